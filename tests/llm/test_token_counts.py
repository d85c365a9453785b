import random

import numpy as np
import pytest

from silverbrook.llm import token_counts as C


def test_counts_equal_tokenizer(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("word%d" % rng.randrange(50) for _ in range(rng.choice([0, 1, 5, 300])))) for i in range(300)]
    rows += [(None, "null id"), (7, None), (7, ""), (8, "long " * 30_000), ((1 << 62) + 1, "large id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = C.lengths(C.scan(C.flatten(docs, block_tokens=64))).select("doc_id", "n_tokens").collect()
    want = [(i, len(C.encoding().encode_ordinary(t or ""))) for i, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert C.lengths(C.scan(C.flatten(docs.limit(0)))).count() == 0


@pytest.mark.parametrize("block", [1, 3, 16, 1000])
def test_flat_files_from_elsewhere(spark, tmp_path, block):
    rng = random.Random(block)
    want = []
    for name in ("a.bin", "b.bin", "c.bin", "empty.bin"):
        tokens = [C.SEPARATOR if rng.random() < 0.2 else rng.randrange(50_000) for _ in range(rng.randrange(1, 200))]
        tokens = [] if name == "empty.bin" else tokens[:-1] + [C.SEPARATOR] if name == "a.bin" else tokens + [5]
        (tmp_path / name).write_bytes(np.array(tokens, dtype="<u2").tobytes())
        sizes, run = [], 0
        for t in tokens:
            if t == C.SEPARATOR:
                sizes.append(run)
                run = 0
            else:
                run += 1
        want += [(name, i, n) for i, n in enumerate(sizes + [run] * (run > 0))]
    rows = C.lengths(C.scan(C.blocks_of(spark, str(tmp_path), block))).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["ordinal"], r["n_tokens"]) for r in rows) == want
