import random

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from silverbrook.llm import byte_bpe, near_dedup, queries

DISTINCT = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, `od.d` int"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9)))
    good = [". ".join(" ".join(word() for _ in range(12)).capitalize() for _ in range(12)) for _ in range(150)]
    rows = [(i, t, rng.choice(["en", None]), f"s{i % 4}", len(t), "r", 1, 2) for i, t in enumerate(good)]
    rows += [(1000 + i, good[0], "en", "s0", 5, None, None, None) for i in range(30)]
    rows += [(2000, good[1] + " extra", "en", "s1", 1, "", 0, 0),
             (2001, good[2] + " password = hunter2hunter2 end", "en", "s1", 1, "", 0, 0),
             (None, None, None, None, None, None, None, None), (3000, "", "", "", 0, "", 0, 0), rows[3], rows[3]]
    return spark.createDataFrame(rows, DISTINCT)


def test_stages_in_order(spark, docs):
    kept = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, kept, "")
        assert out.columns == docs.columns, name
        kept = out.cache()
        assert kept.count() > 0
        assert stage(spark, docs.limit(0), "").count() == 0, name
    rows = kept.collect()
    assert not any("hunter2" in r["text"] for r in rows)
    last = P.STAGES[-1][1](spark, kept, "").collect()
    assert len(last) == len(rows)
    codec = byte_bpe.codec()
    assert sorted((str(r["doc_id"]), *codec.digests([r["text"]])[0]) for r in rows) == sorted(
        (str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in last)


def test_run_and_registration(spark, sf):
    assert [name for name, _ in P.STAGES] == [
        "quality_rules", "near_dedup", "secret_scan", "mixing", "byte_bpe"]
    assert P.run(spark, sf).count() > 0
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}


def test_dedup_leaves_one_of_each(spark, docs):
    out = near_dedup.stage(spark, docs.where(F.length("text") > 0), "")
    assert out.where("doc_id >= 1000").count() == 0 and out.count() == 150
