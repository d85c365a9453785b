import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverbrook.llm import maxent_lm as M


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + [None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    follow = {w: rng.choices([f"w{i}" for i in range(60)], k=3) for w in [f"w{i}" for i in range(60)]}

    def text():
        out = [f"w{rng.randrange(60)}"]
        for _ in range(rng.randrange(1, 120)):
            out.append(rng.choice(follow.get(out[-1], ['w1'])) if rng.random() < 0.9 else f"Rare{rng.randrange(500)}É\xa0x")
        return rng.choice(" \n\t").join(out)

    return [(i, text()) for i in range(500)] + [(None, None), (500, ""), (501, "W1 w1 " * 9000), (7, "new word"), (7, "new word")]


@pytest.mark.parametrize("frequent", [16, 1 << 16])
def test_base_equals_brute_force(spark, rows, frequent, monkeypatch):
    monkeypatch.setattr(M, "FREQUENT", frequent)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.score(docs, ~M.held_out(F.col("doc_id"))).collect()
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), held(i), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n, round(sum(
        math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t)), 5)) for i, t in rows)
    assert want == sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                           round(r["base_score"], 5)) for r in got)
    out = [r for r in got if r["held_out"]]
    assert all(r["score"] < 0 for r in got)
    # The history helps: held-out texts become much likelier than by counts alone.
    assert sum(r["score"] for r in out) > 0.9 * sum(r["base_score"] for r in out)


def test_shares_sum_to_one():
    frequent = [(b"the", 50), (b"a", 20), (b"of", 5), (b"to", 5), (b"x", 1)]
    lex = M.Lexicon(frequent, {M.tail_class(b"ing"): (30, 10)}, 7)
    within = {}
    for (_, n), kind in zip(frequent, lex.classes, strict=True):
        within[kind] = within.get(kind, 0) + (n + 1) / 10 ** lex.shares[kind]
    assert all(0 < x <= 1 + 1e-9 for x in within.values())
    assert lex.tokens == 118 and lex.distinct == 16
    rng = np.random.default_rng(1)
    weights = rng.normal(size=M.empty_weights().shape).astype(np.float32)
    rows = rng.integers(0, 3 * M.ROWS, size=(3, 50))
    total = sum(np.exp(M.log_share(weights, rows, np.full(50, kind))) for kind in range(M.CLASSES))
    assert total == pytest.approx(np.ones(50), abs=1e-5)


def test_features_stay_within_texts():
    own = M.Batches(M.Lexicon([(b"a", 3)], {}, 1))
    together = M.features(*own.encode([[b"a", b"b"], [], [b"c"]]))
    alone = [M.features(*own.encode([t])) for t in ([b"a", b"b"], [], [b"c"])]
    assert (together == np.concatenate(alone, axis=1)).all()


def test_tail_classes_agree(spark):
    words = [b"a", b"ing", "né".encode(), b"\xff\xfe\xfd", b"xy"]
    got = spark.createDataFrame([(bytearray(w),) for w in words], "word binary").select(
        "word", (M.HEAD + 1 + F.crc32(F.substring("word", -2, 2)) % M.TAIL).alias("k")).collect()
    assert all(r["k"] == M.tail_class(bytes(r["word"])) for r in got)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    got = M.score(docs, F.lit(False)).collect()
    assert all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    assert M.score(docs.limit(0), F.lit(True)).count() == 0


def test_all_classes_are_there():
    assert M.CLASSES == 32


def test_changes_of_many_learners_are_averaged(spark):
    """Sums by groups of learners give what one sum gives: a mean weighted by how often a row was met."""
    rng, learners = np.random.default_rng(1), M.FAN + 5
    shape = (learners, M.BLOCK, M.CLASSES)
    change, met = rng.normal(size=shape).astype(np.float32), rng.integers(0, 3, shape[:2]).astype(np.float32)
    change *= met[:, :, None]
    rows = [(7, k, change[k].tobytes(), met[k].tobytes()) for k in range(learners)]
    got = M._mean(spark.createDataFrame(rows, M.CHANGE), learners).collect()
    want = change.sum(axis=0, dtype=np.float64) / np.maximum(met.sum(axis=0), 1)[:, None]
    assert [r["block"] for r in got] == [7]
    assert np.frombuffer(got[0]["mean"], dtype=np.float32).reshape(want.shape) == pytest.approx(want, abs=1e-5)


def test_an_update_moves_each_row_by_its_summed_gradient():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=M.empty_weights().shape).astype(np.float32) / 10
    rows = np.stack([rng.integers(0, 9, 300) + k * M.ROWS for k in range(3)])
    kinds = rng.integers(0, M.CLASSES, 300)
    learner = M.Learner(weights)
    logits = weights[rows].sum(axis=0) + weights[3 * M.ROWS]
    error = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    error[np.arange(300), kinds] -= 1
    learner.update(rows, kinds)
    for row in (0, 3, M.ROWS + 5, 2 * M.ROWS + 8):
        slope = error[(rows == row).any(axis=0)].sum(axis=0)
        step = M.RATE * slope / np.sqrt(1e-6 + (slope**2).sum() / M.CLASSES)
        assert learner.weights[row] == pytest.approx(np.clip(weights[row] - step, -20, 20), abs=1e-3)
    assert learner.met[: M.ROWS].sum() == learner.met[3 * M.ROWS] == 300
