import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverbrook.llm import byte_cnn as C


def slow_score(net, raw):
    """The network as its definition says, one chunk at a time."""
    logits = []
    raw = raw.ljust(C.HALF * max(1, -(-len(raw) // C.HALF)), b"\0")
    halves = len(raw) // C.HALF
    blocks = net.embed[np.frombuffer(raw, dtype=np.uint8)].reshape(-1, C.STRIDE * C.WIDTH).astype(float)
    steps = C.HALF // C.STRIDE
    right = np.vstack([blocks[1:], np.zeros((1, blocks.shape[1]))])
    right[steps - 1 :: steps] = 0
    out = blocks @ net.filters[:, : C.FILTERS] + right @ net.filters[:, C.FILTERS :] + net.offset
    for c in range(max(1, halves - 1)):
        best = out[c * steps : (c + 2) * steps].max(axis=0)
        logits.append(np.maximum(best, 0) @ net.weights + net.bias[0])
    return 1 / (1 + np.exp(-np.mean(logits)))


def test_scores_cover_whole_texts(monkeypatch):
    net = C.Network(3)
    rng = np.random.default_rng(1)
    texts = [b"", b"a", bytes(rng.integers(1, 255, 5000, dtype=np.uint8))] + [
        bytes(rng.integers(1, 255, n, dtype=np.uint8)) for n in (255, 256, 257, 512, 513, 768, 4096, 20_000)]
    want = [slow_score(net, t) for t in texts]
    assert net.scores(texts) == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(C, "PIECE", 1024)  # long texts in pieces
    assert net.scores(texts) == pytest.approx(want, abs=1e-5)
    assert net.scores([]).tolist() == []


def test_gradients_are_slopes():
    net = C.Network(4)
    rng = np.random.default_rng(2)
    batch = [(C.chunks_of(bytes(rng.integers(1, 255, 1500, dtype=np.uint8))), y) for y in (0, 1, 1)]

    def loss():
        out = 0.0
        for chunks, y in batch:
            logit = np.mean([np.log(p / (1 - p)) for p in net.scores(chunks)])
            out += np.log1p(np.exp(-logit if y else logit)) / len(batch)
        return out

    for p, g in zip(net.parameters(), C._gradients(net, batch), strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, step = p[at], 2e-3
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert (up - down) / (2 * step) == pytest.approx(float(g[at]), rel=0.15, abs=1e-4)


def test_learns_and_holds_out(spark):
    rng = np.random.default_rng(5)
    good = lambda: " ".join("".join(rng.choice(list("etaoin"), 4)) for _ in range(rng.integers(20, 300)))
    rows = [(i, good() if i % 2 else good().upper().replace(" ", "!! "), 9.0) for i in range(400)]
    rows += [(None, None, 1.0), (401, "", 1.0), (402, good() * 300, 1.0), (1, rows[1][1], 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, quality int")
    net = C.train(C.sample(docs, labels), epochs=6)
    got = C.scored(docs.select("doc_id", "text"), net).withColumn("held", C.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert r["held"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in got if r["held"] and r["doc_id"] < 400]
    assert np.mean([(r["score"] >= C.THRESHOLD) == bool(r["doc_id"] % 2) for r in held]) > 0.95
    sampled = docs.where("doc_id < 400").where(~C.held_out(F.col("doc_id"))).count()
    assert len(C.sample(docs, labels)) == sampled


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert C.scored(docs, C.train(C.sample(docs, none))).first()["score"] == 0.5
    ones = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert C.scored(docs, C.train(C.sample(docs, ones))).first()["score"] == pytest.approx(2 / 3)
    assert C.scored(docs.limit(0), C.train([])).count() == 0
