"""Quality classifier: a byte-level convolutional network in numpy.

The whole text is covered by chunks of ``CHUNK`` bytes that overlap by half. In a chunk, learned
filters over ``2 * STRIDE`` embedded bytes move in steps of ``STRIDE``; their largest outputs give
the chunk's evidence, and the mean of all chunks' evidence gives one probability.

Training takes a bounded sample of labelled documents: ``PER_CLASS`` of each label, chosen by a hash
of the id, with up to ``TRAIN_CHUNKS`` chunks spread evenly over each. It needs seconds and a few
megabytes, so it runs on the driver. Scoring covers every byte of every text, a megabyte at a time.
Only the text is an input.

Defined results: null and empty texts are one chunk of padding. Labels with a null id or null
quality are left out; repeated labels or documents count as often as they occur. Without labels of
both kinds the score is the smoothed share of good ones, 0.5 when there are none. A null id is not
held out. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook.llm.common import documents

CHUNK = 512
HALF = CHUNK // 2
STRIDE = 8
WIDTH = 8  # numbers per embedded byte
FILTERS = 32
PER_CLASS = 1000
TRAIN_CHUNKS = 8
EPOCHS = 12
RATE = 0.004
SEED = 5
THRESHOLD = 0.7
PIECE = 1 << 20
_BLOCK = STRIDE * WIDTH
_STEPS = HALF // STRIDE


class Network:
    """Embedding, filters, and weights of the filters' maxima. Byte 0 is padding and embeds to 0."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(size=shape).astype(np.float32)
        self.embed = normal(256, WIDTH) * np.float32(0.5)
        self.embed[0] = 0
        # Left half of all filters, then right half.
        self.filters = normal(_BLOCK, 2 * FILTERS) * np.float32((2 * _BLOCK) ** -0.5)
        self.offset = np.zeros(FILTERS, dtype=np.float32)
        self.weights = normal(FILTERS) * np.float32(FILTERS**-0.5)
        self.bias = np.zeros(1, dtype=np.float32)
        self.constant: float | None = None

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.offset, self.weights, self.bias]

    def outputs(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filter outputs per step, and the embedded blocks. Filters stay within half a chunk."""
        blocks = self.embed[data].reshape(-1, _BLOCK)
        both = blocks @ self.filters
        out = both[:, :FILTERS].copy()
        right = both[1:, FILTERS:].copy()
        right[_STEPS - 1 :: _STEPS] = 0
        out[:-1] += right
        return out + self.offset, blocks

    def evidence(self, maxima: np.ndarray) -> np.ndarray:
        return np.maximum(maxima, 0) @ self.weights + self.bias[0]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """One probability per text."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        group: list[tuple[int, bytes]] = []
        size = 0

        def finish() -> None:
            halves = np.array([max(1, -(-len(raw) // HALF)) for _, raw in group])
            data = b"".join(raw.ljust(n * HALF, b"\0") for (_, raw), n in zip(group, halves, strict=True))
            last = np.cumsum(halves)
            out, _ = self.outputs(np.frombuffer(data, dtype=np.uint8))
            maxima = out.reshape(-1, _STEPS, FILTERS).max(axis=1)
            chunks = maxima.copy()
            np.maximum(maxima[:-1], maxima[1:], out=chunks[:-1])
            chunks[last - 1] = maxima[last - 1]
            # The last half of a longer text is in the chunk before it.
            whole = np.ones(len(chunks), dtype=bool)
            whole[last[halves > 1] - 1] = False
            found = np.where(whole, self.evidence(chunks), 0)
            first = last - halves
            owner = [i for i, _ in group]
            np.add.at(total, owner, np.add.reduceat(found, first))
            np.add.at(count, owner, np.add.reduceat(whole.astype(float), first))

        for i, raw in enumerate(texts):
            # Pieces share a half, so each chunk of the text lies in one of them.
            for at in range(0, max(1, len(raw) - HALF), PIECE - HALF):
                group.append((i, raw[at : at + PIECE]))
                size += len(group[-1][1])
                if size >= PIECE:
                    finish()
                    group, size = [], 0
        if group:
            finish()
        return 1 / (1 + np.exp(-total / np.maximum(count, 1)))


def chunks_of(raw: bytes, most: int | None = None) -> list[bytes]:
    """The overlapping chunks of a text, or ``most`` of them spread evenly."""
    count = max(1, -(-len(raw) // HALF) - 1)
    picked = range(count) if most is None or count <= most else np.linspace(0, count - 1, most).astype(int)
    return [raw[c * HALF : c * HALF + CHUNK].ljust(CHUNK, b"\0") for c in picked]


def train(samples: list[tuple[list[bytes], int]], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Fits a network to (chunks, label) of documents by Adam on their log loss."""
    net = Network(seed)
    good = sum(y for _, y in samples)
    if good in (0, len(samples)):
        net.constant = (good + 1) / (len(samples) + 2)
        return net
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), 32):
            batch = [samples[i] for i in order[at : at + 32]]
            step += 1
            for p, g, (m, v) in zip(net.parameters(), _gradients(net, batch), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.embed[0] = 0
    return net


def _gradients(net: Network, batch: list[tuple[list[bytes], int]]) -> list[np.ndarray]:
    sizes = np.array([len(c) for c, _ in batch])
    labels = np.array([y for _, y in batch], dtype=np.float32)
    data = np.frombuffer(b"".join(x for c, _ in batch for x in c), dtype=np.uint8)
    n, steps = int(sizes.sum()), CHUNK // STRIDE
    out, blocks = net.outputs(data)
    out = out.reshape(n, steps, FILTERS)
    at = out.argmax(axis=1)
    maxima = np.take_along_axis(out, at[:, None, :], axis=1)[:, 0]
    owner = np.repeat(np.arange(len(batch)), sizes)
    logits = np.bincount(owner, net.evidence(maxima)) / sizes
    error = ((1 / (1 + np.exp(-logits)) - labels) / len(batch)).astype(np.float32)
    each = (error / sizes)[owner].astype(np.float32)
    of_max = each[:, None] * net.weights * (maxima > 0)
    place = np.arange(n)[:, None] * steps + at
    beyond = at % _STEPS == _STEPS - 1
    left = blocks[place]
    right = np.where(beyond[..., None], 0, blocks[np.minimum(place + 1, len(blocks) - 1)])
    g_filters = np.concatenate([
        np.einsum("nf,nfb->bf", of_max, left), np.einsum("nf,nfb->bf", of_max, right)], axis=1)
    g_embed = np.zeros_like(net.embed)
    rows = data.reshape(-1, STRIDE)
    for side, where, kept in ((0, place, np.ones_like(beyond)), (1, np.minimum(place + 1, len(rows) - 1), ~beyond)):
        flow = (of_max * kept)[..., None] * net.filters[:, side * FILTERS : (side + 1) * FILTERS].T
        flow, touched = flow.reshape(-1, WIDTH), rows[where].reshape(-1)
        for d in range(WIDTH):
            g_embed[:, d] += np.bincount(touched, flow[:, d], minlength=256).astype(np.float32)
    return [g_embed, g_filters.astype(np.float32), of_max.sum(axis=0),
            (each[:, None] * np.maximum(maxima, 0)).sum(axis=0), np.array([each.sum()], dtype=np.float32)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _training_chunks(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: chunks_of((t or "").encode(), TRAIN_CHUNKS))


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[list[bytes], int]]:
    """Chunks and label of the sampled documents, at most ``PER_CLASS`` of each label."""
    place = F.xxhash64(F.lit(SEED), "doc_id")
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    out = []
    for label in (0, 1):
        chosen = known.where(F.col("quality") == label).select("doc_id").orderBy(place, "doc_id").limit(PER_CLASS)
        found = docs.select("doc_id", "text").join(chosen, "doc_id").orderBy(place, "doc_id", F.md5("text")).limit(PER_CLASS)
        out += [(list(map(bytes, r[0])), label) for r in found.select(_training_chunks("text")).collect()]
    return out


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``score``."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(net.scores([(t or "").encode() for t in batch]), dtype="float64")

    return docs.withColumn("score", score("text"))


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    net = train(sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored(docs, net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
