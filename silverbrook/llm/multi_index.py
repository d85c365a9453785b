"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: centred, turned onto their principal axes and then by a learned
rotation (iterative quantisation), one bit per axis. A code is cut into substrings of at most
``SUBSTRING`` bits, each with an index of its own. If two codes differ in at most r of all bits, one
of m substrings differs in at most r / m, so probing each index within r / m bits retrieves every
code within r. Those are ranked by exact Euclidean distance in double precision.

The rotation and the radius are fitted on a bounded sample (``SAMPLE`` vectors): the radius is the
``COVER`` quantile of the Hamming distances between sampled vectors and their ``K`` nearest in the
sample, which are farther away than the nearest of all. Every vector is indexed. A query with fewer
than ``K`` vectors within the radius is searched again without one, exactly.

Spark deals the index out in blocks of about ``BLOCK`` vectors by a hash of the id and the stated
queries in blocks of ``QUERIES``; a task holds one block of each, and hands on the ``K`` best of
every query. Equal vectors and crowded buckets are spread like all others.

Defined results: vectors that are null, zero, hold null or non-finite parts, or differ in length
from the most frequent length (ties: the shorter), and rows without an id take no part. Rows that repeat an id count
once, with the smallest vector. Ties in distance go to the smaller id. Fewer candidates than ``K``
give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import stored

K = 10
EVERY = 100
SAMPLE = 4096
SUBSTRING = 16
COVER = 0.98
TURNS = 30
BLOCK = 8192
QUERIES = 512
SEED = 3


class Coder:
    """Rotation to binary codes, and the search radius."""

    def __init__(self, sample: np.ndarray, k: int = K) -> None:
        rng = np.random.default_rng(SEED)
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        self.bits = sample.shape[1] if sample.shape[1] <= 64 else 64
        axes = axes[:, ::-1][:, : self.bits]
        turn = np.linalg.qr(rng.normal(size=(self.bits, self.bits)))[0]
        flat = centred @ axes
        for _ in range(TURNS):
            signs = np.where(flat @ turn > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ flat)
            turn = (u @ v).T
        self.axes = axes @ turn
        self.parts = -(-self.bits // SUBSTRING)
        self.radius = self._radius(sample, k)

    def _radius(self, sample: np.ndarray, k: int) -> int:
        codes = self.codes(sample)
        few = np.arange(min(256, len(sample)))
        square = (sample**2).sum(axis=1)
        apart = square[few, None] + square - 2 * sample[few] @ sample.T
        apart[few, few] = np.inf
        near = np.argsort(apart, axis=1)[:, : min(k, len(sample) - 1)]
        if not near.size:
            return self.bits
        bits = np.bitwise_count(codes[few, None] ^ codes[near])
        return int(np.quantile(bits, COVER, method="higher"))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.mean) @ self.axes > 0
        padded = np.zeros((len(bits), 64), dtype=bool)
        padded[:, : self.bits] = bits
        return np.packbits(padded, axis=1).view(">u8").astype(np.uint64)[:, 0]

    def substrings(self, codes: np.ndarray) -> list[np.ndarray]:
        return [(codes >> np.uint64(64 - SUBSTRING * (i + 1)) & np.uint64((1 << SUBSTRING) - 1)).astype(np.int64)
                for i in range(self.parts)]


class Index:
    """The substring indexes of one block of vectors."""

    def __init__(self, coder: Coder, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.coder, self.ids, self.vectors = coder, ids, vectors
        self.codes = coder.codes(vectors)
        self.tables = []
        for keys in coder.substrings(self.codes):
            rows = np.argsort(keys, kind="stable")
            self.tables.append((rows, np.searchsorted(keys[rows], np.arange((1 << SUBSTRING) + 1))))
        every = np.arange(1 << SUBSTRING)
        self.flips = every[np.bitwise_count(every.astype(np.uint64)) <= coder.radius // coder.parts]

    def within(self, code: np.uint64) -> np.ndarray:
        """Rows whose codes lie within the radius."""
        found = np.zeros(len(self.ids), dtype=bool)
        for key, (rows, start) in zip(self.coder.substrings(np.array([code])), self.tables, strict=True):
            probes = key[0] ^ self.flips
            begin, end = start[probes], start[probes + 1]
            full = end > begin
            begin, sizes = begin[full], (end - begin)[full]
            if len(begin):
                jumps = np.repeat(begin - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
                found[rows[jumps + np.arange(len(jumps))]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= self.coder.radius]

    def nearest(self, query: int, vector: np.ndarray, k: int, exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k best rows, not counting the query's own."""
        rows = np.arange(len(self.ids)) if exact else self.within(self.coder.codes(vector[None])[0])
        rows = rows[self.ids[rows] != query]
        apart = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[rows], apart))[:k]
        return self.ids[rows[best]], apart[best]


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, v in doubles."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & fine & F.exists(v, lambda x: x != 0)).select("vec_id", v.alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not common:
        return rows
    return rows.where(F.size("v") == common[0]["n"]).groupBy("vec_id").agg(F.min("v").alias("v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` against ``vectors``, both (vec_id, v)."""
    spark = vectors.sparkSession
    result = "query_id long, vec_id long, score double"
    sample = np.array([r[0] for r in vectors.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(
        SAMPLE).select("v").collect()])
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    coder = Coder(sample, k)

    def deal(queries: DataFrame, exact: bool) -> DataFrame:
        blocks = 1 + vectors.count() // BLOCK
        turns = 1 + queries.count() // QUERIES
        place = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        index = vectors.select("vec_id", "v", place(blocks, 1).cast("int").alias("block"), every(turns).alias("turn"))
        asked = queries.select("vec_id", "v", every(blocks).alias("block"), place(turns, 2).cast("int").alias("turn"))

        def look(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(index) and len(asked):
                block = Index(coder, index["vec_id"].to_numpy(), np.stack(index["v"]))
                for query, vector in zip(asked["vec_id"], asked["v"], strict=True):
                    ids, apart = block.nearest(query, np.asarray(vector), k, exact)
                    out.append(pd.DataFrame({"query_id": query, "vec_id": ids, "score": apart}))
            return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

        return index.groupBy("block", "turn").cogroup(asked.groupBy("block", "turn")).applyInPandas(look, result)

    found = stored(deal(queries, False), "near")
    full = found.groupBy("query_id").count().where(F.col("count") >= k)
    lacking = stored(queries.join(full, queries["vec_id"] == full["query_id"], "left_anti"), "lacking")
    if not lacking.isEmpty():
        found = found.join(lacking, found["query_id"] == lacking["vec_id"], "left_anti").unionByName(
            deal(lacking, True))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    vectors = stored(usable(rows), "vectors")
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
