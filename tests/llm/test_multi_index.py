import numpy as np
import pytest
from pyspark.sql import functions as F

from silverbrook.llm import multi_index as M


def exact(ids, vectors, query, k=M.K):
    apart = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(axis=1))
    apart[ids == query] = np.inf
    best = np.lexsort((ids, apart))[:k]
    return [(int(i), d) for i, d in zip(ids[best], apart[best]) if np.isfinite(d)]


def frame(spark, ids, vectors):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in zip(ids, vectors)],
        "vec_id long, embedding array<float>, rank int")


def run(spark, rows):
    vectors = M.usable(rows.select("vec_id", "embedding"))
    return M.search(vectors, vectors.where(F.col("vec_id") % M.EVERY == 0)).collect()


def test_pigeonhole_retrieves_all_within_radius():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 40))
    coder = M.Coder(vectors[:500])
    coder.radius = 14
    index = M.Index(coder, np.arange(3000), vectors)
    for q in range(0, 3000, 97):
        apart = np.bitwise_count(index.codes ^ index.codes[q])
        assert set(index.within(index.codes[q])) == set(np.flatnonzero(apart <= 14))


@pytest.mark.parametrize("dims", [2, 24, 64, 100])
def test_recall(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = rng.normal(size=(3000, dims)).astype(np.float32)
    vectors[500:600] = vectors[0]  # a crowd of copies
    got = run(spark, frame(spark, range(3000), vectors))
    hits = total = 0
    for q in range(0, 3000, 100):
        want = exact(np.arange(3000), vectors.astype(float), q)
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 11))
        assert all(abs(s - np.linalg.norm(vectors[q].astype(float) - vectors[i].astype(float))) < 1e-12 for _, i, s in own)
        hits += len({i for i, _ in want} & {i for _, i, _ in own})
        total += len(want)
    assert hits / total >= 0.9
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0] == list(range(500, 510))


def test_odd_rows(spark):
    ids = [100, 200, 3, 4, 5, 6, 7, 8, None, 3]
    vectors = [[1, 0], [0, 1], [1, 1], None, [0, 0], [None, 1], [float("nan"), 1], [1, 2, 3], [1, 1], [1, 1]]
    got = run(spark, frame(spark, ids, vectors))
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [
        (100, 1, 3), (100, 2, 200), (200, 1, 3), (200, 2, 100)]
    assert run(spark, frame(spark, [], [])) == []
    assert run(spark, frame(spark, [100], [[1, 2]])) == []
