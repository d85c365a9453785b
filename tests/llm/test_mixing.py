import random

import pytest
from pyspark.sql import functions as F

from silverbrook.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, target string"


def water_fill(sizes):
    """Targets by the rule as stated: cap, reshare by weight, again."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        open_ = [s for s in sizes if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return {**full, **share}
        full |= {s: 2.0 * sizes[s] for s in over}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w%d" % rng.randrange(99) for _ in range(rng.randrange(1, 400))), "en",
             rng.choice(["a", "b", "B", None, "ä", "z", "a", "a"]), None, "clash") for i in range(400)]
    rows += [(None, "null id", "en", "a", 7, "x"), (3, None, None, "b", None, None), (4, "", None, None, 0, None),
             (5, " \t\n", "en", "z", 3, "x"), (6, "word " * 20_000, "en", "b", 1, "x")] + [rows[7]] * 3
    return spark.createDataFrame(rows, SCHEMA)


def mixed(docs):
    sizes = docs.select("doc_id", F.col("doc_id").alias("key"), "source", F.coalesce(
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))
    return [r.asDict() for r in mixing.taken(sizes).collect()]


def test_targets_and_taken(docs):
    rows, sizes = mixed(docs), {}
    assert len(rows) == docs.count()
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    want = water_fill(sizes)
    for source in sizes:
        own = [r for r in rows if r["source"] == source]
        assert {r["source_size"] for r in own} == {sizes[source]}
        assert own[0]["target"] == pytest.approx(want[source])
        assert abs(sum(r["taken"] for r in own) - want[source]) <= 2 * mixing.BLOCK_TOKENS
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert sorted(map(str, mixed(docs))) == sorted(map(str, rows))


@pytest.mark.parametrize("seed", range(6))
def test_quotas_equal_highest_quotients(spark, seed):
    rng = random.Random(seed)
    seats = rng.choice([0, 1, 7, 100, 1000])
    parties = [("p%02d" % i, rng.choice([0, 1, 1, 5, rng.randrange(10_000)])) for i in range(rng.randrange(1, 40))]
    frame = spark.createDataFrame([(k, w, seats) for k, w in parties], "k string, w long, n long")
    got = {r["k"]: r["q"] for r in mixing.sainte_lague(frame, [], "k", "w", "n", "q").collect()}
    want = dict.fromkeys([k for k, _ in parties], 0)
    if any(w for _, w in parties):
        for _ in range(seats):
            best = max((k for k, w in sorted(parties) if w), key=lambda k: (
                dict(parties)[k] / (2 * want[k] + 1), [-ord(c) for c in k]))
            want[best] += 1
    assert got == want


def test_stage_takes_the_words(spark, docs):
    out = mixing.stage(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    plan = mixed(docs)
    assert abs(sum(len(r["text"].split()) for r in rows) - sum(r["taken"] for r in plan)) < 200
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"]}
    assert all(r["text"] in texts[r["doc_id"]] for r in rows if r["doc_id"] not in (3, 4, 5, 6))


def test_empty(spark, docs):
    assert mixing.stage(spark, docs.limit(0), "").count() == 0
    assert mixed(docs.where("text is null"))[0]["taken"] == 0
