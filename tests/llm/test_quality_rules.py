import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from silverbrook.llm import quality_rules as Q


def counted(text):
    """The base counts, as the rules state them."""
    text = text or ""
    cut = lambda s: [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", s) if w]
    words = cut(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if cut(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9)))
    good = lambda: ". ".join(" ".join(word() for _ in range(12)).capitalize() for _ in range(rng.randrange(8, 20)))
    rows = [(i, good(), rng.choice(["en", "de", None]), "s%d" % rng.randrange(2), "kept") for i in range(900)]
    rows += [(1000 + i, " ".join(word() + "%$#&" for _ in range(120)), "en", "s0", "x") for i in range(10)]
    rows += [(1100 + i, good().upper().replace(" ", "!! "), "de", "s1", "x") for i in range(10)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s0", "x"), (2002, "a b c " * 9000, "en", "s0", "x"),
             (None, good(), "en", "only here", "x"), (2003, "x\x0by z\u0085w 🙂 é\n\nx\nx\n \nx", "fr", "s9", "x")]
    rows += [rows[0]] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, group_ string")


def test_base_counts_equal_brute_force(spark, docs):
    texts = [r["text"] for r in docs.collect()]
    rng = random.Random(4)
    texts += [" ".join(rng.choice("abc\n") for _ in range(rng.randrange(30))) for _ in range(300)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = Q.with_stats(frame, F.col("text"), F.lit("en"), F.lit("s"))
    for r in got.select("i", *Q.BASE).collect():
        assert tuple(r)[1:] == counted(texts[r["i"]]), texts[r["i"]][:80]


def test_stage_rejects_outliers_and_keeps_clean(spark, docs):
    out = Q.stage(spark, docs, "")
    assert out.columns == docs.columns
    kept = Counter(r["doc_id"] for r in out.collect())
    assert kept[0] == 3 and kept[None] == 1
    assert sum(kept[i] > 0 for i in range(900)) >= 895
    assert not any(kept[i] for i in [*range(1000, 1010), *range(1100, 1110), 2000, 2001, 2002, 2003])


def test_estimate_ignores_outliers(spark):
    """A quarter of far rows moves neither centre nor scatter much."""
    rng = random.Random(5)
    rows = [(False, "g", *[int(rng.gauss(1000, 100)) for _ in Q.FEATURES]) for _ in range(3000)]
    rows += [(False, "g", *[5000] * len(Q.FEATURES)) for _ in range(700)]
    schema = "base_failed boolean, group_ string, " + ", ".join(f"{f} long" for f in Q.FEATURES)
    found = Q.fit(spark.createDataFrame(rows, schema)).first()
    for i, name in enumerate(Q.FEATURES):
        assert abs(found[f"mean_{i}"] - 1000) < 40
        scale = (100**2 + Q.FLOORS[name] ** 2) ** 0.5
        assert 0.6 < found[f"w_{i}_{i}"] * scale < 1.6


def test_small_groups_share_and_empty(spark, docs):
    few = docs.where("source = 'only here'")
    assert Q.stage(spark, few, "").count() == 1
    assert Q.stage(spark, docs.limit(0), "").count() == 0
