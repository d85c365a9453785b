"""Quality rules: base rules on counts, then robust multivariate outliers per language and source.

Every document gets a vector of transformed shares. Per (language, source) a minimum covariance
determinant estimate of centre and scatter is found by concentration steps: begin at medians and
quartiles, keep the ``SUPPORT`` of the rows nearest to the centre, estimate again. Documents whose
squared Mahalanobis distance passes ``CUTOFF`` are rejected.

All of it is DataFrame code. A step is one aggregation over vectors of integers by group and
distance class, so a group with a third of all rows is summed before the shuffle, the sums are
exact, and reruns agree.

Defined results: a null text counts as empty and fails the base rules. Null language or source is
a group like any other. Groups with fewer than ``MIN_ROWS`` usable documents share one estimate.
Repeated rows count as often as they occur; an empty table gives an empty result. A window of
three words is compared by its 64-bit hash within a document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import bind, documents, packed, stored, unpacked, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
STEPS = 3
MIN_ROWS = 100
SUPPORT = 0.75
SALTS = 16
# Scatter of the nearest three quarters of a five-dimensional normal, brought to the whole:
# 0.75 / P(chi2 with 7 degrees of freedom <= the 0.75 quantile with 5).
CONSISTENCY = 1.42
# Quantile of chi2 with 5 degrees of freedom at 1 - 1e-8.
CUTOFF = 46.0
# Features are integers in thousandths; a scale below the floor is taken as the floor.
UNIT = 1000
FLOORS = {"f_length": 40.0, "f_symbols": 40.0, "f_repeats": 110.0, "f_capitals": 40.0, "f_marks": 40.0}
FEATURES = list(FLOORS)
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more."""

    def flagged(pairs: Column) -> Column:
        value = lambda i: F.get(pairs, i)["h"]
        places = F.transform(
            F.filter(
                F.sequence(F.lit(0), F.size(pairs) - 1),
                lambda i: F.coalesce(value(i) == value(i - 1), F.lit(False))
                | F.coalesce(value(i) == value(i + 1), F.lit(False)),
            ),
            lambda i: F.get(pairs, i)["i"],
        )
        return bind(places, lambda p: F.size(F.array_distinct(F.concat(
            p, F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2)))))

    def of_hashes(hashes: Column) -> Column:
        numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(F.sort_array(numbered), flagged))

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bind(hashes, of_hashes))


def measures(text: Column) -> Column:
    """Struct of the counts of one whole text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    long = lambda c, name: c.cast("long").alias(name)
    of_lines = bind(lines, lambda x: F.struct(
        F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    of_words = bind(words_of(text), lambda w: F.struct(
        F.size(w).alias("n"), _repeat_words(w).alias("rep")))
    return F.struct(
        of_words.alias("words"),
        long(count(r"[\x20\x09-\x0D]+"), "word_chars"),
        long(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), "n_symbols"),
        of_lines.alias("lines"),
        long(count(r"[^\p{Lu}]+"), "n_capitals"),
        long(count(r"[\p{L}\p{N}\s]+"), "n_marks"),
    )


def with_stats(frame: DataFrame, text: Column, lang: Column, source: Column) -> DataFrame:
    """Adds the base counts, the base verdict, the group and the feature vector."""
    out = frame.withColumns({"m_": measures(text), "group_": F.to_json(F.struct(
        lang.alias("l"), source.alias("s")))})
    out = out.withColumns({
        "n_words": F.col("m_.words.n").cast("long"),
        "word_chars": F.col("m_.word_chars"),
        "n_symbols": F.col("m_.n_symbols"),
        "n_dup_lines": F.col("m_.lines.dup").cast("long"),
        "n_repeat_words": F.col("m_.words.rep").cast("long"),
    })
    share = lambda part, whole: F.coalesce(F.sqrt(
        F.col(part) / F.when(F.col(whole) > 0, F.col(whole))), F.lit(0.0))
    fixed = lambda c: F.round(c * UNIT).cast("long")
    return out.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "f_length": fixed(F.coalesce(F.log(F.col("word_chars") / F.when(
            F.col("n_words") > 0, F.col("n_words"))), F.lit(0.0))),
        "f_symbols": fixed(share("n_symbols", "word_chars")),
        "f_repeats": fixed(share("n_repeat_words", "n_words")),
        "f_capitals": fixed(share("m_.n_capitals", "word_chars")),
        "f_marks": fixed(share("m_.n_marks", "word_chars")),
    }).drop("m_")


def _inverse_root(cov: dict[tuple[int, int], Column], groups: DataFrame, keep: list[str]) -> DataFrame:
    """Columns w_i_j of the inverse Cholesky factor of each group's scatter."""
    p = len(FEATURES)
    out = groups.select(*keep, *[cov[i, j].alias(f"c_{i}_{j}") for i in range(p) for j in range(i + 1)])
    col = F.col
    for j in range(p):
        done = reduce(lambda a, k: a - col(f"l_{j}_{k}") * col(f"l_{j}_{k}"), range(j), col(f"c_{j}_{j}"))
        out = out.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(done, F.lit(1e-6))))
        out = out.withColumns({
            f"l_{i}_{j}": reduce(lambda a, k: a - col(f"l_{i}_{k}") * col(f"l_{j}_{k}"), range(j),
                                 col(f"c_{i}_{j}")) / col(f"l_{j}_{j}")
            for i in range(j + 1, p)})
    for i in range(p):
        out = out.withColumns({
            f"w_{i}_{j}": (F.lit(1.0) if i == j else -reduce(
                lambda a, b: a + b, [col(f"l_{i}_{k}") * col(f"w_{k}_{j}") for k in range(j, i)]))
            / col(f"l_{i}_{i}") for j in range(i + 1)})
    return out.select(*keep, *[f"w_{i}_{j}" for i in range(p) for j in range(i + 1)])


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's estimate."""
    rows = [reduce(lambda a, b: a + b, [
        F.col(f"w_{i}_{j}") * (F.col(x) - F.col(f"mean_{j}")) for j, x in enumerate(FEATURES[: i + 1])])
        for i in range(len(FEATURES))]
    return reduce(lambda a, b: a + b, [r * r for r in rows])


def fit(stats: DataFrame) -> DataFrame:
    """One row per group: centre ``mean_i`` and inverse root ``w_i_j`` of the scatter.

    ``estimate_of`` names the rows' own groups; small groups point to the pooled estimate ''.
    """
    p = len(FEATURES)
    usable = stats.where(~F.col("base_failed")).select("group_", *FEATURES)
    sizes = stored(usable.groupBy("group_").agg(F.count("*").alias("n_")), "groups")
    target = F.when(F.col("n_") >= MIN_ROWS, F.col("group_")).otherwise(F.lit(""))
    # A group's rows meet its estimate in SALTS tasks; what they share is summed there first.
    usable = usable.join(sizes, "group_").select(
        target.alias("estimate"), *FEATURES, F.pmod(F.xxhash64(*FEATURES), F.lit(SALTS)).alias("salt"))
    quartiles = usable.groupBy("estimate").agg(*[
        F.percentile(x, [0.25, 0.5, 0.75]).alias(f"q_{i}") for i, x in enumerate(FEATURES)])
    start = quartiles.select(
        "estimate", *[F.col(f"q_{i}")[1].alias(f"mean_{i}") for i in range(p)],
        *[((F.lit(1.0) / F.greatest((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349,
                                    F.lit(FLOORS[FEATURES[i]]))) if i == j else F.lit(0.0)).alias(f"w_{i}_{j}")
          for i in range(p) for j in range(i + 1)])
    model = start
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    for _ in range(STEPS):
        # Distance classes: 32 per factor e, so that few rows per group carry all sums.
        salted = model.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        near = usable.join(salted, ["estimate", "salt"]).withColumn(
            "class", F.floor(F.log1p(_distance()) * 32).cast("int"))
        sums = near.groupBy("estimate", "class").agg(
            F.count("*").alias("n"), *[F.sum(x).alias(f"s_{i}") for i, x in enumerate(FEATURES)],
            *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s_{i}_{j}") for i, j in pairs])
        whole = Window.partitionBy("estimate")
        before = whole.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
        kept = sums.withColumns({
            "before": F.coalesce(F.sum("n").over(before), F.lit(0)), "all": F.sum("n").over(whole)}
        ).where(F.col("before") < SUPPORT * F.col("all"))
        total = kept.groupBy("estimate").agg(
            F.sum("n").alias("n"), *[F.sum(f"s_{i}").alias(f"s_{i}") for i in range(p)],
            *[F.sum(f"s_{i}_{j}").alias(f"s_{i}_{j}") for i, j in pairs])
        total = total.withColumns({f"mean_{i}": F.col(f"s_{i}") / F.col("n") for i in range(p)})
        cov = {(i, j): CONSISTENCY * (F.col(f"s_{i}_{j}") / F.col("n") - F.col(f"mean_{i}") * F.col(f"mean_{j}"))
               + (F.lit(FLOORS[FEATURES[i]] ** 2) if i == j else F.lit(0.0)) for i, j in pairs}
        model = _inverse_root(cov, total, ["estimate", *[f"mean_{i}" for i in range(p)]])
    model = stored(model, "estimates")
    # As a table its size is known, and texts need no shuffle to meet a small one.
    return stored(sizes.select("group_", target.alias("estimate")).join(model, "estimate"), "fitted")


def judged(stats: DataFrame) -> DataFrame:
    """Adds ``distance`` (null where the base rules fail) and ``kept``."""
    joined = stats.join(fit(stats), "group_", "left")
    distance = F.when(~F.col("base_failed"), _distance())
    return joined.withColumn("distance", distance).withColumn(
        "kept", ~F.col("base_failed") & (F.col("distance") <= CUTOFF))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    stats = with_stats(docs, F.col("text"), F.col("lang"), F.col("source")).drop("text", "lang", "source")
    out = judged(stored(stats, "quality"))
    return out.select("doc_id", *BASE, "base_failed", "kept", "distance")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the rules keep."""
    stats = with_stats(packed(docs), F.col("row.text"), F.col("row.lang"), F.col("row.source"))
    return unpacked(judged(stored(stats, "quality")).where("kept"))
