"""Mixing sources to target weights: equal-token blocks by highest quotients.

Token targets per source come from weights and a cap of ``max_passes`` times the source. Blocks of
``BLOCK_TOKENS`` words are then apportioned by Sainte-Lague (quotients weight / (2k + 1)) twice:
to sources by target, and within a source to its shards by size, which gives an integer quota per
shard. A shard lays out its documents in seeded order and takes its blocks one after the other
from a seeded start, round the end if need be, so only documents at the two ends are cut.

Everything is DataFrame code on (id, source, size) rows. Only the plan's windows over sources run
unpartitioned, one row per source and its few marginal quotients; a source's documents are spread over shards, so a
source with a third of all rows is no large group. Sums are of integers and the order is by hash,
so reruns agree.

Defined results: null text has size 0, size 0 takes 0. A null source is a source of its own, last
in order. Null or repeated ids are taken as separate documents. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import documents, packed, stored, unpacked, with_text, words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
BLOCK_TOKENS = 8
SHARD_TOKENS = 1 << 18
MAX_SHARDS = 1 << 16
SEED = 20


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """Adds ``target``: ``share`` of all tokens by weight, none above its cap.

    Resharing the excess until none is above fills all sources to one level per weight; sources
    whose cap lies below that level are full. In order of cap per weight these come first.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.lit(list(map(float, weights)))[(F.row_number().over(order) - 1) % len(weights)]
    rows = totals.withColumn("weight", weight)
    cap = MAX_PASSES * F.col("source_size")
    level = Window.orderBy(cap / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumns({
        "rest": share * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
        "open": F.sum("weight").over(after),
    }).withColumn("fills", F.col("rest") / F.col("open"))
    found = F.min(F.when(F.col("fills") <= cap / F.col("weight"), F.struct(
        (cap / F.col("weight")).alias("at"), F.col("fills"))))
    rows = rows.withColumn("level", found.over(everything)["fills"])
    return rows.withColumn("target", F.coalesce(F.least(
        cap.cast("double"), F.col("level") * F.col("weight")), cap.cast("double"), F.lit(0.0))).drop(
            "rest", "open", "fills", "level")


def sainte_lague(parties: DataFrame, group: list[str], key: str, weight: str, seats: str, out: str) -> DataFrame:
    """Gives each group's ``seats`` to its parties by the highest quotients weight / (2k + 1).

    With m parties, no party's seats differ from its share by more than the share * m / seats
    and one, so only the quotients in that span are ranked: about five per party.
    """
    whole = Window.partitionBy(*group)
    col = F.col
    rows = parties.withColumns({
        "m_": F.count("*").over(whole), "w_": F.sum(weight).over(whole)})
    fair = F.when(col("w_") > 0, col(weight) * col(seats) / col("w_")).otherwise(F.lit(0.0))
    spread = F.when(col(seats) > 0, col("m_") / col(seats)).otherwise(F.lit(0.0))
    rows = rows.withColumns({
        "least_": F.greatest(F.floor(fair * (1 - spread)) - 1, F.lit(0)).cast("long"),
        "most_": (F.ceil(fair * (1 + spread)) + 1).cast("long")})
    rows = rows.withColumn("given_", F.sum("least_").over(whole))
    quotients = rows.where((col(weight) > 0) & (col(seats) > 0)).select(
        *group, key, weight, seats, "given_",
        F.explode(F.sequence(col("least_"), col("most_") - 1)).alias("k_"))
    ranked = quotients.withColumn("rank_", F.row_number().over(whole.orderBy(
        F.desc(col(weight) / (2 * col("k_") + 1)), F.asc_nulls_last(key), "k_")))
    won = ranked.where(col("rank_") <= col(seats) - col("given_")).groupBy(*group, key).agg(
        F.count("*").alias("won_")).withColumnsRenamed({c: f"of_{c}" for c in [*group, key]})
    same = [col(c).eqNullSafe(col(f"of_{c}")) for c in [*group, key]]
    counted = F.coalesce(col("least_"), F.lit(0)) + F.coalesce(col("won_"), F.lit(0))
    return rows.join(won, same, "left").select(
        *parties.columns,
        F.when((col(weight) > 0) & (col(seats) > 0), counted).otherwise(F.lit(0)).cast("long").alias(out))


def taken(sizes: DataFrame, seed: int = SEED) -> DataFrame:
    """``sizes`` (key, source, size) with source_size, target, and the words taken.

    ``full`` whole passes are taken, and beyond them the words [from_1, to_1) and [0, to_2) of
    the document's own; ``taken`` is the sum.
    """
    col = F.col
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = targets(totals).withColumn("blocks_", F.round(
        SHARE * F.sum("source_size").over(Window.partitionBy()) / BLOCK_TOKENS).cast("long"))
    planned = sainte_lague(planned, [], "source", "target", "blocks_", "quota_").withColumn(
        "shards_", F.least(F.lit(MAX_SHARDS), 1 + F.floor(col("source_size") / SHARD_TOKENS)).cast("long"))
    planned = stored(planned, "sources")
    joined = sizes.join(
        planned.withColumnRenamed("source", "source_of_"), sizes["source"].eqNullSafe(col("source_of_")))
    placed = joined.withColumn("place_", F.xxhash64(F.lit(seed), "key", "size")).withColumn(
        "shard_", F.pmod(F.xxhash64(F.lit(seed + 1), "key", "size"), col("shards_")))
    shards = placed.groupBy("source", "quota_", "shard_").agg(F.sum("size").alias("shard_size_"))
    shards = sainte_lague(shards, ["source"], "shard_", "shard_size_", "quota_", "blocks_").select(
        col("source").alias("of_source_"), col("shard_").alias("of_shard_"), "shard_size_",
        col("blocks_").alias("shard_blocks_"))
    in_shard = Window.partitionBy("source", "shard_").orderBy("place_", "size", "key")
    laid = placed.withColumn("end_", F.sum("size").over(
        in_shard.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    laid = laid.join(shards, laid["source"].eqNullSafe(col("of_source_")) & (col("shard_") == col("of_shard_")))
    tokens = F.least(col("shard_blocks_") * BLOCK_TOKENS, MAX_PASSES * col("shard_size_"))
    laid = laid.withColumn("full", F.when(
        col("shard_size_") > 0, F.floor(tokens / col("shard_size_"))).otherwise(F.lit(0)).cast("long"))
    laid = laid.withColumns({
        "rest_": tokens - col("full") * col("shard_size_"),
        "start_": BLOCK_TOKENS * F.pmod(
            F.xxhash64(F.lit(seed + 2), "of_source_", "of_shard_"),
            F.greatest(F.ceil(col("shard_size_") / BLOCK_TOKENS), F.lit(1)))})
    begin = col("end_") - col("size")
    inside = lambda at: F.least(F.greatest(at - begin, F.lit(0)), col("size")).cast("long")
    stop = col("start_") + col("rest_")
    laid = laid.withColumns({
        "from_1": inside(col("start_")), "to_1": inside(F.least(stop, col("shard_size_"))),
        "to_2": inside(F.greatest(stop - col("shard_size_"), F.lit(0)))})
    return laid.withColumn(
        "taken", (col("full") * col("size") + col("to_1") - col("from_1") + col("to_2")).cast("long")
    ).select(*sizes.columns, "source_size", "target", "full", "from_1", "to_1", "to_2", "taken")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sizes = docs.select(
        "doc_id", F.col("doc_id").alias("key"), "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))
    return taken(stored(sizes, "sizes")).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken")


def _cut(text: Column, begin: Column, end: Column) -> Column:
    """Words [begin, end) of a text with the separators between them."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.regexp_replace(
        F.array_join(F.slice(pieces, begin.cast("int") + 1, (end - begin).cast("int")), ""), r"^[\x20\x09-\x0D]+", "")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row per pass that takes words of a document, with the words taken.

    Whole passes keep the text as it is. Documents of which nothing is taken go.
    """
    rows = packed(docs).withColumns({
        "key": F.xxhash64("row.doc_id", "row.text"), "source": F.col("row.source"),
        "size": F.size(words_of(F.col("row.text"))).cast("long"),
        "line_": F.monotonically_increasing_id()})
    rows = stored(rows, "to-mix")
    plan = taken(rows.select("key", "source", "size", "line_"))
    plan = plan.where(F.col("taken") > 0).select(
        F.col("line_").alias("of_"), "size", "full", "from_1", "to_1", "to_2")
    passes = F.concat(
        F.array_repeat(F.struct(F.lit(0).cast("long").alias("b"), F.col("size").alias("e")), F.col("full").cast("int")),
        F.array(F.struct(F.col("from_1").alias("b"), F.col("to_1").alias("e")),
                F.struct(F.lit(0).cast("long").alias("b"), F.col("to_2").alias("e"))))
    plan = plan.select("of_", "size", F.explode(passes).alias("p")).where("p.e > p.b").withColumnRenamed("size", "of_size")
    joined = rows.join(plan, rows["line_"] == plan["of_"])
    text = F.when((F.col("p.b") == 0) & (F.col("p.e") == F.col("of_size")), F.col("row.text")).otherwise(
        _cut(F.col("row.text"), F.col("p.b"), F.col("p.e")))
    return unpacked(joined.select(with_text("row", text, docs.columns).alias("row")))
