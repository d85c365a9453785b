"""Keyed tables fed by micro-batches.

A micro-batch only appends: its best row per key goes to a folder of its own, and nothing of the
table is read. Its cost depends on the batch alone, and running it again replaces its own rows.

A compaction now and then folds the batches into the base, a table that Spark buckets by key. Readers
join the base with the best rows of the batches since: the batches are dealt to the base's buckets, and
the base itself is neither shuffled nor ranked. A compaction writes only buckets that new rows fall
into, each as a new version beside the old one; readers follow the log, so one that fails half-way
changes nothing. Replaced versions and folded batches stay for one more compaction, for readers that
have begun, and are then deleted.

``mode="latest"`` keeps the newest row over everything that has arrived, whatever batches it arrived
in: the largest by the given columns (null is least), and among equal ones by content.
``mode="first"`` keeps the row of the earliest batch that held the key (the newest within that
batch), as a merge that only inserts does. Rows without a key are not kept.

A table and the checkpoint of its stream belong together, as batch ids come from the checkpoint;
a stream with another checkpoint is refused.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook import settings
from silverbrook.operators.dedup import latest_per_key
from silverbrook.streaming import folders

SEEN_IN = "seen_in"


def _log(path: str, name: str) -> str:
    return f"{path.rstrip('/')}__{name}"


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A Parquet folder, or None where there is none."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _newest_first(order: list[Column]) -> list[Column]:
    return [column.desc_nulls_last() for column in order]


def write_batch(batch: DataFrame, batch_id: int, path: str, key: str, order: list[Column]) -> int:
    """Append the best row per key of one batch; returns the rows written."""
    observed = Observation()
    best = latest_per_key(batch.where(F.col(key).isNotNull()), key, _newest_first(order))
    best = best.withColumn(SEEN_IN, F.lit(batch_id).cast("bigint"))
    best.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "compression", "zstd").parquet(f"{path}/delta/part={batch_id}")
    return observed.get.get("rows", 0)


# -- the base ----------------------------------------------------------------------------


@dataclass
class Versions:
    """What the log of compactions says: the last batch in the base, and the versions of each bucket."""

    upto: int = -1
    before: int = -1
    buckets: int = 0
    of: dict[int, list[int]] = field(default_factory=dict)


LOG = "upto bigint, buckets int, touched array<int>"


def versions(spark: SparkSession, path: str) -> Versions:
    """One row per compaction is read."""
    log = _read(spark, _log(path, "compactions"), LOG)
    out = Versions()
    for upto, buckets, touched in sorted(log.collect() if log is not None else []):
        out.before, out.upto, out.buckets = out.upto, upto, buckets
        for bucket in touched:
            out.of.setdefault(bucket, []).append(upto)
    return out


def _bucket(key: str, buckets: int) -> Column:
    """The number of the bucket that Spark writes a key to."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def _base_table(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> str:
    """The base as a bucketed table of the catalog, entered there on first use."""
    name = f"keyed_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:16]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    folders.listing_session(spark).sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {SEEN_IN} bigint, bucket int, upto bigint) USING parquet "
        f"PARTITIONED BY (bucket, upto) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
        f"LOCATION '{path.rstrip('/')}/base'")
    return name


def base(
    spark: SparkSession, path: str, schema: T.StructType, key: str, known: Versions,
    only: list[int] | None = None,
) -> DataFrame | None:
    """The current version of every bucket, or of some; None before the first compaction."""
    wanted = {b: v[-1] for b, v in known.of.items() if only is None or b in only}
    if not wanted:
        return None
    name = _base_table(spark, path, schema, key, known.buckets)
    spark.catalog.refreshTable(name)
    of = F.create_map(*[F.lit(x).cast(kind) for b, v in wanted.items() for x, kind in ((b, "int"), (v, "bigint"))])
    return spark.table(name).where(F.try_element_at(of, F.col("bucket")) == F.col("upto")).drop("bucket", "upto")


def batches(spark: SparkSession, path: str, known: Versions) -> list[int]:
    """Batches written since the last compaction; only folder names are read."""
    found = folders.subfolders(spark, f"{path.rstrip('/')}/delta")
    return sorted(n for n in (int(name[5:]) for name in found if name.startswith("part=")) if n > known.upto)


def deltas(spark: SparkSession, path: str, schema: T.StructType, known: Versions) -> DataFrame | None:
    """Rows of the batches since the last compaction, with the batch as ``part``."""
    full = T.StructType([
        *schema.fields, T.StructField(SEEN_IN, T.LongType()), T.StructField("part", T.LongType())])
    rows = _read(spark, f"{path.rstrip('/')}/delta", full)
    return None if rows is None else rows.where(F.col("part") > known.upto)


def last_batch(spark: SparkSession, path: str) -> int:
    """The last batch that has been written, or -1; only folder names are read."""
    known = versions(spark, path)
    return max([known.upto, *batches(spark, path, known)])


# -- reading -----------------------------------------------------------------------------


def resolve(rows: DataFrame, key: str, order: list[Column], mode: str) -> DataFrame:
    """One row per key."""
    if mode == "latest":
        return latest_per_key(rows, key, _newest_first(order))
    if mode != "first":
        raise ValueError(f"mode is latest or first, not {mode}")
    earliest = Window.partitionBy(key).orderBy(SEEN_IN)
    return rows.withColumn("_rank", F.row_number().over(earliest)).where("_rank = 1").drop("_rank")


def merged(old: DataFrame, new: DataFrame, key: str, order: list[Column], mode: str) -> DataFrame:
    """Two tables of one row per key as one, by a join on the key.

    ``old`` holds earlier batches than ``new``, so its rows stay where the mode is ``first``.
    """
    columns = old.columns
    rank = F.struct(*[c.alias(f"by_{i}") for i, c in enumerate(order)], F.xxhash64(*columns).alias("tie"))
    sides = [rows.select(*[F.col(c).alias(f"{side}_{c}") for c in columns], rank.alias(f"{side}_rank"))
             for side, rows in (("old", old), ("new", new.select(columns)))]
    both = sides[0].join(sides[1], F.col(f"old_{key}") == F.col(f"new_{key}"), "full_outer")
    better = F.col(f"old_{key}").isNull()
    if mode == "latest":
        better = better | F.coalesce(F.col("new_rank") > F.col("old_rank"), F.lit(False))
    return both.select(*[F.when(better, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in columns])


def current(
    spark: SparkSession, path: str, schema: T.StructType, key: str, order: list[Column],
    mode: str = "latest",
) -> DataFrame:
    """The table as it stands, with the batch that brought each row; empty if nothing was written."""
    known = versions(spark, path)
    since = batches(spark, path, known)
    new = deltas(spark, path, schema, known)
    old = base(spark, path, schema, key, known)
    if new is None and old is None:
        return spark.createDataFrame([], schema).withColumn(SEEN_IN, F.lit(None).cast("bigint"))
    if new is None:
        return old
    if len(since) == 1:  # one batch is a table of one row per key already; what comes meanwhile is left out
        best = new.where(F.col("part") == since[0]).drop("part")
    else:
        best = resolve(new.drop("part"), key, order, mode)
    return best if old is None else merged(old, best, key, order, mode)


def compact(
    spark: SparkSession, path: str, schema: T.StructType, key: str, order: list[Column],
    mode: str = "latest", after: int = settings.COMPACT_AFTER, buckets: int = settings.KEYED_BUCKETS,
) -> bool:
    """Fold the batches into the base once ``after`` of them have come since the last time.

    Rows keep the batch that brought them. Readers switch when the entry in the log is written, so
    a compaction that fails half-way changes nothing, and a batch run again later is no longer read.
    ``buckets`` holds for a table's first compaction and stays.
    """
    spark = folders.session_like(spark, settings.WRITING)
    known = versions(spark, path)
    new = deltas(spark, path, schema, known)
    if new is None:
        return False
    newest, count = new.agg(F.max("part"), F.count_distinct("part")).first()
    if newest is None or count < after:
        return False
    _sweep(spark, path, known)
    new = new.where(F.col("part") <= newest)  # not what comes meanwhile
    known.buckets = known.buckets or buckets
    touched = [r[0] for r in new.select(_bucket(key, known.buckets)).distinct().collect()]  # at most all buckets
    name = _base_table(spark, path, schema, key, known.buckets)
    # A few buckets at a time, which bounds the shuffle files that lie beside the base.
    for at in range(0, len(touched), settings.COMPACT_BUCKETS):
        some = touched[at : at + settings.COMPACT_BUCKETS]
        old = base(spark, path, schema, key, known, some)
        # Dealt as the buckets are, so that a bucket is one file; a key has a row per batch, and one batch
        # alone is a table of one row per key already.
        rows = new.where(_bucket(key, known.buckets).isin(some)).drop("part").repartition(known.buckets, key)
        rows = rows if count == 1 else resolve(rows, key, order, mode)
        if old is not None:
            rows = merged(old, rows, key, order, mode).repartition(known.buckets, key)
        rows.select(
            *schema.fieldNames(), SEEN_IN, _bucket(key, known.buckets).alias("bucket"),
            F.lit(newest).cast("bigint").alias("upto")).write.insertInto(name)
    entry = spark.createDataFrame([(newest, known.buckets, touched)], LOG)
    entry.coalesce(1).write.mode("append").parquet(_log(path, "compactions"))
    return True


def _sweep(spark: SparkSession, path: str, known: Versions) -> None:
    """Delete what no reader needs: versions before the last two, those that no log entry names, and
    batches that were in the base already at the compaction before the last."""
    root = path.rstrip("/")
    kept = {f"bucket={b}/upto={v}" for b, found in known.of.items() for v in found[-2:]}
    for found in folders.subfolders(spark, f"{root}/base", depth=2):
        if found not in kept:
            folders.delete(spark, f"{root}/base/{found}")
    for found in folders.subfolders(spark, f"{root}/delta"):
        if found.startswith("part=") and int(found[5:]) <= known.before:
            folders.delete(spark, f"{root}/delta/{found}")


def check_owner(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse to write to a table that a stream with another checkpoint has filled."""
    own = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    owner = _read(spark, _log(path, "owner"), "id string")
    known = owner.first() if owner is not None else None
    if known is None:
        spark.createDataFrame([(own,)], "id string").write.mode("overwrite").parquet(_log(path, "owner"))
    elif known[0] != own:
        raise ValueError(f"{path} belongs to a stream with another checkpoint than {checkpoint}")


def writer(
    rows: DataFrame, path: str, checkpoint: str, key: str, order: list[Column], counts: dict[int, int],
    mode: str = "latest",
):
    """Stream into a keyed table; ``counts`` receives the rows written per batch.

    Batches are folded into the base while the stream runs, once enough of them have come.
    """
    schema, spark, adaptive = rows.schema, rows.sparkSession, "spark.sql.adaptive.enabled"
    # A stream's own session plans without AQE, and only plans of AQE have their shuffle files removed.
    planned = settings.WRITING | {adaptive: spark.conf.get(adaptive)}

    def write(batch: DataFrame, batch_id: int) -> None:
        if not counts:
            check_owner(batch.sparkSession, path, checkpoint)
        counts[batch_id] = write_batch(folders.moved(batch, planned), batch_id, path, key, order)
        if (batch_id + 1) % settings.COMPACT_AFTER == 0:
            compact(spark, path, schema, key, order, mode)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
