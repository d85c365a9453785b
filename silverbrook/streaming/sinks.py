"""Writing streams and tables."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from silverbrook import schemas, settings
from silverbrook.streaming import folders


class _Rows(StreamingQueryListener):
    """Adds up the observed row count of every batch of one query."""

    def __init__(self):
        self.by_batch: dict[int, int] = {}
        self.done = threading.Event()
        self.query_id = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        seen = progress.observedMetrics.get("written")
        if seen is not None and str(progress.id) == str(self.query_id):
            self.by_batch[progress.batchId] = seen["rows"]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.id) == str(self.query_id):
            self.done.set()


def counted(rows: DataFrame) -> DataFrame:
    """Count rows while they are written instead of reading the result again."""
    return rows.observe("written", F.count(F.lit(1)).alias("rows"))


def drain(spark: SparkSession, writer) -> int:
    """Process all available input in bounded batches, stop, and return the rows observed."""
    listener = _Rows()
    spark.streams.addListener(listener)
    try:
        query: StreamingQuery = writer.trigger(availableNow=True).start()
        listener.query_id = query.id
        query.awaitTermination()
        for progress in query.recentProgress:
            seen = progress.observedMetrics.get("written")
            if seen is not None:
                listener.by_batch[progress.batchId] = seen["rows"]
        # The listener hears of the end after the last progress; recent progress alone may be cut.
        if not listener.done.wait(settings.LISTENER_SECONDS):
            raise TimeoutError(f"progress of stream {query.id} has not arrived, its rows are not counted")
    finally:
        spark.streams.removeListener(listener)
    return sum(listener.by_batch.values())


def bronze_columns(rows: DataFrame, hourly: bool = True) -> tuple[DataFrame, list[str]]:
    """Partition columns from the landing time."""
    landed = F.to_timestamp("ingested_at")
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    if not hourly:
        parts.pop("hour")
    return rows.withColumns({n: F.date_format(landed, p) for n, p in parts.items()}), list(parts)


def bronze_writer(rows: DataFrame, path: str, checkpoint: str, hourly: bool = True):
    """Append to Parquet partitioned by landing time; the checkpoint makes it exactly once."""
    parted, columns = bronze_columns(rows, hourly)
    return (
        counted(parted)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*columns)
        .option("maxRecordsPerFile", settings.BRONZE_FILE_ROWS)
        .option("compression", "zstd")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def write_bronze(rows: DataFrame, path: str, checkpoint: str, hourly: bool = True):
    """Keep landing every 30 seconds until stopped; returns the running query."""
    writer = bronze_writer(rows, path, checkpoint, hourly)
    return writer.trigger(processingTime=settings.BRONZE_TRIGGER).start()


def append_writer(rows: DataFrame, path: str, checkpoint: str):
    return (
        counted(rows)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


# -- packed bronze ------------------------------------------------------------------------


PACKED_LOG = "run string, hours array<string>"


def packed_hours(spark: SparkSession, packed: str) -> dict[str, list[str]]:
    """The hours (or days) that finished runs have packed, by run; one row per run is read."""
    if not folders.subfolders(spark, packed):
        return {}
    return {r["run"]: r["hours"] for r in spark.read.schema(PACKED_LOG).parquet(f"{packed}/log").collect()}


def pack_bronze(spark: SparkSession, name: str, path: str, packed: str, before: str, hourly: bool = True) -> list[str]:
    """Copy hours before ``yyyy/MM/dd/HH`` that landed in many files into few; returns the hours packed.

    The landed files and the stream's own log of them stay as they are: a copy lies beside them, and
    readers take an hour from the copy once the run's entry is in the log. An hour counts as closed by
    the caller's word, as rows are landed under the time at which they arrive.
    """
    parts = ["year", "month", "day", "hour"][: 4 if hourly else 3]
    done = {h for hours in packed_hours(spark, packed).values() for h in hours}
    found = ("/".join(p.split("=")[1] for p in f.split("/")) for f in folders.subfolders(spark, path, len(parts))
             if all("=" in p for p in f.split("/")))
    hours = [h for h in found if h < before and h not in done]
    if not hours:
        return []
    run = uuid.uuid4().hex
    rows = spark.read.schema(bronze_schema(name, parts)).option("basePath", path).parquet(path)
    rows = for_large_files(rows.where(hour_of(parts).isin(hours)))
    rows.hint("rebalance", *map(F.col, parts)).write.partitionBy(*parts).parquet(f"{packed}/run={run}")
    entry = spark.createDataFrame([(run, hours)], PACKED_LOG)
    entry.coalesce(1).write.mode("append").parquet(f"{packed}/log")
    return hours


def bronze_schema(name: str, parts: list[str]) -> T.StructType:
    return T.StructType([*schemas.BRONZE[name].fields, *(T.StructField(p, T.StringType()) for p in parts)])


def hour_of(parts: list[str]) -> Column:
    """The hour (or day) of a bronze row, from its folders."""
    return F.concat_ws("/", *parts)


def read_packed(spark: SparkSession, name: str, path: str, packed: str, hourly: bool = True) -> DataFrame:
    """A bronze table as a whole: packed hours from their copy, the others as they landed."""
    parts, names = ["year", "month", "day", "hour"][: 4 if hourly else 3], schemas.BRONZE[name].fieldNames()
    schema, runs = bronze_schema(name, parts), packed_hours(spark, packed)
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    copied = [h for hours in runs.values() for h in hours]
    out = rows.where(~hour_of(parts).isin(copied)).select(names) if copied else rows.select(names)
    for run in runs:
        folder = f"{packed}/run={run}"
        out = out.unionByName(spark.read.schema(schema).option("basePath", folder).parquet(folder).select(names))
    return out


# -- batch tables ------------------------------------------------------------------------


def for_large_files(rows: DataFrame) -> DataFrame:
    """Rows whose rebalanced write aims at large files; small tables still use every core."""
    return folders.moved(rows, settings.WRITING | {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(settings.WRITE_TASK_BYTES)})


def overwrite(rows: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Replace a table, or add to it; returns the rows written, counted during the write."""
    observed = Observation()
    rows.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode(mode).option(
        "partitionOverwriteMode", "static"
    ).option("compression", "zstd").parquet(path)
    return observed.get.get("rows", 0)


def overwrite_sliced(rows: DataFrame, path: str, key: str, slices: int) -> int:
    """Replace a table by one slice of the keys after another.

    Rows that are dealt by the key are filtered before: shuffle files are then those of a slice. What the
    rows are read from is read once per slice, so hand in rows of a stored table.
    """
    return sum(
        overwrite(rows.where(F.pmod(F.xxhash64(key), F.lit(slices)) == n), path, "append" if n else "overwrite")
        for n in range(slices))


def overwrite_partitioned(
    rows: DataFrame, path: str, date_column: str, replace_all: bool = True
) -> int:
    """Replace a fact table stored by day.

    The rebalance hint gathers each day into few files and lets Spark split a day that is
    much larger than the others. ``replace_all=False`` replaces only the days present.
    """
    observed = Observation()
    balanced = for_large_files(rows).observe(observed, F.count(F.lit(1)).alias("rows")).hint(
        "rebalance", F.col(date_column)
    )
    mode = "static" if replace_all else "dynamic"
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.option("compression", "zstd").partitionBy(date_column).parquet(path)
    return observed.get["rows"]


def overwrite_clustered(rows: DataFrame, path: str, date_column: str) -> int:
    """Replace a table whose files are sorted by date.

    Row-group statistics then let a date filter skip data without one folder per day. As in
    :func:`overwrite_partitioned` Spark divides a day that is much larger than the others.
    """
    balanced = for_large_files(rows).hint("rebalance", F.col(date_column)).sortWithinPartitions(date_column)
    return overwrite(balanced, path)


def ensure_tables(
    spark: SparkSession,
    database: str,
    location: str | None = None,
    wanted: dict[str, T.StructType] = schemas.SILVER,
) -> list[str]:
    """Create the database and its tables unless they exist."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    made = []
    for name, schema in wanted.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
        made.append(f"{database}.{name}")
    return made
