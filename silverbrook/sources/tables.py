"""Stored tables, lookup rows, reference CSV files."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamReader

from silverbrook import schemas, settings
from silverbrook.streaming import folders


def is_missing(error: AnalysisException) -> bool:
    """True when a read failed because there is no such folder."""
    return error.getCondition() in ("PATH_NOT_FOUND", "DATA_SOURCE_PATH_NOT_FOUND")


def bounded(reader: DataStreamReader, files: int | None = None) -> DataStreamReader:
    """Bound a micro-batch by bytes, or by a number of files."""
    if files:
        return reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", settings.TRIGGER_BYTES)


def read_bronze(
    spark: SparkSession, name: str, path: str, stream: bool = True, files: int | None = None
) -> DataFrame:
    """A bronze table, as a stream of bounded batches or as a whole."""
    schema = schemas.BRONZE[name]
    reader = bounded(spark.readStream, files) if stream else spark.read
    rows = reader.schema(schema).option("basePath", path).parquet(path)
    return rows.select(schema.fieldNames())


def table(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None
) -> DataFrame:
    """A stored table with its known schema, cut to the columns asked for."""
    return spark.read.schema(schema).parquet(path).select(columns or schema.fieldNames())


def state_rows(spark: SparkSession) -> DataFrame:
    """The 27 states with name and region."""
    rows = [(code, *info) for code, info in settings.STATES.items()]
    return spark.createDataFrame(rows, "state string, state_name string, region string")


def read_reference_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV in UTF-8; a byte order mark before the first header is removed.

    Quoted line breaks keep a file in one task, so a file above ``REFERENCE_CSV_BYTES`` is refused:
    it has to come in parts.
    """
    if folders.size(spark, path) > settings.REFERENCE_CSV_BYTES:
        raise ValueError(f"a file of {path} is too large for one task; split it")
    rows = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return rows.toDF(*(name.lstrip("﻿") for name in rows.columns))


def preview(view: DataFrame, rows: int = 100) -> DataFrame:
    """The first rows of a table or view; errors reach the caller."""
    return view.limit(rows)


def first_day(facts: DataFrame, column: str, days: int) -> Column:
    """``days`` before the last day of the facts, as a scalar subquery.

    The subtraction is inside the subquery, so a comparison with it reaches the Parquet scan.
    """
    return facts.agg(F.date_sub(F.max(column), days).alias("d")).scalar()


def last_value(spark: SparkSession, path: str, schema: T.StructType, column: str) -> dt.date | None:
    """The largest date or number of a column of stored files, read from their footers alone."""
    metadata = folders.session_like(spark, {
        "spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"})
    return largest(metadata.read.schema(schema).parquet(path), column).first()[0]


def largest(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.max(column))


def last_days(
    rows: DataFrame,
    column: str,
    days: int,
    as_of: dt.date | None = None,
    since: Column | None = None,
) -> DataFrame:
    """Rows dated at most ``days`` days before ``as_of`` (default today), or from ``since``.

    Applied to a mart, the filter moves below the aggregation to the facts when the column
    is a grouping key.
    """
    if since is None:
        since = F.date_sub(F.current_date() if as_of is None else F.lit(as_of), days)
    return rows.filter(F.col(column) >= since)
