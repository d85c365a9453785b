"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row per key in the given order; rows equal in it are ordered by content.

    Spark limits the group inside every map task before the shuffle (one row per key and
    task is left), so a key that holds a large part of the rows does not overload a task.
    """
    tie = F.xxhash64(*rows.columns).desc()
    window = Window.partitionBy(key).orderBy(*order, tie)
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


ORDER_LATEST = ["cdc_ts_ms"]
REVIEW_LATEST = ["ingested_at"]


def descending(names: list[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]
