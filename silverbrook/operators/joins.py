"""Lookups and fact joins.

Only sides with a proven bound carry a broadcast hint: the state table (27 rows) and a
calendar (at most one row per day of a checked range). Every other side is left to Spark,
which broadcasts below ``spark.sql.autoBroadcastJoinThreshold`` by measured size and
otherwise shuffles, with skewed partitions split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.sources import tables


def with_region(orders: DataFrame) -> DataFrame:
    """Region of the state, or the default for orders without one."""
    regions = tables.state_rows(orders.sparkSession).select("state", "region")
    joined = orders.join(F.broadcast(regions), "state", "left")
    return joined.withColumn(
        "region", F.coalesce("region", F.lit(settings.UNKNOWN_REGION))
    )


def with_date_id(facts: DataFrame, dim_date: DataFrame, date_column: str) -> DataFrame:
    """Calendar id of a date; null outside the calendar."""
    calendar = dim_date.select("date_id", F.col("date_actual").alias(date_column))
    return facts.join(F.broadcast(calendar), date_column, "left")


def with_category_id(facts: DataFrame, dim_category: DataFrame) -> DataFrame:
    ids = dim_category.select("category_id", F.col("category_en").alias("category"))
    return facts.join(ids, "category", "left")


def with_geo_id(facts: DataFrame, dim_geography: DataFrame) -> DataFrame:
    ids = dim_geography.select("geo_id", "state")
    return facts.join(F.broadcast(ids), "state", "left")


def with_category(facts: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Category name of a category id."""
    names = dim_category.select("category_id", F.col("category_en").alias("category"))
    return facts.join(names, "category_id", "left")


def with_geography(facts: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """State and region of a geography id."""
    names = dim_geography.select("geo_id", "state", "region")
    return facts.join(F.broadcast(names), "geo_id", "left")


def with_calendar(facts: DataFrame, dim_date: DataFrame, columns: list[str]) -> DataFrame:
    """Calendar columns of a date id."""
    return facts.join(F.broadcast(dim_date.select("date_id", *columns)), "date_id", "left")
