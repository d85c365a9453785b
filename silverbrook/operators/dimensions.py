"""Dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.functions import values as V
from silverbrook.sources import tables


def dim_date(
    spark: SparkSession,
    start: str = settings.DIM_DATE_START,
    end: str = settings.DIM_DATE_END,
) -> DataFrame:
    """One row per day of a fixed range."""
    if dt.date.fromisoformat(end) < dt.date.fromisoformat(start):
        raise ValueError(f"a calendar can't end on {end} before it starts on {start}")
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return calendar(bounds)


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row frame.

    Days outside the accepted dates are left out: they hold 300 years at most, which keeps the
    result small enough to broadcast, whatever the bounds come from.
    """
    first = F.greatest("first_day", F.lit(settings.EARLIEST_DATE).cast("date"))
    last = F.least("last_day", F.lit(settings.LATEST_DATE).cast("date"))
    days = bounds.select(
        F.explode(F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))).alias("date_actual")
    )
    day = F.col("date_actual")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def dim_category(orders: DataFrame, clicks: DataFrame) -> DataFrame:
    """Every category named by orders or clicks; ``''`` counts, null does not."""
    names = orders.select("category").unionByName(clicks.select("category"))
    return (
        names.filter(F.col("category").isNotNull())
        .distinct()
        .select(F.col("category").alias("category_en"))
        .withColumn("category_id", V.surrogate_id("category_en"))
    )


def dim_geography(spark: SparkSession) -> DataFrame:
    return tables.state_rows(spark).withColumn("geo_id", V.surrogate_id("state"))


def check_unique(dimension: DataFrame, key: str) -> DataFrame:
    """Fail when two rows of a dimension share an id."""
    clash = dimension.groupBy(key).count().filter("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"{key} {clash[0][0]} is used by {clash[0][1]} rows")
    return dimension
