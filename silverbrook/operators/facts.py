"""Silver to gold: fact tables with surrogate ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook import schemas
from silverbrook.functions import values as V
from silverbrook.operators import joins


def dated(rows: DataFrame, timestamp: str, date: str) -> DataFrame:
    """Add the day of a timestamp; rows without one are dropped."""
    return rows.withColumn(date, F.to_date(timestamp)).filter(F.col(date).isNotNull())


def fact_sales(
    orders: DataFrame, dim_date: DataFrame, dim_category: DataFrame, dim_geography: DataFrame
) -> DataFrame:
    facts = dated(orders, "purchase_ts", "purchase_date").drop("region")
    facts = joins.with_date_id(facts, dim_date, "purchase_date")
    facts = joins.with_category_id(facts, dim_category)
    facts = joins.with_geo_id(facts, dim_geography)
    return facts.select(schemas.GOLD["fact_sales"].fieldNames())


def fact_clickstream(
    clicks: DataFrame, dim_date: DataFrame, dim_category: DataFrame
) -> DataFrame:
    facts = dated(clicks, "event_ts", "event_date")
    facts = joins.with_date_id(facts, dim_date, "event_date")
    facts = joins.with_category_id(facts, dim_category)
    return facts.select(schemas.GOLD["fact_clickstream"].fieldNames())


def fact_reviews(reviews: DataFrame, dim_date: DataFrame) -> DataFrame:
    facts = dated(reviews, "ingested_at", "review_date")
    facts = facts.withColumn("sentiment", V.sentiment())
    facts = joins.with_date_id(facts, dim_date, "review_date")
    return facts.select(schemas.GOLD["fact_reviews"].fieldNames())
