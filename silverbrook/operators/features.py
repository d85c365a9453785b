"""Model features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.functions import values as V
from silverbrook.operators import joins, marts


def rfm(sales: DataFrame, unique_keys: bool = False) -> DataFrame:
    """Recency against the last day of the whole data set, frequency and value per customer.

    The last day is a scalar subquery: one value, no join.
    """
    last_day = sales.agg(F.max("purchase_date").alias("d")).scalar()
    customers = sales.groupBy("customer_id").agg(
        F.max("purchase_date").alias("last_purchase"),
        marts.order_count(unique_keys).alias("frequency"),
        V.money_sum("total_value").alias("monetary"),
    )
    return customers.select(
        "customer_id",
        F.datediff(last_day, F.col("last_purchase")).alias("recency"),
        "frequency",
        "monetary",
    )


def customer_rating(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("customer_id").agg(
        V.ratio(F.sum("rating"), F.count("rating")).alias("avg_rating")
    )


def churn_features(
    sales: DataFrame, reviews: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """One row per customer with the label: no purchase in the last 30 days."""
    joined = rfm(sales, unique_keys).join(customer_rating(reviews), "customer_id", "left")
    return joined.select(
        "customer_id",
        "recency",
        "frequency",
        "monetary",
        F.coalesce("avg_rating", F.lit(settings.DEFAULT_RATING)).alias("avg_rating"),
        F.when(F.col("recency") > settings.CHURN_DAYS, 1).otherwise(0).alias("churned"),
    )


def daily_category_features(
    sales: DataFrame, dim_category: DataFrame, dim_date: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """Orders and revenue per category and day with calendar columns.

    Sales are summed before the dimensions are joined: both lookups then run on one row per
    category and day. Every id has one label, so the groups stay the same.
    """
    days = sales.groupBy("category_id", "purchase_date", "date_id").agg(
        marts.order_count(unique_keys).alias("orders_count"),
        V.money_sum("total_value").alias("total_revenue"),
    )
    labelled = joins.with_category(days, dim_category).withColumnRenamed("category", "category_en")
    calendar = ["day_of_week", "is_weekend", "month", "quarter"]
    return joins.with_calendar(labelled, dim_date, calendar).select(
        "category_id", "category_en", "purchase_date", "orders_count", "total_revenue", *calendar
    )


def time_series_features(
    sales: DataFrame,
    dim_category: DataFrame,
    dim_date: DataFrame,
    leak_free: bool = False,
    unique_keys: bool = False,
) -> DataFrame:
    """Lags by row and the mean of seven rows, per category; rows without lag 14 are dropped.

    The mean includes the row to be predicted; ``leak_free`` shifts it one row back. A
    category has at most one row per day, which bounds what a window has to hold.
    """
    series = Window.partitionBy("category_id").orderBy("purchase_date")
    week = series.rowsBetween(-7, -1) if leak_free else series.rowsBetween(-6, 0)
    rows = daily_category_features(sales, dim_category, dim_date, unique_keys)
    lags = {f"lag_{n}": F.lag("orders_count", n).over(series) for n in (1, 7, 14)}
    mean = V.ratio(F.sum("orders_count").over(week), F.count("orders_count").over(week))
    return rows.withColumns({**lags, "rolling_7d_mean": mean}).filter("lag_14 is not null")


def chronological_cut(
    features: DataFrame, share: float = settings.DEMAND_TRAIN_SHARE
) -> DataFrame:
    """Add ``n_rows`` and ``split_date``, the date of row floor(share * n), per category."""
    whole = Window.partitionBy("category_id")
    numbered = features.withColumns(
        {
            "n_rows": F.count("*").over(whole),
            "_row": F.row_number().over(whole.orderBy("purchase_date")),
        }
    )
    early = F.col("_row") <= F.floor(F.col("n_rows") * F.lit(share))
    last = F.max(F.when(early, F.col("purchase_date"))).over(whole)
    return numbered.withColumn("split_date", last).drop("_row")
