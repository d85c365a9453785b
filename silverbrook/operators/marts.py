"""Business marts over the star schema.

``unique_keys=True`` states what the silver upsert guarantees: one row per ``order_id`` in
the sales facts and per ``review_id`` in the review facts. Distinct counts of those keys
are then plain counts, which saves the row expansion of a multi-distinct aggregate and
lets reviews be reduced to one row per order before they are shuffled to the sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverbrook.functions import values as V
from silverbrook.operators import joins


def order_count(unique_keys: bool) -> Column:
    """Distinct orders of a group."""
    return (F.count if unique_keys else F.count_distinct)("order_id")


# -- executive ---------------------------------------------------------------------------


def _reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Additive review measures per order: an order with many reviews becomes one row."""
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("n_reviews"),
        F.count("rating").alias("n_ratings"),
        F.sum("rating").alias("rating_sum"),
        F.count(F.when(F.col("sentiment") == "positive", F.col("review_id"))).alias("n_positive"),
        F.count(F.when(F.col("sentiment") == "negative", F.col("review_id"))).alias("n_negative"),
    )


def _distinct_reviews(sales: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct positive and negative review ids per day, for facts whose keys repeat.

    Runs as one grouping per (day, sentiment, review), so no day is held by one task.
    """
    found = (
        sales.select("purchase_date", "order_id")
        .join(
            reviews.filter(F.col("sentiment").isin("positive", "negative")).select(
                "order_id", "review_id", "sentiment"
            ),
            "order_id",
        )
        .groupBy("purchase_date", "sentiment")
        .agg(F.count_distinct("review_id").alias("n"))
    )
    return found.groupBy(F.col("purchase_date").alias("day")).agg(
        F.sum(F.when(F.col("sentiment") == "positive", F.col("n"))).alias("positive_reviews"),
        F.sum(F.when(F.col("sentiment") == "negative", F.col("n"))).alias("negative_reviews"),
    )


def reviews_of(reviews: DataFrame, sales: DataFrame) -> DataFrame:
    """Reviews of the given sales only.

    Pays when the sales are a small part, such as a window of days: their ids are then few enough
    to be broadcast, and other reviews are dropped in the scan's stage, before any shuffle.
    """
    return reviews.join(sales.select("order_id"), "order_id", "left_semi")


def executive(
    sales: DataFrame, reviews: DataFrame, fan_out: bool = True, unique_keys: bool = False
) -> DataFrame:
    """Daily KPIs.

    With ``fan_out`` an order with k reviews counts k times in revenue and averages, as a
    plain join of sales and reviews gives; without it every order counts once.
    """
    joined = sales.select("purchase_date", "order_id", "customer_id", "total_value").join(
        _reviews_per_order(reviews), "order_id", "left"
    )
    copies = F.greatest(F.coalesce("n_reviews", F.lit(1)), F.lit(1)) if fan_out else F.lit(1)
    value = V.exact("total_value")
    weighted = value * copies.cast("decimal(18,0)")
    measures = [
        order_count(unique_keys).alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum(weighted).cast("double").alias("total_revenue"),
        V.ratio(
            F.sum(weighted).cast("double"), F.sum(F.when(value.isNotNull(), copies))
        ).alias("avg_order_value"),
        V.ratio(F.sum("rating_sum"), F.sum("n_ratings")).alias("avg_rating"),
    ]
    if unique_keys:
        for kind in ("positive", "negative"):
            total = F.coalesce(F.sum(f"n_{kind}"), F.lit(0))
            measures.append(total.alias(f"{kind}_reviews"))
    days = joined.groupBy(F.col("purchase_date").alias("day")).agg(*measures)
    if unique_keys:
        return days
    counts = _distinct_reviews(sales, reviews)
    return days.join(counts, "day", "left").fillna(0, ["positive_reviews", "negative_reviews"])


# -- sales, funnel, reviews --------------------------------------------------------------


def sales_performance(
    sales: DataFrame, dim_category: DataFrame, dim_geography: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """Sales per day, category, state and region; facts without a label keep null."""
    labelled = joins.with_geography(joins.with_category(sales, dim_category), dim_geography)
    return labelled.groupBy("purchase_date", "category", "state", "region").agg(
        order_count(unique_keys).alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        V.money_sum("total_value").alias("revenue"),
        V.money_avg("total_value").alias("avg_order_value"),
        V.money_sum("price").alias("product_revenue"),
        V.money_sum("freight_value").alias("freight_revenue"),
    )


def funnel(clicks: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Events, sessions and users per hour, type, device and category.

    Two distinct counts in one aggregation would copy every click three times before the shuffle.
    Each is a grouping of its own here, summed per task first, and the small results are joined.
    """
    keys = ["hour", "event_date", "event_type", "device", "category"]
    labelled = joins.with_category(clicks, dim_category).withColumn("hour", F.date_trunc("hour", "event_ts"))
    sessions = labelled.groupBy(*keys, "session_id").agg(F.count("*").alias("n")).groupBy(*keys).agg(
        F.sum("n").alias("event_count"), F.count("session_id").alias("sessions"))
    users = labelled.groupBy(*keys, "user_id").agg(F.lit(1).alias("one")).groupBy(*keys).agg(
        F.count("user_id").alias("users")).withColumnsRenamed({k: f"of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    return sessions.join(users, same).select(*keys, "event_count", "sessions", "users")


def review_sentiment(
    reviews: DataFrame, sales: DataFrame, dim_category: DataFrame, dim_geography: DataFrame
) -> DataFrame:
    """Reviews per day, sentiment, category and region of the order reviewed.

    All measures are sums, so reviews are reduced to one row per order, day and sentiment
    before the join on the order.
    """
    reduced = reviews.groupBy("order_id", "review_date", "sentiment").agg(
        F.count("review_id").alias("n"),
        F.count("rating").alias("n_rating"),
        F.sum("rating").alias("rating_sum"),
        F.count("text_length").alias("n_length"),
        F.sum("text_length").alias("length_sum"),
    )
    # Few reviewed orders are broadcast to the sales, which then need no shuffle; many are dealt
    # by the key that the join after needs anyway.
    reviewed = sales.select("order_id", "category_id", "geo_id").join(
        reduced.select("order_id"), "order_id", "left_semi"
    )
    joined = reduced.join(reviewed, "order_id", "left")
    labelled = joins.with_geography(joins.with_category(joined, dim_category), dim_geography)
    return labelled.groupBy("review_date", "sentiment", "category", "region").agg(
        F.sum("n").alias("review_count"),
        V.ratio(F.sum("rating_sum"), F.sum("n_rating")).alias("avg_rating"),
        V.ratio(F.sum("length_sum"), F.sum("n_length")).alias("avg_text_length"),
    )


# -- trends ------------------------------------------------------------------------------


def daily_sales(sales: DataFrame, unique_keys: bool = False) -> DataFrame:
    return sales.groupBy("purchase_date").agg(
        order_count(unique_keys).alias("orders"), V.money_sum("total_value").alias("revenue")
    )


def daily_category_sales(
    sales: DataFrame, dim_category: DataFrame, unique_keys: bool = False
) -> DataFrame:
    return (
        joins.with_category(sales, dim_category)
        .groupBy("purchase_date", "category")
        .agg(order_count(unique_keys).alias("orders"), V.money_sum("total_value").alias("revenue"))
    )


def with_lags(rows: DataFrame, window, columns: list[str], steps: list[int]) -> DataFrame:
    """Earlier values by row, not by calendar day."""
    return rows.withColumns(
        {f"{c}_{s}_ago": F.lag(c, s).over(window) for c in columns for s in steps}
    )


def trends(sales: DataFrame, unique_keys: bool = False) -> DataFrame:
    """Growth against 7 rows ago, its change, and days that leave the 30-row band.

    The unpartitioned window sees one row per day, however large the facts are.
    """
    days = Window.orderBy("purchase_date")
    month = days.rowsBetween(-29, 0)
    rows = with_lags(daily_sales(sales, unique_keys), days, ["orders", "revenue"], [7, 14])
    rows = rows.withColumns(
        {
            "mean_30": V.ratio(
                F.sum(V.exact("revenue")).over(month), F.count("revenue").over(month)
            ),
            "stddev_30": F.stddev_pop("revenue").over(month),
        }
    )
    week = (F.col("revenue") - F.col("revenue_7_ago")) / F.col("revenue_7_ago")
    week_before = (F.col("revenue_7_ago") - F.col("revenue_14_ago")) / F.col("revenue_14_ago")
    both = (F.col("revenue_7_ago") > 0) & (F.col("revenue_14_ago") > 0)
    far = F.abs(F.col("revenue") - F.col("mean_30")) > 2 * F.col("stddev_30")
    return rows.select(
        "purchase_date",
        "orders",
        "revenue",
        V.growth_pct("orders", "orders_7_ago").alias("orders_growth_pct"),
        V.growth_pct("revenue", "revenue_7_ago").alias("revenue_growth_pct"),
        F.when(both, week - week_before).alias("revenue_acceleration"),
        F.when((F.col("stddev_30") > 0) & far, 1).otherwise(0).alias("anomaly_flag"),
    )


def category_trends(
    sales: DataFrame, dim_category: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """Growth against 7 rows ago within each category; at most one row per day and category."""
    days = Window.partitionBy("category").orderBy("purchase_date")
    rows = with_lags(
        daily_category_sales(sales, dim_category, unique_keys), days, ["orders", "revenue"], [7]
    )
    return rows.select(
        "purchase_date",
        "category",
        "orders",
        "revenue",
        V.growth_pct("orders", "orders_7_ago").alias("orders_growth_pct"),
        V.growth_pct("revenue", "revenue_7_ago").alias("revenue_growth_pct"),
    )


# -- views -------------------------------------------------------------------------------


def views(gold, unique_keys: bool = True) -> dict[str, DataFrame]:
    """The six marts by view name; ``gold(name)`` gives a gold table."""
    sales, reviews, clicks = gold("fact_sales"), gold("fact_reviews"), gold("fact_clickstream")
    category, geography = gold("dim_category"), gold("dim_geography")
    return {
        "vw_executive": executive(sales, reviews, unique_keys=unique_keys),
        "vw_sales_performance": sales_performance(sales, category, geography, unique_keys),
        "vw_funnel": funnel(clicks, category),
        "vw_reviews": review_sentiment(reviews, sales, category, geography),
        "vw_trends": trends(sales, unique_keys),
        "vw_category_trends": category_trends(sales, category, unique_keys),
    }


def register_views(spark: SparkSession, gold, unique_keys: bool = True) -> list[str]:
    """Create or replace the six views in the session."""
    made = views(gold, unique_keys)
    for name, rows in made.items():
        rows.createOrReplaceTempView(name)
    return list(made)
