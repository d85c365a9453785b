"""Dashboard aggregations over the marts.

Groups with a null key are left out, and missing numbers count as 0, as the dashboard does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.functions import values as V


def _total(column: str) -> Column:
    """Sum with missing numbers as 0; whole numbers stay whole."""
    return F.sum(F.coalesce(F.col(column), F.lit(0))).alias(column)


def _money(column: str) -> Column:
    return F.coalesce(V.money_sum(column), F.lit(0.0)).alias(column)


def _keyed(rows: DataFrame, *keys: str):
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    return rows.groupBy(*keys)


def top_k(rows: DataFrame, k: int, by: str, tie: str) -> DataFrame:
    """The k largest rows; each task keeps k rows, then they are merged."""
    return rows.orderBy(F.col(by).desc(), F.col(tie)).limit(k)


# -- executive tab -----------------------------------------------------------------------


def kpi_totals(executive: DataFrame) -> DataFrame:
    """Headline numbers from daily rows: sums, and plain means of the daily means.

    Days without reviews count as rating 0 and customers are summed over days.
    """
    return executive.agg(
        _money("total_revenue"),
        _total("total_orders"),
        F.avg(V.number_or_zero("avg_order_value")).alias("avg_order_value"),
        F.avg(V.number_or_zero("avg_rating")).alias("avg_rating"),
        _total("total_customers"),
    )


def kpi_totals_exact(sales: DataFrame, reviews: DataFrame) -> DataFrame:
    """Headline numbers from the facts: every order, customer and review counts once.

    Reviews are reduced to one row per order before they meet the sales.
    """
    ratings = reviews.groupBy("order_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("n_ratings")
    )
    joined = sales.select("order_id", "customer_id", "total_value").join(
        ratings, "order_id", "left"
    )
    return joined.agg(
        V.money_sum("total_value").alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        V.money_avg("total_value").alias("avg_order_value"),
        V.ratio(F.sum("rating_sum"), F.sum("n_ratings")).alias("avg_rating"),
        F.count_distinct("customer_id").alias("total_customers"),
    )


def unpivot_review_counts(executive: DataFrame) -> DataFrame:
    """One row per day and kind of review."""
    kinds = ["positive_reviews", "negative_reviews"]
    return (
        executive.select("day", *kinds)
        .fillna(0, kinds)
        .unpivot("day", kinds, "kind", "review_count")
    )


# -- sales tab ---------------------------------------------------------------------------


def top_categories_by_revenue(performance: DataFrame, k: int = 10) -> DataFrame:
    return top_k(_keyed(performance, "category").agg(_money("revenue")), k, "revenue", "category")


def revenue_by_region(performance: DataFrame) -> DataFrame:
    return _keyed(performance, "region").agg(_money("revenue"))


def revenue_trend(performance: DataFrame) -> DataFrame:
    return _keyed(performance, "purchase_date").agg(_money("revenue"), _total("orders"))


def top_states_by_revenue(performance: DataFrame, k: int = 10) -> DataFrame:
    return top_k(_keyed(performance, "state").agg(_money("revenue")), k, "revenue", "state")


# -- funnel tab --------------------------------------------------------------------------


def journey_position(column: str, journey: list[str]) -> Column:
    """Position of an event type in the journey, null when it is not part of it."""
    position = F.array_position(F.lit(journey), F.col(column))
    return F.when(position > 0, (position - 1).cast("int"))


def funnel_totals(funnel: DataFrame, journey: list[str] | None = None) -> DataFrame:
    """Events per journey step and their share of the first step, in percent."""
    position = journey_position("event_type", journey or settings.JOURNEY)
    steps = (
        _keyed(funnel, "event_type")
        .agg(_total("event_count"))
        .withColumn("journey_order", position)
        .filter(F.col("journey_order").isNotNull())
    )
    # At most one row per journey step reaches the unpartitioned window.
    first = F.first("event_count").over(
        Window.orderBy("journey_order").rowsBetween(Window.unboundedPreceding, 0)
    )
    return steps.withColumn("percent_initial", V.ratio(F.col("event_count") * 100, first))


def events_by_device(funnel: DataFrame) -> DataFrame:
    return _keyed(funnel, "device").agg(_total("event_count"))


def top_events_over_time(funnel: DataFrame, k: int = 5) -> DataFrame:
    """Daily events of the k most frequent types.

    The daily counts are the input of both the ranking and the result, so types are ranked
    over them instead of joining two aggregations of the funnel. Spark drops types beyond
    rank k in every task before the ranks of all types are compared.
    """
    daily = _keyed(funnel, "event_date", "event_type").agg(_total("event_count"))
    total = F.sum("event_count").over(Window.partitionBy("event_type"))
    rank = F.dense_rank().over(Window.orderBy(F.col("_total").desc(), F.col("event_type")))
    ranked = daily.withColumn("_total", total).withColumn("_rank", rank)
    return ranked.filter(F.col("_rank") <= k).drop("_total", "_rank")


def sessions_users_by_day(funnel: DataFrame) -> DataFrame:
    return _keyed(funnel, "event_date").agg(_total("sessions"), _total("users"))


# -- reviews tab -------------------------------------------------------------------------


def sentiment_distribution(reviews: DataFrame) -> DataFrame:
    return _keyed(reviews, "sentiment").agg(_total("review_count"))


def weighted_daily_rating(reviews: DataFrame) -> DataFrame:
    """Daily mean rating weighted by the number of reviews; 0 without reviews."""
    weight = F.coalesce(F.col("review_count"), F.lit(0))
    mean = V.ratio(F.sum(V.number_or_zero("avg_rating") * weight), F.sum(weight))
    return _keyed(reviews, "review_date").agg(
        F.coalesce(mean, F.lit(0.0)).alias("avg_rating"), F.sum(weight).alias("review_count")
    )


def top_reviewed_categories(reviews: DataFrame, k: int = 10) -> DataFrame:
    groups = _keyed(reviews, "category").agg(
        _total("review_count"), F.avg(V.number_or_zero("avg_rating")).alias("avg_rating")
    )
    return top_k(groups, k, "review_count", "category")


def sentiment_by_region(reviews: DataFrame) -> DataFrame:
    return _keyed(reviews, "region", "sentiment").agg(_total("review_count"))


# -- model tab ---------------------------------------------------------------------------


def churn_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_label").agg(
        F.count("*").alias("total_customers"),
        F.avg("churn_probability").alias("avg_churn_prob"),
        F.avg("recency").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("monetary").alias("avg_monetary"),
        F.max("model_f1").alias("model_f1"),
        F.max("model_auc").alias("model_auc"),
    )


def risk_counts(summary: DataFrame) -> DataFrame:
    def customers(label: str) -> Column:
        found = F.when(F.col("risk_label") == label, F.col("total_customers"))
        return F.coalesce(F.sum(found), F.lit(0)).alias(f"{label}_risk")

    return summary.agg(customers("high"), customers("low"))


def forecast_view(forecast: DataFrame) -> DataFrame:
    return forecast.select(
        F.col("category_en").alias("category"),
        "forecast_date",
        "predicted_orders",
        "model_rmse",
        "model_mae",
        "scored_at",
    ).orderBy("category", "forecast_date")
