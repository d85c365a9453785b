"""Steps from clean tables to facts, dimensions and model tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.operators import bitmaps, churn, demand, dimensions, facts, features
from silverbrook.plans.staging import Step, Tables


def calendar_of(*columns: DataFrame) -> DataFrame:
    """A calendar over whole years that covers one-column frames of dates."""
    bounds = columns[0].toDF("d")
    for more in columns[1:]:
        bounds = bounds.unionByName(more.toDF("d"))
    years = bounds.agg(F.min("d").alias("a"), F.max("d").alias("b"))
    return dimensions.calendar(
        years.select(
            F.trunc("a", "year").alias("first_day"),
            F.make_date(F.year("b"), F.lit(12), F.lit(31)).alias("last_day"),
        )
    )


def gold_steps(
    dim_date: Callable[[Tables], DataFrame] | None = None,
    by_day: bool = True,
    as_of: Callable[[Tables], Column] | dt.date | None = None,
) -> dict[str, Step]:
    """Dimensions, facts, features and models on top of ``silver_*`` tables.

    ``by_day`` stores facts in one folder per day; otherwise they are clustered by day, which
    suits tables whose days are far smaller than a file. ``as_of`` is the day before the first
    forecast, today by default.
    """

    def stored(build, day: str) -> Step:
        return Step(build, partition=day) if by_day else Step(build, cluster=day)

    def default_calendar(t: Tables) -> DataFrame:
        return dimensions.dim_date(t.spark, settings.DIM_DATE_START, settings.DIM_DATE_END)

    def unique(key: str):
        return lambda rows: dimensions.check_unique(rows, key)

    trained: dict[str, churn.ChurnModel] = {}

    def churn_model(t: Tables) -> churn.ChurnModel:
        if "churn" not in trained:
            trained["churn"] = churn.train(t("ml_churn_features"), t.path("models/churn"))
        return trained["churn"]

    def model_runs(t: Tables) -> DataFrame:
        rows = [("churn_rf", *row) for row in churn.run_rows(churn_model(t))]
        columns = "run_name string, kind string, name string, value string"
        of_churn = t.spark.createDataFrame(rows, columns)
        both = of_churn.unionByName(demand.run_rows(t("ml_demand_models")))
        return both.withColumn("logged_at", F.current_timestamp())

    return {
        "dim_date": Step(dim_date or default_calendar, check=unique("date_id")),
        "dim_category": Step(
            lambda t: dimensions.dim_category(t("silver_orders"), t("silver_clickstream")),
            check=unique("category_id"),
        ),
        "dim_geography": Step(
            lambda t: dimensions.dim_geography(t.spark), check=unique("geo_id")
        ),
        "fact_sales": stored(
            lambda t: facts.fact_sales(
                t("silver_orders"), t("dim_date"), t("dim_category"), t("dim_geography")
            ),
            "purchase_date",
        ),
        "fact_clickstream": stored(
            lambda t: facts.fact_clickstream(
                t("silver_clickstream"), t("dim_date"), t("dim_category")
            ),
            "event_date",
        ),
        "fact_reviews": stored(
            lambda t: facts.fact_reviews(t("silver_reviews"), t("dim_date")),
            "review_date",
        ),
        "ml_churn_features": Step(
            lambda t: features.churn_features(
                t("fact_sales"), t("fact_reviews"), unique_keys=True
            )
        ),
        "ml_churn_scores": Step(
            lambda t: churn.score(t("ml_churn_features"), churn_model(t))
        ),
        "ml_demand_features": Step(
            lambda t: features.time_series_features(
                t("fact_sales"), t("dim_category"), t("dim_date"), unique_keys=True
            )
        ),
        "ml_demand_models": Step(lambda t: demand.train(t("ml_demand_features"))),
        "ml_demand_forecast": Step(
            lambda t: demand.forecast(t("ml_demand_models"), as_of(t) if callable(as_of) else as_of)
        ),
        "ml_model_runs": Step(model_runs),
    }


def exact_steps() -> dict[str, Step]:
    """Daily marts whose distinct counts can be added up, with the numbers they are sets of."""

    def visitors(column: str):
        return lambda t: bitmaps.daily_visitors(
            t("fact_clickstream"), column, t(f"{column.removesuffix('_id')}_numbers"))

    return {
        "customer_numbers": Step(lambda t: bitmaps.numbers(t("fact_sales"), "customer_id")),
        "session_numbers": Step(lambda t: bitmaps.numbers(t("fact_clickstream"), "session_id")),
        "user_numbers": Step(lambda t: bitmaps.numbers(t("fact_clickstream"), "user_id")),
        "mart_daily": Step(lambda t: bitmaps.daily_totals(t("fact_sales"), t("fact_reviews"))),
        "mart_daily_customers": Step(
            lambda t: bitmaps.daily_customers(t("fact_sales"), t("customer_numbers"))),
        "mart_daily_sessions": Step(visitors("session_id")),
        "mart_daily_users": Step(visitors("user_id")),
    }
