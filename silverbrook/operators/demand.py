"""Demand models: one ridge regression per category, all fitted in one job.

Spark reduces the training rows of every category to means and covariances (partial sums in
each task, so no group is gathered) and solves the 8 x 8 systems in column expressions, a row per
category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverbrook import schemas, settings
from silverbrook.functions import values as V
from silverbrook.operators import features as features_

FEATURES = settings.DEMAND_FEATURES
LABEL = "orders_count"


def _at(matrix: Column, i: Column, j: Column | int) -> Column:
    return F.get(F.get(matrix, i), F.lit(j) if isinstance(j, int) else j)


def ridge_solution(moments: DataFrame, keep: list[str], reg: float = settings.DEMAND_REG) -> DataFrame:
    """``weights`` (intercept first) of each row's ridge system, by elimination in column expressions.

    A row holds population moments: matrix ``cov`` of the features, ``cxy`` with the label, ``cy`` the
    variance of the label, means ``mx`` and ``my``. Features and label are scaled to unit deviation, the
    penalty is divided by the deviation of the label, and a constant feature gets the coefficient 0.
    The system is positive definite, so that it needs no search for pivots. Higher-order functions keep
    it one short expression; a column per number would keep the optimizer busy for minutes.
    """
    p, col, zero = len(FEATURES), F.col, F.lit(0.0)
    places = F.sequence(F.lit(0), F.lit(p - 1))
    deviation = lambda variance: F.sqrt(F.greatest(variance, zero))
    rows = moments.withColumns({"s": F.transform(places, lambda i: deviation(_at(col("cov"), i, i))), "sy": deviation(col("cy"))})
    rows = rows.withColumns({
        "fixed": F.transform("s", lambda v: (v == 0) | (col("sy") == 0)),
        "ky": F.when(col("sy") == 0, 1.0).otherwise(col("sy"))})
    rows = rows.withColumn("k", F.zip_with("s", "fixed", lambda v, f: F.when(f, 1.0).otherwise(v)))
    fixed, scale = lambda i: F.get("fixed", i), lambda i: F.get("k", i)

    def entry(i: Column, j: Column) -> Column:
        scaled = F.when(fixed(i) | fixed(j), zero).otherwise(_at(col("cov"), i, j) / (scale(i) * scale(j)))
        own = F.lit(reg) / col("ky") + F.when(fixed(i), 1.0).otherwise(zero)
        return scaled + F.when(i == j, own).otherwise(zero)

    def line(i: Column) -> Column:
        target = F.when(fixed(i), zero).otherwise(F.get("cxy", i) / (scale(i) * col("ky")))
        return F.concat(F.transform(places, lambda j: entry(i, j)), F.array(target))

    def eliminate(system: Column, k: Column) -> Column:
        pivot = F.get(system, k)
        return F.transform(F.array(F.transform(pivot, lambda v: v / F.get(pivot, k))), lambda unit: F.transform(
            system, lambda row, i: F.when(i == k, unit).otherwise(
                F.zip_with(row, unit, lambda x, u: x - F.get(row, k) * u))))[0]

    rows = rows.withColumn("solved", F.aggregate(places, F.transform(places, line), eliminate))
    rows = rows.withColumn("x", F.transform("solved", lambda row, i: F.get(row, F.lit(p)) * col("ky") / scale(i)))
    shift = F.aggregate(F.zip_with("x", "mx", lambda x, m: x * m), zero, lambda total, v: total + v)
    return rows.select(*keep, F.concat(F.array(col("my") - shift), col("x")).alias("weights"))


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def split_rows(features: DataFrame) -> DataFrame:
    """Rows of categories with enough history, with ``is_train`` by date."""
    ready = features_.chronological_cut(features.filter("category_id is not null"))
    return ready.filter(F.col("n_rows") >= settings.DEMAND_MIN_ROWS).withColumn(
        "is_train", F.col("purchase_date") <= F.col("split_date")
    )


def fit(split: DataFrame) -> DataFrame:
    """``weights`` (intercept first) per category; categories without a tail are left out."""

    def train(value: Column) -> Column:
        return F.when(F.col("is_train"), value)

    x = [train(_number(name)) for name in FEATURES]
    y = train(_number(LABEL))
    # Variances come from the same formula as covariances, so a constant column is exactly 0.
    cov = F.array(*[F.array(*[F.covar_pop(x[min(i, j)], x[max(i, j)]) for j in range(len(x))]) for i in range(len(x))])
    grouped = split.groupBy("category_id", "category_en").agg(
        cov.alias("cov"), F.array(*[F.covar_pop(v, y) for v in x]).alias("cxy"), F.covar_pop(y, y).alias("cy"),
        F.array(*[F.avg(v) for v in x]).alias("mx"), F.avg(y).alias("my"),
        F.count(F.when(~F.col("is_train"), 1)).alias("n_test"))
    return ridge_solution(grouped.filter("n_test > 0"), ["category_id", "category_en"])


def predict() -> Column:
    """Intercept plus the weighted features of a row with ``weights``."""
    total = F.col("weights")[0]
    for at, name in enumerate(FEATURES, start=1):
        total = total + F.col("weights")[at] * _number(name)
    return total


def evaluate(split: DataFrame, models: DataFrame) -> DataFrame:
    """RMSE and MAE on the last rows of each category, with the model.

    Errors are averaged per category before anything else is joined.
    """
    tail = split.filter(~F.col("is_train")).join(
        models.select("category_id", "weights"), "category_id"
    )
    error = _number(LABEL) - predict()
    return tail.groupBy("category_id", "category_en").agg(
        F.first("weights").alias("weights"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count("*").alias("n_test"),
    )


def train(features: DataFrame) -> DataFrame:
    """Model and metrics per category."""
    split = split_rows(features)
    return evaluate(split, fit(split))


def demand_metrics(models: DataFrame) -> DataFrame:
    return models.select("category_id", "category_en", "rmse", "mae", "n_test")


def future_rows(models: DataFrame, as_of=None, days: int = settings.FORECAST_DAYS) -> DataFrame:
    """The next days per category with calendar features; every lag is 0."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    dates = F.sequence(F.date_add(today, 1), F.date_add(today, days))
    rows = models.withColumn("forecast_date", F.explode(dates))
    day = F.col("forecast_date")
    zeros = {name: F.lit(0.0) for name in FEATURES[:4]}
    return rows.withColumns(
        {
            **zeros,
            "day_of_week": F.weekday(day) + 1,
            "is_weekend": F.weekday(day) >= 5,
            "month": F.month(day),
            "quarter": F.quarter(day),
        }
    )


def forecast(models: DataFrame, as_of=None) -> DataFrame:
    """Orders predicted for the next days, never below 0."""
    rows = future_rows(models, as_of)
    return rows.select(
        "category_id",
        "category_en",
        "forecast_date",
        F.greatest(predict(), F.lit(0.0)).alias("predicted_orders"),
        F.round("rmse", 4).alias("model_rmse"),
        F.round("mae", 4).alias("model_mae"),
        F.current_timestamp().alias("scored_at"),
    ).select(schemas.GOLD["ml_demand_forecast"].fieldNames())


def _add_day(state: Column, day: Column) -> Column:
    """One step of the recursion: predict a day from the rows so far and put it behind them."""
    seen, weights = state["seen"], state["weights"]
    lag = lambda n: F.element_at(seen, -n)
    week = F.aggregate(F.slice(seen, -7, 7), F.lit(0.0), lambda a, x: a + x) / 7
    values = [lag(1), lag(7), lag(14), week, F.weekday(day) + 1, F.weekday(day) >= 5, F.month(day), F.quarter(day)]
    total = weights[0]
    for at, value in enumerate(values, start=1):
        total = total + weights[at] * value.cast("double")
    return F.struct(
        F.concat(F.slice(seen, -13, 13), F.array(F.greatest(total, F.lit(0.0)))).alias("seen"),
        weights.alias("weights"),
        F.concat(state["made"], F.array(F.greatest(total, F.lit(0.0)))).alias("made"),
    )


def recursive_forecast(
    models: DataFrame, features: DataFrame, as_of=None, days: int = settings.FORECAST_DAYS
) -> DataFrame:
    """Orders predicted day after day: earlier predictions are the lags of later ones.

    Starts from the last fourteen rows of each category. The mean is that of the seven rows
    before the day, so models should be trained on ``leak_free`` features. The features drop each
    category's first fourteen rows; categories with fewer rows than that after them are left out.
    """
    last = Window.partitionBy("category_id").orderBy(F.desc("purchase_date"))
    recent = features.withColumn("_back", F.row_number().over(last)).filter("_back <= 14")
    rows = F.sort_array(F.collect_list(F.struct("purchase_date", "orders_count")))
    history = recent.groupBy("category_id").agg(
        F.transform(rows, lambda r: r["orders_count"].cast("double")).alias("seen")
    ).filter(F.size("seen") == 14)
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    dates = F.sequence(F.date_add(today, 1), F.date_add(today, days))
    start = F.struct("seen", "weights", F.array().cast("array<double>").alias("made"))
    made = F.aggregate("dates", start, _add_day, lambda state: state["made"])
    # The dates go through a generator, as a subquery for the day can't stand in the recursion.
    rows = V.once(models.join(history, "category_id"), "dates", dates)
    return rows.select("category_id", "category_en", F.inline(F.arrays_zip(
        F.col("dates").alias("forecast_date"), made.alias("predicted_orders"))))


def run_rows(models: DataFrame) -> DataFrame:
    """Parameters and metrics per category as (run_name, kind, name, value)."""
    entries = {
        ("param", "category"): F.col("category_en"),
        ("param", "algorithm"): F.lit("LinearRegression"),
        ("param", "reg_param"): F.lit(str(settings.DEMAND_REG)),
        ("metric", "rmse"): F.col("rmse").cast("string"),
        ("metric", "mae"): F.col("mae").cast("string"),
    }
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), value.alias("value"))
        for (kind, name), value in entries.items()
    ]
    return models.select(
        F.concat(F.lit("demand_"), "category_en").alias("run_name"),
        F.inline(F.array(*rows)),
    )
