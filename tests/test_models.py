import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.operators import audit, churn, demand, features, sessions

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    """Three categories: 90 days, 90 days with constant calendar columns, 15 days."""
    days = spark.range(120).select(F.date_add(F.lit(START), F.col("id").cast("int")).alias("d"),
                                   "id")
    rows = None
    for cat, n in ((1, 90), (2, 90), (3, 15)):
        part = days.filter(F.col("id") < n).select(
            F.lit(cat).cast("bigint").alias("category_id"),
            F.lit(f"c{cat}").alias("category_en"),
            F.col("d").alias("purchase_date"),
            (F.pmod(F.hash("id", F.lit(cat)), F.lit(17)) + F.col("id") % 7).cast("bigint").alias(
                "orders_count"),
            F.when(F.lit(cat) == 2, 1).otherwise(F.weekday("d") + 1).alias("day_of_week"),
            ((F.weekday("d") >= 5) & (F.lit(cat) != 2)).alias("is_weekend"),
            F.month("d").alias("month"),
            F.quarter("d").alias("quarter"))
        rows = part if rows is None else rows.unionByName(part)
    from pyspark.sql import Window
    w = Window.partitionBy("category_id").orderBy("purchase_date")
    lags = {f"lag_{n}": F.coalesce(F.lag("orders_count", n).over(w), F.lit(0)) for n in (1, 7, 14)}
    return rows.withColumns({**lags, "rolling_7d_mean": F.avg("orders_count").over(
        w.rowsBetween(-6, 0))}).cache()


def test_ridge_equals_mllib(spark, series):
    models = {r.category_id: r for r in demand.train(series).collect()}
    assert sorted(models) == [1, 2]
    for cat in (1, 2):
        rows = series.filter(F.col("category_id") == cat)
        cut = START + dt.timedelta(int(90 * 0.8) - 1)
        train = rows.filter(F.col("purchase_date") <= F.lit(cut))
        test = rows.filter(F.col("purchase_date") > F.lit(cut))
        fitted = Pipeline(stages=[
            VectorAssembler(inputCols=settings.DEMAND_FEATURES, outputCol="features"),
            LinearRegression(labelCol="orders_count", maxIter=100, regParam=0.1),
        ]).fit(train)
        line = fitted.stages[-1]
        assert models[cat].weights == pytest.approx(
            [line.intercept, *line.coefficients.toArray()], abs=1e-6)
        predicted = fitted.transform(test)
        for name, value in (("rmse", models[cat].rmse), ("mae", models[cat].mae)):
            check = RegressionEvaluator(labelCol="orders_count", metricName=name)
            assert value == pytest.approx(check.evaluate(predicted), abs=1e-6)
        assert models[cat].n_test == 18


def test_constant_label(spark, series):
    flat = series.withColumn("orders_count", F.lit(4).cast("bigint"))
    row = demand.train(flat).filter("category_id = 1").first()
    assert row.weights == pytest.approx([4.0] + [0.0] * 8)
    assert row.rmse == pytest.approx(0.0)


def test_forecast(spark, series):
    models = demand.train(series).cache()
    rows = demand.forecast(models, dt.date(2024, 3, 1)).collect()
    assert len(rows) == 14
    dates = sorted(r.forecast_date for r in rows if r.category_id == 1)
    assert dates == [dt.date(2024, 3, 2) + dt.timedelta(i) for i in range(7)]
    assert min(r.predicted_orders for r in rows) >= 0.0
    logged = demand.run_rows(models).filter("run_name = 'demand_c1'").collect()
    assert {r.name for r in logged} == {"category", "algorithm", "reg_param", "rmse", "mae"}


def test_cut_date(spark):
    rows = spark.range(25).select(F.lit(1).cast("bigint").alias("category_id"),
                                  F.date_add(F.lit(START), F.col("id").cast("int")).alias(
                                      "purchase_date"))
    got = features.chronological_cut(rows).select("n_rows", "split_date").distinct().collect()
    assert [tuple(r) for r in got] == [(25, START + dt.timedelta(19))]


def test_churn_features(spark):
    sales = spark.createDataFrame(
        [("1", "a", 1.5, START), ("2", "a", 2.0, START + dt.timedelta(10)),
         ("3", "b", 1.0, START + dt.timedelta(41))],
        "order_id string, customer_id string, total_value double, purchase_date date")
    reviews = spark.createDataFrame([("a", 5), ("a", 2), ("z", 1)], "customer_id string, "
                                    "rating int")
    for unique in (True, False):
        rows = features.churn_features(sales, reviews, unique).orderBy("customer_id").collect()
        assert [tuple(r) for r in rows] == [("a", 31, 2, 3.5, 3.5, 1), ("b", 0, 1, 1.0, 3.0, 0)]


def test_churn_model(spark, tmp_path):
    data = spark.range(600).select(
        F.col("id").cast("string").alias("customer_id"),
        F.pmod(F.hash("id"), F.lit(90)).alias("recency"),
        (F.col("id") % 9).alias("frequency"),
        (F.col("id") * 1.5).alias("monetary"),
        F.lit(3.0).alias("avg_rating"),
    ).withColumn("churned", F.when((F.col("recency") > 30) != (F.col("frequency") == 0), 1)
                 .otherwise(0)).cache()
    model = churn.train(data, str(tmp_path / "model"), trees=5)
    held_out = model.pipeline.transform(data.filter(~churn.is_training()))
    for name, metric in (("f1", "f1"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall")):
        check = MulticlassClassificationEvaluator(labelCol="churned", metricName=metric)
        assert model.metrics[name] == pytest.approx(check.evaluate(held_out))
    assert 0.5 < model.metrics["auc"] <= 1.0
    assert sum(model.importances.values()) == pytest.approx(1.0)
    share = data.filter(churn.is_training()).count() / 600
    assert 0.7 < share < 0.9
    scores = churn.score(data, model)
    assert dict(scores.dtypes)["churn_probability"] == "double"
    assert scores.count() == 600
    wrong = scores.filter("(churn_probability > 0.7) != (risk_label = 'high')")
    assert wrong.isEmpty()
    names = {name for _, name, _ in churn.run_rows(model)}
    assert {"num_trees", "f1", "auc", "importance_recency"} <= names


def test_recursive_forecast(spark):
    """Day by day in plain Python gives the same."""
    weights = [0.5, 0.3, 0.2, 0.1, 0.4, -0.2, 1.5, 0.05, 0.1]
    start = dt.date(2024, 1, 1)
    counts = [(i * 7) % 5 + 1 for i in range(20)]
    rows = [(1, start + dt.timedelta(i), c) for i, c in enumerate(counts)] + [(2, start, 3)]
    history = spark.createDataFrame(rows, "category_id long, purchase_date date, orders_count long")
    models = spark.createDataFrame([(1, "a", weights), (2, "b", weights)],
                                   "category_id long, category_en string, weights array<double>")
    got = demand.recursive_forecast(models, history, dt.date(2024, 1, 20), days=10).orderBy("forecast_date").collect()
    assert {r.category_en for r in got} == {"a"}  # too few rows for the lags of the other
    seen = [float(c) for c in counts]
    for r in got:
        day = r.forecast_date
        values = [seen[-1], seen[-7], seen[-14], sum(seen[-7:]) / 7, day.isoweekday(), day.isoweekday() > 5,
                  day.month, (day.month + 2) // 3]
        want = max(0.0, weights[0] + sum(w * v for w, v in zip(weights[1:], values)))
        assert r.predicted_orders == pytest.approx(want)
        seen.append(want)
    assert [r.forecast_date for r in got] == [dt.date(2024, 1, 21) + dt.timedelta(i) for i in range(10)]


def test_sessions(spark):
    ts = "2024-01-01T00:00:0{}"
    rows = [("1", "s", "session_start", ts.format(1), "{}"),
            ("2", "s", "product_view", ts.format(2), "{}"),
            ("3", "s", "session_end", ts.format(3), '{"reason": "no_cart"}'),
            ("4", "t", "session_start", ts.format(1), "{}"),
            ("5", "u", "session_end", ts.format(1), '{"reason": "bounce"}'),
            ("6", None, "product_view", ts.format(1), "{}")]
    raw = spark.createDataFrame(rows, "event_id string, session_id string, event_type string, "
                                "timestamp string, properties string")
    got = sessions.session_outcomes(raw)
    assert {tuple(r) for r in got.collect()} == {
        ("s", 3, "product_view", "no_cart", 3), ("t", 0, "session_start", None, 1),
        ("u", None, None, "bounce", 1)}
    rates = {r.step: (r.sessions, r.rate) for r in sessions.step_conversion(got).collect()}
    assert rates["session_start"] == (2, 1.0) and rates["search"] == (1, 0.5)
    assert rates["add_to_cart"] == (0, None)


def test_run_log(spark):
    log = audit.RunLog("r")
    assert log.step("a", lambda: 5) == 5
    with pytest.raises(ZeroDivisionError):
        log.step("b", lambda: 1 // 0)
    frame = log.frame(spark)
    assert [(r.step, r.status, r.records) for r in frame.orderBy("step").collect()] == [
        ("a", "SUCCESS", 5), ("b", "FAILED", None)]
    total = audit.run_totals(frame).first()
    assert (total.status, total.steps, total.records) == ("FAILED", 2, 5)
