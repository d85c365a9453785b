import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.operators import dimensions, facts, marts, reports
from silverbrook.operators.dedup import descending, latest_per_key
from silverbrook.plans.staging import Step, Tables
from silverbrook.streaming import sinks

DAY = dt.date(2024, 1, 1)


def sales(spark, rows):
    """(order, customer, value, day offset, category id, geo id)"""
    data = [(o, c, float(v), DAY + dt.timedelta(d), cat, geo) for o, c, v, d, cat, geo in rows]
    return spark.createDataFrame(
        data, "order_id string, customer_id string, total_value double, purchase_date date, "
        "category_id bigint, geo_id bigint"
    ).withColumns({"price": F.col("total_value"), "freight_value": F.lit(0.0)})


def reviews(spark, rows):
    """(review, order, rating)"""
    frame = spark.createDataFrame(rows, "review_id string, order_id string, rating int")
    kind = F.when(F.col("rating") >= 4, "positive").when(F.col("rating") == 3, "neutral")
    return frame.withColumns({
        "sentiment": kind.otherwise("negative"), "review_date": F.lit(DAY),
        "text_length": F.lit(2)})


def test_calendar(spark):
    rows = dimensions.dim_date(spark)
    assert rows.count() == 4018
    got = rows.filter("date_id = 20210103").first()
    assert tuple(got) == (20210103, dt.date(2021, 1, 3), 2021, 1, 1, 53, 7, "Sunday", "January",
                          True)
    with pytest.raises(ValueError):
        dimensions.dim_date(spark, "2020-01-02", "2020-01-01")
    # One absurd date neither stops a run nor makes the calendar too long to broadcast.
    long = spark.sql("select date'0001-01-01' as first_day, date'9999-01-01' as last_day")
    days = dimensions.calendar(long)
    assert days.count() == (dt.date(2199, 12, 31) - dt.date(1900, 1, 1)).days + 1
    assert dimensions.calendar(spark.sql("select date'9000-01-01' as first_day, date'9999-01-01' as last_day")).isEmpty()


def test_failed_check_stays_failed(spark, tmp_path):
    """A table that fails its check is not returned by the next call either, and the audit says so."""
    bad = Step(lambda t: spark.range(3).withColumn("id", F.lit(7)), check=lambda rows: dimensions.check_unique(rows, "id"))
    tables = Tables(spark, str(tmp_path), {"bad": bad}, "run")
    for _ in range(2):
        with pytest.raises(ValueError, match="used by 3 rows"):
            tables("bad")
    assert [(r[1], r[2]) for r in tables.log.rows] == [("bad", "FAILED"), ("bad", "FAILED")]


def test_categories_and_ids(spark):
    left = spark.createDataFrame([("a",), (None,), ("",), ("a",)], "category string")
    right = spark.createDataFrame([("b",), ("a",)], "category string")
    rows = dimensions.dim_category(left, right)
    assert sorted(r.category_en for r in rows.collect()) == ["", "a", "b"]
    assert rows.filter("category_id < 0").isEmpty()
    dimensions.check_unique(rows, "category_id")
    with pytest.raises(ValueError):
        dimensions.check_unique(rows.withColumn("category_id", F.lit(1)), "category_id")
    assert dimensions.dim_geography(spark).count() == 27


def test_fact_keeps_unmatched_rows(spark):
    orders = spark.createDataFrame(
        [("1", "a", "SP", dt.datetime(2024, 1, 5, 23)), ("2", "zz", None, dt.datetime(1990, 1, 1)),
         ("3", None, "SP", None)],
        "order_id string, category string, state string, purchase_ts timestamp")
    for name in ("session_id", "customer_id", "product_id", "seller_id", "region"):
        orders = orders.withColumn(name, F.lit("x"))
    for name in ("price", "freight_value", "total_value"):
        orders = orders.withColumn(name, F.lit(1.0))
    category = dimensions.dim_category(orders.filter("order_id = '1'"), orders.limit(0))
    rows = facts.fact_sales(orders, dimensions.dim_date(spark), category,
                            dimensions.dim_geography(spark)).orderBy("order_id").collect()
    assert [(r.order_id, r.date_id, r.category_id is None, r.geo_id is None) for r in rows] == [
        ("1", 20240105, False, False), ("2", None, True, True)]


SALES = [("1", "a", 10, 0, 1, 1), ("2", "a", 20, 0, 1, 2), ("3", "b", 30, 0, 2, None)]
REVIEWS = [("r1", "1", 5), ("r2", "1", 1), ("r3", "2", 3), ("r4", "nobody", 5)]


@pytest.mark.parametrize("unique", [True, False])
def test_executive_fan_out(spark, unique):
    s, r = sales(spark, SALES), reviews(spark, REVIEWS)
    row = marts.executive(s, r, unique_keys=unique).first()
    assert row.asDict() == {
        "day": DAY, "total_orders": 3, "total_customers": 2, "total_revenue": 70.0,
        "avg_order_value": 17.5, "avg_rating": 3.0, "positive_reviews": 1, "negative_reviews": 1}
    flat = marts.executive(s, r, fan_out=False, unique_keys=unique).first()
    assert (flat.total_revenue, flat.avg_order_value, flat.avg_rating) == (60.0, 20.0, 3.0)


def test_executive_with_repeated_keys(spark):
    """Two orders carry the same review id, and one order id appears twice."""
    s = sales(spark, [*SALES, ("3", "c", 5, 0, 2, None)])
    r = reviews(spark, [*REVIEWS, ("r1", "2", 5)])
    s.createOrReplaceTempView("s")
    r.createOrReplaceTempView("r")
    want = spark.sql("""
        select s.purchase_date day, count(distinct s.order_id) total_orders,
          count(distinct customer_id) total_customers, sum(total_value) total_revenue,
          avg(total_value) avg_order_value, avg(rating) avg_rating,
          count(distinct case when sentiment = 'positive' then review_id end) positive_reviews,
          count(distinct case when sentiment = 'negative' then review_id end) negative_reviews
        from s left join r on s.order_id = r.order_id group by 1""").first()
    got = marts.executive(s, r).first()
    assert got.asDict() == pytest.approx({**want.asDict(), "day": DAY})


def test_review_mart_counts_every_matching_sale(spark):
    s = sales(spark, [("1", "a", 1, 0, 1, 1), ("1", "b", 1, 0, 1, 1)])
    category = spark.createDataFrame([("toys", 1)], "category_en string, category_id bigint")
    geo = spark.createDataFrame([("SP", "Sudeste", 1)], "state string, region string, "
                                "geo_id bigint")
    rows = marts.review_sentiment(reviews(spark, [("r1", "1", 5), ("r2", "x", 1)]), s, category,
                                  geo).collect()
    got = sorted((r.sentiment, r.category, r.region, r.review_count, r.avg_rating) for r in rows)
    assert got == [("negative", None, None, 1, 1.0), ("positive", "toys", "Sudeste", 2, 5.0)]


def test_trends(spark):
    values = [10.0] * 40
    values[0], values[39] = 0.0, 1000.0
    rows = [(str(i), "c", v, i * 2, 1, 1) for i, v in enumerate(values)]
    got = marts.trends(sales(spark, rows)).orderBy("purchase_date").collect()
    assert got[0].anomaly_flag == 0 and got[0].revenue_growth_pct is None
    # Seven rows back is two weeks back here; a previous value of 0 gives null.
    assert got[7].revenue_growth_pct is None and got[7].orders_growth_pct == 0.0
    assert got[39].revenue_growth_pct == pytest.approx(9900.0)
    assert got[39].revenue_acceleration == pytest.approx(99.0)
    assert (got[38].anomaly_flag, got[39].anomaly_flag) == (0, 1)


def test_hot_key_is_cut_in_every_task(spark):
    """Half of all rows share one key; each task passes on one row of it."""
    rows = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        "id")
    latest = latest_per_key(rows, "k", descending(["id"]))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert latest.filter("k = 'hot'").first()["id"] == 19_998
    assert latest.count() == 10_001


def test_reports(spark):
    funnel = spark.createDataFrame(
        [(DAY, "session_start", "mobile", 10, 4, 3), (DAY, "search", "tv", 5, 2, 2),
         (DAY, "cart_view", None, 7, 1, 1), (DAY, "search", "mobile", 1, 1, 1)],
        "event_date date, event_type string, device string, event_count bigint, "
        "sessions bigint, users bigint")
    steps = reports.funnel_totals(funnel).orderBy("journey_order").collect()
    assert [tuple(r) for r in steps] == [("session_start", 10, 0, 100.0), ("search", 6, 1, 60.0)]
    assert {tuple(r) for r in reports.events_by_device(funnel).collect()} == {("mobile", 11),
                                                                             ("tv", 5)}
    top = reports.top_events_over_time(funnel, k=2).collect()
    assert {(r.event_type, r.event_count) for r in top} == {("session_start", 10),
                                                            ("cart_view", 7)}
    assert tuple(reports.sessions_users_by_day(funnel).first()) == (DAY, 8, 7)
    daily = spark.createDataFrame(
        [(DAY, 2, 2, 10.0, 5.0, 4.0, 1, 0), (DAY, 1, 1, None, None, None, None, 2)],
        "day date, total_orders bigint, total_customers bigint, total_revenue double, "
        "avg_order_value double, avg_rating double, positive_reviews bigint, "
        "negative_reviews bigint")
    assert reports.kpi_totals(daily).first().asDict() == {
        "total_revenue": 10.0, "total_orders": 3, "avg_order_value": 2.5, "avg_rating": 2.0,
        "total_customers": 3}
    kinds = reports.unpivot_review_counts(daily).groupBy("kind").agg(F.sum("review_count")).collect()
    assert {tuple(r) for r in kinds} == {("positive_reviews", 1), ("negative_reviews", 2)}


def test_a_step_is_built_by_small_tasks(spark, tmp_path, monkeypatch):
    """Steps sort wide rows, so their tasks are smaller than those of the caller's session."""
    name, seen, write = "spark.sql.adaptive.advisoryPartitionSizeInBytes", [], sinks.overwrite
    before = spark.conf.get(name)
    monkeypatch.setattr(sinks, "overwrite", lambda rows, path: seen.append(rows.sparkSession.conf.get(name)) or write(rows, path))
    assert Tables(spark, str(tmp_path), {"x": Step(lambda t: spark.range(10))}, "run")("x").count() == 10
    assert seen == [settings.SMALL_TASKS[name]] != [before] and spark.conf.get(name) == before
    # Large tables written by day aim at tasks of the same order.
    assert settings.WRITE_TASK_BYTES <= 64 * 1024 * 1024
