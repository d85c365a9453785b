import datetime as dt

from pyspark.sql import functions as F

from silverbrook.operators import bitmaps


def test_numbers_are_unique_and_near_dense(spark):
    rows = spark.range(50_000).select(F.concat(F.lit("c"), F.col("id") % 20_000).alias("c")).union(
        spark.createDataFrame([(None,)], "c string"))
    got = bitmaps.numbers(rows, "c", slots=64)
    assert got.agg(F.count("*"), F.count_distinct("number"), F.count_distinct("c")).first() == (20_000,) * 3
    assert got.agg(F.max("number")).first()[0] < 20_000 * 1.3
    assert got.exceptAll(bitmaps.numbers(rows.repartition(7), "c", slots=64)).isEmpty()


def test_sets_are_united_exactly(spark):
    rows = spark.range(100_000).select(
        (F.col("id") % 7).alias("day"), F.pmod(F.hash("id"), F.lit(90_000)).cast("long").alias("n"))
    mart = bitmaps.sets(rows, ["day"], "n", "customers")
    assert mart.groupBy("day").count().agg(F.max("count")).first()[0] == 3  # blocks of 32,768
    for keys in (["day"], []):
        want = rows.groupBy(*keys).agg(F.count_distinct("n").alias("customers"))
        assert bitmaps.united(mart, keys, "customers").exceptAll(want.select(*keys, "customers")).isEmpty()


def test_totals_read_no_facts(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    sales = spark.createDataFrame(
        [("1", "a", 1.5, days[0]), ("2", "a", 2.0, days[2]), ("3", "b", 1.0, days[2]), ("4", None, 4.0, days[1])],
        "order_id string, customer_id string, total_value double, purchase_date date")
    reviews = spark.createDataFrame([("1", 5), ("2", 2), ("2", 4), ("9", 1)], "order_id string, rating int")
    totals = bitmaps.daily_totals(sales, reviews)
    customers = bitmaps.daily_customers(sales, bitmaps.numbers(sales, "customer_id"))
    assert bitmaps.kpi_totals(totals, customers, 90).first().asDict() == {
        "total_revenue": 8.5, "total_orders": 4, "avg_order_value": 2.125, "avg_rating": 11 / 3, "total_customers": 2}
    assert bitmaps.kpi_totals(totals, customers, 0).first().asDict() == {
        "total_revenue": 3.0, "total_orders": 2, "avg_order_value": 1.5, "avg_rating": 3.0, "total_customers": 2}
    none = sales.limit(0)
    empty = bitmaps.kpi_totals(bitmaps.daily_totals(none, reviews), bitmaps.daily_customers(
        none, bitmaps.numbers(none, "customer_id")), 90).first()
    assert empty.total_customers == 0 and empty.total_revenue is None


def test_visitors_without_a_type_or_a_user(spark):
    day = dt.date(2024, 1, 1)
    clicks = spark.createDataFrame(
        [("s", "u", "search", day), ("s", "v", "search", day), ("t", None, "search", day), ("t", None, None, day)],
        "session_id string, user_id string, event_type string, event_date date")
    marts = [bitmaps.daily_visitors(clicks, c, bitmaps.numbers(clicks, c)) for c in ("session_id", "user_id")]
    assert {tuple(r) for r in bitmaps.visitors_per_type(*marts, 7).collect()} == {("search", 2, 2), (None, 1, 0)}
    assert [tuple(r) for r in bitmaps.visitors_per_day(*marts, 7).collect()] == [(day, 2, 2)]


def test_a_set_is_built_by_one_task(spark):
    """No task hands on bitmaps of its own: only numbers are shuffled, and a set is never united."""
    rows = spark.range(1_000).select((F.col("id") % 7).alias("day"), (F.col("id") * 331).alias("n"))
    plan = bitmaps.sets(rows, ["day"], "n", "customers")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange"):]
    assert plan.count("Exchange") == 1 and "bitmap_construct_agg" not in below
