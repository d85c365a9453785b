import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from silverbrook import schemas
from silverbrook.operators import audit, marts
from silverbrook.plans import pipeline, published
from silverbrook.plans import testbed as tb
from silverbrook.streaming import sinks


def put_bronze(spark, sf, lake, recent="2001-01-01"):
    raw = {"clickstream": tb.raw_clicks, "orders": tb.raw_orders, "reviews": tb.raw_reviews}
    late = F.col("purchase_timestamp") >= F.unix_micros(F.lit(recent).cast("timestamp"))
    for name, make in raw.items():
        rows = make(spark, sf)
        # A part of the orders keeps the number of days small.
        rows = rows.filter(late) if name == "orders" else rows
        rows.select(schemas.BRONZE[name].fieldNames()).write.parquet(f"{lake}/bronze/{name}")


@pytest.fixture
def database(spark):
    name = f"gold_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_whole_run(spark, sf, tmp_path, database):
    lake = str(tmp_path)
    put_bronze(spark, sf, lake)
    gold = pipeline.run(
        spark, lake, dim_date=lambda t: pipeline_calendar(t), models=True,
        as_of=dt.date(2001, 8, 1), database=database)
    sales = spark.table(f"{database}.fact_sales")
    assert sales.count() == pipeline.read_silver(spark, lake, "orders").count() > 0
    assert sales.select("order_id").distinct().count() == sales.count()
    build = gold.published.build_of("fact_sales")
    days = [p.name for p in (tmp_path / "gold" / "fact_sales" / build).iterdir() if "=" in p.name]
    assert all(d.startswith("purchase_date=2001-") for d in days)
    assert len(days) == sales.select("purchase_date").distinct().count()
    assert spark.table("vw_executive").count() == len(days)
    for name, schema in schemas.GOLD.items():
        assert set(gold(name).columns) == set(schema.fieldNames()), name
    forecast = gold("ml_demand_forecast")
    assert forecast.filter("forecast_date <= date'2001-08-01'").isEmpty()
    log = spark.read.parquet(f"{lake}/audit")
    assert audit.run_totals(log).first().status == "SUCCESS"
    assert spark.read.parquet(f"{lake}/model_runs").filter("name = 'auc'").count() == 1
    # The views are there for a session that knows nothing of this run, and say what the marts say.
    other = spark.newSession()
    for name, mart in marts.views(gold).items():
        view = other.table(f"{database}.{name}")
        assert view.columns == mart.columns and rounded_rows(view) == rounded_rows(mart) != [], name


def rounded_rows(rows):
    """Rows with doubles to nine digits, as sums over doubles depend on their order."""
    return sorted((tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r) for r in rows.collect()), key=repr)


ORDER = {"customer_id": "c", "product_id": "p", "category": "x", "price": "1.00", "freight_value": "0",
         "state": "SP", "cdc_operation": "u"}


def order(order_id, day, version):
    at = int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    return ORDER | {"order_id": order_id, "purchase_timestamp": at, "cdc_ts_ms": version}


def event(event_id, day):
    return {"event_id": event_id, "session_id": "s", "user_id": "u", "event_type": "search", "device": "tablet",
            "timestamp": f"{day}T10:00:00", "properties": '{"category": "x"}'}


def review(review_id, day, text="fine"):
    return {"review_id": review_id, "order_id": "a", "customer_id": "c", "rating": "5", "title": "t",
            "raw_content": f"---\n{text}", "ingested_at": f"{day}T00:00:00"}


def land(spark, lake, name, *rows):
    names = schemas.BRONZE[name].fieldNames()
    spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.BRONZE[name]).coalesce(
        1).write.mode("append").parquet(f"{lake}/bronze/{name}")


def facts(source):
    return {name: rounded_rows(source(name)) for name in pipeline.FACTS}


def test_facts_are_updated_by_day(spark, tmp_path, database):
    lake = str(tmp_path)
    land(spark, lake, "orders", *(order(k, f"2024-01-0{d}", 1) for k, d in (("a", 1), ("b", 2), ("c", 3), ("d", 3))))
    land(spark, lake, "clickstream", event("1", "2024-01-01"), event("2", "2024-01-02"))
    land(spark, lake, "reviews", review("r", "2024-01-01"), review("s", "2024-01-02"))

    def step(**more):
        return pipeline.run(spark, lake, models=False, database=database, **more)

    def places():
        """The folder of every day of the sales."""
        return {str(r.purchase_date): r.f.split("/purchase_date=")[0] for r in step_sales().select(
            "purchase_date", F.col("_metadata.file_path").alias("f")).distinct().collect()}

    def step_sales():
        return spark.table(f"{database}.fact_sales__{first.published.build_of('fact_sales')}")

    first = step()
    before = places()
    assert not first.days and len(before) == 3
    # Nothing new: no day is written.
    assert step().days == {name: [] for name in pipeline.FACTS} and places() == before
    # A new day, and an order that moves from the second day, its only order, to the third.
    land(spark, lake, "orders", order("e", "2024-01-05", 1), order("b", "2024-01-03", 2))
    land(spark, lake, "clickstream", event("3", "2024-01-02"))
    land(spark, lake, "reviews", review("t", "2024-02-01"))
    second = step()
    assert second.days == {
        "fact_sales": ["2024-01-02", "2024-01-03", "2024-01-05"], "fact_clickstream": ["2024-01-02"],
        "fact_reviews": ["2024-02-01"]}
    after = places()
    assert set(after) == {"2024-01-01", "2024-01-03", "2024-01-05"}
    assert after["2024-01-01"] == before["2024-01-01"] and after["2024-01-03"] != before["2024-01-03"]
    assert second.log.rows[[r[1] for r in second.log.rows].index("fact_sales")][3] == 4
    whole = pipeline.run(spark, lake, models=False, database=f"{database}_whole")
    try:
        updated = facts(second)
        assert updated == facts(whole) and len(updated["fact_sales"]) == 5 and len(updated["fact_clickstream"]) == 3
    finally:
        spark.sql(f"DROP DATABASE {database}_whole CASCADE")
    assert step(incremental=False).days == {} and facts(second) == updated


def test_a_failed_build_leaves_the_old_table(spark, tmp_path, database):
    store = published.Published(spark, database, str(tmp_path))
    good = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, d date")
    assert store.build("t", good, "d", marks={"upto": "3"}) == 2
    reader = store("t")

    def same():
        return sorted(r.v for r in store("t").collect()) == sorted(r.v for r in reader.collect()) == [1, 2]

    broken = good.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("half-way")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="half-way"):
        store.build("t", broken, "d")
    assert same() and store.marks("t") == {"upto": "3"}

    def refuse(rows):
        assert rows.count() == 2
        raise ValueError("not unique")

    with pytest.raises(ValueError, match="not unique"):
        store.build("t", good.withColumn("v", F.col("v") + 10), "d", refuse)
    assert same()
    with pytest.raises(Exception, match="half-way"):
        store.replace_days("t", broken, "d", ["2024-01-01", "2024-01-02"], {"upto": "4"})
    assert same() and store.marks("t") == {"upto": "3"}
    with pytest.raises(ValueError, match="not to be replaced"):
        store.replace_days("t", good, "d", ["2024-01-01"])
    assert same()
    # A reader that has begun keeps the build before; another schema is another table.
    assert store.build("t", good.withColumn("w", F.lit("x")).filter("v = 1")) == 1
    assert [tuple(r) for r in store("t").collect()] == [(1, dt.date(2024, 1, 1), "x")]
    assert sorted(r.v for r in reader.collect()) == [1, 2]
    store.build("t", good)
    kept = {p.name for p in (tmp_path / "t").iterdir()}
    assert store.build_of("t") in kept and len([k for k in kept if "-days" not in k]) >= 2
    assert store.build("empty", good.limit(0), "d") == 0 and store("empty").count() == 0


def pipeline_calendar(t):
    from silverbrook.operators import dimensions

    return dimensions.dim_date(t.spark, "1990-01-01", "2030-12-31")


def test_day_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))],
                                 "v int, d date")
    assert sinks.overwrite_partitioned(rows, path, "d") == 2
    later = spark.createDataFrame([(3, dt.date(2024, 1, 2))], "v int, d date")
    assert sinks.overwrite_partitioned(later, path, "d", replace_all=False) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]
    assert sinks.overwrite_partitioned(later, path, "d") == 1
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_ensure_tables(spark, tmp_path):
    names = sinks.ensure_tables(spark, "lake_silver", str(tmp_path / "db"))
    assert sinks.ensure_tables(spark, "lake_silver") == names
    for name, table in zip(schemas.SILVER, names):
        assert spark.table(table).schema == schemas.SILVER[name]
    spark.sql("DROP DATABASE lake_silver CASCADE")
