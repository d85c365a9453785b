"""Every operator as a named query over the driver tables."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook import schemas, settings
from silverbrook.functions import values as V
from silverbrook.operators import (
    audit,
    bitmaps,
    catalog,
    demand,
    features,
    joins,
    marts,
    quality,
    reports,
    sessions,
)
from silverbrook.operators import catalog_views as catalog_views_
from silverbrook.operators.audit import RunLog
from silverbrook.plans import testbed as tb
from silverbrook.plans.pipeline import Lake, silver_run
from silverbrook.plans.published import Published
from silverbrook.plans.staging import Tables
from silverbrook.plans.star import gold_steps
from silverbrook.sources import changes, events, segments, tables
from silverbrook.streaming import folders, jobs, sinks, upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_run_numbers = itertools.count()

AUDITED = [
    "silver_clickstream", "silver_orders", "silver_reviews",
    "dim_date", "dim_category", "dim_geography",
    "fact_sales", "fact_clickstream", "fact_reviews",
]


def plain(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, as the driver tables have them."""
    zoned = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def rounded(rows: DataFrame, *columns: str) -> DataFrame:
    """Means over doubles to six places: their last digits depend on the order of addition."""
    return rows.withColumns({name: F.round(name, 6) for name in columns})


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(make(spark, sf_dir))

    QUERIES[make.__name__] = run
    return make


def on_tables(make: Callable[[Tables], DataFrame]) -> Query:
    """A query over the staged silver and gold tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(tb.staged(spark, sf_dir))

    run.__name__ = make.__name__
    query(run)
    return make


# -- silver ------------------------------------------------------------------------------


@query
def silver_clickstream(spark, sf_dir):
    return tb.silver_clickstream(spark, sf_dir)


@query
def silver_orders(spark, sf_dir):
    return tb.silver_orders(spark, sf_dir)


@query
def silver_reviews(spark, sf_dir):
    return tb.silver_reviews(spark, sf_dir)


@query
def cdc_unwrap(spark, sf_dir):
    return changes.read_cdc(tb.order_messages(spark, sf_dir)).drop("ingested_at", "source")


@query
def event_stream_filter(spark, sf_dir):
    rows = events.exclude_event_types(events.read_events(tb.click_messages(spark, sf_dir)))
    properties = F.from_json("properties", schemas.EVENT_PROPERTIES)
    return rows.withColumn("p", properties).select(
        "event_id", "session_id", "user_id", "event_type", "timestamp", "device",
        "p.product_id", "p.category", "p.price", "p.state", "p.city", "p.reason", "source",
    )


# -- streams and upserts -----------------------------------------------------------------


def _scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of its own for every run of a streaming query."""
    return f"{tb.staged(spark, sf_dir).root}/runs/{name}-{next(_run_numbers)}"


def _topic(messages: DataFrame, path: str, rows: int = 100_000) -> None:
    """Messages as compressed lines; files are bounded by rows, as a task reads such a file whole."""
    moved = folders.moved(messages, settings.WRITING)
    moved.write.option("compression", "gzip").option("maxRecordsPerFile", rows).text(path)


@query
def insert_new_keys(spark, sf_dir):
    """Two batches: arrivals and snapshot reads, a compaction, then updates; the updates again.

    Keys of the first batch keep their row, and the repeated batch changes nothing.
    """
    root = _scratch(spark, sf_dir, "insert_new_keys")
    sinks.overwrite(folders.moved(tb.raw_orders(spark, sf_dir), settings.WRITING), f"{root}/raw")
    raw = tables.read_bronze(spark, "orders", f"{root}/raw", stream=False)
    about = (schemas.VERSIONED["orders"], "order_id", tb.order_newest(), "first")
    batches = [raw.filter("cdc_operation in ('c', 'r')"), raw.filter("cdc_operation = 'u'")]

    table = f"{root}/table"

    def put(number: int) -> None:
        rows = folders.moved(tb.cleaning.silver_orders(batches[number]), settings.SMALL_TASKS)
        upsert.write_batch(rows, number, table, "order_id", tb.order_newest())

    put(0)
    upsert.compact(spark, table, *about, after=1)
    put(1)
    put(1)
    stored = upsert.current(spark, table, *about).withColumnRenamed(upsert.SEEN_IN, "batch_id")
    return stored.select("batch_id", "order_id", "product_id", "seller_id", "total_value")


@query
def stream_silver_orders(spark, sf_dir):
    """Change messages from text files through bronze into the silver table, as streams."""
    root = _scratch(spark, sf_dir, "orders")
    _topic(tb.order_messages(spark, sf_dir), f"{root}/topic")
    messages = events.message_files(spark, f"{root}/topic")
    jobs.land_changes(messages, f"{root}/bronze", f"{root}/ck_bronze")
    jobs.silver_orders(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck_silver", tb.order_newest()
    )
    return jobs.stored(spark, jobs.ORDERS, f"{root}/silver", tb.order_newest()).drop("ingested_at")


@query
def stream_silver_orders_many_batches(spark, sf_dir):
    """The versions of an order lie in different files, and six batches bring them."""
    root = _scratch(spark, sf_dir, "orders_many")
    raw = folders.moved(tb.raw_orders(spark, sf_dir), settings.WRITING)
    sinks.overwrite(raw, f"{root}/raw")
    versions = raw.sparkSession.read.schema(raw.schema).parquet(f"{root}/raw")
    # Half of the 96 files at a time: their shuffle files would else be as large as all the rest.
    for half in (0, 1):
        part = versions.where(F.pmod(F.xxhash64("cdc_ts_ms", "product_id"), F.lit(2)) == half)
        sinks.overwrite(part.repartition(48, "cdc_ts_ms", "product_id"), f"{root}/bronze", "append")
    folders.delete(spark, f"{root}/raw")
    jobs.silver_orders(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck", tb.order_newest(), files=16
    )
    return jobs.stored(spark, jobs.ORDERS, f"{root}/silver", tb.order_newest()).drop("ingested_at")


def _drop_files(reviews: DataFrame, inbox: str, arrival: int = 0) -> int:
    """A file per review in 64 folders, written by the tasks; a task that runs again writes the same files.

    Spark's own writer takes 19 ms for a file on a local disk, as Hadoop starts a process to set its mode.
    """

    def put(parts):
        store, root = fs.FileSystem.from_uri(inbox)
        for folder in range(64):
            store.create_dir(f"{root}/{folder}")
        for rows in parts:
            for place, value in zip(rows["place"].to_pylist(), rows["value"].to_pylist(), strict=True):
                with store.open_output_stream(f"{root}/{place % 64}/{arrival}-{place}.txt") as out:
                    out.write(value.encode() + b"\n")
            yield pa.RecordBatch.from_pydict({"files": [len(rows)]})

    placed = reviews.select(F.monotonically_increasing_id().alias("place"), "value")
    return placed.mapInArrow(put, "files bigint").agg(F.sum("files")).first()[0]


@query
def land_review_files(spark, sf_dir):
    """Every review document as a file of its own, picked up from an inbox and landed."""
    root = _scratch(spark, sf_dir, "review_files")
    _drop_files(tb.review_documents(spark, sf_dir), f"{root}/inbox")
    jobs.land_reviews(spark, f"{root}/inbox", f"{root}/bronze", f"{root}/ck")
    landed = tables.read_bronze(spark, "reviews", f"{root}/bronze", stream=False)
    # Spark's text files end with a line break.
    return landed.select("review_id", "order_id", "customer_id", "rating", "title",
                         F.regexp_replace("raw_content", r"\n\z", "").alias("raw_content"))


@query
def land_review_files_again(spark, sf_dir):
    """Two arrivals of review documents: what the first drain has landed leaves the inbox before the second."""
    root = _scratch(spark, sf_dir, "review_inbox")
    files = tb.review_documents(spark, sf_dir)
    for late in (False, True):
        part = files.where((F.pmod(F.hash("file_path"), F.lit(2)) == 1) == F.lit(late))
        _drop_files(part, f"{root}/inbox", int(late))
        jobs.land_reviews(spark, f"{root}/inbox", f"{root}/bronze", f"{root}/ck", archive=f"{root}/archive")
    landed = tables.read_bronze(spark, "reviews", f"{root}/bronze", stream=False)
    return landed.select("review_id", "order_id", "customer_id", "rating", "title",
                         F.regexp_replace("raw_content", r"\n\z", "").alias("raw_content"))


def _numbered(rows: DataFrame, by: str, order: str, span: int = 30_000) -> DataFrame:
    """``offset``: the place of every row within its group, from 0, in the order of a whole number.

    Spans of the number are counted first, so that no task sorts a whole group; nulls come first.
    """
    part = F.floor(F.col(order) / span).alias("_span")
    sizes = rows.select(by, part).groupBy(by, "_span").count()
    before = F.sum("count").over(Window.partitionBy(by).orderBy("_span")) - F.col("count")
    firsts = sizes.select(F.col(by).alias("_by"), F.col("_span").alias("_of"), before.alias("_before"))
    place = F.row_number().over(Window.partitionBy(by, "_span").orderBy(order)) - 1
    placed = rows.select("*", part).withColumn("_place", place)
    same = F.col(by).eqNullSafe(F.col("_by")) & F.col("_span").eqNullSafe(F.col("_of"))
    return placed.join(firsts, same).withColumn("offset", F.col("_before") + F.col("_place")).drop(
        "_span", "_place", "_by", "_of", "_before")


@query
def stream_from_segments(spark, sf_dir):
    """Events through a topic's segments with offsets, in two arrivals, into bronze."""
    root, size = _scratch(spark, sf_dir, "segments"), 1000
    event = F.get_json_object("value", "$.event_id").cast("bigint")
    rows = tb.click_messages(spark, sf_dir).withColumns({"event": event, "partition": F.pmod(event, F.lit(3))})
    rows = _numbered(rows, "partition", "event").withColumn("first", F.floor(F.col("offset") / size) * size)
    for late in (False, True):
        part = rows.where((F.col("first") >= 2 * size) == F.lit(late)).withColumn("first", F.format_string("%020d", "first"))
        part = part.repartition("partition", "first").sortWithinPartitions("partition", "first", "offset")
        part.select("value", "partition", "first").write.mode("append").partitionBy("partition", "first").text(f"{root}/topic")
        jobs.land_events(segments.message_segments(spark, f"{root}/topic"), f"{root}/bronze", f"{root}/ck")
    landed = tables.read_bronze(spark, "clickstream", f"{root}/bronze", stream=False)
    return landed.withColumn("p", F.from_json("properties", schemas.EVENT_PROPERTIES)).select(
        "event_id", "session_id", "user_id", "event_type", "timestamp", "device",
        "p.product_id", "p.category", "p.price", "p.state", "p.city", "p.reason", "source",
    )


@query
def packed_bronze(spark, sf_dir):
    """Events landed in many small files, read after their hours have been packed."""
    root = _scratch(spark, sf_dir, "packed")
    tb.click_messages(spark, sf_dir).repartition(6).write.text(f"{root}/topic")
    rows = events.exclude_event_types(events.read_events(events.message_files(spark, f"{root}/topic", files=2)))
    sinks.drain(spark, sinks.bronze_writer(rows, f"{root}/bronze", f"{root}/ck"))
    sinks.pack_bronze(spark, "clickstream", f"{root}/bronze", f"{root}/packed", before="9999")
    landed = sinks.read_packed(spark, "clickstream", f"{root}/bronze", f"{root}/packed")
    return landed.withColumn("p", F.from_json("properties", schemas.EVENT_PROPERTIES)).select(
        "event_id", "session_id", "user_id", "event_type", "timestamp", "device",
        "p.product_id", "p.category", "p.price", "p.state", "p.city", "p.reason", "source",
    )


@query
def stream_silver_clickstream(spark, sf_dir):
    """Event messages from text files through bronze into the silver table, as streams."""
    root = _scratch(spark, sf_dir, "clicks")
    _topic(tb.click_messages(spark, sf_dir), f"{root}/topic")
    messages = events.message_files(spark, f"{root}/topic")
    jobs.land_events(messages, f"{root}/bronze", f"{root}/ck_bronze")
    jobs.silver_clickstream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck_silver")
    return tables.table(spark, f"{root}/silver", schemas.SILVER["clickstream"]).drop("ingested_at")


@query
def stream_silver_reviews(spark, sf_dir):
    """Bronze reviews into the silver table, as a stream."""
    root = _scratch(spark, sf_dir, "reviews")
    tb.raw_reviews(spark, sf_dir).write.parquet(f"{root}/bronze")
    jobs.silver_reviews(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck_silver")
    return jobs.stored(spark, jobs.REVIEWS, f"{root}/silver")


@query
def stream_audit(spark, sf_dir):
    """What the streams of a run report: rows landed, rows kept, and nothing for a missing input."""
    root = _scratch(spark, sf_dir, "audit")
    _topic(tb.click_messages(spark, sf_dir), f"{root}/topic")
    log = RunLog("streams")
    steps = {
        "land_events": lambda: jobs.land_events(
            events.message_files(spark, f"{root}/topic"), f"{root}/bronze", f"{root}/ck_bronze"),
        "silver_clickstream": lambda: jobs.silver_clickstream(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck_silver"),
        "again": lambda: jobs.silver_clickstream(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck_silver"),
        "missing_input": lambda: jobs.silver_orders(
            spark, f"{root}/none", f"{root}/orders", f"{root}/ck_orders"),
    }
    for name, work in steps.items():
        log.step(name, work)
    log.append(spark, f"{root}/log")
    return spark.read.schema(schemas.AUDIT).parquet(f"{root}/log").select("step", "status", "records")


# -- star schema -------------------------------------------------------------------------


@on_tables
def dim_date(t):
    return t("dim_date")


@on_tables
def dim_category(t):
    return t("dim_category").select("category_en")


@on_tables
def dim_geography(t):
    """States with the orders of each."""
    orders = t("silver_orders").groupBy("state").agg(F.count("*").alias("orders"))
    return (
        t("dim_geography")
        .join(orders, "state", "left")
        .select("state", "state_name", "region", F.coalesce("orders", F.lit(0)).alias("orders"))
    )


@on_tables
def fact_sales(t):
    labelled = joins.with_geography(
        joins.with_category(t("fact_sales"), t("dim_category")), t("dim_geography")
    )
    return labelled.drop("category_id", "geo_id")


@on_tables
def fact_clickstream(t):
    return joins.with_category(t("fact_clickstream"), t("dim_category")).drop("category_id")


@on_tables
def fact_reviews(t):
    return t("fact_reviews")


@on_tables
def preview_sales(t):
    """The first hundred orders by id."""
    return joins.with_category(tables.preview(t("fact_sales").orderBy("order_id")), t("dim_category")).select(
        "order_id", "customer_id", "product_id", "category", "total_value", "purchase_date")


@on_tables
def replaced_days(t):
    """Facts stored by date, here the month's first; the earlier half is written again, the rest stays."""
    root = f"{t.root}/runs/by_day-{next(_run_numbers)}"
    sales = t("fact_sales").where("purchase_date is not null").withColumn(
        "purchase_date", F.trunc("purchase_date", "month"))
    sinks.overwrite_partitioned(sales, root, "purchase_date")
    middle = sales.agg(F.expr("date_add(min(purchase_date), int(datediff(max(purchase_date), min(purchase_date)) / 2))")
                       .alias("d")).scalar()
    early = sales.where(F.col("purchase_date") < middle).withColumn("seller_id", F.lit("again"))
    sinks.overwrite_partitioned(early, root, "purchase_date", replace_all=False)
    stored = t.spark.read.schema(schemas.GOLD["fact_sales"]).parquet(root)
    again = F.count(F.when(F.col("seller_id") == "again", 1)).alias("written_again")
    return stored.groupBy("purchase_date").agg(F.count("*").alias("orders"), again)


@on_tables
def published_sales(t):
    """Facts by month read through their published name: a build, another, then the later months again."""
    number = next(_run_numbers)
    store = Published(t.spark, f"published_{number}", f"{t.root}/runs/published-{number}")
    sales = t("fact_sales").where("purchase_date is not null").withColumn(
        "purchase_date", F.trunc("purchase_date", "month"))
    store.build("sales", sales.where("order_id like '%1'"), "purchase_date")
    store.build("sales", sales, "purchase_date")
    bounds = sales.agg(F.min("purchase_date").alias("a"), F.max("purchase_date").alias("b"))
    middle = bounds.select(F.expr("date_add(a, int(datediff(b, a) / 2))").alias("d")).scalar()
    late = sales.where(F.col("purchase_date") >= middle).withColumn("seller_id", F.lit("again"))
    months = [str(r[0]) for r in late.select("purchase_date").distinct().collect()]
    store.replace_days("sales", late, "purchase_date", months)
    again = F.count(F.when(F.col("seller_id") == "again", 1)).alias("written_again")
    return store("sales").groupBy("purchase_date").agg(F.count("*").alias("orders"), again)


@query
def incremental_clickstream(spark, sf_dir):
    """Facts of two arrivals, each a run: the second run writes only the days that it brings rows for."""
    number = next(_run_numbers)
    lake = f"{tb.staged(spark, sf_dir).root}/runs/lake-{number}"
    raw = tb.raw_clicks(spark, sf_dir).select(schemas.BRONZE["clickstream"].fieldNames())
    late = raw.agg(F.date_sub(F.max(F.col("ingested_at").cast("timestamp")).cast("date"), 9).alias("d")).scalar()
    wanted = ("dim_date", "dim_category", "fact_clickstream")
    steps = {name: step for name, step in gold_steps().items() if name in wanted}
    for part in (F.to_date("ingested_at") < late, F.to_date("ingested_at") >= late):
        raw.where(part).write.mode("append").parquet(f"{lake}/bronze/clickstream")
        gold = Lake(spark, lake, steps, f"run-{next(_run_numbers)}", f"lake_{number}")
        silver_run(spark, lake, gold.log)
        gold.build_all()
    facts = joins.with_category(gold("fact_clickstream"), gold("dim_category")).drop("category_id")
    return facts.withColumn("second_run", F.col("event_date").cast("string").isin(gold.days["fact_clickstream"]))


@query
def catalog_views(spark, sf_dir):
    """Rows per view of the catalog, counted by a session that knows nothing but their names."""
    t, number = tb.staged(spark, sf_dir), next(_run_numbers)
    store = Published(spark, f"views_{number}", f"{t.root}/runs/views-{number}")
    for name in ("dim_category", "dim_geography", "fact_sales", "fact_clickstream", "fact_reviews"):
        store.build(name, t(name))
    other = spark.newSession()
    counts = [other.table(name).agg(F.count("*").alias("n_rows"), F.lit(name.split(".")[1]).alias("name"))
              for name in catalog_views_.create(spark, store.database)]
    return reduce(DataFrame.unionByName, counts).select("name", "n_rows")


@on_tables
def managed_tables(t):
    """Tables made in a catalogue database and filled; making them again keeps their rows."""
    database = f"silver_{next(_run_numbers)}"
    sinks.ensure_tables(t.spark, database, f"{t.root}/runs/{database}")
    parts = []
    for name in schemas.SILVER:
        t(f"silver_{name}").select(schemas.SILVER[name].fieldNames()).write.insertInto(f"{database}.{name}")
        sinks.ensure_tables(t.spark, database)
        stored = t.spark.table(f"{database}.{name}").agg(F.count("*").alias("n_rows"))
        parts.append(stored.select(F.lit(name).alias("name"), "n_rows"))
    return parts[0].union(parts[1]).union(parts[2])


@query
def reference_csv(spark, sf_dir):
    """Review rows through CSV files with quotes and line breaks in their texts."""
    root = _scratch(spark, sf_dir, "csv")
    tb.review_rows(spark, sf_dir).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root)
    return tables.read_reference_csv(spark, root)


# -- marts -------------------------------------------------------------------------------


def _executive(t: Tables) -> DataFrame:
    return marts.executive(t("fact_sales"), t("fact_reviews"), unique_keys=True)


def _performance(t: Tables) -> DataFrame:
    return marts.sales_performance(
        t("fact_sales"), t("dim_category"), t("dim_geography"), unique_keys=True
    )


def _funnel(t: Tables) -> DataFrame:
    return marts.funnel(t("fact_clickstream"), t("dim_category"))


def _reviews(t: Tables) -> DataFrame:
    return marts.review_sentiment(
        t("fact_reviews"), t("fact_sales"), t("dim_category"), t("dim_geography")
    )


@on_tables
def mart_executive(t):
    return _executive(t)


@on_tables
def mart_executive_general(t):
    """The same mart without assuming that keys are unique."""
    return marts.executive(t("fact_sales"), t("fact_reviews"), unique_keys=False)


@on_tables
def mart_executive_no_fan_out(t):
    return marts.executive(t("fact_sales"), t("fact_reviews"), fan_out=False, unique_keys=True)


@on_tables
def mart_sales_performance(t):
    return _performance(t)


@on_tables
def mart_funnel(t):
    return _funnel(t)


@on_tables
def mart_reviews(t):
    return _reviews(t)


@on_tables
def mart_trends(t):
    return marts.trends(t("fact_sales"), unique_keys=True)


@on_tables
def mart_category_trends(t):
    return marts.category_trends(t("fact_sales"), t("dim_category"), unique_keys=True)


@query
def views(spark, sf_dir):
    """Rows per registered view."""
    names = marts.register_views(spark, tb.staged(spark, sf_dir))
    counts = [
        spark.table(name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "*")
        for name in names
    ]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    return rows


# -- dashboard ---------------------------------------------------------------------------


def _since(t: Tables, fact: str, day: str, days: int) -> Column:
    """``days`` before a fact's last day, which is read from the files' footers."""
    schema = t(fact).schema
    return F.date_sub(F.lit(tables.last_value(t.spark, t.path(fact), schema, day)).cast("date"), days)


def _recent(t: Tables, mart: DataFrame, name: str, column: str, fact: str, day: str) -> DataFrame:
    days = settings.DASHBOARD_DAYS[name]
    return tables.last_days(mart, column, days, since=_since(t, fact, day, days))


def _recent_sales(t: Tables) -> DataFrame:
    days = settings.DASHBOARD_DAYS["executive"]
    since = _since(t, "fact_sales", "purchase_date", days)
    return tables.last_days(t("fact_sales"), "purchase_date", days, since=since)


def _recent_executive(t):
    sales = _recent_sales(t)
    return marts.executive(sales, marts.reviews_of(t("fact_reviews"), sales), unique_keys=True)


def _recent_performance(t):
    return _recent(
        t, _performance(t), "sales_performance", "purchase_date", "fact_sales", "purchase_date"
    )


def _recent_funnel(t):
    """The window is cut from the clicks, so that both groupings of the mart read only it."""
    days = settings.DASHBOARD_DAYS["funnel"]
    clicks = t("fact_clickstream")
    since = _since(t, "fact_clickstream", "event_date", days)
    return marts.funnel(tables.last_days(clicks, "event_date", days, since=since), t("dim_category"))


def _recent_reviews(t):
    return _recent(t, _reviews(t), "reviews", "review_date", "fact_reviews", "review_date")


@on_tables
def recent_executive(t):
    return _recent_executive(t).orderBy("day")


@on_tables
def recent_sales_performance(t):
    return _recent_performance(t)


@on_tables
def recent_funnel(t):
    return _recent_funnel(t)


@on_tables
def recent_reviews(t):
    return _recent_reviews(t)


@on_tables
def kpi_totals(t):
    return rounded(reports.kpi_totals(_recent_executive(t)), "avg_order_value", "avg_rating")


@on_tables
def kpi_totals_exact(t):
    """From the daily marts alone: customers are counted from bitmaps."""
    return bitmaps.kpi_totals(t("mart_daily"), t("mart_daily_customers"), settings.DASHBOARD_DAYS["executive"])


@on_tables
def kpi_totals_of_facts(t):
    """The same numbers from the facts."""
    sales = _recent_sales(t)
    return reports.kpi_totals_exact(sales, marts.reviews_of(t("fact_reviews"), sales))


@on_tables
def visitors_per_type(t):
    """Distinct sessions and users per event type over the funnel's days, from the daily marts alone."""
    return bitmaps.visitors_per_type(
        t("mart_daily_sessions"), t("mart_daily_users"), settings.DASHBOARD_DAYS["funnel"])


@on_tables
def visitors_per_day(t):
    """Distinct sessions and users per day, each counted once however many types, devices or hours."""
    return bitmaps.visitors_per_day(
        t("mart_daily_sessions"), t("mart_daily_users"), settings.DASHBOARD_DAYS["funnel"])


@on_tables
def unpivot_review_counts(t):
    return reports.unpivot_review_counts(_recent_executive(t))


@on_tables
def top_categories_by_revenue(t):
    return reports.top_categories_by_revenue(_recent_performance(t))


@on_tables
def revenue_by_region(t):
    return reports.revenue_by_region(_recent_performance(t))


@on_tables
def revenue_trend(t):
    return reports.revenue_trend(_recent_performance(t))


@on_tables
def top_states_by_revenue(t):
    return reports.top_states_by_revenue(_recent_performance(t))


@on_tables
def funnel_totals(t):
    return reports.funnel_totals(_recent_funnel(t))


@on_tables
def events_by_device(t):
    return reports.events_by_device(_recent_funnel(t))


@on_tables
def top_events_over_time(t):
    """The two most frequent types; the data has five, so five would keep everything."""
    return reports.top_events_over_time(_recent_funnel(t), k=2)


@on_tables
def sessions_users_by_day(t):
    return reports.sessions_users_by_day(_recent_funnel(t))


@on_tables
def sentiment_distribution(t):
    return reports.sentiment_distribution(_recent_reviews(t))


@on_tables
def weighted_daily_rating(t):
    return rounded(reports.weighted_daily_rating(_recent_reviews(t)), "avg_rating")


@on_tables
def top_reviewed_categories(t):
    return rounded(reports.top_reviewed_categories(_recent_reviews(t)), "avg_rating")


@on_tables
def sentiment_by_region(t):
    return reports.sentiment_by_region(_recent_reviews(t))


# -- features and models -----------------------------------------------------------------


@on_tables
def churn_features(t):
    return features.churn_features(t("fact_sales"), t("fact_reviews"), unique_keys=True)


@on_tables
def time_series_features(t):
    return features.time_series_features(
        t("fact_sales"), t("dim_category"), t("dim_date"), unique_keys=True
    ).drop("category_id")


@on_tables
def time_series_leak_free(t):
    """The same features with the mean of the seven rows before."""
    rows = features.time_series_features(
        t("fact_sales"), t("dim_category"), t("dim_date"), leak_free=True, unique_keys=True)
    return rounded(rows.drop("category_id"), "rolling_7d_mean")


@on_tables
def risk_labels(t):
    """Labels and summary of a score that any engine computes: its recency over a year."""
    scored = t("ml_churn_features").withColumns({
        "churn_probability": F.least(F.col("recency") / 365.0, F.lit(1.0)),
        "model_f1": F.lit(0.5), "model_auc": F.lit(0.75)})
    labelled = scored.withColumn("risk_label", V.risk_label("churn_probability"))
    return rounded(reports.churn_summary(labelled), "avg_churn_prob", "avg_recency", "avg_frequency", "avg_monetary")


@on_tables
def risk_label_counts(t):
    """High and low risk customers of the same score."""
    scored = t("ml_churn_features").withColumn("churn_probability", F.least(F.col("recency") / 365.0, F.lit(1.0)))
    labelled = scored.withColumn("risk_label", V.risk_label("churn_probability"))
    return reports.risk_counts(labelled.groupBy("risk_label").agg(F.count("*").alias("total_customers")))


@on_tables
def chronological_cut(t):
    cut = features.chronological_cut(t("ml_demand_features"))
    return cut.select("category_en", "n_rows", "split_date").distinct()


@on_tables
def churn_scores(t):
    return t("ml_churn_scores")


@on_tables
def churn_score_columns(t):
    """What is certain of the scores: the customers' numbers, and labels that follow the probability."""
    scores = t("ml_churn_scores")
    follows = F.col("risk_label") == V.risk_label("churn_probability")
    sound = F.col("churn_probability").between(0, 1) & F.col("scored_at").isNotNull()
    return scores.select("customer_id", "recency", "frequency", "monetary", (follows & sound).alias("sound"))


@on_tables
def churn_summary(t):
    return reports.churn_summary(t("ml_churn_scores"))


@on_tables
def risk_counts(t):
    return reports.risk_counts(reports.churn_summary(t("ml_churn_scores")))


@on_tables
def demand_metrics(t):
    return rounded(demand.demand_metrics(t("ml_demand_models")).drop("category_id"), "rmse", "mae")


@on_tables
def demand_forecast(t):
    """The forecast tab without the time it was made at."""
    return rounded(reports.forecast_view(t("ml_demand_forecast")), "predicted_orders").drop("scored_at")


@on_tables
def demand_forecast_recursive(t):
    """Forecasts whose lags are real rows and earlier forecasts, from leak-free models."""
    rows = features.time_series_features(
        t("fact_sales"), t("dim_category"), t("dim_date"), leak_free=True, unique_keys=True)
    made = demand.recursive_forecast(demand.train(rows), rows, tb.last_purchase(t("fact_sales")))
    return rounded(made, "predicted_orders").drop("category_id")


@on_tables
def demand_runs(t):
    """Parameters and metrics logged for the demand models, numbers to six places."""
    rows = t("ml_model_runs").where("run_name like 'demand_%'").drop("logged_at")
    number = F.format_number(F.col("value").try_cast("double"), 6)
    return rows.withColumn("value", F.when(F.col("kind") == "metric", number).otherwise(F.col("value")))


@on_tables
def model_runs(t):
    """Parameters and metrics of the churn run and of every demand model."""
    return t("ml_model_runs")


# -- reference tables, quality, sessions, audit ------------------------------------------


@query
def product_catalog(spark, sf_dir):
    return catalog.product_catalog(
        tb.product_rows(spark, sf_dir),
        tb.item_rows(spark, sf_dir),
        tb.translation_rows(spark),
        tb.ITEM_ORDER,
    )


@query
def review_pool(spark, sf_dir):
    return catalog.review_pool(tb.review_rows(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    return quality.quality_report(
        tb.raw_clicks(spark, sf_dir), tb.raw_orders(spark, sf_dir), tb.raw_reviews(spark, sf_dir)
    )


@query
def session_outcomes(spark, sf_dir):
    return sessions.session_outcomes(tb.raw_clicks(spark, sf_dir))


@query
def step_conversion(spark, sf_dir):
    return sessions.step_conversion(sessions.session_outcomes(tb.raw_clicks(spark, sf_dir)))


@query
def session_end_reasons(spark, sf_dir):
    return sessions.end_reasons(sessions.session_outcomes(tb.raw_clicks(spark, sf_dir)))


@on_tables
def run_audit(t):
    """Status and records of every step up to the facts, from the stored audit table."""
    return _audit(t).select("step", "status", "records")


@on_tables
def run_totals(t):
    """Status, steps and records of the run, from the stored audit table."""
    return audit.run_totals(_audit(t)).select(
        "status", "steps", "records", (F.col("seconds") > 0).alias("timed"))


def _audit(t: Tables) -> DataFrame:
    """Builds what is missing, stores the log and reads it back."""
    for name in AUDITED:
        t(name)
    path = f"{t.root}/runs/audit-{next(_run_numbers)}"
    t.log.append(t.spark, path)
    return t.spark.read.schema(schemas.AUDIT).parquet(path).filter(F.col("step").isin(AUDITED))
