"""The driver tables in the shape of the raw retail inputs (mapping: FIXTURES.md).

Everything is arithmetic on whole tables, so any SQL engine derives the same rows.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook import schemas, session, settings
from silverbrook.operators import cleaning, dedup
from silverbrook.plans.staging import Step, Tables
from silverbrook.plans.star import calendar_of, exact_steps, gold_steps
from silverbrook.sources import reviews as review_source

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EVENT_TYPES = {
    "signup": "session_start",
    "view": "product_view",
    "click": "add_to_cart",
    "purchase": "order_placed",
    "error": "session_end",
}
# Categories with a translation; the others keep their name.
TRANSLATION = {"ECONOMY": "economy", "LARGE": "large", "MEDIUM": "medium", "PROMO": "promotion"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _multiple(column: str, of: int) -> Column:
    return F.col(column) % of == 0


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.lit(values), (index + 1).cast("int"))


# -- clicks ------------------------------------------------------------------------------


def _clicks(spark: SparkSession, sf_dir: str, properties: Column) -> DataFrame:
    events = load(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )
    session_id = F.concat_ws("-", _text("user_id"), F.date_format("ts", "yyyyMMdd"))
    kind = F.create_map(*(F.lit(v) for pair in EVENT_TYPES.items() for v in pair))
    day = F.date_format("ts", ISO)
    return events.select(
        _text("event_id").alias("event_id"),
        F.when(_multiple("event_id", 33), None)
        .when(_multiple("event_id", 101), "")
        .otherwise(session_id)
        .alias("session_id"),
        _text("user_id").alias("user_id"),
        F.when(~_multiple("event_id", 50), kind[F.col("event_type")]).alias("event_type"),
        F.when(_multiple("event_id", 97), "not-a-time").otherwise(day).alias("timestamp"),
        F.when(F.col("event_id") % 25 == 0, "bot")
        .when(F.col("event_id") % 25 == 1, "")
        .when(F.col("event_id") % 25 == 2, None)
        .otherwise(_pick(settings.DEVICES, F.col("user_id") % 3))
        .alias("device"),
        properties.alias("properties"),
        day.alias("ingested_at"),
    )


def _properties() -> Column:
    k = F.col("k")
    reason = F.when(F.col("event_type") == "error", _pick(settings.END_REASONS, k % 5))
    return F.struct(
        k.cast("string").alias("product_id"),
        _pick(CATEGORIES, k % 6).alias("category"),
        F.col("value").alias("price"),
        F.when(k % 5 != 0, _pick(settings.STATE_CODES, k % 27)).alias("state"),
        F.concat(F.lit("city_"), k.cast("string")).alias("city"),
        reason.alias("reason"),
    )


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events; one in 89 has broken JSON."""
    text = F.when(_multiple("event_id", 89), "{bad").otherwise(F.to_json(_properties()))
    return _clicks(spark, sf_dir, text).withColumn("source", F.lit("kafka"))


def click_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages with a nested ``properties`` object."""
    rows = _clicks(spark, sf_dir, _properties()).drop("ingested_at")
    return rows.select(F.to_json(F.struct("*")).alias("value"))


# -- orders ------------------------------------------------------------------------------


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows with their operation. No hints: Spark picks joins by measured sizes."""
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    # Narrow tables meet first, so that the lines are shuffled once less.
    bought = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    freight = F.round(amount * F.col("l_tax").cast("decimal(4,2)"), 2)
    price = (
        F.when(_multiple("l_partkey", 41), "N/A")
        .when(_multiple("l_partkey", 25), (-amount).cast("string"))
        # Some prices have a part below the cent.
        .when(_multiple("l_partkey", 37), F.concat(amount.cast("string"), F.lit("5")))
        .otherwise(amount.cast("string"))
    )
    state = _pick(settings.STATE_CODES, F.col("c_nationkey"))
    return joined.select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("order_id"),
        F.concat_ws("-", _text("o_custkey"), F.date_format("o_orderdate", "yyyyMMdd")).alias(
            "session_id"
        ),
        _text("o_custkey").alias("customer_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.when(_multiple("l_partkey", 20), F.concat(F.lit("  "), "p_type", F.lit("  ")))
        .otherwise(F.col("p_type"))
        .alias("category"),
        price.alias("price"),
        freight.cast("string").alias("freight_value"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("purchase_timestamp"),
        F.when(_multiple("l_suppkey", 17), F.lower(state))
        .when(_multiple("l_suppkey", 19), F.concat(F.lit(" "), state, F.lit(" ")))
        .when(_multiple("l_suppkey", 23), F.concat(state, F.lit("0")))
        .otherwise(state)
        .alias("state"),
        F.when(F.col("l_quantity") == 50, "d")
        .when(F.col("l_returnflag") == "R", "u")
        .otherwise("c")
        .alias("cdc_operation"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("cdc_ts_ms"),
        F.date_format("l_shipdate", ISO).alias("ingested_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze orders: deletes are already dropped."""
    rows = _order_lines(spark, sf_dir).filter(F.col("cdc_operation").isin(settings.CHANGE_OPS))
    return rows.withColumn("source", F.lit("debezium"))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes as JSON; every other product comes without the outer ``payload``."""
    rows = _order_lines(spark, sf_dir)
    body = F.struct(
        F.col("cdc_operation").alias("op"),
        F.col("cdc_ts_ms").alias("ts_ms"),
        F.when(F.col("cdc_operation") != "d", F.struct(*schemas.CHANGE_ROW.fieldNames())).alias(
            "after"
        ),
    )
    wrapped = F.col("product_id").cast("bigint") % 2 == 0
    message = F.when(wrapped, F.to_json(F.struct(body.alias("payload")))).otherwise(
        F.to_json(body)
    )
    return rows.select(message.alias("value"))


def order_newest() -> list[Column]:
    """Columns that are larger in the newer version of an order."""
    return [
        F.col("cdc_ts_ms"),
        F.col("product_id").cast("bigint"),
        F.col("seller_id").cast("bigint"),
        F.col("price"),
        F.col("freight_value"),
    ]


def order_latest() -> list[Column]:
    return [column.desc() for column in order_newest()]


# -- reviews -----------------------------------------------------------------------------


def review_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as review files: ``file_path``, ``value`` and a landing time."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    doc = F.col("doc_id")
    body = F.when(_multiple("doc_id", 14), F.replace("text", F.lit("é"), F.lit("Ã©"))).otherwise(
        F.col("text")
    )
    body = F.when(_multiple("doc_id", 37), "   ").otherwise(body)
    review_id = F.when(_multiple("doc_id", 43), "").otherwise(
        F.when(doc % 20 == 19, doc - 1).otherwise(doc).cast("string")
    )
    order_id = F.concat_ws("-", (doc % 250).cast("string"), (doc % 5 + 1).cast("string"))
    stars = (1 + F.floor(doc / 3) % 5).cast("string")
    rating = (
        F.when(_multiple("doc_id", 23), "N/A")
        .when(_multiple("doc_id", 29), "-1")
        .when(_multiple("doc_id", 31), "7")
        .otherwise(stars)
    )
    landed = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (doc % 60).cast("int")), ISO)
    title = F.when(_multiple("doc_id", 2), F.concat(F.lit("TITLE: Review "), _text("doc_id")))
    value = F.concat_ws(
        "\n",
        F.concat(F.lit("REVIEW_ID: "), review_id),
        F.concat(F.lit("ORDER_ID: "), order_id),
        F.concat(F.lit("CUSTOMER_ID: "), (doc % 1500).cast("string")),
        F.concat(F.lit("RATING: "), rating, F.lit("/5")),
        F.concat(F.lit("TIMESTAMP: "), landed),
        F.lit("---"),
        title,
        F.lit(""),
        body,
    )
    path = F.concat(F.lit("reviews/"), _text("doc_id"), F.lit(".txt"))
    return docs.select(path.alias("file_path"), value.alias("value"), landed.alias("landed"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze reviews, parsed from the whole documents."""
    return review_source.parse_reviews(
        review_documents(spark, sf_dir), landed=F.col("landed")
    )


def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of the review reference table."""
    doc = F.col("doc_id")
    message = F.when(_multiple("doc_id", 37), "   ").otherwise(F.col("text"))
    return load(spark, sf_dir, "documents").select(
        _text("doc_id").alias("review_id"),
        (1 + F.floor(doc / 3) % 5).cast("string").alias("review_score"),
        F.when(_multiple("doc_id", 2), F.concat(F.lit(" Review "), _text("doc_id"))).alias(
            "review_comment_title"
        ),
        message.alias("review_comment_message"),
    )


# -- catalogue ---------------------------------------------------------------------------


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.when(~_multiple("p_partkey", 53), F.col("p_type")).alias("product_category_name"),
        _text("p_size").alias("product_photos_qty"),
    )


def item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with the columns that define which one comes first."""
    return load(spark, sf_dir, "lineitem").select(
        _text("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_tax").alias("freight_value"),
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        "l_tax",
    )


ITEM_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_tax",
]


def translation_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(TRANSLATION.items()),
        "product_category_name string, product_category_name_english string",
    )


# -- silver, and tables shared by queries ------------------------------------------------


def silver_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver_clickstream(raw_clicks(spark, sf_dir))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_orders_of(raw_orders(spark, sf_dir))


def silver_orders_of(raw: DataFrame) -> DataFrame:
    clean = cleaning.silver_orders(raw)
    latest = dedup.latest_per_key(clean, "order_id", order_latest())
    return latest.select(schemas.SILVER["orders"].fieldNames())


def silver_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.silver_reviews(raw_reviews(spark, sf_dir))
    return dedup.latest_per_key(clean, "review_id", dedup.descending(dedup.REVIEW_LATEST))


def _calendar(t: Tables) -> DataFrame:
    return calendar_of(
        t("silver_orders").select(F.to_date("purchase_ts")),
        t("silver_clickstream").select(F.to_date("event_ts")),
        t("silver_reviews").select(F.to_date("ingested_at")),
    )


def last_purchase(sales: DataFrame) -> Column:
    return sales.agg(F.max("purchase_date").alias("d")).scalar()


def _files_mark(spark: SparkSession, sf_dir: str) -> str:
    """Changes when any input file does; lists files without reading them."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(sf_dir)
    )
    mark = files.agg(
        F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
    ).first()
    return f"{sf_dir}|{mark[0]}|{mark[1]}"


_marks: dict[tuple[str, str], str] = {}
_tables: dict[tuple[str, str], Tables] = {}
_lock = threading.Lock()


def staged(spark: SparkSession, sf_dir: str) -> Tables:
    """Silver and gold tables of the data set, written once per application when first used.

    They lie in the shared folder, so losing an executor costs no recomputation. The input is
    listed once per application: its files don't change under a run.
    """
    app = spark.sparkContext.applicationId
    with _lock:
        if (app, sf_dir) not in _marks:
            _marks[app, sf_dir] = _files_mark(spark, sf_dir)
        mark = _marks[app, sf_dir]
        if (app, mark) not in _tables:
            digest = hashlib.sha256(mark.encode()).hexdigest()[:16]
            root = f"{session.shared_dir(spark)}/{app}/{digest}"
            steps = {
                "silver_clickstream": Step(lambda t: silver_clickstream(spark, sf_dir)),
                # Stored between its joins and the ranking, which would else keep their shuffle files together.
                "raw_orders": Step(lambda t: raw_orders(spark, sf_dir)),
                "silver_orders": Step(
                    lambda t: silver_orders_of(t("raw_orders")), slices=("order_id", 2), frees=("raw_orders",)),
                "silver_reviews": Step(lambda t: silver_reviews(spark, sf_dir)),
                **gold_steps(
                    dim_date=_calendar, by_day=False, as_of=lambda t: last_purchase(t("fact_sales"))
                ),
                **exact_steps(),
            }
            _tables[app, mark] = Tables(spark, root, steps, digest)
        return _tables[app, mark]
