"""Bronze to silver: validation, typing and normalising. Works on batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook import schemas, settings
from silverbrook.functions import values as V
from silverbrook.operators import joins


def valid_event() -> Column:
    return F.col("event_id").isNotNull() & V.present("session_id") & V.present("event_type")


def known_device(column: str = "device") -> Column:
    return (
        F.when(F.col(column).isin(settings.DEVICES), F.col(column))
        .otherwise(settings.UNKNOWN_DEVICE)
    )


def event_properties(column: str = "properties") -> Column:
    """Typed properties; unreadable JSON gives nulls."""
    return F.from_json(column, schemas.EVENT_PROPERTIES)


def silver_clickstream(raw: DataFrame) -> DataFrame:
    typed = (
        raw.filter(valid_event())
        .withColumn("event_ts", V.parse_ts("timestamp"))
        .filter(plausible(F.col("event_ts")))
    )
    return V.once(typed, "p", event_properties()).select(
        "event_id",
        "session_id",
        "user_id",
        "event_type",
        "event_ts",
        known_device().alias("device"),
        F.col("p.category").alias("category"),
        F.col("p.product_id").alias("product_id"),
        F.col("p.price").alias("price"),
        F.coalesce("p.state", "p.city").alias("location"),
        V.parse_ts("ingested_at").alias("ingested_at"),
    )


def plausible(when: Column) -> Column:
    """True for a time within the accepted dates, false for null; bounds every calendar."""
    first, last = F.lit(settings.EARLIEST_DATE).cast("date"), F.lit(settings.LATEST_DATE).cast("date")
    return F.coalesce(F.to_date(when).between(first, last), F.lit(False))


def valid_price() -> Column:
    """A readable price above 0. NaN, infinities and what money can't hold are not."""
    return V.is_money("price") & (F.col("price").try_cast("double") > 0)


def valid_freight() -> Column:
    """A readable freight of 0 or more."""
    return V.is_money("freight_value") & (F.col("freight_value").try_cast("double") >= 0)


def valid_order() -> Column:
    ids = F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
    return ids & valid_price() & valid_freight()


def state_code(column: str = "state") -> Column:
    """One of the known codes, or null."""
    code = F.upper(F.trim(F.col(column)))
    return F.when(code.isin(settings.STATE_CODES), code)


def total_value() -> Column:
    """Price and freight as they were written, added and then rounded to cents."""
    return V.cents(V.amount("price") + V.amount("freight_value"))


def silver_orders(raw: DataFrame) -> DataFrame:
    """Clean orders, not yet deduplicated; ``cdc_ts_ms`` is kept for that step.

    Amounts below a cent are rounded, never a reason to drop an order.
    """
    bought = F.timestamp_micros("purchase_timestamp")
    typed = raw.filter(valid_order() & plausible(bought)).withColumns(
        {
            "total_value": total_value(),
            "price": V.cents(V.amount("price")),
            "freight_value": V.cents(V.amount("freight_value")),
            "purchase_ts": bought,
            "state": state_code(),
            "category": F.trim("category"),
            "ingested_at": V.parse_ts("ingested_at"),
        }
    )
    with_region = joins.with_region(typed)
    return with_region.select(*schemas.SILVER["orders"].fieldNames(), "cdc_ts_ms")


def clean_rating(column: str = "rating") -> Column:
    """An integer from what is left of the digits, or null."""
    return F.regexp_replace(column, r"[^0-9\-]", "").try_cast("int")


def valid_rating(column: str = "rating") -> Column:
    return F.coalesce(clean_rating(column).between(1, 5), F.lit(False))


def valid_review_ids() -> Column:
    return V.present("review_id") & V.present("order_id")


def valid_message(column: str = "message") -> Column:
    return F.coalesce(F.length(F.trim(F.col(column))) > 0, F.lit(False))


def silver_reviews(raw: DataFrame) -> DataFrame:
    """Clean reviews, not yet deduplicated."""
    valid = raw.filter(valid_review_ids() & valid_rating())
    message = V.fix_mojibake(F.trim(V.review_message("raw_content")))
    return (
        V.once(valid, "message", message)
        .filter(valid_message())
        .select(
            "review_id",
            "order_id",
            "customer_id",
            clean_rating().alias("rating"),
            "title",
            "message",
            V.word_count("message").alias("text_length"),
            V.parse_ts("ingested_at").alias("ingested_at"),
        )
    )
