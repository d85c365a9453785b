"""Rejects and repairs per cleaning rule, one pass over each raw table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.functions import values as V
from silverbrook.operators import cleaning as C


def click_rules() -> dict[str, Column]:
    return {
        "missing_event_id": F.col("event_id").isNull(),
        "missing_session": ~V.present("session_id"),
        "missing_event_type": ~V.present("event_type"),
        "unknown_device": C.known_device() == settings.UNKNOWN_DEVICE,
        "bad_timestamp": V.parse_ts("timestamp").isNull(),
        "implausible_timestamp": V.parse_ts("timestamp").isNotNull() & ~C.plausible(V.parse_ts("timestamp")),
    }


def order_rules() -> dict[str, Column]:
    return {
        "missing_id": F.col("order_id").isNull() | F.col("customer_id").isNull(),
        "bad_price": ~C.valid_price(),
        "bad_freight": ~C.valid_freight(),
        "bad_state": C.state_code().isNull(),
        "repaired_state": F.coalesce(C.state_code() != F.col("state"), F.lit(False)),
        "padded_category": F.coalesce(F.trim("category") != F.col("category"), F.lit(False)),
        "missing_purchase_time": F.col("purchase_timestamp").isNull(),
        "implausible_purchase_time": F.col("purchase_timestamp").isNotNull()
        & ~C.plausible(F.timestamp_micros("purchase_timestamp")),
    }


def review_rules(message: str = "message") -> dict[str, Column]:
    text = F.col(message)
    return {
        "missing_id": ~C.valid_review_ids(),
        "bad_rating": ~C.valid_rating(),
        "empty_message": F.coalesce(text == "", F.lit(True)),
        "damaged_encoding": V.fix_mojibake(text) != text,
    }


def report(raw: DataFrame, source: str, rules: dict[str, Column], key: str) -> DataFrame:
    """Rows checked and rows hit per rule, plus rows beyond the first of their key."""
    hits = {name: F.count(F.when(hit, 1)) for name, hit in rules.items()}
    hits["duplicate_key"] = F.count(key) - F.count_distinct(key)
    counts = raw.agg(
        F.count("*").alias("rows_checked"), *(n.alias(name) for name, n in hits.items())
    )
    return counts.unpivot("rows_checked", list(hits), "rule", "rows_hit").select(
        F.lit(source).alias("source"), "rule", "rows_checked", "rows_hit"
    )


def quality_report(clicks: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    message = F.trim(V.review_message("raw_content"))
    read_reviews = V.once(reviews, "message", message)
    parts = [
        report(clicks, "clickstream", click_rules(), "event_id"),
        report(orders, "orders", order_rules(), "order_id"),
        report(read_reviews, "reviews", review_rules(), "review_id"),
    ]
    return reduce(DataFrame.unionByName, parts)
