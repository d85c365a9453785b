"""The ingestion and silver jobs: each drains its input once and returns the rows written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook import schemas, settings
from silverbrook.operators import cleaning
from silverbrook.operators.dedup import ORDER_LATEST, REVIEW_LATEST
from silverbrook.sources import changes, events, reviews, tables
from silverbrook.streaming import folders, sinks, upsert


def land_events(messages: DataFrame, path: str, checkpoint: str) -> int:
    """Event messages to bronze."""
    rows = folders.moved(events.exclude_event_types(events.read_events(messages)), settings.LANDING)
    return sinks.drain(rows.sparkSession, sinks.bronze_writer(rows, path, checkpoint))


def land_changes(messages: DataFrame, path: str, checkpoint: str) -> int:
    """Change messages to bronze."""
    rows = folders.moved(changes.read_cdc(messages), settings.LANDING)
    return sinks.drain(rows.sparkSession, sinks.bronze_writer(rows, path, checkpoint))


def land_reviews(spark: SparkSession, inbox: str, path: str, checkpoint: str, archive: str | None = None) -> int:
    """Review files to bronze, by day; with ``archive`` the inbox is emptied of what has landed."""
    of_files = folders.session_like(spark, settings.SMALL_FILES)
    rows = reviews.read_review_files(of_files, inbox, archive)
    return sinks.drain(of_files, sinks.bronze_writer(rows, path, checkpoint, hourly=False))


def silver_clickstream(spark: SparkSession, bronze: str, path: str, checkpoint: str) -> int:
    """Append clean events. Repeated event ids are kept."""
    try:
        rows = tables.read_bronze(spark, "clickstream", bronze)
    except AnalysisException as error:
        if tables.is_missing(error):
            return 0
        raise
    return sinks.drain(spark, sinks.append_writer(cleaning.silver_clickstream(rows), path, checkpoint))


@dataclass(frozen=True)
class Keyed:
    """A silver table with one row per key."""

    name: str
    key: str
    clean: Callable[[DataFrame], DataFrame]
    newest: tuple[str, ...]

    def order(self) -> list[Column]:
        """Columns that are larger in newer rows."""
        return [F.col(name) for name in self.newest]


ORDERS = Keyed("orders", "order_id", cleaning.silver_orders, tuple(ORDER_LATEST))
REVIEWS = Keyed("reviews", "review_id", cleaning.silver_reviews, tuple(REVIEW_LATEST))


def _upsert_job(
    spark: SparkSession, what: Keyed, bronze: str, path: str, checkpoint: str,
    order: list[Column] | None, mode: str, files: int | None,
) -> int:
    of_rows = folders.session_like(spark, settings.SMALL_TASKS)
    try:
        raw = tables.read_bronze(of_rows, what.name, bronze, files=files)
    except AnalysisException as error:
        if tables.is_missing(error):
            return 0
        raise
    order, counts = order or what.order(), {}
    rows = what.clean(raw).select(schemas.VERSIONED[what.name].fieldNames())
    sinks.drain(of_rows, upsert.writer(rows, path, checkpoint, what.key, order, counts, mode))
    upsert.compact(spark, path, schemas.VERSIONED[what.name], what.key, order, mode)
    return sum(counts.values())


def silver_orders(
    spark: SparkSession, bronze: str, path: str, checkpoint: str,
    order: list[Column] | None = None, mode: str = "latest", files: int | None = None,
) -> int:
    """Keep the latest change of every order, whatever batches its changes come in.

    ``mode="first"`` keeps the first batch's row instead. Returns the rows its batches wrote.
    """
    return _upsert_job(spark, ORDERS, bronze, path, checkpoint, order, mode, files)


def silver_reviews(
    spark: SparkSession, bronze: str, path: str, checkpoint: str,
    order: list[Column] | None = None, mode: str = "latest", files: int | None = None,
) -> int:
    """Keep the latest version of every review; see :func:`silver_orders`."""
    return _upsert_job(spark, REVIEWS, bronze, path, checkpoint, order, mode, files)


def stored(
    spark: SparkSession, what: Keyed, path: str, order: list[Column] | None = None, mode: str = "latest",
    since: int | None = None,
) -> DataFrame:
    """The silver table as it stands, one row per key; ``since`` keeps rows of later batches than that."""
    rows = upsert.current(spark, path, schemas.VERSIONED[what.name], what.key, order or what.order(), mode)
    if since is not None:
        rows = rows.where(F.col(upsert.SEEN_IN) > since)
    return rows.select(schemas.SILVER[what.name].fieldNames())
