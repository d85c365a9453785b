"""Event messages: JSON text, one event per message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook import schemas, settings
from silverbrook.functions import values as V
from silverbrook.sources.tables import bounded

ISO_WITH_OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def ingestion_time() -> Column:
    """Landing time as ISO text with offset, as bronze stores it."""
    return F.date_format(F.current_timestamp(), ISO_WITH_OFFSET)


def message_stream(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """A topic from its first offset as one string column ``value`` (needs the Kafka connector)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def message_files(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """Files with one message per line as a stream with a string column ``value``."""
    return bounded(spark.readStream, files).text(path)


def read_events(messages: DataFrame, source: str = "kafka") -> DataFrame:
    """Messages to bronze columns; a nested ``properties`` object stays JSON text."""
    parsed = V.once(messages, "e", F.from_json("value", schemas.EVENT_MESSAGE))
    return parsed.select(
        "e.*", ingestion_time().alias("ingested_at"), F.lit(source).alias("source")
    )


def exclude_event_types(events: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Drop event types that are delivered elsewhere; events without a type stay."""
    kept = ~F.col("event_type").isin(settings.NOT_STREAMED if types is None else types)
    return events.filter(F.coalesce(kept, F.lit(True)))
