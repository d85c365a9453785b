"""Review documents: header lines, a ``---`` line, an optional title line, free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook import settings
from silverbrook.functions import values as V
from silverbrook.sources.events import ingestion_time
from silverbrook.sources.tables import bounded


def review_files(
    spark: SparkSession, path: str, archive: str | None = None, files: int | None = None
) -> DataFrame:
    """New ``*.txt`` files as a stream, one row per file; the checkpoint remembers those seen.

    The files are tiny, so a micro-batch is bounded by their number: their names are what it costs the driver.
    With ``archive`` files that a finished batch has read move to that folder, so that the inbox that
    every trigger lists holds little more than new ones.
    """
    reader = bounded(spark.readStream, files or settings.INBOX_FILES)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return (
        reader
        .option("pathGlobFilter", "*.txt")
        .option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("file_path"))
    )


_BLANKS = " \t\n\r\f\x0b"


def _last(matches: Column) -> Column:
    """The last match without white space around it, or ``''``."""
    return F.coalesce(F.btrim(F.try_element_at(matches, F.lit(-1)), F.lit(_BLANKS)), F.lit(""))


def _header(part: Column, key: str) -> Column:
    pattern = F.lit(rf"(?m)^[^\S\n]*{key}[^\S\n]*: (.*)$")
    return _last(F.regexp_extract_all(part, pattern, F.lit(1)))


def parse_reviews(
    files: DataFrame, source: str = "minio", landed: Column | None = None
) -> DataFrame:
    """Header fields and title of each document; the whole text is kept.

    ``landed`` replaces the current time as landing time when documents are loaded again.
    """
    parts = V.once(files, "parts", F.split("value", r"(?m)^[^\S\n]*---[^\S\n]*$", 2))
    head = F.col("parts")[0]
    body = F.coalesce(F.try_element_at("parts", F.lit(2)), F.lit(""))
    titles = F.regexp_extract_all(body, F.lit(r"(?m)^(TITLE:.*)$"), F.lit(1))
    values = F.transform(titles, lambda line: F.replace(line, F.lit("TITLE: "), F.lit("")))
    fields = F.struct(
        _header(head, "REVIEW_ID").alias("review_id"),
        _header(head, "ORDER_ID").alias("order_id"),
        _header(head, "CUSTOMER_ID").alias("customer_id"),
        F.replace(_header(head, "RATING"), F.lit("/5"), F.lit("")).alias("rating"),
        _last(values).alias("title"),
    )
    return V.once(parts, "fields", fields).select(
        "file_path",
        "fields.*",
        F.col("value").alias("raw_content"),
        (ingestion_time() if landed is None else landed).alias("ingested_at"),
        F.lit(source).alias("source"),
    )


def read_review_files(spark: SparkSession, path: str, archive: str | None = None) -> DataFrame:
    return parse_reviews(review_files(spark, path, archive))
