"""What each step of a run did."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook import schemas


class RunLog:
    """Times steps and keeps one row per step."""

    def __init__(self, run_id: str):
        self.run_id = run_id
        self.rows: list[tuple] = []

    def step(self, name: str, work: Callable[[], int | None]) -> int | None:
        """Run a step that returns its number of records; a failure is recorded and raised."""
        start = time.monotonic()
        status, records = "FAILED", None
        try:
            records = work()
            status = "SUCCESS"
            return records
        finally:
            seconds = time.monotonic() - start
            now = dt.datetime.now(dt.timezone.utc)
            self.rows.append((self.run_id, name, status, records, seconds, now))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, schemas.AUDIT)

    def append(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)


def run_totals(audit: DataFrame) -> DataFrame:
    """Overall status, records and seconds per run."""
    all_good = F.count(F.when(F.col("status") != "SUCCESS", 1)) == 0
    return audit.groupBy("run_id").agg(
        F.when(all_good, "SUCCESS").otherwise("FAILED").alias("status"),
        F.count("*").alias("steps"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.sum("seconds").alias("seconds"),
    )
