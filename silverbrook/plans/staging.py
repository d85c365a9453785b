"""Tables that are computed once and then read by many queries."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from silverbrook import settings
from silverbrook.operators.audit import RunLog
from silverbrook.streaming import folders, sinks


@dataclass(frozen=True)
class Step:
    """How a table is built, and the date column it is stored by, if any.

    ``slices`` is a key and the number of slices of its values to build the table in, and ``frees``
    names tables that nothing needs once this one is there.
    """

    build: Callable[[Tables], DataFrame]
    cluster: str | None = None
    partition: str | None = None
    check: Callable[[DataFrame], DataFrame] | None = None
    slices: tuple[str, int] | None = None
    frees: tuple[str, ...] = ()


class Tables:
    """Named tables under one folder; a table is built, with what it needs, at first use."""

    def __init__(self, spark: SparkSession, root: str, steps: dict[str, Step], run_id: str):
        self.spark = spark
        self.root = root
        self.steps = steps
        self.log = RunLog(run_id)
        self._schemas: dict[str, T.StructType] = {}
        self._lock = threading.RLock()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __call__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._schemas:
                self._build(name)
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))

    def build_all(self) -> list[str]:
        for name in self.steps:
            self(name)
        return list(self.steps)

    def _build(self, name: str) -> None:
        step = self.steps[name]
        made: list[DataFrame] = []

        def work() -> int:
            rows = folders.moved(step.build(self), settings.SMALL_TASKS)
            made.append(rows)
            if step.partition:
                records = sinks.overwrite_partitioned(rows, self.path(name), step.partition)
            elif step.cluster:
                records = sinks.overwrite_clustered(rows, self.path(name), step.cluster)
            elif step.slices:
                records = sinks.overwrite_sliced(rows, self.path(name), *step.slices)
            else:
                records = sinks.overwrite(rows, self.path(name))
            if step.check:
                step.check(self.spark.read.schema(rows.schema).parquet(self.path(name)))
            return records

        self.log.step(name, work)  # a failed check is a failed step, and the table stays unknown
        self._schemas[name] = made[0].schema
        for unneeded in step.frees:
            if self._schemas.pop(unneeded, None) is not None:
                folders.delete(self.spark, self.path(unneeded))
