"""The whole run: land, clean, star schema, views, models."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook import schemas
from silverbrook.operators import catalog_views, marts
from silverbrook.operators.audit import RunLog
from silverbrook.plans.published import Published
from silverbrook.plans.staging import Step, Tables
from silverbrook.plans.star import exact_steps, gold_steps
from silverbrook.sources import tables
from silverbrook.streaming import jobs, upsert

SILVER_JOBS = {
    "clickstream": jobs.silver_clickstream,
    "orders": jobs.silver_orders,
    "reviews": jobs.silver_reviews,
}


def silver_run(spark: SparkSession, lake: str, log: RunLog) -> None:
    """Drain bronze into the three silver tables."""
    for name, job in SILVER_JOBS.items():
        bronze, silver = f"{lake}/bronze/{name}", f"{lake}/silver/{name}"
        checkpoint = f"{lake}/checkpoints/silver_{name}"
        log.step(
            f"silver_{name}", lambda job=job, b=bronze, s=silver, c=checkpoint: job(spark, b, s, c)
        )


KEYED = {"orders": jobs.ORDERS, "reviews": jobs.REVIEWS}


def read_silver(spark: SparkSession, lake: str, name: str) -> DataFrame:
    path = f"{lake}/silver/{name}"
    if name in KEYED:
        return jobs.stored(spark, KEYED[name], path)
    try:
        return tables.table(spark, path, schemas.SILVER[name])
    except AnalysisException as error:
        if tables.is_missing(error):
            return spark.createDataFrame([], schemas.SILVER[name])
        raise


# -- gold --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Source:
    """The silver table of a fact table, the time that gives a row's day, and the key both share."""

    silver: str
    time: str
    key: str | None = None


FACTS = {
    "fact_sales": Source("orders", "purchase_ts", "order_id"),
    "fact_clickstream": Source("clickstream", "event_ts"),
    "fact_reviews": Source("reviews", "ingested_at", "review_id"),
}
UPTO = "upto"


def _file_time(rows: DataFrame) -> Column:
    return F.unix_micros(rows["_metadata.file_modification_time"])


def reached(spark: SparkSession, lake: str, name: str) -> int:
    """How far a silver table has come: its last batch, or the time of its last file."""
    path = f"{lake}/silver/{name}"
    if name in KEYED:
        return upsert.last_batch(spark, path)
    try:
        rows = tables.table(spark, path, schemas.SILVER[name])
    except AnalysisException as error:
        if tables.is_missing(error):
            return -1
        raise
    last = rows.agg(F.max(_file_time(rows))).first()[0]
    return -1 if last is None else last


def arrived(spark: SparkSession, lake: str, name: str, after: int) -> DataFrame:
    """Silver rows of later batches, or of later files; earlier files are not opened.

    One writer at a time: a file of a later run is later than all files of the run before.
    """
    path = f"{lake}/silver/{name}"
    if name in KEYED:
        return jobs.stored(spark, KEYED[name], path, since=after)
    rows = tables.table(spark, path, schemas.SILVER[name])
    return rows.where(_file_time(rows) > after)


class _Only:
    """The tables of a run, some of them cut down."""

    def __init__(self, tables_: Tables, cut: dict[str, DataFrame]):
        self.tables, self.cut = tables_, cut

    def __call__(self, name: str) -> DataFrame:
        return self.cut[name] if name in self.cut else self.tables(name)

    def __getattr__(self, name: str):
        return getattr(self.tables, name)


class Lake(Tables):
    """Gold tables of a lake, published under a database; silver is read where the streams wrote it.

    A fact table that is known to the catalog is updated: only days that rows have come for, or that
    a changed row has left, are computed and replaced.
    """

    def __init__(
        self, spark: SparkSession, lake: str, steps: dict[str, Step], run_id: str,
        database: str = "gold", incremental: bool = True,
    ):
        super().__init__(spark, f"{lake}/gold", steps, run_id)
        self.lake, self.incremental = lake, incremental
        self.published = Published(spark, database, self.root)
        self.days: dict[str, list[str]] = {}

    def __call__(self, name: str) -> DataFrame:
        if name.startswith("silver_"):
            return read_silver(self.spark, self.lake, name.removeprefix("silver_"))
        with self._lock:
            if name not in self._schemas:
                self._build(name)
        return self.published(name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/{self.log.run_id}"

    def _build(self, name: str) -> None:
        step = self.steps[name]

        def work() -> int:
            marks = self.published.marks(name) if self.incremental else {}
            if name in FACTS and step.partition and UPTO in marks:
                return self._update(name, step, int(marks[UPTO]))
            upto = {UPTO: reached(self.spark, self.lake, FACTS[name].silver)} if name in FACTS else {}
            return self.published.build(name, step.build(self), step.partition, step.check, upto)

        self.log.step(name, work)
        self._schemas[name] = self.published(name).schema

    def _update(self, name: str, step: Step, upto: int) -> int:
        source, day = FACTS[name], step.partition
        now = reached(self.spark, self.lake, source.silver)
        if now == upto:
            self.days[name] = []
            return 0
        rows = arrived(self.spark, self.lake, source.silver, upto)
        days = rows.select(F.to_date(source.time).alias(day))
        if source.key:
            left = self.published(name).select(source.key, day).join(rows.select(source.key), source.key, "left_semi")
            days = days.union(left.select(day))
        # At most one per day of the accepted years.
        days = days.where(F.col(day).isNotNull()).distinct()
        self.days[name] = sorted(str(r[0]) for r in days.collect())
        wanted = self.spark.createDataFrame([(d,) for d in self.days[name]], f"{day} string")
        wanted = wanted.select(F.col(day).cast("date").alias("of_day"))
        silver = self(f"silver_{source.silver}")
        silver = silver.join(F.broadcast(wanted), F.to_date(source.time) == F.col("of_day"), "left_semi")
        made = step.build(_Only(self, {f"silver_{source.silver}": silver}))
        return self.published.replace_days(name, made, day, self.days[name], {UPTO: str(now)})


def run(
    spark: SparkSession,
    lake: str,
    dim_date=None,
    by_day: bool = True,
    models: bool = True,
    as_of: dt.date | None = None,
    database: str = "gold",
    incremental: bool = True,
) -> Lake:
    """Silver, dimensions, facts, views, models; the audit rows are appended to the lake.

    Gold tables and views are in the catalog under ``database``. With ``incremental`` facts stored by
    day are updated where the catalog knows them; otherwise, and on the first run, they are built
    whole. The audit is written also when a step fails.
    """
    steps = gold_steps(dim_date, by_day, as_of) | exact_steps()
    if not models:
        steps = {name: step for name, step in steps.items() if not name.startswith("ml_")}
    gold = Lake(spark, lake, steps, uuid.uuid4().hex, database, incremental)
    try:
        silver_run(spark, lake, gold.log)
        gold.build_all()
        marts.register_views(spark, gold)
        catalog_views.create(spark, database)
        if models:
            gold("ml_model_runs").write.mode("append").parquet(f"{lake}/model_runs")
    finally:
        gold.log.append(spark, f"{lake}/audit")
    return gold
