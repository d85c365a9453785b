"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook.session import shared_dir

# Fixed value: a word is a run of anything but these six separators.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the folder all executors share and read back.

    Later steps read the table, so a lost executor costs a read and row numbers stay fixed.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def field(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame) -> DataFrame:
    """One struct column ``row`` with all columns, so that no added column can clash."""
    return docs.select(F.struct(*[field(c) for c in docs.columns]).alias("row"))


def unpacked(frame: DataFrame) -> DataFrame:
    return frame.select("row.*")


def with_text(row: str, text: Column, columns: list[str]) -> Column:
    """The struct with another text; ``n_chars`` follows, where there is one."""
    out = F.col(row).withField("text", text)
    return out.withField("n_chars", F.length(text).cast("long")) if "n_chars" in columns else out


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, also where lambdas use it often."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def record(**fields: T.DataType) -> T.StructType:
    """A struct type, also without a running session, as module-level functions need it."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def ordered(rows: DataFrame, group: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows stored in order with ``at_``, and the runs that tell their places in their group.

    Rows are dealt by ranges of (group, order), so no group is one task. A run is the part of a
    group in one range: ``part_``, its least ``at_`` as ``first_``, the rows of the group ``before_``
    it and in ``total_``. The place of a row is ``at_ - first_ + before_``. A group has at most as
    many runs as there are ranges.
    """
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    laid = stored(dealt.withColumn("at_", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("part_", F.shiftright("at_", 33))
    runs = laid.groupBy(*group, "part_").agg(F.min("at_").alias("first_"), F.count("*").alias("rows_"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    return laid, runs.select(
        *group, "part_", "first_", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("before_"),
        F.sum("rows_").over(whole).alias("total_"))


def placed(laid: DataFrame, runs: DataFrame, group: list[str]) -> DataFrame:
    """The rows of ``ordered`` with ``pos_`` (from 0) and whatever else the runs hold."""
    keys = [*group, "part_"]
    of = runs.withColumnsRenamed({c: f"of_{c}" for c in keys})
    same = [laid[c].eqNullSafe(of[f"of_{c}"]) for c in keys]
    return laid.join(of, same).withColumn("pos_", F.expr("at_ - first_ + before_")).drop(
        *(f"of_{c}" for c in keys), "part_", "at_", "first_", "before_")
