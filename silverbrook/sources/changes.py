"""Change records of the order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook import schemas, settings
from silverbrook.functions import values as V
from silverbrook.sources.events import ingestion_time

# The row is read as a map, so that an empty object can be told from a row of nulls.
_BODY = [
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("after", T.MapType(T.StringType(), T.StringType())),
]
_ENVELOPE = T.StructType([T.StructField("payload", T.StructType(_BODY)), *_BODY])


def read_cdc(messages: DataFrame, source: str = "debezium") -> DataFrame:
    """Current rows out of change envelopes, with or without an outer ``payload``.

    Deletes and messages without a current row are dropped.
    """
    parsed = V.once(messages, "m", F.from_json("value", _ENVELOPE))
    bare = F.struct("m.op", "m.ts_ms", "m.after")
    body = parsed.select(F.coalesce("m.payload", bare).alias("b")).filter(
        F.col("b.op").isin(settings.CHANGE_OPS) & (F.size("b.after") > 0)
    )
    fields = [
        F.col("b.after")[field.name].try_cast(field.dataType).alias(field.name)
        for field in schemas.CHANGE_ROW
    ]
    return body.select(
        *fields,
        F.col("b.op").alias("cdc_operation"),
        F.col("b.ts_ms").alias("cdc_ts_ms"),
        ingestion_time().alias("ingested_at"),
        F.lit(source).alias("source"),
    )
