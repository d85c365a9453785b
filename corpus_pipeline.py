"""From raw documents to token counts and digests: the training-data operators in a row.

Defined results: a null or empty text has no words, so the first stage rejects it. Of equal texts one
stays, the one with the least id, null ids last; rows that repeat wholly are such texts. A null source is
a source of its own to the mixer. A very long text goes through every stage whole. Columns that are not
needed come through all stages but the last, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverbrook.llm import byte_bpe, mixing, near_dedup, quality_rules, secret_scan
from silverbrook.llm.common import documents, stored

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_dedup", near_dedup.stage),
    ("secret_scan", secret_scan.stage),
    ("mixing", mixing.stage),
    ("byte_bpe", byte_bpe.stage),
]

# Robust estimates, sketches and merges of byte pairs are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage reads what its predecessor wrote."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
