"""Token counts by separator scan over flat, unindexed token files.

A token file is nothing but 16-bit token ids, each document followed by the separator. Files are
read in blocks that know neither where documents begin nor how many there are. Each block is
searched for the separator with one vector comparison; a prefix scan over the blocks of a file
(tokens so far, separators so far, last separator so far) then stitches documents that cross block
borders. Only positions of separators are shuffled, never tokens, and a document may span any
number of blocks.

``flatten`` writes documents to such blocks and notes which ids end in which block, beside the
tokens, so that counts can be told by id. Blocks of files from elsewhere come from ``blocks_of``.

Defined results: a null or empty text has 0 tokens. Tokens after the last separator of a file are
one more document. Null ids and repeated rows are documents of their own. Empty tables and files
give no documents.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import documents, stored

VOCABULARY = "byte_bpe_50k.tiktoken"
SEPARATOR = 50256  # free in the vocabulary
BLOCK_TOKENS = 1 << 17
_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(name: str = VOCABULARY) -> tiktoken.Encoding:
    """One tokenizer per Python worker."""
    if name not in _encodings:
        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[name] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[name]


def flatten(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, data, doc_ids): the token file of each partition, cut into blocks."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, block, size = TaskContext.get().partitionId(), 0, 2 * block_tokens
        held, ids, encode = bytearray(), [], encoding().encode_ordinary

        def full(data: bytes, ids: list) -> pd.DataFrame:
            return pd.DataFrame({"file": [file], "block": [block], "data": [data], "doc_ids": [ids]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                held += np.array([*encode(text or ""), SEPARATOR], dtype="<u2").tobytes()
                while len(held) > size:
                    yield full(bytes(held[:size]), ids)
                    held, ids, block = held[size:], [], block + 1
                ids.append(None if doc_id is None else int(doc_id))
        if held:
            yield full(bytes(held), ids)

    # As text, since pandas would turn ids with nulls among them into floating point.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(write, "file long, block long, data binary, doc_ids array<long>")


def blocks_of(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of token files from any store that Spark reads."""
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    size = 2 * block_tokens
    cut = files.select("path", "content", F.explode(F.expr(f"sequence(0L, (length - 1) div {size})")).alias("block"))
    return cut.select(F.col("path").alias("file"), "block",
                      F.expr(f"substring(content, int(block * {size} + 1), {size})").alias("data"))


def scan(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """Replaces ``data`` by its number of tokens ``n`` and the places of separators in it."""
    others = [c for c in blocks.columns if c != "data"]

    @F.pandas_udf("n long, ends array<long>")
    def look(data: pd.Series) -> pd.DataFrame:
        tokens = [np.frombuffer(raw, dtype="<u2") for raw in data]
        return pd.DataFrame({"n": [len(t) for t in tokens], "ends": [np.flatnonzero(t == separator) for t in tokens]})

    return blocks.select(*others, look("data").alias("s")).select(*others, "s.*")


def lengths(scanned: DataFrame) -> DataFrame:
    """(file, ordinal, n_tokens, and doc_id if noted) per document, stitched across blocks."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    final = Window.partitionBy("file").orderBy(F.desc("block"))
    noted = "doc_ids" in scanned.columns
    rows = scanned.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    last = F.when(F.size("ends") > 0, F.col("start") + F.element_at("ends", -1))
    rows = rows.withColumns({
        "last": last,
        "first": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
        "is_last": F.row_number().over(final) == 1,
    }).withColumn("previous", F.coalesce(F.last("last", True).over(before), F.lit(-1).cast("long")))
    end = F.col("start") + F.col("n")
    tail = F.when(F.col("is_last") & (end - 1 > F.coalesce("last", "previous")), F.array(end)).otherwise(
        F.array().cast("array<long>"))
    # Document i of a block lies between the separators before and at its end.
    places = F.concat(F.transform("ends", lambda e: e + F.col("start")), tail)
    rows = rows.withColumn("places", places)
    begins = F.concat(F.array("previous"), F.slice("places", 1, F.greatest(F.size("places") - 1, F.lit(0))))
    sizes = F.zip_with("places", begins, lambda e, b: e - b - 1)
    zipped = F.arrays_zip(sizes.alias("s"), F.col("doc_ids").alias("d")) if noted else F.arrays_zip(sizes.alias("s"))
    rows = rows.where(F.size("places") > 0).select("file", "first", F.posexplode(zipped).alias("i", "x"))
    ordinal = (F.col("first") + F.col("i")).alias("ordinal")
    out = ["file", ordinal, F.col("x.s").alias("n_tokens")]
    return rows.select(*out, F.col("x.d").alias("doc_id")) if noted else rows.select(*out)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = stored(flatten(documents(spark, sf_dir)), "tokens")
    return lengths(scan(blocks)).select("doc_id", "n_tokens")
