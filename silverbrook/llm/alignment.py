"""Alignment of two tokenizers' ids over the same bytes, and counts of linked ids over a corpus.

Each tokenizer's cumulative token ends are the keys of a dictionary from end to index. The keys that
both dictionaries hold, sorted, are where tokens of both end; they slice the two id lists into groups,
and within a slice every pair of tokens whose bytes overlap is a link. Texts are first cut where both
tokenizers must end a token, so that pieces that recur are encoded, sliced and linked once per task;
they are remembered within a bound of bytes.

Spark counts in how many documents each pair of ids is linked and which partner of an id of the first
tokenizer is met most often. Pairs in a large share of all documents would be hot keys, so the counts
are joined in two ways: at most ``HEAVY`` pairs can hold a share of 1 / HEAVY of all (document, pair)
rows, and these are broadcast; links of the others are shuffled by pair, and none of those keys holds
more than that share. Sums return to the documents by a row number that is stored with them.

Defined results: a text that is null or empty, or that one of the tokenizers changes (such as a mark
that it takes for a space), has no tokens: zeros and an empty digest. Rows are documents of their own,
whether ids are null or repeated, and repeated rows count in the number of documents; partners with equal
counts are all best. A very long text is aligned whole, in pieces. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.llm.chunks import ByteLevel, Remembered
from silverbrook.llm.common import documents, field, stored

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
SHIFT = 24  # a pair of ids as one number: first << SHIFT | second
HEAVY = 1 << 17
SPACE = "▁"  # fixed value: the second vocabulary's mark of a space


class Part(NamedTuple):
    """An aligned chunk: tokens of both, groups and their ids as text, links as 64-bit numbers of pairs."""

    n_a: int
    n_b: int
    n_groups: int
    written: str
    links: bytes

    def groups(self) -> Iterator[tuple[list[int], list[int]]]:
        for group in self.written.split(";"):
            a, b = group.split("|")
            yield list(map(int, a.split(","))), list(map(int, b.split(",")))


UNEQUAL: tuple = ()  # a chunk whose bytes a tokenizer changes


def slices(a: list[int], b: list[int], sizes_a: list[int], sizes_b: list[int]) -> tuple[list[str], list[int]]:
    """The groups of two id lists as text, and the linked pairs as numbers, given each token's bytes."""
    at_a = dict(zip(accumulate(sizes_a), range(1, len(a) + 1)))
    at_b = dict(zip(accumulate(sizes_b), range(1, len(b) + 1)))
    groups, links, i, j = [], [], 0, 0
    for end in sorted(at_a.keys() & at_b.keys()):
        to_i, to_j = at_a[end], at_b[end]
        if to_i - i == to_j - j == 1:
            groups.append(f"{a[i]}|{b[j]}")
            links.append(a[i] << SHIFT | b[j])
        else:
            groups.append(f"{','.join(map(str, a[i:to_i]))}|{','.join(map(str, b[j:to_j]))}")
            left, right = sizes_a[i], sizes_b[j]
            while True:
                links.append(a[i] << SHIFT | b[j])
                if i + 1 == to_i and j + 1 == to_j:
                    break
                least = min(left, right)
                left, right = left - least, right - least
                if not left:
                    i, left = i + 1, sizes_a[i + 1]
                if not right:
                    j, right = j + 1, sizes_b[j + 1]
        i, j = to_i, to_j
    return groups, links


class Aligner:
    """Both tokenizers, one per Python worker."""

    def __init__(self, first: str = FIRST, second: str = SECOND) -> None:
        self.a = ByteLevel(first, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(second))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = self.a.bytes
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id(SPACE)
        self.parts = Remembered(self._align, lambda p: 200 + len(p.written) + len(p.links) if p else 0)

    def _align(self, keys: list[str]) -> Iterator[Part | tuple]:
        """All chunks begin with a space, which the second tokenizer puts before what it is given."""
        ids_b = self.b.encode(keys, num_threads=1)
        for key, found, b in zip(keys, self.a.of_chunks(keys), ids_b, strict=True):
            a, b = array("I", found).tolist(), b or [self.space]
            raw_a, raw_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
            if not b"".join(raw_a) == b"".join(raw_b) == f" {key}".encode():
                yield UNEQUAL
                continue
            groups, links = slices(a, b, list(map(len, raw_a)), list(map(len, raw_b)))
            yield Part(len(a), len(b), len(groups), ";".join(groups), array("q", links).tobytes())

    def aligned(self, texts: Iterable[str | None]) -> Iterator[list[Part]]:
        """The aligned chunks of each whole text; none if it is empty or a tokenizer changes it."""
        spaced = [" " + t if t else "" for t in texts]
        at, held = 0, []
        for i, parts in self.parts.of(spaced):
            while at < i:
                yield held if all(held) else []
                at, held = at + 1, []
            held += parts
        while at < len(spaced):
            yield held if all(held) else []
            at, held = at + 1, []

    def rows(self, texts: Iterable[str | None]) -> Iterator[tuple]:
        """Per text: tokens of both, groups, links, digest of the groups, distinct links and their times."""
        for parts in self.aligned(texts):
            if not parts:
                yield 0, 0, 0, 0, "", [], []
                continue
            links = np.frombuffer(b"".join([p.links for p in parts]), dtype=np.int64)
            pairs, times = np.unique(links, return_counts=True)
            written = hashlib.sha256()
            for k in range(0, len(parts), 1 << 16):
                written.update((";" * bool(k) + ";".join(p.written for p in parts[k : k + (1 << 16)])).encode())
            yield (sum(p.n_a for p in parts), sum(p.n_b for p in parts), sum(p.n_groups for p in parts),
                   len(links), written.hexdigest(), pairs, times)


_own: list[Aligner] = []


def aligner() -> Aligner:
    if not _own:
        _own.append(Aligner())
    return _own[0]


ROW = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string",
       "pairs": "array<long>", "times": "array<long>"}


def _rows(docs: DataFrame) -> DataFrame:
    """Per document the sizes, the digest of its groups, and its distinct links with their times."""

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in ROW.items()))
    def look(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(list(aligner().rows(batch)), columns=list(ROW))

    rows = docs.select(field("doc_id"), look(field("text")).alias("x")).select("doc_id", "x.*")
    return rows.withColumn("row", F.monotonically_increasing_id())


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, group, a, b, begin, end): every group of every text, its ids and bytes of space + text."""

    @F.pandas_udf("array<struct<a array<int>, b array<int>, begin long, end long>>")
    def look(texts: pd.Series) -> pd.Series:
        own, out = aligner(), []
        for parts in own.aligned(texts):
            found, begin = [], 0
            for a, b in (g for p in parts for g in p.groups()):
                end = begin + sum(len(own.bytes_a[i]) for i in a)
                found.append({"a": a, "b": b, "begin": begin, "end": end})
                begin = end
            out.append(found)
        return pd.Series(out)

    return docs.select(field("doc_id"), F.posexplode(look(field("text"))).alias("group", "x")).select(
        "doc_id", "group", "x.*")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold a pair linked, and whether no partner of its first id has more."""
    counts = stored(links.groupBy("pair").agg(F.count("*").alias("count")), "pair-counts")
    first = F.shiftright("pair", SHIFT)
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    return stored(counts.join(most, first == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best")), "pair-counts")


def align(docs: DataFrame) -> DataFrame:
    """A row per document: tokens, groups, links, and how common its links are in the corpus."""
    rows = stored(_rows(docs), "aligned")
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    counts = pair_counts(links)
    least = counts.agg((F.sum("count") / HEAVY).alias("x")).scalar()
    common = counts.where(F.col("count") >= least)
    rare = counts.where(F.col("count") < least)
    # At most HEAVY pairs can hold 1 / HEAVY of the sum each.
    met = links.join(F.broadcast(common.withColumnRenamed("pair", "of_pair")), F.col("pair") == F.col("of_pair"), "left")
    found = met.where("of_pair is not null").select("row", "times", "count", "best")
    others = met.where("of_pair is null").select("row", "pair", "times").join(rare, "pair").select(
        "row", "times", "count", "best")
    sums = found.unionByName(others).groupBy("row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    sums = sums.withColumnRenamed("row", "of_row")
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, F.col("row") == F.col("of_row"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir)).withColumn("doc_id", F.col("doc_id").cast("long"))
