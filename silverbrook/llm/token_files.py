"""Token files of directly addressable codes: any token is read without decoding a block.

A file holds whole documents in order. Their ids are split into chunks of eight bits: level 0 has the
low chunk of every id and a bitmap that says which ids go on, level 1 the next chunk of just those,
and so on. A rank directory with the number of set bits before every 512 gives the place on the next
level, so a token, or the run of a document, is a few short reads at computed places. Files are
little-endian: magic, version, levels, documents, tokens and the sections' places; then, per
document, its id, whether it has one, and the end of its tokens; then, per level, chunks, bitmap and
directory.

Documents are dealt by ranges of ``doc_id``; the tasks that sort them encode and write them, through any
file system that Arrow reaches. Chunks of text that recur are encoded once per worker and remembered
within a bound of bytes. A file's name is new on each attempt, and only files in the manifest, which
Spark commits, count: a lost executor leaves nothing that is read. The manifest tells each file's first token and document by sums over files and over
ranges, so no sum runs over all files at once.

Defined results: a null or empty text has just the end id. Null ids come first, equal ids are ordered
by a hash of their text and then as they were read, and repeated rows are documents of their own. A
very long text makes a long file, as documents are whole. Strings of special tokens are their ids, as
the library does by default. Other columns are not read. An empty table gives no files and no rows.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverbrook.llm import chunks
from silverbrook.llm.chunks import ByteLevel, Remembered
from silverbrook.llm.common import documents, field, stored
from silverbrook.session import shared_dir

VOCABULARY = "byte_bpe_50k.json"
END = 0  # the id after each document
FILE_TOKENS = 1 << 22
FILE_DOCS = 1 << 17
MOST_TASKS = 20_000
GRID = 1 << 22  # tokens of a cell that positions and files are joined by

MAGIC, VERSION = b"DACT", 1
HEAD = struct.Struct("<4sHHQQ")
PLACE = struct.Struct("<QQ")
BITS, RANK_BITS = 8, 512
Reader = Callable[[int, int], bytes]


class Encoder(NamedTuple):
    """Ids of chunks as little-endian 32-bit integers: of those cut by bytes, and of the others by their keys."""

    vocabulary: ByteLevel
    parts: Remembered
    others: Remembered


_encoders: dict[str, Encoder] = {}


def encoder(name: str = VOCABULARY) -> Encoder:
    """One per Python worker."""
    if name not in _encoders:
        own = ByteLevel(name)
        _encoders[name] = Encoder(
            own, Remembered(own.of_parts, len), Remembered(own.of_chunks, len, limit=32 << 20, breaks=own.breaks))
    return _encoders[name]


def encoded(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Ids of each whole text, with the end id."""
    group, held = [], 0
    for text in texts:
        group.append(text or "")
        held += len(group[-1])
        if held >= chunks.WIDE:
            yield from _encoded(group)
            group, held = [], 0
    if group:
        yield from _encoded(group)


def _encoded(texts: list[str]) -> Iterator[np.ndarray]:
    """Distinct chunks of all texts are looked up once; very long texts and unusual ones go by themselves."""
    vocabulary, known, others = encoder()
    apart = np.array([not vocabulary.even or len(t) > chunks.GROUP for t in texts], dtype=bool)
    found, counts, far = chunks.cut([b"" if a else t.encode() for t, a in zip(texts, apart, strict=True)], vocabulary.kinds)
    apart |= far
    distinct = found.dictionary_encode()
    numbers = distinct.indices.to_numpy()
    made = known.each(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
    sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // 4
    begins = np.cumsum(sizes) - sizes
    taken = sizes[numbers]
    ends = np.cumsum(taken)
    ids = np.frombuffer(b"".join(made), dtype="<u4")[
        np.repeat(begins[numbers] - ends + taken, taken) + np.arange(taken.sum())]
    last = np.append(0, ends)[np.cumsum(counts)]
    for text, alone, begin, end in zip(texts, apart, np.append(0, last[:-1]), last, strict=True):
        if alone:
            parts = [part for _, some in others.of([text]) for part in some]
            yield np.frombuffer(b"".join([*parts, END.to_bytes(4, "little")]), dtype="<u4")
        else:
            yield np.append(ids[begin:end], np.uint32(END))


def pack(ids: np.ndarray, ends: np.ndarray, doc_ids: list[int | None]) -> bytes:
    """A file of documents whose ids follow each other, each up to its end."""
    known = np.array([d is not None for d in doc_ids], dtype=bool)
    named = np.array([d or 0 for d in doc_ids], dtype="<i8")
    sections = [named.tobytes(), np.packbits(known, bitorder="little").tobytes(), ends.astype("<u8").tobytes()]
    rest, levels = ids.astype(np.uint32), 0
    while levels == 0 or len(rest):
        higher = rest >> BITS
        more = higher > 0
        bitmap = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, dtype=bool)
        padded[: len(more)] = more
        counts = padded.reshape(-1, RANK_BITS).sum(axis=1)
        ranks = np.concatenate(([0], np.cumsum(counts))).astype("<u8")
        sections += [(rest & (1 << BITS) - 1).astype(np.uint8).tobytes(), bitmap.tobytes(), ranks.tobytes()]
        rest, levels = higher[more], levels + 1
    out = io.BytesIO()
    out.write(HEAD.pack(MAGIC, VERSION, levels, len(ends), len(ids)))
    at = HEAD.size + PLACE.size * len(sections)
    for section in sections:
        out.write(PLACE.pack(at, len(section)))
        at += len(section)
    out.writelines(sections)
    return out.getvalue()


class TokenFile:
    """A file by a reader of (offset, length): only the head is read ahead."""

    def __init__(self, read: Reader) -> None:
        self.read = read
        magic, version, self.levels, self.docs, self.tokens = HEAD.unpack(read(0, HEAD.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        table = read(HEAD.size, PLACE.size * (3 + 3 * self.levels))
        self.places = list(PLACE.iter_unpack(table))

    def _part(self, section: int, kind: str, begin: int, end: int) -> np.ndarray:
        """Items [begin, end) of a section."""
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.read(self.places[section][0] + begin * size, (end - begin) * size), dtype=kind)

    def _bits(self, section: int, begin: int, end: int) -> np.ndarray:
        held = self._part(section, "u1", begin >> 3, (end + 7) >> 3)
        return np.unpackbits(held, bitorder="little")[begin & 7 : (begin & 7) + end - begin]

    def slice(self, begin: int, end: int) -> np.ndarray:
        """Tokens [begin, end), by rank from level to level."""
        out = np.zeros(end - begin, dtype=np.uint32)
        where = np.arange(end - begin)
        for level in range(self.levels):
            if begin >= end:
                break
            chunk, bitmap, ranks = (3 + 3 * level + i for i in range(3))
            out[where] |= self._part(chunk, "u1", begin, end).astype(np.uint32) << np.uint32(BITS * level)
            start = begin // RANK_BITS * RANK_BITS
            bits = self._bits(bitmap, start, end)
            before = int(bits[: begin - start].sum())
            more = np.flatnonzero(bits[begin - start :])
            begin = int(self._part(ranks, "<u8", start // RANK_BITS, start // RANK_BITS + 1)[0]) + before
            end = begin + len(more)
            where = where[more]
        return out

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])

    def ends(self) -> np.ndarray:
        return self._part(2, "<u8", 0, self.docs).astype(np.int64)

    def doc_ids(self) -> list[int | None]:
        known = self._bits(1, 0, self.docs)
        return [i if k else None for i, k in zip(self._part(0, "<i8", 0, self.docs).tolist(), known, strict=True)]


def _inside(raw: bytes) -> Reader:
    return lambda at, n: raw[at : at + n]


def write(docs: DataFrame, folder: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes files in ascending ``doc_id``; returns the stored manifest.

    The manifest has (file, part, number, docs, tokens, start): ``start`` counts the tokens before.
    """

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        store, root = fs.FileSystem.from_uri(folder)
        ids, names, held = [], [], 0

        def full() -> pd.DataFrame:
            name = f"{part:08d}-{number:06d}-{uuid.uuid4().hex}.dac"
            store.create_dir(root, recursive=True)
            raw = pack(np.concatenate(ids), np.cumsum([len(x) for x in ids]), names)
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(raw)
            return pd.DataFrame({"file": [name], "part": [part], "number": [number], "docs": [len(ids)], "tokens": [held]})

        for batch in batches:
            for doc_id, own in zip(batch["doc_id"], encoded(batch["text"].tolist()), strict=True):
                ids.append(own)
                names.append(None if doc_id is None else int(doc_id))
                held += len(own)
                if held >= file_tokens or len(ids) >= FILE_DOCS:
                    yield full()
                    ids, names, held, number = [], [], 0, number + 1
        if ids:
            yield full()

    rows = docs.select(field("doc_id"), field("text"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", F.xxhash64("text"), "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    files = stored(rows.mapInPandas(save, "file string, part long, number long, docs long, tokens long"), "token-manifest")
    parts = files.groupBy("part").agg(F.sum("tokens").alias("of_part"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("same"), F.coalesce(F.sum("of_part").over(so_far), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return stored(files.join(parts, files["part"] == parts["same"]).select(
        F.concat(F.lit(folder.rstrip("/") + "/"), "file").alias("file"), "part", "number", "docs", "tokens",
        (F.col("before") + F.col("inner")).alias("start")), "token-manifest")


def per_task(files: DataFrame) -> DataFrame:
    """One file a task, up to MOST_TASKS tasks."""
    return files.repartition(min(max(files.count(), 1), MOST_TASKS))


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of a manifest."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, start in zip(batch["file"], batch["start"], strict=True):
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as raw:
                    held = TokenFile(_inside(raw.read()))
                ends, ids = held.ends(), held.slice(0, held.tokens).astype("<u4")
                begins = np.append(0, ends[:-1])
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pd.DataFrame({
                    "doc_id": pd.Series(held.doc_ids(), dtype=object), "start": start + begins,
                    "n_tokens": ends - begins, "ids_crc32": crcs})

    return per_task(files).mapInPandas(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(files: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token) for token numbers over all files; a few bytes of a file are read for each.

    Numbers are joined to files by cells of GRID tokens and need not be gathered by file. Numbers
    that are null or beyond the tokens give no row; repeated ones give a row each.
    """
    first, last = F.col("start"), F.col("start") + F.col("tokens") - 1
    cells = files.where("tokens > 0").select(
        "file", first.alias("first"), last.alias("last"),
        F.explode(F.sequence(F.floor(first / GRID), F.floor(last / GRID))).alias("cell"))
    wanted = positions.select(F.col("position").cast("long").alias("position")).withColumn(
        "of_cell", F.floor(F.col("position") / GRID))
    met = wanted.join(cells, F.col("of_cell") == F.col("cell")).where("position between first and last").select(
        "file", "position", (F.col("position") - F.col("first")).alias("at"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, some in batch.groupby("file"):
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as raw:
                    held = TokenFile(lambda at, n, raw=raw: raw.read_at(n, at))
                    yield pd.DataFrame({"position": some["position"], "token": [held[i] for i in some["at"]]})

    return met.mapInPandas(pick, "position long, token long")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/llm/token-files-{uuid.uuid4().hex}"
    return read(write(documents(spark, sf_dir), folder))
