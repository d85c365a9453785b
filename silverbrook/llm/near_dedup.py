"""MinHash near-dedup by Order MinHash, verified by banded alignment.

Two documents are linked when one can be turned into the other by edits of at most a fifth of the
words of the longer one (similarity 0.8). A class is what links connect.

Sketches: the five-word shingles of a text are labelled with their occurrence number, so that
repeats count. Each of ``SKETCHES`` hash functions picks the ``PICKED`` smallest labelled shingles
and keeps them in text order; the hash of that sequence is the bucket. With a shingle similarity
of 0.8 two texts meet in a given bucket with probability 0.5 and miss all twelve with 2e-4; at 0.9
the miss is below 1e-6.

Buckets: equal texts are one member first. Every member of a bucket is compared with the bucket's
smallest member, so a group of copies of any size gives as many pairs as members; members unlike
that leader are compared with a second leader, and with a leader by a finer sketch of twice as many
shingles. What is linked so far is joined to classes. Then all pairs of a bucket whose members are
still of different classes are tried, so every link between two texts that share a bucket is in the
result. Buckets are divided into bands of length and those into blocks of ``BLOCK`` words, and pairs
of blocks are spread over tasks. Only bounds leave pairs out there: lengths that differ by more than a
fifth, and fewer common words or word pairs than so many edits leave (an edit changes one word and
two word pairs at most). This part grows with the square of the unlike texts of a bucket, a product of bit matrices
for most pairs. Candidate pairs carry 128-bit text keys; only their own texts are looked up.

Defined results: a null text counts as empty; texts without words are equal only if they are the
same text. Texts of fewer than five words are one shingle. ``class_id`` is the smallest id of the
class (null if all its ids are null). Repeated rows are copies of each other. In the stage one row
of each class stays: the smallest id, ties by place in the table. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook.llm.common import documents, field, packed, record, stored, unpacked

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 12
PICKED = 3
FINER = 6
BAND = 1.26  # ratio of lengths; more than 1.25, so like texts are of one band or of adjacent ones
BLOCK = 1 << 18  # words of a block
TILE = 1 << 22  # numbers of a tile of a bit matrix
SIGNED = ["member", "root", "words", "bits", "singles"]  # of each row of a block
SEED = 7

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        both = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        if len(_powers) > 2:
            _powers.clear()
        _powers[size] = both[0], both[1]
    return _powers[size]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segments(raw: bytes) -> Iterator[bytes]:
    """Pieces of about a megabyte that end between words."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + _SEGMENT)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word, from one running polynomial over the bytes."""
    out = []
    for raw in _segments((text or "").encode()):
        data = np.frombuffer(raw, dtype=np.uint8)
        gap = np.concatenate(([True], _SPACE[data], [True]))
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        start, end = edge[::2], edge[1::2]
        power, inverse = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        out.append(_mixed((sums[end] - sums[start]) * inverse[start]))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def labelled_shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hash of each shingle together with how often it has occurred before."""
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    shingles = np.zeros(n - width + 1, dtype=np.uint64)
    for j in range(width):
        shingles = shingles * _BASE + words[j : n - width + 1 + j]
    shingles = _mixed(shingles)
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    same = ranked[1:] == ranked[:-1]
    if same.any():
        first = np.concatenate(([True], ~same))
        number = np.arange(len(ranked)) - np.maximum.accumulate(np.where(first, np.arange(len(ranked)), 0))
        # A first occurrence keeps its hash, as it has in a text without repeats.
        shingles[order] = np.where(number > 0, _mixed(ranked + number.astype(np.uint64) * _BASE), ranked)
    return shingles


_rng = np.random.default_rng(SEED)
_XOR = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)[:, None]
_ODD = (_rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1))[:, None]


def _ordered_key(shingles: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One key per row of places: the shingles there, in text order."""
    key = np.full(len(places), len(places[0]), dtype=np.uint64)
    for column in np.sort(places, axis=1).T:
        key = _mixed(key * _BASE + shingles[column])
    return key


def sketch(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of a text, coarse and finer; none without words."""
    shingles = labelled_shingles(word_hashes(text))
    n = len(shingles)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    most, keys = min(FINER, n), []
    step = max(1, (1 << 20) // n)
    for at in range(0, SKETCHES, step):
        hashed = (shingles[None, :] ^ _XOR[at : at + step]) * _ODD[at : at + step]
        near = np.argpartition(hashed, most - 1, axis=1)[:, :most]
        rank = np.argsort(np.take_along_axis(hashed, near, axis=1), axis=1)
        near = np.take_along_axis(near, rank, axis=1)
        keys.append((_ordered_key(shingles, near[:, :PICKED]), _ordered_key(shingles, near)))
    coarse, fine = (np.concatenate(k).view(np.int64) for k in zip(*keys, strict=True))
    return coarse, fine


@F.pandas_udf(record(coarse=T.ArrayType(T.LongType()), fine=T.ArrayType(T.LongType())))
def sketches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([sketch(t) for t in batch], columns=["coarse", "fine"])


def banded_distance(a: list, b: list, limit: int) -> int:
    """Edit distance of two sequences, or limit + 1 if it is larger.

    Only the diagonals within ``limit`` of the main one are computed. One integer holds the
    vertical differences of the band's cells in a column, and moves down with the diagonal.
    """
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m - n > limit:
        return limit + 1
    if not n:
        return m
    limit = min(limit, m)
    width = 2 * limit + 2
    every, edge = (1 << width) - 1, 1 << (width - 1)
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    up, down = every ^ ((1 << (width - limit - 1)) - 1), 0
    score, shift = limit, limit + 1 - width
    most = limit + n - (m - limit)
    corner = edge >> 1
    for j, x in enumerate(b):
        match = where.get(x, 0)
        match = (match >> shift if shift >= 0 else match << -shift) & every
        diagonal = ((((match & up) + up) ^ up) | match | down) & every
        right = down | (every & ~(diagonal | up))
        left = diagonal & up
        if j < m - limit:  # the lowest cell is still above the last row: follow the diagonal
            score += not diagonal & edge
        else:  # then along the last row
            score += bool(right & corner) - bool(left & corner)
            corner >>= 1
        if score > most:
            return limit + 1
        moved = diagonal >> 1
        up = left | (every & ~(moved | right))
        down = moved & right
        shift += 1
    return min(score, limit + 1)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """1 - edits / longer length by banded alignment; 0 where it is below ``least``."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    limit = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return 0.0
    short = min(len(a), len(b))
    unlike = np.flatnonzero(a[:short] != b[:short])
    head = int(unlike[0]) if len(unlike) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    unlike = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(unlike[0]) if len(unlike) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    # Words that the other side lacks need an edit each.
    (ka, ca), (kb, cb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if max(len(a), len(b)) - int(np.minimum(ca[ia], cb[ib]).sum()) > limit:
        return 0.0
    # A narrow band first: most links are a few edits.
    narrow = min(limit, 16)
    edits = banded_distance(a.tolist(), b.tolist(), narrow)
    if edits > narrow and narrow < limit:
        edits = banded_distance(a.tolist(), b.tolist(), limit)
    return 0.0 if edits > limit else 1 - edits / longer


@F.pandas_udf(T.DoubleType())
def alike(a: pd.Series, b: pd.Series) -> pd.Series:
    last, words = None, np.zeros(0, dtype=np.uint64)
    out = []
    for x, y in zip(a, b, strict=True):
        if x != last:  # pairs of a leader come one after the other
            last, words = x, word_hashes(x)
        out.append(similarity(words, word_hashes(y)))
    return pd.Series(out, dtype="float64")


def _bit_set(hashes: np.ndarray, least: int) -> bytes:
    """Bit set of hashes, of at least that many bits."""
    size = 64 << (max(0, least - 1) // 64).bit_length()
    bits = np.zeros(size, dtype=bool)
    bits[(hashes & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def signature(text: str | None) -> tuple[int, bytes, bytes]:
    """Number of words, and bit sets of hashed word pairs and of words, labelled so that repeats count."""
    words = word_hashes(text)
    n = len(words)
    return n, _bit_set(labelled_shingles(words, 2), 4 * n), _bit_set(labelled_shingles(words, 1), 16 * n)


@F.pandas_udf(record(words=T.IntegerType(), bits=T.BinaryType(), singles=T.BinaryType()))
def signatures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([signature(t) for t in batch], columns=["words", "bits", "singles"])


def _bit_rows(bits: list[bytes], size: int) -> np.ndarray:
    """Bit sets of ``size`` bytes, one per row; larger ones are folded."""
    out = np.empty((len(bits), size), dtype=np.uint8)
    for i, x in enumerate(bits):
        row = np.frombuffer(x, dtype=np.uint8)
        while len(row) > size:
            row = row[: len(row) // 2] | row[len(row) // 2 :]
        out[i] = row
    return out


def possible(words_a: np.ndarray, bits_a: list[bytes], words_b: np.ndarray, bits_b: list[bytes],
             ) -> Iterator[tuple[int, int, np.ndarray]]:
    """Tiles (first row, first column, mask) of the pairs that the bounds can't rule out."""
    size = min(map(len, [*bits_a, *bits_b]))
    a, b = _bit_rows(bits_a, size), _bit_rows(bits_b, size)
    # Word pairs beyond the first of their bit: as many common ones may be hidden.
    extra_a, extra_b = (np.maximum(w - 1, np.minimum(w, 1)) - np.bitwise_count(x).sum(axis=1, dtype=np.int64)
                        for w, x in ((words_a, a), (words_b, b)))
    step = max(1, TILE // (8 * size))
    for i in range(0, len(a), step):
        left = np.unpackbits(a[i : i + step], axis=1).astype(np.float32)
        for j in range(0, len(b), step):
            right = np.unpackbits(b[j : j + step], axis=1).astype(np.float32)
            common = left @ right.T + np.minimum(extra_a[i : i + step, None], extra_b[None, j : j + step])
            wa, wb = words_a[i : i + step, None], words_b[None, j : j + step]
            longer = np.maximum(wa, wb)
            limit = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
            yield i, j, (np.abs(wa - wb) <= limit) & (common >= longer - 1 - 2 * limit)


def enough_words(words_a: np.ndarray, singles_a: list[bytes], words_b: np.ndarray, singles_b: list[bytes],
                 pairs: np.ndarray) -> np.ndarray:
    """Those of the pairs (places in a and b) that may have as many common words as a link needs."""
    if not len(pairs):
        return pairs
    size = min(map(len, [*singles_a, *singles_b]))
    a, b = _bit_rows(singles_a, size), _bit_rows(singles_b, size)
    extra_a, extra_b = (w - np.bitwise_count(x).sum(axis=1, dtype=np.int64) for w, x in ((words_a, a), (words_b, b)))
    out, step = [], max(1, TILE // size)
    for at in range(0, len(pairs), step):
        x, y = pairs[at : at + step].T
        common = np.bitwise_count(a[x] & b[y]).sum(axis=1, dtype=np.int64) + np.minimum(extra_a[x], extra_b[y])
        longer = np.maximum(words_a[x], words_b[y])
        out.append(pairs[at : at + step][common >= longer - ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)])
    return np.concatenate(out)


def _pairs_of(a: pd.DataFrame, b: pd.DataFrame, same: bool) -> list[str]:
    code = np.unique(np.concatenate((a["root"], b["root"])).astype(str), return_inverse=True)[1]
    code_a, code_b = code[: len(a)], code[len(a) :]
    if not code.any():
        return []
    words_a, words_b = a["words"].to_numpy(np.int64), b["words"].to_numpy(np.int64)
    found = [np.zeros((0, 2), dtype=np.int64)]
    for i, j, mask in possible(words_a, list(a["bits"]), words_b, list(b["bits"])):
        mask &= code_a[i : i + mask.shape[0], None] != code_b[None, j : j + mask.shape[1]]
        found.append(np.argwhere(np.triu(mask, i - j + 1) if same else mask) + (i, j))
    found = enough_words(words_a, list(a["singles"]), words_b, list(b["singles"]), np.concatenate(found))
    of_a, of_b = a["member"].tolist(), b["member"].tolist()
    return [of_a[x] + of_b[y] for x, y in found.tolist()]


@F.pandas_udf(T.ArrayType(T.StringType()))
def block_pairs(*columns: pd.Series) -> pd.Series:
    """Both keys, one behind the other, of all possible pairs of different classes in two blocks."""
    n = len(SIGNED)
    return pd.Series([
        _pairs_of(pd.DataFrame(dict(zip(SIGNED, row[:n], strict=True))),
                  pd.DataFrame(dict(zip(SIGNED, row[n:-1], strict=True))), row[-1])
        for row in zip(*columns, strict=True)], dtype=object)


def text_key(text) -> F.Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _leaders(buckets: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's smallest member; leaders themselves go."""
    heads = buckets.groupBy("bucket").agg(F.min("member").alias("leader"), F.max("member").alias("last"))
    heads = heads.where(F.col("leader") != F.col("last")).drop("last")
    return buckets.join(heads, "bucket").where(F.col("leader") != F.col("member"))


def _texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Text of every member that pairs name; only keys meet the whole table."""
    named = pairs.select(F.explode(F.array("leader", "member")).alias("member")).distinct()
    return stored(texts.join(named, "member", "left_semi").dropDuplicates(["member"]), "candidate-texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs with ``linked``."""
    lead = texts.select(F.col("member").alias("leader"), F.col("text").alias("of_leader"))
    joined = pairs.join(texts, "member").join(lead, "leader")
    return stored(joined.select(
        "leader", "member", (alike("of_leader", "text") >= SIMILARITY).alias("linked")), "verified")


def _fresh(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs that were not compared yet, smaller member first."""
    pairs = pairs.select(F.least("leader", "member").alias("leader"), F.greatest("leader", "member").alias("member"))
    return stored(pairs.distinct().join(found, ["leader", "member"], "left_anti"), "candidates")


def _rest(led: DataFrame, known: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs of members that share a bucket and are of different classes, but those the bounds rule out."""
    whole = led.select("bucket", "member").union(led.select("bucket", F.col("leader").alias("member")).distinct())
    whole = whole.join(known, "member", "left").withColumn("root", F.coalesce("root", "member"))
    # A bucket of two members has been compared.
    mixed = whole.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"))
    whole = stored(whole.join(mixed.where("a < b and n > 2").select("bucket"), "bucket"), "mixed")
    signed = texts.join(whole.select("member").distinct(), "member", "left_semi").select(
        "member", signatures("text").alias("s")).select("member", "s.*")
    signed = stored(signed.withColumn("band", F.floor(F.log("words") / math.log(BAND)).cast("int")), "signatures")
    rows = whole.join(signed, "member")
    sizes = whole.join(signed.select("member", "words", "band"), "member").groupBy("bucket", "band").agg(
        F.ceil(F.sum("words") / F.lit(BLOCK)).alias("parts"))
    rows = rows.join(sizes, ["bucket", "band"]).withColumn("part", F.pmod(F.xxhash64("member"), "parts"))
    blocks = stored(rows.groupBy("bucket", "band", "part").agg(
        F.collect_list(F.struct(*SIGNED)).alias("rows")), "blocks")
    place = blocks.select("bucket", "band", "part")
    first = place.select("bucket", F.col("band").alias("band_a"), F.col("part").alias("part_a"),
                         F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    tried = first.join(place, ["bucket", "band"]).where("band_a < band or part_a <= part")
    tried = tried.join(blocks.select("bucket", F.col("band").alias("band_a"), F.col("part").alias("part_a"),
                                     F.col("rows").alias("a")), ["bucket", "band_a", "part_a"])
    tried = tried.join(blocks.withColumnRenamed("rows", "b"), ["bucket", "band", "part"])
    keys = block_pairs(*[F.col(f"{x}.{c}") for x in "ab" for c in SIGNED],
                       (F.col("band_a") == F.col("band")) & (F.col("part_a") == F.col("part")))
    keys = tried.select(F.explode(keys).alias("key"))
    return keys.select(F.substring("key", 1, 32).alias("leader"), F.substring("key", 33, 32).alias("member"))


def linked_classes(sketched: DataFrame, texts: DataFrame) -> DataFrame:
    """(member, root) of all that is linked. ``sketched``: member, coarse, fine per text."""
    numbered = sketched.select("member", "fine", F.posexplode("coarse").alias("i", "key"))
    buckets = numbered.select(
        "member", F.xxhash64("i", "key").alias("bucket"),
        F.xxhash64("i", "key", F.get("fine", "i")).alias("finer"))
    led = stored(_leaders(buckets), "led")
    pairs = stored(led.select("leader", "member").distinct(), "candidates")
    texts = _texts_of(pairs, texts)
    found = _verified(pairs, texts)
    unlike = found.where("not linked").select("leader", "member")
    rest = stored(led.join(unlike, ["leader", "member"], "left_semi").select("bucket", "finer", "member"), "unlike")
    again = [_leaders(rest), _leaders(rest.select("member", F.col("finer").alias("bucket")))]
    again = reduce(DataFrame.union, [x.select("leader", "member") for x in again])
    found = found.union(_verified(_fresh(again, found), texts))
    known = components(found.where("linked").select("leader", "member"))
    # Links between classes, and what hangs together by them.
    more = _verified(_fresh(_rest(led, known, texts), found), texts).where("linked")
    for side in ("leader", "member"):
        more = more.join(known.withColumnsRenamed({"member": side, "root": f"{side}_root"}), side, "left")
    over = components(more.select(
        F.coalesce("leader_root", "leader").alias("leader"), F.coalesce("member_root", "member").alias("member")))
    merged = known.join(over.select(F.col("root").alias("top"), F.col("member").alias("root")), "root", "left")
    return merged.select("member", F.coalesce("top", "root").alias("root")).union(
        over.join(known, "member", "left_anti"))


def components(edges: DataFrame) -> DataFrame:
    """(member, root) of everything linked: smallest labels spread, and labels of labels jump."""
    edges = stored(edges, "links")
    both = edges.union(edges.select("member", "leader")).toDF("a", "b")
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")), "labels")
    while True:
        seen = both.join(labels.withColumnsRenamed({"a": "b", "root": "of_b"}), "b")
        near = seen.groupBy("a").agg(F.min("of_b").alias("near"))
        step = labels.join(near, "a").select("a", "root", F.least("root", "near").alias("best"))
        jump = labels.select(F.col("a").alias("best"), F.col("root").alias("onward"))
        moved = step.join(jump, "best").select(
            "a", F.least("best", "onward").alias("root"), (F.least("best", "onward") != F.col("root")).alias("new"))
        moved = stored(moved, "labels")
        if moved.where("new").isEmpty():
            return moved.select(F.col("a").alias("member"), "root")
        labels = moved.select("a", "root")


def classes(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` (with member, coarse, fine) with the ``root`` of their class."""
    sketched = rows.where(F.size("coarse") > 0).select("member", "coarse", "fine").dropDuplicates(["member"])
    rooted = linked_classes(sketched, texts)
    return rows.join(rooted, "member", "left").withColumn("root", F.coalesce("root", "member"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    member = text_key(field("text"))
    rows = stored(docs.select("doc_id", member.alias("member"), sketches("text").alias("s")).select(
        "doc_id", "member", "s.*"), "sketches")
    texts = docs.select(member.alias("member"), F.coalesce("text", F.lit("")).alias("text"))
    rooted = stored(classes(rows, texts).select("doc_id", "root"), "roots")
    heads = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rooted.join(heads, "root").select("doc_id", "class_id", "class_size")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class."""
    rows = packed(docs).withColumns({"line": F.monotonically_increasing_id(), "member": text_key(F.col("row.text"))})
    rows = stored(rows, "to-dedup")
    sketched = stored(rows.select(
        "line", "member", F.col("row.doc_id").alias("id"), sketches("row.text").alias("s")).select(
            "line", "member", "id", "s.*"), "sketches")
    texts = rows.select("member", F.coalesce("row.text", F.lit("")).alias("text"))
    first = Window.partitionBy("root").orderBy(F.asc_nulls_last("id"), "line")
    kept = classes(sketched, texts).select("root", "id", "line").withColumn(
        "at", F.row_number().over(first)).where("at = 1").select("line")
    return unpacked(rows.join(kept, "line", "left_semi"))
