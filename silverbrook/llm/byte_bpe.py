"""Byte-level BPE encoding and decoding with a rank queue made of hierarchical bitmaps.

Each match of the split pattern is encoded by itself. Its bytes form a linked list; every pair of
neighbours that the vocabulary knows puts its left position into the bucket of its merge rank. A
two-level bitmap says which buckets hold anything, and find-first-set picks the next rank.
Positions of a bucket are merged from left to right; those whose pair has changed since are stale
and skipped. A merge touches two pairs, so the work per pre-token is near linear in its bytes,
however long it is.

One queue serves all new pre-tokens of a group of texts at once: their lists lie one after the
other, and a bucket's positions are merged together as arrays. Where a merge brings up a pair of
lower rank than the bucket's, order within the pre-token matters; such pre-tokens are done again
alone, one merge at a time. Encoded pre-tokens are remembered, about ``REMEMBERED`` of them.

Spark deals out the rows; a task holds one Arrow batch, the vocabulary, the remembered pre-tokens
and one group of at most ``GROUP`` matches. Defined results: a null text is encoded as an empty
one: no tokens, and the digests of the empty string. Rows are independent, so ties, repeated rows,
null ids, other columns and empty tables need no rule. Special tokens are never produced: their
strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook.llm.common import documents, field, record

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
REMEMBERED = 600_000
GROUP = 1 << 20
WORD = 8  # a word of the lower bitmap has 2**WORD bits


class RankQueue:
    """Buckets of positions per rank, below a bitmap of two levels."""

    def __init__(self, ranks: int) -> None:
        self.buckets: dict[int, list] = {}
        self.low = [0] * ((ranks >> WORD) + 1)
        self.top = 0

    def push(self, rank: int, position) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        word = rank >> WORD
        self.low[word] |= 1 << (rank & (1 << WORD) - 1)
        self.top |= 1 << word

    def pop(self) -> tuple[int, list]:
        """The lowest rank with its bucket, which is then gone."""
        word = (self.top & -self.top).bit_length() - 1
        bits = self.low[word]
        first = bits & -bits
        self.low[word] = bits ^ first
        if bits == first:
            self.top &= self.top - 1
        rank = word << WORD | first.bit_length() - 1
        return rank, self.buckets.pop(rank)


class Codec:
    """Encodes and decodes by a file of ranks."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for token, rank in map(bytes.split, lines):
                self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.numerals = {rank: str(rank) for rank in self.tokens}
        self.split = regex.compile(pattern)
        self.size = max(self.tokens, default=0) + 1
        self.seen: dict[str, bytes] = {}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        get = self.ranks.get
        known = sorted(
            (a * self.size + b, rank) for token, rank in self.ranks.items() for i in range(1, len(token))
            if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None)
        self.pairs = np.array([key for key, _ in known] or [-1], dtype=np.int64)
        self.pair_ranks = np.array([rank for _, rank in known] or [-1], dtype=np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token, one merge at a time."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n, queue = len(piece), RankQueue(self.size)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [ranks.get(piece[i : i + 2], -1) for i in range(n - 1)] + [-1, -1]
        for i, rank in enumerate(pair):
            if rank >= 0:
                queue.push(rank, i)
        while queue.top:
            rank, positions = queue.pop()
            positions.sort()
            for done, i in enumerate(positions):
                if pair[i] != rank:
                    continue  # stale: merged away, or a neighbour has grown
                gone = after[i]
                end = after[gone]
                after[i], before[end], pair[gone] = end, i, -1
                left, lowest = before[i], rank
                pair[i] = ranks.get(piece[i : after[end]], -1) if end < n else -1
                if left >= 0:
                    pair[left] = ranks.get(piece[left:end], -1)
                for at in (i, left):
                    if at >= 0 and pair[at] >= 0:
                        queue.push(pair[at], at)
                        lowest = min(lowest, pair[at])
                if lowest < rank:  # a better pair has come up: the others wait
                    for other in positions[done + 1 :]:
                        queue.push(rank, other)
                    break
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of what two tokens make, or -1."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], -1)

    def merge_all(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of many pre-tokens, merged together rank by rank."""
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        owner = np.repeat(np.arange(len(pieces)), sizes)
        token = np.append(self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)], 0)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        filled = sizes > 0
        after[ends[filled] - 1] = n  # n stands for no neighbour
        before[(ends - sizes)[filled]] = -1
        alive = np.ones(n, dtype=bool)
        odd = np.zeros(len(pieces), dtype=bool)
        pair = np.full(n + 1, -1, dtype=np.int64)
        queue = RankQueue(self.size)

        def renew(places: np.ndarray, rank: int) -> None:
            """Ranks of the pairs that begin at the places, and into the queue with them."""
            right = after[places]
            found = np.where(right < n, self._rank_of(token[places], token[right]), -1)
            pair[places] = found
            good = np.flatnonzero(found >= 0)
            places, found = places[good], found[good]
            odd[owner[places[found < rank]]] = True
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            for key, some in zip(found[np.append(0, cuts)].tolist() if len(found) else [], np.split(places, cuts)):
                queue.push(key, some)

        renew(np.arange(n), -1)
        while queue.top:
            rank, bucket = queue.pop()
            at = bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))
            at = at[pair[at] == rank]  # the rest is stale
            if not len(at):
                continue
            gone = after[at]
            close = gone[:-1] == at[1:]
            if close.any():  # in a run of overlapping pairs every other one merges
                number = np.arange(len(at))
                first = np.maximum.accumulate(np.where(np.append(True, ~close), number, 0))
                at = at[(number - first) % 2 == 0]
                gone = after[at]
            end = after[gone]
            touching = np.flatnonzero(end[:-1] == at[1:])
            if len(touching):  # the left one merges while its right neighbour is still in two
                early = self._rank_of(np.full(len(touching), rank), token[end[touching]])
                odd[owner[at[touching[(early >= 0) & (early < rank)]]]] = True
            token[at] = rank
            after[at] = end
            before[end] = at
            pair[gone] = -1
            alive[gone] = False
            left = before[at]
            renew(np.unique(np.concatenate((at, left[left >= 0]))), rank)
        kept = np.flatnonzero(alive)
        counts = np.bincount(owner[kept], minlength=len(pieces))
        out = np.split(token[kept], np.cumsum(counts)[:-1]) if len(pieces) else []
        for i in np.flatnonzero(odd):
            out[i] = np.array(self.merge(pieces[i]))
        return out

    def remember(self, pieces: Iterable[str]) -> None:
        """Encodes the pre-tokens that are not remembered yet."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        new = [p for p in dict.fromkeys(pieces) if p not in self.seen]
        rest = []
        for piece in new:
            whole = self.ranks.get(piece.encode())
            if whole is None:
                rest.append(piece)
            else:
                self.seen[piece] = whole.to_bytes(4, "little")
        for piece, ids in zip(rest, self.merge_all([p.encode() for p in rest]), strict=True):
            self.seen[piece] = ids.astype("<u4").tobytes()

    def groups(self, texts: Iterable[str]) -> Iterator[list[tuple[int, list[str]]]]:
        """Pre-tokens of texts with the text's number, at most about GROUP of them at a time."""
        group, held = [], 0
        for i, text in enumerate(texts):
            if len(text) <= GROUP:
                parts: Iterable[list[str]] = [self.split.findall(text)]
            else:
                found = (m[0] for m in self.split.finditer(text))
                parts = iter(lambda found=found: list(islice(found, GROUP)), [])
            for part in parts:
                group.append((i, part))
                held += len(part)
                if held >= GROUP:
                    yield group
                    group, held = [], 0
        yield group

    def encoded(self, texts: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(number of the text, token ids), in order; a long text comes in several parts."""
        for group in self.groups(texts):
            self.remember(p for _, part in group for p in part)
            look = self.seen.__getitem__
            for i, part in group:
                yield i, np.frombuffer(b"".join(map(look, part)), dtype="<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text: number of tokens, digest of the ids, digest of the bytes decoded from them."""
        out = []
        counts = [0] * len(texts)
        of_ids, of_bytes = hashlib.sha256(), hashlib.sha256()
        for i, ids in self.encoded(texts):
            while len(out) < i:
                out.append((counts[len(out)], of_ids.hexdigest(), of_bytes.hexdigest()))
                of_ids, of_bytes = hashlib.sha256(), hashlib.sha256()
            if ids:
                comma = "," if counts[i] else ""
                of_ids.update((comma + ",".join(map(self.numerals.__getitem__, ids))).encode())
                of_bytes.update(self.decode(ids))
                counts[i] += len(ids)
        while len(out) < len(texts):
            out.append((counts[len(out)], of_ids.hexdigest(), of_bytes.hexdigest()))
            of_ids, of_bytes = hashlib.sha256(), hashlib.sha256()
        return out


_codecs: dict[str, Codec] = {}


def codec(name: str = VOCABULARY) -> Codec:
    """One codec per Python worker."""
    if name not in _codecs:
        _codecs[name] = Codec(public_tokenizers.path(name))
    return _codecs[name]


@F.pandas_udf(record(n_tokens=T.LongType(), ids_sha256=T.StringType(), decoded_sha256=T.StringType()))
def digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    own = codec()
    for batch in texts:
        yield pd.DataFrame(own.digests([t or "" for t in batch]),
                           columns=["n_tokens", "ids_sha256", "decoded_sha256"])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def encoded(texts: pd.Series) -> pd.Series:
    """Token ids of whole texts."""
    out: list[list[int]] = [[] for _ in texts]
    for i, ids in codec().encoded([t or "" for t in texts]):
        out[i] += ids
    return pd.Series(out)


@F.pandas_udf(T.BinaryType())
def decoded(ids: pd.Series) -> pd.Series:
    """Bytes of token ids."""
    return ids.map(lambda x: None if x is None else codec().decode(x))


def _report(docs: DataFrame) -> DataFrame:
    return docs.select(field("doc_id"), digests(field("text")).alias("d")).select("doc_id", "d.*")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with the digests that prove the round trip."""
    return _report(docs)
