"""LM scoring: a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The class is predicted by a log-linear
model over hashed features of the history: the last word, the word before it (a skip feature), and
both together (an n-gram feature), plus a bias. Within its class a word has its smoothed share.

At most ``FREQUENT`` of the most frequent words share ``HEAD`` classes of about equal mass; the text end is a
class of its own; all other words fall into ``TAIL`` classes by their last two bytes.

Corpus counts cover all training documents and every word. Words outside the frequent ones are
joined with their counts by shuffle, so no vocabulary is collected or broadcast whole; the frequent
words (``FREQUENT``) and the weights (``3 * ROWS * CLASSES`` numbers) are bounded by parameters.

Training is distributed: in each of ``ROUNDS`` rounds, every learner makes gradient updates over
its share of that round's documents, from the weights of the round before; Spark gathers the
changes by blocks of weights and averages each weight row over the learners that met it. A learner's
share is a number of tokens, so learners grow with the corpus and scores don't depend on the cluster.
Together the rounds visit every training document once. Scoring runs in batches of numpy gathers.

Defined results: a null text counts as empty and has one token, its end. A null id is not held out.
Without training documents nothing is known and base_score is 0. Words of equal count are frequent
together or not at all. Rows are scored by themselves; repeated rows count as often as they occur;
an empty table gives an empty result. Sums are of doubles, so scores of reruns agree to rounding.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.llm.common import documents, stored

FREQUENT = 1 << 16
HEAD, TAIL = 20, 11
END_CLASS = HEAD
CLASSES = HEAD + 1 + TAIL
ROW_BITS = 14
ROWS = 1 << ROW_BITS
BLOCK = 64
ROUNDS = 2
LEARNER_TOKENS = 1 << 22  # of a learner's share in a round, however large the corpus or the cluster
FAN = 256
BATCH = 4096
RATE = 0.3
LIMIT = 20.0  # of a weight
FLUSH = 300_000
REMEMBERED = 400_000
_END, _START = 0x9E3779B1, 0x85EBCA77
_MASK = (1 << 32) - 1


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lowered; bytes know just these six separators and these letters."""
    return (text or "").encode().lower().split()


def tail_class(word: bytes) -> int:
    return HEAD + 1 + zlib.crc32(word[-2:]) % TAIL


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def counts_of(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of ``texts``, summed per task before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(words_of(text))
                if len(found) >= FLUSH:
                    yield pd.DataFrame({"word": list(found), "n": list(found.values())})
                    found.clear()
        yield pd.DataFrame({"word": list(found), "n": list(found.values())})

    return texts.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Words(dict):
    """Packed number of a word: feature hash, class, and 1 + place among the frequent words."""

    def __init__(self, frequent: list[bytes], classes: np.ndarray) -> None:
        super().__init__()
        for place, (word, kind) in enumerate(zip(frequent, classes.tolist(), strict=True)):
            self[word] = zlib.crc32(word) << 24 | kind << 17 | place + 1
        self.frequent = dict(self)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
            self.update(self.frequent)
        packed = self[word] = zlib.crc32(word) << 24 | tail_class(word) << 17
        return packed


class Lexicon:
    """Frequent words, classes, and the constants of the word shares. Bounded by parameters."""

    def __init__(self, frequent: list[tuple[bytes, int]], tail: dict[int, tuple[int, int]], ends: int) -> None:
        self.words = [w for w, _ in frequent]
        n = np.array([c for _, c in frequent], dtype=np.float64)
        mass = np.cumsum(n) - n / 2
        self.classes = np.minimum(mass / max(n.sum(), 1.0) * HEAD, HEAD - 1).astype(np.int64)
        self.logs = np.concatenate(([0.0], np.log10(n + 1)))
        total, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
        np.add.at(total, self.classes, n)
        np.add.at(distinct, self.classes, 1)
        for kind, (tokens, words) in tail.items():
            total[kind], distinct[kind] = tokens, words
        # log10 of what (count + 1) is divided by within a class; the end is alone in its class.
        self.shares = np.log10(total + distinct + 1)
        self.shares[END_CLASS] = 0
        self.ends = ends
        self.tokens = int(total.sum()) + ends
        self.distinct = int(distinct.sum()) + (ends > 0)


class Batches:
    """Turns texts into numbers, with the words known to this worker."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.words = Words(lexicon.words, lexicon.classes)

    def encode(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Packed tokens of all texts, ends included, and the number of tokens of each."""
        end = (_END & _MASK) << 24 | END_CLASS << 17
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        look = self.words.__getitem__
        flat: list[int] = []
        for text in texts:
            flat.extend(map(look, text))
            flat.append(end)
        return np.array(flat, dtype=np.int64), sizes


def features(packed: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Weight rows of each token's history: last word, word before it, both."""
    hashes = (packed >> 24).astype(np.uint64)
    first = np.cumsum(sizes) - sizes
    last = np.concatenate((hashes[:1], hashes[:-1]))
    last[first] = _START
    before = np.concatenate((last[:1], last[:-1]))
    before[first] = _START
    both = (last * np.uint64(0x9E3779B97F4A7C15)) ^ (before * np.uint64(0xC2B2AE3D27D4EB4F))
    top = np.uint64(64 - ROW_BITS)
    place = lambda x, odd, table: ((x * np.uint64(odd)) >> top).astype(np.int64) + table * ROWS
    return np.stack([place(last, 0xD6E8FEB86659FD93, 0), place(before, 0xA0761D6478BD642F, 1),
                     place(both, 0xE7037ED1A0B428DB, 2)])


_ONES = np.ones(CLASSES, dtype=np.float32)


def empty_weights() -> np.ndarray:
    """Three feature tables and a block whose first row is the bias."""
    return np.zeros((3 * ROWS + BLOCK, CLASSES), dtype=np.float32)


def logits_of(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of a token's weights per class. Weights are within LIMIT, so exponentials stay finite."""
    out = np.take(weights, rows[0], axis=0, mode="clip")
    more = np.take(weights, rows[1], axis=0, mode="clip")
    out += more
    out += np.take(weights, rows[2], axis=0, out=more, mode="clip")
    out += weights[3 * ROWS]
    return out


def log_share(weights: np.ndarray, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each token's class."""
    logits = logits_of(weights, rows)
    own = logits[np.arange(len(kinds)), kinds]
    return own - np.log(np.exp(logits, out=logits) @ _ONES)


class Learner:
    """Gradient updates on a copy of the weights, scaled per row by the gradients seen."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights.copy()
        self.seen = np.full(len(weights), 1e-6, dtype=np.float32)
        self.met = np.zeros(len(weights), dtype=np.float32)

    def update(self, rows: np.ndarray, kinds: np.ndarray) -> None:
        error = logits_of(self.weights, rows)
        np.exp(error, out=error)
        error /= (error @ _ONES)[:, None]
        error[np.arange(len(kinds)), kinds] -= 1
        slopes, every = error.astype(np.float64).ravel(), np.arange(CLASSES)
        for number, table in enumerate(rows):
            order = np.argsort((table - number * ROWS).astype(np.uint16), kind="stable")
            ranked = table[order]
            new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
            place = np.empty(len(order), dtype=np.int64)  # of a token's row among the distinct ones
            place[order] = np.cumsum(new) - 1
            start = np.flatnonzero(new)
            sums = np.bincount((place[:, None] * CLASSES + every).ravel(), weights=slopes, minlength=len(start) * CLASSES)
            self._step(ranked[start], sums.reshape(-1, CLASSES).astype(np.float32), np.diff(np.append(start, len(ranked))))
        self._step(np.array([3 * ROWS]), error.sum(axis=0, keepdims=True), np.array([len(kinds)]))

    def _step(self, at: np.ndarray, slope: np.ndarray, times: np.ndarray) -> None:
        self.seen[at] += np.einsum("ij,ij->i", slope, slope) / CLASSES
        moved = self.weights[at] - RATE * slope / np.sqrt(self.seen[at])[:, None]
        self.weights[at] = np.clip(moved, -LIMIT, LIMIT)
        self.met[at] += times


_last: list[Batches] = []


def _own(lexicon: Broadcast) -> Batches:
    """One word memory per Python worker and lexicon."""
    if not _last or _last[0].lexicon is not lexicon.value:
        _last[:] = [Batches(lexicon.value)]
    return _last[0]


CHANGE = "block long, learner long, change binary, met binary"


def _mean(changes: DataFrame, learners: int) -> DataFrame:
    """(block, mean): changes of each block of weights, averaged over the learners that met its rows.

    More than ``FAN`` learners are first summed by groups of so many, so a call holds ``FAN`` blocks.
    """

    def total(rows: pd.DataFrame, kind: type) -> tuple[np.ndarray, np.ndarray]:
        change, met = np.zeros((BLOCK, CLASSES)), np.zeros(BLOCK)
        rows = rows.sort_values("learner")
        for one, times in zip(rows["change"], rows["met"], strict=True):
            change += np.frombuffer(one, dtype=kind).reshape(BLOCK, CLASSES)
            met += np.frombuffer(times, dtype=kind)
        return change, met

    def summed(kind: type):
        def together(rows: pd.DataFrame) -> pd.DataFrame:
            change, met = total(rows, kind)
            return pd.DataFrame({"block": rows["block"].iloc[:1], "learner": rows["learner"].iloc[0] // FAN,
                                 "change": change.tobytes(), "met": met.tobytes()})

        return together

    def averaged(kind: type):
        def mean(rows: pd.DataFrame) -> pd.DataFrame:
            change, met = total(rows, kind)
            out = (change / np.maximum(met, 1)[:, None]).astype(np.float32)
            return pd.DataFrame({"block": rows["block"].iloc[:1], "mean": out.tobytes()})

        return mean

    kind = np.float32
    while learners > FAN:
        changes = changes.groupBy("block", F.floor(F.col("learner") / FAN)).applyInPandas(summed(kind), CHANGE)
        learners, kind = -(-learners // FAN), np.float64
    return changes.groupBy("block").applyInPandas(averaged(kind), "block long, mean binary")


def train(texts: DataFrame, lexicon: Broadcast, rounds: int = ROUNDS, learner_tokens: int = LEARNER_TOKENS) -> np.ndarray:
    """Weights after all rounds over ``texts``; a learner has about ``learner_tokens`` tokens a round."""
    spark = texts.sparkSession
    learners = max(1, round(lexicon.value.tokens / rounds / learner_tokens))
    weights = empty_weights()
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def learn(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            own, learner = _own(lexicon), Learner(shared.value)
            for batch in batches:
                for at in range(0, len(batch), 256):
                    packed, sizes = own.encode([words_of(t) for t in batch["text"].iloc[at : at + 256]])
                    rows, kinds = features(packed, sizes), packed >> 17 & 127
                    for i in range(0, len(kinds), BATCH):
                        learner.update(rows[:, i : i + BATCH], kinds[i : i + BATCH])
            change = (learner.weights - shared.value) * learner.met[:, None]
            touched = np.flatnonzero(learner.met.reshape(-1, BLOCK).any(axis=1))
            yield pd.DataFrame({
                "block": touched, "learner": TaskContext.get().partitionId(),
                "change": [change[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in touched],
                "met": [learner.met[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in touched]})

        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn).select("text")
        changes = part.repartition(learners).mapInPandas(learn, CHANGE)
        weights = weights.copy()
        for block, mean in _mean(changes, learners).collect():  # at most one row per block of weights
            weights[block * BLOCK : (block + 1) * BLOCK] += np.frombuffer(mean, dtype=np.float32).reshape(BLOCK, CLASSES)
        shared.unpersist()
    return weights


def lexicon_of(counts: DataFrame, ends: int) -> Lexicon:
    """The bounded part of the counts: frequent words, and two sums per class of the others."""
    # Counts in steps of about a hundredth; of a few thousand steps, as many from the top as fit.
    step = F.floor(F.log2("n") * 64).cast("int")
    found, least = 0, 1 << 30
    for at, words in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):
        found += words
        if found > FREQUENT:
            break
        least = at
    frequent = sorted(((bytes(w), n) for w, n in counts.where(step >= least).collect()), key=lambda x: (-x[1], x[0]))
    kind = HEAD + 1 + F.crc32(F.substring("word", -2, 2)) % TAIL
    tail = counts.where(step < least).groupBy(kind.cast("int").alias("kind")).agg(F.sum("n"), F.count("*")).collect()
    return Lexicon(frequent, {k: (n, v) for k, n, v in tail}, ends)


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """Scores (doc_id, text) rows by a model of the rows where ``learn`` holds."""
    spark = docs.sparkSession
    training = docs.where(learn).select(F.coalesce("text", F.lit("")).alias("text"))
    counts = stored(counts_of(training), "counts")
    lexicon = lexicon_of(counts, training.count())
    shared = spark.sparkContext.broadcast(lexicon)
    weights = spark.sparkContext.broadcast(train(training, shared))

    @F.pandas_udf("n_tokens long, n_frequent long, logs double, history double, rare array<binary>")
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, lex, model = _own(shared), shared.value, weights.value
        for batch in batches:
            out = []
            for at in range(0, len(batch), 256):
                texts = [words_of(t) for t in batch.iloc[at : at + 256]]
                packed, sizes = own.encode(texts)
                rows, kinds, place = features(packed, sizes), packed >> 17 & 127, packed & (1 << 17) - 1
                value = np.empty(len(kinds))
                for i in range(0, len(kinds), BATCH):
                    value[i : i + BATCH] = log_share(model, rows[:, i : i + BATCH], kinds[i : i + BATCH])
                value = value / math.log(10) - lex.shares[kinds]
                first = np.cumsum(sizes) - sizes
                known = np.add.reduceat(place > 0, first, dtype=np.int64)
                logs, history = np.add.reduceat(lex.logs[place], first), np.add.reduceat(value, first)
                rare = (place == 0) & (kinds != END_CLASS)
                for j, text in enumerate(texts):
                    odd = np.flatnonzero(rare[first[j] : first[j] + sizes[j]])
                    out.append((sizes[j], known[j], logs[j], history[j], [text[i] for i in odd]))
            yield pd.DataFrame(out, columns=["n_tokens", "n_frequent", "logs", "history", "rare"])

    made = docs.select("doc_id", F.monotonically_increasing_id().alias("line"), parts("text").alias("p"))
    made = stored(made.select("doc_id", "line", "p.*"), "parts")
    rare = made.select("line", F.explode("rare").alias("word")).join(counts, "word").groupBy("line").agg(
        F.sum(F.log10(F.col("n") + 1.0)).alias("rare_logs"), F.count("*").alias("n_rare"))
    ends = 1 if lexicon.ends else 0
    n_tokens, base = F.col("n_tokens"), math.log10(lexicon.tokens + lexicon.distinct + 1)
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return made.drop("rare").join(rare, "line", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0)) + ends).cast("long").alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (logs + math.log10(lexicon.ends + 1) - n_tokens * base).alias("base_score"),
        (logs + F.col("history")).alias("score"))


def op4_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return score(docs, ~held_out(F.col("doc_id")))
