"""The registered queries on a whole small data set, against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_maxent_lm import held, tokens
from test_mixing import water_fill
from test_quality_rules import counted
from test_secret_scan import literal_base

from silverbrook.llm import byte_bpe, multi_index, near_dedup, secret_scan, token_counts
from silverbrook.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def rows(spark, sf):
    return lambda name: QUERIES[name](spark, sf).collect()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op1(rows, spark, sf, texts):
    got = {r["doc_id"]: r for r in rows("op1_mixing")}
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sizes = Counter()
    for i, t in texts.items():
        assert got[i]["size"] == len(t.encode().split())
        sizes[source[i]] += got[i]["size"]
    for name, target in water_fill(dict(sizes)).items():
        own = [r for i, r in got.items() if source[i] == name]
        assert {r["target"] for r in own} == {own[0]["target"]} and own[0]["target"] == pytest.approx(target)
        assert sum(r["taken"] for r in own) == pytest.approx(target, rel=0.01, abs=20)
        assert all(r["taken"] <= 2 * r["size"] for r in own)


def test_op2(rows, texts):
    got = rows("op2_secret_scan")
    assert len(got) == len(texts)
    for r in got:
        base = literal_base(texts[r["doc_id"]])
        assert r["base_sha256"] == sha(secret_scan.joined(base))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for _, k, _ in base) for x in range(3)]
        assert {s for s in r["spans"].split(",") if s and not s.startswith("novel")} == {
            s for s in secret_scan.joined(base).split(",") if s}


def test_op3(rows, texts):
    got = {r["doc_id"]: r["class_id"] for r in rows("op3_near_dedup")}
    words = {i: near_dedup.word_hashes(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and (texts[a] == texts[b] or near_dedup.similarity(words[a], words[b]) >= 0.8):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {i: find(i) for i in ids}


def test_op4(rows, texts):
    got = rows("op4_maxent_lm")
    counts = Counter(t for i, text in texts.items() if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for r in got:
        own = tokens(texts[r["doc_id"]])
        want = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in own)
        assert r["base_score"] == pytest.approx(want, rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[x] > 0 for x in own), n)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_op5(rows, texts):
    encode = token_counts.encoding().encode_ordinary
    assert {r["doc_id"]: r["n_tokens"] for r in rows("op5_token_counts")} == {i: len(encode(t)) for i, t in texts.items()}


def test_op7(rows, texts):
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.codec().ranks,
                               special_tokens={}).encode_ordinary
    for r in rows("op7_byte_bpe"):
        ids = encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]])


def test_op8(rows, spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    got = rows("op8_multi_index")
    hits = total = 0
    for q in ids[ids % multi_index.EVERY == 0]:
        apart = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        apart[ids == q] = np.inf
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert len(own) == 10 and all(s == pytest.approx(apart[ids == i][0], abs=1e-12) for _, i, s in own)
        hits += len({i for _, i, _ in own} & set(ids[np.lexsort((ids, apart))[:10]]))
        total += 10
    assert hits / total >= 0.9


def test_op9(rows, spark, sf, texts):
    got = {r["doc_id"]: r for r in rows("op9_byte_cnn")}
    assert set(got) == set(texts) and all(0 <= r["score"] <= 1 for r in got.values())
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean([got[r["doc_id"]]["predicted"] == r["quality"] for r in labels]) >= 0.85


def test_op10(rows, spark, sf, texts):
    got = {r["doc_id"]: r for r in rows("op10_quality_rules")}
    for i, t in texts.items():
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counted(t)
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
