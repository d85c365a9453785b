import hashlib
import random

import numpy as np
import pytest

from silverbrook.llm import near_dedup as N


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_is_exact():
    rng = random.Random(1)
    for _ in range(1500):
        k = rng.choice([2, 3, 8])
        a = [rng.randrange(k) for _ in range(rng.randrange(14))]
        b = [x for x in a if rng.random() < 0.85] if rng.random() < 0.5 else [
            rng.randrange(k) for _ in range(rng.randrange(14))]
        want = distance(a, b)
        for limit in (0, 1, 2, 5, 20):
            assert N.banded_distance(a, b, limit) == min(want, limit + 1)


def test_words_and_similarity():
    words = N.word_hashes("a bb  a\tc\n" + "é" + "\x85d")
    assert len(words) == 5 and words[0] == words[2] and len(set(words.tolist())) == 4
    assert len(N.word_hashes("x " * (1 << 20))) == 1 << 20
    a = N.word_hashes(" ".join(f"w{i}" for i in range(1000)))
    b = a.copy()
    b[::6] += N._BASE
    assert N.similarity(a, b) == pytest.approx(1 - 167 / 1000)
    b[::4] += N._BASE
    assert N.similarity(a, b) == 0.0
    # The order of rare repeats counts: occurrence labels tell them apart.
    assert len(set(N.labelled_shingles(N.word_hashes("a b c d e " * 9)).tolist())) == 41


def made(rng):
    """Documents with their true class: exact and near copies, shared passages, oddities."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    passage = [word() for _ in range(60)]
    rows, doc_id = [], 0
    for group in range(60):
        base = [word() for _ in range(rng.randrange(30, 300))]
        if group % 3 == 0:
            base[5:5] = passage
        copies = 40 if group == 0 else rng.choice([1, 1, 2, 4])
        for copy in range(copies):
            text = list(base)
            for _ in range(len(text) // 50 if copy else 0):
                text[rng.randrange(len(text))] = word()
            rows.append((doc_id, " ".join(text), group))
            doc_id += 1
    return rows


def test_classes_equal_brute_force(spark):
    rows = made(random.Random(4))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    texts = docs.select(N.text_key(docs["text"]).alias("member"), "text")
    sketched = docs.select("doc_id", N.text_key(docs["text"]).alias("member"), N.sketches("text").alias("s"))
    rooted = N.classes(sketched.select("doc_id", "member", "s.*"), texts).collect()
    root = {r["doc_id"]: r["root"] for r in rooted}
    assert len(root) == len(rows)
    first: dict = {}
    for i, _, group in rows:
        assert first.setdefault(group, root[i]) == root[i]
    assert len(set(first.values())) == len(first)


def test_stage_keeps_one_of_each(spark):
    long = "the quick brown fox jumps over the lazy dog and runs " * 3000
    near = " ".join(f"n{i}" for i in range(200))
    rows = [(5, "same text here", "x"), (2, "same text here", "y"), (2, "same text here", "y"), (None, "same text here", "z"),
            (7, None, "x"), (8, "", "x"), (9, " \n", None), (10, long, "x"), (11, long + "end", "x"),
            (12, near, None), (13, near + " more", None), (14, "one", ""), (15, "one two", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    out = N.stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 7, 9, 10, 12, 14, 15]
    assert N.stage(spark, docs.limit(0), "").count() == 0


def test_components_of_chains(spark):
    chain = [(f"{i:03d}", f"{i + 1:03d}") for i in range(40)] + [("x", "y"), ("x", "z")]
    got = {r["member"]: r["root"] for r in N.components(spark.createDataFrame(chain, "leader string, member string")).collect()}
    assert {got[f"{i:03d}"] for i in range(41)} == {"000"}
    assert {got[c] for c in "xyz"} == {"x"}


def one_bucket(spark, texts):
    """Classes of texts that all share one bucket and no finer one: {text: root}."""
    rows = spark.createDataFrame([(t, [1], [i]) for i, t in enumerate(texts)], "text string, coarse array<long>, fine array<long>")
    keyed = rows.withColumn("member", N.text_key(rows["text"]))
    return {r["text"]: r["root"] for r in N.classes(keyed, keyed.select("member", "text")).collect()}


def test_members_linked_to_the_leader_meet_the_others(spark):
    for seed in range(100):  # until the smallest key is that of the text without its beginning
        base = [f"{seed}w{i}" for i in range(100)]
        whole, late, early = (" ".join(x) for x in (base, base[15:], base[:-15]))
        if min((whole, late, early), key=lambda x: hashlib.md5(x.encode()).digest()) == late:
            break
    hashes = [N.word_hashes(t) for t in (whole, late, early)]
    assert N.similarity(hashes[1], hashes[2]) == 0 < N.similarity(hashes[0], hashes[2])
    assert len(set(one_bucket(spark, [whole, late, early]).values())) == 1


@pytest.mark.parametrize("block", [N.BLOCK, 3000])
def test_bucket_of_unlike_texts_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(8)
    lines = [[f"l{i}x{j}" for j in range(10)] for i in range(14)]
    texts = set()
    for i in range(150):  # texts of common lines, many of them near the threshold
        own = [f"t{i}y{j}" for j in range(rng.randrange(1, 25))]
        cut = rng.randrange(len(own))
        texts.add(" ".join(own[:cut] + sum(rng.sample(lines, rng.randrange(4, 9)), []) + own[cut:]))
    texts |= {" ".join(t.split()[k:]) for t in list(texts)[:30] for k in (9, 14)}
    texts = sorted(texts)
    hashes, root = [N.word_hashes(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if N.similarity(hashes[i], hashes[j]) >= N.SIMILARITY and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    got = one_bucket(spark, texts)
    assert len({(root[i], got[t]) for i, t in enumerate(texts)}) == len(set(root)) == len(set(got.values()))


def test_a_repeat_leaves_other_shingles_alone():
    text = " ".join(f"w{i}" for i in range(50))
    once, twice = (set(N.labelled_shingles(N.word_hashes(t)).tolist()) for t in (text, text + " " + text[:60]))
    assert once < twice


def test_bounds_keep_all_links():
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        base = [rng.choice("abcdefghijklmn") * rng.randrange(1, 4) for _ in range(rng.choice([1, 2, 5, 17, 60, 300, 900]))]
        for _ in range(4):
            text = [w for w in base if rng.random() > 0.05]
            for _ in range(int(len(text) * rng.random() * 0.2)):
                text[rng.randrange(len(text))] = "new"
            texts.append(" ".join(text or base))
    hashes, signed = [N.word_hashes(t) for t in texts], [N.signature(t) for t in texts]
    linked = ruled_out = 0
    for i in range(len(texts)):
        for j in range(max(0, i - 8), i):
            (_, _, mask), = N.possible(*[x for k in (i, j) for x in (np.array([signed[k][0]]), [signed[k][1]])])
            link = N.similarity(hashes[i], hashes[j]) >= N.SIMILARITY
            assert mask[0, 0] or not link
            kept = N.enough_words(*[x for k in (i, j) for x in (np.array([signed[k][0]]), [signed[k][2]])], np.array([[0, 0]]))
            assert len(kept) or not link
            linked, ruled_out = linked + link, ruled_out + (not mask[0, 0] or not len(kept))
    assert linked > 100 and ruled_out > 100
