"""Alignment of two tokenizers against spans compared pair by pair."""

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import ROWS, frame

from silverbrook.llm import alignment
from silverbrook.llm.queries import QUERIES


@pytest.fixture(scope="module")
def own():
    return alignment.Aligner()


def spans(raw):
    out, at = [], 0
    for x in raw:
        out.append((at, at + len(x)))
        at += len(x)
    return out


def plain(own, text):
    """(ids a, ids b, groups as written, links) with whole texts given to both libraries; None without tokens."""
    if not text:
        return None
    a, b = own.a.library.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)
    raw_a, raw_b = [own.bytes_a[i] for i in a], [own.bytes_b[i] for i in b]
    if not b"".join(raw_a) == b"".join(raw_b) == f" {text}".encode():
        return None
    at_a, at_b = spans(raw_a), spans(raw_b)
    cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
    group_a, group_b = defaultdict(list), defaultdict(list)
    for ids, at, group in ((a, at_a, group_a), (b, at_b, group_b)):
        cut = iter(cuts)
        now = next(cut)
        for i, (_, end) in zip(ids, at, strict=True):
            group[now].append(str(i))
            if end == now:
                now = next(cut, None)
    written = ";".join(f"{','.join(group_a[c])}|{','.join(group_b[c])}" for c in cuts)
    links, j = [], 0
    for x, (s, e) in zip(a, at_a, strict=True):
        while at_b[j][1] <= s:
            j += 1
        k = j
        while k < len(b) and at_b[k][0] < e:
            links.append((x, b[k]))
            k += 1
    return a, b, written, links


TEXTS = st.lists(st.sampled_from(
    ["a", "'s", " ", "  ", "\n", "\t", "\x85", "\xa0", "<|endoftext|>", "<s>", "<0x0A>", "é", "日本", "😀", "́", "1", "▁",
     "naïve", "Zürich", "\x00"]), max_size=12).map("".join)


@settings(deadline=None)
@given(TEXTS)
def test_texts(own, text):
    want, got = plain(own, text), next(own.rows([text]))
    if want is None:
        assert got[:5] == (0, 0, 0, 0, "") and not len(got[5])
        return
    a, b, written, links = want
    assert got[:4] == (len(a), len(b), written.count(";") + 1, len(links))
    assert got[4] == hashlib.sha256(written.encode()).hexdigest()
    pairs = Counter({(p >> alignment.SHIFT, p & (1 << alignment.SHIFT) - 1): n
                     for p, n in zip(got[5].tolist(), got[6].tolist(), strict=True)})
    assert pairs == Counter(links)


def test_a_slice_of_many_tokens():
    groups, links = alignment.slices([1, 2, 3], [7, 8], [2, 2, 3], [3, 4])
    assert groups == ["1,2,3|7,8"]
    assert [divmod(x, 1 << alignment.SHIFT) for x in links] == [(1, 7), (2, 7), (2, 8), (3, 8)]
    assert alignment.slices([], [], [], []) == ([], [])


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(own, rows):
    found = [(i, plain(own, t)) for i, t in rows]
    counts = Counter(p for _, x in found if x for p in set(x[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, written, links = x
        out.append((i, len(a), len(b), written.count(";") + 1, len(links), sum(counts[p] == most[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(written.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(got):
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)


@pytest.mark.parametrize("heavy", [1, 50, 1 << 17])
def test_odd_rows(spark, own, heavy, monkeypatch):
    monkeypatch.setattr(alignment, "HEAVY", heavy)
    got = alignment.align(frame(spark))
    assert result(got) == brute(own, [r[:2] for r in ROWS])


def test_empty_table(spark):
    assert alignment.align(frame(spark, [])).collect() == []


def test_groups(spark, own):
    rows = [(1, "naïve Zürich 日本", None, None, None), (2, None, None, None, None), (3, "a▁b", None, None, None)]
    got = alignment.groups(frame(spark, rows)).orderBy("group").collect()
    assert {r["doc_id"] for r in got} == {1}
    raw = f" {rows[0][1]}".encode()
    for r in got:
        part = raw[r["begin"] : r["end"]]
        assert b"".join(own.bytes_a[i] for i in r["a"]) == part == b"".join(own.bytes_b[i] for i in r["b"])
    assert b"".join(raw[r["begin"] : r["end"]] for r in got) == raw


def test_query(spark, sf, own):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op13_alignment"](spark, sf)) == brute(own, rows)
