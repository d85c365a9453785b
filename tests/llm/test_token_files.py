"""Directly addressable token files: codes, whole round trip, single tokens."""

import random
import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import ROWS, frame
from tokenizers import Tokenizer

from silverbrook.llm import chunks, token_files
from silverbrook.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    library = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, 0]


@settings(deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=1500),
       st.data())
def test_codes(ids, data):
    raw = token_files.pack(np.array(ids, dtype=np.uint32), np.array([len(ids)]), [None])
    reads = []

    def read(at, n):
        reads.append(n)
        return raw[at : at + n]

    held = token_files.TokenFile(read)
    begin = data.draw(st.integers(0, len(ids)))
    end = data.draw(st.integers(begin, len(ids)))
    assert held.slice(begin, end).tolist() == ids[begin:end] and held.doc_ids() == [None]
    if ids:
        reads.clear()
        i = data.draw(st.integers(0, len(ids) - 1))
        assert held[i] == ids[i]
        assert sum(reads) <= held.levels * (1 + 8 + token_files.RANK_BITS // 8 + 1)  # no block is decoded


@settings(deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", "​", "<|endoftext|>", "é", "日本", "1", ".", "\r\n"]),
    max_size=12).map("".join))
def test_chunks_leave_tokens_as_they_are(plain, text):
    texts = [text, None, f"x{text}y", text * 3, ""]
    assert [ids.tolist() for ids in token_files.encoded(texts)] == [plain(t) for t in texts]


def test_long_texts_in_parts(plain, monkeypatch):
    monkeypatch.setattr(chunks, "GROUP", 64)
    texts = ["a long text of  many words\n " * 20, "", "short", "word " * 50, "x" * 500]
    assert [ids.tolist() for ids in token_files.encoded(texts)] == [plain(t) for t in texts]


def test_remembered_is_bounded():
    asked = []

    def make(keys):
        asked.extend(keys)
        return [chunks.written(key).upper() for key in keys]

    made = token_files.Remembered(make, len, limit=1000)
    for k in range(50):
        assert list(made.of([f"p{k} q p{k}", "", "z"])) == [(0, [f"P{k}", " Q", f" P{k}"]), (2, ["Z"])]
    assert len(made.known) + len(made.older) <= 24 and asked.count("q") == asked.count(("z",)) == 1


def result(got):
    return [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.orderBy("start").collect()]


def expected(rows, plain):
    sizes = [len(plain(t)) for _, t in rows]
    starts = [0, *accumulate(sizes)][: len(rows)]
    return [(i, s, n, zlib.crc32(np.array(plain(t), dtype="<u4").tobytes()))
            for (i, t), s, n in zip(rows, starts, sizes, strict=True)]


def test_odd_rows(spark, plain, tmp_path):
    files = token_files.write(frame(spark), str(tmp_path), file_tokens=10)
    got = result(token_files.read(files))
    order = [r[0] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0)) and len(got) == len(ROWS)
    assert sorted(((i, n, c) for i, _, n, c in got), key=repr) == sorted(
        ((i, n, c) for i, _, n, c in expected([r[:2] for r in ROWS], plain)), key=repr)
    assert [s for _, s, _, _ in got] == [0, *accumulate(n for _, _, n, _ in got)][: len(got)]
    assert files.count() > 3 and all(p.read_bytes()[:4] == b"DACT" for p in tmp_path.glob("*.dac"))


def test_files_that_no_manifest_names_are_not_read(spark, tmp_path):
    rows = [(i, f"text {i}", None, None, None) for i in range(20)]
    files = token_files.write(frame(spark, rows), str(tmp_path))
    (tmp_path / "00000000-000000-of-a-lost-attempt.dac").write_bytes(b"half a file")
    assert token_files.read(files).count() == 20


def test_single_tokens(spark, plain, tmp_path):
    rows = [(i, f"token {i} of naïve 日本 text", None, None, None) for i in range(40)]
    files = token_files.write(frame(spark, rows), f"file://{tmp_path}", file_tokens=50)
    ids = [x for r in rows for x in plain(r[1])]
    wanted = [(0,), (len(ids) - 1,), (len(ids),), (-1,), (None,), (17,), (17,), *((k,) for k in range(100, 140))]
    got = token_files.lookup(files, spark.createDataFrame(wanted, "position long")).collect()
    assert sorted(map(tuple, got)) == sorted((p, ids[p]) for (p,) in wanted if p is not None and 0 <= p < len(ids))


def test_empty_table(spark, tmp_path):
    files = token_files.write(frame(spark, []), str(tmp_path))
    assert files.count() == 0 and token_files.read(files).count() == 0
    assert token_files.lookup(files, spark.createDataFrame([(0,)], "position long")).count() == 0


def test_query(spark, sf, plain):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert result(QUERIES["op12_token_files"](spark, sf)) == expected([tuple(r) for r in rows], plain)


def test_single_line_breaks_part_chunks_and_ids_stay():
    """Words beside a line break are known from elsewhere, and the ids are those of the whole text."""
    rng = random.Random(7)
    signs = ["a", "b", "Été", "ab", "7", ".", ",", "'s", "'", "\n", "\n", "\n", " ", " ", "\t", "\r", "\x1c", "\x1f", "\xa0",
             "<|endoftext|>", "δ", "é", "$$", " "]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(4000)] + ["\nab", "ab\n", "\n", "a\n\nb", "a\nb\n<|endoftext|>"]
    plain = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    want = [plain.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert [x.tolist() for x in token_files.encoded(texts)] == want
    assert ["".join(map(chunks.written, k)) for t in texts for k in chunks.chunks(t, breaks=True)] == [t for t in texts if t]
    (keys,) = chunks.chunks(" one.\ntwo one.", breaks=True)
    assert keys == ["one.", f"{chunks.NEXT}\n", f"{chunks.NEXT}two", "one."]


def test_what_was_remembered_is_looked_up_and_not_walked_through():
    class Walked(dict):
        def __iter__(self):
            raise AssertionError("all keys are visited")

    known = chunks.Remembered(lambda keys: [k.encode() for k in keys], len)
    known.older = Walked(a=b"old")
    assert [parts for _, parts in known.of([" a b"])] == [[b"old", b"b"]]


SIGNS = ["a", "B", "Été", "ab", "7", "12", ".", ",", "'s", "'", "'re", "ll", "\n", "\n", "\n", " ", " ", "  ", "\t", "\r\n", "\x1c", "\xa0",
         "\x85", " ", "　", "’", "​", "<|endoftext|>", "<|", "|>", "endoftext", "δ", "é", "$$", "&&&", "-", "(", "日本",
         "̀", "ª", "½", "\x00", "\U0001d400", "ɐ", "€"]


def test_marks_make_no_word_new(plain, monkeypatch):
    """A word is encoded once, whatever marks, digits and line breaks are beside it."""
    asked = []
    own = token_files.encoder()
    monkeypatch.setattr(own.parts, "make", lambda parts: asked.extend(parts) or own.vocabulary.of_parts(parts))
    texts = ["xqzt. a xqzt, xqzt\nxqzt; (xqzt) xqzt&&& xqzt's", "the\xa0xqzt", " xqzt7 -xqzt- xqzt"]
    assert [ids.tolist() for ids in token_files.encoded(texts)] == [plain(t) for t in texts]
    assert sorted(p for p in asked if "xqzt" in p) == [" xqzt", "xqzt"]


def test_cut_by_bytes_leaves_ids_as_they_are(plain, monkeypatch):
    rng = random.Random(11)
    for wide in (1 << 22, 40):
        monkeypatch.setattr(chunks, "WIDE", wide)
        texts = ["".join(rng.choices(rng.sample(SIGNS, rng.randint(2, 12)), k=rng.randint(0, 25))) for _ in range(3000)]
        assert [ids.tolist() for ids in token_files.encoded(texts)] == [plain(t) for t in texts]
    assert list(token_files.encoded([])) == []
    found, counts, far = chunks.cut([b"", b" one. two\nthree", "a　b".encode(), b""], token_files.encoder().vocabulary.kinds)
    assert found.to_pylist() == [" one", ".", " two", "\n", "three"]
    assert counts.tolist() == [0, 5, 0, 0] and far.tolist() == [False, False, True, False]


def test_vocabularies_with_other_patterns_are_not_cut_by_bytes(plain, monkeypatch):
    monkeypatch.setattr(token_files.encoder().vocabulary, "even", False)
    texts = ["one. two\nthree", "", "zqxt's zqxt"]
    assert [ids.tolist() for ids in token_files.encoded(texts)] == [plain(t) for t in texts]
