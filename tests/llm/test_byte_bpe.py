import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from silverbrook.llm import byte_bpe as B


@pytest.fixture(scope="module")
def codec():
    return B.codec()


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    return ["", " ", "a", "a" * 3000, "ab" * 2000, " \n\n  x　y", "<|endoftext|>", "日本語テキスト" * 50, "it's WE'LL 123 4567",
            make("abc", 5000), "!?" * 500, make("thenioón é", 20_000), "\x00\x1f\x85\xa0", "🙂" * 40] + [
                make("thenioón ", rng.randrange(60)) for _ in range(1500)]


def test_same_ids_and_round_trip(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "GROUP", 700)  # long texts come in parts
    for text, (n, ids, raw) in zip(texts(), codec.digests(texts()), strict=True):
        want = reference.encode_ordinary(text)
        assert n == len(want)
        assert ids == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert raw == hashlib.sha256(text.encode()).hexdigest()


def test_together_equals_alone(codec):
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"abchet \xc3\xa9") for _ in range(rng.randrange(30))) for _ in range(3000)]
    pieces = [p for p in pieces if p not in codec.ranks]
    assert [x.tolist() for x in codec.merge_all(pieces)] == [codec.merge(p) for p in pieces]
    assert codec.merge_all([]) == []


def test_order_matters_with_odd_ranks(tmp_path):
    """Ranks in which a merge brings up a lower rank: leftmost and lowest first, one at a time."""
    import base64

    rng = random.Random(6)
    for trial in range(30):
        tokens = [bytes([b]) for b in range(256)]
        more = {bytes(rng.choice(b"ab") for _ in range(rng.randrange(2, 6))) for _ in range(25)}
        more = sorted(more)
        rng.shuffle(more)
        path = tmp_path / f"{trial}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens + more)))
        own = B.Codec(str(path))
        for _ in range(60):
            piece = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 25)))
            parts = [piece[i : i + 1] for i in range(len(piece))]
            while piece not in own.ranks:
                known = [(own.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in own.ranks]
                if not known:
                    break
                _, i = min(known)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            want = [own.ranks[piece]] if piece in own.ranks else [own.ranks[p] for p in parts]
            assert own.merge(piece) == want
            if piece not in own.ranks:
                assert own.merge_all([b"ba", piece, b"ab"])[1].tolist() == want


def test_queue_gives_lowest_first():
    rng = random.Random(7)
    queue, held = B.RankQueue(50_000), []
    for _ in range(5000):
        if held and rng.random() < 0.45:
            rank, bucket = queue.pop()
            assert rank == min(held) and len(bucket) == held.count(rank)
            held = [h for h in held if h != rank]
        else:
            held.append(rng.choice([rng.randrange(50_000), rng.randrange(300)]))
            queue.push(held[-1], 0)


def test_on_frames(spark):
    rows = [(1, "hello wörld"), (1, "hello wörld"), (None, None), (2, ""), (3, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = B.stage(spark, docs, "").collect()
    assert [r["doc_id"] for r in got] == [1, 1, None, 2, 3] and got[2]["n_tokens"] == 0
    assert got[2]["ids_sha256"] == got[3]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    back = docs.select("text", B.decoded(B.encoded("text")).alias("b")).collect()
    assert all(bytes(r["b"]).decode() == (r["text"] or "") for r in back)
    assert B.stage(spark, docs.limit(0), "").count() == 0
