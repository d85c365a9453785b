import random
import re

from silverbrook.llm import secret_scan as S

NOVELTY = S.Novelty()


def literal_base(text):
    """The contract's patterns, word for word."""
    out = []
    for kind, pattern, least, group in (
            (0, r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
            (1, r"AKIA[A-Z0-9]+", 20, 0), (2, r"[0-9a-f]+", 24, 0)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    return sorted(out)


def test_base_spans_equal_patterns():
    rng = random.Random(2)
    parts = ["password", "Token", "secret", "api_key", "APIKEY", "passwd", "=", ":", " ", "\"", "'", "AKIA", "abc",
             "0f" * 14, "ABCDEFGH12345678", "é", "ſ", "x.y-z", "\n", "abcdef"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert S.base_spans(text) == literal_base(text), text


def test_novel_needs_context_and_surprise():
    key = "wJalrXUtnFEMI7K7MDENGbPxRfiCYzQ4"
    assert S.novel_spans(f"my credential is {key} ok", NOVELTY)
    assert not S.novel_spans(f"the weather was {key} today", NOVELTY)
    assert not S.novel_spans("private static_final_buffer1_size_size_size", NOVELTY)
    assert not S.novel_spans(f"{key} again: key {key}", NOVELTY)  # already in the text around it
    assert not S.novel_spans("auth aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", NOVELTY)


def test_report_and_stage(spark):
    secret = "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\""
    rows = [(1, f"é {secret} end", "x", 5), (1, f"é {secret} end", "x", 5), (None, None, "x", None), (2, "", None, 0),
            (3, "word " * 50_000 + secret, "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    got = docs.select("doc_id", S.scanned("text").alias("d")).select("doc_id", "d.*").collect()
    assert [(r["n_assign"], r["n_access"], r["n_hex"]) for r in got] == [(1, 0, 1)] * 2 + [(0, 0, 0)] * 2 + [(1, 0, 1)]
    assert got[0]["spans"].startswith("assign:2:51,hex:11:51")
    clean = S.stage(spark, docs, "")
    assert clean.columns == docs.columns
    out = clean.collect()
    assert len(out) == 5 and all(r["text"] is None or "24be" not in r["text"] for r in out)
    assert out[0]["text"] == "é [REDACTED]\" end" and out[0]["n_chars"] == len(out[0]["text"])
    assert out[2]["text"] is None and out[3]["text"] == ""
    assert S.stage(spark, docs.limit(0), "").count() == 0
