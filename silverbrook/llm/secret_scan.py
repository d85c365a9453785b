"""Secret scans: three fixed patterns, and strings that a primed compressor finds new.

The base spans are matches of the patterns below. The method adds ``novel`` spans: runs of secret
material in a sensitive context whose marginal cost under zstandard is high. The compressor is
primed with a dictionary of identifiers common in code and with the text around the candidate, so
names, words and repeated text cost next to nothing and only incompressible strings remain.

Rows are independent and scanned whole; the context of a candidate is a window around it. Defined
results: a null text counts as empty. Spans are in code points, ends exclusive, sorted by start and
then by kind in the order of ``KINDS``. Ties, repeated rows, null ids and empty tables need no rule.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverbrook.llm.common import documents, field, packed, record, unpacked, with_text

KINDS = ("assign", "access", "hex", "novel")
# Fixed patterns of the base kinds, each with the least length of what it must hold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}+")  # runs of [0-9a-f]+ of 24 and more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Candidates of the method: runs of key material with a digit and a letter.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}+")
SENSITIVE = re.compile(
    r"key|secret|token|passw|pwd|auth|bearer|credential|private|signature|session|cookie|akia", re.I | re.A)
CONTEXT = 48  # characters before a candidate in which a sensitive word must stand
AROUND = 512  # characters of surrounding text on either side that prime the compressor
NOVELTY = 0.6  # least marginal bytes per character: more than names or digits cost, less than base64

# Identifiers that code and configuration share; the primed compressor knows them.
IDENTIFIERS = """
abstract access_token account address algorithm api_key application argument array assert async
attribute auth authorization await background base64 basic bearer boolean boundary browser buffer
bytes cache callback certificate char charset class client client_id client_secret close column
command config connection const constructor content-type context continue cookie count create
credential currentUser data database debug decode default define delete description destroy device
dictionary directory document element encode encoding endpoint enum environment error event example
exception export extends false field filename filter final finally float format function generate
getElementById group handler hash header height hidden hostname html http https identifier import
index initialize input insert instance integer interface internal iterator javascript json key label
length library license listener local localhost location logger login lookup main manager map message
metadata method module name namespace network null number object offset option order output override
package parameter parent parse password path pattern payload placeholder plugin pointer port prefix
private private_key process production profile property protected provider proxy public public_key
query queue random read record redirect refresh_token register remote remove render replace repository
request require resource response result return router schema scope script search secret select
sequence serialize server service session settings signature size source start state static status
storage stream string struct style submit subscribe success super switch synchronized system table
target template test thread throw timeout timestamp title token transaction true type undefined union
unique unsigned update upload url user username utf-8 validate value variable vector version virtual
visible void warning while width window with write xmlns your_api_key_here changeme
""".split()
ALPHABETS = "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef"


class Novelty:
    """Marginal compressed bytes of a string after its surroundings."""

    def __init__(self) -> None:
        primer = " ".join([ALPHABETS, *(x.title() for x in IDENTIFIERS), *IDENTIFIERS]).encode()
        self.compressor = zstandard.ZstdCompressor(
            level=9, write_content_size=False,
            dict_data=zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def per_character(self, text: str, start: int, end: int) -> float:
        around = (text[max(0, start - AROUND) : start] + "\n" + text[end : end + AROUND] + "\n").encode()
        cost = len(self.compressor.compress(around + text[start:end].encode())) - len(
            self.compressor.compress(around))
        return cost / (end - start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, sorted."""
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    low = text.encode(errors="replace").lower()
    if any(w.encode() in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return sorted(found)


def novel_spans(text: str, novelty: Novelty) -> list[tuple[int, int, int]]:
    """Candidates in a sensitive context that the primed compressor can't shorten."""
    found = []
    for m in CANDIDATE.finditer(text):
        run, start, end = m[0], m.start(), m.end()
        if run.isalpha() or not any("0" <= x <= "9" for x in run) or not any(x.isalpha() for x in run):
            continue
        if SENSITIVE.search(text, max(0, start - CONTEXT), start) and (
                novelty.per_character(text, start, end) >= NOVELTY):
            found.append((start, 3, end))
    return found


def spans(text: str | None, novelty: Novelty) -> list[tuple[int, int, int]]:
    text = text or ""
    return sorted(base_spans(text) + novel_spans(text, novelty))


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


@F.pandas_udf(record(
    n_assign=T.LongType(), n_access=T.LongType(), n_hex=T.LongType(), n_novel=T.LongType(),
    base_sha256=T.StringType(), spans=T.StringType()))
def scanned(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    novelty = Novelty()
    for batch in texts:
        rows = []
        for text in batch:
            found = spans(text, novelty)
            counts = [sum(k == kind for _, k, _ in found) for kind in range(4)]
            base = joined([x for x in found if x[1] < 3])
            rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), joined(found)))
        yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])


def redact(text: str | None, novelty: Novelty, mark: str = "[REDACTED]") -> str | None:
    """The text with every span, or run of overlapping spans, replaced."""
    found = spans(text, novelty)
    if not found:
        return text
    out, at, upto = [], 0, -1
    for start, _, end in found:
        if start >= upto:
            out += [text[at:start], mark]
        at = upto = max(upto, end)
    return "".join([*out, text[at:]])


@F.pandas_udf(T.StringType())
def redacted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    novelty = Novelty()
    for batch in texts:
        yield batch.map(lambda t: redact(t, novelty))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return docs.select(field("doc_id"), scanned(field("text")).alias("d")).select("doc_id", "d.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets taken out of their texts."""
    rows = packed(docs).withColumn("clean", redacted("row.text"))
    return unpacked(rows.select(with_text("row", F.col("clean"), docs.columns).alias("row")))
