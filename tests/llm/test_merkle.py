"""The Merkle manifest against a plain tree, and its SQL."""

import hashlib
import zlib

import duckdb
import pytest
from odd import ROWS, SCHEMA, frame

from silverbrook.llm import merkle
from silverbrook.llm.queries import QUERIES

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    count = None if row["n_chars"] is None else row["n_chars"] + more
    parts = [row["doc_id"], row["source"], row["lang"], count, row["text"]]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        out.append((i % 2, nodes[i ^ 1] if i ^ 1 < len(nodes) else None))
        i //= 2
    return out


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r["lang"] == x),
                     key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in own[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(own[x]):
            steps = path(trees[x], i) + path(top, k)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf(r, int(hit))
            for odd, other in steps:
                node = digest(node) if other is None else digest(other, node) if odd else digest(node, other)
            out.append((r["doc_id"], leaf(r), trees[x][-1][0], top[-1][0],
                        digest(*(o for _, o in steps if o)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def result(got):
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 11])
def test_odd_rows(spark, height):
    rows = [dict(zip(SCHEMA.names, r, strict=True)) for r in ROWS]
    want = brute(rows)
    assert {w[-1] for w in want} == {True, False}
    assert result(merkle.manifest(frame(spark), height)) == want


def test_order_of_rows_is_no_matter(spark):
    assert result(merkle.manifest(frame(spark, ROWS[::-1]).repartition(5))) == result(merkle.manifest(frame(spark)))


@pytest.mark.parametrize("rows", [[], ROWS[:1]])
def test_few_rows(spark, rows):
    want = brute([dict(zip(SCHEMA.names, r, strict=True)) for r in rows])
    assert result(merkle.manifest(frame(spark, rows))) == want


def test_tampering_shows(spark):
    rows = [(i, f"text {i}", "en", "a", i) for i in range(300)]
    got = {r["doc_id"]: r["verified"] for r in merkle.manifest(frame(spark, rows), 3).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 7 != 0 for i in range(300)}


def test_query_and_sql(spark, sf):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    assert result(QUERIES["op11_merkle"](spark, sf)) == want
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    cursor = db.execute(merkle.SQL)
    assert [d[0] for d in cursor.description] == COLUMNS
    assert sorted(cursor.fetchall(), key=repr) == want
