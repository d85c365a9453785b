"""Merkle manifest of a dataset: leaves and outer nodes meet by superblock.

Every row is a leaf; the leaves of a language, in order of ``doc_id``, are the base of a binary tree,
and the roots of the languages, in order, are the base of the last tree. A tree is cut into
superblocks of ``2 ** HEIGHT`` neighbours. Going up, one grouping reduces every superblock to its top
node; these are the base of the next, much smaller storey, until each tree is one node. Going down,
the nodes of a storey and the outer nodes that they require, one row per superblock with the siblings
above it, are cogrouped by superblock: one call reduces the block once more, joins each node's
siblings within the block to those above, and, at the leaves, folds every proof to a root.

Spark deals the leaves by ranges, counts them per range, and deals superblocks to tasks, so neither a
language with a third of all rows nor one task ever holds a whole tree. A call holds one superblock.
Every storey is a stored table, so a lost executor costs a read.

Defined results: a null column counts as ``-`` in its leaf. Rows without a ``doc_id`` come first in
their language and are never tampered with; rows with equal ``doc_id`` are ordered by leaf, and equal
rows are leaves of their own. A null language is a language, the first one. A null ``n_chars`` can't
be tampered with, so such a row stays verified. Very long texts are hashed where they are read and
never shuffled. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.llm.common import documents, field, ordered, placed, stored

# Children of a node, columns of a leaf in order, one document in so many is tampered with.
FANOUT = 2
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 7
HEIGHT = 11  # levels of a superblock

NODES = "tree long, pos long, node string, n long"
OUTER = "tree long, block long, path array<string>, subroot string, root string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(columns: dict[str, Column]) -> Column:
    """The leaf digest of a row's columns."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(part(columns[name]) for name in LEAF)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, changed): ``changed`` is the leaf of a row tampered with, else null."""
    own = {name: field(name) for name in LEAF}
    more = own | {"n_chars": own["n_chars"].cast("decimal(20,0)") + 1}
    hit = F.crc32(own["doc_id"].cast("string")) % TAMPERED == 0
    return docs.select(own["doc_id"], own["lang"], leaf_of(own).alias("leaf"),
                       F.when(hit, leaf_of(more)).alias("changed"))


def levels(nodes: list[str], n: int, height: int) -> list[list[str]]:
    """The nodes of a superblock, level by level; ``n`` counts the whole tree's nodes."""
    out = [nodes]
    for _ in range(height):
        if n == 1:
            break
        nodes = [digest(*nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        n = -(-n // FANOUT)
        out.append(nodes)
    return out


def siblings(block: list[list[str]], place: int) -> list[str]:
    """The sibling on each level below the block's top, after ``<`` or ``>`` for its side; '' if none."""
    path = []
    for nodes in block[:-1]:
        other = place ^ 1
        path.append("" if other >= len(nodes) else ("<" if other < place else ">") + nodes[other])
        place //= FANOUT
    return path


def fold(node: str, path: Iterable[str]) -> str:
    """The root that a node and its siblings lead to."""
    for other in path:
        node = digest(other[1:], node) if other[:1] == "<" else digest(node, other[1:])
    return node


def proof(path: Iterable[str]) -> str:
    """The digest of all siblings of a path."""
    return digest(*(other[1:] for other in path))


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", height))


def _reduced(group: pd.DataFrame, height: int) -> pd.DataFrame:
    group = group.sort_values("pos")
    n = int(group["n"].iloc[0])
    top = levels(group["node"].tolist(), n, height)[-1][0]
    return pd.DataFrame({"tree": group["tree"].iloc[:1], "pos": group["block"].iloc[0], "node": top,
                         "n": -(-n // (FANOUT**height))})


def _met(nodes: pd.DataFrame, outer: pd.DataFrame, height: int) -> tuple[pd.DataFrame, list[list[str]], str, str]:
    """A superblock in order, the path of each of its nodes, the root of its tree and of all trees."""
    nodes = nodes.sort_values("pos")
    above = list(outer["path"].iloc[0])
    block = levels(nodes["node"].tolist(), int(nodes["n"].iloc[0]), height)
    paths = [siblings(block, i) + above for i in range(len(nodes))]
    return nodes, paths, outer["subroot"].iloc[0], outer["root"].iloc[0]


def _inner(nodes: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    nodes, paths, subroot, root = _met(nodes, outer, height)
    return pd.DataFrame({"tree": nodes["tree"], "block": nodes["pos"], "path": paths, "subroot": subroot, "root": root})


def _proved(nodes: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    nodes, paths, subroot, root = _met(nodes, outer, height)
    held = nodes["changed"].where(nodes["changed"].notna(), nodes["node"])
    folded = [fold(node, path) for node, path in zip(held, paths, strict=True)]
    return pd.DataFrame({
        "doc_id": nodes["doc_id"], "leaf": nodes["node"], "subroot": subroot, "root": root,
        "proof_sha256": [proof(path) for path in paths], "folded_root": folded,
        "verified": [f == root for f in folded]})


def storeys(base: DataFrame, height: int) -> list[DataFrame]:
    """The base of (tree, pos, node, n) and each storey above it, up to one node per tree."""
    out, nodes = [base], base.select("tree", "pos", "node", "n")
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        nodes = stored(_blocks(nodes, height).groupBy("tree", "block").applyInPandas(
            lambda group: _reduced(group, height), NODES), "merkle-storey")
        out.append(nodes)
    return out


def _cogrouped(nodes: DataFrame, outer: DataFrame, height: int, meet, schema: str) -> DataFrame:
    left = _blocks(nodes, height).groupBy("tree", "block")
    return left.cogroup(outer.groupBy("tree", "block")).applyInPandas(
        lambda a, b: meet(a, b, height), schema)


def descended(tree: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """Outer nodes for the superblocks of a tree's base, from those above its top node."""
    for nodes in tree[-2:0:-1]:
        outer = stored(_cogrouped(nodes, outer, height, _inner, OUTER), "merkle-outer")
    return outer


def _based(docs: DataFrame) -> DataFrame:
    """The leaves with their tree (number of the language), place, and the trees in all."""
    base = stored(leaves(docs), "merkle-leaves").withColumn("row_", F.monotonically_increasing_id())
    laid, runs = ordered(base, ["lang"], ["doc_id", "leaf", "row_"], "merkle-ordered")
    runs = stored(runs, "merkle-runs")
    langs, spans = ordered(runs.select("lang").distinct(), [], ["lang"], "merkle-langs")
    langs = placed(langs, spans, []).select(
        F.col("lang").alias("of_lang"), F.col("pos_").alias("tree"), F.col("total_").alias("trees"))
    runs = runs.join(langs, runs["lang"].eqNullSafe(langs["of_lang"])).drop("of_lang")
    return stored(placed(laid, runs, ["lang"]).select(
        "tree", F.col("pos_").alias("pos"), F.col("leaf").alias("node"), F.col("total_").alias("n"),
        F.col("doc_id").cast("string").alias("doc_id"), "changed", "trees"), "merkle-base")


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """A row per document: leaf, root of its language, root of all, digest and outcome of its proof."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    base = _based(docs)
    tree = storeys(base.drop("trees"), height)
    subroots = tree[-1].select(F.col("tree").alias("pos"), "node")
    trees = base.where("pos = 0").select(F.col("tree").alias("of_tree"), F.col("trees").alias("n"))
    roots = subroots.join(trees, F.col("pos") == F.col("of_tree")).select(zero.alias("tree"), "pos", "node", "n")
    last = storeys(stored(roots, "merkle-roots"), height)
    top = last[-1].select("tree", zero.alias("block"), none.alias("path"), F.col("node").alias("subroot"),
                          F.col("node").alias("root"))
    above = _cogrouped(last[0], descended(last, top, height), height, _inner, OUTER).select("block", "path", "root")
    outer = above.join(subroots, F.col("block") == F.col("pos")).select(
        F.col("block").alias("tree"), zero.alias("block"), "path", F.col("node").alias("subroot"), "root")
    outer = descended(tree, stored(outer, "merkle-outer"), height)
    proved = _cogrouped(
        tree[0], outer, height, _proved,
        "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean")
    return proved.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


SQL = """
WITH RECURSIVE
fields AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [-1 - ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))),
      lambda crc, op: CASE WHEN op < 0 THEN xor(crc, -1 - op)
        ELSE xor(crc // 2, CASE WHEN crc % 2 = 1 THEN 3988292384 ELSE 0 END) END) AS inverse
  FROM documents),
leaves AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN (4294967295 - inverse) % 7 = 0 THEN
      sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS changed
  FROM fields),
langs AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
  FROM (SELECT DISTINCT lang FROM leaves)),
based AS (
  SELECT doc_id, leaf, changed, tree, trees, count(*) OVER (PARTITION BY tree) AS n,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves JOIN langs ON leaves.lang IS NOT DISTINCT FROM langs.lang),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS node, n FROM based
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subroots AS (SELECT tree, node AS subroot, level AS height FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, subroots.tree AS pos, subroot AS node, trees AS n
  FROM subroots JOIN langs ON subroots.tree = langs.tree
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
top AS (SELECT node AS root, level AS levels FROM tops WHERE n = 1),
steps AS (
  SELECT p.tree, p.pos, p.level, (p.pos >> p.level) % 2 AS is_right, nodes.node AS other
  FROM (SELECT b.tree, b.pos, CAST(unnest(range(s.height)) AS INTEGER) AS level
        FROM based b JOIN subroots s ON b.tree = s.tree) p
  LEFT JOIN nodes ON nodes.tree = p.tree AND nodes.level = p.level AND nodes.pos = xor(p.pos >> p.level, 1)
  UNION ALL
  SELECT p.tree, p.pos, p.height + p.level, (p.tree >> p.level) % 2, tops.node
  FROM (SELECT b.tree, b.pos, s.height, CAST(unnest(range(levels)) AS INTEGER) AS level
        FROM based b JOIN subroots s ON b.tree = s.tree, top) p
  LEFT JOIN tops ON tops.level = p.level AND tops.pos = xor(p.tree >> p.level, 1)),
proofs AS (
  SELECT tree, pos, coalesce(string_agg(other, '' ORDER BY level), '') AS siblings FROM steps GROUP BY tree, pos),
folds AS (
  SELECT tree, pos, 0 AS level, coalesce(changed, leaf) AS node FROM based
  UNION ALL
  SELECT folds.tree, folds.pos, folds.level + 1, sha256(
    CASE WHEN other IS NULL THEN node WHEN is_right = 1 THEN other || node ELSE node || other END)
  FROM folds JOIN steps ON steps.tree = folds.tree AND steps.pos = folds.pos AND steps.level = folds.level),
folded AS (SELECT tree, pos, max_by(node, level) AS folded_root FROM folds GROUP BY tree, pos)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM based JOIN folded USING (tree, pos) LEFT JOIN proofs USING (tree, pos)
JOIN subroots ON subroots.tree = based.tree CROSS JOIN top
"""
