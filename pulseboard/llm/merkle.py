"""Merkle manifest of a dataset by cogrouped subtree exchange.

A tree has the rows of one source as leaves, ordered by id; a second tree has the roots of
the sources as leaves. Nodes are numbered in their order, and ``FAN`` consecutive ones make
the node above. A superblock is ``FAN ** HEIGHT`` consecutive nodes, that is, a subtree of
``HEIGHT`` levels, and the unit of work.

Upwards, each superblock is reduced to its top node, and these are the nodes of the next
round; the rounds needed grow with the logarithm of the largest source. Downwards, the nodes
of a superblock are cogrouped with the one row of outer nodes that they need (the siblings
on the way from the top of the superblock to the root): the local reduction is done again,
local siblings and outer ones are joined to proofs, and each leaf is folded to the root. A
group never holds more than one superblock, however large a source is.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseboard.llm.common import stored, table
from pulseboard.llm.positional import LOWER, UPPER

FAN = 16
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 5  # rows whose checksum this divides are tampered with
NODE = "tree string, i long, n long, digest string"
PATH = ("tree string, i long, before array<string>, after array<string>, subroot string, "
        "root string")
PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
         "folded_root string, verified boolean")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of a row: every value with its length in bytes before it, or a dash if null."""
    parts = []
    for value in values.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, changed): ``changed`` is the digest of the tampered row, null
    where a row is left as it is. The null source sorts before all others."""
    own = {name: F.col(name) for name in FIELDS}
    tampered = {**own, "text": F.translate(F.col("text"), UPPER, LOWER)}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long"), leaf_digest(own).alias("digest"),
        F.when(chosen, leaf_digest(tampered)).alias("changed"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``i``, the place of a row in its tree by the given order, and ``n``, the size of
    the tree. Ranges are over tree and order together, and over a hash of the row's number
    behind them, so a large tree and equal rows spread over many tasks; then the counts of
    the ranges are added up."""
    by = ["tree", *order, "_other"]
    spread = rows.withColumn("_other", F.xxhash64(F.monotonically_increasing_id()))
    laid = stored(spread.repartitionByRange(*by).sortWithinPartitions(*by).drop("_other")
                  .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    counts = laid.groupBy("tree", "_part").agg(F.count("*").alias("c"), F.min("_at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("tree", "_part", F.sum("c").over(whole).alias("n"), (
        F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return laid.join(counts, ["tree", "_part"]).withColumn("i", F.col("_at") + F.col("shift")).drop(
        "_at", "_part", "shift")


def _levels(nodes: list[str], n: int) -> list[list[str]]:
    """The levels of one superblock of a tree with ``n`` nodes, up to its top node. A tree is
    reduced while it has several nodes, so the last step may have a run of one."""
    out = [nodes]
    while n > 1 and len(out) <= HEIGHT:
        row = out[-1]
        out.append([digest("".join(row[k:k + FAN])) for k in range(0, len(row), FAN)])
        n = -(-n // FAN)
    return out


def _top(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("i")
    n, size = int(nodes["n"].iloc[0]), FAN ** HEIGHT
    return pd.DataFrame({"tree": [nodes["tree"].iloc[0]], "i": [int(nodes["i"].iloc[0]) // size],
                         "n": [-(-n // size)],
                         "digest": [_levels(nodes["digest"].tolist(), n)[-1][0]]})


def _block() -> Column:
    return F.floor(F.col("i") / FAN ** HEIGHT).alias("block")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of all rounds, each a written table; the last holds the roots."""
    rounds = [nodes]
    while True:
        rounds.append(stored(rounds[-1].select("tree", "i", "n", "digest").groupBy(
            "tree", _block()).applyInPandas(_top, NODE), "nodes"))
        if rounds[-1].where("n > 1").isEmpty():
            return rounds


def _paths(nodes: pd.DataFrame, outer: pd.DataFrame):
    """For each node of a superblock, in order: the row, and its siblings before and after it
    at each level, the outer ones included."""
    nodes, outer = nodes.sort_values("i"), outer.iloc[0]
    levels = _levels(nodes["digest"].tolist(), int(nodes["n"].iloc[0]))
    for k, row in enumerate(nodes.itertuples(index=False)):
        before, after, at = [], [], k
        for level in levels[:-1]:
            run = at - at % FAN
            before.append("".join(level[run:at]))
            after.append("".join(level[at + 1:run + FAN]))
            at //= FAN
        yield row, outer, before + list(outer["before"]), after + list(outer["after"])


def _lower(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    rows = [(row.tree, row.i, before, after, top["subroot"], top["root"])
            for row, top, before, after in _paths(nodes, outer)]
    return pd.DataFrame(rows, columns=["tree", "i", "before", "after", "subroot", "root"])


def _prove(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for row, top, before, after in _paths(nodes, outer):
        proof = digest("".join(b + a for b, a in zip(before, after)))
        node = row.digest if row.changed is None or row.changed != row.changed else row.changed
        for b, a in zip(before, after):
            node = digest(b + node + a)
        rows.append((row.doc_id, row.digest, top["subroot"], top["root"], proof, node,
                     node == top["root"]))
    out = pd.DataFrame(rows, columns=[f.split()[0] for f in PROOF.split(", ")])
    return out.astype({"doc_id": "Int64"})


def exchange(nodes: DataFrame, outer: DataFrame, step, schema: str) -> DataFrame:
    """Every superblock with the outer nodes of its top node."""
    outer = outer.select("tree", F.col("i").alias("block"), "before", "after", "subroot", "root")
    return (nodes.withColumn("block", _block()).groupBy("tree", "block")
            .cogroup(outer.toDF(*outer.columns).groupBy("tree", "block"))
            .applyInPandas(step, schema))


def descend(rounds: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Outer nodes of all superblocks of the first round's nodes, from those of the roots."""
    for nodes in rounds[-2:0:-1]:
        outer = stored(exchange(nodes, outer, _lower, PATH), "outer")
    return outer


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: leaf, subroot of its source, root, digest of its proof, root
    folded from the (if chosen, tampered) leaf and the original siblings, and whether both
    agree.

    Nulls in any of the five columns are values of their own. Rows without an id come first
    in their source and are not tampered with; rows of one id follow each other by leaf, and
    equal rows have equal results but for their siblings. An empty table has no rows.
    """
    rows = numbered(stored(leaves(docs), "leaves"), "doc_id", "digest")
    below = climb(stored(rows, "leaves"))
    roots = below[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    above = climb(stored(numbered(roots, "name"), "subroots"))
    nothing = F.array().cast("array<string>")
    top = above[-1].select("tree", F.lit(0).cast("long").alias("i"), nothing.alias("before"),
                           nothing.alias("after"), F.lit("").alias("subroot"),
                           F.col("digest").alias("root"))
    paths = exchange(above[0].select("tree", "i", "n", "digest"), descend(above, top), _lower,
                     PATH).select("i", "before", "after", "root")
    names = above[0].select("i", F.col("name").alias("tree"), F.col("digest").alias("subroot"))
    outer = paths.join(names, "i").withColumn("i", F.lit(0).cast("long"))
    return exchange(below[0], descend(below, stored(outer, "outer")), _prove, PROOF)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest and proofs of all documents."""
    return manifest(table(spark, sf_dir, "documents"))


def _forest(name: str, start: str, rounds: int) -> str:
    """Statement text: nodes and runs of a forest, and the paths of ``start`` through it."""
    out = []
    for k in range(rounds):
        out.append(f"""{name}_run{k} AS (
  SELECT tree, i // 16 AS i, any_value(n) AS n, list(h ORDER BY i) AS run
  FROM {name}{k} WHERE n > 1 GROUP BY tree, i // 16),
{name}{k + 1} AS (
  SELECT tree, i, (n + 15) // 16 AS n, sha256(array_to_string(run, '')) AS h FROM {name}_run{k}
  UNION ALL SELECT tree, i, n, h FROM {name}{k} WHERE n = 1),
{name}_way{k} AS (
  SELECT r, p.tree, p.i // 16 AS i,
         CASE WHEN run IS NULL THEN node ELSE sha256(array_to_string(run[1:p.i % 16], '') || node
           || array_to_string(run[p.i % 16 + 2:], '')) END AS node,
         CASE WHEN run IS NULL THEN proof ELSE proof || array_to_string(run[1:p.i % 16], '')
           || array_to_string(run[p.i % 16 + 2:], '') END AS proof
  FROM {start if k == 0 else f"{name}_way{k - 1}"} p
  LEFT JOIN {name}_run{k} q ON p.tree = q.tree AND p.i // 16 = q.i)""")
    return ",\n".join(out)


_VALUE = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_ROW = " || ".join(_VALUE.format(c) for c in FIELDS)
_SMALL = f"translate(text, '{UPPER}', '{LOWER}')"

# Sources of up to 16^5 rows and up to 16^3 sources.
SQL = f"""
WITH leaf AS (
  SELECT row_number() OVER () AS r, doc_id,
         CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS tree,
         sha256({_ROW}) AS leaf,
         CASE WHEN xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1),
             lambda k: ascii((doc_id::VARCHAR)[k])::BIGINT), lambda c, b: list_reduce(range(8),
             lambda s, k: xor(s >> 1, 3988292384 * (s & 1)), xor(c, b)), 4294967295::BIGINT),
             4294967295) % 5 = 0
           THEN sha256({_ROW.replace(_VALUE.format("text"), _VALUE.format(_SMALL))}) END AS changed
  FROM documents),
src0 AS (
  SELECT r, doc_id, tree, leaf AS h, changed, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaf),
begin AS (SELECT r, tree, i, coalesce(changed, h) AS node, '' AS proof FROM src0),
{_forest("src", "begin", 5)},
top0 AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS i,
                count(*) OVER () AS n, h FROM src5),
over AS (SELECT p.r, '' AS tree, t.i, p.node, p.proof FROM src_way4 p JOIN top0 t
         ON p.tree = t.name),
{_forest("top", "over", 3)}
SELECT doc_id, src0.h AS leaf, sub.h AS subroot, top3.h AS root, sha256(w.proof) AS proof_sha256,
       w.node AS folded_root, w.node = top3.h AS verified
FROM top_way2 w JOIN src0 USING (r) JOIN src5 sub ON sub.tree = src0.tree CROSS JOIN top3
"""
