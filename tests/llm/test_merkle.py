"""The Merkle manifest against a plain recursive one, and on awkward inputs."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pulseboard.llm import merkle
from tests.llm.test_operators import DOCS, awkward


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_digest(doc_id, text, lang, source, n_chars):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}"
                 for v in (doc_id, source, lang, n_chars, text)))


def build(nodes):
    """Root, and the way (left siblings, right siblings by level) of every node."""
    ways, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, merged = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at:at + 16]
            for k, group in enumerate(groups[at:at + 16]):
                for leaf in group:
                    ways[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(sha(*run))
            merged.append([leaf for g in groups[at:at + 16] for leaf in g])
        nodes, groups = above, merged
    return nodes[0] if nodes else None, ways


def slow(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        own = sorted(by_source[name], key=lambda r: (
            r[0] is not None, r[0] or 0, row_digest(*r)))
        trees[name] = own, *build([row_digest(*r) for r in own])
    root, tops = build([trees[n][1] for n in names])
    out = []
    for name, top in zip(names, tops):
        own, subroot, ways = trees[name]
        for row, way in zip(own, ways):
            way, text = way + top, row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = row_digest(row[0], text, *row[2:])
            for left, right in way:
                node = sha(left, node, right)
            out.append((row[0], row_digest(*row), subroot, root, sha(*(
                side for level in way for side in level)), node, node == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def many():
    """Trees of one, 16, 17, 256, 257 and 5000 rows; more than 16 sources; equal rows."""
    sizes = {None: 3, "": 1, "a": 16, "b": 17, "c": 256, "d": 257, "é": 5000,
             **{f"s{k}": 1 + k % 2 for k in range(20)}}
    out, doc_id = [], 0
    for source, size in sizes.items():
        for k in range(size):
            doc_id += 1
            out.append((doc_id * 7 % 100003, f"Text {k}", "en", source, k))
    return [*out, *[(None, "Twice", None, "a", None)] * 40, *[(5, "X", "en", "b", 1)] * 3]


@pytest.mark.parametrize("rows", [awkward(), many(), awkward()[:1]], ids=["odd", "many", "one"])
def test_against_plain_tree(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumn("tree", F.lit(1)).withColumn(
        "digest", F.lit("x")).withColumn("i", F.lit(None)).repartition(5)
    got = rows_of(merkle.manifest(docs))
    assert got == slow(rows)
    if len(rows) > 1000:
        assert {r[6] for r in got} == {True, False}


def test_empty_table(spark):
    out = merkle.manifest(spark.createDataFrame([], DOCS))
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "leaf"]
