"""The positional index against brute force over words, and on awkward inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.llm import positional
from tests.llm.test_operators import DOCS, awkward, prose

ITEMS = "item_id long, text string, doc_id long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items):
    """(doc_id, n_words, n_hit, ids, contaminated, n_near) of each document."""
    out = []
    wins = {(i, tuple(w[k:k + 10])) for i, t in items for w in [words(t)] if w
            for k in range(max(1, len(w) - 9))}
    for doc_id, text in docs:
        w, hit, names, near = words(text), set(), set(), set()
        for item, win in wins:
            n = len(win)
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) == win:
                    hit |= set(range(s, s + n))
                    names.add(item)
            if any(set(win) <= set(w[s:s + n + 5]) for s in range(len(w))):
                near.add(item)
        ids = sorted(str(i) for i in names if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(
            ",".join(ids).encode()).hexdigest(), bool(hit), len(near - {None})))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(5)
    source = [prose(s, 60) for s in range(12)]
    items = [(i, source[i][: 40 + 30 * i]) for i in range(8)]
    items += [(7, source[3][20:150]), (20, source[3][:90]), (None, source[9]), (21, "harbour"),
              (22, "moon moon harbour"), (23, ""), (24, None), (25, "!? --"), (26, "nowhere else"),
              (20, source[3][:90])]
    docs = awkward()
    for k in range(40):
        w = prose(100 + k, rng.randrange(1, 50)).split()
        cut = source[rng.randrange(12)].split()
        at, n = rng.randrange(40), rng.randrange(3, 30)
        part = cut[at:at + n]
        if k % 3 == 0:
            part.insert(len(part) // 2, "extra")
        if k % 3 == 1:
            rng.shuffle(part)
        place = rng.randrange(len(w))
        docs.append((1000 + k, " ".join(w[:place] + part + w[place:]).upper(), None, "s", 1))
    return docs, items


@pytest.mark.parametrize("segment, block, parts", [(1 << 20, 16384, 1), (400, 50, 3)])
def test_against_brute_force(spark, planted, monkeypatch, segment, block, parts):
    docs, items = planted
    frame = spark.createDataFrame(docs, DOCS).withColumn("term", F.lit("x")).withColumn(
        "segment", F.lit(1)).repartition(parts)
    asked = spark.createDataFrame([(i, t, 4) for i, t in items], ITEMS)
    monkeypatch.setattr(positional, "SEGMENT", segment)
    monkeypatch.setattr(positional.build_index, "__defaults__", (segment,))
    monkeypatch.setattr(positional.queries, "__defaults__", (block,))
    got = rows(positional.decontaminate(frame, asked))
    assert got == slow([(d[0], d[1]) for d in docs], items)
    assert sum(r[5] for r in got) > 10 and any(r[6] > r[3] for r in got)


def test_empty_tables(spark, planted):
    docs, none = spark.createDataFrame(planted[0], DOCS), spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, prose(2, 300), 0)], ITEMS)
    assert positional.decontaminate(none, items).count() == 0
    clean = positional.decontaminate(docs, items.where("false"))
    assert clean.where("contaminated OR n_near > 0").count() == 0
    assert clean.count() == len(planted[0])


def test_index_is_whole(spark, planted):
    """Every posting of every document is in the index, whatever the segments."""
    docs = spark.createDataFrame(planted[0], DOCS).repartition(2)
    index = positional.build_index(docs, segment=300)
    listed = {(r["segment"]): (positional.decode_places(r["places"]), r["doc_ids"], r["lengths"])
              for r in index.where("term IS NULL").collect()}
    built = []
    for segment, (starts, ids, lengths) in listed.items():
        place = {}
        for r in index.where("term IS NOT NULL").where(F.col("segment") == segment).collect():
            places = positional.decode_places(r["places"])
            assert len(places) == r["n"] and (np.diff(places) > 0).all()
            place.update((int(p), r["term"]) for p in places)
        built += [(i, [place.pop(s + k) for k in range(n)])
                  for s, i, n in zip(starts, ids, lengths)]
        assert place == {}
    assert sorted(built, key=str) == sorted(((d[0], words(d[1])) for d in planted[0]), key=str)


def test_delta_bytes():
    rng = np.random.default_rng(1)
    values = np.concatenate([[0, 127, 128, 16383, 16384, 2 ** 31, 2 ** 34], rng.integers(
        0, 2 ** 30, 200)])
    data, size = positional.encode_deltas(values)
    assert positional.decode_places(data.tobytes()).tolist() == np.cumsum(values).tolist()
    assert len(data) == size.sum() and size[:3].tolist() == [1, 1, 2]
