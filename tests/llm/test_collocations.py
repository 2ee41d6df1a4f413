"""Quotient filters as exact counters, and collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.llm import collocations as co
from tests.llm.test_operators import DOCS, awkward


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def slow(docs, top=2000, least=10):
    counts = {}
    for lang, text in docs:
        f = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", small(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                f.update(tuple(w[k:k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in chosen.items():
            if len(p) == 2 and any(100 * b >= 50 * a for q, b in chosen.items()
                                   if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n, -score) for rank, (
            score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def fixture():
    rng = random.Random(3)
    common = "the of Of TO naïve İ  x zu\x00y".split(" ")
    rare = [f"w{k}" for k in range(60)]
    fixed = ["new York city", "machine learning", "de facto standard", "a a a", "über alles da"]
    docs = []
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(1, 60)):
            kind = rng.random()
            parts.append(rng.choice(fixed) if kind < .25 else rng.choice(common) if kind < .7
                         else rng.choice(rare))
            if rng.random() < .15:
                parts.append(rng.choice([".", ", ", "\n", "!?", "\t\t", " - "]))
        docs.append((k, " ".join(parts), rng.choice(["en", "en", "de", None, "und", ""]), "s", 1))
    docs += [(500, "x y " * 3000, "xx", None, None), (501, "only. " * 20, "yy", None, 0)]
    return docs + [docs[3]] * 25 + awkward()


@pytest.mark.parametrize("block, fan, parts, top", [
    (1 << 20, 256, 1, 2000), (400, 256, 3, 2000), (800, 4, 2, 5)])
def test_against_brute_force(spark, block, fan, parts, top):
    docs = fixture()
    frame = spark.createDataFrame(docs, DOCS).withColumn("word", F.lit("x")).withColumn(
        "block", F.lit(None)).repartition(parts)
    got = sorted(tuple(r) for r in co.collocations(frame, top, 10, block, fan).collect())
    assert got == slow([(d[2], d[1]) for d in docs], top)
    assert {r[0] for r in got} >= {"en", "de", "und", "xx"}


def test_nothing_to_count(spark):
    for rows in ([], [(1, None, None, None, None)], [(1, "a b", "en", "s", 3)]):
        assert co.collocations(spark.createDataFrame(rows, DOCS)).count() == 0


@pytest.mark.parametrize("bits", [3, 4, 8, 15, 16, 21, 22, 26, 32])
def test_permutation_is_invertible(bits):
    rng = np.random.default_rng(bits)
    grams = rng.integers(0, 1 << bits, (500, 3))
    grams[:3] = [[0, 0, 0], [(1 << bits) - 1] * 3, [1, 0, (1 << bits) - 1]]
    first, rest = co.permute(grams, bits)
    assert co.restore(first, rest, bits).tolist() == grams.tolist()
    assert len(set(zip(first.tolist(), rest.tolist()))) == len({tuple(g) for g in grams.tolist()})
    used = 96 - 3 * bits  # nothing below the code
    whole = [int(a) << 32 | int(b) for a, b in zip(first, rest)]
    assert all(w >> used << used == w for w in whole)


@pytest.mark.parametrize("bits, n", [(3, 40), (8, 3000), (18, 1), (18, 300), (18, 70000),
                                     (24, 5000), (32, 5000)])
def test_filters_are_lossless(bits, n):
    rng = np.random.default_rng(n)
    grams = rng.integers(0, 1 << bits, (n, 3)) // rng.integers(1, 4, (n, 1))
    want = Counter(map(tuple, grams.tolist()))
    counts = rng.choice([1, 2, 255, 256, 257, 10 ** 12], n)
    width = -(-3 * bits // 8)
    codes = co.summed(*co.permute(grams, bits), None)
    totals = co.summed(*co.permute(grams, bits), counts)
    for given in (codes, totals):
        for prefix, data in [(b"", co.encode_filter(*given, 0, width)),
                             *co._parts(given, b"", bits)]:
            first, rest, c = co.decode_filter(data, prefix, width)
            lead = len(prefix)
            keep = (given[0] >> np.uint64(56) == prefix[0]) if lead else np.ones(
                len(given[0]), bool)
            assert [x.tolist() for x in (first, rest, c)] == [x[keep].tolist() for x in given]
    back = co.restore(codes[0], codes[1], bits)
    assert dict(zip(map(tuple, back.tolist()), codes[2].tolist())) == want
    assert totals[2].sum() == counts.sum()
