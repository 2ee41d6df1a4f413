"""Phrase collocations from counting quotient filters.

Words that are frequent enough to be part of a candidate get dense numbers, per language. A
2- or 3-gram is its packed numbers, permuted by an invertible mixing (a Feistel network), so
that the n-grams, however skewed, spread evenly over the range of codes. The leading bits of
a code are its quotient, the others the full remainder: a filter keeps, per quotient, how
many remainders it has (in unary, two bits an entry or less), the remainders and counters of
one byte with an overflow list. It is sorted, lossless and can be inverted.

Each block of about ``BLOCK`` words becomes one filter, cut at the leading byte of the code
into 256 parts. Then filters of up to 256 blocks are merged part by part; as long as there
are several groups of blocks, the result is cut at the next byte and merged again. A merge
never holds more than some million entries, whatever the size of the corpus, and an n-gram
adds one entry to it per block, however often it occurs.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseboard.llm.common import ARROW, slices, stored, table
from pulseboard.llm.positional import decode_values, encode_deltas

BLOCK = 1 << 20  # words of a block
FAN = 256  # blocks whose filters are merged at a time
LEAST = 10  # occurrences of a candidate
COVERED = 50  # per cent of a phrase's occurrences inside one longer phrase that drop it
TOP = 2000
ANY = "und"  # documents without a language

# Letters become small, the ends of pieces a full stop, tabs spaces.
ENDS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(b + 32 if 65 <= b <= 90 else 46 if b in ENDS else 32 if b == 9 else b
             for b in range(256))
KEYS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0x27D4EB2F165667C5)]

BLOCKS = {"block": "bigint", "lang": "string", "word": "string", "local": "int",
          "n": "bigint", "tokens": "binary"}


class _Block:
    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.next = count(1).__next__  # nought parts pieces and documents
        self.names = defaultdict(lambda: defaultdict(self.next, {b".": 0}))
        self.ids = []

    def add(self, lang: str | None, text: str | None) -> None:
        words = (text or "").encode().translate(FOLD).replace(b".", b" . ").split(b" ")
        names = self.names[ANY if lang is None else lang]
        words = [*filter(None, words), b"."]
        self.ids.append(np.fromiter(map(names.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def rows(self):
        schema = pa.schema([(name, ARROW[kind]) for name, kind in BLOCKS.items()])

        def batch(size: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else
                 pa.nulls(size, f.type) for f in schema], schema=schema)

        ids = np.concatenate(self.ids)
        yield batch(1, block=[self.number], tokens=[encode_deltas(ids)[0].tobytes()])
        counts = np.bincount(ids)
        for lang, names in self.names.items():
            words = [(w, k) for w, k in names.items() if k]
            for at in range(0, len(words), 8192):
                part = words[at:at + 8192]
                local = [k for _, k in part]
                yield batch(len(part), block=[self.number] * len(part),
                            lang=[lang] * len(part), word=[w.decode() for w, _ in part],
                            local=local, n=counts[local])


def blocks_of(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row of tokens (numbers of the block's own) per block, and its dictionary."""
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        now = _Block(number)
        for batch in batches:
            for part in slices(batch, 512, 8 << 20):
                for lang, text in zip(part.column("lang").to_pylist(),
                                      part.column("text").to_pylist()):
                    now.add(lang, text)
                    if now.size >= size:
                        yield from now.rows()
                        number += 1
                        now = _Block(number)
        if now.ids:
            yield from now.rows()
        pa.default_memory_pool().release_unused()

    return stored(docs.select(F.col("lang").cast("string"), "text").mapInArrow(
        run, ", ".join(f"{n} {k}" for n, k in BLOCKS.items())), "blocks")


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x + key) * KEYS[0]
    x = (x ^ (x >> np.uint64(29))) * KEYS[1]
    return x ^ (x >> np.uint64(32))


def _masks(bits: int) -> tuple[np.uint64, np.uint64]:
    return np.uint64((1 << bits) - 1), np.uint64((1 << 2 * bits) - 1)


def permute(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of n-grams (three numbers of ``bits`` bits, nought for none), as their leading
    64 bits and up to 32 more, aligned to the left."""
    small, large = _masks(bits)
    w = grams.astype(np.uint64)
    hi, lo = w[:, 0], w[:, 1] << np.uint64(bits) | w[:, 2]
    hi, lo = hi + _mix(lo, KEYS[0]) & small, lo
    lo = lo + _mix(hi, KEYS[1]) & large
    hi = hi + _mix(lo, KEYS[2]) & small
    lo = lo + _mix(hi, KEYS[3]) & large
    lead = hi << np.uint64(64 - bits)
    if 3 * bits <= 64:
        return lead | lo << np.uint64(64 - 3 * bits), np.zeros(len(lo), np.uint32)
    over = np.uint64(3 * bits - 64)
    rest = (lo & np.uint64((1 << int(over)) - 1)) << np.uint64(32) - over
    return lead | lo >> over, rest.astype(np.uint32)


def restore(first: np.ndarray, rest: np.ndarray, bits: int) -> np.ndarray:
    """The n-grams of codes: :func:`permute` undone."""
    small, large = _masks(bits)
    hi = first >> np.uint64(64 - bits)
    if 3 * bits <= 64:
        lo = first >> np.uint64(64 - 3 * bits) & large
    else:
        over = np.uint64(3 * bits - 64)
        lo = (first << over | rest.astype(np.uint64) >> np.uint64(32) - over) & large
    lo = lo - _mix(hi, KEYS[3]) & large
    hi = hi - _mix(lo, KEYS[2]) & small
    lo = lo - _mix(hi, KEYS[1]) & large
    hi = hi - _mix(lo, KEYS[0]) & small
    return np.stack([hi, lo >> np.uint64(bits), lo & small], axis=1).astype(np.int64)


def summed(first: np.ndarray, rest: np.ndarray, counts: np.ndarray | None) -> tuple:
    """Sorted distinct codes with their counts added up."""
    order = np.lexsort((rest, first)) if rest.any() else np.argsort(first)
    first, rest = first[order], rest[order]
    new = np.append(True, (first[1:] != first[:-1]) | (rest[1:] != rest[:-1]))[:len(first)]
    at = np.flatnonzero(new)
    if counts is None:
        totals = np.diff(np.append(at, len(first)))
    else:
        totals = np.add.reduceat(counts[order], at) if len(at) else counts
    return first[at], rest[at], totals.astype(np.int64)


def encode_filter(first: np.ndarray, rest: np.ndarray, counts: np.ndarray, lead: int,
                  width: int) -> bytes:
    """A filter of sorted codes of ``width`` bytes that share their ``lead`` first ones."""
    n = len(first)
    quotient = min(3, (n.bit_length() - 1) // 8, width - lead) if n else 0
    raw = np.concatenate([first.astype(">u8").view(np.uint8).reshape(n, 8),
                          rest.astype(">u4").view(np.uint8).reshape(n, 4)], axis=1)
    slot = np.zeros(n, np.int64)
    for k in range(lead, lead + quotient):
        slot = slot << 8 | raw[:, k]
    marks = np.zeros(n + (1 << 8 * quotient), np.uint8)
    run = np.bincount(slot, minlength=1 << 8 * quotient)
    marks[np.cumsum(run) + np.arange(len(run))] = 1  # each run ends with a one
    large = np.flatnonzero(counts > 255)
    head = np.array([n, quotient, len(large)], "<i8")
    return b"".join([head.tobytes(), np.packbits(marks).tobytes(),
                     raw[:, lead + quotient:width].tobytes(),
                     (np.minimum(counts, 256) - 1).astype(np.uint8).tobytes(),
                     large.astype("<i8").tobytes(), counts[large].astype("<i8").tobytes()])


def decode_filter(data: bytes, prefix: bytes, width: int) -> tuple:
    """Codes and counts of a filter; ``prefix`` are the bytes that all codes share."""
    n, quotient, large = np.frombuffer(data, "<i8", 3).tolist()
    slots, at = 1 << 8 * quotient, 24
    size = -(-(n + slots) // 8)
    marks = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n + slots)
    run = np.diff(np.flatnonzero(marks), prepend=-1) - 1
    slot = np.repeat(np.arange(slots), run)
    raw = np.zeros((n, 12), np.uint8)
    lead = len(prefix)
    raw[:, :lead] = np.frombuffer(prefix, np.uint8)
    for k in range(quotient):
        raw[:, lead + k] = slot >> 8 * (quotient - 1 - k) & 255
    at, left = at + size, width - lead - quotient
    raw[:, lead + quotient:width] = np.frombuffer(data, np.uint8, n * left, at).reshape(n, left)
    at += n * left
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64) + 1
    where = np.frombuffer(data, "<i8", large, at + n)
    counts[where] = np.frombuffer(data, "<i8", large, at + n + 8 * large)
    return (np.ascontiguousarray(raw[:, :8]).view(">u8").ravel().astype(np.uint64),
            np.ascontiguousarray(raw[:, 8:]).view(">u4").ravel().astype(np.uint32), counts)


def _parts(codes: tuple, prefix: bytes, bits: int) -> list[tuple[bytes, bytes]]:
    """(prefix, filter) of the codes, cut at the byte behind ``prefix``."""
    first, rest, counts = codes
    lead, width = len(prefix), -(-3 * bits // 8)
    byte = first >> np.uint64(56 - 8 * lead) & np.uint64(255)
    ends = np.searchsorted(byte, np.arange(257))
    return [(prefix + bytes([b]), encode_filter(first[s:e], rest[s:e], counts[s:e], lead + 1,
                                                width))
            for b, (s, e) in enumerate(zip(ends, ends[1:])) if e > s]


FILTER = "grp long, prefix binary, filter binary"


def _block_filter(bits: int):
    def build(tokens: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        if not len(tokens) or not len(names):
            return pd.DataFrame([], columns=["grp", "prefix", "filter"])
        local = decode_values(tokens["tokens"].iloc[0])
        number = np.zeros(int(local.max()) + 1, np.int64)
        number[names["local"].to_numpy()] = names["number"].to_numpy()
        w = np.concatenate([number[local], [0, 0]])
        two = (w[:-2] > 0) & (w[1:-1] > 0)
        three = two & (w[2:] > 0)
        grams = np.stack([w[:-2], w[1:-1], w[2:]], axis=1)
        pairs = grams[two]
        pairs[:, 2] = 0
        codes = summed(*permute(np.concatenate([pairs, grams[three]]), bits), None)
        parts = _parts(codes, b"", bits)
        return pd.DataFrame([(int(tokens["grp"].iloc[0]), *p) for p in parts],
                            columns=["grp", "prefix", "filter"])
    return build


def _merged(filters: pd.DataFrame, bits: int) -> tuple:
    prefix, width = bytes(filters["prefix"].iloc[0]), -(-3 * bits // 8)
    parts = [decode_filter(bytes(f), prefix, width) for f in filters["filter"]]
    return summed(*(np.concatenate(c) for c in zip(*parts)))


def _merge(bits: int, groups: int):
    def step(filters: pd.DataFrame) -> pd.DataFrame:
        codes, prefix = _merged(filters, bits), bytes(filters["prefix"].iloc[0])
        deep = len(prefix) + 1 <= min(7, -(-3 * bits // 8))
        parts = _parts(codes, prefix, bits) if deep else [
            (prefix, encode_filter(*codes, len(prefix), -(-3 * bits // 8)))]
        group = int(filters["grp"].iloc[0]) % groups
        return pd.DataFrame([(group, *p) for p in parts], columns=["grp", "prefix", "filter"])
    return step


def _frequent(bits: int, least: int):
    def step(filters: pd.DataFrame) -> pd.DataFrame:
        first, rest, counts = _merged(filters, bits)
        keep = counts >= least
        grams = restore(first[keep], rest[keep], bits)
        return pd.DataFrame({"w1": grams[:, 0], "w2": grams[:, 1], "w3": grams[:, 2],
                             "a": counts[keep]})
    return step


def numbered_words(words: DataFrame) -> DataFrame:
    """Dense numbers from 1 on: the rank in one of many buckets, buckets taken in turn."""
    buckets = max(1, words.count() // 4096)
    words = words.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(buckets)))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    return words.select("lang", "word", "f", (
        (rank - 1) * F.lit(buckets) + F.col("bucket") + 1).cast("long").alias("number"))


def counted(docs: DataFrame, least: int = LEAST, block: int = BLOCK,
            fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n), (lang, word, f, number) of the words with f >= least, and the counts
    (w1, w2, w3, a) of the 2-grams (w3 is nought) and 3-grams with a >= least.

    A word that is rarer than ``least`` cannot be in such an n-gram, so it gets no number.
    """
    rows = blocks_of(docs, block)
    names, tokens = rows.where("word IS NOT NULL"), rows.where("tokens IS NOT NULL")
    every = stored(names.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    sizes = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = stored(numbered_words(every.where(F.col("f") >= least)), "frequent")
    most = words.agg(F.max("number")).first()[0]
    if most is None:
        none = words.select(*[F.lit(0).cast("long").alias(c) for c in ("w1", "w2", "w3", "a")])
        return sizes, words, none.where("false")
    bits = max(3, int(most).bit_length())
    if bits > 32:
        raise ValueError("more than 2^32 frequent words")
    groups = -(-tokens.count() // fan)
    tokens = tokens.select("block", "tokens", F.pmod(
        F.xxhash64("block"), F.lit(groups)).alias("grp"))
    known = names.join(words.select("lang", "word", "number"), ["lang", "word"]).select(
        "block", "local", "number")
    filters = (tokens.groupBy("block").cogroup(known.toDF(*known.columns).groupBy("block"))
               .applyInPandas(_block_filter(bits), FILTER))
    while groups > 1:
        above = -(-groups // fan)
        filters = stored(filters.groupBy("grp", "prefix").applyInPandas(
            _merge(bits, above), FILTER), "filters")
        groups = above
    grams = filters.groupBy("prefix").applyInPandas(
        _frequent(bits, least), "w1 long, w2 long, w3 long, a long")
    return sizes, words, stored(grams, "grams")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits."""
    def big(name):
        return f"CAST({name} AS DECIMAL(19, 0))"
    return F.expr(f"CAST({big(a)} * {big(a)} * 1000000 AS DECIMAL(38, 0)) "
                  f"div CAST({big(left)} * {big(right)} AS DECIMAL(38, 0))")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, block: int = BLOCK,
                 fan: int = FAN) -> DataFrame:
    """The best phrases of each language by rank.

    A null text has no words, a null language is ``und``; texts, repeated rows and ids are
    counted as they come (only lang and text are read). Ties are broken by the phrase. An
    empty table has no phrases. Joins on words are plain ones, so adaptive execution splits
    those of a very common word; the ranking ships at most ``top`` rows of a language from a
    task.
    """
    sizes, words, grams = counted(docs, least, block, fan)
    pairs, threes = grams.where("w3 = 0"), grams.where("w3 > 0")
    pairs = pairs.select("w1", "w2", "a")
    inside = (threes.select("w1", "w2", "a").unionByName(threes.select(
        F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
        .groupBy("w1", "w2").agg(F.max("a").alias("longer")))
    left = pairs.join(inside, ["w1", "w2"], "left").where(
        f"longer IS NULL OR 100 * longer < {COVERED} * a").select(
        "w1", "w2", F.lit(0).cast("long").alias("w3"), "a",
        F.lit(None).cast("long").alias("head"), F.lit(None).cast("long").alias("tail"))
    whole = (threes.join(pairs.toDF("w1", "w2", "head"), ["w1", "w2"])
             .join(pairs.toDF("w2", "w3", "tail"), ["w2", "w3"])
             .select("w1", "w2", "w3", "a", "head", "tail"))
    rows = left.unionByName(whole)
    for k in (1, 2, 3):
        rows = rows.join(words.select(
            F.col("number").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("f").alias(
                f"f{k}"), *([F.col("lang")] if k == 1 else [])), f"w{k}",
            "inner" if k < 3 else "left")
    two = F.col("w3") == 0
    rows = rows.withColumn("r1", F.when(two, F.col("f2")).otherwise(F.col("tail"))).withColumn(
        "s1", _score("a", "f1", "r1")).withColumn(
        "s2", F.when(~two, _score("a", "head", "f3")))
    second = ~two & (F.col("s2") < F.col("s1"))
    rows = rows.select(
        "lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a",
        F.when(second, F.col("head")).otherwise(F.col("f1")).alias("l"),
        F.when(second, F.col("f3")).otherwise(F.col("r1")).alias("r"),
        F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(sizes, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"))


def op12_quotient_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language in all documents."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
      coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
one AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM p) GROUP BY ALL),
size AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY 1),
two AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS a FROM p, range(1, len(w)) t(i)
        GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS a
          FROM p, range(1, len(w) - 1) t(i) GROUP BY ALL HAVING count(*) >= 10),
longer AS (SELECT lang, x, y, max(a) AS m FROM (
    SELECT lang, x, y, a FROM three UNION ALL SELECT lang, y, z, a FROM three) GROUP BY ALL),
cut AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.a, 1 AS k, u.f AS l, v.f AS r
  FROM two t JOIN one u ON u.lang = t.lang AND u.w = t.x
  JOIN one v ON v.lang = t.lang AND v.w = t.y
  LEFT JOIN longer g ON g.lang = t.lang AND g.x = t.x AND g.y = t.y
  WHERE g.m IS NULL OR 100 * g.m < 50 * t.a
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.a, 1, u.f, v.a
  FROM three t JOIN one u ON u.lang = t.lang AND u.w = t.x
  JOIN two v ON v.lang = t.lang AND v.x = t.y AND v.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.a, 2, v.a, u.f
  FROM three t JOIN one u ON u.lang = t.lang AND u.w = t.z
  JOIN two v ON v.lang = t.lang AND v.x = t.x AND v.y = t.y),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut),
best AS (SELECT * FROM scored
         QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
           AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= 2000
"""
