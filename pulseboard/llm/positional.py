"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments. A segment holds whole documents, about ``SEGMENT`` words
of them, and its words have places: one after another, with a gap between documents. For
every term of a segment there is one row with the term itself (no hash) and the sorted
places where it stands, as delta-coded bytes. Building it is one pass without a shuffle,
and no term and no source can make a segment larger.

A query is a sequence of words. It is looked for in two steps:

1. Its ``RAREST`` rarest words, by their count in the whole index, are intersected in each
   segment that holds the rarest one. Only the postings of such words are fetched.
2. Where places are left, the postings of the other words are fetched, for these segments
   and words alone, and the lists, each adjusted by its word's offset, are intersected.

What remains are exact occurrences; near ones have all words of the query, in any order,
within ``SLACK`` more words than the query has.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm.common import ARROW, slices, stored, table

SEGMENT = 1 << 20  # words of a segment; one longer document is a segment of its own
WINDOW = 10
SLACK = 5
GAP = 64  # places between documents, so that nothing near crosses from one to the next
RAREST = 3
BLOCK = 16384  # queries that one task looks for in one segment
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of words stay (letters made small), all others become spaces. Bytes from 0x80 on
# belong to characters beyond ASCII, which are all parts of words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122
             else 32 for b in range(256))

INDEX = {"segment": "bigint", "term": "string", "n": "bigint", "places": "binary",
         "doc_ids": "array<bigint>", "lengths": "array<bigint>"}


def encode_deltas(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values (seven bits each, the last byte of a value has none above), and
    how many bytes each takes."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 5):
        size += values >= np.uint64(1 << 7 * k)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    first = ends - size
    for k in range(5):
        there = np.flatnonzero(size > k)
        more = (size[there] > k + 1).astype(np.uint8) << 7
        out[first[there] + k] = ((values[there] >> np.uint64(7 * k)) & np.uint64(127)).astype(
            np.uint8) | more
    return out, size


def decode_values(data: bytes) -> np.ndarray:
    """The values that :func:`encode_deltas` made bytes of."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = raw < 128
    first = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    number = np.cumsum(np.concatenate([[0], last[:-1]]))
    shift = 7 * (np.arange(len(raw)) - first[number])
    return np.add.reduceat((raw & 127).astype(np.int64) << shift, first)


def decode_places(data: bytes) -> np.ndarray:
    """The places of one posting list."""
    return np.cumsum(decode_values(data))


class _Segment:
    def __init__(self, number: int):
        self.number = number
        self.names = defaultdict(count().__next__)
        self.ids, self.docs, self.starts, self.lengths = [], [], [], []
        self.end = self.size = 0

    def add(self, doc_id, text: str | None) -> None:
        words = (text or "").encode().translate(FOLD).split()
        self.ids.append(np.fromiter(map(self.names.__getitem__, words), np.int32, len(words)))
        self.docs.append(doc_id)
        self.starts.append(self.end)
        self.lengths.append(len(words))
        self.end += len(words) + GAP
        self.size += len(words) + 1

    def rows(self):
        """One row of documents, then the rows of terms, in batches."""
        schema = pa.schema([(name, ARROW[kind]) for name, kind in INDEX.items()])

        def batch(size: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
                 for f in schema], schema=schema)

        starts = encode_deltas(np.diff(self.starts, prepend=0))[0].tobytes()
        yield batch(1, segment=[self.number], places=[starts], doc_ids=[self.docs],
                    lengths=[self.lengths])
        if not self.names:
            return
        lengths = np.array(self.lengths)
        ids = np.concatenate(self.ids)
        places = np.arange(len(ids)) + np.repeat(np.arange(len(lengths)) * GAP, lengths)
        order = np.argsort(ids, kind="stable")
        counts = np.bincount(ids)
        places = places[order]
        deltas = np.diff(places, prepend=0)
        heads = np.cumsum(counts) - counts
        deltas[heads] = places[heads]
        data, size = encode_deltas(deltas)
        ends = np.concatenate([[0], np.cumsum(size)])[np.append(heads, len(ids))]
        terms = [w.decode() for w in self.names]
        for at in range(0, len(terms), 4096):
            to = min(at + 4096, len(terms))
            part = data[ends[at]: ends[to]]
            lists = pa.BinaryArray.from_buffers(pa.binary(), to - at, [
                None, pa.py_buffer((ends[at: to + 1] - ends[at]).astype(np.int32)),
                pa.py_buffer(part.tobytes())])
            yield batch(to - at, segment=[self.number] * (to - at), term=terms[at:to],
                        n=counts[at:to], places=lists)


def build_index(docs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The index of all rows, as a written table: rows of terms, and one row (``term`` is
    null) per segment that lists its documents and their first places.

    A null or empty text has no words, but its row is in the list of documents. Rows without
    an id, and repeated ids, are documents of their own. Only doc_id and text are read.
    """
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        now = _Segment(number)
        for batch in batches:
            for part in slices(batch, 512, 8 << 20):
                for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                        part.column("text").to_pylist()):
                    now.add(doc_id, text)
                    if now.size >= segment:
                        yield from now.rows()
                        number += 1
                        now = _Segment(number)
        if now.docs:
            yield from now.rows()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, ", ".join(f"{n} {k}" for n, k in INDEX.items()))
    # Segment numbers come from the tasks, so they are fixed by writing them.
    return stored(rows, "postings")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, words): all runs of ``width`` words of each item, or all its words if it has
    fewer. Items without a word have none."""
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - width)),
                       lambda i: F.slice("w", i + 1, width))
    return (items.select("item_id", words_of(F.col("text")).alias("w"))
            .where(F.size("w") > 0).select("item_id", F.explode(runs).alias("words")).distinct())


def queries(index: DataFrame, phrases: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, q, item_id, words, rare) of the phrases whose words are all in the index;
    ``rare`` are its rarest words, the rarest first."""
    phrases = stored(phrases.select("item_id", "words", F.xxhash64(
        F.col("item_id").cast("string"), "words").alias("q")), "phrases")
    terms = phrases.select("item_id", "words", "q", F.explode(F.array_distinct("words")).alias(
        "term"))
    counts = (index.where("term IS NOT NULL").select("term", "n")
              .join(terms.select("term").distinct(), "term", "left_semi")
              .groupBy("term").agg(F.sum("n").alias("n")))
    ranked = F.array_sort(F.collect_list(F.struct("n", "term")))
    known = (terms.join(counts, "term").groupBy("item_id", "words", "q")
             .agg(ranked.alias("ranked"))
             .where(F.size("ranked") == F.size(F.array_distinct("words"))))
    blocks = max(1, -(-phrases.count() // block))
    return stored(known.select(
        F.pmod("q", F.lit(blocks)).cast("int").alias("block"), "q", "item_id", "words",
        F.slice("ranked.term", 1, RAREST).alias("rare")), "queries")


def _spans(lists: list[np.ndarray], anchors: np.ndarray, span: int) -> np.ndarray:
    """Which anchors lie in some run of ``span`` places that holds a place of every list."""
    starts = anchors[:, None] - np.arange(span)
    ok = np.ones(starts.shape, bool)
    for places in lists:
        at = np.searchsorted(places, starts)
        ok &= (at < len(places)) & (places[np.minimum(at, len(places) - 1)] < starts + span)
    return ok.any(axis=1)


def _anchors(lists: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
    """Step one in one segment: the places of each query's rarest word that have its other
    rare words near."""
    postings, found = {}, []
    raw = dict(zip(lists["term"], lists["places"]))
    for segment, block, q, rare, n_words in wanted[
            ["segment", "block", "q", "rare", "n_words"]].itertuples(index=False):
        if not all(t in raw for t in rare):
            continue
        for t in rare:
            if t not in postings:
                postings[t] = decode_places(raw[t])
        anchors = postings[rare[0]]
        for t in rare[1:]:
            anchors = anchors[_spans([postings[t]], anchors, n_words + SLACK)]
        if len(anchors):
            found.append((segment, block, q, anchors))
    return pd.DataFrame(found, columns=["segment", "block", "q", "anchors"])


MATCH = ("segment long, row long, item_id {kind}, exact boolean, begins array<long>, "
         "ends array<long>")


def _matches(lists: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
    """Step two in one segment: documents with near and exact occurrences of each item."""
    raw = dict(zip(lists["term"].where(lists["term"].notna(), None), lists["places"]))
    starts = decode_places(raw.pop(None))  # of the segment's documents
    postings = {}
    near, runs, first = set(), defaultdict(list), {}
    for segment, item_id, words, anchors in wanted[
            ["segment", "item_id", "words", "anchors"]].itertuples(index=False):
        terms = list(dict.fromkeys(words))
        if not all(t in raw for t in terms):
            continue
        for t in terms:
            if t not in postings:
                postings[t] = decode_places(raw[t])
        key = None if item_id is None or item_id != item_id else item_id
        first["segment"] = segment
        anchors = np.asarray(anchors, np.int64)
        there = _spans([postings[t] for t in terms], anchors, len(words) + SLACK)
        for row in np.searchsorted(starts, anchors[there], side="right") - 1:
            near.add((int(row), key))
        if not there.any():
            continue
        lists_in_order = sorted(((postings[t], k) for k, t in enumerate(words)),
                                key=lambda x: len(x[0]))
        begin = lists_in_order[0][0] - lists_in_order[0][1]
        for places, offset in lists_in_order[1:]:
            at = np.minimum(np.searchsorted(places, begin + offset), len(places) - 1)
            begin = begin[places[at] == begin + offset]
            if not len(begin):
                break
        for row, b in zip(np.searchsorted(starts, begin, side="right") - 1, begin):
            runs[int(row), key].append((int(b), int(b) + len(words)))
    out = []
    for row, key in near | set(runs):
        begins, ends = [], []
        for b, e in sorted(runs.get((row, key), [])):
            if ends and b <= ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                begins.append(b)
                ends.append(e)
        out.append((first["segment"], row, key, bool(begins), begins, ends))
    return pd.DataFrame(out, columns=["segment", "row", "item_id", "exact", "begins", "ends"]
                        ).astype({"item_id": object})


def _paired(a: DataFrame, b: DataFrame, by: list[str]):
    """Two frames grouped together; fresh columns, as both come from the same tables."""
    return a.groupBy(*by).cogroup(b.toDF(*b.columns).groupBy(*by))


def search(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(segment, row, item_id, exact, begins, ends): for each document (its number in the
    segment) and item with a near match, whether one is exact, and the places that exact
    ones cover, as merged runs. ``wanted`` comes from :func:`queries`.

    Both steps group by segment and block of queries: neither side of a group grows with
    the corpus, nor with the number of queries. Postings meet the queries by equality of
    terms; whether a side is broadcast is Spark's own check of its size.
    """
    terms = index.where("term IS NOT NULL")
    rare = wanted.select("block", F.explode("rare").alias("term")).distinct()
    lists = terms.select("segment", "term", "places").join(rare, "term")
    holders = terms.select("segment", "term").join(wanted.select(
        F.col("rare")[0].alias("term"), "block", "q", "rare",
        F.size("words").alias("n_words")), "term").drop("term")
    by = ["segment", "block"]
    anchors = stored(_paired(lists, holders, by).applyInPandas(
        _anchors, "segment long, block int, q long, anchors array<long>"), "anchors")
    left = anchors.join(wanted.select("block", "q", "item_id", "words"), ["block", "q"])
    needed = left.select(*by, F.explode("words").alias("term")).distinct()
    documents = index.where("term IS NULL").select("segment", "places").join(
        left.select(*by).distinct(), "segment").select(
        *by, F.lit(None).cast("string").alias("term"), "places")
    lists = (terms.select("segment", "term", "places").join(needed, ["segment", "term"])
             .select(*by, "term", "places").unionByName(documents))
    kind = wanted.schema["item_id"].dataType.simpleString()
    return _paired(lists, left, by).applyInPandas(
        _matches, MATCH.format(kind=kind))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: words, words hit by a window of an item, items with such windows
    (number and digest of their ids), items near (see the module), and the verdict.

    A null or empty text has no words and is not hit; an item without a word hits nothing.
    Repeated rows and rows without an id are judged each by itself. An item without an id
    hits words, but counts as no item. Ids of items are compared as strings.
    """
    index = build_index(docs)
    found = stored(search(index, queries(index, windows(items, width))), "matches")
    name = F.col("item_id").cast("string")
    runs = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("begins", "ends"))))
    union = F.aggregate(
        runs, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("to")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(r["ends"] - F.greatest(r["begins"], a["to"]), F.lit(0))).alias(
                "n"), F.greatest(a["to"], r["ends"]).alias("to")))["n"]
    hits = found.groupBy("segment", "row").agg(
        union.alias("n_hit"),
        F.array_sort(F.collect_set(F.when(F.col("exact"), name))).alias("names"),
        F.count_distinct(name).alias("n_near"))
    rows = index.where("term IS NULL").select("segment", F.posexplode(F.arrays_zip(
        "doc_ids", "lengths")).alias("row", "d")).select(
        "segment", F.col("row").cast("long"), F.col("d.doc_ids").alias("doc_id"),
        F.col("d.lengths").alias("n_words"))
    zero = F.lit(0).cast("long")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return rows.join(hits, ["segment", "row"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        F.coalesce("n_near", zero).alias("n_near"))


def op11_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items; ``n_near`` counts the items with a window
    whose words all stand, in any order, within five more words than it has."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS words FROM b, range(1, greatest(len(w) - 8, 2)) t(i)
        WHERE len(w) > 0),
q AS (SELECT row_number() OVER () AS q, item_id, words, len(words) AS n FROM win),
place AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
cf AS (SELECT word, count(*) AS c FROM place GROUP BY 1),
anchor AS (SELECT q, word, k FROM (
    SELECT q, unnest(words) AS word, unnest(range(0, n)) AS k FROM q) JOIN cf USING (word)
  QUALIFY row_number() OVER (PARTITION BY q ORDER BY c, word, k) = 1),
start AS (SELECT q, r, p - k AS s FROM anchor JOIN place USING (word)),
exact AS (SELECT q, r, s, n, item_id FROM start JOIN q USING (q) JOIN d USING (r)
          WHERE s > 0 AND w[s:s + n - 1] = words),
near AS (SELECT DISTINCT r, item_id FROM start JOIN q USING (q) JOIN d USING (r)
           JOIN anchor USING (q), range(0, n + 5) t(o)
         WHERE list_has_all(w[greatest(s + k - o, 1):s + k - o + n + 4], words)),
hit AS (SELECT r, count(DISTINCT s + o) AS n_hit FROM exact, range(0, n) t(o) GROUP BY 1),
named AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (
    SELECT DISTINCT r, item_id::VARCHAR AS i FROM exact WHERE item_id IS NOT NULL) GROUP BY 1),
close AS (SELECT r, count(DISTINCT item_id) AS n_near FROM near GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN close USING (r)
"""
