"""Exact removal of repeated byte strings by prefix-free parsing.

Triggers cut the texts into phrases: for every string of ``width`` bytes the position
with the smallest rolling hash among its first ``GAP`` ones is its trigger, and a phrase
is everything that the strings of one trigger cover. The choice looks at content alone,
so equal strings have the same trigger and the same place in their phrase; neighbouring
phrases overlap by ``width - 1`` bytes, so every string is in exactly one phrase.

The parse is the list of phrases by document, the dictionary the distinct phrases. A
string occurs twice if its phrase does in the parse, or if two phrases of the dictionary
hold it. For the second, only phrases with equal bytes after the trigger (the core, part
of every string of the phrase) are looked at: first by cells, runs of ``CELL`` strings at
the same place before the trigger, whose common bytes must occur twice, then the suffixes
of the dictionary that are left, each by its first ``width`` bytes. Repetitive text is
settled in the first step, by one row per phrase.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm.common import map_batches, stored, table

WIDTH = 200
GAP = 128  # a phrase begins at least every GAP bytes
CELL = 16
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, as one number (``data`` ends with padding)."""
    return np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))


def digest(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int,
           seed: np.ndarray | int) -> np.ndarray:
    """64-bit hash of the strings of given starts and lengths (at least eight bytes)."""
    out = np.full(len(starts), 0, np.uint64) + np.asarray(seed, np.uint64) * MIX[0]
    longest = int(np.max(lengths)) if len(starts) else 0
    last = starts + lengths - 8
    for at in range(0, longest, 8):
        step = (out ^ words[np.minimum(starts + at, last)]) * MIX[at // 8 % 2]
        step ^= step >> np.uint64(31)
        out = np.where(np.asarray(lengths) > at, step * MIX[0], out)
    return out ^ (out >> np.uint64(29))


def phrases(data: np.ndarray, ends: np.ndarray, width: int, gap: int) -> tuple:
    """Phrases of texts that stand one after another: (text, first string, last string,
    trigger), as positions in ``data``, which has ``width + gap`` bytes of padding."""
    size = int(ends[-1])
    words = words_at(data)
    marks = words[: size + gap] * MIX[0]
    marks = ((marks ^ (marks >> np.uint64(32))) * MIX[1]) >> np.uint64(32)
    marks = (marks << np.uint64(32)) | np.arange(len(marks), dtype=np.uint64)
    rows = marks[: len(marks) // gap * gap].reshape(-1, gap)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    first = np.minimum(right[: len(left) - gap + 1], left[gap - 1:])
    trigger = (first & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    room = np.flatnonzero(ends - begins >= width)
    edge = np.zeros(size + 1, np.int8)
    edge[begins[room]] += 1
    edge[ends[room] - width + 1] -= 1
    whole = np.cumsum(edge[:-1]) > 0  # a string of ``width`` bytes starts here
    if len(trigger) < size:
        trigger = np.append(trigger, np.zeros(size - len(trigger), np.int64))
    trigger = trigger[:size]
    change = np.append(True, trigger[1:] != trigger[:-1])
    starts = np.flatnonzero(whole & (change | np.append(True, ~whole[:-1])))
    stops = np.flatnonzero(whole & (np.append(change[1:], True) | np.append(~whole[1:], True)))
    return np.searchsorted(ends, starts, side="right"), starts, stops, trigger[starts]


def raw_bytes(texts: pa.Array, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each ends."""
    parts = [(t or "").encode() for t in texts.to_pylist()]
    data = np.frombuffer(b"".join([*parts, bytes(padding)]), np.uint8)
    return data, np.cumsum([len(p) for p in parts]).astype(np.int64)


PARSE = {"rk": "bigint", "place": "bigint", "core": "bigint", "phrase": "bigint"}
RUN = {"rk": "bigint", "run": "bigint", "hash": "bigint"}
STRING = {"rk": "bigint", "start": "bigint", "hash": "bigint", "check": "int"}


def parse(keyed: DataFrame, width: int, gap: int) -> DataFrame:
    """One row per phrase: row key, place (first string, distances from it to the trigger
    and to the last string), hash of the core, hash of the phrase with its shape."""
    def step():
        def work(batch):
            data, ends = raw_bytes(batch.column("text"), width + 2 * gap + 8)
            if not len(ends) or not ends[-1]:
                return {name: [] for name in PARSE}
            words = words_at(data)
            text, first, last, trigger = phrases(data, ends, width, gap)
            begins = np.concatenate([[0], ends[:-1]])
            shape = (trigger - first) * gap + (last - first)
            keys = batch.column("rk").to_numpy(zero_copy_only=False)
            return {
                "rk": keys[text], "place": (first - begins[text]) * gap * gap + shape,
                "core": digest(words, trigger, width - gap + 1, 1).view(np.int64),
                "phrase": digest(words, first, last - first + width, shape + 2).view(np.int64)}
        return work

    return map_batches(keyed, step, PARSE, 4096, 4 << 20)


def _listed(batch, column: str, padding: int) -> tuple:
    """Bytes, where texts begin, keys, and the values of a list column with their row."""
    data, ends = raw_bytes(batch.column("text"), padding)
    lists = batch.column(column)
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    return (data, np.concatenate([[0], ends[:-1]]),
            batch.column("rk").to_numpy(zero_copy_only=False),
            lists.flatten().to_numpy(zero_copy_only=False), np.repeat(
                np.arange(len(counts)), counts))


def _ranges(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def cells(tasks: DataFrame, width: int, gap: int, cell: int) -> DataFrame:
    """(rk, run, hash): the cells of the given phrases (``places``: 2 * place + open), as
    runs of strings (2 * (start * gap + number - 1) + open), with the hash of the bytes
    that all strings of a whole cell share."""
    def step():
        def work(batch):
            data, begins, keys, flat, row = _listed(batch, "places", width + gap)
            place, opened = flat >> 1, flat & 1
            first = place // (gap * gap)
            trigger, last = first + place // gap % gap, first + place % gap
            nearest = (trigger - last) // cell
            n = (trigger - first) // cell - nearest + 1
            each = np.repeat(np.arange(len(n)), n)
            top = trigger[each] - (nearest[each] + _ranges(n)) * cell  # its last string
            begin = np.maximum(first[each], top - cell + 1)
            size = np.minimum(last[each], top) - begin
            code = digest(words_at(data), begins[row[each]] + top, width - cell + 1,
                          (trigger[each] - top) + 5)
            return {"rk": keys[row[each]], "run": (begin * gap + size) << 1 | opened[each],
                    "hash": code.view(np.int64)}
        return work

    return map_batches(tasks.select("rk", "text", "places"), step, RUN, 512, 4 << 20)


def strings(tasks: DataFrame, width: int, gap: int) -> DataFrame:
    """(rk, start, hash, check) of every string in the given runs of each text; the last
    bit of ``start`` tells whether its phrase is open."""
    def step():
        def work(batch):
            data, begins, keys, flat, row = _listed(batch, "runs", 8)
            n = (flat >> 1) % gap + 1
            each = np.repeat(np.arange(len(n)), n)
            at = (flat >> 1)[each] // gap + _ranges(n)
            begin, words = begins[row[each]] + at, words_at(data)
            again = digest(words, begin + 4, width - 8, 4)
            return {"rk": keys[row[each]], "start": at << 1 | flat[each] & 1,
                    "hash": digest(words, begin, width, 3).view(np.int64),
                    "check": (again >> np.uint64(32)).astype(np.uint32).view(np.int32)}
        return work

    return map_batches(tasks.select("rk", "text", "runs"), step, STRING, 512, 4 << 20)


def _cut_batches(width: int, gap: int):
    def cut(text, places, starts):
        data = (text or "").encode()
        edge = np.zeros(len(data) + 1, np.int64)
        if places:
            p = np.array(places, np.int64)
            np.add.at(edge, p // (gap * gap), 1)
            np.add.at(edge, p // (gap * gap) + p % gap + width, -1)
        if starts:
            s = np.array(starts, np.int64)
            np.add.at(edge, s, 1)
            np.add.at(edge, s + width, -1)
        gone = np.cumsum(edge[:-1]) > 0
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + bool(len(gone) and gone[0])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        return len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()

    def work(batch):
        rows = [cut(*row) for row in zip(*(batch.column(c).to_pylist()
                                           for c in ("text", "places", "starts")))]
        out = dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"),
                       zip(*rows) if rows else ([], [], [], [])))
        return {"doc_id": batch.column("doc_id"), **out}
    return work


def row_key() -> Column:
    """Rows of one id and one text may share a key: all that is found holds for both."""
    return F.xxhash64("doc_id", "text")


def repeated(docs: DataFrame, width: int = WIDTH, gap: int = GAP,
             cell: int = CELL) -> DataFrame:
    """(rk, places, starts) of the texts that hold a repeated string: whole phrases, and
    starts of single strings.

    Every count is a grouped count with partial aggregation and every way back a plain
    join on one key, which adaptive execution splits where a phrase is in very many texts.
    """
    keyed = docs.select(row_key().alias("rk"), "text")
    rows = stored(parse(keyed, width, gap), "parse")
    cores = stored(rows.groupBy("core").count().where("count > 1").select("core"), "cores")
    live = stored(rows.join(cores, "core", "left_semi"), "live")
    # The dictionary of what is left: distinct phrases, how often they occur, one place.
    words = stored(live.groupBy("core", "phrase").agg(
        F.count("*").alias("n"), F.min(F.struct("rk", "place")).alias("at")), "dictionary")
    settled = live.join(words.where("n > 1").select("core", "phrase"), ["core", "phrase"],
                        "left_semi").select("rk", "place")
    several = words.groupBy("core").count().where("count > 1").select("core")
    opened = (F.col("n") == 1).cast("long")
    tasks = stored(words.join(several, "core", "left_semi").select(
        "at.rk", (F.col("at.place") * 2 + opened).alias("place"))
        .groupBy("rk").agg(F.collect_list("place").alias("places")), "tasks")
    runs = stored(cells(keyed.join(tasks, "rk"), width, gap, cell), "cells")
    shared = runs.groupBy("hash").count().where("count > 1").select("hash")
    tasks = stored(runs.join(shared, "hash", "left_semi").groupBy("rk").agg(
        F.collect_list("run").alias("runs")), "tasks")
    found = stored(strings(keyed.join(tasks, "rk"), width, gap), "strings")
    twice = found.groupBy("hash", "check").count().where("count > 1").select("hash", "check")
    starts = (found.where("start % 2 = 1").join(twice, ["hash", "check"], "left_semi")
              .select("rk", F.floor(F.col("start") / 2).alias("start")))
    marks = settled.select("rk", "place", F.lit(None).cast("long").alias("start")).unionByName(
        starts.select("rk", F.lit(None).cast("long").alias("place"), "start"))
    return stored(marks.groupBy("rk").agg(F.collect_set("place").alias("places"),
                                          F.collect_set("start").alias("starts")), "marks")


def remove_repeats(docs: DataFrame, width: int = WIDTH, gap: int = GAP) -> DataFrame:
    """Per input row: doc_id, bytes, bytes removed, runs removed, digest of what is left.

    A null or empty text has no bytes; texts shorter than ``width`` keep theirs. Repeated
    rows remove each other, like any two equal texts. Only doc_id and text are read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    marks = repeated(docs, width, gap)
    joined = docs.withColumn("rk", row_key()).join(marks, "rk", "left")
    touched = map_batches(
        joined.where("places IS NOT NULL").select("doc_id", "text", "places", "starts"),
        lambda: _cut_batches(width, gap),
        {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint",
         "kept_sha256": "string"})
    text, zero = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    rest = joined.where("places IS NULL").select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), zero.alias("n_removed"),
        zero.alias("n_spans"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
    return touched.unionByName(rest)


def op8_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 200-byte strings that occur elsewhere too."""
    return remove_repeats(table(spark, sf_dir, "documents"))
