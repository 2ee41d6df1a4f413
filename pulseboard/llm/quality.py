"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and one
failure bit per rule; a policy is a named, versioned mask over those bits, so applying
or changing a policy, or asking what each rule costs, reads the ledger and no text.
Policies are kept as a table with one row per policy, version and rule.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm.common import map_batches, stored, table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Words of which a running English text has at least two.
STOP = ("the", "be", "to", "of", "and", "that", "have", "with")
# Characters counted by class; every class is written so that SQL reads it as well.
CLASSES = {
    "n_digits": "[0-9]", "n_upper": "[A-Z]", "n_letters": "[A-Za-z]",
    "n_wide": r"[^\x00-\x7F]", "n_control": r"[\x01-\x08\x0E-\x1F\x7F]",
    "n_braces": "[{}]", "n_points": "[.,;:!?]",
}
PHRASES = {
    "n_lost": ("\ufffd",), "n_urls": ("http://", "https://"),
    "n_lorem": ("lorem ipsum", "Lorem ipsum"), "n_script": ("javascript", "JavaScript"),
}
SHORT_LINE = 10  # code points
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs",
    "n_chars", *CLASSES, *PHRASES, "n_end_lines", "n_cut_lines", "n_bullet_lines",
    "n_short_lines", "max_line", "max_word", "n_kinds", "n_top_word", "n_stop")

# name, failure condition over the measurements; the place in the list is the bit, so new
# rules come last and none is ever taken out.
RULES = (
    ("short", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("shouting", "100 * n_bangs > 50 * n_words"),
    ("tiny", "n_words < 5"),
    ("short_50", "n_words < 50"),
    ("huge", "n_words > 100000"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("longest_word", "max_word > 1000"),
    ("digits", "100 * n_digits > 20 * word_chars"),
    ("capitals", "100 * n_upper > 30 * n_letters"),
    ("few_letters", "100 * (n_letters + n_wide) < 60 * word_chars"),
    ("wide", "100 * n_wide > 50 * word_chars"),
    ("control", "n_control > 0"),
    ("lost_characters", "n_lost > 0"),
    ("braces", "100 * n_braces > 5 * n_words"),
    ("no_points", "n_points = 0"),
    ("many_points", "100 * n_points > 50 * n_words"),
    ("links", "100 * n_urls > 10 * n_words"),
    ("placeholder", "n_lorem > 0"),
    ("script", "n_script > 0"),
    ("open_lines", "100 * n_end_lines < 12 * n_lines"),
    ("cut_lines", "100 * n_cut_lines > 30 * n_lines"),
    ("bullets", "100 * n_bullet_lines > 90 * n_lines"),
    ("short_lines", "100 * n_short_lines > 67 * n_lines"),
    ("longest_line", "max_line > 100000"),
    ("few_kinds", "100 * n_kinds < 10 * n_words"),
    ("one_word", "100 * n_top_word > 20 * n_words"),
    ("repeated_half", "100 * n_repeat_words > 50 * n_words"),
    ("no_stop_words", "n_stop < 2"),
    ("blank", "2 * word_chars < n_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("short", "repeated_words"))
WEB = Policy("web", 2, (
    "short", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting"))
# rows of the policy table: a version is never changed, a new one is added
POLICIES = (
    BASE, WEB,
    Policy("web", 3, (*WEB.rules, "longest_word", "few_letters", "control", "lost_characters",
                      "placeholder", "cut_lines", "bullets", "few_kinds", "one_word")),
    Policy("prose", 1, ("short_50", "short_words", "long_words", "digits", "capitals", "braces",
                        "no_points", "links", "script", "open_lines", "short_lines")),
    Policy("english", 1, ("short", "no_stop_words", "wide", "few_letters")),
)


def policy_table(spark: SparkSession, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """Policies as rows (policy, version, rule)."""
    return spark.createDataFrame([(p.name, p.version, r) for p in policies for r in p.rules],
                                 "policy string, version int, rule string")


def read_policies(rules: DataFrame) -> list[Policy]:
    """Policies of a table (policy, version, rule), by name and version.

    There are a handful of them, each of at most as many rules as the ledger has bits;
    repeated rows count once. A rule that the ledger does not have is an error, as a
    policy without it would keep what it should drop; so is a row with a null.
    """
    grouped = rules.groupBy("policy", "version").agg(
        F.array_sort(F.collect_set(F.coalesce("rule", F.lit("null")))).alias("rules"))
    found = [Policy(r["policy"], r["version"], tuple(r["rules"])) for r in grouped.collect()]
    for p in found:
        unknown = sorted(set(p.rules) - set(BIT))
        if unknown or p.name is None or p.version is None:
            raise ValueError(f"policy {p.name} version {p.version}: unknown rules {unknown}")
    return sorted(found, key=lambda p: (p.name, p.version))


def repeated_words(ids: np.ndarray, lengths: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Per document, the words inside windows that occur twice or more in that document.

    ``ids`` are word numbers of all documents one after another. Windows get exact
    numbers by doubling: words, pairs, fours, eights (``width`` is a power of two).
    """
    out = np.zeros(len(lengths), np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    if len(ids) < width:
        return out
    names, step = ids.astype(np.int64), 1
    while step < width:
        names = np.unique(names[:-step] * (names.max() + 1) + names[step:],
                          return_inverse=True)[1].astype(np.int64)
        step *= 2
    starts = np.flatnonzero(doc[: len(names)] == doc[width - 1:])
    if not len(starts):
        return out
    _, inverse, counts = np.unique(doc[starts] * (names.max() + 1) + names[starts],
                                   return_inverse=True, return_counts=True)
    starts = starts[counts[inverse] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(lengths)).astype(np.int64)


def word_kinds(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document, its number of distinct words and how often its commonest one stands."""
    kinds = np.zeros(len(lengths), np.int64)
    most = np.zeros(len(lengths), np.int64)
    if len(ids):
        width = int(ids.max()) + 1
        keys, counts = np.unique(np.repeat(np.arange(len(lengths)), lengths) * width + ids,
                                 return_counts=True)
        doc = keys // width
        kinds = np.bincount(doc, minlength=len(lengths)).astype(np.int64)
        np.maximum.at(most, doc, counts)
    return kinds, most


LINE_MEASURES = ("n_lines", "n_dup_lines", "n_end_lines", "n_cut_lines", "n_bullet_lines",
                 "n_short_lines", "max_line")


def _measure():
    classes = {name: re.compile(pattern + "+") for name, pattern in CLASSES.items()}
    stop = {w.encode() for w in STOP}

    def lines(text: str) -> tuple[int, ...]:
        seen, dup, ends, cut, bullets, short, longest = set(), 0, 0, 0, 0, 0, 0
        n = 0
        for line in text.split("\n"):
            body = line.strip(SPACES)
            if body:
                n += 1
                dup += line in seen
                seen.add(line)
                ends += body.endswith((".", "!", "?", '"'))
                cut += body.endswith(("...", "\u2026"))
                bullets += body.startswith(("-", "*", "\u2022"))
                short += len(body) <= SHORT_LINE
                longest = max(longest, len(body))
        return n, dup, ends, cut, bullets, short, longest

    def work(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        numbers = defaultdict(count().__next__)
        ids, lengths, stops, longest = [], [], [], []
        for text in texts:
            words = text.encode().split()
            lengths.append(len(words))
            ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            stops.append(sum(map(stop.__contains__, words)))
            longest.append(max(map(len, words), default=0))
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        sizes = np.array(lengths, np.int64)
        kinds, most = word_kinds(ids, sizes)
        return {
            "doc_id": batch.column("doc_id"), "n_words": lengths,
            "word_chars": [len(t) - sum(map(t.count, SPACES)) for t in texts],
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
            "n_repeat_words": repeated_words(ids, sizes),
            "n_bangs": [t.count("!") for t in texts], "n_chars": list(map(len, texts)),
            **{name: [sum(map(len, found.findall(t))) for t in texts]
               for name, found in classes.items()},
            **{name: [sum(map(t.count, phrases)) for t in texts]
               for name, phrases in PHRASES.items()},
            **dict(zip(LINE_MEASURES, np.array([lines(t) for t in texts], np.int64)
                       .reshape(-1, len(LINE_MEASURES)).T)),
            "max_word": longest, "n_kinds": kinds, "n_top_word": most, "n_stop": stops,
        }
    return work


def ledger(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, measurements, ``fail_bits``.

    Lines are measured without the spaces around them, the longest word in bytes, the rest
    in code points. A null text has no words; a row without doc_id and a repeated row are measured like
    any other. Only doc_id and text are read, so other columns may have any name.
    """
    fields = {"doc_id": "bigint", **dict.fromkeys(MEASURES, "bigint")}
    measured = map_batches(docs.select(F.col("doc_id").cast("long"), "text"), _measure, fields)
    bits = [F.when(F.expr(test), F.lit(BIT[name])).otherwise(0) for name, test in RULES]
    total = bits[0].cast("long")
    for bit in bits[1:]:
        total = total.bitwiseOR(bit.cast("long"))
    return measured.withColumn("fail_bits", total)


def kept(policy: Policy, bits: str | Column = "fail_bits") -> Column:
    col = F.col(bits) if isinstance(bits, str) else bits
    return col.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def kept_by(policies: Sequence[Policy], bits: str = "fail_bits") -> Column:
    """Names and versions of the policies that keep a row: ``name:version``, comma-joined in
    the order given. A row is judged by its bits alone."""
    return F.concat_ws(",", *[F.when(kept(p, bits), F.lit(f"{p.name}:{p.version}"))
                              for p in policies])


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of the policy drops: rule, bit, documents failing it, and documents
    that only this rule drops (those come back when it is left out).

    Counted per distinct bit pattern first, so at most 2^rules rows are shuffled per task.
    """
    pattern = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    patterns = rows.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("docs"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                      for r in policy.rules])
    hit = F.col("pattern").bitwiseAND(F.col("r.bit")) != 0
    return (patterns.select("pattern", "docs", F.explode(rules).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"), F.col("r.bit").alias("bit"))
            .agg(F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("pattern") == F.col("r.bit"), F.col("docs")).otherwise(0))
                 .alias("n_only")))


def op1_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per document under the web policy, version 2, from a stored ledger.

    ``kept_by``: all policies of the table that keep the document. ``only_rule_docs``: for
    a document that a single rule of the web policy drops, how many documents of the corpus
    that rule alone drops; else null.
    """
    rows = stored(ledger(table(spark, sf_dir, "documents")), "ledger")
    policies = read_policies(policy_table(spark))
    web = F.col("fail_bits").bitwiseAND(F.lit(WEB.mask).cast("long"))
    costs = ablations(rows, WEB).select(F.col("bit").alias("_web"),
                                        F.col("n_only").alias("only_rule_docs"))
    return (rows.withColumn("_web", web).join(costs, "_web", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", (~kept(BASE)).alias("base_failed"),
                    kept(WEB).alias("kept"), "fail_bits", kept_by(policies).alias("kept_by"),
                    "only_rule_docs"))


def _counted(pattern: str) -> str:
    """Characters of a class, in SQL: what is left without all others."""
    return f"(length(t) - length(regexp_replace(t, '{pattern}', '', 'g')))::BIGINT"


def _phrased(phrases: Sequence[str]) -> str:
    return " + ".join(f"(length(t) - length(replace(t, '{p}', ''))) // {len(p)}"
                      for p in phrases)


_BITS = " + ".join(f"CASE WHEN {test} THEN {BIT[name]} ELSE 0 END" for name, test in RULES)
_KEPT = ", ".join(f"CASE WHEN fail_bits & {p.mask} = 0 THEN '{p.name}:{p.version}' END"
                  for p in sorted(POLICIES, key=lambda p: (p.name, p.version)))
SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
full_lines AS (SELECT doc_id, line, count(*) AS c,
                      regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS body
               FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
by_line AS (
  SELECT doc_id, sum(c)::BIGINT AS n_lines, sum(c - 1)::BIGINT AS n_dup_lines,
         sum(c * regexp_matches(body, '[.!?"]$')::INT)::BIGINT AS n_end_lines,
         sum(c * regexp_matches(body, '(\.\.\.|…)$')::INT)::BIGINT AS n_cut_lines,
         sum(c * regexp_matches(body, '^[-*•]')::INT)::BIGINT AS n_bullet_lines,
         sum(c * (length(body) <= {SHORT_LINE})::INT)::BIGINT AS n_short_lines,
         max(length(body)) AS max_line FROM full_lines GROUP BY 1),
one_word AS (SELECT doc_id, unnest(w) AS word FROM d),
per_word AS (SELECT doc_id, word, count(*) AS c FROM one_word GROUP BY ALL),
by_word AS (SELECT doc_id, count(*) AS n_kinds, max(c) AS n_top_word,
                   max(strlen(word)) AS max_word,
                   sum(CASE WHEN word IN {STOP} THEN c ELSE 0 END)::BIGINT AS n_stop
            FROM per_word GROUP BY 1),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM places),
twice AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
covered AS (SELECT DISTINCT doc_id, i + o AS p FROM twice, range(0, 8) r(o)),
rep AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY 1),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_bangs,
         length(t) AS n_chars, {", ".join(f"{_counted(p)} AS {n}" for n, p in CLASSES.items())},
         {", ".join(f"{_phrased(p)} AS {n}" for n, p in PHRASES.items())},
         {", ".join(f"coalesce({n}, 0) AS {n}"
                    for n in (*LINE_MEASURES, "n_kinds", "n_top_word", "max_word", "n_stop"))},
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN by_line USING (doc_id) LEFT JOIN by_word USING (doc_id)
  LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, ({_BITS})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits & 63 = 0 AS kept, fail_bits,
       concat_ws(',', {_KEPT}) AS kept_by,
       CASE WHEN fail_bits & 63 IN (1, 2, 4, 8, 16, 32)
            THEN count(*) OVER (PARTITION BY fail_bits & 63) END AS only_rule_docs
FROM b
"""
