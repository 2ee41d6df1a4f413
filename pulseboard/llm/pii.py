"""Personal data: fixed formats, and contextual extraction bootstrapped from them.

Entities of fixed format are the seeds. The words around each mention are its lexical
patterns. Tokens that look like identifiers but fit no format are candidates, with
patterns of their own. Over the graph of patterns and instances, in rounds: a pattern is
as good as the share of confident instances among those it meets; an instance is as
likely as the average pattern before it, after it or around it. Only sides where most
patterns are trusted speak, so an instance does not become likely by standing in many
places. What ends up confident is personal data.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm.common import map_batches, stored, table

KINDS = ("email", "ip", "card", "phone", "id")
CANDIDATE = KINDS.index("id")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, and saying so keeps the search linear.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT, NO_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]")
# Words end at spaces and at the marks that separate fields. A candidate is a run between
# such marks or characters that are not ASCII, or digit groups joined by single spaces.
SEPARATORS = frozenset(",;=:|\"'`()[]{}<>")
WORD = re.compile(r"[^\s,;=:|\"'`()\[\]{}<>]+")
RUN = re.compile(r"\+?[A-Za-z0-9](?:[!#$%&*+./@\\^_~A-Za-z0-9-]*[A-Za-z0-9])?")
GROUPS = re.compile(r"(?<![A-Za-z0-9-])(?:\+?(?:[0-9]++ )?\([0-9]++\) ?"
                    r"|\+?[A-Za-z]{0,4}[0-9]++(?:-[0-9]++)*+(?: [A-Z]{4})? )"
                    r"[0-9]++(?:-[0-9]++)*+(?: [0-9]++(?:-[0-9]++)*+)*(?![A-Za-z0-9])")
WRAP = "\"'`.,;:!?()[]{}<>"

ROUNDS = 3
SUPPORT = 5  # distinct confident instances a pattern needs
CONFIDENT = 0.9
TRUST = 0.8  # share of confident instances from which a pattern speaks for others

MENTION = ("start", "end", "kind", "instance", "before", "after", "both")
FIELDS = {"doc_id": "bigint", **{f"m_{n}": "array<bigint>" for n in MENTION}}
DOCUMENT = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
            "n_chars": "bigint"}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: every @ with the local part before it and a
    domain after it. A long run of letters is walked once, not once from each letter."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats, by start, then kind."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in (
                    part.lstrip("0") for part in m.group().split(".")))]
        for m in CARD.finditer(text):
            digits = NO_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                    if 10 <= len(NO_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts), 7) - (1 << 63)


def _word(text: str, at: int, forward: bool) -> str:
    """The next word from ``at``, lower-cased, without marks around it; '' if none."""
    if forward:
        found = WORD.search(text, at)
        return text[found.start(): min(found.end(), found.start() + 64)].strip(
            WRAP).lower() if found else ""
    stop = at
    while stop and (text[stop - 1].isspace() or text[stop - 1] in SEPARATORS):
        stop -= 1
    start = stop
    while start and stop - start < 64 and not (
            text[start - 1].isspace() or text[start - 1] in SEPARATORS):
        start -= 1
    return text[start:stop].strip(WRAP).lower()


def candidates(text: str, seeds: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs with a digit, of any length, in what the seeds leave of the text; digit groups
    that spaces or brackets part are one more candidate as a whole."""
    out, at = [], 0
    for start, _, end in [*seeds, (len(text), 0, len(text))]:
        if start > at:
            out += [m.span() for m in RUN.finditer(text, at, start) if DIGIT.search(m.group())]
            out += [m.span() for m in GROUPS.finditer(text, at, start)]
        at = max(at, end)
    return out


def mentions(text: str) -> list[tuple]:
    """Seeds and candidates of a text: (start, end, kind, instance, three patterns)."""
    spans = base_spans(text)
    found = [(a, b, k) for a, k, b in spans]
    if DIGIT.search(text):
        found += [(a, b, CANDIDATE) for a, b in candidates(text, spans)]
    out = []
    for a, b, kind in found:
        before, after = _word(text, a, False), _word(text, b, True)
        out.append((a, b, kind, _hash("i", text[a:b]), _hash("b", before), _hash("a", after),
                    _hash("ab", before, after)))
    return out


def find(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Input rows (the given columns, text among the input) with arrays of mentions and a
    row number; stored, so the number stays with its row."""
    fields = {**columns, **{k: v for k, v in FIELDS.items() if k != "doc_id"}}

    def step():
        def work(batch):
            rows = [mentions(t or "") for t in batch.column("text").to_pylist()]
            out = {c: batch.column(c) for c in columns}
            for i, name in enumerate(MENTION):
                out[f"m_{name}"] = [[m[i] for m in row] for row in rows]
            return out
        return work

    names = dict.fromkeys([*columns, "text"])
    read = docs.select(*[F.col(c).cast({**DOCUMENT, **columns}[c]).alias(c) for c in names])
    return stored(map_batches(read, step, fields).withColumn(
        "row", F.monotonically_increasing_id()), "mentions")


def _mentions(rows: DataFrame) -> DataFrame:
    zipped = F.arrays_zip(*[F.col(f"m_{n}").alias(n) for n in MENTION])
    return rows.where(F.size("m_start") > 0).select("row", F.explode(zipped).alias("m")).select(
        "row", *[F.col("m")[n].alias(n) for n in MENTION])


def discover(rows: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT,
             confident: float = CONFIDENT, least: float = TRUST) -> DataFrame:
    """(instance) of the candidates found to be personal data.

    A pattern is trusted if its share of confident instances is ``least`` or more and it
    has met ``support`` of them, a discovered one counting half a seed. On each side
    (before, after, both) an instance has the mean trust of its patterns met by
    ``support`` instances or more, if that is at least ``least`` and no fewer than half of
    all its patterns there are trusted. The sides that are left are taken as independent.

    The graph is grouped to distinct (pattern, instance) edges first; a pattern that very
    many mentions share is summed with partial aggregation, and the joins on it are plain
    joins that adaptive execution splits.
    """
    m = _mentions(rows)
    edges = stored(
        m.select("instance", (F.col("kind") != CANDIDATE).alias("seed"), F.posexplode(
            F.array("before", "after", "both")).alias("side", "pattern"))
        .groupBy("pattern", "side", "instance").agg(F.max("seed").alias("seed")), "edges")
    likely = stored(edges.where("seed").select("instance").distinct()
                    .withColumn("belief", F.lit(1.0)), "beliefs")
    seeds = likely
    for _ in range(rounds):
        sure = F.coalesce("belief", F.lit(0.0))
        known = F.when(sure < confident, 0.0).when(F.col("seed"), 1.0).otherwise(0.5)
        trust = F.col("mass") / (F.col("n") + 1)
        patterns = (edges.join(likely, "instance", "left").groupBy("pattern")
                    .agg(F.sum(sure).alias("mass"), F.count("*").alias("n"),
                         F.sum(known).alias("known"))
                    .where(F.col("n") >= support)
                    .select("pattern", trust.alias("trust"), (
                        (F.col("known") >= support) & (trust >= least)).alias("votes")))
        sides = (edges.where("NOT seed").join(patterns, "pattern", "left")
                 .groupBy("instance", "side").agg(
                     F.avg("trust").alias("mean"), F.count("*").alias("n"),
                     F.count_if(F.coalesce("votes", F.lit(False))).alias("votes"))
                 .where((F.col("mean") >= least) & (2 * F.col("votes") >= F.col("n"))))
        doubt = F.sum(F.log(F.greatest(1 - F.col("mean"), F.lit(1e-9))))
        found = sides.groupBy("instance").agg((1 - F.exp(doubt)).alias("belief"))
        likely = stored(found.join(seeds, "instance", "left_anti").unionByName(seeds), "beliefs")
    return (likely.where(F.col("belief") >= confident).join(seeds, "instance", "left_anti")
            .select("instance"))


def _text(spans: Column) -> Column:
    """kind:start:end joined by commas; spans are (start, kind, end) in order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"].cast("int")), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def with_spans(rows: DataFrame) -> DataFrame:
    """Adds ``base`` and ``found``: arrays of (start, kind, end), by start, then kind.
    Only rows that hold a candidate meet the discoveries."""
    new = stored(
        _mentions(rows).where(F.col("kind") == CANDIDATE).join(discover(rows), "instance")
        .groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")),
        "discovered")
    pairs = F.transform(F.arrays_zip("m_start", "m_kind", "m_end"), lambda s: F.struct(
        s["m_start"].alias("start"), s["m_kind"].alias("kind"), s["m_end"].alias("end")))
    base = F.array_sort(F.filter(pairs, lambda s: s["kind"] != CANDIDATE))
    rows = rows.withColumn("base", base)
    waiting = F.exists("m_kind", lambda k: k == CANDIDATE)
    columns = [c for c in rows.columns if not c.startswith("m_")]
    plain = rows.where(~waiting).select(*columns, F.col("base").alias("found"))
    met = rows.where(waiting).select(*columns).join(new, "row", "left")
    met = met.withColumn("found", F.array_sort(F.concat(
        "base", F.coalesce("more", F.expr("cast(array() as array<struct<start:bigint,"
                                          "kind:bigint,end:bigint>>)"))))).drop("more")
    return plain.unionByName(met)


def detect(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, base counts, digest of the base spans, all spans.

    A null or empty text has none; repeated rows have the same result each; a null doc_id
    is kept. Only doc_id and text are read.
    """
    rows = with_spans(find(docs, {"doc_id": "bigint"}))

    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id", *[n(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:CANDIDATE])],
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
        _text(F.col("found")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets and ``n_chars`` set
    anew. Overlapping spans become one, named after the first. Null texts stay null."""
    rows = with_spans(find(docs, DOCUMENT))
    parts = rows.select(*DOCUMENT, F.expr("transform(found, s -> s.start)").alias("m_start"),
                        F.expr("transform(found, s -> s.kind)").alias("m_kind"),
                        F.expr("transform(found, s -> s.end)").alias("m_end"))

    def step():
        def clean(text, starts, kinds, ends):
            out, at = [], 0
            for a, k, b in zip(starts, kinds, ends):
                if a >= at:
                    out += [text[at:a], f"[{KINDS[k].upper()}]"]
                at = max(at, b)
            return "".join([*out, text[at:]])

        def work(batch):
            texts = [t if t is None or not a else clean(t, a, k, b) for t, a, k, b in zip(
                *(batch.column(c).to_pylist() for c in ("text", "m_start", "m_kind", "m_end")))]
            out = {c: batch.column(c) for c in DOCUMENT}
            out["text"] = texts
            out["n_chars"] = [None if t is None else len(t) for t in texts]
            return out
        return work

    return map_batches(parts, step, DOCUMENT)


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return detect(table(spark, sf_dir, "documents"))
