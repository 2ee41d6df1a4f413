"""Quotation linking: conversations in reply order, without the quotes.

A line's quote level is the number of ``>`` before it. Runs of lines at one level are
passages; they and their lines are normalised and hashed, and so are the messages' own
texts, paragraphs and lines. Equal hashes link a message to the one it quotes.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseboard.llm.common import map_batches, stored, table

QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.S)
INTRO = re.compile(r"[ \t]*(on .{1,200} wrote|.{1,80} (wrote|said|schrieb|a écrit|escribió))"
                   r"[ \t]*:[ \t]*", re.I)
WORDS = 5  # words that must agree with a message of another conversation, unless no third
# conversation holds the passage
SPAN = 1024  # turns of one conversation that are ordered together

PARSED = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string",
          "n_quotes": "bigint", "max_depth": "bigint", "q_depth": "array<bigint>",
          "q_part": "array<bigint>", "q_hash": "array<bigint>", "q_words": "array<bigint>",
 "units": "array<bigint>"}


def key(text: str) -> int | None:
    """Hash of a passage without case, marks at the ends and spacing; None if empty."""
    plain = " ".join(text.lower().split()).strip(" .,;:!?*_")
    return xxhash.xxh64_intdigest(plain, 3) - (1 << 63) if plain else None


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """Own text, and the quoted passages as (depth, text). A line that introduces a quote
    ("... wrote:") right before it is not own text."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    open_depth = 0
    for line in text.split("\n"):
        found = QUOTE.fullmatch(line)
        depth = found.group(1).count(">") if found else 0
        if depth and depth == open_depth:
            passages[-1][1].append(found.group(2))
        elif depth:
            while not open_depth and own and not own[-1].strip():
                own.pop()
            if not open_depth and own and INTRO.fullmatch(own[-1]):
                own.pop()
            passages.append((depth, [found.group(2)]))
        else:
            own.append(line)
        open_depth = depth
    return "\n".join(own).strip("\n"), [(d, "\n".join(lines)) for d, lines in passages]


def _parse_batches():
    def work(batch):
        out = {name: [] for name in PARSED}
        for name in ("conv_id", "turn", "role"):
            out[name] = batch.column(name)
        for text in batch.column("text").to_pylist():
            own, passages = parse(text or "")
            quotes = {}  # (depth, part, hash); part 0 is a whole passage, 1 a line of one
            for depth, passage in passages:
                for part, piece in [(0, passage), *((1, x) for x in passage.split("\n"))]:
                    if (h := key(piece)) is not None:
                        quotes.setdefault((depth, part, h), len(piece.split()))
            units = {h: None for piece in [own, *re.split(r"\n\s*\n", own), *own.split("\n")]
                     if (h := key(piece)) is not None}
            out["text"].append(None if text is None else own)
            out["n_quotes"].append(len(passages))
            out["max_depth"].append(max((d for d, _ in passages), default=0))
            for i, name in enumerate(("q_depth", "q_part", "q_hash")):
                out[name].append([q[i] for q in quotes])
            out["q_words"].append(list(quotes.values()))
            out["units"].append(list(units))
        return out
    return work


def links(rows: DataFrame) -> DataFrame:
    """(row, reply_conv, reply_turn) for each message whose quotes are found.

    A quote means the latest earlier message of its own conversation with that text, else
    the first message of another conversation, smallest conv_id first, however many hold it.
    Such a message must be backed by evidence: a passage of ``WORDS`` words, or lines of the
    quote that all stand in it and have as many words together, or a passage that no other
    conversation holds. The least nested quote decides, a whole passage before a line, then
    the message that more words of the quote agree with.

    Messages with a common line never meet in pairs: each side is reduced to one row per
    hash and conversation, or swept in turn order, and of a hash two conversations go on.
    """
    quotes = rows.where("n_quotes > 0").select(
        "row", "conv_id", "turn", F.explode(F.arrays_zip(
            "q_depth", "q_part", "q_hash", "q_words")).alias("q")).select(
        "row", "conv_id", "turn", F.col("q.q_depth").alias("depth"),
        F.col("q.q_part").alias("part"), F.col("q.q_hash").alias("hash"),
        F.col("q.q_words").alias("words"))
    wanted = quotes.select("hash").distinct()
    units = (rows.select("conv_id", "turn", F.explode("units").alias("hash"))
             .join(wanted, "hash", "left_semi"))
    sweep = quotes.withColumn("unit", F.lit(None).cast("long")).unionByName(
        units.distinct().withColumn("unit", F.col("turn")), allowMissingColumns=True)
    before = (Window.partitionBy("hash", "conv_id").orderBy("turn")
              .rangeBetween(Window.unboundedPreceding, -1))
    near = sweep.withColumn("near", F.max("unit").over(before)).where("row IS NOT NULL")
    holders = units.where("conv_id IS NOT NULL").groupBy("hash", "conv_id").agg(
        F.min("turn").alias("turn"))
    rank = F.row_number().over(Window.partitionBy("hash").orderBy("conv_id"))
    two = holders.withColumn("rank", rank).where("rank <= 2").groupBy("hash").agg(
        F.array_sort(F.collect_list(F.struct("conv_id", "turn"))).alias("two"))
    held = two.join(holders.groupBy("hash").agg(F.count("*").alias("held")), "hash")
    both = near.join(held, "hash", "left").withColumn("other", F.get(F.filter(
        "two", lambda x: ~x["conv_id"].eqNullSafe(F.col("conv_id"))), F.lit(0)))
    own_too = F.exists("two", lambda x: x["conv_id"].eqNullSafe(F.col("conv_id")))
    alone = F.col("held") - F.when(own_too, 1).otherwise(0) == 1
    far = stored(both.where("near IS NULL AND other IS NOT NULL").select(
        "row", "depth", "part", "words", F.col("other.conv_id").alias("conv"),
        F.col("other.turn").alias("at"), alone.alias("alone")), "far")
    lines = quotes.where("part = 1").select("row", "hash", "words").distinct()
    texts = units.select(F.col("conv_id").alias("conv"), F.col("turn").alias("at"),
                         "hash").distinct()
    agreed = (far.select("row", "conv", "at").distinct().join(lines, "row")
              .join(texts, ["conv", "at", "hash"]).groupBy("row", "conv", "at")
              .agg(F.sum("words").alias("agreed")))
    far = far.join(agreed, ["row", "conv", "at"], "left").withColumn(
        "agreed", F.greatest("words", F.coalesce("agreed", F.lit(0)))).where(
        F.col("alone") | (F.col("agreed") >= WORDS))
    target = both.where("near IS NOT NULL").select(
        "row", "depth", "part", F.struct(
            F.lit(0).alias("far"), F.lit(0).cast("long").alias("agreed"),
            F.col("conv_id").alias("conv"), F.col("near").alias("turn")).alias("to")).unionByName(
        far.select("row", "depth", "part", F.struct(
            F.lit(1).alias("far"), "agreed", "conv", F.col("at").alias("turn")).alias("to")))
    order = F.struct("depth", "part", F.col("to.far"), -F.col("to.agreed"), F.when(
        F.col("to.far") == 0, -F.col("to.turn")).otherwise(F.col("to.conv")), F.col("to.turn"))
    best = target.groupBy("row").agg(F.min_by("to", order).alias("to"))
    return best.select("row", F.col("to.conv").alias("reply_conv"),
                       F.col("to.turn").alias("reply_turn"))


def threads(heads: DataFrame) -> DataFrame:
    """(conv_id, thread_id, depth) of conversations that answer another one. ``heads`` has
    (conv_id, parent), one row a conversation. Pointers are doubled until none moves; the
    thread is the conversation at their end, the depth the answers on the way to it.

    Where conversations quote each other in a circle, pointers never rest: the smallest id
    of each circle is made its root.
    """
    while True:
        now = stored(heads.select("conv_id", "parent", F.lit(1).cast("long").alias("depth"),
                                  F.col("conv_id").alias("low")), "threads")
        for _ in range(now.count().bit_length() + 1):
            up = now.select(F.col("conv_id").alias("parent"), F.col("parent").alias("above"),
                            F.col("depth").alias("more"), F.col("low").alias("lower"))
            moved = stored(now.join(up, "parent", "left"), "threads")
            if moved.where("above IS NOT NULL").isEmpty():
                return moved.select("conv_id", F.col("parent").alias("thread_id"), "depth")
            now = moved.select("conv_id", F.coalesce("above", "parent").alias("parent"), (
                F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.least("low", "lower").alias("low"))
        # Each pointer has gone round its circle by now, so it has met the smallest id there.
        roots = moved.where("above IS NOT NULL").select(F.col("lower").alias("conv_id")).distinct()
        heads = stored(heads.join(roots, "conv_id", "left_anti"), "threads")


def link_conversations(messages: DataFrame) -> DataFrame:
    """One row per input row: own text without quotes, the message it answers, its thread
    and place there.

    A message without a linked quote answers the previous turn of its conversation. A
    conversation whose first message answers another conversation joins its thread; the
    thread's id is the conversation at its root. In a thread, conversations follow by how
    many answers they are away from the root, then by conv_id, and turns in each, so an
    answer comes after what it answers. Repeated rows follow each other in any order, a null
    turn comes first; rows without conv_id are one thread of their own, in stored order. A
    null text stays null. Only the four named columns are read.
    """
    read = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                           "role", "text")
    rows = stored(map_batches(read, _parse_batches, PARSED).withColumn(
        "row", F.monotonically_increasing_id()), "messages")
    found = stored(links(rows), "links")
    # Order within spans of turns, then count spans: a long conversation is many groups.
    span = F.when(F.col("conv_id").isNull(), F.shiftright("row", 10)).otherwise(
        F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-1 << 53)))
    slim = rows.select("row", "conv_id", "turn").withColumn("span", span)
    w = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "row")
    inside = slim.withColumn("at", F.row_number().over(w)).withColumn(
        "previous", F.lag("turn").over(w))
    spans = slim.groupBy("conv_id", "span").agg(F.count("*").alias("n"),
                                                F.max("turn").alias("last"))
    heads = (slim.groupBy("conv_id").agg(F.min_by("row", F.struct(
        F.coalesce("turn", F.lit(-1 << 62)), "row")).alias("row")).join(found, "row")
        .where("reply_conv <> conv_id").select("conv_id", F.col("reply_conv").alias("parent")))
    roots = threads(heads)
    placed = spans.join(roots, "conv_id", "left").withColumn(
        "thread_id", F.coalesce("thread_id", "conv_id")).withColumn(
        "depth", F.coalesce("depth", F.lit(0)))
    along = Window.partitionBy("thread_id").orderBy("depth", "conv_id", "span")
    upto = Window.partitionBy("conv_id").orderBy("span")
    placed = placed.withColumn("base", F.sum("n").over(along) - F.col("n")).withColumn(
        "before", F.lag("last").over(upto)).drop("n", "last", "depth")
    places = inside.alias("i").join(placed.alias("p"), (
        F.col("i.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("i.span") == F.col("p.span")))
    ).select("i.row", "p.thread_id", (F.col("base") + F.col("at")).alias("position"),
             F.when(F.col("at") > 1, F.col("previous")).otherwise(F.col("before"))
             .alias("previous")).join(found, "row", "left")
    linked = F.col("reply_turn").isNotNull()
    return rows.join(places, "row").select(
        "thread_id", "position", "conv_id", "turn", "role", "n_quotes", "max_depth",
        linked.alias("quote_linked"),
        F.when(linked, F.col("reply_conv")).when(F.col("previous").isNotNull(), F.col("conv_id"))
        .alias("reply_conv"), F.coalesce("reply_turn", "previous").alias("reply_turn"), "text")


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return link_conversations(table(spark, sf_dir, "conversations"))
