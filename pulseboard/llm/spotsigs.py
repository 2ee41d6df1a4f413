"""SpotSigs fingerprints, in DataFrame functions only.

A signature is a very common word (the anchor) with the next content words after it. The
distinct signatures of a text are its fingerprint; two fingerprints are as alike as their
Jaccard coefficient. Where all similar pairs are wanted, fingerprints are partitioned by
their length, since sets of too different lengths cannot be similar, and met on their
rarest signatures only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseboard.llm.common import stored, table
from pulseboard.llm.licenses import normalised

# Fixed word list: very common words of English, French, German and Spanish.
ANCHORS = """a an and are as at be by for from has in is it of on or that the this to was with
au aux ce dans de des du elle en est et il la le les pour que qui se sur un une
auf das dem den der des die ein eine es für ist mit nicht sich sie und von zu
al como con del el las los lo no para por se su un una y""".split()
CHAIN = 2  # content words in a signature
REACH = 3  # further anchors a chain may step over
SIMILAR = 0.8

BUCKET_BYTES = 8 << 20
CUTS = 4096  # bounds inside a coarse range are chosen among this many quantiles


def spots(norm: Column, anchors: list[str] = ANCHORS, chain: int = CHAIN,
          reach: int = REACH) -> Column:
    """Sorted distinct 64-bit hashes of the signatures of a normalised text.

    A chain takes the content words up to the next anchors, at most ``reach`` of them
    stepped over; an anchor with too few words behind it gives none. A text without any
    signature has one, made of all its words, so that equal texts stay alike and others
    do not. The work is linear in the text: it is split before each anchor, and a piece
    looks at the few that follow.
    """
    words = "|".join(sorted(set(anchors)))
    pieces = F.slice(F.split(norm, f" (?=(?:{words}) )"), 2, 1 << 30)
    parts = F.transform(pieces, lambda p: F.struct(
        F.substring_index(p, " ", 1).alias("anchor"),
        F.trim(F.when(F.instr(p, " ") > 0, F.substr(p, F.instr(p, " "))).otherwise(""))
        .alias("rest")))

    def signatures(parts: Column) -> Column:
        def sign(part: Column, i: Column) -> Column:
            after = [F.get(parts, i + k)["rest"] for k in range(1, reach + 1)]
            text = F.trim(F.regexp_replace(F.concat_ws(" ", part["rest"], *after), " +", " "))
            full = F.get(F.split(text, " ", chain + 1), F.lit(chain - 1)).isNotNull()
            return F.when(full, F.xxhash64(part["anchor"], F.substring_index(text, " ", chain)))
        return F.array_sort(F.array_distinct(F.filter(
            F.transform(parts, sign), lambda h: h.isNotNull())))

    # the pieces are built once: a lambda over an array of one holds them
    found = F.get(F.transform(F.array(parts), signatures), F.lit(0))
    return F.get(F.transform(F.array(found), lambda s: F.when(F.size(s) > 0, s).otherwise(
        F.array(F.xxhash64(norm)))), F.lit(0))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard coefficient of two signature sets; 0 without comparing them if their
    lengths alone keep it below ``least``."""
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (F.size(a) + F.size(b) - shared)
    if not least:
        return exact
    bound = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    return F.when(bound < least, F.lit(0.0)).otherwise(exact)


def fingerprint(sets: Column) -> Column:
    """The set as text: hashes of 16 hex digits, in order."""
    return F.array_join(F.transform(sets, lambda h: F.lpad(F.hex(h), 16, "0")), " ")


def similar_pairs(docs: DataFrame, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): doc_id with class_id per input row, and pairs of classes (a, b,
    similarity) with ``similarity >= least``. A class is a distinct fingerprint, named by
    its smallest doc_id.

    Lengths are cut where they grow by 1 / least, so similar sets are in one partition or
    neighbours. Of a set of n signatures the ``n - ceil(least * n) + 1`` rarest meet the
    others': two similar sets share one of those. The shared one that comes first decides
    which meeting gives the pair.
    """
    members = stored(docs.select("doc_id", normalised().alias("norm"))
                     .select("doc_id", spots(F.col("norm")).alias("spots")), "spots")
    classes = stored(members.groupBy("spots").agg(F.min("doc_id").alias("class_id")), "classes")
    labels = members.join(classes, "spots").select("doc_id", "class_id")
    each = classes.select("class_id", F.explode("spots").alias("spot"))
    ranks = each.groupBy("spot").count().select("spot", F.struct("count", "spot").alias("rank"))
    ordered = stored(each.join(ranks, "spot").groupBy("class_id").agg(
        F.array_sort(F.collect_list("rank")).alias("ranks")), "ranked")
    n = F.size("ranks")
    step = -math.log(least)
    index = ordered.select(
        "class_id", "ranks", n.alias("n"), F.floor(F.log(n) / step).alias("part"), F.explode(
            F.slice("ranks", F.lit(1), (n - F.ceil(n * least - 1e-9) + 1).cast("int")))
        .alias("rank"))
    index = index.withColumn("spot", F.col("rank.spot"))
    near = index.withColumn("part", F.explode(F.array("part", F.col("part") + 1)))
    a, b = index.alias("a"), near.alias("b")
    shared = F.array_intersect(F.col("a.ranks"), F.col("b.ranks"))
    same = F.floor(F.log(F.col("b.n")) / step) == F.col("a.part")
    met = a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.spot") == F.col("b.spot"))
                 & (F.col("b.n") >= F.col("a.n") * least - 1e-9)
                 & (F.col("a.n") >= F.col("b.n") * least - 1e-9)
                 & (~same | (F.col("a.class_id") < F.col("b.class_id")))
                 & (F.array_min(shared) == F.col("a.rank")))
    pairs = met.select(
        F.least("a.class_id", "b.class_id").alias("a"),
        F.greatest("a.class_id", "b.class_id").alias("b"),
        likeness(F.col("a.ranks"), F.col("b.ranks"), least).alias("similarity"))
    return labels, pairs.where(F.col("similarity") >= least)


def below(bounds: Column, key: Column) -> Column:
    """How many of the ascending bounds are less than the key, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(CUTS.bit_length() + 1))])
    return F.reduce(steps, F.lit(0), lambda at, step: F.when(
        F.get(bounds, at + step - 1) < key, at + step).otherwise(at))


def cut_points(keys: DataFrame) -> tuple[list[int], int | None, DataFrame]:
    """Bounds of ranges of about BUCKET_BYTES, from rows (_key, _size): coarse ones as a
    list, the largest key, and for each coarse range a row (_coarse, _cuts) with the bounds
    inside it.

    There are about as many coarse ranges as ranges in each, so the list grows with the
    square root of the text. Quantiles of large ids are rounded, so each is replaced by the
    largest id of its range: every bound is an id that exists, and no range is empty.
    """
    found = keys.agg(F.sum("_size").alias("size"), F.max("_key").alias("top")).first()
    ranges = 1 + (found["size"] or 0) // BUCKET_BYTES
    many = math.isqrt(ranges - 1) + 1
    coarse = []
    if many > 1:
        coarse = keys.agg(F.percentile_approx("_key", [i / many for i in range(1, many)],
                                              10 * max(many, 100)).alias("cuts")).first()["cuts"]
        own = below(longs(sorted(set(coarse or []))), F.col("_key"))
        largest = keys.groupBy(own.alias("_coarse")).agg(F.max("_key").alias("key")).collect()
        coarse = sorted(r["key"] for r in largest)[:-1]
    placed = keys.withColumn("_coarse", below(longs(coarse), F.col("_key")))
    parts = F.least(F.lit(CUTS), 1 + F.floor(F.col("size") / BUCKET_BYTES)).cast("int")
    picked = F.transform(F.sequence(F.lit(1), F.col("parts") - 1), lambda i: F.get(
        F.col("cuts"), F.floor(i * CUTS / F.col("parts")).cast("int") - 1))
    quantiles = (placed.groupBy("_coarse")
                 .agg(F.sum("_size").alias("size"), F.percentile_approx(
                     "_key", [i / CUTS for i in range(1, CUTS)], 10 * CUTS).alias("cuts"))
                 .withColumn("parts", parts)
                 .select("_coarse", F.when(F.col("parts") > 1, F.array_sort(
                     F.array_distinct(picked))).otherwise(longs([])).alias("_cuts")))
    largest = (placed.join(F.broadcast(quantiles), "_coarse")
               .groupBy("_coarse", below(F.col("_cuts"), F.col("_key")).alias("_fine"))
               .agg(F.max("_key").alias("key")))
    ordered = F.array_sort(F.collect_list("key"))
    fine = largest.groupBy("_coarse").agg(
        F.slice(ordered, F.lit(1), F.size(ordered) - 1).alias("_cuts"))
    return coarse, found["top"], stored(fine, "cuts")


def longs(values: list[int]) -> Column:
    return F.lit(values).cast("array<bigint>")


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Each row with the given columns of the next one by descending doc_id (named with
    ``next_`` before); after the last comes the first.

    Ids are cut into ranges of about BUCKET_BYTES of text at ids that exist, each the
    largest of its range: coarse ranges first, then ranges inside each. The rows at a
    bound also go to the range above, where they follow the last row, and the largest of
    all goes below the lowest. What is broadcast is eight bytes a range, a millionth of
    the text. Equal ids follow each other in order of their text's hash, null ids come
    last; rows of one id are never parted.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.withColumn("_key", key)
    coarse, top, fine = cut_points(rows.select(
        "_key", F.coalesce(F.octet_length("text"), F.lit(0)).alias("_size")))
    upper = longs(coarse)
    placed = (rows.withColumn("_coarse", below(upper, F.col("_key")))
              .join(F.broadcast(fine), "_coarse")
              .withColumn("_fine", below(F.col("_cuts"), F.col("_key"))))

    def place(at: Column, inside: Column, guest: int) -> Column:
        return F.struct(at.cast("int").alias("coarse"), inside.cast("int").alias("fine"),
                        F.lit(guest).alias("guest"))
    places = F.array(
        place(F.col("_coarse"), F.col("_fine"), 0),
        F.when(F.get("_cuts", F.col("_fine")) == F.col("_key"),
               place(F.col("_coarse"), F.col("_fine") + 1, 1)),
        F.when(F.get(upper, F.col("_coarse")) == F.col("_key"),
               place(F.col("_coarse") + 1, F.lit(0), 1)),
        F.when(F.col("_key") == F.lit(top), place(F.lit(0), F.lit(0), 2)))
    placed = placed.withColumn("_at", F.explode(F.filter(places, lambda p: p.isNotNull())))
    order = Window.partitionBy("_at.coarse", "_at.fine").orderBy(
        "_at.guest", F.desc("_key"), F.xxhash64("text"))
    after = F.lead(F.struct(*columns)).over(order)
    return (placed.withColumn("_next", after).where("_at.guest = 0")
            .select(*docs.columns, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns]))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first ones of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half),
                    F.substr(following, F.lit(1), half))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Per input row: fingerprints of the text and its edit, and their likeness to it and
    to the next document. A null text is empty; texts without words are alike. Repeated
    rows are documents of their own. Only doc_id and text are read.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    marked = base.withColumn("norm", normalised()).select(
        "doc_id", "text", spots(F.col("norm")).alias("spots"))
    both = with_next(marked, ["text", "spots"]).withColumn(
        "changed", edited(F.col("text"), F.col("next_text"))).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("changed").cast("binary"), 256).alias("edited_sha256"),
        normalised("changed").alias("norm"), "spots", "next_spots")
    full = both.select("*", spots(F.col("norm")).alias("edited_spots"))
    return full.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
        F.size("spots").cast("long").alias("n_spots"))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edits."""
    return compare_edits(table(spark, sf_dir, "documents"))
