"""Language identification with a string kernel.

Texts are compared by the character 1- to 3-grams present in them (blended spectrum,
presence only): k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|). Every labelled text is
compared with a few landmark texts among them (Nystroem), and ridge regression in that
space gives one weight vector per language against the rest. The regression needs sums
over the texts alone, which tasks add up where the texts are. A batch of texts is scored
by two matrix products: presence x landmarks, kernel x weights.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseboard.llm.common import ARROW, map_batches, slices, stored, table, worker_memory

GRAMS = 3
DIMS = 1 << 14  # gram slots; grams are hashed into them
LANDMARKS = 160  # width of the model: labelled texts that all others are compared with
SCALE = 1 << 16  # kernel values are added up as whole numbers of 1 / SCALE, in any order
LANGUAGES_HELD = 64  # by a task before it hands its sums on
RIDGE = 1e-4
BATCH_BYTES = 2 << 20  # of text compared at once; a character takes some 50 bytes
UNKNOWN = "und"
STEPS = 1 << 16  # in which shares are counted
COMMON = 0.02  # share of a language's fitted documents a gram stands in to be known
LOW, SLACK = 0.01, 0.75  # a text is unlike below SLACK times this quantile of theirs
CUT = 0.6  # where no labelled document is spare


def letters() -> np.ndarray:
    """Lower-case letter of every BMP code point, a space for what is no letter."""
    memory = worker_memory()
    if "letters" not in memory:
        memory["letters"] = np.array(
            [ord(c.lower()[0]) if (c := chr(i)).isalpha() else 32 for i in range(1 << 16)],
            np.uint32)
    return memory["letters"]


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x DIMS) 0/1 matrix of the grams present, and whether a text has a letter."""
    codes = np.frombuffer("".join(f" {t or ''} " for t in texts).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t or "") + 2 for t in texts], int)  # a space before and behind
    small = letters()[np.minimum(codes, 0xFFFF)]
    far = np.flatnonzero(codes > 0xFFFF)
    small[far] = [ord(c.lower()[0]) if (c := chr(x)).isalpha() else 32
                  for x in codes[far].tolist()]
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    keep = np.ones(len(small), bool)  # one space of a run, never one of another text
    keep[1:] = (small[1:] != 32) | (small[:-1] != 32) | (doc[1:] != doc[:-1])
    small, doc = small[keep], doc[keep]
    out = np.zeros((len(texts) + 1, DIMS), np.float32)
    hashes = np.zeros(len(small), np.uint32)
    for n in range(GRAMS):
        part = small[n:]
        hashes = (hashes[: len(part)] + part) * np.uint32(0x9E3779B1)
        hashes ^= hashes >> np.uint32(15)
        slots = (hashes * np.uint32(0x85EBCA77)) >> np.uint32(18)
        same = doc[: len(part)] == doc[n:] if n else slice(None)
        out[doc[: len(part)][same], slots[same]] = 1
    seen = np.zeros(len(texts) + 1, bool)
    seen[doc[small != 32]] = True
    return out[: len(texts)], seen[: len(texts)]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: np.ndarray  # packed presence bits
    weights: np.ndarray  # landmarks x languages
    known: np.ndarray | None = None  # packed bits of the grams common in each language
    cut: float = CUT

    def share(self, grams: np.ndarray) -> np.ndarray:
        """Largest share of a text's grams that are common in one language. Unlike the
        score, whose ridge gives 0.5 to a text that is far from all landmarks, it falls
        towards 0 for other scripts, other languages and random letters."""
        known = np.unpackbits(self.known, axis=1, count=DIMS).astype(np.float32)
        return (grams @ known.T).max(axis=1) / np.maximum(grams.sum(axis=1), 1)

    def kernel(self, grams: np.ndarray) -> np.ndarray:
        """Kernel of texts and landmarks; the matrix product counts, so it is exact."""
        marks = np.unpackbits(self.landmarks, axis=1, count=DIMS).astype(np.float32)
        sizes = np.maximum(grams.sum(axis=1, dtype=np.float64), 1)[:, None] * np.maximum(
            marks.sum(axis=1, dtype=np.float64), 1)
        return (grams @ marks.T) / np.sqrt(sizes)


def _fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(_fold(doc_id) % 4 == 2, F.lit(False))


def spare(doc_id: str = "doc_id") -> Column:
    """An eighth of the other documents: no model is fitted on them, they calibrate it."""
    fold = _fold(doc_id)
    return F.coalesce((fold % 4 != 2) & (F.floor(fold / 4) % 8 == 0), F.lit(False))


def learned(doc_id: str = "doc_id") -> Column:
    return ~held_out(doc_id) & ~spare(doc_id)


def labelled(fold: Column) -> Column:
    """Rows of a fold that can be learned from."""
    return (F.col("lang").isNotNull() & F.col("text").isNotNull()
            & F.col("doc_id").isNotNull() & fold)


def sample(docs: DataFrame, per_language: int, rows: int, fold: Column) -> DataFrame:
    """(doc_id, lang, digest of the text) of the landmarks, by hash order; languages take
    turns, so that each is there. Texts are not sorted. A row is known by all three, so
    where an id stands in several rows, each text keeps its own label."""
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("digest")]
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (docs.where(labelled(fold))
            .select("doc_id", "lang", F.md5("text").alias("digest")).distinct()
            .withColumn("turn", turn).where(F.col("turn") <= per_language)
            .orderBy("turn", *order, "lang").limit(rows).drop("turn"))


def labelled_bits(docs: DataFrame, per_language: int, rows: int, fold: Column) -> list:
    """(lang, presence bits) of such landmarks, in a fixed order. Bits are computed where the
    texts are, and only they come to the driver; texts without a letter have none."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", "lang").where(
        F.col("text").rlike(r"\p{L}"))
    chosen = stored(sample(docs, per_language, rows, fold), "language-landmarks")

    def step():
        def work(batch):
            grams, seen = presence(batch.column("text").to_pylist())
            bits = np.packbits(grams.astype(np.uint8), axis=1)
            return {**{c: batch.column(c) for c in ("doc_id", "lang", "digest")},
                    "bits": [b.tobytes() if s else None for b, s in zip(bits, seen)]}
        return work

    texts = docs.withColumn("digest", F.md5("text")).join(chosen, ["doc_id", "lang", "digest"])
    found = map_batches(texts, step, {"doc_id": "bigint", "lang": "string", "digest": "string",
                                      "bits": "binary"}, 128, BATCH_BYTES)
    return (found.where("bits IS NOT NULL").dropDuplicates(["doc_id", "lang", "digest"])
            .orderBy(F.xxhash64("doc_id"), "doc_id", "digest", "lang").limit(rows)
            .select("lang", "bits").collect())


SUMS = {"part": "string", "lang": "string", "place": "bigint", "n": "bigint"}


def sums(docs: DataFrame, landmarks: np.ndarray, fold: Column) -> DataFrame:
    """Rows (part, lang, place, n) added up over all labelled texts with a letter:
    ``texts`` of a language; its ``grams``, how many of its texts have the gram of a slot;
    its ``kernel`` values with a landmark; ``products`` of the values with two landmarks
    (place: first * landmarks + second), over all languages. Kernel values are whole numbers
    of 1 / SCALE, so the sums are the same in any order. Repeated rows count each."""
    width = len(landmarks)

    def run(batches):
        model = Model((), landmarks, np.zeros((0, 0)))
        held: dict[str, list] = {}
        products = np.zeros((width, width), np.int64)

        def rows(part, lang, values):
            at = np.flatnonzero(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(at), pa.string()), pa.array([lang] * len(at), pa.string()),
                 pa.array(at, pa.int64()), pa.array(values.ravel()[at], pa.int64())],
                schema=pa.schema([(name, ARROW[kind]) for name, kind in SUMS.items()]))

        def hand_on():
            for lang, values in held.items():
                for part, value in zip(("texts", "grams", "kernel"), values):
                    yield rows(part, lang, value)
            held.clear()

        for batch in batches:
            for part in slices(batch, 256, BATCH_BYTES):
                grams, seen = presence(part.column("text").to_pylist())
                values = np.rint(model.kernel(grams) * SCALE) * seen[:, None]
                products += (values.T @ values).astype(np.int64)  # below 2 ** 53: exact
                names, which = np.unique(np.array(part.column("lang").to_pylist(), object),
                                         return_inverse=True)
                own = ((which == np.arange(len(names))[:, None]) & seen).astype(np.float32)
                new = zip(own.sum(axis=1), own @ grams, own.astype(np.float64) @ values)
                for lang, found in zip(names.tolist(), new):
                    found = [np.atleast_1d(x).astype(np.int64) for x in found]
                    held[lang] = [a + b for a, b in zip(held[lang], found)] if (
                        lang in held) else found
                if len(held) > LANGUAGES_HELD:
                    yield from hand_on()
            pa.default_memory_pool().release_unused()
        yield from hand_on()
        yield rows("products", None, products)

    return (docs.where(labelled(fold)).select("text", "lang")
            .mapInArrow(run, ", ".join(f"{n} {k}" for n, k in SUMS.items()))
            .groupBy("part", "lang", "place").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, landmarks: int = LANDMARKS) -> Model:
    """Fit on every labelled document that is neither held out nor spare. ``landmarks`` is
    the width of the model; what comes to the driver grows with it and with the number of
    languages, not with the documents."""
    marks = [r["bits"] for r in labelled_bits(docs, landmarks, landmarks, learned())]
    packed = np.frombuffer(b"".join(marks), np.uint8).reshape(len(marks), DIMS // 8)
    if not marks:
        return Model((), packed, np.zeros((0, 0), np.float32))
    added = stored(sums(docs, packed, learned()), "language-sums")
    texts = added.where("part = 'texts'").select("lang", F.col("n").alias("texts"))
    counts = {r["lang"]: r["texts"] for r in texts.collect()}
    languages = tuple(sorted(counts))
    at = {name: i for i, name in enumerate(languages)}
    inner = np.zeros((len(marks), len(marks)))
    for r in added.where("part = 'products'").select("place", "n").collect():
        inner[divmod(r["place"], len(marks))] = r["n"] / SCALE ** 2
    own = np.zeros((len(marks), len(languages)))
    for r in added.where("part = 'kernel'").select("lang", "place", "n").collect():
        own[r["place"], at[r["lang"]]] = r["n"] / SCALE
    known = np.zeros((len(languages), DIMS), np.uint8)
    for r in (added.where("part = 'grams'").join(F.broadcast(texts), "lang")
              .where(F.col("n") / F.col("texts") >= COMMON)
              .groupBy("lang").agg(F.collect_list("place").alias("slots")).collect()):
        known[at[r["lang"]], r["slots"]] = 1
    core = Model((), packed, np.zeros((0, 0))).kernel(
        np.unpackbits(packed, axis=1).astype(np.float32))
    ridge = RIDGE * sum(counts.values()) * (core + 1e-6 * np.eye(len(core)))
    # The target is 1 for a text of the language and -1 for one of the rest.
    target = 2 * own - own.sum(axis=1, keepdims=True)
    weights = np.linalg.lstsq(inner + ridge, target, rcond=None)[0]
    return Model(languages, packed, weights.astype(np.float32), np.packbits(known, axis=1))


def calibrate(docs: DataFrame, model: Model) -> Model:
    """The model with its ``cut``: how unlike a text of a learned language can be, from
    every labelled spare document. Without any, the cut stays as it was."""
    known = docs.where(labelled(spare()) & F.col("lang").isin(list(model.languages)))
    step = F.floor(F.col("share") * STEPS).cast("long").alias("step")
    found = sorted(tuple(r) for r in predict(known, model).where(F.col("lang_pred") != UNKNOWN)
                   .groupBy(step).count().collect())
    if not found:
        return model
    steps, ends = np.array([s for s, _ in found]), np.cumsum([n for _, n in found])
    rank = LOW * (ends[-1] - 1)  # between two places in order, as numpy's quantile does
    low, high = steps[np.searchsorted(ends, [np.floor(rank), np.ceil(rank)], side="right")]
    return replace(model, cut=SLACK * float(low + (high - low) * (rank % 1)) / STEPS)


def predict(docs: DataFrame, model: Model, columns: dict[str, str] | None = None) -> DataFrame:
    """The given columns (doc_id if none are named), ``lang_pred``, ``score`` and ``share``
    per input row; the prediction uses the text alone.

    A null text, one without a letter, or an empty model gives ``und`` with score and
    share 0.
    Repeated rows and null ids are scored like any other.
    """
    columns = columns or {"doc_id": "bigint"}

    def step():
        names = np.array([*model.languages, UNKNOWN], object)

        def work(batch):
            grams, seen = presence(batch.column("text").to_pylist())
            if not model.languages:
                best, top, share = np.zeros(len(seen), int), np.zeros(len(seen)), np.zeros(
                    len(seen))
            else:
                share = model.share(grams)
                scores = model.kernel(grams) @ model.weights
                best, top = scores.argmax(axis=1), (scores.max(axis=1) + 1) / 2
            best = np.where(seen, best, len(model.languages))
            return {**{c: batch.column(c) for c in columns}, "lang_pred": names[best].tolist(),
                    "score": np.where(seen, np.clip(top, 0, 1), 0.0).astype(np.float64),
                    "share": np.where(seen, share, 0.0).astype(np.float64)}
        return work

    read = [F.col(c).cast(kind).alias(c) for c, kind in {**columns, "text": "string"}.items()]
    return map_batches(docs.select(*read), step,
                       {**columns, "lang_pred": "string", "score": "double", "share": "double"},
                       256, BATCH_BYTES)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents (columns of the table) in a learned language. A text whose grams are
    less known in every language than those of spare labelled documents (if the model was
    calibrated on such) goes."""
    columns = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
               "n_chars": "bigint"}
    return (predict(docs, model, columns)
            .where((F.col("lang_pred") != UNKNOWN) & (F.col("share") >= model.cut))
            .select(*columns))


def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter is never learned from."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
