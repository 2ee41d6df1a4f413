"""Hierarchical packing of token sequences.

Documents are tokenised in place and cut at the largest context; what is left of each is
routed to the smallest context tier that holds it. Inside a bucket of about a step's
worth of tokens every tier is packed from the longest down: a window starts with a piece
of its tier, takes whole pieces of shorter tiers that fit, and cuts one more for the
last gap. Windows are powers of two, so none is padded; only the very last pieces of a
bucket are split into smaller powers. Windows are then dealt to step groups of equal
token counts.
"""

from __future__ import annotations

import heapq
import os
import zlib
from bisect import bisect_right, insort

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from pulseboard.llm.common import map_batches, table, worker_memory

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 2
TIERS = (512, 1024, 2048, 4096)
BUCKET_BYTES = 4 << 20
STEP_TOKENS = 1 << 19
BATCH_BYTES = 2 << 20  # of text encoded at once
CHUNKS_KEPT = 200_000
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
LETTERS = np.array([bytes([i]).isalpha() for i in range(256)])
LATIN = np.array([0x80 <= i < 0xC0 and i not in (0x97, 0xB7) for i in range(256)])  # behind C3
SIGNS = np.array([33 <= i < 127 and not bytes([i]).isalnum() and i != 39 for i in range(256)])
PLAIN_SIGNS = SIGNS & ~np.isin(np.arange(256), list(b"<|>"))

PIECE = {"doc_id": "bigint", "start": "bigint", "doc_tokens": "bigint", "ids": "binary"}
OUT = {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
       "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint",
       "tier": "bigint", "step_group": "bigint"}


class Encoder:
    """Token ids of whole texts.

    The vocabulary drops white space and never joins across it, so the ids of a text are
    those of its chunks between white space, and each distinct chunk is encoded once.
    Nor does it tell cases apart or join a letter with a sign behind it (but for the
    apostrophe), so A-Z are lowered first and the signs set apart: fewer distinct chunks,
    the same ids.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        # For lower-case words, which need no normalizing and no search for their ends.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a word
        self.last[[i for token, i in self.tokenizer.get_vocab().items()
                   if suffix and token.endswith(suffix)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def plain(texts: pa.Array) -> pa.Array:
        """The texts with A-Z lowered, and a space between an ASCII or Latin-1 letter and
        an ASCII sign behind it."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:][: len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]: ends[-1]]
        ends = ends - ends[0]
        if not len(raw):
            return texts
        signs = PLAIN_SIGNS
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # else it names a token
            raw, signs = LOWER[raw], SIGNS
        letter = LETTERS[raw]
        letter[1:] |= (raw[:-1] == 0xC3) & LATIN[raw[1:]]
        cut = np.flatnonzero(letter[:-1] & signs[raw[1:]]) + 1
        data = np.insert(raw, cut, 32)
        ends = (ends + np.searchsorted(cut, ends)).astype(np.int32)
        return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(data))

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Codes of distinct chunks: Latin words in one go, as each of them is one word to
        the tokenizer, the others one by one."""
        out = dict.fromkeys(chunks)
        words = [c for c in chunks if c.isalpha() and (
            c.isascii() or max(c) < "\u0250" and "\u0130" not in c)]
        code = self.words.encode_batch_fast([" ".join(words).lower()], add_special_tokens=False)
        ids = np.array(code[0].ids, self.dtype)
        ends = ((np.flatnonzero(self.last[ids]) + 1) * ids.itemsize).tolist()
        if len(ends) == len(words):  # the vocabulary marks the ends of words
            joined = ids.tobytes()
            out.update(zip(words, [joined[a:b] for a, b in zip([0, *ends], ends)]))
        other = [c for c, code in out.items() if code is None]
        for part, code in zip(other, self.tokenizer.encode_batch_fast(
                other, add_special_tokens=False)):
            out[part] = np.array(code.ids, self.dtype).tobytes()
        return out

    def codes(self, chunks: list[str]) -> list[bytes]:
        if len(self.young) > CHUNKS_KEPT:
            self.young, self.old = {}, self.young
        out = list(map(self.young.get, chunks))
        missing = [i for i, code in enumerate(out) if code is None]
        if missing:
            asked = [chunks[i] for i in missing]
            found = {c: code for c in asked if (code := self.old.get(c)) is not None}
            found.update(self.learn([c for c in asked if c not in found]))
            self.young.update(found)
            for i, c in zip(missing, asked):
                out[i] = found[c]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids end."""
        lists = pc.ascii_split_whitespace(self.plain(pc.fill_null(texts.cast(pa.string()), "")))
        words = lists.flatten().dictionary_encode()
        codes = self.codes(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        table = np.frombuffer(b"".join(codes), self.dtype)
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // np.dtype(
            self.dtype).itemsize
        which = words.indices.to_numpy()
        counts = sizes[which]
        ends = np.cumsum(counts)
        first = (np.cumsum(sizes) - sizes)[which] - (ends - counts)
        ids = table[np.repeat(first, counts) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.cumsum(pc.list_value_length(lists).to_numpy())
        return ids, np.concatenate([[0], ends])[upto]


def encoder(path: str, dtype: str) -> Encoder:
    """The encoder of this worker; later tasks find its chunks already encoded."""
    memory, key = worker_memory(), f"encoder {path} {dtype}"
    if key not in memory:
        memory[key] = Encoder(path, dtype)
    return memory[key]


def token_pieces(docs: DataFrame, path: str, dtype: str, context: int) -> DataFrame:
    """Rows (doc_id, start, doc_tokens, ids) of at most ``context`` ids each."""
    def step():
        encode, end = encoder(path, dtype).encode, np.array([END], dtype).tobytes()

        def work(batch):
            ids, ends = encode(batch.column("text"))
            out = {name: [] for name in PIECE}
            for doc, a, b in zip(batch.column("doc_id").to_pylist(),
                                 [0, *ends.tolist()], ends.tolist()):
                size = b - a + 1
                for at in range(a, b + 1, context):
                    last = at + context > b
                    out["doc_id"].append(doc)
                    out["start"].append(at - a)
                    out["doc_tokens"].append(size)
                    out["ids"].append(ids[at: min(b, at + context)].tobytes() + end * last)
            return out
        return work

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), step, PIECE, 8192,
                       BATCH_BYTES)


def plan_windows(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple]]:
    """Windows over pieces 0..n-1: lists of (piece, first id, length), each adding up to a
    power of two of at most the largest tier. Every id is in exactly one place."""
    full = tiers[-1]
    windows = [[(i, 0, n)] for i, n in enumerate(lengths) if n == full]
    waiting: list[list[tuple]] = [[] for _ in tiers]  # (length, piece, first), by length
    for i, n in enumerate(lengths):
        if 0 < n < full:
            waiting[next(k for k, t in enumerate(tiers) if n <= t)].append((n, i, 0))
    for lane in waiting:
        lane.sort()

    def power_windows(items: list[tuple]) -> None:
        size, current, room = 0, [], 0
        left = sum(n for _, _, n in items)
        for i, a, n in items:
            while n:
                if not room:
                    size = room = min(full, 1 << (left.bit_length() - 1))
                take = min(n, room)
                current.append((i, a, take))
                a, n, room, left = a + take, n - take, room - take, left - take
                if not room:
                    windows.append(current)
                    current = []

    for k in range(len(tiers) - 1, -1, -1):
        while waiting[k]:
            n, i, a = waiting[k].pop()
            window, gap = [(i, a, n)], tiers[k] - n
            for lane in waiting[k::-1]:  # whole pieces, the longest that fit
                while gap and (at := bisect_right(lane, (gap, len(lengths), 0))):
                    n, i, a = lane.pop(at - 1)
                    window.append((i, a, n))
                    gap -= n
            while gap and (source := next((x for x in waiting[: k + 1] if x), None)):
                n, i, a = source.pop()  # cut one for what is left
                take = min(n, gap)
                window.append((i, a, take))
                gap -= take
                if n > take:
                    insort(waiting[next(j for j, t in enumerate(tiers) if n - take <= t)],
                           (n - take, i, a + take))
            if gap:
                power_windows(window)
            else:
                windows.append(window)
    return windows


def step_groups(sizes: list[int], tokens: int = STEP_TOKENS) -> list[int]:
    """Group number per window: the largest first, each to the lightest group."""
    groups = [(0, g) for g in range(max(1, round(sum(sizes) / tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, g = heapq.heappop(groups)
        out[i] = g
        heapq.heappush(groups, (load + sizes[i], g))
    return out


def pack(docs: DataFrame, path: str = TOKENIZER, tiers: tuple[int, ...] = TIERS,
         bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there.

    A null or empty text has the end token alone. Repeated rows are packed each on its
    own. Pieces are spread over buckets by id, place and input position, so neither a
    very long document nor one row repeated many times fills a bucket.
    """
    dtype = "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"
    total = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    buckets = 1 + ((total[0] or 0) + total[1]) // bucket_bytes
    pieces = token_pieces(docs, path, dtype, tiers[-1])
    spread = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()),
                    F.lit(buckets))

    def bucket(group: pa.Table) -> pa.Table:
        number = group.column("bucket")[0].as_py()
        rows = sorted(zip(*(group.column(c).to_pylist() for c in PIECE)),
                      key=lambda r: (r[0] is None, r[0], r[1], r[3]))
        ids = [np.frombuffer(r[3], dtype).astype("<u4") for r in rows]
        windows = plan_windows([len(x) for x in ids], tiers)
        sizes = [sum(n for _, _, n in w) for w in windows]
        groups = step_groups(sizes)
        out = {name: [] for name in OUT}
        for w, (window, size) in enumerate(zip(windows, sizes)):
            offset = 0
            for i, a, n in window:
                for name, value in zip(OUT, (
                        rows[i][0], rows[i][1] + a, n, zlib.crc32(ids[i][a: a + n].tobytes()),
                        rows[i][2], number << 32 | w, offset, size, number << 20 | groups[w])):
                    out[name].append(value)
                offset += n
        return pa.table({name: pa.array(v, pa.int64()) for name, v in out.items()})

    return pieces.withColumn("bucket", spread).groupBy("bucket").applyInArrow(
        bucket, ", ".join(f"{n} {k}" for n, k in OUT.items()))


def op9_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of at most 4096 ids."""
    return pack(table(spark, sf_dir, "documents"))
