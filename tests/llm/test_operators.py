"""The corpus operators against brute force and on awkward inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pulseboard.llm import (components, langid, licenses, mixing, packing, pii, quality, quotes,
                            repeats, simhash, spotsigs)
from pulseboard.llm.common import slices
from pulseboard.llm.queries import QUERIES, STATEMENTS
from tests.compare import differences, duck
from tests.conftest import SF_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the of and in to a license under water stone river light paper garden window "
         "quiet seven moon harbour winter").split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward() -> list[tuple]:
    """Null, empty and blank texts, null columns, ties, repeated rows, odd characters, a
    long text and near copies."""
    long = prose(1, 6000)
    texts = [None, "", " \n\t", "a", "ÀÉ ß İK 𝔘  x", prose(2, 300), prose(2, 300),
             prose(2, 299) + " changed", long, "!" * 500, "one line\n" * 60,
             "cc by\tCC BY all Rights-reserved GENERAL public license", "x" * 700,
             "mail a.b@c.de now, 10.0.0.256 10.0.0.25 +1 (988) 555-2485"]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None,
             None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, prose(3, 40), None, None, None),
            (-7, prose(2, 300), "en", "s1", 5)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS).withColumn(
        "norm", F.lit(1)).withColumn("row", F.lit("x")).withColumn("rate", F.lit(None))


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_statement(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck(SF_DIR), STATEMENTS[name]) == []


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_slices():
    import pyarrow as pa

    texts = ["x" * n for n in (0, 5000, 1, 1, 1, 9000, 2, 40, 0)] + [None]
    batch = pa.record_batch({"n": list(range(len(texts))), "text": texts})
    for rows, size in ((3, 1 << 20), (100, 4000), (1, 1)):
        parts = list(slices(batch, rows, size))
        assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(len(texts)))
        assert all(p.num_rows <= rows and (p.nbytes <= size or p.num_rows == 1) for p in parts)
    assert list(slices(batch.slice(0, 0), 4, 100)) == []


# 1 -----------------------------------------------------------------------------------

def ledger_row(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7)
               if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup,
            len(covered))


def test_ledger_against_brute_force(spark, docs, table):
    for frame in (docs, table):
        got = [(r["doc_id"], *[r[m] for m in quality.MEASURES[:5]])
               for r in quality.ledger(frame).collect()]
        want = [(r["doc_id"], *ledger_row(r["text"]))
                for r in frame.select("doc_id", "text").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert quality.ledger(empty(spark)).count() == 0


def more_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    bodies = [b for b in (line.strip(" \t\x0b\x0c\r") for line in text.split("\n")) if b]

    def chars(test):
        return sum(map(test, text))
    return {
        "n_chars": len(text), "n_digits": chars(lambda c: c in "0123456789"),
        "n_upper": chars(lambda c: "A" <= c <= "Z"),
        "n_letters": chars(lambda c: "a" <= c.lower() <= "z" and c < "\x80"),
        "n_wide": chars(lambda c: c > "\x7f"), "n_bangs": chars(lambda c: c == "!"),
        "n_control": chars(lambda c: c == "\x7f" or "\x01" <= c <= "\x08" or "\x0e" <= c <= "\x1f"),
        "n_braces": chars(lambda c: c in "{}"), "n_points": chars(lambda c: c in ".,;:!?"),
        "n_lost": chars(lambda c: c == "\ufffd"),
        "n_urls": len(re.findall("https?://", text)),
        "n_lorem": len(re.findall("[Ll]orem ipsum", text)),
        "n_script": len(re.findall("javascript|JavaScript", text)),
        "n_lines": len(bodies), "n_end_lines": sum(b[-1] in '.!?"' for b in bodies),
        "n_cut_lines": sum(b[-3:] == "..." or b[-1] == "\u2026" for b in bodies),
        "n_bullet_lines": sum(b[0] in "-*\u2022" for b in bodies),
        "n_short_lines": sum(len(b) <= 10 for b in bodies),
        "max_line": max(map(len, bodies), default=0),
        "max_word": max((len(w.encode()) for w in words), default=0),
        "n_kinds": len(set(words)), "n_top_word": max(Counter(words).values(), default=0),
        "n_stop": sum(w in quality.STOP for w in words)}


ODD_TEXTS = [
    None, "", " \n\t", "one", "the of\x01\x7f \ufffd\ufffd {x} https://a http://b httpx://c",
    "- a\n* b\n\u2022 c\n  - d...\ne\u2026\nEnd.\n\"Q\"\nWhy?\r\n" * 3,
    "Lorem ipsum lorem ipsum LOREM IPSUM javascript JavaScript Javascript",
    "w" * 1500 + " \u00e9\u4e2d\U0001f600 " + "go " * 40, "A B C! D!! 12 345 \u0661",
    "x\u00a0y\x1cz\x85q \u2028r"]


def test_every_measure_and_rule_against_brute_force(spark, table):
    odd = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD_TEXTS)],
                                "doc_id long, text string, fail_bits string")
    for frame in (odd, table):
        texts = {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}
        for row in quality.ledger(frame).collect():
            want = more_measures(texts[row["doc_id"]])
            assert {m: row[m] for m in want} == want, texts[row["doc_id"]]
            values = {m: row[m] for m in quality.MEASURES}
            failed = {name for name, test in quality.RULES if eval(
                test.replace(" = ", " == ").replace("OR", "or"), {}, values)}
            assert {n for n, bit in quality.BIT.items() if row["fail_bits"] & bit} == failed


def test_policy_table(spark, docs):
    frame = quality.policy_table(spark)
    found = quality.read_policies(frame.union(frame))
    assert {(p.name, p.version): p.mask for p in found} == {
        (p.name, p.version): p.mask for p in quality.POLICIES}
    assert quality.read_policies(frame.limit(0)) == []
    rows = quality.ledger(docs).withColumn("by", quality.kept_by(found)).collect()
    for r in rows:
        assert r["by"] == ",".join(
            f"{p.name}:{p.version}" for p in found if r["fail_bits"] & p.mask == 0)
    for bad in [("web", 9, "no_such_rule"), ("web", 9, None), (None, 1, "short"),
                ("web", None, "short")]:
        with pytest.raises(ValueError):
            quality.read_policies(spark.createDataFrame([bad], frame.schema))


def test_policies_and_ablations(spark, docs):
    rows = quality.ledger(docs).cache()
    bits = [r["fail_bits"] for r in rows.collect()]
    for policy in (quality.BASE, quality.WEB):
        assert rows.where(quality.kept(policy)).count() == sum(b & policy.mask == 0 for b in bits)
        got = {r["rule"]: (r["n_failed"], r["n_only"])
               for r in quality.ablations(rows, policy).collect()}
        assert got == {name: (sum(b & quality.BIT[name] > 0 for b in bits),
                              sum(b & policy.mask == quality.BIT[name] for b in bits))
                       for name in policy.rules}


# 2 -----------------------------------------------------------------------------------

def test_quote_levels():
    own, passages = quotes.parse("Yes.\n\nOn Monday Ann wrote:\n> I think\n> so\n>> Do you?\n"
                                 "> > Do we?\nBye")
    assert own == "Yes.\n\nBye"
    assert passages == [(1, "I think\nso"), (2, "Do you?\nDo we?")]


def test_conversations(spark):
    rows = [(1, 0, "user", "Where is the harbour?\nNear the river."),
            (1, 1, "assistant", "> where is the  HARBOUR\nBehind the stone."),
            (1, 2, "user", "> near the river\nThanks"),
            (2, 0, "user", ">> Where is the harbour?\n> Behind the stone.\nIs it?"),
            (2, 1, "assistant", "Yes"), (3, 0, "user", "> Nobody said this"),
            (4, 0, "user", None), (4, 0, "user", None), (None, None, None, ""),
            (5, 0, "user", "> Yes\nReally"), (9, 5000, "user", "late"), (9, 1, "user", "early")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_conversations(frame).collect()}
    assert len(got) == 11 and quotes.link_conversations(frame).count() == len(rows)
    assert [got[1, 1][c] for c in ("reply_conv", "reply_turn", "text")] == [
        1, 0, "Behind the stone."]
    assert (got[1, 2]["reply_conv"], got[1, 2]["reply_turn"]) == (1, 0)
    assert (got[2, 0]["reply_conv"], got[2, 0]["reply_turn"], got[2, 0]["max_depth"]) == (1, 1, 2)
    assert got[2, 0]["thread_id"] == got[5, 0]["thread_id"] == 1
    assert [got[k]["position"] for k in ((1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (5, 0))] == [
        1, 2, 3, 4, 5, 6]
    assert (got[3, 0]["reply_turn"], got[3, 0]["quote_linked"], got[3, 0]["text"]) == (
        None, False, "")
    assert got[4, 0]["text"] is None
    assert (got[9, 5000]["reply_turn"], got[9, 5000]["position"]) == (1, 2)
    assert quotes.link_conversations(frame.limit(0)).count() == 0


def test_common_lines_do_not_join_conversations(spark):
    long = "the harbour is closed until the ice has gone"
    rows = [(i, 0, "user", "Thanks\nHello there") for i in range(1, 21)]
    rows += [(30, 0, "user", long), (31, 0, "user", f"> {long}\n> Thanks\nIs it?"),
             (32, 0, "user", "> Thanks\nYou are welcome"), (33, 0, "user", "> hello there\nHi"),
             (34, 0, "user", "Thanks"), (34, 1, "assistant", "> thanks\nSure")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_conversations(frame).collect()}
    assert got[31, 0]["thread_id"] == 30 and got[31, 0]["reply_conv"] == 30
    for conv in (32, 33):
        assert got[conv, 0]["thread_id"] == conv and not got[conv, 0]["quote_linked"]
    assert got[34, 1]["quote_linked"] and got[34, 1]["reply_conv"] == 34


# 3 -----------------------------------------------------------------------------------

def license_row(text):
    upper = {c: c + 32 for c in range(65, 91)}
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(upper))
    places = [(i, label) for phrase, label in (
        ("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
        for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min((i for i, _ in places), default=None),
            max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))


def test_license_base(spark, docs, table):
    for frame in (docs, table):
        got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                r["base_labels"]) for r in licenses.scan(frame).collect()]
        want = [(r["doc_id"], *license_row(r["text"]))
                for r in frame.select("doc_id", "text").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan(empty(spark)).count() == 0


def test_license_rules(spark):
    cases = {"Licensed under the Apache License, Version 2.0.": ("apache-2.0", 1.0),
             "under the GNU Lesser General Public License version 2.1 or any later version":
                 ("gpl,lgpl-2.1-or-later", 1.0),
             "LaTeX Project Public License version 1.2": ("lppl", 0.7),
             "LaTeX Project Public License version 1.3c": ("lppl-1.3c", 1.0),
             "Zope Public License 1.0": ("zpl", 0.7), "Zope Public License": ("zpl", 0.7),
             "Zope Public License v2.1": ("zpl-2.1", 1.0),
             "Open Government License v2.0": ("ogl", 0.7),
             "Open Government License v3.0": ("ogl-3.0", 1.0),
             "SIL Open Font License 1.0": ("ofl", 0.7),
             "SIL Open Font License, Version 1.1": ("ofl-1.1", 1.0),
             "Etalab 1.0": ("etalab", 0.7), "Common Public License 0.5": ("cpl", 0.7),
             "Netscape Public License 1.0": ("npl", 0.7),
             "Reciprocal Public License 1.1": ("rpl", 0.7),
             "SPDX-License-Identifier: MIT": ("mit", 1.0),
             "SPDX-License-Identifier: BSD-3-Clause": ("bsd-3-clause", 1.0),
             "SPDX-License-Identifier: Apache-2.0": ("apache-2.0", 1.0),
             "AGPL-3.0-or-later": ("agpl-3-or-later", 1.0),
             "Released under the MIT License": ("mit", 1.0), "CC BY-SA 4.0": (
                 "cc-by,cc-by-sa-4.0", 1.0), "Copyright 2020": ("copyright", 0.4),
             "K cc K by": ("", 0.0), "nothing here": ("", 0.0)}
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = by_id(licenses.scan(frame))
    assert {t: (got[i]["labels"], got[i]["score"]) for i, t in enumerate(cases)} == cases
    assert len(licenses.RULES) > 200
    for rule in licenses.RULES:
        re.compile(rule["regex"])


def example(tree, rng) -> str:
    """A random string that a parsed regex matches."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            out += "x" if str(arg[0][0]) == "NEGATE" else chr(
                arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])
        elif name in ("ANY", "NOT_LITERAL"):
            out += "x"
        elif name == "BRANCH":
            out += example(rng.choice(arg[1]), rng)
        elif name == "SUBPATTERN":
            out += example(arg[3], rng)
        elif name == "MAX_REPEAT":
            out += "".join(example(arg[2], rng) for _ in range(
                rng.randint(arg[0], min(arg[1], arg[0] + 1))))
        else:
            assert name == "ASSERT", name
    return out


def test_every_rule_passes_its_prefilter(spark):
    rng, rows = random.Random(5), []
    for rule in licenses.RULES:
        for k in range(40):
            text = f" {example(re._parser.parse(rule['regex']), rng)} "
            assert re.search(rule["regex"], text), (rule, text)
            assert any(t in text for t in licenses.terms(rule["keyword"])), (rule, text)
            if k == 0:
                rows.append((rule["rank"], text.strip()))
    hits, found = licenses.detections(licenses.RULES)
    frame = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", licenses.normalised().alias("norm")).withColumn("hits", hits)
    got = frame.select("doc_id", F.transform(found, lambda d: d["rank"]).alias("ranks")).collect()
    assert len(got) == len(licenses.RULES) and all(r["doc_id"] in r["ranks"] for r in got)


def test_license_versions_and_fused_names(spark):
    cases = {"Mozilla Public License v2.0": "mpl-2.0", "Apache License v2.0": "apache-2.0",
             "Apache License, Version v2": "apache-2.0", "under GPLv3": "gpl-3",
             "LGPLv2.1": "lgpl-2.1", "gpl3": "gpl-3", "AGPL v3.0": "agpl-3",
             "GNU General Public License v2": "gpl,gpl-2", "beerware license": "beerware",
             "0BSD license": "0bsd", "noncommercial use only": "noncommercial",
             "PSF License Version 2": "python-2.0", "EUPL": "",
             "public domain dedication and license": "pddl-1.0", "CECILLv2.1": "cecill-2.1",
             "CC BY-SA v4.0": "cc-by,cc-by-sa-4.0"}
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = by_id(licenses.scan(frame))
    assert {t: got[i]["labels"] for i, t in enumerate(cases)} == {
        t: ",".join(sorted(w.split(","))) for t, w in cases.items()}


# 4 -----------------------------------------------------------------------------------

def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(
        {c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, distance):
    low = {i: i for i in range(len(ids))}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = root(i), root(j)
                low[max(a, b)] = min(a, b)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(root(i), []).append(x)
    return [min((x for x in groups[root(i)] if x is not None), default=None)
            for i in range(len(ids))]


def test_simhash_against_brute_force(spark, docs, table):
    for frame in (docs, table):
        rows = frame.select("doc_id", "text").collect()
        prints = [slow_print(r["text"]) for r in rows]
        want = zip([r["doc_id"] for r in rows], prints,
                   slow_components([r["doc_id"] for r in rows], prints, 4))
        got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"])
               for r in simhash.near_duplicates(frame).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 5])
def test_close_pairs(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = {b ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(7))})
              for b in base for _ in range(8)} | {0, (1 << 64) - 1, 1 << 63}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = [tuple(sorted(r)) for r in simhash.close_pairs(frame, distance).collect()]
    want = {tuple(sorted((a, b))) for a in signed for b in signed
            if a < b and bin((a ^ b) % (1 << 64)).count("1") <= distance}
    assert len(got) == len(set(got)) and set(got) == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {
        **{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 140)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 5 -----------------------------------------------------------------------------------

def test_language_accuracy(spark):
    frame = spark.read.parquet(f"{SF_DIR}/../sf0.01/documents.parquet")
    got = langid.predict(frame, langid.fit(frame))
    right = got.join(frame, "doc_id").where(langid.held_out()).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_edges(spark, docs):
    labelled = spark.createDataFrame(
        [(i, f"the harbour {prose(i, 30)}" if i % 2 else "größe straße über schön " * 5,
          "en" if i % 2 else "de") for i in range(60)], "doc_id long, text string, lang string")
    model = langid.fit(labelled)
    got = by_id(langid.predict(docs, model))
    assert {got[i]["lang_pred"] for i in (0, 1, 2, 9)} == {"und"} and got[0]["score"] == 0
    assert got[8]["lang_pred"] == "en" and 0 <= got[8]["score"] <= 1
    assert langid.predict(docs, model).count() == len(awkward())
    none = langid.fit(empty(spark))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    sampled = {r["doc_id"] for r in langid.sample(labelled, 5, 8, langid.learned()).collect()}
    folds = [zlib.crc32(str(i).encode()) for i in sampled]
    assert len(sampled) == 8 and all(f % 4 != 2 and f // 4 % 8 for f in folds)
    for fold in (langid.held_out(), langid.spare(), langid.learned()):
        assert 0 < labelled.where(fold).count() < 60


def test_held_out_documents_change_nothing(spark):
    """Neither fit nor cut looks at the held-out fold; a repeated id keeps each text's label."""
    rows = [(i, f"the harbour {prose(i, 30)}" if i % 2 else f"größe straße {i} über schön " * 5,
             "en" if i % 2 else "de") for i in range(200)]
    rows += [(401, "größe und straße über alles schön", "de"), (401, prose(7, 30), "en")]
    kind = "doc_id long, text string, lang string"
    frame = spark.createDataFrame(rows, kind)
    other = frame.where(~langid.held_out()).unionByName(frame.where(langid.held_out()).select(
        "doc_id", F.lit("zzz qqq").alias("text"), F.lit("xx").alias("lang")))
    models = [langid.calibrate(d, langid.fit(d)) for d in (frame, other.repartition(3))]
    assert models[0].languages == models[1].languages == ("de", "en")
    assert models[0].cut == models[1].cut != langid.CUT
    assert np.array_equal(models[0].landmarks, models[1].landmarks)
    assert np.allclose(models[0].weights, models[1].weights)
    bits = langid.labelled_bits(frame.where("doc_id = 401"), 9, 9, F.lit(True))
    want = {lang: np.packbits(langid.presence([text])[0].astype(np.uint8), axis=1)[0].tobytes()
            for i, text, lang in rows if i == 401}
    assert {r["lang"]: bytes(r["bits"]) for r in bits} == want


def test_kernel_and_ridge_against_a_plain_twin(spark):
    """Gram sets, kernel and ridge written out over Python sets and a direct solution."""
    def slots(text):
        codes = [ord(c.lower()[0]) if c.isalpha() else 32 for c in f" {text} "]
        codes = [c for k, c in enumerate(codes) if k == 0 or c != 32 or codes[k - 1] != 32]
        out = set()
        for n in (1, 2, 3):
            for at in range(len(codes) - n + 1):
                h = 0
                for c in codes[at:at + n]:
                    h = (h + c) * 0x9E3779B1 % 2 ** 32
                    h ^= h >> 15
                out.add((h * 0x85EBCA77 % 2 ** 32) >> 18)
        return out

    texts = ["The Harbour, at night", "größe über Straße 12", "a", "un été là-bas", "x  y\nz"]
    grams, _ = langid.presence(texts)
    assert [set(np.flatnonzero(g)) for g in grams] == [slots(t) for t in texts]
    rows = [(i, prose(i, 12) if i % 2 else "größe straße über " + prose(i, 3)[::-1],
             "en" if i % 2 else "de") for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(frame, landmarks=10)
    marks = [set(np.flatnonzero(np.unpackbits(m))) for m in model.landmarks]
    fitted = [(slots(t), lang) for i, t, lang in rows
              if zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(str(i).encode()) // 4 % 8]
    assert all(any(m == s for s, _ in fitted) for m in marks) and len(marks) == 10

    def k(a, b):
        return len(a & b) / (len(a) * len(b)) ** 0.5

    full = np.array([[k(s, m) for m in marks] for s, _ in fitted])
    core = np.array([[k(a, b) for b in marks] for a in marks]) + 1e-6 * np.eye(10)
    target = np.array([[1.0 if lang == name else -1.0 for name in ("de", "en")]
                       for _, lang in fitted])
    weights = np.linalg.solve(full.T @ full + langid.RIDGE * len(fitted) * core,
                              full.T @ target)
    asked = [prose(900, 20), "straße und größe", "zebra"]
    got = by_id(langid.predict(spark.createDataFrame(list(enumerate(asked)),
                                                     "doc_id long, text string"), model))
    for i, text in enumerate(asked):
        outs = np.array([k(slots(text), m) for m in marks]) @ weights
        assert got[i]["lang_pred"] == ("de", "en")[outs.argmax()]
        assert abs(got[i]["score"] - min(1, max(0, (outs.max() + 1) / 2))) < 1e-3


def test_model_and_cut_come_from_every_labelled_document(spark, monkeypatch):
    """More documents than any sample would hold, in more labels than a task holds: counts,
    weights and cut are those of all of them, however the rows are dealt."""
    monkeypatch.setattr(langid, "LANGUAGES_HELD", 2)
    rng = random.Random(8)
    letters = {"de": "abcdefghäöüß", "en": "abcdefghklmn", "fr": "acegéèàçklmn"}
    rows = [(i, "" if i % 97 == 0 else " ".join("".join(rng.choices(letters[lang], k=rng.randrange(
        1, 6))) for _ in range(rng.randrange(1, 30))), lang)
        for i, lang in enumerate(rng.choices(list(letters), [20, 4, 1], k=6500))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = [langid.calibrate(d, langid.fit(d, landmarks=12))
              for d in (frame, frame.repartition(7))]
    fold = [zlib.crc32(str(i).encode()) for i, _, _ in rows]
    grams, seen = langid.presence([t for _, t, _ in rows])
    spare = np.array([f % 4 != 2 and f // 4 % 8 == 0 for f in fold]) & seen
    fitted = np.array([f % 4 != 2 and f // 4 % 8 != 0 for f in fold]) & seen
    lang = np.array([r[2] for r in rows])
    assert fitted.sum() > 4000 and min((spare & (lang == x)).sum() for x in ("de", "en")) > 60
    names = sorted(letters)
    known = np.array([grams[fitted & (lang == name)].mean(axis=0, dtype=float) >= langid.COMMON
                      for name in names])
    marks = np.unpackbits(models[0].landmarks, axis=1).astype(float)

    def k(a):
        return a @ marks.T / np.sqrt(a.sum(axis=1)[:, None] * marks.sum(axis=1))

    full = k(grams[fitted].astype(float))
    target = np.where(lang[fitted][:, None] == names, 1.0, -1.0)
    weights = np.linalg.solve(full.T @ full + langid.RIDGE * len(full) * (
        k(marks) + 1e-6 * np.eye(12)), full.T @ target)
    share = (grams[spare] @ known.T.astype(float)).max(axis=1) / grams[spare].sum(axis=1)
    cut = langid.SLACK * np.quantile(share, langid.LOW)
    for model in models:
        assert model.languages == tuple(names)
        assert np.array_equal(model.known, np.packbits(known, axis=1))
        assert np.abs(k(grams[seen]) @ (model.weights - weights)).max() < 1e-3
        assert abs(model.cut - cut) < 1e-4
    assert models[0].cut == models[1].cut
    assert np.array_equal(models[0].weights, models[1].weights)


def test_unlike_texts_go(spark):
    frame = spark.read.parquet(f"{SF_DIR}/../sf0.01/documents.parquet")
    rng = random.Random(1)

    def junk(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    unlike = [
        "这是一个关于语言识别的文本,我们希望它不会被当作已知语言。今天天气很好。",
        "Это текст на русском языке, который не должен считаться известным. Сегодня хорошо.",
        "Zażółć gęślą jaźń, to jest tekst w języku polskim, który nie powinien zostać uznany",
        "Tämä on suomenkielinen teksti, jota ei pitäisi tunnistaa tunnetuksi kieleksi. Tänään",
        junk("bcdfghjklmnpqrstvwxz ", 900), junk("0123456789abcdef", 900),
        junk("abcdefghijklmnopqrstuvwxyz ", 60000)]
    labelled = [r["text"] for r in frame.where(langid.held_out() & (F.length("text") > 40))
                .collect() if re.search(r"[^\W\d_]{3}", r["text"][:30])]
    short = [" ".join(t.split()[:8]) for t in labelled]
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(
        unlike + labelled + short)], DOCS)
    kept = {r["doc_id"] for r in langid.keep(rows, langid.calibrate(
        frame, langid.fit(frame))).collect()}
    assert not kept & set(range(len(unlike)))
    assert len(kept) == len(labelled) + len(short) > 300


# 6 -----------------------------------------------------------------------------------

def test_mixing(spark, docs):
    rates = spark.createDataFrame([("s0", 0.0), ("s1", 40.0), (None, 2.5)],
                                  "source string, rate double")
    plain = docs.drop("rate")
    got = mixing.mix(plain, rates)
    counts = Counter(r["doc_id"] for r in got.collect())
    for doc, _, _, source, _ in awkward()[:14]:
        rate = {"s0": 0.0, "s1": 40.0, None: 2.5}.get(source, 1.0)
        if source == "s2":
            assert counts[doc] == (3 if doc == 5 else 1)
            continue
        parts = max(1, int(np.ceil(rate / 16)))
        draws = [int(hashlib.md5(f"17:{doc}:{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
                 for j in range(1, parts + 1)]
        want = 0
        for u in draws:
            p = c = float(np.exp(-rate / parts))
            k = 0
            while c <= u:
                k += 1
                p *= rate / parts / k
                c += p
            want += k
        assert counts[doc] == want * (3 if doc == 5 else 1)
    assert mixing.mix(empty(spark), mixing.target_rates(empty(spark))).count() == 0
    assert sum(r["rate"] is None for r in mixing.target_rates(plain).collect()) == 0


def test_mixing_means(spark):
    frame = spark.range(20000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'a', 'b') AS source")
    rates = spark.createDataFrame([("a", 0.7), ("b", 21.0)], "source string, rate double")
    got = {r["source"]: r["n"] / 10000 for r in mixing.mix(frame, rates).groupBy("source")
           .agg(F.count("*").alias("n")).collect()}
    assert abs(got["a"] - 0.7) < 0.03 and abs(got["b"] - 21) < 0.2


# 7 -----------------------------------------------------------------------------------

def test_base_spans():
    text = "a.b@c.de 10.0.0.256 x10.0.0.25. 4041894974608795 +1 (988) 555-2485, 1234567812345678"
    assert [text[a:b] for a, _, b in pii.base_spans(text)] == [
        "a.b@c.de", "10.0.0.25", "4041894974608795", "+1 (988) 555-2485"]
    assert pii.base_spans("") == [] and pii.luhn("4041894974608795")


def test_emails_and_addresses_against_plain_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(3)
    for _ in range(20000):
        text = "".join(rng.choice("a@.1_- 2") for _ in range(rng.randrange(25)))
        assert pii.emails(text) == [m.span() for m in email.finditer(text)]
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in ip.finditer(text)]


def test_long_runs_are_scanned_once():
    text = "@ " + "a" * 500_000 + " " + "1" * 500_000 + " " + "AB-12345678 " * 20_000
    assert sum(m[2] == pii.CANDIDATE for m in pii.mentions(text)) == 20_001


def test_detect(spark, docs):
    got = [r for r in pii.detect(docs).collect()]
    want = []
    for doc, text, *_ in awkward():
        spans = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.base_spans(text or ""))
        want.append((doc, hashlib.sha256(spans.encode()).hexdigest(), spans))
    assert sorted([(r["doc_id"], r["base_sha256"], r["spans"]) for r in got], key=str) == sorted(
        want, key=str)
    assert pii.detect(empty(spark)).count() == 0


def test_candidates():
    def found(text):
        return {text[m[0]:m[1]] for m in pii.mentions(text) if m[2] == pii.CANDIDATE}

    assert found("id=12345678,name=foo") == {"12345678"}
    assert found("a@b.org,123-45-6789") == {"123-45-6789"}
    assert found('{"ssn":"123-45-6789","k":[7]}') == {"123-45-6789", "7"}
    assert found("号码12345678在 éAB-1234567") == {"12345678", "AB-1234567"}
    assert "DE89 3704 0044 0532 0130 00" in found("to DE89 3704 0044 0532 0130 00 now")
    assert "GB29 NWBK 6016 1331 9268 19" in found("to GB29 NWBK 6016 1331 9268 19 now")
    assert "663 555 6869" in found("call 663 555 6869.")
    assert "(663) 555-6869" in found("call (663) 555-6869, or not")
    assert found("user7 in no. 12!") == {"user7", "12"}
    for text in ("1 " * 200_000, "1" * 400_000 + "x ", "(1" * 200_000, "1-" * 200_000,
                 "a!" * 200_000, "a" + "!" * 400_000):
        pii.mentions(text)


def test_discovery_of_short_and_spaced_identifiers(spark):
    texts = [f"reach me at number u{i}@mail{i}.org today please" for i in range(30)]
    texts += ["at number (663) 555-6869 today", "at number DE89 3704 0044 0532 0130 00 today",
              "a,number=4711,today"]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    clean = by_id(pii.redact(frame))
    assert [clean[i]["text"] for i in (30, 31, 32)] == [
        "at number [ID] today", "at number [ID] today", "a,number=[ID],today"]


def bootstrap_fixture() -> list[tuple]:
    seeds = [(i, f"river stone reach me at number u{i}@mail{i}.org today please",
              None, None, None) for i in range(30)]
    new = [(100 + i, f"garden call at number QX-77{i}-{9000 + 7 * i} today thanks", None, None,
            None) for i in range(3)]
    other = [(200 + i, f"order batch PART{i}55512 arrived from winter {i}", None, None, None)
             for i in range(10)]
    return seeds + new + other


def slow_discover(texts, rounds=3, support=5, sure=0.9):
    edges, seeds = set(), set()
    for text in texts:
        for _, _, kind, instance, *patterns in pii.mentions(text):
            edges |= {(p, instance) for p in patterns}
            if kind != pii.CANDIDATE:
                seeds.add(instance)
    belief = {i: 1.0 for i in seeds}
    for _ in range(rounds):
        trust = {}
        for p in {p for p, _ in edges}:
            met = [belief.get(i, 0.0) for q, i in edges if q == p]
            if sum(b >= sure for b in met) >= support:
                trust[p] = sum(met) / (len(met) + 1)
        belief = {i: 1.0 for i in seeds}
        for i in {i for p, i in edges if p in trust} - seeds:
            belief[i] = 1 - np.prod([1 - trust[p] for p, j in edges if j == i and p in trust])
    return {i for i, b in belief.items() if b >= sure} - seeds


def test_bootstrapping(spark):
    rows = bootstrap_fixture()
    frame = spark.createDataFrame(rows, DOCS)
    found = {r["instance"] for r in pii.discover(pii.find(frame, {"doc_id": "bigint"})).collect()}
    assert found == slow_discover([r[1] for r in rows]) and len(found) == 3
    got = by_id(pii.detect(frame))
    assert got[101]["spans"] == "id:22:33" and got[205]["spans"] == ""
    clean = by_id(pii.redact(frame))
    assert clean[1]["text"] == "river stone reach me at number [EMAIL] today please"
    assert clean[101]["text"] == "garden call at number [ID] today thanks"
    assert clean[1]["n_chars"] == len(clean[1]["text"])


def test_frequent_tokens_are_not_discovered(spark):
    texts = [f"reach me at number u{i}@mail{i}.org today please" for i in range(30)]
    texts += [f"write to address w{i}@mail{i}.org soon please" for i in range(30)]
    texts += ["at number QX-774-9021 today", "to address AB-555-1234 soon"]
    # a date in hundreds of contexts: each met a few seeds among many other tokens
    for k in range(300):
        texts += [f"w{k}x k{k}u{i}@mail{i}.org v{k}x" for i in range(5)]
        texts += [f"w{k}x PART{k}{i}55512 v{k}x" for i in range(5)]
        texts.append(f"w{k}x 2024-01-05 v{k}x")
    # and twice in a trusted one
    texts += ["at number 2024-01-05 today", "to address 2024-01-05 soon"]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    spans = by_id(pii.detect(frame))
    assert spans[60]["spans"] == "id:10:21" and spans[61]["spans"] == "id:11:22"
    assert all("id:" not in spans[i]["spans"] for i in range(62, len(texts)))


def test_redact_edges(spark, docs):
    got = pii.redact(docs)
    assert got.columns == corpus_pipeline.COLUMNS and got.count() == len(awkward())
    assert by_id(got)[0]["text"] is None and by_id(got)[13]["text"].startswith("mail [EMAIL] now")


# 8 -----------------------------------------------------------------------------------

def slow_repeats(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - width + 1):
            if seen[d[i:i + width]] > 1:
                gone[i:i + width] = True
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(d)))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_against_brute_force(spark, seed):
    rng = random.Random(seed)
    passage = prose(seed, 90)
    texts = [r[1] for r in awkward()]
    for i in range(60):
        a, b = sorted(rng.choices(range(len(passage)), k=2))
        texts.append(prose(100 * seed + i, rng.randrange(60)) + passage[a:b] * rng.randrange(3)
                     + prose(9000 + i // 7, rng.randrange(90)) + "ab" * rng.randrange(200))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in repeats.remove_repeats(frame).collect())
    assert got == [(i, *row) for i, row in enumerate(slow_repeats(texts, 200))]


def test_repeats_other_sizes_and_edges(spark, docs):
    rows = awkward()
    got = rows_of(repeats.remove_repeats(docs))
    assert got == sorted([(r[0], *x) for r, x in zip(
        rows, slow_repeats([r[1] for r in rows], 200))], key=str)
    assert repeats.remove_repeats(empty(spark)).count() == 0


# 9 -----------------------------------------------------------------------------------

def check_packing(rows, packed):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    ids = [tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows]
    want = Counter((r[0], len(x)) for r, x in zip(rows, ids))
    whole, pieces, sequences = Counter(), {}, {}
    for p in packed:
        pieces.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    by_key = {(r[0], len(x)): x for r, x in zip(rows, ids)}
    for key, parts in pieces.items():
        for p in parts:
            part = by_key[key][p["start"]: p["start"] + p["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"]
        covered = Counter(i for p in parts for i in range(p["start"], p["start"] + p["length"]))
        assert set(covered) == set(range(key[1])) and set(covered.values()) == {want[key]}
        whole[key] = want[key]
    assert whole == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0


def test_packing(spark, docs, table):
    rows = awkward()
    check_packing(rows, packing.pack(docs, bucket_bytes=20000).collect())
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    check_packing(rows, packing.pack(table).collect())
    assert packing.pack(empty(spark)).count() == 0


def test_encoder_equals_tokenizer():
    import pyarrow as pa

    rng = random.Random(4)
    marks = list("aAbZé. ,;:!?'\n\t\r\x0b\x1c\x85  İſKΣς0９𝔘́<|>-“”«»…") + [
        "<|endoftext|>", "<|ENDOFTEXT|>", "don't ", "word. ", "Über "]
    texts = ["".join(rng.choices(marks, k=rng.randrange(40))) for _ in range(400)] + [None, ""]
    encoder = packing.Encoder(packing.TOKENIZER, "<u2")
    for part in (texts, texts[50:90]):
        ids, ends = encoder.encode(pa.array(part, pa.string()))
        starts = [0, *ends.tolist()]
        for i, t in enumerate(part):
            want = encoder.tokenizer.encode(t or "", add_special_tokens=False).ids
            assert ids[starts[i]:starts[i + 1]].tolist() == want, repr(t)


def test_words_with_signs_are_encoded_once():
    """All Latin letters beside all signs: the tokenizer's ids, and no word is learned again
    for the signs behind it."""
    import pyarrow as pa

    letters = [c for i in range(65, 0x250) if (c := chr(i)).isalpha()]
    signs = [chr(i) for i in range(33, 127) if not chr(i).isalnum()]
    rng = random.Random(5)
    texts = [f"{c}{s}{c} {c}q{s}{s}" for c in letters for s in signs]
    texts += ["".join(rng.choices(letters + 9 * signs + [" "] * 60, k=60)) for _ in range(300)]
    texts += ["×. ÷. e\u0301. e.\u0301 =\u0338 a=\u0338", "é<|endoftext|>. É.<|endoftext|>É|"]
    encoder = packing.Encoder(packing.TOKENIZER, "<u2")
    for part in (texts[:-1], texts[-2:]):
        ids, ends = encoder.encode(pa.array(part, pa.string()))
        starts = [0, *ends.tolist()]
        for i, t in enumerate(part):
            want = encoder.tokenizer.encode(t, add_special_tokens=False).ids
            assert ids[starts[i]:starts[i + 1]].tolist() == want, repr(t)
    encoder = packing.Encoder(packing.TOKENIZER, "<u2")
    encoder.encode(pa.array(["été river"]))
    known = set(encoder.young)
    encoder.encode(pa.array(["été. été&&& été) river,*** River%%%", "été.%%% river|"]))
    assert not {c for c in set(encoder.young) - known if any(x.isalpha() for x in c)}


@pytest.mark.parametrize("seed", range(4))
def test_windows(seed):
    rng = random.Random(seed)
    lengths = [min(4096, int(rng.lognormvariate(5 + seed, 1.5)) + 1) for _ in range(300)]
    windows = packing.plan_windows(lengths)
    covered = Counter()
    for window in windows:
        size = sum(n for _, _, n in window)
        assert size & (size - 1) == 0 and size <= 4096
        covered.update((i, a + k) for i, a, n in window for k in range(n))
    assert covered == Counter((i, k) for i, n in enumerate(lengths) for k in range(n))
    groups = packing.step_groups([sum(n for _, _, n in w) for w in windows], 1 << 14)
    loads = Counter()
    for w, g in zip(windows, groups):
        loads[g] += sum(n for _, _, n in w)
    assert max(loads.values()) - min(loads.values()) <= 4096


# 10 ----------------------------------------------------------------------------------

def slow_spots(text):
    upper = {c: c + 32 for c in range(65, 91)}
    kept = (text or "").replace("İ", "ı").replace("K", "ĸ")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", kept.translate(upper).lower())
    anchors, out = set(spotsigs.ANCHORS), set()
    for i, w in enumerate(words):
        if w in anchors:
            chain, steps = [], 0
            for x in words[i + 1:]:
                steps += x in anchors
                if steps > spotsigs.REACH or len(chain) == spotsigs.CHAIN:
                    break
                if x not in anchors:
                    chain.append(x)
            if len(chain) == spotsigs.CHAIN:
                out.add((w, *chain))
    return out or {tuple(words)}


def slow_likeness(a, b):
    return len(a & b) / len(a | b)


def test_spotsigs_against_brute_force(spark, table, docs):
    for frame in (table, docs):
        rows = sorted(((r[0], r[1] or "") for r in frame.select("doc_id", "text").collect()),
                      key=lambda r: (r[0] is None, -(r[0] or 0)))
        want = {}
        for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
            half = len(text) // 2
            changed = text[:len(text) - half] + following[:half]
            want.setdefault(doc, []).append((
                len(text), hashlib.sha256(changed.encode()).hexdigest(),
                slow_likeness(slow_spots(text), slow_spots(changed)),
                slow_likeness(slow_spots(text), slow_spots(following))))
        got = {}
        for r in spotsigs.compare_edits(frame).collect():
            got.setdefault(r["doc_id"], []).append(
                (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]))
        assert got.keys() == want.keys()
        for doc in want:
            for a, b in zip(sorted(got[doc]), sorted(want[doc])):
                assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])
    assert spotsigs.compare_edits(empty(spark)).count() == 0


def test_next_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_BYTES", 1)
    ids = [3, 9, 27, 81, 82, 83, -5, 1000, 5000]
    frame = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in spotsigs.with_next(frame, ["text"]).collect()}
    down = sorted(ids, reverse=True)
    assert got == {a: str(b) for a, b in zip(down, down[1:] + down[:1])}
    chance = random.Random(4)
    wild = [(chance.choice([chance.randrange(60), chance.randrange(-(1 << 62), 1 << 62)]),
             "x" * chance.randrange(50)) for _ in range(400)] + [(None, "n"), (-(1 << 63) + 1, None)]
    frame = spark.createDataFrame([(i, f"{n}{t or ''}", "clash") for n, (i, t) in enumerate(wild)],
                                  "doc_id long, text string, size string")
    for size in (1, 40, 700, 5000, 1 << 20):
        monkeypatch.setattr(spotsigs, "BUCKET_BYTES", size)
        got = spotsigs.with_next(frame, ["doc_id", "text"]).collect()
        texts = sorted(r["text"] for r in got)  # every row once, every row after one other
        assert texts == sorted(r["next_text"] for r in got) and len(set(texts)) == len(wild)
        ids = sorted((i for i, _ in wild), key=lambda i: (i is None, -(i or 0)))
        after = Counter(zip(ids, ids[1:] + ids[:1]))
        assert Counter((r["doc_id"], r["next_doc_id"]) for r in got) == after
    monkeypatch.setattr(spotsigs, "BUCKET_BYTES", 1)
    one = spark.createDataFrame([(4, "x")], "doc_id long, text string")
    assert spotsigs.with_next(one, ["text"]).first()["next_text"] == "x"


def test_similar_pairs(spark):
    base = prose(5, 120)
    texts = [base, base, base + " the quiet moon", base + " of " + prose(6, 14), prose(7, 100),
             None, "", prose(8, 30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for least in (0.5, 0.8, 0.95):
        labels, pairs = spotsigs.similar_pairs(frame, least)
        classes = {r["doc_id"]: r["class_id"] for r in labels.collect()}
        assert classes[1] == 0 and classes[6] == 5
        sets = {c: slow_spots(texts[c]) for c in set(classes.values())}
        want = {(a, b) for a in sets for b in sets
                if a < b and slow_likeness(sets[a], sets[b]) >= least}
        got = [(r["a"], r["b"]) for r in pairs.collect()]
        assert len(got) == len(set(got)) and set(got) == want


# pipeline ----------------------------------------------------------------------------

def test_pipeline_stages(spark, docs, table):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language ID"
    for frame in (docs, table, empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF_DIR).columns == corpus_pipeline.COLUMNS
    kept = corpus_pipeline.drop_near_duplicates(spark, table, SF_DIR)
    rows = table.select("doc_id", "text").collect()
    ids = [r["doc_id"] for r in rows]
    want = set(slow_components(ids, [slow_print(r["text"]) for r in rows], 4))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    masked = corpus_pipeline.mask_personal_data(spark, table, SF_DIR)
    assert not any(pii.base_spans(r["text"]) for r in masked.collect())
    final = corpus_pipeline.run(spark, SF_DIR)
    assert final.count() > 0
    lengths = final.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert all(r["n"] & (r["n"] - 1) == 0 and r["n"] <= 4096 for r in lengths)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    near = prose(2, 300)
    texts = [(None, prose(50 + i, 60)) for i in range(6)]  # unrelated texts without ids
    texts += [(None, near), (3, near + " x"), (9, near), (3, near + " x")]
    texts += [(9, prose(70, 80)), (9, prose(71, 80)), (None, prose(50, 60)), (4, None), (None, "")]
    rows = [(i, t, None, None, None) for i, t in texts]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, DOCS), SF_DIR)
    ids = list(range(len(rows)))
    low = slow_components(ids, [slow_print(t) for _, t in texts], 4)
    want = []
    for g in set(low):
        members = [texts[i] for i in ids if low[i] == g]
        want.append(min(members, key=lambda m: (m[0] is None, m[0] or 0, slow_print(m[1]))))
    assert len(want) == 10
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(
        want, key=str)
