"""Dedupe, matching, tree walk and checks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pulseboard.operators import dedupe, matching, quality, tree
from pulseboard.schemas import EMAILS, LEGACY_EMAILS, empty_like
from tests.conftest import column

DICTIONARY = (("A", ("ring", "gear")), ("B", ("widget",)), ("C", ("ri",)))


# ---- dedupe -------------------------------------------------------------------
@pytest.fixture()
def copies(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only"), ("c", 3, "x"), ("c", 3, "y"),
            ("d", None, "unknown"), ("d", 0, "known")]
    return spark.createDataFrame(rows, "id string, _extracted_at int, v string")


@pytest.mark.parametrize("latest", [dedupe.latest_per_key, dedupe.latest_per_key_agg])
def test_latest_wins_with_ties_and_nulls(copies, latest):
    got = {r["id"]: r["v"] for r in latest(copies, "id", tie_by=("v",)).collect()}
    assert got == {"a": "new", "b": "only", "c": "y", "d": "known"}
    again = latest(latest(copies, "id", tie_by=("v",)), "id", tie_by=("v",))
    assert {r["id"]: r["v"] for r in again.collect()} == got


def test_copies_of_one_hot_key_are_cut_before_the_shuffle(copies):
    plan = dedupe.latest_per_key(copies, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_top_k_per_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    got = dedupe.first_per_key(df, "g", [F.col("id").desc()], limit=2).collect()
    assert sorted((r["g"], r["id"]) for r in got) == [
        (0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]


# ---- matching -----------------------------------------------------------------
def test_first_entry_wins_and_words_may_contain_keywords(spark):
    texts = ["a Widget in a RING", "trading", "strip", "nothing", "", None]
    assert column(spark, texts, lambda c: matching.match_keywords(c, DICTIONARY)) == [
        "A", None, "C", None, None, None]
    assert column(spark, ["string", "a ring."], lambda c: matching.match_keywords(
        c, DICTIONARY, word_boundary=True)) == [None, "A"]
    assert column(spark, ["x", None], lambda c: matching.match_keywords(c, ())) == [None, None]


def test_alias_keeps_unmatched_names(spark):
    assert column(spark, ["Gear Ltd", "Other"], lambda c: matching.match_alias(c, DICTIONARY)) == [
        "A", "Other"]


def test_labels_by_dictionary_order(spark):
    labels = {"L2": "second", "L1": "first"}
    assert column(spark, [["L1", "L2"], ["L1"], ["x"], [], None],
                  lambda c: matching.match_labels(c, labels), "array<string>") == [
        "second", "first", None, None, None]


def test_attendee_domains_in_order(spark):
    assert column(spark, [["ring@x.com", "a@widget.com", "a@gear.com"], ["a@b.com"], [], None],
                  lambda c: matching.match_attendee_domain(c, DICTIONARY), "array<string>") == [
        "B", None, None, None]


def test_large_dictionaries(spark):
    words = [(f"A{i}", [f"key{i}x"]) for i in range(300)]
    assert column(spark, ["a KEY299X b", "key7x"], lambda c: matching.match_keywords(c, words)) == [
        "A299", "A7"]
    labels = {f"L{i}": f"A{i}" for i in range(250)}
    assert column(spark, [["L240", "L3"]], lambda c: matching.match_labels(c, labels),
                  "array<string>") == ["A3"]


@pytest.mark.parametrize("word_boundary", [False, True])
@pytest.mark.parametrize("sizes", [(1, 5), (4, 40), (1, 90)])
def test_trie_join_equals_brute_force(spark, word_boundary, sizes):
    rng = random.Random(7)

    def letters(alphabet, low, high):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))

    words = [(i, f"acc{i % 40}", letters("abcdé", *sizes)) for i in range(60)]
    words += [(99, "blank", ""), (100, "tie", words[7][2]), (101, "dot", "a.b"),
              (102, "wide", "𝔘b" * 3), (103, "shared", "abcdabcdabcd"),
              (104, "shared too", "abcdabcdabcdé")]
    texts = [letters("abcD é_", 0, 30) for _ in range(200)]
    for _, _, word in words * 2:  # inside longer texts, at their ends, across windows
        at = rng.randint(0, 300)
        texts.append(letters("xyz é", at, at) + rng.choice(["", " "]) + word.upper()
                     + rng.choice(["", ".", "q ", "é", "𝔘"]) + letters("xy z", 0, 200))
    rows = [*enumerate(texts), (9000, None), (9001, "")]
    got = matching.match_keywords_join(
        spark.createDataFrame(rows, "id int, t string"), "id", "t",
        spark.createDataFrame(words, "ord int, account string, keyword string"),
        word_boundary=word_boundary)

    def holds(text, word):
        if word_boundary:
            return re.search(rf"(?<!\w){re.escape(word)}(?!\w)", text, re.ASCII)
        return word in text

    def brute(text):
        return next((a for _, a, w in words if w and text and holds(text.lower(), w.lower())),
                    None)
    assert {r["id"]: r["account"] for r in got.collect()} == {i: brute(t) for i, t in rows}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_trie_join_of_an_empty_dictionary(spark):
    rows = spark.createDataFrame([(1, "text")], "id int, t string")
    none = spark.createDataFrame([], "ord int, account string, keyword string")
    assert [tuple(r) for r in matching.match_keywords_join(rows, "id", "t", none).collect()] == [
        (1, "text", None)]


# ---- tree ---------------------------------------------------------------------
def test_closure_with_deep_chain_cycle_and_detached(spark):
    chain = [("n0", "root")] + [(f"n{i}", f"n{i - 1}") for i in range(1, 40)]
    edges = [("root", None), ("m", "root"), ("m1", "m"), ("c1", "c2"), ("c2", "c1"), ("c3", "c1"),
             ("lost", "nowhere"), *chain]
    got = tree.root_children_closure(
        spark.createDataFrame(edges, "id string, parent string"), "root").collect()
    assert {r["id"]: r["top"] for r in got} == {
        "m": "m", "m1": "m", **{f"n{i}": "n0" for i in range(40)}}


def test_closure_with_one_crowded_folder(spark):
    edges = spark.range(3000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"), F.lit("hot").alias("parent"))
    head = spark.createDataFrame([("hot", "a"), ("a", "root")], "id string, parent string")
    got = tree.root_children_closure(edges.unionByName(head), "root")
    assert got.where("top = 'a'").count() == 3002


# ---- checks -------------------------------------------------------------------
def test_null_keys_and_row_counts(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert [tuple(r) for r in quality.null_key_counts({"t": (df, ["k"])}).collect()] == [
        ("t", "k", 3, 2)]
    assert [tuple(r) for r in quality.row_counts({"z": df, "b": df.where("k = 'a'")}).collect()] == [
        ("b", 1), ("z", 3)]


def test_declared_schemas(spark):
    empty = empty_like(spark, EMAILS)
    assert empty.count() == 0 and empty.schema == EMAILS
    assert not LEGACY_EMAILS["message_id"].nullable and LEGACY_EMAILS["subject"].nullable
    assert quality.declared_keys(LEGACY_EMAILS) == ["message_id"]
    with pytest.raises(ValueError):
        quality.require_schema(spark.createDataFrame([(1,)], "message_id int"), EMAILS)


def test_constraints_in_one_scan(spark):
    kind = "k string, a string, b string"
    rows = [("1", "x", "p"), ("1", None, "q"), (None, "x", None), (None, None, "gone"),
            ("2", "y", "gone"), ("2", "y", "gone"), ("2", None, "p"), ("3", "z", None)]
    other = spark.createDataFrame([("p",), ("q",), ("q",), (None,)], "name string")
    declared = quality.Constraints(("k", "a"), "k", (("b", other, "name"),))

    def found(df, what):
        return {(r["check"], r["column_name"]): (r["rows"], r["failures"])
                for r in quality.constraint_failures("t", df, what).collect()}

    df = spark.createDataFrame(rows, kind)
    assert found(df, declared) == {
        ("not null", "k"): (8, 2), ("not null", "a"): (8, 3), ("reference", "b"): (8, 3),
        ("unique", "k"): (8, 3)}
    assert found(df, quality.Constraints(("b",))) == {("not null", "b"): (8, 2)}
    assert set(found(df.where("false"), declared).values()) == {(0, 0)}


def test_constraints_scan_a_table_once(spark, tmp_path):
    spark.range(50).selectExpr("string(id) k", "string(id % 7) a").write.parquet(
        f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    other = spark.createDataFrame([("1",)], "name string")
    out = quality.constraint_failures("t", table, quality.Constraints(
        ("k", "a"), "k", (("a", other, "name"),)))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
