"""Stored labels of folder trees: moves equal a rebuild and touch their subtree only."""

import random

import pytest

from pulseboard.operators import intervals, tree
from pulseboard.session import scratch_path


def frame(spark, parents):
    return spark.createDataFrame(list(parents.items()), "id string, parent string")


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_labels_and_closure(spark):
    parents = {"a": "root", "b": "a", "a/b": "a", "100%": "a/b", "c": "100%", "lost": "nowhere",
               "x": "y", "y": "x", "root": None, "a b": "root", "d": "a b"}
    got = intervals.labelled(frame(spark, parents), "root")
    assert {r["id"]: r["label"] for r in got.collect()} == {
        "a": "a", "b": "a/b", "a/b": "a/a%2Fb", "100%": "a/a%2Fb/100%25", "a b": "a b",
        "c": "a/a%2Fb/100%25/c", "d": "a b/d"}
    assert pairs(intervals.closure(got)) == pairs(
        tree.root_children_closure(frame(spark, parents), "root"))


def test_moves_equal_a_rebuild(spark):
    rng = random.Random(6)
    parents = {"root": None, **{f"n{i}": "root" if i < 4 else f"n{rng.randrange(i)}"
                                for i in range(300)}}
    table = intervals.build(frame(spark, parents), "root", scratch_path(spark, "t"), files=12)

    def ancestors(x):
        while x is not None:
            yield x
            x = parents[x]

    done = 0
    while done < 6:
        folder, target = f"n{rng.randrange(300)}", rng.choice(
            ["root", *[f"n{rng.randrange(300)}" for _ in range(4)]])
        if folder in ancestors(target):
            with pytest.raises(ValueError):
                intervals.move(table, "root", folder, target)
            continue
        before = {r["piece"] for r in table.pieces().collect()}
        written = intervals.move(table, "root", folder, target)
        kept = before & {r["piece"] for r in table.pieces().collect()}
        assert len(kept) == len(before) - written
        parents[folder] = target
        done += 1
    fresh = intervals.labelled(frame(spark, parents), "root")
    assert pairs(table.read(intervals.TREE)) == pairs(fresh)
    under = {x for x in parents if x != "n1" and "n1" in ancestors(x)}
    assert {r["id"] for r in intervals.below(spark, table.base, "n1").collect()} == under
    with pytest.raises(KeyError):
        intervals.move(table, "root", "unknown", "root")


def test_a_move_leaves_other_files_alone(spark):
    parents = {"root": None, **{f"t{i}": "root" for i in range(10)},
               **{f"t{i}x{k}": f"t{i}" for i in range(10) for k in range(50)}}
    table = intervals.build(frame(spark, parents), "root", scratch_path(spark, "t"), files=20)
    old = table.read(intervals.TREE)
    assert intervals.move(table, "root", "t3", "t8") <= 5 <= 15 <= table.pieces().count()
    assert old.where("label = 't3'").count() == 1  # who reads the old version still can
    assert table.read(intervals.TREE).where("startswith(label, 't8/t3')").count() == 51
