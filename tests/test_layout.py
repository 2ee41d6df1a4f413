"""Layout along the curve: bounds, skipping, skewed and awkward columns."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulseboard.session import scratch_path
from pulseboard.sources import layout
from pulseboard.sources.versions import Versioned

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def mails(spark):
    """8000 rows; a third of them on one account; some without account or time."""
    n = F.col("id")
    account = F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).otherwise(
        F.concat(F.lit("a"), F.lpad((F.xxhash64(n) % 200).cast("string"), 5, "0")))
    time = F.lit(START) + F.make_dt_interval(F.lit(0), F.pmod(F.xxhash64(n, F.lit(7)), F.lit(
        24 * 365)).cast("int"))
    return spark.range(8000).select(
        n.alias("n"), account.alias("account"),
        F.when(n % 70 != 2, time).cast("timestamp_ntz").alias("time"))


def numbers(df):
    return sorted(r["n"] for r in df.select("n").collect())


def test_interleaved(spark):
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 5), (63, 63)], "a int, b int")
    got = [r[0] for r in df.select(layout.interleaved([a, b])).collect()]
    assert got == [0, 2, 1, 0b011011, 4095]


def test_range_numbers_follow_the_order(spark, mails):
    begins = layout.cuts(mails, "time", 3)
    assert begins == sorted(begins) and 1 <= len(begins) <= 7
    rows = mails.select("time", layout.range_number("time", begins).alias("k")).collect()
    for r in rows[:300]:
        assert r["k"] == sum(r["time"] is not None and r["time"] >= b for b in begins)
    assert layout.cuts(mails.where("false"), "time") == []


@pytest.mark.parametrize("bounds", [
    {"time": (START + timedelta(days=100), START + timedelta(days=107))},
    {"account": ("a00017", "a00017")},
    {"account": ("hot", "hot"), "time": (None, START + timedelta(days=10))},
    {"time": (START + timedelta(days=900), None)},
])
def test_within_bounds(spark, mails, bounds):
    base = scratch_path(spark, "curve")
    table = layout.write_curve(mails, base, "account", "time", files=64)
    test = F.lit(True)
    for c, (low, high) in bounds.items():
        test = test & (F.col(c) >= F.lit(low) if low is not None else F.lit(True))
        test = test & (F.col(c) <= F.lit(high) if high is not None else F.lit(True))
    got = layout.read_within(spark, base, mails.schema, bounds)
    assert numbers(got) == numbers(mails.where(test))
    assert table.read(mails.schema).count() == 8000
    whole, opened = table.pieces().count(), layout.skipping(table, bounds).count()
    assert whole >= 40 and opened <= whole / 3


def test_both_columns_skip_where_a_sort_skips_one(spark, mails):
    """Time alone opens a fraction of the curve's files, and nearly all of the sorted ones."""
    week = {"time": (START + timedelta(days=100), START + timedelta(days=107))}
    curve = layout.write_curve(mails, scratch_path(spark, "c"), "account", "time", files=64)
    plain = layout.write_curve(mails, scratch_path(spark, "p"), "account", "time", files=64,
                               bits=0)
    parts = [layout.skipping(t, week).count() / t.pieces().count() for t in (curve, plain)]
    assert parts[0] < 0.35 < 0.6 < parts[1]


def test_versions_and_empty_tables(spark, mails):
    base = scratch_path(spark, "curve")
    layout.write_curve(mails, base, "time", files=4)
    layout.write_curve(mails.where("n < 10"), base, "time", files=4)
    table = Versioned(spark, base)
    assert table.current() == 1 and table.read(mails.schema).count() == 10
    assert table.read(mails.schema, table.pieces(0)).count() == 8000
    nothing = scratch_path(spark, "nothing")
    layout.write_curve(mails.where("false"), nothing, "account", "time")
    assert layout.read_within(spark, nothing, mails.schema, {"account": ("a", "b")}).count() == 0
