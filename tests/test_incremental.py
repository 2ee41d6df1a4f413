"""Versioned tables and the incremental refresh."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulseboard.hosts import bronze
from pulseboard.operators.dedupe import latest_per_key
from pulseboard.plans import gold, incremental, silver
from pulseboard.plans.incremental import FAMILIES, merge, state
from pulseboard.schemas import ACCOUNTS
from pulseboard.session import scratch_path
from pulseboard.sources.versions import Conflict, Versioned
from tests.conftest import AS_OF, SF_DIR

START = datetime(2024, 1, 1)


def accounts(spark, rows):
    """(id, name, arr, day) as bronze accounts."""
    blank = {f.name: None for f in ACCOUNTS}
    return spark.createDataFrame([tuple({
        **blank, "account_id": i, "account_name": n, "arr": a,
        "_extracted_at": START + timedelta(days=d)}.values()) for i, n, a, d in rows], ACCOUNTS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merges_equal_a_full_choice(spark):
    """Random deliveries in five runs, with ties, repeated rows and rows without a key."""
    rng, family = random.Random(4), FAMILIES["accounts"]
    table = state(spark, scratch_path(spark, "t"), "accounts")
    delivered = []
    for run in range(5):
        ids = [rng.choice([None, *"abcdefghijklmnop"]) for _ in range(12 if run else 40)]
        batch = [(i, f"n{rng.randrange(3)}", float(rng.randrange(3)), run) for i in ids]
        delivered += batch + batch[:3]
        merge(table, accounts(spark, delivered), family, buckets=8)
        want = latest_per_key(accounts(spark, delivered), family.key, tie_by=family.tie_by)
        assert rows_of(table.read(ACCOUNTS)) == rows_of(want)
    assert table.current() == 4


def test_a_run_touches_the_buckets_of_new_rows_only(spark):
    family = FAMILIES["accounts"]
    table = state(spark, scratch_path(spark, "t"), "accounts")
    first = [(f"k{i}", "n", 1.0, 0) for i in range(200)]
    done = merge(table, accounts(spark, first), family, buckets=16)
    assert (done.version, done.fresh_rows, done.touched) == (0, 200, 16)
    before = {r["bucket"]: r["piece"] for r in table.pieces().collect()}
    old = table.read(ACCOUNTS)
    done = merge(table, accounts(spark, first + [("k7", "new", 2.0, 1)] * 4), family)
    after = {r["bucket"]: r["piece"] for r in table.pieces().collect()}
    assert (done.fresh_rows, done.touched, done.buckets) == (1, 1, 16)
    assert sum(before[b] != after[b] for b in before) == 1 and len(after) == 16
    assert rows_of(old) == rows_of(accounts(spark, first))  # the old version is still whole
    assert table.read(ACCOUNTS).where("account_name = 'new'").count() == 1
    # nothing newer: nothing is written
    done = merge(table, accounts(spark, first), family)
    assert done.touched == 0 and table.current() == 1


def test_equal_to_the_full_refresh(spark):
    """Every table over states of two runs is the one computed from all rows."""
    base, raw, first = scratch_path(spark, "s"), {}, {}
    for name in FAMILIES:
        rows = getattr(bronze, name)(spark, SF_DIR)
        late = F.pmod(F.xxhash64(FAMILIES[name].key), F.lit(7)) == 0
        first[name] = rows.where(~late)
        raw[name] = first[name].unionByName(rows.where(late).withColumn(
            "_extracted_at", F.col("_extracted_at") + F.expr("INTERVAL 3 DAYS")))
    incremental.refresh_states(first, base, buckets=4)
    done = incremental.refresh_states(raw, base)
    assert all(0 < m.fresh_rows for m in done.values())
    got = incremental.tables(spark, base, AS_OF)
    full = silver.accounts(raw["accounts"])
    emails = silver.emails(raw["emails"], full, AS_OF)
    meetings = silver.calendar(raw["meetings"], full, AS_OF)
    chat = silver.chat(raw["chat"], full, AS_OF)
    want = {"accounts": full, "emails": emails, "calendar": meetings, "chat": chat,
            "tasks": silver.tasks(raw["tasks"], AS_OF),
            "documents": silver.documents(raw["documents"]),
            "use_cases": silver.use_cases(raw["use_cases"], AS_OF),
            "activity": gold.activity(emails, meetings, chat, AS_OF)}
    for name, df in want.items():
        assert rows_of(got[name].select(*df.columns)) == rows_of(df), name
    assert got["health"].count() == full.count()


def test_states_need_no_further_choice(spark):
    base = scratch_path(spark, "s")
    raw = {name: getattr(bronze, name)(spark, SF_DIR) for name in FAMILIES}
    incremental.refresh_states(raw, base, buckets=2)
    plan = incremental.tables(spark, base, AS_OF)["health"]._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_versions(spark):
    table = Versioned(spark, scratch_path(spark, "v"))
    assert table.current() is None and table.pieces() is None and table.vacuum() == 0
    assert table.read(ACCOUNTS).count() == 0
    folders = []
    for k in range(3):
        folders.append(table.new_folder())
        spark.range(k + 1).write.parquet(f"{table.base}/{folders[-1]}")
        version = table.commit(spark.createDataFrame([(folders[-1],)], "piece string"),
                               k - 1 if k else None)
        assert version == k == table.current()
    with pytest.raises(Conflict):
        table.commit(table.pieces(), 1)
    unlisted = table.new_folder()  # of a writer that has not committed
    spark.range(9).write.parquet(f"{table.base}/{unlisted}")
    assert table.vacuum(keep=2) == 1
    assert [os.path.isdir(f"{table.base}/{f}") for f in [*folders, unlisted]] == [
        False, True, True, True]
    assert table.read(spark.range(1).schema).count() == 3
    assert table.read(spark.range(1).schema, table.pieces(1)).count() == 2
