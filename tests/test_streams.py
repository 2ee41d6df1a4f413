"""Quarantine, exact streaming dedupe, and histories behind a commit log."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulseboard.operators.dedupe import latest_per_key
from pulseboard.plans.incremental import FAMILIES
from pulseboard.schemas import EMAILS, struct, TEXT, INT
from pulseboard.session import scratch_path
from pulseboard.sources import landing, sinks
from pulseboard.sources.versions import Versioned
from pulseboard.streaming import history, ledger

START = datetime(2024, 1, 1)
SMALL = struct(id=TEXT, n=INT, inner=struct(x=INT))
GOOD = [json.dumps(d) for d in (
    {"id": "a", "n": 1, "inner": {"x": 2}}, {}, {"id": None}, {"id": "b", "other": [1]})]
BROKEN = ['{"id": "c", "n"', "7", '"text"', "", "   ", '{"id": "d", "n": "many"}',
          '{"id": "e", "inner": 5}', "not json"]


def lines(spark):
    return spark.createDataFrame([(t,) for t in [*GOOD, *BROKEN, None]], "doc string")


def test_unreadable_documents_keep_their_text(spark):
    rows = landing.parsed(lines(spark), "doc", SMALL).collect()
    bad = [r["_bad_record"] for r in rows if r["_bad_record"] is not None]
    assert sorted(bad) == sorted(BROKEN)
    good = [r for r in rows if r["_bad_record"] is None]
    assert sorted(str(r["id"]) for r in good) == ["None", "None", "a", "b"]


def test_quarantine_in_batch_and_stream(spark):
    base = scratch_path(spark, "q")
    sinks.write_landed(landing.parsed(lines(spark), "doc", SMALL), "batch", f"{base}/b",
                       f"{base}/log", START)
    lines(spark).coalesce(1).write.parquet(f"{base}/landing")
    for _ in range(2):  # the second run finds nothing new
        history.land_batches(history.read_landing(spark, f"{base}/landing", lines(spark).schema),
                             "doc", SMALL, "stream", f"{base}/s", f"{base}/c", f"{base}/log",
                             START)
    for path in (f"{base}/b", f"{base}/s/batch=0"):
        assert sinks.read_landed(spark, SMALL, path).count() == len(GOOD)
        kept = sinks.read_quarantine(spark, path).collect()
        assert sorted(r["record"] for r in kept) == sorted(BROKEN)
        assert {r["landed_at"] for r in kept} == {START}
    log = {r["source"]: r for r in sinks.read_run_log(spark, f"{base}/log").collect()}
    assert {(s, r["rows_ingested"], r["rows_rejected"]) for s, r in log.items()} == {
        (s, len(GOOD), len(BROKEN)) for s in ("batch", "stream")}


def test_nothing_unreadable(spark):
    base = scratch_path(spark, "q")
    for name, docs in (("some", GOOD), ("none", [])):
        frame = spark.createDataFrame([(t,) for t in docs], "doc string")
        sinks.write_landed(landing.parsed(frame, "doc", SMALL), name, f"{base}/{name}",
                           f"{base}/log", START)
        assert sinks.read_landed(spark, SMALL, f"{base}/{name}").count() == len(docs)
        assert sinks.read_quarantine(spark, f"{base}/{name}").count() == 0


def mails(spark, rows):
    """(id, unread, day) as bronze mails."""
    blank = {f.name: None for f in EMAILS}
    return spark.createDataFrame([tuple({
        **blank, "message_id": i, "is_unread": u,
        "_extracted_at": START + timedelta(days=d)}.values()) for i, u, d in rows], EMAILS)


def test_stream_keeps_the_newest_and_counts_late_rows(spark):
    base = scratch_path(spark, "exact")
    table = Versioned(spark, f"{base}/state")
    runs = [[("a", True, 5), ("a", True, 5), ("b", True, 1), (None, True, 2)],
            [("a", False, 3), ("b", False, 4), ("c", True, 1), ("a", True, 5)],
            [("c", False, 0), ("c", False, 0), ("a", True, 4), (None, False, 1)]]
    late, every = [0, 0, 3], []
    for number, rows in enumerate(runs):
        every += rows
        mails(spark, rows).coalesce(1).write.parquet(f"{base}/landing/run={number}")
        history.keep_newest(history.read_landing(spark, f"{base}/landing", EMAILS), table,
                            FAMILIES["emails"], "mail", f"{base}/checkpoint", f"{base}/log",
                            buckets=4)
        want = latest_per_key(mails(spark, every), "message_id",
                              tie_by=("received_date", "is_unread"))
        got = table.read(EMAILS)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    log = sinks.read_run_log(spark, f"{base}/log").orderBy("run_at").collect()
    assert [r["rows_late"] for r in log] == late
    aside = spark.read.schema(EMAILS).parquet(f"{base}/state/late/batch=2")
    assert sorted(str(r["message_id"]) for r in aside.collect()) == ["None", "a", "c"]


def test_watermark_drops_are_counted(spark):
    base = scratch_path(spark, "wm")
    for number, days in enumerate(([100, 101], [102], [1, 2, 103])):
        spark.createDataFrame([(f"{number}{d}", START + timedelta(days=d)) for d in days],
                              "k string, t timestamp_ntz").coalesce(1).write.parquet(
            f"{base}/landing/run={number}")
        stream = history.read_landing(spark, f"{base}/landing", struct(k=TEXT).add(
            "t", "timestamp_ntz"))
        history.append_stream(history.distinct_stream(stream, ["k"], "t"), f"{base}/out",
                              f"{base}/c", "watermark", f"{base}/log")
    assert spark.read.parquet(f"{base}/out").count() == 4
    log = sinks.read_run_log(spark, f"{base}/log").orderBy("run_at").collect()
    assert [r["rows_late"] for r in log] == [0, 0, 2]


@pytest.fixture()
def landed(spark):
    base = scratch_path(spark, "h")

    def land(number, low, high):
        spark.range(low, high).coalesce(1).write.parquet(f"{base}/landing/run={number}")

    def stream():
        return history.read_landing(spark, f"{base}/landing", spark.range(1).schema)

    return Versioned(spark, f"{base}/history"), land, stream


def test_refresh_resume_and_compaction(spark, landed):
    table, land, stream = landed
    schema = spark.range(1).schema

    def numbers(df):
        return sorted(r["id"] for r in df.collect())

    for k in range(3):
        land(k, 10 * k, 10 * k + 10)
        assert ledger.run_incremental(stream(), lambda b: b, table) == 1
        assert ledger.run_incremental(stream(), lambda b: b, table) == 0
    assert numbers(ledger.read(spark, table.base, schema)) == list(range(30))
    reader = table.read(schema)
    assert ledger.compact(table, schema, small=100, target=1000) == 3
    assert table.pieces().count() == 1
    assert ledger.compact(table, schema, small=100, target=1000) == 0
    assert numbers(reader) == numbers(table.read(schema)) == list(range(30))
    land(3, 30, 35)
    ledger.run_incremental(stream(), lambda b: b, table)
    assert numbers(table.read(schema)) == list(range(35))
    # a full run that computes something else; the old rows stay until it is done
    shifted = lambda b: b.select((F.col("id") + 100).alias("id"))
    old = table.read(schema)
    ledger.run_full(stream(), shifted, table)
    assert numbers(old) == list(range(35))
    assert numbers(table.read(schema)) == list(range(100, 135))
    land(4, 35, 40)
    assert ledger.run_incremental(stream(), shifted, table) == 1
    assert numbers(table.read(schema)) == list(range(100, 140))
    assert table.vacuum() > 0
    assert numbers(table.read(schema)) == list(range(100, 140))


def test_a_refresh_that_dies_changes_nothing(spark, landed):
    table, land, stream = landed
    land(0, 0, 5)
    ledger.run_incremental(stream(), lambda b: b, table)

    def fail(batch):
        raise ValueError("no")

    with pytest.raises(Exception, match="no"):
        ledger.run_full(stream(), fail, table)
    assert table.read(spark.range(1).schema).count() == 5 and table.current() == 0


def test_a_batch_committed_twice_counts_once(spark, landed):
    """The commit was made, but the stream did not note it: the batch comes again."""
    table, land, stream = landed
    land(0, 0, 5)
    ledger.run_incremental(stream(), lambda b: b, table)
    checkpoint = table.pieces().first()["checkpoint"]
    sc = spark.sparkContext
    noted = sc._jvm.org.apache.hadoop.fs.Path(f"{table.base}/{checkpoint}/commits/0")
    noted.getFileSystem(sc._jsc.hadoopConfiguration()).delete(noted, False)
    assert ledger.run_incremental(stream(), lambda b: b, table) == 0
    assert table.read(spark.range(1).schema).count() == 5
