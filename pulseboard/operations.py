"""Queries that write and read back: sinks, run log, checks and streams.

Tables go to fresh folders below the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.catalog import Inputs, Query, joined_arrays
from pulseboard.functions.clock import now
from pulseboard.hosts import AS_OF, bronze, payloads
from pulseboard.hosts.payloads import KEYWORDS, LABELS, OWN_ADDRESS, ROOT
from pulseboard.operators import intervals, quality
from pulseboard.plans import incremental, legacy, silver
from pulseboard.plans.refresh import SOURCES, refresh
from pulseboard.schemas import (ACCOUNTS, CALENDAR_EVENT, CHAT, CHAT_MESSAGE, EMAILS, LEGACY,
                                MAIL_MESSAGE)
from pulseboard.session import scratch_path
from pulseboard.sources import calendar, chat, landing, layout, sinks
from pulseboard.sources import mail as mail_source
from pulseboard.sources.documents import FOLDER
from pulseboard.sources.versions import Versioned
from pulseboard.streaming import history, ledger


# ---- batch sinks ---------------------------------------------------------------
def src_staging_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace the staging table in one write, then pass it through."""
    path = scratch_path(spark, "staging")
    sinks.replace_staging(bronze.accounts(spark, sf_dir), path, ACCOUNTS)
    return landing.read_staging(spark, path, ACCOUNTS)


def snk_snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots to one place: the second replaces the first."""
    path = scratch_path(spark, "snapshot")
    accounts = Inputs(spark, sf_dir).accounts
    sinks.write_snapshot(accounts.where(F.col("arr") > 0), path)
    sinks.write_snapshot(accounts, path)
    return spark.read.schema(accounts.schema).parquet(path)


def snk_curve_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails laid out along the curve over account and time; a week is read, by time alone,
    from the files that can hold it, and summarised per account."""
    path = scratch_path(spark, "curve")
    emails = Inputs(spark, sf_dir).emails
    layout.write_curve(emails, path, "account_name", "received_date", files=64)
    week = {"received_date": (AS_OF - timedelta(days=7), AS_OF)}
    return layout.read_within(spark, path, emails.schema, week).groupBy("account_name").agg(
        F.count("*").alias("mails"), F.max("received_date").alias("last_received"))


def snk_clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails laid out by account and time, then summarised per account."""
    path = scratch_path(spark, "clustered")
    emails = Inputs(spark, sf_dir).emails
    sinks.write_clustered(emails, path, "account_name", "received_date")
    stored = spark.read.schema(emails.schema).parquet(path)
    return stored.groupBy("account_name").agg(
        F.count("*").alias("mails"), F.min("received_date").alias("first_received"),
        F.max("received_date").alias("last_received"))


def ops_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily refresh: every table written once; the stored scorecard."""
    raw = {name: getattr(bronze, name)(spark, sf_dir) for name in SOURCES}
    return refresh(raw, scratch_path(spark, "refresh"), AS_OF)["health"]


def _redelivered(name: str, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records that come with the second run (one key in 97), and the others."""
    key, _ = silver.VERSIONS[name]
    number = F.abs(F.xxhash64(key)) if name in ("tasks", "chat", "documents") else F.col(key).cast(
        "long")
    late = F.coalesce(number % 97 == 0, F.lit(False))
    return raw.where(late), raw.where(~late)


def ops_refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs: all records but one key in 97, then these too, extracted two days
    later. The scorecard over the states, without the time of extraction."""
    base = scratch_path(spark, "states")
    first, both = {}, {}
    for name in SOURCES:
        late, early = _redelivered(name, getattr(bronze, name)(spark, sf_dir))
        first[name] = early
        both[name] = early.unionByName(late.withColumn(
            "_extracted_at", F.col("_extracted_at") + F.expr("INTERVAL 2 DAYS")))
    incremental.refresh_states(first, base, buckets=16)
    incremental.refresh_states(both, base)
    return incremental.tables(spark, base, AS_OF)["health"].drop("last_synced_at")


def bronze_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every bronze table once and return the log of those writes."""
    out = scratch_path(spark, "bronze")
    for source in SOURCES:
        sinks.logged_write(getattr(bronze, source)(spark, sf_dir), source,
                           lambda df, observe, s=source: sinks.write_snapshot(
                               df, f"{out}/{s}", observe),
                           f"{out}/run_log")
    return sinks.read_run_log(spark, f"{out}/run_log")


def _landed_events(spark: SparkSession, sf_dir: str) -> tuple[list[str], str]:
    """Calendar documents, some broken, landed as a batch and as a stream of two files."""
    base = scratch_path(spark, "landed")
    lines = payloads.calendar_lines(spark, sf_dir)
    sinks.write_landed(landing.parsed(lines, "doc", CALENDAR_EVENT), "calendar_batch",
                       f"{base}/batch", f"{base}/run_log", AS_OF)
    lines.repartition(2).write.parquet(f"{base}/landing")
    history.land_batches(history.read_landing(spark, f"{base}/landing", lines.schema), "doc",
                         CALENDAR_EVENT, "calendar_stream", f"{base}/stream",
                         f"{base}/checkpoint", f"{base}/run_log", AS_OF)
    return [f"{base}/batch", f"{base}/stream/batch=0"], f"{base}/run_log"


def ops_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that could not be read, of both routes, by the id that their text names."""
    paths, _ = _landed_events(spark, sf_dir)
    return sinks.read_quarantine(spark, *paths).select(
        "source", F.regexp_extract("record", '"id":"([0-9]+)"', 1).alias("named_id"),
        "landed_at")


def src_calendar_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar snapshot over landed documents of which some are broken: only these are lost."""
    paths, _ = _landed_events(spark, sf_dir)
    return joined_arrays(calendar.calendar_snapshot(
        sinks.read_landed(spark, CALENDAR_EVENT, paths[0]), KEYWORDS, AS_OF))


def ops_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per write: bronze tables, and documents landed by both routes."""
    _, log = _landed_events(spark, sf_dir)
    return bronze_run_log(spark, sf_dir).unionByName(sinks.read_run_log(spark, log)).select(
        "source", "status", "rows_ingested", "rows_rejected")


def src_folder_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder tree with stored labels, after one folder went under another account's folder
    and one to the root: where every folder is now."""
    files = payloads.drive_files(spark, sf_dir)
    table = intervals.build(files.where(F.col("mimeType") == FOLDER).select("id", "parent"),
                            ROOT, scratch_path(spark, "tree"), files=16)
    intervals.move(table, ROOT, "F12", "F3")
    intervals.move(table, ROOT, "F57", ROOT)
    return intervals.closure(table.read(intervals.TREE))


# ---- the older tables ------------------------------------------------------------
def legacy_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    builders = (bronze.legacy_accounts, bronze.legacy_use_cases, bronze.legacy_emails,
                bronze.legacy_meetings, bronze.legacy_chat)
    return {name: quality.require_schema(build(spark, sf_dir), schema)
            for (name, schema), build in zip(LEGACY.items(), builders)}


def view_legacy_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered as a temporary view and read back sorted."""
    tables = legacy_tables(spark, sf_dir)
    view = legacy.daily_activity(tables["gmail_customer_emails"], tables["calendar_events"],
                                 tables["slack_messages"])
    view.createOrReplaceTempView("daily_activity")
    return spark.table("daily_activity").orderBy(F.desc("activity_date"), "source_id")


def dq_not_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_key_counts({
        name: (df, quality.declared_keys(LEGACY[name]))
        for name, df in legacy_tables(spark, sf_dir).items()})


def dq_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and references of the older tables: facts name an account, use cases have one."""
    tables = legacy_tables(spark, sf_dir)
    accounts = tables["sf_accounts"]
    parts = []
    for name, df in tables.items():
        key, = quality.declared_keys(LEGACY[name])
        refers = {"sf_accounts": (), "sf_use_cases": (("account_id", accounts, "account_id"),)}
        parts.append(quality.constraint_failures(name, df, quality.Constraints(
            (key, "account_name"), key,
            refers.get(name, (("account_name", accounts, "account_name"),)))))
    return reduce(DataFrame.unionByName, parts)


def ops_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, log = _landed_events(spark, sf_dir)
    return quality.row_counts({**legacy_tables(spark, sf_dir),
                               "ingestion_run_log": sinks.read_run_log(spark, log)})


# ---- streams -----------------------------------------------------------------------
def _two_runs(spark: SparkSession, name: str, first: DataFrame, second: DataFrame,
              run: Callable[[str, str, str, int], None]) -> str:
    """Land and run twice, as on two days; the second run resumes the checkpoint."""
    base = scratch_path(spark, name)
    for number, delivered in enumerate((first, second)):
        delivered.write.mode("append").parquet(f"{base}/landing/run={number}")
        run(f"{base}/landing", f"{base}/history", f"{base}/checkpoint", number)
    return f"{base}/history"


def stream_email_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily mail runs; the second day re-delivers one day of the first."""
    yesterday = AS_OF - timedelta(days=1)

    def run(landed: str, path: str, checkpoint: str, number: int) -> None:
        run_time = (yesterday, AS_OF)[number]
        stream = history.read_landing(spark, landed, MAIL_MESSAGE)
        history.append_batches(
            stream, lambda batch: mail_source.emails_incremental(
                batch, LABELS, OWN_ADDRESS, run_time), path, checkpoint)

    path = _two_runs(
        spark, "mail", payloads.mail_messages(spark, sf_dir, until=now(yesterday)),
        payloads.mail_messages(spark, sf_dir, since=now(AS_OF - timedelta(days=2))), run)
    return joined_arrays(history.read_history(spark, path, EMAILS))


def stream_history_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two mail runs behind a commit log: a full run, an incremental one that goes on
    with it, and the merging of both runs' folders."""
    base, yesterday = scratch_path(spark, "ledger"), AS_OF - timedelta(days=1)
    table = Versioned(spark, f"{base}/history")
    runs = ((ledger.run_full, yesterday, None, yesterday),
            (ledger.run_incremental, AS_OF, AS_OF - timedelta(days=2), None))
    for number, (run, run_time, since, until) in enumerate(runs):
        payloads.mail_messages(spark, sf_dir, since and now(since), until and now(until)).write.mode(
            "append").parquet(f"{base}/landing/run={number}")
        run(history.read_landing(spark, f"{base}/landing", MAIL_MESSAGE),
            lambda batch, at=run_time: mail_source.emails_incremental(
                batch, LABELS, OWN_ADDRESS, at), table)
    ledger.compact(table, EMAILS, small=1 << 20, target=1 << 20)
    return joined_arrays(ledger.read(spark, table.base, EMAILS))


def stream_chat_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily chat runs; the second day re-delivers one day of the first."""
    yesterday = AS_OF - timedelta(days=1)
    channels = payloads.chat_channels(spark, sf_dir)

    def run(landed: str, path: str, checkpoint: str, number: int) -> None:
        run_time = (yesterday, AS_OF)[number]
        stream = history.read_landing(spark, landed, CHAT_MESSAGE)
        history.append_batches(
            stream, lambda batch: chat.chat_incremental(
                channels, batch, KEYWORDS, run_time), path, checkpoint)

    path = _two_runs(
        spark, "chat", payloads.chat_messages(spark, sf_dir, until=now(yesterday)),
        payloads.chat_messages(spark, sf_dir, since=now(AS_OF - timedelta(days=2))), run)
    return joined_arrays(history.read_history(spark, path, CHAT))


def stream_dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with re-extracted mails; the newest version of each is read."""
    emails = bronze.emails(spark, sf_dir)

    def run(landed: str, path: str, checkpoint: str, _number: int) -> None:
        history.append_stream(history.read_landing(spark, landed, EMAILS), path, checkpoint)

    again = F.col("_extracted_at") == now(AS_OF)
    path = _two_runs(spark, "latest", emails.where(~again), emails.where(again), run)
    return history.latest_history(history.read_history(spark, path, EMAILS), "message_id",
                                  ("received_date", "is_unread")).select(
        "message_id", "is_unread", "received_date", "_extracted_at")


def _newest_stream(spark: SparkSession, sf_dir: str) -> tuple[Versioned, str]:
    """Re-extracted mails come first, all others with the second run, partly late."""
    emails, base = bronze.emails(spark, sf_dir), scratch_path(spark, "newest")
    table = Versioned(spark, f"{base}/state")

    def run(landed: str, _path: str, checkpoint: str, _number: int) -> None:
        history.keep_newest(history.read_landing(spark, landed, EMAILS), table,
                            incremental.FAMILIES["emails"], "emails", checkpoint,
                            f"{base}/run_log", buckets=16)

    again = F.col("_extracted_at") == now(AS_OF)
    _two_runs(spark, "exact", emails.where(again), emails.where(~again), run)
    return table, f"{base}/run_log"


def stream_dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of each mail, kept by the stream itself in a keyed table."""
    table, _ = _newest_stream(spark, sf_dir)
    return table.read(EMAILS).select("message_id", "is_unread", "received_date", "_extracted_at")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log says of both runs: rows merged, and rows that came late."""
    _, log = _newest_stream(spark, sf_dir)
    return sinks.read_run_log(spark, log).select("source", "rows_ingested", "rows_late")


def stream_dedupe_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat messages in two overlapping deliveries, de-duplicated by state."""
    messages = bronze.chat(spark, sf_dir)
    split = AS_OF - timedelta(days=15)

    def run(landed: str, path: str, checkpoint: str, _number: int) -> None:
        stream = history.read_landing(spark, landed, CHAT).select(
            "message_ts", "channel_id", "message_text", "sent_at")
        history.append_stream(history.distinct_stream(stream, ["message_ts"], "sent_at"),
                              path, checkpoint)

    path = _two_runs(spark, "distinct", messages.where(F.col("sent_at") < now(split)),
                     messages.where(F.col("sent_at") >= now(split - timedelta(days=1))), run)
    return spark.read.parquet(path)


OPERATIONS: dict[str, Query] = {
    "src_staging_scan": src_staging_scan,
    "snk_snapshot_roundtrip": snk_snapshot_roundtrip,
    "snk_clustered_scan": snk_clustered_scan,
    "snk_curve_scan": snk_curve_scan,
    "ops_refresh": ops_refresh,
    "ops_refresh_incremental": ops_refresh_incremental,
    "ops_run_log": ops_run_log,
    "ops_quarantine": ops_quarantine,
    "src_folder_moved": src_folder_moved,
    "src_calendar_landed": src_calendar_landed,
    "view_legacy_activity": view_legacy_activity,
    "dq_not_null_keys": dq_not_null_keys,
    "dq_constraints": dq_constraints,
    "ops_row_counts": ops_row_counts,
    "stream_email_append": stream_email_append,
    "stream_history_log": stream_history_log,
    "stream_chat_append": stream_chat_append,
    "stream_dedupe_latest": stream_dedupe_latest,
    "stream_dedupe_exact": stream_dedupe_exact,
    "stream_late_rows": stream_late_rows,
    "stream_dedupe_watermark": stream_dedupe_watermark,
}
