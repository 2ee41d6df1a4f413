"""Landing, sinks, the run log and the streaming histories."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pulseboard import records
from pulseboard.catalog import Inputs
from pulseboard.functions import text as txt
from pulseboard.hosts import bronze, payloads
from pulseboard.hosts.payloads import KEYWORDS, LABELS, OWN_ADDRESS
from pulseboard.operators.dedupe import latest_per_key
from pulseboard.plans import refresh
from pulseboard.schemas import (ACCOUNTS, CALENDAR_EVENT, CHAT_CHANNEL, CHAT_MESSAGE, CRM_ACCOUNT,
                                CRM_USE_CASE, DRIVE_FILE, EMAILS, MAIL_MESSAGE, TASK_PAGE)
from pulseboard.session import scratch_path
from pulseboard.sources import calendar, chat, crm, documents, landing, mail, sinks, tasks
from pulseboard.streaming import history
from tests.conftest import AS_OF, SF_DIR


@pytest.fixture()
def path(spark):
    return scratch_path(spark, "test")


def landed(spark, path, schema, records):
    lines = [json.dumps(r) if not isinstance(r, str) else r for r in records]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return landing.read_landed_json(spark, path, schema)


def test_bad_lines_are_kept_aside(spark, path):
    df = landed(spark, path, CALENDAR_EVENT, [{"id": "1"}, "{broken", {"id": "2"}]).cache()
    assert df.count() == 3
    assert [r[landing.BAD_RECORD] for r in df.where("id IS NULL").collect()] == ["{broken"]


def test_crm_defaults_and_semi_join(spark, path):
    accounts = landed(spark, path + "a", CRM_ACCOUNT, [
        {"Id": "1", "Revenue": 0, "NumberOfEmployees": 0, "Engaged": {"Email": "p@x", "Name": "P"}},
        {"Id": "2", "Revenue": 5.0, "Engaged": {"Email": "p@x"}, "Owner": {"Name": "O"}},
        {"Id": "3", "Engaged": {"Email": "q@x"}}, {"Id": "4"}])
    got = crm.flatten_accounts(accounts, "p@x", AS_OF).collect()
    assert [(r["account_id"], r["arr"], r["number_of_employees"], r["owner_name"]) for r in got] == [
        ("2", 5.0, None, "O"), ("1", None, None, None)]
    cases = landed(spark, path + "u", CRM_USE_CASE, [
        {"Id": "u1", "AccountId": "1", "LastModifiedDate": "2024-01-01T00:00:00.000+0000"},
        {"Id": "u2", "AccountId": "2", "LastModifiedDate": "2024-01-02T01:00:00+01:00"},
        {"Id": "u3", "AccountId": "3"}, {"Id": "u4"}])
    got = crm.flatten_use_cases(cases, accounts, "p@x", AS_OF).collect()
    assert [(r["uco_id"], str(r["last_modified_date"])) for r in got] == [
        ("u2", "2024-01-02 00:00:00"), ("u1", "2024-01-01 00:00:00")]


def message(number, labels, day, **more):
    return {"id": f"m{number}", "threadId": "t", "labelIds": labels, "headers": [
        {"name": "Date", "value": f"{day} Jan 2024 10:00:00 +0000"},
        {"name": "From", "value": "A <a@example.com>"}], "payload": {}, **more}


def test_label_cap_comes_before_first_label(spark, path):
    raw = landed(spark, path, MAIL_MESSAGE, [
        message(1, ["Label_0", "Label_1"], 28), message(2, ["Label_0"], 30),
        message(3, ["Label_1"], 29), message(4, ["other"], 30), message(5, ["Label_0"], 1),
        message(6, ["Label_0"], 29)])
    got = mail.newest_per_label(raw, LABELS, OWN_ADDRESS, AS_OF, 2, back_days=10)
    # m1 is third in the first label but second in the other one
    assert {r["message_id"]: r["account_name"] for r in got.collect()} == {
        "m2": "Account A", "m6": "Account A", "m3": "Account B", "m1": "Account B"}
    full = mail.emails_snapshot(raw, LABELS, OWN_ADDRESS, AS_OF)
    assert full.schema.names == EMAILS.names
    assert {r["message_id"]: r["account_name"] for r in full.collect()} == {
        "m1": "Account A", "m2": "Account A", "m3": "Account B", "m6": "Account A"}


def test_copies_take_one_place_under_the_cap(spark, path):
    raw = landed(spark, path, MAIL_MESSAGE, [
        message(1, ["Label_0"], 30), message(1, ["Label_0"], 30), message(2, ["Label_0"], 29),
        message(3, ["Label_0"], 28)])
    got = mail.newest_per_label(raw, LABELS, OWN_ADDRESS, AS_OF, 2)
    assert sorted(r["message_id"] for r in got.collect()) == ["m1", "m2"]


def test_mail_defaults(spark, path):
    raw = landed(spark, path, MAIL_MESSAGE, [message(1, ["Label_0", "UNREAD"], 30)])
    row = mail.emails_snapshot(raw, LABELS, OWN_ADDRESS, AS_OF).first()
    assert (row["subject"], row["body_text"], row["body_snippet"], row["to_emails"]) == (
        "(no subject)", "", "", [])
    assert row["is_unread"] and row["needs_response"] and not row["has_attachment"]


def test_no_mail_is_left_behind(spark, path):
    raw = landed(spark, path, MAIL_MESSAGE, [message(i, ["Label_0"], 30) for i in range(200)])
    assert mail.emails_snapshot(raw, LABELS, OWN_ADDRESS, AS_OF).count() == 200
    assert mail.emails_incremental(raw, LABELS, OWN_ADDRESS, AS_OF).count() == 200


def test_whole_bodies_are_stored(spark, path):
    import base64
    long_text = "word " * 3000
    data = base64.urlsafe_b64encode(long_text.encode()).decode()
    raw = landed(spark, path, MAIL_MESSAGE, [message(1, ["Label_0"], 30, payload={
        "mimeType": "text/plain", "body": {"data": data}})])
    selected = mail.select_labelled(raw, LABELS, AS_OF, 30, None)
    whole = mail.to_emails(selected, OWN_ADDRESS, AS_OF).first()["body_text"]
    stored = mail.to_emails(selected, OWN_ADDRESS, AS_OF, body_width=50).first()["body_text"]
    assert whole == long_text.strip() and stored == whole[:50]


def test_calendar_matching_and_window(spark, path):
    def event(key, day, **more):
        return {"id": key, "start": {"date": day}, "status": "confirmed", **more}
    raw = landed(spark, path, CALENDAR_EVENT, [
        event("text", "2024-02-01", summary="GEAR sync"),
        event("guest", "2024-02-01", attendees=[{"email": "a@x"}, {"email": "b@rod.com"}]),
        event("none", "2024-02-01", summary="lunch"), event("past", "2023-12-01", summary="ring"),
        event("late", "2024-05-01", summary="ring"), {"id": "undated", "summary": "ring"},
        event("far", "2024-02-02", description="x" * 3000 + " widget")])
    got = {r["event_id"]: r for r in calendar.calendar_snapshot(raw, KEYWORDS, AS_OF).collect()}
    assert {k: r["account_name"] for k, r in got.items()} == {
        "text": "Account A", "guest": "Account C", "far": "Account B", "undated": "Account A"}
    assert len(got["far"]["description"]) == 3007 and got["undated"]["start_time"] is None
    assert got["text"]["attendees"] == [] and got["text"]["description"] is None


def test_chat_first_channel_wins(spark, path):
    channels = landed(spark, path + "c", CHAT_CHANNEL, [
        {"ord": 1, "id": "B", "name": "gear"}, {"ord": 0, "id": "A", "purpose": {"value": "Widget"}},
        {"ord": 2, "id": "X", "name": "misc"}])
    messages = landed(spark, path + "m", CHAT_MESSAGE, [
        {"channel": "B", "ts": "1706600000.000001", "text": "b"},
        {"channel": "A", "ts": "1706600000.000001", "text": "a", "bot_id": "bot"},
        {"channel": "X", "ts": "1706600001.000001"}, {"channel": "B", "ts": "1600000000.0"},
        {"channel": "B", "ts": ""}, {"channel": "B"}])
    got = chat.chat_snapshot(channels, messages, KEYWORDS, AS_OF).collect()
    assert [(r["channel_id"], r["account_name"], r["user_id"], r["message_text"]) for r in got] == [
        ("A", "Account B", "bot", "a")]


def test_tasks_keep_unmatched(spark, path):
    pages = landed(spark, path, TASK_PAGE, [{"id": "l", "title": "L", "items": [
        {"id": "1", "title": "ring", "due": "2024-02-01T00:00:00.000Z", "parent": ""},
        {"id": "2", "status": "completed"}, {"id": "3", "parent": "1", "status": "needsAction"}]}])
    got = [(r["task_id"], r["account_name"], r["due_date"], r["status"], r["parent_task_id"])
           for r in tasks.tasks_snapshot(pages, KEYWORDS, AS_OF).collect()]
    assert got == [("1", "Account A", "2024-02-01", "needsAction", None),
                   ("3", None, "", "needsAction", "1")]


def test_folder_documents(spark, path):
    def entry(key, parent, kind=documents.DOCUMENT, **more):
        return {"id": key, "parent": parent, "mimeType": kind, "name": key, **more}
    files = landed(spark, path, DRIVE_FILE, [
        entry("R", None, documents.FOLDER), entry("Gear Ltd", "R", documents.FOLDER),
        entry("Other", "R", documents.FOLDER), entry("sub", "Other", documents.FOLDER),
        entry("d1", "Gear Ltd", text="a\n\n\n\nb"), entry("d2", "sub", text="deep"),
        entry("d3", "sub", text=" \n "), entry("d4", "R", text="at the root"),
        entry("d5", "sub", "image/png", text="x")])
    got = {r["file_id"]: (r["account_name"], r["content"]) for r in
           documents.folder_documents(files, "R", KEYWORDS, AS_OF).collect()}
    assert got == {"d1": ("Account A", "a\n\nb"), "d2": ("Other", "deep")}


# ---- sinks --------------------------------------------------------------------
def test_run_log_records_success_and_failure(spark, path):
    df = spark.range(5)
    sinks.logged_write(df, "good", lambda d, o: sinks.write_snapshot(d, path + "/t", o), path + "/log")
    bad = df.select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception):
        sinks.logged_write(bad, "bad", lambda d, o: sinks.write_snapshot(d, path + "/u", o), path + "/log")
    log = {r["source"]: r for r in sinks.read_run_log(spark, path + "/log").collect()}
    assert log["good"]["status"] == "SUCCESS" and log["good"]["rows_ingested"] == 5
    assert log["bad"]["status"] == "FAILED" and "boom" in log["bad"]["error_detail"]


def test_run_log_counts_a_clustered_write_once(spark, path):
    sinks.logged_write(spark.range(1000), "ranged", lambda d, o: sinks.write_clustered(
        d, path + "/t", "id", observe=o), path + "/log")
    assert sinks.read_run_log(spark, path + "/log").first()["rows_ingested"] == 1000


def test_run_log_notes_unreadable_lines(spark, path):
    df = landed(spark, path + "/in", CALENDAR_EVENT, [{"id": "1"}, "{broken", {"id": "2"}])
    sinks.logged_write(df, "meetings", lambda d, o: sinks.write_snapshot(d, path + "/t", o), path + "/log")
    line = sinks.read_run_log(spark, path + "/log").first()
    assert (line["status"], line["rows_ingested"], line["error_detail"]) == (
        "SUCCESS", 2, "1 unreadable records")
    written = spark.read.parquet(path + "/t")
    assert written.columns == CALENDAR_EVENT.names and written.count() == 2


def test_clustered_files_cover_disjoint_ranges(spark, path):
    df = spark.range(4000).select((F.col("id") % 2).alias("account"), "id")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")                  # tiny partitions would be merged
    try:
        sinks.write_clustered(df, path, "account", "id")
    finally:
        spark.conf.unset(merge)
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("account", "id")).alias("lo"), F.max(F.struct("account", "id")).alias("hi"))
    spans = sorted((tuple(r["lo"]), tuple(r["hi"])) for r in spans.collect())
    assert len(spans) > 2 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_staging_is_replaced(spark, path):
    accounts = bronze.accounts(spark, SF_DIR)
    for _ in range(2):
        sinks.replace_staging(accounts, path, ACCOUNTS)
    assert landing.read_staging(spark, path, ACCOUNTS).count() == accounts.count()


# ---- dictionary tables ---------------------------------------------------------
def keyword_table(spark, dictionary):
    """The dictionary as a table, with 300 words more that no text holds."""
    rows = [(i, account, word) for i, (account, words) in enumerate(dictionary) for word in words]
    rows += [(100 + i, f"Filler {i}", f"zq{i}xj") for i in range(300)]
    return spark.createDataFrame(rows, "ord int, account string, keyword string")


SOURCES_BY_DICTIONARY = {
    "calendar": (KEYWORDS, lambda s, d: calendar.calendar_snapshot(
        records.calendar_events(s, SF_DIR), d, AS_OF)),
    "chat": (KEYWORDS, lambda s, d: chat.chat_snapshot(
        payloads.chat_channels(s, SF_DIR), payloads.chat_messages(s, SF_DIR), d, AS_OF)),
    "tasks": (KEYWORDS, lambda s, d: tasks.tasks_snapshot(
        payloads.task_pages(s, SF_DIR), d, AS_OF)),
    "documents": (payloads.ALIASES, lambda s, d: documents.folder_documents(
        payloads.drive_files(s, SF_DIR), payloads.ROOT, d, AS_OF)),
}


@pytest.mark.parametrize("source", SOURCES_BY_DICTIONARY)
def test_dictionary_table_equals_inline(spark, source):
    dictionary, run = SOURCES_BY_DICTIONARY[source]
    inline, table = run(spark, dictionary), run(spark, keyword_table(spark, dictionary))
    assert table.columns == inline.columns
    left, right = (sorted(map(str, df.collect())) for df in (inline, table))
    assert left and left == right
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_label_table_equals_inline(spark):
    raw = payloads.mail_messages(spark, SF_DIR)
    rows = [(i, label, account) for i, (label, account) in enumerate(LABELS.items())]
    rows += [(100 + i, f"Other_{i}", f"Filler {i}") for i in range(300)]
    table = spark.createDataFrame(rows, "ord int, label string, account string")
    left, right = (sorted(map(str, mail.emails_snapshot(raw, known, OWN_ADDRESS, AS_OF).collect()))
                   for known in (LABELS, table))
    assert left and left == right


# ---- refresh --------------------------------------------------------------------
def test_refresh_writes_each_layer_once(spark, path):
    raw = {name: getattr(bronze, name)(spark, SF_DIR) for name in refresh.SOURCES}
    tables = refresh.refresh(raw, path, AS_OF)
    assert set(tables) == set(refresh.TABLES)
    direct = Inputs(spark, SF_DIR)
    for name in ("emails", "tasks", "activity", "health"):
        left, right = tables[name], getattr(direct, name)
        assert left.columns == right.columns
        assert left.exceptAll(right).count() == 0 == right.exceptAll(left).count()


# ---- streams --------------------------------------------------------------------
def test_history_resumes_and_tolerates_redelivery(spark, path):
    emails = bronze.emails(spark, SF_DIR)
    landing_path, kept, checkpoint = path + "/in", path + "/out", path + "/cp"

    def run():
        history.append_stream(history.read_landing(spark, landing_path, EMAILS), kept, checkpoint)
        return history.read_history(spark, kept, EMAILS)

    emails.write.parquet(landing_path)
    first = run()
    n, silver_rows = first.count(), latest_per_key(first, "message_id").count()
    assert n == emails.count()
    assert run().count() == n                       # nothing new, nothing added
    emails.write.mode("append").parquet(landing_path)
    again = run()
    assert again.count() == 2 * n
    before, after = latest_per_key(first, "message_id"), history.latest_history(again, "message_id")
    assert after.count() == silver_rows and after.exceptAll(before).count() == 0


def test_full_refresh_reads_everything_again(spark, path):
    emails = bronze.emails(spark, SF_DIR)
    early = F.col("received_date") < F.lit("2024-01-15").cast("timestamp_ntz")

    def run(number):
        rows, checkpoint = history.generation(path, number)
        history.append_stream(history.read_landing(spark, path + "/in", EMAILS), rows, checkpoint)
        return history.read_history(spark, rows, EMAILS)

    for part in (emails.where(early), emails.where(~early)):
        part.write.mode("append").parquet(path + "/in")
        kept = run(0)
    fresh = run(1)
    assert kept.count() == fresh.count() == emails.count()
    assert kept.exceptAll(fresh).count() == 0


def test_repeated_batch_does_not_add_rows(spark, path):
    payloads.chat_messages(spark, SF_DIR).write.parquet(path + "/in")

    def run(checkpoint):
        history.append_batches(history.read_landing(spark, path + "/in", CHAT_MESSAGE),
                               lambda batch: batch, path + "/out", checkpoint)
        return history.read_history(spark, path + "/out", CHAT_MESSAGE).count()
    once = run(path + "/cp1")
    assert once == payloads.chat_messages(spark, SF_DIR).count()
    # a lost checkpoint replays the same batch, whichever run it is
    assert run(path + "/cp2") == once


def test_bounded_state_forgets_late_records(spark, path):
    def deliver(day, keys):
        spark.createDataFrame([(k, AS_OF + timedelta(days=day)) for k in keys],
                              "k string, t timestamp_ntz").write.mode("append").parquet(path + "/in")
        stream = history.read_landing(spark, path + "/in", spark.read.parquet(path + "/in").schema)
        history.append_stream(history.distinct_stream(stream, ["k"], "t"), path + "/out", path + "/cp")
        return sorted(r["k"] for r in spark.read.parquet(path + "/out").collect())
    assert deliver(0, ["a", "b", "a"]) == ["a", "b"]
    assert deliver(1, ["a", "c"]) == ["a", "b", "c"]
    assert deliver(9, ["d"]) == ["a", "b", "c", "d"]
    assert deliver(-5, ["late"]) == ["a", "b", "c", "d"]
