"""Silver, gold and reports on small hand-made inputs, and plan shapes."""

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulseboard.catalog import Inputs
from pulseboard.plans import gold, reports, silver
from pulseboard.schemas import ACCOUNTS, CHAT, DOCUMENTS, EMAILS, MEETINGS, TASKS, USE_CASES
from tests.conftest import AS_OF, SF_DIR

STAMP = AS_OF - timedelta(days=1)


def frame(spark, schema, rows):
    """Rows given as dicts; everything else is NULL."""
    filled = [tuple({"_extracted_at": STAMP, **r}.get(n) for n in schema.names) for r in rows]
    return spark.createDataFrame(filled, schema)


@pytest.fixture(scope="module")
def small(spark):
    """Two accounts of one name, one without activity, facts of unknown accounts."""
    accounts = silver.accounts(frame(spark, ACCOUNTS, [
        {"account_id": "1", "account_name": "Twin", "arr": 2e6},
        {"account_id": "2", "account_name": "Twin", "arr": 2e6},
        {"account_id": "3", "account_name": "Quiet"},
        {"account_id": "4", "account_name": "Busy", "arr": 1.0},
        {"account_id": None, "account_name": "No id"}, {"account_id": "5"}]))
    use_cases = silver.use_cases(frame(spark, USE_CASES, [
        {"uco_id": f"u{i}", "account_id": str(1 + i % 2), "account_name": "Twin",
         "stage": f"U{1 + i % 6}", "last_modified_date": AS_OF - timedelta(days=10 * i),
         "go_live_date": AS_OF + timedelta(days=20 * i - 30)} for i in range(9)]), AS_OF)
    raw_emails = frame(spark, EMAILS, [
        {"message_id": f"m{i}", "account_name": name, "thread_id": "t", "from_name": "F",
         "from_email": f"{i}@example.com", "subject": "S", "needs_response": i % 3 != 0,
         "is_unread": i % 2 == 0, "received_date": AS_OF - timedelta(days=i)}
        for i, name in enumerate(["Twin", "Twin", "Busy", "Busy", "Busy", None, "Elsewhere"])])
    raw_meetings = frame(spark, MEETINGS, [
        {"event_id": f"e{i}", "account_name": name, "event_title": "T", "status": status,
         "start_time": AS_OF + timedelta(days=shift), "attendees": ["a||"],
         "end_time": AS_OF + timedelta(days=shift, minutes=45)}
        for i, (name, status, shift) in enumerate([
            ("Twin", "confirmed", 1), ("Twin", "confirmed", 1), ("Busy", "confirmed", 20),
            ("Busy", "cancelled", 2), ("Busy", None, 2), ("Busy", "confirmed", -3)])])
    raw_chat = frame(spark, CHAT, [
        {"message_ts": f"c{i}", "account_name": "Busy", "channel_name": "ch", "channel_id": "C",
         "message_text": "hi", "is_reply": False, "reply_count": i, "reactions": [],
         "sent_at": AS_OF - timedelta(days=3 * i)} for i in range(7)])
    return dict(
        accounts=accounts, use_cases=use_cases,
        emails=silver.emails(raw_emails, accounts, AS_OF),
        emails_core=silver.emails_core(raw_emails, AS_OF),
        calendar=silver.calendar(raw_meetings, accounts, AS_OF),
        calendar_core=silver.calendar_core(raw_meetings, AS_OF),
        chat=silver.chat(raw_chat, accounts, AS_OF), chat_core=silver.chat_core(raw_chat, AS_OF))


@pytest.fixture(scope="module")
def health(small):
    return gold.health(small["accounts"], small["use_cases"], small["emails_core"],
                       small["calendar_core"], small["chat_core"]).cache()


def rows(df):
    return sorted(map(str, df.collect()))


def test_counted_health_equals_the_fan_out_join(small, health):
    a, u, e = small["accounts"], small["use_cases"], small["emails"]
    m, c = small["calendar"], small["chat"]
    naive = (a.join(u, a.account_id == u.account_id, "left")
             .join(e, e.account_name == a.account_name, "left")
             .join(m, m.account_name == a.account_name, "left")
             .join(c, c.account_name == a.account_name, "left")
             .groupBy(a.account_id)
             .agg(F.count_distinct("uco_id").alias("total_ucos"),
                  F.count_distinct(F.when(u.is_stale, u.uco_id)).alias("stale_ucos"),
                  F.count_distinct(F.when(F.col("action_status") == "URGENT", e.message_id)).alias(
                      "urgent_emails"),
                  F.count_distinct(F.when(e.needs_response, e.message_id)).alias("pending_emails"),
                  F.count_distinct(F.when(m.timing_label == "THIS_WEEK", m.event_id)).alias(
                      "meetings_this_week"),
                  F.count_distinct(F.when(c.days_since_sent <= 14, c.message_ts)).alias(
                      "slack_messages_14d")))
    assert rows(naive) == rows(health.select(*naive.columns))


def test_twins_each_get_all_mail_and_quiet_scores_fifty(health):
    by_id = {r["account_id"]: r for r in health.collect()}
    assert set(by_id) == {"1", "2", "3", "4"}
    assert by_id["1"]["pending_emails"] == by_id["2"]["pending_emails"] == 1
    assert by_id["1"]["meetings_this_week"] == by_id["2"]["meetings_this_week"] == 2
    assert by_id["3"]["health_score"] == 50 and by_id["3"]["total_ucos"] == 0
    assert all(0 <= r["health_score"] <= 100 for r in by_id.values())


def test_shared_names_multiply_facts_in_silver(small):
    assert small["emails_core"].count() == 7
    assert small["emails"].count() == 9
    assert small["emails"].where("account_name = 'Elsewhere'").first()["arr_tier"] is None


def test_meeting_prep_adds_up_twin_accounts(small):
    got = reports.meeting_prep(small["calendar_core"], small["accounts"], small["use_cases"],
                               small["emails_core"]).collect()
    twin = [r for r in got if r["account_name"] == "Twin"]
    assert len(twin) == 1 and twin[0]["active_ucos"] == 9 and twin[0]["pending_emails"] == 1
    assert [r["account_name"] for r in got] == ["Twin", "Busy"]


def test_counting_first_equals_joining_first(small):
    accounts = small["accounts"].unionByName(small["accounts"].where("account_id = '4'")
                                             .withColumn("arr_tier", F.lit("other")))
    mails, meetings, chat = (silver.with_tier(small[f"{k}_core"], accounts)
                             for k in ("emails", "calendar", "chat"))
    pairs = [
        (reports.email_volume(mails, AS_OF),
         reports.email_volume(small["emails_core"], AS_OF, accounts=accounts)),
        (reports.thread_summary(mails), reports.thread_summary(small["emails_core"], accounts)),
        (reports.meeting_frequency(meetings, AS_OF),
         reports.meeting_frequency(small["calendar_core"], AS_OF, accounts=accounts)),
        (reports.chat_activity(chat),
         reports.chat_activity(small["chat_core"], accounts=accounts)),
        (reports.channels_summary(chat),
         reports.channels_summary(small["chat_core"], accounts))]
    for joined, counted in pairs:
        assert rows(joined) == rows(counted) and counted.columns == joined.columns
    twin = {r["account_name"]: r for r in pairs[0][1].collect()}["Twin"]
    assert twin["total_emails"] == 4


def test_thread_of_many_senders_is_sorted_in_blocks(spark):
    names = ([f"p{i:03d}@x.org" for i in range(40)] + ["", "a", "ab", "abc", "Zoe@y.org", "é@x.org", "p"])
    days = [f"2025-01-{1 + i % 28:02d} 10:00:00" for i in range(3 * len(names))]
    mails = [("A", "t", "S", n, d, i % 50 == 7)
             for i, (n, d) in enumerate(zip(names * 3, days))]
    mails += [("A", "t", "S", None, "2025-03-01 00:00:00", None),
              ("A", "u", "S", None, "2025-03-01 00:00:00", False),
              ("A", "u", None, "one@x.org", "2025-03-01 00:00:00", False),
              ("B", None, "S", None, None, None), ("B", None, "S", None, None, None)]
    frame = spark.createDataFrame(
        mails, "account_name string, thread_id string, subject string, from_email string, "
               "received_date string, needs_response boolean").withColumn(
        "received_date", F.col("received_date").cast("timestamp_ntz"))
    got = {r["account_name"]: r for r in reports.thread_summary(frame).collect()}
    assert set(got) == {"A", "B"}  # threads of one mail have no line
    assert got["A"]["participants"] == sorted(set(names), key=str.encode)
    assert got["A"]["emails_in_thread"] == 3 * len(names) + 1
    assert (str(got["A"]["thread_start"]), str(got["A"]["last_reply"])) == ("2025-01-01", "2025-03-01")
    assert got["A"]["has_pending_response"] is True
    assert got["B"]["participants"] == [] and got["B"]["thread_start"] is None
    assert got["B"]["has_pending_response"] is None


def test_timeline_is_the_sum_of_its_parts(small):
    timeline = gold.activity(small["emails"], small["calendar"], small["chat"], AS_OF)
    assert timeline.columns == list(gold.TIMELINE)
    assert timeline.count() == (
        gold.mail_entries(small["emails"]).count()
        + gold.meeting_entries(small["calendar"], AS_OF).count()
        + gold.chat_entries(small["chat"]).count())
    core = gold.activity(small["emails_core"], small["calendar_core"], small["chat_core"], AS_OF)
    assert rows(gold.tiered_activity(core, small["accounts"])) == rows(timeline)
    detail = {r["activity_id"]: r["activity_detail"] for r in timeline.collect()}
    assert detail["e2"] == "UPCOMING | 45 min | 1 attendees"
    assert detail["c3"] == "hi | Replies: 3 | Reactions: 0"


def test_cross_source_keeps_silent_accounts(small, health):
    core = gold.activity(small["emails_core"], small["calendar_core"], small["chat_core"], AS_OF)
    got = {(r["account_name"], r["health_score"]): (r["email_actions"], r["meetings"], r["slack_threads"])
           for r in reports.cross_source(health, core, AS_OF).collect()}
    assert got[("Quiet", 50)] == (0, 0, 0)
    # entries of mail m2, m4; meetings e2 (ahead) and e5; chat with two or more replies
    assert [v for (name, _), v in got.items() if name == "Busy"] == [(2, 2, 3)]


def test_attention_reasons(spark):
    columns = ("account_id string, account_name string, arr_tier string, health_score long, "
               "stale_ucos long, urgent_emails long, total_ucos long, meetings_this_week long, "
               "slack_messages_14d long")
    lines = [("1", "a", "t", 10, 1, 1, 0, 0, 0), ("2", "b", "t", 11, 0, 1, 0, 0, 0),
             ("3", "c", "t", 12, 0, 0, 0, 0, 0), ("4", "d", "t", 13, 0, 0, 1, 0, 0),
             ("5", "e", "t", 14, 0, 0, 1, 1, 0), ("6", "f", "t", 65, 1, 1, 1, 1, 1)]
    got = reports.attention(spark.createDataFrame(lines, columns)).collect()
    assert [r["attention_reason"] for r in got] == [
        "Stale UCOs need update", "Overdue email responses", "No active use cases",
        "No engagement this week", "Review recommended"]


def test_forecast_buckets(small):
    got = {r["uco_name"]: r for r in reports.go_live_forecast(
        small["use_cases"].withColumn("uco_name", F.col("uco_id")), AS_OF).collect()}
    assert {k: r["forecast_bucket"] for k, r in got.items()} == {
        "u0": "OVERDUE", "u1": "OVERDUE", "u2": "THIS_MONTH", "u3": "THIS_MONTH",
        "u4": "NEXT_QUARTER", "u5": "NEXT_QUARTER", "u6": "NEXT_QUARTER"}


def test_optional_report_windows(small):
    assert reports.email_volume(small["emails_core"].withColumn("arr_tier", F.lit("x")), AS_OF,
                                within_days=2).agg(F.sum("total_emails")).first()[0] == 3
    assert reports.chat_activity(small["chat"], within_days=6).first()["total_messages"] == 3


def test_meetings_without_status_or_start(spark):
    core = silver.calendar_core(frame(spark, MEETINGS, [
        {"event_id": "a", "status": "confirmed"}, {"event_id": "b"},
        {"event_id": "c", "status": "cancelled"}, {"event_id": None, "status": "confirmed"}]), AS_OF)
    assert [(r["event_id"], r["timing_label"], r["duration_minutes"]) for r in core.collect()] == [
        ("a", "FUTURE", None)]


def test_older_versions_may_win_after_filters(spark):
    newer = {"_extracted_at": AS_OF}
    tasks = silver.tasks(frame(spark, TASKS, [
        {"task_id": "p", "title": "P", "status": "needsAction", "account_name": "A"},
        {"task_id": "k", "title": "K", "status": "needsAction", "parent_task_id": "p",
         "notes": " ", "due_date": "2024-02-02"},
        {"task_id": "k", "title": "K2", "status": "completed", "parent_task_id": "p", **newer},
        {"task_id": "g", "title": "G", "status": "needsAction", "parent_task_id": "k"},
        {"task_id": "r", "title": "R", "status": "needsAction", "parent_task_id": "",
         "due_date": ""}]), AS_OF)
    got = {r["task_id"]: (r["task_display"], r["account_name"], r["days_overdue"], r["task_notes"])
           for r in tasks.collect()}
    assert got == {"p": ("P", "A", None, None), "k": ("K (re: P)", "A", -2, None),
                   "g": ("G", None, None, None), "r": ("R", None, None, None)}
    documents = silver.documents(frame(spark, DOCUMENTS, [
        {"file_id": "1", "content": "x" * 21}, {"file_id": "1", "content": "short", **newer},
        {"file_id": "2", "content": " " * 30 + "y" * 20}, {"file_id": "3"}]))
    assert [(r["file_id"], len(r["content"])) for r in documents.collect()] == [("1", 21)]


def test_blank_chat_is_dropped(spark):
    core = silver.chat_core(frame(spark, CHAT, [
        {"message_ts": "1", "message_text": "  "}, {"message_ts": "2", "message_text": "\n"},
        {"message_ts": "3"}, {"message_ts": "4", "message_text": "x"}]), AS_OF)
    got = {r["message_ts"]: r["reaction_count"] for r in core.collect()}
    assert got == {"2": None, "4": None}


# ---- plan shapes ----------------------------------------------------------------
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - {
    n for n in entry.queries() if n.startswith(("stream_", "ops_", "snk_"))}))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    corpus = name == "pipeline" or re.match(r"op(?!3_|10_)\d+_", name)  # may use pandas
    for word in ("Cartesian", "NestedLoop", *(() if corpus else ("Python", "Pandas"))):
        assert word not in plan


def test_reports_read_only_the_columns_they_need(spark):
    plan = plan_of(reports.stage_distribution(Inputs(spark, SF_DIR).use_cases))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "orders" in line]
    assert scans and all("o_totalprice" not in s and "o_orderpriority" not in s for s in scans)


def test_event_kind_reaches_the_scan(spark):
    plan = plan_of(Inputs(spark, SF_DIR).emails_core)
    assert "In(event_type, [click,view])" in plan.split("PushedFilters:")[1].split("ReadSchema")[0]


def test_top_threads_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(reports.top_threads(Inputs(spark, SF_DIR).chat_core))


def test_scorecard_counts_before_it_joins(spark):
    plan = plan_of(Inputs(spark, SF_DIR).health)
    assert "Expand" not in plan
