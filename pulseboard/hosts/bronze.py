"""Typed bronze tables derived from the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseboard.functions.meetings import decode_attendees, minutes_between
from pulseboard.hosts import AS_OF, table, versions
from pulseboard.schemas import (ACCOUNTS, CHAT, DOCUMENTS, EMAILS, LEGACY_ACCOUNTS, LEGACY_CHAT,
                                LEGACY_EMAILS, LEGACY_MEETINGS, LEGACY_USE_CASES, MEETINGS,
                                TASKS, USE_CASES)

RUN = f"TIMESTAMP_NTZ'{AS_OF:%Y-%m-%d %H:%M:%S}'"
DAY = f"DATE'{AS_OF:%Y-%m-%d}'"
EVENT_ACCOUNT = """if(user_id % 50 = 49, 'Unmatched',
    concat('Customer#', lpad(string(user_id), 9, '0')))"""


def _select(rows: DataFrame, schema: StructType, columns: dict[str, str]) -> DataFrame:
    """Columns given as SQL expressions, in the order of the schema."""
    return rows.selectExpr(*[f"{columns[name]} AS {name}" for name in schema.names])


def _extracted(again: int) -> str:
    """One day before the run; second copies at ``again`` days before it."""
    return f"if(v = 0, {RUN} - INTERVAL 1 DAY, {RUN} - INTERVAL {again} DAY)"


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; every tenth also as an older copy without revenue."""
    rows = (versions(table(spark, sf_dir, "customer"), "c_custkey % 10 = 0")
            .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")))
    revenue = "if(c_acctbal >= 0 AND v = 0, c_acctbal * 200, NULL)"
    return _select(rows, ACCOUNTS, {
        "account_id": "string(c_custkey)",
        "account_name": "c_name",
        "type": "if(c_custkey % 5 = 0, NULL, r_name)",
        "industry": "c_mktsegment",
        "vertical": "if(c_custkey % 11 = 0, NULL, r_name)",
        "arr": revenue,
        "t3m_arr": f"{revenue} / 4",
        "number_of_employees": "int(c_custkey % 5000)",
        "billing_city": "if(c_custkey % 4 = 0, '', concat('City ', c_nationkey))",
        "billing_state": "if(c_custkey % 3 = 0, NULL, concat('S', c_nationkey))",
        "billing_country": "n_name",
        "owner_name": "concat('Owner ', c_custkey % 20)",
        "last_sa_engaged_id": "concat('P', c_custkey % 7)",
        "last_sa_engaged_name": "concat('Person ', c_custkey % 7)",
        "_extracted_at": _extracted(2)})


def use_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; every twentieth also as an older copy in the first stage."""
    rows = versions(table(spark, sf_dir, "orders"), "o_orderkey % 20 = 0").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
        F.expr("o_custkey = c_custkey"))
    return _select(rows, USE_CASES, {
        "uco_id": "string(o_orderkey)",
        "account_id": "string(o_custkey)",
        "account_name": "c_name",
        "uco_name": "concat('UC ', o_orderkey)",
        "stage": """if(v = 1, 'U1',
            if(o_orderkey % 13 = 0, NULL, concat('U', 1 + o_orderkey % 6)))""",
        "description": "if(o_orderkey % 7 = 0, NULL, o_orderpriority)",
        "use_case_type": "o_orderpriority",
        "implementation_status": "if(o_orderkey % 19 = 0, NULL, o_orderstatus)",
        "go_live_date": f"""if(o_orderkey % 3 = 0, NULL,
            {RUN} + make_dt_interval(int(o_orderkey % 150 - 20)))""",
        "estimated_project_go_live": f"""if(o_orderkey % 2 = 0, NULL,
            {RUN} + make_dt_interval(int(o_orderkey % 200 - 30)))""",
        "last_modified_date": f"{RUN} - make_dt_interval(int(o_orderkey % 90))",
        "created_date": "o_orderdate",
        "assigned_sa_id": "concat('P', o_orderkey % 7)",
        "assigned_sa_name": "concat('Person ', o_orderkey % 7)",
        "_extracted_at": _extracted(2)})


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and views; every seventh also as a newer copy that has been read."""
    events = table(spark, sf_dir, "events").where("event_type IN ('click', 'view')")
    return _select(versions(events, "event_id % 7 = 0"), EMAILS, {
        "message_id": "string(event_id)",
        "thread_id": "concat(user_id, '-', event_id % 5)",
        "account_name": EVENT_ACCOUNT,
        "customer_label": EVENT_ACCOUNT,
        "from_email": "concat('u', event_id % 13, '@example.com')",
        "from_name": "concat('User ', event_id % 13)",
        "to_emails": "array('owner@example.com')",
        "cc_emails": "cast(array() AS array<string>)",
        "subject": """if(event_id % 97 = 0, NULL,
            concat('Subject ', user_id, '-', event_id % 5))""",
        "body_snippet": "props",
        "body_text": "props",
        "received_date": "ts",
        "labels": "if(v = 0 AND value > 20, array('INBOX', 'UNREAD'), array('INBOX'))",
        "is_unread": "v = 0 AND value > 20",
        "needs_response": "if(event_id % 101 = 0, NULL, event_id % 3 <> 0)",
        "has_attachment": "event_id % 4 = 0",
        "_extracted_at": _extracted(0)})


def meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups, spread over the coming weeks."""
    events = table(spark, sf_dir, "events").where("event_type = 'signup'")
    start = "if(event_id % 41 = 0, NULL, ts + make_dt_interval(int(event_id % 6 * 8)))"
    length = "make_dt_interval(0, 0, int(15 + event_id % 4 * 15))"
    people = ", ".join(f"'u{i}@example.com|accepted|U{i}'" for i in range(5))
    return _select(events, MEETINGS, {
        "event_id": "string(event_id)",
        "account_name": EVENT_ACCOUNT,
        "event_title": "concat('Meeting ', event_id % 9)",
        "description": "props",
        "location": "string(NULL)",
        "start_time": start,
        "end_time": f"if(event_id % 23 = 0, NULL, {start} + {length})",
        "attendees": f"slice(array({people}), 1, int(event_id % 6))",
        "video_link": "if(event_id % 3 = 0, NULL, concat('https://zoom.us/j/', event_id))",
        "status": """if(event_id % 17 = 0, 'cancelled',
            if(event_id % 29 = 0, NULL, 'confirmed'))""",
        "organizer_email": "concat('u', event_id % 13, '@example.com')",
        "html_link": "string(NULL)",
        "_extracted_at": f"{RUN} - INTERVAL 1 DAY"})


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and errors; every ninth also as a newer copy without replies."""
    events = table(spark, sf_dir, "events").where("event_type IN ('purchase', 'error')")
    return _select(versions(events, "event_id % 9 = 0"), CHAT, {
        "message_ts": "string(event_id)",
        "channel_id": "concat('C', user_id % 30)",
        "channel_name": "concat('chan-', user_id % 30)",
        "account_name": EVENT_ACCOUNT,
        "user_id": "string(user_id)",
        "message_text": "if(event_id % 31 = 0, '  ', concat(event_type, ' ', props))",
        "sent_at": "ts",
        "thread_ts": "if(event_id % 4 = 0, string(event_id - 1), NULL)",
        "is_reply": "event_id % 4 = 0",
        "reply_count": "if(v = 0, int(event_id % 8), 0)",
        "reactions": "slice(array('a', 'b', 'c', 'd'), 1, int(event_id % 5))",
        "_extracted_at": _extracted(0)})


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns; the first turn is the parent of the others."""
    due = f"date_format(date_add({DAY}, int(conv_id % 40 - 20)), 'yyyy-MM-dd')"
    return _select(table(spark, sf_dir, "conversations"), TASKS, {
        "task_id": "concat(conv_id, '-', turn)",
        "parent_task_id": """if(turn > 0, concat(conv_id, '-0'),
            if(conv_id % 2 = 0, '', NULL))""",
        "tasklist_id": "string(conv_id % 5)",
        "tasklist_name": "concat('List ', conv_id % 5)",
        "title": "text",
        "notes": "if(turn % 3 = 0, '  ', text)",
        "status": "if(turn = 5, 'completed', 'needsAction')",
        "due_date": f"if(conv_id % 4 = 0, '', {due})",
        "account_name": """if(turn = 0,
            concat('Customer#', lpad(string(conv_id), 9, '0')), NULL)""",
        "updated": "''",
        "_extracted_at": f"{RUN} - INTERVAL 1 DAY"})


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents; every eighth also as a newer copy that is too short."""
    return _select(versions(table(spark, sf_dir, "documents"), "doc_id % 8 = 0"), DOCUMENTS, {
        "file_id": "string(doc_id)",
        "file_name": "concat('doc-', doc_id)",
        "account_name": "source",
        "modified_time": "concat('2024-01-', lpad(string(1 + doc_id % 28), 2, '0'))",
        "content": "if(v = 0, text, 'short')",
        "_extracted_at": _extracted(0)})


# ---- the older tables ---------------------------------------------------------
def legacy_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = accounts(spark, sf_dir)
    return raw.select("*", F.col("_extracted_at").alias("ingested_at"),
                      F.lit("salesforce").alias("source_system")).select(*LEGACY_ACCOUNTS.names)


def legacy_use_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = use_cases(spark, sf_dir)
    return raw.select("*", F.col("estimated_project_go_live").alias("full_production_date"),
                      F.col("_extracted_at").alias("ingested_at"),
                      F.lit("salesforce").alias("source_system")).select(*LEGACY_USE_CASES.names)


def legacy_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = emails(spark, sf_dir)
    return raw.select("*", F.col("_extracted_at").alias("ingested_at"),
                      F.lit("gmail").alias("source_system")).select(*LEGACY_EMAILS.names)


def legacy_meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = meetings(spark, sf_dir)
    host = F.regexp_extract("organizer_email", r"^u(\d+)@", 1)
    return raw.select(
        "event_id", "account_name", "event_title", F.col("description").alias("agenda"),
        F.col("start_time").alias("start_datetime"), F.col("end_time").alias("end_datetime"),
        minutes_between(F.col("start_time"), F.col("end_time")).cast("int").alias(
            "duration_minutes"),
        decode_attendees(F.col("attendees")).alias("attendees"), "organizer_email",
        F.concat(F.lit("User "), host).alias("organizer_name"),
        F.col("video_link").alias("meeting_link"), "location", F.col("status").alias("event_status"),
        F.lit("accepted").alias("sa_response_status"), F.lit(False).alias("is_recurring"),
        F.lit("primary").alias("calendar_id"), F.col("_extracted_at").alias("ingested_at"),
        F.lit("google_calendar").alias("source_system")).select(*LEGACY_MEETINGS.names)


def legacy_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = chat(spark, sf_dir)
    return raw.select(
        "message_ts", "channel_id", "channel_name", "account_name",
        F.col("user_id").alias("sender_id"),
        F.concat(F.lit("User "), F.col("user_id")).alias("sender_name"), "message_text",
        "thread_ts", F.col("is_reply").alias("is_thread_reply"), "reply_count", "reactions",
        F.lit(False).alias("has_files"), F.col("sent_at").alias("message_date"),
        F.col("_extracted_at").alias("ingested_at"),
        F.lit("slack").alias("source_system")).select(*LEGACY_CHAT.names)
