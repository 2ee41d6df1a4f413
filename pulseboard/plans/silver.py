"""Silver: latest version of every record, cleaned and classified.

Each fact has a ``*_core`` form without account attributes. Gold counts by
account need nothing else, so they skip the enrichment join; the full form adds
the revenue tier.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import classify as c
from pulseboard.functions.clock import age_days, parse_day
from pulseboard.functions.meetings import minutes_between
from pulseboard.functions.text import is_blank
from pulseboard.operators.dedupe import latest_per_key
from pulseboard.sources.tasks import COMPLETED

# Defaults and bounds of the silver layer.
UNKNOWN = "Unknown"
CANCELLED = "cancelled"
MIN_DOCUMENT_CHARS = 20

# Key of each record family, and the columns that settle equal extraction times.
VERSIONS = {
    "accounts": ("account_id", ("account_name", "arr")),
    "use_cases": ("uco_id", ("last_modified_date", "stage")),
    "emails": ("message_id", ("received_date", "is_unread")),
    "meetings": ("event_id", ("start_time", "status")),
    "chat": ("message_ts", ("channel_id", "reply_count")),
    "tasks": ("task_id", ("title", "due_date")),
    "documents": ("file_id", ("modified_time",)),
}


def _latest(raw: DataFrame, family: str, newest: bool = False) -> DataFrame:
    """The newest version of each key; ``newest`` says that ``raw`` holds nothing else."""
    key, tie_by = VERSIONS[family]
    return raw if newest else latest_per_key(raw, key, tie_by=tie_by)


def _or(name: str, default: object) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def with_tier(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Left join of the revenue tier by account name.

    Two accounts of one name give every fact twice, as the name is all there is
    to join on. Spark broadcasts the two-column account side when its measured
    size allows; otherwise a hot account's facts are split by adaptive
    execution (the fact side of a left join may be split).
    """
    tiers = accounts.select("account_name", "arr_tier")
    return facts.join(tiers, "account_name", "left")


# Columns of the facts with the tier.
TIERED = {
    "emails": (
        "message_id", "thread_id", "account_name", "arr_tier", "from_email", "from_name",
        "to_emails", "cc_emails", "subject", "body_snippet", "received_date", "is_unread",
        "needs_response", "has_attachment", "days_since_received", "action_status",
        "last_synced_at"),
    "calendar": (
        "event_id", "account_name", "arr_tier", "event_title", "description", "location",
        "start_time", "end_time", "duration_minutes", "event_day_of_week", "timing_label",
        "attendees", "attendee_count", "video_link", "status", "organizer_email", "html_link",
        "last_synced_at"),
    "chat": (
        "message_ts", "channel_id", "channel_name", "account_name", "arr_tier", "user_id",
        "message_text", "sent_at", "days_since_sent", "thread_ts", "is_reply", "reply_count",
        "reactions", "reaction_count", "engagement_level", "last_synced_at"),
}


def tiered(name: str, core: DataFrame, accounts: DataFrame) -> DataFrame:
    """Core facts with the tier of their account."""
    return with_tier(core, accounts).select(*TIERED[name])


def accounts(raw: DataFrame, newest: bool = False) -> DataFrame:
    latest = _latest(raw, "accounts", newest)
    return latest.where(F.col("account_id").isNotNull() & F.col("account_name").isNotNull()).select(
        "account_id", "account_name",
        F.coalesce("type", F.lit(UNKNOWN)).alias("account_type"),
        _or("industry", UNKNOWN), _or("vertical", UNKNOWN), _or("arr", 0.0), _or("t3m_arr", 0.0),
        "number_of_employees", "billing_city", "billing_state", "billing_country",
        F.concat_ws(", ", *[F.nullif(F.col(f"billing_{part}"), F.lit(""))
                            for part in ("city", "state", "country")]).alias("billing_location"),
        "owner_name", "last_sa_engaged_name",
        c.revenue_tier(F.col("arr")).alias("arr_tier"),
        F.col("_extracted_at").alias("last_synced_at"))


def use_cases(raw: DataFrame, as_of: datetime, newest: bool = False) -> DataFrame:
    latest = _latest(raw, "use_cases", newest)
    due = F.coalesce("go_live_date", "estimated_project_go_live")
    return latest.where(F.col("uco_id").isNotNull()).select(
        "uco_id", "account_id", "account_name", "uco_name",
        _or("stage", UNKNOWN), _or("description", ""), _or("use_case_type", UNKNOWN),
        _or("implementation_status", UNKNOWN),
        "go_live_date", "estimated_project_go_live", "last_modified_date", "created_date",
        "assigned_sa_name",
        c.stage_rank(F.col("stage")).alias("stage_order"),
        c.is_stale(F.col("last_modified_date"), as_of).alias("is_stale"),
        c.due_within(due, as_of).alias("go_live_soon"),
        F.col("_extracted_at").alias("last_synced_at"))


def emails_core(raw: DataFrame, as_of: datetime, newest: bool = False) -> DataFrame:
    latest = _latest(raw, "emails", newest)
    received = F.col("received_date")
    return latest.where(F.col("message_id").isNotNull()).select(
        "message_id", "thread_id", "account_name", "from_email", "from_name", "to_emails",
        "cc_emails", "subject", "body_snippet", "received_date", "is_unread", "needs_response",
        "has_attachment", age_days(as_of, received).alias("days_since_received"),
        c.mail_status(F.col("needs_response"), F.col("is_unread"), received,
                      as_of).alias("action_status"),
        F.col("_extracted_at").alias("last_synced_at"))


def emails(raw: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    return tiered("emails", emails_core(raw, as_of), accounts)


def calendar_core(raw: DataFrame, as_of: datetime, newest: bool = False) -> DataFrame:
    latest = _latest(raw, "meetings", newest)
    start = F.col("start_time")
    return latest.where(F.col("event_id").isNotNull() & (F.col("status") != CANCELLED)).select(
        "event_id", "account_name", "event_title", "description", "location", "start_time",
        "end_time", minutes_between(start, F.col("end_time")).alias("duration_minutes"),
        F.date_format(start, "EEEE").alias("event_day_of_week"),
        c.timing_label(start, as_of).alias("timing_label"),
        "attendees", F.size("attendees").alias("attendee_count"), "video_link", "status",
        "organizer_email", "html_link", F.col("_extracted_at").alias("last_synced_at"))


def calendar(raw: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    return tiered("calendar", calendar_core(raw, as_of), accounts)


def chat_core(raw: DataFrame, as_of: datetime, newest: bool = False) -> DataFrame:
    """The key is the message time alone, without the channel."""
    latest = _latest(raw, "chat", newest)
    return latest.where(F.col("message_ts").isNotNull() & ~is_blank(F.col("message_text"))).select(
        "message_ts", "channel_id", "channel_name", "account_name", "user_id", "message_text",
        "sent_at", age_days(as_of, F.col("sent_at")).alias("days_since_sent"),
        "thread_ts", "is_reply", "reply_count", "reactions",
        F.size("reactions").alias("reaction_count"),
        c.engagement(F.col("reply_count"), F.size("reactions")).alias("engagement_level"),
        F.col("_extracted_at").alias("last_synced_at"))


def chat(raw: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    return tiered("chat", chat_core(raw, as_of), accounts)


def open_tasks(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("status") != COMPLETED)


def tasks(raw: DataFrame, as_of: datetime) -> DataFrame:
    """Open tasks with their parent's title.

    Finished versions are removed before the latest one is picked, so an older
    open version outlives a newer finished one. Parents are open root tasks,
    taken as delivered: a parent delivered twice doubles its children. Root tasks
    would all meet on the one empty parent id, so each joins on a key of its own.
    """
    still_open = open_tasks(raw)
    latest = _latest(still_open, "tasks")
    is_root = F.coalesce("parent_task_id", F.lit("")) == ""
    parents = still_open.where(is_root).select(
        F.col("task_id").alias("_parent"), F.col("title").alias("parent_title"),
        F.col("account_name").alias("parent_account"))
    own_key = F.concat(F.lit("\u0000"), F.col("task_id"))
    latest = latest.withColumn(
        "_parent", F.when(is_root, own_key).otherwise(F.col("parent_task_id")))
    due = parse_day(F.col("due_date"))
    return latest.join(parents, "_parent", "left").select(
        "task_id", "parent_task_id", "parent_title", "tasklist_id", "tasklist_name",
        F.col("title").alias("task_title"),
        F.when(F.col("parent_title").isNotNull(),
               F.concat("title", F.lit(" (re: "), "parent_title", F.lit(")")))
        .otherwise(F.col("title")).alias("task_display"),
        F.nullif(F.trim("notes"), F.lit("")).alias("task_notes"), "status",
        due.alias("due_date"), age_days(as_of, due).alias("days_overdue"),
        F.coalesce("account_name", "parent_account").alias("account_name"),
        "updated", "_extracted_at")


def long_documents(raw: DataFrame) -> DataFrame:
    return raw.where(F.length(F.trim("content")) > MIN_DOCUMENT_CHARS)


def documents(raw: DataFrame, newest: bool = False) -> DataFrame:
    """Latest version among those with enough text.

    The length filter comes before the choice, so an older long version
    outlives a newer short one.
    """
    return _latest(long_documents(raw), "documents", newest).select(
        "file_id", "file_name", "account_name", "modified_time", "content", "_extracted_at")
