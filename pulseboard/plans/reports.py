"""The reports: functions of silver and gold frames.

Sort orders carry a last key that makes them total where rows would tie, so a
listing or a top-k does not depend on task timing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import classify as c
from pulseboard.functions.clock import age_days, days, now, today
from pulseboard.plans import gold

# Rank of mail states and of priorities in listings.
MAIL_ORDER = ("URGENT", "PENDING", "READ_PENDING")
PRIORITY_ORDER = ("URGENT", "HIGH", "MEDIUM")
# Preview widths, length of the thread ranking, attention bound.
MESSAGE_PREVIEW, THREAD_PREVIEW, TOP_THREADS = 200, 150, 20
ATTENTION_BELOW = 65
BLOCK_CHARS = 3  # senders of a thread are sorted in blocks of this common beginning


def _thousands(name: str) -> Column:
    return F.round(F.col(name) / 1000, 0)


def _day(name: str) -> Column:
    return F.col(name).cast("date")


def _due() -> Column:
    return F.coalesce("go_live_date", "estimated_project_go_live")


def _per_account(counts: DataFrame, accounts: DataFrame, counted: tuple[str, ...],
                 tier: bool = True) -> DataFrame:
    """Counts by account name, carried over to the accounts of that name.

    A fact belongs to every account of its name, so each counted column is multiplied
    by how many there are (of one tier, which becomes a column). The facts themselves
    never meet the accounts; a name without account keeps its counts.
    """
    keys = ["account_name", "arr_tier"] if tier else ["account_name"]
    names = accounts.groupBy(*keys).agg(F.count("*").alias("_accounts"))
    times = F.coalesce("_accounts", F.lit(1))
    rest = [c for c in counts.columns if c != "account_name"]
    return counts.join(names, "account_name", "left").select(
        *keys, *[(F.col(c) * times).alias(c) if c in counted else c for c in rest])


# ---- accounts and use cases -------------------------------------------------
def account_overview(accounts: DataFrame) -> DataFrame:
    return (accounts.orderBy(F.col("arr").desc_nulls_last(), "account_id")
            .select("account_name", "arr_tier", _thousands("arr").alias("arr_k"), "industry",
                    "vertical", "billing_location", "last_synced_at"))


def stage_distribution(use_cases: DataFrame) -> DataFrame:
    return (use_cases.groupBy("account_name", "stage")
            .agg(F.count("*").alias("uco_count"), F.max("last_modified_date").alias("last_updated"),
                 F.min("stage_order").alias("_order"))
            .orderBy("account_name", "_order", "stage").drop("_order"))


def stale_use_cases(use_cases: DataFrame, as_of: datetime) -> DataFrame:
    return (use_cases.where(F.col("is_stale"))
            .select("uco_id", "account_name", "uco_name", "stage", "use_case_type",
                    "implementation_status",
                    age_days(as_of, F.col("last_modified_date")).alias("days_since_update"),
                    "last_modified_date")
            .orderBy(F.col("days_since_update").desc(), "uco_id"))


def go_live_soon(use_cases: DataFrame, as_of: datetime) -> DataFrame:
    return (use_cases.where(F.col("go_live_soon"))
            .select("uco_id", "account_name", "uco_name", "stage", "go_live_date",
                    "estimated_project_go_live",
                    F.date_diff(_due().cast("date"), today(as_of)).alias("days_until_go_live"))
            .orderBy("days_until_go_live", "uco_id"))


def health_scorecard(health: DataFrame) -> DataFrame:
    return (health.orderBy(F.col("health_score").desc(), "account_id")
            .select("account_name", "arr_tier", _thousands("arr").alias("arr_k"), "total_ucos",
                    "ucos_early", "ucos_mid", "ucos_live", "stale_ucos", "urgent_emails",
                    "meetings_this_week", "slack_messages_14d", "health_score"))


# ---- mail -------------------------------------------------------------------
def emails_to_answer(emails: DataFrame) -> DataFrame:
    rank = c.rank_of(F.col("action_status"), MAIL_ORDER, 4)
    return (emails.where(F.col("needs_response"))
            .orderBy(rank, F.col("received_date").desc(), "message_id")
            .select("account_name", "arr_tier", "subject", "from_name", "from_email",
                    _day("received_date").alias("date"), "days_since_received", "action_status",
                    "is_unread", "has_attachment"))


def urgent_emails(emails: DataFrame) -> DataFrame:
    return (emails.where(F.col("action_status") == "URGENT")
            .orderBy(F.col("days_since_received").desc(), "message_id")
            .select("account_name", "subject", "from_email",
                    _day("received_date").alias("received"), "days_since_received",
                    "body_snippet"))


def email_volume(emails: DataFrame, as_of: datetime, within_days: int | None = None,
                 accounts: DataFrame | None = None) -> DataFrame:
    """All history unless ``within_days`` is given. With ``accounts`` the mails are core
    facts and are counted before the tier is joined; without, they carry it."""
    if within_days is not None:
        emails = emails.where(F.col("received_date") >= now(as_of) - days(within_days))
    keys = ["account_name"] if accounts is not None else ["account_name", "arr_tier"]
    counts = emails.groupBy(*keys).agg(
        F.count("*").alias("total_emails"),
        F.count_if("needs_response").alias("needs_response"),
        F.count_if(F.col("action_status") == "URGENT").alias("urgent"),
        F.count_if("is_unread").alias("unread"),
        F.max(_day("received_date")).alias("last_email_date"))
    if accounts is not None:
        counts = _per_account(counts, accounts, (
            "total_emails", "needs_response", "urgent", "unread"))
    return counts.orderBy(F.desc("needs_response"), F.desc("total_emails"), "account_name",
                          "arr_tier")


def thread_summary(emails: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """With ``accounts`` a mail counts once for each account of its name.

    Senders are told apart before they meet: mails are counted per thread and sender,
    then senders sorted in blocks of one beginning, then blocks joined in order. A thread
    with very many mails or senders is spread over tasks until its line is written.
    """
    thread = ["account_name", "thread_id", "subject"]
    senders = (emails.groupBy(*thread, "from_email")
               .agg(F.count("*").alias("mails"), F.min(_day("received_date")).alias("first"),
                    F.max(_day("received_date")).alias("last"),
                    F.bool_or("needs_response").alias("pending")))
    blocks = (senders.withColumn("block", F.substring("from_email", 1, BLOCK_CHARS))
              .groupBy(*thread, "block")
              .agg(F.sum("mails").alias("mails"), F.min("first").alias("first"),
                   F.max("last").alias("last"), F.bool_or("pending").alias("pending"),
                   F.array_sort(F.collect_list("from_email")).alias("names")))
    ordered = F.array_sort(F.collect_list(F.struct("block", "names")))
    threads = (blocks.groupBy(*thread)
               .agg(F.sum("mails").alias("emails_in_thread"),
                    F.min("first").alias("thread_start"),
                    F.max("last").alias("last_reply"),
                    F.bool_or("pending").alias("has_pending_response"),
                    F.flatten(F.transform(ordered, lambda b: b["names"])).alias("participants")))
    if accounts is not None:
        threads = _per_account(threads, accounts, ("emails_in_thread",), tier=False)
    return (threads.where(F.col("emails_in_thread") > 1)
            .orderBy(F.desc("last_reply"), "account_name", "thread_id")
            .drop("thread_id"))


# ---- meetings ---------------------------------------------------------------
def week_meetings(meetings: DataFrame) -> DataFrame:
    return (meetings.where(F.col("timing_label") == "THIS_WEEK")
            .orderBy("start_time", "event_id")
            .select("account_name", "arr_tier", "event_title", _day("start_time").alias("date"),
                    F.date_format("start_time", "HH:mm").alias("time"),
                    F.col("duration_minutes").cast("int").alias("duration_min"),
                    "attendee_count", "video_link", "organizer_email"))


def upcoming_meetings(meetings: DataFrame) -> DataFrame:
    """Sorted by the real start, not by its time of day."""
    return (meetings.where(F.col("timing_label").isin("THIS_WEEK", "UPCOMING"))
            .orderBy("start_time", "event_id")
            .select("account_name", "arr_tier", "event_title", _day("start_time").alias("date"),
                    "event_day_of_week", F.date_format("start_time", "HH:mm").alias("start_hhmm"),
                    F.col("duration_minutes").cast("int").alias("duration_min"),
                    "attendee_count", "video_link", "timing_label"))


def meeting_frequency(meetings: DataFrame, as_of: datetime, within_days: int = 30,
                      accounts: DataFrame | None = None) -> DataFrame:
    """With ``accounts`` the meetings are core facts, counted before the tier is joined."""
    recent = meetings.where((F.col("timing_label") == "PAST")
                            & (F.col("start_time") >= now(as_of) - days(within_days)))
    keys = ["account_name"] if accounts is not None else ["account_name", "arr_tier"]
    counts = recent.groupBy(*keys).agg(
        F.count("*").alias("total_meetings"),
        F.round(F.avg("duration_minutes"), 0).alias("avg_duration_min"),
        F.sum("attendee_count").alias("total_attendees"),
        F.min(_day("start_time")).alias("first_meeting"),
        F.max(_day("start_time")).alias("last_meeting"))
    if accounts is not None:
        counts = _per_account(counts, accounts, ("total_meetings", "total_attendees"))
    return counts.orderBy(F.desc("total_meetings"), "account_name", "arr_tier")


def meeting_prep(meetings: DataFrame, accounts: DataFrame, use_cases: DataFrame,
                 emails: DataFrame) -> DataFrame:
    """Coming meetings with use-case and mail counts, from core facts.

    Counted per account before joining, as in the scorecard. Meetings that agree
    in every listed column are one line; accounts that agree in name, tier and
    revenue share a line, so their use cases are added up.
    """
    by_account = use_cases.groupBy("account_id").agg(
        F.count("*").alias("_ucos"), F.count_if("is_stale").alias("_stale"))
    context = (accounts.join(by_account, "account_id", "left")
               .groupBy("account_name", "arr_tier", "arr")
               .agg(F.coalesce(F.sum("_ucos"), F.lit(0)).alias("active_ucos"),
                    F.coalesce(F.sum("_stale"), F.lit(0)).alias("stale_ucos")))
    waiting = gold.mail_counts(emails).select("account_name", "pending_emails")
    lines = (meetings.where(F.col("timing_label").isin("THIS_WEEK", "UPCOMING"))
             .select("account_name", "event_title", _day("start_time").alias("meeting_date"),
                     "duration_minutes", "attendees")
             .distinct())
    # One join of the lines, so that a hot account's lines can be split.
    return (lines.join(context.join(waiting, "account_name", "left"), "account_name")
            .select("account_name", "event_title", "meeting_date", "duration_minutes",
                    "attendees", "arr_tier", "arr", "active_ucos", "stale_ucos",
                    F.coalesce("pending_emails", F.lit(0)).alias("pending_emails"))
            .orderBy("meeting_date", "account_name", "event_title", "duration_minutes",
                     "attendees", "arr_tier", "arr"))


# ---- chat -------------------------------------------------------------------
def engaged_chat(chat: DataFrame) -> DataFrame:
    rank = c.rank_of(F.col("engagement_level"), ("HIGH",), 2)
    return (chat.where(F.col("engagement_level").isin("HIGH", "MEDIUM"))
            .orderBy(rank, F.col("sent_at").desc(), "message_ts")
            .select("account_name", "arr_tier", "channel_name",
                    F.left("message_text", F.lit(MESSAGE_PREVIEW)).alias("message_preview"),
                    _day("sent_at").alias("date"), "days_since_sent", "reply_count",
                    "reaction_count", "engagement_level"))


def chat_activity(chat: DataFrame, within_days: int | None = None,
                  accounts: DataFrame | None = None) -> DataFrame:
    """All history unless ``within_days`` is given. With ``accounts`` the messages are core
    facts and are counted before the tier is joined; without, they carry it."""
    if within_days is not None:
        chat = chat.where(F.col("days_since_sent") <= within_days)
    keys = ["account_name"] if accounts is not None else ["account_name", "arr_tier"]
    counts = chat.groupBy(*keys, "channel_name").agg(
        F.count("*").alias("total_messages"),
        F.count_if(~F.col("is_reply")).alias("top_level_messages"),
        F.sum("reply_count").alias("total_replies"),
        F.count_if(F.col("engagement_level") == "HIGH").alias("high_engagement"),
        F.max(_day("sent_at")).alias("last_message_date"))
    if accounts is not None:
        counts = _per_account(counts, accounts, (
            "total_messages", "top_level_messages", "total_replies", "high_engagement"))
    return counts.orderBy(F.desc("total_messages"), "account_name", "channel_name", "arr_tier")


def channels_summary(chat: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Channels, volume and active days per account.

    Counted per account, channel and day first: what reaches the per-account
    stage is bounded by channels x days, not by messages. With ``accounts`` a
    message counts once for each account of its name.
    """
    daily = (chat.groupBy("account_name", "channel_name", _day("sent_at").alias("_day"))
             .agg(F.count("*").alias("_n")))
    summary = daily.groupBy("account_name").agg(
        F.array_sort(F.collect_set("channel_name")).alias("channels"),
        F.sum("_n").alias("total_messages"),
        F.size(F.collect_set("_day")).cast("long").alias("active_days"),
        F.max("_day").alias("most_recent"))
    if accounts is not None:
        summary = _per_account(summary, accounts, ("total_messages",), tier=False)
    return summary.orderBy(F.desc("most_recent"), "account_name")


def top_threads(chat: DataFrame, limit: int = TOP_THREADS) -> DataFrame:
    return (chat.where(~F.col("is_reply") & (F.col("reply_count") > 0))
            .orderBy(F.desc("reply_count"), F.desc("sent_at"), "message_ts")
            .limit(limit)
            .select("account_name", "channel_name",
                    F.left("message_text", F.lit(THREAD_PREVIEW)).alias("thread_starter"),
                    _day("sent_at").alias("date"), "reply_count", "reaction_count"))


# ---- daily view -------------------------------------------------------------
def today_actions(activity: DataFrame, as_of: datetime, mail_days: int = 3) -> DataFrame:
    kind = F.col("activity_type")
    wanted = ((F.col("activity_date") == today(as_of))
              | ((kind == "Email") & F.col("needs_response") & (F.col("days_old") <= mail_days))
              | ((kind == "Meeting") & (F.col("priority") == "HIGH")))
    return (activity.where(wanted)
            .orderBy(c.rank_of(F.col("priority"), PRIORITY_ORDER, 4), "account_name",
                     "activity_id")
            .select("account_name", "arr_tier", "activity_type", "activity_title",
                    "activity_detail", "priority", "days_old", "is_unread", "needs_response",
                    "meeting_link"))


def week_timeline(activity: DataFrame, as_of: datetime, reach: int = 7) -> DataFrame:
    span = F.col("activity_date").between(F.date_sub(today(as_of), reach),
                                          F.date_add(today(as_of), reach))
    return (activity.where(span)
            .orderBy("activity_date", "account_name", "activity_type", "activity_id")
            .select("activity_date", "account_name", "activity_type", "activity_title",
                    "activity_detail", "priority"))


def health_exec(health: DataFrame) -> DataFrame:
    return (health.orderBy("health_score", "account_id")
            .select("account_name", "arr_tier", _thousands("arr").alias("arr_k"), "health_score",
                    "total_ucos", "ucos_live", "stale_ucos", "urgent_emails",
                    "meetings_this_week", "slack_messages_14d", "ucos_go_live_soon"))


def attention(health: DataFrame, below: int = ATTENTION_BELOW) -> DataFrame:
    silent = (F.col("meetings_this_week") == 0) & (F.col("slack_messages_14d") == 0)
    # The reason texts, the first that holds.
    reason = (F.when(F.col("stale_ucos") > 0, "Stale UCOs need update")
              .when(F.col("urgent_emails") > 0, "Overdue email responses")
              .when(F.col("total_ucos") == 0, "No active use cases")
              .when(silent, "No engagement this week")
              .otherwise("Review recommended"))
    return (health.where(F.col("health_score") < below)
            .orderBy("health_score", "account_id")
            .select("account_name", "arr_tier", "health_score", reason.alias("attention_reason"),
                    "stale_ucos", "urgent_emails", "total_ucos", "meetings_this_week"))


def cross_source(health: DataFrame, activity: DataFrame, as_of: datetime,
                 within_days: int = 14) -> DataFrame:
    """Timeline entries by kind per account, from the timeline without tiers.

    Ids are unique per kind there, so entries are counted by account name first
    and joined one to one; an account without entries keeps its line.
    """
    recent = activity.where(F.col("activity_date") >= F.date_sub(today(as_of), within_days))
    kinds = {"Email": "email_actions", "Meeting": "meetings", "Slack": "slack_threads"}
    counts = recent.groupBy("account_name").agg(
        *[F.count_if(F.col("activity_type") == kind).alias(name) for kind, name in kinds.items()])
    return (health.select("account_name", "arr_tier", "health_score").distinct()
            .join(counts, "account_name", "left")
            .select("account_name", "arr_tier", "health_score",
                    *[F.coalesce(name, F.lit(0)).alias(name) for name in kinds.values()])
            .orderBy("health_score", "account_name"))


# ---- use-case tracking --------------------------------------------------------
def use_cases_by_stage(use_cases: DataFrame) -> DataFrame:
    """Per stage; pre-counted per account, as the few stages hold all rows."""
    per_account = use_cases.groupBy("stage", "account_name").agg(
        F.count("*").alias("_n"), F.count_if("is_stale").alias("_stale"),
        F.count_if("go_live_soon").alias("_soon"), F.min("stage_order").alias("_order"))
    return (per_account.groupBy("stage")
            .agg(F.sum("_n").alias("uco_count"), F.count("account_name").alias("accounts"),
                 F.sum("_stale").alias("stale"), F.sum("_soon").alias("go_live_soon"),
                 F.min("_order").alias("_order"))
            .orderBy("_order", "stage").drop("_order"))


def use_case_list(use_cases: DataFrame, as_of: datetime) -> DataFrame:
    return (use_cases.orderBy("account_name", "stage_order", "uco_id")
            .select("account_name", "uco_name", "stage", "use_case_type",
                    "implementation_status", "go_live_date", "estimated_project_go_live",
                    age_days(as_of, F.col("last_modified_date")).alias("days_since_update"),
                    "is_stale", "go_live_soon", "assigned_sa_name"))


def stage_progression(use_cases: DataFrame, health: DataFrame) -> DataFrame:
    def staged(group: tuple[str, ...]) -> Column:
        return F.count_if(F.col("stage").isin(*group))
    counts = use_cases.groupBy("account_name").agg(
        staged(c.EARLY).alias("early_stage"), staged(c.MID).alias("mid_stage"),
        staged(c.LIVE).alias("live_stage"), F.count("*").alias("total_ucos"))
    share = F.lit(100.0) * F.col("live_stage") / F.nullif("total_ucos", F.lit(0))
    return (counts.join(health.select("account_name", "arr_tier", "health_score"), "account_name")
            .select("account_name", "early_stage", "mid_stage", "live_stage", "total_ucos",
                    F.round(share, 1).alias("pct_live"), "arr_tier", "health_score")
            .orderBy(F.desc("pct_live"), "account_name"))


def implementation_status(use_cases: DataFrame) -> DataFrame:
    """Per status; pre-counted per account, as the few statuses hold all rows."""
    per_account = (use_cases.where(F.col("implementation_status").isNotNull())
                   .groupBy("implementation_status", "account_name")
                   .agg(F.count("*").alias("_n")))
    return (per_account.groupBy("implementation_status")
            .agg(F.sum("_n").alias("uco_count"), F.count("account_name").alias("accounts"))
            .orderBy(F.desc("uco_count"), "implementation_status"))


def go_live_forecast(use_cases: DataFrame, as_of: datetime, ahead_days: int = 90,
                     month_days: int = 30) -> DataFrame:
    """Everything due up to ``ahead_days`` ahead, with no lower bound."""
    out = F.date_diff(F.col("target_go_live").cast("date"), today(as_of))
    bucket = (F.when(F.col("target_go_live") < now(as_of), "OVERDUE")
              .when(out <= month_days, "THIS_MONTH").otherwise("NEXT_QUARTER"))
    return (use_cases.withColumn("target_go_live", _due())
            .where(F.col("target_go_live") <= now(as_of) + days(ahead_days))
            .orderBy("target_go_live", "uco_id")
            .select("account_name", "uco_name", "stage", "target_go_live",
                    out.alias("days_out"), bucket.alias("forecast_bucket")))
