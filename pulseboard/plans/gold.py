"""Gold: one activity timeline, one scorecard per account."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import classify as c
from pulseboard.functions.clock import age_days
from pulseboard.plans.silver import with_tier

# Chat window of the timeline and scorecard, and of the score.
CHAT_DAYS, SCORED_CHAT_DAYS = 14, 7
# Fixed value: width of the message excerpt in a timeline entry.
EXCERPT = 120
# Health score, as start value, bonus for any use case, and
# (points each, limit) per signal.
SCORE_START, SCORE_USE_CASES = 50, 10
STALE_POINTS, MEETING_POINTS, CHAT_POINTS, URGENT_POINTS = (5, 20), (5, 15), (2, 10), (5, 15)

TIMELINE = ("activity_id", "account_name", "arr_tier", "activity_date", "activity_type",
            "activity_title", "activity_detail", "priority", "days_old", "is_unread",
            "needs_response", "meeting_link", "last_synced_at")


def _entries(source: DataFrame, kind: str, values: Mapping[str, Column]) -> DataFrame:
    built = source.select(
        "account_name", "last_synced_at", F.lit(kind).alias("activity_type"),
        *([F.col("arr_tier")] if "arr_tier" in source.columns else []),
        *[column.alias(name) for name, column in values.items()])
    return built.select(*[name for name in TIMELINE if name in built.columns])


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def mail_entries(emails: DataFrame) -> DataFrame:
    return _entries(emails.where(F.col("needs_response")), "Email", {
        "activity_id": F.col("message_id"),
        "activity_date": F.col("received_date").cast("date"),
        "activity_title": F.concat(F.lit("Email: "), F.col("subject")),
        "activity_detail": F.concat(F.lit("From: "), F.col("from_name"), F.lit(" | Status: "),
                                    F.col("action_status")),
        "priority": F.col("action_status"),
        "days_old": F.col("days_since_received"),
        "is_unread": F.col("is_unread"),
        "needs_response": F.col("needs_response"),
        "meeting_link": F.lit(None).cast("string")})


def meeting_entries(meetings: DataFrame, as_of: datetime) -> DataFrame:
    minutes = F.coalesce(F.col("duration_minutes").cast("int").cast("string"), F.lit("?"))
    near = meetings.where(F.col("timing_label").isin("THIS_WEEK", "UPCOMING", "PAST"))
    return _entries(near, "Meeting", {
        "activity_id": F.col("event_id"),
        "activity_date": F.col("start_time").cast("date"),
        "activity_title": F.concat(F.lit("Meeting: "), F.col("event_title")),
        "activity_detail": F.concat(F.col("timing_label"), F.lit(" | "), minutes,
                                    F.lit(" min | "), _text("attendee_count"),
                                    F.lit(" attendees")),
        "priority": c.meeting_priority(F.col("timing_label")),
        "days_old": age_days(as_of, F.col("start_time")),
        "is_unread": F.lit(False),
        "needs_response": F.lit(False),
        "meeting_link": F.col("video_link")})


def chat_entries(chat: DataFrame) -> DataFrame:
    engaged = chat.where(F.col("engagement_level").isin("HIGH", "MEDIUM")
                         & (F.col("days_since_sent") <= CHAT_DAYS))
    return _entries(engaged, "Slack", {
        "activity_id": F.col("message_ts"),
        "activity_date": F.col("sent_at").cast("date"),
        "activity_title": F.concat(F.lit("Slack #"), F.col("channel_name")),
        "activity_detail": F.concat(F.left("message_text", F.lit(EXCERPT)),
                                    F.lit(" | Replies: "), _text("reply_count"),
                                    F.lit(" | Reactions: "), _text("reaction_count")),
        "priority": F.col("engagement_level"),
        "days_old": F.col("days_since_sent"),
        "is_unread": F.lit(False),
        "needs_response": F.lit(False),
        "meeting_link": F.lit(None).cast("string")})


def activity(emails: DataFrame, meetings: DataFrame, chat: DataFrame,
             as_of: datetime) -> DataFrame:
    """Mails to answer, past and near meetings, engaged chat of two weeks.

    The union itself does not shuffle, and filters on it reach every source.
    Given core facts (no revenue tier) it yields the timeline without a tier,
    see :func:`tiered_activity`.
    """
    return (mail_entries(emails)
            .unionByName(meeting_entries(meetings, as_of))
            .unionByName(chat_entries(chat)))


def tiered_activity(core: DataFrame, accounts: DataFrame) -> DataFrame:
    """The timeline of core facts with the tier: one join instead of one per fact."""
    return with_tier(core, accounts).select(*TIMELINE)


def use_case_counts(use_cases: DataFrame) -> DataFrame:
    def staged(group: tuple[str, ...]) -> Column:
        return F.count_if(F.col("stage").isin(*group))
    return use_cases.groupBy("account_id").agg(
        F.count("*").alias("total_ucos"), staged(c.EARLY).alias("ucos_early"),
        staged(c.MID).alias("ucos_mid"), staged(c.LIVE).alias("ucos_live"),
        F.count_if("is_stale").alias("stale_ucos"),
        F.count_if("go_live_soon").alias("ucos_go_live_soon"))


def mail_counts(emails: DataFrame) -> DataFrame:
    return emails.groupBy("account_name").agg(
        F.count_if(F.col("action_status") == "URGENT").alias("urgent_emails"),
        F.count_if("needs_response").alias("pending_emails"))


def meeting_counts(meetings: DataFrame) -> DataFrame:
    return meetings.groupBy("account_name").agg(
        F.count_if(F.col("timing_label") == "THIS_WEEK").alias("meetings_this_week"))


def chat_counts(chat: DataFrame) -> DataFrame:
    def recent(days: int) -> Column:
        return F.count_if(F.col("days_since_sent") <= days)
    return chat.groupBy("account_name").agg(
        recent(CHAT_DAYS).alias("slack_messages_14d"), recent(SCORED_CHAT_DAYS).alias("_chat_7d"))


def _points(count: Column, rule: tuple[int, int]) -> Column:
    each, limit = rule
    return F.least(F.lit(limit), count * each)


def health(accounts: DataFrame, use_cases: DataFrame, emails: DataFrame, meetings: DataFrame,
           chat: DataFrame) -> DataFrame:
    """Scorecard per account, from core facts.

    Joining the four facts to the account and counting distinct ids would build
    use cases x mails x meetings x messages rows per account. Ids are unique
    after the silver dedupe, so each fact is counted per account first and the
    joins are one to one. Partial aggregation absorbs a hot account before the
    shuffle. Facts are counted by account name, so accounts that share a name
    each get the full counts.
    """
    counted = (accounts
               .join(use_case_counts(use_cases), "account_id", "left")
               .join(mail_counts(emails), "account_name", "left")
               .join(meeting_counts(meetings), "account_name", "left")
               .join(chat_counts(chat), "account_name", "left"))
    counts = ("total_ucos", "ucos_early", "ucos_mid", "ucos_live", "stale_ucos",
              "ucos_go_live_soon", "urgent_emails", "pending_emails", "meetings_this_week",
              "slack_messages_14d", "_chat_7d")
    counted = counted.select(
        "account_id", "account_name", "arr", "t3m_arr", "arr_tier", "industry", "vertical",
        "billing_location", *[F.coalesce(n, F.lit(0)).alias(n) for n in counts],
        "last_synced_at")
    score = (F.lit(SCORE_START)
             + F.when(F.col("total_ucos") > 0, F.lit(SCORE_USE_CASES)).otherwise(F.lit(0))
             - _points(F.col("stale_ucos"), STALE_POINTS)
             + _points(F.col("meetings_this_week"), MEETING_POINTS)
             + _points(F.col("_chat_7d"), CHAT_POINTS)
             - _points(F.col("urgent_emails"), URGENT_POINTS))
    return counted.withColumn(
        "health_score", F.least(F.lit(100), F.greatest(F.lit(0), score))).select(
        "account_id", "account_name", "arr", "t3m_arr", "arr_tier", "industry", "vertical",
        "billing_location", *counts[:-1], "health_score", "last_synced_at")
