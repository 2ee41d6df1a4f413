"""Calendar events matched to accounts by text, else by attendee domain."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.clock import days, now, parse_iso
from pulseboard.functions.meetings import encode_attendees, video_link
from pulseboard.operators.matching import (Dictionary, match_attendee_domain, match_keywords,
                                           with_account, with_attendee_account)

# Snapshot window around the run, in days.
BACK_DAYS, AHEAD_DAYS = 30, 60


def _moment(edge: str) -> Column:
    value = F.coalesce(F.nullif(F.col(f"{edge}.dateTime"), F.lit("")), F.col(f"{edge}.date"))
    return parse_iso(value)


def flatten_events(raw: DataFrame, as_of: datetime) -> DataFrame:
    """Nested events to typed rows with defaults; no account yet."""
    description = F.nullif(F.col("description"), F.lit(""))
    return raw.select(
        F.col("id").alias("event_id"),
        F.coalesce("summary", F.lit("")).alias("event_title"),
        description.alias("description"),
        F.nullif(F.col("location"), F.lit("")).alias("location"),
        _moment("start").alias("start_time"), _moment("end").alias("end_time"),
        encode_attendees(F.col("attendees")).alias("attendees"),
        video_link(F.col("location"), F.col("description"), F.col("hangoutLink")).alias("video_link"),
        "status", F.col("organizer.email").alias("organizer_email"),
        F.col("htmlLink").alias("html_link"), now(as_of).alias("_extracted_at"),
        F.concat_ws(" ", F.coalesce("summary", F.lit("")), F.coalesce("description", F.lit("")),
                    F.coalesce("location", F.lit(""))).alias("_text"),
        F.transform("attendees", lambda a: F.coalesce(a["email"], F.lit(""))).alias("_addresses"))


def calendar_snapshot(raw: DataFrame, dictionary: Dictionary | DataFrame, as_of: datetime,
                      back_days: int = BACK_DAYS, ahead_days: int = AHEAD_DAYS) -> DataFrame:
    """Events of the window that match an account; the others are dropped.

    An event whose start cannot be read is kept: it may be in the window.
    """
    start = F.col("start_time")
    events = flatten_events(raw, as_of).where(
        start.isNull() | start.between(now(as_of) - days(back_days),
                                       now(as_of) + days(ahead_days)))
    if isinstance(dictionary, DataFrame):
        events = with_attendee_account(
            with_account(events, F.col("_text"), dictionary, "_by_text"),
            F.col("_addresses"), dictionary, "_by_guest")
        account = F.coalesce("_by_text", "_by_guest")
    else:
        account = F.coalesce(match_keywords(F.col("_text"), dictionary),
                             match_attendee_domain(F.col("_addresses"), dictionary))
    # one row per match or none: matched once, while a filter on the match
    # would be pushed down and evaluate it a second time
    return (events.withColumn("account_name", F.explode(F.array_compact(F.array(account))))
            .select("event_id", "account_name", "event_title", "description", "location",
                    "start_time", "end_time", "attendees", "video_link", "status",
                    "organizer_email", "html_link", "_extracted_at"))
