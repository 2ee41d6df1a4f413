"""Chat messages of the channels that match an account."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.clock import days, now, parse_epoch
from pulseboard.functions.meetings import is_thread_reply, reaction_names
from pulseboard.operators.dedupe import first_per_key
from pulseboard.operators.matching import Dictionary, with_account

# Look-back in days.
SNAPSHOT_DAYS, INCREMENTAL_DAYS = 14, 2


def matched_channels(channels: DataFrame, dictionary: Dictionary | DataFrame) -> DataFrame:
    """Channels whose name or purpose names an account."""
    name = F.coalesce("name", F.lit(""))
    text = F.concat(name, F.lit(" "), F.coalesce("purpose.value", F.lit("")))
    return (with_account(channels, text, dictionary).where(F.col("account_name").isNotNull())
            .select("ord", F.col("id").alias("channel_id"), name.alias("channel_name"),
                    "account_name"))


def flatten_messages(messages: DataFrame, as_of: datetime) -> DataFrame:
    """Nested messages to typed rows, without channel attributes."""
    return messages.select(
        F.col("ts").alias("message_ts"), F.col("channel").alias("channel_id"),
        F.coalesce(F.nullif(F.col("user"), F.lit("")), "bot_id").alias("user_id"),
        F.coalesce("text", F.lit("")).alias("message_text"),
        parse_epoch(F.col("ts")).alias("sent_at"), "thread_ts",
        is_thread_reply(F.col("thread_ts"), F.col("ts")).alias("is_reply"),
        F.coalesce("reply_count", F.lit(0)).alias("reply_count"),
        reaction_names(F.col("reactions")).alias("reactions"),
        now(as_of).alias("_extracted_at"))


def chat_snapshot(channels: DataFrame, messages: DataFrame, dictionary: Dictionary | DataFrame,
                  as_of: datetime, back_days: int = SNAPSHOT_DAYS) -> DataFrame:
    """Messages of matched channels in the window, one row per timestamp.

    A timestamp seen in several channels stays with the channel listed first.
    Whether the channel table is broadcast is left to its measured size.
    """
    recent = flatten_messages(messages, as_of).where(
        (F.col("message_ts") != "") & (F.col("sent_at") >= now(as_of) - days(back_days)))
    joined = recent.join(matched_channels(channels, dictionary), "channel_id")
    return first_per_key(joined, "message_ts", [F.col("ord"), F.col("channel_id")]).select(
        "message_ts", "channel_id", "channel_name", "account_name", "user_id", "message_text",
        "sent_at", "thread_ts", "is_reply", "reply_count", "reactions", "_extracted_at")


def chat_incremental(channels: DataFrame, messages: DataFrame,
                     dictionary: Dictionary | DataFrame, as_of: datetime, back_days: int = INCREMENTAL_DAYS) -> DataFrame:
    """One incremental run: two days back, of which one is a safety overlap."""
    return chat_snapshot(channels, messages, dictionary, as_of, back_days)
