"""The older unified view over the older tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.plans.gold import EXCERPT


def daily_activity(emails: DataFrame, meetings: DataFrame, chat: DataFrame) -> DataFrame:
    """Mails, meetings and messages in nine common columns, unordered.

    Readers sort; an order inside a view would not survive the next operation.
    """
    mail = emails.select(
        F.lit("email").alias("activity_type"), "account_name",
        F.col("received_date").alias("activity_date"), F.col("subject").alias("title"),
        F.col("from_name").alias("contact"), F.col("body_snippet").alias("summary"),
        F.when(F.col("needs_response"), "ACTION REQUIRED").when(F.col("is_unread"), "UNREAD")
        .otherwise("READ").alias("status"),
        F.col("message_id").alias("source_id"), "ingested_at")
    held = meetings.select(
        F.lit("meeting").alias("activity_type"), "account_name",
        F.col("start_datetime").alias("activity_date"), F.col("event_title").alias("title"),
        F.col("organizer_name").alias("contact"),
        F.coalesce("agenda", F.lit("")).alias("summary"), F.upper("event_status").alias("status"),
        F.col("event_id").alias("source_id"), "ingested_at")
    excerpt = F.left("message_text", F.lit(EXCERPT))
    said = chat.select(
        F.lit("slack").alias("activity_type"), "account_name",
        F.col("message_date").alias("activity_date"),
        F.concat(F.lit("["), F.col("channel_name"), F.lit("] "), excerpt).alias("title"),
        F.col("sender_name").alias("contact"), F.col("message_text").alias("summary"),
        F.lit("MESSAGE").alias("status"), F.col("message_ts").alias("source_id"), "ingested_at")
    return mail.unionByName(held).unionByName(said)
