"""Mail messages: label match, per-label newest-k, header and body parsing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import mail as m
from pulseboard.functions.clock import days, now, parse_mail_date
from pulseboard.functions.text import html_to_text
from pulseboard.operators.dedupe import first_per_key
from pulseboard.operators.matching import Labels, explode_labels

# Look-back in days.
SNAPSHOT_DAYS, INCREMENTAL_DAYS = 30, 2


def select_labelled(raw: DataFrame, accounts: Labels, as_of: datetime,
                    back_days: int, per_label: int | None = None) -> DataFrame:
    """Messages of the look-back window with a known label.

    Adds ``received_date`` and ``account_name``; a message with several labels
    goes to the one listed first. Asked for ``per_label``, only the newest so
    many of each label are taken, before that.

    The choice reads ids, labels and dates only; bodies, the bulk of the data,
    are neither read nor sorted for it, and fetched by id.
    """
    narrow = raw.select(
        "id", "labelIds",
        parse_mail_date(m.header(F.col("headers"), "date"), now(as_of)).alias("received_date"))
    fresh = narrow.where(F.col("received_date") >= now(as_of) - days(back_days))
    # copies take one place, not two
    hits = explode_labels(fresh, "labelIds", accounts, "id", "received_date").distinct()
    if per_label is not None:
        hits = first_per_key(hits, "_hit.ord",
                             [F.col("received_date").desc(), F.col("id")], limit=per_label)
    best = F.min_by(F.struct(F.col("_hit.account").alias("account_name"), "received_date"),
                    F.struct("_hit.ord", F.col("received_date")))
    chosen = hits.groupBy("id").agg(best.alias("_best")).select("id", "_best.*")
    # a message delivered more than once in this landing is stored once
    copies = raw.join(chosen, "id")
    content = F.xxhash64("threadId", "snippet", F.to_json("payload"))
    return first_per_key(copies, "id", [F.array_join("labelIds", ",").desc_nulls_last(), content])


def to_emails(selected: DataFrame, own_address: str, as_of: datetime,
              body_width: int | None = None) -> DataFrame:
    """Selected messages to typed bronze rows, with whole texts.

    A ``body_width`` cuts the stored body, after it was decoded and cleaned whole.
    """
    headers = F.col("headers")
    sender = F.coalesce(m.header(headers, "from"), F.lit(""))
    subject = m.header(headers, "subject")
    return selected.select(
        F.col("id").alias("message_id"), F.col("threadId").alias("thread_id"),
        "account_name", F.col("account_name").alias("customer_label"),
        m.address_of(sender).alias("from_email"), m.sender_name(sender).alias("from_name"),
        m.recipients(m.header(headers, "to")).alias("to_emails"),
        m.recipients(m.header(headers, "cc")).alias("cc_emails"),
        F.coalesce(subject, F.lit(m.NO_SUBJECT)).alias("subject"),
        F.coalesce(F.col("snippet"), F.lit("")).alias("body_snippet"),
        html_to_text(m.first_plain_text(F.col("payload")), body_width).alias("body_text"),
        "received_date", F.col("labelIds").alias("labels"),
        F.coalesce(F.array_contains("labelIds", "UNREAD"), F.lit(False)).alias("is_unread"),
        m.needs_response(sender, subject, own_address).alias("needs_response"),
        m.has_attachment(F.col("payload")).alias("has_attachment"),
        now(as_of).alias("_extracted_at"))


def emails_snapshot(raw: DataFrame, accounts: Labels, own_address: str,
                    as_of: datetime, back_days: int = SNAPSHOT_DAYS,
                    body_width: int | None = None) -> DataFrame:
    """Full snapshot: the labelled messages of the window."""
    return to_emails(select_labelled(raw, accounts, as_of, back_days), own_address, as_of,
                     body_width)


def newest_per_label(raw: DataFrame, accounts: Labels, own_address: str,
                     as_of: datetime, per_label: int,
                     back_days: int = SNAPSHOT_DAYS) -> DataFrame:
    """The newest ``per_label`` messages of every label."""
    return to_emails(select_labelled(raw, accounts, as_of, back_days, per_label),
                     own_address, as_of)


def emails_incremental(raw: DataFrame, accounts: Labels, own_address: str,
                       as_of: datetime, back_days: int = INCREMENTAL_DAYS,
                       body_width: int | None = None) -> DataFrame:
    """One incremental run: two days back, of which one is a safety overlap."""
    return emails_snapshot(raw, accounts, own_address, as_of, back_days, body_width)
