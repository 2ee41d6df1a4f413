"""Queries over raw payloads: landing, matching, parsing, sinks and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.catalog import Query, joined_arrays
from pulseboard.functions import clock, mail, meetings
from pulseboard.functions import text as txt
from pulseboard.hosts import AS_OF, bronze, payloads, table
from pulseboard.hosts.payloads import (ALIASES, KEYWORDS, LABELS, OWN_ADDRESS, PERSON, ROOT,
                                       SOURCE_ALIASES)
from pulseboard.operators import dedupe, matching
from pulseboard.schemas import CALENDAR_EVENT
from pulseboard.session import scratch_path
from pulseboard.sources import calendar, chat, crm, documents, landing
from pulseboard.sources import mail as mail_source
from pulseboard.sources import tasks


def _host(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return getattr(payloads, name)


def _on(host: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: joined_arrays(build(_host(host)(spark, sf_dir)))


def _on_table(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: joined_arrays(build(table(spark, sf_dir, name)))


def calendar_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar events landed as JSON lines and read with their schema."""
    path = scratch_path(spark, "calendar")
    payloads.calendar_events(spark, sf_dir).write.text(path)
    return landing.read_landed_json(spark, path, CALENDAR_EVENT)


def calendar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events read from JSON documents in a column."""
    document = landing.from_json_text(F.col("doc"), CALENDAR_EVENT)
    return payloads.calendar_events(spark, sf_dir).select(document.alias("e")).select("e.*")


# ---- landing -----------------------------------------------------------------
def src_use_cases_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm.flatten_use_cases(payloads.crm_use_cases(spark, sf_dir),
                                 payloads.crm_accounts(spark, sf_dir), PERSON, AS_OF)


def src_calendar_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_arrays(calendar.calendar_snapshot(
        calendar_payloads(spark, sf_dir), KEYWORDS, AS_OF))


def src_chat_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_arrays(chat.chat_snapshot(
        payloads.chat_channels(spark, sf_dir), payloads.chat_messages(spark, sf_dir),
        KEYWORDS, AS_OF))


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON documents in a column."""
    flat = calendar.flatten_events(calendar_events(spark, sf_dir), AS_OF)
    return joined_arrays(flat.drop("_text", "_addresses", "_extracted_at"))


# ---- matching ----------------------------------------------------------------
def match_keywords_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary of all words of all part names, in order of appearance."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    words = (parts.select("p_partkey", F.explode(F.split("p_name", " ")).alias("keyword"))
             .groupBy("keyword").agg(F.min("p_partkey").alias("_first")))
    dictionary = words.select(F.struct("_first", "keyword").alias("ord"),
                              F.concat(F.lit("Account "), "keyword").alias("account"), "keyword")
    return matching.match_keywords_join(parts, "p_partkey", "p_name", dictionary)


def src_tasks_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks against a dictionary table: all words of all benchmark passages from four letters."""
    words = (table(spark, sf_dir, "benchmark")
             .select("item_id", F.explode(F.split("text", " ")).alias("keyword"))
             .where(F.length("keyword") >= 4)
             .groupBy("keyword").agg(F.min("item_id").alias("_first")))
    dictionary = words.select(F.struct("_first", "keyword").alias("ord"),
                              F.concat(F.lit("Account "), "keyword").alias("account"), "keyword")
    return tasks.tasks_snapshot(payloads.task_pages(spark, sf_dir), dictionary, AS_OF)


def src_email_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails against a label table: one label for each customer."""
    labels = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ord"), F.concat(F.lit("Label_"), "c_custkey").alias("label"),
        F.col("c_name").alias("account"))
    return joined_arrays(mail_source.emails_snapshot(
        payloads.mail_messages(spark, sf_dir), labels, OWN_ADDRESS, AS_OF))


def match_attendee_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses = F.transform("attendees", lambda a: F.coalesce(a["email"], F.lit("")))
    return calendar_events(spark, sf_dir).select(
        "id", matching.match_attendee_domain(addresses, KEYWORDS).alias("account"))


def _dedupe(latest: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        emails = bronze.emails(spark, sf_dir).select(
            "message_id", "is_unread", "received_date", "_extracted_at")
        return latest(emails, "message_id", tie_by=("received_date", "is_unread"))
    return query


# ---- parsing -----------------------------------------------------------------
def _header(name: str) -> F.Column:
    return mail.header(F.col("headers"), name)


def headers_to_map(messages: DataFrame) -> DataFrame:
    entries = F.map_entries(mail.headers_to_map(F.col("headers")))
    lines = F.array_sort(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])))
    return messages.select("id", lines.alias("headers"))


def normalise_text(docs: DataFrame) -> DataFrame:
    spaced = F.regexp_replace("text", "\n", "\n\n\n\n")
    return docs.select("doc_id", txt.normalise_newlines(spaced).alias("clean_text"),
                       txt.normalise_newlines(spaced, txt.STORED_TEXT).alias("stored_text"))


def extract_link(pages: DataFrame) -> DataFrame:
    key = F.col("page_id")
    number = key.cast("string")
    location = F.when(key % 3 == 0, F.concat(F.lit("Room HTTPS://Zoom.us/j/"), number,
                                             F.lit("?pwd=x")))
    description = F.concat(F.col("html"), F.when(key % 3 == 1, F.concat(
        F.lit('<a href="https://meet.google.com/'), number, F.lit('">'))).otherwise(""))
    conference = F.when(key % 5 != 0, F.concat(F.lit("https://teams.microsoft.com/l/"), number))
    return pages.select("page_id", meetings.video_link(location, description, conference).alias(
        "video_link"))


def attendees_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = calendar_events(spark, sf_dir).select(
        "id", meetings.encode_attendees(F.col("attendees")).alias("encoded"))
    decoded = encoded.withColumn("_d", meetings.decode_attendees(F.col("encoded")))
    return joined_arrays(decoded.select(
        "id", "encoded", F.col("_d.email").alias("emails"), F.col("_d.name").alias("names"),
        F.col("_d.response_status").alias("statuses")))


def parse_iso_ts(orders: DataFrame) -> DataFrame:
    key, moment = F.col("o_orderkey"), F.col("o_orderdate")

    def stamp(shift: int) -> F.Column:
        return F.date_format(moment + F.make_dt_interval(F.lit(0), F.lit(shift)),
                             "yyyy-MM-dd'T'HH:mm:ss")
    texts = (F.when(key % 6 == 0, F.concat(stamp(0), F.lit("Z")))
             .when(key % 6 == 1, F.concat(stamp(2), F.lit("+02:00")))
             .when(key % 6 == 2, F.concat(stamp(0), F.lit(".000+0000")))
             .when(key % 6 == 3, F.date_format(moment, "yyyy-MM-dd"))
             .when(key % 6 == 4, "next week"))
    return orders.select("o_orderkey", clock.parse_iso(texts).alias("parsed"))


def parse_epoch_ts(events: DataFrame) -> DataFrame:
    return events.select("event_id", clock.parse_epoch(payloads.epoch_text(F.col("ts"))).alias(
        "parsed"))


def chat_flags(messages: DataFrame) -> DataFrame:
    return chat.flatten_messages(messages, AS_OF).select(
        "message_ts", "channel_id", "user_id", "is_reply", "reply_count", "reactions")


RECORDS: dict[str, Query] = {
    "src_accounts_flatten": _on("crm_accounts", lambda d: crm.flatten_accounts(d, PERSON, AS_OF)),
    "src_use_cases_semi": src_use_cases_semi,
    "src_email_snapshot": _on("mail_messages", lambda d: mail_source.emails_snapshot(
        d, LABELS, OWN_ADDRESS, AS_OF)),
    "src_email_newest": _on("mail_messages", lambda d: mail_source.newest_per_label(
        d, LABELS, OWN_ADDRESS, AS_OF, per_label=25)),
    "src_calendar_snapshot": src_calendar_snapshot,
    "src_chat_snapshot": src_chat_snapshot,
    "src_tasks_snapshot": _on("task_pages", lambda d: tasks.tasks_snapshot(d, KEYWORDS, AS_OF)),
    "src_tasks_dictionary": src_tasks_dictionary,
    "src_email_labels": src_email_labels,
    "src_folder_walk": _on("drive_files", lambda d: documents.folder_documents(
        d, ROOT, ALIASES, AS_OF)),
    "match_keywords_expr": _on_table("part", lambda d: d.select(
        "p_partkey", "p_name",
        matching.match_keywords(F.col("p_name"), KEYWORDS).alias("account"))),
    "match_keywords_join": match_keywords_join,
    "match_labels": _on("mail_messages", lambda d: d.select(
        "id", matching.match_labels(F.col("labelIds"), LABELS).alias("account"))),
    "match_attendee_domain": match_attendee_domain,
    "match_alias_fallback": _on_table("documents", lambda d: d.select(
        "doc_id", "source",
        matching.match_alias(F.col("source"), SOURCE_ALIASES).alias("account"))),
    "dedupe_latest_window": _dedupe(dedupe.latest_per_key),
    "dedupe_latest_agg": _dedupe(dedupe.latest_per_key_agg),
    "classify_needs_response": _on("mail_messages", lambda d: d.select(
        "id", mail.needs_response(_header("from"), _header("subject"), OWN_ADDRESS).alias(
            "needs_response"))),
    "headers_to_map": _on("mail_messages", headers_to_map),
    "parse_address": _on("mail_messages", lambda d: d.select(
        "id", mail.address_of(_header("from")).alias("from_email"),
        mail.sender_name(_header("from")).alias("from_name"))),
    "parse_recipients": _on("mail_messages", lambda d: d.select(
        "id", mail.recipients(_header("to")).alias("to_list"),
        mail.recipients(_header("cc")).alias("cc_list"))),
    "parse_mail_date": _on("mail_messages", lambda d: d.select(
        "id", clock.parse_mail_date(_header("date"), clock.now(AS_OF)).alias("received_date"))),
    "mime_first_text": _on("mail_bodies", lambda d: d.select(
        "doc_id", mail.first_plain_text(F.col("payload")).alias("body"))),
    "b64url_decode": _on("mail_bodies", lambda d: d.select(
        "doc_id", txt.b64url_to_text(F.col("data")).alias("decoded"))),
    "html_to_text": _on_table("pages", lambda d: d.select(
        "page_id", txt.html_to_text(F.col("html")).alias("clean_text"),
        txt.html_to_text(F.col("html"), txt.STORED_TEXT).alias("stored_text"))),
    "normalise_text": _on_table("documents", normalise_text),
    "array_flags": _on("mail_messages", lambda d: d.select(
        "id", mail.has_attachment(F.col("payload")).alias("has_attachment"),
        F.array_contains("labelIds", "UNREAD").alias("is_unread"))),
    "extract_link": _on_table("pages", extract_link),
    "attendees_encode_decode": attendees_encode_decode,
    "parse_iso_ts": _on_table("orders", parse_iso_ts),
    "parse_epoch_ts": _on_table("events", parse_epoch_ts),
    "chat_flags": _on("chat_messages", chat_flags),
    "json_flatten": json_flatten,
}
