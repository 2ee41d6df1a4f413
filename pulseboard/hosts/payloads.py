"""Raw payloads, as an API would deliver them, derived from the shared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.functions.clock import days, now, today
from pulseboard.hosts import AS_OF, customer_name, table, text, unless, versions
from pulseboard.sources.documents import DOCUMENT, FOLDER

# Synthetic dictionaries and addresses.
KEYWORDS = (("Account A", ("ring", "gear")), ("Account B", ("widget",)),
            ("Account C", ("bolt", "rod")))
LABELS = {f"Label_{i}": f"Account {'ABCDEFGHI'[i]}" for i in range(9)}
ALIASES = (("Ring Works", ("ring",)), ("Gear Works", ("gear",)))
SOURCE_ALIASES = (("Source One", ("SRC1",)), ("Source Five", ("src5",)))
OWN_ADDRESS = "owner@example.com"
PERSON = "p3@example.com"
ROOT = "F0"


def _n(expr: Column) -> Column:
    return expr.cast("string")


def _say(*parts: object) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def b64url(value: Column, padded: Column | bool = False) -> Column:
    encoded = F.replace(F.replace(F.base64(F.encode(value, "utf-8")), F.lit("+"), F.lit("-")),
                        F.lit("/"), F.lit("_"))
    bare = F.rtrim(encoded, F.lit("="))
    return bare if padded is False else F.when(padded, encoded).otherwise(bare)


def _leaf(mime: str, data: Column, filename: str | None = None) -> Column:
    fields = [F.lit(mime).alias("mimeType"), F.struct(data.alias("data")).alias("body")]
    if filename is not None:
        fields.append(F.lit(filename).alias("filename"))
    return F.to_json(F.struct(*fields))


def _node(mime: str, *parts: Column) -> Column:
    return _say(f'{{"mimeType":"{mime}","parts":[', F.concat_ws(",", *parts), "]}")


def events_between(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...],
                   since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Events of some kinds, optionally of a half-open time span."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds))
    if since is not None:
        events = events.where(F.col("ts") >= since)
    return events if until is None else events.where(F.col("ts") < until)


def mail_messages(spark: SparkSession, sf_dir: str, since: Column | None = None,
                  until: Column | None = None) -> DataFrame:
    """Clicks and views as messages with awkward headers and nested bodies."""
    key = F.col("event_id")
    events = events_between(spark, sf_dir, ("click", "view"), since, until)
    address = (F.when(key % 11 == 0, "No-Reply@example.com").when(key % 17 == 0, "OWNER@example.com")
               .otherwise(_say("u", _n(key % 13), "@example.com")))
    name = _say("User ", _n(key % 13))
    sender = (F.when(key % 4 == 0, _say('"', name, '" <', address, ">"))
              .when(key % 4 == 1, address)
              .when(key % 4 == 2, _say(name, " <", address, ">"))
              .otherwise(_say("<", address, ">")))

    def stamp(form: str, hours: int, zone: str) -> Column:
        local = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(hours))
        return _say(F.date_format(local, form), " ", zone)

    date = (F.when(key % 37 == 0, "not a date")
            .when(key % 41 == 1, stamp("EEE, dd MMM yyyy HH:mm:ss", -5, "EST"))
            .when(key % 41 == 2, stamp("EEE, d MMM yyyy HH:mm:ss", -7, "PDT"))
            .when(key % 41 == 3, stamp("dd MMM yyyy HH:mm:ss", 0, "GMT"))
            .when(key % 41 == 4, stamp("EEE, d MMM yy HH:mm:ss", 0, "+0000 (UTC)"))
            .otherwise(stamp("EEE, dd MMM yyyy HH:mm:ss", 2, "+0200")))
    subject = F.when(key % 8 == 0, "Updated Invitation: review").otherwise(
        _say("Question ", _n(key % 5)))

    def head(label: str, value: Column) -> Column:
        return F.struct(F.lit(label).alias("name"), value.alias("value"))

    headers = F.filter(F.array(
        head("From", sender),
        head("To", _say("a", _n(key % 5), '@example.com, "Last, First" <b@example.com>, ')),
        head("Cc", F.when(key % 2 == 1, "c@example.com (Team C)")),
        head("Date", date),
        head("Subject", F.when(key % 19 != 0, "Old subject")),
        head("SUBJECT", F.when(key % 19 != 0, subject))), lambda h: h["value"].isNotNull())
    plain = b64url(_say("<p>Hello ", F.col("props"), "</p>\n\n  bye "))
    html = b64url(_say("<b>", F.col("props"), "</b>"))
    tree = (F.when(key % 3 == 0, _leaf("text/plain", plain))
            .when(key % 3 == 1, _node("multipart/mixed", _leaf("text/html", html),
                                      _leaf("text/plain", plain, ""),
                                      _leaf("application/pdf", html, "f.pdf")))
            .otherwise(_node("multipart/mixed", _node("multipart/alternative",
                                                      _leaf("text/html", html),
                                                      _leaf("text/plain", plain)))))
    labels = F.array_compact(F.array(
        _say("Label_", _n(F.col("user_id") % 12)),
        F.when(key % 3 == 0, _say("Label_", _n(key % 9))),
        F.when(F.col("value") > 20, "UNREAD")))
    return events.select(
        text("event_id").alias("id"), _say(text("user_id"), "-", _n(key % 5)).alias("threadId"),
        labels.alias("labelIds"), F.col("props").alias("snippet"), headers.alias("headers"),
        F.parse_json(tree).alias("payload"))


def mail_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as MIME trees of four shapes."""
    key, body = F.col("doc_id"), b64url(F.col("text"), F.col("doc_id") % 2 == 0)
    other, none = b64url(F.lit("<b>other</b>")), F.lit("")
    tree = (F.when(key % 4 == 0, _leaf("text/plain", body))
            .when(key % 4 == 1, _node("multipart/alternative", _leaf("text/plain", body),
                                      _leaf("text/html", other)))
            .when(key % 4 == 2, _node(
                "multipart/mixed",
                _node("multipart/related", _node("multipart/alternative",
                                                 _leaf("text/html", other),
                                                 _leaf("text/plain", none),
                                                 _leaf("text/plain", body))),
                _leaf("text/plain", other), _leaf("application/pdf", other, "f.pdf")))
            .otherwise(_node("multipart/mixed", _leaf("text/plain", none),
                             _leaf("text/html", other))))
    return table(spark, sf_dir, "documents").select(
        "doc_id", body.alias("data"), F.parse_json(tree).alias("payload"))


def calendar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups as calendar events, one JSON document per row (``doc``)."""
    key = F.col("event_id")
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    begins = F.col("ts") + days((key % 6 * 16).cast("int"))

    def iso(moment: Column) -> Column:
        shifted = F.date_format(moment + F.make_dt_interval(F.lit(0), F.lit(2)),
                                "yyyy-MM-dd'T'HH:mm:ss")
        return F.when(key % 2 == 0, _say(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), "Z")).otherwise(
            _say(shifted, "+02:00"))

    def guest(email: str, response: str | None, name: str | None) -> Column:
        return F.struct(F.lit(email).alias("email"),
                        F.lit(response).cast("string").alias("responseStatus"),
                        F.lit(name).cast("string").alias("displayName"))

    guests = F.array(guest("a@example.com", "accepted", "A"),
                     guest("b@Gear.example.com", "declined", None),
                     guest("c@rod.example.com", None, "C"))
    all_day = key % 8 == 0
    summary = (F.when(key % 5 == 0, "Ring review").when(key % 5 == 4, "BOLT check")
               .when(key % 5 != 2, "Sync"))
    description = F.concat(
        F.col("props"), F.when(key % 7 == 0, " about the widget").otherwise(""),
        F.when(key % 4 == 1, _say(" join HTTPS://zoom.us/j/", _n(key), " now")).otherwise(""))
    event = F.struct(
        text("event_id").alias("id"), summary.alias("summary"), description.alias("description"),
        F.when(key % 6 == 0, "Room 1").alias("location"),
        F.when(key % 3 == 0, _say("https://meet.google.com/", _n(key))).alias("hangoutLink"),
        F.struct(F.when(~all_day, iso(begins)).alias("dateTime"),
                 F.when(all_day, F.date_format(begins, "yyyy-MM-dd")).alias("date")).alias("start"),
        F.struct(F.when(key % 23 == 0, "bad").otherwise(
            iso(begins + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30)))).alias(
                "dateTime")).alias("end"),
        unless(key % 10 == 9, F.slice(guests, F.lit(1), (key % 4).cast("int"))).alias("attendees"),
        F.lit("confirmed").alias("status"),
        unless(key % 19 == 0, F.struct(_say("u", _n(key % 13), "@example.com").alias(
            "email"))).alias("organizer"),
        _say("https://cal.example.com/", _n(key)).alias("htmlLink"))
    return events.select(F.to_json(event).alias("doc"))


def calendar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents, and broken copies of some: cut short, of a wrong type, no object."""
    docs = calendar_events(spark, sf_dir)
    number = F.get_json_object("doc", "$.id").cast("long")
    broken = (F.when(number % 29 == 0, F.expr("left(doc, length(doc) - 7)"))
              .when(number % 29 == 1, _say('{"id":"', _n(number), '","start":7}'))
              .when(number % 29 == 2, _say('"id":"', _n(number), '"')))
    return docs.select(F.explode(F.array_compact(F.array("doc", broken))).alias("doc"))


def epoch_text(ts: Column) -> Column:
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)
    return _say(_n(F.floor(micros / F.lit(1_000_000)).cast("long")), ".",
                F.lpad(_n(micros % 1_000_000), 6, "0"))


def chat_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("number")
    purpose = (F.when(number % 4 == 0, "ring gear team").when(number % 4 == 1, "Widget launch")
               .when(number % 4 == 3, "misc"))
    return (table(spark, sf_dir, "events").select((F.col("user_id") % 30).alias("number"))
            .distinct()
            .select(number.cast("int").alias("ord"), _say("C", _n(number)).alias("id"),
                    _say("chan-", _n(number)).alias("name"),
                    F.struct(purpose.alias("value")).alias("purpose")))


def chat_messages(spark: SparkSession, sf_dir: str, since: Column | None = None,
                  until: Column | None = None) -> DataFrame:
    """Purchases and errors; every ninth is also seen in a second channel."""
    key = F.col("event_id")
    events = events_between(spark, sf_dir, ("purchase", "error"), since, until)
    own = epoch_text(F.col("ts"))
    reactions = F.array(*[F.struct(F.lit(n).alias("name")) for n in "abc"])
    return versions(events, "event_id % 9 = 0").select(
        _say("C", _n((F.col("user_id") + F.col("v")) % 30)).alias("channel"), own.alias("ts"),
        F.when(key % 4 == 0, own).when(key % 4 == 1, "1704067200.000000")
        .when(key % 4 == 2, "").alias("thread_ts"),
        unless(key % 6 == 0, text("user_id")).alias("user"), F.lit("B1").alias("bot_id"),
        unless(key % 31 == 0, _say(F.col("event_type"), " ", F.col("props"))).alias("text"),
        unless(key % 5 == 0, (key % 8).cast("int")).alias("reply_count"),
        unless(key % 3 == 0, F.slice(reactions, F.lit(1), (key % 4).cast("int"))).alias("reactions"))


def task_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as task-list pages, each turn a task."""
    conv, turn = F.col("conv_id"), F.col("turn")
    due = F.date_format(F.date_add(today(AS_OF), (conv % 40 - 20).cast("int")), "yyyy-MM-dd")
    item = F.struct(
        _say(text("conv_id"), "-", text("turn")).alias("id"),
        F.when(turn > 0, _say(text("conv_id"), "-0")).otherwise(F.when(conv % 2 == 0, "")).alias(
            "parent"),
        F.col("text").alias("title"),
        unless(turn % 3 == 0, _say(F.col("role"), F.when(conv % 3 == 0, " Widget").otherwise(""))).alias(
            "notes"),
        F.when(turn == 5, "completed").when(turn != 4, "needsAction").alias("status"),
        unless(conv % 4 == 0, _say(due, "T00:00:00.000Z")).alias("due"),
        F.lit(None).cast("string").alias("updated"))
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.collect_list(item).alias("items"))
    return pages.select(_n(conv % 5).alias("id"), _say("List ", _n(conv % 5)).alias("title"),
                        "items")


def drive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a folder tree of fan-out ten, one document in each folder."""
    part, doc = F.col("p_partkey"), F.col("doc_id")
    blank = F.lit(None).cast("string")
    folders = table(spark, sf_dir, "part").select(
        _say("F", _n(part)).alias("id"), F.col("p_name").alias("name"),
        F.lit(FOLDER).alias("mimeType"), blank.alias("modifiedTime"),
        F.when(part > 0, _say("F", _n(F.floor(part / 10)))).alias("parent"), blank.alias("text"))
    kind = F.when(F.col("source") == "src7", "application/pdf").otherwise(DOCUMENT)
    spaced = F.regexp_replace("text", "\n", "\n\n\n\n")
    files = table(spark, sf_dir, "documents").select(
        _say("D", _n(doc)).alias("id"), _say("doc-", _n(doc)).alias("name"),
        kind.alias("mimeType"), F.lit("2024-01-15T10:00:00.000Z").alias("modifiedTime"),
        _say("F", _n(doc)).alias("parent"), spaced.alias("text"))
    return folders.unionByName(files)


def crm_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("Id"), F.col("c_name").alias("Name"),
        F.lit("Customer").alias("Type"), F.col("c_mktsegment").alias("Industry"),
        unless(key % 5 == 0, F.col("c_mktsegment")).alias("Vertical"),
        F.when(key % 9 == 0, 0.0).otherwise(F.col("c_acctbal") * 200).alias("Revenue"),
        (F.col("c_acctbal") * 50).alias("RevenueQuarter"),
        (key % 100).cast("int").alias("NumberOfEmployees"),
        F.lit(None).cast("string").alias("BillingCity"),
        F.lit(None).cast("string").alias("BillingState"),
        _say("N", text("c_nationkey")).alias("BillingCountry"),
        unless(key % 6 == 0, F.struct(_say("Owner ", _n(key % 20)).alias("Name"))).alias("Owner"),
        unless(key % 8 == 0, _say("P", _n(key % 7))).alias("EngagedId"),
        unless(key % 8 == 0, F.struct(_say("Person ", _n(key % 7)).alias("Name"),
                                      _say("p", _n(key % 7), "@example.com").alias(
                                          "Email"))).alias("Engaged"))


def crm_use_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    modified = now(AS_OF) - days((key % 90).cast("int"))
    day = F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(2)),
                        "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("Id"), _say("UC ", _n(key)).alias("Name"),
        text("o_custkey").alias("AccountId"),
        F.struct(customer_name("o_custkey").alias("Name")).alias("Account"),
        _say("U", _n(key % 6 + 1)).alias("Stage"), F.col("o_orderpriority").alias("Description"),
        F.col("o_orderstatus").alias("Type"), F.col("o_orderstatus").alias("Status"),
        F.when(key % 3 != 0, F.date_format(modified, "yyyy-MM-dd")).alias("GoLiveDate"),
        F.when(key % 5 == 0, "soon").when(key % 5 == 1, "").alias("EstimatedGoLive"),
        _say(F.date_format(modified, "yyyy-MM-dd'T'HH:mm:ss"), ".000+0000").alias(
            "LastModifiedDate"),
        _say(day, "+02:00").alias("CreatedDate"),
        _say("P", _n(key % 7)).alias("AssignedId"),
        unless(key % 4 == 0, F.struct(_say("Person ", _n(key % 7)).alias("Name"))).alias(
            "Assigned"))
