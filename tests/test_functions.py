"""Column helpers on awkward values."""

import base64
import json
import re
import time
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseboard.functions import classify, clock, mail, meetings
from pulseboard.functions import text as txt
from tests.conftest import AS_OF, column, one

RELAXED = settings(max_examples=8, deadline=None,
                   suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- time --------------------------------------------------------------------
def test_iso_forms(spark):
    got = column(spark, ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00",
                         "2024-01-02T03:04:05.250+0000", "2024-01-02", "2024-01", "bad", "", None],
                 clock.parse_iso)
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 1, 4, 5),
                   datetime(2024, 1, 2, 3, 4, 5, 250000), datetime(2024, 1, 2), None, None, None,
                   None]


def test_results_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
        assert one(spark, "2024-01-02T03:04:05+02:00", clock.parse_iso) == datetime(
            2024, 1, 2, 1, 4, 5)
        assert one(spark, "2024-01-02", clock.parse_iso) == datetime(2024, 1, 2)
        assert one(spark, "1704067200.5", clock.parse_epoch) == datetime(2024, 1, 1, 0, 0, 0, 500000)
        assert one(spark, "Tue, 02 Jan 2024 03:04:05 +0200", lambda c: clock.parse_mail_date(
            c, clock.now(AS_OF))) == datetime(2024, 1, 2, 1, 4, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_mail_dates(spark):
    got = column(spark, ["Tue, 2 Jan 2024 03:04:05 +0200", "2 Jan 2024 03:04:05 GMT",
                         "Tue, 02 Jan 2024 03:04:05 +0000 (UTC)", "02 Jan 2024 03:04 -0500",
                         "yesterday", "", None],
                 lambda c: clock.parse_mail_date(c, clock.now(AS_OF)))
    assert got == [datetime(2024, 1, 2, 1, 4, 5), datetime(2024, 1, 2, 3, 4, 5),
                   datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 8, 4), AS_OF, AS_OF, AS_OF]


def test_days(spark):
    assert column(spark, ["2024-02-30", "", None, "2024-02-03"],
                  lambda c: clock.parse_day(c).cast("string")) == [None, None, None, "2024-02-03"]
    assert column(spark, ["2024-01-30 23:00:00", "2024-02-01 00:00:00", None],
                  lambda c: clock.age_days(AS_OF, c.cast("timestamp_ntz"))) == [1, -1, None]


# ---- text --------------------------------------------------------------------
def test_blank_set_is_the_unicode_one(spark):
    text = " \xa0a\x85b \x1c\x0b c　\n"
    assert one(spark, text, txt.strip) == "a\x85b \x1c\x0b c"
    assert one(spark, text, txt.html_to_text) == "a b c"


@RELAXED
@given(st.lists(st.text(alphabet="ab<>/ \n\t\xa0 é", max_size=30), min_size=5, max_size=20))
def test_clean_texts_have_no_tags_or_blank_runs(spark, values):
    clean = column(spark, values, txt.html_to_text)
    assert column(spark, clean, txt.html_to_text) == clean
    for text in clean:
        assert "  " not in text and not set(text) & set("\n\t\xa0") and text == text.strip()
        assert not re.search("<[^>]+>", text)  # "<>>" is no tag
    lines = column(spark, values, txt.normalise_newlines)
    assert column(spark, lines, txt.normalise_newlines) == lines
    assert not any("\n\n\n" in text or text != text.strip() for text in lines)


def test_cleaning_by_example(spark):
    assert column(spark, ["<p>a <b>b</b></p>\n c", "a < b", "<>", "x<br/>\xa0y"],
                  txt.html_to_text) == ["a b c", "a < b", "<>", "x y"]
    assert column(spark, ["\n a\n\n\n\nb\n\nc \n", "a\nb"], txt.normalise_newlines) == [
        "a\n\nb\n\nc", "a\nb"]
    assert one(spark, "abcdefgh\n\n\n", lambda c: txt.normalise_newlines(c, 7)) == "abcdefg"


def test_base64url(spark):
    raw = "✓ ✋ ~?>".encode()
    padded = base64.urlsafe_b64encode(raw).decode()
    got = column(spark, [padded, padded.rstrip("="), base64.urlsafe_b64encode(raw[:-4] + b"\xff").decode(),
                         "!!", None], txt.b64url_to_text)
    assert got[:2] == [raw.decode()] * 2
    assert got[2] == (raw[:-4] + b"\xff").decode("utf-8", errors="replace")
    assert got[3:] == [None, None]


# ---- mail --------------------------------------------------------------------
ADDRESSES = ["User A <a@example.com>", '"Last, First" <b@example.com>', "c@example.com",
             "<d@example.com>", "e@example.com (Team E)", '"Last', 'First" <b@example.com>', ""]


# what is left of a name that a comma cut in two, and of an empty address
REST = ["Last", "First", ""]
REST_NAMES = ["Last", "First", ""]


def test_addresses_like_a_lenient_parser(spark):
    assert column(spark, ADDRESSES, mail.address_of) == [
        "a@example.com", "b@example.com", "c@example.com", "d@example.com", "e@example.com", *REST]
    assert column(spark, ADDRESSES, mail.sender_name) == [
        "User A", "Last, First", "c@example.com", "d@example.com", "Team E", *REST_NAMES]


def test_recipients_split_naively(spark):
    value = 'a@example.com, "Last, First" <b@example.com>, , c@example.com'
    assert one(spark, value, mail.recipients) == [
        "a@example.com", REST[0], REST[1], "c@example.com"]
    assert column(spark, [None, "", " , "], mail.recipients) == [[], [], []]


def test_last_header_wins(spark):
    kind = "array<struct<name:string,value:string>>"
    headers = [("Subject", "one"), ("To", "x"), ("SUBJECT", "two")]
    assert one(spark, headers, mail.headers_to_map, kind) == {"to": "x", "subject": "two"}
    assert one(spark, headers, lambda h: mail.header(h, "subject"), kind) == "two"
    assert one(spark, [], lambda h: mail.header(h, "subject"), kind) is None


def test_needs_response(spark):
    senders = ["a@example.com", "NoReply@example.com", "me@example.com", "x <alerts@example.com>", None]
    got = column(spark, senders, lambda c: mail.needs_response(c, F.lit("Hello"), "ME@example.com"))
    assert got == [True, False, False, False, True]
    subjects = ["Re: plan", "Service OUTAGE", "Invitation: sync", None]
    got = column(spark, subjects, lambda c: mail.needs_response(
        F.lit("a@example.com"), c, "me@example.com"))
    assert got == [True, False, False, True]


def _leaf(mime, text, **more):
    return {"mimeType": mime, "body": {"data": base64.urlsafe_b64encode(text.encode()).decode()},
            **more}


def _nested(depth):
    tree = _leaf("text/plain", f"deep {depth}")
    for _ in range(depth):
        tree = {"mimeType": "multipart/mixed", "parts": [_leaf("text/html", "no"), tree,
                                                         _leaf("text/plain", "late")]}
    return tree


def _wrapped(depth, tree):
    for _ in range(depth):
        tree = {"mimeType": "multipart/mixed", "parts": [tree]}
    return tree


def test_a_deep_mail_of_many_parts(spark):
    """10,000 leaves before the text, at a depth that the quick way does not reach."""
    many = [{"mimeType": "text/html", "body": {"data": "eA"}}] * 10000
    tree = {"mimeType": "multipart/mixed", "parts": [*many, _leaf("text/plain", "here")]}
    began = time.monotonic()
    got = column(spark, [json.dumps(_wrapped(9, tree))],
                 lambda c: mail.first_plain_text(F.parse_json(c)))
    assert got == ["here"] and time.monotonic() - began < 60


def test_first_plain_text_at_any_depth(spark):
    trees = [_leaf("text/plain", "root"), _nested(1), _nested(5), _nested(6), _nested(7),
             _nested(12), _leaf("text/html", "x"), {"mimeType": "multipart/mixed", "parts": []},
             {"parts": [_leaf("text/plain", ""), _leaf("text/plain", "second")]},
             {"mimeType": "text/plain", "parts": [_leaf("text/plain", "child")]},
             *[_wrapped(depth, {"mimeType": "text/plain", "body": {"data": "!!"},
                                "parts": [_leaf("text/plain", "child")]}) for depth in (2, 5, 12)]]
    got = column(spark, [json.dumps(t) for t in trees],
                 lambda c: mail.first_plain_text(F.parse_json(c)))
    assert got == ["root", "deep 1", "deep 5", "deep 6", "deep 7", "deep 12", "", "", "second",
                   "child", "", "", ""]


def test_attachments(spark):
    trees = [{"parts": [{"filename": ""}, {"filename": "a.pdf"}]}, {"parts": [{"filename": ""}]},
             {"parts": [{"parts": [{"filename": "deep.pdf"}]}]}, {"filename": "root.pdf"}]
    got = column(spark, [json.dumps(t) for t in trees],
                 lambda c: mail.has_attachment(F.parse_json(c)))
    assert got == [True, False, False, False]


# ---- calendar and chat ---------------------------------------------------------
def test_video_link_order_and_hosts(spark):
    got = column(spark, ["see HTTPS://ZOOM.us/j/1?x=2>", "https://zoom.us/my/1", None],
                 lambda c: meetings.video_link(c, F.lit("go to https://meet.google.com/abc \" x"),
                                               F.lit(None).cast("string")))
    assert got == ["HTTPS://ZOOM.us/j/1?x=2", "https://meet.google.com/abc",
                   "https://meet.google.com/abc"]


def test_attendees_round_trip(spark):
    kind = "array<struct<email:string,responseStatus:string,displayName:string>>"
    value = [("a@example.com", "accepted", "A|B"), ("b@example.com", None, None)]
    encoded = one(spark, value, meetings.encode_attendees, kind)
    assert encoded == ["a@example.com|accepted|A|B", "b@example.com||"]
    decoded = one(spark, encoded, meetings.decode_attendees, "array<string>")
    assert [tuple(d) for d in decoded] == [("a@example.com", "A|B", "accepted"),
                                           ("b@example.com", "", "")]
    assert one(spark, None, meetings.encode_attendees, kind) == []
    assert column(spark, ["x@Y.example.com", "a@b@c.D", "plain"], meetings.domain_of) == [
        "y.example.com", "c.d", "plain"]


def test_thread_reply(spark):
    assert column(spark, [None, "", "1.0", "2.0"], lambda c: meetings.is_thread_reply(
        c, F.lit("1.0"))) == [False, False, False, True]


# ---- classifiers: every branch and every unknown ---------------------------------
def test_revenue_tiers(spark):
    values = [1e6, 999_999.0, 5e5, 1e5, 99_999.0, 0.01, 0.0, -1.0, None]
    assert [t.split()[0] for t in column(spark, values, classify.revenue_tier, "double")] == [
        "Strategic", "Enterprise", "Enterprise", "Growth", "Emerging", "Emerging", "No", "No", "No"]


def test_stage_rank(spark):
    assert column(spark, ["U1", "U6", "u1", None, "Lost"], classify.stage_rank) == [1, 6, 99, 99, 99]


def test_mail_status(spark):
    rows = [(True, True, "2024-01-29 23:00:00"), (True, True, "2024-01-30 00:00:00"),
            (True, False, "2024-01-01 00:00:00"), (False, True, "2024-01-01 00:00:00"),
            (None, True, "2024-01-01 00:00:00"), (True, None, "2024-01-01 00:00:00"),
            (True, True, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, n boolean, u boolean, t string")
    got = df.select("i", classify.mail_status(F.col("n"), F.col("u"),
                                              F.col("t").cast("timestamp_ntz"), AS_OF).alias("s"))
    assert [r["s"] for r in got.orderBy("i").collect()] == [
        "URGENT", "PENDING", "READ_PENDING", "NO_ACTION", "NO_ACTION", "NO_ACTION", "PENDING"]


def test_timing(spark):
    starts = ["2024-01-31 11:59:59", "2024-01-31 12:00:00", "2024-02-07 11:59:59",
              "2024-02-07 12:00:00", "2024-03-01 12:00:00", None]
    assert column(spark, starts, lambda c: classify.timing_label(
        c.cast("timestamp_ntz"), AS_OF)) == [
        "PAST", "THIS_WEEK", "THIS_WEEK", "UPCOMING", "FUTURE", "FUTURE"]


def test_flags(spark):
    moments = ["2024-01-01 11:59:59", "2024-01-01 12:00:00", None]
    assert column(spark, moments, lambda c: classify.is_stale(c.cast("timestamp_ntz"), AS_OF)) == [
        True, False, False]
    moments = ["2024-01-31 12:00:00", "2024-03-01 12:00:00", "2024-03-01 12:00:01",
               "2024-01-31 11:59:59", None]
    assert column(spark, moments, lambda c: classify.due_within(
        c.cast("timestamp_ntz"), AS_OF)) == [True, True, False, False, False]


def test_engagement(spark):
    df = spark.createDataFrame([(0, 5, 0), (1, 0, 3), (2, 2, 0), (3, 0, 1), (4, 1, 0), (5, None, None)],
                               "i int, r int, x int")
    got = df.select("i", classify.engagement(F.col("r"), F.col("x")).alias("e")).orderBy("i").collect()
    assert [r["e"] for r in got] == ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
