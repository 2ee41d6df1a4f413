"""Calendar and chat record helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts whose links count as video links.
VIDEO_LINK = (
    r'(?i)https?://(?:meet\.google\.com|zoom\.us/j|teams\.microsoft\.com)[^\s"<>]*'
)


def video_link(*fields: Column) -> Column:
    """First video link in the first field that has one."""
    return F.coalesce(*[F.nullif(F.regexp_extract(f, VIDEO_LINK, 0), F.lit("")) for f in fields])


def domain_of(address: Column) -> Column:
    return F.lower(F.substring_index(address, "@", -1))


def encode_attendees(attendees: Column) -> Column:
    """array<struct<email,responseStatus,displayName>> to ``email|status|name``."""
    def blank(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))
    encoded = F.transform(attendees, lambda a: F.concat_ws(
        "|", blank(a["email"]), blank(a["responseStatus"]), blank(a["displayName"])))
    return F.coalesce(encoded, F.array().cast("array<string>"))


def decode_attendees(encoded: Column) -> Column:
    """``email|status|name`` back to array<struct<email,name,response_status>>."""
    def decode(item: Column) -> Column:
        piece = F.split(item, r"\|", 3)
        return F.struct(F.get(piece, F.lit(0)).alias("email"), F.get(piece, F.lit(2)).alias("name"),
                        F.get(piece, F.lit(1)).alias("response_status"))
    return F.transform(encoded, decode)


def minutes_between(start: Column, end: Column) -> Column:
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds.cast("double") / F.lit(60.0))


def is_thread_reply(thread_ts: Column, own_ts: Column) -> Column:
    """Set, not empty and not the message itself."""
    return F.coalesce((thread_ts != "") & (thread_ts != own_ts), F.lit(False))


def reaction_names(reactions: Column) -> Column:
    names = F.transform(reactions, lambda r: r["name"])
    return F.coalesce(names, F.array().cast("array<string>"))
