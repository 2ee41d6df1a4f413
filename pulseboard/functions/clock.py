"""Time helpers built around one explicit run time.

All timestamps are UTC wall-clock TIMESTAMP_NTZ values, so results depend
neither on the session zone nor on when a stage happens to run (or re-run).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


# Zone words of mail dates.
ZONES = {"EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700",
         "MDT": "-0600", "PST": "-0800", "PDT": "-0700", "AST": "-0400", "ADT": "-0300"}


def now(as_of: datetime) -> Column:
    """The run time as a literal; a literal keeps range filters pushable."""
    return F.expr(f"TIMESTAMP_NTZ'{as_of:%Y-%m-%d %H:%M:%S.%f}'")


def today(as_of: datetime) -> Column:
    return F.expr(f"DATE'{as_of:%Y-%m-%d}'")


def days(n: int | Column) -> Column:
    return F.make_dt_interval(F.lit(n) if isinstance(n, int) else n)


def age_days(as_of: datetime, ts: Column) -> Column:
    """Whole days from ``ts`` to the run date; negative for the future."""
    return F.date_diff(today(as_of), ts.cast("date"))


def utc_ntz(instant: Column) -> Column:
    """Instant (TIMESTAMP) to UTC wall clock, whatever the session zone is."""
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))


def parse_iso(text: Column) -> Column:
    """ISO-8601 date or date-time to UTC; a missing zone means UTC; bad is NULL."""
    well_formed = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$")
    zoned = text.rlike(r"[T ].*(Z|[+-]\d{2}:?\d{2})$")
    return F.when(well_formed & zoned, utc_ntz(F.try_to_timestamp(text))).when(
        well_formed, text.try_cast("timestamp_ntz"))


def parse_epoch(text: Column) -> Column:
    """Epoch seconds as text (``"1704067207.179575"``) to UTC."""
    return utc_ntz(F.timestamp_seconds(text.try_cast("decimal(20,6)")))


def parse_mail_date(text: Column, fallback: Column) -> Column:
    """RFC 2822 date to UTC; anything unreadable becomes ``fallback``.

    The weekday is removed first because Spark does not parse weekday names;
    so is a trailing zone comment, and zone words become an offset. Years of two
    digits count from 2000 up to 49, else from 1900.
    """
    bare = F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*|\s*\([^)]*\)\s*$", "")
    bare = F.regexp_replace(bare, r"^\s*(\d{1,2} [A-Za-z]{3}) ([0-4]\d) ", "$1 20$2 ")
    bare = F.regexp_replace(bare, r"^\s*(\d{1,2} [A-Za-z]{3}) ([5-9]\d) ", "$1 19$2 ")
    numeric = F.regexp_replace(bare, r"\s+(GMT|UTC|UT|Z)$", " +0000")
    for word, offset in ZONES.items():
        numeric = F.regexp_replace(numeric, rf"\s+{word}$", f" {offset}")
    with_seconds = F.try_to_timestamp(numeric, F.lit("d MMM yyyy HH:mm:ss Z"))
    without = F.try_to_timestamp(numeric, F.lit("d MMM yyyy HH:mm Z"))
    return F.coalesce(utc_ntz(F.coalesce(with_seconds, without)), fallback)


def parse_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text to DATE; blank or bad is NULL."""
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyy-MM-dd")
