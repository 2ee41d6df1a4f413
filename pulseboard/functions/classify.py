"""Classifiers: thresholds and labels as parameters, plain CASE expressions out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseboard.functions.clock import age_days, days, now

# Revenue tiers (lower bound, label), highest first.
REVENUE_TIERS = (
    (1_000_000.0, "Strategic (≥$1M)"),
    (500_000.0, "Enterprise ($500K–$1M)"),
    (100_000.0, "Growth ($100K–$500K)"),
)
SMALL_REVENUE = "Emerging (<$100K)"
NO_REVENUE = "No ARR"

# Life-cycle stages in order, their groups, and the rank of any other.
STAGES = ("U1", "U2", "U3", "U4", "U5", "U6")
EARLY, MID, LIVE = STAGES[:2], STAGES[2:4], STAGES[4:]
OTHER_STAGE_RANK = 99


def rank_of(value: Column, ordered: Sequence[str], other: int) -> Column:
    """1-based position of ``value`` in ``ordered``, else ``other``."""
    expr = F
    for position, label in enumerate(ordered, start=1):
        expr = expr.when(value == label, F.lit(position))
    return expr.otherwise(F.lit(other))


def revenue_tier(revenue: Column) -> Column:
    expr = F
    for bound, label in REVENUE_TIERS:
        expr = expr.when(revenue >= bound, F.lit(label))
    return expr.when(revenue > 0, F.lit(SMALL_REVENUE)).otherwise(F.lit(NO_REVENUE))


def stage_rank(stage: Column) -> Column:
    return rank_of(stage, STAGES, OTHER_STAGE_RANK)


def is_stale(modified: Column, as_of: datetime, after_days: int = 30) -> Column:
    return F.coalesce(modified < now(as_of) - days(after_days), F.lit(False))


def due_within(due: Column, as_of: datetime, within_days: int = 30) -> Column:
    return F.coalesce(due.between(now(as_of), now(as_of) + days(within_days)), F.lit(False))


def mail_status(needs: Column, unread: Column, received: Column, as_of: datetime,
                urgent_days: int = 2) -> Column:
    """Unknown ``needs`` falls through to NO_ACTION."""
    return (F.when(needs & unread & (age_days(as_of, received) >= urgent_days), "URGENT")
            .when(needs & unread, "PENDING")
            .when(needs & ~unread, "READ_PENDING")
            .otherwise("NO_ACTION"))


def timing_label(start: Column, as_of: datetime, week: int = 7, month: int = 30) -> Column:
    """Unknown start falls through to FUTURE."""
    return (F.when(start < now(as_of), "PAST")
            .when(start < now(as_of) + days(week), "THIS_WEEK")
            .when(start < now(as_of) + days(month), "UPCOMING")
            .otherwise("FUTURE"))


def engagement(replies: Column, reactions: Column) -> Column:
    return (F.when((replies >= 5) | (reactions >= 3), "HIGH")
            .when((replies >= 2) | (reactions >= 1), "MEDIUM")
            .otherwise("LOW"))


def meeting_priority(timing: Column) -> Column:
    return F.when(timing == "THIS_WEEK", "HIGH").when(timing == "UPCOMING", "MEDIUM").otherwise("LOW")
