"""Keep one version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column],
                  limit: int = 1) -> DataFrame:
    """The first ``limit`` rows of every key in the given order.

    Spark turns the rank filter into a WindowGroupLimit that runs before the
    exchange as well: each map task ships at most ``limit`` rows per key, so
    a key with very many copies does not land in one task.
    """
    rank = "_rank"
    window = Window.partitionBy(*_columns(keys)).orderBy(*order)
    return (df.withColumn(rank, F.row_number().over(window))
            .where(F.col(rank) <= limit)
            .drop(rank))


def latest_per_key(df: DataFrame, keys: str | Sequence[str],
                   version: str = "_extracted_at", tie_by: Sequence[str] = ()) -> DataFrame:
    """Latest version of every key by ``version``.

    Equal versions would leave the choice open, and a retried task could then
    choose differently; ``tie_by`` names the columns that settle it. Keep it to
    columns the reader needs anyway, so that column pruning still works.
    """
    order = [F.col(c).desc_nulls_last() for c in (version, *tie_by)]
    return first_per_key(df, keys, order)


def latest_per_key_agg(df: DataFrame, keys: str | Sequence[str],
                       version: str = "_extracted_at", tie_by: Sequence[str] = ()) -> DataFrame:
    """Same result as :func:`latest_per_key`, as a ``max_by`` aggregate.

    Partial aggregation keeps one row per key and map task. The window form is
    the default; this one suits narrow rows.
    """
    key_names = _columns(keys)
    newest = F.max_by(F.struct(*df.columns), F.struct(version, *tie_by)).alias("_row")
    return df.groupBy(*key_names).agg(newest).select("_row.*")
