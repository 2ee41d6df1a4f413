"""Checks over tables: declared constraints and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def null_key_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows and NULL offenders for every declared NOT NULL column, one scan a table."""
    parts = []
    for name, (df, columns) in tables.items():
        counts = df.agg(F.count("*").alias("rows"), F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias(
                "null_rows")) for c in columns]).alias("_checks"))
        parts.append(counts.select(F.lit(name).alias("table_name"), "rows",
                                   F.inline("_checks")))
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "column_name", "rows", "null_rows")


@dataclass(frozen=True)
class Constraints:
    """What a table declares: columns without NULL, its key, and columns whose values must
    be among those of another table's column."""

    not_null: Sequence[str] = ()
    key: str | None = None
    references: Sequence[tuple[str, DataFrame, str]] = ()


def constraint_failures(name: str, df: DataFrame, declared: Constraints) -> DataFrame:
    """(table_name, check, column_name, rows, failures) for every declared constraint.

    The table is scanned once: its rows meet what they refer to, are counted per key (a key
    with very many rows is one row before the shuffle), and the counts are added up. Values
    of a reference that are NULL refer to nothing and do not fail; rows beyond the first of
    a key fail uniqueness, NULL keys do not.

    Referenced values are distinct before the join, which Spark broadcasts if they are small
    by its own check, and else filters by what they may hold (runtime Bloom filter).
    """
    marked, tests = df, []
    for k, (column, other, theirs) in enumerate(declared.references):
        found = f"_found{k}"
        known = other.select(F.col(theirs).alias(found)).where(
            F.col(found).isNotNull()).distinct()
        marked = marked.join(known, F.col(column) == F.col(found), "left")
        tests.append(("reference", column, F.col(column).isNotNull() & F.col(found).isNull()))
    tests = [("not null", c, F.col(c).isNull()) for c in declared.not_null] + tests
    failed = [F.count_if(test).alias(f"_failed{k}") for k, (_, _, test) in enumerate(tests)]
    if declared.key is None:
        counts, again = marked.agg(F.count("*").alias("n"), *failed), F.lit(0)
    else:
        key = F.col(declared.key).alias("_key")
        counts = marked.groupBy(key).agg(F.count("*").alias("n"), *failed)
        again = F.sum(F.when(F.col("_key").isNotNull(), F.col("n") - 1).otherwise(0))
    failed = [F.sum(f"_failed{k}") for k in range(len(tests))]
    lines = [(check, column, total) for (check, column, _), total in zip(tests, failed)]
    if declared.key is not None:
        lines.append(("unique", declared.key, again))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.array(*[F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"),
                           F.coalesce(total, F.lit(0)).cast("long").alias("failures"))
                  for check, column, total in lines]).alias("_lines")).select(
        F.lit(name).alias("table_name"), "rows", F.inline("_lines")).select(
        "table_name", "check", "column_name", "rows", "failures")


def declared_keys(schema: StructType) -> list[str]:
    """Columns a schema declares NOT NULL."""
    return [f.name for f in schema if not f.nullable]


def require_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in order, refusing missing or mistyped ones.

    Nullability is data, not type: :func:`null_key_counts` looks at that.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = [f.name for f in schema if actual.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ValueError(f"columns missing or of another type: {', '.join(wrong)}")
    return df.select(*schema.names)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)`` per table, ordered by name."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")
