"""Layout along a space-filling curve, with bounds per file to skip by.

Rows sorted by (account, time) can be skipped by account, but hardly by time alone. Here the
columns are cut into ranges of their distinct values, the range numbers are interleaved bit
by bit, and rows are laid out along that curve, so that every file is narrow in all of the
columns. The commit lists each file with its bounds, and a reader opens only the files that
its conditions can meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseboard.sources.versions import PIECE, Versioned

BITS = 6  # a column is cut into 2^BITS ranges

Bounds = Mapping[str, tuple[object, object]]  # column to (lowest, highest), None for open


def cuts(df: DataFrame, column: str, bits: int = BITS) -> list:
    """Where the ranges of a column begin: at most 2^bits - 1 values.

    The distinct values alone are dealt into ranges, so a value that a third of the rows hold
    counts once, and its rows are split by the other columns.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = values.repartitionByRange(1 << bits, column)
    begins = (ranged.groupBy(F.spark_partition_id()).agg(F.min(column).alias("begin"))
              .select("begin").orderBy("begin").collect())
    return [r["begin"] for r in begins[1:]]


def range_number(column: str, begins: Sequence) -> Column:
    """How many ranges begin at or before the value; NULL counts as the lowest."""
    if not begins:
        return F.lit(0)
    sizes = [F.when(F.col(column) >= F.lit(b), 1).otherwise(0) for b in begins]
    # halves are added up first, so that the expression stays shallow
    while len(sizes) > 1:
        sizes = [reduce(Column.__add__, sizes[k:k + 2]) for k in range(0, len(sizes), 2)]
    return sizes[0]


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One number from the bits of several, the highest bits first."""
    places = []
    for bit in range(bits):
        for k, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            places.append(F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - k))
    return reduce(Column.bitwiseOR, places, F.lit(0).cast("long"))


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Position of a row on the curve over the given columns."""
    return interleaved([range_number(c, cuts(df, c, bits)) for c in columns], bits)


def _low(name: str) -> str:
    return f"low_{name}"


def _high(name: str) -> str:
    return f"high_{name}"


def file_bounds(table: Versioned, schema: StructType, folder: str,
                columns: Sequence[str]) -> DataFrame:
    """The files of a written folder as pieces: rows, and bounds of the given columns. Reads
    these columns alone; partial aggregation leaves one row per file and task."""
    written = table.spark.read.schema(schema).parquet(f"{table.base}/{folder}")
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    bounds = written.select(*columns, name.alias("_file")).groupBy("_file").agg(
        F.count("*").alias("rows"),
        *[f(c).alias(n) for c in columns
          for f, n in ((F.min, _low(c)), (F.max, _high(c)))],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])
    return bounds.withColumn(PIECE, F.concat(F.lit(f"{folder}/"), F.col("_file"))).drop("_file")


def write_curve(df: DataFrame, base: str, *columns: str, files: int | None = None,
                bits: int = BITS) -> Versioned:
    """A new version of the table, laid out along the curve over ``columns``.

    The ranges are over the key and the columns behind it, so a cell that holds very many
    rows is cut further. ``files`` is the number of files, Spark's own choice if None.
    """
    table = Versioned(df.sparkSession, base)
    after, folder = table.current(), table.new_folder()
    key = "_curve"
    keyed = df.withColumn(key, curve_key(df, columns, bits))
    by = [key, *columns]
    ranged = keyed.repartitionByRange(*([files] if files else []), *by)
    ranged.sortWithinPartitions(*by).drop(key).write.parquet(f"{base}/{folder}")
    table.commit(file_bounds(table, df.schema, folder, columns), after)
    return table


def _possible(bounds: Bounds) -> Column:
    test = F.lit(True)
    for column, (low, high) in bounds.items():
        if low is not None:
            test = test & (F.col(_high(column)) >= F.lit(low))
        if high is not None:
            test = test & (F.col(_low(column)) <= F.lit(high))
    return test


def skipping(table: Versioned, bounds: Bounds) -> DataFrame:
    """The files that can hold rows within all of the bounds (no NULL is within one)."""
    return table.pieces().where(F.coalesce(_possible(bounds), F.lit(False)))


def read_within(spark: SparkSession, base: str, schema: StructType, bounds: Bounds) -> DataFrame:
    """The rows within the bounds; files that cannot hold one are not opened."""
    table = Versioned(spark, base)
    test = F.lit(True)
    for column, (low, high) in bounds.items():
        if low is not None:
            test = test & (F.col(column) >= F.lit(low))
        if high is not None:
            test = test & (F.col(column) <= F.lit(high))
    return table.read(schema, skipping(table, bounds)).where(test)
