"""Stand-in inputs: every record family derived from the shared test tables.

The shared tables hold no mails, meetings or tasks, so each record family is a
deterministic mapping of a table, computed by Spark over the whole table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The run time used with the shared tables.
AS_OF = datetime(2024, 1, 31, 12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def unless(blank: Column, value: Column) -> Column:
    """``value``, or NULL where ``blank`` holds."""
    return F.when(~blank, value)


def versions(df: DataFrame, again: str) -> DataFrame:
    """Add ``v``: 0 for every row, and a second copy with 1 where ``again`` holds.

    Copies come from one scan rather than from a union of two.
    """
    return df.withColumn("v", F.expr(f"explode(if({again}, array(0, 1), array(0)))"))


def customer_name(key: str) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(text(key), 9, "0"))
