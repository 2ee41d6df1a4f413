"""Incremental refresh: the newest version of every record, kept in buckets of keys.

A run reads only the rows extracted after the last one, brings them down to the newest
version of each key, and merges these into the buckets that they fall in; the other buckets
are neither read nor written. Silver and gold are then plain projections and counts over the
kept rows: nothing has to be de-duplicated again, and what depends on the run time (ages,
labels, scores) is computed for the run time that is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pulseboard.operators.dedupe import latest_per_key
from pulseboard.plans import gold, silver
from pulseboard.schemas import (ACCOUNTS, CHAT, DOCUMENTS, EMAILS, MEETINGS, TASKS, USE_CASES)
from pulseboard.sources.versions import PIECE, Versioned, remove

BUCKETS = 64  # files of a state; set it so that a bucket fits a task


@dataclass(frozen=True)
class Family:
    """How records of one kind are kept: key, last sort columns, what may be chosen at all."""

    schema: StructType
    key: str
    tie_by: tuple[str, ...]
    eligible: Callable[[DataFrame], DataFrame] = lambda rows: rows
    every_version: bool = False


FAMILIES = {
    "accounts": Family(ACCOUNTS, *silver.VERSIONS["accounts"]),
    "use_cases": Family(USE_CASES, *silver.VERSIONS["use_cases"]),
    "emails": Family(EMAILS, *silver.VERSIONS["emails"]),
    "meetings": Family(MEETINGS, *silver.VERSIONS["meetings"]),
    "chat": Family(CHAT, *silver.VERSIONS["chat"]),
    # A parent delivered twice doubles its children, so all open versions are kept.
    "tasks": Family(TASKS, *silver.VERSIONS["tasks"], silver.open_tasks, True),
    "documents": Family(DOCUMENTS, *silver.VERSIONS["documents"], silver.long_documents),
}


@dataclass(frozen=True)
class Merge:
    """What one run did to one state."""

    version: int | None
    fresh_rows: int  # newest of each key among what was delivered
    touched: int
    buckets: int
    late: int = 0  # of these, older than the version kept


def _newest(rows: DataFrame, family: Family) -> DataFrame:
    if family.every_version:
        return rows
    return latest_per_key(rows, family.key, tie_by=family.tie_by)


def merge(table: Versioned, raw: DataFrame, family: Family, buckets: int = BUCKETS,
          whole: bool = False, late_to: str | None = None) -> Merge:
    """Bring the state up to date with ``raw``, of which only rows newer than the last merge
    are read (rows of one extraction time are delivered together), or all if it is ``whole``
    new. Rows older than the version kept go to the folder ``late_to``, if one is named.

    Equal to choosing the newest versions among all rows ever delivered, as the order of
    versions is total. A key delivered very many times is reduced before it is shuffled.
    Rows without a key share one. An interrupted run changes nothing: the buckets it wrote
    are listed by the commit at its end only.
    """
    last, listed = table.current(), table.pieces()
    if listed is not None:
        head = listed.agg(F.max("mark").alias("mark"), F.max("of").alias("of")).first()
        buckets = head["of"]  # fixed by the first run
        if not whole:
            raw = raw.where(F.col("_extracted_at") > F.lit(head["mark"]))
    bucket = F.pmod(F.xxhash64(family.key), F.lit(buckets)).cast("int").alias("bucket")
    staged = f"{table.base}/{table.new_folder('fresh')}"
    (_newest(family.eligible(raw.select(*family.schema.names)), family).select("*", bucket)
     .write.parquet(staged))
    schema = StructType([*family.schema, StructField("bucket", IntegerType())])
    fresh = table.spark.read.schema(schema).parquet(staged)
    counted = fresh.groupBy("bucket").agg(F.count("*").alias("n"),
                                          F.max("_extracted_at").alias("mark")).collect()
    if not counted:
        return Merge(last, 0, 0, buckets)
    touched = [r["bucket"] for r in counted]  # at most ``buckets`` numbers
    rows = fresh.select(*family.schema.names)
    late = 0
    if listed is not None:
        kept = table.read(family.schema, listed.where(F.col("bucket").isin(touched)))
        if late_to is not None:  # keys are unique on both sides
            newer = kept.select(F.col(family.key).alias("_key"), F.col(
                "_extracted_at").alias("_kept_at"))
            rows.join(newer, F.col(family.key).eqNullSafe(F.col("_key"))).where(
                "_extracted_at < _kept_at").select(*family.schema.names).write.mode(
                "overwrite").parquet(f"{table.base}/{late_to}")
            late = table.spark.read.schema(family.schema).parquet(
                f"{table.base}/{late_to}").count()
        rows = _newest(rows.unionByName(kept), family)
    folder = table.new_folder()
    (rows.select("*", bucket).repartition(len(touched), "bucket")
     .write.partitionBy("bucket").parquet(f"{table.base}/{folder}"))
    mark = max([r["mark"] for r in counted] + ([] if listed is None else [head["mark"]]))
    pieces = table.spark.createDataFrame(
        [(f"{folder}/bucket={b}", b, buckets) for b in touched],
        f"{PIECE} string, bucket int, of int")
    if listed is not None:
        pieces = pieces.unionByName(listed.where(~F.col("bucket").isin(touched)).drop("mark"))
    version = table.commit(pieces.withColumn("mark", F.lit(mark)), last)
    remove(table.spark, staged)
    return Merge(version, sum(r["n"] for r in counted), len(touched), buckets, late)


def state(spark: SparkSession, base: str, name: str) -> Versioned:
    return Versioned(spark, f"{base}/{name}")


def refresh_states(raw: Mapping[str, DataFrame], base: str,
                   buckets: int = BUCKETS) -> dict[str, Merge]:
    """One incremental run over all record families."""
    return {name: merge(state(frame.sparkSession, base, name), frame, FAMILIES[name], buckets)
            for name, frame in raw.items()}


def tables(spark: SparkSession, base: str, as_of: datetime) -> dict[str, DataFrame]:
    """Silver and gold over the states, for the given run time. No record is de-duplicated
    again; the tier is joined once, to the finished timeline and where a table shows it."""
    rows = {name: state(spark, base, name).read(family.schema)
            for name, family in FAMILIES.items()}
    accounts = silver.accounts(rows["accounts"], newest=True)
    use_cases = silver.use_cases(rows["use_cases"], as_of, newest=True)
    emails = silver.emails_core(rows["emails"], as_of, newest=True)
    meetings = silver.calendar_core(rows["meetings"], as_of, newest=True)
    chat = silver.chat_core(rows["chat"], as_of, newest=True)
    return {
        "accounts": accounts, "use_cases": use_cases,
        "emails": silver.tiered("emails", emails, accounts),
        "calendar": silver.tiered("calendar", meetings, accounts),
        "chat": silver.tiered("chat", chat, accounts),
        "tasks": silver.tasks(rows["tasks"], as_of),
        "documents": silver.documents(rows["documents"], newest=True),
        "activity": gold.tiered_activity(gold.activity(emails, meetings, chat, as_of), accounts),
        "health": gold.health(accounts, use_cases, emails, meetings, chat),
    }
