"""Table writers and the run log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from pulseboard.operators.quality import require_schema
from pulseboard.schemas import QUARANTINE, RUN_LOG
from pulseboard.sources.landing import BAD_RECORD
from pulseboard.sources.versions import exists


Observe = Callable[[DataFrame], DataFrame]

GOOD, BAD = "rejected=false", "rejected=true"  # parts of a landed table


def write_snapshot(df: DataFrame, path: str, observe: Observe = lambda d: d) -> None:
    """Materialise a full snapshot, replacing the previous one."""
    observe(df).write.mode("overwrite").parquet(path)


def replace_staging(df: DataFrame, path: str, schema) -> None:
    """Replace a staging table by rows of exactly the declared columns."""
    write_snapshot(require_schema(df, schema), path)


def write_clustered(df: DataFrame, path: str, *columns: str,
                    observe: Observe = lambda d: d) -> None:
    """Snapshot laid out by range, so that readers skip files and row groups.

    Ranges are over all given columns together: an account with very many rows
    is cut by the following column instead of filling one file. The layout runs
    its input once more to find the ranges, so rows are observed above it.
    """
    laid_out = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    observe(laid_out).write.mode("overwrite").parquet(path)


def log_line(spark: SparkSession, log_path: str, source: str, status: str, rows: int,
             started: datetime, seconds: float, detail: str | None = None, rejected: int = 0,
             late: int = 0) -> None:
    """Append one line to the run log."""
    line = (uuid.uuid4().hex, source, status, rows, started, seconds, detail, rejected, late)
    spark.createDataFrame([line], RUN_LOG).coalesce(1).write.mode("append").parquet(log_path)


def write_landed(df: DataFrame, source: str, path: str, log_path: str, landed_at: datetime,
                 mode: str = "error") -> None:
    """Write parsed records and, beside them, those that could not be read.

    Both come from one pass: the unreadable ones are a partition of their own, with their
    text. Both are counted as they are written, and the counts go to the run log.
    """
    observation, bad = Observation(), F.col(BAD_RECORD).isNotNull()
    started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
    (df.observe(observation, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("bad"))
     .select("*", F.when(bad, F.lit(source)).alias("_source"),
             F.when(bad, F.lit(landed_at)).cast("timestamp_ntz").alias("_landed_at"),
             bad.alias("rejected"))
     .write.mode(mode).partitionBy("rejected").parquet(path))
    counts = observation.get
    log_line(df.sparkSession, log_path, source, "SUCCESS", counts["rows"], started,
             time.monotonic() - clock, rejected=counts["bad"])


def _part(spark: SparkSession, paths: Sequence[str], part: str, schema) -> DataFrame:
    """One part of landed tables; a table without such records has no folder for it."""
    found = [f"{path}/{part}" for path in paths if exists(spark, f"{path}/{part}")]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame(
        [], schema)


def read_landed(spark: SparkSession, schema, *paths: str) -> DataFrame:
    """The records of landed tables that could be read."""
    return _part(spark, paths, GOOD, schema)


def read_quarantine(spark: SparkSession, *paths: str) -> DataFrame:
    """The records of landed tables that could not: source, text, time of landing."""
    kept = StructType([StructField("_source", StringType()), StructField(
        BAD_RECORD, StringType()), StructField("_landed_at", TimestampNTZType())])
    return _part(spark, paths, BAD, kept).toDF(*QUARANTINE.names)


def logged_write(df: DataFrame, source: str, write: Callable[[DataFrame, Observe], None],
                 log_path: str) -> None:
    """Run ``write(df, observe)`` and append one line about it to the run log.

    The writer applies ``observe`` last, so rows are counted once, as they are
    written, not by a second pass. Of a frame
    read with ``read_landed_json``, unreadable lines are not written but their
    number is noted. A failed write is logged as FAILED and raised again.
    """
    spark = df.sparkSession
    observation = Observation()
    bad = F.col(BAD_RECORD).isNotNull() if BAD_RECORD in df.columns else F.lit(False)

    def observe(rows: DataFrame) -> DataFrame:
        return (rows.observe(observation, F.count_if(~bad).alias("rows"),
                             F.count_if(bad).alias("bad")).where(~bad).drop(BAD_RECORD))

    started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()

    def log(status: str, rows: int, detail: str | None, rejected: int = 0) -> None:
        log_line(spark, log_path, source, status, rows, started, time.monotonic() - clock,
                 detail, rejected)

    try:
        write(df, observe)
    except Exception as error:
        log("FAILED", 0, str(error))
        raise
    counts = observation.get
    log("SUCCESS", counts["rows"],
        f"{counts['bad']} unreadable records" if counts["bad"] else None, counts["bad"])


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)
