"""Append-only histories fed by Structured Streaming runs.

A run reads what is new in the landing folder, appends it and stops
(``availableNow``); the checkpoint remembers what was read. Re-delivered
records are expected and are resolved when the history is read: either exactly,
as the latest version per key, or by bounded state for messages that never
change.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseboard.operators.dedupe import latest_per_key
from pulseboard.plans.incremental import BUCKETS, Family, merge
from pulseboard.sources.landing import parsed
from pulseboard.sources.sinks import log_line, write_landed
from pulseboard.sources.versions import Versioned


def generation(base: str, number: int) -> tuple[str, str]:
    """Table and checkpoint folders of one generation of a history.

    An incremental run goes on with the current generation. A full refresh
    starts the next one: its rows and its memory of what was read begin anew,
    and readers of the current generation are not disturbed meanwhile.
    """
    return f"{base}/generation={number}/rows", f"{base}/generation={number}/checkpoint"


def read_landing(spark: SparkSession, path: str, schema: StructType,
                 files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the parquet files that arrive in a landing folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("recursiveFileLookup", "true").parquet(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str, source: str | None = None,
                  log_path: str | None = None) -> None:
    """Append everything new to the history, exactly once, and stop.

    With a run log, rows written and rows that a watermark dropped as late are noted there.
    """
    started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if log_path is not None:
        steps = [s for p in query.recentProgress for s in p.stateOperators]
        log_line(stream.sparkSession, log_path, source, "SUCCESS",
                 sum(p.numInputRows for p in query.recentProgress), started,
                 time.monotonic() - clock, late=sum(s.numRowsDroppedByWatermark for s in steps))


def append_batches(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                   path: str, checkpoint: str) -> None:
    """Like :func:`append_stream` for transformations a stream cannot express.

    Ranking per label, for instance, needs the whole batch. Each batch owns one
    folder of the history and overwrites it, so a batch that is repeated after
    a failure does not add its rows twice, whichever run repeats it: batch
    numbers grow over all runs of one checkpoint.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (transform(batch).write.mode("overwrite")
         .parquet(f"{path}/batch={batch_id}"))

    (stream.writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def land_batches(stream: DataFrame, text: str, schema: StructType, source: str, path: str,
                 checkpoint: str, log_path: str, landed_at: datetime) -> None:
    """Parse a stream of documents, keep what cannot be read aside, and log both counts.

    Each batch owns a folder and overwrites it, see :func:`append_batches`.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_landed(parsed(batch, text, schema), source, f"{path}/batch={batch_id}", log_path,
                     landed_at, mode="overwrite")

    (stream.writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def keep_newest(stream: DataFrame, table: Versioned, family: Family, source: str,
                checkpoint: str, log_path: str, buckets: int = BUCKETS) -> None:
    """Exact latest-wins over a stream: its state is the table of newest versions.

    Nothing is forgotten, however late a record comes. One that is older than the version
    kept for its key changes nothing; it is written aside and counted as late in the run
    log. A batch that is repeated after a failure leaves the same state.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
        done = merge(table, batch, family, buckets, whole=True, late_to=f"late/batch={batch_id}")
        log_line(table.spark, log_path, source, "SUCCESS", done.fresh_rows, started,
                 time.monotonic() - clock, late=done.late)

    (stream.writeStream.foreachBatch(step)
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_history(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All runs of a history; the run folders themselves add no columns."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def latest_history(history: DataFrame, keys: str | Sequence[str],
                   tie_by: Sequence[str] = ()) -> DataFrame:
    """Exact latest-wins view of a history; nothing is forgotten."""
    return latest_per_key(history, keys, tie_by=tie_by)


def distinct_stream(stream: DataFrame, keys: Sequence[str], event_time: str,
                    delay: str = "2 days") -> DataFrame:
    """First-wins dedupe with bounded state, for messages that never change.

    Not the same as :func:`latest_history`: state older than ``delay`` is
    dropped, and so are records that arrive later than that. Watermarks need an
    instant, so the wall-clock event time is carried as one while deduplicating.
    """
    clock = "_event_time"
    return (stream.withColumn(clock, F.col(event_time).cast("timestamp"))
            .withWatermark(clock, delay)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop(clock))
