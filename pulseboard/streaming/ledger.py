"""Histories behind a commit log: runs, full refreshes and compaction under readers.

A history is a versioned table whose pieces are the folders of its batches. Every batch of an
incremental run is committed as it is written; a full refresh collects its batches and
commits once, at its end, so readers go from the old rows to the new ones in one step.
Small pieces are merged into large ones by a commit too. A reader keeps the version that it
began with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseboard.sources.versions import PIECE, Versioned

# checkpoint: folder of what the generation has read; batch: the last one in the piece.
PIECES = f"{PIECE} string, checkpoint string, batch long, rows long"


def _written(table: Versioned, rows: DataFrame) -> tuple[str, int]:
    """A new folder with the rows, and their number, read from what was written."""
    folder = table.new_folder()
    rows.write.parquet(f"{table.base}/{folder}")
    return folder, table.spark.read.schema(rows.schema).parquet(f"{table.base}/{folder}").count()


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def run_incremental(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                    table: Versioned) -> int:
    """Append what is new and stop; returns the batches added.

    A batch that comes again after a failure, as its commit was made but not noted, is known
    by its number and skipped. Without a history it starts one.
    """
    listed = table.pieces()
    checkpoint = table.new_folder("checkpoint") if listed is None else listed.agg(
        F.max("checkpoint")).first()[0]
    added = []

    def step(batch: DataFrame, number: int) -> None:
        version, now = table.current(), table.pieces()
        last = None if now is None else now.agg(F.max("batch")).first()[0]
        if last is not None and number <= last:
            return
        folder, rows = _written(table, transform(batch))
        new = table.spark.createDataFrame([(folder, checkpoint, number, rows)], PIECES)
        table.commit(new if now is None else now.unionByName(new), version)
        added.append(number)

    _run(stream, step, f"{table.base}/{checkpoint}")
    return len(added)


def run_full(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
             table: Versioned) -> int:
    """Build the history anew from all that was ever landed, and switch to it at the end.

    It has a memory of its own of what was read, which later incremental runs go on with. A
    refresh that dies leaves the old history as it was.
    """
    version, checkpoint, pieces = table.current(), table.new_folder("checkpoint"), {}

    def step(batch: DataFrame, number: int) -> None:
        pieces[number] = _written(table, transform(batch))

    _run(stream, step, f"{table.base}/{checkpoint}")
    if pieces:
        table.commit(table.spark.createDataFrame(
            [(folder, checkpoint, number, rows) for number, (folder, rows) in pieces.items()],
            PIECES), version)
    return len(pieces)


def compact(table: Versioned, schema: StructType, small: int, target: int) -> int:
    """Merge the pieces of fewer than ``small`` rows into files of about ``target`` rows;
    returns how many pieces were merged. Nobody who reads is disturbed."""
    version, listed = table.current(), table.pieces()
    if listed is None:
        return 0
    few = listed.where(F.col("rows") < small)
    total = few.agg(F.count("*").alias("n"), F.sum("rows").alias("rows"),
                    F.max("batch").alias("batch"), F.max("checkpoint").alias("c")).first()
    if total["n"] < 2:
        return 0
    files = max(1, -(-total["rows"] // target))
    folder, rows = _written(table, table.read(schema, few).repartition(files))
    merged = table.spark.createDataFrame([(folder, total["c"], total["batch"], rows)], PIECES)
    table.commit(listed.where(F.col("rows") >= small).unionByName(merged), version)
    return total["n"]


def read(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """All rows of the newest version."""
    return Versioned(spark, base).read(schema)
