"""Helpers that several operators share: input, text passes in Arrow batches, stored steps."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pulseboard.session import scratch_path

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "binary": pa.binary(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()),
         "array<int>": pa.list_(pa.int32())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, rows: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in order, halved until a part has at most ``rows`` rows and ``most_bytes``
    bytes; a single row may be larger. Slicing copies nothing."""
    n = batch.num_rows
    if n <= rows and (n <= 1 or batch.nbytes <= most_bytes):
        if n:
            yield batch
    else:
        yield from slices(batch.slice(0, n // 2), rows, most_bytes)
        yield from slices(batch.slice(n // 2), rows, most_bytes)


def map_batches(df: DataFrame, step: Callable[[], Callable], fields: dict[str, str],
                rows: int = 512, most_bytes: int = 8 << 20) -> DataFrame:
    """Run a vectorised step over a frame, a few hundred rows at a time.

    ``step()`` is called once per task and gives a function from a record batch to a
    dict of columns. Spark's batches may hold thousands of long texts; slicing them by
    rows and bytes bounds what becomes Python objects at once. What Arrow freed goes back
    to the system after each batch, as workers are reused by later stages.
    """
    schema = pa.schema([(name, ARROW[kind]) for name, kind in fields.items()])

    def run(batches):
        work = step()
        for batch in batches:
            for part in slices(batch, rows, most_bytes):
                out = work(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in schema], schema=schema)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in fields.items()))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: lineage ends here, a lost
    executor costs no more than its own tasks, and Spark knows the size when it plans.
    The shuffle files of the step are of no use after that and are removed at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def worker_memory() -> dict:
    """What outlives a task in a reused Python worker, such as a loaded vocabulary."""
    name = "pulseboard_worker_memory"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))
