"""Parent-child closure over a folder table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.session import shared_dir


def root_children_closure(folders: DataFrame, root_id: str) -> DataFrame:
    """For every folder below ``root_id``: which child of the root it is under.

    ``folders`` has ``id`` (unique), ``parent``. Returns ``id``, ``top``.

    Pointer doubling: every folder points at an ancestor, and each round
    replaces the pointer by that ancestor's own pointer, so a tree of depth d
    needs log2(d) joins of the folder table with itself rather than d of them.
    The walk stops when a round resolves no further folder; folders that never
    reach the root (detached or in a cycle) stay unresolved and are left out.
    Rounds are cut with reliable checkpoints, so a lost executor costs one
    round at most. The lookup side has one row per id, so a folder with very
    many children skews only the probing side, which adaptive execution splits.
    """
    shared_dir(folders.sparkSession)
    is_top = F.col("parent") == root_id
    links = folders.where(F.col("id") != root_id).select(
        "id", F.when(is_top, F.col("id")).otherwise(F.col("parent")).alias("up"),
        is_top.alias("done")).checkpoint()
    resolved = links.where("done").count()
    while True:
        above = links.select(F.col("id").alias("up"), F.col("up").alias("_up"),
                             F.col("done").alias("_done"))
        pending = links.where(~F.col("done")).join(above, "up").select(
            "id", F.col("_up").alias("up"), F.col("_done").alias("done"))
        links = links.where("done").unionByName(pending).checkpoint()
        now_resolved = links.where("done").count()
        if now_resolved == resolved:
            return links.where("done").select("id", F.col("up").alias("top"))
        resolved = now_resolved
