"""Interval labels for folder trees, stored with the tree.

A folder's label is its way from the root, one step per folder. Everything below a folder
lies in one interval of labels, so the table is laid out by label with bounds per file: the
folders below one are a range scan, the child of the root that a folder is under is the first
step of its label, and a folder that moves has only its own subtree relabelled. The files
that hold none of it are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulseboard.session import shared_dir
from pulseboard.sources import layout
from pulseboard.sources.versions import PIECE, Versioned

TREE = StructType([StructField(n, StringType()) for n in ("id", "parent", "label")])


def step_of(folder: Column) -> Column:
    """An id as one step of a label: a slash in it is written otherwise."""
    return F.replace(F.replace(folder, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))


def id_of(step: Column) -> Column:
    return F.replace(F.replace(step, F.lit("%2F"), F.lit("/")), F.lit("%25"), F.lit("%"))


def labelled(folders: DataFrame, root_id: str) -> DataFrame:
    """(id, parent, label) of every folder below the root, by pointer doubling: each round
    puts the label of the folder pointed at before one's own. Detached folders and cycles
    have no label and are left out."""
    shared_dir(folders.sparkSession)
    links = folders.where((F.col("id") != root_id) & F.col("parent").isNotNull()).select(
        "id", "parent", F.col("parent").alias("up"), step_of(F.col("id")).alias("label"),
        (F.col("parent") == root_id).alias("done")).checkpoint()
    resolved = links.where("done").count()
    while True:
        above = links.select(F.col("id").alias("up"), F.col("up").alias("_up"),
                             F.col("label").alias("_label"), F.col("done").alias("_done"))
        pending = links.where(~F.col("done")).join(above, "up").select(
            "id", "parent", F.col("_up").alias("up"),
            F.concat_ws("/", "_label", "label").alias("label"), F.col("_done").alias("done"))
        links = links.where("done").unionByName(pending).checkpoint()
        now_resolved = links.where("done").count()
        if now_resolved == resolved:
            return links.where("done").select(*TREE.names)
        resolved = now_resolved


def build(folders: DataFrame, root_id: str, base: str, files: int | None = None) -> Versioned:
    """Label a tree and store it by label."""
    return layout.write_curve(labelled(folders, root_id), base, "label", files=files, bits=0)


def closure(tree: DataFrame) -> DataFrame:
    """(id, top): which child of the root every folder is under."""
    return tree.select("id", id_of(F.split("label", "/")[0]).alias("top"))


def _inside(label: str) -> Column:
    """In the subtree of the folder with that label, itself included."""
    return (F.col("label") == label) | F.startswith("label", F.lit(f"{label}/"))


def _interval(label: str) -> layout.Bounds:
    return {"label": (label, f"{label}0")}  # the slash is the character before the nought


def _label(table: Versioned, folder: str) -> str:
    found = table.read(TREE).where(F.col("id") == folder).select("label").take(1)
    if not found:
        raise KeyError(folder)
    return found[0]["label"]


def below(spark: SparkSession, base: str, folder: str) -> DataFrame:
    """All folders below one, from the files that its interval meets."""
    label = _label(Versioned(spark, base), folder)
    return layout.read_within(spark, base, TREE, _interval(label)).where(
        _inside(label) & (F.col("label") != label))


def move(table: Versioned, root_id: str, folder: str, parent: str) -> int:
    """Put a folder under another one; returns how many files were written anew.

    Only files that the folder's interval meets are read and written: their other rows stay
    as they are, and the subtree's labels begin with the new way.
    """
    old, after, listed = _label(table, folder), table.current(), table.pieces()
    above = None if parent == root_id else _label(table, parent)
    if above is not None and (above == old or above.startswith(f"{old}/")):
        raise ValueError(f"{parent} is inside {folder}")
    own = old.rsplit("/", 1)[-1]
    new = own if above is None else f"{above}/{own}"
    touched = layout.skipping(table, _interval(old))
    moved = F.concat(F.lit(new), F.substr("label", F.lit(len(old) + 1)))
    rows = table.read(TREE, touched).select(
        "id", F.when(F.col("id") == folder, F.lit(parent)).otherwise(F.col("parent")).alias(
            "parent"), F.when(_inside(old), moved).otherwise(F.col("label")).alias("label"))
    place = table.new_folder()
    count = touched.count()
    rows.repartitionByRange(max(1, count), "label").sortWithinPartitions("label").write.parquet(
        f"{table.base}/{place}")
    pieces = layout.file_bounds(table, TREE, place, ["label"])
    table.commit(listed.join(touched.select(PIECE), PIECE, "left_anti").unionByName(pieces),
                 after)
    return count
