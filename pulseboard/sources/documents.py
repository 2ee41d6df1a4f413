"""Documents below account folders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.clock import now
from pulseboard.functions.text import normalise_newlines
from pulseboard.operators.matching import Dictionary, with_account
from pulseboard.operators.tree import root_children_closure

# Kinds of folder entries.
FOLDER = "application/vnd.google-apps.folder"
DOCUMENT = "application/vnd.google-apps.document"


def folder_documents(files: DataFrame, root_id: str, aliases: Dictionary | DataFrame,
                     as_of: datetime, width: int | None = None) -> DataFrame:
    """Documents anywhere below a child folder of the root, empty ones dropped.

    Only the folders take part in the recursive walk; documents join its result
    once, on their direct parent. An account folder's name goes through the
    alias dictionary and otherwise stays as it is.
    """
    folders = files.where(F.col("mimeType") == FOLDER).select("id", "parent", "name")
    closure = root_children_closure(folders, root_id)
    tops = with_account(folders.where(F.col("parent") == root_id), F.col("name"), aliases)
    accounts = tops.select(F.col("id").alias("top"),
                           F.coalesce("account_name", "name").alias("account_name"))
    home = closure.join(accounts, "top").select(F.col("id").alias("parent"), "account_name")
    return (files.where(F.col("mimeType") == DOCUMENT)
            .join(home, "parent")
            .select(F.col("id").alias("file_id"), F.col("name").alias("file_name"), "account_name",
                    F.left(F.coalesce("modifiedTime", F.lit("")), F.lit(10)).alias("modified_time"),
                    normalise_newlines(F.col("text"), width).alias("content"),
                    now(as_of).alias("_extracted_at"))
            .where(F.col("content") != ""))
