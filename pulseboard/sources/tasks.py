"""Open tasks of all task lists."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.clock import now
from pulseboard.operators.matching import Dictionary, with_account

# Status of a finished task, and of one without a status.
COMPLETED, OPEN = "completed", "needsAction"


def tasks_snapshot(pages: DataFrame, dictionary: Dictionary | DataFrame,
                   as_of: datetime) -> DataFrame:
    """Task pages to typed rows; finished tasks go, unmatched ones stay."""
    tasks = pages.select(F.col("id").alias("tasklist_id"), F.col("title").alias("tasklist_name"),
                         F.explode("items").alias("t"))
    title, notes = F.coalesce("t.title", F.lit("")), F.coalesce("t.notes", F.lit(""))
    status = F.coalesce("t.status", F.lit(OPEN))
    named = with_account(tasks.where(status != COMPLETED), F.concat(title, F.lit(" "), notes),
                         dictionary)
    return named.select(
        F.col("t.id").alias("task_id"), F.nullif("t.parent", F.lit("")).alias("parent_task_id"),
        "tasklist_id", "tasklist_name", title.alias("title"), notes.alias("notes"),
        status.alias("status"),
        F.left(F.coalesce("t.due", F.lit("")), F.lit(10)).alias("due_date"),
        "account_name", F.coalesce("t.updated", F.lit("")).alias("updated"),
        now(as_of).alias("_extracted_at"))
