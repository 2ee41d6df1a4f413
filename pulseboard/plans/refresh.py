"""One refresh: every silver and gold table computed and written once.

Later layers and reports read the written tables, so a silver table is neither
recomputed for each reader nor held in executor memory, and a lost executor
never reaches further back than the layer being computed.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from pulseboard.plans import gold, silver
from pulseboard.sources.sinks import write_clustered

SOURCES = ("accounts", "use_cases", "emails", "meetings", "chat", "tasks", "documents")

FACTS = ("emails", "calendar", "chat")

# Tables of a refresh with the columns they are laid out by.
TABLES = {
    "accounts": ("account_id",),
    "use_cases": ("account_id", "stage"),
    "emails": ("account_name", "received_date"),
    "calendar": ("account_name", "start_time"),
    "chat": ("account_name", "sent_at"),
    "tasks": ("account_name", "task_id"),
    "documents": ("account_name", "file_id"),
    "activity": ("activity_date", "account_name"),
    "health": ("account_id",),
}


def refresh(raw: Mapping[str, DataFrame], path: str, as_of: datetime) -> dict[str, DataFrame]:
    """Write all tables below ``path`` and return them as read back.

    Mails, meetings and chat are written as core facts, one row per id, which is what the
    counts need; the tier of an account is joined once to the written timeline, and to the
    facts as they are read.
    """
    spark = raw["accounts"].sparkSession
    tables: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        target = f"{path}/{name}"
        write_clustered(df, target, *TABLES[name])
        tables[name] = spark.read.schema(df.schema).parquet(target)
        return tables[name]

    accounts = keep("accounts", silver.accounts(raw["accounts"]))
    use_cases = keep("use_cases", silver.use_cases(raw["use_cases"], as_of))
    emails = keep("emails", silver.emails_core(raw["emails"], as_of))
    meetings = keep("calendar", silver.calendar_core(raw["meetings"], as_of))
    chat = keep("chat", silver.chat_core(raw["chat"], as_of))
    keep("tasks", silver.tasks(raw["tasks"], as_of))
    keep("documents", silver.documents(raw["documents"]))
    keep("activity", gold.tiered_activity(gold.activity(emails, meetings, chat, as_of), accounts))
    keep("health", gold.health(accounts, use_cases, emails, meetings, chat))
    for name in FACTS:
        tables[name] = silver.tiered(name, tables[name], accounts)
    return tables
