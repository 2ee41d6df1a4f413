"""One complete DuckDB statement per query name."""

from oracle import compose
from oracle.datasets import GOLD, HEALTH_FAN_OUT, REPORTS, SILVER
from oracle.hosts import BRONZE
from oracle.operations import OPERATIONS
from oracle.payloads import PAYLOADS, RECORDS

RELATIONS = {**BRONZE, **SILVER, **GOLD, **PAYLOADS}


def joined(relation: str, *arrays: str) -> str:
    """All columns of a relation, the named arrays as ``a;b;c``."""
    swaps = ", ".join(f"array_to_string({a}, ';') AS {a}" for a in arrays)
    return f"SELECT * {f'REPLACE ({swaps})' if swaps else ''} FROM {relation}"


DATASETS = {
    "silver_accounts": joined("s_accounts"),
    "silver_use_cases": joined("s_use_cases"),
    "silver_emails": joined("s_emails", "to_emails", "cc_emails"),
    "silver_calendar": joined("s_calendar", "attendees"),
    "silver_chat": joined("s_chat", "reactions"),
    "silver_tasks": joined("s_tasks"),
    "silver_documents": joined("s_documents"),
    "gold_activity": joined("g_activity"),
    "gold_health": HEALTH_FAN_OUT,
}


def statements() -> dict[str, str]:
    bodies = {**DATASETS, **REPORTS, **RECORDS, **OPERATIONS}
    for twin in ("dedupe_latest_agg", "stream_dedupe_latest", "stream_dedupe_exact"):
        bodies[twin] = bodies["dedupe_latest_window"]
    bodies["stream_history_log"] = bodies["stream_email_append"]
    bodies["src_calendar_landed"] = bodies["src_calendar_snapshot"]
    bodies["ops_refresh"] = bodies["gold_health"]
    bodies["ops_refresh_incremental"] = "SELECT * EXCLUDE (last_synced_at) FROM g_health"
    return {name: compose(body, RELATIONS) for name, body in bodies.items()}
