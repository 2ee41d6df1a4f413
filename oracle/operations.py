"""Statements for sinks, checks, the older view and the streams."""

from oracle.hosts import BRONZE, RUN
from oracle.payloads import chat_run, email_run

_YESTERDAY = f"({RUN} - to_days(1))"
_LEGACY = {"sf_accounts": ("in_accounts", "account_id"),
           "sf_use_cases": ("in_use_cases", "uco_id"),
           "gmail_customer_emails": ("in_emails", "message_id"),
           "calendar_events": ("in_meetings", "event_id"),
           "slack_messages": ("in_chat", "message_ts")}


def _two_runs(run, time: str, *limits: int) -> str:
    """Yesterday's run, and today's over what was delivered since two days ago."""
    first = run(_YESTERDAY, *limits, seen=f"{time} < {_YESTERDAY}")
    second = run(RUN, *limits, seen=f"{time} >= {RUN} - to_days(2)")
    return f"SELECT * FROM ({first}) UNION ALL BY NAME SELECT * FROM ({second})"


OPERATIONS = {
    "snk_snapshot_roundtrip": "SELECT * FROM s_accounts",
    "snk_clustered_scan": """
SELECT account_name, count(*) AS mails, min(received_date) AS first_received,
    max(received_date) AS last_received FROM s_emails GROUP BY account_name""",
    "ops_run_log": " UNION ALL ".join([
        *[f"SELECT '{name[3:]}' AS source, 'SUCCESS' AS status, count(*) AS rows_ingested, "
          f"0::BIGINT AS rows_rejected FROM {name}" for name in BRONZE],
        *[f"SELECT 'calendar_{route}' AS source, 'SUCCESS' AS status, "
          f"count(*) AS rows_ingested, count(*) FILTER (event_id % 29 IN (0, 1, 2)) "
          f"AS rows_rejected FROM p_events" for route in ("batch", "stream")]]),
    "src_folder_moved": """
WITH RECURSIVE folders AS (
    SELECT p_partkey AS folder, CASE p_partkey WHEN 12 THEN 3 WHEN 57 THEN 0
        ELSE p_partkey // 10 END AS parent FROM part WHERE p_partkey > 0),
below AS (
    SELECT folder, folder AS top FROM folders WHERE parent = 0
    UNION ALL
    SELECT f.folder, top FROM folders f JOIN below b ON f.parent = b.folder)
SELECT 'F' || folder AS id, 'F' || top AS top FROM below""",
    "ops_quarantine": f"""
SELECT source, id AS named_id, {RUN} AS landed_at
FROM p_events, (VALUES ('calendar_batch'), ('calendar_stream')) routes(source)
WHERE event_id % 29 IN (0, 1, 2)""",
    "snk_curve_scan": f"""
SELECT account_name, count(*) AS mails, max(received_date) AS last_received FROM s_emails
WHERE received_date BETWEEN {RUN} - to_days(7) AND {RUN} GROUP BY account_name""",
    "stream_late_rows": f"""
SELECT 'emails' AS source, count(*) AS rows_ingested, 0::BIGINT AS rows_late FROM in_emails
WHERE _extracted_at = {RUN}
UNION ALL
SELECT 'emails', count(*), count(*) FILTER (message_id IN (
    SELECT message_id FROM in_emails WHERE _extracted_at = {RUN}))
FROM in_emails WHERE _extracted_at < {RUN}""",
    "ops_row_counts": " UNION ALL ".join(
        [f"SELECT '{name}' AS table_name, count(*) AS rows FROM {host}"
         for name, (host, _) in _LEGACY.items()]
        + ["SELECT 'ingestion_run_log' AS table_name, 2::BIGINT AS rows"]),
    "dq_constraints": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{check}' AS \"check\", '{column}' AS column_name, "
        f"count(*) AS rows, ({failures})::BIGINT AS failures FROM {host}"
        for name, (host, key) in _LEGACY.items() for check, column, failures in [
            ("not null", key, f"count(*) FILTER ({key} IS NULL)"),
            ("not null", "account_name", "count(*) FILTER (account_name IS NULL)"),
            ("unique", key, f"count({key}) - count(DISTINCT {key})"),
            *([] if name == "sf_accounts" else [(
                "reference", "account_id" if name == "sf_use_cases" else "account_name",
                "count(*) FILTER (account_id NOT IN (SELECT account_id FROM in_accounts))"
                if name == "sf_use_cases" else "count(*) FILTER (account_name NOT IN "
                "(SELECT account_name FROM in_accounts))")])]),
    "dq_not_null_keys": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{key}' AS column_name, count(*) AS rows, "
        f"count(*) FILTER ({key} IS NULL) AS null_rows FROM {host}"
        for name, (host, key) in _LEGACY.items()),
    "view_legacy_activity": """
SELECT 'email' AS activity_type, account_name, received_date AS activity_date, subject AS title,
    from_name AS contact, body_snippet AS summary,
    CASE WHEN ifnull(needs_response, false) THEN 'ACTION REQUIRED'
        ELSE if(is_unread, 'UNREAD', 'READ') END AS status,
    message_id AS source_id, _extracted_at AS ingested_at
FROM in_emails
UNION ALL BY NAME
SELECT 'meeting' AS activity_type, account_name, start_time AS activity_date,
    event_title AS title, 'User ' || (event_id::BIGINT % 13) AS contact, description AS summary,
    upper(m.status) AS status, event_id AS source_id, _extracted_at AS ingested_at
FROM in_meetings m
UNION ALL BY NAME
SELECT 'slack' AS activity_type, account_name, sent_at AS activity_date,
    format('[{}] {}', channel_name, message_text[:120]) AS title, 'User ' || user_id AS contact,
    message_text AS summary, 'MESSAGE' AS status, message_ts AS source_id,
    _extracted_at AS ingested_at
FROM in_chat""",
    "stream_email_append": _two_runs(email_run, "ts", 2),
    "stream_chat_append": _two_runs(chat_run, "sent_at", 2),
    "stream_dedupe_watermark": """
SELECT DISTINCT message_ts, channel_id, message_text, sent_at FROM in_chat""",
}
