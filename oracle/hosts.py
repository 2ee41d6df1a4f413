"""The stand-in inputs once more, as DuckDB relations."""

RUN = "TIMESTAMP '2024-01-31 12:00:00'"
DAY = "DATE '2024-01-31'"

_EVENT_ACCOUNT = """CASE WHEN user_id % 50 = 49 THEN 'Unmatched'
    ELSE 'Customer#' || lpad(user_id::VARCHAR, 9, '0') END"""

BRONZE = {
    "in_accounts": f"""
SELECT c_custkey::VARCHAR AS account_id, c_name AS account_name,
    CASE WHEN c_custkey % 5 <> 0 THEN r_name END AS type,
    c_mktsegment AS industry,
    CASE WHEN c_custkey % 11 <> 0 THEN r_name END AS vertical,
    CASE WHEN c_acctbal >= 0 AND v = 0 THEN c_acctbal * 200 END AS arr,
    CASE WHEN c_acctbal >= 0 AND v = 0 THEN c_acctbal * 200 / 4 END AS t3m_arr,
    (c_custkey % 5000)::INTEGER AS number_of_employees,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'City ' || c_nationkey END AS billing_city,
    CASE WHEN c_custkey % 3 <> 0 THEN 'S' || c_nationkey END AS billing_state,
    n_name AS billing_country, 'Owner ' || (c_custkey % 20) AS owner_name,
    'P' || (c_custkey % 7) AS last_sa_engaged_id,
    'Person ' || (c_custkey % 7) AS last_sa_engaged_name,
    {RUN} - to_days(CASE v WHEN 0 THEN 1 ELSE 2 END) AS _extracted_at
FROM customer, nation, region, (VALUES (0), (1)) copies(v)
WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
  AND (v = 0 OR c_custkey % 10 = 0)""",
    "in_use_cases": f"""
SELECT o_orderkey::VARCHAR AS uco_id, o_custkey::VARCHAR AS account_id, c_name AS account_name,
    'UC ' || o_orderkey AS uco_name,
    CASE WHEN v = 1 THEN 'U1' WHEN o_orderkey % 13 <> 0 THEN 'U' || (1 + o_orderkey % 6) END
        AS stage,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS description,
    o_orderpriority AS use_case_type,
    CASE WHEN o_orderkey % 19 <> 0 THEN o_orderstatus END AS implementation_status,
    CASE WHEN o_orderkey % 3 <> 0 THEN {RUN} + to_days((o_orderkey % 150 - 20)::INTEGER) END
        AS go_live_date,
    CASE WHEN o_orderkey % 2 <> 0 THEN {RUN} + to_days((o_orderkey % 200 - 30)::INTEGER) END
        AS estimated_project_go_live,
    {RUN} - to_days((o_orderkey % 90)::INTEGER) AS last_modified_date,
    o_orderdate AS created_date, 'P' || (o_orderkey % 7) AS assigned_sa_id,
    'Person ' || (o_orderkey % 7) AS assigned_sa_name,
    {RUN} - to_days(CASE v WHEN 0 THEN 1 ELSE 2 END) AS _extracted_at
FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES (0), (1)) copies(v)
WHERE v = 0 OR o_orderkey % 20 = 0""",
    "in_emails": f"""
SELECT event_id::VARCHAR AS message_id, user_id || '-' || (event_id % 5) AS thread_id,
    {_EVENT_ACCOUNT} AS account_name, {_EVENT_ACCOUNT} AS customer_label,
    'u' || (event_id % 13) || '@example.com' AS from_email,
    'User ' || (event_id % 13) AS from_name,
    ['owner@example.com'] AS to_emails, []::VARCHAR[] AS cc_emails,
    CASE WHEN event_id % 97 <> 0 THEN 'Subject ' || user_id || '-' || (event_id % 5) END
        AS subject,
    props AS body_snippet, props AS body_text, ts AS received_date,
    CASE WHEN v = 0 AND value > 20 THEN ['INBOX', 'UNREAD'] ELSE ['INBOX'] END AS labels,
    v = 0 AND value > 20 AS is_unread,
    CASE WHEN event_id % 101 <> 0 THEN event_id % 3 <> 0 END AS needs_response,
    event_id % 4 = 0 AS has_attachment,
    {RUN} - to_days(CASE v WHEN 0 THEN 1 ELSE 0 END) AS _extracted_at
FROM events, (VALUES (0), (1)) copies(v)
WHERE event_type IN ('click', 'view') AND (v = 0 OR event_id % 7 = 0)""",
    "in_meetings": f"""
SELECT event_id::VARCHAR AS event_id, {_EVENT_ACCOUNT} AS account_name,
    'Meeting ' || (event_id % 9) AS event_title, props AS description,
    NULL::VARCHAR AS location, starts AS start_time,
    CASE WHEN event_id % 23 <> 0 THEN starts + to_minutes(15 + event_id % 4 * 15) END AS end_time,
    list_transform(range(least(event_id % 6, 5)),
                   lambda i: 'u' || i || '@example.com|accepted|U' || i) AS attendees,
    CASE WHEN event_id % 3 <> 0 THEN 'https://zoom.us/j/' || event_id END AS video_link,
    CASE WHEN event_id % 17 = 0 THEN 'cancelled' WHEN event_id % 29 = 0 THEN NULL
        ELSE 'confirmed' END AS status,
    'u' || (event_id % 13) || '@example.com' AS organizer_email, NULL::VARCHAR AS html_link,
    {RUN} - to_days(1) AS _extracted_at
FROM (SELECT *, CASE WHEN event_id % 41 <> 0 THEN ts + to_days((event_id % 6 * 8)::INTEGER) END
          AS starts
      FROM events WHERE event_type = 'signup')""",
    "in_chat": f"""
SELECT event_id::VARCHAR AS message_ts, 'C' || (user_id % 30) AS channel_id,
    'chan-' || (user_id % 30) AS channel_name, {_EVENT_ACCOUNT} AS account_name,
    user_id::VARCHAR AS user_id,
    CASE WHEN event_id % 31 = 0 THEN '  ' ELSE event_type || ' ' || props END AS message_text,
    ts AS sent_at, CASE WHEN event_id % 4 = 0 THEN (event_id - 1)::VARCHAR END AS thread_ts,
    event_id % 4 = 0 AS is_reply,
    CASE v WHEN 0 THEN (event_id % 8)::INTEGER ELSE 0 END AS reply_count,
    list_slice(['a', 'b', 'c', 'd'], 1, event_id % 5) AS reactions,
    {RUN} - to_days(CASE v WHEN 0 THEN 1 ELSE 0 END) AS _extracted_at
FROM events, (VALUES (0), (1)) copies(v)
WHERE event_type IN ('purchase', 'error') AND (v = 0 OR event_id % 9 = 0)""",
    "in_tasks": f"""
SELECT conv_id || '-' || turn AS task_id,
    CASE WHEN turn > 0 THEN conv_id || '-0' WHEN conv_id % 2 = 0 THEN '' END AS parent_task_id,
    (conv_id % 5)::VARCHAR AS tasklist_id, 'List ' || (conv_id % 5) AS tasklist_name,
    "text" AS title, CASE WHEN turn % 3 = 0 THEN '  ' ELSE "text" END AS notes,
    CASE WHEN turn = 5 THEN 'completed' ELSE 'needsAction' END AS status,
    CASE WHEN conv_id % 4 = 0 THEN ''
        ELSE strftime({DAY} + to_days((conv_id % 40 - 20)::INTEGER), '%Y-%m-%d') END AS due_date,
    CASE WHEN turn = 0 THEN 'Customer#' || lpad(conv_id::VARCHAR, 9, '0') END AS account_name,
    '' AS updated, {RUN} - to_days(1) AS _extracted_at
FROM conversations""",
    "in_documents": f"""
SELECT doc_id::VARCHAR AS file_id, 'doc-' || doc_id AS file_name, source AS account_name,
    '2024-01-' || lpad((1 + doc_id % 28)::VARCHAR, 2, '0') AS modified_time,
    CASE v WHEN 0 THEN "text" ELSE 'short' END AS content,
    {RUN} - to_days(CASE v WHEN 0 THEN 1 ELSE 0 END) AS _extracted_at
FROM documents, (VALUES (0), (1)) copies(v)
WHERE v = 0 OR doc_id % 8 = 0""",
}
