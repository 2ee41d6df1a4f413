"""The raw payloads as plain DuckDB relations, with the values they carry.

Where the Spark side wraps a value (JSON, MIME, base64url, header text) the
relation here keeps the value itself, so a statement states what must come out.
"""

from oracle.hosts import DAY, RUN

# White space as in Unicode-aware strip and \s.
BLANKS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
VIDEO = r"""(?i)https?://(?:meet\.google\.com|zoom\.us/j|teams\.microsoft\.com)[^\s"<>]*"""


def keyword_account(text: str) -> str:
    """First hit in the synthetic dictionary."""
    return f"""CASE WHEN contains(lower({text}), 'ring') OR contains(lower({text}), 'gear')
            THEN 'Account A'
        WHEN contains(lower({text}), 'widget') THEN 'Account B'
        WHEN contains(lower({text}), 'bolt') OR contains(lower({text}), 'rod') THEN 'Account C'
        END"""


PAYLOADS = {
    "label_accounts": "SELECT i AS ord, 'Label_' || i AS label, 'Account ' || 'ABCDEFGHI'[i + 1] "
                      "AS account FROM range(9) t(i)",
    "label_table": "SELECT c_custkey AS ord, 'Label_' || c_custkey AS label, c_name AS account "
                   "FROM customer",
    "keyword_table": """
SELECT keyword, min(item_id) AS ord FROM (
    SELECT item_id, unnest(string_split("text", ' ')) AS keyword FROM benchmark)
WHERE length(keyword) >= 4 GROUP BY 1""",
    "p_mail": rf"""
SELECT event_id, event_id::VARCHAR AS id, user_id || '-' || (event_id % 5) AS thread_id, props,
    CASE WHEN event_id % 11 = 0 THEN 'No-Reply@example.com'
        WHEN event_id % 17 = 0 THEN 'OWNER@example.com'
        ELSE 'u' || (event_id % 13) || '@example.com' END AS address,
    CASE WHEN event_id % 2 = 0 THEN 'User ' || (event_id % 13) ELSE address END AS from_name,
    'a' || (event_id % 5) || '@example.com;Last;First' AS to_list,
    CASE WHEN event_id % 2 = 1 THEN 'c@example.com' ELSE '' END AS cc_list,
    CASE WHEN event_id % 37 = 0 THEN {RUN} ELSE date_trunc('second', ts) END AS received_date,
    CASE WHEN event_id % 19 = 0 THEN NULL
        WHEN event_id % 8 = 0 THEN 'Updated Invitation: review'
        ELSE 'Question ' || (event_id % 5) END AS subject,
    list_filter(['Label_' || (user_id % 12),
        CASE WHEN event_id % 3 = 0 THEN 'Label_' || (event_id % 9) END,
        CASE WHEN value > 20 THEN 'UNREAD' END], lambda x: x IS NOT NULL) AS labels,
    value > 20 AS is_unread, event_id % 3 = 1 AS has_attachment,
    NOT (event_id % 11 = 0 OR event_id % 17 = 0 OR (event_id % 19 <> 0 AND event_id % 8 = 0))
        AS needs_response,
    'Hello ' || trim(regexp_replace(props, '{BLANKS}+', ' ', 'g')) || ' bye' AS body_text, ts
FROM events WHERE event_type IN ('click', 'view')""",
    "p_events": f"""
SELECT event_id, event_id::VARCHAR AS id,
    CASE event_id % 5 WHEN 0 THEN 'Ring review' WHEN 2 THEN '' WHEN 4 THEN 'BOLT check'
        ELSE 'Sync' END AS event_title,
    props || CASE WHEN event_id % 7 = 0 THEN ' about the widget' ELSE '' END
        || CASE WHEN event_id % 4 = 1 THEN ' join HTTPS://zoom.us/j/' || event_id || ' now'
            ELSE '' END AS description,
    CASE WHEN event_id % 6 = 0 THEN 'Room 1' END AS location,
    CASE WHEN event_id % 8 = 0 THEN date_trunc('day', begins) ELSE date_trunc('second', begins)
        END AS start_time,
    CASE WHEN event_id % 23 <> 0 THEN date_trunc('second', begins) + to_minutes(30) END
        AS end_time,
    CASE WHEN event_id % 10 = 9 THEN [] ELSE list_slice(
        ['a@example.com|accepted|A', 'b@Gear.example.com|declined|', 'c@rod.example.com||C'],
        1, event_id % 4) END AS guests,
    CASE WHEN event_id % 4 = 1 THEN 'HTTPS://zoom.us/j/' || event_id
        WHEN event_id % 3 = 0 THEN 'https://meet.google.com/' || event_id END AS video_link,
    CASE WHEN event_id % 19 <> 0 THEN 'u' || (event_id % 13) || '@example.com' END
        AS organizer_email,
    'https://cal.example.com/' || event_id AS html_link
FROM (SELECT *, ts + to_days((event_id % 6 * 16)::INTEGER) AS begins
      FROM events WHERE event_type = 'signup')""",
    "guest_accounts": """
SELECT id, CASE WHEN contains(array_to_string(guests, ','), 'Gear') THEN 'Account A'
    WHEN contains(array_to_string(guests, ','), 'rod') THEN 'Account C' END AS account
FROM p_events""",
    "p_channels": f"""
SELECT number AS ord, 'C' || number AS channel_id, 'chan-' || number AS channel_name,
    CASE number % 4 WHEN 0 THEN 'Account A' WHEN 1 THEN 'Account B' END AS account_name
FROM (SELECT DISTINCT user_id % 30 AS number FROM events)""",
    "p_messages": """
SELECT event_id, 'C' || ((user_id + v) % 30) AS channel_id,
    (epoch_us(ts) // 1000000) || '.' || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0')
        AS message_ts,
    CASE WHEN event_id % 6 = 0 THEN 'B1' ELSE user_id::VARCHAR END AS user_id,
    CASE WHEN event_id % 31 = 0 THEN '' ELSE event_type || ' ' || props END AS message_text,
    ts AS sent_at,
    CASE event_id % 4 WHEN 0 THEN message_ts WHEN 1 THEN '1704067200.000000' WHEN 2 THEN '' END
        AS thread_ts,
    event_id % 4 = 1 AND message_ts <> '1704067200.000000' AS is_reply,
    CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 8 END::INTEGER AS reply_count,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE substr('a;b;c', 1, greatest(0, (event_id % 4) * 2 - 1)::BIGINT)
        END AS reactions
FROM events, (VALUES (0), (1)) copies(v)
WHERE event_type IN ('purchase', 'error') AND (v = 0 OR event_id % 9 = 0)""",
}

_EVENT_COLUMNS = """id AS event_id, event_title, description, location, start_time, end_time,
    array_to_string(guests, ';') AS attendees, video_link, 'confirmed' AS status,
    organizer_email, html_link"""

_EMAIL_COLUMNS = """id AS message_id, thread_id, account_name, account_name AS customer_label,
    address AS from_email, from_name, to_list AS to_emails, cc_list AS cc_emails,
    ifnull(subject, '(no subject)') AS subject, props AS body_snippet, body_text, received_date,
    array_to_string(labels, ';') AS labels, is_unread, needs_response, has_attachment"""


def email_run(run: str, back_days: int, per_label: int | None = None,
              seen: str = "true") -> str:
    """One mail run at time ``run`` over the messages that satisfy ``seen``."""
    newest = "" if per_label is None else f"""
            QUALIFY row_number() OVER (PARTITION BY a.ord ORDER BY CASE WHEN event_id % 37 = 0
                THEN {run} ELSE received_date END DESC, id) <= {per_label}"""
    return f"""
SELECT {_EMAIL_COLUMNS}, {run} AS _extracted_at
FROM (SELECT *, arg_min(account, ord) OVER (PARTITION BY id) AS account_name,
          row_number() OVER (PARTITION BY id ORDER BY ord) AS nth
      FROM (SELECT m.* REPLACE (CASE WHEN event_id % 37 = 0 THEN {run} ELSE received_date END
                                AS received_date), a.ord, a.account
            FROM p_mail m, unnest(list_distinct(labels)) t(label) JOIN label_accounts a USING (label)
            WHERE ({seen}) AND (event_id % 37 = 0 OR received_date >= {run} - to_days({back_days})){newest}))
WHERE nth = 1"""


def chat_run(run: str, back_days: int, seen: str = "true") -> str:
    return f"""
SELECT message_ts, channel_id, channel_name, account_name, user_id, message_text, sent_at,
    thread_ts, is_reply, reply_count, reactions, {run} AS _extracted_at
FROM p_messages JOIN p_channels USING (channel_id)
WHERE ({seen}) AND account_name IS NOT NULL AND sent_at >= {run} - to_days({back_days})
QUALIFY row_number() OVER (PARTITION BY message_ts ORDER BY ord) = 1"""


RECORDS = {
    "src_accounts_flatten": f"""
SELECT c_custkey::VARCHAR AS account_id, c_name AS account_name, 'Customer' AS type,
    c_mktsegment AS industry, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS vertical,
    CASE WHEN c_custkey % 9 <> 0 THEN nullif(c_acctbal * 200, 0) END AS arr,
    nullif(c_acctbal * 50, 0) AS t3m_arr,
    nullif(c_custkey % 100, 0)::INTEGER AS number_of_employees,
    NULL::VARCHAR AS billing_city, NULL::VARCHAR AS billing_state,
    'N' || c_nationkey AS billing_country,
    CASE WHEN c_custkey % 6 <> 0 THEN 'Owner ' || (c_custkey % 20) END AS owner_name,
    'P3' AS last_sa_engaged_id, 'Person 3' AS last_sa_engaged_name, {RUN} AS _extracted_at
FROM customer WHERE c_custkey % 7 = 3 AND c_custkey % 8 <> 0""",
    "src_use_cases_semi": f"""
SELECT o_orderkey::VARCHAR AS uco_id, o_custkey::VARCHAR AS account_id,
    'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS account_name,
    'UC ' || o_orderkey AS uco_name, 'U' || (1 + o_orderkey % 6) AS stage,
    o_orderpriority AS description, o_orderstatus AS use_case_type,
    o_orderstatus AS implementation_status,
    CASE WHEN o_orderkey % 3 <> 0 THEN ({DAY} - (o_orderkey % 90)::INTEGER)::TIMESTAMP END
        AS go_live_date,
    NULL::TIMESTAMP AS estimated_project_go_live,
    {RUN} - to_days((o_orderkey % 90)::INTEGER) AS last_modified_date,
    date_trunc('second', o_orderdate) AS created_date,
    'P' || (o_orderkey % 7) AS assigned_sa_id,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'Person ' || (o_orderkey % 7) END AS assigned_sa_name,
    {RUN} AS _extracted_at
FROM orders WHERE o_custkey IN (
    SELECT c_custkey FROM customer WHERE c_custkey % 7 = 3 AND c_custkey % 8 <> 0)""",
    "src_staging_scan": "SELECT * FROM in_accounts",
    "src_email_snapshot": email_run(RUN, 30),
    "src_email_newest": email_run(RUN, 30, 25),
    "src_calendar_snapshot": f"""
SELECT {_EVENT_COLUMNS}, ifnull({keyword_account(
    "event_title || ' ' || description || ' ' || ifnull(location, '')")}, account)
    AS account_name, {RUN} AS _extracted_at
FROM p_events JOIN guest_accounts USING (id)
WHERE account_name IS NOT NULL AND (start_time IS NULL OR (start_time >= {RUN} - to_days(30)
  AND start_time <= {RUN} + to_days(60)))""",
    "src_chat_snapshot": chat_run(RUN, 14),
    "src_tasks_snapshot": f"""
SELECT conv_id || '-' || turn AS task_id, CASE WHEN turn > 0 THEN conv_id || '-0' END
        AS parent_task_id,
    (conv_id % 5)::VARCHAR AS tasklist_id, 'List ' || (conv_id % 5) AS tasklist_name,
    "text" AS title, CASE WHEN turn % 3 = 0 THEN '' WHEN conv_id % 3 = 0 THEN role || ' Widget'
        ELSE role END AS notes,
    'needsAction' AS status,
    CASE WHEN conv_id % 4 = 0 THEN ''
        ELSE strftime({DAY} + to_days((conv_id % 40 - 20)::INTEGER), '%Y-%m-%d') END AS due_date,
    {keyword_account("title || ' ' || notes")} AS account_name, '' AS updated,
    {RUN} AS _extracted_at
FROM conversations WHERE turn <> 5""",
    "src_folder_walk": rf"""
WITH RECURSIVE below AS (
    SELECT p_partkey AS folder, CASE WHEN contains(p_name, 'ring') THEN 'Ring Works'
            WHEN contains(p_name, 'gear') THEN 'Gear Works' ELSE p_name END AS account_name
    FROM part WHERE p_partkey BETWEEN 1 AND 9
    UNION ALL
    SELECT p_partkey, account_name FROM part JOIN below ON p_partkey // 10 = folder)
SELECT 'D' || doc_id AS file_id, 'doc-' || doc_id AS file_name, account_name,
    '2024-01-15' AS modified_time,
    regexp_replace(regexp_replace(replace("text", chr(10), repeat(chr(10), 4)),
        '\n{{3,}}', repeat(chr(10), 2), 'g'), '^{BLANKS}+|{BLANKS}+\z', '', 'g') AS content,
    {RUN} AS _extracted_at
FROM documents JOIN below ON folder = doc_id WHERE source <> 'src7' AND content <> ''""",
    "match_keywords_expr": f"SELECT p_partkey, p_name, {keyword_account('p_name')} AS account "
                           "FROM part",
    "match_keywords_join": """
WITH words AS (SELECT unnest(string_split(p_name, ' ')) AS keyword, min(p_partkey) AS ord
               FROM part GROUP BY 1)
SELECT p_partkey, p_name, arg_min('Account ' || keyword, (w.ord, keyword)) AS account
FROM part LEFT JOIN words w ON contains(lower(p_name), lower(keyword)) GROUP BY 1, 2""",
    "match_labels": """
SELECT id, (SELECT arg_min(account, ord) FROM label_accounts WHERE list_contains(labels, label))
    AS account FROM p_mail""",
    "match_attendee_domain": "SELECT id, account FROM guest_accounts",
    "match_alias_fallback": """
SELECT doc_id, source, CASE WHEN contains(source, 'src1') THEN 'Source One'
    WHEN contains(source, 'src5') THEN 'Source Five' ELSE source END AS account FROM documents""",
    "dedupe_latest_window": """
SELECT DISTINCT ON (message_id) message_id, is_unread, received_date, _extracted_at
FROM in_emails ORDER BY message_id, _extracted_at DESC""",
    "classify_needs_response": "SELECT id, needs_response FROM p_mail",
    "headers_to_map": r"""
SELECT id, array_to_string(list_sort(list_filter([
    'from=' || CASE event_id % 4 WHEN 0 THEN '"' || from_name || '" <' || address || '>'
        WHEN 1 THEN address WHEN 2 THEN from_name || ' <' || address || '>'
        ELSE '<' || address || '>' END,
    'to=a' || (event_id % 5) || '@example.com, "Last, First" <b@example.com>, ',
    CASE WHEN event_id % 2 = 1 THEN 'cc=c@example.com (Team C)' END,
    'date=' || CASE WHEN event_id % 37 = 0 THEN 'not a date'
        WHEN event_id % 41 = 1 THEN strftime(ts - INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S EST')
        WHEN event_id % 41 = 2 THEN strftime(ts - INTERVAL 7 HOUR, '%a, %-d %b %Y %H:%M:%S PDT')
        WHEN event_id % 41 = 3 THEN strftime(ts, '%d %b %Y %H:%M:%S GMT')
        WHEN event_id % 41 = 4 THEN strftime(ts, '%a, %-d %b %y %H:%M:%S +0000 (UTC)')
        ELSE strftime(ts + INTERVAL 2 HOUR, '%a, %d %b %Y %H:%M:%S +0200') END,
    'subject=' || subject], lambda x: x IS NOT NULL)), ';') AS headers
FROM p_mail""",
    "parse_address": "SELECT id, address AS from_email, from_name FROM p_mail",
    "parse_recipients": "SELECT id, to_list, cc_list FROM p_mail",
    "parse_mail_date": "SELECT id, received_date FROM p_mail",
    "mime_first_text": """
SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN '' WHEN 2 THEN ifnull(nullif("text", ''), '<b>other</b>')
    ELSE "text" END AS body FROM documents""",
    "b64url_decode": 'SELECT doc_id, "text" AS decoded FROM documents',
    "html_to_text": rf"""
SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
    '{BLANKS}+', ' ', 'g')) AS clean_text, left(clean_text, 4000) AS stored_text FROM pages""",
    "normalise_text": rf"""
SELECT doc_id, regexp_replace(regexp_replace(replace("text", chr(10), repeat(chr(10), 4)),
    '\n{{3,}}', repeat(chr(10), 2), 'g'), '^{BLANKS}+|{BLANKS}+\z', '', 'g') AS clean_text,
    left(clean_text, 4000) AS stored_text FROM documents""",
    "array_flags": "SELECT id, has_attachment, is_unread FROM p_mail",
    "extract_link": f"""
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'HTTPS://Zoom.us/j/' || page_id || '?pwd=x'
    ELSE ifnull(nullif(regexp_extract(html, '{VIDEO}'), ''),
        CASE page_id % 3 WHEN 1 THEN 'https://meet.google.com/' || page_id
            ELSE CASE WHEN page_id % 5 <> 0 THEN 'https://teams.microsoft.com/l/' || page_id END
        END) END AS video_link
FROM pages""",
    "attendees_encode_decode": """
SELECT id, array_to_string(guests, ';') AS encoded,
    array_to_string(list_transform(guests, lambda g: split_part(g, '|', 1)), ';') AS emails,
    array_to_string(list_transform(guests, lambda g: split_part(g, '|', 3)), ';') AS names,
    array_to_string(list_transform(guests, lambda g: split_part(g, '|', 2)), ';') AS statuses
FROM p_events""",
    "parse_iso_ts": """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN date_trunc('second', o_orderdate)
    WHEN 1 THEN date_trunc('second', o_orderdate) WHEN 2 THEN date_trunc('second', o_orderdate)
    WHEN 3 THEN date_trunc('day', o_orderdate) END AS parsed FROM orders""",
    "parse_epoch_ts": "SELECT event_id, ts AS parsed FROM events",
    "chat_flags": """
SELECT message_ts, channel_id, user_id, is_reply, reply_count, reactions FROM p_messages""",
    "json_flatten": f"SELECT {_EVENT_COLUMNS} FROM p_events",
}

RECORDS["src_email_labels"] = email_run(RUN, 30).replace("label_accounts", "label_table")
RECORDS["src_tasks_dictionary"] = f"""
SELECT t.* REPLACE (hit.account AS account_name)
FROM ({RECORDS["src_tasks_snapshot"]}) t LEFT JOIN (
    SELECT task_id, arg_min('Account ' || keyword, (k.ord, keyword)) AS account
    FROM ({RECORDS["src_tasks_snapshot"]}) JOIN keyword_table k
        ON contains(lower(title || ' ' || notes), lower(keyword)) GROUP BY 1) hit USING (task_id)"""
