"""The named queries in DuckDB SQL, written from the rules rather than from our plans."""

from __future__ import annotations

# Views in message shape. Bodies that plant irregular input repeat the rules of
# ``views``.
DOCUMENTS = """
document_messages AS (
  SELECT source AS account_id, CAST(doc_id AS VARCHAR) AS message_id, text AS message_body,
         'doc-' || doc_id AS correlation_id, lang AS message_status,
         strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id * 7), '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
         doc_id
  FROM documents)"""

CONVERSATIONS = """
conversation_messages AS (
  SELECT CAST(conv_id AS VARCHAR) AS account_id, conv_id || '-' || turn AS message_id,
         text AS message_body, CAST(NULL AS VARCHAR) AS correlation_id, role AS message_status,
         strftime(TIMESTAMP '2024-01-01' + to_minutes(conv_id * 60 + turn), '%Y-%m-%dT%H:%M:%SZ')
           AS "timestamp",
         conv_id, turn
  FROM conversations)"""

EVENTS = """
event_messages AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id, CAST(event_id AS VARCHAR) AS message_id,
         event_type || ' ' || props AS message_body,
         CASE WHEN event_id % 11 <> 0 THEN 'e-' || event_id END AS correlation_id,
         event_type AS message_status, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
         event_id, ts,
         CASE WHEN contains(lower(event_type || ' ' || props), 'error')
              THEN 'PROFANITY' ELSE 'SAFE' END AS profanity_type
  FROM events)"""

# The instant is taken from the event itself where the planted text is one.
IRREGULAR = f"""{EVENTS},
irregular AS (
  SELECT account_id, message_id, message_body, correlation_id, message_status, profanity_type,
         CASE WHEN event_id % 17 = 0 THEN NULL
              WHEN event_id % 19 = 0 THEN ''
              WHEN event_id % 23 = 0 THEN 'some day soon'
              WHEN event_id % 29 = 0 THEN strftime(ts, '%Y-%m-%d')
              WHEN event_id % 31 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')
              WHEN event_id % 37 = 0 THEN '2024-02-30T10:00:00Z'
              WHEN event_id % 41 = 0 THEN strftime(ts, '%Y-%m-%dt%H:%M:%S.%f999z')
              WHEN event_id % 43 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%MZ')
              ELSE "timestamp" END AS "timestamp",
         CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0
                OR event_id % 31 = 0 OR event_id % 37 = 0 THEN NULL
              WHEN event_id % 41 <> 0 AND event_id % 43 = 0 THEN NULL
              ELSE ts END AS instant
  FROM event_messages)"""

LAKE = f"""{IRREGULAR},
lake AS (
  SELECT CASE WHEN usable THEN account_id ELSE '' END AS account_id,
         CASE WHEN usable THEN message_id ELSE '' END AS message_id,
         CASE WHEN usable THEN message_body ELSE '' END AS message_body,
         CASE WHEN usable THEN coalesce(correlation_id, '') ELSE '' END AS correlation_id,
         CASE WHEN usable THEN message_status ELSE 'ERROR' END AS message_status,
         coalesce(instant, TIMESTAMP '2024-02-01') AS "timestamp",
         CASE WHEN usable THEN profanity_type ELSE 'SAFE' END AS profanity_type
  FROM (SELECT *, "timestamp" IS NULL OR instant IS NOT NULL AS usable FROM irregular))"""

EVENT_TABLE = f"""{EVENTS},
event_table AS (
  SELECT account_id, message_id, message_body, coalesce(correlation_id, '') AS correlation_id,
         message_status, ts AS event_time, profanity_type, event_id
  FROM event_messages)"""

DOCUMENT_TABLE = f"""{DOCUMENTS},
document_table AS (
  SELECT account_id, message_id, doc_id,
         CASE WHEN contains(lower(message_body), 'gun') OR contains(lower(message_body), 'bad')
                OR contains(lower(message_body), 'word') OR contains(lower(message_body), 'violence')
                OR contains(lower(message_body), 'hate') THEN 'PROFANITY' ELSE 'SAFE' END
           AS profanity_type
  FROM document_messages)"""

LARGE_LEXICON = f"""
WITH {DOCUMENTS},
words AS (
  SELECT DISTINCT word
  FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM benchmark)
  WHERE length(word) >= 10)
SELECT account_id, message_id,
       CASE WHEN EXISTS (SELECT 1 FROM words w WHERE contains(lower(d.message_body), w.word))
            THEN 'PROFANITY' ELSE 'SAFE' END AS profanity_type
FROM document_messages d"""

ROUGH_LEXICON = f"""
WITH {DOCUMENTS},
shapes AS (
  SELECT unnest(['  ' || upper(substr(text, 1, 12)) || chr(9), substr(text, 20, 7), substr(text, 1, 90) || ' not there',
                 CASE WHEN item_id % 3 = 0 THEN substr(text, 1, 90) END,
                 CASE WHEN item_id % 3 = 1 THEN substr(text, 1, 70) END,
                 CASE WHEN item_id % 7 = 0 THEN 'ñ' END]) AS shape
  FROM benchmark),
words AS (
  SELECT DISTINCT lower(trim(shape, ' ' || chr(9) || chr(10) || chr(13))) AS word FROM shapes
  WHERE trim(shape, ' ' || chr(9) || chr(10) || chr(13)) <> '')
SELECT account_id, message_id,
       CASE WHEN EXISTS (SELECT 1 FROM words w WHERE contains(lower(d.message_body), w.word))
            THEN 'PROFANITY' ELSE 'SAFE' END AS profanity_type
FROM document_messages d"""

PROFANE_CONVERSATIONS = f"""{CONVERSATIONS},
profane AS (
  SELECT account_id, message_id, message_body, correlation_id, message_status, "timestamp",
         'PROFANITY' AS profanity_type
  FROM conversation_messages
  WHERE regexp_matches(lower(message_body), 'gun|bad|word|violence|hate'))"""

DECODE = f"""{CONVERSATIONS},
decoded AS (
  SELECT *, CAST(conv_id % 3 AS INTEGER) AS source_partition, conv_id * 1000 + turn AS "offset",
         CASE WHEN key % 13 = 0 OR key % 17 = 0 THEN 'malformed_json'
              WHEN key % 19 = 0 THEN 'null_record'
              WHEN key % 23 = 0 THEN 'not_an_object'
              WHEN key % 29 = 0 THEN 'nested_field'
              WHEN key % 31 = 0 THEN 'unknown_profanity_type' END AS reason,
         CASE WHEN key % 37 = 0 THEN '1.50'
              WHEN key % 5 <> 0 THEN account_id
              WHEN key % 4 = 1 THEN account_id || '.50'
              WHEN key % 4 = 2 THEN account_id || 'e5'
              WHEN key % 4 = 3 THEN '123456789012345678901234567890123456789' || account_id || '.10'
              ELSE account_id END AS sent_account,
         CASE WHEN key % 37 <> 0 AND key % 5 <> 0 AND key % 3 = 0 THEN 'SAFE' END AS profanity_type
  FROM (SELECT *, conv_id * 7 + turn AS key FROM conversation_messages))"""

VERSIONS = f"""{EVENT_TABLE},
versions AS (
  SELECT account_id, message_id,
         CASE WHEN v = 0 THEN message_body ELSE message_body || ' v' || v END AS message_body,
         correlation_id, message_status,
         CASE WHEN v = 3 THEN event_time + INTERVAL 31 DAY ELSE event_time END AS event_time,
         profanity_type,
         TIMESTAMP '2024-02-01' + CASE WHEN v = 0 THEN INTERVAL 0 SECOND ELSE INTERVAL 60 SECOND END
           AS inserted_at,
         v AS batch_id
  FROM event_table, (VALUES (0), (1), (2), (3)) AS n(v)
  WHERE v = 0 OR (v = 1 AND event_id % 3 = 0) OR (v = 2 AND event_id % 15 = 0)
     OR (v = 3 AND event_id % 21 = 0))"""

LATEST = f"""
WITH {VERSIONS}
SELECT account_id, message_id, message_body, correlation_id, message_status, event_time, profanity_type
FROM versions
QUALIFY row_number() OVER (
  PARTITION BY date_trunc('month', event_time), account_id, message_id
  ORDER BY inserted_at DESC, batch_id DESC) = 1"""

AUDIT = """WITH arrivals AS (
  SELECT CASE WHEN event_id % 101 <> 0 THEN user_id % 3 END AS source_partition,
         CASE WHEN event_id % 103 <> 0 THEN event_id END AS "offset",
         ts - CASE WHEN event_id % 7 = 0 THEN INTERVAL 45 MINUTE
                   WHEN event_id % 5 = 0 THEN INTERVAL 5 SECOND
                   ELSE INTERVAL 0 SECOND END AS event_ts
  FROM events),
seen AS (
  SELECT *, max(event_ts) OVER (PARTITION BY source_partition ORDER BY "offset"
                                ROWS UNBOUNDED PRECEDING) - INTERVAL 10 SECOND AS watermark
  FROM arrivals WHERE source_partition IS NOT NULL AND "offset" IS NOT NULL
  UNION ALL BY NAME
  SELECT *, NULL::TIMESTAMP AS watermark FROM arrivals WHERE source_partition IS NULL OR "offset" IS NULL)"""


def _on_stored(sql: str) -> str:
    """A query on ``event_table`` turned to the latest versions."""
    body = sql.split(EVENT_TABLE, 1)[1].strip()
    return f"WITH latest AS ({LATEST})\n{body.replace('event_table', 'latest')}"


STREAM = f"""{DOCUMENT_TABLE},
streamed AS (
  SELECT d.*, t.profanity_type, d.doc_id % 19 = 0 AS rejected,
         d.doc_id % 13 = 0 OR d.doc_id % 17 = 0 AS bad_time
  FROM document_messages d JOIN document_table t USING (doc_id))"""

ORACLES: dict[str, str] = {
    "lexicon_words": """
SELECT DISTINCT word
FROM (SELECT lower(trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13))) AS word FROM documents)
WHERE word <> ''""",
    "classify_messages": f"""
WITH {DOCUMENT_TABLE}
SELECT account_id, message_id, profanity_type FROM document_table""",
    "classify_large_lexicon": LARGE_LEXICON,
    "classify_by_benchmark_table": LARGE_LEXICON,
    "classify_by_lexicon_table": ROUGH_LEXICON,
    "classify_by_shuffled_lexicon": ROUGH_LEXICON,
    "classify_default_by_table": f"""
WITH {DOCUMENT_TABLE}
SELECT account_id, message_id, profanity_type FROM document_table""",
    "profane_messages": f"""
WITH {PROFANE_CONVERSATIONS}
SELECT account_id, message_id, message_body, correlation_id, message_status, "timestamp", profanity_type
FROM profane""",
    "topic_payload_json": f"""
WITH {PROFANE_CONVERSATIONS}
SELECT 'account_id,message_id,message_body,correlation_id,message_status,timestamp,profanity_type' AS fields,
       account_id, message_id, message_body, correlation_id, message_status, "timestamp", profanity_type
FROM profane""",
    "decode_json_messages": f"""
WITH {DECODE}
SELECT source_partition, "offset", sent_account AS account_id, message_id, message_body, correlation_id,
       message_status, "timestamp", profanity_type
FROM decoded WHERE reason IS NULL""",
    "quarantine_json": f"""
WITH {DECODE}
SELECT source_partition, "offset", reason FROM decoded WHERE reason IS NOT NULL""",
    "instants_parsed": f"""
WITH {IRREGULAR}
SELECT message_id, "timestamp", instant FROM irregular""",
    "lake_rows": f"""
WITH {LAKE}
SELECT account_id, message_id, message_body, correlation_id, message_status, "timestamp", profanity_type
FROM lake""",
    "olap_rows": f"""
WITH {IRREGULAR}
SELECT account_id, message_id, message_body, coalesce(correlation_id, '') AS correlation_id,
       message_status, date_trunc('millisecond', coalesce(instant, TIMESTAMP '2024-02-01')) AS event_time,
       profanity_type
FROM irregular""",
    "event_time_assigned": f"""
WITH {IRREGULAR}
SELECT message_id, coalesce(instant, TIMESTAMP '2024-02-01') AS event_ts FROM irregular""",
    "route_counts_by_day": f"""
WITH {LAKE}
SELECT CASE WHEN profanity_type = 'PROFANITY' THEN 'profanity_messages' ELSE 'safe_messages' END
         AS table_name,
       CAST("timestamp" AS DATE) AS timestamp_day, count(*) AS n
FROM lake GROUP BY 1, 2""",
    "lake_range_scan": f"""
WITH {EVENTS}
SELECT account_id, message_body, profanity_type, ts AS "timestamp"
FROM event_messages WHERE ts > TIMESTAMP '2024-01-15 12:00:00'""",
    "count_all": "SELECT count(*) AS total FROM documents",
    "count_by_type": f"""
WITH {DOCUMENT_TABLE}
SELECT profanity_type, count(*) AS total FROM document_table GROUP BY profanity_type""",
    "type_share": f"""
WITH {DOCUMENT_TABLE}
SELECT profanity_type, count(*) AS total,
       round_even(count(*) * CAST(100.0 AS DOUBLE) / sum(count(*)) OVER (), 2) AS percentage
FROM document_table GROUP BY profanity_type""",
    "recent_messages": f"""
WITH {EVENT_TABLE}
SELECT account_id, message_id, message_body, correlation_id, message_status, event_time, profanity_type
FROM event_table WHERE event_time > TIMESTAMP '2024-01-20 06:00:00' - INTERVAL 24 HOUR""",
    "messages_per_hour": f"""
WITH {EVENT_TABLE}
SELECT date_trunc('hour', event_time) AS hour, count(*) AS message_count
FROM event_table WHERE event_time > TIMESTAMP '2024-01-20 06:00:00' - INTERVAL 24 HOUR
GROUP BY 1 ORDER BY 1""",
    "daily_trend": f"""
WITH {EVENT_TABLE}
SELECT CAST(event_time AS DATE) AS day,
       count(*) FILTER (WHERE profanity_type = 'PROFANITY') AS profane,
       count(*) FILTER (WHERE profanity_type = 'SAFE') AS safe
FROM event_table GROUP BY 1 ORDER BY 1""",
    "top_profane_accounts": f"""
WITH {EVENT_TABLE}
SELECT account_id, count(*) AS profane_messages
FROM event_table WHERE profanity_type = 'PROFANITY'
GROUP BY account_id ORDER BY profane_messages DESC, account_id LIMIT 10""",
    "account_hour_heatmap": f"""
WITH {EVENT_TABLE}
SELECT account_id, CAST(hour(event_time) AS BIGINT) AS hour, count(*) AS messages
FROM event_table GROUP BY 1, 2 ORDER BY 1, 2""",
    "latest_messages": f"""
WITH {EVENT_TABLE}
SELECT account_id, message_id, message_body, correlation_id, message_status, event_time, profanity_type
FROM event_table ORDER BY event_time DESC, account_id, message_id LIMIT 10""",
    "duplicate_keys": f"""
WITH {VERSIONS}
SELECT account_id, message_id, count(*) AS occurrences
FROM versions GROUP BY account_id, message_id HAVING count(*) > 1""",
    "latest_version_rows": LATEST,
    "merged_table": LATEST,
    "lake_after_replay": f"""
WITH {LAKE}
SELECT account_id, message_id, message_body, correlation_id, message_status, "timestamp", profanity_type,
       CAST("timestamp" AS DATE) AS timestamp_day,
       CASE WHEN profanity_type = 'PROFANITY' THEN 'profanity_messages' ELSE 'safe_messages' END
         AS table_name
FROM lake""",
    "lake_in_arrival_order": f"""
WITH {EVENTS}
SELECT CASE WHEN profanity_type = 'PROFANITY' THEN 'profanity_messages' ELSE 'safe_messages' END AS table_name,
       CAST(ts AS DATE) AS timestamp_day, CAST(event_id % 3 AS INTEGER) AS source_partition, event_id AS "offset",
       row_number() OVER (PARTITION BY profanity_type, CAST(ts AS DATE), event_id % 3 ORDER BY event_id) AS place
FROM event_messages""",
    "olap_file_sizes": f"""
WITH {VERSIONS}
SELECT CAST(year(event_time) * 100 + month(event_time) AS INTEGER) AS event_month, count(*) AS n_rows, 0 AS files_off_target
FROM versions WHERE CAST(message_id AS BIGINT) % 8 > 1 GROUP BY 1""",
    "late_rows_audit": f"""
{AUDIT}
SELECT source_partition, "offset", event_ts, watermark, coalesce(event_ts < watermark, false) AS is_late
FROM seen""",
    "stream_late_rows": f"""
{AUDIT}
SELECT source_partition, "offset", event_ts, watermark FROM seen WHERE event_ts < watermark""",
    "windows_by_partition": f"""
WITH {EVENTS},
arrived AS (
  SELECT user_id % 3 AS source_partition, profanity_type,
         ts - CASE WHEN user_id % 3 = 1 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END
            - CASE WHEN event_id % 5 = 0 THEN INTERVAL 5 SECOND ELSE INTERVAL 0 SECOND END AS event_ts
  FROM event_messages JOIN (SELECT event_id, user_id FROM events) USING (event_id)),
clock AS (
  SELECT min(newest) - INTERVAL 10 SECOND AS watermark
  FROM (SELECT date_trunc('millisecond', max(event_ts)) AS newest FROM arrived GROUP BY source_partition)),
timed AS (SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start, profanity_type FROM arrived)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, profanity_type, count(*) AS n
FROM timed, clock WHERE window_start + INTERVAL 5 MINUTE <= watermark
GROUP BY window_start, profanity_type""",
    "window_counts": f"""
WITH {IRREGULAR},
timed AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, coalesce(instant, TIMESTAMP '2024-02-01')) AS window_start,
         profanity_type
  FROM irregular)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, profanity_type, count(*) AS n
FROM timed GROUP BY window_start, profanity_type""",
    "stream_fan_out_counts": f"""
WITH {STREAM}
SELECT 'feed' AS sink, count(*) AS n FROM streamed WHERE NOT rejected AND profanity_type = 'PROFANITY'
UNION ALL
SELECT 'profanity_messages', count(*) FROM streamed
WHERE NOT rejected AND profanity_type = 'PROFANITY' AND NOT bad_time
UNION ALL
SELECT 'safe_messages', count(*) FROM streamed
WHERE NOT rejected AND (profanity_type = 'SAFE' OR bad_time)
UNION ALL
SELECT 'olap', count(*) FROM streamed WHERE NOT rejected
UNION ALL
SELECT 'rejects', count(*) FROM streamed WHERE rejected""",
    "feed_after_replay": f"""
WITH {DECODE}
SELECT sent_account AS account_id, message_id, message_body, 'PROFANITY' AS profanity_type
FROM decoded WHERE reason IS NULL AND regexp_matches(lower(message_body), 'gun|bad|word|violence|hate')""",
    "stream_conservation": f"""
WITH {STREAM}
SELECT name, count(*) FILTER (WHERE counted) AS n
FROM (
  SELECT unnest(['arrived', 'rejected', 'profane', 'safe', 'feed', 'olap', 'rejects', 'profanity_messages', 'safe_messages']) AS name,
         unnest([true, rejected, NOT rejected AND tagged, NOT rejected AND NOT tagged, NOT rejected AND tagged, NOT rejected, rejected,
                 NOT rejected AND tagged AND NOT bad_time, NOT rejected AND NOT (tagged AND NOT bad_time)]) AS counted
  FROM (SELECT rejected, bad_time, profanity_type = 'PROFANITY' AS tagged FROM streamed))
GROUP BY name""",
    "stream_lake_tables": f"""
WITH {STREAM},
instants AS (
  SELECT *, TIMESTAMP '2024-01-01' + to_minutes(doc_id * 7) AS instant FROM streamed WHERE NOT rejected)
SELECT CASE WHEN bad_time THEN '' ELSE account_id END AS account_id,
       CASE WHEN bad_time THEN '' ELSE message_id END AS message_id,
       CASE WHEN bad_time THEN '' ELSE message_body END AS message_body,
       CASE WHEN bad_time THEN '' ELSE correlation_id END AS correlation_id,
       CASE WHEN bad_time THEN 'ERROR' ELSE message_status END AS message_status,
       CASE WHEN NOT bad_time THEN instant END AS "timestamp",
       CASE WHEN bad_time THEN 'SAFE' ELSE profanity_type END AS profanity_type,
       CASE WHEN NOT bad_time THEN CAST(instant AS DATE) END AS timestamp_day,
       CASE WHEN profanity_type = 'PROFANITY' AND NOT bad_time THEN 'profanity_messages'
            ELSE 'safe_messages' END AS table_name
FROM instants""",
}

ORACLES |= {
    f"stored_{name}": _on_stored(ORACLES[name])
    for name in (
        "recent_messages",
        "messages_per_hour",
        "daily_trend",
        "top_profane_accounts",
        "account_hour_heatmap",
        "latest_messages",
    )
}
ORACLES |= {
    "bucketed_latest_versions": LATEST,
    "bucketed_duplicate_keys": ORACLES["duplicate_keys"],
    "stored_type_share": f"""
WITH latest AS ({LATEST})
SELECT profanity_type, count(*) AS total,
       round_even(count(*) * CAST(100.0 AS DOUBLE) / sum(count(*)) OVER (), 2) AS percentage
FROM latest GROUP BY profanity_type""",
    "stored_lake_range": f"""
WITH {LAKE}
SELECT account_id, message_body, profanity_type, "timestamp" FROM lake
WHERE profanity_type <> 'PROFANITY' AND "timestamp" > TIMESTAMP '2024-01-15 12:00:00'""",
    "lake_by_name": ORACLES["lake_after_replay"],
    "job_on_records_counts": f"""
WITH {DOCUMENT_TABLE}
SELECT 'feed' AS sink, count(*) AS n FROM document_table WHERE profanity_type = 'PROFANITY'
UNION ALL SELECT 'profanity_messages', count(*) FROM document_table WHERE profanity_type = 'PROFANITY'
UNION ALL SELECT 'safe_messages', count(*) FROM document_table WHERE profanity_type = 'SAFE'
UNION ALL SELECT 'olap', count(*) FROM document_table""",
}
