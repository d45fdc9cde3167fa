"""SQL that gives the same rows as the registered queries, for checks by another engine."""

from __future__ import annotations

LOG = """
log AS (
  SELECT event_type AS topic, CAST(user_id % 10 AS INTEGER) AS partition, event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key, props AS value, ts AS timestamp
  FROM events)"""

DAMAGED = """
damaged AS (
  SELECT event_type AS topic, CAST(user_id % 10 AS INTEGER) AS partition, event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key, ts AS timestamp,
         CASE WHEN event_id % 97 = 0 THEN substr(props, 1, length(props) - 1)
              WHEN event_id % 101 = 0 THEN 'null'
              WHEN event_id % 103 = 0 THEN '[1]'
              WHEN event_id % 107 = 0 THEN NULL
              WHEN event_id % 109 = 0 THEN '{"k": "x"}'
              ELSE props END AS value
  FROM events),
judged AS (
  SELECT *,
         CASE WHEN value IS NULL OR NOT json_valid(value) OR json_type(value) <> 'OBJECT'
                THEN 'decode_error'
              WHEN TRY_CAST(json_extract_string(value, '$.k') AS INTEGER) IS NULL
                THEN 'reject_error' END AS error_class
  FROM damaged)"""

ENVELOPE = """
envelope AS (
  SELECT event_type AS topic, CAST(user_id % 10 AS INTEGER) AS partition, event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key,
         CAST(user_id AS VARCHAR) || CASE WHEN event_id % 41 = 0 THEN 'x' ELSE '' END AS id,
         event_type, value AS amount
  FROM events)"""

NAMED = """
named AS (
  SELECT *, coalesce(id, key) AS own,
         replace(to_json(struct_pack(id := id, event_type := event_type, amount := amount)), '"id":null,', '') AS value
  FROM (SELECT event_type AS topic, CAST(user_id % 10 AS INTEGER) AS partition, event_id AS "offset",
               ts AS timestamp,
               CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS key,
               CASE WHEN event_id % 43 <> 0 THEN
                 CAST(user_id AS VARCHAR) || CASE WHEN event_id % 41 = 0 THEN 'x' ELSE '' END END AS id,
               event_type, value AS amount
        FROM events))"""

BY_ID = f"""
WITH {NAMED},
arrived AS (
  SELECT own AS key, topic, partition, max("offset") AS "offset",
         arg_max(timestamp, "offset") AS timestamp, arg_max(amount, "offset") AS amount
  FROM named WHERE own IS NOT NULL GROUP BY own, topic, partition)
SELECT key, topic, partition, "offset", amount FROM arrived
QUALIFY row_number() OVER (PARTITION BY key ORDER BY timestamp DESC, topic DESC, partition DESC) = 1"""

BY_OFFSET = """
WITH shifted AS (
  SELECT event_type AS topic, CAST(user_id % 10 AS INTEGER) AS partition, event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key, props, ts - to_days(CAST(event_id % 7 AS INTEGER)) AS ts
  FROM events),
arrived AS (
  SELECT key, topic, partition, max("offset") AS "offset", arg_max(ts, "offset") AS ts,
         arg_max(props, "offset") AS props
  FROM shifted GROUP BY key, topic, partition)
SELECT key, topic, partition, "offset", epoch_us(ts) AS ts_us,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM arrived
QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, topic DESC, partition DESC) = 1"""

TARGETS = """
targets AS (
  SELECT 'c' || CAST(s_suppkey % 2 AS VARCHAR) AS collection,
         CAST(s_suppkey % 4 AS INTEGER) AS shard_id, s_name AS core,
         CASE s_nationkey % 3 WHEN 0 THEN 'NRT' WHEN 1 THEN 'TLOG' ELSE 'PULL' END AS replica_type,
         CASE WHEN s_suppkey % 17 = 0 THEN 'down' ELSE 'active' END AS state,
         s_suppkey = min(s_suppkey) OVER (PARTITION BY s_suppkey % 2, s_suppkey % 4) AS is_leader,
         CAST(100 + s_suppkey % 4 + CASE WHEN s_suppkey % 29 = 0 THEN 1 ELSE 0 END AS BIGINT)
           AS num_docs
  FROM supplier)"""

LEDGER = """
ledger AS (
  SELECT 'KafkaImporterGroup:events' AS group_id, date_trunc('day', timestamp) AS round, topic,
         partition, max("offset") + 1 AS next_offset,
         date_trunc('day', timestamp) + INTERVAL 2 DAY AS commit_at,
         count(*) AS n_ok, CAST(0 AS BIGINT) AS n_bad
  FROM log GROUP BY 2, 3, 4)"""

MOMENT = "TIMESTAMP '2024-01-20 00:00:00'"

COMMITTED = f"""
committed AS (
  SELECT group_id, topic, partition, max(next_offset) AS committed_offset
  FROM ledger WHERE commit_at <= {MOMENT} GROUP BY group_id, topic, partition)"""

LAG = f"""
ends AS (
  SELECT topic, partition, max("offset") + 1 AS end_offset
  FROM log WHERE timestamp < {MOMENT} GROUP BY topic, partition),
lags AS (
  SELECT group_id, topic, partition, end_offset, committed_offset,
         end_offset - committed_offset AS lag,
         topic || '-' || CAST(partition AS VARCHAR) || ':' || group_id AS lag_key
  FROM committed JOIN ends USING (topic, partition))"""

LATEST_LOG = """
SELECT key, arg_max(topic, "offset") AS topic, arg_max(partition, "offset") AS partition,
       max("offset") AS "offset", arg_max(epoch_us(timestamp), "offset") AS ts_us,
       CAST(arg_max(json_extract_string(value, '$.k'), "offset") AS INTEGER) AS k
FROM log GROUP BY key"""

CURRENT = f"WITH {LOG} {LATEST_LOG}"

SUMMARY = """
       CAST(coalesce(sum(lag), 0) AS BIGINT) AS total_lag, max(lag) AS max_partition_lag,
       arg_max(lag_key, {lag: lag, t: topic, p: partition, g: group_id}) AS most_behind_partition"""

SHARD = "CAST(CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % 4 AS INTEGER)"

# A poll sees the records before it and the commits up to it.
HISTORY = """
polls AS (
  SELECT unnest(generate_series(
    (SELECT min(date_trunc('day', timestamp)) + INTERVAL 1 DAY FROM log),
    (SELECT max(date_trunc('day', timestamp)) + INTERVAL 1 DAY FROM log), INTERVAL 1 DAY)) AS poll),
seen_ends AS (
  SELECT poll, topic, partition, max("offset") + 1 AS end_offset
  FROM polls JOIN (SELECT topic, partition, date_trunc('day', timestamp) AS d, max("offset") AS "offset"
                   FROM log GROUP BY 1, 2, 3) ON d < poll
  GROUP BY 1, 2, 3),
seen_commits AS (
  SELECT poll, group_id, topic, partition, max(next_offset) AS committed_offset
  FROM polls JOIN ledger ON commit_at <= poll GROUP BY 1, 2, 3, 4),
history AS (
  SELECT group_id, poll, CAST(sum(greatest(end_offset - committed_offset, 0)) AS BIGINT) AS total_lag
  FROM seen_commits JOIN seen_ends USING (poll, topic, partition) GROUP BY 1, 2)"""

TOPIC_LEDGER = """
ledger AS (
  SELECT 'KafkaImporterGroup:' || topic AS group_id, date_trunc('day', timestamp) AS round, topic,
         partition, max("offset") + 1 AS next_offset,
         date_trunc('day', timestamp) + INTERVAL 2 DAY AS commit_at
  FROM log GROUP BY topic, 2, partition)"""


def _random_text() -> str:
    def draw(purpose: str, digits: int = 8) -> str:
        return f"CAST('0x' || substr(md5('7:{purpose}:' || CAST(doc_id AS VARCHAR)), 1, {digits}) AS BIGINT)"

    digest = "md5('7:' || CAST(doc_id AS VARCHAR))"
    uuid = " || '-' || ".join(
        f"substr({digest}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    )
    return f"""
SELECT {uuid} AS id,
       base64(encode(array_to_string(list_transform(range(1, {draw('length')} % 100 + 1),
         lambda i: CAST(({draw('start')} % 2147483648 + i) * 2654435761 % 4294967296 - 2147483648
                        AS VARCHAR)), ''))) AS text,
       CAST({draw('int')} - 2147483648 AS INTEGER) AS doc_number,
       {draw('double', 13)} / 4503599627370496.0::DOUBLE AS doc_double,
       {draw('flag')} % 2 = 1 AS some_flag
FROM documents"""


def _sample_docs() -> str:
    digest = "md5('7:' || CAST(event_id AS VARCHAR))"
    uuid = " || '-' || ".join(
        f"substr({digest}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    )
    return f"""
SELECT 'doc_' || {uuid} AS id, 'Hi mom' AS title,
       strftime(ts, '%a %b %d %H:%M:%S UTC %Y') AS date
FROM events"""


def _field_profile() -> str:
    def of(fields: tuple[str, ...], table: str) -> str:
        columns = ", ".join(f"'{f}', {f}" for f in fields)
        return f"SELECT json_object({columns}) AS doc FROM {table}"

    docs = of(("doc_id", "text", "lang", "source", "n_chars"), "documents")
    events = of(("id", "event_type", "amount"), "envelope")
    return f"""
WITH {ENVELOPE}, docs AS ({docs} UNION ALL {events}),
fields AS (SELECT unnest(json_keys(doc)) AS field, doc FROM docs)
SELECT field,
       CASE json_type(doc, '$.' || field)
         WHEN 'BIGINT' THEN 'integer' WHEN 'UBIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number'
         WHEN 'VARCHAR' THEN 'string' ELSE lower(json_type(doc, '$.' || field)) END AS json_type,
       count(*) AS n_docs
FROM fields GROUP BY 1, 2"""


def _inferred() -> str:
    return f"""
WITH profile AS ({_field_profile()}),
kinds AS (
  SELECT field, list_sort(list(DISTINCT json_type) FILTER (json_type <> 'null')) AS kinds,
         CAST(sum(n_docs) AS BIGINT) AS n_docs FROM profile GROUP BY field)
SELECT field,
       CASE WHEN kinds IS NULL OR len(kinds) = 0 THEN 'null' WHEN len(kinds) = 1 THEN kinds[1]
            WHEN len(list_filter(kinds, lambda k: k NOT IN ('integer', 'number'))) = 0 THEN 'number'
            ELSE 'mixed' END AS json_type, n_docs
FROM kinds"""


def oracle_sql() -> dict[str, str]:
    ledger = f"WITH {LOG}, {LEDGER}"
    lag = f"{ledger}, {COMMITTED}, {LAG}"
    next_ok = 'max("offset") + 1'
    early = "TIMESTAMP '2024-01-03 12:00:00'"
    damaged_current = f"""
WITH {DAMAGED}
SELECT key, arg_max(topic, "offset") AS topic, arg_max(partition, "offset") AS partition,
       max("offset") AS "offset", arg_max(epoch_us(timestamp), "offset") AS ts_us,
       CAST(arg_max(json_extract_string(value, '$.k'), "offset") AS INTEGER) AS k
FROM judged WHERE error_class IS NULL GROUP BY key"""
    quarantine = f"""
WITH {DAMAGED}
SELECT topic, partition, "offset", key, value, error_class FROM judged
WHERE error_class IS NOT NULL"""
    shards = f"SELECT {SHARD} AS shard_id, count(DISTINCT key) AS n_docs FROM log GROUP BY 1"
    eligible = "SELECT * FROM targets WHERE replica_type = 'NRT' OR is_leader"
    mismatch = f"""
SELECT 'events' AS collection, 2 AS shard_id, count(*) FILTER (CAST(key AS BIGINT) % 2 = 0) AS min_docs,
       count(*) AS max_docs, CAST(2 AS BIGINT) AS n_replicas, CAST(0 AS BIGINT) AS n_unknown
FROM (SELECT DISTINCT key FROM log) WHERE {SHARD} = 2 HAVING min_docs < max_docs"""
    return {
        "current_docs": CURRENT,
        "current_docs_ranked": CURRENT,
        "current_docs_by_offset": BY_OFFSET,
        "current_docs_by_id": BY_ID,
        "current_docs_per_topic": f"""
WITH {LOG}
SELECT key, topic, arg_max(partition, "offset") AS partition, max("offset") AS "offset",
       arg_max(epoch_us(timestamp), "offset") AS ts_us,
       CAST(arg_max(json_extract_string(value, '$.k'), "offset") AS INTEGER) AS k
FROM log GROUP BY topic, key""",
        "upsert_replay": CURRENT,
        "upsert_compact": CURRENT,
        "upsert_damaged": damaged_current,
        "doc_upsert_documents": """
SELECT lang || ':' || source AS key, max(doc_id) AS doc_id, arg_max(lang, doc_id) AS lang,
       arg_max(source, doc_id) AS source, arg_max(n_chars, doc_id) AS n_chars,
       arg_max(text, doc_id) AS text
FROM documents GROUP BY 1""",
        "conversation_latest_turn": """
SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text
FROM conversations GROUP BY conv_id""",
        "page_latest_by_host": """
SELECT coalesce(nullif(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), ''), url) AS host, max(page_id) AS page_id,
       arg_max(url, page_id) AS url, arg_max(html, page_id) AS html
FROM pages GROUP BY 1""",
        "key_partition_violations": """
WITH places AS (
  SELECT 'by_key' AS log, event_type AS topic, user_id AS key, user_id % 10 AS partition FROM events
  UNION ALL
  SELECT 'dealt', event_type, user_id, event_id % 10 FROM events),
keys AS (
  SELECT log, topic, key, count(DISTINCT partition) > 1 AS split FROM places GROUP BY 1, 2, 3)
SELECT log, topic, count(*) AS n_keys, count(*) FILTER (split) AS n_split_keys
FROM keys GROUP BY log, topic""",
        "decode_json": f"WITH {ENVELOPE} SELECT * FROM envelope",
        "decode_variant": f'WITH {ENVELOPE} SELECT "offset", id, event_type, amount FROM envelope',
        "decode_raw": f'WITH {DAMAGED} SELECT "offset", key, value AS text FROM damaged WHERE value IS NOT NULL',
        "encode_json": """
SELECT CAST(doc_id AS VARCHAR) AS key, doc_id, text, lang, source, n_chars FROM documents""",
        "decode_classify": f"""
WITH {DAMAGED}
SELECT coalesce(error_class, 'ok') AS outcome, count(*) AS n_records FROM judged GROUP BY 1""",
        "quarantine_rows": f"""
WITH {DAMAGED}
SELECT topic, partition, "offset", key, value, error_class,
       CASE WHEN value IS NULL THEN 'tombstone' WHEN error_class = 'decode_error'
            THEN 'not a JSON object' ELSE 'field does not fit the schema' END AS error_detail
FROM judged WHERE error_class IS NOT NULL""",
        "flatten_fields": f"""
WITH {ENVELOPE},
fields AS (
  SELECT "offset", 'id' AS field, id AS v FROM envelope
  UNION ALL SELECT "offset", 'event_type', event_type FROM envelope
  UNION ALL SELECT "offset", 'amount', CAST(amount AS VARCHAR) FROM envelope)
SELECT "offset", field, CASE WHEN TRY_CAST(v AS DOUBLE) IS NULL THEN v END AS text,
       TRY_CAST(v AS DOUBLE) AS number FROM fields""",
        "infer_schema": _inferred(),
        "field_profile": _field_profile(),
        "key_id_mismatch": f"""
WITH {ENVELOPE}
SELECT topic, partition, "offset", key, id AS doc_id FROM envelope WHERE key <> id""",
        "base64_documents": "SELECT doc_id, base64(encode(text)) AS encoded FROM documents",
        "event_date_text": """
SELECT event_id, strftime(ts, '%a %b %d %H:%M:%S UTC %Y') AS date FROM events""",
        "shard_route_counts": f"WITH {LOG} {shards}",
        "shard_sum_check": f"""
WITH {LOG}
SELECT count(DISTINCT key) AS shard_sum, count(DISTINCT key) AS expected, true AS agrees FROM log""",
        "fanout_counts": f"""
WITH {LOG}
SELECT CAST(s AS INTEGER) AS shard_id, count(DISTINCT key) AS n_docs
FROM log CROSS JOIN range(4) t(s) GROUP BY 1""",
        "fanout_documents": f"""
WITH {LOG}, current AS ({LATEST_LOG})
SELECT current.*, CAST(s AS INTEGER) AS shard_id FROM current CROSS JOIN range(4) t(s)""",
        "fanout_targets": f"""
WITH {LOG}, {TARGETS}
SELECT collection, shard_id, core, key
FROM targets JOIN (SELECT DISTINCT key, 'c' || CAST(CAST(key AS BIGINT) % 2 AS VARCHAR) AS collection FROM log)
  USING (collection)
WHERE replica_type = 'NRT' OR is_leader""",
        "fanout_target_counts": f"""
WITH {LOG}, {TARGETS},
counts AS (
  SELECT 'c' || CAST(CAST(key AS BIGINT) % 2 AS VARCHAR) AS collection, count(DISTINCT key) AS n_docs FROM log GROUP BY 1)
SELECT collection, shard_id, core, n_docs FROM targets JOIN counts USING (collection)
WHERE replica_type = 'NRT' OR is_leader""",
        "shard_count_check": f"""
WITH {LOG}
SELECT 2 AS shard_id, count(DISTINCT key) FILTER (CAST(key AS BIGINT) % 2 = 0) AS n_docs,
       count(DISTINCT key) AS expected FROM log""",
        "eligible_targets": f"WITH {TARGETS} {eligible}",
        "mode_precondition": f"""
WITH {TARGETS}
SELECT collection, bool_or(replica_type = 'TLOG') AS has_tlog,
       NOT bool_or(replica_type = 'TLOG') AS all_shards_allowed
FROM targets GROUP BY collection""",
        "inactive_targets": f"""
WITH {TARGETS}
SELECT collection, shard_id, core, state FROM targets
WHERE collection = 'c0' AND state <> 'active'""",
        "replica_mismatch": f"WITH {LOG} {mismatch}",
        "error_report": f"""
WITH {LOG}, wrong AS ({mismatch})
SELECT collection, shard_id,
       'shard ' || shard_id || ': between ' || min_docs || ' and ' || max_docs || ' documents' AS message
FROM wrong""",
        "doc_count": f"WITH {LOG} SELECT count(DISTINCT key) AS n_docs FROM log",
        "seeded_vs_end": f"""
WITH {LOG},
ends AS (SELECT topic, partition, max("offset") + 1 AS e FROM log GROUP BY 1, 2),
sums AS (SELECT topic, CAST(sum(e) AS BIGINT) AS end_sum FROM ends GROUP BY 1),
sent AS (SELECT topic, count(*) AS n_records FROM log GROUP BY 1)
SELECT topic, n_records, end_sum, n_records = end_sum AS agrees FROM sent JOIN sums USING (topic)""",
        "end_offsets": f"""
WITH {LOG} SELECT topic, partition, {next_ok} AS end_offset FROM log GROUP BY 1, 2""",
        "end_offsets_by_name": f"""
WITH {LOG}
SELECT topic || CAST(partition AS VARCHAR) AS end_key, {next_ok} AS end_offset
FROM log WHERE topic = 'view' GROUP BY 1""",
        "next_offsets_ok": f"""
WITH {DAMAGED}
SELECT topic, partition, {next_ok} AS next_offset FROM judged WHERE error_class IS NULL
GROUP BY 1, 2""",
        "commit_ledger_daily": f"""
{ledger}
SELECT group_id, CAST(epoch(round) AS BIGINT) AS round_s, topic, partition, next_offset,
       CAST(epoch(commit_at) AS BIGINT) AS commit_s, n_ok, n_bad FROM ledger""",
        "committed_as_of": f"{ledger}, {COMMITTED} SELECT * FROM committed",
        "lag_report": f"{lag} SELECT * FROM lags",
        "lag_uncommitted": f"""
{ledger},
committed AS (
  SELECT group_id, topic, partition, max(next_offset) AS committed_offset
  FROM ledger WHERE commit_at <= {early} GROUP BY 1, 2, 3),
ends AS (
  SELECT topic, partition, max("offset") + 1 AS end_offset
  FROM log WHERE timestamp < {early} GROUP BY 1, 2),
expected AS (SELECT * FROM ends JOIN (SELECT DISTINCT group_id, topic FROM committed) USING (topic))
SELECT group_id, topic, partition, end_offset, coalesce(committed_offset, 0) AS committed_offset,
       end_offset - coalesce(committed_offset, 0) AS lag,
       topic || '-' || CAST(partition AS VARCHAR) || ':' || group_id AS lag_key
FROM expected LEFT JOIN committed USING (group_id, topic, partition)""",
        "lag_summary": f"{lag} SELECT {SUMMARY} FROM lags",
        "lag_top_k": f"""
{lag} SELECT lag_key, lag FROM lags ORDER BY lag DESC, topic, partition, group_id LIMIT 5""",
        "lag_history": f"""
{ledger}, {HISTORY}
SELECT group_id, CAST(epoch(poll) AS BIGINT) AS poll_s, total_lag FROM history""",
        "lag_stalls": f"""
WITH {LOG}, {TOPIC_LEDGER}, {HISTORY},
compared AS (
  SELECT *, lag(total_lag, 1, 0) OVER (PARTITION BY group_id ORDER BY poll) AS previous,
         coalesce(bool_or(total_lag <= 0) OVER (PARTITION BY group_id ORDER BY poll
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over
  FROM history)
SELECT group_id, count(*) FILTER (NOT over) AS n_polls,
       count(*) FILTER (NOT over AND total_lag > 0 AND total_lag = previous) AS n_still,
       count(*) FILTER (NOT over AND total_lag > 0 AND total_lag = previous) > 10 AS stalled
FROM compared GROUP BY group_id""",
        "replay_window": f"""
{ledger}, {COMMITTED}
SELECT topic, partition, count(*) AS n_records, min("offset") AS first_offset
FROM log LEFT JOIN committed USING (topic, partition)
WHERE "offset" >= coalesce(committed_offset, 0) GROUP BY topic, partition""",
        "replay_tail": f"""
{ledger}, {COMMITTED}
SELECT topic, partition, count(*) AS n_records, min("offset") AS first_offset, CAST(sum(length(value)) AS BIGINT) AS n_chars
FROM log LEFT JOIN committed USING (topic, partition)
WHERE "offset" >= coalesce(committed_offset, 0) GROUP BY topic, partition""",
        "zoned_end_offsets": f"""
WITH {LOG} SELECT topic, partition, {next_ok} AS end_offset FROM log GROUP BY 1, 2""",
        "offset_gaps": f"""
WITH {LOG},
steps AS (
  SELECT topic, partition, "offset",
         lead("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS next_offset
  FROM log)
SELECT *, next_offset - "offset" - 1 AS n_missing FROM steps WHERE next_offset - "offset" > 1""",
        "stream_gaps": f"""
WITH {LOG},
steps AS (
  SELECT topic, partition, "offset",
         lead("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS next_offset
  FROM log)
SELECT *, next_offset - "offset" - 1 AS n_missing FROM steps WHERE next_offset - "offset" > 1""",
        "offset_gap_totals": f"""
WITH {LOG}
SELECT topic, partition, min("offset") AS first_offset, max("offset") AS last_offset,
       count(*) AS n_records, max("offset") - min("offset") + 1 - count(*) AS n_missing
FROM log GROUP BY 1, 2""",
        "group_names": f"""
WITH {TARGETS}
SELECT core, 'KafkaImporterGroup:' || collection AS routed_group,
       'KafkaImporterGroup:' || collection || ':' || core AS all_shard_group FROM targets""",
        "ingest_status_report": f"""
{lag}
SELECT 'core1' AS current_core, 'STOPPED' AS status,
       string_agg(lag_key || '=' || lag, ',' ORDER BY lag_key) AS consumer_group_lag, {SUMMARY},
       false AS should_run, true AS leader, true AS eligible FROM lags""",
        "interval_metrics": f"""
WITH {LOG},
per AS (
  SELECT date_trunc('hour', timestamp) AS h, count(*) AS n_docs, min(timestamp) AS a,
         max(timestamp) AS b FROM log GROUP BY 1),
totals AS (
  SELECT *, CAST(sum(n_docs) OVER (ORDER BY h) AS BIGINT) AS total_docs,
         (epoch_us(b) - epoch_us((SELECT min(timestamp) FROM log))) // 1000 AS elapsed_ms FROM per)
SELECT CAST(epoch(h) AS BIGINT) AS interval_s, n_docs, total_docs, elapsed_ms,
       round(elapsed_ms::DOUBLE / total_docs, 6) AS avg_ms_per_doc,
       round((epoch_us(b) - epoch_us(a)) // 1000 / 1000.0::DOUBLE, 3) AS busy_seconds
FROM totals""",
        "throughput": f"""
WITH {LOG},
per AS (
  SELECT topic, count(*) AS n_docs,
         (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) // 1000 / 1000.0::DOUBLE AS seconds
  FROM log GROUP BY topic)
SELECT topic, n_docs, round(seconds, 3) AS seconds, round(n_docs / nullif(seconds, 0), 9) AS docs_per_second
FROM per""",
        "send_rate": f"""
WITH {LOG},
chunks AS (
  SELECT CAST(floor("offset" / 1000) AS BIGINT) AS chunk, count(*) AS n_sent, max("offset") + 1 AS total_sent,
         (epoch_us(max(timestamp)) - epoch_us((SELECT min(timestamp) FROM log))) // 1000 AS elapsed_ms
  FROM log GROUP BY 1)
SELECT *, round(1000.0::DOUBLE * total_sent / nullif(elapsed_ms, 0), 9) AS docs_per_second FROM chunks""",
        "random_docs": _random_text(),
        "sample_docs": _sample_docs(),
        "seeded_docs": """
SELECT 'docs' AS topic, CAST(doc_id % 10 AS INTEGER) AS partition, doc_id // 10 AS "offset",
       CAST(doc_id AS VARCHAR) AS key, doc_id, lang, source, n_chars, text FROM documents""",
        "stream_current_docs": CURRENT,
        "stream_compacted_docs": CURRENT,
        "stream_docs_by_offset": BY_OFFSET,
        "stream_docs_by_id": BY_ID,
        "stream_nameless": f"""
WITH {NAMED}
SELECT topic, partition, "offset", key, value, 'reject_error' AS error_class,
       'neither a document id nor a key' AS error_detail
FROM named WHERE own IS NULL""",
        "stream_all_shards": f"""
WITH {LOG}
SELECT CAST(s AS INTEGER) AS shard_id, count(DISTINCT key) AS n_docs
FROM log CROSS JOIN range(4) t(s) GROUP BY 1""",
        "stream_quarantine": f"""
WITH {DAMAGED}
SELECT topic, partition, "offset", key, value, error_class, true AS has_detail FROM judged
WHERE error_class IS NOT NULL""",
        "stream_lag": f"""
WITH {DAMAGED}, ends AS (
SELECT 'KafkaImporterGroup:events' AS group_id, topic, partition, max("offset") + 1 AS end_offset,
       coalesce(max("offset") FILTER (error_class IS NULL) + 1, 0) AS committed_offset
FROM judged GROUP BY topic, partition)
SELECT *, end_offset - committed_offset AS lag,
       topic || '-' || CAST(partition AS VARCHAR) || ':' || group_id AS lag_key FROM ends""",
        "stream_lag_before_start": f"""
WITH {LOG}, lags AS (
SELECT 'KafkaImporterGroup:events' AS group_id, topic, partition, max("offset") + 1 AS lag,
       topic || '-' || CAST(partition AS VARCHAR) || ':KafkaImporterGroup:events' AS lag_key
FROM log GROUP BY topic, partition)
SELECT {SUMMARY} FROM lags""",
        "stream_commit_ledger": f"""
WITH {DAMAGED}
SELECT 'KafkaImporterGroup:events' AS group_id, topic, partition,
       max("offset") FILTER (error_class IS NULL) + 1 AS next_offset,
       count(*) FILTER (error_class IS NULL) AS n_ok, count(*) FILTER (error_class IS NOT NULL) AS n_bad
FROM judged GROUP BY topic, partition""",
    }
