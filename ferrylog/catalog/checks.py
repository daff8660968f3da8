"""The registered queries in SQL over the same ``events`` and ``documents``.

Written from the mapping's rules and DuckDB's own JSON and window functions,
so that a query and its check share no logic.
"""

from __future__ import annotations

from ferrylog import fixtures as fx
from ferrylog.catalog import queries as q

_SEVERITY = """CASE {0} WHEN 0 THEN 'EMERGENCY' WHEN 1 THEN 'ALERT' WHEN 2 THEN 'CRITICAL'
  WHEN 3 THEN 'ERROR' WHEN 4 THEN 'WARNING' WHEN 5 THEN 'NOTICE' WHEN 6 THEN 'INFO'
  WHEN 7 THEN 'DEBUG' ELSE 'INFO' END"""

_BASE = f"""
ev AS (
  SELECT event_id, user_id, event_type, props, epoch_us(ts) // 1000 AS ms,
         event_id % 25 AS kind, user_id % 10 AS sev, user_id % 24 AS facility
  FROM events),
entries AS (
  SELECT *, ms AS id_ms, event_id AS id_seq,
    ms || '-' || event_id AS id, 'syslog:' || event_type AS stream,
    CASE kind
      WHEN 0 THEN ''
      WHEN 1 THEN '{{"hostname":"h' || user_id || '"}}'
      WHEN 2 THEN 'not json'
      WHEN 3 THEN '{{"severity":"' || sev || '"}}'
      WHEN 4 THEN '{{"hostname":"h' || user_id || '","severity":' || sev || ',"raw":"inner"}}'
      WHEN 5 THEN '{{"severity":' || sev || ',"structured_data":{{"hall":{{"row":{{"seat":"' || user_id || '"}}}}}}}}'
      WHEN 6 THEN '{{"severity":' || sev || ',"structured_data":"-"}}'
      ELSE '{{"hostname":"h' || user_id || '","severity":' || sev || ',"facility":' || facility
           || ',"structured_data":{{"site@7":' || props || '}}}}'
    END AS object,
    CASE WHEN kind IN (0, 7) THEN ''
         ELSE '<' || (facility * 8 + sev % 8) || '>1 ' || event_type || ' ' || event_id END AS raw
  FROM ev),
parsed AS (
  SELECT *, CASE WHEN object <> '' AND json_valid(object) THEN object::JSON END AS j FROM entries),
lines AS (
  SELECT *, CASE WHEN object = '' AND raw = '' THEN NULL ELSE
    id || chr(9) || stream || chr(9) || body END AS line
  FROM (
    SELECT *, CASE
      WHEN kind = 0 THEN ''
      WHEN kind = 1 THEN '{{"hostname":"h' || user_id || '",'
      WHEN kind = 2 THEN '{{'
      WHEN kind = 3 THEN '{{"severity":"INFO",'
      WHEN kind = 4 THEN '{{"hostname":"h' || user_id || '","severity":"' || name || '",'
      WHEN kind = 5 THEN '{{"severity":"' || name || '","seat":"' || user_id || '",'
      WHEN kind = 6 THEN '{{"severity":"' || name || '",'
      ELSE '{{"hostname":"h' || user_id || '","severity":"' || name || '","facility":' || facility
           || ',"k":' || json_extract(props, '$.k') || ','
      END || '"raw":"' || CASE raw WHEN '' THEN '-' ELSE raw END || '"}}' AS body
    FROM (SELECT *, {_SEVERITY.format("sev")} AS name FROM entries))),
deliveries AS (
  SELECT *, 'relay-' || ((ms - {fx.START_MS}) // {5 * fx.DAY_MS}) AS consumer,
    ms + 1000 AS delivered_at_ms
  FROM entries WHERE event_id % 3 <> 0),
outcomes AS (
  SELECT *, event_id % 4 <> 3 AS ack FROM deliveries WHERE event_id % 4 <> 0),
acks AS (
  SELECT stream, (event_id // 100) * 2 + CASE WHEN ack THEN 0 ELSE 1 END AS arrival, ack,
    string_agg(id, ',' ORDER BY ms, event_id) AS ids, count(*) AS n
  FROM outcomes GROUP BY 1, 2, 3),
bad(arrival, stream, ids, ack, reason) AS (VALUES
  (-1, '', '', false, 'malformed'), (-2, '', '', false, 'malformed'),
  (-3, '', '', true, 'ids'), (-4, '', '', false, 'ids'),
  (-5, 's', '', true, 'ids'), (-6, '', 'msg-123', true, 'stream'),
  (-7, '', 'msg-123', true, 'stream'), (-8, '', '', false, 'undecodable'),
  (-9, '', '', false, 'malformed'), (-10, '', '', false, 'malformed')),
pending AS (
  SELECT *, {fx.NOW_MS} - delivered_at_ms AS idle_ms FROM deliveries d
  WHERE NOT EXISTS (SELECT 1 FROM outcomes o WHERE o.stream = d.stream AND o.id = d.id AND o.ack)),
ranked_idle AS (
  SELECT *, row_number() OVER (PARTITION BY stream ORDER BY id_ms, id_seq) AS rn
  FROM pending WHERE idle_ms >= {fx.CLAIM_IDLE_MS}),
chosen AS (SELECT * FROM ranked_idle WHERE rn <= {q.CLAIM_BATCH}),
claimed AS (SELECT * FROM chosen),
consumers AS (
  SELECT stream, consumer, max(delivered_at_ms) AS last_seen_ms FROM deliveries GROUP BY 1, 2
  UNION ALL
  SELECT DISTINCT stream, 'spare', {fx.START_MS} FROM entries),
info AS (
  SELECT c.stream, c.consumer, count(p.id) AS pending,
    {fx.NOW_MS} - max(greatest(c.last_seen_ms, coalesce(p.delivered_at_ms, 0))) AS idle_ms
  FROM consumers c LEFT JOIN pending p ON p.stream = c.stream AND p.consumer = c.consumer
  GROUP BY 1, 2),
dead AS (
  SELECT * FROM info
  WHERE consumer <> '{fx.SELF}' AND idle_ms > {fx.CONSUMER_IDLE_TIMEOUT_MS}),
cursors AS (
  SELECT DISTINCT stream, {fx.START_MS + 15 * fx.DAY_MS} AS c_ms, 0 AS c_seq
  FROM entries WHERE event_type NOT IN ('error', 'view')),
fresh AS (
  SELECT * FROM (
    SELECT e.*, row_number() OVER (PARTITION BY e.stream ORDER BY id_ms, id_seq) AS rn
    FROM entries e LEFT JOIN cursors c ON c.stream = e.stream
    WHERE c.stream IS NULL OR id_ms > c_ms OR (id_ms = c_ms AND id_seq > c_seq))
  WHERE rn <= {q.READ_BATCH}),
packed AS (
  SELECT stream, batch, count(line) AS n_lines, count(*) - count(line) AS n_skipped,
    CAST(sum(strlen(line)) + count(line) - 1 AS BIGINT) AS raw_bytes
  FROM (SELECT *, (row_number() OVER (PARTITION BY stream ORDER BY id_ms, id_seq) - 1)
          // {q.PACK_BATCH} AS batch FROM lines)
  GROUP BY 1, 2 HAVING count(line) > 0),
m AS (
  SELECT *, row_number() OVER (PARTITION BY stream ORDER BY arrival) AS rn FROM acks),
walk AS (
  SELECT stream, rn, 0::BIGINT AS batch, n AS acc FROM m WHERE rn = 1
  UNION ALL
  SELECT m.stream, m.rn, w.batch + CASE WHEN w.acc >= {q.FLUSH_IDS} THEN 1 ELSE 0 END,
    m.n + CASE WHEN w.acc >= {q.FLUSH_IDS} THEN 0 ELSE w.acc END
  FROM walk w JOIN m ON m.stream = w.stream AND m.rn = w.rn + 1),
flushes AS (
  SELECT stream, batch, count(*) AS messages,
    coalesce(string_agg(ids, ',' ORDER BY arrival) FILTER (ack), '') AS ack_ids,
    CAST(coalesce(sum(n) FILTER (NOT ack), 0) AS BIGINT) AS nack_count
  FROM walk JOIN m USING (stream, rn) GROUP BY 1, 2),
changes AS (
  SELECT DISTINCT stream, CASE WHEN stream = 'syslog:error' THEN 'new' ELSE 'kept' END AS change
  FROM entries
  UNION ALL SELECT 'syslog:gone', 'removed')
"""

_ENTRY = "SELECT id, stream, object, raw FROM entries"
_LINE_JSON = "SELECT id, stream, body AS json FROM lines WHERE line IS NOT NULL"
_NAMED = f"""
  SELECT id, CASE WHEN json_type(j, '$.severity') IN ('UBIGINT', 'BIGINT')
    THEN {_SEVERITY.format("CAST(json_extract_string(j, '$.severity') AS BIGINT)")}
    ELSE 'INFO' END AS severity
  FROM parsed WHERE json_extract(j, '$.severity') IS NOT NULL"""
_ACK_ROWS = "SELECT stream, id, ack FROM outcomes"
_UNACKED = f"""
  SELECT stream, id FROM deliveries d WHERE NOT EXISTS (
    SELECT 1 FROM outcomes o WHERE o.id = d.id AND o.stream = d.stream AND o.ack
      AND (o.event_id % 7) * {3 * fx.DAY_MS} <= {fx.CLAIM_IDLE_MS})"""

# fixed values: 32-bit FNV-1a offset and prime
_SHARDS = """
  SELECT e.id, h.hash, h.hash % 50 AS shard FROM entries e JOIN (
    SELECT stream, list_reduce(
      list_prepend(2166136261::BIGINT,
        list_transform(string_split(stream, ''), lambda c: ord(c)::BIGINT)),
      lambda h, b: (xor(h, b) * 16777619) % 4294967296) AS hash
    FROM (SELECT DISTINCT stream FROM entries)) h USING (stream)"""

_TIMED = f"""
lane_m AS (
  SELECT *, arrival % {q.LANES} AS lane, arrival * 60000 AS at_ms,
    row_number() OVER (PARTITION BY stream, arrival % {q.LANES} ORDER BY arrival) AS rn
  FROM acks),
lane_walk AS (
  SELECT stream, lane, rn, 0::BIGINT AS batch, n AS acc, at_ms AS since FROM lane_m WHERE rn = 1
  UNION ALL
  SELECT stream, lane, rn, batch + CASE WHEN cut THEN 1 ELSE 0 END,
    n + CASE WHEN cut THEN 0 ELSE acc END, CASE WHEN cut THEN at_ms ELSE since END
  FROM (
    SELECT x.stream, x.lane, x.rn, w.batch, w.acc, w.since, x.n, x.at_ms,
      w.acc >= {q.FLUSH_IDS} OR x.at_ms >= w.since + {q.STREAM_FLUSH_MS} AS cut
    FROM lane_walk w JOIN lane_m x
      ON x.stream = w.stream AND x.lane = w.lane AND x.rn = w.rn + 1))
"""


def _with(select: str, extra: str = "") -> str:
    tables = _BASE + (", " + extra if extra else "")
    return f"WITH RECURSIVE {tables} {select}"


def _counter(metric: str, source: str) -> str:
    return f"SELECT stream, '{metric}' AS metric, count(*) AS n FROM {source} GROUP BY 1"


_COUNTS = " UNION ALL ".join(
    [
        _counter("messages_fetched", "entries"),
        _counter("messages_published", "(SELECT * FROM lines WHERE line IS NOT NULL)"),
        _counter("messages_acked", "(SELECT * FROM outcomes WHERE ack)"),
        _counter("messages_nacked", "(SELECT * FROM outcomes WHERE NOT ack)"),
        _counter("messages_claimed", "claimed"),
        _counter("streams_active", "(SELECT * FROM changes WHERE change <> 'removed')"),
        _counter("streams_discovered", "(SELECT * FROM changes WHERE change = 'new')"),
        _counter("dead_consumers_removed", "dead"),
    ]
)

_SELECTS: dict[str, str] = {
    "read_entries": _ENTRY,
    "read_entries_one_stream": _ENTRY + " WHERE stream = 'syslog:click'",
    "stream_entries": _ENTRY,
    "read_new": "SELECT stream, id, raw FROM fresh",
    "read_new_cursors": """
      SELECT stream, top.id_ms AS id_ms, top.id_seq AS id_seq FROM (
        SELECT stream, max({'id_ms': id_ms, 'id_seq': id_seq}) AS top FROM (
          SELECT stream, id_ms, id_seq FROM fresh
          UNION ALL SELECT stream, c_ms, c_seq::BIGINT FROM cursors) GROUP BY 1)""",
    "discover_streams": "SELECT DISTINCT stream FROM entries",
    "refresh_streams": "SELECT stream, change FROM changes",
    "write_envelopes": "SELECT stream, batch, n_lines, n_skipped, raw_bytes FROM packed",
    "read_envelopes": _LINE_JSON,
    "deliver_stream": _LINE_JSON,
    "read_acks": """
      SELECT arrival, stream, ids, ack, '' AS reject_reason FROM acks
      UNION ALL SELECT arrival, stream, ids, ack, reason FROM bad""",
    "route_topic": """
      SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'unit-' || user_id || '/logs/in'
        ELSE 'logs/in' END AS topic FROM ev""",
    "extract_fields": _ENTRY,
    "drop_empty_body": _ENTRY + " WHERE object <> '' OR raw <> ''",
    "severity_name": _NAMED,
    "severity_name_text": f"""
      SELECT event_id, CASE WHEN event_id % 7 IN (0, 5, 6) THEN
          {_SEVERITY.format("user_id % 12")}
        WHEN event_id % 7 = 1 AND user_id % 12 = 0 THEN 'EMERGENCY' ELSE 'INFO' END AS severity
      FROM ev""",
    "flatten_structured_data": """
      SELECT id, stream, 'seat' AS key,
        json_extract(j, '$.structured_data.hall.row.seat')::VARCHAR AS value
      FROM parsed WHERE kind = 5
      UNION ALL
      SELECT id, stream, 'k', json_extract(j, '$.structured_data."site@7".k')::VARCHAR
      FROM parsed WHERE kind > 6""",
    "pass_through_fields": """
      SELECT id, stream, key, json_extract(j, '$.' || key)::VARCHAR AS value FROM (
        SELECT id, stream, j, unnest(json_keys(j)) AS key FROM parsed WHERE j IS NOT NULL)
      WHERE key NOT IN ('structured_data', 'severity', 'raw')""",
    "flatten_deep": """
      SELECT id, stream, 'leaf' AS key, event_id::VARCHAR AS value FROM entries
      WHERE event_id % 4 = 0
      UNION ALL SELECT id, stream, 'last', '1.10' FROM entries WHERE event_id % 4 = 0""",
    "pass_through_numbers": f"""
      SELECT id, stream, unnest(['price', 'big', 'far', 'list', 'obj']) AS key,
        unnest([user_id || '.50', '{fx.ODD_BIG}', '1e400', '[1.0,  ' || event_id || ']',
                '{{"z":1,"a":-0.0}}']) AS value
      FROM entries WHERE event_id % 4 = 1
      UNION ALL SELECT id, stream, 'name', '"caf\\u00e9"' FROM entries WHERE event_id % 4 = 2
      UNION ALL
      SELECT id, stream, 'hostname', '"h' || user_id || '"' FROM entries WHERE event_id % 4 = 3""",
    "build_payload_odd": f"""
      SELECT id, stream, id || chr(9) || stream || chr(9) || CASE event_id % 4
        WHEN 0 THEN '{{"leaf":' || event_id || ',"last":1.10'
        WHEN 1 THEN '{{"price":' || user_id || '.50,"big":{fx.ODD_BIG},"far":1e400,"list":[1.0,  '
          || event_id || '],"obj":{{"z":1,"a":-0.0}}'
        WHEN 2 THEN '{{"name":"caf\\u00e9","severity":"' || name || '"'
        ELSE '{{"hostname":"h' || user_id || '","severity":"' || name || '"'
      END || ',"raw":"r"}}' AS line
      FROM (SELECT *, {_SEVERITY.format("sev")} AS name FROM entries)""",
    "default_raw": "SELECT id, CASE raw WHEN '' THEN '-' ELSE raw END AS raw FROM entries",
    "tolerate_bad_object": """
      SELECT id, object = '' OR j IS NOT NULL AS object_ok,
        coalesce(len(json_keys(j)), 0)::BIGINT AS n_fields FROM parsed""",
    "build_payload": "SELECT id, stream, line FROM lines WHERE line IS NOT NULL",
    "json_escape": """
      SELECT doc_id, substr(to_json(text)::VARCHAR, 2, length(to_json(text)::VARCHAR) - 2)
        AS escaped FROM documents""",
    "parse_id": "SELECT id, id_ms, id_seq, id_ms AS event_ms FROM entries",
    "is_compressed": """
      SELECT arrival, (arrival // 2) % 2 = 1 AS packed FROM acks
      UNION ALL SELECT arrival, arrival = -8 FROM bad""",
    "compress_lines": "SELECT doc_id, md5(text) AS digest FROM documents",
    "decompress_capped": f"""
      SELECT doc_id, CASE WHEN strlen(text) <= {q.CAP_BYTES} THEN md5(text) ELSE '' END AS digest
      FROM documents""",
    "parse_payload_line": _LINE_JSON,
    "parse_ack": "SELECT arrival, stream, ids, ack AND arrival % 3 <> 0 AS ack FROM acks",
    "validate_ack": """
      SELECT arrival, n, '' AS reason FROM acks
      UNION ALL SELECT arrival, 0, reason FROM bad""",
    "explode_acks": _ACK_ROWS,
    "accumulate_acks": f"""
      SELECT stream, arrival // {q.PART_MESSAGES} AS part,
        coalesce(string_agg(ids, ',' ORDER BY arrival) FILTER (ack), '') AS ack_ids,
        CAST(coalesce(sum(n) FILTER (NOT ack), 0) AS BIGINT) AS nack_count
      FROM acks GROUP BY 1, 2""",
    "ack_shard": _SHARDS,
    "ack_batches": "SELECT * FROM flushes",
    "apply_acks": """
      SELECT stream, id, raw FROM entries
      WHERE id NOT IN (SELECT id FROM outcomes WHERE ack)""",
    "apply_acks_pending": "SELECT stream, id, consumer, delivered_at_ms FROM pending",
    "nacked": """
      SELECT stream, id, consumer, delivered_at_ms FROM deliveries
      WHERE id IN (SELECT id FROM outcomes WHERE NOT ack)""",
    "ack_dedup": _ACK_ROWS,
    "ack_dedup_stream": _ACK_ROWS,
    "pending": "SELECT stream, id, consumer, idle_ms FROM pending",
    "select_idle": "SELECT stream, id, consumer FROM chosen",
    "claim_idle": "SELECT id, stream, object, raw FROM claimed",
    "claim_idle_deliveries": f"""
      SELECT stream, id, consumer, delivered_at_ms FROM pending
      WHERE id NOT IN (SELECT id FROM chosen)
      UNION ALL SELECT stream, id, '{fx.SELF}', {fx.NOW_MS} FROM claimed""",
    "redelivery_feed": """
      SELECT id, stream, line FROM lines
      WHERE line IS NOT NULL AND id IN (SELECT id FROM fresh)
      UNION ALL
      SELECT id, stream, line FROM lines WHERE line IS NOT NULL AND id IN (SELECT id FROM claimed)""",
    "consumers_info": "SELECT stream, consumer, pending, idle_ms FROM info",
    "dead_consumers": "SELECT stream, consumer FROM dead",
    "drop_dead_consumers": "SELECT stream, consumer, pending AS released FROM dead",
    "drop_dead_consumers_left": f"""
      SELECT stream, consumer, last_seen_ms FROM consumers
      WHERE (stream, consumer) NOT IN (
        SELECT (stream, consumer) FROM dead WHERE consumer <> '{q.OWN_IDLE}')""",
    "drop_dead_consumers_released": """
      SELECT stream, id, consumer FROM pending SEMI JOIN dead USING (stream, consumer)""",
    "unacked_after": _UNACKED,
    "unacked_after_stream": _UNACKED,
    "unacked_after_late": _UNACKED,
    "flush_acks_stream": f"""
      SELECT f.stream, f.batch, CASE WHEN t.n >= {q.FLUSH_IDS} THEN 'size' ELSE 'time' END AS trigger,
        f.messages, f.ack_ids, f.nack_count
      FROM flushes f JOIN (
        SELECT stream, batch, sum(n) AS n FROM walk JOIN m USING (stream, rn) GROUP BY 1, 2) t
      USING (stream, batch)""",
    "flush_acks_late": "SELECT stream, id FROM outcomes WHERE ack",
    "deliver_stream_pending": f"""
      SELECT stream, id, '{fx.SELF}' AS consumer, {fx.NOW_MS}::BIGINT AS delivered_at_ms
      FROM entries WHERE id NOT IN (SELECT id FROM outcomes WHERE ack)""",
    "deliver_rounds": f"""
      SELECT (rn - 1) // {q.READ_BATCH} AS round, stream, count(*) AS n,
        min(id_ms) AS first_ms, max(id_ms) AS last_ms
      FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY id_ms, id_seq) AS rn
        FROM entries) GROUP BY 1, 2""",
    "settle_store": """
      SELECT stream, id, raw FROM entries
      WHERE id NOT IN (SELECT id FROM outcomes WHERE ack)""",
    "read_new_store": "SELECT stream, id, raw FROM fresh",
    "claim_store": "SELECT id, stream, object, raw FROM claimed",
    "dedup_received": "SELECT id, stream, line FROM lines WHERE line IS NOT NULL",
    "dedup_received_stream": "SELECT id, stream, raw FROM entries",
    "dedup_received_late": "SELECT id, stream, raw FROM entries",
    "counters": f"""
      SELECT CASE WHEN stream IS NULL THEN 'total' ELSE 'stream' END AS scope,
        coalesce(stream, '') AS stream, metric, CAST(sum(n) AS BIGINT) AS value
      FROM ({_COUNTS}) GROUP BY GROUPING SETS ((metric, stream), (metric))""",
    "publish_stats": """
      SELECT stream, batch, n_lines AS published, n_skipped AS skipped, raw_bytes,
        true AS packed FROM packed""",
    "error_counts": """
      SELECT stage, reason, CAST(sum(n) AS BIGINT) AS value FROM (
        SELECT 'fetch' AS stage, 'object' AS reason, 1 AS n FROM parsed
        WHERE object <> '' AND j IS NULL
        UNION ALL SELECT 'ack', reason, 1 FROM bad
        UNION ALL SELECT 'ack', 'flush', 1 FROM flushes WHERE batch % 3 = 0
        UNION ALL SELECT 'publish', 'batch', n_lines FROM packed WHERE batch % 2 = 1)
      GROUP BY 1, 2""",
    "receive": f"""
      SELECT id, l.stream, body AS json FROM (
        SELECT *, (row_number() OVER (PARTITION BY stream ORDER BY id_ms, id_seq) - 1)
          // {q.PACK_BATCH} AS batch FROM lines) l
      JOIN packed p ON p.stream = l.stream AND p.batch = l.batch
      WHERE line IS NOT NULL AND raw_bytes <= {q.RECEIVE_BYTES}""",
    "receive_rejected": f"""
      SELECT stream, batch, n_lines FROM packed WHERE raw_bytes > {q.RECEIVE_BYTES}""",
    "error_counts_jobs": f"""
      SELECT stage, reason, CAST(sum(n) AS BIGINT) AS value FROM (
        SELECT 'fetch' AS stage, 'object' AS reason, 1 AS n FROM parsed
        WHERE object <> '' AND j IS NULL
        UNION ALL SELECT 'ack', reason, 1 FROM bad
        UNION ALL SELECT 'publish', 'batch', n_lines FROM packed
        WHERE raw_bytes > {q.RECEIVE_BYTES})
      GROUP BY 1, 2""",
    "ack_backlog": "SELECT count(*) AS ack_queue_depth FROM acks WHERE arrival % 5 = 0",
    "health_rollup": """
      SELECT CASE WHEN s = 0 OR n > 0 THEN 'degraded' ELSE 'ok' END AS status,
        CASE WHEN s > 0 THEN 'ok' ELSE 'no entries' END AS source,
        CASE WHEN n = 0 THEN 'ok' ELSE n || ' refused' END AS sink
      FROM (SELECT (SELECT count(*) FROM entries) AS s,
                   (SELECT count(*) FROM outcomes WHERE NOT ack) AS n)""",
    "observe_stream": """
      SELECT 'messages_fetched' AS metric, count(*) AS value FROM lines
      UNION ALL SELECT 'messages_published', count(line) FROM lines
      UNION ALL SELECT 'messages_skipped', count(*) - count(line) FROM lines""",
    "deliver": """
      SELECT id, stream, body AS json FROM lines
      WHERE line IS NOT NULL AND id IN (SELECT id FROM fresh)""",
    "settle": "SELECT stream, id FROM entries WHERE id NOT IN (SELECT id FROM outcomes WHERE ack)",
    "recover": """
      SELECT id, stream, line FROM lines
      WHERE line IS NOT NULL AND id IN (SELECT id FROM chosen)""",
}


def checks() -> dict[str, str]:
    """SQL per query name."""
    sql = {name: _with(select) for name, select in _SELECTS.items()}
    sql["ack_batches_stream"] = _with(
        f"""
        SELECT stream, lane, batch,
          CASE WHEN sum(n) >= {q.FLUSH_IDS} THEN 'size' ELSE 'time' END AS trigger,
          count(*) AS messages,
          coalesce(string_agg(ids, ',' ORDER BY arrival) FILTER (ack), '') AS ack_ids,
          CAST(coalesce(sum(n) FILTER (NOT ack), 0) AS BIGINT) AS nack_count
        FROM lane_walk JOIN lane_m USING (stream, lane, rn) GROUP BY 1, 2, 3""",
        _TIMED,
    )
    return sql
