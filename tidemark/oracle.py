"""DuckDB oracle SQL, one statement per registered query.

The oracle does not decode anything: it computes the *expected* result from
the fixture rules (FIXTURES F1/F2, :mod:`tidemark.fixtures`) directly on the
``events`` table, so a Spark decode/encode bug shows up as a mismatch.
Wire texts are rebuilt by string concatenation; greedy windows and commit
folds are step-by-step recursive CTEs.
"""

from __future__ import annotations


def iso(e: str) -> str:
    """ISO offset date-time text of a UTC timestamp expression."""
    return ("(strftime({e}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({e}) % 1000000 <> 0 "
            "THEN '.' || rtrim(lpad(CAST(epoch_us({e}) % 1000000 AS VARCHAR), 6, '0'), '0') ELSE '' END"
            " || 'Z')").format(e=e)


_FAULT = """CASE WHEN "offset" % 5 = 0 THEN CASE
      WHEN event_id % 97 = 0 THEN 'cut' WHEN event_id % 89 = 0 THEN 'offset_number'
      WHEN event_id % 83 = 0 THEN 'no_eid' WHEN event_id % 79 = 0 THEN 'date_only'
      WHEN event_id % 73 = 0 THEN 'data_not_object' END END"""


def _ev_json(name: str, faults: bool) -> str:
    fault = _FAULT if faults else "CAST(NULL AS VARCHAR)"
    s = """
{name}_a AS (
  SELECT l.*, {fault} AS efault, CAST(json(payload) AS VARCHAR) AS pj FROM event_log l),
{name}_b AS (
  SELECT *, CASE WHEN efault = 'date_only' THEN strftime(occurred_at, '%Y-%m-%d') ELSE {occ} END AS occ_w,
         CASE WHEN efault = 'no_eid' THEN '' ELSE '"eid":"' || eid || '",' END AS eid_part
  FROM {name}_a),
{name}_c AS (
  SELECT *,
    '{{' || eid_part || '"event_type":"' || event_type || '","occurred_at":"' || occ_w || '"'
      || COALESCE(',"flow_id":"' || flow_id || '"', '') || '}}' AS md_struct,
    '{{' || eid_part || '"event_type":"' || event_type || '"' || COALESCE(',"flow_id":"' || flow_id || '"', '')
      || ',"occurred_at":"' || occ_w || '"}}' AS md_sorted
  FROM {name}_b),
{name} AS (
  SELECT *, CASE
    WHEN efault = 'data_not_object' AND kind = 'data' THEN
      '{{"data_type":"' || data_type || '","data_op":"' || data_op || '","data":' || CAST(to_json(payload) AS VARCHAR)
      || ',"metadata":' || md_struct || '}}'
    WHEN efault = 'data_not_object' THEN
      '{{"metadata":' || md_sorted || ',' || substr(pj, 2, length(pj) - 2) || ',"data":'
      || CAST(to_json(payload) AS VARCHAR) || '}}'
    WHEN kind = 'data' THEN
      '{{"data_type":"' || data_type || '","data_op":"' || data_op || '","data":' || pj || ',"metadata":' || md_struct || '}}'
    ELSE '{{"metadata":' || md_sorted || ',' || substr(pj, 2) END AS event_json
  FROM {name}_c)"""
    return s.format(name=name, fault=fault, occ=iso("occurred_at"))


PRELUDE = """WITH RECURSIVE
event_log AS (
  SELECT event_id, user_id, event_type,
         CAST(user_id % 4 AS VARCHAR) AS "partition",
         row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1 AS "offset",
         md5(CAST(event_id AS VARCHAR)) AS eid,
         ts AS occurred_at,
         CASE WHEN event_id % 3 = 0 THEN 'business' ELSE 'data' END AS kind,
         CASE WHEN event_id % 3 <> 0 THEN event_type END AS data_type,
         CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'X'
              ELSE ['C','U','D','S'][event_id % 4 + 1] END AS data_op,
         CASE WHEN event_id % 5 <> 0 THEN 'flow-' || CAST(user_id AS VARCHAR) END AS flow_id,
         props AS payload
  FROM events),
parts AS (SELECT DISTINCT event_type, "partition" FROM event_log),
""" + _ev_json("evj", True) + "," + _ev_json("cleanj", False) + """,
wb AS (
  SELECT event_type, "partition", "offset" // 5 AS batch_no, max("offset") AS cursor_offset,
         count(*) AS n_events, min(CASE WHEN "offset" % 5 = 0 THEN event_id END) AS first_event_id,
         max(efault) AS fault, string_agg(event_json, ',' ORDER BY "offset") AS evs
  FROM evj GROUP BY ALL),
wl AS (
  SELECT event_type, "partition", batch_no, cursor_offset, 0 AS line_seq, fault, n_events, first_event_id,
         CASE WHEN fault = 'cut' THEN substr(line, 1, length(line) // 2) ELSE line END AS value
  FROM (SELECT *, '{"cursor":{"partition":"' || "partition" || '","offset":'
          || CASE WHEN fault = 'offset_number' THEN CAST(cursor_offset AS VARCHAR)
                  ELSE '"' || lpad(CAST(cursor_offset AS VARCHAR), 18, '0') || '"' END
          || '},"events":[' || evs || ']}' AS line FROM wb)
  UNION ALL
  SELECT event_type, "partition", batch_no, cursor_offset, r.k AS line_seq, NULL, 0, first_event_id,
         '{"cursor":{"partition":"' || "partition" || '","offset":"' || lpad(CAST(cursor_offset AS VARCHAR), 18, '0')
         || '"}' || CASE r.k WHEN 1 THEN '}' WHEN 2 THEN ',"events":null}' ELSE ',"events":[]}' END
  FROM wb CROSS JOIN (SELECT range AS k FROM range(1, 4)) r
  WHERE (batch_no + 1) % 7 = 0 AND r.k <= ((batch_no + 1) // 7 - 1) % 3 + 1),
valid_events AS (
  SELECT e.* FROM event_log e JOIN wb b
    ON b.event_type = e.event_type AND b."partition" = e."partition" AND b.batch_no = e."offset" // 5
  WHERE b.fault IS NULL),
hw_a AS (SELECT event_type, "partition", max("offset") AS hw FROM event_log
         WHERE occurred_at < TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL),
hw_b AS (SELECT event_type, "partition", max("offset") AS hw FROM event_log
         WHERE occurred_at < TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL),
hw_c AS (SELECT event_type, "partition", max("offset") AS hw FROM event_log
         WHERE occurred_at < TIMESTAMP '2024-01-20 00:00:00' GROUP BY ALL),
commits AS (
  SELECT 'g1' AS group_id, event_type, "partition" AS partition_id, CAST(hw AS VARCHAR) AS checkpoint_id,
         'worker-a' AS lease_holder,
         CASE WHEN "partition" = '3' THEN NULL ELSE CAST("partition" AS BIGINT) END AS lease_counter,
         CASE WHEN event_type IN ('click', 'signup') THEN TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 400 SECOND
              ELSE TIMESTAMP '2024-02-01 00:00:00' + INTERVAL 400 SECOND END AS lease_timestamp,
         'lease-g1-' || "partition" AS lease_id
  FROM hw_b
  UNION ALL
  SELECT 'g2', event_type, "partition", CAST(hw AS VARCHAR), 'worker-a',
         CAST("partition" AS BIGINT),
         CASE WHEN event_type IN ('click', 'signup') THEN TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 400 SECOND
              ELSE TIMESTAMP '2024-02-01 00:00:00' + INTERVAL 400 SECOND END,
         CAST(NULL AS VARCHAR)
  FROM hw_a WHERE "partition" IN ('0', '1')),
requests AS (
  SELECT g.group_id, p.event_type, p."partition" AS partition_id
  FROM parts p CROSS JOIN (VALUES ('g1'), ('g2'), ('g3')) g(group_id)),
own AS (
  SELECT group_id, event_type, partition_id,
         CASE partition_id WHEN '0' THEN 0 WHEN '1' THEN 5 WHEN '2' THEN NULL ELSE 7 END AS own_counter
  FROM requests WHERE event_type <> 'view'),
lookups AS (
  SELECT event_type, "partition" FROM parts
  UNION ALL SELECT DISTINCT event_type, '9' FROM parts),
xc AS (
  SELECT event_type, "partition",
         CASE "partition" WHEN '0' THEN 0 WHEN '1' THEN 1 WHEN '2' THEN 101 ELSE 0 END AS start_offset
  FROM parts),
after_cursor AS (
  SELECT l.*, x.start_offset FROM event_log l JOIN xc x USING (event_type, "partition")
  WHERE l."offset" >= x.start_offset),
reg AS (
  SELECT event_id, event_type, "partition", "offset",
         row_number() OVER (ORDER BY eid) AS arrival_seq FROM event_log),
reg_acc AS (
  SELECT *, "offset" > COALESCE(max("offset") OVER (PARTITION BY event_type, "partition" ORDER BY arrival_seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS accepted,
         TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(arrival_seq AS INTEGER)) AS arrived
  FROM reg),
fold_puts AS (
  SELECT g.group_id, b.event_type, b."partition" AS partition_id, b.cursor_offset AS put_seq,
         row_number() OVER (PARTITION BY g.group_id, b.event_type, b."partition" ORDER BY b.cursor_offset) AS i,
         CAST(b.cursor_offset AS VARCHAR) AS checkpoint_id,
         CASE WHEN (b.cursor_offset // 50) % 2 = 0 THEN 'worker-a' ELSE 'worker-b' END AS lease_holder,
         CASE WHEN b.batch_no % 17 = 3 THEN 0 WHEN b.batch_no % 23 = 7 THEN 5 END AS supplied,
         CASE WHEN b.batch_no % 4 = 0 THEN 'lease-' ||
              CASE WHEN (b.cursor_offset // 50) % 2 = 0 THEN 'worker-a' ELSE 'worker-b' END
              || '-' || CAST(b.batch_no // 40 AS VARCHAR) END AS lid
  FROM wb b CROSS JOIN (VALUES ('g1'), ('g4')) g(group_id) WHERE b.fault IS NULL),
fold AS (
  SELECT p.group_id, p.event_type, p.partition_id, p.i, p.put_seq, p.checkpoint_id, p.lease_holder,
         CASE WHEN c.group_id IS NULL THEN 1
              ELSE COALESCE(p.supplied, COALESCE(c.lease_counter, 0) + 1) END AS lease_counter,
         COALESCE(p.lid, c.lease_id) AS lease_id
  FROM fold_puts p LEFT JOIN commits c
    ON c.group_id = p.group_id AND c.event_type = p.event_type AND c.partition_id = p.partition_id
  WHERE p.i = 1
  UNION ALL
  SELECT p.group_id, p.event_type, p.partition_id, p.i, p.put_seq, p.checkpoint_id, p.lease_holder,
         COALESCE(p.supplied, f.lease_counter + 1), COALESCE(p.lid, f.lease_id)
  FROM fold f JOIN fold_puts p
    ON p.group_id = f.group_id AND p.event_type = f.event_type AND p.partition_id = f.partition_id
   AND p.i = f.i + 1)
"""

_KEYS = 'event_type, "partition"'


def _summary(src: str) -> str:
    return (f'SELECT event_type, "partition", count(*) AS n_events, min("offset") AS first_offset, '
            f'max("offset") AS last_offset FROM {src} GROUP BY ALL')


_REASON = """CASE fault WHEN 'cut' THEN 'unparseable' WHEN 'offset_number' THEN 'cursor.offset: not a string'
  WHEN 'no_eid' THEN 'events[0].metadata.eid: missing'
  WHEN 'date_only' THEN 'events[0].metadata.occurred_at: not an offset date-time'
  ELSE CASE WHEN first_event_id % 3 = 0 THEN 'events[0].data_type: missing'
            ELSE 'events[0].data: not an object' END END"""

_ERRORS = """SELECT '$' AS path, 'unparseable' AS reason FROM wb WHERE fault = 'cut'
  UNION ALL SELECT 'cursor.offset', 'not a string' FROM wb WHERE fault = 'offset_number'
  UNION ALL SELECT 'events[*].metadata.eid', 'missing' FROM wb WHERE fault = 'no_eid'
  UNION ALL SELECT 'events[*].metadata.occurred_at', 'not an offset date-time' FROM wb WHERE fault = 'date_only'
  UNION ALL SELECT 'events[*].data', 'not an object' FROM wb WHERE fault = 'data_not_object'
  UNION ALL SELECT 'events[*].data_type', 'missing' FROM wb WHERE fault = 'data_not_object' AND first_event_id % 3 = 0
  UNION ALL SELECT 'events[*].data_op', 'missing' FROM wb WHERE fault = 'data_not_object' AND first_event_id % 3 = 0"""

_G1_START = """g1start AS (
  SELECT p.event_type, p."partition",
         CASE WHEN p."partition" = '2' THEN 0 WHEN c.checkpoint_id IS NULL THEN 0
              ELSE CAST(c.checkpoint_id AS BIGINT) + 1 END AS start_offset
  FROM parts p LEFT JOIN commits c
    ON c.group_id = 'g1' AND c.event_type = p.event_type AND c.partition_id = p."partition")"""

_NORM_OP = "CASE WHEN data_op IN ('C','U','D','S') THEN data_op ELSE 'UnknownValue(' || data_op || ')' END"


def _greedy(src: str, order: str, ts: str, n: int | None, hours: int, name: str, seconds: int = 0) -> str:
    cond = f"x.{ts} < g.wts + INTERVAL {hours} HOUR + INTERVAL {seconds} SECOND"
    if n:
        cond = f"g.cnt < {n} AND " + cond
    return f"""{name}_x AS (
  SELECT *, row_number() OVER (PARTITION BY event_type, "partition" ORDER BY {order}) AS rn FROM {src}),
{name} AS (
  SELECT event_type, "partition", rn, "offset", {order} AS ord, {ts} AS ts_, {ts} AS wts, 1 AS cnt, {order} AS wstart
  FROM {name}_x WHERE rn = 1
  UNION ALL
  SELECT x.event_type, x."partition", x.rn, x."offset", x.{order}, x.{ts},
         CASE WHEN {cond} THEN g.wts ELSE x.{ts} END,
         CASE WHEN {cond} THEN g.cnt + 1 ELSE 1 END,
         CASE WHEN {cond} THEN g.wstart ELSE x.{order} END
  FROM {name} g JOIN {name}_x x
    ON x.event_type = g.event_type AND x."partition" = g."partition" AND x.rn = g.rn + 1)"""


def _with(extra: str, body: str) -> str:
    return PRELUDE + ("," + extra if extra else "") + "\n" + body


def _map_key(src: str, off: str = "hw") -> str:
    return f"SELECT ltrim(md5(event_type || ' - ' || \"partition\"), '0') AS key, {off} AS \"offset\" FROM {src}"


def _table_out(src: str) -> str:
    return (f"SELECT group_id, event_type, partition_id, checkpoint_id, lease_holder, lease_counter, "
            f"{iso('lease_timestamp')} AS lease_timestamp, lease_id FROM {src}")


_FLUSH = """flush AS (
  SELECT 'g1' AS group_id, l.event_type, l."partition" AS partition_id, CAST(h.hw AS VARCHAR) AS checkpoint_id,
         'worker-b' AS lease_holder, CAST(NULL AS BIGINT) AS lease_counter,
         TIMESTAMP '2024-02-01 00:00:00' + INTERVAL 300 SECOND AS lease_timestamp, 'lease-new' AS lease_id,
         CASE WHEN h.hw IS NULL THEN 'No offset set for given partition ' || l."partition" || ' and event-type '
              || l.event_type END AS error
  FROM lookups l LEFT JOIN hw_c h USING (event_type, "partition"))"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    scan = 'SELECT event_type, count(*) AS n_lines, CAST(sum(length(value)) AS BIGINT) AS n_chars FROM wl GROUP BY 1'
    q["scan_batch_log"] = _with("", scan)
    q["stream_batch_log"] = _with("", scan)
    q["resolve_start_cursor"] = _with("", """
SELECT r.group_id, r.event_type, r.partition_id AS "partition",
       COALESCE(r.explicit, c.checkpoint_id) AS start_cursor,
       CASE WHEN r.explicit IS NOT NULL THEN 'explicit' WHEN c.checkpoint_id IS NOT NULL THEN 'committed'
            ELSE 'none' END AS cursor_source
FROM (SELECT *, CASE WHEN group_id = 'g1' AND partition_id = '2' THEN 'BEGIN'
                     WHEN group_id = 'g3' AND partition_id = '1' THEN '5' END AS explicit FROM requests) r
LEFT JOIN commits c ON c.group_id = r.group_id AND c.event_type = r.event_type AND c.partition_id = r.partition_id""")
    q["read_from_cursor"] = _with("", _summary("after_cursor"))
    q["read_from_mixed_cursors"] = _with("", _summary("""(
  SELECT e.* FROM event_log e JOIN xc USING (event_type, "partition")
  WHERE e."offset" >= CASE WHEN event_type < 'p' THEN xc.start_offset ELSE 0 END) m"""))
    q["consume_all_partitions"] = _with(_G1_START, _summary(
        'valid_events v JOIN g1start s USING (event_type, "partition") WHERE v."offset" >= s.start_offset'))
    q["consume_after_cursors"] = q["consume_wire_log"] = q["consume_all_partitions"]
    q["batch_by_count"] = _with("", """
SELECT event_type, "partition", max("offset") AS batch_cursor, min("offset") AS first_offset, count(*) AS n_events
FROM after_cursor GROUP BY event_type, "partition", ("offset" - start_offset) // 10""")
    q["batch_by_count_or_time"] = _with(_greedy("after_cursor", '"offset"', "occurred_at", 4, 6, "gw"), """
SELECT event_type, "partition", max("offset") AS batch_cursor, min("offset") AS first_offset, count(*) AS n_events
FROM gw GROUP BY event_type, "partition", wstart""")
    q["limit_stream"] = _with("", _summary('after_cursor WHERE "offset" - start_offset < 25'))
    q["limit_stream_by_time"] = _with("", _summary(
        "after_cursor WHERE occurred_at < TIMESTAMP '2024-01-13 00:00:00'"))
    q["close_on_keep_alives"] = _with("""closing AS (
  SELECT event_type, "partition", min(cursor_offset) AS close_at FROM wb
  WHERE (batch_no + 1) % 7 = 0 AND ((batch_no + 1) // 7 - 1) % 3 + 1 >= 2 GROUP BY ALL)""", """
SELECT event_type, "partition", count(*) AS n_batches, max(cursor_offset) AS last_cursor
FROM wb LEFT JOIN closing USING (event_type, "partition")
WHERE fault IS NULL AND (close_at IS NULL OR cursor_offset <= close_at) GROUP BY ALL""")
    q["drop_keep_alives"] = _with("", """
SELECT event_type, count(*) AS n_valid_lines, count(*) FILTER (WHERE n_events > 0) AS n_delivered,
       count(*) FILTER (WHERE n_events = 0) AS n_dropped
FROM wl WHERE fault IS NULL GROUP BY 1""")
    q["to_consumer_message"] = _with("", """
SELECT event_type, "partition", lpad(CAST(cursor_offset AS VARCHAR), 18, '0') AS cursor_offset, n_events
FROM wl WHERE fault IS NULL""")
    q["detect_stalled_partitions"] = _with("""gaps AS (
  SELECT event_type, "partition",
         epoch_us(occurred_at) - lag(epoch_us(occurred_at)) OVER (PARTITION BY event_type, "partition"
                                                                  ORDER BY "offset") AS gap_us
  FROM event_log)""", """
SELECT event_type, "partition", count(*) AS n_stalls, max(gap_us) // 1000000 AS max_gap_seconds
FROM gaps WHERE gap_us > 5400000000 GROUP BY ALL""")
    # -- publish
    q["publish_messages"] = _with("", """
SELECT 'audit' AS event_type, event_id // 10 AS message_id, count(*) AS n_events,
       first(eid ORDER BY event_id % 10) AS first_eid,
       md5('[' || string_agg(event_json, ',' ORDER BY event_id % 10) || ']') AS body_md5
FROM cleanj GROUP BY event_id // 10""")
    q["publish_flow_header"] = _with("", """
SELECT 'v0' AS variant, event_id // 10 AS message_id, first(flow_id ORDER BY event_id % 10) AS flow_id
FROM event_log GROUP BY 2
UNION ALL
SELECT 'v3', (event_id + 3) // 10, first(flow_id ORDER BY (event_id + 3) % 10) FROM event_log GROUP BY 2""")
    q["publish_with_markers"] = _with("", "SELECT event_id // 10 AS message_id, eid AS marker, "
                                          "event_id // 10 AS seq FROM event_log WHERE event_id % 10 = 0")
    q["republish"] = _with("", """
SELECT md5(eid || ':audit') AS new_eid, eid AS parent_eid, "partition", "offset"
FROM valid_events WHERE event_type = 'purchase'""")
    q["republish_bodies"] = _with("""audit_md AS (
  SELECT *, '"eid":"' || md5(eid || ':audit') || '","event_type":"purchase-audit"' AS head,
         '"occurred_at":"' || """ + iso("occurred_at") + """ || '"' AS occ,
         '"parent_eids":["' || eid || '"]' AS parents, ',"flow_id":"' || flow_id || '"' AS flow,
         CAST(json(payload) AS VARCHAR) AS pj
  FROM valid_events WHERE event_type = 'purchase'),
audit AS (
  SELECT *, CASE WHEN kind = 'data' THEN
      '{"data_type":"' || data_type || '","data_op":"' || CASE WHEN data_op = 'X' THEN 'UnknownValue(X)' ELSE data_op END
      || '","data":' || pj || ',"metadata":{' || head || ',' || occ || ',' || parents || COALESCE(flow, '') || '}}'
    ELSE '{"metadata":{' || head || COALESCE(flow, '') || ',' || occ || ',' || parents || '},' || substr(pj, 2) END AS ej
  FROM audit_md)""", """
SELECT 'purchase-audit' AS event_type, "partition", max("offset") AS cursor_offset, count(*) AS n_events,
       md5('[' || string_agg(ej, ',' ORDER BY "offset") || ']') AS body_md5
FROM audit GROUP BY "partition", "offset" // 5""")
    q["register_event_types"] = _with("", """
SELECT event_type AS name, CAST(2 AS BIGINT) AS version,
       CASE WHEN event_type IN ('click', 'view') THEN 'team-' ELSE 'app-' END || event_type AS owning_application,
       CASE WHEN event_type = 'view' THEN 'audit' WHEN event_type = 'purchase' THEN 'business' ELSE 'data' END
         AS category
FROM (SELECT DISTINCT event_type FROM event_log)""")
    # -- codec
    q["decode_batches"] = _with("", """
SELECT event_type, "partition", count(*) AS n_batches, CAST(sum(n_events) AS BIGINT) AS n_events
FROM wl WHERE fault IS NULL GROUP BY ALL""")
    q["quarantine_batches"] = _with("", f"""
SELECT event_type, {_REASON} AS reason, count(*) AS n_batches FROM wb WHERE fault IS NOT NULL GROUP BY ALL""")
    q["quarantine_landed"] = q["quarantine_batches"]
    q["validation_report"] = _with("", f"SELECT path, reason, count(*) AS n_errors FROM ({_ERRORS}) GROUP BY ALL")
    q["explode_events"] = _with("", 'SELECT event_type, "partition", "offset", "offset" % 5 AS pos, eid '
                                    'FROM valid_events')
    q["classify_events"] = _with("", "SELECT event_type, kind, count(*) AS n_events FROM valid_events GROUP BY ALL")
    q["decode_metadata"] = _with("", f"SELECT eid, {iso('occurred_at')} AS occurred_at_text, flow_id, "
                                     "event_type AS meta_event_type FROM valid_events")
    q["decode_full_metadata"] = _with("", f"""
SELECT eid, event_type AS meta_event_type, {iso('occurred_at')} AS occurred_at_text,
       CASE WHEN event_id % 3 = 0 THEN {iso('occurred_at')} END AS received_at_text,
       CASE WHEN event_id % 2 = 1 THEN '["root-' || eid || '","' || md5(eid) || '"]' END AS parent_eids, flow_id
FROM event_log""")
    q["decode_data_change"] = _with("", f"SELECT eid, data_type, {_NORM_OP} AS data_op, "
                                        "CAST(json(payload) AS VARCHAR) AS payload FROM valid_events "
                                        "WHERE kind = 'data'")
    q["decode_business"] = _with("", "SELECT eid, CAST(json(payload) AS VARCHAR) AS payload FROM valid_events "
                                     "WHERE kind = 'business'")
    q["normalise_data_op"] = _with("", f"SELECT {_NORM_OP} AS data_op, count(*) AS n_events FROM valid_events "
                                       "WHERE kind = 'data' GROUP BY 1")
    q["normalise_category"] = _with("", """
SELECT event_type AS name, CAST(v AS BIGINT) AS version,
       CASE WHEN v = 2 AND event_type = 'view' THEN 'UnknownValue(audit)'
            WHEN event_type = 'purchase' THEN 'business' ELSE 'data' END AS category
FROM (SELECT DISTINCT event_type FROM event_log) CROSS JOIN (VALUES (1), (2)) t(v)""")
    occ = iso("occurred_at")
    q["parse_offset_datetime"] = _with("", f"""
SELECT event_id,
  CASE event_id % 6
    WHEN 0 THEN {occ}
    WHEN 1 THEN strftime(occurred_at + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || '.'
                || lpad(CAST(epoch_us(occurred_at) % 1000000 AS VARCHAR), 6, '0') || '+01:00'
    WHEN 2 THEN strftime(occurred_at, '%Y-%m-%d')
    WHEN 3 THEN strftime(occurred_at, '%Y-%m-%dT%H:%M') || 'Z'
    WHEN 4 THEN lower({occ})
    ELSE strftime(occurred_at, '%Y-%m-%dT%H:%M:%S') END AS text,
  CASE event_id % 6 WHEN 2 THEN NULL WHEN 5 THEN NULL
    WHEN 3 THEN epoch_us(date_trunc('minute', occurred_at)) ELSE epoch_us(occurred_at) END AS parsed_us
FROM event_log""")
    q["encode_events"] = _with("", "SELECT eid, event_json FROM cleanj")
    q["format_offset_datetime"] = _with("", f"SELECT event_id, {occ} AS occurred_at_text FROM event_log")
    q["round_trip_events"] = _with("", "SELECT count(*) AS n_events, CAST(0 AS BIGINT) AS n_only_original, "
                                       "CAST(0 AS BIGINT) AS n_only_round_trip FROM event_log")
    q["encode_cursors"] = _with("", """
SELECT event_type, '[' || string_agg('{"partition":"' || "partition" || '","offset":"' || CAST(hw AS VARCHAR) || '"}',
                                     ',' ORDER BY "partition") || ']' AS cursors_json
FROM (SELECT event_type, "partition", max("offset") AS hw FROM event_log GROUP BY ALL) GROUP BY 1""")
    q["encode_batches"] = _with("", """
SELECT event_type, "partition", max("offset") AS cursor_offset,
       '{"cursor":{"partition":"' || "partition" || '","offset":"' || lpad(CAST(max("offset") AS VARCHAR), 18, '0')
       || '"},"events":[' || string_agg(event_json, ',' ORDER BY "offset") || ']}' AS value
FROM cleanj GROUP BY event_type, "partition", "offset" // 5""")
    q["decode_event_types"] = _with("", """
SELECT event_type AS name, event_type <> 'signup' AS valid,
       CASE WHEN event_type = 'view' THEN 'UnknownValue(audit)' WHEN event_type = 'purchase' THEN 'business'
            ELSE 'data' END AS category,
       CAST(1 AS BIGINT) AS n_key_fields, CAST(1000 AS BIGINT) AS expected_write_rate
FROM (SELECT DISTINCT event_type FROM event_log)""")
    # -- offsets
    q["offset_to_long"] = _with("", """
SELECT event_id,
  CASE event_id % 8 WHEN 0 THEN lpad(CAST("offset" AS VARCHAR), 18, '0') WHEN 1 THEN CAST("offset" AS VARCHAR)
    WHEN 2 THEN 'BEGIN' WHEN 3 THEN 'something invalid' WHEN 4 THEN '' WHEN 5 THEN '-' || CAST("offset" AS VARCHAR)
    WHEN 6 THEN '99999999999999999999' ELSE CAST("offset" AS VARCHAR) || '0' END AS text,
  CASE event_id % 8 WHEN 0 THEN "offset" WHEN 1 THEN "offset" WHEN 2 THEN 0 WHEN 7 THEN "offset" * 10 END AS value,
  CASE event_id % 8 WHEN 3 THEN 'invalid offset' WHEN 4 THEN 'invalid offset' WHEN 5 THEN 'invalid offset'
    WHEN 6 THEN 'offset out of range' END AS error
FROM event_log""")
    q["partition_key_hash"] = _with("", """SELECT event_type, "partition",
       ltrim(md5(event_type || ' - ' || "partition"), '0') AS key FROM parts""")
    q["last_offset"] = _with("", """SELECT l.event_type, l."partition", COALESCE(h.hw, -1) AS last_offset
FROM lookups l LEFT JOIN hw_b h USING (event_type, "partition")""")
    q["last_offset_required"] = _with("", """SELECT l.event_type, l."partition", CAST(h.hw AS VARCHAR) AS checkpoint,
       CASE WHEN h.hw IS NULL THEN 'No offset set for given partition ' || l."partition" || ' and event-type '
            || l.event_type END AS error
FROM lookups l LEFT JOIN hw_b h USING (event_type, "partition")""")
    q["register_commits"] = _with("", 'SELECT event_id, event_type, "partition", "offset", arrival_seq, accepted '
                                      'FROM reg_acc')
    q["high_water_offsets"] = _with("", 'SELECT event_type, "partition", max(cursor_offset) AS high_water FROM wb '
                                        'WHERE fault IS NULL GROUP BY ALL')
    q["offset_map_upsert"] = _with(f"""writes AS (
  SELECT ltrim(md5(event_type || ' - ' || "partition"), '0') AS key, hw AS "offset", 0 AS seq FROM hw_b
  UNION ALL SELECT ltrim(md5(event_type || ' - ' || "partition"), '0'), hw, 1 FROM hw_c WHERE "partition" IN ('0','1')
  UNION ALL SELECT ltrim(md5(event_type || ' - ' || "partition"), '0'), 3, 2 FROM parts WHERE "partition" = '2'
  UNION ALL SELECT ltrim(md5(event_type || ' - 7'), '0'), 42, 3 FROM parts WHERE "partition" = '0')""",
                                   'SELECT key, arg_max("offset", seq) AS "offset" FROM writes GROUP BY key')
    q["offset_map_diff"] = _with("", f"{_map_key('hw_c')} EXCEPT {_map_key('hw_b')}")
    q["offset_map_non_empty"] = _with("""cur AS (SELECT event_type, "partition", max("offset") AS hw FROM event_log GROUP BY ALL),
committed_m AS (SELECT event_type, "partition", max("offset") AS hw FROM event_log
  WHERE event_type IN ('click', 'view') OR occurred_at < TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL),
d AS (SELECT event_type, "partition", hw FROM cur EXCEPT SELECT event_type, "partition", hw FROM committed_m)""",
                                      """SELECT p.event_type, count(d.hw) > 0 AS non_empty
FROM (SELECT DISTINCT event_type FROM event_log) p LEFT JOIN d USING (event_type) GROUP BY 1""")
    q["commit_flush_timeline"] = _with(
        _greedy("(SELECT * FROM reg_acc WHERE accepted)", "arrival_seq", "arrived", None, 6, "fw"),
        f"""SELECT event_type, "partition", {iso("min(wts) + INTERVAL 6 HOUR")} AS flush_at,
       count(*) AS n_registrations, max("offset") AS flushed_offset
FROM fw GROUP BY event_type, "partition", wstart""")
    close = "TIMESTAMP '2024-02-04 00:00:00'"
    q["uncommitted_on_close"] = _with(
        _greedy(f"(SELECT * FROM reg_acc WHERE accepted AND arrived <= {close})", "arrival_seq", "arrived",
                None, 6, "cw") + f""",
committed_c AS (
  SELECT event_type, "partition", max(mo) AS committed_offset FROM (
    SELECT event_type, "partition", wstart, min(wts) AS w, max("offset") AS mo FROM cw GROUP BY ALL)
  WHERE w + INTERVAL 6 HOUR <= {close} GROUP BY ALL)""",
        f"""SELECT r.event_type, r."partition", max(c.committed_offset) AS committed_offset,
       count(*) FILTER (WHERE c.committed_offset IS NULL OR r."offset" > c.committed_offset) AS n_at_risk
FROM reg_acc r LEFT JOIN committed_c c USING (event_type, "partition")
WHERE r.arrived <= {close} GROUP BY ALL""")
    q["acknowledge_offsets"] = _with("", f"""{_map_key('hw_c')} EXCEPT
SELECT ltrim(md5(event_type || ' - ' || "partition"), '0'), hw + CASE WHEN "partition" = '0' THEN 1 ELSE 0 END - 1
FROM hw_c""")
    # -- commits and leases
    valid = ("(c.lease_counter IS NOT NULL AND c.lease_counter = COALESCE(o.own_counter, 0)) "
             "OR c.lease_timestamp < TIMESTAMP '2024-02-01 00:00:00'")
    q["validate_lease"] = _with("", f"""SELECT c.group_id, c.event_type, c.partition_id, {valid} AS valid
FROM commits c LEFT JOIN own o USING (group_id, event_type, partition_id)""")
    q["request_lease"] = _with("", f"""SELECT r.group_id, r.event_type, r.partition_id,
       CASE WHEN c.group_id IS NULL THEN true ELSE {valid} END AS available
FROM requests r LEFT JOIN commits c USING (group_id, event_type, partition_id)
LEFT JOIN own o USING (group_id, event_type, partition_id)""")
    q["release_lease"] = _with("", f"""SELECT r.group_id, r.event_type, r.partition_id,
       c.group_id IS NOT NULL AS released,
       CASE WHEN c.group_id IS NOT NULL THEN CAST(0 AS BIGINT) END AS lease_counter,
       CASE WHEN c.group_id IS NOT NULL THEN {iso("TIMESTAMP '2024-02-01 00:00:00'")} END AS lease_timestamp,
       CASE WHEN c.group_id IS NULL THEN 'No lease exists to release for group: ''' || r.group_id
            || ''' eventType: ''' || r.event_type || ''' partition: ''' || r.partition_id || '''' END AS warning
FROM requests r LEFT JOIN commits c USING (group_id, event_type, partition_id)
WHERE r.partition_id IN ('0', '3')""")
    q["build_commit"] = _with(_FLUSH, f"""SELECT group_id, event_type, partition_id, checkpoint_id, lease_holder,
       {iso('lease_timestamp')} AS lease_timestamp, lease_id, error FROM flush""")
    q["commit_put_twice"] = _with("""put2 AS (
  SELECT * FROM commits WHERE group_id = 'g2'
  UNION ALL
  SELECT r.group_id, r.event_type, r.partition_id, '6', 'worker-d', CASE WHEN c.group_id IS NULL THEN 2 ELSE 6 END,
         TIMESTAMP '2024-02-01 00:00:00', 'lease-d'
  FROM requests r LEFT JOIN commits c
    ON c.group_id = r.group_id AND c.event_type = r.event_type AND c.partition_id = r.partition_id
  WHERE r.group_id <> 'g2')""", _table_out("put2"))
    q["commit_put"] = _with(_FLUSH + """,
puts AS (
  SELECT group_id, event_type, partition_id, checkpoint_id, lease_holder, lease_counter, lease_timestamp, lease_id
  FROM flush WHERE error IS NULL
  UNION ALL
  SELECT 'g2', event_type, "partition", '1', 'worker-c', 0, TIMESTAMP '2024-02-01 00:00:00', NULL
  FROM parts WHERE "partition" = '0'
  UNION ALL
  SELECT 'g3', event_type, "partition", '7', 'worker-c', CASE WHEN "partition" = '1' THEN 5 END,
         TIMESTAMP '2024-02-01 00:00:00', NULL FROM parts),
newt AS (
  SELECT COALESCE(p.group_id, c.group_id) AS group_id, COALESCE(p.event_type, c.event_type) AS event_type,
         COALESCE(p.partition_id, c.partition_id) AS partition_id,
         CASE WHEN p.group_id IS NOT NULL THEN p.checkpoint_id ELSE c.checkpoint_id END AS checkpoint_id,
         CASE WHEN p.group_id IS NOT NULL THEN p.lease_holder ELSE c.lease_holder END AS lease_holder,
         CAST(CASE WHEN p.group_id IS NULL THEN c.lease_counter WHEN c.group_id IS NULL THEN 1
              ELSE COALESCE(p.lease_counter, COALESCE(c.lease_counter, 0) + 1) END AS BIGINT) AS lease_counter,
         CASE WHEN p.group_id IS NOT NULL THEN p.lease_timestamp ELSE c.lease_timestamp END AS lease_timestamp,
         CASE WHEN p.group_id IS NOT NULL THEN COALESCE(p.lease_id, c.lease_id) ELSE c.lease_id END AS lease_id
  FROM commits c FULL OUTER JOIN puts p
    ON p.group_id = c.group_id AND p.event_type = c.event_type AND p.partition_id = c.partition_id)""",
                            _table_out("newt"))
    q["commit_fold"] = _with("", """SELECT group_id, event_type, partition_id, checkpoint_id, lease_holder,
       CAST(lease_counter AS BIGINT) AS lease_counter, lease_id
FROM fold QUALIFY row_number() OVER (PARTITION BY group_id, event_type, partition_id ORDER BY i DESC) = 1""")
    q["commit_get"] = _with("", """SELECT r.group_id, r.event_type, r.partition_id, c.checkpoint_id, c.lease_counter
FROM requests r LEFT JOIN commits c USING (group_id, event_type, partition_id)""")
    q["lease_counters"] = _with("", """SELECT lease_holder, group_id, event_type, partition_id,
       CAST(arg_max(COALESCE(lease_counter, 0), put_seq) AS BIGINT) AS counter
FROM fold GROUP BY ALL""")
    s5 = "INTERVAL 6 HOUR + INTERVAL 30 SECOND"
    q["stream_flush_timer"] = _with(
        _greedy("(SELECT * FROM reg_acc WHERE accepted)", "arrival_seq", "arrived", None, 6, "tw", 30),
        f"""SELECT event_type, "partition", {iso("min(wts) + " + s5)} AS flush_at,
       count(*) AS n_registrations, max("offset") AS flushed_offset
FROM tw GROUP BY event_type, "partition", wstart
HAVING min(wts) + {s5} < (SELECT max(arrived) FROM reg_acc WHERE accepted)""")
    a7 = "INTERVAL 6 HOUR + INTERVAL 1 SECOND"
    q["batch_by_count_or_time_stream"] = _with(
        _greedy("after_cursor", '"offset"', "occurred_at", 4, 6, "sw", 1),
        f"""SELECT event_type, "partition", max("offset") AS batch_cursor, min("offset") AS first_offset,
       count(*) AS n_events
FROM sw GROUP BY event_type, "partition", wstart
HAVING count(*) = 4 OR min(wts) + {a7} < (SELECT max(occurred_at) FROM after_cursor)""")
    live = """live_src AS (
  SELECT v.* FROM valid_events v JOIN after_cursor a USING (event_type, "partition", "offset")),
"""
    q["batch_by_count_or_time_live"] = _with(live + _greedy("live_src", '"offset"', "occurred_at", 4, 6, "lw", 1), """
SELECT event_type, "partition", max("offset") AS batch_cursor, min("offset") AS first_offset, count(*) AS n_events
FROM lw JOIN (SELECT event_type, "partition", max("offset") AS mx FROM live_src GROUP BY ALL) USING (event_type, "partition")
GROUP BY event_type, "partition", wstart HAVING count(*) = 4 OR max("offset") < any_value(mx)""")
    q["detect_stalled_partitions_live"] = _with("""vgaps AS (
  SELECT event_type, "partition",
         epoch_us(occurred_at) - lag(epoch_us(occurred_at)) OVER (PARTITION BY event_type, "partition"
                                                                  ORDER BY "offset") AS gap_us
  FROM valid_events)""", """
SELECT event_type, "partition", count(*) AS n_stalls, max(gap_us) // 1000000 AS max_gap_seconds
FROM vgaps WHERE gap_us > 5400000000 GROUP BY ALL""")
    q["detect_stalled_partitions_stream"] = _with("""gaps2 AS (
  SELECT event_type, "partition", epoch_us(occurred_at) AS t,
         epoch_us(occurred_at) - lag(epoch_us(occurred_at)) OVER (PARTITION BY event_type, "partition"
                                                                  ORDER BY "offset") AS gap_us
  FROM event_log),
per_part AS (
  SELECT event_type, "partition", count(*) FILTER (WHERE gap_us > 5400000000) AS n_stalls,
         max(gap_us) FILTER (WHERE gap_us > 5400000000) // 1000000 AS max_gap_seconds,
         (SELECT max(epoch_us(occurred_at)) FROM event_log) - max(t) > 5400000000 AS stalled_at_end
  FROM gaps2 GROUP BY ALL)""", """SELECT event_type, "partition", n_stalls, max_gap_seconds, stalled_at_end
FROM per_part WHERE n_stalls > 0 OR stalled_at_end""")
    # -- streaming: the batch twins
    q["stream_consume"] = _with("", _summary("valid_events"))
    q["stream_resume"] = q["land_decoded_log"] = q["stream_consume"]
    q["stream_high_water"] = q["high_water_offsets"]
    q["stream_consume_with_commits"] = _with("", """
SELECT 's2' AS group_id, event_type, "partition" AS partition_id, CAST(max(cursor_offset) AS VARCHAR) AS checkpoint_id,
       'worker-s' AS lease_holder, 'lease-s' AS lease_id
FROM wb WHERE fault IS NULL GROUP BY ALL""")
    q["stream_consume_two_groups"] = _with("", """
SELECT g AS group_id, event_type, "partition" AS partition_id, CAST(max(cursor_offset) AS VARCHAR) AS checkpoint_id,
       'worker-' || g AS lease_holder, 'lease-' || g AS lease_id
FROM wb, (VALUES ('g1'), ('g2')) AS t(g) WHERE fault IS NULL AND (g = 'g1' OR event_type IN ('click', 'error')) GROUP BY ALL""")
    q["stream_republish"] = _with("", """SELECT md5(eid || ':audit') AS new_eid, eid AS parent_eid
FROM valid_events WHERE event_type = 'purchase'""")
    return q
