"""Plain SQL twins of the registered queries, for a side-by-side check on the same tables."""

from __future__ import annotations

_EVENTS = """
msg AS (
  SELECT *, 'app-' || event_type AS topic, (user_id % 4)::VARCHAR AS part, event_id AS off,
         'app-' || event_type || '-' || (user_id % 4) || '-' || event_id AS id,
         (event_id * 7919) % 11 <> 0 AS acked, (event_id * 7919) % 100003 AS ack_seq,
         'kafkaKey=' || user_id || ';schema=v1' AS attributes
  FROM events)"""

_ALL = (
    _EVENTS
    + """,
everything AS (
  SELECT id, topic, part, off, props AS payload, user_id AS k FROM msg
  UNION ALL
  SELECT 'chat-' || role || '-' || (conv_id % 4) || '-' || (conv_id * 1000 + turn),
         'chat-' || role, (conv_id % 4)::VARCHAR, conv_id * 1000 + turn, text, conv_id
  FROM conversations
  UNION ALL
  SELECT 'orders-' || o_orderstatus || '-' || (o_custkey % 4) || '-' || o_orderkey,
         'orders-' || o_orderstatus, (o_custkey % 4)::VARCHAR, o_orderkey, o_orderpriority, o_custkey
  FROM orders)"""
)

_KINESIS = """
shardrows AS (
  SELECT event_id, ts, user_id % 16 AS shard, 'shard-' || (user_id % 16) AS part,
         CASE WHEN user_id % 16 < 8 THEN '4959033827' || lpad(event_id::VARCHAR, 46, '0')
              ELSE event_id::VARCHAR END AS pos,
         (event_id * 7919) % 11 <> 0 AS acked
  FROM events),
shardstate AS (
  SELECT part, min(event_id) AS lowest,
         min(event_id) FILTER (NOT acked) AS first_unacked,
         count(*) FILTER (NOT acked) AS outstanding
  FROM shardrows GROUP BY part),
shardckpt AS (
  SELECT r.part, max(event_id) AS n
  FROM shardrows r JOIN shardstate s USING (part)
  WHERE first_unacked IS NULL OR event_id < first_unacked GROUP BY r.part),
shardpos AS (SELECT DISTINCT part, event_id, pos FROM shardrows)"""

_STARTS = """
starts AS (
  SELECT 'shard-' || CASE r_regionkey WHEN 3 THEN 998 WHEN 4 THEN 999 ELSE r_regionkey END AS part,
         CASE r_regionkey WHEN 0 THEN 'AT_SEQUENCE_NUMBER' WHEN 1 THEN 'AFTER_SEQUENCE_NUMBER'
              WHEN 2 THEN 'AT_TIMESTAMP' ELSE 'LATEST' END AS kind,
         CASE WHEN r_regionkey = 2 THEN '2024-01-15 00:00:00' END AS ts,
         CASE WHEN r_regionkey < 2 THEN '4959033827' || lpad('500', 46, '0') END AS seq
  FROM region)"""

_OUTCOMES = """
outcomes AS (
  SELECT event_id, event_type AS reg, event_id // 20 AS batch_no, event_id % 20 AS idx,
         'app-' || event_type || '-' || (user_id % 4) || '-' || event_id AS id,
         value < 100 AS ok,
         CASE WHEN NOT (value < 100) THEN 'broker refused ' || event_id END AS error
  FROM events)"""

_BRIDGE = r"""
bridge0 AS (
  SELECT r_regionkey AS reg_no,
         CASE WHEN r_regionkey < 4 THEN 'app' ELSE 'chat' END AS source_id,
         ['click', 'error', 'purchase', 'view', 'user'][r_regionkey + 1] AS channel,
         NULL AS source_topic, NULL AS target_topic, 0 AS partitions, 3 AS replication
  FROM region
  UNION ALL
  SELECT n_nationkey + 10,
         CASE n_nationkey % 10 WHEN 1 THEN '  ' WHEN 2 THEN 'bad id' WHEN 3 THEN 'line' || chr(10)
              WHEN 4 THEN repeat('s', 249) WHEN 5 THEN 'app'
              ELSE lower(replace(n_name, '_', '-')) END,
         CASE n_nationkey % 10 WHEN 4 THEN 'c' WHEN 5 THEN 'click' WHEN 6 THEN 'no/slash'
              WHEN 7 THEN NULL ELSE 'orders.v1' END,
         CASE n_nationkey % 10 WHEN 8 THEN ''
              ELSE 'raw-' || lower(replace(n_name, '_', '-')) END,
         CASE WHEN n_nationkey = 9 THEN 'elsewhere' END,
         n_nationkey % 7 - 1, n_regionkey - 1
  FROM nation),
bridge1 AS (
  SELECT reg_no, source_id, channel,
         CASE WHEN reg_no < 10 THEN source_id || '-' || channel ELSE source_topic END AS source_topic,
         coalesce(target_topic, source_id || '.' || coalesce(channel, '?')) AS target_topic,
         partitions, replication
  FROM bridge0),
bridge2 AS (
  SELECT *, CASE
    WHEN source_id IS NULL OR trim(source_id) = '' THEN 'sourceId must be non-blank'
    WHEN channel IS NULL OR trim(channel) = '' THEN 'channel must be non-blank'
    WHEN source_topic IS NULL OR trim(source_topic) = '' THEN 'sourceTopic must be non-blank'
    WHEN target_topic IS NULL OR trim(target_topic) = '' THEN 'targetTopic must be non-blank'
    WHEN NOT regexp_full_match(source_id, '[a-zA-Z0-9_-]+')
      THEN 'sourceId must match ^[a-zA-Z0-9_-]+$, got ' || source_id
    WHEN NOT regexp_full_match(channel, '[a-zA-Z0-9._-]+')
      THEN 'channel must match ^[a-zA-Z0-9._-]+$, got ' || channel
    WHEN length(source_id) + 1 + length(channel) > 249
      THEN 'sourceId + "." + channel must be at most 249 characters, got '
           || (length(source_id) + 1 + length(channel))
    WHEN target_topic <> source_id || '.' || channel
      THEN 'targetTopic must equal sourceId + "." + channel (' || source_id || '.' || channel
           || '), got ' || target_topic
    END AS broken
  FROM bridge1),
bridge AS (
  SELECT *, CASE WHEN broken IS NOT NULL THEN broken
    WHEN row_number() OVER (PARTITION BY source_id, channel, broken IS NULL ORDER BY reg_no) > 1
      THEN '(sourceId, channel) already registered: ' || source_id || '.' || channel
    END AS refusal
  FROM bridge2)"""

_RELAY = r"""
relay1 AS (
  SELECT n_nationkey AS reg_no,
         CASE n_nationkey % 6 WHEN 4 THEN 'dest id' WHEN 5 THEN ''
              ELSE 'dest-' || (n_nationkey % 3) END AS destination_id,
         ['app.click', 'app.error', 'app.view', 'chat.user'][n_nationkey % 4 + 1] AS source_topic,
         'queue_' || n_nationkey AS downstream_topic
  FROM nation),
relay2 AS (
  SELECT *, CASE
    WHEN trim(destination_id) = '' THEN 'destinationId must be non-blank'
    WHEN NOT regexp_full_match(destination_id, '[a-zA-Z0-9_-]+')
      THEN 'destinationId must match ^[a-zA-Z0-9_-]+$, got ' || destination_id
    END AS broken
  FROM relay1),
relay AS (
  SELECT *, CASE WHEN broken IS NOT NULL THEN broken
    WHEN row_number() OVER (PARTITION BY destination_id, source_topic, broken IS NULL ORDER BY reg_no) > 1
      THEN '(destinationId, sourceTopic) already registered: ' || destination_id || ' / ' || source_topic
    END AS refusal
  FROM relay2)"""

_BACKBONE = """
backbone AS (
  SELECT e.id, b.target_topic AS topic, e.payload, b.source_id, b.channel,
         'bridge.channel=' || b.channel || ';bridge.sourceId=' || b.source_id
         || ';bridge.sourceTopic=' || e.topic || ';kafkaKey=' || e.k AS head
  FROM everything e JOIN bridge b ON e.topic = b.source_topic WHERE b.refusal IS NULL)"""

_PAYLOADS = """
cases AS (
  SELECT id, topic, event_id % 11 AS kind, CASE event_id % 11
    WHEN 0 THEN '{"id":"e' || event_id || '","amount":' || event_id || ',"paid":true}'
    WHEN 1 THEN '{"id":"e' || event_id || '"} trailing'
    WHEN 2 THEN '{"id":"e' || event_id || '"}{"id":"b"}'
    WHEN 3 THEN ''
    WHEN 4 THEN 'null'
    WHEN 5 THEN '[1]'
    WHEN 6 THEN '{"id":' || event_id || ',"amount":1,"paid":true}'
    WHEN 7 THEN '{"amount":' || event_id || ',"paid":false}'
    WHEN 8 THEN '{"id":null,"amount":' || event_id || '}'
    WHEN 9 THEN '{"id":"e' || event_id || '","amount":"x","paid":true}'
    ELSE '{"id":"e' || event_id || '","amount":1.5,"paid":[1]' END AS p
  FROM msg),
tagged AS (
  SELECT *, CASE WHEN json_valid(p) THEN json_type(p) END AS root,
         CASE WHEN json_valid(p) THEN json_type(p, '$.id') END AS t_id,
         CASE WHEN json_valid(p) THEN json_type(p, '$.amount') END AS t_amount,
         CASE WHEN json_valid(p) THEN json_type(p, '$.paid') END AS t_paid
  FROM cases),
named AS (
  SELECT id, topic, kind, p, root,
         CASE t_id WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'NUMBER'
              WHEN 'BIGINT' THEN 'NUMBER' WHEN 'DOUBLE' THEN 'NUMBER' ELSE t_id END AS t_id,
         CASE t_amount WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'NUMBER'
              WHEN 'BIGINT' THEN 'NUMBER' WHEN 'DOUBLE' THEN 'NUMBER' ELSE t_amount END AS t_amount,
         CASE t_paid WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'NUMBER'
              WHEN 'BIGINT' THEN 'NUMBER' WHEN 'DOUBLE' THEN 'NUMBER' ELSE t_paid END AS t_paid
  FROM tagged),
reasons AS (
  SELECT id, topic, p,
    CASE WHEN topic = 'app-signup' THEN NULL
         WHEN p = '' THEN 'empty payload'
         WHEN root = 'NULL' THEN 'non-JSON payload: empty document'
         WHEN root IS NULL AND kind IN (1, 2)
           THEN 'non-JSON payload: trailing content after JSON value'
         WHEN root IS NULL THEN 'non-JSON payload: malformed document'
         WHEN root <> 'OBJECT' THEN 'expected JSON object at root, got ' || root
    END AS document,
    CASE WHEN t_id IS DISTINCT FROM 'STRING' THEN 'id'
         WHEN t_amount IS DISTINCT FROM 'NUMBER' THEN 'amount'
         WHEN t_paid IS DISTINCT FROM 'BOOLEAN' THEN 'paid' END AS field,
    CASE WHEN t_id IS NULL THEN 'missing required field'
         WHEN t_id <> 'STRING' THEN 'expected STRING, got ' || t_id
         WHEN t_amount IS NULL THEN 'missing required field'
         WHEN t_amount <> 'NUMBER' THEN 'expected NUMBER, got ' || t_amount
         WHEN t_paid IS NULL THEN 'missing required field'
         WHEN t_paid <> 'BOOLEAN' THEN 'expected BOOLEAN, got ' || t_paid END AS field_reason
  FROM named),
verdicts AS (
  SELECT id, topic, CASE WHEN document IS NULL AND topic <> 'app-signup' THEN field END AS field_name,
         CASE WHEN topic = 'app-signup' THEN NULL
              ELSE coalesce(document, field_reason) END AS reason
  FROM reasons)"""

_CHANGES = """
changes AS (
  SELECT 'app-' || event_type AS topic, user_id % 5 <> 0 AS registers, event_id AS seq,
         '{"requiredFields":[' || array_to_string(list_slice(
            ['{"name":"id","type":"STRING"}', '{"name":"amount","type":"NUMBER"}',
             '{"name":"paid","type":"BOOLEAN"}'], 1, user_id % 3 + 1), ',') || ']}' AS definition
  FROM events),
current AS (
  SELECT topic, definition FROM changes
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY seq DESC) = 1 AND registers)"""

_CAPPED = """
, s0 AS (SELECT topic, part, off, CASE WHEN acked THEN ack_seq END AS ack FROM msg),
k1 AS (SELECT topic, part, min(off) AS seek FROM s0 WHERE ack IS NULL GROUP BY ALL),
s1 AS (
  SELECT topic, part, off, CASE WHEN off % 5 <> 0 THEN ack_seq + 100003 END AS ack
  FROM msg JOIN k1 USING (topic, part) WHERE off >= seek),
k2 AS (SELECT topic, part, min(off) AS seek FROM s1 WHERE ack IS NULL GROUP BY ALL),
s2 AS (SELECT topic, part, off, ack_seq + 200006 AS ack FROM msg JOIN k2 USING (topic, part) WHERE off >= seek),
sessions AS (SELECT 0 AS s, * FROM s0 UNION ALL SELECT 1, * FROM s1 UNION ALL SELECT 2, * FROM s2),
along AS (
  SELECT *, bool_and(ack IS NOT NULL) OVER upto AS whole, max(ack) OVER upto AS at_ack
  FROM sessions WINDOW upto AS (PARTITION BY s, topic, part ORDER BY off))
SELECT 'commit' AS event, topic, part, at_ack AS at, max(off) + 1 AS position
FROM along WHERE whole GROUP BY s, topic, part, at_ack
UNION ALL SELECT 'seek', topic, part, 1, seek FROM k1
UNION ALL SELECT 'seek', topic, part, 2, seek FROM k2
UNION ALL SELECT 'refused', '', '', ack_seq + 600018, off FROM msg JOIN s1 USING (topic, part, off) WHERE off % 29 = 0
UNION ALL SELECT 'refused', '', '', ack_seq + 700021, off FROM msg JOIN s2 USING (topic, part, off) WHERE off % 29 = 0"""


def _asof(only: str = "") -> str:
    """Violations by the contract valid at each message: its first one to three of the fields."""
    return f"""
, fields AS (
  SELECT topic, seq, registers, CASE WHEN registers THEN len(string_split(definition, '"name"')) - 1 ELSE 0 END AS wide
  FROM changes WHERE true{only}),
placed AS (
  SELECT n.*, f.wide FROM (
    SELECT named.*, off FROM named JOIN msg USING (id)) n
  ASOF LEFT JOIN fields f ON n.topic = f.topic AND n.off >= f.seq),
judged AS (
  SELECT id, topic, wide,
    CASE WHEN p = '' THEN 'empty payload'
         WHEN root = 'NULL' THEN 'non-JSON payload: empty document'
         WHEN root IS NULL AND kind IN (1, 2) THEN 'non-JSON payload: trailing content after JSON value'
         WHEN root IS NULL THEN 'non-JSON payload: malformed document'
         WHEN root <> 'OBJECT' THEN 'expected JSON object at root, got ' || root END AS document,
    CASE WHEN t_id IS DISTINCT FROM 'STRING' THEN 'id'
         WHEN wide >= 2 AND t_amount IS DISTINCT FROM 'NUMBER' THEN 'amount'
         WHEN wide >= 3 AND t_paid IS DISTINCT FROM 'BOOLEAN' THEN 'paid' END AS field,
    CASE WHEN t_id IS NULL THEN 'missing required field'
         WHEN t_id <> 'STRING' THEN 'expected STRING, got ' || t_id
         WHEN wide >= 2 AND t_amount IS NULL THEN 'missing required field'
         WHEN wide >= 2 AND t_amount <> 'NUMBER' THEN 'expected NUMBER, got ' || t_amount
         WHEN wide >= 3 AND t_paid IS NULL THEN 'missing required field'
         WHEN wide >= 3 AND t_paid <> 'BOOLEAN' THEN 'expected BOOLEAN, got ' || t_paid END AS field_reason
  FROM placed WHERE wide >= 1),
refused AS (
  SELECT id, topic, CASE WHEN document IS NULL THEN field END AS field_name,
         coalesce(document, field_reason) AS reason FROM judged)
SELECT id, topic, field_name, reason, 'topic=' || topic
  || CASE WHEN field_name IS NULL THEN '' ELSE ' field=' || field_name END
  || ' reason=' || reason AS message FROM refused WHERE reason IS NOT NULL"""


_DEFINITIONS = """
definitions AS (
  SELECT event_id, event_id % 14 AS kind, CASE event_id % 14
    WHEN 0 THEN '{"requiredFields":[{"name":"f' || event_id
      || '","type":"NUMBER"},{"name":"ok","type":"BOOLEAN"}]}'
    WHEN 1 THEN '{"requiredFields":[]}'
    WHEN 2 THEN '{nope'
    WHEN 3 THEN '{} ' || event_id
    WHEN 4 THEN '  '
    WHEN 5 THEN '[]'
    WHEN 6 THEN '{"other":1}'
    WHEN 7 THEN '{"requiredFields":{}}'
    WHEN 8 THEN '{"requiredFields":[{"name":"userId","type":"STRING"},7]}'
    WHEN 9 THEN '{"requiredFields":[{"name":" ","type":"STRING"}]}'
    WHEN 10 THEN '{"requiredFields":[{"name":"a","type":3}]}'
    WHEN 11 THEN '{"requiredFields":[{"name":"userId","type":"STRING"},{"name":"userId","type":"STRING"}]}'
    WHEN 12 THEN '{"requiredFields":[{"name":"f' || event_id || '","type":"string"}]}'
    ELSE '{"requiredFields":[{"name":"userId","type":"STRING"},{"name":"count","type":"NUMBER"}]}'
    END AS definition
  FROM events),
outer_checks AS (
  SELECT *, CASE
    WHEN trim(definition) = '' THEN 'invalid JSON: empty document'
    WHEN NOT json_valid(definition) AND kind = 3
      THEN 'invalid JSON: trailing content after schema document'
    WHEN NOT json_valid(definition) THEN 'invalid JSON: malformed document'
    WHEN json_type(definition) <> 'OBJECT' THEN 'schema must be a JSON object'
    WHEN json_type(definition, '$.requiredFields') IS NULL THEN 'missing ''requiredFields'''
    WHEN json_type(definition, '$.requiredFields') <> 'ARRAY'
      THEN '''requiredFields'' must be a JSON array' END AS broken
  FROM definitions),
entries AS (
  SELECT event_id, i, json_extract(definition, '$.requiredFields[' || i || ']') AS e
  FROM (SELECT event_id, definition,
               unnest(range(json_array_length(definition, '$.requiredFields')::BIGINT)) AS i
        FROM outer_checks WHERE broken IS NULL)),
parsed AS (
  SELECT event_id, i, json_type(e) AS kind,
         CASE WHEN json_type(e, '$.name') = 'VARCHAR' THEN e ->> '$.name' END AS name,
         CASE WHEN json_type(e, '$.type') = 'VARCHAR' THEN e ->> '$.type' END AS type
  FROM entries),
entry_reasons AS (
  SELECT *, CASE
    WHEN kind <> 'OBJECT' THEN 'requiredFields entry must be a JSON object'
    WHEN name IS NULL OR trim(name) = '' THEN 'requiredFields entry missing non-blank ''name'''
    WHEN type IS NULL THEN 'requiredFields entry missing textual ''type'''
    WHEN row_number() OVER (PARTITION BY event_id, name ORDER BY i) > 1
      THEN 'duplicate field name: ' || name
    WHEN type NOT IN ('STRING', 'NUMBER', 'BOOLEAN', 'OBJECT', 'ARRAY')
      THEN 'unknown field type: ' || type END AS broken
  FROM parsed),
entry_lists AS (
  SELECT event_id, arg_min(broken, i) FILTER (broken IS NOT NULL) AS broken,
         string_agg(name || ':' || type, ',' ORDER BY i) AS fields
  FROM entry_reasons GROUP BY event_id)"""

_LATE = (
    _EVENTS
    + """,
late AS (
  SELECT topic, part, off, CASE WHEN event_id % 4999 <> 4998 THEN ack_seq END AS seq FROM msg),
prefix AS (
  SELECT *, bool_and(seq IS NOT NULL) OVER w AS whole, max(seq) OVER w AS at_ack
  FROM late WINDOW w AS (PARTITION BY topic, part ORDER BY off))"""
)


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


_KEYED = """
keyed AS (
  SELECT *, CASE WHEN event_id % 5 = 0 OR event_id % 3 = 2 THEN NULL
                 WHEN event_id % 3 = 0 THEN user_id::VARCHAR ELSE '' END AS pk,
         event_id % 5 = 0 AS bare
  FROM msg)"""


def all_sql() -> dict[str, str]:
    """SQL by query name."""
    sql: dict[str, str] = {}

    kafka_attributes = """
      CASE WHEN event_id % 11 = 0 THEN '' ELSE
        CASE WHEN event_id % 5 = 0 THEN 'raw=' || chr(65533) || 'A;' ELSE '' END
        || 'schema=' || CASE WHEN event_id % 3 = 0 THEN 'v2' ELSE 'v1' END
        || ';trace=' || CASE WHEN event_id % 7 = 0 THEN '' ELSE event_id::VARCHAR END END"""
    kafka_head = """
      SELECT id, topic, part, off::VARCHAR AS pos,
             CASE WHEN event_id % 10 = 0 THEN '' ELSE hex(props) END AS payload_hex,"""
    sql["kafka_envelope"] = _with(
        _EVENTS, select=f"{kafka_head} {kafka_attributes} AS attributes FROM msg"
    )
    sql["kafka_envelope_with_key"] = _with(
        _EVENTS,
        select=f"""{kafka_head} 'kafkaKey=' || user_id
          || CASE WHEN event_id % 11 = 0 THEN '' ELSE ';' END || {kafka_attributes} AS attributes
        FROM msg""",
    )
    sql["kinesis_envelope"] = """
      WITH a AS (
        SELECT *, '4959033827' || lpad(event_id::VARCHAR, 46, '0') AS seq,
               CASE WHEN event_id % 6 = 0 THEN NULL
                    WHEN event_id % 4 = 1 THEN date_trunc('second', ts)
                    WHEN event_id % 4 = 2 THEN date_trunc('milliseconds', ts) ELSE ts END AS arrival
        FROM events),
      b AS (SELECT *, epoch_us(arrival) % 1000000 AS us FROM a)
      SELECT 'shard-' || (user_id % 16) || ':' || seq AS id, 'app-stream' AS topic,
             'shard-' || (user_id % 16) AS part, seq AS pos,
             CASE WHEN event_id % 10 = 0 THEN '' ELSE hex(props) END AS payload_hex,
             CASE WHEN arrival IS NULL THEN '' ELSE
               'approximateArrivalTimestamp=' || strftime(arrival, '%Y-%m-%dT%H:%M:%S')
               || CASE WHEN us = 0 THEN '' WHEN us % 1000 = 0 THEN printf('.%03d', us // 1000)
                       ELSE printf('.%06d', us) END || 'Z;' END
             || 'partitionKey=' || user_id AS attributes
      FROM b"""
    sql["pulsar_envelope"] = """
      SELECT 'chat-' || role || '-' || conv_id || ':' || turn || ':-1' AS id,
             'chat-' || role AS topic, 'chat-' || role AS part, conv_id || ':' || turn || ':-1' AS pos,
             CASE WHEN turn % 5 = 4 THEN '' ELSE hex(text) END AS payload_hex,
             CASE WHEN turn % 2 = 0 THEN 'conv=' || conv_id ELSE '' END AS attributes
      FROM conversations"""
    sql["gcp_envelope"] = """
      SELECT 'm' || event_id AS id, 'events-sub' AS topic, 'ack' || event_id AS pos,
             hex(props) AS payload_hex,
             CASE WHEN event_id % 4 = 0 THEN '' ELSE 'k=' || event_type END AS attributes
      FROM events"""
    sql["multi_topic_scan"] = _with(
        _ALL,
        select="""SELECT id, topic, part, off FROM everything
        WHERE topic IN ('app-click', 'chat-user', 'orders-F', 'app-nothing')""",
    )
    sql["start_positions"] = _with(
        _KINESIS,
        _STARTS,
        select="""
      SELECT r.part || ':' || r.pos AS id, r.part, r.pos
      FROM shardrows r LEFT JOIN starts s ON r.part = s.part
      WHERE CASE coalesce(s.kind, 'AT_TIMESTAMP')
        WHEN 'LATEST' THEN false
        WHEN 'AT_TIMESTAMP' THEN r.ts >= coalesce(s.ts, '2024-01-10 12:00:00')::TIMESTAMP
        WHEN 'AT_SEQUENCE_NUMBER' THEN r.event_id >= 500
        ELSE r.event_id > 500 END""",
    )
    sql["shard_pruning"] = """
      WITH s AS (
        SELECT user_id % 64 AS n, 'shard-' || (user_id % 64) AS part, min(ts) AS opened, max(ts) AS last
        FROM events GROUP BY ALL),
      t AS (
        SELECT part, CASE n % 3 WHEN 0 THEN last WHEN 1 THEN opened END AS closed FROM s)
      SELECT 'latest' AS plan, part FROM t WHERE closed IS NULL
      UNION ALL
      SELECT 'timestamp', part FROM t
      WHERE closed IS NULL OR closed > TIMESTAMP '2024-01-15 00:00:00'
      UNION ALL SELECT 'horizon', part FROM t
      UNION ALL SELECT 'overrides', part FROM t"""
    sql["intake_caps"] = _with(
        _EVENTS,
        select="""SELECT topic, part, off, id FROM msg
        QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off) <= 40""",
    )
    # 7 topics, budget 150: share 21; pull 11 starts at topic 11 mod 7 = 4.
    sql["fair_share"] = _with(
        _ALL,
        select="""
      , subs AS (
        SELECT * FROM (VALUES ('app-click', 0), ('app-view', 1), ('app-nothing', 2),
          ('chat-system', 3), ('chat-user', 4), ('orders-P', 5), ('app-error', 6)) v(topic, ix)),
      ranked AS (
        SELECT e.*, (ix + 3) % 7 AS turn,
               row_number() OVER (PARTITION BY e.topic ORDER BY off) AS rn
        FROM everything e JOIN subs USING (topic)),
      numbered AS (
        SELECT *, row_number() OVER (ORDER BY turn, rn) AS visit_no FROM ranked WHERE rn <= 21)
      SELECT visit_no::INTEGER AS visit_no, topic, off, id FROM numbered WHERE visit_no <= 150""",
    )
    sql["read_budget_audit"] = """
      WITH f AS (
        SELECT 'shard-' || event_type AS shard, event_id * 150000000 AS at_nanos,
               user_id * 20000 AS bytes FROM events),
      g AS (
        SELECT *, at_nanos + greatest(200000000,
                 CASE WHEN bytes > 0 THEN (bytes * 1000000000 + 2097151) // 2097152 ELSE 0 END)
                 AS allowed_at FROM f),
      h AS (SELECT *, lag(allowed_at) OVER (PARTITION BY shard ORDER BY at_nanos) AS ready_at FROM g)
      SELECT shard, at_nanos, bytes, allowed_at, ready_at,
             coalesce(at_nanos < ready_at, false)::INT AS is_early FROM h"""

    sql["kafka_rows"] = _with(
        _EVENTS,
        select="""SELECT topic, hex(user_id::VARCHAR) AS key_hex, hex(props) AS value_hex,
        'schema=v1' AS headers FROM msg""",
    )
    sql["kinesis_rows"] = _with(
        _EVENTS,
        _KEYED,
        select="""SELECT topic AS stream, coalesce(nullif(pk, ''), id) AS partition_key,
        hex(props) AS data_hex FROM keyed""",
    )
    ordered = f"""CASE WHEN pk IS NULL THEN attributes ELSE
        'kafkaKey=' || user_id || ';partitionKey=' || pk || ';schema=v1' END"""
    sql["pulsar_rows"] = _with(
        _EVENTS,
        _KEYED,
        select=f"""SELECT topic, hex(props) AS value_hex,
        CASE WHEN bare THEN NULL ELSE {ordered} END AS properties FROM keyed""",
    )
    sql["gcp_rows"] = _with(
        _EVENTS,
        _KEYED,
        select=f"""SELECT 'projects/demo-project/topics/' || topic AS topic, hex(props) AS data_hex,
        CASE WHEN bare THEN '' ELSE {ordered} END AS attributes FROM keyed""",
    )
    sql["landed_backbone"] = _with(
        _ALL,
        select="SELECT id, topic, part, off, md5(payload) AS payload_md5 FROM everything",
    )
    sql["chunk_plan"] = """
      WITH o AS (
        SELECT 'orders-' || o_orderstatus AS topic, o_orderkey AS off,
               'orders-' || o_orderstatus || '-' || (o_custkey % 4) || '-' || o_orderkey AS id,
               row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS n FROM orders)
      SELECT topic, off, id, n // 500 AS chunk_no, n % 500 AS entry_no FROM o"""
    sql["batch_precheck"] = """
      WITH o AS (
        SELECT o_orderkey // 50 AS batch_no, o_orderkey AS idx,
               CASE WHEN o_orderkey % 211 <> 0 THEN
                 'orders-' || o_orderstatus || '-' || (o_custkey % 4) || '-' || o_orderkey END AS entry
        FROM orders)
      SELECT batch_no, idx, entry,
             CASE WHEN bool_or(entry IS NULL) OVER (PARTITION BY batch_no)
                  THEN 'messages contains null' END AS refusal FROM o"""
    sql["publish_results"] = _with(
        _EVENTS,
        select="""
      SELECT 'kafka' AS backend, id AS message_id, topic, part::INT AS partition, off AS "offset",
             NULL AS shard_id, NULL AS sequence_number, event_id * 1000 AS "timestamp"
      FROM msg WHERE event_id % 4 = 0
      UNION ALL
      SELECT 'kinesis', 'shard-' || part || ':4959033827' || lpad(event_id::VARCHAR, 46, '0'), topic,
             NULL, NULL, 'shard-' || part, '4959033827' || lpad(event_id::VARCHAR, 46, '0'), NULL
      FROM msg WHERE event_id % 4 = 1
      UNION ALL
      SELECT 'pulsar', topic || '-b' || event_id, topic, NULL, NULL, NULL, NULL, NULL
      FROM msg WHERE event_id % 4 = 2
      UNION ALL
      SELECT 'gcp', 'b' || event_id, topic, NULL, NULL, NULL, NULL, NULL
      FROM msg WHERE event_id % 4 = 3""",
    )
    sql["entry_failures"] = _with(
        _EVENTS,
        select="""
      , c AS (
        SELECT *, (row_number() OVER (PARTITION BY topic ORDER BY off) - 1) // 500 AS chunk_no FROM msg),
      d AS (
        SELECT *, CASE
          WHEN (chunk_no + length(topic)) % 5 = 0 THEN 'connection reset'
          WHEN event_id % 19 = 0 THEN 'Kinesis PutRecords entry failed: '
            || 'ProvisionedThroughputExceededException: rate limited'
          WHEN event_id % 23 = 0 THEN 'Kinesis PutRecords entry failed: InternalFailure: null'
          END AS error FROM c)
      SELECT event_id, topic AS stream, chunk_no, (error IS NULL)::INT AS ok, error,
             CASE WHEN error IS NULL THEN 'shard-' || part || ':4959033827'
                  || lpad(event_id::VARCHAR, 46, '0') END AS message_id FROM d""",
    )

    fan_in = "id, topic, md5(payload) AS payload_md5, head || ';schema=v1' AS attributes"
    fan_out = """
      SELECT b.id, r.downstream_topic AS topic, md5(b.payload) AS payload_md5,
             b.head || ';relay.destinationId=' || r.destination_id || ';relay.downstreamTopic='
             || r.downstream_topic || ';relay.sourceTopic=' || b.topic || ';schema=v1' AS attributes
      FROM backbone b JOIN relay r ON r.source_topic = b.topic WHERE r.refusal IS NULL"""
    sql["bridge_fan_in"] = _with(_ALL, _BRIDGE, _BACKBONE, select=f"SELECT {fan_in} FROM backbone")
    sql["bridge_topic_counts"] = _with(
        _ALL,
        _BRIDGE,
        _BACKBONE,
        select="SELECT topic, source_id, count(*) AS messages FROM backbone GROUP BY ALL",
    )
    sql["relay_fan_out"] = _with(_ALL, _BRIDGE, _BACKBONE, _RELAY, select=fan_out)
    sql["path_report"] = _with(
        _ALL,
        _BRIDGE,
        _BACKBONE,
        _RELAY,
        select="""
      SELECT b.source_id, b.channel, r.destination_id, r.downstream_topic, count(*) AS messages
      FROM backbone b JOIN relay r ON r.source_topic = b.topic WHERE r.refusal IS NULL GROUP BY ALL""",
    )
    sql["bridge_route_checks"] = _with(
        _BRIDGE, select="SELECT reg_no::BIGINT AS reg_no, source_id, channel, target_topic, refusal FROM bridge"
    )
    sql["relay_route_checks"] = _with(
        _RELAY, select="SELECT reg_no::BIGINT AS reg_no, destination_id, source_topic, refusal FROM relay"
    )
    effective = """CASE WHEN partitions = 0 THEN 6 ELSE partitions END AS effective_partitions,
        CASE WHEN replication = 0 THEN 2 ELSE replication END AS effective_replication"""
    sql["topic_plan"] = _with(
        _BRIDGE,
        select=f"""SELECT reg_no::BIGINT AS reg_no, {effective},
        CASE WHEN partitions < 0 THEN 'partitions must be >= 0, got ' || partitions
             WHEN replication < 0 THEN 'replicationFactor must be >= 0, got ' || replication
        END AS option_refusal FROM bridge""",
    )
    sql["topics_to_create"] = _with(
        _ALL,
        _BRIDGE,
        select=f"""SELECT target_topic, {effective} FROM bridge
        WHERE refusal IS NULL AND partitions >= 0 AND replication >= 0 AND target_topic NOT IN (
          SELECT CASE WHEN topic LIKE '%e' OR topic LIKE '%k' THEN '' ELSE 'old.' END
                 || replace(topic, '-', '.') FROM everything)""",
    )

    held = """
      , state AS (
        SELECT topic, part, min(off) FILTER (NOT acked) AS fu FROM msg GROUP BY ALL)"""
    sql["ack_checkpoint"] = _with(
        _EVENTS,
        select=f"""{held}
      SELECT topic, part, max(off) AS checkpoint, max(off) + 1 AS commit_offset
      FROM msg JOIN state USING (topic, part) WHERE fu IS NULL OR off < fu GROUP BY ALL""",
    )
    sql["kafka_start_options"] = _with(
        _EVENTS,
        select=f"""{held}
      , points AS (
        SELECT topic, part, max(off) + 1 AS next
        FROM msg JOIN state USING (topic, part) WHERE fu IS NULL OR off < fu GROUP BY ALL)
      SELECT topic, 'startingOffsets' AS option,
             '{{' || string_agg('"' || part || '":' || next, ',' ORDER BY part) || '}}' AS partitions
      FROM points GROUP BY topic""",
    )
    again = """
      , again AS (
        SELECT *, event_id % 5 <> 0 AS acked_again FROM msg JOIN state USING (topic, part)
        WHERE fu IS NOT NULL AND off >= fu)"""
    sql["redelivered_checkpoint"] = _with(
        _EVENTS,
        select=f"""{held}{again}
      , next AS (
        SELECT topic, part, min(off) FILTER (NOT acked_again) AS fu FROM again GROUP BY ALL),
      points AS (
        SELECT topic, part, off FROM msg JOIN state USING (topic, part) WHERE fu IS NULL OR off < fu
        UNION ALL
        SELECT topic, part, off FROM again JOIN next USING (topic, part)
        WHERE next.fu IS NULL OR off < next.fu)
      SELECT topic, part, max(off) AS checkpoint FROM points GROUP BY ALL""",
    )
    sql["refused_session_acks"] = _with(
        _EVENTS,
        select=f"""{held}{again}
      , bad AS (
        SELECT 'lost-' || id AS id, 0 AS session, ack_seq, 'never delivered' AS cause
        FROM msg WHERE acked AND event_id % 17 = 0
        UNION ALL
        SELECT id, 0, ack_seq + 100003, 'already acknowledged'
        FROM msg WHERE acked AND event_id % 13 = 0
        UNION ALL
        SELECT id, 1, event_id + 200006, 'of an earlier session'
        FROM msg WHERE event_id % 29 = 0 AND id NOT IN (SELECT id FROM again))
      SELECT *, 'Unknown message: ' || id
        || '. Only messages returned by poll() can be acknowledged.' AS message FROM bad""",
    )
    sql["kinesis_checkpoint"] = _with(
        _KINESIS,
        select="""SELECT c.part, p.pos AS checkpoint
        FROM shardckpt c JOIN shardpos p ON c.part = p.part AND c.n = p.event_id""",
    )
    sql["match_acks"] = _with(
        _EVENTS,
        select="""SELECT id, topic, part, off, CASE WHEN acked THEN ack_seq END AS ack_seq FROM msg""",
    )
    history = """SELECT topic, part, at_ack, max(off) + 1 AS commit_offset
        FROM prefix WHERE whole GROUP BY ALL"""
    sql["commit_history"] = _with(_LATE, select=history)
    sql["commit_attempts"] = _with(
        _LATE,
        select=f"""
      , advance AS ({history}),
      log AS (
        SELECT p.topic, p.part, p.seq AS ack_seq, p.seq % 3 <> 0 AS ok, a.commit_offset
        FROM prefix p LEFT JOIN advance a
          ON a.topic = p.topic AND a.part = p.part AND a.at_ack = p.seq
        WHERE p.seq IS NOT NULL),
      seen AS (
        SELECT topic, part, ack_seq, ok, max(commit_offset) OVER upto AS commit_offset,
               max(CASE WHEN commit_offset IS NOT NULL THEN ack_seq END) OVER upto AS advanced,
               max(CASE WHEN ok THEN ack_seq END) OVER earlier AS swept
        FROM log
        WINDOW upto AS (PARTITION BY topic, part ORDER BY ack_seq),
               earlier AS (PARTITION BY topic, part ORDER BY ack_seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      SELECT topic, part, ack_seq, commit_offset, ok::INT AS commit_ok FROM seen
      WHERE commit_offset IS NOT NULL AND (swept IS NULL OR swept < advanced)""",
    )
    sql["inflight"] = _with(
        _EVENTS,
        select="""SELECT topic, count(*) FILTER (NOT acked) AS in_flight,
        (count(*) FILTER (NOT acked) >= 180)::INT AS cap_reached FROM msg GROUP BY ALL""",
    )
    sql["bad_acks"] = _with(
        _EVENTS,
        select="""
      , bad AS (
        SELECT 'lost-' || id AS id, ack_seq, 'never delivered' AS cause
        FROM msg WHERE acked AND event_id % 17 = 0
        UNION ALL
        SELECT id, ack_seq + 100003, 'already acknowledged'
        FROM msg WHERE acked AND event_id % 13 = 0)
      SELECT *, 'Unknown message: ' || id
        || '. Only messages returned by poll() can be acknowledged.' AS message FROM bad""",
    )
    # Long sequence numbers are all above short ones, so compare (width, digits).
    sql["checkpoint_merge"] = _with(
        _KINESIS,
        select="""
      , snapshots AS (
        SELECT c.part, p.pos AS digits
        FROM shardckpt c JOIN shardpos p ON c.part = p.part AND c.n = p.event_id
        UNION ALL
        SELECT 'shard-' || (user_id % 16), coalesce(min(event_id) FILTER (event_id % 16 < user_id % 16), max(event_id))::VARCHAR
        FROM events GROUP BY 1)
      SELECT part, digits AS checkpoint FROM snapshots
      QUALIFY row_number() OVER (PARTITION BY part ORDER BY length(digits) DESC, digits DESC) = 1""",
    )
    sql["redelivery_plan"] = _with(
        _EVENTS,
        select=f"{held} SELECT topic, part, fu AS seek_to FROM state WHERE fu IS NOT NULL",
    )
    sql["redelivered_rows"] = _with(
        _EVENTS,
        select=f"""{held}
      SELECT id, topic, part, off FROM msg JOIN state USING (topic, part) WHERE off >= fu""",
    )
    resume = """
      SELECT s.part,
        CASE WHEN c.n IS NOT NULL THEN 'AFTER_SEQUENCE_NUMBER'
             WHEN l.part IS NOT NULL THEN 'AT_SEQUENCE_NUMBER'
             ELSE coalesce(o.kind, 'AT_TIMESTAMP') END AS start_kind,
        CASE WHEN c.n IS NULL AND l.part IS NULL THEN
             CASE WHEN o.part IS NOT NULL THEN o.ts ELSE '2024-01-10 12:00:00' END END AS start_ts,
        coalesce(pc.pos, pl.pos, o.seq) AS start_seq
      FROM shards s
      LEFT JOIN shardckpt c ON c.part = s.part
      LEFT JOIN shardstate l ON l.part = s.part
      LEFT JOIN shardpos pc ON pc.part = c.part AND pc.event_id = c.n
      LEFT JOIN shardpos pl ON pl.part = l.part AND pl.event_id = l.lowest
      LEFT JOIN starts o ON o.part = s.part"""
    sql["resume_positions"] = _with(
        _KINESIS,
        _STARTS,
        select=f"""
      , shards AS (
        SELECT part FROM shardstate
        UNION SELECT 'shard-' || (r_regionkey % 2 + 999) FROM region)
      {resume}""",
    )
    sql["cap_reacquired"] = _with(
        _KINESIS,
        select=f"""
      , starts AS (
        SELECT NULL::VARCHAR AS part, NULL::VARCHAR AS kind, NULL::VARCHAR AS ts, NULL::VARCHAR AS seq),
      shards AS (SELECT part FROM shardstate WHERE outstanding > 0)
      {resume}""",
    )
    sql["checkpoint_restore"] = _with(
        _KINESIS,
        select="""SELECT r.part, count(*) AS to_read
        FROM shardrows r LEFT JOIN shardckpt c ON c.part = r.part
        WHERE c.n IS NULL OR r.event_id > c.n GROUP BY r.part""",
    )
    sql["latest_ack"] = """
      SELECT 'm' || (event_id * 31 % 2503) AS id, 'ack' || arg_max(event_id, ts) AS ack_id,
             count(*) AS deliveries FROM events GROUP BY 1"""

    sql["batch_outcome"] = _with(
        _OUTCOMES,
        select="""
      , g AS (
        SELECT reg, batch_no, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed,
               min(idx) FILTER (NOT ok) AS first_failed_idx,
               arg_min(error, idx) FILTER (NOT ok) AS cause
        FROM outcomes GROUP BY ALL)
      SELECT *, CASE WHEN failed > 0 THEN 'publishBatch had ' || failed
        || CASE WHEN failed = 1 THEN ' failure' ELSE ' failures' END END AS message FROM g""",
    )
    sql["batch_outcome_entries"] = _with(
        _OUTCOMES,
        select="""SELECT reg, batch_no, idx, id, CASE WHEN ok THEN
        row_number() OVER (PARTITION BY reg, batch_no, ok ORDER BY idx) - 1 END AS success_no,
        error FROM outcomes""",
    )
    sql["batch_cut"] = _with(
        _OUTCOMES,
        select="""
      , c AS (
        SELECT *, min(CASE WHEN NOT ok THEN idx END) OVER (PARTITION BY reg, batch_no) AS first_fail
        FROM outcomes)
      SELECT reg, batch_no, idx, id,
        CASE WHEN first_fail IS NULL OR idx < first_fail THEN 'acked'
             WHEN idx = first_fail THEN 'failed' ELSE 'not_attempted' END AS state FROM c""",
    )
    trips = """
      , f AS (
        SELECT *, min(CASE WHEN NOT ok THEN idx END) OVER (PARTITION BY reg, batch_no) AS first_fail
        FROM outcomes),
      b AS (
        SELECT reg, batch_no, bool_or(ok) AS any_ok, bool_or(NOT ok) AS failed
        FROM f WHERE first_fail IS NULL OR idx <= first_fail GROUP BY ALL),
      s AS (
        SELECT *, sum(any_ok::INT) OVER (PARTITION BY reg ORDER BY batch_no) AS grp FROM b),
      t AS (
        SELECT *, (sum(failed::INT) OVER (PARTITION BY reg, grp ORDER BY batch_no))::BIGINT AS streak
        FROM s)
      SELECT reg, batch_no, streak FROM t WHERE failed AND streak >= 3"""
    sql["breaker_trips"] = _with(_OUTCOMES, select=trips)
    sql["relay_attempts"] = """
      WITH a AS (
        SELECT event_type AS reg, event_id // 5 AS msg_no,
               CASE WHEN event_id % 97 = 0 THEN event_id - 11 ELSE event_id END AS tick,
               event_id % 3 <> 0 OR value < 20 AS ok
        FROM events),
      l AS (
        SELECT reg, msg_no, count(*) AS attempts, min(tick) AS first_at,
               min(tick) FILTER (ok) AS delivered_at FROM a GROUP BY ALL),
      w AS (
        SELECT *, max(delivered_at) OVER v AS prior, bool_or(delivered_at IS NULL) OVER v AS blocked
        FROM l WINDOW v AS (PARTITION BY reg ORDER BY msg_no
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      SELECT reg, msg_no, attempts, first_at, delivered_at, delivered_at - first_at AS wait,
             (blocked IS NULL OR (NOT blocked AND first_at >= prior))::INT AS in_order FROM w"""
    sql["ack_failures"] = _with(
        _OUTCOMES,
        select="""SELECT reg, batch_no, count(*) AS published,
        count(*) FILTER (event_id % 37 = 0) AS ack_failures,
        bool_or(event_id % 37 = 0)::INT AS backoffs FROM outcomes WHERE ok GROUP BY ALL""",
    )
    sql["duplicate_candidates"] = _with(
        _OUTCOMES,
        select="SELECT reg, batch_no, id FROM outcomes WHERE ok AND event_id % 37 = 0",
    )

    sql["contract_violations"] = _with(
        _EVENTS,
        _PAYLOADS,
        select="""SELECT id, topic, field_name, reason, 'topic=' || topic
        || CASE WHEN field_name IS NULL THEN '' ELSE ' field=' || field_name END
        || ' reason=' || reason AS message FROM verdicts WHERE reason IS NOT NULL""",
    )
    sql["contract_report"] = _with(
        _EVENTS,
        _PAYLOADS,
        select="""SELECT topic, field_name, reason, count(*) AS messages
        FROM verdicts WHERE reason IS NOT NULL GROUP BY ALL""",
    )
    sql["contract_asof"] = _with(_EVENTS, _PAYLOADS, _CHANGES, select=_asof())
    sql["contract_asof_few"] = _with(_EVENTS, _PAYLOADS, _CHANGES, select=_asof(" AND seq % 500 = 0"))
    sides = """SELECT id, CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantine' END AS side
        FROM verdicts"""
    sql["quarantine_split"] = _with(_EVENTS, _PAYLOADS, select=sides)
    sql["contract_fail_policy"] = _with(_EVENTS, select="SELECT id, topic FROM msg")
    sql["registry_state"] = _with(_CHANGES, select="SELECT topic, definition FROM current")
    sql["registered_topics"] = _with(_CHANGES, select="SELECT topic FROM current")
    sql["schema_encode"] = _with(
        _CHANGES, select="SELECT seq, topic, definition FROM changes WHERE registers"
    )
    sql["schema_decode"] = _with(
        _DEFINITIONS,
        select="""
      SELECT o.event_id, coalesce(o.broken, l.broken) AS reason,
             CASE WHEN o.broken IS NULL AND l.broken IS NULL THEN coalesce(l.fields, '') END AS fields
      FROM outer_checks o LEFT JOIN entry_lists l USING (event_id)""",
    )

    # Streams are compared with the SQL of their batch twins over the same messages.
    from_events = "everything AS (SELECT id, topic, part, off, props AS payload, user_id AS k FROM msg)"
    sql["stream_bridge"] = _with(
        _EVENTS, from_events, _BRIDGE, _BACKBONE, select=f"SELECT {fan_in} FROM backbone"
    )
    sql["stream_bridge_each"] = sql["stream_bounded_intake"] = sql["stream_bridge"]
    sql["stream_relay"] = _with(_EVENTS, from_events, _BRIDGE, _BACKBONE, _RELAY, select=fan_out)
    sql["stream_ack"] = _with(_LATE, select=history)
    sql["stream_ack_blocks"] = sql["stream_ack"]
    sql["stream_kinesis_ack"] = _with(
        _KINESIS,
        select="""
      , late AS (
        SELECT part, event_id, pos,
               CASE WHEN event_id % 4999 <> 4998 THEN (event_id * 7919) % 100003 END AS seq
        FROM shardrows),
      prefix AS (
        SELECT *, bool_and(seq IS NOT NULL) OVER w AS whole, max(seq) OVER w AS at_ack
        FROM late WINDOW w AS (PARTITION BY part ORDER BY event_id))
      SELECT part, at_ack, arg_max(pos, event_id) AS checkpoint FROM prefix WHERE whole GROUP BY ALL""",
    )
    sql["stream_breaker"] = _with(_OUTCOMES, select=trips)
    sql["stream_contracts"] = _with(_EVENTS, _PAYLOADS, select=sides)
    sql["stream_contracts_asof"] = sql["contract_asof"]
    sql["stream_offset_export"] = _with(
        _EVENTS,
        select="""
      , share AS (
        SELECT greatest(1, ((count(*) + 3) // 4) // count(DISTINCT topic)) AS n FROM msg)
      SELECT id, topic, CASE WHEN (row_number() OVER (PARTITION BY topic ORDER BY off) - 1) // n < 2
        THEN 'first' ELSE 'second' END AS run
      FROM msg, share""",
    )
    sql["stream_entry_report"] = _with(
        _EVENTS,
        select="""
      , sent AS (
        SELECT *, (props->>'$.k')::INT AS k, (event_id - min(event_id) OVER ()) * 3
          // (max(event_id) OVER () - min(event_id) OVER () + 1) AS step FROM msg)
      SELECT topic AS reg, step AS batch_no, off AS idx, id, (k % 10 <> 3)::INT AS ok,
        CASE WHEN k % 10 = 3 THEN 'Kinesis PutRecords entry failed: Throttled: stream-' || part || ' is busy' END AS error,
        CASE WHEN k % 10 <> 3 THEN 'shard-' || (k % 4) || ':' || user_id || lpad(k::VARCHAR, 4, '0') END AS message_id
      FROM sent""",
    )
    # Refused twice, opened, and let through by the probe of the last step.
    sql["stream_gate"] = _with(
        _EVENTS,
        select="""
      , steps AS (
        SELECT topic AS reg, off AS seq, (event_id - min(event_id) OVER ()) * 3
          // (max(event_id) OVER () - min(event_id) OVER () + 1) AS step FROM msg)
      SELECT 'delivered' AS event, reg, seq, CASE WHEN reg = 'app-error' THEN 2 ELSE step END AS step FROM steps
      UNION ALL SELECT 'opened', 'app-error', 2, 1 FROM steps WHERE reg = 'app-error' AND step < 2
        GROUP BY ALL HAVING count(DISTINCT step) = 2""",
    )
    sql["log_scan"] = _with(
        _EVENTS,
        select="""SELECT topic, part, off AS pos, id, md5(props) AS payload_md5, attributes FROM msg
        WHERE topic IN ('app-click', 'app-view') AND off >= 100
          AND NOT (topic = 'app-click' AND part = '0' AND off <= 500)""",
    )
    sql["stream_fair_share"] = _with(
        _EVENTS,
        select="""
      , share AS (
        SELECT greatest(1, ((count(*) + 3) // 4) // count(DISTINCT topic)) AS n FROM msg)
      SELECT id, topic, (row_number() OVER (PARTITION BY topic ORDER BY off) - 1) // n AS pull
      FROM msg, share""",
    )
    sql["stream_ack_cap"] = _with(_EVENTS, select=_CAPPED)
    return sql
