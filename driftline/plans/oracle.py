"""DuckDB SQL restating each registered query's expected result from the
source tables and the fixture rules (never from the engine's code)."""

# Shared fragments -----------------------------------------------------------

_ORDERS_TYPED = """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       'CUST-' || CAST(o_custkey AS VARCHAR) AS customer_id,
       o_totalprice AS total_price,
       o_orderstatus AS status,
       o_orderpriority AS priority,
       strftime(o_orderdate, '%Y-%m-%d') AS ordered_on,
       CASE WHEN o_orderkey >= 500 THEN CAST(o_orderkey % 30 AS DOUBLE) / CAST(100 AS DOUBLE) END AS discount_pct
FROM orders"""

_DISCOUNT = "CASE WHEN o_orderkey >= 500 THEN CAST(o_orderkey % 30 AS DOUBLE) / CAST(100 AS DOUBLE) END"

# Records per topic of every fixture frame.
_TOPIC_COUNTS = """
SELECT 'orders' AS topic, count(*) AS records, min(o_orderkey) AS min_offset, max(o_orderkey) AS max_offset FROM orders
UNION ALL SELECT 'orders.v2', count(*), min(o_orderkey), max(o_orderkey) FROM orders
UNION ALL SELECT 'customers', count(*), min(c_custkey), max(c_custkey) FROM customer
UNION ALL SELECT 'user.events', count(*), min(event_id), max(event_id) FROM events
UNION ALL SELECT 'line-items', count(DISTINCT l_orderkey), min(l_orderkey), max(l_orderkey) FROM lineitem
UNION ALL SELECT 'kinds', count(*), min(p_partkey), max(p_partkey) FROM part
UNION ALL SELECT 'cdc.customers', count(*), min(c_custkey), max(c_custkey) FROM customer
UNION ALL SELECT 'faulty', count(*), min(o_orderkey), max(o_orderkey) FROM orders
UNION ALL SELECT 'dated', count(*), min(event_id), max(event_id) FROM events
UNION ALL SELECT 'typed', count(*), min(p_partkey), max(p_partkey) FROM part
UNION ALL SELECT '__offsets', count(*), CAST(min(r_regionkey) AS BIGINT), CAST(max(r_regionkey) AS BIGINT) FROM region
UNION ALL SELECT 'a.b', count(*), CAST(min(n_nationkey) AS BIGINT), CAST(max(n_nationkey) AS BIGINT) FROM nation WHERE n_nationkey % 2 = 0
UNION ALL SELECT 'a-b', count(*), CAST(min(n_nationkey) AS BIGINT), CAST(max(n_nationkey) AS BIGINT) FROM nation WHERE n_nationkey % 2 = 1
"""

_FAULTY_GOOD = """('{"id":"' || CAST(o_orderkey AS VARCHAR) || '","customer":' || CAST(o_custkey AS VARCHAR)
  || ',"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}')"""

_DATED_TEXT_AT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

def _schema_sql(tables: list) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({i} AS INTEGER) AS position, '{name}' AS field, '{dtype}' AS type, "
        f"CAST({count} AS BIGINT) AS records FROM {rows}"
        for table, rows, columns in tables for i, (name, dtype, count) in enumerate(columns))


# Where a topic's offsets are cut into three micro-batches.
def _cut(key: str, table: str) -> str:
    last = f"(SELECT max({key}) FROM {table})"
    return (f"CASE WHEN {key} <= CAST(floor({last} * 0.3) AS BIGINT) THEN 0 "
            f"WHEN {key} <= CAST(floor({last} * 0.6) AS BIGINT) THEN 1 ELSE 2 END")


_ORDER_FIELDS = """(VALUES (0, 'id', 'string'), (1, 'customer_id', 'string'), (2, 'total_price', 'double'),
  (3, 'status', 'string'), (4, 'priority', 'string'), (5, 'ordered_on', 'string'), (6, 'discount_pct', 'double'))
  AS f(position, field, type)"""
# The first record of each column of the orders topic.
_ORDER_FIRSTS = "SELECT min(o_orderkey) AS k0, min(o_orderkey) FILTER (WHERE o_orderkey >= 500) AS k1 FROM orders"

_KIND_LOSS = """
SELECT column_name AS "column", CASE WHEN column_name = 'n' AND m = 1 THEN 'truncation' ELSE 'wrong_kind' END AS kind
FROM (SELECT p_partkey % 8 AS m FROM part WHERE p_partkey <> 0) p,
     (VALUES ('b'), ('n'), ('d'), ('s'), ('o'), ('a')) AS c(column_name)
WHERE m <> 5 AND CASE column_name WHEN 'b' THEN m <> 4 WHEN 'n' THEN m <> 0 WHEN 'd' THEN m > 1 WHEN 's' THEN m >= 6
      WHEN 'o' THEN m <> 6 ELSE m <> 7 END"""

ORACLE_SQL = {
    "ingest_orders_typed": _ORDERS_TYPED,

    "topic_pattern_scan": f"SELECT topic, records, min_offset, max_offset FROM ({_TOPIC_COUNTS}) t "
                          "WHERE topic NOT LIKE '\\_%' ESCAPE '\\'",

    "start_offset_slice": """
SELECT topic, CAST(p AS INTEGER) AS partition, count(*) AS records, min(k) AS min_offset FROM (
  SELECT 'orders' AS topic, o_orderkey % 3 AS p, o_orderkey AS k FROM orders
  UNION ALL SELECT 'customers', c_custkey % 3, c_custkey FROM customer) r
WHERE (topic = 'orders' AND ((p = 0 AND k >= 3000) OR p = 1))
   OR (topic = 'customers' AND ((p = 1 AND k >= 300) OR p = 2))
GROUP BY topic, p""",

    "utf8_json_admission": """
SELECT o_orderkey AS "offset",
       CASE WHEN o_orderkey % 20 < 8 THEN 'skipped' ELSE 'emitted' END AS disposition,
       CASE o_orderkey % 20 WHEN 0 THEN 'empty' WHEN 1 THEN 'empty' WHEN 2 THEN 'unparsable'
            WHEN 3 THEN 'non_object' WHEN 4 THEN 'non_object' WHEN 5 THEN 'non_object'
            WHEN 6 THEN 'non_object' WHEN 7 THEN 'unparsable' END AS reason,
       CASE WHEN o_orderkey % 20 = 9 THEN 'A' || chr(65533) || 'B'
            WHEN o_orderkey % 20 = 11 THEN NULL
            WHEN o_orderkey % 20 >= 8 THEN o_orderstatus END AS status
FROM orders""",

    "envelope_unwrap": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment,
       CAST(c_nationkey AS BIGINT) AS nation, 'false' AS __deleted
FROM customer WHERE c_custkey % 10 NOT IN (0, 5)""",

    "delete_filter": """
SELECT c_custkey AS "offset",
       CASE WHEN c_custkey % 10 IN (0, 5) THEN 'skipped' ELSE 'emitted' END AS disposition,
       CASE WHEN c_custkey % 10 IN (0, 5) THEN 'deleted' END AS reason
FROM customer""",

    "ingest_customers_nullable": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation,
       c_acctbal AS balance, c_mktsegment AS segment,
       CASE WHEN c_custkey % 10 < 3 THEN NULL ELSE '+62-' || CAST(8000000 + c_custkey AS VARCHAR) END AS phone
FROM customer""",

    "ingest_events_nested": """
SELECT CAST(event_id AS VARCHAR) AS id, user_id, event_type AS type, value,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k
FROM events""",

    "nested_field_not_evolved": """
SELECT CAST(event_id AS VARCHAR) AS id,
       '{"k":' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) || '}' AS props_json
FROM events""",

    "ingest_line_arrays": """
WITH f AS (SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS flags
           FROM lineitem GROUP BY l_orderkey)
SELECT CAST(l.l_orderkey AS VARCHAR) AS id,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey
            ORDER BY l.l_linenumber, l.l_quantity, l.l_extendedprice) - 1 AS INTEGER) AS idx,
       CAST(l.l_linenumber AS BIGINT) AS line, l.l_quantity AS qty, l.l_extendedprice AS price, f.flags
FROM lineitem l JOIN f ON l.l_orderkey = f.l_orderkey""",

    # (table, its rows, its columns in order: name, type, how many landed rows have a value)
    "infer_schema_frame": _schema_sql([
        ("a_b", "nation", [
            ('id', 'string', 'count(*)'),
            ('name', 'string', 'count(n_name)'),
            ('from_dot', 'bigint', 'count(*) FILTER (WHERE n_nationkey % 2 = 0)'),
            ('from_dash', 'bigint', 'count(*) FILTER (WHERE n_nationkey % 2 = 1)'),
        ]),
        ("cdc_customers", "customer WHERE c_custkey % 10 NOT IN (0, 5)", [
            ('id', 'string', 'count(*)'),
            ('name', 'string', 'count(c_name)'),
            ('segment', 'string', 'count(c_mktsegment)'),
            ('nation', 'bigint', 'count(c_nationkey)'),
            ('__deleted', 'string', 'count(*)'),
        ]),
        ("customers", "customer", [
            ('id', 'string', 'count(*)'),
            ('name', 'string', 'count(c_name)'),
            ('nation', 'bigint', 'count(c_nationkey)'),
            ('balance', 'double', 'count(c_acctbal)'),
            ('segment', 'string', 'count(c_mktsegment)'),
            ('phone', 'string', 'count(*) FILTER (WHERE c_custkey % 10 >= 3)'),
        ]),
        ("faulty", "orders WHERE o_orderkey % 20 >= 8", [
            ('id', 'string', 'count(*) FILTER (WHERE o_orderkey % 20 <> 11)'),
            ('customer', 'bigint', 'count(*) FILTER (WHERE o_orderkey % 20 NOT IN (9, 10, 11))'),
            ('status', 'string', 'count(*) FILTER (WHERE o_orderkey % 20 <> 11)'),
            ('priority', 'string', 'count(*) FILTER (WHERE o_orderkey % 20 NOT IN (9, 10, 11))'),
            ('payload', 'string', 'count(NULL)'),
        ]),
        ("kinds", "part", [
            ('id', 'string', 'count(*)'),
            ('b', 'boolean', 'count(*) FILTER (WHERE p_partkey = 0 OR p_partkey % 8 <> 5)'),
            ('n', 'bigint', 'count(*) FILTER (WHERE p_partkey = 0 OR p_partkey % 8 <> 5)'),
            ('d', 'double', 'count(*) FILTER (WHERE p_partkey = 0 OR p_partkey % 8 <> 5)'),
            ('s', 'string', 'count(*) FILTER (WHERE p_partkey = 0 OR p_partkey % 8 <> 5)'),
            ('o', 'struct<size:bigint,brand:string>', 'count(*) FILTER (WHERE p_partkey = 0 OR p_partkey % 8 = 6)'),
            ('a', 'array<bigint>', 'count(*) FILTER (WHERE p_partkey = 0 OR p_partkey % 8 <> 5)'),
        ]),
        ("line_items", "lineitem", [
            ('id', 'string', 'count(DISTINCT l_orderkey)'),
            ('items', 'array<struct<line:bigint,qty:double,price:double>>', 'count(DISTINCT l_orderkey)'),
            ('flags', 'array<string>', 'count(DISTINCT l_orderkey)'),
        ]),
        ("orders", "orders", [
            ('id', 'string', 'count(*)'),
            ('customer_id', 'string', 'count(o_custkey)'),
            ('total_price', 'double', 'count(o_totalprice)'),
            ('status', 'string', 'count(o_orderstatus)'),
            ('priority', 'string', 'count(o_orderpriority)'),
            ('ordered_on', 'string', 'count(o_orderdate)'),
            ('discount_pct', 'double', 'count(*) FILTER (WHERE o_orderkey >= 500)'),
        ]),
        ("orders_v2", "orders", [
            ('id', 'string', 'count(*)'),
            ('customer_id', 'string', 'count(o_custkey)'),
            ('total_price', 'double', 'count(o_totalprice)'),
            ('status', 'string', 'count(o_orderstatus)'),
            ('priority', 'string', 'count(o_orderpriority)'),
            ('ordered_on', 'string', 'count(o_orderdate)'),
            ('discount_pct', 'string', 'count(*) FILTER (WHERE o_orderkey >= 500 AND o_orderkey % 2 = 1)'),
        ]),
        ("user_events", "events", [
            ('id', 'string', 'count(*)'),
            ('user_id', 'bigint', 'count(user_id)'),
            ('type', 'string', 'count(event_type)'),
            ('value', 'double', 'count(value)'),
            ('props', 'struct<k:bigint>', 'count(*)'),
        ]),
    ]),

    "null_first_pins_string": """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderkey < 500 OR o_orderkey % 2 = 0 THEN NULL
            ELSE '0.' || lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') END AS discount_pct
FROM orders""",

    "value_first_pins_double": f"SELECT CAST(o_orderkey AS VARCHAR) AS id, {_DISCOUNT} AS discount_pct FROM orders",

    "evolve_add_column": f"SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total_price, "
                         f"{_DISCOUNT} AS discount_pct FROM orders",

    "schema_change_log": f"""
SELECT CAST(CASE WHEN position < 6 THEN 0 ELSE 1 END AS BIGINT) AS batch_id, 'orders' AS table_name, position, field, type,
       CAST(CASE WHEN position < 6 THEN k0 ELSE k1 END % 3 AS INTEGER) AS first_partition,
       CASE WHEN position < 6 THEN k0 ELSE k1 END AS first_offset
FROM {_ORDER_FIELDS}, ({_ORDER_FIRSTS}) k""",

    "stream_schema_changes": f"""
SELECT CAST((SELECT {_cut('o_orderkey', 'orders')} FROM orders WHERE o_orderkey = CASE WHEN position < 6 THEN k0 ELSE k1 END)
            AS BIGINT) AS batch_id, 'orders' AS table_name, position, field, type,
       CASE WHEN position < 6 THEN k0 ELSE k1 END AS first_offset
FROM {_ORDER_FIELDS}, ({_ORDER_FIRSTS}) k""",

    "coercion_loss": f"""
SELECT 'kinds' AS table_name, "column", kind, count(*) AS records FROM ({_KIND_LOSS}) x GROUP BY 2, 3
UNION ALL
SELECT 'big_numbers', 'n', 'overflow', count(*) FROM part WHERE p_partkey <> 0 AND p_partkey % 3 <> 2""",

    "infer_nested_empty": """
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS c FROM customer""",

    "awkward_names": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS dotted, c_custkey AS spaced, c_mktsegment AS ticked,
       CAST(c_nationkey AS BIGINT) AS accented, c_acctbal AS nested_dotted, c_custkey AS nested_spaced FROM customer""",

    "documents_roundtrip": """
SELECT 'documents' AS table_name, CAST(doc_id AS VARCHAR) AS id, text, lang AS tag FROM documents
UNION ALL SELECT 'conversations', CAST(conv_id * 10000 + turn AS VARCHAR), text, role FROM conversations""",

    "route_numeric_topics": """
SELECT (['01', '1', '2', '3', '4', '5'])[CAST(c_custkey % 6 AS INTEGER) + 1] AS table_name,
       CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer""",

    "ingest_beside_map_table": """
SELECT 'orders' AS topic, o_orderkey AS "offset", 'landed' AS outcome FROM orders
UNION ALL SELECT 'customers', c_custkey, 'unsupported_table' FROM customer""",

    "reserved_field_name": """
SELECT c_custkey AS "offset", CASE WHEN c_custkey % 2 = 1 THEN 'reserved_field' ELSE 'landed' END AS outcome FROM customer""",

    "append_plain_session": f"SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total_price, "
                            f"{_DISCOUNT} AS discount_pct FROM orders",

    "multi_table_sink_values": """
SELECT 'a_b' AS table_name, CAST(n_nationkey AS VARCHAR) AS id, n_name AS text, CAST(n_regionkey AS DOUBLE) AS number FROM nation
UNION ALL SELECT 'cdc_customers', CAST(c_custkey AS VARCHAR), c_name || '/' || c_mktsegment || '/false', CAST(c_nationkey AS DOUBLE)
  FROM customer WHERE c_custkey % 10 NOT IN (0, 5)
UNION ALL SELECT 'customers', CAST(c_custkey AS VARCHAR), c_name || '/' || c_mktsegment || '/' ||
  CASE WHEN c_custkey % 10 < 3 THEN '-' ELSE '+62-' || CAST(8000000 + c_custkey AS VARCHAR) END, c_acctbal FROM customer
UNION ALL SELECT 'dated', CAST(event_id AS VARCHAR),
  CASE WHEN event_id % 6 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) WHEN event_id % 6 < 4 THEN '0' END,
  CAST(CASE WHEN event_id % 6 = 0 THEN CAST(ts AS DATE) - DATE '1970-01-01' WHEN event_id % 6 < 4 THEN 0 END AS DOUBLE) FROM events
UNION ALL SELECT 'faulty', CASE WHEN o_orderkey % 20 <> 11 THEN CAST(o_orderkey AS VARCHAR) END,
  CASE WHEN o_orderkey % 20 = 11 THEN '-' WHEN o_orderkey % 20 = 9 THEN 'A' || chr(65533) || 'B' ELSE o_orderstatus END
    || '/' || CASE WHEN o_orderkey % 20 IN (9, 10, 11) THEN '-' ELSE o_orderpriority END,
  CAST(CASE WHEN o_orderkey % 20 NOT IN (9, 10, 11) THEN o_custkey END AS DOUBLE) FROM orders WHERE o_orderkey % 20 >= 8
UNION ALL SELECT 'kinds', CAST(p_partkey AS VARCHAR),
  CASE WHEN p_partkey = 0 THEN p_name WHEN p_partkey % 8 = 0 THEN CAST(p_size AS VARCHAR)
       WHEN p_partkey % 8 = 1 THEN '1.5' WHEN p_partkey % 8 = 2 THEN '12' WHEN p_partkey % 8 = 3 THEN 'x'
       WHEN p_partkey % 8 = 4 THEN 'true' WHEN p_partkey % 8 = 5 THEN NULL ELSE '' END,
  CAST(CASE WHEN p_partkey = 0 THEN p_retailprice WHEN p_partkey % 8 = 0 THEN p_size
       WHEN p_partkey % 8 = 1 THEN 1.5 WHEN p_partkey % 8 = 5 THEN NULL ELSE 0 END AS DOUBLE) FROM part
UNION ALL SELECT 'line_items', CAST(l_orderkey AS VARCHAR), string_agg(l_returnflag, ',' ORDER BY l_returnflag),
  CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY l_orderkey
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), o_orderstatus || '/' || o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m-%d'),
  o_totalprice FROM orders
UNION ALL SELECT 'orders_v2', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey >= 500 AND o_orderkey % 2 = 1
  THEN '0.' || lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') END, o_totalprice FROM orders
UNION ALL SELECT 'user_events', CAST(event_id AS VARCHAR), event_type || '/' || json_extract_string(props, '$.k'), value FROM events""",

    "coerce_wrong_kind": """
SELECT CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_partkey = 0 THEN TRUE WHEN p_partkey % 8 = 5 THEN NULL
       WHEN p_partkey % 8 = 4 THEN TRUE ELSE FALSE END AS b,
  CAST(CASE WHEN p_partkey = 0 OR p_partkey % 8 = 0 THEN p_size WHEN p_partkey % 8 = 1 THEN 1
       WHEN p_partkey % 8 = 5 THEN NULL ELSE 0 END AS BIGINT) AS n,
  CAST(CASE WHEN p_partkey = 0 THEN p_retailprice WHEN p_partkey % 8 = 0 THEN p_size
       WHEN p_partkey % 8 = 1 THEN 1.5 WHEN p_partkey % 8 = 5 THEN NULL ELSE 0 END AS DOUBLE) AS d,
  CASE WHEN p_partkey = 0 THEN p_name WHEN p_partkey % 8 = 0 THEN CAST(p_size AS VARCHAR)
       WHEN p_partkey % 8 = 1 THEN '1.5' WHEN p_partkey % 8 = 2 THEN '12' WHEN p_partkey % 8 = 3 THEN 'x'
       WHEN p_partkey % 8 = 4 THEN 'true' WHEN p_partkey % 8 = 5 THEN NULL ELSE '' END AS s,
  CAST(CASE WHEN p_partkey = 0 OR p_partkey % 8 = 6 THEN p_size END AS BIGINT) AS o_size,
  CASE WHEN p_partkey = 0 THEN p_brand END AS o_brand,
  NOT (p_partkey = 0 OR p_partkey % 8 = 6) AS o_null,
  CASE WHEN p_partkey = 0 THEN CAST(p_size AS VARCHAR) || ',' || CAST(p_size + 1 AS VARCHAR)
       WHEN p_partkey % 8 = 5 THEN NULL
       WHEN p_partkey % 8 IN (6, 7) THEN CAST(p_size AS VARCHAR) ELSE '' END AS a_text
FROM part""",

    "coerce_date_timestamp": """
SELECT event_id AS "offset",
       CASE WHEN event_id % 6 IN (2, 3) THEN 'error' ELSE 'emitted' END AS disposition,
       CASE WHEN event_id % 6 IN (0, 1) THEN strftime(ts, '%Y-%m-%d') END AS day,
       CASE WHEN event_id % 6 IN (0, 1) THEN epoch_us(ts) // 1000 END AS at_ms
FROM events""",

    "coerce_existing_types": """
SELECT p_partkey AS "offset",
       CASE WHEN p_partkey % 4 = 2 THEN 'error' ELSE 'emitted' END AS disposition,
       CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN 1 END AS INTEGER) AS i,
       CAST(CAST(CASE p_partkey % 4 WHEN 0 THEN p_retailprice WHEN 1 THEN 0 END AS FLOAT) AS DOUBLE) AS f,
       CASE p_partkey % 4 WHEN 0 THEN hex(p_brand) WHEN 1 THEN '37' END AS bin_hex,
       CAST(CAST(CASE p_partkey % 4 WHEN 0 THEN CAST(p_retailprice AS DECIMAL(10, 2)) WHEN 1 THEN 12.5 END
            AS DECIMAL(10, 2)) AS VARCHAR) AS dec_text,
       CASE WHEN p_partkey % 4 = 0 THEN p_type END AS note
FROM part""",

    "route_topics_to_tables": f"SELECT topic, replace(replace(topic, '.', '_'), '-', '_') AS table_name, records "
                              f"FROM ({_TOPIC_COUNTS}) t",

    "multi_table_sink_counts": """
SELECT 'a_b' AS table_name, count(*) AS "rows" FROM nation
UNION ALL SELECT 'cdc_customers', count(*) FROM customer WHERE c_custkey % 10 NOT IN (0, 5)
UNION ALL SELECT 'customers', count(*) FROM customer
UNION ALL SELECT 'dated', count(*) FROM events
UNION ALL SELECT 'faulty', count(*) FROM orders WHERE o_orderkey % 20 >= 8
UNION ALL SELECT 'kinds', count(*) FROM part
UNION ALL SELECT 'line_items', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'orders_v2', count(*) FROM orders
UNION ALL SELECT 'user_events', count(*) FROM events""",

    "list_tables": """
SELECT 'a_b' AS table_name, count(*) AS "rows" FROM nation
UNION ALL SELECT 'cdc_customers', count(*) FROM customer WHERE c_custkey % 10 NOT IN (0, 5)
UNION ALL SELECT 'customers', count(*) FROM customer
UNION ALL SELECT 'kinds', count(*) FROM part""",

    "append_change_log": """
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(v AS BIGINT) AS version, c_acctbal + v AS balance
FROM customer, unnest([1, 2, 3]) AS u(v)""",

    "replay_idempotent": "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total_price FROM orders",

    "read_limit": "SELECT least(count(*), 10) AS \"rows\", least(count(*), 10) AS ids FROM orders",

    "restart_reload_schema": """
SELECT position, field, type, (SELECT count(*) FROM orders) AS table_rows FROM (VALUES
 (0, 'status', 'string'), (1, 'id', 'string'), (2, 'note', 'string'), (3, 'customer_id', 'string'),
 (4, 'total_price', 'double'), (5, 'priority', 'string'), (6, 'ordered_on', 'string'),
 (7, 'discount_pct', 'double')) AS t(position, field, type)""",

    "stream_equals_batch": f"SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total_price, "
                           f"{_DISCOUNT} AS discount_pct FROM orders",

    "stream_batch_stats": f"""
SELECT CAST(b AS BIGINT) AS batch_id, count(*) AS received, count(*) AS emitted,
       CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS errors
FROM (SELECT {_cut('o_orderkey', 'orders')} AS b FROM orders) o
GROUP BY b""",

    "ingest_counters": """
SELECT 'faulty' AS topic, count(*) AS received, count(*) FILTER (WHERE o_orderkey % 20 >= 8) AS emitted,
       count(*) FILTER (WHERE o_orderkey % 20 < 8) AS skipped, CAST(0 AS BIGINT) AS errors FROM orders
UNION ALL SELECT 'cdc.customers', count(*), count(*) FILTER (WHERE c_custkey % 10 NOT IN (0, 5)),
       count(*) FILTER (WHERE c_custkey % 10 IN (0, 5)), 0 FROM customer
UNION ALL SELECT 'dated', count(*), count(*) FILTER (WHERE event_id % 6 NOT IN (2, 3)), 0,
       count(*) FILTER (WHERE event_id % 6 IN (2, 3)) FROM events
UNION ALL SELECT 'orders', count(*), count(*), 0, 0 FROM orders""",

    "reject_frame": f"""
SELECT 'faulty' AS topic, o_orderkey AS "offset", 'skipped' AS disposition,
  CASE o_orderkey % 20 WHEN 0 THEN 'empty' WHEN 1 THEN 'empty' WHEN 2 THEN 'unparsable' WHEN 7 THEN 'unparsable'
       ELSE 'non_object' END AS reason,
  CAST(NULL AS VARCHAR) AS detail,
  CASE WHEN o_orderkey % 20 IN (2, 7) THEN '7B' END AS first_byte,
  CASE o_orderkey % 20 WHEN 0 THEN NULL WHEN 1 THEN ''
       WHEN 2 THEN substr({_FAULTY_GOOD}, 1, 20)
       WHEN 3 THEN '[1]' WHEN 4 THEN '5' WHEN 5 THEN 'null' WHEN 6 THEN '   '
       WHEN 7 THEN '{{''id'':''' || CAST(o_orderkey AS VARCHAR) || '''}}' END AS preview
FROM orders WHERE o_orderkey % 20 < 8
UNION ALL
SELECT 'dated', event_id, 'error', 'convert_error',
  CASE WHEN event_id % 6 = 2 THEN 'at' ELSE 'day' END, NULL,
  '{{"id":"' || CAST(event_id AS VARCHAR) || '","day":"'
    || CASE WHEN event_id % 6 = 2 THEN strftime(ts, '%Y-%m-%d') ELSE '2024-1-1' END
    || '","at":"' || {_DATED_TEXT_AT} || CASE WHEN event_id % 6 = 2 THEN '+00:00' ELSE 'Z' END || '"}}'
FROM events WHERE event_id % 6 IN (2, 3)""",

    "first_record_sample": f"""
SELECT 'faulty' AS topic, 2 AS partition, CAST(2 AS BIGINT) AS "offset", '7B' AS first_byte,
       substr({_FAULTY_GOOD}, 1, 20) AS preview FROM orders WHERE o_orderkey = 2
UNION ALL SELECT 'cdc.customers', 0, 0, '7B',
       '{{"id":"0","name":"' || c_name || '","segment":"' || c_mktsegment || '","nation":'
       || CAST(c_nationkey AS VARCHAR) || ',"__deleted":"true"}}' FROM customer WHERE c_custkey = 0
UNION ALL SELECT 'dated', 0, 0, '7B',
       '{{"id":"0","day":' || CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS VARCHAR) || ',"at":'
       || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '}}' FROM events WHERE event_id = 0
UNION ALL SELECT 'a.b', 0, 0, '7B',
       '{{"id":"0","name":"' || n_name || '","from_dot":' || CAST(n_regionkey AS VARCHAR) || '}}'
       FROM nation WHERE n_nationkey = 0
UNION ALL SELECT 'a-b', 1, 1, '7B',
       '{{"id":"1","name":"' || n_name || '","from_dash":' || CAST(n_regionkey AS VARCHAR) || '}}'
       FROM nation WHERE n_nationkey = 1
UNION ALL SELECT '__offsets', 0, 0, '7B', '{{"id":"0","name":"' || r_name || '"}}' FROM region WHERE r_regionkey = 0""",

    "many_small_topics": """
SELECT 'shop_' || CAST(i AS VARCHAR) AS table_name, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance,
       CASE WHEN i % 3 = 1 THEN CAST(c_nationkey AS BIGINT) END AS nation, CASE WHEN i % 3 = 2 THEN c_mktsegment END AS segment
FROM (SELECT *, c_custkey % 240 AS i FROM customer) c""",

    "topic_joins_running_query": """
SELECT 'customers' AS table_name, true AS at_start, CAST(c_custkey AS VARCHAR) AS id FROM customer
UNION ALL SELECT 'orders', false, CAST(o_orderkey AS VARCHAR) FROM orders""",

    "resume_from_ledger": """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total_price, p.n AS ranges
FROM orders, (SELECT sum(CASE WHEN gap THEN 1 ELSE 0 END)::BIGINT AS n FROM (
  SELECT coalesce(o_orderkey - lag(o_orderkey) OVER (ORDER BY o_orderkey) <> 1, true) AS gap FROM orders) g) p""",

    "poison_record_isolated": """
SELECT c_custkey AS "offset", CASE WHEN c_custkey % 5000 = 77 THEN 'error/write_error/EXCEED_LIMIT_LENGTH' ELSE 'landed' END AS outcome,
       CASE WHEN c_custkey % 5000 <> 77 THEN right(c_name, 8) END AS code
FROM customer""",

    "wide_topic_overflow": """
SELECT CAST(c_custkey AS VARCHAR) AS id, row_number() OVER (ORDER BY c_custkey) <= 99 AS has_column,
       'k' || CAST(c_custkey AS VARCHAR) AS field, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation
FROM customer""",

    "deep_nesting_landed": """
SELECT depth, id, CAST(length(inner_text) AS INTEGER) AS chars, md5(inner_text) AS digest FROM (
  SELECT depth, id, CASE WHEN depth <= 16 THEN id
    ELSE repeat('{"a":', CAST(depth - 16 AS BIGINT)) || '"' || id || '"' || repeat('}', CAST(depth - 16 AS BIGINT)) END AS inner_text
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, ([1, 10, 100, 450, 900])[c_custkey % 5 + 1] AS depth FROM customer) c) d""",

    "hollow_objects_long_text": """
SELECT id, CAST(length(t) AS INTEGER) AS chars, md5(t) AS digest, 'id,b' AS columns FROM (
  SELECT CAST(doc_id AS VARCHAR) AS id, repeat(coalesce(text, ''), CASE WHEN doc_id % 5000 = 0
    THEN CAST(ceil(10000000 / greatest(length(coalesce(text, '')), 1)) AS BIGINT) ELSE 1 END) AS t FROM documents) d""",

    "normalize_locations": """
SELECT page_id, loc AS location,
       CASE WHEN page_id % 3 = 0 THEN 'oss://lake-' || CAST(page_id % 7 AS VARCHAR) || '/' || path ELSE loc END
         AS normalized
FROM (SELECT page_id, path,
        CASE page_id % 3
          WHEN 0 THEN 'oss://lake-' || CAST(page_id % 7 AS VARCHAR) || '.ap-southeast-5.oss-dls.aliyuncs.com/' || path
          WHEN 1 THEN 'oss://lake-' || CAST(page_id % 7 AS VARCHAR) || '/' || path
          ELSE 'oss://LAKE-' || CAST(page_id % 7 AS VARCHAR) || '.ap-southeast-5.oss-dls.aliyuncs.com/' || path
        END AS loc
      FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages) p) q""",
}

ORACLE_SQL["stream_totals"] = ORACLE_SQL["ingest_counters"]
ORACLE_SQL["stream_first_samples"] = f"SELECT * FROM ({ORACLE_SQL['first_record_sample']}) s WHERE topic <> '__offsets'"
ORACLE_SQL["stream_rejects"] = ORACLE_SQL["reject_frame"]
