"""Independent SQL (DuckDB dialect) for every query in ``catalog``.

Each statement restates the operator's semantics in plain SQL over the
driver's tables; fixture CTEs mirror ``fixtures``.
"""

from __future__ import annotations

NEW_KEY = 1_000_000_000

CUSTOMER_CHANGES = f"""
ch AS (
  SELECT CASE c_custkey % 10 WHEN 2 THEN c_custkey + {NEW_KEY} WHEN 4 THEN c_custkey + {2 * NEW_KEY}
                             WHEN 5 THEN c_custkey + {3 * NEW_KEY} WHEN 6 THEN c_custkey + {4 * NEW_KEY}
                             WHEN 8 THEN CAST(NULL AS BIGINT) ELSE c_custkey END AS c_custkey,
         CASE c_custkey % 10 WHEN 1 THEN c_name || '#u' WHEN 3 THEN c_name || '#i' ELSE c_name END AS c_name,
         c_nationkey, c_acctbal,
         CASE c_custkey % 10 WHEN 1 THEN 'UPDATED' WHEN 7 THEN 'NULLFLAG' ELSE c_mktsegment END AS c_mktsegment,
         CASE WHEN c_custkey % 10 IN (0, 5) THEN 'D' WHEN c_custkey % 10 IN (1, 4) THEN 'U'
              WHEN c_custkey % 10 IN (2, 3, 8) THEN 'I' ELSE CAST(NULL AS VARCHAR) END AS delta_flg
  FROM customer WHERE c_custkey % 10 <> 9)"""


def _merge_sql(insert_filter: str) -> str:
    return f"""
WITH {CUSTOMER_CHANGES},
hit AS (SELECT * FROM ch WHERE delta_flg IN ('U', 'D') AND c_custkey IS NOT NULL)
SELECT t.c_custkey,
       CASE WHEN h.delta_flg = 'U' THEN h.c_name ELSE t.c_name END AS c_name,
       CASE WHEN h.delta_flg = 'U' THEN h.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       CASE WHEN h.delta_flg = 'U' THEN h.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN h.delta_flg = 'U' THEN h.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM customer t LEFT JOIN hit h ON t.c_custkey = h.c_custkey
WHERE h.delta_flg IS NULL OR h.delta_flg = 'U'
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM ch
WHERE {insert_filter} NOT EXISTS (SELECT 1 FROM customer t WHERE t.c_custkey = ch.c_custkey)
"""


ORDERS_OLD = """
old AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 7 IN (3, 4) THEN CAST(NULL AS VARCHAR) ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""

ORDERS_NEW = f"""
new AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE o_orderkey % 7 WHEN 1 THEN o_orderpriority || '*' WHEN 3 THEN CAST(NULL AS VARCHAR)
              ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL
  SELECT o_orderkey + {NEW_KEY}, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 7 = 2)"""

LATEST_EVENTS = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

SQL: dict[str, str] = {
    "latest_per_key": LATEST_EVENTS,
    "apply_changes": f"SELECT * FROM ({LATEST_EVENTS}) WHERE event_type <> 'error'",
    "merge_flagged_incremental": _merge_sql("delta_flg = 'I' AND"),
    "merge_flagged_initial": _merge_sql(""),
    "snapshot_diff": f"""
WITH {ORDERS_OLD}, {ORDERS_NEW}
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_custkey ELSE n.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderdate ELSE n.o_orderdate END AS o_orderdate,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderpriority ELSE n.o_orderpriority END AS o_orderpriority,
       CASE WHEN o.o_orderkey IS NULL THEN 'I' WHEN n.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS _change
FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
   OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
   OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderdate IS DISTINCT FROM n.o_orderdate
   OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority""",
    "apply_snapshot": f"WITH {ORDERS_NEW} SELECT * FROM new",
    "apply_snapshot_log": f"WITH {ORDERS_NEW} SELECT * FROM new",
    "apply_snapshot_digests": f"WITH {ORDERS_OLD} SELECT * FROM old WHERE o_orderkey % 11 <> 0",
    "reconcile": f"""
WITH {ORDERS_OLD}, {ORDERS_NEW}
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN o.o_orderkey IS NULL THEN 'missing' WHEN n.o_orderkey IS NULL THEN 'extra'
            WHEN o.o_custkey IS NOT DISTINCT FROM n.o_custkey AND o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus
             AND o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice AND o.o_orderdate IS NOT DISTINCT FROM n.o_orderdate
             AND o.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority THEN 'equal'
            ELSE 'different' END AS status
FROM new n FULL OUTER JOIN old o ON o.o_orderkey = n.o_orderkey""",
    "reconcile_counts": f"""
WITH {ORDERS_OLD}, {ORDERS_NEW},
r AS (
SELECT CASE WHEN o.o_orderkey IS NULL THEN 'missing' WHEN n.o_orderkey IS NULL THEN 'extra'
            WHEN o.o_custkey IS NOT DISTINCT FROM n.o_custkey AND o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus
             AND o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice AND o.o_orderdate IS NOT DISTINCT FROM n.o_orderdate
             AND o.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority THEN 'equal'
            ELSE 'different' END AS status
FROM new n FULL OUTER JOIN old o ON o.o_orderkey = n.o_orderkey)
SELECT status, count(*) AS n FROM r GROUP BY status""",
}

DML_COND = "nullif(c_mktsegment, 'BUILDING') <> 'AUTOMOBILE'"

SQL.update({
    "cast_to_schema": """
SELECT try_cast(CASE event_id % 3 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN 'abc' ELSE '' END AS BIGINT)
         AS event_id,
       ts, value
FROM events""",
    "cast_by_type": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(trunc(l_quantity) AS BIGINT) AS l_quantity,
       CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice,
       CAST(trunc(l_discount) AS BIGINT) AS l_discount,
       CAST(trunc(l_tax) AS BIGINT) AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem""",
    "rescue_unexpected": """
SELECT event_id, ts, user_id, CAST(NULL AS INTEGER) AS event_type, value,
       CAST(json_object('event_type', event_type, 'props', props) AS VARCHAR) AS _rescued_data
FROM events""",
    "filter_ilike": "SELECT doc_id, lang, n_chars FROM documents WHERE text ILIKE '%licen%' OR text ILIKE 'the%'",
    "filter_not_ilike": "SELECT doc_id, lang, n_chars FROM documents WHERE NOT (text ILIKE '%the%')",
    "replace_chain": """
SELECT doc_id, replace(replace(replace(replace(text, 'a', '4'), '4', 'four'), 'e', '3'), 'the', 'THE') AS text
FROM documents""",
    "select_except": f"""
SELECT o_orderkey + {NEW_KEY} AS o_orderkey, o_custkey, o_orderstatus AS status, o_orderdate, o_orderpriority,
       'loader' AS record_insert_id
FROM orders""",
    "filter_predicate": """
SELECT * FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '' AND NOT (o_totalprice > 200000)""",
    "filter_key_text": "SELECT * FROM orders WHERE o_orderkey = CAST('42' AS BIGINT)",
    "union_all": "SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
    "sort_limit": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    "path_stem": """
SELECT page_id,
       split_part(regexp_extract(url, '[^/]*$'), '.', 1) AS stem,
       split_part(url, '/', 3) AS host,
       split_part(split_part(url, '/', 3), '.', 1) AS host_head,
       CAST(len(string_split(url, '/')) AS INTEGER) AS n_parts
FROM pages""",
    "split_text": """
SELECT page_id,
       array_to_string(list_filter(string_split(regexp_replace(lower(url), '[/?#&=.:]', ' ', 'g'), ' '),
                                   lambda x: x <> ''), ',') AS words,
       CASE WHEN strpos(url, '://') > 0 THEN split_part(url, '://', -1) ELSE url END AS after_scheme,
       replace(replace(replace(url, 'https://', ''), 'http://', ''), '.example', '') AS stripped
FROM pages""",
    "parse_ts": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS txt,
       strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed
FROM orders""",
    "update_where": f"""
SELECT c_custkey,
       CASE WHEN coalesce({DML_COND}, false) THEN c_name || '*' ELSE c_name END AS c_name,
       c_nationkey,
       CASE WHEN coalesce({DML_COND}, false) THEN 0.0 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer""",
    "delete_where": f"SELECT * FROM customer WHERE NOT coalesce({DML_COND}, false)",
    "replace_where": """
SELECT * FROM customer WHERE NOT coalesce(c_nationkey = 3, false)
UNION ALL
SELECT c_custkey, c_name || '#r' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 3""",
    "fk_violations": """
SELECT * FROM orders o
WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey = o.o_custkey)""",
    "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "not_null_violations": """
WITH d AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS column_name, count(*) FILTER (WHERE doc_id IS NULL) AS null_rows FROM d
UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM d
UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM d
UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM d""",
    "schema_gate": "SELECT * FROM orders",
    "check_constraints": """
SELECT 'o_custkey_not_null' AS "constraint", 'not_null' AS kind, count(*) FILTER (WHERE o_custkey IS NULL) AS violations
FROM orders
UNION ALL SELECT 'o_orderdate_not_null', 'not_null', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'o_orderpriority_not_null', 'not_null', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders
UNION ALL SELECT 'o_orderkey_pk', 'primary_key', CAST(coalesce(sum(n), 0) AS BIGINT)
  FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL)
UNION ALL SELECT 'orders_customer_fk1', 'foreign_key', count(*) FROM orders o
  WHERE o.o_custkey IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey = o.o_custkey)""",
    "expect_report": """
SELECT 'qty_positive' AS rule, count(*) FILTER (WHERE NOT coalesce(l_quantity > 0, false)) AS failed_rows FROM lineitem
UNION ALL SELECT 'discount_small', count(*) FILTER (WHERE NOT coalesce(l_discount <= 0.05, false)) FROM lineitem
UNION ALL SELECT 'flag_known', count(*) FILTER (WHERE NOT coalesce(l_returnflag IN ('A', 'N'), false)) FROM lineitem
UNION ALL SELECT 'tax_below_price', count(*) FILTER (WHERE NOT coalesce(l_tax < l_extendedprice, false)) FROM lineitem""",
    "expect_all_or_fail": "SELECT * FROM lineitem",
    "row_count": "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type",
    "distinct_flags": """
SELECT string_agg(event_type, ', ' ORDER BY event_type) AS flags
FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)""",
    "max_key": "SELECT coalesce(max(o_orderkey), 0) AS max_key FROM orders",
    "distinct_profile": """
SELECT count(DISTINCT o_custkey) AS o_custkey_distinct, count(DISTINCT o_orderstatus) AS o_orderstatus_distinct,
       count(DISTINCT o_orderdate) AS o_orderdate_distinct
FROM orders""",
    "group_collect": """
SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_nationkey) AS "values" FROM nation GROUP BY n_regionkey""",
    "group_positions": """
SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos,
       o_orderkey
FROM orders""",
    "ntile_split": """
SELECT o_orderkey, o_custkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) AS INTEGER) AS tile FROM orders""",
    "ntile_split_written": """
SELECT o_orderkey, o_custkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) AS INTEGER) AS tile FROM orders""",
    "group_positions_written": """
SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos, o_orderkey
FROM orders""",
    "assign_keys": """
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey)
         AS o_orderkey,
       o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders""",
    "change_batch_u": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       date_trunc('second', o_orderdate) + INTERVAL 10 SECOND AS o_orderdate,
       'changed' AS o_orderpriority, 'U' AS delta_flg
FROM (SELECT *, ntile(5) OVER (ORDER BY o_orderkey) AS t FROM orders) WHERE t = 2""",
    "change_batch_d": """
SELECT event_id, date_trunc('second', ts) + INTERVAL 10 SECOND AS ts, user_id, event_type, value, props,
       'D' AS delta_flg
FROM (SELECT *, ntile(5) OVER (ORDER BY event_id) AS t FROM events) WHERE t = 3""",
    "change_batch_i": """
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY c_custkey) AS c_custkey,
       c_name, c_nationkey, c_acctbal, c_mktsegment, 'I' AS delta_flg
FROM (SELECT *, ntile(4) OVER (ORDER BY c_custkey) AS t FROM customer) WHERE t = 1""",
})

FOLD_NEW = """
SELECT event_id, ts, user_id, event_type, value, props, CASE WHEN event_id % 3 = 0 THEN 'n' || event_id END AS note
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'"""

RANKED_TIES = """
SELECT o_orderstatus, min(r) AS first, max(r) AS last, count(DISTINCT r) AS ranks
FROM (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus NULLS FIRST) AS r FROM orders) GROUP BY 1"""

FILE_RANGES = """
SELECT o_orderkey AS key, o_orderpriority AS name FROM orders
UNION ALL SELECT 1, 'several files' UNION ALL SELECT 0, 'overlaps'"""

DAILY = """
SELECT 'day=' || strftime(ts, '%Y-%m-%d') AS file_name, count(*) AS file_number_of_rows
FROM events GROUP BY 1"""

ODD_DAY = "CAST(right(file_name, 2) AS INTEGER) % 2 = 1"

SQL.update({
    "parse_delimited": "SELECT * FROM customer",
    "load_delimited": "SELECT * FROM customer",
    "scan_text_records": "SELECT c_custkey, c_name FROM customer",
    "stream_append": "SELECT * FROM events",
    "stream_apply_changes": SQL["apply_changes"],
    "stream_rescue": """
SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN CAST(floor(v) AS INTEGER) WHEN v = trunc(v) THEN CAST(v AS INTEGER) END AS value,
       CASE WHEN event_id % 3 = 1 THEN '{"event_type":"' || event_type || '"}'
            WHEN event_id % 3 = 2 AND v <> trunc(v) THEN '{"value":"' || CAST(v AS VARCHAR) || '"}' END AS rescued
FROM (SELECT event_id, event_type, CAST(round(value, 2) AS DECIMAL(18, 2)) AS v FROM events)""",
    "compacted_state": SQL["apply_changes"],
    "stream_apply_flagged": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderkey % 5 = 1 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderkey % 5 = 1 THEN o_orderpriority || '+' ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 5 <> 2""",
    "ledger_register": f"""
SELECT file_name, TIMESTAMP '2024-02-01 00:00:00' AS file_arrival_timestamp, file_number_of_rows,
       CAST(NULL AS TIMESTAMP) AS file_processed_timestamp, false AS file_loaded
FROM ({DAILY})""",
    "ledger_mark": f"""
SELECT file_name, TIMESTAMP '2024-02-01 00:00:00' AS file_arrival_timestamp, file_number_of_rows,
       CASE WHEN {ODD_DAY} THEN TIMESTAMP '2024-02-02 00:00:00' END AS file_processed_timestamp,
       {ODD_DAY} AS file_loaded
FROM ({DAILY})""",
    "ledger_pending": f"SELECT file_name, file_number_of_rows FROM ({DAILY}) WHERE NOT ({ODD_DAY})",
    "apply_pending": f"""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN c_name || '#2' ELSE c_name END AS c_name,
       c_nationkey, c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 5 <> 2
UNION ALL
SELECT c_custkey + {NEW_KEY}, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 5 = 3""",
    "stage_drop": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice, o_orderdate,
       o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 'U' ELSE 'I' END AS delta_flg
FROM orders""",
    "cluster_write": "SELECT * FROM lineitem",
    "compact": "SELECT * FROM orders",
    "create_table_as": "SELECT * FROM customer",
    "insert_positional": "SELECT * FROM customer",
    "truncate_load": "SELECT * REPLACE (c_name || '!' AS c_name) FROM customer",
    "append_select": "SELECT * FROM orders",
    "parse_delimited_rescue": """
SELECT CASE WHEN c_custkey % 7 = 0 THEN 'category ' ELSE '' END || c_name AS name, CAST(c_custkey AS VARCHAR) AS key,
       CASE WHEN c_custkey % 22 = 0 THEN 'spare^Amore^A' WHEN c_custkey % 11 = 0 THEN 'spare^A' END AS spare
FROM customer""",
    "fold_new_column": FOLD_NEW,
    "fold_new_column_large": FOLD_NEW,
    "stream_two_runs": f"SELECT event_id, ts, user_id AS v, event_type, value, props FROM ({SQL['apply_changes']})",
    "stream_apply_drops": SQL["apply_changes"],
    "reconcile_duplicates": """
WITH t AS (SELECT * REPLACE (l_extendedprice + CASE WHEN l_orderkey % 10 = 0 THEN 1.0 ELSE 0.0 END AS l_extendedprice)
           FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R'),
     a AS (SELECT l_orderkey, l_linenumber, count(*) AS n, any_value(l_extendedprice) AS p FROM lineitem GROUP BY ALL),
     b AS (SELECT l_orderkey, l_linenumber, count(*) AS n, any_value(l_extendedprice) AS p FROM t GROUP BY ALL)
SELECT l_orderkey, l_linenumber, coalesce(a.n, 0) AS n_source, coalesce(b.n, 0) AS n_target,
       CASE WHEN a.n > 1 OR b.n > 1 THEN 'duplicate' WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra'
            WHEN a.p IS NOT DISTINCT FROM b.p THEN 'equal' ELSE 'different' END AS status
FROM a FULL JOIN b USING (l_orderkey, l_linenumber)""",
    "ranked_ties": RANKED_TIES,
    "ranked_ties_written": RANKED_TIES,
    "named_tables": "SELECT c.* FROM customer c, range(4)",
    "schema_drift": """
WITH e AS (SELECT event_id % 3 AS i, count(*) AS n FROM events GROUP BY 1),
     r(i, "drop", "column", src_pos, tgt_pos, src_type, tgt_type, status) AS (VALUES
        (0, 'as_expected', 'event_id', 1, 1, 'bigint', 'bigint', 'ok'), (0, 'as_expected', 'value', 2, 2, 'int', 'int', 'ok'),
        (1, 'column_more', 'event_id', 1, 1, 'bigint', 'bigint', 'ok'), (1, 'column_more', 'value', 2, 2, 'int', 'int', 'ok'),
        (1, 'column_more', 'event_type', 3, NULL, 'string', NULL, 'source_only'),
        (2, 'narrowing', 'event_id', 1, 1, 'bigint', 'bigint', 'ok'),
        (2, 'narrowing', 'value', 2, 2, 'decimal(18,2)', 'int', 'type'))
SELECT "drop", "column", CAST(src_pos AS INTEGER) AS src_pos, CAST(tgt_pos AS INTEGER) AS tgt_pos, src_type, tgt_type, status, n
FROM r JOIN e USING (i)""",
    "cluster_ranges": FILE_RANGES,
    "compact_ranges": FILE_RANGES,
    "sort_by": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders",
    "ledger_complete": """
SELECT file_name, TIMESTAMP '2024-02-01 00:00:00' AS file_arrival_timestamp, CAST(n AS BIGINT) AS file_number_of_rows,
       CAST(NULL AS TIMESTAMP) AS file_processed_timestamp, false AS file_loaded
FROM (SELECT 'a b+c%20.parquet_I_1' AS file_name, count(*) AS n FROM customer UNION ALL SELECT 'empty.parquet_U_2', 0
      UNION ALL SELECT 'plain.parquet_D_3', count(*) FROM customer)""",
    "load_twice": f"""
WITH one AS (SELECT c_custkey AS k, c_name AS base, CASE WHEN c_custkey % 5 = 1 THEN c_name || '#2' ELSE c_name END AS name
             FROM customer WHERE c_custkey % 5 <> 2
             UNION ALL SELECT c_custkey + {NEW_KEY}, c_name, c_name FROM customer WHERE c_custkey % 5 = 3),
     two AS (SELECT o.k, coalesce(c.c_name || '#4', o.name) AS name FROM one o
             LEFT JOIN customer c ON c.c_custkey = o.k AND c.c_custkey % 5 = 3
             UNION ALL SELECT c_custkey, c_name || '#back' FROM customer WHERE c_custkey % 5 = 2)
SELECT coalesce(c.c_name || '#5', t.name) AS name, t.k AS key
FROM two t LEFT JOIN customer c ON c.c_custkey = t.k AND c.c_custkey % 10 = 2
WHERE NOT EXISTS (SELECT 1 FROM customer d WHERE d.c_custkey = t.k AND d.c_custkey % 10 = 4)
UNION ALL SELECT 'ledger:' || f, l FROM (VALUES ('customer.parquet_I_1', 1), ('customer.parquet_U_2', 1),
    ('customer.parquet_D_3', 1), ('customer.parquet_U_4', 1), ('customer.parquet_D_5', 1), ('customer_old.parquet_I_9', 0)) v(f, l)""",
})

SQL.update({
    "merged_types": """
SELECT c AS "column", m AS merged_type, s AS status, t AS types, CAST(3 AS BIGINT) AS files
FROM (VALUES ('c_custkey', 'bigint', 'widened', 'bigint, int'), ('c_name', 'string', 'same', 'string'),
             ('c_nationkey', 'bigint', 'widened', 'bigint, int'), ('c_acctbal', NULL, 'clash', 'double, string'),
             ('c_mktsegment', 'string', 'same', 'string')) v(c, m, s, t)
WHERE EXISTS (SELECT 1 FROM customer)""",
    "stream_typed_drops": """
WITH c AS (SELECT *, CAST(round(c_acctbal, 2) AS DECIMAL(18, 2)) AS d, c_custkey % 3 = 2 AND c_custkey % 2 = 0 AS odd FROM customer)
SELECT c_custkey, c_name, c_nationkey, CASE WHEN NOT odd THEN CAST(d AS DOUBLE) END AS c_acctbal, c_mktsegment,
       CASE WHEN odd THEN '{"c_acctbal":"' || CAST(d AS VARCHAR) || ' EUR"}' END AS rescued
FROM c""",
    "load_ranges": """
WITH h AS (SELECT max(o_orderkey) // 2 AS half FROM orders)
SELECT CASE WHEN o_orderkey > half AND o_orderkey <= half + 30 AND o_orderkey % 3 = 1 THEN 'changed' ELSE o_orderpriority END AS o_orderpriority, o_orderkey
FROM orders, h WHERE NOT (o_orderkey > half AND o_orderkey <= half + 30 AND o_orderkey % 3 = 0)
UNION ALL SELECT 'few rows written', -1""",
    "cluster_columns": """
SELECT o_orderkey AS key, o_orderpriority AS name FROM orders
UNION ALL SELECT 1, c || ' prunes' FROM (VALUES ('o_custkey'), ('o_orderdate')) v(c)""",
    "compact_small": """
SELECT o_orderkey AS key, o_orderpriority AS name FROM orders
UNION ALL SELECT n, c FROM (VALUES (2, 'large kept'), (1, 'few files')) v(n, c)""",
})

SQL.update({
    "reconcile_by_digests": f"""
WITH t AS (SELECT * REPLACE (CASE WHEN o_orderkey % 997 = 1 THEN o_orderstatus || '?' ELSE o_orderstatus END AS o_orderstatus)
           FROM orders WHERE o_orderkey % 997 <> 0
           UNION ALL SELECT * REPLACE (o_orderkey + {NEW_KEY} AS o_orderkey) FROM orders WHERE o_orderkey % 997 = 2
           UNION ALL SELECT * FROM orders WHERE o_orderkey % 997 = 3),
     b AS (SELECT o_orderkey, count(*) AS n, any_value(o_orderstatus) AS status FROM t GROUP BY 1)
SELECT o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 0 ELSE 1 END AS n_source, coalesce(b.n, 0) AS n_target,
       CASE WHEN b.n > 1 THEN 'duplicate' WHEN b.n IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'extra'
            WHEN a.o_orderstatus IS NOT DISTINCT FROM b.status THEN 'equal' ELSE 'different' END AS status
FROM orders a FULL JOIN b USING (o_orderkey)""",
    "fk_violations_bitmap": """
SELECT l.* FROM lineitem l
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_totalprice > 50000)""",
    "lookup_keys": f"""
SELECT * FROM ({SQL['apply_changes']})
WHERE user_id IN (SELECT user_id FROM events ORDER BY event_id DESC LIMIT 10)""",
    "cluster_by_indexes": """
SELECT 'orders' AS "table", o_orderkey AS key, o_orderpriority AS name FROM orders
UNION ALL SELECT 'customer', c_custkey, c_name FROM customer
UNION ALL SELECT t, i, c FROM (VALUES ('orders', 0, 'o_custkey'), ('orders', 1, 'o_orderpriority'), ('orders', 2, 'o_orderdate'),
                                      ('customer', 0, 'c_nationkey')) v(t, i, c)""",
    "profile_drops": "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_nulls, true AS near FROM events"
        for c in ("event_id", "user_id", "event_type", "value", "ts")),
})
