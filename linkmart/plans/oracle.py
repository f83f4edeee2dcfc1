"""Oracle SQL (DuckDB dialect) for the testbed queries, written over the plain tables.

The Spark side goes through JSON payloads, upserts and snapshots; the SQL states the
expected result directly from the table columns and the fault rules of
``linkmart.sources.testbed``.
"""

from __future__ import annotations

from linkmart.plans import warehouse_queries
from linkmart.sources.testbed import BASE_URL, T1, T2

K = "o_orderkey"
VK = f"CAST({K} AS VARCHAR)"
CUST_URL = f"'{BASE_URL}/customers/'"
TS1, TS2 = f"TIMESTAMP '{T1}'", f"TIMESTAMP '{T2}'"

ORDER_NAME = (f"CASE WHEN {K} % 17 = 0 THEN NULL WHEN {K} % 19 = 0 THEN '   ' "
              f"WHEN {K} % 23 = 0 THEN NULL ELSE ' Order ' || {VK} || ' ' END")
ORDER_CHANGED = f"({K} % 4 = 0 AND {K} % 41 <> 0)"
ORDER_STATUS2 = f"CASE WHEN {ORDER_CHANGED} THEN o_orderstatus || '2' ELSE o_orderstatus END"
ORDER_DATE = f"CASE WHEN {K} % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END"
ORDER_DATE_TEXT = (f"CASE WHEN {K} % 7 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') "
                   f"ELSE strftime(o_orderdate, '%B %-d, %Y') END")
NO_ARRAY = f"({K} % 29 = 0 OR {K} % 31 = 0 OR {K} % 37 = 0)"
N_LINKS = (f"CASE WHEN {K} % 29 = 0 OR {K} % 31 = 0 THEN NULL WHEN {K} % 37 = 0 THEN 0 "
           f"ELSE 1 + CAST({K} % 5 = 0 AS INTEGER) + CAST({K} % 11 = 0 AS INTEGER) "
           f"+ CAST({K} % 13 = 0 AS INTEGER) END")

ORDER_LINKS = f"""
o_arr AS (
  SELECT {K} AS k, CAST(o_custkey AS VARCHAR) AS c,
         {CUST_URL} || CAST(o_custkey AS VARCHAR) AS u
  FROM orders WHERE NOT {NO_ARRAY}
),
ol AS (
  SELECT CAST(k AS VARCHAR) AS order_id, u AS customer_url, c AS customer_id FROM o_arr
  UNION ALL SELECT CAST(k AS VARCHAR), u, c FROM o_arr WHERE k % 5 = 0
  UNION ALL SELECT CAST(k AS VARCHAR), {CUST_URL} || 'x' || CAST(k AS VARCHAR),
                   'x' || CAST(k AS VARCHAR) FROM o_arr WHERE k % 11 = 0
  UNION ALL SELECT CAST(k AS VARCHAR), u || '/', '' FROM o_arr WHERE k % 13 = 0
)"""

DIM_ORDERS = f"""
dim_o AS (
  SELECT md5({VK} || '|' || CAST({TS1} AS VARCHAR)) AS order_sk, {VK} AS order_id,
         {ORDER_NAME} AS order_name, o_orderstatus AS order_status,
         o_orderpriority AS order_priority, {ORDER_DATE} AS order_date,
         {TS1} AS valid_from,
         CASE WHEN {ORDER_CHANGED} THEN {TS2} END AS valid_to,
         NOT {ORDER_CHANGED} AS is_current
  FROM orders
  UNION ALL
  SELECT md5({VK} || '|' || CAST({TS2} AS VARCHAR)), {VK}, {ORDER_NAME}, {ORDER_STATUS2},
         o_orderpriority, {ORDER_DATE}, {TS2}, CAST(NULL AS TIMESTAMP), TRUE
  FROM orders WHERE {ORDER_CHANGED}
)"""

C_CHANGED = "(c_custkey % 3 = 0)"
DIM_CUSTOMERS = f"""
dim_c AS (
  SELECT md5(CAST(c_custkey AS VARCHAR) || '|' || CAST({TS1} AS VARCHAR)) AS customer_sk,
         CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
         c_mktsegment AS segment, {TS1} AS valid_from,
         CASE WHEN {C_CHANGED} THEN {TS2} END AS valid_to, NOT {C_CHANGED} AS is_current
  FROM customer
  UNION ALL
  SELECT md5(CAST(c_custkey AS VARCHAR) || '|' || CAST({TS2} AS VARCHAR)),
         CAST(c_custkey AS VARCHAR), c_name, lower(c_mktsegment), {TS2},
         CAST(NULL AS TIMESTAMP), TRUE
  FROM customer WHERE {C_CHANGED}
)"""


def _fact(current: bool) -> str:
    cur_o = "WHERE is_current" if current else ""
    return f"""
WITH {ORDER_LINKS}, {DIM_ORDERS}, {DIM_CUSTOMERS}
SELECT o.order_sk, ol.order_id, o.order_name, o.order_date,
       c.customer_sk, ol.customer_id, c.customer_name, c.segment
FROM ol
LEFT JOIN (SELECT * FROM dim_o {cur_o}) o ON o.order_id = ol.order_id
LEFT JOIN (SELECT * FROM dim_c {cur_o}) c ON c.customer_id = ol.customer_id
"""


ORACLE_SQL = {
    "stage_orders": f"""
SELECT {VK} AS order_id, trim({ORDER_NAME}) AS order_name, {ORDER_STATUS2} AS status,
       o_orderpriority AS priority, {ORDER_DATE} AS order_date, {N_LINKS} AS n_customers,
       CASE WHEN {ORDER_CHANGED} THEN {TS2} ELSE {TS1} END AS extracted_at
FROM orders""",
    "stage_customers": f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       CASE WHEN {C_CHANGED} THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment,
       CASE WHEN {C_CHANGED} THEN {TS2} ELSE {TS1} END AS extracted_at
FROM customer""",
    "stage_order_dates": f"""
SELECT {VK} AS order_id, {ORDER_DATE_TEXT} AS order_date_text, {ORDER_DATE} AS order_date
FROM orders""",
    "json_roundtrip_events": """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract(props, '$.k') AS VARCHAR) AS k_json,
       CAST(NULL AS VARCHAR) AS missing_text, CAST(NULL AS VARCHAR) AS missing_json,
       CAST(NULL AS VARCHAR) AS null_text, 'null' AS null_json
FROM events""",
    "canonical_json_events": """
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS canonical,
       '{"k":' || json_extract_string(props, '$.k') || ',"z":1}' AS canonical_reordered,
       TRUE AS equal
FROM events""",
    "url_tail_split_pages": """
SELECT page_id, url, split_part(url, '/', -1) AS tail FROM pages""",
    "url_tail_regex_pages": """
SELECT page_id, url, nullif(regexp_extract(url, '[^/]+$'), '') AS tail FROM pages""",
    "surrogate_key_events": """
SELECT event_id, user_id, ts,
       md5(CAST(user_id AS VARCHAR) || '|' || CAST(ts AS VARCHAR)) AS sk
FROM events""",
    "unnest_order_customers": f"WITH {ORDER_LINKS} SELECT * FROM ol",
    "dim_orders_all": f"WITH {DIM_ORDERS} SELECT * FROM dim_o",
    "dim_orders_current": f"WITH {DIM_ORDERS} SELECT * FROM dim_o WHERE is_current",
    "dim_customers_all": f"WITH {DIM_CUSTOMERS} SELECT * FROM dim_c",
    "fact_current": _fact(True),
    "fact_all": _fact(False),
    "fact_unmatched": f"SELECT * FROM ({_fact(True)}) f WHERE customer_sk IS NULL",
    "fact_part_supplier": f"""
SELECT md5(CAST(p_partkey AS VARCHAR) || '|' || CAST({TS1} AS VARCHAR)) AS part_sk,
       CAST(l_partkey AS VARCHAR) AS part_id, p_name AS part_name, p_brand AS brand,
       md5(CAST(s_suppkey AS VARCHAR) || '|' || CAST({TS1} AS VARCHAR)) AS supplier_sk,
       CAST(l_suppkey AS VARCHAR) AS supplier_id, s_name AS supplier_name
FROM lineitem
LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN supplier ON s_suppkey = l_suppkey""",
    "scd2_bucketed_orders": f"WITH {DIM_ORDERS} SELECT * FROM dim_o",
    "upsert_bucketed_orders": f"""
SELECT {VK} AS order_id, {ORDER_STATUS2} AS status,
       CASE WHEN {ORDER_CHANGED} THEN {TS2} ELSE {TS1} END AS extracted_at, CAST(2 AS INTEGER) AS version
FROM orders""",
    "upsert_two_batches": f"""
SELECT {VK} AS order_id, {ORDER_STATUS2} AS status, TRUE AS canonical,
       CASE WHEN {ORDER_CHANGED} THEN {TS2} ELSE {TS1} END AS extracted_at
FROM orders""",
}

# ---- pages -------------------------------------------------------------------------------

CK = "c_custkey"
PAGE = f"CAST({CK} // 50 AS INTEGER)"
POS = f"CAST({CK} % 50 AS INTEGER)"
CORRUPT = f"({CK} // 50) % 9 = 4"
C_BAD = f"({CK} % 97 = 0 OR {CK} % 89 = 0 OR {CK} % 83 = 0)"
C_REASON = (f"CASE WHEN {CK} % 97 = 0 THEN 'not_a_dict' "
            f"WHEN {CK} % 89 = 0 OR {CK} % 83 = 0 THEN 'missing_id' END")
C_PAYLOAD = (f"CASE WHEN {CK} % 97 = 0 THEN '\"broken-' || CAST({CK} AS VARCHAR) || '\"' "
             f"WHEN {CK} % 89 = 0 THEN '{{\"name\":\"' || c_name || '\"}}' "
             f"WHEN {CK} % 83 = 0 THEN '{{\"id\":0,\"name\":\"' || c_name || '\"}}' "
             f"ELSE '{{\"id\":\"' || CAST({CK} AS VARCHAR) || '\",\"name\":\"' || c_name "
             f"|| '\",\"segment\":\"' || c_mktsegment || '\"}}' END")
PAGE_ROWS = f"""
pr AS (
  SELECT 'customers' AS source_name, {PAGE} AS page, {POS} AS pos,
         CASE WHEN {C_BAD} THEN NULL ELSE CAST({CK} AS VARCHAR) END AS id,
         {C_PAYLOAD} AS payload, {C_REASON} AS reason
  FROM customer WHERE NOT ({CORRUPT})
)"""
METRICS = f"""
{PAGE_ROWS},
m AS (
  SELECT source_name, page,
         CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS loaded,
         CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS quarantined,
         CAST(count(*) AS BIGINT) AS records
  FROM pr GROUP BY source_name, page
)"""
RUN_STATE = f"""
{METRICS},
allp AS (SELECT DISTINCT {PAGE} AS page FROM customer),
stops AS (
  SELECT (SELECT min(page) FROM m WHERE records < 50) AS s,
         (SELECT min(page) FROM allp WHERE page % 9 = 4) AS b
),
rs AS (
  SELECT 'customers' AS source_name,
         CASE WHEN b IS NOT NULL AND (s IS NULL OR b < s) THEN 'failed' ELSE 'completed' END AS status,
         CAST((SELECT max(page) FROM m WHERE (s IS NULL OR page <= s) AND (b IS NULL OR page < b))
              AS INTEGER) AS last_completed_page,
         {TS1} AS run_started_at, {TS2} AS run_ended_at,
         CASE WHEN b IS NOT NULL AND (s IS NULL OR b < s) THEN 'malformed page ' || CAST(b AS VARCHAR)
         END AS error_message,
         CAST(coalesce((SELECT sum(loaded) FROM m WHERE (s IS NULL OR page <= s)
                         AND (b IS NULL OR page < b)), 0) AS INTEGER) AS records_loaded
  FROM stops
)"""

# ---- users change log ----------------------------------------------------------------------

USER_DAYS = """
ud AS (
  SELECT CAST(user_id AS VARCHAR) AS id, day, 'user-' || CAST(user_id AS VARCHAR) AS name,
         event_type, '{"k":' || json_extract_string(props, '$.k') || '}' AS props
  FROM (SELECT user_id, date_trunc('day', ts) AS day, event_type, props,
               row_number() OVER (PARTITION BY user_id, date_trunc('day', ts)
                                  ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) t
  WHERE rn = 1
),
uc AS (
  SELECT * FROM (
    SELECT *, lag(event_type) OVER w AS pe, lag(props) OVER w AS pp, lag(day) OVER w AS pd
    FROM ud WINDOW w AS (PARTITION BY id ORDER BY day)) t
  WHERE pd IS NULL OR pe IS DISTINCT FROM event_type OR pp IS DISTINCT FROM props
)"""
USER_FINAL = f"""
WITH {USER_DAYS}
SELECT id AS user_id, event_type, props, day AS extracted_at
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day DESC) AS r FROM uc) t
WHERE r = 1"""
USER_VERSIONS = f"""
WITH {USER_DAYS}
SELECT id, name, event_type, props, md5(id || '|' || CAST(day AS VARCHAR)) AS scd_id,
       day AS updated_at, day AS valid_from,
       lead(day) OVER (PARTITION BY id ORDER BY day) AS valid_to
FROM uc"""

# ---- orders payload text (canonical JSON: sorted keys, no spaces) --------------------------

_U = f"{CUST_URL} || CAST(o_custkey AS VARCHAR)"
_CUSTOMERS_JSON = (
    f"CASE WHEN {K} % 29 = 0 THEN '\"customers\":null,' WHEN {K} % 31 = 0 THEN '' "
    f"WHEN {K} % 37 = 0 THEN '\"customers\":[],' "
    f"ELSE '\"customers\":[\"' || {_U} || '\"' "
    f"|| CASE WHEN {K} % 5 = 0 THEN ',\"' || {_U} || '\"' ELSE '' END "
    f"|| CASE WHEN {K} % 11 = 0 THEN ',\"' || {CUST_URL} || 'x' || {VK} || '\"' ELSE '' END "
    f"|| CASE WHEN {K} % 13 = 0 THEN ',\"' || {_U} || '/\"' ELSE '' END || '],' END")
_NAME_JSON = (f"CASE WHEN {K} % 17 = 0 THEN '' WHEN {K} % 19 = 0 THEN '\"name\":\"   \",' "
              f"WHEN {K} % 23 = 0 THEN '\"name\":null,' "
              f"ELSE '\"name\":\" Order ' || {VK} || ' \",' END")
ORDER_PAYLOAD = (f"'{{' || {_CUSTOMERS_JSON} || '\"id\":\"' || {VK} || '\",' || {_NAME_JSON} "
                 f"|| '\"order_date\":\"' || {ORDER_DATE_TEXT} || '\",\"priority\":\"' "
                 f"|| o_orderpriority || '\",\"status\":\"' || {ORDER_STATUS2} || '\"}}'")
ORDER_EXTRACTED = f"CASE WHEN {ORDER_CHANGED} THEN {TS2} ELSE {TS1} END"
DL_FIELDS = f"""
SELECT 'orders' AS source_name, {VK} AS natural_key, {ORDER_PAYLOAD} AS raw_payload,
       {ORDER_EXTRACTED} AS extracted_at,
       CASE WHEN ({ORDER_NAME}) IS NULL THEN 'missing_name' ELSE 'empty_name' END AS error_type
FROM orders WHERE ({ORDER_NAME}) IS NULL OR trim({ORDER_NAME}) = ''"""
DL_LINKS = f"""
SELECT 'orders' AS source_name, {VK} AS natural_key, {ORDER_PAYLOAD} AS raw_payload,
       {ORDER_EXTRACTED} AS extracted_at, 'invalid_customers_link' AS error_type
FROM orders
WHERE NOT {NO_ARRAY}
  AND ({K} % 11 = 0 OR {K} % 13 = 0
       OR NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey))
UNION ALL
SELECT 'orders', {VK}, {ORDER_PAYLOAD}, {ORDER_EXTRACTED}, 'invalid_customers_type'
FROM orders WHERE {K} % 29 = 0"""
DL_QUARANTINE = f"""
WITH {PAGE_ROWS}
SELECT source_name, CAST(NULL AS VARCHAR) AS natural_key, payload AS raw_payload,
       {TS1} AS extracted_at, reason AS error_type
FROM pr WHERE reason IS NOT NULL"""

ORACLE_SQL.update({
    "read_pages_rows": f"WITH {PAGE_ROWS} SELECT * FROM pr",
    "malformed_pages": f"""
SELECT DISTINCT 'customers' AS source_name, {PAGE} AS page FROM customer WHERE {CORRUPT}""",
    "split_records_counts": f"""
WITH {METRICS}
SELECT *, CAST(sum(loaded) OVER (PARTITION BY source_name ORDER BY page) AS BIGINT) AS loaded_total
FROM m""",
    "quarantine_rows": f"""
WITH {PAGE_ROWS}
SELECT md5(source_name || '|b1|' || CAST(page AS VARCHAR) || '|' || CAST(pos AS VARCHAR)) AS raw_id,
       source_name, payload AS raw_payload, reason, {TS1} AS extracted_at
FROM pr WHERE reason IS NOT NULL""",
    "state_after_run": f"WITH {RUN_STATE} SELECT * FROM rs",
    "merge_state": f"""
WITH {RUN_STATE}
SELECT source_name, 'in_progress' AS status, last_completed_page, {TS2} AS run_started_at,
       CAST(NULL AS TIMESTAMP) AS run_ended_at, CAST(NULL AS VARCHAR) AS error_message,
       records_loaded
FROM rs""",
    "resume_point": f"""
WITH {RUN_STATE}
SELECT source_name,
       CAST(CASE WHEN status IN ('in_progress', 'failed') THEN coalesce(last_completed_page, -1) + 1
            ELSE 0 END AS INTEGER) AS start_page,
       CAST(CASE WHEN status IN ('in_progress', 'failed') THEN records_loaded ELSE 0 END
            AS INTEGER) AS records_loaded
FROM rs""",
    "upsert_replay_events": USER_FINAL,
    "stream_upsert": USER_FINAL,
    "scd2_replay_events": USER_VERSIONS,
    "scd2_merge_events": USER_VERSIONS,
    "dead_letter_fields": DL_FIELDS,
    "dead_letter_links": DL_LINKS,
    "dead_letters": f"{DL_FIELDS} UNION ALL {DL_LINKS} UNION ALL SELECT * FROM ({DL_QUARANTINE}) q",
    "check_not_null": f"""
SELECT {VK} AS order_id, CAST(NULL AS VARCHAR) AS order_name
FROM orders WHERE ({ORDER_NAME}) IS NULL""",
    "check_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n_records
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_relationships": f"""
SELECT * FROM ({_fact(True)}) f
WHERE customer_id IS NOT NULL
  AND customer_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)""",
    "check_relationships_labels": """
SELECT l.* FROM labels l
WHERE l.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)""",
    "check_count": f"""
WITH q AS ({DL_QUARANTINE})
SELECT count(*) AS bad_count FROM q WHERE error_type IN ('missing_id', 'not_a_dict')
HAVING count(*) > 0""",
})


def _check_report() -> str:
    fact_cur = f"({_fact(True)})"
    rows = [
        ("not_null__stg_orders__order_id", "stg_orders", "not_null",
         f"SELECT count(*) FROM orders WHERE {K} IS NULL"),
        ("unique__stg_orders__order_id", "stg_orders", "unique",
         f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM orders WHERE {K} IS NOT NULL "
         f"GROUP BY {K} HAVING count(*) > 1) t"),
        ("not_null__stg_orders__order_name", "stg_orders", "not_null",
         f"SELECT count(*) FROM orders WHERE ({ORDER_NAME}) IS NULL"),
        ("not_null__dim_orders__order_sk", "dim_orders", "not_null",
         "SELECT count(*) FROM dim_o WHERE order_sk IS NULL"),
        ("unique__dim_orders__order_sk", "dim_orders", "unique",
         "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM dim_o GROUP BY order_sk "
         "HAVING count(*) > 1) t"),
        ("not_null__dim_orders__order_id", "dim_orders", "not_null",
         "SELECT count(*) FROM dim_o WHERE order_id IS NULL"),
        ("unique__dim_orders__current__order_id", "dim_orders__current", "unique",
         "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM dim_o WHERE is_current "
         "GROUP BY order_id HAVING count(*) > 1) t"),
        ("not_null__dim_orders__order_name", "dim_orders", "not_null",
         "SELECT count(*) FROM dim_o WHERE order_name IS NULL"),
        ("not_null__fct_order_customers__order_id", "fct_order_customers", "not_null",
         f"SELECT count(*) FROM {fact_cur} f WHERE order_id IS NULL"),
        ("relationships__fct_order_customers__order_id__dim_orders__order_id",
         "fct_order_customers", "relationships",
         f"SELECT count(*) FROM {fact_cur} f WHERE order_id NOT IN (SELECT order_id FROM dim_o)"),
        ("relationships__fct_order_customers__customer_id__dim_customers__customer_id",
         "fct_order_customers", "relationships",
         f"SELECT count(*) FROM {fact_cur} f WHERE customer_id NOT IN "
         "(SELECT customer_id FROM dim_c)"),
        ("count__dead_letters", "dead_letters", "count",
         "SELECT CASE WHEN n > 0 THEN n ELSE 0 END FROM (SELECT count(*) AS n FROM pr "
         "WHERE reason IN ('missing_id', 'not_a_dict')) t"),
    ]
    body = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS check_name, '{m}' AS model, '{t}' AS test, CAST(({q}) AS BIGINT) AS failures"
        for n, m, t, q in rows)
    return f"""
WITH {DIM_ORDERS}, {DIM_CUSTOMERS}, {PAGE_ROWS},
c AS ({body})
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM c"""


ORACLE_SQL["check_report"] = _check_report()
ORACLE_SQL["page_report"] = f"""
WITH pg AS (
  SELECT 'customers' AS source_name, {PAGE} AS page, bool_or({CORRUPT}) AS bad,
         CASE WHEN bool_or({CORRUPT}) THEN 0 ELSE count(*) END AS n
  FROM customer GROUP BY {PAGE}
)
SELECT source_name, count(*) AS pages, CAST(sum(n) AS BIGINT) AS records,
       count(*) FILTER (WHERE bad) AS malformed,
       CAST(max(page) + 1 - count(*) AS BIGINT) AS missing_pages,
       arg_max(n, page) AS last_page_records,
       count(*) FILTER (WHERE n < 50) AS short_pages,
       (count(*) FILTER (WHERE bad) = 0 AND max(page) + 1 - count(*) = 0
        AND arg_max(n, page) < 50 AND count(*) FILTER (WHERE n < 50) = 1) AS complete
FROM pg GROUP BY source_name"""

ORACLE_SQL["refresh_counts"] = f"""
WITH {ORDER_LINKS}, {DIM_ORDERS}, {DIM_CUSTOMERS}
SELECT 'checks' AS table_name,
       -- 8 generated checks per entity (2), 4 per fact (2), 1 dead-letter count check
       CAST(2 * 8 + 2 * 4 + 1 AS BIGINT) AS n_rows
UNION ALL SELECT 'dead_letters', CAST((SELECT count(*) FROM ({DL_FIELDS}) a)
                                      + (SELECT count(*) FROM ({DL_LINKS}) b) AS BIGINT)
UNION ALL SELECT 'dim_customers', CAST((SELECT count(*) FROM dim_c) AS BIGINT)
UNION ALL SELECT 'dim_orders', CAST((SELECT count(*) FROM dim_o) AS BIGINT)
UNION ALL SELECT 'fct_order_customers', CAST((SELECT count(*) FROM ({_fact(True)}) f) AS BIGINT)
UNION ALL SELECT 'fct_order_customers_all', CAST((SELECT count(*) FROM ({_fact(False)}) f) AS BIGINT)
"""

ORACLE_SQL["pages_to_raw"] = f"""
WITH {PAGE_ROWS}
SELECT id, payload, {TS1} AS extracted_at FROM pr WHERE reason IS NULL"""

ORACLE_SQL["lineitem_latest_per_key"] = """
SELECT line_id, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus
FROM (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id, *,
         row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                    l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                    l_linestatus DESC) AS rn
  FROM lineitem) t
WHERE rn = 1"""

# users runs are days, a page is user_id div 50: the state is that of the last day
ORACLE_SQL["stream_state_users"] = """
WITH ud AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS day FROM events)
SELECT 'users' AS source_name, 'completed' AS status,
       CAST(max(user_id // 50) AS INTEGER) AS last_completed_page,
       CAST(count(*) AS INTEGER) AS records_loaded, CAST(NULL AS VARCHAR) AS error_message
FROM ud WHERE day = (SELECT max(day) FROM ud)"""

ORACLE_SQL["stream_reextract_customers"] = f"""
SELECT CAST({CK} AS VARCHAR) AS customer_id,
       CASE WHEN {CK} % 3 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment,
       CASE WHEN {CK} % 3 = 0 AND lower(c_mktsegment) <> c_mktsegment THEN {TS2} ELSE {TS1} END AS extracted_at
FROM customer WHERE NOT ({CORRUPT}) AND NOT ({C_BAD})"""

ORACLE_SQL["stream_reextract_quarantine"] = f"""
WITH {PAGE_ROWS},
one AS (
  SELECT reason, count(*) AS n FROM pr WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL
  SELECT 'malformed_page', count(DISTINCT {PAGE}) FROM customer WHERE {CORRUPT} HAVING count(*) > 0
)
SELECT t AS extracted_at, reason, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) AS n_ids
FROM one, (SELECT {TS1} AS t UNION ALL SELECT {TS2}) r"""

ORACLE_SQL["upsert_sequence_users"] = USER_FINAL

# three runs of two sources: run 8's readable pages at T1, then the rest of it, run 9 and
# run 10's page 0 of the customers (a later run's record wins), and all suppliers, at T2
_LANDED_CUSTOMERS = f"""
c AS (SELECT c_custkey AS k, c_custkey // 50 AS page, c_mktsegment AS seg FROM customer),
at1 AS (SELECT k, seg FROM c WHERE page < 2),
at2 AS (
  SELECT k, 8 AS run, seg FROM c WHERE page > 2
  UNION ALL SELECT k, 9, CASE WHEN k % 3 = 0 THEN lower(seg) ELSE seg END FROM c WHERE page >= 1
  UNION ALL SELECT k, 10, CASE WHEN k % 4 = 0 THEN seg || '10' ELSE seg END FROM c WHERE page = 0
),
last2 AS (SELECT k, arg_max(seg, run) AS seg FROM at2 GROUP BY k)"""

ORACLE_SQL["extract_runs_raw"] = f"""
WITH {_LANDED_CUSTOMERS}
SELECT 'customers' AS source_name, CAST(coalesce(b.k, a.k) AS VARCHAR) AS id, coalesce(b.seg, a.seg) AS value,
       CASE WHEN a.k IS NOT NULL AND (b.k IS NULL OR a.seg = b.seg) THEN {TS1} ELSE {TS2} END AS extracted_at
FROM at1 a FULL JOIN last2 b ON a.k = b.k
UNION ALL
SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 2 = 0 THEN s_name || '10' ELSE s_name END,
       CASE WHEN s_suppkey % 2 = 0 THEN {TS2} ELSE {TS1} END
FROM supplier"""

# a run ends at its first page that is not full, which may be an empty one
_RUN_LEDGER = f"""
{_LANDED_CUSTOMERS},
top AS (SELECT CAST((max(k) + 1) // 50 + 1 AS INTEGER) AS beyond, CAST(max(page) AS INTEGER) AS p FROM c),
sup AS (
  SELECT CAST((max(s_suppkey) + 1) // 50 + 1 AS INTEGER) AS beyond, CAST(max(s_suppkey // 50) AS INTEGER) AS p,
         CAST(count(*) AS INTEGER) AS n FROM supplier
),
ledger AS (
  SELECT 'customers' AS source_name, '8' AS run, 'failed' AS status, beyond AS next_page,
         CASE WHEN p = 2 THEN 1 ELSE p END AS last_completed_page, {TS2} AS run_started_at, {TS2} AS run_ended_at,
         'malformed page 2' AS error_message, CAST((SELECT count(*) FROM c WHERE page <> 2) AS INTEGER) AS records_loaded
  FROM top
  UNION ALL
  SELECT 'customers', '9', 'failed', beyond, p, {TS2}, {TS2}, 'missing page 0',
         CAST((SELECT count(*) FROM c WHERE page > 0) AS INTEGER) FROM top
  UNION ALL
  SELECT 'customers', '10', 'failed', 1, 0, {TS2}, {TS2}, 'malformed page 1', 50
  UNION ALL
  SELECT 'suppliers', '8', 'completed', beyond, p, {TS1}, {TS1}, NULL, n FROM sup
  UNION ALL
  SELECT 'suppliers', '10', 'completed', beyond, p, {TS2}, {TS2}, NULL, n FROM sup
)"""
ORACLE_SQL["extract_runs_ledger"] = f"WITH {_RUN_LEDGER} SELECT * FROM ledger"
ORACLE_SQL["extract_runs_state"] = f"""
WITH {_RUN_LEDGER}
SELECT source_name, status, last_completed_page, records_loaded,
       CAST(CASE WHEN status = 'failed' THEN last_completed_page + 1 ELSE 0 END AS INTEGER) AS start_page
FROM ledger WHERE run = '10'"""

ORACLE_SQL["canonical_json_numbers"] = """
WITH e AS (SELECT event_id, CAST(event_id AS VARCHAR) AS k, '1' || lpad(CAST(event_id AS VARCHAR), 28, '0') AS long FROM events)
SELECT event_id, '{"k":' || k || ',"z":"1e2"}' AS plain, '{"k":' || k || ',"z":"1e2"}' AS exponent,
       '{"k":' || k || ',"z":"1e2"}' AS zeros, '{"k":' || CAST(event_id * 1000 AS VARCHAR) || '}' AS thousand,
       '{"k":' || long || '}' AS long, '{"k":' || long || '}' AS long_exponent
FROM e"""

ORACLE_SQL["stream_compacted_customers"] = ORACLE_SQL["stream_reextract_customers"]

ORACLE_SQL |= warehouse_queries.ORACLE_SQL
