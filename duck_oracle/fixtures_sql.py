"""FX1 to FX4 as DuckDB CTEs (the text of FIXTURES.md §2) plus the variants."""

FX1 = """
cust_dim AS (
  SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey AS nat, TIMESTAMP '1997-01-01 00:00:00' AS configuration_date,
         1 AS version, c_custkey % 3 <> 0 AS lastversion, TIMESTAMP '1997-01-01 00:00:00' AS date_from,
         CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '1998-01-01 00:00:00' ELSE TIMESTAMP '2200-01-01 00:00:00' END AS date_to
  FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL
  SELECT c_custkey, 'OLD', c_nationkey, TIMESTAMP '1997-01-01 00:00:00', 2, true,
         TIMESTAMP '1998-01-01 00:00:00', TIMESTAMP '2200-01-01 00:00:00'
  FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 3 = 0
),
cust_stg AS (
  SELECT c_custkey AS src_k,
         CASE WHEN c_custkey % 4 = 0 THEN 'MACHINERY' WHEN c_custkey % 14 = 0 THEN NULL ELSE c_mktsegment END AS src_seg,
         c_nationkey AS src_nat, TIMESTAMP '1999-06-01 00:00:00' AS crtupd_dt
  FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0
  UNION ALL
  SELECT c_custkey, c_mktsegment, c_nationkey, TIMESTAMP '1999-07-01 00:00:00'
  FROM customer WHERE c_custkey % 8 = 0 AND c_custkey % 5 <> 0
)"""

FX2 = """
ord_log AS MATERIALIZED (
  SELECT o_custkey AS k1, o_orderpriority AS k2, o_orderstatus AS st, o_totalprice AS amt, o_orderdate AS ts, o_orderkey AS id
  FROM orders
),
ord_dim AS MATERIALIZED (
  SELECT k1, k2, st, amt, CAST(row_number() OVER w AS INT) AS version,
         lead(ts) OVER w IS NULL AS lastversion, ts AS date_from,
         coalesce(lead(ts) OVER w, TIMESTAMP '2200-01-01 00:00:00') AS date_to
  FROM ord_log WHERE ts < TIMESTAMP '1999-01-01 00:00:00'
  WINDOW w AS (PARTITION BY k1, k2 ORDER BY ts, id)
),
ord_stg AS MATERIALIZED (
  SELECT k1 AS src_k1, k2 AS src_k2, st AS src_st, amt AS src_amt, ts AS src_created_on
  FROM ord_log WHERE ts >= TIMESTAMP '1999-01-01 00:00:00'
)"""

FX3 = """
li_rank AS MATERIALIZED (
  SELECT l_suppkey AS k1, l_partkey % 20 AS k2, l_returnflag AS k3, l_shipdate AS ts, l_linestatus AS ls, l_quantity AS qty,
         l_orderkey AS id, l_linenumber AS line,
         row_number() OVER (PARTITION BY l_suppkey, l_partkey % 20, l_returnflag
                            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem
),
li_dim AS MATERIALIZED (
  SELECT k1, k2, k3, ls, qty, CAST(row_number() OVER w AS INT) AS version, lead(ts) OVER w IS NULL AS lastversion,
         ts AS date_from, coalesce(lead(ts) OVER w, TIMESTAMP '2200-01-01 00:00:00') AS date_to
  FROM li_rank WHERE rn > 1 AND (k1 + k2) % 7 <> 0
  WINDOW w AS (PARTITION BY k1, k2, k3 ORDER BY ts, id, line)
),
li_stg AS MATERIALIZED (
  SELECT k1, k2, k3, ls, qty, ts AS crtupd_dt FROM li_rank WHERE rn = 1 OR (k1 + k2) % 7 = 0
)"""

FX4 = """
evt_log AS (
  SELECT event_type AS kpi_name, CAST(month(ts) AS INT) AS mon, CAST(year(ts) AS INT) AS yr, user_id AS category,
         CAST(floor(value / 25) AS INT) AS target, ts, event_id
  FROM events
),
evt_rank AS (
  SELECT *, row_number() OVER (PARTITION BY kpi_name, mon, yr, category ORDER BY ts DESC, event_id DESC) AS rd
  FROM evt_log
),
evt_dim AS (
  SELECT kpi_name, mon, yr, category, target, CAST(row_number() OVER w AS INT) AS version,
         lead(ts) OVER w IS NULL AS lastversion, ts AS date_from,
         coalesce(lead(ts) OVER w, TIMESTAMP '2200-01-01 00:00:00') AS date_to
  FROM evt_rank WHERE category % 4 <> 0 AND (rd > 1 OR category % 3 = 0)
  WINDOW w AS (PARTITION BY kpi_name, mon, yr, category ORDER BY ts, event_id)
),
evt_stg AS (
  SELECT kpi_name AS src_kpi_name, mon AS src_month, yr AS src_year, category AS src_category, target AS src_target, ts AS src_created_on
  FROM evt_rank WHERE category % 4 = 0 OR (rd = 1 AND category % 3 <> 0)
)"""

# variant → (CTE text, dimension CTE, staging CTE)
FIXTURE_SQL = {
    "fx1": (FX1, "cust_dim", "cust_stg"),
    "fx2": (FX2, "ord_dim", "ord_stg"),
    "fx3": (FX3, "li_dim", "li_stg"),
    "fx4": (FX4, "evt_dim", "evt_stg"),
}
