"""The same results as SQL over the given tables, for checking the queries."""

VISITS = """
visits AS (
  SELECT o_custkey AS patient_id,
         '  ' || c_name || ' ' AS name,
         CASE WHEN c_nationkey <> 0 THEN c_nationkey * 8 END AS age,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN lower(c_mktsegment) END AS diagnosis,
         CAST(o_orderdate AS DATE) AS visit_date,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              WHEN o_orderpriority = '5-LOW' THEN -o_totalprice
              ELSE o_totalprice END AS billing_amount,
         o_orderkey AS visit_id
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

FILLED = """
filled AS (
  SELECT patient_id,
         coalesce(name, 'Unknown') AS name,
         coalesce(age, 0) AS age,
         coalesce(diagnosis, 'Unknown') AS diagnosis,
         visit_date,
         coalesce(billing_amount, 0.0) AS billing_amount,
         visit_id
  FROM visits
)"""

STANDARD = """
standard AS (
  SELECT patient_id, trim(name) AS name, age, upper(trim(diagnosis)) AS diagnosis,
         visit_date, billing_amount, visit_id
  FROM filled
)"""

CLEAN = """
clean AS (
  SELECT * FROM standard WHERE age BETWEEN 0 AND 150 AND billing_amount >= 0
)"""


def _silver(source: str) -> str:
    return f"""
silver AS (
  SELECT patient_id, name, age, diagnosis, visit_date, billing_amount, visit_id
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY patient_id ORDER BY visit_date DESC NULLS LAST, visit_id DESC NULLS LAST
    ) AS pick
    FROM {source}
  ) WHERE pick = 1
)"""


GROUPED = """
grouped AS (
  SELECT diagnosis,
         round(CAST(sum(CAST(billing_amount AS DECIMAL(28,6))) AS DOUBLE), 2) AS total_billing,
         round(avg(billing_amount), 2) AS avg_billing,
         count(patient_id) AS patient_count,
         min(age) AS min_age,
         max(age) AS max_age,
         round(avg(age), 1) AS avg_age,
         min(visit_date) AS first_visit,
         max(visit_date) AS last_visit
  FROM silver GROUP BY diagnosis
)"""

RANKED = """
ranked AS (
  SELECT *, CAST(rank() OVER (ORDER BY total_billing DESC NULLS LAST) AS INTEGER)
         AS billing_rank
  FROM grouped
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_TO_CLEAN = (VISITS, FILLED, STANDARD, CLEAN)
_TO_SILVER = (*_TO_CLEAN, _silver("clean"))
_TO_GOLD = (*_TO_SILVER, GROUPED)
_TO_RANKED = (*_TO_GOLD, RANKED)
_SINCE = "(SELECT * FROM clean WHERE visit_date > DATE '1998-01-01')"
_TOP = "SELECT diagnosis, total_billing FROM grouped ORDER BY total_billing DESC, diagnosis LIMIT 1"
_NULLS = "SELECT '{0}' AS field, count(*) FILTER (WHERE {0} IS NULL) AS null_count FROM visits"

ORACLE: dict[str, str] = {
    "csv_ingest": _with(VISITS, select="SELECT *, TRUE AS from_csv FROM visits"),
    "ingest_incremental": _with(
        VISITS, select="SELECT * FROM visits WHERE visit_date > DATE '1998-01-01'"
    ),
    "incremental_days_back": _with(
        VISITS,
        select="SELECT * FROM visits WHERE visit_date > "
        "(SELECT max(visit_date) - INTERVAL 30 DAY FROM visits)",
    ),
    "bronze_roundtrip": _with(VISITS, select="SELECT * FROM visits"),
    "bronze_date_range": _with(
        VISITS,
        select="SELECT * FROM visits "
        "WHERE visit_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'",
    ),
    "schema_evolution": _with(
        VISITS,
        select="SELECT *, CASE WHEN visit_date > DATE '1998-01-01' "
        "THEN 'DOC' || patient_id END AS doctor_id FROM visits",
    ),
    "silver_fill_nulls": _with(VISITS, FILLED, select="SELECT * FROM filled"),
    "silver_standardize": _with(VISITS, FILLED, STANDARD, select="SELECT * FROM standard"),
    "silver_range_rules": _with(*_TO_CLEAN, select="SELECT * FROM clean"),
    "silver_rejects": _with(
        VISITS,
        FILLED,
        STANDARD,
        select="""
SELECT visit_id,
       concat_ws(',', CASE WHEN age NOT BETWEEN 0 AND 150 THEN 'age_out_of_range' END,
                      CASE WHEN billing_amount < 0 THEN 'negative_billing' END) AS reasons
FROM standard WHERE age NOT BETWEEN 0 AND 150 OR billing_amount < 0""",
    ),
    "silver_dedup_latest": _with(*_TO_SILVER, select="SELECT * FROM silver"),
    "silver_dedup_keys": _with(*_TO_CLEAN, select="SELECT DISTINCT patient_id FROM clean"),
    "silver_null_audit": _with(
        VISITS,
        select=" UNION ALL ".join(
            _NULLS.format(c) for c in ("patient_id", "name", "diagnosis", "visit_date")
        ),
    ),
    "silver_roundtrip": _with(*_TO_SILVER, select="SELECT * FROM silver"),
    "gold_by_diagnosis": _with(*_TO_GOLD, select="SELECT * FROM grouped"),
    "gold_billing_rank": _with(
        *_TO_RANKED, select="SELECT diagnosis, total_billing, billing_rank FROM ranked"
    ),
    "insight_top_diagnosis": _with(*_TO_GOLD, select=_TOP),
    "insight_total_revenue": _with(
        *_TO_SILVER, select="SELECT round(sum(billing_amount), 2) AS total_revenue FROM silver"
    ),
    "insight_distribution": _with(
        *_TO_GOLD, select="SELECT diagnosis, patient_count FROM grouped"
    ),
    "insight_summary": _with(
        *_TO_GOLD,
        f"top AS ({_TOP})",
        select="""
SELECT (SELECT diagnosis FROM top) AS top_diagnosis,
       (SELECT total_billing FROM top) AS top_billing,
       round(sum(billing_amount), 2) AS total_revenue
FROM silver""",
    ),
    "insight_record": _with(
        *_TO_GOLD,
        f"top AS ({_TOP})",
        select="""
SELECT 'top_diagnosis' AS insight, diagnosis, total_billing AS value FROM top
UNION ALL
SELECT 'total_revenue', NULL, round(sum(billing_amount), 2) FROM silver
UNION ALL
SELECT 'patient_count', diagnosis, CAST(patient_count AS DOUBLE) FROM grouped""",
    ),
    "join_broadcast": """
SELECT l_suppkey AS suppkey, l_orderkey, l_linenumber, l_extendedprice, s_name, s_nationkey
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "join_regular": """
SELECT l_orderkey AS orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "join_heavy_key": """
SELECT p_partkey AS partkey, l_orderkey, l_linenumber, l_quantity, p_brand, p_size
FROM lineitem JOIN part
  ON p_partkey = CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END""",
    "join_heavy_both": """
SELECT nation, c_custkey, s_suppkey
FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_nationkey END AS nation, c_custkey
      FROM customer)
JOIN (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_nationkey END AS nation, s_suppkey
      FROM supplier) USING (nation)""",
    "sized_partition_write": """
SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users
FROM events GROUP BY event_type""",
    "agg_metrics": """
WITH lines AS (
  SELECT l_returnflag, l_linestatus, nullif(l_quantity, 1.0) AS quantity,
         CASE WHEN l_discount > 0 THEN l_extendedprice END AS price
  FROM lineitem
)
SELECT l_returnflag, l_linestatus,
       round(sum(quantity), 2) AS total_quantity,
       round(avg(quantity), 2) AS avg_quantity,
       count(quantity) AS count_quantity,
       round(sum(price), 2) AS total_price,
       round(avg(price), 2) AS avg_price,
       count(price) AS count_price
FROM lines WHERE quantity IS NOT NULL AND price IS NOT NULL
GROUP BY l_returnflag, l_linestatus""",
    "capped_view": """
SELECT event_type, count(*) AS events, count(value) AS measured,
       round(sum(value), 2) AS total_value
FROM events GROUP BY event_type""",
    "run_metrics": _with(
        *_TO_GOLD,
        select="""
SELECT 'bronze' AS layer, 'success' AS status, count(*) AS record_count FROM visits
UNION ALL SELECT 'silver', 'success', count(*) FROM silver
UNION ALL SELECT 'gold', 'success', count(*) FROM grouped""",
    ),
    "medallion_full": _with(*_TO_RANKED, select="SELECT * FROM ranked"),
    "medallion_stored": _with(*_TO_RANKED, select="SELECT * FROM ranked"),
    "incremental_run": _with(
        *_TO_CLEAN, _silver(_SINCE), GROUPED, RANKED, select="SELECT * FROM ranked"
    ),
    "incremental_days_run": _with(*_TO_RANKED, select="SELECT * FROM ranked"),
    "malformed_lines": _with(
        VISITS,
        "broken AS (SELECT * REPLACE (CASE WHEN visit_id % 97 <> 0 THEN age END AS age) "
        "FROM visits)",
        FILLED.replace("FROM visits", "FROM broken"),
        STANDARD,
        select="""
SELECT visit_id, 'malformed' AS why FROM visits WHERE visit_id % 97 = 0
UNION ALL
SELECT visit_id,
       concat_ws(',', CASE WHEN age NOT BETWEEN 0 AND 150 THEN 'age_out_of_range' END,
                      CASE WHEN billing_amount < 0 THEN 'negative_billing' END)
FROM standard WHERE age NOT BETWEEN 0 AND 150 OR billing_amount < 0""",
    ),
    "evolution_fold": _with(
        *_TO_SILVER,
        select="SELECT *, CASE WHEN visit_date > DATE '1998-01-01' "
        "THEN 'DOC' || patient_id END AS doctor_id FROM silver",
    ),
    "step_metrics": _with(
        *_TO_GOLD,
        select="""
SELECT 'bronze' AS operation, count(*) AS row_count, TRUE AS timed FROM visits
UNION ALL SELECT 'silver', count(*), TRUE FROM silver
UNION ALL SELECT 'gold', count(*), TRUE FROM grouped
UNION ALL SELECT 'gold read', count(*), TRUE FROM grouped""",
    ),
    "layer_stamps": _with(
        *_TO_SILVER,
        select="SELECT count(*) AS named, count(*) AS loaded, count(*) AS processed FROM silver",
    ),
    "trend_calendar": _with(
        *_TO_CLEAN,
        """
kept AS (
  SELECT * FROM clean WHERE month(visit_date) BETWEEN 6 AND 8 OR diagnosis <> 'BUILDING'
)""",
        """
months AS (
  SELECT CAST(date_trunc('month', visit_date) AS DATE) AS visit_month, diagnosis,
         count(*) AS visits, sum(CAST(billing_amount AS DECIMAL(28,6))) AS total
  FROM kept GROUP BY ALL
)""",
        """
calendar AS (
  SELECT CAST(unnest(generate_series(min(visit_month), max(visit_month), INTERVAL 1 MONTH))
              AS DATE) AS visit_month FROM months
)""",
        """
whole AS (
  SELECT c.visit_month, g.diagnosis, coalesce(visits, 0) AS visits, coalesce(total, 0) AS total
  FROM calendar AS c CROSS JOIN (SELECT DISTINCT diagnosis FROM months) AS g
  LEFT JOIN months AS m ON m.visit_month = c.visit_month AND m.diagnosis = g.diagnosis
)""",
        select="""
SELECT visit_month, diagnosis, visits,
       round(CAST(total AS DOUBLE), 2) AS total_billing,
       CAST(sum(visits) OVER recent AS BIGINT) AS trailing_visits,
       round(CAST(sum(total) OVER recent AS DOUBLE), 2) AS trailing_billing,
       round(CAST(total - lag(total, 12) OVER months AS DOUBLE), 2) AS change_on_year
FROM whole
WINDOW months AS (PARTITION BY diagnosis ORDER BY visit_month),
       recent AS (PARTITION BY diagnosis ORDER BY visit_month ROWS 2 PRECEDING)""",
    ),
    "profile_range": _with(
        VISITS,
        select="""
SELECT count(*) AS rows, count(*) FILTER (patient_id IS NULL) AS null_patient_id,
       count(*) FILTER (diagnosis IS NULL) AS null_diagnosis,
       min(billing_amount) AS least, max(billing_amount) AS greatest, TRUE AS near
FROM visits WHERE visit_date BETWEEN DATE '1996-06-15' AND DATE '1999-06-14'""",
    ),
    "evolution_types": _with(
        VISITS,
        select="""
SELECT * REPLACE (
  CASE WHEN visit_date > DATE '1998-01-01' THEN age + 0.5 ELSE age END::DOUBLE AS age)
FROM visits""",
    ),
    "sized_write_of_known_rows": """
SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users
FROM events GROUP BY event_type""",
    "incremental_fold": _with(*_TO_RANKED, select="SELECT * FROM ranked"),
    "gold_from_changes": _with(*_TO_RANKED, select="SELECT * FROM ranked"),
    "ingest_twice": _with(VISITS, select="SELECT * FROM visits"),
    "trend_monthly": _with(
        *_TO_CLEAN,
        select="""
SELECT CAST(date_trunc('month', visit_date) AS DATE) AS visit_month, diagnosis,
       count(*) AS visits, round(sum(billing_amount), 2) AS total_billing
FROM clean GROUP BY 1, 2""",
    ),
    "stream_bronze": _with(VISITS, select="SELECT * FROM visits"),
}
