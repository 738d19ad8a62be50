"""Views over the star schema in the shapes that the operators take, as SQL for Spark and for DuckDB.

Every function returns a SELECT whose tables are plain names; ``read`` runs it on Spark, an oracle embeds it as a CTE.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")


def day(x: str, duck: bool = False) -> str:
    """Days since 1970-01-01 of a date expression."""
    return f"CAST(({x}) - DATE '1970-01-01' AS BIGINT)" if duck else f"CAST(unix_date({x}) AS BIGINT)"


def read(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL over the tables of a folder; each named table is a scan of its own file."""
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sf := sql)]
    for t in used:
        sf = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sf)
    return spark.sql(sf, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def history_brand(duck: bool = False) -> str:
    return """SELECT p_brand AS name, CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS downloads
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, CAST(l_shipdate AS DATE)"""


def history_supplier(duck: bool = False) -> str:
    return """SELECT concat('s', CAST(l_suppkey AS VARCHAR(20))) AS name, CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS downloads
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)"""


def history_event(duck: bool = False) -> str:
    return """SELECT event_type AS name, CAST(ts AS DATE) AS date, count(*) AS downloads FROM events GROUP BY event_type, CAST(ts AS DATE)"""


def history_user(duck: bool = False) -> str:
    return """SELECT concat('u', CAST(user_id AS VARCHAR(20))) AS name, CAST(ts AS DATE) AS date, count(*) AS downloads
FROM events GROUP BY user_id, CAST(ts AS DATE)"""


def history_named(duck: bool = False) -> str:
    return """SELECT s_name AS name, CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS downloads
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_name, CAST(l_shipdate AS DATE)"""


def _state_direct() -> str:
    """Figures of each supplier at each month-end from all its lines up to then, joined by range (DuckDB)."""
    d, m = day("l.sd", True), day("m.m", True)
    return f"""  SELECT l.l_suppkey, m.m, count(*) AS lines, count(DISTINCT l.l_orderkey) AS orders, count(DISTINCT l.l_partkey) AS parts,
    CAST(nullif(sum(CASE WHEN {m} - {d} < 7 THEN l.l_quantity ELSE 0 END), 0) AS BIGINT) AS downloads_7d,
    CAST(nullif(sum(CASE WHEN {m} - {d} < 28 THEN l.l_quantity ELSE 0 END), 0) AS BIGINT) AS downloads_28d,
    CAST(sum(CASE WHEN {m} - {d} >= 28 AND {m} - {d} < 56 THEN l.l_quantity ELSE 0 END) AS BIGINT) AS prev_28d,
    CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS open_issues,
    CAST(sum(CASE WHEN l.l_returnflag = 'N' AND {m} - {d} < 7 THEN 1 ELSE 0 END) AS BIGINT) AS prs_merged_7d,
    CAST(sum(CASE WHEN l.l_returnflag = 'R' AND {m} - {d} < 7 THEN 1 ELSE 0 END) AS BIGINT) AS issues_opened_7d,
    max(CASE WHEN l.l_quantity = 50 THEN {d} END) AS last_release, min(CASE WHEN l.l_quantity = 50 THEN {d} END) AS first_release,
    CAST(sum(CASE WHEN l.l_quantity = 50 THEN 1 ELSE 0 END) AS BIGINT) AS version_count,
    CAST(sum(CASE WHEN l.l_quantity <= 5 AND l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS vuln_count,
    CAST(sum(CASE WHEN l.l_quantity <= 5 AND l.l_returnflag = 'R' AND {m} - {d} <= 14 THEN 1 ELSE 0 END) AS BIGINT) AS vuln_new_14d,
    CAST(sum(CASE WHEN l.l_quantity <= 5 AND l.l_returnflag = 'R' AND {m} - {d} <= 28 THEN 1 ELSE 0 END) AS BIGINT) AS vuln_new_28d,
    max(CASE WHEN l.l_quantity = 1 AND l.l_returnflag = 'R' THEN l.l_linenumber END) AS worst
  FROM (SELECT *, CAST(l_shipdate AS DATE) AS sd FROM lineitem) l
  JOIN (SELECT DISTINCT last_day(CAST(l_shipdate AS DATE)) AS m FROM lineitem) m ON l.sd <= m.m
  GROUP BY l.l_suppkey, m.m"""


def _state_cumulated() -> str:
    """The same figures on Spark: lines aggregate once per (supplier, month), windows cumulate.

    A line counts in its own month and, for the recent sums, in the next one: 56 days before a month-end never reach
    further back. An order or part counts in the month in which its supplier first had it.
    """
    age = "unix_date(m) - d"
    return f"""WITH l AS (SELECT l_suppkey, l_orderkey, l_partkey, l_quantity AS q, l_returnflag AS f, l_linenumber, unix_date(CAST(l_shipdate AS DATE)) AS d, last_day(CAST(l_shipdate AS DATE)) AS own FROM lineitem),
  per AS (SELECT l_suppkey, m, count_if(m = own) AS lines, sum(CASE WHEN {age} < 7 THEN q END) AS d7, sum(CASE WHEN {age} < 28 THEN q END) AS d28,
      sum(CASE WHEN {age} >= 28 AND {age} < 56 THEN q END) AS p28, count_if(m = own AND f = 'R') AS open_issues, count_if({age} < 7 AND f = 'N') AS prs, count_if({age} < 7 AND f = 'R') AS issues,
      max(CASE WHEN m = own AND q = 50 THEN CAST(d AS BIGINT) END) AS last_release, min(CASE WHEN m = own AND q = 50 THEN CAST(d AS BIGINT) END) AS first_release, count_if(m = own AND q = 50) AS versions,
      count_if(m = own AND q <= 5 AND f = 'R') AS vulns, count_if({age} <= 14 AND q <= 5 AND f = 'R') AS v14, count_if({age} <= 28 AND q <= 5 AND f = 'R') AS v28,
      max(CASE WHEN m = own AND q = 1 AND f = 'R' THEN l_linenumber END) AS worst
    FROM (SELECT *, explode(array(own, last_day(add_months(own, 1)))) AS m FROM l) GROUP BY l_suppkey, m),
  fo AS (SELECT l_suppkey, m, count(*) AS n FROM (SELECT l_suppkey, min(own) AS m FROM l GROUP BY l_suppkey, l_orderkey) GROUP BY l_suppkey, m),
  fp AS (SELECT l_suppkey, m, count(*) AS n FROM (SELECT l_suppkey, min(own) AS m FROM l GROUP BY l_suppkey, l_partkey) GROUP BY l_suppkey, m),
  months AS (SELECT DISTINCT m FROM per WHERE lines > 0),
  life AS (SELECT l_suppkey, trunc(min(m), 'MM') AS first FROM per WHERE lines > 0 GROUP BY l_suppkey),
  days AS (SELECT l_suppkey, explode(sequence(first, (SELECT max(m) FROM months), INTERVAL 1 MONTH)) AS day FROM life),
  grid AS (SELECT l_suppkey, last_day(day) AS m FROM days)
  SELECT l_suppkey, m, sum(coalesce(lines, 0)) OVER w AS lines, sum(coalesce(fo.n, 0)) OVER w AS orders, sum(coalesce(fp.n, 0)) OVER w AS parts,
    CAST(nullif(d7, 0) AS BIGINT) AS downloads_7d, CAST(nullif(d28, 0) AS BIGINT) AS downloads_28d, CAST(coalesce(p28, 0) AS BIGINT) AS prev_28d,
    sum(coalesce(open_issues, 0)) OVER w AS open_issues, coalesce(prs, 0) AS prs_merged_7d, coalesce(issues, 0) AS issues_opened_7d,
    max(last_release) OVER w AS last_release, min(first_release) OVER w AS first_release, sum(coalesce(versions, 0)) OVER w AS version_count,
    sum(coalesce(vulns, 0)) OVER w AS vuln_count, coalesce(v14, 0) AS vuln_new_14d, coalesce(v28, 0) AS vuln_new_28d, max(worst) OVER w AS worst
  FROM grid LEFT SEMI JOIN months USING (m) LEFT JOIN per USING (l_suppkey, m) LEFT JOIN fo USING (l_suppkey, m) LEFT JOIN fp USING (l_suppkey, m)
  WINDOW w AS (PARTITION BY l_suppkey ORDER BY m)"""


def snapshots(duck: bool = False) -> str:
    """One row per supplier and month-end, from that supplier's lines up to then (see FIXTURES.md, V4)."""
    return f"""SELECT CAST(year(x.m) * 100 + month(x.m) AS VARCHAR(6)) AS run_id, x.m AS snapshot_date, s_name AS name, r_name AS category,
  CASE WHEN x.l_suppkey % 3 = 0 THEN NULL ELSE concat('org', CAST(x.l_suppkey % 10 AS VARCHAR(4)), '/', s_name) END AS repo,
  x.downloads_7d, x.downloads_28d, x.prev_28d, CAST(x.orders AS BIGINT) AS stars, x.lines AS forks, x.open_issues,
  x.prs_merged_7d, x.issues_opened_7d,
  CASE WHEN x.l_suppkey % 7 = 0 THEN NULL ELSE ((x.l_suppkey * 7 + year(x.m) * 12 + month(x.m)) % 11) / 10.0E0 END AS bus_factor,
  CASE WHEN x.l_suppkey % 11 = 0 THEN NULL ELSE s_acctbal < 0 END AS archived,
  x.parts AS dependent_packages_count, 5 * x.orders AS dependent_repos_count, CAST(NULL AS DOUBLE) AS rank_average,
  CASE WHEN s_nationkey = 0 THEN 'removed' END AS status, x.version_count,
  CAST({day('x.m', duck)} - x.last_release AS DOUBLE) AS days_since_last_release,
  CASE WHEN x.version_count > 1 THEN (x.last_release - x.first_release) / CAST(x.version_count - 1 AS DOUBLE) END AS release_cadence_days,
  CAST(NULL AS DOUBLE) AS dependency_count, CAST(NULL AS DOUBLE) AS commit_count_4w,
  CASE WHEN x.l_suppkey % 5 = 0 THEN NULL ELSE CAST((x.l_suppkey * 3) % 11 AS DOUBLE) END AS scorecard_overall,
  x.vuln_count, x.vuln_new_14d, x.vuln_new_28d,
  CASE WHEN x.worst IS NULL THEN NULL WHEN x.worst <= 2 THEN 'LOW' WHEN x.worst <= 4 THEN 'MODERATE' WHEN x.worst <= 6 THEN 'HIGH' ELSE 'CRITICAL' END AS max_severity,
  CAST(x.m AS TIMESTAMP) AS ingested_at
FROM ({_state_direct() if duck else _state_cumulated()}) x
JOIN supplier ON s_suppkey = x.l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""


def _risk(prefix: str = "") -> str:
    """The composite score as a SQL expression over a snapshot row."""
    p = prefix
    return f"""round((least(coalesce({p}vuln_new_28d, 0) * 0.5E0, 1.0E0) * (0.5E0 + coalesce(CASE {p}max_severity WHEN 'CRITICAL' THEN 1.0E0 WHEN 'HIGH' THEN 0.7E0
    WHEN 'MODERATE' THEN 0.4E0 WHEN 'LOW' THEN 0.2E0 END, 0.0E0) / 2) * 0.24E0
  + CASE WHEN {p}days_since_last_release IS NULL THEN 0.3E0 ELSE least(greatest(({p}days_since_last_release - 30) / 335, 0.0E0), 1.0E0) END * 0.20E0
  + coalesce(1 - {p}bus_factor, 0.4E0) * 0.18E0 + coalesce(1 - {p}scorecard_overall / 10, 0.35E0) * 0.16E0
  + CASE WHEN coalesce({p}archived, false) OR coalesce({p}status, '') <> '' THEN 1.0E0 ELSE 0.0E0 END * 0.12E0
  + CASE WHEN {p}issues_opened_7d + {p}prs_merged_7d <> 0 THEN {p}issues_opened_7d / CAST({p}issues_opened_7d + {p}prs_merged_7d AS DOUBLE) ELSE 0.3E0 END * 0.10E0) * 100, 1)"""


def predictions(duck: bool = False) -> str:
    """One scored row per snapshot: composite risk, momentum from the log change of 28-day sums, reasons as JSON text."""
    return f"""SELECT run_id, CAST(snapshot_date AS TIMESTAMP) AS predicted_at, name, category, momentum_score, risk_score,
  growth AS growth_pred_70d,
  CASE WHEN momentum_score >= 66 THEN 'high' WHEN momentum_score <= 40 THEN 'declining' ELSE 'normal' END AS momentum_label,
  CASE WHEN risk_score >= 66 THEN 'high' WHEN risk_score >= 40 THEN 'medium' ELSE 'low' END AS risk_level,
  concat('["', CASE WHEN growth >= 0 THEN 'monthly downloads rising' ELSE 'monthly downloads falling' END, '", "',
         CASE WHEN risk_score >= 40 THEN 'elevated risk' ELSE 'steady upkeep' END, '"]') AS top_reasons
FROM (SELECT *, round(100 / (1 + exp(-3.0E0 * growth)), 1) AS momentum_score
  FROM (SELECT *, round(ln((coalesce(downloads_28d, 0) + 1) / CAST(prev_28d + 1 AS DOUBLE)), 4) AS growth, {_risk()} AS risk_score
    FROM ({snapshots(duck)}) q0) q1) q2"""


def model_runs(duck: bool = False) -> str:
    """Metric rows of two models per month, champions by running maximum, some without a value."""
    return f"""SELECT run_id, model_name, trained_at, concat(model_name, '-', run_id) AS version, metric_name,
  CASE WHEN CAST(run_id AS INT) % 7 = 3 THEN CAST('NaN' AS DOUBLE) ELSE metric_value END AS metric_value,
  CASE WHEN CAST(run_id AS INT) % 7 = 3 THEN false
    ELSE metric_value > coalesce(max(metric_value) OVER (PARTITION BY model_name ORDER BY run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0E0) END AS is_champion,
  CASE WHEN model_name = 'risk' AND CAST(run_id AS INT) % 4 = 0 THEN '' ELSE concat('models/', model_name, '-', run_id) END AS gcs_uri,
  n_train
FROM (
  SELECT run_id, 'growth' AS model_name, max(predicted_at) AS trained_at, 'spearman' AS metric_name, round(avg(momentum_score) / 100, 6) AS metric_value, count(*) AS n_train
  FROM ({predictions(duck)}) a GROUP BY run_id
  UNION ALL
  SELECT run_id, 'risk' AS model_name, max(predicted_at) AS trained_at, 'auc' AS metric_name, round(avg(risk_score) / 100, 6) AS metric_value, count(*) AS n_train
  FROM ({predictions(duck)}) b GROUP BY run_id) u"""


def binary(duck: bool = False) -> str:
    return """SELECT CAST(d.doc_id AS VARCHAR(20)) AS name, l.toxic AS label, (d.n_chars % 97) / 97.0E0 AS score
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def requirements(duck: bool = False) -> str:
    """One requirement text per brand: pins, comments, flags, URLs and markers by rule (see FIXTURES.md, V7)."""
    line = """CASE WHEN p_partkey % 13 = 0 THEN concat('# ', p_name) WHEN p_partkey % 17 = 0 THEN concat('-r ', p_name, '.txt')
    WHEN p_partkey % 19 = 0 THEN concat('git+https://github.com/org/', replace(p_name, ' ', '_'))
    WHEN p_partkey % 3 = 0 THEN concat(replace(p_name, ' ', '_'), '==', CAST(p_size AS VARCHAR(10)), '.0')
    WHEN p_partkey % 5 = 0 THEN concat(replace(p_name, ' ', '_'), '[extra] >= 1.0 ; python_version < ''4''  # why')
    ELSE concat('  ', replace(p_name, ' ', '-')) END"""
    lines = f"string_agg({line}, chr(10) ORDER BY p_partkey)" if duck else f"array_join(transform(array_sort(collect_list(struct(p_partkey, {line} AS t))), x -> x.t), '\\n')"
    return f"SELECT p_brand AS doc, {lines} AS text FROM part GROUP BY p_brand"


def scored(duck: bool = False) -> str:
    """Held-out style rows (name, t, y, persistence, yhat): monthly growth of each supplier, damped persistence as forecast."""
    return f"""SELECT name, snapshot_date AS t, y, persistence, 0.1E0 + 0.4E0 * persistence AS yhat
FROM (SELECT name, snapshot_date, g AS y, lag(g) OVER (PARTITION BY name ORDER BY snapshot_date) AS persistence
  FROM (SELECT name, snapshot_date, round(ln((coalesce(downloads_28d, 0) + 1) / CAST(prev_28d + 1 AS DOUBLE)), 6) AS g
    FROM ({snapshots(duck)}) s0) s1) s2 WHERE persistence IS NOT NULL"""
