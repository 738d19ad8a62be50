"""Queries of the dependency audit and of the daily-series diagnostics and forecasts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.columns import lookup
from seriesforge.operators import audit as G
from seriesforge.operators import forecast as K
from seriesforge.operators.stats import diebold_mariano, dm_by_horizon
from seriesforge.plans import fixtures as X
from seriesforge.plans.model_queries import _P, _dm
from seriesforge.plans.registry import query, rounded
from seriesforge.plans.series_queries import brand

_REQ = f"rq AS ({X.requirements(True)})"
_WS = r"'^\s+|\s+$'"
_DEPS = rf"""{_REQ}, ln AS (SELECT doc, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM rq),
l2 AS (SELECT doc, pos, regexp_replace(split_part(raw, '#', 1), {_WS}, '', 'g') AS line FROM ln), l3 AS (SELECT doc, pos, regexp_replace(split_part(line, ';', 1), {_WS}, '', 'g') AS spec FROM l2 WHERE line <> '' AND NOT starts_with(line, '-') AND NOT contains(line, '://')),
l4 AS (SELECT doc, pos, replace(lower(regexp_extract(spec, '^([A-Za-z0-9][A-Za-z0-9._-]*)', 1)), '_', '-') AS name, nullif(regexp_extract(spec, '==\s*([A-Za-z0-9][A-Za-z0-9._!+-]*)', 1), '') AS version FROM l3 WHERE regexp_matches(spec, '^[A-Za-z0-9]')),
deps AS MATERIALIZED (SELECT doc, name, version, pos FROM (SELECT *, row_number() OVER (PARTITION BY doc, name ORDER BY pos) AS rn FROM l4) WHERE rn = 1)"""

PACKAGES = "SELECT replace(lower(p_name), ' ', '-') AS name, min(p_partkey) AS k FROM part GROUP BY replace(lower(p_name), ' ', '-')"
_KNOWN = f"""kn AS (SELECT name, CASE WHEN k % 4 <> 0 THEN ((k * 7) % 100)::DOUBLE END AS stored_risk, ((k * 3) % 80)::DOUBLE AS composite, k % 29 = 0 AS archived, ((k * 13) % 500)::DOUBLE AS days_since_last_release FROM ({PACKAGES}) WHERE k % 6 <> 0)"""
_TREND = "td AS (SELECT name, CASE WHEN k % 5 = 0 THEN NULL ELSE ((k % 60) - 30)::DOUBLE END AS trend_pct FROM (" + PACKAGES + "))"
ADVISORIES = """SELECT replace(lower(p_name), ' ', '-') AS package, l_orderkey, l_linenumber, l_orderkey % 2 AS odd, p_size FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' AND l_quantity <= 2"""
_ADV = f"""ad AS (SELECT package AS name, CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2 WHEN l_linenumber <= 6 THEN 3 ELSE 4 END AS severity_rank, CASE WHEN odd = 0 THEN [p_size || '.0', '0.2'] ELSE ['0.1'] END AS av FROM ({ADVISORIES})),
ex AS (SELECT d.doc, d.name, d.version, d.pos, count(ad.name) AS vuln_count, max(severity_rank) AS severity_rank, CASE WHEN version IS NOT NULL THEN 'active' ELSE 'historical' END AS vuln_kind
FROM deps d LEFT JOIN ad ON ad.name = d.name AND (d.version IS NULL OR list_contains(av, d.version)) GROUP BY ALL)"""
_SEV = "CASE severity_rank WHEN 1 THEN 'LOW' WHEN 2 THEN 'MODERATE' WHEN 3 THEN 'HIGH' WHEN 4 THEN 'CRITICAL' END"
_AUD = f"""{_DEPS}, {_ADV}, {_KNOWN}, {_TREND}, j AS (SELECT ex.*, kn.name IS NOT NULL AS known, coalesce(stored_risk, composite) AS risk_score, archived, days_since_last_release AS dd, trend_pct, coalesce({_SEV}, '') AS sev FROM ex LEFT JOIN kn USING (name) LEFT JOIN td USING (name)),
au AS (SELECT doc, name, version, vuln_count, vuln_kind, risk_score, CASE WHEN NOT known THEN 'unknown' WHEN archived THEN 'critical' WHEN vuln_kind = 'active' AND vuln_count > 0 AND sev IN ('HIGH', 'CRITICAL') THEN 'critical' WHEN vuln_kind = 'active' AND vuln_count > 0 THEN 'high' WHEN risk_score >= 66 THEN 'high'
WHEN dd > 365 OR coalesce(trend_pct, 0) < -20 OR (vuln_kind = 'historical' AND vuln_count > 0) OR risk_score >= 40 THEN 'watch' ELSE 'healthy' END AS verdict,
CASE WHEN NOT known THEN 'not tracked' WHEN archived THEN 'archived / removed upstream' WHEN vuln_kind = 'active' AND vuln_count > 0 AND sev IN ('HIGH', 'CRITICAL') THEN 'pinned version exposed to ' || vuln_count || ' ' || lower(sev) || ' vuln' || CASE WHEN vuln_count = 1 THEN '' ELSE 's' END
WHEN vuln_kind = 'active' AND vuln_count > 0 THEN 'pinned version exposed to ' || vuln_count || ' known vuln' || CASE WHEN vuln_count = 1 THEN '' ELSE 's' END WHEN risk_score >= 66 THEN 'high composite maintenance risk' WHEN dd > 365 THEN 'no release in ' || dd::INT || ' days'
WHEN coalesce(trend_pct, 0) < -20 THEN 'downloads down ' || abs(trend_pct)::INT || '% week-over-week' WHEN vuln_kind = 'historical' AND vuln_count > 0 THEN vuln_count || ' historical CVEs — pin a version to check exposure' WHEN risk_score >= 40 THEN 'elevated maintenance risk' ELSE 'actively maintained' END AS reason FROM j)"""


def deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.parse_requirements(X.read(spark, sf_dir, X.requirements()))


def exposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = X.read(spark, sf_dir, ADVISORIES)
    n = F.col("l_linenumber")
    rank = F.when(n <= 2, 1).when(n <= 4, 2).when(n <= 6, 3).otherwise(4)
    versions = F.when(F.col("odd") == 0, F.array(F.concat(F.col("p_size").cast("string"), F.lit(".0")), F.lit("0.2"))).otherwise(F.array(F.lit("0.1")))
    return G.exposure(deps(spark, sf_dir), a.select(F.col("package").alias("name"), rank.alias("severity_rank"), versions.alias("affected_versions")))


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    packages = X.read(spark, sf_dir, PACKAGES)
    known = packages.filter("k % 6 <> 0").select(
        "name", F.when(k % 4 != 0, (k * 7 % 100).cast("double")).alias("stored_risk"), (k * 3 % 80).cast("double").alias("composite"), (k % 29 == 0).alias("archived"),
        (k * 13 % 500).cast("double").alias("days_since_last_release"),
    )
    trends = packages.select("name", F.when(k % 5 != 0, (k % 60 - 30).cast("double")).alias("trend_pct"))
    e = exposed(spark, sf_dir).withColumn("max_severity", lookup("severity_rank", {1: "LOW", 2: "MODERATE", 3: "HIGH", 4: "CRITICAL"}))
    return G.audit(e, known, trends)


@query(f"WITH {_DEPS} SELECT doc, name, version FROM deps")
def g1_parse_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deps(spark, sf_dir).select("doc", "name", "version")


@query("SELECT p_partkey, replace(lower(trim(p_name)), '_', '-') AS name FROM part")
def g2_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return p.select("p_partkey", G.normalise(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"))


@query("""SELECT p_brand AS doc, replace(lower(p_name), ' ', '-') AS name, CASE WHEN bool_or(p_partkey % 3 = 0 AND f) THEN max(p_size) FILTER (f) || '.0' END AS version
FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, replace(lower(p_name), ' ', '-') ORDER BY p_partkey % 4 = 3, p_partkey) = 1 AS f FROM part) GROUP BY 1, 2""")
def g3_parse_pyproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    under = F.translate("p_name", " ", "_")
    spec = F.concat(F.lit("  \""), under, F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("=="), F.col("p_size").cast("string"), F.lit(".0"))).otherwise(F.lit(">=1")), F.lit("\","))
    rows = p.groupBy(F.col("p_brand").alias("doc"), (F.col("p_partkey") % 4 == 3).alias("extra")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", spec.alias("s")))), lambda x: x["s"]), "\n").alias("body")
    )
    both = rows.groupBy("doc").agg(F.max(F.when(~F.col("extra"), F.col("body"))).alias("a"), F.max(F.when(F.col("extra"), F.col("body"))).alias("b"))
    text = F.concat(F.lit("[project]\ndependencies = [\n"), F.coalesce("a", F.lit("")), F.lit("\n]\n[project.optional-dependencies]\nmore = [\n"), F.coalesce("b", F.lit("")), F.lit("\n]\n[tool.poetry.dependencies]\nPython = \"^3\"\n"))
    return G.parse_pyproject(both.select("doc", text.alias("text"))).select("doc", "name", "version")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE 'Org' || s_suppkey % 7 || '/repo.' || s_suppkey END AS slug FROM supplier")
def g4_repo_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    slug = F.concat(F.lit("Org"), (k % 7).cast("string"), F.lit("/repo."), k.cast("string"))
    url = F.when(k % 4 == 0, F.concat(F.lit("https://github.com/"), slug, F.lit(".git"))).when(k % 4 == 1, F.concat(F.lit(" git@github.com:"), slug, F.lit("/ "))).when(k % 4 == 2, slug).otherwise("nothing")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", G.repo_slug(url).alias("slug"))


_FILES = "fl AS (SELECT doc, name, version, pos, CASE WHEN doc LIKE '%1' THEN 'master' ELSE 'main' END AS branch, CASE WHEN pos % 2 = 0 THEN 'requirements.txt' ELSE 'reqs.txt' END AS path FROM deps)"


@query(f"""WITH {_DEPS}, {_FILES}, pr(branch, path, rank) AS (VALUES ('main', 'requirements.txt', 2), ('main', 'reqs.txt', 1), ('master', 'requirements.txt', 3), ('master', 'reqs.txt', 4)),
r AS (SELECT fl.*, rank FROM fl JOIN pr USING (branch, path)) SELECT doc AS repo, branch, path, name, version FROM r WHERE rank = (SELECT min(rank) FROM r q WHERE q.doc = r.doc)""")
def g5_choose_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = deps(spark, sf_dir).select(
        F.col("doc").alias("repo"), F.when(F.col("doc").endswith("1"), "master").otherwise("main").alias("branch"),
        F.when(F.col("pos") % 2 == 0, "requirements.txt").otherwise("reqs.txt").alias("path"), "name", "version",
    )
    ranks = [("main", "requirements.txt", 2), ("main", "reqs.txt", 1), ("master", "requirements.txt", 3), ("master", "reqs.txt", 4)]
    return G.choose_file(d, spark.createDataFrame(ranks, "branch string, path string, rank int")).select("repo", "branch", "path", "name", "version")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY date DESC) AS r FROM ({X.history_user()}))
SELECT name, CASE WHEN count(*) = 14 AND sum(downloads) FILTER (r > 7) > 0 THEN round((sum(downloads) FILTER (r <= 7) / sum(downloads) FILTER (r > 7) - 1) * 100, 1) END AS trend_pct FROM r WHERE r <= 14 GROUP BY name""")
def g6_week_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.week_trend(X.read(spark, sf_dir, X.history_user()))


@query(f"WITH {_DEPS}, {_ADV} SELECT doc, name, version, vuln_count, severity_rank, vuln_kind FROM ex")
def g7_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exposed(spark, sf_dir).select("doc", "name", "version", "vuln_count", "severity_rank", "vuln_kind")


@query(f"WITH {_AUD} SELECT doc, name, version, vuln_count, vuln_kind, risk_score, verdict, reason FROM au")
def g8_audit_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir).select("doc", "name", "version", "vuln_count", "vuln_kind", "risk_score", "verdict", "reason")


@query(f"WITH {_AUD} SELECT verdict, count(*) AS n, count(risk_score) AS with_risk FROM au GROUP BY verdict")
def g9_known_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir).groupBy("verdict").agg(F.count("*").alias("n"), F.count("risk_score").alias("with_risk"))


@query(f"""WITH {_AUD} SELECT doc, count(*) AS audited, count(*) FILTER (vuln_kind = 'active' AND vuln_count > 0) AS exposed, {', '.join(f"count(*) FILTER (verdict = '{v}') AS {v}" for v in G.VERDICTS)} FROM au GROUP BY doc""")
def g10_audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.audit_summary(audited(spark, sf_dir), ["doc"])


@query(f"WITH {_AUD} SELECT doc, name, verdict, risk_score FROM au")
def g11_audit_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.audit_order(audited(spark, sf_dir)).select("doc", "name", "verdict", "risk_score")


@query(f"WITH {_DEPS} SELECT name, version, doc AS file FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc, pos) AS rn FROM deps) WHERE rn = 1")
def g12_first_file_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.first_wins(deps(spark, sf_dir).select("name", "version", "pos", F.col("doc").alias("file"), F.col("doc").alias("file_order")))


_K = f"""kh AS (SELECT name, date, ln(1 + downloads::DOUBLE) AS y FROM ({X.history_brand()})), ks AS MATERIALIZED (SELECT name, row_number() OVER (PARTITION BY name ORDER BY date) - 1 AS i, y, count(*) OVER (PARTITION BY name) AS n
FROM kh WHERE name IN (SELECT name FROM kh GROUP BY name HAVING count(*) >= 90 AND stddev_pop(y) > 0))"""


def admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.admit(brand(spark, sf_dir))


@query(f"WITH {_K} SELECT name, i, round(y, 6) AS y FROM ks")
def k1_admitted_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(admitted(spark, sf_dir)).select("name", F.col("i").cast("bigint").alias("i"), "y")


def _chi2(x: str, dof: int) -> str:
    """Upper chi-square tail in DuckDB by the series of the lower one."""
    return f"CASE WHEN {x} > 400 THEN 0 ELSE 1 - list_sum(list_transform(range(0, 700), lambda k: exp(({dof} / 2 + k) * ln(greatest({x}, 1e-12) / 2) - {x} / 2 - lgamma({dof} / 2 + k + 1)))) END"


def _acf(lags: int, src: str = "ks", v: str = "y") -> str:
    return f"""ac0 AS (SELECT name, i, {v} - avg({v}) OVER (PARTITION BY name) AS c, count(*) OVER (PARTITION BY name) AS n FROM {src}),
ac AS (SELECT a.name, a.n, b.i - a.i AS lag, sum(a.c * b.c) / (SELECT sum(c * c) FROM ac0 z WHERE z.name = a.name) AS rho FROM ac0 a JOIN ac0 b ON a.name = b.name AND b.i - a.i BETWEEN 1 AND {lags} GROUP BY a.name, a.n, b.i - a.i)"""


#: Lags that the SQL of the unit-root test can hold: enough for series of 3,900 days.
_LAGS = 30


def _swept(src: str, first: str, xs: list[str], keep: str = "") -> str:
    """Rows of src from place ``first`` on, xs swept out of v (and of ``keep``) series by series; s0, s1, ...: squares of v left after so many."""
    w = "WINDOW w AS (PARTITION BY name)"
    rest = [*xs, *([keep] if keep else []), "v"]
    sql = f"SELECT name, k, m, {', '.join(f'{c} - avg({c}) OVER w AS {c}' for c in rest)} FROM (SELECT *, count(*) OVER w AS m FROM {src} WHERE j >= {first} {w}) {w}"
    for n, x in enumerate(xs):
        told = "".join(f", s{i}" for i in range(n)) + f", sum(v * v) OVER w AS s{n}"
        left = ", ".join(f"{c} - {x} * coalesce(sum({c} * {x}) OVER w / nullif(sum({x} * {x}) OVER w, 0), 0) AS {c}" for c in rest[n + 1 :])
        sql = f"SELECT name, k, m{told}, {left} FROM ({sql}) {w}"
    return sql


def _adf_sql(tag: str, src: str, trend: bool) -> str:
    """CTE ``{tag}``: (name, stat, lag). The lag order is that of the least criterion over the rows that all orders share."""
    lags, line = [f"d{i}" for i in range(1, _LAGS + 1)], ["tt"] if trend else []
    held = ", ".join(f"CASE WHEN k >= {i} THEN d{i} ELSE 0 END AS d{i}" for i in range(1, _LAGS + 1))
    held += ", j::DOUBLE AS tt" if trend else ""
    own = 2 + len(line)
    order = ", ".join(f"{{'a': CASE WHEN k >= {i} THEN m * ln(greatest(s{own - 1 + i}, 1e-300) / m) + {2 * (own + i)} END, 'k': {i}}}" for i in range(_LAGS))
    return f"""{tag}0 AS (SELECT name, row_number() OVER w - 1 AS j, count(*) OVER (PARTITION BY name) AS n, y AS x0, lead(y) OVER w - y AS v FROM {src} WINDOW w AS (PARTITION BY name ORDER BY i)),
{tag}1 AS MATERIALIZED (SELECT *, least(ceil(12 * pow(n / 100, 0.25))::INT, n // 2 - 3) AS k, {', '.join(f'coalesce(lag(v, {i}) OVER w, 0) AS d{i}' for i in range(1, _LAGS + 1))} FROM {tag}0 WINDOW w AS (PARTITION BY name ORDER BY j)),
{tag}2 AS (SELECT name, j, k, x0, v, {held} FROM {tag}1 WHERE v IS NOT NULL), {tag}3 AS (SELECT DISTINCT ON (name) * FROM ({_swept(tag + '2', 'k', [*line, 'x0', *lags])})),
{tag}4 AS (SELECT name, unnest([{order}]) AS o FROM {tag}3), {tag}5 AS (SELECT name, o.k AS k FROM {tag}4 WHERE o.a IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY o.a, o.k) = 1),
{tag}6 AS (SELECT name, j, k, x0, v, {held} FROM (SELECT a.* REPLACE (b.k AS k) FROM {tag}1 a JOIN {tag}5 b ON b.name = a.name) WHERE v IS NOT NULL),
{tag}7 AS (SELECT name, any_value(k) AS k, any_value(m) AS m, sum(x0 * v) AS xv, sum(x0 * x0) AS xx, sum(v * v) AS vv FROM ({_swept(tag + '6', 'k', [*line, *lags], 'x0')}) GROUP BY name),
{tag} AS (SELECT name, k::INT AS lag, xv / xx / sqrt((vv - xv * xv / xx) / greatest(m - {own} - k, 1) / xx) AS stat FROM {tag}7)"""


def _unit_root_z(x: str, terms: str) -> str:
    """The normal deviate of the response surface; beyond its ends one whose tail is nothing."""
    least, turn, most, below, above = K.UNIT_ROOT[terms]
    low, high = (" + ".join(f"({b}) * pow({x}, {k})" for k, b in enumerate(c)) for c in (below, above))
    return f"CASE WHEN {x} > {most} THEN 40 WHEN {x} < {least} THEN -40 WHEN {x} <= {turn} THEN {low} ELSE {high} END"


def _below(z: str) -> str:
    both = re.sub(r"\bz\b", z, _P)
    return f"CASE WHEN {z} > 0 THEN 1 - ({both}) / 2 ELSE ({both}) / 2 END"


_ADF = f"""{_K}, kd AS (SELECT * FROM (SELECT name, i, lead(y) OVER (PARTITION BY name ORDER BY i) - y AS y FROM ks) WHERE y IS NOT NULL), {_adf_sql('uc', 'ks', False)}, {_adf_sql('ut', 'ks', True)}, {_adf_sql('ud', 'kd', False)},
uz AS MATERIALIZED (SELECT uc.name, uc.stat AS adf_c, uc.lag, ut.stat AS adf_ct, ud.stat AS adf_diff, {_unit_root_z('uc.stat', 'c')} AS z_c, {_unit_root_z('ut.stat', 'ct')} AS z_ct, {_unit_root_z('ud.stat', 'c')} AS z_diff
FROM uc JOIN ut ON ut.name = uc.name JOIN ud ON ud.name = uc.name),
ur AS MATERIALIZED (SELECT *, {', '.join(f'{_below(f"z_{c}")} AS p_{c}' for c in ('c', 'ct', 'diff'))} FROM uz)"""


@query(f"""WITH {_ADF} SELECT name, round(adf_c, 4) AS adf_c, lag, round(adf_ct, 4) AS adf_ct, round(adf_diff, 4) AS adf_diff, round(p_c, 4) AS p_c, round(p_ct, 4) AS p_ct, round(p_diff, 4) AS p_diff,
p_c < 0.05 AS rejects_c, p_ct < 0.05 AS rejects_ct, p_diff < 0.05 AS rejects_diff FROM ur""")
def k2_unit_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.adf(admitted(spark, sf_dir)), 4)


_KPSS = f"""{_K}, {_acf(7)}, cu AS (SELECT name, c, n, sum(c) OVER (PARTITION BY name ORDER BY i) AS s FROM ac0),
kp AS (SELECT u.name, sum(s * s) / (any_value(n) * any_value(n)) / (sum(c * c) * (1 + any_value(r)) / any_value(n)) AS stat FROM cu u JOIN (SELECT name, sum(2 * (1 - lag / 8) * rho) AS r FROM ac GROUP BY name) q ON q.name = u.name GROUP BY u.name)"""


@query(f"""WITH {_KPSS} SELECT name, round(stat, 5) AS stat, round(CASE WHEN stat <= 0.347 THEN 0.1 WHEN stat < 0.463 THEN 0.1 + (stat - 0.347) / (0.463 - 0.347) * (0.05 - 0.1) WHEN stat < 0.574 THEN 0.05 + (stat - 0.463) / (0.574 - 0.463) * (0.025 - 0.05)
WHEN stat < 0.739 THEN 0.025 + (stat - 0.574) / (0.739 - 0.574) * (0.01 - 0.025) ELSE 0.01 END, 5) AS p_value FROM kp""")
def k3_kpss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.kpss(admitted(spark, sf_dir), 7).select("name", "stat", "p_value"), 5)


_KPSS_AUTO = f"""{_acf(40)}, bw AS (SELECT a.name, any_value(n) AS n, 2 * sum(lag * rho) / (1 + 2 * sum(rho)) AS s FROM ac a WHERE lag <= floor(pow(n, 2 / 9)) GROUP BY a.name),
lg AS (SELECT name, n, floor(1.1447 * pow(s * s * n, 1 / 3))::INT AS lags FROM bw), cu AS (SELECT name, c, sum(c) OVER (PARTITION BY name ORDER BY i) AS s FROM ac0),
ka AS (SELECT lg.name, any_value(lags) AS lags, any_value(e.ss) / any_value(n) / any_value(n) / (any_value(e.c2) * (1 + coalesce(any_value(q.r), 0)) / any_value(n)) AS stat FROM lg
JOIN (SELECT name, sum(s * s) AS ss, sum(c * c) AS c2 FROM cu GROUP BY name) e ON e.name = lg.name
LEFT JOIN (SELECT ac.name, sum(2 * (1 - lag / (lags + 1)) * rho) AS r FROM ac JOIN lg g ON g.name = ac.name WHERE lag <= lags GROUP BY ac.name) q ON q.name = lg.name GROUP BY lg.name)"""


@query(f"WITH {_K}, {_KPSS_AUTO} SELECT name, lags, round(stat, 5) AS stat FROM ka")
def k3_kpss_automatic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The automatic bandwidth and the statistic under it."""
    s = admitted(spark, sf_dir)
    return rounded(K.automatic_bandwidth(s).join(K.kpss(s), "name").select("name", "lags", "stat"), 5)


@query(f"""WITH {_ADF}, {_KPSS_AUTO} SELECT name, CASE WHEN p_c < 0.05 AND stat <= 0.463 THEN 'stationary' WHEN p_c >= 0.05 AND stat > 0.463 THEN 'unit_root' WHEN p_c < 0.05 THEN 'conflict' ELSE 'inconclusive' END AS cell,
CASE WHEN p_c < 0.05 AND stat < 0.463 THEN 'I(0)' WHEN p_diff < 0.05 THEN 'I(1)' ELSE 'I(2)+' END AS integration FROM ur JOIN ka USING (name)""")
def k4_integration(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = admitted(spark, sf_dir)
    return K.integration(K.adf(s), K.kpss(s))


@query(f"WITH {_K}, {_acf(14)}, lb AS (SELECT name, any_value(n) * (any_value(n) + 2) * sum(rho * rho / (n - lag)) AS q FROM ac GROUP BY name) SELECT name, round(q, 4) AS q, round({_chi2('q', 14)}, 4) AS p_value FROM lb")
def k5_ljung_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.ljung_box(admitted(spark, sf_dir)), 4)


_DEC = f"""{_K}, tr AS (SELECT name, i, y, avg(y) OVER w AS trend, count(*) OVER w AS k FROM ks WINDOW w AS (PARTITION BY name ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
t7 AS (SELECT *, i % 7 AS ph FROM tr WHERE k = 7), sr AS (SELECT name, ph, avg(y - trend) AS raw FROM t7 GROUP BY name, ph), sn AS (SELECT name, ph, raw - avg(raw) OVER (PARTITION BY name) AS seasonal FROM sr),
de AS MATERIALIZED (SELECT t7.name, i, y, trend, seasonal, y - trend - seasonal AS resid FROM t7 JOIN sn ON sn.name = t7.name AND sn.ph = t7.ph), stg AS (SELECT name, greatest(0, 1 - var_pop(resid) / var_pop(resid + seasonal)) AS strength FROM de GROUP BY name)"""


@query(f"WITH {_DEC} SELECT name, i, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(resid, 6) AS resid FROM de")
def k6_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.decompose(admitted(spark, sf_dir)).select("name", F.col("i").cast("bigint").alias("i"), "trend", "seasonal", "resid"))


@query(f"WITH {_DEC} SELECT name, round(strength, 6) AS strength FROM stg")
def k6_seasonal_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.seasonal_strength(K.decompose(admitted(spark, sf_dir))))


def _regressed(src: str, xs: list[str], y: str = "v") -> str:
    """CTEs r0, r1, ...: centred columns, of which one regressor after another is swept out of those that follow and of y, series by series."""
    centred = ", ".join(f"{c} - avg({c}) OVER w AS {c}" for c in (*xs, y))
    steps = [f"r0 AS (SELECT name, {centred} FROM {src} WINDOW w AS (PARTITION BY name))"]
    for k, x in enumerate(xs):
        rest = ", ".join(f"{c} - {x} * coalesce(sum({c} * {x}) OVER w / nullif(sum({x} * {x}) OVER w, 0), 0) AS {c}" for c in (*xs[k + 1 :], y))
        steps.append(f"r{k + 1} AS (SELECT name, {rest} FROM r{k} WINDOW w AS (PARTITION BY name))")
    return ", ".join(steps)


_ARCH = f"""{_DEC}, sq AS (SELECT name, {', '.join(f'lag(resid * resid, {j}) OVER w AS x{j}' for j in range(1, 8))}, resid * resid AS v FROM de WINDOW w AS (PARTITION BY name ORDER BY i)),
sl AS (SELECT * FROM sq WHERE x7 IS NOT NULL), {_regressed('sl', [f'x{j}' for j in range(1, 8)])}, tot AS (SELECT name, count(*) AS n, sum(v * v) AS s FROM r0 GROUP BY name),
ar AS (SELECT tot.name, CASE WHEN any_value(s) > 0 THEN any_value(n) * (1 - sum(v * v) / any_value(s)) ELSE 0 END AS lm FROM tot JOIN r7 ON r7.name = tot.name GROUP BY tot.name)"""


@query(f"WITH {_ARCH} SELECT name, round(lm, 4) AS lm, round({_chi2('greatest(lm, 0)', 7)}, 4) AS p_value FROM ar")
def k7_arch_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.arch_lm(K.decompose(admitted(spark, sf_dir))), 4)


@query(f"""WITH {_DEC}, rs AS (SELECT name, i, resid AS y FROM de), {_acf(7, 'rs')}, lb AS (SELECT name, any_value(n) * (any_value(n) + 2) * sum(rho * rho / (n - lag)) AS q FROM ac GROUP BY name)
SELECT name, round(q, 4) AS q, round({_chi2('q', 7)}, 4) AS p_value FROM lb""")
def k5_ljung_box_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven lags of the remainder: an odd number of degrees of freedom."""
    return rounded(K.ljung_box(K.decompose(admitted(spark, sf_dir)), 7, "resid"), 4)


@query(f"""WITH {_DEC}, mo AS (SELECT name, resid - avg(resid) OVER (PARTITION BY name) AS e FROM de), mm AS (SELECT name, count(*) AS n, avg(e * e) AS m2, avg(e * e * e) AS m3, avg(e * e * e * e) AS m4 FROM mo GROUP BY name)
SELECT name, round(jb, 4) AS jb, round(exp(-jb / 2), 4) AS p_value FROM (SELECT name, n / 6 * (m3 * m3 / (m2 * m2 * m2) + (m4 / (m2 * m2) - 3) ** 2 / 4) AS jb FROM mm) j""")
def k8_jarque_bera(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.jarque_bera(K.decompose(admitted(spark, sf_dir))), 4)


@query()
def k9_diagnostics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.diagnostics_summary(admitted(spark, sf_dir))


_FC = f"""{_K}, fw AS MATERIALIZED (SELECT name, i, n, y, lead(y, 1) OVER o AS l1, lead(y, 3) OVER o AS l3, lead(y, 7) OVER o AS l7, lag(y, 6) OVER o AS g6, lag(y, 4) OVER o AS g4 FROM ks WINDOW o AS (PARTITION BY name ORDER BY i)),
fh AS (SELECT name, i, 1 AS h, l1 AS actual, y AS naive, g6 AS seasonal_naive FROM fw WHERE i >= 60 AND i < n - 7 UNION ALL SELECT name, i, 3, l3, y, g4 FROM fw WHERE i >= 60 AND i < n - 7 UNION ALL SELECT name, i, 7, l7, y, y FROM fw WHERE i >= 60 AND i < n - 7)"""


@query(f"WITH {_FC} SELECT name, i, h, round(actual - naive, 6) AS naive_error, round(actual - seasonal_naive, 6) AS seasonal_error FROM fh")
def k10_naive_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = K.origins(admitted(spark, sf_dir))
    return rounded(o.select("name", F.col("i").cast("bigint").alias("i"), "h", (F.col("actual") - F.col("naive")).alias("naive_error"), (F.col("actual") - F.col("seasonal_naive")).alias("seasonal_error")))


@query()
def k12_holt_winters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.holt_winters(admitted(spark, sf_dir))


_MASE = f"""{_FC}, scl AS (SELECT a.name, greatest(avg(abs(a.y - b.y)), 1e-9) AS scale FROM ks a JOIN ks b ON a.name = b.name AND b.i = a.i - 7 WHERE a.i <= 60 GROUP BY a.name),
ma AS (SELECT fh.name, h, count(*) AS n, avg(abs(actual - naive)) / any_value(scale) AS naive, avg(abs(actual - seasonal_naive)) / any_value(scale) AS seasonal_naive FROM fh JOIN scl ON scl.name = fh.name GROUP BY fh.name, h HAVING count(*) >= 20)"""


def naive_mase(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = admitted(spark, sf_dir)
    return K.mase(K.origins(s), K.scale(s), ("naive", "seasonal_naive"))


@query(f"WITH {_MASE} SELECT name, h, n, round(naive, 6) AS naive, round(seasonal_naive, 6) AS seasonal_naive FROM ma")
def k13_mase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(naive_mase(spark, sf_dir))


@query(f"""WITH {_FC}, ls AS (SELECT name, (actual - naive) ** 2 - (actual - seasonal_naive) ** 2 AS d, i AS ord FROM fh WHERE h = 7), {_dm('ls', '6', 'name')}
SELECT name, n, round(mean_loss_diff / sqrt(greatest(v, 1e-12) / n), 4) AS dm_stat FROM dm""")
def k14_dm_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = K.origins(admitted(spark, sf_dir)).filter("h = 7")
    d = o.select("name", "i", ((F.col("actual") - F.col("naive")) ** 2 - (F.col("actual") - F.col("seasonal_naive")) ** 2).alias("d"))
    return rounded(diebold_mariano(d, 7, ["name"], ["i"]).filter("n >= 8").select("name", "n", "dm_stat"), 4)


@query()
def k14_dm_by_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test of ``k14_dm_by_series`` at every horizon."""
    return rounded(dm_by_horizon(K.origins(admitted(spark, sf_dir)), "naive", "seasonal_naive", K.HORIZONS), 4)


@query(f"""WITH {_FC}, se AS (SELECT name, i, y - lag(y, 7) OVER (PARTITION BY name ORDER BY i) AS e FROM ks), sg AS (SELECT name, i, stddev_pop(e) OVER (PARTITION BY name ORDER BY i) AS s FROM se)
SELECT fh.name, round(avg((abs(actual - seasonal_naive) <= 1.96 * CASE WHEN s > 0 THEN s ELSE 1e-6 END)::INT), 6) AS coverage FROM fh JOIN sg ON sg.name = fh.name AND sg.i = fh.i WHERE h = 1 GROUP BY fh.name""")
def k15_interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of the seasonal-naive forecast; the spread is that of its own errors up to the origin."""
    s = admitted(spark, sf_dir)
    return rounded(K.interval_coverage(K.origins(s).join(K.seasonal_residuals(s), ["name", "i"]), "seasonal_naive", "sigma"))


@query()
def k15_smoothed_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of the smoothed forecast."""
    s = admitted(spark, sf_dir)
    return K.interval_coverage(K.origins(s).join(K.holt_winters(s), ["name", "i", "h"]), "ets", "sigma")


@query(f"WITH {_FC} SELECT name, round(regr_slope(actual, seasonal_naive), 6) AS slope, round(regr_intercept(actual, seasonal_naive), 6) AS intercept FROM fh WHERE h = 1 GROUP BY name")
def k16_mincer_zarnowitz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.mincer_zarnowitz(K.origins(admitted(spark, sf_dir)), "seasonal_naive"))


@query(f"""WITH t AS (SELECT name, sum(downloads)::BIGINT AS total FROM ({X.history_supplier()}) GROUP BY name), r AS (SELECT *, row_number() OVER (ORDER BY total DESC, name) - 1 AS pos, count(*) OVER () AS n FROM t)
SELECT name, total, pos FROM r WHERE pos < 6 OR pos BETWEEN greatest(floor(n / 2) - 3, 0) AND greatest(floor(n / 2) - 3, 0) + 5 OR pos >= n - 6""")
def k17_stratified_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.stratified_selection(X.read(spark, sf_dir, X.history_supplier())).withColumn("pos", F.col("pos").cast("bigint"))


@query(f"WITH {_MASE} SELECT h, count(*) AS n_series, round(quantile_cont(naive, 0.5), 3) AS median_naive, round(quantile_cont(seasonal_naive, 0.5), 3) AS median_seasonal_naive, round(avg((naive < seasonal_naive)::INT), 3) AS beats FROM ma GROUP BY h")
def k18_forecast_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.forecast_summary(naive_mase(spark, sf_dir), ("naive", "seasonal_naive"))


@query()
def k18_forecast_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smoothed forecasts against both naive ones, over all series."""
    s = admitted(spark, sf_dir)
    o = K.origins(s).join(K.holt_winters(s), ["name", "i", "h"])
    return K.forecast_summary(K.mase(o, K.scale(s), ("ets", "seasonal_naive", "naive")), ("ets", "seasonal_naive", "naive"))
