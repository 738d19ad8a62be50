"""Queries of tables and payload normalisers over payloads built from the star schema by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.lineage import fresh_folder, written
from seriesforge.plans import fixtures as X
from seriesforge.plans.registry import query, rounded
from seriesforge.plans.risk_queries import _LABEL, _LATEST, _SNAP, snaps
from seriesforge.plans.series_queries import _DATE, _H, _SM, _sums, brand
from seriesforge.sources import payloads as P
from seriesforge.sources import tables as T


def _supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))


def series_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = brand(spark, sf_dir).withColumn("d", F.unix_date("date"))
    entry = F.struct(
        F.when(F.col("downloads") % 5 == 0, "with_mirrors").otherwise("without_mirrors").alias("category"),
        F.when(F.col("d") % 97 == 0, "not-a-date").otherwise(F.col("date").cast("string")).alias("date"),
        F.when(F.col("downloads") % 11 != 0, F.col("downloads")).alias("downloads"),
    )
    return rows.groupBy("name").agg(F.to_json(F.struct(F.collect_list(entry).alias("data"))).alias("payload"))


_B1 = f"b1 AS (SELECT name, date, CASE WHEN downloads % 11 = 0 THEN 0 ELSE downloads END AS downloads FROM ({X.history_brand()}) WHERE downloads % 5 <> 0 AND {X.day('date', True)} % 97 <> 0)"


@query(f"WITH {_B1} SELECT * FROM b1")
def b1_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.daily_series(series_payloads(spark, sf_dir))


@query(f"""WITH {_B1}, l AS (SELECT name, max(date) AS last FROM b1 GROUP BY name), n AS (SELECT DISTINCT p_brand AS name FROM part UNION ALL SELECT 'absent'),
s AS (SELECT b1.name, coalesce(sum(downloads) FILTER (last - date < 1), 0)::BIGINT AS downloads_1d, coalesce(sum(downloads) FILTER (last - date < 7), 0)::BIGINT AS downloads_7d,
coalesce(sum(downloads) FILTER (last - date < 28), 0)::BIGINT AS downloads_28d, coalesce(sum(downloads) FILTER (last - date BETWEEN 7 AND 13), 0)::BIGINT AS p FROM b1 JOIN l USING (name) GROUP BY b1.name)
SELECT name, downloads_1d, downloads_7d, downloads_28d, round(downloads_7d / 7, 2) AS download_velocity, (downloads_7d - p)::DOUBLE AS download_acceleration, downloads_7d IS NOT NULL AS ok FROM n LEFT JOIN s USING (name)""")
def b2_download_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = series_payloads(spark, sf_dir)
    names = p.select("name").union(spark.createDataFrame([("absent",)], "name string"))
    return P.download_summary(names, P.daily_series(p))


@query("""WITH o AS (SELECT o_custkey, o_orderdate FROM orders WHERE o_orderkey % 5 <> 0), n AS (SELECT DISTINCT o_custkey FROM orders),
a AS (SELECT o_custkey, count(*) AS c, max(o_orderdate) AS hi, min(o_orderdate) AS lo FROM o GROUP BY o_custkey)
SELECT 'c' || n.o_custkey AS name, coalesce(c, 0) AS version_count, round(datediff('second', hi, TIMESTAMP '2001-12-31') / 86400, 1) AS days_since_last_release,
CASE WHEN c >= 2 THEN round(datediff('second', lo, hi) / 86400 / (c - 1), 1) END AS release_cadence_days FROM n LEFT JOIN a USING (o_custkey)""")
def b3_release_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    none = F.array().cast("array<struct<upload_time: string>>")
    files = F.when(F.col("o_orderkey") % 5 == 0, none).otherwise(F.array(F.struct(F.col("o_orderdate").cast("string").alias("upload_time"))))
    releases = F.map_from_entries(F.collect_list(F.struct(F.col("o_orderkey").cast("string"), files)))
    p = o.groupBy(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("name")).agg(F.to_json(F.struct(releases.alias("releases"))).alias("payload"))
    return P.release_cadence(p, F.lit("2001-12-31").cast("timestamp"))


def url_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _supplier(spark, sf_dir)
    owner = F.concat(F.lit("org"), (F.col("k") % 10).cast("string"))
    gh = F.concat(F.lit("https://GitHub.com/"), owner, F.lit("/r"), F.col("k").cast("string"))
    low = F.lower(gh)
    urls = (
        F.when(F.col("k") % 4 == 0, F.create_map(F.lit("Home"), F.concat(low, F.lit("/issues")), F.lit("Source"), F.concat(low, F.lit(".git"))))
        .when(F.col("k") % 4 == 1, F.create_map(F.lit("Homepage"), F.lit("https://example.org/x"), F.lit("Docs"), F.concat(low, F.lit("#readme"))))
        .when(F.col("k") % 4 == 2, F.create_map(F.lit("Homepage"), F.lit("https://example.org/x")))
    )
    return s.select("k", "name", urls.alias("urls"), F.when(F.col("k") % 3 == 0, F.concat(low, F.lit("-reg"))).alias("registry"), F.when(F.col("k") % 9 == 0, F.lit("own/override")).alias("override"))


_URL = "CASE WHEN s_suppkey % 4 = 0 THEN g || '.git' WHEN s_suppkey % 4 = 1 THEN g || '#readme' END"
_S = "s AS (SELECT *, 'https://github.com/org' || s_suppkey % 10 || '/r' || s_suppkey AS g, 'org' || s_suppkey % 10 || '/r' || s_suppkey AS o FROM supplier)"


@query(f"WITH {_S} SELECT s_name AS name, {_URL} AS url, CASE WHEN s_suppkey % 4 IN (0, 1) THEN o END AS repo FROM s")
def b4_repo_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = url_payloads(spark, sf_dir).withColumn("url", P.repo_url(F.col("urls")))
    return u.select("name", "url", P.owner_repo(F.col("url")).alias("repo"))


@query(f"WITH {_S} SELECT s_name AS name, CASE WHEN s_suppkey % 9 = 0 THEN 'own/override' WHEN s_suppkey % 4 IN (0, 1) THEN o WHEN s_suppkey % 3 = 0 THEN o || '-reg' END AS repo FROM s")
def b6_repo_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = url_payloads(spark, sf_dir)
    return u.select("name", P.resolve_repo(F.col("override"), P.repo_url(F.col("urls")), F.col("registry")).alias("repo"))


@query("""WITH v AS (SELECT l_suppkey, datediff('second', l_shipdate, TIMESTAMP '2001-06-30') / 86400 AS age, CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2 WHEN l_linenumber <= 6 THEN 3 ELSE 4 END AS r
FROM lineitem WHERE l_returnflag = 'R' AND l_quantity <= 2), a AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (floor(age) <= 14) AS n14, count(*) FILTER (floor(age) <= 28) AS n28, max(r) AS r FROM v GROUP BY l_suppkey)
SELECT s_name AS name, coalesce(n, 0) AS vuln_count, coalesce(n14, 0) AS vuln_new_14d, coalesce(n28, 0) AS vuln_new_28d, CASE r WHEN 1 THEN 'LOW' WHEN 2 THEN 'MODERATE' WHEN 3 THEN 'HIGH' WHEN 4 THEN 'CRITICAL' END AS max_severity
FROM supplier LEFT JOIN a ON l_suppkey = s_suppkey""")
def b7_vulnerability_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_returnflag = 'R' AND l_quantity <= 2")
    n = F.col("l_linenumber")
    sev = F.when(n <= 2, "low").when(n <= 4, "MEDIUM").when(n <= 6, "HIGH").otherwise("CRITICAL")
    entry = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_shipdate").cast("string").alias("published"), sev.alias("severity"))
    lists = li.groupBy(F.col("l_suppkey").alias("k")).agg(F.collect_list(entry).alias("vulns"))
    p = _supplier(spark, sf_dir).join(lists, "k", "left").select("name", F.to_json(F.struct("vulns")).alias("payload"))
    return P.vulnerability_rollup(p, F.lit("2001-06-30").cast("timestamp"))


def graph_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions, dependency nodes, scorecard checks and weekly commits of each supplier, by rule, as JSON."""
    k = F.col("k")
    versions = F.transform(F.sequence(F.lit(1), 1 + k % 4), lambda i: F.struct((i == k % 6).alias("isDefault"), F.concat(i.cast("string"), F.lit(".0")).alias("version")))
    nodes = F.transform(F.sequence(F.lit(0).cast("bigint"), k % 7), lambda i: F.struct(F.when(i == 0, "SELF").when(i % 2 == 0, "DIRECT").alias("relation")))
    checks = F.array(F.struct(F.lit("Maintained").alias("name"), (k % 12 - 1).cast("double").alias("score")), F.struct(F.lit("Code-Review").alias("name"), F.when(k % 5 != 0, (k % 11).cast("double")).alias("score")))
    weeks = F.when(k % 7 > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), k % 7), lambda i: i * 10 + k % 3)).otherwise(F.array().cast("array<bigint>"))
    stats = F.struct((k * 3).alias("stargazers_count"), (k % 50).alias("forks_count"), (F.col("bal") < 0).alias("archived"), F.when(k % 4 != 0, k % 10 / 10).alias("dds"))
    body = F.struct(versions.alias("versions"), nodes.alias("nodes"), checks.alias("checks"), weeks.alias("weeks"), stats.alias("stats"))
    kind = ("struct<versions: array<struct<isDefault: boolean, version: string>>, nodes: array<struct<relation: string>>, checks: array<struct<name: string, score: double>>, "
            "weeks: array<bigint>, stats: struct<stargazers_count: bigint, forks_count: bigint, archived: boolean, dds: double>>")  # fmt: skip
    return _supplier(spark, sf_dir).select("name", F.from_json(F.to_json(body), kind).alias("p"))


@query("SELECT s_name AS name, CASE WHEN s_suppkey % 6 BETWEEN 1 AND 1 + s_suppkey % 4 THEN s_suppkey % 6 ELSE 1 + s_suppkey % 4 END || '.0' AS version, 1 + s_suppkey % 4 AS version_count FROM supplier")
def b8_default_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_payloads(spark, sf_dir).select("name", P.default_version(F.col("p.versions")).alias("version"), F.size("p.versions").cast("bigint").alias("version_count"))


@query("SELECT s_name AS name, s_suppkey % 7 AS dependency_count FROM supplier")
def b9_dependency_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_payloads(spark, sf_dir).select("name", P.dependency_count(F.col("p.nodes")).cast("bigint").alias("dependency_count"))


@query("SELECT s_name AS name, CASE WHEN s_suppkey % 12 >= 1 THEN (s_suppkey % 12 - 1)::DOUBLE END AS maintained, CASE WHEN s_suppkey % 5 <> 0 THEN (s_suppkey % 11)::DOUBLE END AS code_review FROM supplier")
def b10_scorecard_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("p.checks")
    return graph_payloads(spark, sf_dir).select("name", P.check_score(c, "Maintained").alias("maintained"), P.check_score(c, "Code-Review").alias("code_review"))


@query("SELECT s_name AS name, s_suppkey * 3 AS stars, s_suppkey % 50 AS forks, s_acctbal < 0 AS archived, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 10 / 10 END AS bus_factor FROM supplier")
def b11_registry_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_payloads(spark, sf_dir).select("name", F.col("p.stats.stargazers_count").alias("stars"), F.col("p.stats.forks_count").alias("forks"), "p.stats.archived", F.col("p.stats.dds").alias("bus_factor"))


@query("SELECT s_name AS name, coalesce(list_sum(list_transform(range(greatest(1, s_suppkey % 7 - 3), s_suppkey % 7 + 1), lambda i: i * 10 + s_suppkey % 3)), 0)::BIGINT AS commit_count_4w FROM supplier")
def b12_commit_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_payloads(spark, sf_dir).select("name", P.commits_4w(F.col("p.weeks")).alias("commit_count_4w"))


@query("""SELECT user_id, count(*) FILTER (event_type = 'purchase') AS prs_merged_7d, count(*) FILTER (event_type = 'error') AS issues_opened_7d FROM events
WHERE ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-29' GROUP BY user_id""")
def b13_velocity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_type")
    return P.velocity_counts(e, "user_id", F.lit("2024-01-29").cast("timestamp_ntz"), {"prs_merged_7d": "purchase", "issues_opened_7d": "error"})


@query(f"WITH {_SNAP} SELECT run_id, name, downloads_7d IS NOT NULL AS downloads_ok, bus_factor IS NOT NULL AS repo_ok FROM snap")
def b14_source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = P.source_status({"downloads": F.col("downloads_7d").isNotNull(), "repo": F.col("bus_factor").isNotNull()})
    return snaps(spark, sf_dir).withColumn("m", status).select("run_id", "name", F.col("m")["downloads"].alias("downloads_ok"), F.col("m")["repo"].alias("repo_ok"))


@query(f"""WITH {_SNAP}, {_LATEST} SELECT s_name AS name, r_name AS category, coalesce(CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 10 / 10 END, bus_factor) AS bus_factor,
coalesce(archived, s_acctbal < 0) AS archived, coalesce(stars, s_suppkey * 3) AS stars
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey LEFT JOIN cur ON cur.name = s_name""")
def b15_precedence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesforge.operators.reads import latest_run

    names = X.read(spark, sf_dir, "SELECT s_name AS name, r_name AS category FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey")
    registry = b11_registry_stats(spark, sf_dir).select("name", *[F.col(c).alias(f"g_{c}") for c in ("stars", "archived", "bus_factor")])
    cur = latest_run(snaps(spark, sf_dir), "snapshot_date").select("name", "stars", "archived", "bus_factor")
    return P.merge_sources(names, [registry, cur], {"bus_factor": ["g_bus_factor", "bus_factor"], "archived": ["archived", "g_archived"], "stars": ["stars", "g_stars"]})


@query(f"WITH {_SNAP}, {_LATEST} SELECT (SELECT count(*) FROM cur) AS packages, (SELECT count(downloads_7d) FROM cur) AS with_downloads, (SELECT count(*) FROM ({X.history_supplier()})) AS history_rows")
def b16_collection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesforge.operators.reads import latest_run

    return P.collection_stats(latest_run(snaps(spark, sf_dir), "snapshot_date"), X.read(spark, sf_dir, X.history_supplier()))


@query(f"WITH {_SNAP} SELECT run_id, name FROM snap WHERE downloads_7d IS NULL")
def b17_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.failures(snaps(spark, sf_dir)).select("run_id", "name")


def healed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The latest run with a second attempt for every third name, and the runs before it."""
    s = snaps(spark, sf_dir).select("run_id", "snapshot_date", "name", "downloads_7d", "stars", "ingested_at")
    last = s.agg(F.max("run_id").alias("run_id"))
    cur = s.join(F.broadcast(last), "run_id", "left_semi").select(s.columns)
    retry = cur.filter("stars % 3 = 0").withColumn("downloads_7d", F.lit(7).cast("bigint"))
    return P.retry_merge(cur, retry), s.join(F.broadcast(last), "run_id", "left_anti").select(s.columns)


_HEAL = f"""{_SNAP}, {_LATEST}, b18 AS (SELECT run_id, name, CASE WHEN downloads_7d IS NULL AND stars % 3 = 0 THEN 7 ELSE downloads_7d END AS downloads_7d, stars,
CASE WHEN downloads_7d IS NULL AND stars % 3 = 0 THEN 'recovered' ELSE 'ingested' END AS origin FROM cur),
old AS (SELECT name, arg_max(downloads_7d, snapshot_date) AS d, arg_max(stars, snapshot_date) AS s FROM snap WHERE downloads_7d IS NOT NULL AND run_id <> (SELECT max(run_id) FROM snap) GROUP BY name),
b19 AS (SELECT run_id, b18.name, coalesce(downloads_7d, d) AS downloads_7d, CASE WHEN downloads_7d IS NULL AND d IS NOT NULL THEN s ELSE stars END AS stars,
CASE WHEN downloads_7d IS NULL AND d IS NOT NULL THEN 'carried_forward' ELSE origin END AS origin FROM b18 LEFT JOIN old ON old.name = b18.name)"""


@query(f"WITH {_HEAL} SELECT * FROM b18")
def b18_retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return healed(spark, sf_dir)[0].select("run_id", "name", "downloads_7d", "stars", "origin")


@query(f"WITH {_HEAL} SELECT * FROM b19")
def b19_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.carry_forward(*healed(spark, sf_dir)).select("run_id", "name", "downloads_7d", "stars", "origin")


@query(f"WITH {_HEAL} SELECT count(*) FILTER (downloads_7d IS NULL OR origin <> 'ingested') AS failed, count(*) FILTER (origin = 'recovered') AS recovered, count(*) FILTER (origin = 'carried_forward') AS carried_forward FROM b19")
def b20_healing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.healing_stats(P.carry_forward(*healed(spark, sf_dir)))


@query("""SELECT o_orderkey::VARCHAR AS name, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate::DATE END AS date,
CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN trunc(o_totalprice)::BIGINT ELSE o_custkey END AS downloads FROM orders""")
def a2_row_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    date = F.when(F.col("o_orderkey") % 3 == 0, "someday").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    count = F.when(F.col("o_orderkey") % 5 == 0, float("nan")).when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).otherwise(F.col("o_custkey").cast("double"))
    return T.conform(o.select(F.col("o_orderkey").alias("name"), date.alias("date"), count.alias("downloads"), F.col("o_orderstatus").alias("unknown")), "download_history")


@query("SELECT o_orderkey::VARCHAR AS name, o_orderdate::DATE AS date, o_custkey::BIGINT AS downloads FROM orders")
def a1_create_keeps_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables created, rows appended to one, all created again."""
    root = fresh_folder(spark, "tables")
    T.create(spark, root)
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    T.append(o.select(F.col("o_orderkey").cast("string").alias("name"), F.col("o_orderdate").alias("date"), F.col("o_custkey").alias("downloads")), root, "download_history")
    T.create(spark, root)
    return T.load(spark, root, "download_history")


@query(f"WITH {_SNAP}, {_LATEST} SELECT run_id, name, stars FROM cur")
def a3_append_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots appended in two parts, the later runs first; the latest run read from its own folders."""
    root = fresh_folder(spark, "tables")
    T.create(spark, root)
    rows = written(snaps(spark, sf_dir), "snapshots")
    for part in ("snapshot_date >= DATE '1998-01-01'", "snapshot_date < DATE '1998-01-01'"):
        T.append(rows.filter(part), root, "snapshots")
    return T.load_latest(spark, root, "snapshots", "snapshot_date").select("run_id", "name", "stars")


@query(f"WITH {_SNAP} SELECT run_id, name, stars FROM snap WHERE stars > 3")
def a4_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by part of its own rows."""
    root = fresh_folder(spark, "tables")
    T.create(spark, root)
    T.append(snaps(spark, sf_dir), root, "snapshots")
    T.reload(T.load(spark, root, "snapshots").filter("stars > 3"), root, "snapshots")
    return T.load(spark, root, "snapshots").select("run_id", "name", "stars")


@query(f"WITH {_SNAP}, {_LATEST} SELECT name, stars, NULL::VARCHAR AS license, NULL::BIGINT AS subscribers FROM cur")
def a5_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesforge.operators.reads import latest_run

    old = latest_run(snaps(spark, sf_dir), "snapshot_date").select("run_id", "name", "stars")
    return T.evolve(old, "snapshots").select("name", "stars", "license", "subscribers")


@query(f"WITH {_SNAP} SELECT name, run_id, stars FROM snap WHERE vuln_count > 20 AND category = 'ASIA'")
def a6_query_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT name, run_id, stars FROM {snapshots} WHERE vuln_count > :least AND category = :category"
    return T.query(spark, sql, {"least": 20, "category": "ASIA"}, snapshots=snaps(spark, sf_dir))


@query("SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events")
def a7_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.row_counts({t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "events")})


@query(f"WITH {_SNAP} SELECT run_id, snapshot_date, name, repo, stars, bus_factor, archived FROM snap")
def a10_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots written as CSV with a header and read back under a schema."""
    folder = fresh_folder(spark, "csv")
    T.write_csv(snaps(spark, sf_dir).select("run_id", "snapshot_date", "name", "repo", "stars", "bus_factor", "archived"), folder)
    return T.scan_landed(spark, folder, "run_id string, snapshot_date date, name string, repo string, stars bigint, bus_factor double, archived boolean", "csv")


@query(f"WITH m AS ({X.model_runs(True)}) SELECT run_id, model_name, CASE WHEN NOT isnan(metric_value) THEN metric_value END AS metric_value FROM m")
def a11_finite_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = T.finite(X.read(spark, sf_dir, X.model_runs()).select("run_id", "model_name", "metric_value"))
    text = clean.select(F.to_json(F.struct("*")).alias("j"))
    return text.select(F.from_json("j", "run_id string, model_name string, metric_value double").alias("r")).select("r.*")


@query("SELECT (row_number() OVER (ORDER BY p_brand) - 1)::INT AS pos, p_brand AS name, 'brand' AS category, NULL::VARCHAR AS repo_override FROM (SELECT DISTINCT p_brand FROM part) ORDER BY 1 LIMIT 20")
def a12_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [r["p_brand"] for r in spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand").distinct().orderBy("p_brand").limit(20).collect()]
    return T.watchlist(spark, [(n, "brand") for n in names], limit=20)


@query(f"WITH {_SNAP} SELECT run_id, name, downloads_28d, stars, vuln_new_28d AS candidate FROM snap")
def a13_active_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots cut to the active features: the configured ones that are computed, plus the candidate on trial."""
    rows = snaps(spark, sf_dir).withColumnRenamed("vuln_new_28d", "candidate")
    return rows.select("run_id", "name", *T.active_features(["downloads_28d", "never_computed", "stars"], rows.columns, ["forks"], "candidate"))


@query(f"WITH {_H} SELECT name, count(*) AS n FROM h GROUP BY name")
def a14_landed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads landed as JSON files and scanned from there."""
    folder = fresh_folder(spark, "landed")
    series_payloads(spark, sf_dir).withColumn("source", F.lit("downloads")).write.partitionBy("source").json(folder)
    landed = T.scan_landed(spark, folder, "name string, payload string, source string").filter("source = 'downloads'")
    kind = "struct<data: array<struct<date: string>>>"
    return landed.select("name", F.size(F.from_json("payload", kind)["data"]).cast("bigint").alias("n"))


@query(f"WITH {_B1} SELECT name, date, CASE WHEN date >= DATE '2000-01-01' AND downloads > 0 THEN downloads + 5 ELSE downloads END AS downloads FROM b1")
def m1_incremental_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, the second one with corrections of late days; taken in by two incremental runs."""
    from seriesforge.streaming import incremental as I

    root = fresh_folder(spark, "m1")
    first = series_payloads(spark, sf_dir).withColumn("fetched_at", F.lit(1).cast("bigint"))
    kind = "struct<data: array<struct<category: string, date: string, downloads: bigint>>>"
    late = F.filter(F.from_json("payload", kind)["data"], lambda r: (r["date"] >= "2000") & (r["downloads"] > 0) & (r["date"] != "not-a-date"))
    fixed = F.transform(late, lambda r: F.struct(r["category"].alias("category"), r["date"].alias("date"), (r["downloads"] + 5).alias("downloads")))
    second = first.select("name", F.to_json(F.struct(fixed.alias("data"))).alias("payload"), F.lit(2).cast("bigint").alias("fetched_at"))
    for batch in (first, second):
        batch.write.mode("append").parquet(f"{root}/landing")
        I.upkeep(spark, f"{root}/landing", f"{root}/table", f"{root}/state")
    return I.read_series(spark, f"{root}/table").select("name", "date", "downloads")


@query(f"""WITH {_SNAP}, {_LATEST}, {_SM.replace(X.history_brand(), X.history_named())}, o AS (SELECT name, max(d) AS t FROM hd GROUP BY name), a AS ({_sums('o')})
SELECT 'now' AS run_id, a.name, category, {_DATE.format('a.t')} AS feature_date, round(s7, 4) AS downloads_7d, round(s28, 4) AS downloads_28d, round(s7 / 7, 4) AS download_velocity, stars::DOUBLE AS stars,
bus_factor::DOUBLE AS bus_factor, scorecard_overall, vuln_new_28d::DOUBLE AS vuln_new_28d, days_since_last_release, {_LABEL} AS at_risk_label, true AS is_scoring_row
FROM a LEFT JOIN cur ON cur.name = a.name WHERE s7 > 0""")
def c17_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide feature table of the latest run (suppliers' series with the suppliers' snapshots), written and read back."""
    from seriesforge.operators import risk as R
    from seriesforge.operators import series as S
    from seriesforge.operators.reads import latest_run

    cur = latest_run(snaps(spark, sf_dir), "snapshot_date").drop("run_id")
    table = S.feature_table(S.scoring_frame(X.read(spark, sf_dir, X.history_named())), R.risk_frame(cur), cur, "now")
    return rounded(written(table, "features"), 4)
