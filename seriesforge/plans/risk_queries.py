"""Queries of risk, scoring, drift, quality and read operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.columns import momentum_label, momentum_score
from seriesforge.operators import quality as Q
from seriesforge.operators import reads as V
from seriesforge.operators import risk as R
from seriesforge.operators import scoring as C
from seriesforge.operators import series as S
from seriesforge.plans import fixtures as X
from seriesforge.plans.registry import query, rounded
from seriesforge.plans.series_queries import SCORING_SQL

_SNAP = f"snap AS MATERIALIZED ({X.snapshots(True)})"
_PRED = f"pred AS MATERIALIZED ({X.predictions(True)})"
_LATEST = "cur AS (SELECT * FROM snap WHERE run_id = (SELECT run_id FROM snap ORDER BY snapshot_date DESC, run_id DESC LIMIT 1))"
_LATEST_PRED = "lp AS (SELECT * FROM pred WHERE run_id = (SELECT run_id FROM pred ORDER BY predicted_at DESC, run_id DESC LIMIT 1))"


def snaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.read(spark, sf_dir, X.snapshots())


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.read(spark, sf_dir, X.predictions())


_LABEL = """CASE WHEN (coalesce(vuln_new_28d, 0) > 0 AND coalesce(max_severity, '') IN ('HIGH', 'CRITICAL')) OR coalesce(archived, false) OR coalesce(status, '') <> ''
  OR coalesce(days_since_last_release, 0) > 365 OR (bus_factor IS NOT NULL AND bus_factor < 0.1 AND coalesce(dependent_repos_count, 0) > 1000) THEN 1 ELSE 0 END"""
_RISK_COLS = f"""name, category, round(ln(1 + stars), 6) AS log_stars, round(ln(1 + forks), 6) AS log_forks, round(ln(1 + open_issues), 6) AS log_open_issues,
round(ln(1 + dependent_repos_count), 6) AS log_dependent_repos, round(ln(1 + dependent_packages_count), 6) AS log_dependent_packages, bus_factor,
round(release_cadence_days, 6) AS release_cadence_days, dependency_count, scorecard_overall, commit_count_4w, prs_merged_7d::DOUBLE AS prs_merged_7d,
issues_opened_7d::DOUBLE AS issues_opened_7d, rank_average"""


@query(f"WITH {_SNAP}, {_LATEST} SELECT {_RISK_COLS}, {_LABEL} AS at_risk_label FROM cur")
def d1_risk_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.risk_frame(V.latest_run(snaps(spark, sf_dir), "snapshot_date")))


@query(f"WITH {_SNAP} SELECT run_id, name, {_LABEL} AS at_risk_label FROM snap")
def d2_heuristic_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snaps(spark, sf_dir).select("run_id", "name", R.heuristic_label().alias("at_risk_label"))


_ESC = """CASE WHEN coalesce(b.vuln_count, 0) > coalesce(a.vuln_count, 0) OR (coalesce(b.archived, false) AND NOT coalesce(a.archived, false))
  OR (coalesce(b.status, '') <> '' AND coalesce(a.status, '') = '') OR coalesce(a.downloads_7d <> 0 AND b.downloads_7d < 0.7 * a.downloads_7d, false)
  OR (coalesce(b.days_since_last_release, 0) > 365 AND coalesce(a.days_since_last_release, 0) <= 365) THEN 1 ELSE 0 END"""


@query(f"WITH {_SNAP} SELECT a.name, a.run_id AS first_run, b.run_id AS last_run, {_ESC} AS escalated FROM snap a JOIN snap b ON a.name = b.name AND b.snapshot_date > a.snapshot_date")
def d3_escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snaps(spark, sf_dir)
    sides = [s.select("name", F.struct(*s.columns).alias(k)) for k in ("a", "b")]
    pairs = sides[0].join(sides[1], "name").filter("b.snapshot_date > a.snapshot_date")
    return pairs.select("name", F.col("a.run_id").alias("first_run"), F.col("b.run_id").alias("last_run"), R.escalated("a", "b").alias("escalated"))


_ENDS = """ends AS (SELECT name, min(snapshot_date) AS d0, max(snapshot_date) AS d1 FROM snap GROUP BY name),
fw AS (SELECT a.*, b.esc FROM ends JOIN snap a ON a.name = ends.name AND a.snapshot_date = d0 JOIN (SELECT a.name, {esc} AS esc FROM ends e JOIN snap a ON a.name = e.name AND a.snapshot_date = d0
  JOIN snap b ON b.name = e.name AND b.snapshot_date = d1) b ON b.name = a.name WHERE d1 - d0 >= 14)""".replace("{esc}", _ESC)


@query(f"WITH {_SNAP}, {_ENDS} SELECT {_RISK_COLS}, esc AS at_risk_label FROM fw")
def d4_forward_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.forward_frame(snaps(spark, sf_dir)))


@query(f"""WITH {_SNAP}, {_LATEST}, {_ENDS}, ready AS (SELECT count(*) >= 25 AND count(DISTINCT esc) > 1 AS ok FROM fw)
SELECT name, esc AS at_risk_label, 'forward' AS label_mode FROM fw WHERE (SELECT ok FROM ready)
UNION ALL SELECT name, {_LABEL}, 'heuristic' FROM cur WHERE NOT (SELECT ok FROM ready)""")
def d5_label_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snaps(spark, sf_dir)
    chosen = R.choose_training(R.risk_frame(V.latest_run(s, "snapshot_date")), R.forward_frame(s))
    return chosen.select("name", "at_risk_label", "label_mode")


@query(f"WITH {_PRED} SELECT run_id, name, risk_score AS composite FROM pred")
def d6_composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.composite_score(snaps(spark, sf_dir)).select("run_id", "name", "composite")


_PARTS = """p AS (SELECT run_id, name, unnest([
  {'k': 'recent vulnerabilities', 'i': 0, 'w': 0.24, 'v': least(coalesce(vuln_new_28d, 0) * 0.5, 1.0) * (0.5 + coalesce(CASE max_severity WHEN 'CRITICAL' THEN 1.0 WHEN 'HIGH' THEN 0.7 WHEN 'MODERATE' THEN 0.4 WHEN 'LOW' THEN 0.2 END, 0.0) / 2)::DOUBLE},
  {'k': 'release staleness', 'i': 1, 'w': 0.20, 'v': CASE WHEN days_since_last_release IS NULL THEN 0.3::DOUBLE ELSE least(greatest((days_since_last_release - 30) / 335, 0::DOUBLE), 1::DOUBLE) END},
  {'k': 'maintainer key-person risk', 'i': 2, 'w': 0.18, 'v': coalesce(1 - bus_factor, 0.4::DOUBLE)},
  {'k': 'weak security posture', 'i': 3, 'w': 0.16, 'v': coalesce(1 - scorecard_overall / 10, 0.35::DOUBLE)},
  {'k': 'abandoned / removed', 'i': 4, 'w': 0.12, 'v': CASE WHEN coalesce(archived, false) OR coalesce(status, '') <> '' THEN 1::DOUBLE ELSE 0::DOUBLE END},
  {'k': 'issue backlog pressure', 'i': 5, 'w': 0.10, 'v': CASE WHEN issues_opened_7d + prs_merged_7d <> 0 THEN issues_opened_7d / (issues_opened_7d + prs_merged_7d)::DOUBLE ELSE 0.3::DOUBLE END}], recursive := true) FROM snap)"""


@query(f"""WITH {_SNAP}, {_PARTS}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id, name ORDER BY v * w::DOUBLE DESC, i) AS rn FROM p WHERE v > 0.25)
SELECT s.run_id, s.name, coalesce(string_agg(k, '; ' ORDER BY rn) FILTER (WHERE rn <= 2), '') AS reasons FROM snap s LEFT JOIN r ON r.run_id = s.run_id AND r.name = s.name GROUP BY s.run_id, s.name""")
def d7_composite_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.composite_score(snaps(spark, sf_dir)).select("run_id", "name", F.array_join("reasons", "; ").alias("reasons"))


@query(f"""WITH {_PRED}, b AS (SELECT run_id, name, CASE WHEN momentum_score > 80 THEN risk_score ELSE round(0.6 * risk_score + 0.4 * momentum_score, 1) END AS blended FROM pred)
SELECT *, CASE WHEN blended >= 66 THEN 'high' WHEN blended >= 40 THEN 'medium' ELSE 'low' END AS risk_level FROM b""")
def d8_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = preds(spark, sf_dir).withColumn("p", F.when(F.col("momentum_score") <= 80, F.col("momentum_score") / 100))
    return R.with_level(p.select("run_id", "name", R.blend("risk_score", "p").alias("blended")), "blended")


@query(f"""WITH {_SNAP}, {_LATEST}, m AS (SELECT coalesce(quantile_cont(bus_factor, 0.5), 0) AS a, coalesce(quantile_cont(scorecard_overall, 0.5), 0) AS b, coalesce(quantile_cont(release_cadence_days, 0.5), 0) AS c FROM cur)
SELECT name, round(coalesce(bus_factor, a), 6) AS bus_factor, round(coalesce(scorecard_overall, b), 6) AS scorecard_overall, round(coalesce(release_cadence_days, c), 6) AS release_cadence_days,
0::DOUBLE AS rank_average FROM cur, m""")
def d9_median_imputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["bus_factor", "scorecard_overall", "release_cadence_days", "rank_average"]
    return rounded(R.impute_medians(V.latest_run(snaps(spark, sf_dir), "snapshot_date").select("name", *cols), cols))


@query(f"WITH {_SNAP}, {_LATEST} SELECT run_id, name, stars FROM cur")
def a8_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.latest_run(snaps(spark, sf_dir), "snapshot_date").select("run_id", "name", "stars")


@query(f"WITH f AS ({SCORING_SQL}) SELECT name, round(100 / (1 + exp(-3 * ln(mom_28v28))), 1) AS momentum_score, CASE WHEN round(100 / (1 + exp(-3 * ln(mom_28v28))), 1) >= 66 THEN 'high' WHEN round(100 / (1 + exp(-3 * ln(mom_28v28))), 1) <= 40 THEN 'declining' ELSE 'normal' END AS momentum_label FROM f")
def f1_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = rounded(S.scoring_frame(X.read(spark, sf_dir, X.history_brand()))).select("name", momentum_score(F.log("mom_28v28")).alias("momentum_score"))
    return f.withColumn("momentum_label", momentum_label("momentum_score"))


_PHRASE_ROWS = ", ".join(f"('{k}', '{a}', '{b}')" for k, (a, b) in C.PHRASES.items())


@query(f"""WITH f AS ({SCORING_SQL}), u AS (UNPIVOT (SELECT name, trend_slope_28, trend_slope_56, trend_slope_7 FROM f) ON trend_slope_28, trend_slope_56, trend_slope_7 INTO NAME feature VALUE value),
ph(feature, up, down) AS (VALUES {_PHRASE_ROWS}), r AS (SELECT name, CASE WHEN value >= 0 THEN up ELSE down END AS t, row_number() OVER (PARTITION BY name ORDER BY abs(value) DESC, u.feature) AS rn FROM u JOIN ph USING (feature))
SELECT name, string_agg(t, '; ' ORDER BY rn) AS reasons FROM r WHERE rn <= 2 GROUP BY name""")
def f2_reason_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = rounded(S.scoring_frame(X.read(spark, sf_dir, X.history_brand())))
    long = C.melt(f, ["name"], ["trend_slope_28", "trend_slope_56", "trend_slope_7"]).select("name", F.col("metric_name").alias("feature"), F.col("metric_value").alias("value"))
    told = C.reason_texts(long.withColumn("pos", F.struct(-F.abs("value"), "feature")))
    return told.select("name", F.array_join("reasons", "; ").alias("reasons"))


@query(f"""WITH {_SNAP}, {_PRED}, {_LATEST}, {_LATEST_PRED} SELECT 'now' AS run_id, lp.name, lp.category, lp.momentum_score,
CASE WHEN bus_factor IS NULL THEN risk_score ELSE round(0.6 * risk_score + 0.4 * 100 * bus_factor, 1) END AS risk_score, growth_pred_70d, momentum_label FROM lp JOIN cur ON cur.name = lp.name""")
def f3_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = V.latest_run(snaps(spark, sf_dir), "snapshot_date")
    scores = V.latest_run(preds(spark, sf_dir), "predicted_at").select("name", F.col("growth_pred_70d").alias("growth_pred"))
    none = scores.select("name", F.array(F.lit("steady")).alias("reasons"))
    told = C.assemble_predictions(scores, R.composite_score(cur), cur.select("name", F.col("bus_factor").alias("probability")), none, "now")
    return told.select("run_id", "name", "category", "momentum_score", "risk_score", "growth_pred_70d", "momentum_label")


_PAIRS = f"""{_PRED}, runs AS (SELECT run_id, lag(run_id) OVER (ORDER BY max(predicted_at), run_id) AS prev FROM pred GROUP BY run_id),
sides AS (SELECT r.run_id AS curr_run, 'curr' AS side, p.* EXCLUDE (run_id) FROM runs r JOIN pred p ON p.run_id = r.run_id WHERE prev IS NOT NULL
  UNION ALL SELECT r.run_id, 'prev', p.* EXCLUDE (run_id) FROM runs r JOIN pred p ON p.run_id = r.prev)"""


def _psi_cte(c: str) -> str:
    return f"""e_{c} AS (SELECT curr_run, list_sort(list_distinct(quantile_cont({c}, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS edges,
  count(*) FILTER (side = 'prev') AS np, count(*) FILTER (side = 'curr') AS nc FROM sides GROUP BY curr_run),
b_{c} AS (SELECT s.curr_run, least(len(list_filter(edges, lambda z: z <= {c})), len(edges) - 1) AS bin, count(*) FILTER (side = 'prev') AS p, count(*) FILTER (side = 'curr') AS c
  FROM sides s JOIN e_{c} USING (curr_run) GROUP BY 1, 2),
f_{c} AS (SELECT curr_run, np, nc, unnest(range(1, len(edges))) AS bin FROM e_{c} WHERE len(edges) >= 3 AND least(np, nc) >= 2),
t_{c} AS (SELECT curr_run, sum((greatest(coalesce(c, 0) / nc, 1e-4) - greatest(coalesce(p, 0) / np, 1e-4)) * ln(greatest(coalesce(c, 0) / nc, 1e-4) / greatest(coalesce(p, 0) / np, 1e-4))) AS psi
  FROM f_{c} LEFT JOIN b_{c} USING (curr_run, bin) GROUP BY curr_run)"""


@query(f"WITH {_PAIRS}, {_psi_cte('momentum_score')} SELECT curr_run, round(coalesce(psi, 0), 6) AS psi FROM e_momentum_score LEFT JOIN t_momentum_score USING (curr_run)")
def f4_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(C.population_stability(C.both_sides(preds(spark, sf_dir)), "momentum_score", ["curr_run"]))


@query(f"WITH {_PAIRS} SELECT curr_run, round(avg(risk_score) FILTER (side = 'curr') - avg(risk_score) FILTER (side = 'prev'), 6) AS risk_score_mean_shift FROM sides GROUP BY curr_run")
def f5_mean_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.mean_shift(C.both_sides(preds(spark, sf_dir)), "risk_score", 6)


_CHURN = """ch AS (SELECT a.curr_run, round((avg((a.momentum_label <> b.momentum_label)::INT) + avg((a.risk_level <> b.risk_level)::INT)) / 2, 3) AS label_churn
FROM sides a JOIN sides b ON a.curr_run = b.curr_run AND a.name = b.name AND a.side = 'prev' AND b.side = 'curr' GROUP BY a.curr_run)"""


@query(f"WITH {_PAIRS}, {_CHURN} SELECT * FROM ch")
def f6_label_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.label_churn(C.both_sides(preds(spark, sf_dir)))


_DRIFT = f"""{_PAIRS}, {_psi_cte('momentum_score')}, {_psi_cte('risk_score')}, {_CHURN},
dr AS (SELECT ch.curr_run, label_churn, round(coalesce(m.psi, 0), 3) AS mp, round(coalesce(r.psi, 0), 3) AS rp FROM ch LEFT JOIN t_momentum_score m USING (curr_run) LEFT JOIN t_risk_score r USING (curr_run)),
sev AS (SELECT *, CASE WHEN greatest(mp, rp) > 0.25 OR label_churn > 0.30 THEN 'high' WHEN greatest(mp, rp) > 0.10 OR label_churn > 0.15 THEN 'moderate' ELSE 'low' END AS severity FROM dr)"""


@query(f"WITH {_DRIFT} SELECT run_id AS curr_run, coalesce(severity, 'none') AS severity, severity IS NOT NULL AS available, label_churn, mp AS momentum_score_psi, rp AS risk_score_psi FROM runs LEFT JOIN sev ON curr_run = run_id")
def f7_drift_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drift_report(preds(spark, sf_dir)).select("curr_run", "severity", "available", "label_churn", "momentum_score_psi", "risk_score_psi")


@query(f"WITH {_DRIFT} UNPIVOT (SELECT curr_run AS run_id, 'monitor' AS model_name, label_churn, mp AS momentum_score_psi, rp AS risk_score_psi FROM sev) ON label_churn, momentum_score_psi, risk_score_psi INTO NAME metric_name VALUE metric_value")
def f8_drift_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.drift_report(preds(spark, sf_dir)).filter("available").select(F.col("curr_run").alias("run_id"), F.lit("monitor").alias("model_name"), "label_churn", "momentum_score_psi", "risk_score_psi")
    return C.melt(d, ["run_id", "model_name"], ["label_churn", "momentum_score_psi", "risk_score_psi"])


@query(f"WITH {_PAIRS} SELECT prev AS prev_run, run_id AS curr_run FROM runs WHERE prev IS NOT NULL")
def f9_consecutive_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.run_order(preds(spark, sf_dir))


_STATUS = """st AS (SELECT run_id, unnest([{'source': 'downloads', 'ok': downloads_7d IS NOT NULL}, {'source': 'releases', 'ok': days_since_last_release IS NOT NULL},
{'source': 'scorecard', 'ok': scorecard_overall IS NOT NULL}, {'source': 'github', 'ok': bus_factor IS NOT NULL}], recursive := true) FROM snap),
rates AS (SELECT run_id, source, round(avg(ok::INT), 3) AS rate FROM st GROUP BY run_id, source)"""


def with_status(s: DataFrame) -> DataFrame:
    """Snapshots with the per-source success map as JSON."""
    groups = {"downloads": "downloads_7d", "releases": "days_since_last_release", "scorecard": "scorecard_overall", "github": "bus_factor"}
    return s.withColumn("source_status", F.to_json(F.create_map(*[x for k, c in groups.items() for x in (F.lit(k), F.col(c).isNotNull())])))


@query(f"WITH {_SNAP}, {_STATUS} SELECT * FROM rates")
def h1_source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.source_rates(with_status(snaps(spark, sf_dir)))


_HEALTH = """health AS (SELECT run_id, CASE WHEN min(rate) = 0 THEN 'error' WHEN min(rate) < 0.7 THEN 'warning' ELSE 'ok' END AS status,
string_agg(source || ' ' || floor(rate * 100 + 1e-9)::INT || '%', ', ' ORDER BY source) AS summary FROM rates GROUP BY run_id)"""


@query(f"WITH {_SNAP}, {_STATUS}, {_HEALTH} SELECT * FROM health")
def h2_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.source_health(Q.source_rates(with_status(snaps(spark, sf_dir))))


_QUALITY = """ql AS (SELECT run_id, count(*) AS n_rows, count(*) - count(DISTINCT name) AS duplicates, round(avg((downloads_7d IS NOT NULL)::INT), 3) AS coverage,
round(avg((stars IS NULL)::INT), 3) AS null_stars, round(avg((dependent_repos_count IS NULL)::INT), 3) AS null_dependent_repos_count,
round(avg((scorecard_overall IS NULL)::INT), 3) AS null_scorecard_overall, round(avg((bus_factor IS NULL)::INT), 3) AS null_bus_factor FROM {src} GROUP BY run_id),
qs AS (SELECT *, CASE WHEN duplicates = 0 AND coverage >= 0.8 THEN 'ok' ELSE 'warning' END AS status FROM ql)"""
_DOUBLED = "(SELECT * FROM snap UNION ALL SELECT * FROM snap WHERE stars % 4 = 0)"


@query(f"WITH {_SNAP}, {_QUALITY.replace('{src}', _DOUBLED)} SELECT * FROM qs")
def h3_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snaps(spark, sf_dir)
    return Q.quality_report(s.unionAll(s.filter("stars % 4 = 0")))


@query(f"""WITH {_SNAP}, {_STATUS}, {_HEALTH}, {_QUALITY.replace('{src}', 'snap')}, {_DRIFT}
SELECT *, last_day(strptime(run_id, '%Y%m'))::DATE AS ts, '' AS artifact_url FROM (SELECT run_id, 'ingest' AS agent, 'check_sources' AS action, status, summary FROM health
UNION ALL SELECT run_id, 'quality', 'validate_table', status, round(coverage * 100)::INT || '% coverage, ' || duplicates || ' duplicates' FROM qs
UNION ALL SELECT run_id, 'monitor', 'monitor_drift', CASE WHEN severity = 'high' THEN 'warning' ELSE 'ok' END, 'drift ' || coalesce(severity, 'none') FROM runs LEFT JOIN sev ON curr_run = run_id) u""")
def h6_activity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snaps(spark, sf_dir)
    return Q.activity_rows(Q.source_health(Q.source_rates(with_status(s))), Q.quality_report(s), C.drift_report(preds(spark, sf_dir)), F.last_day(F.to_date("run_id", "yyyyMM")))


@query(f"""WITH {_SNAP} SELECT 'now' AS run_id, 'success' AS status, '{{"ingest":1.5,"quality":0.25}}' AS stages,
'{{"rows":' || count(*) || ',"names":' || count(DISTINCT name) || ',"without_repo":' || count(*) FILTER (WHERE repo IS NULL) || '}}' AS counts FROM snap""")
def h7_run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of a run over all snapshots."""
    counts = snaps(spark, sf_dir).agg(F.count("*").alias("rows"), F.count_distinct("name").alias("names"), F.count_if(F.col("repo").isNull()).alias("without_repo"))
    return Q.run_record(counts, "now", {"ingest": 1.5, "quality": 0.25})


_I1 = f"{_SNAP}, {_PRED}, {_LATEST}, {_LATEST_PRED}, lj AS (SELECT lp.*, cur.* EXCLUDE (run_id, snapshot_date, name, category, ingested_at) FROM lp LEFT JOIN cur ON cur.name = lp.name)"


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.latest_predictions(preds(spark, sf_dir), snaps(spark, sf_dir))


@query(f"WITH {_I1} SELECT name, category, momentum_score, risk_score, risk_level, repo, stars, forks, vuln_count, bus_factor, archived, json_extract_string(top_reasons, '$[0]') AS first_reason FROM lj")
def i1_latest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).select(
        "name", "category", "momentum_score", "risk_score", "risk_level", "repo", "stars", "forks", "vuln_count", "bus_factor", "archived",
        F.get("top_reasons", F.lit(0)).alias("first_reason"),
    )


@query(f"WITH {_PRED} SELECT run_id, name, CASE WHEN run_id::INT % 4 = 0 THEN growth_pred_70d * 2 ELSE growth_pred_70d END AS growth_pred_70d FROM pred")
def i2_legacy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = preds(spark, sf_dir).select("run_id", "name", "growth_pred_70d")
    new = p.filter("CAST(run_id AS INT) % 4 <> 0")
    old = p.filter("CAST(run_id AS INT) % 4 = 0").select("run_id", "name", (F.col("growth_pred_70d") * 2).alias("growth_pred_28d"))
    return V.merge_legacy(new.unionByName(old, allowMissingColumns=True), "growth_pred_70d", "growth_pred_28d")


@query(f"WITH {_I1} SELECT count(*) AS tracked, round(avg(momentum_score), 1) AS avg_momentum, count(*) FILTER (risk_level = 'high') AS high_risk, count(*) FILTER (momentum_label = 'high') AS rising FROM lj")
def i3_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.overview(latest(spark, sf_dir))


@query(f"WITH {_I1} SELECT name, momentum_score FROM lj ORDER BY momentum_score DESC, name LIMIT 8")
def i4_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.top(latest(spark, sf_dir).select("name", "momentum_score"), "momentum_score")


@query(f"WITH {_I1} SELECT name, risk_score FROM lj ORDER BY risk_score DESC, name LIMIT 8")
def i4_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.top(latest(spark, sf_dir).select("name", "risk_score"), "risk_score")


@query(f"WITH {_I1} SELECT category, count(*) AS n FROM lj GROUP BY category")
def i5_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.category_counts(latest(spark, sf_dir))


@query(f"WITH {_I1} SELECT name, category, repo, momentum_score, risk_score, growth_pred_70d, momentum_label, risk_level, stars, downloads_28d, dependent_repos_count, vuln_count, scorecard_overall FROM lj")
def i6_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.leaderboard(latest(spark, sf_dir))


@query(f"""WITH {_SNAP}, {_PRED}, {_LATEST_PRED}, one AS (SELECT min(s_name) AS name FROM supplier)
SELECT 'prediction' AS part, CAST(predicted_at AS DATE) AS date, momentum_score, risk_score, NULL::BIGINT AS downloads, NULL::BIGINT AS stars, NULL::BIGINT AS forks, NULL::BIGINT AS open_issues, NULL::BIGINT AS downloads_7d FROM lp WHERE name = (SELECT name FROM one)
UNION ALL SELECT 'history', date, NULL, NULL, downloads, NULL, NULL, NULL, NULL FROM ({X.history_named(True)}) h WHERE name = (SELECT name FROM one)
UNION ALL SELECT 'snapshots', snapshot_date, NULL, NULL, NULL, stars, forks, open_issues, downloads_7d FROM snap WHERE name = (SELECT name FROM one)""")
def i7_package_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three parts of one name's page in one table."""
    name = spark.read.parquet(f"{sf_dir}/supplier.parquet").agg(F.min("s_name").alias("n")).first()["n"]
    d = V.detail(name, preds(spark, sf_dir), X.read(spark, sf_dir, X.history_named()), snaps(spark, sf_dir))
    parts = {
        "prediction": [F.col("predicted_at").cast("date").alias("date"), "momentum_score", "risk_score"], "history": ["date", "downloads"],
        "snapshots": [F.col("snapshot_date").alias("date"), "stars", "forks", "open_issues", "downloads_7d"],
    }
    rows = [d[k].select(F.lit(k).alias("part"), *c) for k, c in parts.items()]
    return rows[0].unionByName(rows[1], allowMissingColumns=True).unionByName(rows[2], allowMissingColumns=True)


@query(f"WITH m AS ({X.model_runs(True)}) SELECT run_id, model_name, CAST(trained_at AS DATE) AS trained_on, metric_name, metric_value FROM m WHERE NOT isnan(metric_value)")
def i8_model_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = X.read(spark, sf_dir, X.model_runs()).filter(~F.isnan("metric_value"))
    return m.select("run_id", "model_name", F.col("trained_at").cast("date").alias("trained_on"), "metric_name", "metric_value").orderBy("trained_on", "model_name")


@query("SELECT event_id, ts, json_extract_string(props, '$.k') AS k FROM events ORDER BY ts DESC, event_id LIMIT 80")
def i9_activity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "props")
    return V.feed(log, "ts", 80, ("props",)).select("event_id", "ts", F.col("props")["k"].alias("k"))


@query(f"WITH {_PRED}, {_LATEST_PRED} SELECT run_id, count(*) AS tracked, max(risk_score) AS worst FROM lp GROUP BY run_id")
def i10_latest_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = preds(spark, sf_dir).groupBy("run_id").agg(F.max("predicted_at").alias("created_at"), F.to_json(F.struct(F.count("*").alias("tracked"), F.max("risk_score").alias("worst"))).alias("payload"))
    return V.latest_payload(p, "tracked bigint, worst double")


@query(f"WITH {_SNAP}, {_LATEST}, {_STATUS} SELECT source, rate FROM rates WHERE run_id = (SELECT any_value(run_id) FROM cur)")
def i11_source_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.source_rates(with_status(V.latest_run(snaps(spark, sf_dir), "snapshot_date"))).select("source", "rate").orderBy("source")


_WHY = "array_to_string(from_json(top_reasons, '[\"VARCHAR\"]'), ', ')"


@query(f"""WITH {_PRED}, {_LATEST_PRED}, a AS (SELECT *, row_number() OVER (ORDER BY momentum_score DESC, name) AS m, row_number() OVER (ORDER BY risk_score DESC, name) AS r, {_WHY} AS why FROM lp)
SELECT 0 AS section, 0 AS pos, 'Tracked ' || count(*) || ' packages' AS line FROM lp UNION ALL
SELECT 1, (m - 1)::INT, format('{{}} | {{:.0f}} | {{}}', name, round(momentum_score + 1e-9), why) FROM a WHERE m <= 6 UNION ALL
SELECT 2, (r - 1)::INT, format('{{}} | {{:.0f}} | {{}} | {{}}', name, round(risk_score + 1e-9), risk_level, why) FROM a WHERE r <= 6""")
def i12_daily_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.latest_run(preds(spark, sf_dir), "predicted_at").withColumn("top_reasons", F.from_json("top_reasons", "array<string>"))
    return V.brief_lines(p)
