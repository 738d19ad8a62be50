"""Queries of model evaluation, gating, promotion and of the validation statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.lineage import cut
from seriesforge.operators import models as M
from seriesforge.operators import quality as Q
from seriesforge.operators import risk as R
from seriesforge.operators import series as S
from seriesforge.operators import stats as J
from seriesforge.operators.scoring import melt, reason_texts
from seriesforge.plans import fixtures as X
from seriesforge.plans.registry import ORACLES, query, rounded
from seriesforge.plans.risk_queries import snaps
from seriesforge.plans.series_queries import TRAINING_SQL, VALIDATION_CTE, brand

_SC = f"sc AS MATERIALIZED ({X.scored(True)})"
_BIN = f"bn AS ({X.binary(True)})"
_RUNS = f"mr AS MATERIALIZED ({X.model_runs(True)})"


FEATURES = list(S.FEATURES)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.read(spark, sf_dir, X.scored())


def binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.read(spark, sf_dir, X.binary())


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.read(spark, sf_dir, X.model_runs())


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.training_frame(brand(spark, sf_dir))


def _metrics_sql(src: str, yhat: str = "yhat", by: str = "") -> str:
    k = f"{by}, " if by else ""
    g = f"GROUP BY {by}" if by else ""
    j = f"JOIN (SELECT {k}avg(y) AS m FROM {src} {g}) mm {'USING (' + by + ')' if by else 'ON true'}"
    return f"""SELECT {k}count(*) AS n, CASE WHEN count(*) < 3 OR sum((y - m) * (y - m)) = 0 THEN 'NaN'::DOUBLE ELSE round(1 - sum((y - {yhat}) * (y - {yhat})) / sum((y - m) * (y - m)), 6) END AS r2,
round(avg(abs(y - {yhat})), 6) AS mae, round(sqrt(avg((y - {yhat}) * (y - {yhat}))), 6) AS rmse FROM {src} {j} {g}"""


def _rank(c: str, over: str = "") -> str:
    return f"(rank() OVER ({over} ORDER BY {c}) + (count(*) OVER (PARTITION BY {(over.replace('PARTITION BY ', '') + ', ') if over else ''}{c}) - 1) / 2)"


@query(f"""WITH t AS ({TRAINING_SQL}) SELECT name, feature_date, row_number() OVER (ORDER BY feature_date, name) > floor((SELECT count(*) FROM t) * 0.8) AS is_test FROM t""")
def e1_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.time_split(training(spark, sf_dir).select("name", "feature_date"))


@query(f"WITH {_SC} {_metrics_sql('sc')}")
def e3_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.regression_metrics(scored(spark, sf_dir)))


@query(f"WITH {_SC} {_metrics_sql('sc', by='t')}")
def j1_metrics_by_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.regression_metrics(scored(spark, sf_dir), ["t"]))


@query(f"WITH {_SC}, r AS (SELECT {_rank('y')} AS a, {_rank('yhat')} AS b FROM sc) SELECT round(corr(a, b), 6) AS spearman FROM r")
def j2_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.spearman(scored(spark, sf_dir), "y", "yhat"))


@query(f"WITH {_SC}, r AS (SELECT t, {_rank('y', 'PARTITION BY t')} AS a, {_rank('yhat', 'PARTITION BY t')} AS b FROM sc) SELECT t, round(corr(a, b), 6) AS spearman FROM r GROUP BY t")
def j2_spearman_by_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.spearman(scored(spark, sf_dir), "y", "yhat", ["t"]))


@query(f"WITH {_SC} SELECT round(1 - avg((y - yhat) ** 2) / greatest(avg((y - persistence) ** 2), 1e-9), 6) AS skill FROM sc")
def j3_skill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.skill(scored(spark, sf_dir)))


_SPLIT = f"{_SC}, sp AS (SELECT *, t >= (SELECT min(t) FROM (SELECT DISTINCT t FROM sc ORDER BY t DESC LIMIT 2)) AS is_test FROM sc)"


@query(f"""WITH {_SPLIT}, l AS (SELECT y, unnest([{{'baseline': 'persistence', 'yhat': persistence}}, {{'baseline': 'zero', 'yhat': 0::DOUBLE}},
{{'baseline': 'train_mean', 'yhat': (SELECT avg(y) FROM sp WHERE NOT is_test)}}], recursive := true) FROM sp WHERE is_test) {_metrics_sql('l', by='baseline')}""")
def j4_naive_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.naive_baselines(J.last_origins(scored(spark, sf_dir))))


_LINE = "ln AS (SELECT regr_slope(y, persistence) AS slope, regr_intercept(y, persistence) AS intercept FROM sp WHERE NOT is_test), cp AS (SELECT name, t, y, slope, intercept, intercept + slope * persistence AS yhat FROM sp, ln WHERE is_test)"


@query(f"WITH {_SPLIT}, {_LINE} SELECT name, t, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(yhat, 6) AS yhat FROM cp")
def j5_calibrated_persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.calibrated_persistence(J.last_origins(scored(spark, sf_dir))).select("name", "t", "slope", "intercept", "yhat"))


@query(f"WITH {_SPLIT} SELECT name, t, is_test FROM sp")
def j6_last_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.last_origins(scored(spark, sf_dir)).select("name", "t", "is_test")


_VF = f"WITH {VALIDATION_CTE}"


@query(f"""{_VF}, s AS (SELECT count(DISTINCT t) AS n_origins, max(t) - min(t) AS span_days FROM vf) SELECT n_origins, span_days, span_days > 140 AS feasible, round(greatest(span_days, 1) / 70, 2) AS independent_forecasts,
CASE WHEN span_days <= 70 THEN 'all targets overlap' ELSE 'limited separation' END AS verdict FROM s""")
def j7_origin_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.origin_diagnostics(S.validation_frame(brand(spark, sf_dir)))


def _folds(purge: bool) -> str:
    until = "f.t - 70" if purge else "l.t"
    return f"""ix AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT t FROM vf)),
k AS (SELECT DISTINCT unnest(range(4)) AS k, n FROM ix), b AS (SELECT k, n, floor((0.5 + 0.5 * k / 4) * (n - 1))::BIGINT AS lo, floor((0.5 + 0.5 * (k + 1) / 4) * (n - 1))::BIGINT AS hi FROM k),
fo AS (SELECT k + 1 AS fold, ({until})::DATE AS train_until, f.t AS test_from, h.t AS test_until FROM b JOIN ix l ON l.i = lo JOIN ix f ON f.i = least(lo + 1, b.n - 1) JOIN ix h ON h.i = hi)"""


_COUNTS = "SELECT * FROM (SELECT fold, count(*) FILTER (t <= train_until) AS n_train, count(*) FILTER (t BETWEEN test_from AND test_until) AS n_test FROM vf, fo GROUP BY fold) WHERE n_train >= 100 AND n_test >= 20"


@query(f"{_VF}, {_folds(True)} {_COUNTS}")
def j8_purged_walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = S.validation_frame(brand(spark, sf_dir)).select("name", "t")
    return J.fold_rows(v, J.walk_forward_folds(v))


@query(f"{_VF}, {_folds(False)} {_COUNTS}")
def j9_unpurged_walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = S.validation_frame(brand(spark, sf_dir)).select("name", "t")
    return J.fold_rows(v, J.walk_forward_folds(v, purge=False))


def _walk_forward(spark: SparkSession, sf_dir: str, purge: bool) -> DataFrame:
    v = S.validation_frame(brand(spark, sf_dir))
    return M.walk_forward(v, J.walk_forward_folds(v.select("t"), purge=purge), FEATURES)


@query()
def j8_purged_fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fits on the folds of ``j8_purged_walk_forward``."""
    return _walk_forward(spark, sf_dir, True)


@query()
def j9_unpurged_fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fits on the folds of ``j9_unpurged_walk_forward``: optimistic, as training targets reach into the tests."""
    return _walk_forward(spark, sf_dir, False)


@query()
def j10_disjoint_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold figures of the growth model on names it did not see."""
    v = S.validation_frame(brand(spark, sf_dir))
    return M.disjoint_cv(v.withColumns({"feature_date": F.col("t"), M.TARGET: F.col("y")}), FEATURES)


_GROUP = """gs AS (SELECT name, row_number() OVER (ORDER BY count(*) DESC, name) - 1 AS pos FROM {src} GROUP BY name),
gf AS (SELECT name, (CASE WHEN floor(pos / 5) % 2 = 0 THEN pos % 5 ELSE 4 - pos % 5 END)::INT AS fold FROM gs)"""


@query(f"WITH t AS ({TRAINING_SQL}), {_GROUP.replace('{src}', 't')} SELECT name, fold FROM gf")
def e12_group_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.stats.group_folds(training(spark, sf_dir))


@query(f"""WITH {_SC}, {_GROUP.replace('{src}', 'sc')}, w AS (SELECT sc.*, fold FROM sc JOIN gf USING (name)), o AS (
SELECT v.name, v.y, l.a + l.b * v.persistence AS yhat FROM w v JOIN (SELECT f.fold, regr_intercept(w.y, w.persistence) AS a, regr_slope(w.y, w.persistence) AS b FROM (SELECT DISTINCT fold FROM gf) f JOIN w ON w.fold <> f.fold GROUP BY f.fold) l ON l.fold = v.fold)
{_metrics_sql('o')}""")
def j10_disjoint_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole names held out; the line of each fold is fitted on the others' names."""
    s = scored(spark, sf_dir)
    folded = s.join(J.group_folds(s), "name")
    held = folded.select("fold").distinct().withColumnRenamed("fold", "held")
    lines = folded.join(F.broadcast(held), F.col("fold") != F.col("held")).groupBy("held").agg(F.regr_intercept("y", "persistence").alias("a"), F.regr_slope("y", "persistence").alias("b"))
    out = folded.join(F.broadcast(lines), F.col("fold") == F.col("held")).withColumn("yhat", F.col("a") + F.col("b") * F.col("persistence"))
    return rounded(J.regression_metrics(out))


#: The five primes of XXH64.
_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def _hashed_sql(src: str, out: str, columns: list[str], seed: int = 11) -> str:
    """CTE ``out``: the rows of src with ``h`` = xxhash64(columns..., seed), signed, as Spark gives it for bigint columns and an int."""
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in _PRIMES)
    low = f"{(1 << 64) - 1}::UHUGEINT"
    sql = f"SELECT *, 42::UHUGEINT AS h FROM {src}"

    def step(expression: str) -> None:
        nonlocal sql
        sql = f"SELECT * REPLACE (({expression}) & {low} AS h) FROM ({sql})"

    def turn(x: str, by: int) -> str:
        return f"((({x} << {by}) & {low}) + ({x} >> {64 - by}))"

    def last_mix() -> None:
        for shift, prime in ((33, p2), (29, p3), (32, "1::UHUGEINT")):
            step(f"xor(h, h >> {shift}) * {prime}")

    for c in columns:
        word = f"(({c}::UHUGEINT * {p2}) & {low})"
        step(f"xor((h + {p5} + 8) & {low}, ({turn(word, 31)} * {p1}) & {low})")
        step(f"{turn('h', 27)} * {p1} + {p4}")
        last_mix()
    step(f"xor((h + {p5} + 4) & {low}, ({seed}::UHUGEINT * {p1}) & {low})")
    step(f"{turn('h', 23)} * {p2} + {p3}")
    last_mix()
    return f"{out} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h >= {1 << 63} THEN (h::HUGEINT - {1 << 64})::BIGINT ELSE h::BIGINT END AS h) FROM ({sql}))"


_NUMBERED = f"""{_SC}, nu AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY name) - 1 AS u, row_number() OVER (ORDER BY name, t, y, yhat) - 1 AS slot, y, yhat, persistence,
2 * rank() OVER (ORDER BY y) + count(*) OVER (PARTITION BY y) - 1 AS ry, 2 * rank() OVER (ORDER BY yhat) + count(*) OVER (PARTITION BY yhat) - 1 AS rp FROM sc WHERE y IS NOT NULL AND yhat IS NOT NULL)"""
_BOOT = f"""{_NUMBERED}, nn AS (SELECT count(DISTINCT u) AS n FROM nu), id AS (SELECT unnest(range(2000 * n)) AS id, n FROM nn), {_hashed_sql('id', 'dr', ['id'])},
tm AS (SELECT id // n AS b, ((h % n) + n) % n AS u, count(*) AS m FROM dr GROUP BY ALL), ex AS MATERIALIZED (SELECT b, m, y, yhat, persistence FROM tm JOIN nu ON nu.u = tm.u),
hy AS (SELECT b, y, sum(m) AS k FROM ex GROUP BY b, y), hp AS (SELECT b, yhat, sum(m) AS k FROM ex GROUP BY b, yhat),
wy AS (SELECT b, y, sum(k) OVER (PARTITION BY b ORDER BY y) - (k - 1) / 2 AS ry FROM hy), wp AS (SELECT b, yhat, sum(k) OVER (PARTITION BY b ORDER BY yhat) - (k - 1) / 2 AS rp FROM hp),
su AS (SELECT ex.b, count(DISTINCT ex.y) AS varied, sum(m)::DOUBLE AS w, sum(m * ry) AS a, sum(m * rp) AS q, sum(m * ry * rp) AS aq, sum(m * ry * ry) AS aa, sum(m * rp * rp) AS qq, sum(m * ex.y) AS sy, sum(m * ex.y * ex.y) AS syy,
  sum(m * (ex.y - ex.yhat) ** 2) AS see, coalesce(sum(m * (ex.y - persistence) ** 2), 0) AS spp FROM ex JOIN wy ON wy.b = ex.b AND wy.y = ex.y JOIN wp ON wp.b = ex.b AND wp.yhat = ex.yhat GROUP BY ex.b),
me AS (SELECT 'spearman' AS metric, (aq - a * q / w) / sqrt(nullif(greatest((aa - a * a / w) * (qq - q * q / w), 0), 0)) AS v FROM su WHERE varied >= 3
  UNION ALL SELECT 'r2', 1 - see / nullif(syy - sy * sy / w, 0) FROM su WHERE varied >= 3 UNION ALL SELECT 'skill', 1 - see / greatest(spp, 1e-9) FROM su WHERE varied >= 3)"""


@query(f"WITH {_BOOT} SELECT metric, round(quantile_cont(v, 0.025), 6) AS lo, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.975), 6) AS hi FROM me GROUP BY metric")
def j11_cluster_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.cluster_bootstrap(scored(spark, sf_dir)))


def _permuted_sql(moved: str) -> str:
    return f"""SELECT round(o.observed, 6) AS observed, round((1 + count(*) FILTER (WHERE pr.s >= o.seen)) / 2001, 6) AS p
FROM (SELECT v.b, sum(v.ry * nu.rp) AS s FROM ({moved}) v JOIN nu ON nu.slot = v.slot GROUP BY v.b) pr, (SELECT corr(ry, rp) AS observed, sum(ry * rp) AS seen FROM nu) o GROUP BY o.observed"""


_UNITS = "un AS (SELECT u, count(*) AS k, min(slot) AS first FROM nu GROUP BY u), bu AS (SELECT b, u, k, first FROM un, (SELECT unnest(range(2000)) AS b))"
_BLOCKS = "SELECT b, ry, o + slot - first AS slot FROM (SELECT b, u, first, sum(k) OVER (PARTITION BY b ORDER BY h, u) - k AS o FROM dr) d JOIN nu ON nu.u = d.u"


@query(f"WITH {_NUMBERED}, {_UNITS}, {_hashed_sql('bu', 'dr', ['b', 'u'])} {_permuted_sql(_BLOCKS)}")
def j12_block_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.permutation_p(scored(spark, sf_dir)))


@query(f"""WITH {_NUMBERED}, br AS (SELECT b, slot AS place, ry FROM nu, (SELECT unnest(range(2000)) AS b)), {_hashed_sql('br', 'dr', ['b', 'place'])}
{_permuted_sql("SELECT b, ry, row_number() OVER (PARTITION BY b ORDER BY h, place) - 1 AS slot FROM dr")}""")
def j13_row_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.permutation_p(scored(spark, sf_dir), blocks=False))


def _dm(src: str, lag: str, by: str = "") -> str:
    k, p = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    g = f"GROUP BY {by}" if by else ""
    on = f"a.{by} = b.{by} AND " if by else ""
    ka = f"a.{by}, " if by else ""
    return f"""dp AS (SELECT {k}d - avg(d) OVER ({p}) AS c, row_number() OVER ({p}ORDER BY ord) AS pos, count(*) OVER ({p}) AS n, avg(d) OVER ({p}) AS m FROM {src}),
dl AS (SELECT {ka}b.pos - a.pos AS lag, avg(a.c * b.c) AS cv, any_value(a.n) AS n, any_value(a.m) AS m FROM dp a JOIN dp b ON {on}b.pos >= a.pos AND b.pos - a.pos <= least({lag}, a.n - 1) GROUP BY {ka}b.pos - a.pos),
dm AS (SELECT {k}any_value(n) AS n, any_value(m) AS mean_loss_diff, sum(CASE WHEN lag = 0 THEN cv ELSE 2 * (1 - lag / (least({lag}, n - 1) + 1)) * cv END) AS v FROM dl {g})"""


#: Two-sided normal p-value in DuckDB: the error function by its series of positive terms.
_P = "CASE WHEN abs(z) > 9 THEN 0 ELSE greatest(0, 1 - list_sum(list_transform(range(0, 200), lambda k: exp((2 * k + 1) * ln(greatest(abs(z), 1e-12) / sqrt(2)) - lgamma(k + 1.5) - z * z / 2)))) END"


@query(f"""WITH {_SC}, ls AS (SELECT (y - yhat) ** 2 - (y - persistence) ** 2 AS d, {{'a': name, 'b': t}} AS ord FROM sc), {_dm('ls', '69')}
SELECT n, round(mean_loss_diff, 6) AS mean_loss_diff, round(z, 5) AS dm_stat, round({_P}, 5) AS p_value, CASE WHEN mean_loss_diff < 0 THEN 'model' ELSE 'benchmark' END AS favored
FROM (SELECT *, mean_loss_diff / sqrt(greatest(v, 1e-12) / n) AS z FROM dm) x""")
def j14_diebold_mariano(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scored(spark, sf_dir).withColumn("d", (F.col("y") - F.col("yhat")) ** 2 - (F.col("y") - F.col("persistence")) ** 2)
    out = J.diebold_mariano(d, 70)
    return out.select("n", F.round("mean_loss_diff", 6).alias("mean_loss_diff"), F.round("dm_stat", 5).alias("dm_stat"), F.round("p_value", 5).alias("p_value"), "favored")


@query(f"""WITH {_SC}, mn AS (SELECT name, avg(y) AS y, avg(yhat) AS yhat, count(*) AS k FROM sc GROUP BY name), wi AS (SELECT sc.y - mn.y AS y, sc.yhat - mn.yhat AS yhat FROM sc JOIN mn USING (name))
SELECT b.n AS n_names, (SELECT median(k) FROM mn)::DOUBLE AS median_rows, b.r2 AS r2_between, CASE WHEN (SELECT median(k) FROM mn) >= 3 THEN w.r2 END AS r2_within FROM ({_metrics_sql('mn')}) b, ({_metrics_sql('wi')}) w""")
def j15_between_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.between_within(scored(spark, sf_dir)))


@query(f"""WITH {_SC}, a AS (SELECT DISTINCT name FROM (SELECT name FROM sc ORDER BY yhat DESC, name, t LIMIT 10)), b AS (SELECT DISTINCT name FROM (SELECT name FROM sc ORDER BY y DESC, name, t LIMIT 10)), q AS (SELECT quantile_cont(y, 0.8) AS c FROM sc)
SELECT round(regr_slope(yhat, y), 6) AS slope, round(avg(abs(yhat - y)) FILTER (y >= c), 6) AS head_mae, round(avg(abs(yhat - y)), 6) AS mae, round(avg(yhat - y) FILTER (y >= c), 6) AS head_bias, (SELECT count(*) FROM a JOIN b USING (name)) AS overlap FROM sc, q""")
def j16_head_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.head_reliability(scored(spark, sf_dir)))


@query(f"{_VF} SELECT count(*) AS n_rows, count(DISTINCT name) AS n_names, round(70 / 3, 6) AS overlap, round(count(*) / (70 / 3), 6) AS effective_rows, round((max(t) - min(t)) / 70, 6) AS independent_windows FROM vf")
def j17_effective_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(J.effective_sample(S.validation_frame(brand(spark, sf_dir))))


_CENTRED = VALIDATION_CTE.replace("RANGE BETWEEN 27 PRECEDING AND CURRENT ROW", "RANGE BETWEEN 14 PRECEDING AND 14 FOLLOWING")


def _leak(cte: str, mode: str) -> str:
    return f"""(WITH {cte}, sp AS (SELECT *, t >= (SELECT min(t) FROM (SELECT DISTINCT t FROM vf ORDER BY t DESC LIMIT 2)) AS is_test FROM vf), {_LINE} SELECT '{mode}' AS smoother, * FROM ({_metrics_sql('cp')}))"""


@query(f"SELECT * FROM {_leak(VALIDATION_CTE, 'trailing')} UNION ALL SELECT * FROM {_leak(_CENTRED, 'centered')}")
def j18_leak_quantification(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, parts = brand(spark, sf_dir), []
    for mode, smoother in (("trailing", S.smooth_trailing), ("centered", S.smooth_centered)):
        test = J.calibrated_persistence(J.last_origins(S.validation_frame(h, smoother).select("name", "t", "y", "persistence")))
        parts.append(J.regression_metrics(test).withColumn("smoother", F.lit(mode)))
    return rounded(parts[0].unionByName(parts[1]))


@query(f"""WITH {_SC}, a AS (SELECT unnest([{{'stat': 'mean_y', 'value': avg(y)}}, {{'stat': 'max_y', 'value': max(y)}}, {{'stat': 'n', 'value': count(*)::DOUBLE}}], recursive := true) FROM sc)
SELECT stat, round(CASE WHEN stat = 'max_y' THEN value + 0.5 WHEN stat = 'n' THEN value + 9 ELSE value END, 6) AS expected, round(value, 6) AS actual, CASE WHEN stat = 'max_y' THEN 'fail' ELSE 'pass' END AS status FROM a""")
def j19_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = scored(spark, sf_dir).agg(F.avg("y").alias("mean_y"), F.max("y").alias("max_y"), F.count("*").alias("n")).withColumn("k", F.lit(1))
    actual = melt(row, ["k"], ["mean_y", "max_y", "n"]).select(F.col("metric_name").alias("stat"), F.col("metric_value").alias("value"))
    off = F.when(F.col("stat") == "max_y", 0.5).when(F.col("stat") == "n", 9.0).otherwise(0.0)
    recorded = actual.select("stat", F.when(F.col("stat") == "n", "info").otherwise("exact").alias("kind"), (F.col("value") + off).alias("value"))
    return rounded(J.cross_check(recorded, actual))


@query("SELECT round(datediff('second', max(ts), TIMESTAMP '2024-02-01') / 3600, 2) AS age_hours, round(datediff('second', max(ts), TIMESTAMP '2024-02-01') / 3600, 2) > 36 AS stale FROM events")
def j20_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.freshness(spark.read.parquet(f"{sf_dir}/events.parquet").select("ts"), F.lit("2024-02-01").cast("timestamp"))


@query(f"WITH {_BIN} SELECT name, label, ((row_number() OVER (PARTITION BY label ORDER BY name) - 1) % 5)::INT AS fold FROM bn")
def e8_stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.stratified_folds(binary(spark, sf_dir), 5).select("name", "label", "fold")


@query(f"WITH {_BIN}, r AS (SELECT label, {_rank('score')} AS rk FROM bn), s AS (SELECT count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg, sum(rk) FILTER (label = 1) AS s FROM r) SELECT n_pos, n_neg, round((s - n_pos * (n_pos + 1) / 2) / (n_pos * n_neg), 6) AS auc FROM s")
def e10_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.roc_auc(binary(spark, sf_dir)))


@query(f"""WITH {_BIN}, p AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM bn GROUP BY score)
SELECT round(score, 6) AS threshold, round(sum(q) OVER w / sum(q) OVER (), 6) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 6) AS tpr FROM p WINDOW w AS (ORDER BY score DESC) UNION ALL SELECT NULL, 0, 0""")
def e11_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.roc_points(binary(spark, sf_dir)))


@query(f"WITH {_SC}, r AS (SELECT *, row_number() OVER (ORDER BY yhat, name, t) AS r, count(*) OVER () AS n FROM sc) SELECT greatest(1, ceil((r - 1) * 10 / (n - 1)))::INT AS decile, count(*) AS n, round(avg(yhat), 6) AS mean_pred, round(avg(y), 6) AS mean_actual FROM r GROUP BY 1")
def e18_calibration_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.calibration_deciles(scored(spark, sf_dir)))


@query(f"WITH {_SC} SELECT name, t, round(y, 6) AS y, round(yhat, 6) AS yhat FROM sc ORDER BY md5(name || '|' || strftime(t, '%Y-%m-%d') || '|7'), name, t LIMIT 300")
def e19_scatter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.scatter_sample(scored(spark, sf_dir)).select("name", "t", "y", "yhat"))


def _gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate figures of the line model: fitted on the earlier 80 % and tried on the rest; and fitted in folds of whole names."""
    s = cut(scored(spark, sf_dir))
    split = M.time_split(s, date="t")
    line = split.filter("NOT is_test").agg(F.regr_intercept("y", "persistence").alias("a"), F.regr_slope("y", "persistence").alias("b"))
    yhat = (F.col("a") + F.col("b") * F.col("persistence")).alias("yhat")
    seen = split.filter("is_test").crossJoin(F.broadcast(line)).select("y", yhat)
    folded = s.join(J.group_folds(s), "name")
    held = folded.select("fold").distinct().withColumnRenamed("fold", "held")
    lines = folded.join(F.broadcast(held), F.col("fold") != F.col("held")).groupBy("held").agg(F.regr_intercept("y", "persistence").alias("a"), F.regr_slope("y", "persistence").alias("b"))
    unseen = folded.join(F.broadcast(lines), F.col("fold") == F.col("held")).select("y", yhat)
    n = s.agg(F.lit("line").alias("model_name"), F.count("*").alias("n"))
    same, oof = (J.regression_metrics(d).select("r2").crossJoin(J.spearman(d, "y", "yhat")) for d in map(cut, (seen, unseen)))
    return n.crossJoin(same).crossJoin(oof.select(F.col("r2").alias("oof_r2"), F.col("spearman").alias("oof_spearman")))


_RHO = "(SELECT corr(a, b) FROM (SELECT {a} AS a, {b} AS b FROM {src}))"
_RHOS = {src: _RHO.format(a=_rank("y"), b=_rank("yhat"), src=src) for src in ("gh", "go")}
_GATE = f"""{_SC}, {_GROUP.replace('{src}', 'sc')}, gsp AS (SELECT *, row_number() OVER (ORDER BY t, name) > floor((SELECT count(*) FROM sc) * 0.8) AS is_test FROM sc),
gl AS (SELECT regr_intercept(y, persistence) AS a, regr_slope(y, persistence) AS b FROM gsp WHERE NOT is_test), gh AS (SELECT y, a + b * persistence AS yhat FROM gsp, gl WHERE is_test),
gw AS (SELECT sc.*, fold FROM sc JOIN gf USING (name)), go AS (SELECT v.y, l.a + l.b * v.persistence AS yhat FROM gw v JOIN (SELECT f.fold, regr_intercept(w.y, w.persistence) AS a, regr_slope(w.y, w.persistence) AS b
FROM (SELECT DISTINCT fold FROM gf) f JOIN gw w ON w.fold <> f.fold GROUP BY f.fold) l ON l.fold = v.fold),
gv AS (SELECT (SELECT count(*) FROM sc) AS n, (SELECT r2 FROM ({_metrics_sql('gh')})) AS r2, {_RHOS['gh']} AS s, (SELECT r2 FROM ({_metrics_sql('go')})) AS o_r2, {_RHOS['go']} AS o_s),
gt AS (SELECT 'line' AS model_name, n, unnest([{{'check': 'has_skill_spearman', 'value': s, 'threshold': 0.05::DOUBLE, 'ok': s >= 0.05}}, {{'check': 'has_skill_r2', 'value': r2, 'threshold': 0::DOUBLE, 'ok': r2 >= 0}},
{{'check': 'generalises_spearman', 'value': o_s, 'threshold': 0.05::DOUBLE, 'ok': o_s >= 0.05}}, {{'check': 'not_leaky_ceiling', 'value': r2, 'threshold': 0.9::DOUBLE, 'ok': r2 <= 0.9}},
{{'check': 'not_leaky_gap', 'value': r2 - o_r2, 'threshold': 0.4::DOUBLE, 'ok': r2 - o_r2 <= 0.4}}], recursive := true) FROM gv)"""


@query(f'WITH {_GATE} SELECT model_name, n, "check", round(value, 4) AS value, threshold, coalesce(isnan(value), true) OR ok AS passed FROM gt')
def e13_gate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.gate_checks(_gate_rows(spark, sf_dir)), 4)


@query(f"WITH {_GATE} SELECT model_name, any_value(n) < 200 OR bool_and(coalesce(isnan(value), true) OR ok) AS passed, any_value(n) < 200 AS skipped FROM gt GROUP BY model_name")
def e13_gate_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.gate_result(M.gate_checks(_gate_rows(spark, sf_dir)), ["model_name"]).select("model_name", "passed", "skipped")


@query(f"WITH {_GATE}, g AS (SELECT model_name, bool_and(coalesce(isnan(value), true) OR ok)::INT::DOUBLE AS gate_passed, count(*)::DOUBLE AS gate_checks FROM gt GROUP BY model_name) UNPIVOT g ON gate_passed, gate_checks INTO NAME metric_name VALUE metric_value")
def e14_gate_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = M.gate_checks(_gate_rows(spark, sf_dir)).groupBy("model_name").agg(F.bool_and("passed").cast("int").alias("gate_passed"), F.count("*").alias("gate_checks"))
    return melt(g, ["model_name"], ["gate_passed", "gate_checks"])


@query()
def e13_growth_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of the boosted growth model itself, with models fitted in folds of whole names."""
    return M.growth_gate(training(spark, sf_dir), FEATURES)


@query(f"WITH {_RUNS}, c AS (SELECT run_id AS candidate, metric_value - 0.4 AS delta FROM mr WHERE model_name = 'growth' AND NOT isnan(metric_value)) SELECT candidate, round(delta, 6) AS delta FROM c WHERE delta >= 0.01 ORDER BY delta DESC, candidate LIMIT 1")
def e16_best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = runs(spark, sf_dir).filter("model_name = 'growth' AND NOT isnan(metric_value)").select(F.col("run_id").alias("candidate"), (F.col("metric_value") - 0.4).alias("delta"))
    return rounded(M.best_candidate(c))


def _half_up(x: str) -> str:
    """Three places, halves away from zero as Spark's format does."""
    return f"round({x} + sign({x}) * 1e-9, 3)"


_BEST = "pb AS (SELECT model_name, metric_name, max(metric_value) FILTER (NOT isnan(metric_value)) AS best FROM mr WHERE is_champion GROUP BY ALL)"


@query(f"WITH {_RUNS}, {_BEST} SELECT * FROM pb")
def e20_previous_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.previous_best(runs(spark, sf_dir))


@query(f"""WITH {_RUNS}, {_BEST}, c AS (SELECT run_id, mr.model_name, metric_name, metric_value, run_id::INT % 5 <> 0 AS ok, CASE WHEN mr.model_name = 'risk' THEN NULL ELSE best END AS best FROM mr JOIN pb USING (model_name, metric_name)),
d AS (SELECT *, CASE WHEN isnan(metric_value) THEN 'not promoted: ' || metric_name || ' unavailable' WHEN best IS NULL THEN format('first champion: {{}}={{:.3f}}', metric_name, {_half_up('metric_value')})
WHEN metric_value > best THEN format('promoted: {{}}={{:.3f}} > prev best {{:.3f}}', metric_name, {_half_up('metric_value')}, {_half_up('best')}) ELSE format('held challenger: {{}}={{:.3f}} did not beat best {{:.3f}}', metric_name, {_half_up('metric_value')}, {_half_up('best')}) END AS nt FROM c)
SELECT run_id, model_name, ok AND NOT isnan(metric_value) AND (best IS NULL OR metric_value > best) AS is_champion, CASE WHEN ok THEN nt ELSE 'BLOCKED by validation gate (' || nt || ')' END AS note FROM d""")
def e21_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runs(spark, sf_dir)
    c = r.select("run_id", "model_name", "metric_name", "metric_value", (F.col("run_id").cast("int") % 5 != 0).alias("gate_passed"))
    return M.promotion(c, M.previous_best(r).filter("model_name = 'growth'")).select("run_id", "model_name", "is_champion", "note")


@query(f"""WITH {_RUNS} SELECT p.run_id, last_day(strptime(p.run_id, '%Y%m'))::DATE AS ts, 'trainer' AS agent, 'retrain_' || p.model_name AS action, 'ok' AS status,
mr.metric_name || '=' || CASE WHEN isnan(metric_value) THEN 'n/a' ELSE format('{{:.3f}}', {_half_up('metric_value')}) END || '; ' || note AS summary, '' AS artifact_url
FROM ({ORACLES["e21_promotion"]}) p JOIN mr ON mr.run_id = p.run_id AND mr.model_name = p.model_name
UNION ALL SELECT run_id, last_day(strptime(run_id, '%Y%m'))::DATE, 'trainer', 'feature_experiment', 'ok', count(*) || ' candidates: ' || string_agg(format('{{}} {{:+.3f}}', model_name, {_half_up('(metric_value - 0.4)')}), ', ' ORDER BY metric_value DESC, model_name), '' FROM mr WHERE NOT isnan(metric_value) GROUP BY run_id
UNION ALL SELECT run_id, last_day(strptime(run_id, '%Y%m'))::DATE, 'trainer', 'propose_feature', 'ok', coalesce(max(format('{{}} {{:+.3f}}', model_name, {_half_up('(metric_value - 0.4)')})) FILTER (model_name = 'growth' AND metric_value - 0.4 >= 0.15), 'no candidate'), '' FROM mr WHERE NOT isnan(metric_value) GROUP BY run_id""")
def h6_model_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of promotions and experiments (the model metrics of each run stand for its experiments' lifts)."""
    ts = F.last_day(F.to_date("run_id", "yyyyMM"))
    r = runs(spark, sf_dir)
    c = r.withColumn("gate_passed", F.col("run_id").cast("int") % 5 != 0).select("run_id", "model_name", "metric_name", "metric_value", "gate_passed")
    promoted = M.promotion(c, M.previous_best(r).filter("model_name = 'growth'"))
    tried = r.filter("NOT isnan(metric_value)").select("run_id", F.col("model_name").alias("candidate"), F.round(F.col("metric_value") - 0.4, 6).alias("delta"))
    return Q.model_activity(promoted, ts).unionByName(Q.experiment_activity(tried, tried.filter("candidate = 'growth' AND delta >= 0.15"), ts))


@query(f"WITH {_SC}, m AS ({_metrics_sql('sc', by='t')}) UNPIVOT (SELECT t, n::DOUBLE AS n, mae, rmse FROM m) ON n, mae, rmse INTO NAME metric_name VALUE metric_value")
def e22_metric_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(melt(J.regression_metrics(scored(spark, sf_dir), ["t"]), ["t"], ["n", "mae", "rmse"]))


_GOOD = "lc AS (SELECT model_name, arg_max(run_id, run_id) AS run_id, arg_max(gcs_uri, run_id) AS gcs_uri FROM mr WHERE is_champion AND coalesce(gcs_uri, '') <> '' GROUP BY model_name)"


@query(f"WITH {_RUNS}, {_GOOD} SELECT * FROM lc")
def e24_last_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.last_champion(runs(spark, sf_dir))


@query(f"""WITH {_RUNS}, {_GOOD}, g AS (SELECT DISTINCT model_name, false AS ok FROM mr UNION ALL SELECT DISTINCT model_name || '-new', false FROM mr UNION ALL SELECT 'fresh', true)
SELECT g.model_name, CASE WHEN ok THEN 'candidate' ELSE coalesce(gcs_uri, 'candidate') END AS serve, NOT ok AND gcs_uri IS NULL AS warning FROM g LEFT JOIN lc USING (model_name)""")
def e25_serving_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runs(spark, sf_dir)
    names = r.select("model_name").distinct()
    gates = names.union(names.select(F.concat("model_name", F.lit("-new")))).withColumn("gate_passed", F.lit(False))
    return M.serving_choice(gates.union(spark.createDataFrame([("fresh", True)], gates.schema)), M.last_champion(r))


@query(f"WITH {_RUNS} SELECT model_name, max(metric_value) FILTER (metric_name = 'spearman') AS spearman, max(metric_value) FILTER (metric_name = 'auc') AS auc FROM mr WHERE is_champion GROUP BY model_name")
def e26_champion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.champion_metrics(runs(spark, sf_dir))


def _growth(spark: SparkSession, sf_dir: str):
    split = M.time_split(training(spark, sf_dir)).cache()
    return split, M.fit_growth(split.filter("NOT is_test"), FEATURES, rounds=20)


@query()
def e2_growth_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    split, model = _growth(spark, sf_dir)
    return M.growth_metrics(split, model, FEATURES)


@query()
def e4_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.importance(_growth(spark, sf_dir)[1], FEATURES, spark)


@query()
def e5_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _growth(spark, sf_dir)
    return M.predict_growth(model, S.scoring_frame(brand(spark, sf_dir)), FEATURES).select("name", "feature_date", "growth_pred")


@query()
def e6_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _growth(spark, sf_dir)
    told = M.attributions(model, S.scoring_frame(brand(spark, sf_dir)), FEATURES)
    return told.join(reason_texts(told), "name")


def _risk(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    features = list(R.RISK_FEATURES)
    frame = R.impute_medians(R.risk_frame(snaps(spark, sf_dir).withColumn("name", F.concat_ws("@", "name", "run_id"))), features)
    return M.stratified_folds(frame, 3, "at_risk_label").cache(), features


@query()
def e7_risk_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, features = _risk(spark, sf_dir)
    return M.predict_risk(M.fit_risk(frame, features, rounds=10), frame, features).select("name", "at_risk_label", "probability")


@query()
def e9_out_of_fold_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, features = _risk(spark, sf_dir)
    k = min(5, frame.filter("at_risk_label = 1").count())
    oof = M.out_of_fold(M.stratified_folds(frame.drop("fold"), k, "at_risk_label").cache(), features, k).filter("probability IS NOT NULL")
    return M.roc_auc(oof, "at_risk_label", "probability")


@query()
def e15_candidate_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = M.time_split(training(spark, sf_dir)).cache()
    return M.experiment(split, FEATURES, list(S.CANDIDATES), rounds=20)


@query()
def h8_experiment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The experiment of ``e15_candidate_experiment`` as text."""
    return Q.experiment_table(e15_candidate_experiment(spark, sf_dir))


@query()
def e17_growth_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.growth_backtest(M.time_split(training(spark, sf_dir)).cache(), FEATURES)
