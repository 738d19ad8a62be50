"""Queries of the daily-series operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators import series as S
from seriesforge.plans import fixtures as X
from seriesforge.plans.registry import query, rounded

_H = f"h AS ({X.history_brand()}), hd AS (SELECT name, {X.day('date', True)} AS d, CAST(downloads AS DOUBLE) AS y FROM h)"
_SM = f"{_H}, sm AS (SELECT name, d, avg(y) OVER (PARTITION BY name ORDER BY d RANGE BETWEEN 27 PRECEDING AND CURRENT ROW) AS y FROM hd)"
_DATE = "(DATE '1970-01-01' + CAST({} AS INTEGER))"


def _sums(rows: str, asof: str = "o.t") -> str:
    """Window sums of the smoothed series around as-of rows (name, t), by a join instead of frames."""
    out = []
    for n in (7, 28, 56, 84, 70):
        out.append(f"coalesce(sum(CASE WHEN s.d > {asof} - {n} AND s.d <= {asof} THEN s.y END), 0) AS s{n}")
    for n in (7, 28, 56, 70):
        out.append(f"coalesce(sum(CASE WHEN s.d > {asof} - {2 * n} AND s.d <= {asof} - {n} THEN s.y END), 0) AS p{n}")
    for n in (7, 28, 56, 84):
        out.append(f"coalesce(sum(CASE WHEN s.d > {asof} - {n} AND s.d <= {asof} THEN s.y * (s.d - {asof} + {n} - 1) END), 0) AS iy{n}")
    for n in (7, 28):
        out.append(f"coalesce(sum(CASE WHEN s.d > {asof} - {n} AND s.d <= {asof} THEN s.y * s.y END), 0) AS yy{n}")
    out.append(f"coalesce(sum(CASE WHEN s.d > {asof} AND s.d <= {asof} + 70 THEN s.y END), 0) AS f70")
    return f"SELECT o.name, o.t, {', '.join(out)} FROM {rows} o JOIN sm s ON s.name = o.name AND s.d BETWEEN o.t - 139 AND o.t + 70 GROUP BY o.name, o.t"


def _slope(n: int) -> str:
    si, sii = n * (n - 1) / 2, (n - 1) * n * (2 * n - 1) / 6
    return f"CASE WHEN s{n} > 0 THEN ({n} * iy{n} - {si} * s{n}) / ({n * sii - si * si}) / (s{n} / {n}) ELSE 0 END"


def _vol(n: int) -> str:
    return f"CASE WHEN s{n} > 0 THEN sqrt(greatest(yy{n} / {n} - (s{n} / {n}) * (s{n} / {n}), 0)) / (s{n} / {n}) ELSE 0 END"


_FEATURES = {
    "log_d7": "ln(1 + s7)", "log_d28": "ln(1 + s28)", "velocity": "s7 / 7", "mom_7v7": "s7 / greatest(p7, 1)", "mom_7v28": "s7 / greatest(s28 / 4, 1)",
    "trend_slope_28": _slope(28), "volatility_28": _vol(28), "log_d56": "ln(1 + s56)", "log_d84": "ln(1 + s84)",
    "mom_28v28": "s28 / greatest(p28, 1)", "mom_56v56": "s56 / greatest(p56, 1)", "mom_28v56": "s28 / greatest(s56 / 2, 1)",
    "trend_slope_56": _slope(56), "trend_slope_84": _slope(84), "recent_share": "s7 / greatest(s28, 1)", "trend_slope_7": _slope(7), "dow_volatility_7": _vol(7),
}


def _feature_sql(names=None) -> str:
    return ", ".join(f"round({v}, 6) AS {k}" for k, v in _FEATURES.items() if names is None or k in names)


_ORIGINS = "o AS (SELECT name, unnest(range(min(d) + 84, max(d) - 70 + 1, 3)) AS t FROM hd GROUP BY name)"
TRAINING_SQL = f"""WITH {_SM}, {_ORIGINS}, a AS ({_sums('o')})
SELECT name, {_DATE.format('t')} AS feature_date, {_feature_sql()}, round(ln(1 + f70) - ln(1 + s70), 6) AS growth_target_70d FROM a WHERE s7 > 0 AND s70 > 0"""
SCORING_SQL = f"""WITH {_SM}, o AS (SELECT name, max(d) AS t FROM hd GROUP BY name), a AS ({_sums('o')})
SELECT name, {_DATE.format('t')} AS feature_date, {_feature_sql()} FROM a WHERE s7 > 0"""
_LONG = "long AS (SELECT name FROM hd GROUP BY name HAVING count(*) >= 154)"
VALIDATION_CTE = f"""{_SM}, {_LONG}, o AS (SELECT name, unnest(range(min(d) + 84, max(d) - 70 + 1, 3)) AS t FROM hd WHERE name IN (SELECT name FROM long) GROUP BY name),
a AS ({_sums('o')}), vf AS (SELECT name, {_DATE.format('t')} AS t, *EXCLUDE (name, t), ln(1 + f70) - ln(1 + s70) AS y, ln(1 + s70) - ln(1 + p70) AS persistence
FROM a WHERE s7 > 0 AND s70 > 0 AND p70 > 0)"""


def brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.read(spark, sf_dir, X.history_brand())


@query(f"WITH {_H}, o AS (SELECT name, date, downloads FROM h UNION ALL SELECT name, date, downloads + 1 FROM h WHERE downloads % 3 = 0) SELECT name, date, max(downloads) AS downloads FROM o GROUP BY name, date")
def a9_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = brand(spark, sf_dir)
    again = h.filter("downloads % 3 = 0").select("name", "date", (F.col("downloads") + 1).alias("downloads"), F.lit(2).alias("ingest_seq"))
    return S.latest_wins(h.withColumn("ingest_seq", F.lit(1)).unionByName(again))


@query(f"WITH {_SM} SELECT name, d, round(y, 6) AS y FROM sm")
def c1_trailing_smoother(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.smooth_trailing(S.with_day(brand(spark, sf_dir))).select("name", F.col("d").cast("bigint"), "y"))


@query(f"WITH {_H} SELECT name, d, round(avg(y) OVER (PARTITION BY name ORDER BY d RANGE BETWEEN 14 PRECEDING AND 14 FOLLOWING), 6) AS y FROM hd")
def c2_centered_smoother(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.smooth_centered(S.with_day(brand(spark, sf_dir))).select("name", F.col("d").cast("bigint"), "y"))


@query(f"""WITH {_H} SELECT a.name, a.d, sum(CASE WHEN b.d > a.d - 7 AND b.d <= a.d THEN b.y ELSE 0 END) AS s7,
sum(CASE WHEN b.d > a.d - 14 AND b.d <= a.d - 7 THEN b.y ELSE 0 END) AS p7, sum(CASE WHEN b.d > a.d - 28 AND b.d <= a.d THEN b.y ELSE 0 END) AS s28
FROM hd a JOIN hd b ON a.name = b.name AND b.d BETWEEN a.d - 27 AND a.d GROUP BY a.name, a.d""")
def c3_calendar_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_day(brand(spark, sf_dir)).select(
        "name", F.col("d").cast("bigint").alias("d"), S.calendar_sum(7).alias("s7"), S.calendar_sum(7, 7).alias("p7"), S.calendar_sum(28).alias("s28")
    )


@query(TRAINING_SQL)
def c13_training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.training_frame(brand(spark, sf_dir)))


def _part_of_training(names: str, extra: str = "growth_target_70d") -> str:
    return f"SELECT name, feature_date, {names}{', ' + extra if extra else ''} FROM ({TRAINING_SQL})"


@query(_part_of_training("trend_slope_28, trend_slope_56, trend_slope_84, trend_slope_7", ""))
def c5_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.training_frame(brand(spark, sf_dir)).select("name", "feature_date", "trend_slope_28", "trend_slope_56", "trend_slope_84", "trend_slope_7"))


@query(_part_of_training("volatility_28, dow_volatility_7", ""))
def c6_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.training_frame(brand(spark, sf_dir)).select("name", "feature_date", "volatility_28", "dow_volatility_7"))


@query(_part_of_training("log_d7, log_d28, log_d56, log_d84, velocity", ""))
def c7_log_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.training_frame(brand(spark, sf_dir)).select("name", "feature_date", "log_d7", "log_d28", "log_d56", "log_d84", "velocity"))


@query(_part_of_training("mom_7v7, mom_7v28, mom_28v28, mom_56v56, mom_28v56, recent_share", ""))
def c9_momentum_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.training_frame(brand(spark, sf_dir)).select("name", "feature_date", "mom_7v7", "mom_7v28", "mom_28v28", "mom_56v56", "mom_28v56", "recent_share"))


@query(f"WITH {_H}, {_ORIGINS} SELECT name, t AS d FROM o")
def c11_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.origins(S.with_day(brand(spark, sf_dir))).select("name", F.col("d").cast("bigint").alias("d"))


@query(f"SELECT name, feature_date, least(greatest(growth_target_70d, -0.9), 3.0)::DOUBLE AS target FROM ({TRAINING_SQL})")
def c16_clipped_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.training_frame(brand(spark, sf_dir)).select("name", "feature_date", S.clip_target("growth_target_70d").alias("target")))


@query(SCORING_SQL)
def c14_scoring_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.scoring_frame(brand(spark, sf_dir)))


@query(SCORING_SQL.replace(X.history_brand(), X.history_event()))
def c14_scoring_short_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.scoring_frame(X.read(spark, sf_dir, X.history_event())))


@query(f"WITH {VALIDATION_CTE} SELECT name, t, {_feature_sql()}, round(y, 6) AS y, round(persistence, 6) AS persistence FROM vf")
def c15_validation_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.validation_frame(brand(spark, sf_dir)))


_Z = {"all": "g", "date": "d", "name": "n"}


@query(f"""WITH t AS ({TRAINING_SQL}) SELECT name, feature_date,
{', '.join(f"round(CASE WHEN stddev_pop({c}) OVER {w} > 0 THEN ({c} - avg({c}) OVER {w}) / stddev_pop({c}) OVER {w} ELSE 0 END, 4) AS {c}_{k}" for k, w in _Z.items() for c in S.FEATURES)}
FROM t WINDOW g AS (), d AS (PARTITION BY feature_date), n AS (PARTITION BY name)""")
def c18_normalisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every active feature standardised over the whole frame, per date and within each name."""
    t = rounded(S.training_frame(brand(spark, sf_dir))).select("name", "feature_date", *[F.col(c).alias(f"{c}_{k}") for k in _Z for c in S.FEATURES])
    for k, by in (("all", []), ("date", ["feature_date"]), ("name", ["name"])):
        t = S.standardise(t, [f"{c}_{k}" for c in S.FEATURES], by)
    return rounded(t, 4)


@query(f"WITH t AS ({TRAINING_SQL}) SELECT name, feature_date, {', '.join(c for c in S.FEATURES if c.startswith('mom_'))}, growth_target_70d FROM t")
def c18_momentum_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ablation that keeps the momentum ratios alone."""
    return rounded(S.training_frame(brand(spark, sf_dir)).select("name", "feature_date", *[c for c in S.FEATURES if c.startswith("mom_")], "growth_target_70d"))
