"""Validation statistics on scored rows (name, t, y, yhat, persistence) and rank-based metrics.

Ranks, exact quantiles and lagged products come from ``ranks``: no task holds all rows, one value or one group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.columns import two_sided_p
from seriesforge.functions.lineage import written
from seriesforge.operators.ranks import average_ranks, cumulative, lagged_products, positions, quantiles
from seriesforge.operators.resampling import cluster_bootstrap, permutation_p

__all__ = ["average_ranks", "cluster_bootstrap", "cumulative", "permutation_p", "positions", "quantiles"]

HORIZON = 70


def regression_metrics(scored: DataFrame, by: list[str] | None = None, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """(by..., n, r2, mae, rmse): two passes, the mean first; NaN r2 for fewer than 3 rows or a constant target."""
    by = by or []
    means = scored.groupBy(*by).agg(F.avg(y).alias("_m"))
    rows = scored.join(means, by) if by else scored.crossJoin(F.broadcast(means))
    e = F.col(y) - F.col(yhat)
    sums = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(e * e).alias("_se"), F.sum((F.col(y) - F.col("_m")) ** 2).alias("_st"), F.avg(F.abs(e)).alias("mae"))
    r2 = F.when((F.col("n") < 3) | (F.col("_st") == 0), float("nan")).otherwise(1 - F.col("_se") / F.col("_st"))
    return sums.select(*by, "n", r2.alias("r2"), "mae", F.sqrt(F.col("_se") / F.col("n")).alias("rmse"))


def spearman(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """(by..., spearman): Pearson correlation of average ranks; the input is evaluated once. Null without two rows of different values."""
    by = by or []
    rows = df.select(*by, F.col(a).alias("_x"), F.col(b).alias("_y")).filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    ranked = average_ranks(average_ranks(rows, "_x", "_ra", by), "_y", "_rb", by)
    return ranked.groupBy(*by).agg(F.corr("_ra", "_rb").alias("spearman"))


def skill(scored: DataFrame) -> DataFrame:
    def mse(x: str) -> Column:
        return F.avg((F.col("y") - F.col(x)) ** 2)

    return scored.agg((1 - mse("yhat") / F.greatest(mse("persistence"), F.lit(1e-9))).alias("skill"))


def last_origins(frame: DataFrame, n: int = 2, t: str = "t") -> DataFrame:
    """Rows with ``is_test``: whether their date is among the n latest distinct ones."""
    latest = frame.select(t).distinct().orderBy(F.desc(t)).limit(n).agg(F.min(t).alias("_from"))
    return frame.crossJoin(F.broadcast(latest)).withColumn("is_test", F.col(t) >= F.col("_from")).drop("_from")


def naive_baselines(split: DataFrame) -> DataFrame:
    """Metrics of persistence, zero and the training mean on the test rows."""
    mean = split.filter("NOT is_test").agg(F.avg("y").alias("_mean"))
    test = split.filter("is_test").crossJoin(F.broadcast(mean))
    long = test.select("y", F.explode(F.map_from_arrays(F.array(*[F.lit(x) for x in ("persistence", "zero", "train_mean")]),
                                                        F.array(F.col("persistence"), F.lit(0.0), F.col("_mean")))).alias("baseline", "yhat"))
    return regression_metrics(long, ["baseline"])


def calibrated_persistence(split: DataFrame) -> DataFrame:
    """Test rows with yhat from a line fitted on the training rows' persistence; slope and intercept ride along."""
    line = split.filter("NOT is_test").agg(F.regr_slope("y", "persistence").alias("slope"), F.regr_intercept("y", "persistence").alias("intercept"))
    test = split.filter("is_test").crossJoin(F.broadcast(line))
    return test.withColumn("yhat", F.col("intercept") + F.col("slope") * F.col("persistence"))


def origin_diagnostics(frame: DataFrame, horizon: int = HORIZON) -> DataFrame:
    span = F.coalesce(F.datediff(F.max("t"), F.min("t")), F.lit(0))
    told = frame.agg(F.count_distinct("t").alias("n_origins"), span.alias("span_days"))
    return told.select(
        "n_origins", "span_days", (F.col("span_days") > 2 * horizon).alias("feasible"),
        F.round(F.greatest("span_days", F.lit(1)) / horizon, 2).alias("independent_forecasts"),
        F.when(F.col("span_days") <= horizon, "all targets overlap").otherwise("limited separation").alias("verdict"),
    )


def walk_forward_folds(frame: DataFrame, n_folds: int = 4, purge: bool = True, horizon: int = HORIZON) -> DataFrame:
    """(fold, train_until, test_from, test_until) over the distinct dates: half to start with, then equal blocks.

    With ``purge``, training ends a horizon before the test block, so that no target window overlaps it. The dates (one
    row each) are indexed in one task; facts join the folds by a range condition.
    """
    dates = frame.select("t").distinct()
    indexed = dates.select("t", (F.row_number().over(Window.orderBy("t")) - 1).alias("i"), F.count("*").over(Window.partitionBy()).alias("n"))
    k = F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1)))
    bounds = indexed.select("n").distinct().select("n", k.alias("k"))
    lo = F.floor((0.5 + 0.5 * F.col("k") / n_folds) * (F.col("n") - 1))
    hi = F.floor((0.5 + 0.5 * (F.col("k") + 1) / n_folds) * (F.col("n") - 1))
    b = bounds.select(F.col("k"), lo.alias("lo"), F.least(lo + 1, F.col("n") - 1).alias("from_i"), hi.alias("hi"))
    at = indexed.select("i", "t")
    named = b
    for c, name in (("lo", "lo_t"), ("from_i", "test_from"), ("hi", "test_until")):
        named = named.join(at.select(F.col("i").alias(c), F.col("t").alias(name)), c)
    until = F.date_sub("test_from", horizon) if purge else F.col("lo_t")
    return named.select((F.col("k") + 1).alias("fold"), until.alias("train_until"), "test_from", "test_until")


def fold_rows(frame: DataFrame, folds: DataFrame) -> DataFrame:
    """(fold, n_train, n_test) of folds with at least 100 and 20 rows."""
    f = F.broadcast(folds)
    train, test = F.col("t") <= F.col("train_until"), F.col("t").between(F.col("test_from"), F.col("test_until"))
    counts = frame.join(f, train | test).groupBy("fold").agg(F.count_if(train).alias("n_train"), F.count_if(test).alias("n_test"))
    return counts.filter("n_train >= 100 AND n_test >= 20")


def group_folds(frame: DataFrame, k: int = 5) -> DataFrame:
    """(name, fold): whole names per fold, sizes balanced by dealing them out, largest first, back and forth."""
    sizes = frame.groupBy("name").agg(F.count("*").alias("n")).withColumn("_less", -F.col("n"))
    pos = F.col("pos") - 1
    lap = F.floor(pos / k)
    snake = F.when(lap % 2 == 0, pos % k).otherwise(k - 1 - pos % k)
    return positions(sizes, ["_less", "name"]).select("name", snake.cast("int").alias("fold"))


def diebold_mariano(losses: DataFrame, horizon: int, by: list[str] | None = None, order: list[str] | None = None, default_lag: int | None = None) -> DataFrame:
    """(by..., n, mean_loss_diff, dm_stat, p_value, favored) from rows with loss difference ``d``.

    Long-run variance with Bartlett weights over min(horizon-1, n-1) lags, floored at 1e-12; lagged products come
    from chunks of consecutive rows that share their last ones with the next chunk.
    """
    by, order = by or [], order or ["name", "t"]
    rows = positions(losses.select(*dict.fromkeys([*by, *order, "d"])), order, by=by)
    stats = rows.groupBy(*by).agg(F.avg("d").alias("m"), F.count("*").alias("n"))
    lag = F.least(F.lit(horizon - 1), F.col("n") - 1).cast("int")
    centred = (rows.join(stats, by) if by else rows.crossJoin(F.broadcast(stats))).select(*by, "pos", (F.col("d") - F.col("m")).alias("c"), lag.alias("lags"))
    products = lagged_products(centred, by)
    products = products.join(stats, by) if by else products.crossJoin(F.broadcast(stats))
    weight = F.when(F.col("lag") == 0, 1.0).otherwise(2 * (1 - F.col("lag") / (lag + 1)) * F.col("n") / (F.col("n") - F.col("lag")))
    var = products.groupBy(*by).agg(F.sum(weight * F.col("p")).alias("v"))
    told = stats.join(var, by) if by else stats.crossJoin(var)
    dm = F.col("m") / F.sqrt(F.greatest(F.col("v") / F.col("n"), F.lit(1e-12)) / F.col("n"))
    return told.select(*by, "n", F.col("m").alias("mean_loss_diff"), dm.alias("dm_stat"), two_sided_p(dm).alias("p_value"), F.when(F.col("m") < 0, "model").otherwise("benchmark").alias("favored"))


def dm_by_horizon(forecasts: DataFrame, model: str, benchmark: str, horizons: tuple[int, ...] = (1, 3, 7)) -> DataFrame:
    """(name, h, n, dm_stat, p_value): the test of each series at each horizon h over h - 1 lags.

    Null figures for fewer than 8 origins or where both forecasts lose the same everywhere.
    """
    d = (F.col("actual") - F.col(model)) ** 2 - (F.col("actual") - F.col(benchmark)) ** 2
    rows = forecasts.select("name", "i", "h", d.alias("d"))
    told = reduce(DataFrame.unionByName, [diebold_mariano(rows.filter(F.col("h") == h), h, ["name", "h"], ["i"]) for h in horizons])
    flat = rows.groupBy("name", "h").agg(F.max(F.abs("d")).alias("most"))
    fit = (F.col("n") >= 8) & (F.col("most") > 1e-8)
    return told.join(flat, ["name", "h"]).select("name", "h", "n", *[F.when(fit, F.col(c)).alias(c) for c in ("dm_stat", "p_value")])


def between_within(scored: DataFrame) -> DataFrame:
    """R2 of name means, and of values less their name's mean where the median name has three rows or more."""
    means = written(scored.groupBy("name").agg(F.avg("y").alias("y"), F.avg("yhat").alias("yhat"), F.count("*").alias("k")), "means")
    between = regression_metrics(means).select(F.col("n").alias("n_names"), F.col("r2").alias("r2_between"))
    joined = scored.select("name", F.col("y").alias("y0"), F.col("yhat").alias("p0")).join(means, "name").select((F.col("y0") - F.col("y")).alias("y"), (F.col("p0") - F.col("yhat")).alias("yhat"))
    within = regression_metrics(joined).select("r2")
    depth = quantiles(means, "k", [0.5]).select(F.get("q", F.lit(0)).alias("median_rows"))
    return between.crossJoin(F.broadcast(depth)).crossJoin(F.broadcast(within)).select("n_names", "median_rows", "r2_between", F.when(F.col("median_rows") >= 3, F.col("r2")).alias("r2_within"))


def head_reliability(scored: DataFrame, k: int = 10, share: float = 0.2) -> DataFrame:
    """Slope of forecast on outcome, overlap of the two top-k name sets, errors above the outcome's upper quantile."""
    tops = [scored.orderBy(F.desc(c), "name", "t").limit(k).select("name").distinct() for c in ("yhat", "y")]
    overlap = tops[0].intersect(tops[1]).agg(F.count("*").alias("overlap"))
    cut = quantiles(scored, "y", [1 - share]).select(F.get("q", F.lit(0)).alias("cut"))
    e = F.col("yhat") - F.col("y")
    high = F.col("y") >= F.col("cut")
    told = scored.crossJoin(F.broadcast(cut)).agg(F.regr_slope("yhat", "y").alias("slope"), F.avg(F.when(high, F.abs(e))).alias("head_mae"), F.avg(F.abs(e)).alias("mae"), F.avg(F.when(high, e)).alias("head_bias"))
    return told.crossJoin(overlap)


def effective_sample(frame: DataFrame, horizon: int = HORIZON, stride: int = 3) -> DataFrame:
    return frame.agg(
        F.count("*").alias("n_rows"), F.count_distinct("name").alias("n_names"), F.lit(horizon / stride).alias("overlap"),
        (F.count("*") / (horizon / stride)).alias("effective_rows"), (F.datediff(F.max("t"), F.min("t")) / horizon).alias("independent_windows"),
    )


def cross_check(recorded: DataFrame, recomputed: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(stat, expected, actual, status): recorded against recomputed; kind 'info' always passes."""
    both = recorded.select("stat", "kind", F.col("value").alias("expected")).join(recomputed.select("stat", F.col("value").alias("actual")), "stat", "full_outer")
    near = F.abs(F.col("actual") - F.col("expected")) <= tolerance * (1 + F.abs("expected"))
    return both.select("stat", "expected", "actual", F.when(F.col("kind") == "info", "pass").when(near, "pass").otherwise("fail").alias("status"))


def freshness(runs: DataFrame, now: Column, limit_hours: float = 36, ts: str = "ts") -> DataFrame:
    hours = (F.unix_timestamp(now) - F.unix_timestamp(F.max(ts).cast("timestamp"))) / 3600
    return runs.agg(F.round(hours, 2).alias("age_hours")).withColumn("stale", F.col("age_hours") > limit_hours)
