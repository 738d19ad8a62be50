"""Daily-series diagnostics and rolling-origin forecasts on y = log1p(downloads), indexed by row.

A series (K1) is one group; windows and lagged equi-joins give the tests that have closed forms, and grouped-map
functions those that need least squares or a recursion, one series (or series and parameter pair) per group.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.columns import erfc
from seriesforge.functions.lineage import written
from seriesforge.operators.ranks import lagged_products, positions, quantiles

SEASON, START, HORIZONS, MIN_LENGTH = 7, 60, (1, 3, 7), 90
#: Response surfaces of the unit-root statistic's p-value (MacKinnon 1994, one variable), by deterministic terms:
#: least, turning and greatest statistic, and the polynomials below and above the turning point; fixed values.
UNIT_ROOT = {
    "c": (-18.83, -1.61, 2.74, (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)),
    "ct": (-16.18, -2.89, 0.7, (3.2512, 1.6047, 0.049588), (2.5261, 0.61654, -0.37956, -0.060285)),
}
#: p-value table of the level stationarity statistic (Kwiatkowski et al. 1992); fixed values.
KPSS_TABLE = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))


def admit(history: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """(name, i, y) of series with enough observations and some variation; i counts rows from 0 by date."""
    y = history.select("name", "date", F.log1p(F.col("downloads").cast("double")).alias("y"))
    good = y.groupBy("name").agg(F.count("*").alias("n"), F.stddev_pop("y").alias("s")).filter((F.col("n") >= least) & (F.col("s") > 0)).select("name")
    return y.join(good, "name", "left_semi").select("name", (F.row_number().over(Window.partitionBy("name").orderBy("date")) - 1).alias("i"), "y")


def autocorrelation(series: DataFrame, lags: int | DataFrame, value: str = "y") -> DataFrame:
    """(name, n, lag, rho) by lagged products of chunks of consecutive rows; ``lags``: one number, or (name, lags) of each series."""
    m = series.groupBy("name").agg(F.avg(value).alias("m"), F.count("*").alias("n"), (F.var_pop(value) * F.count("*")).alias("ss"))
    c = series.join(m, "name").select("name", "i", "n", "ss", (F.col(value) - F.col("m")).alias("c"))
    reach = c.withColumn("lags", F.lit(lags)) if isinstance(lags, int) else c.join(lags.select("name", "lags"), "name")
    products = lagged_products(reach.withColumn("lags", F.least("lags", F.col("n").cast("int") - 1)).filter("lags >= 1"), ["name"], "i")
    return products.filter("lag >= 1").join(m, "name").select("name", "n", "lag", (F.col("p") / F.col("ss")).alias("rho"))


def chi2_tail(x: Column, dof: int) -> Column:
    """Upper tail of the chi-square distribution: a finite sum, from a normal tail on where ``dof`` is odd."""
    half, odd = x / 2, dof % 2
    total, term = (erfc(F.sqrt(half)), F.sqrt(half) * F.exp(-half) / math.gamma(1.5)) if odd else (F.lit(0.0), F.exp(-half))
    for k in range(dof // 2):
        total = total + term
        term = term * half / (k + 1 + odd / 2)
    return total


def ljung_box(series: DataFrame, lags: int = 14, value: str = "y") -> DataFrame:
    """(name, q, p_value): autocorrelation up to ``lags``."""
    q = F.first("n") * (F.first("n") + 2) * F.sum(F.col("rho") ** 2 / (F.col("n") - F.col("lag")))
    told = autocorrelation(series, lags, value).groupBy("name").agg(q.alias("q"))
    return told.withColumn("p_value", chi2_tail(F.col("q"), lags))


def automatic_bandwidth(series: DataFrame) -> DataFrame:
    """(name, lags): Bartlett bandwidth of each series from its first n^(2/9) autocorrelations (Hobijn et al. 1998)."""
    n = series.groupBy("name").agg(F.count("*").alias("n"))
    first = n.select("name", "n", F.floor(F.pow("n", F.lit(2 / 9))).cast("int").alias("lags"))
    acf = autocorrelation(series, first).groupBy("name").agg(F.sum("rho").alias("s0"), F.sum(F.col("lag") * F.col("rho")).alias("s1"))
    s = F.coalesce(2 * F.col("s1") / (1 + 2 * F.col("s0")), F.lit(0.0))
    lags = F.floor(1.1447 * F.pow(s * s * F.col("n"), F.lit(1 / 3))).cast("int")
    return first.join(acf, "name", "left").select("name", F.least(lags, F.col("n").cast("int") - 1).alias("lags"))


def kpss(series: DataFrame, lags: int | None = None) -> DataFrame:
    """(name, stat, p_value, floored): level stationarity, p interpolated and clipped; without ``lags`` the bandwidth is automatic."""
    w = Window.partitionBy("name").orderBy("i")
    c = series.withColumn("c", F.col("y") - F.avg("y").over(Window.partitionBy("name"))).withColumn("s", F.sum("c").over(w))
    eta = c.groupBy("name").agg(F.sum(F.col("s") ** 2).alias("s2"), F.sum(F.col("c") ** 2).alias("ss"), F.count("*").alias("n"))
    width = automatic_bandwidth(series) if lags is None else eta.select("name", F.lit(lags).alias("lags"))
    acf = autocorrelation(series, width).join(width, "name").groupBy("name").agg(F.sum(2 * (1 - F.col("lag") / (F.col("lags") + 1)) * F.col("rho")).alias("r"))
    long_run = F.col("ss") * (1 + F.coalesce("r", F.lit(0.0))) / F.col("n")
    stat = eta.join(acf, "name", "left").select("name", (F.col("s2") / F.col("n") ** 2 / long_run).alias("stat"))
    p = F.lit(KPSS_TABLE[-1][1])
    for (x0, p0), (x1, p1) in reversed(list(zip(KPSS_TABLE, KPSS_TABLE[1:], strict=False))):
        p = F.when(F.col("stat") < x1, p0 + (F.col("stat") - x0) / (x1 - x0) * (p1 - p0)).otherwise(p)
    p = F.when(F.col("stat") <= KPSS_TABLE[0][0], KPSS_TABLE[0][1]).otherwise(p)
    return stat.withColumn("p_value", p).withColumn("floored", F.col("p_value") <= 0.01)


def _adf(y: np.ndarray, trend: bool) -> tuple[float, int]:
    """t statistic of the lagged level, lag order by the information criterion on a common sample."""
    d, n = np.diff(y), len(y)
    top = min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 3)
    best = None

    def fit(k: int, first: int):
        rows = np.arange(first, len(d))
        cols = [y[rows], np.ones(len(rows))] + ([rows.astype(float)] if trend else []) + [d[rows - j] for j in range(1, k + 1)]
        x = np.column_stack(cols)
        b, *_ = np.linalg.lstsq(x, d[rows], rcond=None)
        e = d[rows] - x @ b
        return x, b, float(e @ e), len(rows)

    for k in range(top + 1):
        x, _, sse, m = fit(k, top)
        aic = m * math.log(max(sse, 1e-300) / m) + 2 * x.shape[1]
        if best is None or aic < best[0]:
            best = (aic, k)
    x, b, sse, m = fit(best[1], best[1])
    s2 = sse / max(1, m - x.shape[1])
    return float(b[0] / math.sqrt(max(s2 * np.linalg.pinv(x.T @ x)[0, 0], 1e-300))), best[1]


def unit_root_p(stat: float, terms: str) -> float:
    """p-value of a unit-root statistic from its response surface."""
    least, turn, most, below, above = UNIT_ROOT[terms]
    if not least <= stat <= most:
        return float(stat > most)
    z = sum(b * stat**k for k, b in enumerate(below if stat <= turn else above))
    return math.erfc(-z / math.sqrt(2)) / 2


def adf(series: DataFrame) -> DataFrame:
    """Unit-root statistics and p-values of each series: level with constant, with trend, and of the differences."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("i")["y"].to_numpy()
        (c, k), (ct, _), (dc, _) = _adf(y, False), _adf(y, True), _adf(np.diff(y), False)
        ps = [unit_root_p(c, "c"), unit_root_p(ct, "ct"), unit_root_p(dc, "c")]
        return pd.DataFrame([(pdf["name"].iloc[0], c, k, ct, dc, *ps, *[p < 0.05 for p in ps])])

    kinds = "name string, adf_c double, lag int, adf_ct double, adf_diff double, p_c double, p_ct double, p_diff double, rejects_c boolean, rejects_ct boolean, rejects_diff boolean"
    return series.groupBy("name").applyInPandas(run, kinds)


def integration(adf_rows: DataFrame, kpss_rows: DataFrame) -> DataFrame:
    """(name, cell, integration): the two tests' joint verdict and the order of integration."""
    j = adf_rows.join(kpss_rows.select("name", "p_value"), "name")
    a, k = F.col("rejects_c"), F.col("p_value") < 0.05
    cell = F.when(a & ~k, "stationary").when(~a & k, "unit_root").when(a & k, "conflict").otherwise("inconclusive")
    order = F.when(a & (F.col("p_value") > 0.05), "I(0)").when(F.col("rejects_diff"), "I(1)").otherwise("I(2)+")
    return j.select("name", cell.alias("cell"), order.alias("integration"))


def decompose(series: DataFrame, period: int = SEASON) -> DataFrame:
    """(name, i, y, trend, seasonal, resid): centred mean over a season, centred phase means, remainder (interior rows)."""
    half = period // 2
    w = Window.partitionBy("name").orderBy("i").rowsBetween(-half, half)
    t = series.withColumn("trend", F.avg("y").over(w)).withColumn("k", F.count("*").over(w)).filter(F.col("k") == period).withColumn("phase", F.col("i") % period)
    phases = t.groupBy("name", "phase").agg(F.avg(F.col("y") - F.col("trend")).alias("raw"))
    centred = phases.withColumn("seasonal", F.col("raw") - F.avg("raw").over(Window.partitionBy("name"))).select("name", "phase", "seasonal")
    return t.join(centred, ["name", "phase"]).select("name", "i", "y", "trend", "seasonal", (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"))


def seasonal_strength(parts: DataFrame) -> DataFrame:
    r, rs = F.var_pop("resid"), F.var_pop(F.col("resid") + F.col("seasonal"))
    return parts.groupBy("name").agg(F.when(rs > 0, F.greatest(F.lit(0.0), 1 - r / rs)).otherwise(0.0).alias("strength"))


def arch_lm(parts: DataFrame, lags: int = SEASON) -> DataFrame:
    """(name, lm, p_value): n times R2 of squared remainders on their own lags."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        e = pdf.sort_values("i")["resid"].to_numpy() ** 2
        y = e[lags:]
        x = np.column_stack([np.ones(len(y))] + [e[lags - j : len(e) - j] for j in range(1, lags + 1)])
        b, *_ = np.linalg.lstsq(x, y, rcond=None)
        total = float(((y - y.mean()) ** 2).sum())
        r2 = 1 - float(((y - x @ b) ** 2).sum()) / total if total > 0 else 0.0
        return pd.DataFrame([(pdf["name"].iloc[0], len(y) * r2)])

    return parts.groupBy("name").applyInPandas(run, "name string, lm double").withColumn("p_value", chi2_tail(F.greatest("lm", F.lit(0.0)), lags))


def jarque_bera(parts: DataFrame, value: str = "resid") -> DataFrame:
    jb = F.count("*") / 6 * (F.skewness(value) ** 2 + F.kurtosis(value) ** 2 / 4)
    return parts.groupBy("name").agg(jb.alias("jb")).withColumn("p_value", F.exp(-F.col("jb") / 2))


def origins(series: DataFrame, start: int = START, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """(name, i, h, actual, naive, seasonal_naive): every forecast origin from ``start`` on with its targets.

    The seasonal source of target i+h is the newest same-season row known at i.
    """
    w, n = Window.partitionBy("name").orderBy("i"), F.count("*").over(Window.partitionBy("name"))
    top = max(horizons)
    options = []
    for h in horizons:
        back = SEASON * math.ceil(h / SEASON) - h
        source = F.lag("y", back).over(w) if back else F.col("y")
        options.append(F.struct(F.lit(h).alias("h"), F.lead("y", h).over(w).alias("actual"), F.col("y").alias("naive"), source.alias("seasonal_naive")))
    rows = series.select("name", "i", n.alias("n"), F.array(*options).alias("o")).filter((F.col("i") >= start) & (F.col("i") < F.col("n") - top))
    return rows.select("name", "i", F.explode("o").alias("o")).select("name", "i", "o.*")


def scale(series: DataFrame, start: int = START) -> DataFrame:
    """(name, scale): in-sample seasonal-naive error on the first rows."""
    w = Window.partitionBy("name").orderBy("i")
    d = series.withColumn("e", F.abs(F.col("y") - F.lag("y", SEASON).over(w))).filter(F.col("i") <= start)
    return d.groupBy("name").agg(F.greatest(F.avg("e"), F.lit(1e-9)).alias("scale"))


def mase(forecasts: DataFrame, scales: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """(name, h, n, model columns): mean absolute error over the scale; series with fewer than 20 origins are left out."""
    j = forecasts.join(scales, "name")
    told = j.groupBy("name", "h").agg(F.count("*").alias("n"), *[(F.avg(F.abs(F.col("actual") - F.col(m))) / F.first("scale")).alias(m) for m in models])
    return told.filter("n >= 20")


#: Smoothing parameters that the search starts from: level, trend, season.
GRID = tuple((a, b, g) for a in (0.1, 0.3, 0.6) for b in (0.01, 0.1) for g in (0.05, 0.2, 0.4))
#: Rows between two fits, passes of the search at most, its first and last step (log odds), and series that one task fits together.
REFIT, PASSES, FIRST_STEP, LAST_STEP, TOGETHER = 28, 40, 1.0, 0.05, 32


def smooth(y: np.ndarray, lane: np.ndarray, params: np.ndarray, stop: np.ndarray, wanted: dict[int, np.ndarray] | None = None):
    """Sum of squared one-step errors of each lane: series ``lane`` of ``y`` (one per row) up to and with row ``stop``.

    ``params``: level, trend and season weights of each lane. With ``wanted`` (lanes by row) also the states of those
    lanes after that row: level, trend, seasons by phase, squared errors so far.
    """
    m, (a, b, g) = SEASON, params.T
    rows = y[lane]
    level = rows[:, :m].mean(1)
    trend = (rows[:, m : 2 * m].mean(1) - level) / m
    season, sse, kept = (rows[:, :m] - level[:, None]).T.copy(), np.zeros(len(lane)), {}
    for i in range(m, int(stop.max(initial=m - 1)) + 1):
        s = season[i % m]
        e = rows[:, i] - (level + trend + s)
        on = i <= stop
        sse = sse + np.where(on, e * e, 0.0)
        old = level
        level = np.where(on, a * (rows[:, i] - s) + (1 - a) * (level + trend), level)
        trend = np.where(on, b * (level - old) + (1 - b) * trend, trend)
        season[i % m] = np.where(on, g * (rows[:, i] - level) + (1 - g) * s, s)
        if wanted is not None and i in wanted:
            at = wanted[i]
            kept[i] = level[at], trend[at], season[:, at].copy(), sse[at]
    return sse if wanted is None else (sse, kept)


def fit_smoothing(y: np.ndarray, lane: np.ndarray, stop: np.ndarray, grid: tuple = GRID, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(params, sum of squares) of each lane, all lanes together: the best triple of the grid, then a pattern search from it.

    A pass tries both directions of all three parameters (as log odds) in every lane, takes the best if it is better,
    and halves the steps of the lanes where none is; so no sum of squares is above the grid's.
    """
    k = len(grid)
    tried = smooth(y, np.repeat(lane, k), np.tile(np.array(grid, float), (len(lane), 1)), np.repeat(stop, k)).reshape(-1, k)
    best, params = tried.min(1), np.array(grid, float)[tried.argmin(1)]
    at, step = np.log(params / (1 - params)), np.full(len(lane), FIRST_STEP)
    moves = np.concatenate([np.eye(3), -np.eye(3)])
    for _ in range(passes):
        live = np.flatnonzero(step >= LAST_STEP)
        if not len(live):
            break
        trial = np.clip(at[live, None] + moves * step[live, None, None], -9, 9)
        sse = smooth(y, np.repeat(lane[live], 6), 1 / (1 + np.exp(-trial.reshape(-1, 3))), np.repeat(stop[live], 6)).reshape(-1, 6)
        found, better = sse.argmin(1), sse.min(1) < best[live]
        win = live[better]
        at[win], best[win] = trial[better, found[better]], sse.min(1)[better]
        params[win] = 1 / (1 + np.exp(-at[win]))
        step[live[~better]] /= 2
    return params, best


def holt_winters(series: DataFrame, start: int = START, grid: tuple = GRID, horizons: tuple[int, ...] = HORIZONS, refit: int = REFIT, passes: int = PASSES) -> DataFrame:
    """(name, i, h, ets, sigma): additive trend and season, with fitted parameters.

    The three parameters are fitted at the first origin and every ``refit`` rows, on the rows up to there alone; origins in
    between use the last fit. ``sigma`` is the root of the mean squared error so far under those parameters. A task fits
    its series together, ``TOGETHER`` or so of them; no row is copied.
    """
    top = max(horizons)
    names = written(series.select("name").distinct(), "names")
    n = names.count()
    groups = max(-(-n // TOGETHER), min(n, series.sparkSession.sparkContext.defaultParallelism), 1)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t = table.sort_by([("name", "ascending"), ("i", "ascending")])
        name, value = t["name"].to_pylist(), t["y"].to_numpy()
        edges = [0, *[k for k in range(1, len(name)) if name[k] != name[k - 1]], len(name)]
        parts = [(name[p], value[p:q]) for p, q in zip(edges, edges[1:], strict=False) if q - p > start + top]
        y = np.zeros((len(parts), max((len(v) for _, v in parts), default=0)))
        for k, (_, v) in enumerate(parts):
            y[k, : len(v)] = v
        anchors = [(k, i, min(i + refit, len(v) - top)) for k, (_, v) in enumerate(parts) for i in range(start, len(v) - top, refit)]
        lane, first, end = (np.array(c, int) for c in (zip(*anchors, strict=True) if anchors else ([], [], [])))
        out: list[tuple] = []
        if anchors:
            params, _ = fit_smoothing(y, lane, first, grid, passes)
            wanted: dict[int, list[int]] = {}
            for k, (_, i, stop) in enumerate(anchors):
                for j in range(i, stop):
                    wanted.setdefault(j, []).append(k)
            _, kept = smooth(y, lane, params, end - 1, {j: np.array(ks) for j, ks in wanted.items()})
            for j, (level, trend, season, sse) in kept.items():
                for pos, k in enumerate(wanted[j]):
                    sigma = math.sqrt(sse[pos] / (j - SEASON + 1))
                    out += [(parts[lane[k]][0], j, h, float(level[pos] + h * trend[pos] + season[(j + h) % SEASON, pos]), sigma) for h in horizons]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["name", "i", "h", "ets", "sigma"])

    dealt = positions(names, ["name"], "_at").select(F.col("name").alias("_name"), (F.col("_at") % groups).alias("_group"))
    rows = series.select("name", "i", "y").join(dealt, F.col("name") == F.col("_name"))
    return rows.groupBy("_group").applyInArrow(run, "name string, i int, h int, ets double, sigma double")


def seasonal_residuals(series: DataFrame) -> DataFrame:
    """(name, i, sigma): spread of the seasonal-naive errors up to and with each row; 1e-6 where they do not vary."""
    w = Window.partitionBy("name").orderBy("i")
    e = series.select("name", "i", (F.col("y") - F.lag("y", SEASON).over(w)).alias("e"))
    s = F.stddev_pop("e").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return e.select("name", "i", F.when(s > 0, s).otherwise(1e-6).alias("sigma"))


def interval_coverage(forecasts: DataFrame, yhat: str, sigma: str) -> DataFrame:
    inside = F.abs(F.col("actual") - F.col(yhat)) <= 1.96 * F.col(sigma)
    return forecasts.filter("h = 1").groupBy("name").agg(F.avg(inside.cast("int")).alias("coverage"))


def mincer_zarnowitz(forecasts: DataFrame, yhat: str) -> DataFrame:
    return forecasts.filter("h = 1").groupBy("name").agg(F.regr_slope("actual", yhat).alias("slope"), F.regr_intercept("actual", yhat).alias("intercept"))


def stratified_selection(history: DataFrame, per_tier: int = 6) -> DataFrame:
    """(name, total, pos): the highest, middle and lowest series by total volume, each once."""
    totals = history.groupBy("name").agg(F.sum("downloads").alias("total"))
    placed = positions(totals.withColumn("_less", -F.col("total")), ["_less", "name"], "r").withColumn("r", F.col("r") - 1)
    ranked = placed.crossJoin(F.broadcast(placed.agg(F.count("*").alias("n"))))
    mid = F.greatest(F.floor(F.col("n") / 2) - per_tier // 2, F.lit(0))
    keep = (F.col("r") < per_tier) | ((F.col("r") >= mid) & (F.col("r") < mid + per_tier)) | (F.col("r") >= F.col("n") - per_tier)
    return ranked.filter(keep).select("name", "total", F.col("r").alias("pos"))


def forecast_summary(errors: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """(h, n_series, median per model, share of series where the first model beats the second)."""
    errors = written(errors, "errors")
    long = errors.select("h", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("v")) for m in models])).alias("x")).select("h", "x.*")
    q = quantiles(long, "v", [0.5], ["h", "m"]).select("h", "m", F.get("q", F.lit(0)).alias("q"))
    med = q.groupBy("h").agg(*[F.round(F.max(F.when(F.col("m") == m, F.col("q"))), 3).alias(f"median_{m}") for m in models])
    told = errors.groupBy("h").agg(F.count("*").alias("n_series"), F.round(F.avg((F.col(models[0]) < F.col(models[1])).cast("int")), 3).alias("beats"))
    return told.join(med, "h").select("h", "n_series", *[f"median_{m}" for m in models], "beats")


def diagnostics_summary(series: DataFrame) -> DataFrame:
    """One row over all series: shares by verdict of each test at 5 %, counts of joint cells and orders, median strength."""
    parts, roots, level = decompose(series), adf(series), kpss(series)

    def p(told: DataFrame, name: str) -> DataFrame:
        return told.select("name", F.col("p_value").alias(name))

    j = roots.select("name", "rejects_c", "rejects_ct").join(level.select("name", "floored"), "name").join(integration(roots, level), "name")
    j = reduce(lambda x, y: x.join(y, "name"), (p(ljung_box(series), "lb"), p(level, "kpss"), seasonal_strength(parts), p(arch_lm(parts), "arch"), p(jarque_bera(parts), "jb")), j)
    c = F.col
    shares = {
        "adf_c_rejects_share": c("rejects_c"), "adf_ct_rejects_share": c("rejects_ct"), "kpss_rejects_share": c("kpss") < 0.05, "kpss_floored_share": c("floored"),
        "autocorrelated_share": c("lb") < 0.05, "seasonal_share": c("strength") > 0.3, "heteroscedastic_share": c("arch") < 0.05, "nonnormal_share": c("jb") < 0.05,
    }
    j = written(j, "diagnostics")
    strength = quantiles(j, "strength", [0.5]).agg(F.round(F.get(F.max("q"), F.lit(0)), 3).alias("median_strength"))
    told = j.agg(
        F.count("*").alias("n_series"), *[F.round(F.avg(v.cast("int")), 3).alias(k) for k, v in shares.items()],
        *[F.count_if(c("cell") == x).alias(x) for x in ("stationary", "unit_root", "conflict", "inconclusive")],
        *[F.count_if(c("integration") == x).alias(k) for k, x in (("order_0", "I(0)"), ("order_1", "I(1)"), ("order_2_or_more", "I(2)+"))],
    )
    columns = told.columns
    return told.crossJoin(F.broadcast(strength)).select(*columns[: 1 + len(shares)], "median_strength", *columns[1 + len(shares) :])
