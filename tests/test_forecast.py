"""Tests of the diagnostics against closed forms and plain recomputation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import forecast as K
from seriesforge.operators import quality as Q


def test_chi_square_tail_for_even_and_odd_degrees(spark):
    """Upper 5 % points of the published table."""
    points = {1: 3.841459, 2: 5.991465, 3: 7.814728, 7: 14.067140, 14: 23.684791}
    row = spark.range(1).select(*[K.chi2_tail(F.lit(x), k).alias(str(k)) for k, x in points.items()]).first()
    assert [row[str(k)] for k in points] == pytest.approx([0.05] * 5, abs=1e-6)


def test_unit_root_p_values_at_the_published_critical_values():
    for terms, points in (("c", {-3.43: 0.01, -2.86: 0.05, -2.57: 0.10}), ("ct", {-3.96: 0.01, -3.41: 0.05, -3.13: 0.10})):
        for stat, p in points.items():
            assert K.unit_root_p(stat, terms) == pytest.approx(p, rel=0.03)
    assert K.unit_root_p(-40.0, "c") == 0 and K.unit_root_p(5.0, "ct") == 1


def series(spark, **columns):
    rows = [(name, i, float(y)) for name, ys in columns.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "name string, i int, y double")


def test_walk_and_noise_get_their_orders(spark):
    rng = np.random.default_rng(3)
    noise = rng.normal(size=300)
    s = series(spark, noise=noise, walk=np.cumsum(rng.normal(size=300)))
    told = {r["name"]: (r["cell"], r["integration"]) for r in K.integration(K.adf(s), K.kpss(s)).collect()}
    assert told == {"noise": ("stationary", "I(0)"), "walk": ("unit_root", "I(1)")}


def test_automatic_bandwidth_equals_plain_python(spark):
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(size=150), "b": np.cumsum(rng.normal(size=220))}
    told = {r["name"]: r["lags"] for r in K.automatic_bandwidth(series(spark, **data)).collect()}
    for name, y in data.items():
        c, n = y - y.mean(), len(y)
        cov = [float(c[j:] @ c[: n - j]) / n for j in range(int(n ** (2 / 9)) + 1)]
        s = 2 * sum(j * v for j, v in enumerate(cov)) / (cov[0] + 2 * sum(cov[1:]))
        assert told[name] == int(1.1447 * (s * s * n) ** (1 / 3))


def test_seasonal_residuals_grow_with_the_origin(spark):
    y = np.random.default_rng(7).normal(size=40)
    told = {r["i"]: r["sigma"] for r in K.seasonal_residuals(series(spark, a=y)).collect()}
    e = y[7:] - y[:-7]
    assert told[39] == pytest.approx(e.std()) and told[20] == pytest.approx(e[:14].std()) and told[3] == 1e-6


def test_log_rows_of_models_and_experiments(spark):
    promoted = spark.createDataFrame([("r", "growth", "spearman", 0.5, "first"), ("r", "risk", "auc", math.nan, "none")], "run_id string, model_name string, metric_name string, metric_value double, note string")
    told = {r["action"]: (r["summary"], r["artifact_url"]) for r in Q.model_activity(promoted).collect()}
    assert told == {"retrain_growth": ("spearman=0.500; first", ""), "retrain_risk": ("auc=n/a; none", "")}
    tried = spark.createDataFrame([("r", "a", 0.5, 0.52, 0.02), ("r", "b", 0.5, None, None), ("r", "c", 0.5, 0.4, -0.1)], "run_id string, candidate string, base double, new double, delta double")
    lines = [r["line"] for r in Q.experiment_table(tried).orderBy("pos").collect()]
    assert lines == ["a | 0.5000 | 0.5200 | +0.0200", "c | 0.5000 | 0.4000 | -0.1000", "b | 0.5000 | n/a | n/a"]
    rows = {r["action"]: r["summary"] for r in Q.experiment_activity(tried, tried.filter("delta > 1")).collect()}
    assert rows["propose_feature"] == "no candidate" and rows["feature_experiment"].startswith("3 candidates: ")


def test_arch_lm_equals_the_normal_equations(spark):
    rng = np.random.default_rng(9)
    wild = rng.normal(size=160) * np.repeat([0.3, 2.0, 0.5, 1.5], 40)
    parts = spark.createDataFrame([(n, i, float(v)) for n, y in (("wild", wild), ("calm", rng.normal(size=90))) for i, v in enumerate(y)], "name string, i int, resid double")
    told = {r["name"]: r for r in K.arch_lm(parts).collect()}
    for name, y in (("wild", wild), ("calm", [r["resid"] for r in parts.filter("name = 'calm'").orderBy("i").collect()])):
        e = [float(v) ** 2 for v in y]
        x, target = np.array([[1.0] + [e[i - j] for j in range(1, 8)] for i in range(7, len(e))]), np.array(e[7:])
        fitted = x @ np.linalg.solve(x.T @ x, x.T @ target)
        assert told[name]["lm"] == pytest.approx(len(target) * np.corrcoef(fitted, target)[0, 1] ** 2)
        x = np.linspace(told[name]["lm"], told[name]["lm"] + 200, 400_001)
        density = x**2.5 * np.exp(-x / 2) / (2**3.5 * math.gamma(3.5))
        assert told[name]["p_value"] == pytest.approx(float(np.trapezoid(density, x)), abs=1e-6)


def test_holt_winters_equals_a_recursion_from_scratch_at_each_origin(spark):
    rng = np.random.default_rng(4)
    data = {"a": 5 + np.tile([0, 1, 2, 0, -1, -2, 0], 12) + rng.normal(size=84) * 0.3, "b": np.cumsum(rng.normal(size=80)) + 9}
    grid = ((0.2, 0.05, 0.1), (0.6, 0.1, 0.3), (0.05, 0.01, 0.4))
    told = {(r["name"], r["i"], r["h"]): (r["ets"], r["sigma"]) for r in K.holt_winters(series(spark, **data), grid=grid, refit=1, passes=0).collect()}
    assert set(told) == {(n, i, h) for n, y in data.items() for i in range(60, len(y) - 7) for h in (1, 3, 7)}
    for name, i in (("a", 60), ("a", 76), ("b", 66)):
        tries = []
        for a, b, g in grid:
            y = data[name][: i + 1]  # nothing after the origin is seen
            level = [y[:7].mean()]
            trend = [(y[7:14].mean() - y[:7].mean()) / 7]
            season = [v - level[0] for v in y[:7]]
            errors = []
            for t in range(7, i + 1):
                errors.append(y[t] - level[-1] - trend[-1] - season[t - 7])
                level.append(a * (y[t] - season[t - 7]) + (1 - a) * (level[-1] + trend[-1]))
                trend.append(b * (level[-1] - level[-2]) + (1 - b) * trend[-1])
                season.append(g * (y[t] - level[-1]) + (1 - g) * season[t - 7])
            tries.append((float(np.mean(np.square(errors))), {h: level[-1] + h * trend[-1] + season[i - 7 + h] for h in (1, 3, 7)}))
        mse, ahead = min(tries, key=lambda x: x[0])
        for h in (1, 3, 7):
            assert told[name, i, h] == pytest.approx((ahead[h], math.sqrt(mse)))


def _sse(y, a, b, g, stop):
    """One series' sum of squared one-step errors, written out."""
    level, trend = y[:7].mean(), (y[7:14].mean() - y[:7].mean()) / 7
    season, total = list(y[:7] - level), 0.0
    for t in range(7, stop + 1):
        e = y[t] - level - trend - season[t % 7]
        total += e * e
        old, s = level, season[t % 7]
        level = a * (y[t] - s) + (1 - a) * (level + trend)
        trend = b * (level - old) + (1 - b) * trend
        season[t % 7] = g * (y[t] - level) + (1 - g) * s
    return total


def test_fitted_smoothing_is_never_worse_than_the_grid_and_near_a_fine_search():
    rng = np.random.default_rng(9)
    y = np.stack([5 + np.tile([0, 1, 2, 0, -1, -2, 0], 15) + rng.normal(size=105) * 0.3, np.cumsum(rng.normal(size=105)) + 9, np.sin(np.arange(105) / 9) * 3 + rng.normal(size=105)])
    lane, stop = np.array([0, 1, 2, 0, 1]), np.array([104, 104, 104, 60, 80])
    params, sse = K.fit_smoothing(y, lane, stop)
    fine = np.r_[0.0005, 0.002, 0.01, 0.03, np.arange(0.06, 1.0, 0.08), 0.995]
    for k in range(5):
        assert sse[k] == pytest.approx(_sse(y[lane[k]], *params[k], stop[k]))
        assert sse[k] <= min(_sse(y[lane[k]], *p, stop[k]) for p in K.GRID) + 1e-9
    for k in (0, 1):
        tried = np.array([(a, b, g) for a in fine for b in fine for g in fine])
        best = K.smooth(y, np.full(len(tried), lane[k]), tried, np.full(len(tried), stop[k])).min()
        assert sse[k] <= best * 1.03


def test_fits_see_nothing_after_their_origin(spark):
    rng = np.random.default_rng(3)
    a = 5 + np.tile([0, 1, 2, 0, -1, -2, 0], 20) + rng.normal(size=140) * 0.3
    changed = np.r_[a[:100], a[100:] * 3 + 7]
    one, two = ({(r["i"], r["h"]): (r["ets"], r["sigma"]) for r in K.holt_winters(series(spark, a=v)).collect()} for v in (a, changed))
    assert set(one) == {(i, h) for i in range(60, 133) for h in (1, 3, 7)}
    assert all(one[k] == pytest.approx(two[k]) for k in one if k[0] < 100) and any(one[k] != pytest.approx(two[k]) for k in one)
    assert K.holt_winters(series(spark, a=a).limit(0)).count() == 0
