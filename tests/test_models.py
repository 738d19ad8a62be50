"""Model experiments and cross-validation on the smallest tables."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from seriesforge.operators import models as M
from seriesforge.operators import series as S
from seriesforge.operators import stats as J
from seriesforge.plans import daily
from seriesforge.plans import model_queries as Q


def test_experiment_tries_every_candidate_on_all_features(spark, sf_dir, monkeypatch):
    fits, fit = [], M.fit_growth

    def counted(train, features, rounds=20, seed=42):
        fits.append((tuple(features), rounds))
        return fit(train, features, 1, seed)  # the fits asked for are what is tested, not their length

    monkeypatch.setattr(M, "fit_growth", counted)
    rows = entry.queries()["e15_candidate_experiment"](spark, sf_dir).collect()
    assert sorted(r["candidate"] for r in rows) == sorted(S.CANDIDATES)
    assert fits == [(tuple(f), 20) for f in (Q.FEATURES, *[[*Q.FEATURES, c] for c in S.CANDIDATES])]


@pytest.fixture(scope="module")
def frame(spark):
    """Names with a level of their own; the target follows x inside a name."""
    rng, rows = random.Random(4), []
    for k in range(20):
        for i in range(60):
            x = rng.random()
            rows.append((f"n{k:02}", dt.date(2024, 1, 1) + dt.timedelta(5 * i), x, 2 * x - 1 + rng.gauss(0, 0.1), rng.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "name string, t date, x double, y double, persistence double").cache()


def test_walk_forward_fits_in_each_fold(frame):
    folds = J.walk_forward_folds(frame).cache()
    got = sorted(M.walk_forward(frame, folds, ["x"], rounds=2).collect())
    assert [tuple(r)[:3] for r in got] == sorted(tuple(r) for r in J.fold_rows(frame, folds).collect()) and len(got) == 4
    assert all(r["spearman"] > 0.9 and r["r2"] > 0.2 and abs(r["persistence_spearman"]) < 0.4 and r["persistence_r2"] < 0 and r["skill"] > 0.4 for r in got)


def test_disjoint_cv_and_the_gate_see_unseen_names(frame):
    named = frame.withColumns({"feature_date": F.col("t"), M.TARGET: F.col("y")})
    got = M.disjoint_cv(named, ["x"], rounds=5).first()
    assert got["n"] == 1200 and got["spearman"] > 0.9 and got["r2"] > 0.2


def test_daily_gate_gets_unseen_name_figures(spark, sf_dir):
    from seriesforge.plans import fixtures as X

    history = X.read(spark, sf_dir, X.history_brand())
    checks = {r["check"]: r["value"] for r in daily.run(history, X.read(spark, sf_dir, X.snapshots()), None, "now", rounds=1)["gate_checks"].collect()}
    assert checks["generalises_spearman"] is not None and checks["not_leaky_gap"] is not None


def test_growth_backtest_reports_all_parts_and_guards_few_rows(frame):
    named = frame.select("name", "x", F.col("t").alias("feature_date"), F.col("y").alias(M.TARGET))
    got = M.growth_backtest(M.time_split(named), ["x"], rounds=1).first()
    assert got["metrics"]["n_test"] == 240 and got["metrics"]["n_train"] == 960 and got["metrics"]["spearman"] > 0.9
    assert [d["decile"] for d in got["calibration"]] == list(range(1, 11)) and sum(d["n"] for d in got["calibration"]) == 240
    assert len(got["scatter"]) == 240
    few = M.growth_backtest(M.time_split(named.limit(49)), ["x"], rounds=1).first()
    assert tuple(few) == (None, None, None)


def test_diebold_mariano_at_each_horizon(spark):
    rng = random.Random(6)
    e = {(n, h): [(rng.gauss(0, 1), rng.gauss(0, 2)) for _ in range(7 if n == "few" else 30)] for n in ("a", "few") for h in (1, 3, 7)}
    e |= {("flat", h): [(1.0, 1.0)] * 30 for h in (1, 3, 7)}
    rows = [(n, i, h, 0.0, a, b) for (n, h), es in e.items() for i, (a, b) in enumerate(es)]
    got = {(r["name"], r["h"]): r["dm_stat"] for r in J.dm_by_horizon(spark.createDataFrame(rows, "name string, i int, h int, actual double, m double, b double"), "m", "b").collect()}
    assert set(got) == set(e)
    for (n, h), es in e.items():
        if n != "a":
            assert got[n, h] is None
            continue
        d = [a * a - b * b for a, b in es]
        mean = sum(d) / len(d)
        c = [v - mean for v in d]
        var = sum(v * v for v in c) / len(c) + sum(2 * (1 - g / h) * sum(x * y for x, y in zip(c[g:], c)) / (len(c) - g) for g in range(1, h))
        assert got[n, h] == pytest.approx(mean / (max(var, 1e-12) / len(d)) ** 0.5)


def test_bootstrap_spearman_equals_brute_force(spark):
    rng, b, names = random.Random(8), 40, 9
    rows = [(f"n{k}", dt.date(2024, 1, 1 + i), float(rng.randrange(12)), float(rng.randrange(12)), 0.0) for k in range(names) for i in range(5)]
    scored = spark.createDataFrame(rows, "name string, t date, y double, yhat double, persistence double")
    picks = spark.range(b * names).select(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(names)).alias("i")).collect()

    def ranks(v):
        return [sum(x < a for x in v) + (v.count(a) + 1) / 2 for a in v]

    rhos = []
    for k in range(b):
        drawn = [r for p in picks[k * names : (k + 1) * names] for r in rows if r[0] == f"n{p['i']}"]
        rhos.append(np.corrcoef(ranks([r[2] for r in drawn]), ranks([r[3] for r in drawn]))[0, 1])
    told = []
    for bound in (1000, 10):  # broadcast, and joined
        got = {r["metric"]: (r["lo"], r["median"], r["hi"]) for r in J.cluster_bootstrap(scored, b, rows_bound=bound).collect()}
        assert set(got) == {"r2", "spearman", "skill"}
        assert got["spearman"] == pytest.approx(np.percentile(rhos, [2.5, 50, 97.5]), abs=1e-9)
        told.append(got)
    for m in ("r2", "skill"):
        assert told[0][m] == pytest.approx(told[1][m], abs=1e-9)


def test_resampling_takes_2000_replicates(spark):
    rows = [(f"n{k}", dt.date(2024, 1, 1), float(k), float(k), 0.0) for k in range(12)]
    scored = spark.createDataFrame(rows, "name string, t date, y double, yhat double, persistence double")
    for blocks in (True, False):
        assert J.permutation_p(scored, blocks=blocks).first()["p"] == pytest.approx(1 / 2001)


def _gate_frame(spark, seed, target, n=700):
    rng, day = np.random.default_rng(seed), dt.date(2026, 1, 1)
    x, z = rng.normal(size=n), rng.normal(size=n)
    rows = [(f"p{i % 35:02}", day + dt.timedelta(i // 35), float(x[i]), float(z[i]), float(target(x[i], rng))) for i in range(n)]
    return spark.createDataFrame(rows, f"name string, feature_date date, x double, z double, {M.TARGET} double")


def test_gate_judges_fitted_models(spark):
    def judged(seed, target, n=700):
        checks = M.growth_gate(_gate_frame(spark, seed, target, n), ["x", "z"], k=3, rounds=12).collect()
        return {r["check"] for r in checks if not r["passed"]}, {r["check"]: r["value"] for r in checks}, M.gate_result(spark.createDataFrame(checks), ["model_name"]).first() if n > 200 else None

    failed, values, result = judged(1, lambda x, r: 1.0 + 0.5 * x + r.normal(0, 0.4))
    assert not failed and result["passed"] and not result["skipped"] and 0 < values["has_skill_r2"] < 0.9 and values["generalises_spearman"] > 0.5
    failed, _, result = judged(2, lambda x, r: r.normal(0, 0.5))
    assert failed & {"has_skill_spearman", "has_skill_r2"} and not result["passed"]
    failed, values, result = judged(3, lambda x, r: 1.0 + 0.5 * x + r.normal(0, 0.01))
    assert "not_leaky_ceiling" in failed and values["not_leaky_ceiling"] > 0.9 and not result["passed"]
    few = M.growth_gate(_gate_frame(spark, 4, lambda x, r: r.normal(), 50), ["x", "z"])
    told = M.gate_result(few, ["model_name"]).first()
    assert told["passed"] and told["skipped"]


def test_saved_models_predict_alike(spark, tmp_path):
    frame = _gate_frame(spark, 5, lambda x, r: x + r.normal(0, 0.2))
    model = M.fit_growth(frame, ["x", "z"], 5)
    again = M.load_model("growth", M.save_model(model, "growth", "r7", str(tmp_path)))
    a, b = (sorted(tuple(r) for r in M.predict_growth(m, frame, ["x", "z"]).select("name", "feature_date", "x", "growth_pred").collect()) for m in (model, again))
    assert a == b


def test_positions_number_rows_like_one_sort(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1.5, rng.random(), rng.random() * 9]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, i int")
    key = lambda r: (r[1] is not None, r[1] or 0.0, r[2])
    want = {r[2]: k for k, r in enumerate(sorted(rows, key=key), 1)}
    assert {r["i"]: r["pos"] for r in J.positions(df, ["v", "i"]).collect()} == want
    inside = {r[2]: k for g in ("a", "b", None) for k, r in enumerate(sorted((r for r in rows if r[0] == g), key=key), 1)}
    assert {r["i"]: r["at"] for r in J.positions(df, ["v", "i"], "at", ["g"]).collect()} == inside
    assert J.positions(df.limit(0), ["v", "i"]).count() == 0


def test_permutation_p_equals_the_same_draws_in_numpy(spark):
    rng = random.Random(6)
    rows = [(f"n{i % 7}", i, rng.random(), rng.random()) for i in range(60)]
    df = spark.createDataFrame(rows, "name string, t int, y double, yhat double")
    order = sorted(rows, key=lambda r: (r[0], r[1]))
    rank = lambda v: np.argsort(np.argsort(v)) + 1.0
    ry, rp = rank([r[2] for r in order]), rank([r[3] for r in order])
    seen = np.corrcoef(ry, rp)[0, 1]
    for blocks in (True, False):
        names = sorted({r[0] for r in rows})
        units = [(b, names.index(r[0]) if blocks else k, k) for b in range(50) for k, r in enumerate(order)]
        drawn = spark.createDataFrame(units, "b bigint, u bigint, k int").select("b", "k", F.xxhash64("b", "u", F.lit(11)).alias("h")).collect()
        more = 0
        for b in range(50):
            moved = [r["k"] for r in sorted((r for r in drawn if r["b"] == b), key=lambda r: (r["h"], r["k"]))]
            more += np.corrcoef(ry[moved], rp)[0, 1] >= seen
        for bound in (1000, 10):  # broadcast, and joined
            got = J.permutation_p(df, 50, blocks, rows_bound=bound).first()
            assert got["observed"] == pytest.approx(seen) and got["p"] == pytest.approx((1 + more) / 51)


def test_p_values_equal_the_textbook(spark):
    import math

    from seriesforge.functions.columns import two_sided_p

    z = [0.0, 0.1, 0.5, 1.0, 1.96, 2.5758, 4.0, 6.5]
    got = [r[0] for r in spark.createDataFrame([(float(x),) for x in z], "z double").select(two_sided_p(F.col("z"))).collect()]
    assert got == pytest.approx([math.erfc(x / math.sqrt(2)) for x in z], rel=1e-4, abs=2e-7)
