"""Values of the fitted models: patience, importance, attributions, probabilities, folds; the diagnostics summary."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import forecast as K
from seriesforge.operators import models as M


@pytest.fixture(scope="module")
def frame(spark):
    rng, day = np.random.default_rng(1), dt.date(2026, 1, 1)
    x, z = rng.normal(size=900), rng.normal(size=900)
    rows = [(f"p{i % 30:02}", day + dt.timedelta(i // 30), float(x[i]), float(z[i]), 1.0 + 0.5 * float(x[i]) + float(rng.normal(0, 0.1))) for i in range(900)]
    return spark.createDataFrame(rows, f"name string, feature_date date, x double, z double, {M.TARGET} double").cache()


def test_patience_stops_where_one_long_run_would():
    assert M.stopping_round([3.0, 2.0, 2.5, 2.4, 2.3], 3) == (2, True)
    assert M.stopping_round([3.0, 2.0, 2.5, 1.9, 2.3], 3) == (4, False)
    assert M.stopping_round([1.0], 3) == (1, False)


def test_boosting_ends_with_patience_at_the_best_round(spark, frame):
    watch = F.pmod(F.xxhash64("feature_date", F.lit(42)), F.lit(10)) == 0
    model = M.fit_growth(frame, ["x", "z"], rounds=60, patience=6)
    rows = M.assemble(frame.withColumn("_y", F.col(M.TARGET)).withColumn("_watch", watch), ["x", "z"])
    used = M.rounds_used(model)
    curve = model.evaluateEachIteration(rows.filter("_watch"), "squared")
    assert 1 <= used <= 60 and int(np.argmin(curve)) == used - 1
    # twelve rounds, then doubled: the same trees as a longer fit's first ones
    longer = M.fit_growth(frame, ["x", "z"], rounds=used, patience=used)
    a, b = ([r["growth_pred"] for r in M.predict_growth(m, frame, ["x", "z"]).orderBy("name", "feature_date").collect()] for m in (model, longer))
    assert a == b


def _visit(nodes, x):
    left, right, feature, split, value = nodes
    at = 0
    while left[at] >= 0:
        at = left[at] if x[feature[at]] <= split[at] else right[at]
    return value[at]


def test_importance_names_the_driver(spark, frame):
    model = M.fit_growth(frame, ["x", "z"], rounds=5)
    got = {r["feature"]: r["share"] for r in M.importance(model, ["x", "z"], spark).collect()}
    assert sum(got.values()) == pytest.approx(1.0) and got["x"] > 0.9


def test_attributions_and_roots_add_up_to_the_prediction(spark, frame):
    model = M.fit_growth(frame, ["x", "z"], rounds=6)
    roots = sum(w * M._nodes(t)[4][0] for t, w in zip(model.trees, model.treeWeights, strict=True))
    told = M.attributions(model, frame, ["x", "z"], top=2).groupBy("name", "feature_date").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    rows = told.join(M.predict_growth(model, frame, ["x", "z"]), ["name", "feature_date"]).collect()
    assert len(rows) == 900 and all(r["n"] == 2 and r["s"] + roots == pytest.approx(r["growth_pred"], abs=1e-9) for r in rows)


def test_risk_probabilities_are_those_of_the_trees_walked_by_hand(spark, frame):
    labelled = frame.withColumn("at_risk_label", (F.col("x") > 0.8).cast("int")).limit(300).cache()
    model = M.fit_risk(labelled, ["x", "z"], rounds=4)
    trees = [(w, M._nodes(t)) for t, w in zip(model.trees, model.treeWeights, strict=True)]
    for r in M.predict_risk(model, labelled, ["x", "z"]).collect():
        margin = sum(w * _visit(n, (r["x"], r["z"])) for w, n in trees)
        assert r["probability"] == pytest.approx(1 / (1 + math.exp(-2 * margin)), abs=1e-9)
    assert M.fit_risk(labelled.withColumn("at_risk_label", F.lit(0)), ["x", "z"]) is None


def test_out_of_fold_rows_are_scored_by_the_model_that_did_not_see_them(spark, frame):
    folds = M.stratified_folds(frame.withColumn("at_risk_label", (F.col("x") > 0.8).cast("int")), 2, "at_risk_label", F.concat_ws("|", "name", "feature_date")).cache()
    oof = {(r["name"], r["feature_date"]): r["probability"] for r in M.out_of_fold(folds, ["x", "z"], 2, rounds=3).collect()}
    assert len(oof) == 900
    for i in (0, 1):
        held = M.predict_risk(M.fit_risk(folds.filter(F.col("fold") != i), ["x", "z"], rounds=3), folds.filter(F.col("fold") == i), ["x", "z"]).collect()
        assert held and all(oof[r["name"], r["feature_date"]] == r["probability"] for r in held)
    none = M.out_of_fold(M.stratified_folds(folds.drop("fold"), 0, "at_risk_label", "name"), ["x", "z"], 0)
    assert none.filter("probability IS NOT NULL").count() == 0 and none.count() == 900


def test_diagnostics_summary_counts_the_tests_it_sums_up(spark):
    rng = np.random.default_rng(2)
    data = {"s": 5 + np.tile([0, 2, 4, 0, -2, -4, 0], 20) + rng.normal(size=140) * 0.3, "w": np.cumsum(rng.normal(size=140)), "n": rng.normal(size=140), "m": np.cumsum(rng.normal(size=140)) + 3}
    df = spark.createDataFrame([(n, i, float(v)) for n, y in data.items() for i, v in enumerate(y)], "name string, i int, y double").cache()
    got = K.diagnostics_summary(df).first().asDict()
    parts, roots, level = K.decompose(df).cache(), K.adf(df), K.kpss(df)

    def share(told, test):
        return round(np.mean([bool(test(r)) for r in told.collect()]), 3)

    strength = {r["name"]: r["strength"] for r in K.seasonal_strength(parts).collect()}
    joint = K.integration(roots, level).collect()
    assert got["n_series"] == 4 and got["median_strength"] == round(float(np.median(list(strength.values()))), 3)
    assert got["adf_c_rejects_share"] == share(roots, lambda r: r["rejects_c"]) and got["adf_ct_rejects_share"] == share(roots, lambda r: r["rejects_ct"])
    assert got["kpss_rejects_share"] == share(level, lambda r: r["p_value"] < 0.05) and got["kpss_floored_share"] == share(level, lambda r: r["floored"])
    assert got["autocorrelated_share"] == share(K.ljung_box(df), lambda r: r["p_value"] < 0.05) and got["seasonal_share"] == round(np.mean([s > 0.3 for s in strength.values()]), 3)
    assert got["heteroscedastic_share"] == share(K.arch_lm(parts), lambda r: r["p_value"] < 0.05) and got["nonnormal_share"] == share(K.jarque_bera(parts), lambda r: r["p_value"] < 0.05)
    assert [got[c] for c in ("stationary", "unit_root", "conflict", "inconclusive")] == [sum(r["cell"] == c for r in joint) for c in ("stationary", "unit_root", "conflict", "inconclusive")]
    assert [got[c] for c in ("order_0", "order_1", "order_2_or_more")] == [sum(r["integration"] == c for r in joint) for c in ("I(0)", "I(1)", "I(2)+")]
