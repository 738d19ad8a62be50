"""Training, evaluation, gating, promotion and serving of the growth and risk models (MLlib boosted trees)."""

from __future__ import annotations

from functools import reduce

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.columns import col
from seriesforge.functions.lineage import written
from seriesforge.operators import stats
from seriesforge.operators.series import clip_target

TARGET = "growth_target_70d"
#: Gate thresholds: held-out R2 floor and ceiling, rank skill, unseen-name rank skill, largest R2 gap, least rows; fixed values.
GATE = {"min_r2": 0.0, "max_r2": 0.90, "min_spearman": 0.05, "min_oof_spearman": 0.05, "max_gap": 0.40, "min_rows": 200}


def time_split(frame: DataFrame, share: float = 0.8, date: str = "feature_date") -> DataFrame:
    """Rows with ``is_test``: the first floor(share*n) rows by (date, name) train, the rest test.

    The cut is found on counts per date, so only the rows of one date are ever ranked together.
    """
    per = frame.groupBy(date).agg(F.count("*").alias("k"))
    before = per.select(date, (F.sum("k").over(Window.orderBy(date)) - F.col("k")).alias("_before"), F.sum("k").over(Window.partitionBy()).alias("_n"))
    inside = F.row_number().over(Window.partitionBy(date).orderBy("name"))
    return frame.join(before, date).withColumn("is_test", F.col("_before") + inside > F.floor(F.col("_n") * share)).drop("_before", "_n")


def stratified_folds(frame: DataFrame, k: int, label: str = "label", key: Column | str = "name") -> DataFrame:
    """Rows with ``fold``: each class dealt out in the order of ``key``."""
    keyed = stats.positions(frame.withColumn("_key", col(key)), ["_key"], "_pos", [label])
    return keyed.withColumn("fold", ((F.col("_pos") - 1) % max(k, 1)).cast("int")).drop("_key", "_pos")


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(n_pos, n_neg, auc) by the rank sum of the positives."""
    r = stats.average_ranks(scored, score, "_rank").agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"), F.sum(F.when(F.col(label) == 1, F.col("_rank"))).alias("_s"))
    return r.select("n_pos", "n_neg", ((F.col("_s") - F.col("n_pos") * (F.col("n_pos") + 1) / 2) / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))


def roc_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, and (null, 0, 0)."""
    per = scored.groupBy(F.negative(score).alias("_s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    cum = stats.cumulative(per, "_s", ["p", "q"]).crossJoin(F.broadcast(per.agg(F.sum("p").alias("tp"), F.sum("q").alias("tq"))))
    points = cum.select((-F.col("_s")).alias("threshold"), ((F.col("cum_q") + F.col("q")) / F.col("tq")).alias("fpr"), ((F.col("cum_p") + F.col("p")) / F.col("tp")).alias("tpr"))
    return points.union(scored.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double"))


def calibration_deciles(scored: DataFrame, yhat: str = "yhat", y: str = "y") -> DataFrame:
    """(decile, n, mean_pred, mean_actual) by the rank of the forecast (ties in the order of name and t)."""
    ranked = stats.positions(scored, [yhat, "name", "t"], "_pos").crossJoin(F.broadcast(scored.agg(F.count("*").alias("_n"))))
    decile = F.greatest(F.lit(1), F.ceil((F.col("_pos") - 1) * 10 / (F.col("_n") - 1)))
    return ranked.groupBy(decile.cast("int").alias("decile")).agg(F.count("*").alias("n"), F.avg(yhat).alias("mean_pred"), F.avg(y).alias("mean_actual"))


def scatter_sample(scored: DataFrame, n: int = 300, seed: int = 7) -> DataFrame:
    """``n`` rows without replacement, those with the smallest MD5 of name, date and seed: the same on every run and engine."""
    key = F.md5(F.concat_ws("|", "name", F.date_format("t", "yyyy-MM-dd"), F.lit(str(seed))).cast("binary"))
    return scored.orderBy(key, "name", "t").limit(n)


def gate_checks(metrics: DataFrame) -> DataFrame:
    """One row per check of a metrics row (n, r2, spearman, oof_r2, oof_spearman): a NaN or null never fails."""
    gap = F.col("r2") - F.col("oof_r2")

    def ok(c: Column, test: Column) -> Column:
        return c.isNull() | F.isnan(c) | test

    rows = [
        ("has_skill_spearman", F.col("spearman"), GATE["min_spearman"], lambda c: c >= GATE["min_spearman"]),
        ("has_skill_r2", F.col("r2"), GATE["min_r2"], lambda c: c >= GATE["min_r2"]),
        ("generalises_spearman", F.col("oof_spearman"), GATE["min_oof_spearman"], lambda c: c >= GATE["min_oof_spearman"]),
        ("not_leaky_ceiling", F.col("r2"), GATE["max_r2"], lambda c: c <= GATE["max_r2"]),
        ("not_leaky_gap", gap, GATE["max_gap"], lambda c: c <= GATE["max_gap"]),
    ]
    checks = F.array(*[F.struct(F.lit(name).alias("check"), c.alias("value"), F.lit(float(t)).alias("threshold"), ok(c, test(c)).alias("passed")) for name, c, t, test in rows])
    keys = [c for c in metrics.columns if c not in ("n", "r2", "spearman", "oof_r2", "oof_spearman")]
    return metrics.select(*keys, "n", F.explode(checks).alias("x")).select(*keys, "n", "x.*")


def gate_result(checks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, passed, skipped, reasons): all checks pass, or there are too few rows to tell."""
    few = F.first("n") < GATE["min_rows"]
    reason = F.format_string("%s: %.3f vs threshold %.3f", "check", "value", "threshold")
    failed = F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), reason))), "; ")
    return checks.groupBy(*keys).agg((few | F.bool_and("passed")).alias("passed"), few.alias("skipped"), F.when(few, F.lit("")).otherwise(failed).alias("reasons"))


def growth_gate(frame: DataFrame, features: list[str], k: int = 5, rounds: int = 20) -> DataFrame:
    """(model_name, n, check, value, threshold, passed) of the growth model: figures on later dates, and on names it did not see.

    ``frame`` holds name, feature_date, the target and the features; rows without a target are left out. No model is
    fitted for fewer rows than the gate asks for: its checks are null and never fail.
    """
    known = frame.filter(F.col(TARGET).isNotNull())
    n = known.count()
    if n < GATE["min_rows"]:
        nothing = [F.lit(None).cast("double").alias(c) for c in ("r2", "spearman", "oof_r2", "oof_spearman")]
        return gate_checks(known.sparkSession.range(1).select(F.lit("growth").alias("model_name"), F.lit(n).cast("bigint").alias("n"), *nothing))
    split = time_split(known)
    seen = growth_metrics(split, fit_growth(split.filter("NOT is_test"), features, rounds), features)
    unseen = disjoint_cv(known, features, k, rounds).select(F.col("r2").alias("oof_r2"), F.col("spearman").alias("oof_spearman"))
    return gate_checks(seen.crossJoin(unseen).select(F.lit("growth").alias("model_name"), F.lit(n).cast("bigint").alias("n"), "r2", "spearman", "oof_r2", "oof_spearman"))


def best_candidate(results: DataFrame, margin: float = 0.01) -> DataFrame:
    return results.filter(F.col("delta") >= margin).orderBy(F.desc("delta"), "candidate").limit(1)


def previous_best(model_runs: DataFrame) -> DataFrame:
    ok = F.when(~F.isnan("metric_value"), F.col("metric_value"))
    return model_runs.filter("is_champion").groupBy("model_name", "metric_name").agg(F.max(ok).alias("best"))


def promotion(candidates: DataFrame, best: DataFrame, margin: float = 0.0) -> DataFrame:
    """Candidates (model_name, metric_name, metric_value, gate_passed) with ``is_champion`` and a note."""
    j = candidates.join(best, ["model_name", "metric_name"], "left")
    v, b = F.col("metric_value"), F.col("best")
    missing = v.isNull() | F.isnan(v)
    beats = F.when(missing, False).when(b.isNull(), True).otherwise(v > b + margin)
    note = (
        F.when(missing, F.format_string("not promoted: %s unavailable", "metric_name"))
        .when(b.isNull(), F.format_string("first champion: %s=%.3f", "metric_name", v))
        .when(v > b + margin, F.format_string("promoted: %s=%.3f > prev best %.3f", "metric_name", v, b))
        .otherwise(F.format_string("held challenger: %s=%.3f did not beat best %.3f", "metric_name", v, b))
    )
    blocked = F.col("gate_passed").eqNullSafe(False)
    return j.select(*candidates.columns, (beats & ~blocked).alias("is_champion"), F.when(blocked, F.concat(F.lit("BLOCKED by validation gate ("), note, F.lit(")"))).otherwise(note).alias("note"))


def last_champion(model_runs: DataFrame) -> DataFrame:
    """(model_name, run_id, gcs_uri) of the newest champion that has an artefact."""
    good = model_runs.filter("is_champion AND coalesce(gcs_uri, '') <> ''")
    return good.groupBy("model_name").agg(F.max_by(F.struct("run_id", "gcs_uri"), F.struct("trained_at", "run_id")).alias("x")).select("model_name", "x.run_id", "x.gcs_uri")


def serving_choice(gates: DataFrame, champions: DataFrame) -> DataFrame:
    """(model_name, serve, warning): the candidate if its gate passed, else the champion, else the candidate with a warning."""
    j = gates.join(champions.select("model_name", "gcs_uri"), "model_name", "left")
    serve = F.when(F.col("gate_passed"), "candidate").when(F.col("gcs_uri").isNotNull(), F.col("gcs_uri")).otherwise("candidate")
    return j.select("model_name", serve.alias("serve"), (~F.col("gate_passed") & F.col("gcs_uri").isNull()).alias("warning"))


#: Class and primary metric of each registered model; fixed values.
REGISTERED = {"growth": (GBTRegressionModel, "spearman"), "risk": (GBTClassificationModel, "auc")}


def save_model(model, model_name: str, run_id: str, folder: str) -> str:
    """Write a model under its version in a shared folder; returns where it lies."""
    uri = f"{folder.rstrip('/')}/{model_name}-{run_id}"
    model.write().overwrite().save(uri)
    return uri


def load_model(model_name: str, uri: str):
    return REGISTERED[model_name][0].load(uri)


def load_champion(model_runs: DataFrame, model_name: str):
    """The newest champion's model, or None without one that has an artefact."""
    row = last_champion(model_runs.filter(F.col("model_name") == model_name)).first()
    return load_model(model_name, row["gcs_uri"]) if row else None


def registry_rows(candidates: DataFrame, model_runs: DataFrame | None, run_id: str, uris: dict[str, str]) -> DataFrame:
    """Rows of the registry for this run's candidates (model_name, metric_name, metric_value, gate_passed), promoted or held."""
    none = candidates.select("model_name", "metric_name", F.col("metric_value").alias("best")).limit(0)
    told = promotion(candidates, none if model_runs is None else previous_best(model_runs))
    uri = F.coalesce(*[F.when(F.col("model_name") == k, F.lit(v)) for k, v in uris.items()], F.lit(""))
    return told.select(
        F.lit(run_id).alias("run_id"), "model_name", F.current_timestamp().alias("trained_at"), F.concat_ws("-", "model_name", F.lit(run_id)).alias("version"),
        "metric_name", "metric_value", "is_champion", uri.alias("gcs_uri"), "note",
    )


def champion_metrics(model_runs: DataFrame) -> DataFrame:
    return model_runs.filter("is_champion").groupBy("model_name").pivot("metric_name", ["spearman", "auc"]).agg(F.max("metric_value"))


def assemble(frame: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(frame)


#: Rounds of boosting at most, of the growth and the risk model, and rounds without gain on the watched rows that end it.
GROWTH_ROUNDS, RISK_ROUNDS, PATIENCE = 500, 200, 40


def stopping_round(curve: list[float], patience: int) -> tuple[int, bool]:
    """(rounds up to the least error, whether ``patience`` rounds without gain followed) of a run that stops then."""
    best = 0
    for k, error in enumerate(curve):
        if error < curve[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model after its first ``n`` rounds."""
    sc, java = SparkContext.getOrCreate(), model._java_obj
    jvm = sc._jvm
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(jvm.double, n)
    for k, (tree, weight) in enumerate(zip(list(java.trees())[:n], list(java.treeWeights())[:n], strict=True)):
        trees[k], weights[k] = tree, weight
    made = jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    for param in ("featuresCol", "labelCol", "predictionCol"):
        made.set(made.getParam(param), java.getOrDefault(java.getParam(param)))
    return GBTRegressionModel(made)


def fit_patiently(gbt: GBTRegressor, fit: DataFrame, watch: DataFrame, rounds: int, patience: int) -> GBTRegressionModel:
    """Boosting that ends after ``patience`` rounds without gain on ``watch``, cut back to its best round.

    A fit is a prefix of every longer one with the same seed, so it starts with twice the patience and doubles while the
    watch curve still falls: less than twice the rounds of a run that stops by itself.
    """
    n = min(rounds, 2 * patience)
    while True:
        model = gbt.setMaxIter(n).fit(fit)
        best, stopped = stopping_round(model.evaluateEachIteration(watch, "squared"), patience)
        if stopped or n == rounds:
            return first_trees(model, best)
        n = min(rounds, 2 * n)


def rounds_used(model) -> int:
    return model.getNumTrees


def fit_growth(train: DataFrame, features: list[str], rounds: int = GROWTH_ROUNDS, seed: int = 42, patience: int = PATIENCE) -> GBTRegressionModel:
    """Boosted trees on the clipped target; every tenth date of the training part watches for early stopping.

    Where the hash picks none of few dates, or all of them, every row trains and all rounds run.
    """
    watch = F.pmod(F.xxhash64("feature_date", F.lit(seed)), F.lit(10)) == 0
    rows = assemble(train.withColumn("_y", clip_target(TARGET)).withColumn("_watch", watch), features)
    gbt = GBTRegressor(labelCol="_y", maxIter=rounds, stepSize=0.1, maxDepth=5, minInstancesPerNode=30, subsamplingRate=0.8, featureSubsetStrategy="0.9",
                       seed=seed, maxBins=32)
    sides = rows.agg(F.count_if("_watch").alias("watch"), F.count_if(~F.col("_watch")).alias("fit")).first()
    if not (sides["watch"] and sides["fit"]):
        return gbt.fit(rows)
    rows = written(rows.select("features", "_y", "_watch"), "boosting")
    return fit_patiently(gbt, rows.filter("NOT _watch"), rows.filter("_watch"), rounds, patience)


def predict_growth(model: GBTRegressionModel, frame: DataFrame, features: list[str]) -> DataFrame:
    return model.transform(assemble(frame, features)).withColumnRenamed("prediction", "growth_pred").drop("features")


def importance(model: GBTRegressionModel, features: list[str], spark) -> DataFrame:
    """(feature, share), sums to 1 where any split was made."""
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)], "feature string, share double")


def growth_metrics(split: DataFrame, model: GBTRegressionModel, features: list[str]) -> DataFrame:
    test = predict_growth(model, split.filter("is_test"), features).select(F.col(TARGET).alias("y"), F.col("growth_pred").alias("yhat"))
    m = stats.regression_metrics(test).crossJoin(stats.spearman(test, "y", "yhat"))
    return m.crossJoin(split.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test")))


def growth_backtest(split: DataFrame, features: list[str], rounds: int = 20, scatter: int = 300, least: int = 50) -> DataFrame:
    """One row (metrics, calibration, scatter) of the test rows, whose targets are clipped; all null under ``least`` rows in all.

    Calibration holds the ten deciles, scatter a sample of bounded size.
    """
    known = split.filter(F.col(TARGET).isNotNull()).withColumn(TARGET, clip_target(TARGET))
    parts = known.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test")).first()
    if parts["n_train"] + parts["n_test"] < least:
        nothing = [F.lit(None).cast(t) for t in (_METRICS, _DECILES, _SCATTER)]
        return split.sparkSession.range(1).select(*[c.alias(n) for c, n in zip(nothing, ("metrics", "calibration", "scatter"), strict=True)])
    model = fit_growth(known.filter("NOT is_test"), features, rounds)
    test = predict_growth(model, known.filter("is_test"), features).select("name", F.col("feature_date").alias("t"), F.col(TARGET).alias("y"), F.col("growth_pred").alias("yhat")).persist()
    m = stats.regression_metrics(test).crossJoin(stats.spearman(test, "y", "yhat"))
    metrics = m.select(F.struct("spearman", "mae", "rmse", "r2", F.lit(parts["n_test"]).alias("n_test"), F.lit(parts["n_train"]).alias("n_train")).cast(_METRICS).alias("metrics"))
    deciles = calibration_deciles(test).agg(F.array_sort(F.collect_list(F.struct("decile", "n", "mean_pred", "mean_actual"))).cast(_DECILES).alias("calibration"))
    points = scatter_sample(test, scatter).agg(F.collect_list(F.struct(F.col("yhat").alias("pred"), F.col("y").alias("actual"))).cast(_SCATTER).alias("scatter"))
    return metrics.crossJoin(deciles).crossJoin(points)


_METRICS = "struct<spearman:double,mae:double,rmse:double,r2:double,n_test:bigint,n_train:bigint>"
_DECILES = "array<struct<decile:int,n:bigint,mean_pred:double,mean_actual:double>>"
_SCATTER = "array<struct<pred:double,actual:double>>"


def walk_forward(frame: DataFrame, folds: DataFrame, features: list[str], rounds: int = 20) -> DataFrame:
    """(fold, n_train, n_test, r2, mae, rmse, spearman, persistence_..., skill): one fit per fold of ``fold_rows``.

    ``frame`` as of ``validation_frame``, ``folds`` as of ``walk_forward_folds``; the few folds are looped over.
    """
    rows = frame.withColumns({"feature_date": F.col("t"), TARGET: F.col("y")}).persist()
    out = []
    for f in stats.fold_rows(rows, folds).join(folds, "fold").orderBy("fold").collect():
        train, test = rows.filter(F.col("t") <= f["train_until"]), rows.filter(F.col("t").between(f["test_from"], f["test_until"]))
        told = predict_growth(fit_growth(train, features, rounds), test, features).select("y", "persistence", F.col("growth_pred").alias("yhat"))
        figures = stats.regression_metrics(told).drop("n").crossJoin(stats.spearman(told, "y", "yhat"))
        plain = stats.regression_metrics(told, yhat="persistence").drop("n").crossJoin(stats.spearman(told, "y", "persistence"))
        both = figures.crossJoin(plain.select(*[F.col(c).alias(f"persistence_{c}") for c in plain.columns])).crossJoin(stats.skill(told)).first()
        out.append((f["fold"], f["n_train"], f["n_test"], *both))
    rows.unpersist()
    names = ["r2", "mae", "rmse", "spearman"]
    doubles = ", ".join(f"{c} double" for c in [*names, *[f"persistence_{c}" for c in names], "skill"])
    return frame.sparkSession.createDataFrame(out, f"fold bigint, n_train bigint, n_test bigint, {doubles}")


def disjoint_cv(frame: DataFrame, features: list[str], k: int = 5, rounds: int = 20) -> DataFrame:
    """(n, r2, mae, rmse, spearman) of forecasts by models that saw no row of the name: k fits on whole-name folds."""
    rows = frame.join(stats.group_folds(frame, k), "name").persist()
    held = [r["fold"] for r in rows.select("fold").distinct().orderBy("fold").collect()]
    if len(held) < 2:  # no other names to fit on
        return frame.sparkSession.createDataFrame([(0, None, None, None, None)], "n bigint, r2 double, mae double, rmse double, spearman double")
    parts = [predict_growth(fit_growth(rows.filter(F.col("fold") != i), features, rounds), rows.filter(F.col("fold") == i), features) for i in held]
    told = reduce(DataFrame.unionByName, parts).select(F.col(TARGET).alias("y"), F.col("growth_pred").alias("yhat"))
    return stats.regression_metrics(told).crossJoin(stats.spearman(told, "y", "yhat"))


def attributions(model: GBTRegressionModel, frame: DataFrame, features: list[str], top: int = 3) -> DataFrame:
    """(name, feature_date, feature, value, pos): what each feature's splits move along a row's path through the trees.

    Node values change from parent to child; the change goes to the feature that was asked. Contributions and the
    roots' values add up to the prediction. A path attribution, not Shapley values.
    """
    shared = frame.sparkSession.sparkContext.broadcast([(t_weight, _nodes(t)) for t, t_weight in zip(model.trees, model.treeWeights, strict=True)])
    names = list(features)

    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            x = pdf[names].to_numpy(float)
            out = np.zeros((len(x), len(names)))
            for weight, (left, right, feature, split, value) in shared.value:
                at = np.zeros(len(x), int)
                while True:
                    inner = np.flatnonzero(left[at] >= 0)
                    if not len(inner):
                        break
                    f = feature[at[inner]]
                    nxt = np.where(x[inner, f] <= split[at[inner]], left[at[inner]], right[at[inner]])
                    np.add.at(out, (inner, f), weight * (value[nxt] - value[at[inner]]))
                    at[inner] = nxt
            order = np.argsort(-np.abs(out), axis=1, kind="stable")[:, :top]
            for pos in range(order.shape[1]):
                k = order[:, pos]
                yield pd.DataFrame({"name": pdf["name"], "feature_date": pdf["feature_date"], "feature": np.array(names)[k], "value": out[np.arange(len(x)), k], "pos": pos})

    return frame.select("name", "feature_date", *names).mapInPandas(run, "name string, feature_date date, feature string, value double, pos int")


def _nodes(tree) -> tuple:
    """Arrays of one regression tree in pre-order: left, right, feature, threshold, value."""
    import numpy as np

    left, right, feature, split, value = [], [], [], [], []

    def visit(node) -> int:
        i = len(left)
        left.append(-1), right.append(-1), feature.append(0), split.append(0.0), value.append(node.prediction())
        if node.numDescendants() > 0:
            feature[i], split[i] = node.split().featureIndex(), node.split().threshold()
            left[i] = visit(node.leftChild())
            right[i] = visit(node.rightChild())
        return i

    visit(tree._call_java("rootNode"))
    return tuple(np.array(a) for a in (left, right, feature, split, value))


def fit_risk(frame: DataFrame, features: list[str], label: str = "at_risk_label", rounds: int = RISK_ROUNDS, seed: int = 42):
    """Boosted classifier, or None where a class has fewer than three rows."""
    n = frame.agg(F.count("*").alias("n"), F.sum(label).alias("p")).first()
    if (n["p"] or 0) < 3 or n["p"] > n["n"] - 3:
        return None
    return GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, seed=seed).fit(assemble(frame, features))


def predict_risk(model, frame: DataFrame, features: list[str]) -> DataFrame:
    """Rows with ``probability`` (null without a model)."""
    if model is None:
        return frame.withColumn("probability", F.lit(None).cast("double"))
    out = model.transform(assemble(frame, features)).withColumn("probability", vector_to_array("probability")[1])
    return out.drop("features", "rawPrediction", "prediction")


def out_of_fold(frame: DataFrame, features: list[str], k: int, label: str = "at_risk_label", rounds: int = 10) -> DataFrame:
    """Each row scored by the model that did not see its fold (folds are few; the fits are distributed). Null without two folds."""
    if k < 2:
        return predict_risk(None, frame, features)
    parts = [predict_risk(fit_risk(frame.filter(F.col("fold") != i), features, label, rounds), frame.filter(F.col("fold") == i), features) for i in range(k)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def experiment(split: DataFrame, active: list[str], candidates: list[str], rounds: int = 20) -> DataFrame:
    """(candidate, base, new, delta): rank skill with each candidate feature added, best first; active or absent ones are skipped."""
    def rho(features: list[str]) -> float | None:
        model = fit_growth(split.filter("NOT is_test"), features, rounds)
        return growth_metrics(split, model, features).first()["spearman"]

    base = rho(active)
    rows = [(c, base, new := rho([*active, c]), new - base if new is not None and base is not None else None) for c in candidates if c not in active and c in split.columns]
    return split.sparkSession.createDataFrame(rows, "candidate string, base double, new double, delta double").orderBy(F.desc_nulls_last("delta"), "candidate")
