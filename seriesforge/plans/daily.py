"""The daily run as one plan: inputs to features, scores, drift, quality and logs; frames in, frames out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.functions.lineage import cut as _cut
from seriesforge.operators import models as M
from seriesforge.operators import quality as Q
from seriesforge.operators import risk as R
from seriesforge.operators import scoring as C
from seriesforge.operators import series as S
from seriesforge.operators.reads import latest_run
from seriesforge.sources.payloads import carry_forward, failures


def run(
    history: DataFrame, snapshots: DataFrame, earlier_predictions: DataFrame | None, run_id: str, features: list[str] | None = None, rounds: int = 20,
    model_runs: DataFrame | None = None, models: str | None = None,
) -> dict[str, DataFrame]:
    """Heal, featurise, train, gate, promote, score and compare with the run before.

    ``history``: (name, date, downloads); ``snapshots``: all runs' snapshot rows, the newest run being this one;
    ``model_runs``: the registry so far; ``models``: a shared folder for model files. Scores come from this run's growth
    model if its gate passes, else from the last champion where there is one; so does the risk model where too few cases allow no fit. Fits are the only actions besides the
    one-row frames that decide which model serves.
    """
    features = features or list(S.FEATURES)
    snapshots = _cut(snapshots)  # read by healing, both risk frames and the composite score
    current = latest_run(snapshots, "snapshot_date").select(snapshots.columns)
    earlier = snapshots.join(current.select("run_id").distinct(), "run_id", "left_anti").select(snapshots.columns)
    healed = _cut(carry_forward(current.withColumn("origin", F.lit("ingested")), earlier))
    split = _cut(M.time_split(S.training_frame(history)))
    growth = M.fit_growth(split.filter("NOT is_test"), features, rounds)
    metrics = M.growth_metrics(split, growth, features)
    unseen = M.disjoint_cv(split, features, rounds=rounds).select(F.col("r2").alias("oof_r2"), F.col("spearman").alias("oof_spearman"))
    checks = _cut(M.gate_checks(metrics.crossJoin(unseen).select(F.lit("growth").alias("model_name"), "n", "r2", "spearman", "oof_r2", "oof_spearman")))
    gate = _cut(M.gate_result(checks, ["model_name"]))
    scoring = S.scoring_frame(history)
    risk = R.choose_training(R.risk_frame(healed), R.forward_frame(snapshots))
    columns = list(R.RISK_FEATURES)
    known = _cut(R.impute_medians(risk.drop("label_mode"), columns))
    model = M.fit_risk(known, columns, rounds=min(rounds, M.RISK_ROUNDS))
    candidates = metrics.select(F.lit("growth").alias("model_name"), F.lit("spearman").alias("metric_name"), F.col("spearman").alias("metric_value")).join(gate.select("model_name", F.col("passed").alias("gate_passed")), "model_name")
    if model is not None:
        k = min(5, known.agg(F.sum("at_risk_label").alias("p")).first()["p"])
        unseen_risk = M.out_of_fold(_cut(M.stratified_folds(known, k, "at_risk_label")), columns, k)
        auc = M.roc_auc(unseen_risk.filter("probability IS NOT NULL"), "at_risk_label", "probability")
        candidates = candidates.unionByName(auc.select(F.lit("risk").alias("model_name"), F.lit("auc").alias("metric_name"), F.col("auc").alias("metric_value"), F.lit(None).cast("boolean").alias("gate_passed")))
    fitted = {"growth": growth, **({"risk": model} if model is not None else {})}
    registry = M.registry_rows(_cut(candidates), model_runs, run_id, {n: M.save_model(m, n, run_id, models) for n, m in fitted.items()} if models else {})
    champions = M.last_champion(model_runs) if model_runs is not None else registry.select("model_name", "run_id", "gcs_uri").limit(0)
    serving = _cut(M.serving_choice(gate.select("model_name", F.col("passed").alias("gate_passed")), champions))
    if (serve := serving.first()["serve"]) != "candidate":
        growth = M.load_model("growth", serve)
    # without enough cases to fit on, the last risk champion serves
    served = model if model is not None or model_runs is None else M.load_champion(model_runs, "risk")
    probabilities = M.predict_risk(served, R.impute_medians(R.risk_frame(healed), columns), columns)
    scores = M.predict_growth(growth, scoring, features).select("name", "growth_pred")
    reasons = C.reason_texts(M.attributions(growth, scoring, features))
    predictions = _cut(C.assemble_predictions(scores, R.composite_score(healed), probabilities, reasons, run_id).withColumn("predicted_at", F.current_timestamp()))
    out = {
        "features": S.feature_table(scoring, R.risk_frame(healed), healed, run_id), "metrics": metrics, "gate": gate, "gate_checks": checks, "model_runs": registry, "serving": serving,
        "predictions": predictions, "quality": Q.quality_report(healed), "failures": failures(current),
    }
    if earlier_predictions is not None:
        out["drift"] = C.drift_report(latest_run(earlier_predictions, "predicted_at").unionByName(predictions, allowMissingColumns=True))
    return out
