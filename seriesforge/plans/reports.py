"""Whole reports as plans over the operators: frames in, frames out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.functions.columns import lookup
from seriesforge.functions.lineage import cut
from seriesforge.operators import audit as G
from seriesforge.operators import forecast as K
from seriesforge.operators import models as M
from seriesforge.operators import series as S
from seriesforge.operators import stats as J


def validation_report(history: DataFrame, features: list[str] | None = None, rounds: int = 20, replicates: int = 2000) -> dict[str, DataFrame]:
    """Held-out skill of the growth model on (name, date, downloads): metrics, baselines, folds, intervals, tests.

    Rows of the last two origins are held out; their forecasts are written once, as every figure reads them.
    """
    features = features or list(S.FEATURES)
    frame = cut(S.validation_frame(history))
    split = J.last_origins(frame)
    fitted = M.fit_growth(split.filter("NOT is_test").withColumns({"feature_date": F.col("t"), M.TARGET: F.col("y")}), features, rounds)
    told = M.predict_growth(fitted, split.filter("is_test"), features)
    scored = cut(told.select("name", "t", "y", "persistence", F.col("growth_pred").alias("yhat")))
    losses = scored.select("name", "t", ((F.col("y") - F.col("yhat")) ** 2 - (F.col("y") - F.col("persistence")) ** 2).alias("d"))
    named = frame.withColumns({"feature_date": F.col("t"), M.TARGET: F.col("y")})
    return {
        "metrics": J.regression_metrics(scored).crossJoin(J.spearman(scored, "y", "yhat")).crossJoin(J.skill(scored)),
        "by_origin": J.regression_metrics(scored, ["t"]), "baselines": J.naive_baselines(split),
        "calibrated_persistence": J.regression_metrics(J.calibrated_persistence(split)), "origins": J.origin_diagnostics(frame),
        "walk_forward": M.walk_forward(frame, J.walk_forward_folds(frame), features, rounds), "unseen_names": M.disjoint_cv(named, features, rounds=rounds),
        "intervals": J.cluster_bootstrap(scored, replicates), "block_permutation": J.permutation_p(scored, replicates), "row_permutation": J.permutation_p(scored, replicates, False),
        "diebold_mariano": J.diebold_mariano(losses, J.HORIZON), "between_within": J.between_within(scored), "head": J.head_reliability(scored), "sample": J.effective_sample(frame),
    }


def audit_run(files: DataFrame, priorities: DataFrame, advisories: DataFrame, known: DataFrame, history: DataFrame) -> dict[str, DataFrame]:
    """Audit of the dependency files (doc, branch, path, text) that the ``priorities`` (branch, path, rank) choose for each document.

    Requirement lists and project files are parsed by their path; verdicts come worst first.
    """
    named = files.withColumn("doc", F.to_json(F.struct("doc", "branch", "path")))
    project = F.col("path").endswith(".toml")
    parsed = G.parse_requirements(named.filter(~project)).select("doc", "name", "version").union(G.parse_pyproject(named.filter(project)).select("doc", "name", "version"))
    told = F.from_json("doc", "doc string, branch string, path string")
    flat = parsed.select(told.alias("f"), "name", "version").select(F.col("f.doc").alias("repo"), "f.branch", "f.path", "name", "version")
    deps = G.choose_file(flat, priorities).select(F.col("repo").alias("doc"), "name", "version")
    exposed = G.exposure(deps, advisories).withColumn("max_severity", lookup("severity_rank", {1: "LOW", 2: "MODERATE", 3: "HIGH", 4: "CRITICAL"}))
    audited = cut(G.audit(exposed, known, G.week_trend(history)))
    return {"verdicts": G.audit_order(audited), "summary": G.audit_summary(audited, ["doc"])}


def forecast_report(history: DataFrame) -> dict[str, DataFrame]:
    """Diagnostics and rolling-origin errors of the daily series that are long enough."""
    series = cut(K.admit(history))
    parts = cut(K.decompose(series))
    errors = cut(K.mase(K.origins(series).join(K.holt_winters(series), ["name", "i", "h"]), K.scale(series), ("ets", "seasonal_naive", "naive")))
    strengths, boxes = K.seasonal_strength(parts), K.ljung_box(series)
    return {"strength": strengths, "ljung_box": boxes, "arch_lm": K.arch_lm(parts), "jarque_bera": K.jarque_bera(parts), "errors": errors, "summary": K.forecast_summary(errors, ("ets", "seasonal_naive", "naive"))}
