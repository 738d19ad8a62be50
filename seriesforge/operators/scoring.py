"""Scoring and drift: momentum, reason phrases, assembled predictions, population stability, label churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesforge.functions.columns import momentum_label, momentum_score, risk_level
from seriesforge.functions.lineage import cut, written
from seriesforge.operators.ranks import quantiles
from seriesforge.operators.risk import blend

#: Phrases for a feature that pushes up or down; fixed values.
PHRASES = {
    "log_d56": ("strong 8-week download base", "small 8-week download base"),
    "log_d84": ("strong 12-week download base", "small 12-week download base"),
    "mom_28v28": ("monthly downloads rising vs prior month", "monthly downloads falling vs prior month"),
    "mom_56v56": ("8-week downloads rising vs prior 8 weeks", "8-week downloads falling vs prior 8 weeks"),
    "mom_28v56": ("recent month above the 8-week pace", "recent month below the 8-week pace"),
    "trend_slope_56": ("8-week download trend rising", "8-week download trend falling"),
    "trend_slope_84": ("12-week download trend rising", "12-week download trend falling"),
    "mom_7v7": ("weekly downloads accelerating vs prior week", "weekly downloads slowing vs prior week"),
    "mom_7v28": ("this week running above the monthly average", "this week below the monthly average"),
    "trend_slope_28": ("28-day download trend rising", "28-day download trend falling"),
    "velocity": ("high recent download volume", "low recent download volume"),
    "log_d7": ("strong weekly download base", "small weekly download base"),
    "log_d28": ("strong monthly download base", "small monthly download base"),
    "volatility_28": ("volatile download pattern", "steady download pattern"),
    "recent_share": ("downloads concentrated in the last week", "downloads spread over the month"),
    "trend_slope_7": ("7-day download trend rising", "7-day download trend falling"),
    "dow_volatility_7": ("spiky week of downloads", "smooth week of downloads"),
}


def phrases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in PHRASES.items()], "feature string, up string, down string")


def reason_texts(contributions: DataFrame, top: int = 2) -> DataFrame:
    """(name, reasons): phrases of the contributions (name, feature, value, pos) in order of pos, first ``top``."""
    told = contributions.join(F.broadcast(phrases(contributions.sparkSession)), "feature", "left").withColumn(
        "reason", F.coalesce(F.when(F.col("value") >= 0, F.col("up")).otherwise(F.col("down")), F.col("feature"))
    )
    ranked = told.groupBy("name").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "reason"))), 1, top).alias("r"))
    return ranked.select("name", F.transform("r", lambda x: x["reason"]).alias("reasons"))


def assemble_predictions(scores: DataFrame, composites: DataFrame, probabilities: DataFrame, reasons: DataFrame, run_id: str) -> DataFrame:
    """Predictions of a run: growth scores of names that have a snapshot, blended risk, reasons of both kinds."""
    growth, risk = F.col("growth_pred"), blend("composite", "probability")
    return (
        scores.join(composites.select("name", "category", "composite", F.col("reasons").alias("risk_reasons")), "name")
        .join(probabilities.select("name", "probability"), "name", "left")
        .join(reasons.select("name", F.col("reasons").alias("growth_reasons")), "name", "left")
        .select(
            F.lit(run_id).alias("run_id"), "name", "category", momentum_score(growth).alias("momentum_score"), risk.alias("risk_score"),
            F.round(growth, 4).alias("growth_pred_70d"), momentum_label(momentum_score(growth)).alias("momentum_label"), risk_level(risk).alias("risk_level"),
            F.to_json(F.concat(F.coalesce("growth_reasons", F.array().cast("array<string>")), "risk_reasons")).alias("top_reasons"),
        )
    )


def population_stability(frame: DataFrame, column: str, by: list[str], side: str = "side", bins: int = 10) -> DataFrame:
    """(by..., psi): stability index between the rows of side 'prev' and 'curr' of each group.

    Bins are the distinct linear-interpolated quantiles of both sides together, the last one closed; fewer than three
    edges or two values of a side give 0. Shares are floored at 1e-4.
    """
    x = written(frame.filter(F.col(column).isNotNull() & ~F.isnan(column)).select(*by, side, F.col(column).alias("x")), "stability")
    sides = x.groupBy(*by).agg(F.count_if(F.col(side) == "prev").alias("n_prev"), F.count_if(F.col(side) == "curr").alias("n_curr"))
    q = quantiles(x, "x", [i / bins for i in range(bins + 1)], by).select(*by, F.array_distinct("q").alias("edges"))
    edges = q.join(sides, by)
    enough = (F.size("edges") >= 3) & (F.least("n_prev", "n_curr") >= 2)
    # the bin of a value: how many edges lie at or below it, the top edge belonging to the last bin
    placed = x.join(edges.filter(enough), by).withColumn(
        "bin", F.least(F.size(F.filter("edges", lambda e: e <= F.col("x"))), F.size("edges") - 1)
    )
    counts = placed.groupBy(*by, "bin").agg(F.count_if(F.col(side) == "prev").alias("p"), F.count_if(F.col(side) == "curr").alias("c"))
    full = edges.filter(enough).withColumn("bin", F.explode(F.sequence(F.lit(1), F.size("edges") - 1))).join(counts, [*by, "bin"], "left")
    e = F.greatest(F.coalesce("p", F.lit(0)) / F.col("n_prev"), F.lit(1e-4))
    a = F.greatest(F.coalesce("c", F.lit(0)) / F.col("n_curr"), F.lit(1e-4))
    told = full.groupBy(*by).agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    return edges.select(*by).join(told, by, "left").withColumn("psi", F.coalesce("psi", F.lit(0.0)))


def run_order(predictions: DataFrame) -> DataFrame:
    """(prev_run, curr_run) of consecutive runs; one row per run, ordered by time."""
    runs = predictions.groupBy("run_id").agg(F.max("predicted_at").alias("at"))
    w = Window.orderBy("at", "run_id")
    return runs.select(F.lag("run_id").over(w).alias("prev_run"), F.col("run_id").alias("curr_run")).filter("prev_run IS NOT NULL")


def both_sides(predictions: DataFrame) -> DataFrame:
    """Every prediction as 'curr' of its run and as 'prev' of the next one, keyed by curr_run."""
    pairs = run_order(predictions)
    curr = predictions.join(F.broadcast(pairs), predictions["run_id"] == pairs["curr_run"]).withColumn("side", F.lit("curr"))
    prev = predictions.join(F.broadcast(pairs), predictions["run_id"] == pairs["prev_run"]).withColumn("side", F.lit("prev"))
    return curr.unionByName(prev)


def mean_shift(sides: DataFrame, column: str, digits: int = 2) -> DataFrame:
    def of(s: str) -> Column:
        return F.avg(F.when(F.col("side") == s, F.col(column)))

    return sides.groupBy("curr_run").agg(F.coalesce(F.round(of("curr") - of("prev"), digits), F.lit(0.0)).alias(f"{column}_mean_shift"))


def label_churn(sides: DataFrame) -> DataFrame:
    """(curr_run, label_churn): share of common names whose label changed, averaged over the two labels; null differs."""
    p, c = sides.filter("side = 'prev'"), sides.filter("side = 'curr'")
    labels = ("momentum_label", "risk_level")
    both = p.select("curr_run", "name", *[F.col(x).alias(f"{x}_p") for x in labels]).join(c.select("curr_run", "name", *labels), ["curr_run", "name"])
    changed = [F.avg(F.coalesce(F.col(f"{x}_p") != F.col(x), F.lit(True)).cast("int")) for x in labels]
    churn = both.groupBy("curr_run").agg(F.round((changed[0] + changed[1]) / 2, 3).alias("label_churn"))
    return sides.select("curr_run").distinct().join(churn, "curr_run", "left").withColumn("label_churn", F.coalesce("label_churn", F.lit(0.0)))


def drift_severity(psi: Column, churn: Column) -> Column:
    return F.when((psi > 0.25) | (churn > 0.30), "high").when((psi > 0.10) | (churn > 0.15), "moderate").otherwise("low")


def drift_report(predictions: DataFrame) -> DataFrame:
    """Drift of every run against the one before it; the first run has none and is marked unavailable."""
    # read by the churn, both stability indexes and both shifts: written once
    predictions = cut(predictions.select("run_id", "predicted_at", "name", "momentum_score", "risk_score", "momentum_label", "risk_level"))
    sides = both_sides(predictions).select("curr_run", "side", "name", "momentum_score", "risk_score", "momentum_label", "risk_level")
    out = label_churn(sides)
    for c in ("momentum_score", "risk_score"):
        psi = population_stability(sides, c, ["curr_run"]).select("curr_run", F.round("psi", 3).alias(f"{c}_psi"))
        out = out.join(psi, "curr_run").join(mean_shift(sides, c), "curr_run")
    out = out.withColumn("severity", drift_severity(F.greatest("momentum_score_psi", "risk_score_psi"), F.col("label_churn")))
    runs = predictions.select(F.col("run_id").alias("curr_run")).distinct()
    return runs.join(out, "curr_run", "left").withColumn("available", F.col("severity").isNotNull()).withColumn("severity", F.coalesce("severity", F.lit("none")))


def melt(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row per metric: keys, metric_name, metric_value (double)."""
    return df.unpivot(keys, [F.col(m).cast("double").alias(m) for m in metrics], "metric_name", "metric_value")
