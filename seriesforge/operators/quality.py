"""Data quality and run logging as small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_rates(snapshots: DataFrame, by: str = "run_id", status: str = "source_status") -> DataFrame:
    """(run, source, rate): share of rows whose JSON status map says ok."""
    told = snapshots.select(by, F.explode(F.from_json(status, "map<string,boolean>")).alias("source", "ok"))
    return told.groupBy(by, "source").agg(F.round(F.avg(F.coalesce("ok", F.lit(False)).cast("int")), 3).alias("rate"))


def source_health(rates: DataFrame, by: str = "run_id") -> DataFrame:
    """(run, status, summary): error if a source is down, warning if one is degraded (below 0.7)."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("source", "rate"))), lambda x: F.format_string("%s %d%%", x["source"], F.floor(x["rate"] * 100 + 1e-9)))
    status = F.when(F.count_if(F.col("rate") == 0) > 0, "error").when(F.count_if((F.col("rate") > 0) & (F.col("rate") < 0.7)) > 0, "warning").otherwise("ok")
    return rates.groupBy(by).agg(status.alias("status"), F.array_join(parts, ", ").alias("summary"))


KEY_COLUMNS = ("stars", "dependent_repos_count", "scorecard_overall", "bus_factor")


def quality_report(snapshots: DataFrame, by: str = "run_id") -> DataFrame:
    """Rows, duplicates beyond the first per name, download coverage, null rates and a verdict, per run."""
    told = snapshots.groupBy(by).agg(
        F.count("*").alias("n_rows"), (F.count("*") - F.count_distinct("name")).alias("duplicates"),
        F.round(F.avg(F.col("downloads_7d").isNotNull().cast("int")), 3).alias("coverage"),
        *[F.round(F.avg(F.col(c).isNull().cast("int")), 3).alias(f"null_{c}") for c in KEY_COLUMNS],
    )
    return told.withColumn("status", F.when((F.col("duplicates") == 0) & (F.col("coverage") >= 0.8), "ok").otherwise("warning"))


def _entry(rows: DataFrame, agent: str, action: Column | str, status: Column | str, summary: Column, ts: Column | None) -> DataFrame:
    """Rows of the run log; those that carry an ``artifact_url`` keep it."""
    url = F.coalesce("artifact_url", F.lit("")) if "artifact_url" in rows.columns else F.lit("")
    said = [(F.lit(x) if isinstance(x, str) else x).alias(n) for n, x in (("agent", agent), ("action", action), ("status", status))]
    return rows.select("run_id", (F.current_timestamp() if ts is None else ts).alias("ts"), *said, summary.alias("summary"), url.alias("artifact_url"))


def activity_rows(health: DataFrame, quality: DataFrame, drift: DataFrame, ts: Column | None = None) -> DataFrame:
    """The run log (run_id, ts, agent, action, status, summary, artifact_url): one row per check and run."""
    covered = F.format_string("%d%% coverage, %d duplicates", F.round(F.col("coverage") * 100).cast("int"), F.col("duplicates"))
    moved = F.when(F.col("severity") == "high", "warning").otherwise("ok")
    return (
        _entry(health, "ingest", "check_sources", F.col("status"), F.col("summary"), ts)
        .unionByName(_entry(quality, "quality", "validate_table", F.col("status"), covered, ts))
        .unionByName(_entry(drift.withColumnRenamed("curr_run", "run_id"), "monitor", "monitor_drift", moved, F.concat(F.lit("drift "), "severity"), ts))
    )


def model_activity(promoted: DataFrame, ts: Column | None = None) -> DataFrame:
    """Log rows of trained models (run_id, model_name, metric_name, metric_value, note)."""
    value = F.when(F.isnan("metric_value") | F.col("metric_value").isNull(), "n/a").otherwise(F.format_string("%.3f", "metric_value"))
    return _entry(promoted, "trainer", F.concat(F.lit("retrain_"), "model_name"), "ok", F.concat("metric_name", F.lit("="), value, F.lit("; "), "note"), ts)


def experiment_activity(results: DataFrame, best: DataFrame, ts: Column | None = None) -> DataFrame:
    """Log rows of feature experiments (run_id, candidate, base, new, delta): what was tried, and the choice where there is one."""
    change = F.when(F.col("delta").isNull(), F.concat("candidate", F.lit(" n/a"))).otherwise(F.format_string("%s %+.3f", "candidate", "delta"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.negative(F.coalesce("delta", F.lit(float("-inf")))).alias("o"), "candidate", change.alias("t")))), lambda x: x["t"]), ", ")
    tried = results.groupBy("run_id").agg(listed.alias("t"), F.count("*").alias("n"))
    told = _entry(tried, "trainer", "feature_experiment", "ok", F.format_string("%d candidates: %s", "n", "t"), ts)
    chosen = tried.select("run_id").join(best.select("run_id", change.alias("c")), "run_id", "left")
    return told.unionByName(_entry(chosen, "trainer", "propose_feature", "ok", F.coalesce("c", F.lit("no candidate")), ts))


def experiment_table(results: DataFrame) -> DataFrame:
    """(pos, line): the experiment as lines of a text table, best lift first."""
    def number(c: str, pattern: str) -> Column:
        return F.when(F.col(c).isNull(), "n/a").otherwise(F.format_string(pattern, c))

    line = F.concat_ws(" | ", "candidate", number("base", "%.4f"), number("new", "%.4f"), number("delta", "%+.4f"))
    rows = results.agg(F.array_sort(F.collect_list(F.struct(F.negative(F.coalesce("delta", F.lit(float("-inf")))).alias("o"), "candidate", line.alias("line")))).alias("x"))
    return rows.select(F.posexplode("x").alias("pos", "r")).select("pos", F.col("r.line").alias("line"))


def run_record(counts: DataFrame, run_id: str, stages: dict[str, float]) -> DataFrame:
    """One row: run, status, durations and counts as JSON."""
    return counts.select(
        F.lit(run_id).alias("run_id"), F.lit("success").alias("status"),
        F.to_json(F.create_map(*[F.lit(x) for kv in stages.items() for x in kv])).alias("stages"), F.to_json(F.struct(*counts.columns)).alias("counts"),
    )
