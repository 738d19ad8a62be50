"""Read queries: the latest run, leaderboards, details, feeds and the brief."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SNAPSHOT_COLUMNS = (
    "repo", "stars", "forks", "downloads_28d", "downloads_7d", "dependent_repos_count",
    "vuln_count", "scorecard_overall", "days_since_last_release", "bus_factor", "archived",
)


def latest_run(df: DataFrame, ts: str, run: str = "run_id") -> DataFrame:
    """Rows of the run whose row is the newest: a one-row aggregate, broadcast back."""
    newest = df.agg(F.max_by(run, F.struct(ts, run)).alias(run))
    return df.join(F.broadcast(newest), run, "left_semi")


def latest_predictions(predictions: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Latest predictions with the latest snapshot's columns and parsed reasons."""
    snap = latest_run(snapshots, "snapshot_date").select("name", *SNAPSHOT_COLUMNS)
    return latest_run(predictions, "predicted_at").join(snap, "name", "left").withColumn("top_reasons", F.from_json("top_reasons", "array<string>"))


def merge_legacy(df: DataFrame, new: str, old: str) -> DataFrame:
    """One column from a new and an old name, where both may exist."""
    if old not in df.columns:
        return df
    return df.withColumn(new, F.coalesce(new, old) if new in df.columns else F.col(old)).drop(old)


def overview(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count("*").alias("tracked"), F.round(F.avg("momentum_score"), 1).alias("avg_momentum"),
        F.count_if(F.col("risk_level") == "high").alias("high_risk"), F.count_if(F.col("momentum_label") == "high").alias("rising"),
    )


def top(df: DataFrame, by: str, k: int = 8) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), "name").limit(k)


def category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count("*").alias("n"))


def leaderboard(latest: DataFrame) -> DataFrame:
    cols = ("name", "category", "repo", "momentum_score", "risk_score", "growth_pred_70d", "momentum_label", "risk_level", "stars",
            "downloads_28d", "dependent_repos_count", "vuln_count", "scorecard_overall")
    return latest.select(*cols).orderBy(F.desc("momentum_score"), "name")


def detail(name: str, predictions: DataFrame, history: DataFrame, snapshots: DataFrame) -> dict[str, DataFrame]:
    """Everything about one name; the filters reach the scans."""
    return {
        "prediction": latest_run(predictions, "predicted_at").filter(F.col("name") == name),
        "history": history.filter(F.col("name") == name).orderBy("date"),
        "snapshots": snapshots.filter(F.col("name") == name).orderBy("snapshot_date"),
    }


def feed(log: DataFrame, ts: str, n: int, json_columns: tuple[str, ...] = ()) -> DataFrame:
    """The newest n rows with their JSON columns parsed to maps."""
    newest = log.orderBy(F.desc(ts), *[c for c in log.columns if c != ts and c not in json_columns]).limit(n)
    return newest.withColumns({c: F.from_json(c, "map<string,string>") for c in json_columns})


def latest_payload(table: DataFrame, schema: str, ts: str = "created_at") -> DataFrame:
    return table.orderBy(F.desc(ts), F.desc("run_id")).limit(1).select("run_id", F.from_json("payload", schema).alias("p")).select("run_id", "p.*")


def brief_lines(predictions: DataFrame, k: int = 6) -> DataFrame:
    """(section, pos, line): header, movers and risks of a run as text lines in order."""
    told = predictions.withColumn("why", F.array_join("top_reasons", ", "))
    head = told.agg(F.format_string("Tracked %d packages", F.count("*")).alias("line")).select(F.lit(0).alias("section"), F.lit(0).alias("pos"), "line")
    parts = [head]
    for section, (by, line) in enumerate((
        ("momentum_score", F.format_string("%s | %.0f | %s", "name", "momentum_score", "why")),
        ("risk_score", F.format_string("%s | %.0f | %s | %s", "name", "risk_score", "risk_level", "why")),
    ), 1):
        rows = top(told, by, k).select(F.collect_list(F.struct(F.negative(by).alias("o"), "name", line.alias("line"))).alias("x"))
        parts.append(rows.select(F.lit(section).alias("section"), F.posexplode(F.array_sort("x")).alias("pos", "r")).select("section", "pos", F.col("r.line").alias("line")))
    return parts[0].union(parts[1]).union(parts[2])
