"""Cross-sectional risk: features, heuristic and realised labels, the transparent composite score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions.columns import SEVERITY_WEIGHT, clamp, lookup, number, risk_level
from seriesforge.functions.lineage import written
from seriesforge.operators.ranks import quantiles

LOGGED = {
    "log_stars": "stars", "log_forks": "forks", "log_open_issues": "open_issues",
    "log_dependent_repos": "dependent_repos_count", "log_dependent_packages": "dependent_packages_count",
}
PASSED = (
    "bus_factor", "release_cadence_days", "dependency_count", "scorecard_overall",
    "commit_count_4w", "prs_merged_7d", "issues_opened_7d", "rank_average",
)
RISK_FEATURES = (*LOGGED, *PASSED)
#: Component weights of the composite score, in the order in which ties are told; fixed values.
WEIGHTS = {
    "recent vulnerabilities": 0.24,
    "release staleness": 0.20,
    "maintainer key-person risk": 0.18,
    "weak security posture": 0.16,
    "abandoned / removed": 0.12,
    "issue backlog pressure": 0.10,
}


def _zero(x: str) -> Column:
    return F.coalesce(number(x), F.lit(0.0))


def _flagged() -> Column:
    return F.col("archived").eqNullSafe(True) | (F.coalesce(F.col("status"), F.lit("")) != "")


def heuristic_label() -> Column:
    severe = F.coalesce(F.col("max_severity"), F.lit("")).isin("HIGH", "CRITICAL")
    alone = F.coalesce((number("bus_factor") < 0.1) & (_zero("dependent_repos_count") > 1000), F.lit(False))
    return (((_zero("vuln_new_28d") > 0) & severe) | _flagged() | (_zero("days_since_last_release") > 365) | alone).cast("int")


def risk_frame(snapshots: DataFrame) -> DataFrame:
    """(name, category, 13 features, at_risk_label); columns that the snapshots lack count as null."""
    need = {*LOGGED.values(), *PASSED, "max_severity", "vuln_new_28d", "archived", "status", "days_since_last_release"}
    kinds = {"max_severity": "string", "status": "string", "archived": "boolean"}
    full = snapshots.withColumns({c: F.lit(None).cast(kinds.get(c, "double")) for c in need - set(snapshots.columns)} or {"name": F.col("name")})
    logs = [F.log1p(F.greatest(_zero(c), F.lit(0.0))).alias(n) for n, c in LOGGED.items()]
    return full.select("name", "category", *logs, *[number(c).alias(c) for c in PASSED], heuristic_label().alias("at_risk_label"))


def escalated(first: str, last: str) -> Column:
    """Whether things got worse between two snapshot structs."""

    def num(side: str, c: str) -> Column:
        return number(F.col(f"{side}.{c}"))

    def zero(side: str, c: str) -> Column:
        return F.coalesce(num(side, c), F.lit(0.0))

    def removed(side: str) -> Column:
        return F.coalesce(F.col(f"{side}.status"), F.lit("")) != ""

    archived = F.col(f"{last}.archived").eqNullSafe(True) & ~F.col(f"{first}.archived").eqNullSafe(True)
    fell = F.coalesce((num(first, "downloads_7d") != 0) & (num(last, "downloads_7d") < 0.7 * num(first, "downloads_7d")), F.lit(False))
    stale = (zero(last, "days_since_last_release") > 365) & (zero(first, "days_since_last_release") <= 365)
    rose = zero(last, "vuln_count") > zero(first, "vuln_count")
    return (rose | archived | (removed(last) & ~removed(first)) | fell | stale).cast("int")


def forward_frame(history: DataFrame, horizon_days: int = 14) -> DataFrame:
    """Risk features of each name's earliest snapshot with the realised label at its latest, 14 days on or more."""
    row = F.struct(*history.columns)
    order = F.struct("snapshot_date", "run_id")
    ends = history.filter("snapshot_date IS NOT NULL").groupBy("name").agg(F.min_by(row, order).alias("t0"), F.max_by(row, order).alias("tn"))
    far = ends.filter(F.datediff("tn.snapshot_date", "t0.snapshot_date") >= horizon_days)
    told = far.select("t0.*", escalated("t0", "tn").alias("_label"))
    return risk_frame(told.drop("_label")).drop("at_risk_label").join(told.select("name", F.col("_label").alias("at_risk_label")), "name")


def choose_training(heuristic: DataFrame, forward: DataFrame, min_rows: int = 25) -> DataFrame:
    """The realised frame where it has enough rows of both classes, else the heuristic frame; ``label_mode`` tells."""
    ready = forward.agg(((F.count("*") >= min_rows) & (F.count_distinct("at_risk_label") > 1)).alias("ready"))
    parts = [
        frame.crossJoin(F.broadcast(ready)).filter(F.col("ready") == use).drop("ready").withColumn("label_mode", F.lit(mode))
        for frame, use, mode in ((forward, True, "forward"), (heuristic, False, "heuristic"))
    ]
    return parts[0].unionByName(parts[1])


def components() -> dict[str, Column]:
    vulns = F.least(_zero("vuln_new_28d") * 0.5, F.lit(1.0))
    severity = F.coalesce(lookup("max_severity", SEVERITY_WEIGHT), F.lit(0.0))
    stale = number("days_since_last_release")
    issues, merged = _zero("issues_opened_7d"), _zero("prs_merged_7d")
    return {
        "recent vulnerabilities": vulns * (0.5 + severity / 2),
        "release staleness": F.when(stale.isNull(), 0.3).otherwise(clamp((stale - 30) / 335, 0.0, 1.0)),
        "maintainer key-person risk": F.coalesce(1 - number("bus_factor"), F.lit(0.4)),
        "weak security posture": F.coalesce(1 - number("scorecard_overall") / 10, F.lit(0.35)),
        "abandoned / removed": F.when(_flagged(), 1.0).otherwise(0.0),
        "issue backlog pressure": F.when(issues + merged != 0, F.least(issues / F.greatest(issues + merged, F.lit(1.0)), F.lit(1.0))).otherwise(0.3),
    }


def composite_score(snapshots: DataFrame) -> DataFrame:
    """All columns plus ``composite`` (0-100, one decimal) and ``reasons``: the two weightiest components above 0.25."""
    parts = components()
    total = sum((parts[k] * w for k, w in WEIGHTS.items()), F.lit(0.0)) * 100
    told = F.array(*[F.struct((-v * WEIGHTS[k]).alias("w"), F.lit(i).alias("i"), F.lit(k).alias("k"), v.alias("v")) for i, (k, v) in enumerate(parts.items())])
    top = F.slice(F.array_sort(F.filter(told, lambda x: x["v"] > 0.25)), 1, 2)
    return snapshots.withColumn("composite", F.round(total, 1)).withColumn("reasons", F.transform(top, lambda x: x["k"]))


def blend(composite: Column | str, probability: Column | str) -> Column:
    c, p = (F.col(x) if isinstance(x, str) else x for x in (composite, probability))
    return F.when(p.isNull() | F.isnan(p), c).otherwise(F.round(0.6 * c + 0.4 * 100 * p, 1))


def with_level(df: DataFrame, score: str = "risk_score") -> DataFrame:
    return df.withColumn("risk_level", risk_level(score))


def impute_medians(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls become the exact median of their column, 0 where all are null; one row of medians is broadcast. The input is evaluated once."""
    frame = written(frame, "unfilled")
    long = frame.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.*")
    found = quantiles(long, "v", [0.5], ["c"]).select("c", F.get("q", F.lit(0)).alias("m"))
    medians = found.agg(*[F.coalesce(F.max(F.when(F.col("c") == c, F.col("m"))), F.lit(0.0)).alias(f"_m_{c}") for c in columns])
    filled = frame.crossJoin(F.broadcast(medians)).withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in columns})
    return filled.select(frame.columns)
