"""Daily series: smoothing, calendar windows, features as of a day, forward labels.

A series is a long table (name, date, downloads). Windows are calendar ranges over the integer day, so absent days
count as nothing without a row of their own; as-of days that a series lacks join it as probe rows, and every
frame of one pass shares the partitioning and order by (name, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesforge.functions.columns import norm_slope, variation

SMOOTH, HORIZON, STRIDE, MIN_HISTORY = 28, 70, 3, 84
FEATURES = (
    "log_d7", "log_d28", "velocity", "mom_7v7", "mom_7v28", "trend_slope_28", "volatility_28",
    "log_d56", "log_d84", "mom_28v28", "mom_56v56", "mom_28v56", "trend_slope_56", "trend_slope_84",
)
CANDIDATES = ("recent_share", "trend_slope_7", "dow_volatility_7")


def _by_day() -> WindowSpec:
    return Window.partitionBy("name").orderBy("d")


def latest_wins(history: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """One row per (name, date): the value that arrived last."""
    return history.groupBy("name", "date").agg(F.max_by("downloads", order).alias("downloads"))


def with_day(history: DataFrame) -> DataFrame:
    return history.select("name", F.unix_date("date").alias("d"), F.col("downloads").cast("double").alias("y"))


def smooth_trailing(days: DataFrame, k: int = SMOOTH) -> DataFrame:
    """Mean of the present days among the last k, on present days."""
    return days.withColumn("y", F.avg("y").over(_by_day().rangeBetween(-(k - 1), 0)))


def smooth_centered(days: DataFrame, k: int = SMOOTH) -> DataFrame:
    """Mean of the present days within k//2 days on either side: looks ahead; for ablation only."""
    return days.withColumn("y", F.avg("y").over(_by_day().rangeBetween(-(k // 2), k // 2)))


def calendar_sum(days: int, offset: int = 0, value: str | Column = "y") -> Column:
    """Sum over the ``days`` calendar days that end ``offset`` days before the row's day."""
    return F.coalesce(F.sum(value).over(_by_day().rangeBetween(-(days - 1) - offset, -offset)), F.lit(0.0))


def window_sums() -> dict[str, Column]:
    """Every frame the features and labels need, as columns of one pass."""
    out = {f"s{n}": calendar_sum(n) for n in (7, 28, 56, 84, HORIZON)}
    out |= {f"p{n}": calendar_sum(n, n) for n in (7, 28, 56, HORIZON)}
    out |= {f"dy{n}": calendar_sum(n, 0, F.col("y") * F.col("d")) for n in (7, 28, 56, 84)}
    out |= {f"yy{n}": calendar_sum(n, 0, F.col("y") * F.col("y")) for n in (7, 28)}
    out["f70"] = F.coalesce(F.sum("y").over(_by_day().rangeBetween(1, HORIZON)), F.lit(0.0))
    return out


def feature_columns() -> dict[str, Column]:
    """Features from the columns of ``window_sums`` on a row's day."""
    c = F.col

    def slope(n: int) -> Column:
        return norm_slope(n, c(f"s{n}"), c(f"dy{n}") - (c("d") - (n - 1)) * c(f"s{n}"))

    def over(x: Column, y: Column) -> Column:
        return x / F.greatest(y, F.lit(1.0))

    return {
        "log_d7": F.log1p("s7"), "log_d28": F.log1p("s28"), "velocity": c("s7") / 7,
        "mom_7v7": over(c("s7"), c("p7")), "mom_7v28": over(c("s7"), c("s28") / 4),
        "trend_slope_28": slope(28), "volatility_28": variation(28, c("s28"), c("yy28")),
        "log_d56": F.log1p("s56"), "log_d84": F.log1p("s84"),
        "mom_28v28": over(c("s28"), c("p28")), "mom_56v56": over(c("s56"), c("p56")), "mom_28v56": over(c("s28"), c("s56") / 2),
        "trend_slope_56": slope(56), "trend_slope_84": slope(84),
        "recent_share": over(c("s7"), c("s28")), "trend_slope_7": slope(7), "dow_volatility_7": variation(7, c("s7"), c("yy7")),
    }


def origins(days: DataFrame, stride: int = STRIDE, min_history: int = MIN_HISTORY, horizon: int = HORIZON) -> DataFrame:
    """(name, d): as-of days from the first day + min_history to the last - horizon, every ``stride`` days."""
    span = days.groupBy("name").agg((F.min("d") + min_history).alias("a"), (F.max("d") - horizon).alias("b"))
    return span.filter("a <= b").select("name", F.explode(F.sequence("a", "b", F.lit(stride))).alias("d"))


def _asof(smoothed: DataFrame, at: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Window sums on the given as-of days: probe rows without a value run through the same frames."""
    rows = smoothed.select("name", "d", "y", F.lit(False).alias("probe")).union(at.select("name", "d", F.lit(None).cast("double"), F.lit(True)))
    return rows.select("name", "d", "probe", *[v.alias(k) for k, v in {**window_sums(), **(extra or {})}.items()]).filter("probe")


def training_frame(history: DataFrame) -> DataFrame:
    """Features and 70-day log-growth label at every origin; rows without a week or a base are left out."""
    smoothed = smooth_trailing(with_day(history))
    rows = _asof(smoothed, origins(with_day(history))).filter("s7 > 0 AND s70 > 0")
    label = (F.log1p("f70") - F.log1p("s70")).alias("growth_target_70d")
    return rows.select("name", F.date_from_unix_date("d").alias("feature_date"), *[v.alias(k) for k, v in feature_columns().items()], label)


def scoring_frame(history: DataFrame) -> DataFrame:
    """Features of every name on its last present day (short series count absent days as nothing)."""
    smoothed = smooth_trailing(with_day(history))
    last = Window.partitionBy("name")
    rows = smoothed.withColumn("last", F.max("d").over(last)).select("name", "d", "last", *[v.alias(k) for k, v in window_sums().items() if k != "f70"])
    return rows.filter("d = last AND s7 > 0").select("name", F.date_from_unix_date("d").alias("feature_date"), *[v.alias(k) for k, v in feature_columns().items()])


def validation_frame(history: DataFrame, smoother=smooth_trailing) -> DataFrame:
    """(name, t, features, y, persistence): needs a base and the base before it, and 154 present days."""
    days = with_day(history)
    long = days.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_HISTORY + HORIZON).select("name")
    kept = days.join(long, "name", "left_semi")
    rows = _asof(smoother(kept), origins(kept)).filter("s7 > 0 AND s70 > 0 AND p70 > 0")
    return rows.select(
        "name", F.date_from_unix_date("d").alias("t"), *[v.alias(k) for k, v in feature_columns().items()],
        (F.log1p("f70") - F.log1p("s70")).alias("y"), (F.log1p("s70") - F.log1p("p70")).alias("persistence"),
    )


def clip_target(x: Column | str) -> Column:
    return F.least(F.greatest(F.col(x) if isinstance(x, str) else x, F.lit(-0.9)), F.lit(3.0))


def feature_table(scoring: DataFrame, risk: DataFrame, snapshots: DataFrame, run_id: str) -> DataFrame:
    """The wide feature table of a run: scoring rows with category, label and risk columns where known."""
    labels = risk.select("name", "at_risk_label", "log_stars", "bus_factor", "scorecard_overall")
    snap = snapshots.select("name", "category", F.col("vuln_new_28d").cast("double"), "days_since_last_release")
    return (
        scoring.join(snap, "name", "left").join(labels, "name", "left")
        .select(
            F.lit(run_id).alias("run_id"), "name", "category", "feature_date",
            F.expm1("log_d7").alias("downloads_7d"), F.expm1("log_d28").alias("downloads_28d"), F.col("velocity").alias("download_velocity"),
            F.expm1("log_stars").alias("stars"), "bus_factor", "scorecard_overall", "vuln_new_28d", "days_since_last_release",
            "at_risk_label", F.lit(True).alias("is_scoring_row"),
        )
    )


def standardise(frame: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """z-scores of columns over the whole frame (by=[]), per date, or within each name; 0 for constant groups."""
    stats = frame.groupBy(*by).agg(*[f(c).alias(f"_{k}_{c}") for c in columns for k, f in (("m", F.avg), ("s", F.stddev_pop))])
    joined = frame.join(stats, by) if by else frame.crossJoin(F.broadcast(stats))
    z = {c: F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0) for c in columns}
    return joined.withColumns(z).select(frame.columns)
