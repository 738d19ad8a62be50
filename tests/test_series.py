import datetime as dt
import math

from pyspark.sql import functions as F

from seriesforge.operators import series as S


def _history(spark, n=220, skip=()):
    day = dt.date(2024, 1, 1)
    rows = [("p", day + dt.timedelta(i), int(1000 * 1.01**i)) for i in range(n) if i not in skip]
    return spark.createDataFrame(rows, "name string, date date, downloads bigint")


def test_growing_series_has_positive_labels(spark):
    rows = S.training_frame(_history(spark)).collect()
    assert len(rows) == len(range(84, 219 - 70 + 1, 3))
    assert all(r["growth_target_70d"] > 0 and r["trend_slope_28"] > 0 and r["mom_28v28"] > 1 for r in rows)


def test_features_match_a_day_by_day_computation(spark):
    skip = {5, 6, 50, 101, 102, 103}
    h = _history(spark, 200, skip)
    got = {r["feature_date"]: r for r in S.training_frame(h).collect()}
    days = {r["date"]: float(r["downloads"]) for r in h.collect()}
    smooth = {d: sum(v := [days[d - dt.timedelta(o)] for o in range(28) if d - dt.timedelta(o) in days]) / len(v) for d in days}
    first = min(days)
    asof = first + dt.timedelta(84 + 15)

    def window(n, offset=0):
        return [smooth.get(asof - dt.timedelta(offset + i), 0.0) for i in range(n)][::-1]

    r = got[asof]
    y = window(28)
    mean = sum(y) / 28
    slope = sum((i - 13.5) * v for i, v in enumerate(y)) / sum((i - 13.5) ** 2 for i in range(28)) / mean
    assert abs(r["trend_slope_28"] - slope) < 1e-9
    assert abs(r["volatility_28"] - math.sqrt(sum((v - mean) ** 2 for v in y) / 28) / mean) < 1e-9
    assert abs(r["mom_7v7"] - sum(window(7)) / sum(window(7, 7))) < 1e-12
    ahead = sum(smooth.get(asof + dt.timedelta(i), 0.0) for i in range(1, 71))
    assert abs(r["growth_target_70d"] - (math.log1p(ahead) - math.log1p(sum(window(70))))) < 1e-9


def test_scoring_has_one_row_per_name_even_for_short_series(spark):
    h = _history(spark, 12)
    assert S.scoring_frame(h).count() == 1


def test_features_never_look_ahead(spark):
    h = _history(spark)
    cut = dt.date(2024, 1, 1) + dt.timedelta(100)
    later = h.withColumn("downloads", F.when(F.col("date") > F.lit(cut), F.col("downloads") * 9).otherwise(F.col("downloads")))
    names = list(S.FEATURES)
    a, b = (S.training_frame(x).filter(F.col("feature_date") <= F.lit(cut)).select("feature_date", *names).collect() for x in (h, later))
    assert sorted(a) == sorted(b)


def test_latest_value_wins(spark):
    rows = [("a", "2024-01-01", 1, 1), ("a", "2024-01-01", 9, 2), ("a", "2024-01-02", 3, 1)]
    df = spark.createDataFrame(rows, "name string, date string, downloads int, ingest_seq int")
    assert {(r["date"], r["downloads"]) for r in S.latest_wins(df).collect()} == {("2024-01-01", 9), ("2024-01-02", 3)}
