"""The whole reports on small tables."""

from pyspark.sql import functions as F

from seriesforge.plans import reports
from seriesforge.plans.series_queries import brand


def test_validation_report(spark, sf_dir):
    out = reports.validation_report(brand(spark, sf_dir), ["log_d28", "mom_28v28"], rounds=2, replicates=20)
    row = out["metrics"].first()
    assert row["n"] > 0 and out["by_origin"].agg(F.sum("n")).first()[0] == row["n"]
    assert {r["metric"] for r in out["intervals"].collect()} <= {"r2", "skill", "spearman"}  # few distinct targets give none
    assert out["unseen_names"].first()["n"] > row["n"]


def test_audit_run(spark):
    files = spark.createDataFrame([
        ("a", "main", "requirements.txt", "Left_Pad==1.0\nother>=2\n"), ("a", "main", "old.txt", "ignored==9\n"),
        ("b", "main", "pyproject.toml", '[project]\ndependencies = [\n  "left-pad==2.0",\n]\n'),
    ], "doc string, branch string, path string, text string")
    ranks = spark.createDataFrame([("main", "requirements.txt", 1), ("main", "pyproject.toml", 2), ("main", "old.txt", 3)], "branch string, path string, rank int")
    advisories = spark.createDataFrame([("left-pad", ["1.0"], 4)], "name string, affected_versions array<string>, severity_rank int")
    known = spark.createDataFrame([("Left_Pad", None, 10.0, False, 5.0)], "name string, stored_risk double, composite double, archived boolean, days_since_last_release double")
    history = spark.createDataFrame([], "name string, date date, downloads bigint")
    out = reports.audit_run(files, ranks, advisories, known, history)
    told = [(r["doc"], r["name"], r["verdict"]) for r in out["verdicts"].collect()]
    assert told == [("a", "left-pad", "critical"), ("b", "left-pad", "healthy"), ("a", "other", "unknown")]
    assert {r["doc"]: r["audited"] for r in out["summary"].collect()} == {"a": 2, "b": 1}


def test_forecast_report(spark, sf_dir):
    out = reports.forecast_report(brand(spark, sf_dir))
    assert out["summary"].count() == 3 and out["strength"].count() == out["ljung_box"].count() > 0
