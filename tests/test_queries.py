"""Registered queries against their DuckDB counterparts on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = ["a10_csv_sink", "a13_active_features", "c13_training_frame", "d4_forward_frame", "e8_stratified_folds", "e13_gate_checks", "e13_gate_result", "e14_gate_metric_rows", "e18_calibration_deciles", "e19_scatter_sample", "f7_drift_severity", "g8_audit_verdicts", "h7_run_record", "i12_daily_brief", "j11_cluster_bootstrap", "j12_block_permutation", "j13_row_permutation", "j14_diebold_mariano", "k2_unit_root", "k3_kpss_automatic", "k4_integration", "k5_ljung_box", "k7_arch_lm", "m1_incremental_series"]


def same(a, b):
    """Equal rows in any order; doubles within 1e-5."""
    assert sorted(a.column_names) == sorted(b.column_names)
    columns, sides = sorted(a.column_names), []
    for table in (a, b):
        told = []
        for r in table.select(columns).to_pylist():
            numbers = [v for v in r.values() if isinstance(v, float)]
            told.append((tuple(str(v).removesuffix(" 00:00:00") for v in r.values() if not isinstance(v, float)), numbers))
        sides.append(sorted(told))
    assert [k for k, _ in sides[0]] == [k for k, _ in sides[1]]
    for (_, x), (_, y) in zip(*sides, strict=True):
        assert x == pytest.approx(y, abs=1e-5, nan_ok=True)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = con.execute(entry.oracle_sql()[name]).to_arrow_table()
    same(entry.queries()[name](spark, sf_dir).toArrow(), want)


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_daily_plan(spark, sf_dir):
    from pyspark.sql import functions as F

    from seriesforge.plans import daily
    from seriesforge.plans import fixtures as X

    names = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_name").alias("n"))
    history = X.read(spark, sf_dir, X.history_supplier()).join(names, "name").select(F.col("n").alias("name"), "date", "downloads")
    out = daily.run(history, X.read(spark, sf_dir, X.snapshots()), X.read(spark, sf_dir, X.predictions()), "now", rounds=2)
    told = out["predictions"].collect()
    assert told and all(0 <= r["momentum_score"] <= 100 for r in told)
    assert out["drift"].filter("available").count() == 1
    assert out["gate"].count() == 1


def test_daily_plan_falls_back_to_the_champion(spark, sf_dir, tmp_path, monkeypatch):
    """A run registers its models; a later run whose gate fails scores with the champion's file."""
    from pyspark.sql import functions as F

    from seriesforge.operators import models as M
    from seriesforge.plans import daily
    from seriesforge.plans import fixtures as X

    names = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_name").alias("n"))
    history = X.read(spark, sf_dir, X.history_supplier()).join(names, "name").select(F.col("n").alias("name"), "date", "downloads").cache()
    snapshots, folder = X.read(spark, sf_dir, X.snapshots()), str(tmp_path)
    first = daily.run(history, snapshots, None, "r1", rounds=2, models=folder)
    runs = first["model_runs"].filter("model_name = 'growth'").withColumns({"is_champion": F.lit(True), "metric_value": F.lit(0.9)}).cache()
    assert first["serving"].first()["serve"] == "candidate" and M.load_champion(runs, "growth") is not None
    monkeypatch.setattr(M, "gate_result", lambda checks, keys: checks.select("model_name", F.lit(False).alias("passed"), F.lit(False).alias("skipped"), F.lit("x").alias("reasons")).distinct())
    used = []
    monkeypatch.setattr(M, "load_model", lambda name, uri, load=M.load_model: used.append(uri) or load(name, uri))
    second = daily.run(history, snapshots, None, "r2", rounds=3, model_runs=runs, models=folder)
    assert used == [f"{folder}/growth-r1"] and second["serving"].first()["serve"] == used[0]
    told = second["model_runs"].filter("model_name = 'growth'").first()
    assert not told["is_champion"] and told["note"].startswith("BLOCKED by validation gate (") and told["gcs_uri"].endswith("growth-r2")
    key = ["name", "growth_pred_70d"]
    assert second["predictions"].select(key).exceptAll(first["predictions"].select(key)).count() == 0
