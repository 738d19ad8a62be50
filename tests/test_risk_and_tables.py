import datetime as dt

from pyspark.sql import functions as F

from seriesforge.operators import audit as G
from seriesforge.operators import risk as R
from seriesforge.operators import scoring as C
from seriesforge.sources import tables as T

SNAP = ("name string, category string, stars bigint, bus_factor double, vuln_new_28d bigint, max_severity string, archived boolean, status string,"
        " days_since_last_release double, scorecard_overall double, issues_opened_7d bigint, prs_merged_7d bigint, dependent_repos_count bigint")  # fmt: skip


def test_null_snapshots_get_priors_and_no_label(spark):
    rows = [("nulls", "x", *[None] * 11), ("bad", "x", 5, 0.0, 3, "CRITICAL", True, None, 900.0, 0.0, 9, 0, 5000), ("good", "x", 5, 1.0, 0, None, False, None, 3.0, 10.0, 0, 5, 1)]
    df = spark.createDataFrame(rows, SNAP)
    score = {r["name"]: r["composite"] for r in R.composite_score(df).collect()}
    assert score["good"] < score["nulls"] < score["bad"] == 100.0
    label = {r["name"]: r["at_risk_label"] for r in R.risk_frame(df).collect()}
    assert label == {"nulls": 0, "bad": 1, "good": 0}


def test_forward_labels_need_the_horizon(spark):
    kind = "run_id string, snapshot_date date, name string, category string, vuln_count bigint, archived boolean, status string, downloads_7d bigint, days_since_last_release double"
    day = dt.date(2024, 1, 1)

    def history(days):
        rows = []
        for i in range(30):
            rows += [("1", day, f"p{i}", "x", 1, False, None, 100, 1.0), ("2", day + dt.timedelta(days), f"p{i}", "x", 4 if i < 10 else 1, False, None, 100, 1.0)]
        return spark.createDataFrame(rows, kind)

    assert R.forward_frame(history(20)).agg(F.sum("at_risk_label")).first()[0] == 10
    assert R.forward_frame(history(5)).count() == 0


def test_drift_of_equal_and_shifted_runs(spark):
    def run(run_id, score, label, day):
        return [(run_id, dt.datetime(2024, 1, day), f"p{i}", score + i % 3, score + i % 3, label, label) for i in range(40)]

    kind = "run_id string, predicted_at timestamp, name string, momentum_score double, risk_score double, momentum_label string, risk_level string"
    df = spark.createDataFrame(run("a", 50.0, "normal", 1) + run("b", 50.0, "normal", 2) + run("c", 85.0, "high", 3), kind)
    got = {r["curr_run"]: r for r in C.drift_report(df).collect()}
    assert not got["a"]["available"] and got["a"]["severity"] == "none"
    assert got["b"]["momentum_score_psi"] == 0.0 and got["b"]["severity"] == "low"
    assert got["c"]["label_churn"] == 1.0 and got["c"]["severity"] == "high"


def test_rows_conform_append_reload_and_evolve(spark, tmp_path):
    root = str(tmp_path / "tables")
    T.create(spark, root)
    df = spark.createDataFrame([("a", "2024-01-02", float("nan"), 1), ("b", "soon", 3.7, 2)], "name string, date string, downloads double, extra int")
    T.append(df, root, "download_history")
    T.append(df, root, "download_history")
    rows = T.load(spark, root, "download_history").orderBy("name").collect()
    assert len(rows) == 4 and rows[0]["date"] == dt.date(2024, 1, 2) and rows[0]["downloads"] is None and rows[2]["date"] is None and rows[2]["downloads"] == 3
    T.reload(df, root, "download_history")
    assert T.load(spark, root, "download_history").count() == 2
    nested = spark.createDataFrame([("r", {"a": True})], "run_id string, source_status map<string,boolean>")
    assert T.conform(nested, "snapshots").first()["source_status"] == '{"a":true}'


def test_requirement_lines(spark):
    text = "# c\nDjango_X==4.2 ; python_version < '4'\n-r base.txt\nreq[extra]>=1 # why\ngit+https://x/y\n\ndjango-x==9\n"
    got = {(r["name"], r["version"]) for r in G.parse_requirements(spark.createDataFrame([("d", text)], "doc string, text string")).collect()}
    assert got == {("django-x", "4.2"), ("req", None)}


def test_empty_inputs_give_empty_results(spark):
    empty = spark.createDataFrame([], SNAP)
    assert R.risk_frame(empty).count() == 0
    assert R.composite_score(empty).count() == 0
    assert G.parse_requirements(spark.createDataFrame([], "doc string, text string")).count() == 0


def test_csv_and_json_sinks_and_the_run_record(spark, tmp_path):
    import json

    from seriesforge.operators import quality as Q
    from seriesforge.sources import tables as T

    df = spark.createDataFrame([(1, 1.5, "a"), (2, float("nan"), None), (3, float("inf"), "c,d")], "id int, v double, s string")
    T.write_csv(df, str(tmp_path / "c"))
    assert sorted(r["s"] or "" for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()) == ["", "a", "c,d"]
    T.write_json(df, str(tmp_path / "j"))
    assert {r["id"]: r["v"] for r in spark.read.json(str(tmp_path / "j")).collect()} == {1: 1.5, 2: None, 3: None}
    assert T.active_features(["a", "z"], ["a", "b"], ["d"], "b") == ["a", "b"] and T.active_features(["z"], ["a"], ["d"]) == ["d"]
    row = Q.run_record(spark.createDataFrame([(5, 2)], "rows int, failures int"), "r1", {"ingest": 1.5}).first()
    assert row["status"] == "success" and json.loads(row["counts"]) == {"rows": 5, "failures": 2} and json.loads(row["stages"]) == {"ingest": 1.5}
