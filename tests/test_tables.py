"""Tables survive their own upkeep: nothing overwrites, a job that dies is not seen, runs are read alone."""

import datetime as dt
import threading

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter

from seriesforge.sources import tables as T
from seriesforge.sources import versions as V

HISTORY = "name string, date date, downloads bigint"


def _history(spark, *names):
    return spark.createDataFrame([(n, dt.date(2024, 1, 1), k) for k, n in enumerate(names)], HISTORY)


def _names(spark, root, table="download_history"):
    return sorted(r["name"] for r in T.load(spark, root, table).collect())


@pytest.fixture
def root(spark, tmp_path):
    T.create(spark, str(tmp_path / "t"))
    return str(tmp_path / "t")


def test_create_keeps_what_is_there(spark, root, monkeypatch):
    assert all(T.load(spark, root, t).count() == 0 and T.load(spark, root, t).columns == [n for n, _ in T.TABLES[t]] for t in T.TABLES)
    T.append(_history(spark, "a", "b"), root, "download_history")

    def broken(self, *paths, **more):
        raise OSError("unreadable")

    with monkeypatch.context() as m:
        m.setattr(DataFrameReader, "parquet", broken)
        T.create(spark, root)
        with pytest.raises(OSError):
            T.load(spark, root, "download_history")
    T.create(spark, root)
    assert _names(spark, root) == ["a", "b"]


def test_create_raises_where_it_cannot_tell(spark, tmp_path, monkeypatch):
    root = tmp_path / "t"
    (root / "features").mkdir(parents=True)
    (root / "features" / "stray.parquet").write_bytes(b"no parquet")
    with pytest.raises(FileExistsError):
        T.create(spark, str(root))
    assert (root / "features" / "stray.parquet").read_bytes() == b"no parquet"

    def broken(*_):
        raise OSError("unreachable")

    monkeypatch.setattr(V, "entries", broken)
    with pytest.raises(OSError):
        T.create(spark, str(tmp_path / "u"))


def test_a_table_that_is_missing_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        T.load(spark, str(tmp_path), "features")
    with pytest.raises(FileNotFoundError):
        T.append(_history(spark, "a"), str(tmp_path), "download_history")


@pytest.mark.parametrize("step", ["before the data", "after the data", "inside the manifest"])
@pytest.mark.parametrize("change", [T.append, T.reload])
def test_a_change_that_dies_is_not_seen(spark, root, monkeypatch, step, change):
    T.append(_history(spark, "a", "b"), root, "download_history")
    write, publish = DataFrameWriter.parquet, V.publish

    def dies_writing(self, *paths, **more):
        if step == "after the data":
            write(self, *paths, **more)
        raise KeyboardInterrupt

    def dies_publishing(spark, table, version, lines):
        with monkeypatch.context() as cut_off:
            cut_off.setattr(V, "_END", "")
            publish(spark, table, version, lines)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step == "inside the manifest":
            m.setattr(V, "publish", dies_publishing)
        else:
            m.setattr(DataFrameWriter, "parquet", dies_writing)
        with pytest.raises(KeyboardInterrupt):
            change(_history(spark, "c"), root, "download_history")
    assert _names(spark, root) == ["a", "b"]
    change(_history(spark, "c"), root, "download_history")
    assert _names(spark, root) == (["a", "b", "c"] if change is T.append else ["c"])


def test_a_table_is_reloaded_from_itself_while_it_is_read(spark, root):
    T.append(_history(spark, "a", "b"), root, "download_history")
    opened = T.load(spark, root, "download_history")
    T.reload(opened.filter("name = 'b'"), root, "download_history")
    assert _names(spark, root) == ["b"] and opened.count() == 2
    for _ in range(4):
        T.reload(T.load(spark, root, "download_history"), root, "download_history")
    assert _names(spark, root) == ["b"]
    assert len(V.entries(spark, f"{root}/download_history/data")) == 2  # the present version and the one before


def test_two_writers_lose_nothing(spark, root):
    frames = [_history(spark, f"n{k}") for k in range(6)]
    threads = [threading.Thread(target=T.append, args=(f, root, "download_history")) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert _names(spark, root) == [f"n{k}" for k in range(6)]


def test_runs_are_folders_and_one_run_is_read_alone(spark, root):
    kind = "run_id string, predicted_at timestamp, name string, risk_score double"
    for k in range(3):
        day = dt.datetime(2024, 1, 1 + k)
        T.append(spark.createDataFrame([(f"r{k}", day, f"p{i}", float(i)) for i in range(5)] + [(None, day, "none", 1.0)], kind), root, "predictions")
    rows = T.load(spark, root, "predictions")
    assert rows.count() == 18 and rows.filter("run_id = 'r1'").count() == 5 and rows.filter("run_id IS NULL").count() == 3
    latest = T.load_latest(spark, root, "predictions", "predicted_at")
    assert {r["run_id"] for r in latest.collect()} == {"r2"} and latest.count() == 5
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "run_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert T.load_latest(spark, root, "features", "feature_date").count() == 0


def test_a_column_added_later_reads_as_null(spark, root, monkeypatch):
    T.append(_history(spark, "a"), root, "download_history")
    monkeypatch.setitem(T.TABLES, "download_history", [*T.TABLES["download_history"], ("origin", "STRING")])
    T.append(_history(spark, "b").selectExpr("*", "'x' AS origin"), root, "download_history")
    assert sorted((r["name"], r["origin"]) for r in T.load(spark, root, "download_history").collect()) == [("a", None), ("b", "x")]
