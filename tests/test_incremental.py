"""Incremental upkeep: no batch is lost, whatever fails in between."""

import json

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter

from seriesforge.streaming import incremental as I


def _payload(spark, name, days, fetched):
    data = [{"category": "without_mirrors", "date": d, "downloads": n} for d, n in days]
    return spark.createDataFrame([(name, json.dumps({"data": data}), fetched)], "name string, payload string, fetched_at bigint")


def _rows(spark, table):
    return sorted((r["name"], str(r["date"]), r["downloads"]) for r in I.read_series(spark, table).collect())


def test_batches_merge_and_untouched_buckets_stay(spark, tmp_path):
    table = str(tmp_path / "t")
    assert _rows(spark, table) == []
    for k in range(24):
        I.take(_payload(spark, f"p{k % 12}", [(f"2024-01-{1 + k // 12:02}", k)], k), table)
        if k == 1:
            held = I._current(spark, table)
            assert len(held) == 1 << I.FIRST_DEPTH and {h.version for h in held.values()} >= {-1, 1}
    assert _rows(spark, table) == sorted((f"p{k % 12}", f"2024-01-{1 + k // 12:02}", k) for k in range(24))
    I.take(_payload(spark, "p0", [("2024-01-01", 99)], 50), table)
    I.take(_payload(spark, "p0", [("2024-01-01", 98)], 49), table)  # late, and older
    assert ("p0", "2024-01-01", 99) in _rows(spark, table)


def _many(spark, names, day, n, fetched):
    data = json.dumps({"data": [{"category": "without_mirrors", "date": day, "downloads": n}]})
    return spark.createDataFrame([(name, data, fetched) for name in names], "name string, payload string, fetched_at bigint")


def test_buckets_split_as_the_table_grows(spark, tmp_path):
    table, size = str(tmp_path / "t"), 40
    I.take(_many(spark, ["a", "b", "c"], "2024-01-01", 1, 1), table, size)
    names = [f"p{k}" for k in range(3000)]
    for k in range(0, 3000, 1000):
        I.take(_many(spark, names[k : k + 1000], "2024-01-01", 2, 2), table, size)
    held = I._current(spark, table)
    assert sum(h.rows for h in held.values()) == 3003 and max(h.rows for h in held.values()) <= size
    # the buckets are a partition of all hashes: every pattern of bits belongs to exactly one
    assert sum(2.0 ** -(b.bit_length() - 1) for b in held) == 1.0
    assert len(_rows(spark, table)) == 3003
    # 30 further names: what is written again is about 30 buckets' share
    before = I.V.current(spark, table)[0]
    I.take(_many(spark, [f"q{k}" for k in range(30)], "2024-01-01", 3, 3), table, size)
    after = I._current(spark, table)
    rewritten = sum(h.rows for h in after.values() if h.version > before)
    assert rewritten <= 30 * size and rewritten < 0.45 * 3033
    assert _rows(spark, table) == sorted([(n, "2024-01-01", 1) for n in "abc"] + [(n, "2024-01-01", 2) for n in names] + [(f"q{k}", "2024-01-01", 3) for k in range(30)])
    # one name's batch rewrites one bucket, however large the table
    before = I.V.current(spark, table)[0]
    I.take(_many(spark, ["p7"], "2024-01-01", 9, 9), table, size)
    assert sum(h.version > before for h in I._current(spark, table).values()) <= 2
    assert ("p7", "2024-01-01", 9) in _rows(spark, table)


def test_one_name_larger_than_a_bucket_stops_splitting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "MOST_DEPTH", 5)
    table = str(tmp_path / "t")
    days = [(f"2024-{1 + k // 28:02}-{1 + k % 28:02}", k) for k in range(200)]
    for k in range(2):
        I.take(_payload(spark, "a", days, k), table, 10)
    held = I._current(spark, table)
    assert sum(h.rows for h in held.values()) == 200 and max(b.bit_length() for b in held) == 6
    assert len(_rows(spark, table)) == 200


def test_children_share_their_parents_bits():
    assert I.children(I.bucket_id(2, 3), 100, 100) == [I.bucket_id(2, 3)]
    assert I.children(I.bucket_id(2, 3), 101, 100) == [I.bucket_id(3, 3), I.bucket_id(3, 7)]
    assert sorted(I.children(I.bucket_id(0, 0), 350, 100)) == [4, 5, 6, 7]


def test_a_broken_read_raises_and_loses_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    I.take(_payload(spark, "a", [("2024-01-01", 1)], 1), table)
    before, second = _rows(spark, table), _payload(spark, "a", [("2024-01-02", 2)], 2)

    def broken(self, *paths, **more):
        raise OSError("unreadable")

    with monkeypatch.context() as m:
        m.setattr(DataFrameReader, "parquet", broken)
        with pytest.raises(OSError):
            I.take(second, table)
    assert _rows(spark, table) == before
    I.take(second, table)
    assert _rows(spark, table) == [("a", "2024-01-01", 1), ("a", "2024-01-02", 2)]


@pytest.mark.parametrize("fails", ["landing", "data", "manifest"])
def test_a_batch_that_dies_before_the_switch_is_run_again(spark, tmp_path, monkeypatch, fails):
    """Killed after its rows are parsed, after its buckets are written, or before its manifest is."""
    table = str(tmp_path / "t")
    I.take(_payload(spark, "a", [("2024-01-01", 1)], 1), table)
    second, write = _payload(spark, "a", [("2024-01-02", 2)], 2), DataFrameWriter.parquet

    def dies(self, path, **more):
        write(self, path, **more)
        if ("/batches/" in path) == (fails == "landing"):
            raise KeyboardInterrupt

    def never(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if fails == "manifest":
            m.setattr(I.V, "publish", never)
        else:
            m.setattr(DataFrameWriter, "parquet", dies)
        with pytest.raises(KeyboardInterrupt):
            I.take(second, table)
    assert _rows(spark, table) == [("a", "2024-01-01", 1)]
    for _ in range(2):  # the run again, and once more after the switch
        I.take(second, table)
        assert _rows(spark, table) == [("a", "2024-01-01", 1), ("a", "2024-01-02", 2)]
