"""Incremental upkeep of the daily series: newly landed payload files merge into the table, latest value wins.

The table is a set of buckets by the low bits of the name's hash. A bucket of ``depth`` bits that a batch would take past
``bucket_rows`` rows is split into buckets of one more bit (and again, as long as needed) while it is written anyway, so
buckets keep their size as the table grows, and a batch rewrites only what holds its names. A manifest names every
bucket of the table with the version that holds it and its rows; it is written last, so readers see either the table
before the batch or the one after it, and nothing that a manifest names is ever written again. A batch that failed anywhere is run again on the same
base; one that had already switched merges its own rows once more, which changes nothing.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.sources import versions as V
from seriesforge.sources.payloads import daily_series

#: Rows that a bucket may hold before it splits; bits of a new table's buckets, and the most that a bucket can have.
BUCKET_ROWS, FIRST_DEPTH, MOST_DEPTH = 2_000_000, 2, 48
SCHEMA = "bucket bigint, name string, date date, downloads bigint, fetched_at bigint"
_COLUMNS = ("bucket", "name", "date", "downloads", "fetched_at")


class Held(NamedTuple):
    """Where a bucket lies: the version that wrote it (-1: it holds nothing yet), and its rows."""

    version: int
    rows: int


def bucket_id(depth: int, bits: int) -> int:
    """A bucket's number: a one, then its bits."""
    return 1 << depth | bits


def bucket_of(hashed: Column, buckets: list[int], spark: SparkSession) -> tuple[Column, DataFrame]:
    """Candidates of a row (one per depth in use) and the table (a row per bucket, broadcast) that knows the right one."""
    depths = sorted({b.bit_length() - 1 for b in buckets})
    at = F.array(*[F.lit(1 << d).cast("long").bitwiseOR(hashed.bitwiseAND(F.lit((1 << d) - 1).cast("long"))) for d in depths])
    return at, F.broadcast(spark.createDataFrame([(b,) for b in buckets], "bucket bigint"))


def merge(table: DataFrame | None, batch: DataFrame) -> DataFrame:
    """One row per (name, date): the one that was fetched last."""
    rows = batch if table is None else table.unionByName(batch)
    last = F.max_by(F.struct("downloads", "fetched_at"), F.struct("fetched_at", "downloads"))
    merged = rows.groupBy("bucket", "name", "date").agg(last.alias("x"))
    return merged.select("bucket", "name", "date", "x.downloads", "x.fetched_at")


def normalise(payloads: DataFrame) -> DataFrame:
    """(name, date, downloads, fetched_at) of a payload table (name, payload, fetched_at)."""
    keyed = payloads.select(F.struct("name", "fetched_at").alias("name"), "payload")
    return daily_series(keyed).select("name.name", "name.fetched_at", "date", "downloads")


def in_buckets(rows: DataFrame, buckets: list[int]) -> DataFrame:
    """Rows with the one bucket, of those that make up the table, that their name belongs to."""
    at, table = bucket_of(F.xxhash64("name"), buckets, rows.sparkSession)
    return rows.drop("bucket").withColumn("bucket", F.explode(at)).join(table, "bucket").select(*_COLUMNS)


def _manifest(lines: list[str]) -> dict[int, Held]:
    return {int(b): Held(int(v), int(n)) for b, v, n in (line.split() for line in lines)}


def _current(spark: SparkSession, table: str) -> dict[int, Held]:
    found = V.current(spark, table)
    return _manifest(found[1]) if found else {bucket_id(FIRST_DEPTH, b): Held(-1, 0) for b in range(1 << FIRST_DEPTH)}


def _read(spark: SparkSession, table: str, held: dict[int, Held]) -> DataFrame | None:
    parts = []
    for v in sorted({h.version for h in held.values()} - {-1}):
        folders = [f"{table}/data/{v}/bucket={b}" for b, h in held.items() if h.version == v]
        parts.append(spark.read.schema(SCHEMA).option("basePath", f"{table}/data/{v}").parquet(*folders).select(*_COLUMNS))
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_series(spark: SparkSession, table: str) -> DataFrame:
    """The current table; empty if nothing has landed yet."""
    rows = _read(spark, table, _current(spark, table))
    return rows if rows is not None else spark.createDataFrame([], SCHEMA)


def children(bucket: int, rows: int, bucket_rows: int) -> list[int]:
    """The buckets that take over from one which may get ``rows`` rows; itself, if it can hold them."""
    depth = bucket.bit_length() - 1
    more = min(max(0, -(-rows // bucket_rows) - 1).bit_length(), MOST_DEPTH - depth)
    bits = bucket - (1 << depth)
    return [bucket_id(depth + more, k << depth | bits) for k in range(1 << more)]


def take(batch: DataFrame, table: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Merge one batch of payloads into the table; only buckets with news are written."""
    spark = batch.sparkSession
    held, new = _current(spark, table), V.following(spark, table)
    landed = f"{table}/batches/{new}"
    in_buckets(normalise(batch), list(held)).write.mode("overwrite").parquet(landed)  # parsed once
    rows = spark.read.schema(SCHEMA).parquet(landed)
    # one row per bucket with news
    news = {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    if news:
        target = {b: children(b, held[b].rows + n, bucket_rows) for b, n in news.items()}
        leaves = [c for cs in target.values() for c in cs]
        merged = in_buckets(merge(_read(spark, table, {b: held[b] for b in news}), rows), leaves)
        spread = merged.repartition(min(len(leaves), 10_000), "bucket")
        spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/data/{new}")
        made = spark.read.schema(SCHEMA).parquet(f"{table}/data/{new}").groupBy("bucket").agg(F.count("*").alias("n"))
        wrote = {r["bucket"]: r["n"] for r in made.collect()}
        after = {b: h for b, h in held.items() if b not in news} | {c: Held(new if wrote.get(c) else -1, wrote.get(c, 0)) for c in leaves}
        V.publish(spark, table, new, [f"{b} {h.version} {h.rows}" for b, h in sorted(after.items())])
        V.forget(spark, table, lambda lines: {str(h.version) for h in _manifest(lines).values()} - {"-1"})
    V.remove(spark, landed)


def upkeep(spark: SparkSession, landing: str, table: str, state: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Take in every file that landed since the last call."""
    stream = spark.readStream.schema("name string, payload string, fetched_at bigint").parquet(landing)
    writer = stream.writeStream.foreachBatch(lambda batch, _: take(batch, table, bucket_rows))
    writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
