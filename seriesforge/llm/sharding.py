"""Sharding by a Feistel permutation with cycle walking over global row numbers. DataFrame functions only.

Rows are numbered 0..N-1 in the order of (id, checksum, size). Equal rows of one input partition are numbered together,
so a key that holds a third of all rows is one row per partition until the numbers are given out. Numbers come from a range partitioning: a written
copy fixes each row's place, the partitions' sums (one row per partition) become offsets. The permutation works on
a grid of a columns and b rows with a*b just above N; numbers that land at N or above walk on. The permuted number
gives shard and slot by division, and the same arithmetic finds them for any row number without the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.textkit import cut

#: Round keys of the permutation; fixed values.
ROUND_KEYS = (374761393, 668265263, 1274126177, 1103515245)
PRIME = 2147483647
#: Steps of the walk. Fewer than a cells lie above N: the walk ends for certain within a steps, and for a of 64 or
#: more a further step is needed with a chance of at most 1/a each.
WALK = 64


def _div(x: Column, y: int) -> Column:
    return F.call_function("div", x, F.lit(y).cast("long"))


def _round(x: Column, key: Column) -> Column:
    """A round function below ``PRIME``: two squarings modulo that prime of 31 bits."""
    t = (x % PRIME + key) % PRIME
    t = (t * t + _div(x, PRIME) % PRIME + key) % PRIME
    return (t * t + t) % PRIME


def grid(n: int) -> tuple[int, int]:
    """(a, b) with a*b >= n and fewer than a cells to spare."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permute(x: Column, n: int, keys: tuple[int, ...] = ROUND_KEYS) -> Column:
    """One pass of the permutation of 0..a*b-1 (no walking)."""
    if len(keys) % 2:
        raise ValueError("the number of rounds is even, so that both halves return to their places")
    a, b = grid(n)
    start = F.struct(_div(x, b).alias("u"), (x % b).alias("v"), F.lit(a).cast("long").alias("m"), F.lit(b).cast("long").alias("w"))

    def one(s: Column, key: Column) -> Column:
        return F.struct(s["v"].alias("u"), ((s["u"] + _round(s["v"], key)) % s["m"]).alias("v"), s["w"].alias("m"), s["m"].alias("w"))

    rounds = F.array(*[F.lit(k).cast("long") for k in keys])
    return F.aggregate(rounds, start, one, lambda s: s["u"] * b + s["v"])


def shuffled(x: Column, n: int, keys: tuple[int, ...] = ROUND_KEYS) -> Column:
    """The place of row number x among n rows: walks while a place is n or above."""
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), x, lambda p, _: F.when(p < n, p).otherwise(permute(p, n, keys)))
    ended = F.coalesce(F.nullif(walk, F.greatest(walk, F.lit(n).cast("long"))), F.raise_error(F.lit("the walk did not end")).cast("long"))
    return F.when(x < n, x).otherwise(ended)


def shard_rows(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", keys: tuple[int, ...] = ROUND_KEYS) -> DataFrame:
    """(id, size, text_crc32, row_number, shard, slot) for every row.

    Shards 0..shards-1 hold counts at most one apart; slots are gapless from 0. ``size``: UTF-8 bytes of the text
    plus 16; null texts have no bytes (and the checksum of none). Null ids come first. Rows alike in id, text
    checksum and size are interchangeable and take consecutive numbers. An empty table gives no rows.
    """
    bare = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    order = ("id", "text_crc32", "size", "origin")
    alike = bare.withColumn("origin", F.spark_partition_id()).groupBy(*order).agg(F.count("*").alias("n"))
    ordered = alike.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(ordered.withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33)))
    parts = placed.groupBy("part").agg(F.sum("n").alias("rows"))
    offsets = parts.withColumn("offset", F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).select("part", "offset")
    total = parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    inside = Window.partitionBy("part").orderBy("place")
    numbered = placed.join(F.broadcast(offsets), "part").withColumn("first", F.col("offset") + F.sum("n").over(inside) - F.col("n"))
    each = numbered.withColumn("row_number", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)))
    once = each.withColumn("once", permute(F.col("row_number"), total, keys))
    put = once.withColumn("to", shuffled(F.col("once"), total, keys))
    return put.select("id", "size", "text_crc32", "row_number", (F.col("to") % shards).cast("int").alias("shard"), _div(F.col("to"), shards).alias("slot"))
