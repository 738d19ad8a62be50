"""Exact order statistics without a task that holds a value, a group or the whole table: places, ranks, quantiles, lags.

Places: the input is written once (slim), cut into ranges at tuples of (group, value, a tie key) and sorted inside them; a
written copy fixes each row's range and index. One row for each range and group carries the rows before it, so a value
or group that holds half of all rows is spread over as many ranges as it fills.

Quantiles: groups of at most ``SMALL`` rows are sorted in their task. In larger ones the ranks wanted are enclosed by
histograms: a pass counts the values of every open interval by ``BINS`` bins, for all groups and ranks together, and keeps the
bin that holds the rank, until it holds at most ``SMALL`` rows or one value. A task sends a row per group, interval and bin.

Lags: rows are dealt to chunks of ``CHUNK`` consecutive places, and to the chunks that lie within the lag after them, so
a row is copied into its own chunk and, near a chunk's end, the next. Inside a chunk lagged products are array products.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.lineage import written

SMALL, BINS, CHUNK = 10_000, 512, 16_384


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[f"_b{c}"]) for c in columns])


def _matched(a: DataFrame, b: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """``a`` with the further columns of ``b`` of the row that is equal (nulls too) in ``columns``."""
    renamed = b.withColumnsRenamed({c: f"_b{c}" for c in columns})
    return a.join(renamed, _same(a, renamed, columns), how).drop(*[f"_b{c}" for c in columns])


def placed(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All columns plus ``_part`` and ``_i``: range and index of each row in the order of (by, order); a written table."""
    base = written(df, "slim").withColumn("_tie", F.monotonically_increasing_id())
    keys = [*by, *order, "_tie"]
    ranged = base.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    part, index = F.shiftright("_place", 33).cast("int"), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return written(ranged.select(*df.columns, part.alias("_part"), index.alias("_i")), "placed")


def _starts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., _part, _shift): what to add to a row's index for its number from 0 in its group."""
    each = rows.groupBy(*by, "_part").agg(F.count("*").alias("_k"), F.min("_i").alias("_m"))
    before = F.sum("_k").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_k")
    return each.select(*by, "_part", (before - F.col("_m")).alias("_shift"))


def positions(df: DataFrame, order: Sequence[str], out: str = "pos", by: Sequence[str] | None = None) -> DataFrame:
    """All columns plus the row number (from 1) in the given order, in all or within groups (nulls first; null groups are one)."""
    by = list(by or [])
    rows = placed(df, order, by)
    told = _matched(rows, _starts(rows, by), [*by, "_part"])
    return told.withColumn(out, F.col("_i") + F.col("_shift") + 1).select(*[c for c in df.columns if c != out], out)


def cumulative(df: DataFrame, column: str, amounts: Sequence[str]) -> DataFrame:
    """All columns plus ``cum_x`` per amount: its sum over rows with a smaller ``column`` (ties must be summed before)."""
    rows = placed(df, [column])
    totals = rows.groupBy("_part").agg(*[F.sum(a).alias(f"_t{a}") for a in amounts])
    over, inside = Window.orderBy("_part"), Window.partitionBy("_part").orderBy("_i")
    offsets = totals.select("_part", *[(F.sum(f"_t{a}").over(over) - F.col(f"_t{a}")).alias(f"_o{a}") for a in amounts])
    told = rows.join(F.broadcast(offsets), "_part")  # one row per range
    sums = {f"cum_{a}": F.sum(a).over(inside) - F.col(a) + F.col(f"_o{a}") for a in amounts}
    return told.withColumns(sums).select(*df.columns, *sums)


def average_ranks(df: DataFrame, column: str, out: str, by: Sequence[str] | None = None) -> DataFrame:
    """All columns plus the average rank (from 1, ties share) of ``column``, in all or within groups. Rows without a value are left out."""
    by = list(by or [])
    rows = placed(df.filter(F.col(column).isNotNull()), [column], by)
    # runs of equal values: one row per range and value, so a value in many ranges has one row in each
    runs = rows.groupBy(*by, "_part", column).agg(F.count("*").alias("_n"), F.min("_i").alias("_m"))
    runs = _matched(runs, _starts(rows, by), [*by, "_part"])
    alike = Window.partitionBy(*by, column)
    rank = F.min(F.col("_m") + F.col("_shift")).over(alike) + (F.sum("_n").over(alike) + 1) / 2
    told = _matched(rows, runs.select(*by, "_part", column, rank.alias("_rank")), [*by, "_part", column])
    return told.withColumn(out, F.col("_rank")).select(*[c for c in df.columns if c != out], out)


def _magnitude(v: Column) -> Column:
    """Rises with v and by one for every factor of e, on both sides of zero."""
    return F.signum(v) * (F.coalesce(F.log(F.nullif(F.abs(v), F.lit(0.0))), F.lit(-745.0)) + 745)


def quantiles(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str] | None = None, small: int = SMALL) -> DataFrame:
    """(by..., n, q): exact quantiles of the non-null values, linear between neighbours; no row for groups without values."""
    # groups under names of their own: a caller's column may be called as one of the columns below
    back = {f"_by{i}": c for i, c in enumerate(by or [])}
    slim = df.filter(F.col(value).isNotNull()).select(*[F.col(c).alias(k) for k, c in back.items()], F.col(value).cast("double").alias("v"))
    return _quantiles(written(slim, "values"), ps, list(back), small).withColumnsRenamed(back)


def _quantiles(rows: DataFrame, ps: Sequence[float], by: list[str], small: int) -> DataFrame:
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).filter("n > 0")
    plain = F.percentile("v", F.array(*[F.lit(float(p)) for p in ps]))
    most = sizes.agg(F.max("n")).first()[0] or 0
    if most <= small:
        return rows.groupBy(*by).agg(F.count("*").alias("n"), plain.alias("q")).filter("n > 0")
    sizes = written(sizes, "sizes")
    large = sizes.filter(F.col("n") > small)
    # a wanted rank lies in an open interval [lo, hi] that has ``before`` values below it and holds ``held``
    h = [F.lit(float(p)) * (F.col("n") - 1) for p in ps]
    ranks = F.array_distinct(F.array(*[g(x).cast("long") for x in h for g in (F.floor, F.ceil)]))
    state = written(large.select(*by, F.explode(ranks).alias("k"), "lo", "hi", F.lit(0).cast("long").alias("before"), F.col("n").alias("held")), "ranks")
    span = ["lo", "hi", "before"]
    while (open_now := state.filter((F.col("lo") < F.col("hi")) & (F.col("held") > small))).limit(1).count():
        asked = open_now.select(*by, *span).distinct()
        inside = _matched(rows, asked, by) if by else rows.crossJoin(F.broadcast(asked))
        inside = inside.filter(F.col("v").between(F.col("lo"), F.col("hi")))
        # an interval over several magnitudes is cut by logarithms, so that a few passes reach any double
        wide = (F.col("lo") <= 0) & (F.col("hi") >= 0) | (F.abs("hi") > 1000 * F.abs("lo")) | (F.abs("lo") > 1000 * F.abs("hi"))
        v, lo, hi = (F.when(wide, _magnitude(F.col(c))).otherwise(F.col(c)) for c in ("v", "lo", "hi"))
        # halves, so that the width cannot overflow
        share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
        bins = inside.withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1))).groupBy(*by, *span, "bin").agg(F.count("*").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        below = F.sum("c").over(Window.partitionBy(*by, *span).orderBy("bin")) - F.col("c") + F.col("before")
        cells = bins.select(*by, *span, "c", "least", "most", below.alias("under"))
        kept = _matched(open_now, cells, [*by, *span]).filter((F.col("k") >= F.col("under")) & (F.col("k") < F.col("under") + F.col("c")))
        narrowed = kept.select(*by, "k", F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("under").alias("before"), F.col("c").alias("held"))
        state = written(state.filter((F.col("lo") >= F.col("hi")) | (F.col("held") <= small)).unionByName(narrowed), "ranks")
    some = state.filter("lo < hi").select(*by, *span).distinct()
    inside = (_matched(rows, some, by) if by else rows.crossJoin(F.broadcast(some))).filter(F.col("v").between(F.col("lo"), F.col("hi")))
    lists = inside.groupBy(*by, *span).agg(F.sort_array(F.collect_list("v")).alias("vs"))  # at most ``small`` values each
    found = _matched(state, lists, [*by, *span], "left").select(*by, "k", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.get("vs", (F.col("k") - F.col("before")).cast("int"))).alias("x"))
    at = _matched(large.select(*by, "n"), found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("at")), by) if by else large.select("n").crossJoin(found.agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("at")))

    def between(p: Column) -> Column:
        low, high = (F.element_at("at", g(p).cast("long")) for g in (F.floor, F.ceil))
        share = p - F.floor(p)
        return F.when(share == 0, low).otherwise((1 - share) * low + share * high)

    told = at.select(*by, "n", F.array(*[between(x) for x in h]).alias("q"))
    few = sizes.filter(F.col("n") <= small).select(*by)
    rest = (_matched(rows, few, by, "left_semi") if by else rows.limit(0)).groupBy(*by).agg(F.count("*").alias("n"), plain.alias("q")).filter("n > 0")
    return told.unionByName(rest)


def lagged_products(rows: DataFrame, by: Sequence[str] = (), place: str = "pos", value: str = "c", lags: str = "lags", chunk: int = CHUNK) -> DataFrame:
    """(by..., lag, p): sums of value(place) * value(place - lag) for lag 0 to the group's ``lags``; places follow each other without gaps."""
    at = F.col(place).cast("long")
    chunks = F.sequence(F.call_function("div", at, F.lit(chunk).cast("long")), F.call_function("div", at + F.col(lags), F.lit(chunk).cast("long")))
    spread = rows.select(*by, at.alias("_at"), F.col(value).cast("double").alias("_c"), F.col(lags).cast("int").alias("_lags"), F.explode(chunks).alias("_chunk"))
    kinds = dict(rows.dtypes)
    schema = spread.limit(0).select(*by)

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        at, order = t["_at"].to_numpy(), np.argsort(t["_at"].to_numpy())
        c, at, top = t["_c"].to_numpy()[order], at[order], int(t["_lags"][0].as_py())
        first = int(np.searchsorted(at, key[len(by)].as_py() * chunk))  # rows of its own
        own, sums = c[first:], []
        for lag in range(top + 1):
            skip = max(0, lag - first)
            sums.append(float(own[skip:] @ c[first + skip - lag : len(c) - lag]) if skip < len(own) else 0.0)
        n = len(sums)
        return pa.table({**{b: pa.array([key[k].as_py()] * n, t.schema.field(b).type) for k, b in enumerate(by)}, "lag": pa.array(range(n), pa.int32()), "p": pa.array(sums)})

    ddl = ", ".join([*[f"`{b}` {kinds[b]}" for b in schema.columns], "lag int", "p double"])
    return spread.groupBy(*by, "_chunk").applyInArrow(run, ddl).groupBy(*by, "lag").agg(F.sum("p").alias("p"))
