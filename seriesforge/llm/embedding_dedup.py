"""Embedding near-dedup: PCA-ordered tiled cosine comparison with suffix-norm bounds.

Vectors are scaled to length one in double precision and turned into the principal axes of the whole table (the
covariance is a sum over partitions, its size fixed by the dimension). Equal vectors of a label collapse first.
Inside a label, vectors of one length are ordered by their cell on the leading axes (the bits of the axes' bins taken in turn,
so cells that follow each other lie close on all of them) and cut into blocks. Two blocks whose boxes on these axes are
further apart than any pair at the threshold can be are never compared. Within a tile of two blocks the leading axes
are multiplied first; what the remaining axes can still add is at most the product of the two suffix norms, so a pair
stops as soon as the sum cannot reach the threshold. Survivors are verified with the vectors as given.

A tile returns link counts per vector and a spanning forest of its links, so its output is linear in its rows
however tight a group is. Vectors travel in the precision they were given in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.components import connected_components, forest
from seriesforge.llm.textkit import cut, hot_join

#: Leading axes of the cells, and bits of each axis's bin.
AXES, AXIS_BITS = 4, 5
STEPS = (8, 24, 48)


def _valid(vector: str) -> F.Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by their largest component first, so that no square leaves the range of a double."""
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def cells(leading: np.ndarray) -> np.ndarray:
    """Number of the cell of each row: the bits of its bins on the leading axes, from the highest down, in turn."""
    bins = np.clip(np.floor((leading + 1) / 2 * (1 << AXIS_BITS)), 0, (1 << AXIS_BITS) - 1).astype(np.int32)
    out = np.zeros(len(leading), np.int32)
    for bit in range(AXIS_BITS - 1, -1, -1):
        for axis in range(bins.shape[1]):
            out = out << 1 | bins[:, axis] >> bit & 1
    return out


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Axes of the vectors' covariance, widest first; partitions send one dim x dim sum each."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = unit(_matrix(b.column(0), dim))
            n, s, ss = n + len(x), s + x.sum(0), ss + x.T @ x
        i = np.arange(dim * dim + dim + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(np.concatenate([ss.ravel(), s, [n]]))], names=["i", "v"])

    total = vectors.select("x").mapInArrow(sums, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    v = np.array([r["v"] for r in total])
    n = max(v[-1], 1.0)
    mean = v[-1 - dim : -1] / n
    return np.linalg.eigh(v[: dim * dim].reshape(dim, dim) / n - np.outer(mean, mean))[1][:, ::-1]


def compare(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of PCA-ordered unit vectors whose product may reach the threshold (all that do among them)."""
    dim, slack, floor = left.shape[1], 1e-9, threshold - 1e-9
    edges = [0, *[s for s in STEPS if s < dim], dim]
    suffix = [np.sqrt(np.maximum((m[:, ::-1] ** 2).cumsum(1)[:, ::-1], 0)) for m in (left, right)]
    k = edges[1]
    part = left[:, :k] @ right[:, :k].T
    if k < dim:
        i, j = np.nonzero(part + np.outer(suffix[0][:, k], suffix[1][:, k]) >= floor - slack)
    else:
        i, j = np.nonzero(part >= floor - slack)
    part = part[i, j]
    for k, end in zip(edges[1:], edges[2:], strict=False):
        part = part + np.einsum("ij,ij->i", left[i, k:end], right[j, k:end])
        rest = suffix[0][i, end] * suffix[1][j, end] if end < dim else 0.0
        on = part + rest >= floor - slack
        i, j, part = i[on], j[on], part[on]
    return i, j


def embedding_groups(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.93, block_rows: int = 2048,
) -> DataFrame:
    """(id, n_links, component, kept) for every row: links are pairs of one label with cosine of ``threshold`` or more.

    Vectors that are null, empty, all zero or hold null or non-finite components, or whose label is null, link with
    nothing. Vectors of one label are compared when they have the same length, each length on its own (the principal axes
    are those of the most common length; the others keep their own axes, for which the bounds hold as well). Rows
    with a null id link and are counted as links of others, but name no component. Repeated rows, and rows that share
    an id, are rows of their own: equal vectors link.
    """
    kind = dict(vectors.dtypes)[vector_col]
    given_as = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(given_as).alias("x"))
    good = rows.filter(_valid("x") & F.col("label").isNotNull())
    none = rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"), F.col("id").isNotNull().alias("kept"))
    distinct = good.groupBy("label", "x").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    common = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return none
    turned = {common["d"]: principal_axes(good.filter(F.size("x") == common["d"]), common["d"])}
    names = [f"c{k}" for k in range(AXES)]

    def onto_axes(x: np.ndarray) -> np.ndarray:
        return x @ turned[x.shape[1]] if x.shape[1] in turned else x

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, lead = b.column("dim").to_numpy(), np.zeros((b.num_rows, AXES))
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                lead[at, : min(d, AXES)] = onto_axes(unit(_matrix(b.column("x").take(pa.array(at)), d)))[:, :AXES]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells(lead)), *[pa.array(c) for c in lead.T]], names=[*b.schema.names, "bin", *names])

    shaped = distinct.withColumn("dim", F.size("x"))
    schema = shaped.withColumns({"bin": F.lit(0), **{c: F.lit(0.0) for c in names}}).schema
    # a key of its own for each distinct vector, fixed by the checkpoint
    flat = cut(shaped.mapInArrow(turn, schema).withColumn("v", F.monotonically_increasing_id()))

    # blocks: runs of cells that hold about block_rows vectors; a cell that holds more is dealt out by hash
    kin = ["label", "dim"]
    by_bin = Window.partitionBy(*kin).orderBy("bin")
    bins = cut(
        flat.groupBy(*kin, "bin").agg(F.count("*").alias("c"))
        .withColumn("run", F.floor((F.sum("c").over(by_bin) - F.col("c")) / block_rows))
        .withColumn("parts", F.ceil(F.col("c") / block_rows).cast("int"))
    )
    of_bin = hot_join(flat, bins.select(*kin, "bin", "run", "parts", F.col("c").alias("held")), [*kin, "bin"], "held", flat.count())
    block = F.struct("run", F.when(F.col("parts") > 1, F.struct("bin", F.expr("pmod(xxhash64(v), parts)").alias("part"))).alias("at"))
    placed = of_bin.select(*kin, "x", "n", "v", *names, block.alias("block"))
    blocks = cut(placed.groupBy(*kin, "block").agg(*[f(c).alias(f"{c}_{e}") for c in names for f, e in ((F.min, "lo"), (F.max, "hi"))]))
    # cosine >= threshold: unit vectors at most this far apart
    reach = max(0.0, 2 - 2 * threshold) + 1e-9
    p, q = blocks.alias("p"), blocks.alias("q")
    gaps = [F.greatest(F.lit(0.0), F.col(f"p.{c}_lo") - F.col(f"q.{c}_hi"), F.col(f"q.{c}_lo") - F.col(f"p.{c}_hi")) for c in names]
    apart = reduce(lambda x, y: x + y, [g * g for g in gaps])
    pairs = p.join(q, (F.col("p.label") == F.col("q.label")) & (F.col("p.dim") == F.col("q.dim")) & (F.col("p.block") <= F.col("q.block")) & (apart <= reach)) \
        .select(F.col("p.label").alias("label"), F.col("p.dim").alias("dim"), F.col("p.block").alias("one"), F.col("q.block").alias("two")) \
        .withColumn("tile", F.xxhash64("label", "dim", "one", "two"))
    sides = pairs.select(*kin, F.col("one").alias("block"), "tile", "one", "two", F.lit(0).alias("side")).union(
        pairs.filter("one < two").select(*kin, F.col("two").alias("block"), "tile", "one", "two", F.lit(1).alias("side"))
    )
    dealt = placed.join(sides, [*kin, "block"]).select("tile", *kin, "one", "two", "side", "v", "n", "x")

    def tile(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        side, v, n = (t[c].to_numpy() for c in ("side", "v", "n"))
        given = _matrix(t["x"], key[2].as_py())
        y = onto_axes(unit(given))
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(two)
        i, j = compare(y[one], y[one if same else two], threshold)
        a, b = one[i], (one if same else two)[j]
        if same:
            a, b = a[i < j], b[i < j]
        # scaled to length one first: products of very large or very small components leave the range of a double
        one_a, one_b = unit(given[a]), unit(given[b])
        dot = np.einsum("ij,ij->i", one_a, one_b)
        a, b = a[dot >= threshold], b[dot >= threshold]
        links = np.bincount(a, n[b], len(v)) + np.bincount(b, n[a], len(v))
        root = forest(len(v), a, b)
        on = links > 0
        return pa.table({"v": pa.array(v[on]), "links": pa.array(links[on].astype(np.int64)), "root": pa.array(v[root][on])})

    found = cut(dealt.groupBy("tile", *kin, "one", "two").applyInArrow(tile, "v bigint, links bigint, root bigint"))
    parts = connected_components(found, "v", "root")
    links = found.groupBy("v").agg(F.sum("links").alias("links"))
    named = flat.join(parts.withColumnRenamed("node", "v"), "v", "left").withColumn("component", F.coalesce("component", "v"))
    least = named.groupBy("component").agg(F.min("id").alias("least"))
    told = named.join(least, "component").join(links, "v", "left").select(
        "label", "x", F.col("n").alias("held"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.col("least").alias("component")
    )
    linked = hot_join(good.select("id", "label", "x"), told, ["label", "x"], "held", good.count()).select("id", "n_links", "component")
    alone = rows.filter(~_valid("x") | F.col("label").isNull()).select("id", F.lit(0).cast("long"), "id")
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
