"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.textkit import cut, hot_join


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of n rows over the links (a, b), by label passing with shortcuts."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round hangs the larger neighbours of a node on its smallest neighbour, then the smaller ones, until the
    link table stops changing; the number of rounds is logarithmic in the longest chain. Minima come from partial
    aggregates and return by a plain join, so a hub with very many links is never one task's group. Rounds are
    cut by reliable checkpoints. Null ends are ignored; no links give an empty table.
    """
    edges = cut(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    )
    before = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
        if now == before or now["n"] == 0:
            break
        before = now
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("held")).select("u", F.least("u", "m").alias("m"), "held")
        large = hot_join(both.filter("v > u"), low, "u", "held", 2 * now["n"]).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low2 = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low2, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo"))
        edges = cut(small.filter("hi > lo").distinct())
    return edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    ).groupBy("node").agg(F.min("component").alias("component"))
