"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed character n-grams. Each n-gram's value is its log-count ratio, how much more often
toxic than clean training texts hold it; logistic regression learns weights on top. The fit takes at most
``max_rows`` labelled rows (chosen by a hash of the id), and so the labels it joins by broadcast and the rows it
trains on are bounded; rows are dealt to a fixed number of trainers by a hash of id and text, each of which makes a few
passes over its rows from the common weights in every round, and the weights are averaged in the trainers' order. So the
model is the same whatever the layout of the input. Scoring is a map over all documents with one broadcast vector of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.textkit import cut

BITS = 18
SIZES = (3, 4, 5)
MAX_ROWS = 20_000
#: Common rounds, passes of a partition in each, and the share of its error that a row corrects.
ROUNDS, PASSES, RATE = 5, 3, 1.0
#: A toxic row, the rarer kind, counts this often; n-grams in fewer rows than LEAST have no ratio.
TOXIC_WEIGHT, LEAST = 3.0, 5
#: Trainers that work side by side; part of the model's definition, so fixed.
TRAINERS = 8


def ngram_set(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Sorted hashed n-grams of a text (lower case, runs of white space as one blank). ``seen``: scratch, all False."""
    code = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for n in SIZES:
        m = len(code) - n + 1
        if m > 0:
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h + code[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
            seen[(h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)] = True
    at = np.flatnonzero(seen)
    seen[at] = False
    return at


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(trainer, grams binary, y): at most ``max_rows`` labelled ids' documents, by a broadcast of their ids.

    An id with several labels counts as toxic if one of them is; null labels and ids are left out.
    """
    one = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    n = one.count()
    if n > max_rows:  # exact bound: the rows with the smallest hashes
        share = max_rows / n
        one = one.filter(F.pmod(F.xxhash64(id_col, F.lit(10)), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64(id_col, F.lit(10))).limit(max_rows)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(one.select(F.col(id_col).cast("string").alias("id"), "y")), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, bool)
        for b in batches:
            grams = [packed(ngram_set(t.as_py(), seen)) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(grams, pa.binary()), b.column(1)], names=["trainer", "grams", "y"])

    # the sampled texts are dealt out, not their n-grams, which take more room
    trainer = F.pmod(F.xxhash64("id", "text"), F.lit(TRAINERS)).cast("int")
    dealt = rows.withColumn("trainer", trainer).repartition(TRAINERS, "trainer").sortWithinPartitions("trainer", "id", "y", "text")
    return dealt.select("text", F.when(F.col("y") > 0, 1).otherwise(0).alias("y"), "trainer").mapInArrow(run, "trainer int, grams binary, y int")


def packed(at: np.ndarray) -> bytes:
    """Sorted n-grams as 16-bit gaps; a gap of 65535 or more takes several."""
    gaps = np.diff(at, prepend=0)
    more = gaps // 65535
    if more.any():
        wide = np.full(len(gaps) + int(more.sum()), 65535, "<u2")
        wide[np.cumsum(more + 1) - 1] = gaps % 65535
        return wide.tobytes()
    return gaps.astype("<u2").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    gaps = np.frombuffer(raw, "<u2").astype(np.int64)
    return np.cumsum(gaps)[gaps != 65535]


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """(weight per n-gram, intercept). Without rows of both labels: no weights, and the smoothed prior."""
    rows = training_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, max_rows=max_rows)
    rows = cut(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for b in batches:
            for g, y in zip(b.column("grams"), b.column("y").to_pylist(), strict=True):
                sums[y][unpacked(g.as_py())] += 1
                n[y] += 1
        if n.any():  # as many sums as trainers at most, however many partitions
            yield pa.RecordBatch.from_arrays([pa.array([s.astype("<i8").tobytes() for s in sums]), pa.array(n)], names=["sums", "n"])

    total, n = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    told = rows.mapInArrow(count, "sums binary, n bigint").toArrow()
    for i, (s, k) in enumerate(zip(told["sums"], told["n"].to_pylist(), strict=True)):
        total[i % 2] += np.frombuffer(s.as_py(), "<i8")
        n[i % 2] += k
    prior = math.log((n[1] + 0.5) / (n[0] + 0.5)) if n.sum() else -20.0
    if not n.all():
        return np.zeros(1 << BITS), prior
    share = total / n[:, None]
    small = 1.0 / n.min()
    ratio = np.log((share[1] + small) / (share[0] + small))
    ratio[total.sum(0) < LEAST] = 0.0

    weight, bias = np.zeros(1 << BITS, np.float32), prior
    for _ in range(ROUNDS):
        state = rows.sparkSession.sparkContext.broadcast((weight, bias, ratio.astype(np.float32)))

        def train(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            r, data = state.value[2], {}
            for b in batches:
                for t, g, y in zip(b.column("trainer").to_pylist(), b.column("grams"), b.column("y").to_pylist(), strict=True):
                    data.setdefault(t, []).append((unpacked(g.as_py()).astype(np.int32), y))
            for t, mine in data.items():
                w, b0 = one(state.value[0].copy(), state.value[1], r, mine)
                yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([w.astype("<f4").tobytes()]), pa.array([float(b0)]), pa.array([len(mine)])], names=["t", "w", "b", "n"])

        def one(w: np.ndarray, b0: float, r: np.ndarray, data: list) -> tuple[np.ndarray, float]:
            for _ in range(PASSES):
                for at, y in data:
                    x = r[at]
                    z = max(-30.0, min(30.0, float(w[at] @ x) + b0))
                    d = TOXIC_WEIGHT * (1.0 - 1.0 / (1.0 + math.exp(-z))) if y else -1.0 / (1.0 + math.exp(-z))
                    w[at] += np.float32(RATE * d / (float(x @ x) + 1.0)) * x
                    b0 += 0.01 * d
            return w, b0

        told = rows.mapInArrow(train, "t bigint, w binary, b double, n bigint").toArrow().sort_by("t")
        parts = [(np.frombuffer(w.as_py(), "<f4"), b, k) for w, b, k in zip(told["w"], told["b"].to_pylist(), told["n"].to_pylist(), strict=True) if k]
        seen = sum(k for _, _, k in parts)
        weight = sum(w * np.float32(k / seen) for w, _, k in parts)
        bias = sum(b * k / seen for _, b, k in parts)
        state.unpersist()
    return weight.astype(np.float64) * ratio, bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], *, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more).

    Null and empty texts have no n-grams but the blank's and get about the intercept's score. Input columns of the two
    names are replaced.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = shared.value
        seen = np.zeros(1 << BITS, bool)
        for b in batches:
            z = np.array([bias + float(weight[ngram_set(t.as_py(), seen)].sum(dtype=np.float64)) for t in b.column(text_col)])
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema)


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id as text, modulo k (null ids count as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(k))
