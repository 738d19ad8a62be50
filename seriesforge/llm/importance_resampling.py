"""Target-distribution importance resampling over hashed word n-grams.

A text is lower-cased (A-Z only) and its separators collapse to single spaces, one more in front. One regular
expression, searched with overlapping matches, then stands at every word in turn: the space before the word and
lookarounds are its boundaries, and its groups are the word and the two after it, as far as there are any. So
a match gives the spans of the 1- to 3-grams that begin there, and the CRC-32 of each follows from that of the shorter one.

Every text is scanned once: its buckets are written to the shared folder, about a byte for each n-gram, and tasks send on
only sums by bucket. From the bucket counts of all documents and of all target texts come the gains (one number for each of
``BUCKETS`` buckets, the only thing that is collected and broadcast); a document's weight is the sum of its gains. Scores are weights
plus Gumbel noise from a hash of the id, so the best of them are a draw without replacement in proportion to
exp(weight / 1000). Ranks come from a range partitioning of (score, id): places inside a partition, offsets from one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.textkit import cut, written

BUCKETS, ORDERS = 10_000, 3
#: Bytes of words once A-Z are lower case: digits, a-z and all of UTF-8's longer sequences. All others part words.
_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_GRAMS = regex.compile(rb" (?=[^ ])([^ ]++)( [^ ]++)?( [^ ]++)?(?![^ ])")


def flattened(text: str | None) -> bytes:
    """Words of a text, lower case, each after one space."""
    words = (text or "").encode().lower().translate(_BYTES).split()
    return b" " + b" ".join(words) if words else b""


def buckets(text: str | None) -> tuple[int, np.ndarray]:
    """Words of a text, and the buckets of its 1- to 3-grams, sorted, repeats included."""
    flat, sums = flattened(text), []
    add, words = sums.append, 0
    for m in _GRAMS.finditer(flat, overlapped=True):
        one, two, three = m.group(1, 2, 3)
        add(c := crc32(one))
        words += 1
        if two:
            add(c := crc32(two, c))
            if three:
                add(crc32(three, c))
    return words, np.sort(np.array(sums, np.uint32) % BUCKETS).astype(np.int64)


def packed(sorted_buckets: np.ndarray) -> bytes:
    """Sorted numbers as gaps of one byte; a gap of 255 or more takes several."""
    gaps = np.diff(sorted_buckets, prepend=0)
    wide = np.full(len(gaps) + int((gaps // 255).sum()), 255, np.uint8)
    wide[np.cumsum(gaps // 255 + 1) - 1] = gaps % 255
    return wide.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    gaps = np.frombuffer(raw, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def _scanned(texts: DataFrame) -> DataFrame:
    """(id, n_words, n_features, buckets) of (id, text)."""
    id_type = dict(texts.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                told = [(n, len(x), packed(x)) for n, x in map(buckets, part.column("text").to_pylist())]
                n, k, raw = zip(*told, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(raw, pa.binary())], names=["id", "n_words", "n_features", "buckets"])

    return texts.mapInArrow(run, f"id {id_type}, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(scanned: DataFrame) -> np.ndarray:
    """Features by bucket in all rows; a task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for raw in b.column(0):
                total += np.bincount(unpacked(raw.as_py()), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    told = scanned.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[told["bucket"].to_numpy()] = told["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to raw frequency of every bucket, one added to each count; rounded down."""
    raw_all, target_all = float(raw.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.floor(1000 * np.log((target + 1.0) * raw_all / ((raw + 1.0) * target_all))).astype(np.int64)


def weighted(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the sum of a row's gains."""
    shared = scanned.sparkSession.sparkContext.broadcast(gain)
    id_type = dict(scanned.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            sums = [int(gain[unpacked(raw.as_py())].sum()) for raw in b.column("buckets")]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sums, pa.int64())], names=["id", "n_words", "n_features", "weight"])

    return scanned.mapInArrow(run, f"id {id_type}, n_words bigint, n_features bigint, weight bigint")


def noise(id_col: str, seed: int) -> F.Column:
    """Thousandths of a Gumbel variate from the first 32 bits of the SHA-256 of ``seed:id``, rounded down."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[F.Column]) -> DataFrame:
    """All columns plus ``rank`` from 1 in the given order; equal rows are told apart, so no key has to fit one task."""
    # a column of its own for equal rows, which may hold any share of the table
    ordered = rows.withColumn("_equal", F.monotonically_increasing_id())
    placed = cut(ordered.repartitionByRange(*order, "_equal").sortWithinPartitions(*order, "_equal").withColumn("_place", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    told = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + inside + 1)
    return told.select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank is null for those that are not drawn.

    Of the N documents with at least ``min_words`` words the floor(percent * N / 100) with the highest scores are drawn,
    ties to the smaller id (a null id comes first). Null and empty texts have no features, weight 0 and are never
    drawn while ``min_words`` is above 0. Texts of any length are scanned whole. Repeated rows score alike and each may be drawn. An
    empty target leaves the raw frequencies to decide. Further columns, whatever their names, are not read; an empty
    table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scanned = written(_scanned(rows), "features")
    aims = _scanned(target.select(F.lit(0).alias("id"), F.col(target_text_col).alias("text")))
    gain = gains(bucket_counts(scanned), bucket_counts(aims))
    scored = written(weighted(scanned, gain).withColumn("score", F.col("weight") + noise("id", seed)), "scores")
    fit = F.col("n_words") >= min_words
    n = scored.filter(fit).count() * percent // 100
    place = ranked(scored.filter(fit), [F.desc("score"), F.asc_nulls_first("id")])
    drawn = place.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    rest = scored.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("id", "n_features", "weight", "score", "rank")
