"""Helpers shared by the text operators: word spans, word hashes, checkpoints."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from uuid import uuid4

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the runs without 0x20 and 0x09-0x0D."""
    word = np.empty(len(buf) + 2, np.int8)
    word[0] = word[-1] = 0
    word[1:-1] = (buf != 0x20) & ((buf < 0x09) | (buf > 0x0D))
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH3 (64 bits) of every word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


class SpanHasher:
    """Fast 64-bit hashes of byte spans, for estimates only: a random-table polynomial by prefix sums, then ``mix64``.

    A handful of vector operations over the whole buffer and no loop over words, but spans can be made that collide
    under every table. Nothing may be decided by these hashes.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 60, 1 << 62)) | 5
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        def table(base: int) -> np.ndarray:
            out, step = np.ones(1, np.uint64), base
            while len(out) < n:
                out, step = np.concatenate([out, out * np.uint64(step)]), step * step % (1 << 64)
            return out

        if len(self.powers) < n:
            self.powers, self.inverses = table(self.base), table(pow(self.base, -1, 1 << 64))

    def hash(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._grow(len(buf) + 1)
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.table[buf] * self.powers[: len(buf)], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64) * ODD)


def roll(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive word hashes (order matters)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out ^ hashes[k : k + n]) * ODD
        out ^= out >> np.uint64(29)
    return mix64(out)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as ``spark.checkpoint.dir`` names it.

    A local session needs no other machine, so there the folder may be unset; Spark's own local folder is used then.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.local.dir', '/tmp').split(',')[0]}/spark-{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def without_join_blooms(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator on a frame, run without Spark's Bloom filters of joins; its result is a checkpoint, so nothing is left to run later.

    Frames behind several joins have estimated sizes far above their own, so Spark makes such filters for small ones too:
    every partition sends megabytes of bits, however few rows it has, and one task merges those of all partitions.
    """
    setting = "spark.sql.optimizer.runtime.bloomFilter.enabled"

    @wraps(operator)
    def run(docs: DataFrame, *args, **named) -> DataFrame:
        conf = docs.sparkSession.conf
        before = conf.get(setting)
        conf.set(setting, "false")
        try:
            return cut(operator(docs, *args, **named))
        finally:
            conf.set(setting, before)

    return run


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table of the shared folder: computed once, unlike a checkpoint of a map."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it in any spelling."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts (one column-pruned pass)."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]


def hot_join(rows: DataFrame, table: DataFrame, key: str | list[str], held_by: str, total: int) -> DataFrame:
    """``rows`` joined with ``table`` on a key (or several columns), where ``held_by`` says how many of the ``total`` rows hold a key.

    Keys that hold more than a thousandth of all rows, of which there are fewer than a thousand, go by broadcast, so
    the rows of such a key stay spread as they are; all other keys are shuffled.
    """
    bound = max(100, total // 1000)
    hot = F.broadcast(table.filter(F.col(held_by) > bound).drop(held_by))
    cold = table.filter(F.col(held_by) <= bound).drop(held_by)
    spread = rows.join(hot, key)
    return spread.union(rows.join(hot.select(key), key, "left_anti").join(cold, key).select(spread.columns))
