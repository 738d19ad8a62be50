"""Exact token counts: a histogram of encoded lengths whose suffix sums answer every context limit.

Documents are encoded once, where they are read; only (length, documents) pairs leave a task, combined before the
shuffle. Suffix sums are taken in two levels, inside ranges of lengths and over the ranges, so no task sees more
than ``RANGE`` lengths or one row per range.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.textkit import cut

RANGE = 4096


@lru_cache(maxsize=4)
def encoder(path: str):
    """tiktoken encoder of a vocabulary file of ranks; no special tokens."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_length(docs: DataFrame, vocabulary: str, *, text_col: str = "text", name: str = "n_tokens") -> DataFrame:
    """All columns of ``docs`` plus the token count of the whole text (null: none). A column of that name is replaced."""
    docs = docs.drop(name)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for b in batches:
            n = [len(encode(t.as_py() or "")) for t in b.column(text_col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], names=[*names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0).cast("long")).schema)


def token_lengths(docs: DataFrame, vocabulary: str, *, text_col: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents by encoded length, pre-summed in each task.

    Null and empty texts have length 0; repeated rows count one by one; further columns, whatever their names, are
    not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        seen: dict[int, int] = {}
        for b in batches:
            for t in b.column(0):
                n = len(encode(t.as_py() or ""))
                seen[n] = seen.get(n, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["n_tokens", "n_docs"])

    mapped = docs.select(text_col).mapInArrow(run, "n_tokens bigint, n_docs bigint")
    return mapped.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def length_table(lengths: DataFrame) -> DataFrame:
    """One row per encoded length that occurs, from (n_tokens, n_docs).

    ``n_docs``; ``docs_from`` and ``tokens_from``: documents of that length or more and their tokens (suffix sums);
    ``total_tokens``; ``truncated_tokens``: all tokens left when texts are cut to this length; ``quantile``: share of
    documents up to this length. For a limit L between two rows, the next row up (length m) answers exactly:
    total_tokens - tokens_from + docs_from * L. An empty table gives no rows.
    """
    # small: one row per length; written once, so that both levels of sums read it and no text is encoded again
    ranged = cut(lengths).withColumn("r", F.floor(F.col("n_tokens") / RANGE))
    tokens = F.col("n_tokens") * F.col("n_docs")
    ranges = ranged.groupBy("r").agg(F.sum("n_docs").alias("rd"), F.sum(tokens).alias("rt"))
    up = Window.orderBy(F.desc("r"))
    above = ranges.select(
        "r", (F.sum("rd").over(up) - F.col("rd")).alias("ad"), (F.sum("rt").over(up) - F.col("rt")).alias("at"),
        F.sum("rd").over(Window.partitionBy()).alias("all_docs"), F.sum("rt").over(Window.partitionBy()).alias("all_tokens"),
    )
    within = Window.partitionBy("r").orderBy(F.desc("n_tokens"))
    return (
        ranged.join(above, "r")
        .withColumn("docs_from", F.sum("n_docs").over(within) + F.col("ad"))
        .withColumn("tokens_from", F.sum(tokens).over(within) + F.col("at"))
        .select(
            "n_tokens", "n_docs", "docs_from", "tokens_from", F.col("all_tokens").alias("total_tokens"),
            (F.col("all_tokens") - F.col("tokens_from") + F.col("docs_from") * F.col("n_tokens")).alias("truncated_tokens"),
            ((F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("all_docs")).alias("quantile"),
        )
    )


def answer_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_tokens, total_tokens) for any limits, from the small length table."""
    rows = table.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit bigint")
    over = F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)
    kept = F.least("n_tokens", "context_limit") * F.col("n_docs")
    return table.crossJoin(F.broadcast(rows)).groupBy("context_limit").agg(
        F.sum(over).alias("docs_over"), F.sum(kept).alias("truncated_tokens"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total_tokens")
    )


def length_quantile(table: DataFrame, share: float) -> DataFrame:
    """(n_tokens): the smallest length that at least ``share`` of the documents do not exceed."""
    return table.filter(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))
