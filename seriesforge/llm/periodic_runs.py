"""Periodic runs: stretches of words that repeat with a period three times or more, found by seed and extend.

A run of smallest period q and length at least max(24, 3q) agrees with itself, moved by q, on 16 words or more, and on
2q or more. So k-grams of 16 words meet every run of a period up to 16, those of 32 words every period up to 32, and so
on: level k answers for the periods in (k/2, k], and k is the least overlap that such a run is sure to have. Grams are
numbered by value, each level by pairs of the level below, so equal numbers are equal words and nothing is hashed.

At a level only neighbouring occurrences of a gram are seeds. That loses nothing: the gram at a run's start comes
again q words later, and if it came d words later with d < q, the two overlapping grams and the run would have the
period gcd(d, q) in common (the gram is at least q long), against q being the smallest. So a text of n words
has at most n seeds a level, however often a gram occurs. A seed is extended word by word along its diagonal, and a
table of the furthest position covered for each lag keeps a diagonal from being walked twice.

Texts are judged one by one, by a map over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run holds at least this many words and this many periods; fixed by the definition of a run.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of the first level's grams: the least overlap of any run with itself, moved by one period (24 - 8).
FIRST = 16

#: Words before a text is cut, given its id: lets a caller alter texts in the same pass.
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def doubled(grams: np.ndarray, step: int) -> np.ndarray:
    """Numbers of the grams twice as long, from those of ``step`` words."""
    left, right = grams[: len(grams) - step], grams[step:]
    return np.unique(left * (int(grams.max()) + 1) + right, return_inverse=True)[1]


def seeds(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of neighbouring occurrences of a gram, lags in low..high, by lag and position.

    Of seeds on one diagonal that the gram of the seed before reaches, only the first is given.
    """
    order = np.argsort(grams, kind="stable")
    same = np.diff(grams[order]) == 0
    at, lag = order[:-1][same], np.diff(order)[same]
    fits = (lag >= low) & (lag <= high)
    at, lag = at[fits], lag[fits]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    if len(at) > 1:
        first = np.r_[True, (np.diff(lag) != 0) | (np.diff(at) > high)]
        at, lag = at[first], lag[first]
    return at, lag


def _agree(number: np.ndarray, i: int, j: int, back: bool) -> int:
    """How many words agree from i and j > i on, or before them (``back``); compared in growing blocks."""
    room, done, block = (i if back else len(number) - j), 0, 64
    while done < room:
        n = min(block, room - done)
        if back:
            differ = (number[i - done - n : i - done] != number[j - done - n : j - done])[::-1]
        else:
            differ = number[i + done : i + done + n] != number[j + done : j + done + n]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, block = done + n, 2 * block
    return done


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    number = numbered(words)
    grams, k, found = number, 1, {}
    while 2 * k <= n and grams.max() + 1 < len(grams):  # until no gram occurs twice
        grams, k = doubled(grams, k), 2 * k
        if k < FIRST:
            continue
        furthest: dict[int, int] = {}
        for i, q in zip(*(a.tolist() for a in seeds(grams, 1 if k == FIRST else k // 2 + 1, k)), strict=True):
            if i < furthest.get(q, 0):
                continue
            end = i + q + _agree(number, i, i + q, back=False)
            start = i - _agree(number, i, i + q, back=True)
            furthest[q] = end - q
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                # multiples of the smallest period give the same stretch
                found[start, end] = min(q, found.get((start, end), q))
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words without those that a run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prepare: Prepare | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``runs`` (start, length, period; by start, then period) and ``collapsed_text``.

    Words are what lies between the bytes 0x20 and 0x09-0x0D. ``collapsed_text`` holds the words, joined by one space,
    that no run contains after its first period. Null and empty texts have no runs and an empty collapsed text. Every
    text is taken whole, however long (time n log n in its words, memory in proportion to them). Rows are judged one
    by one, so repeated rows agree; input columns of the two output names are replaced, all others, whatever their names,
    are kept; an empty table gives an empty one. ``prepare`` may change the words of a text first.
    """
    docs = docs.drop("runs", "collapsed_text")
    names = docs.columns
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                runs, texts = [], []
                for i, text in zip(part.column(id_col), part.column(text_col), strict=True):
                    words = (text.as_py() or "").encode().split()  # the bytes 0x20 and 0x09-0x0D part words
                    if prepare:
                        words = prepare(i.as_py(), words)
                    here = find_runs(words)
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in here])
                    texts.append(b" ".join(collapsed(words, here)).decode())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(runs, kind), pa.array(texts, pa.string())], names=[*names, "runs", "collapsed_text"])

    return docs.mapInArrow(run, docs.withColumns({"runs": F.lit(None).cast(_RUNS), "collapsed_text": F.lit("")}).schema)


def strongest(runs: str = "runs") -> F.Column:
    """The run with the greatest exact length / period (ties: smallest start, then period); null without runs."""
    one = F.get(runs, F.lit(0))
    better = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.aggregate(runs, one, better)
