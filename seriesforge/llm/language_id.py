"""Language identification by multilingual mixture inference.

A text is a mixture of the learned languages. Expectation-maximisation estimates each document's language
proportions from hashed character n-gram likelihoods; the language set is the one whose likelihood, less a
penalty per language, is best. The model is one table of ``BUCKETS`` rows by languages, summed over all training
documents by Spark; ``MAX_LANGUAGES`` bounds it, and with it what a task holds, the driver takes and the broadcast sends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.textkit import cut

#: Hashed n-gram table; n-grams of two and three letters.
BUCKETS = 1 << 15
#: Languages of a model (256 KB each). More are an error, never left out: such a column does not hold languages.
MAX_LANGUAGES = 1024
ROUNDS = 12
#: Penalty per added language: this share of all n-grams' log-likelihood, and a Bayes information term.
MIN_SHARE = 0.02


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the hashed letter bigrams and trigrams of lower-cased words; none without letters."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = ((code >= 97) & (code <= 122)) | (code >= 0xAA)
    if (code >= 0xAA).any():
        odd = np.unique(code[code >= 0xAA])
        letter &= ~np.isin(code, odd[[not chr(c).isalpha() for c in odd]])
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = np.zeros(len(code) + 2, np.uint64)
    x[1:-1] = np.where(letter, code, 32)
    x[0] = x[-1] = 32
    a, b, c = x[:-2], x[1:-1], x[2:]
    tri = (a * np.uint64(0x9E3779B1) + b * np.uint64(0x85EBCA6B) + c * np.uint64(0xC2B2AE35)) * np.uint64(0x9E3779B97F4A7C15)
    two = (b * np.uint64(0x27D4EB2F) + c * np.uint64(0x165667B1) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - 15)
    h = np.concatenate([(tri >> shift)[b != 32], (two >> shift)[(b != 32) & (c != 32)]]).astype(np.int64)
    counts = np.bincount(h, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages, table): smoothed n-gram shares of each non-null language over all given rows.

    The table is collected and broadcast, so its width is bounded: more than ``max_languages`` values raise. Languages whose texts have no letters are not learned.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at, c = ngram_counts(text)
                if lang not in sums:
                    if len(sums) == max_languages:
                        raise ValueError(f"more than {max_languages} languages")
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang][at] += c
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(s[at])], names=["lang", "bucket", "n"])

    seen = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string"), text_col)
    counted = cut(seen.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    if counted.select("lang").distinct().count() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    rows = counted.toArrow()
    coded = rows["lang"].combine_chunks().dictionary_encode()
    names = coded.dictionary.to_pylist()
    langs = sorted(names)
    table = np.full((BUCKETS, len(langs)), 0.5)
    if langs:
        column = {x: i for i, x in enumerate(langs)}
        place = np.array([column[x] for x in names])
        np.add.at(table, (rows["bucket"].to_numpy(), place[coded.indices.to_numpy()]), rows["n"].to_numpy())
        table /= table.sum(0)
    return langs, table


def mixture(at: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Language proportions of one document (zero for languages outside the chosen set)."""
    p, n = table[at], counts.sum()
    logs = counts @ np.log(p)
    best = int(np.argmax(logs))
    chosen, score = [best], logs[best]
    share = np.zeros(table.shape[1])
    share[best] = 1.0
    penalty = max(0.5 * np.log(n + 1), MIN_SHARE * n)
    ratio = p / p[:, [best]]
    while len(chosen) < table.shape[1]:
        # a language can only help if its n-grams that the set explains badly gain more than the penalty
        rest = [k for k in range(table.shape[1]) if k not in chosen]
        mixed = ratio[:, chosen] @ share[chosen]
        gain = [(counts @ np.log(0.85 * mixed + 0.15 * ratio[:, k]), k) for k in rest]
        value, k = max(gain)
        now = logs[best] + counts @ np.log(mixed)
        if logs[best] + value < now - 0.5 * penalty:
            break
        trial = [*chosen, k]
        pi = np.full(len(trial), 1.0 / len(trial))
        r = ratio[:, trial]
        for _ in range(ROUNDS):
            weight = counts / (r @ pi)
            pi = pi * (weight @ r) / n
        value = logs[best] + counts @ np.log(r @ pi) - penalty * (len(trial) - 1)
        if value <= score:
            break
        chosen, score = trial, value
        share = np.zeros(table.shape[1])
        share[trial] = pi
    return share


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus lang_pred, score (share of that language), and langs (the chosen set, by share).

    ``und`` with score 0 and no languages where the text is null or has no letter, or nothing was learned. Input
    columns of the three output names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "langs")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        for b in batches:
            pred, score, sets = [], [], []
            for text in b.column(text_col).to_pylist():
                at, counts = ngram_counts(text)
                if not len(at) or not langs:
                    pred.append("und"), score.append(0.0), sets.append([])
                    continue
                share = mixture(at, counts, table)
                order = [k for k in np.argsort(-share, kind="stable") if share[k] > 0]
                pred.append(langs[order[0]]), score.append(float(min(1.0, share[order[0]]))), sets.append([langs[k] for k in order])
            made = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*names, "lang_pred", "score", "langs"])

    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "langs": F.array().cast("array<string>")}).schema
    return docs.mapInArrow(run, schema)
