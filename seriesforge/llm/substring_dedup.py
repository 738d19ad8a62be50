"""Substring dedup: a count-min prefilter over word windows, then exact grouping of what it lets through.

Documents are dealt once into chunks (one text shuffle, which all three passes reuse):

1. every chunk sends the sketch cells of its windows to the sketch block that owns them; a block merges the
   partition sketches and answers each chunk with one bit per cell: "estimated in two documents or more".
   Estimates never fall short, so no repeated window is lost;
2. windows whose every cell passed go, with 128 bits of the BLAKE2b of their bytes and the chunk's smallest doc_id, to the
   key block that owns them; it groups them exactly and answers with one bit: "a smaller doc_id outside the chunk has
   it". The sketch's fast hashes decide nothing: words go only where these cryptographic digests, for which no two
   inputs of one digest are known or can be sought out, agree;
3. every chunk marks the words of windows that a smaller document has, and drops them.

Nothing is collected or broadcast. The sketch has one cell per text byte (about six per window) in each of two
rows, so it grows with the corpus; a window costs about four shuffled bytes, and only estimated repeats (a few
per cent when nothing repeats) cost the sixteen to twenty-four bytes of the exact pass. A window that very many
documents share is sent once per chunk. Messages between chunks and blocks are read and written as whole columns, so
their number costs little.
"""

from __future__ import annotations

import math
from hashlib import blake2b
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.textkit import ODD, SpanHasher, mix64, roll, text_bytes, unused, word_spans

ROWS = 2
_LAST = np.iinfo(np.int64).max
#: Messages that a sketch block adds at once; their sum fits one byte.
SLAB = 120
_FAST = SpanHasher(1)


class _Windows:
    """Windows of one chunk: position of the first word, document, and a fast hash for the sketch."""

    def __init__(self, texts: list, ids: list, width: int):
        # the bytes 0x20 and 0x09-0x0D part words; one space between them makes equal windows equal bytes
        lines = [b" ".join((t or "").encode("utf-8", "surrogatepass").split()) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])])
        self.raw = b"\n".join([*lines, b""])
        buf = np.frombuffer(self.raw, np.uint8)
        self.starts, self.ends = word_spans(buf)
        self.offsets = offsets
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        n = max(0, len(self.starts) - width + 1)
        self.at = np.flatnonzero(self.doc[:n] == self.doc[width - 1 :]) if n else np.zeros(0, np.int64)
        self.fast = roll(_FAST.hash(buf, self.starts, self.ends), width)[self.at]
        self.width = width

    def exact(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of the BLAKE2b digests of the windows' bytes."""
        first, raw = self.at[pick], self.raw
        spans = zip(self.starts[first].tolist(), self.ends[first + self.width - 1].tolist(), strict=True)
        both = np.frombuffer(b"".join([blake2b(raw[a:b]).digest()[:16] for a, b in spans]), np.uint64)
        return both[::2], both[1::2]

    def owner(self) -> np.ndarray:
        """doc_id of each window."""
        return self.ids[self.doc[self.at]]


def _cells(fast: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (fast if row == 0 else mix64(fast * ODD + np.uint64(row))) >> np.uint64(64 - bits)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])


def _counts(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the narrowest type that holds them."""
    if values.min(initial=0) < 0:
        return values
    top = values.max(initial=0)
    return values.astype("<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def _messages(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive slices of an array as binary values."""
    ends = np.concatenate([[0], np.cumsum(counts * values.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


def _bit_places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every bit where each message begins at a whole byte, and the bytes of each message."""
    size = (counts + 7) // 8
    shift = 8 * (np.cumsum(size) - size) - (np.cumsum(counts) - counts)
    return np.arange(counts.sum()) + np.repeat(shift, counts), size


def _bit_messages(bits: np.ndarray, counts: np.ndarray) -> pa.Array:
    place, size = _bit_places(counts)
    flat = np.zeros(8 * int(size.sum()), bool)
    flat[place] = bits
    return _messages(np.packbits(flat), size)


def _bits(column: pa.ChunkedArray, counts: np.ndarray) -> np.ndarray:
    place, _ = _bit_places(counts)
    return np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8))[place].astype(bool)


def _numbers(column: pa.ChunkedArray, counts: np.ndarray) -> np.ndarray:
    """What ``_messages`` of ``_narrow`` values held, one after another, whatever each message's width."""
    raw = column.to_pylist()
    width, out = np.array([len(r) for r in raw]) // counts, np.empty(counts.sum(), np.int64)
    for w in np.unique(width):
        values = np.frombuffer(b"".join(compress(raw, width == w)), f"<u{w}")
        out[np.repeat(width == w, counts)] = values.astype(np.uint64).view(np.int64)
    return out


_SKETCH = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("gaps", pa.binary()), ("multi", pa.binary())])
_KEYS = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("k1", pa.binary()), ("k2", pa.binary()), ("low", pa.binary())])
_REPLY = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])


def _table(schema: pa.Schema, *columns) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema, strict=True)], schema=schema)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def remove_repeated_windows(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 13, chunk_bytes: int | None = None
) -> DataFrame:
    """Remove from every document the words of windows that start in a document with a smaller id.

    A window is ``width`` consecutive words (``[^\\x20\\x09-\\x0D]+``) of one document; windows are judged on the
    input. Returns all columns of ``docs`` plus ``dedup_words``, ``dedup_removed`` (long) and ``dedup_text`` (kept
    words joined by one space). Null or empty texts have no words; documents shorter than the window keep all. Rows
    with one id are one age: they never remove from each other. A null id counts as later than every other id. Rows
    repeated whole are dealt by the input partition they come from, so no chunk has to hold all of them.
    Extra columns pass through; an input column of one of the three output names is replaced.

    ``chunk_bytes``: text per chunk. By default 64 times the square root of the corpus bytes, between 2 and 128 MB,
    so that chunks and blocks both stay in one worker's memory as the corpus grows.
    """
    new = ("dedup_words", "dedup_removed", "dedup_text")
    docs = docs.drop(*new)
    total = text_bytes(docs, text_col)
    size = chunk_bytes or int(min(max(64 * math.sqrt(total), 2 << 20), 128 << 20))
    chunks = max(1, -(-total // size))
    bits = min(60, max(16, math.ceil(math.log2(total + 1))))
    block_bits = min(bits, max(16, min(27, bits // 2 + 7)))
    key_bits = max(0, bits - block_bits - 2)
    columns = docs.columns
    chunk = unused(columns, "_chunk")
    dealt = docs.withColumn(chunk, F.pmod(F.xxhash64(id_col, text_col, F.spark_partition_id()), F.lit(chunks))).repartition(chunk)

    def windows(table: pa.Table) -> _Windows:
        return _Windows(table[text_col].to_pylist(), table[id_col].to_pylist(), width)

    def per_row(w: _Windows, row: int):
        """Windows in cell order, the run starts, and the cell of each run."""
        cells = _cells(w.fast, row, bits)
        order = np.argsort(cells, kind="stable")
        ordered = cells[order]
        at = _runs(ordered)
        return order, at, ordered[at]

    def sketch(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        w, out = windows(table), []
        for row in range(ROWS):
            order, at, cells = per_row(w, row)
            doc = w.doc[w.at][order]
            multi = doc[at] != doc[np.append(at[1:], len(doc)) - 1] if len(at) else np.zeros(0, bool)
            block, inner = (cells >> np.uint64(block_bits)).astype(np.int64), (cells & np.uint64((1 << block_bits) - 1)).astype(np.int64)
            first = _runs(block)
            n = _counts(first, len(block)) if len(first) else first
            gaps = np.diff(inner, prepend=0)
            gaps[first] = inner[first]
            out.append(_table(_SKETCH, block[first] * ROWS + row, np.full(len(first), key[0].as_py()), n, _messages(_narrow(gaps), n), _bit_messages(multi, n)))
        return pa.concat_tables(out)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        counts, cells, said = np.zeros(1 << block_bits, np.uint8), [], table["n"].to_numpy()
        for i in range(0, len(said), SLAB):
            part, n = table.slice(i, SLAB), said[i : i + SLAB]
            sums, start = np.cumsum(_numbers(part["gaps"], n)), np.cumsum(n) - n
            at = sums - np.repeat(np.where(start > 0, sums[start - 1], 0), n)
            np.add.at(counts, at, _bits(part["multi"], n).astype(np.uint8) + np.uint8(1))
            counts[at] = np.minimum(counts[at], 2)
            cells.append(at)
        here = np.full(len(said), key[0].as_py())
        return _table(_REPLY, table["chunk"].to_numpy(), np.zeros(len(said), np.int32), here, said, _bit_messages(counts[np.concatenate(cells)] >= 2, said))

    def answers(replies: pa.Table, kind: int, row: int | None = None) -> np.ndarray:
        """The bits that blocks sent, in the order of the blocks."""
        kinds, block = replies["kind"].to_numpy(), replies["block"].to_numpy()
        mine = np.flatnonzero((kinds == kind) & ((block % ROWS == row) if row is not None else True))
        some = replies.take(pa.array(mine[np.argsort(block[mine])]))
        return _bits(some["bits"], some["n"].to_numpy()) if len(mine) else np.zeros(0, bool)

    def candidates(w: _Windows, replies: pa.Table):
        """Windows estimated repeated, in key order: indexes, run starts, keys, smallest doc_id of each run."""
        passed = np.ones(len(w.fast), bool)
        for row in range(ROWS):
            order, at, _ = per_row(w, row)
            if len(at):
                each = np.empty(len(order), bool)
                each[order] = np.repeat(answers(replies, 0, row), _counts(at, len(order)))
                passed &= each
        pick = np.flatnonzero(passed)
        (k1, k2), owner = w.exact(pick), w.owner()[pick]
        order = np.lexsort((owner, k2, k1))
        pick, k1, k2, owner = pick[order], k1[order], k2[order], owner[order]
        at = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))) if len(pick) else np.zeros(0, np.int64)
        return pick, at, k1[at], k2[at], owner[at]

    def keys(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        _, _, k1, k2, low = candidates(windows(table), replies)
        block = (k1 >> np.uint64(64 - key_bits)).astype(np.int64) if key_bits else np.zeros(len(k1), np.int64)
        first = _runs(block)
        n = _counts(first, len(block)) if len(first) else first
        return _table(_KEYS, block[first], np.full(len(first), key[0].as_py()), n, _messages(k1, n), _messages(k2, n), _messages(_narrow(low), n))

    def group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n = table["n"].to_numpy()
        k1, k2, low = (_numbers(table[c], n) for c in ("k1", "k2", "low"))
        order = np.lexsort((low, k2, k1))
        a, b = k1[order], k2[order]
        at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        least = np.empty(len(order), np.int64)
        least[order] = np.repeat(low[order][at], _counts(at, len(order)))
        here = np.full(len(n), key[0].as_py())
        return _table(_REPLY, table["chunk"].to_numpy(), np.ones(len(n), np.int32), here, n, _bit_messages(least < low, n))

    def clean(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        w = windows(table)
        pick, at, _, _, low = candidates(w, replies)
        runs = _counts(at, len(pick)) if len(at) else at
        hit = pick[np.repeat(answers(replies, 1), runs) | (w.owner()[pick] > np.repeat(low, runs))]
        edge = np.zeros(len(w.starts) + 1, np.int64)
        np.add.at(edge, w.at[hit], 1)
        np.add.at(edge, w.at[hit] + width, -1)
        gone = np.cumsum(edge)[:-1] > 0
        n_docs = len(w.ids)
        n_words, n_gone = np.bincount(w.doc, minlength=n_docs), np.bincount(w.doc[gone], minlength=n_docs)
        first, kept, edges = np.concatenate([[0], np.cumsum(n_words)]), [], w.offsets.tolist()
        for i in range(n_docs):
            line = w.raw[edges[i] : edges[i + 1] - 1]
            if n_gone[i]:
                line = b" ".join(compress(line.split(), ~gone[first[i] : first[i + 1]]))
            kept.append(line.decode("utf-8", "surrogatepass"))
        out = table.select(columns)
        for name, values in zip(new, (pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, pa.string())), strict=True):
            out = out.append_column(name, values)
        return out

    by_chunk = dealt.groupBy(chunk)
    marks = by_chunk.applyInArrow(sketch, _ddl(_SKETCH)).groupBy("block").applyInArrow(merge, _ddl(_REPLY))
    found = by_chunk.cogroup(marks.groupBy("chunk")).applyInArrow(keys, _ddl(_KEYS)).groupBy("block").applyInArrow(group, _ddl(_REPLY))
    schema = docs.withColumns({new[0]: F.lit(0).cast("long"), new[1]: F.lit(0).cast("long"), new[2]: F.lit("")}).schema
    return by_chunk.cogroup(marks.union(found).groupBy("chunk")).applyInArrow(clean, schema)
