"""Variable-capacity best-fit packing of token sequences.

Documents are dealt by a fixed row number into packing groups of bounded size, and every group is packed on its
own, so groups are the unit of parallel work and of recovery. Inside a group pieces go, longest first, into the open
bin with the least room that still holds them. Where none does, the bin size that costs least per token it can
expect to hold is opened. Which of the permitted lengths may be opened is optimised jointly: every choice of lengths
is packed and the cheapest whole packing wins. At last each bin shrinks to the smallest length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.textkit import cut, unused

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Rows of a packing group; cost of a bin of c tokens is c + BIN_COST + c*c / ATTENTION.
GROUP_ROWS, BIN_COST, ATTENTION = 16_384, 64.0, 131_072.0
#: Tasks that the groups are dealt to, unless the session asks for more shuffle partitions.
MAX_TASKS = 1024


def bin_cost(c: int) -> float:
    return c + BIN_COST + c * c / ATTENTION


def best_fit(sizes: list[int], opened: tuple[int, ...], lengths: tuple[int, ...]) -> tuple[float, list[int], list[int], list[int]]:
    """Pack sizes (descending, each at most the largest opened length): cost, bin and offset per item, bin lengths.

    Opens only ``opened`` lengths; final lengths come from all ``lengths``.
    """
    costs = [(c, bin_cost(c)) for c in opened]
    rooms: list[int] = []
    by_room: dict[int, list[int]] = {}
    used: list[int] = []
    bins, offsets, left = [], [], sum(sizes)
    for x in sizes:
        i = bisect_left(rooms, x)
        if i < len(rooms):
            room = rooms[i]
            k = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                del rooms[i]
        else:
            room = min((cost / min(c, left), c) for c, cost in costs if c >= x)[1]
            k = len(used)
            used.append(0)
        bins.append(k)
        offsets.append(used[k])
        used[k] += x
        left -= x
        room -= x
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append(k)
    final = [lengths[bisect_left(lengths, u)] for u in used]
    return sum(map(bin_cost, final)), bins, offsets, final


def pack(sizes: list[int], lengths: tuple[int, ...]) -> tuple[float, list[int], list[int], list[int]]:
    """The cheapest best-fit packing over all sets of lengths that may be opened (the largest always may)."""
    top, rest = lengths[-1], lengths[:-1]
    choices = [(*c, top) for n in range(len(rest) + 1) for c in combinations(rest, n)]
    return min((best_fit(sizes, c, lengths) for c in choices), key=lambda p: p[0])


_OUT = pa.schema([
    ("_row", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("bin", pa.int64()), ("bin_offset", pa.int64()), ("bin_length", pa.int64()),
])


def pack_sequences(docs: DataFrame, *, size_col: str = "n_tokens", lengths: tuple[int, ...] = LENGTHS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All columns of ``docs`` and one row per piece: piece, start, length, bin, bin_offset, bin_length.

    A document longer than the largest length gives full pieces of that length and a rest; every token is in exactly
    one piece, and pieces in one bin never overlap. Documents of size zero or null keep one row, of length 0 and
    without a bin. Repeated rows are packed one by one. Input columns of the output names are replaced (``size_col`` may
    be one of them: its values are taken first); all others, whatever their names, are kept. Which group a row is packed in,
    and so its bin, follows the layout of the input.
    """
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    kept = [c for c in docs.columns if c.lower() not in {f.name for f in list(_OUT)[1:]}]
    row, held = unused(docs.columns, "_row"), unused(docs.columns, "_size")
    rows = cut(docs.select(*[docs[c] for c in kept], F.coalesce(F.col(size_col).cast("long"), F.lit(0)).alias(held), F.monotonically_increasing_id().alias(row)))
    groups = max(1, -(-rows.count() // group_rows))
    sized = rows.select(F.col(row).alias("_row"), F.col(held).alias("_size"), F.pmod(F.xxhash64(row), F.lit(groups)).alias("_group"))

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        order = np.lexsort((t["_row"].to_numpy(), -t["_size"].to_numpy()))
        row, size = t["_row"].to_numpy()[order], np.maximum(t["_size"].to_numpy()[order], 0)
        full, rest = size // top, size % top
        # full pieces fill a bin each; then the rests, longest first; then the empty documents
        f_row, f_piece = np.repeat(row, full), np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
        order = np.lexsort((row, -rest))
        row, full, rest, size = row[order], full[order], rest[order], size[order]
        some = rest > 0
        _, bins, offsets, final = pack(rest[some].tolist(), lengths)
        empty = size == 0
        n_full, n_empty = len(f_row), int(empty.sum())
        first = key[0].as_py() << 32
        join = np.concatenate
        ids = first + np.array([*range(len(final), len(final) + n_full)], np.int64)
        packed = first + np.array(bins, np.int64)
        holds = np.array(final, np.int64)[np.array(bins, np.int64)]
        bin_ids = pa.array(join([ids, packed, np.zeros(n_empty, np.int64)]), mask=join([np.zeros(n_full + len(bins), bool), np.ones(n_empty, bool)]))
        held = pa.array(join([np.full(n_full, top), holds, np.zeros(n_empty, np.int64)]), mask=join([np.zeros(n_full + len(bins), bool), np.ones(n_empty, bool)]))
        zero = np.zeros(n_full + n_empty, np.int64)
        return pa.Table.from_arrays([
            pa.array(join([f_row, row[some], row[empty]])),
            pa.array(join([f_piece, full[some], zero[:n_empty]])),
            pa.array(join([f_piece * top, full[some] * top, zero[:n_empty]])),
            pa.array(join([np.full(n_full, top), rest[some], zero[:n_empty]])),
            bin_ids,
            pa.array(join([zero[:n_full], np.array(offsets, np.int64), zero[:n_empty]])),
            held,
        ], schema=_OUT)

    # a number of partitions of our own: each holds few groups, and small tables still use many tasks
    spread = sized.repartition(min(groups, max(MAX_TASKS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "_group")
    pieces = spread.groupBy("_group").applyInArrow(run, ", ".join(f"{f.name} bigint" for f in _OUT))
    return rows.join(pieces.withColumnRenamed("_row", row), row).drop(row, held)
