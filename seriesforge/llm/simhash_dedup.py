"""SimHash near-dedup with pivot distance tables.

Documents collapse to distinct fingerprints first, so exact copies cost one partial aggregate. Every distinct
fingerprint gets its row of the pivot distance table once: its Hamming distances to many reference fingerprints, one
byte each. Pairs to look at come from fingerprints that agree on all but ``radius`` of a few bit blocks (any two that
differ in at most ``radius`` bits must agree on the others), dealt out by the agreeing bits; a bucket of agreeing bits that
holds more than a tile is cut into chunks, and pairs of chunks are the tiles. A bucket of very many chunks is dealt once
more, by blocks of the bits in which its own members differ, where that is counted to move fewer rows. Inside a tile rows are in the order of
their distance to the first reference: by the triangle inequality partners lie in a window of ``radius`` around it, pairs
whose rows differ by more than ``radius`` in any other coordinate are discarded too, and survivors are verified by the
distance itself. Links go to the distributed component search.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.components import connected_components, forest
from seriesforge.llm.textkit import ODD, cut, hot_join, mix64, roll, without_join_blooms, word_hashes

SEED = 42
#: Reference fingerprints of the pivot table; a row of it fills three 64-bit integers.
PIVOTS = 24
FAR = ("far0", "far1", "far2")
#: Rows of a chunk; a tile compares one chunk with itself or with another.
TILE = 2048
#: Hot buckets that may be broadcast (bucket key and number of chunks, some 20 bytes each).
MAX_BROADCAST_ROWS = 100_000


def pivots(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(64).integers(0, 1 << 63, n, np.int64).view(np.uint64) * np.uint64(2)


def pivot_rows(fp: np.ndarray) -> np.ndarray:
    """The pivot distance table of some fingerprints, one row of ``PIVOTS`` bytes each, as three integers."""
    return np.ascontiguousarray(np.bitwise_count(fp[:, None] ^ pivots()[None, :]).astype(np.uint8)).view("<i8")


def distances(far: np.ndarray) -> np.ndarray:
    """Rows of three integers as rows of distances."""
    return np.ascontiguousarray(far).view(np.uint8).astype(np.int8)


def majority(h: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the 64-bit hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        ones += np.unpackbits(h[i : i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash: bit i is set if it is set in over half of the shingles' XXH64 (seed 42); no words give zero."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    digest, last = xxhash.xxh64_intdigest, min(shingle, len(words)) - 1
    return majority(np.fromiter((digest(line[starts[i] : ends[i + last] - 1], SEED) for i in range(n)), np.uint64, n))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp bigint) for every row; the unsigned fingerprint is kept in a signed long."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps.view(np.int64))], schema=schema)

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "id bigint, fp bigint")


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks that keep all but ``radius`` of the bit blocks: near fingerprints agree under at least one of them."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return _all_but([((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)], radius)


def _all_but(parts: list[int], radius: int) -> list[int]:
    return [reduce(int.__or__, kept) for kept in combinations(parts, len(parts) - radius)]


def informed_masks(ones: np.ndarray, held: int, radius: int, blocks: int) -> list[int]:
    """Masks as those of ``block_masks`` for ``held`` fingerprints of which ``ones`` have each bit set: the blocks hold equal
    shares of the bits' entropy, so bits that all members share part nothing and count for nothing."""
    p = ones / held
    told = -sum(x * np.log2(np.where(x > 0, x, 1)) for x in (p, 1 - p))
    block = np.minimum(blocks * (np.cumsum(told) - told / 2) / max(told.sum(), 1e-9), blocks - 1).astype(int)
    return _all_but([sum(1 << b for b in np.flatnonzero(block == i).tolist()) for i in range(blocks)], radius)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_pivots(distinct: DataFrame) -> DataFrame:
    """The rows with ``far0`` to ``far2``, the pivot distances of ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = pivot_rows(b.column("fp").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(far[:, c]) for c in range(3)]], names=[*b.schema.names, *FAR])

    return distinct.mapInArrow(run, distinct.withColumns({c: F.lit(0).cast("long") for c in FAR}).schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Whole runs of rows that agree in the key columns, several runs to a table, of rows sorted by them."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
        if not t.num_rows:
            continue
        last = np.logical_and.reduce([(x := t[k].to_numpy()) == x[-1] for k in keys])
        end = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        held = t.slice(end)  # this run may go on in the next batch
        if end:
            yield t.slice(0, end)
    if held is not None and held.num_rows:
        yield held


def _run_numbers(t: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    new = np.logical_or.reduce([(x := t[k].to_numpy())[1:] != x[:-1] for k in keys])
    return np.cumsum(np.concatenate([[0], new]))


def _partners(run: np.ndarray, near: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one run, for all runs at once, distance by distance, while ``near`` (sorted in a run) differs by ``reach`` at most."""
    i, step = np.arange(len(run)), 1
    while True:
        i = i[i + step < len(run)]
        i = i[(run[i] == run[i + step]) & (near[i + step] - near[i] <= reach)]
        if not len(i):
            return
        yield i, i + step
        step += 1


def _either(small: DataFrame) -> DataFrame:
    """The table to join: broadcast below ``MAX_BROADCAST_ROWS`` rows, by shuffle beyond."""
    return F.broadcast(small) if small.count() <= MAX_BROADCAST_ROWS else small


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_TILE = ("m", "k", "m2", "k2", "i", "j")


def _upto(n: Column, start: Column | int = 0) -> Column:
    """start, ..., n - 1 (empty where start is n)."""
    start = start if isinstance(start, Column) else F.lit(start).cast("long")
    return F.when(start < n, F.sequence(start, n - 1)).otherwise(F.array().cast("array<bigint>"))


def _dealt_again(keyed: DataFrame, hot: DataFrame, radius: int, blocks: int, tile_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """Rows of buckets that are dealt again, with ``m2`` and ``k2``, and those buckets' (m, k); None if there are none.

    Dealing costs a copy for each mask and tiling one for each chunk, so only buckets of more chunks than masks come into
    question; the copies that both ways would move are counted, and the lesser wins.
    """
    wide = cut(hot.filter(F.col("parts") > len(block_masks(radius, blocks))))
    if wide.isEmpty():
        return None

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ones = np.stack([b.column(f"b{i}").to_numpy() for i in range(64)], axis=1)
            told = [[_signed(x) for x in informed_masks(o, h, radius, blocks)] for o, h in zip(ones, b.column("held").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("m"), b.column("k"), pa.array(told, pa.list_(pa.int64()))], names=["m", "k", "masks"])

    members = keyed.join(_either(wide), ["m", "k"])
    bits = [F.sum(F.shiftright("fp", i).bitwiseAND(F.lit(1).cast("long"))).alias(f"b{i}") for i in range(64)]
    how = cut(members.groupBy("m", "k").agg(F.count("*").alias("held"), *bits).mapInArrow(masks, "m int, k bigint, masks array<bigint>"))
    second = F.transform("masks", lambda x, i: F.struct(i.alias("m2"), F.col("fp").bitwiseAND(x).alias("k2")))
    finer = keyed.join(_either(how), ["m", "k"]).withColumn("y", F.explode(second)).select("m", "k", "y.m2", "y.k2", "fp", "id", *FAR)
    copies = F.col("held") * F.ceil(F.col("held") / tile_rows)
    moved = finer.groupBy("m", "k", "m2", "k2").agg(F.count("*").alias("held")).groupBy("m", "k").agg(F.sum(copies).alias("moved"))
    better = cut(wide.join(moved, ["m", "k"]).filter(F.col("moved") < copies).select("m", "k"))
    return finer.join(_either(better), ["m", "k"], "left_semi"), better


def near_links(distinct: DataFrame, radius: int = 4, blocks: int | None = None, spanning: bool = False, tile_rows: int = TILE) -> DataFrame:
    """(a, b): ids of distinct fingerprints ``(fp, id)`` that differ in at most ``radius`` bits.

    ``spanning``: a link between two fingerprints that earlier links of their tile already connect is left out, so a
    tight group gives a number of links that is linear in its size; what is reachable stays the same. A pair that agrees
    under several masks may be told more than once.
    """
    table = cut(distinct if FAR[0] in distinct.columns else with_pivots(distinct))
    if blocks is None:
        n = table.count()
        blocks = radius + (2 if n < 1 << 20 else 3 if n < 1 << 26 else 4)
    masks = block_masks(radius, blocks)
    keyed = table.select(
        "fp", "id", *FAR,
        F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("k")) for i, m in enumerate(masks)])).alias("x"),
    ).select("x.m", "x.k", "fp", "id", *FAR)

    def parts(rows: DataFrame, *keys: str) -> DataFrame:
        return cut(rows.groupBy(*keys).agg(F.count("*").alias("held"), F.ceil(F.count("*") / tile_rows).alias("parts")).filter("parts > 1"))

    def chunked(rows: DataFrame, hot: DataFrame, *keys: str) -> DataFrame:
        return rows.join(_either(hot.drop("held")), list(keys), "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))

    hot = parts(keyed, "m", "k")
    again = _dealt_again(keyed, hot, radius, blocks, tile_rows)
    once = keyed.join(_either(again[1]), ["m", "k"], "left_anti") if again else keyed
    split = chunked(once, hot, "m", "k").withColumns({"m2": F.lit(-1), "k2": F.lit(0).cast("long")})
    if again:
        finer = ("m", "k", "m2", "k2")
        split = split.unionByName(chunked(again[0], parts(again[0], *finer), *finer))
    mine = split.withColumn("side", F.pmod(F.xxhash64("fp"), F.col("parts")))
    low = F.transform(_upto(F.col("parts"), F.col("side")), lambda j: F.struct(F.col("side").alias("i"), j.alias("j")))
    high = F.transform(_upto(F.col("side")), lambda i: F.struct(i.alias("i"), F.col("side").alias("j")))
    tiles = mine.withColumn("t", F.explode(F.concat(low, high))).select("m", "k", "m2", "k2", "t.i", "t.j", "side", "fp", "id", *FAR)

    def links(t: pa.Table) -> Iterator[pa.RecordBatch]:
        run = _run_numbers(t, _TILE)
        t = t.filter(pa.array(np.bincount(run)[run] > 1))
        if not t.num_rows:
            return
        run, fp, ids = _run_numbers(t, _TILE), t["fp"].to_numpy().view(np.uint64), t["id"].to_numpy()
        rows, side, within = distances(np.stack([t[c].to_numpy() for c in FAR], axis=1)), t["side"].to_numpy(), t["i"].to_numpy() == t["j"].to_numpy()
        label = np.arange(len(run))
        for x, y in _partners(run, rows[:, 0], radius):
            new = within[x] | (side[x] != side[y])
            if spanning:
                new &= label[x] != label[y]
            x, y = x[new], y[new]
            near = np.abs(rows[x] - rows[y]).max(axis=1, initial=0) <= radius
            x, y = x[near], y[near]
            same = np.bitwise_count(fp[x] ^ fp[y]) <= radius
            x, y = x[same], y[same]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y])], schema=_PAIR)
                if spanning:
                    label = forest(len(run), label[x], label[y])[label]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, _TILE):
            yield from links(t)

    ordered = tiles.repartition(*_TILE).sortWithinPartitions(*_TILE, F.col("far0").bitwiseAND(F.lit(255).cast("long")))
    return ordered.mapInArrow(run, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """(id, fp, component): the SimHash of every row and the smallest id reachable by links of at most ``radius`` bits.

    Null and empty texts have fingerprint zero, linked like any other. Rows that repeat an id are all returned. A
    null id takes no part in naming a group: its component is the smallest non-null id it reaches, or null.
    """
    rows = cut(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    counted = cut(rows.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("held")))
    distinct = counted.select("fp", "id")
    named = distinct.filter("id IS NOT NULL")
    # fingerprints met only in rows without an id still carry links, under stand-in ids above all others
    links = near_links(with_pivots(distinct.withColumn("id", F.col("fp"))), radius, spanning=True)
    parts = connected_components(links)
    least = parts.join(named, parts["node"] == named["fp"]).groupBy("component").agg(F.min("id").alias("least"))
    label = parts.join(least, "component").select(F.col("node").alias("fp"), "least")
    group = counted.join(label, "fp", "left").select("fp", F.coalesce("least", "id").alias("component"), "held")
    return hot_join(rows, group, "fp", "held", rows.count()).select("id", "fp", "component")


#: Candidate keys of ``similar_groups``: bands of least hashes; a pair of similarity 0.8 misses them all with
#: a chance of (1 - 0.8**4)**14 < 0.001, one of 0.9 with less than 1e-6.
BANDS, BAND_ROWS = 14, 4
#: Fingerprint radius that the pivot table tests there. Those fingerprints are of the distinct shingles, as the similarity
#: is: at 0.8 a bit differs with a chance of 0.152 in long texts and of at most 0.1875 (4 and 5 shingles), so more than
#: 28 of 64 differ with a chance below 1e-8, and of 1.1e-6 at most.
WIDE_RADIUS = 28


#: Members and shingles of a chunk of a hub's group; a tile holds two chunks at most.
CHUNK_ROWS, CHUNK_SHINGLES = 512, 1 << 19


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Distinct 64-bit hashes of the lower-cased word shingles (fewer words: the whole sequence; none: none)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(roll(word_hashes(words), min(shingle, len(words)))) if words else np.zeros(0, np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the Jaccard similarity of each pair of sets reaches ``similarity``: few pairs one by one, many by
    products of blocks of the 0/1 membership matrix."""
    if len(i) <= 2 * len(sets):
        return np.array([jaccard(sets[x], sets[y]) >= similarity for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)
    size = np.array(list(map(len, sets)))
    row = np.repeat(np.arange(len(sets)), size)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1  # members of one set alone are in no intersection
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        member = np.zeros((len(sets), 4096), np.float32)
        member[row[a:b], column[a:b] - start] = 1
        both += member @ member.T
    inside = both[i, j].astype(np.float64)
    return inside >= similarity * np.maximum(size[i] + size[j] - inside, 1) - 1e-9


@without_join_blooms
def similar_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(id, component) of the documents that have a near copy: Jaccard similarity of word shingles of 0.8 or more.

    Documents with one set of shingles collapse to the smallest id. A SimHash of the distinct shingles differs in about
    ten of 64 bits at that similarity, too many for blocks of agreeing bits, so candidates share a band of least
    shingle hashes. All that share a band bucket meet in the group of its smallest id, the hub, so a document is sent
    once per hub, not once per band. Groups are cut into chunks of bounded size, each with the hub in it. Inside a
    chunk the pivot distances and then the fingerprints discard pairs that cannot be near, and the survivors' whole
    texts are compared, with the hub first and then all pairs not yet connected; a chunk returns a spanning forest
    of its links, never a row per pair. In groups of several chunks the members that did not join their hub are then
    compared with all members of the other chunks that are not in their component. So every pair that shares a bucket is tested
    or already connected. Texts without words and null ids take no part; an input of one row per id is expected
    (further rows of an id follow its first).
    """
    rows_per = BANDS * BAND_ROWS
    keys = np.random.default_rng(5).integers(1, 1 << 62, rows_per, np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
    sized = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64()), *[(c, pa.int64()) for c in FAR], ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("same", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fps, sizes, bands, sets = [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = shingle_hashes(text, shingle)
                if not len(h):
                    continue
                least = np.full(rows_per, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(h), 2048):
                    part = h[at : at + 2048, None] * keys[None, :]
                    least = np.minimum(least, (part ^ (part >> np.uint64(29))).min(axis=0))
                key = mix64(least.reshape(BANDS, BAND_ROWS) * ODD)
                for k in range(1, BAND_ROWS):
                    key[:, 0] = mix64(key[:, 0] * ODD + key[:, k])
                ids.append(i), fps.append(majority(h)), sizes.append(len(h)), bands.append(key[:, 0].view(np.int64).tolist())
                sets.append(xxhash.xxh3_128_digest(h.tobytes()))
            fp = np.array(fps, np.uint64)
            columns = (ids, fp.view(np.int64), *pivot_rows(fp).T, sizes, bands, sets)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def forest_of(t: pa.Table, across: bool) -> pa.RecordBatch:
        """Spanning links of one chunk, or between the strays and the members of a pair of chunks."""
        ids, fp, size = t["id"].to_numpy(), t["fp"].to_numpy().view(np.uint64), t["n"].to_numpy()
        rows = distances(np.stack([t[c].to_numpy() for c in FAR], axis=1))
        if across:
            stray, group = t["stray"].to_numpy() == 1, t["group"].to_numpy()
            one, two = np.flatnonzero(stray), np.flatnonzero(~stray)
        else:
            one = two = np.arange(len(ids))
        near = np.ones((len(one), len(two)), bool)
        for c in range(PIVOTS):
            near &= np.abs(rows[one, c][:, None] - rows[two, c][None, :]) <= WIDE_RADIUS
        near &= np.bitwise_count(fp[one][:, None] ^ fp[two][None, :]) <= WIDE_RADIUS
        near &= np.minimum(size[one][:, None], size[two][None, :]) >= similarity * np.maximum(size[one][:, None], size[two][None, :])
        near &= (group[one][:, None] != group[two][None, :]) if across else (one[:, None] < two[None, :])
        i, j = np.nonzero(near)
        i, j = one[i], two[j]
        used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        if not len(used):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, schema=_PAIR)
        i, j = at[: len(i)], at[len(i) :]
        texts, same = t["text"].take(pa.array(used)).to_pylist(), t["same"].take(pa.array(used)).to_pylist()
        sets = [shingle_hashes(x, shingle) for x in texts]
        # another row of the same id has another set; it is not the one that was signed
        signed = np.array([xxhash.xxh3_128_digest(h.tobytes()) == s for h, s in zip(sets, same, strict=True)])
        valid = signed[i] & signed[j]
        i, j = i[valid], j[valid]
        label = np.arange(len(used))
        if not across:
            hub = ids[used] == t["hub"][0].as_py()
            first = hub[i] | hub[j]
            on = similar(sets, i[first], j[first], similarity)
            label = forest(len(used), i[first][on], j[first][on])
            rest = ~first & (label[i] != label[j])
            i, j = i[rest], j[rest]
        on = similar(sets, i, j, similarity)
        label = forest(len(used), label[i[on]], label[j[on]])[label]
        moved = np.flatnonzero(label != np.arange(len(used)))
        return pa.RecordBatch.from_arrays([pa.array(ids[used[moved]]), pa.array(ids[used[label[moved]]])], schema=_PAIR)

    def tiled(keys: tuple[str, ...], across: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in sorted_groups(batches, keys):
                edges = np.flatnonzero(np.diff(_run_numbers(t, keys))) + 1
                for a, b in zip([0, *edges], [*edges, t.num_rows], strict=True):
                    if b - a > 1:
                        yield forest_of(t.slice(a, b - a), across)

        return run

    signed = cut(sized.mapInArrow(sign, f"id bigint, fp bigint, {', '.join(f'{c} bigint' for c in FAR)}, n bigint, keys array<bigint>, same binary"))
    copies = cut(signed.groupBy("same").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("fp", *FAR, "n", "keys")], F.count("*").alias("held")))
    keyed = copies.select("id", "n", F.posexplode("keys").alias("band", "key"))
    total = copies.count()

    buckets = keyed.groupBy("band", "key").agg(F.min("id").alias("hub"), F.count("*").alias("held")).filter("held > 1")
    members = cut(hot_join(keyed, buckets, ["band", "key"], "held", BANDS * total).select("hub", "id", "n").distinct())
    cost = F.greatest(F.count("*") / chunk_rows, F.sum("n") / CHUNK_SHINGLES)
    hubs = members.groupBy("hub").agg(F.count("*").alias("held"), F.ceil(cost).alias("parts"))
    placed = cut(hot_join(members, hubs, "hub", "held", members.count()).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))))
    told = copies.select("id", "fp", *FAR, "n", "same")

    def with_texts(tiles: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        return tiles.join(told, "id").join(sized, "id").repartition(*keys).sortWithinPartitions(*keys, "id")

    chunk = F.when(F.col("id") == F.col("hub"), _upto(F.col("parts"))).otherwise(F.array("part"))
    chunks = with_texts(placed.select("hub", "id", F.explode(chunk).alias("part")), ("hub", "part"))
    links = cut(chunks.mapInArrow(tiled(("hub", "part"), False), "a bigint, b bigint"))
    groups = connected_components(links)

    # groups of several chunks; a stray is a member outside the hub's component
    large = placed.filter("parts > 1")
    if not large.isEmpty():
        known = cut(large.join(groups, large["id"] == groups["node"], "left").select("hub", "id", "parts", "part", "n", F.coalesce("component", "id").alias("group")))
        first = known.filter("id = hub").select("hub", F.col("group").alias("first"), (F.col("parts") * chunk_rows).alias("held"))
        apart = cut(hot_join(known, first, "hub", "held", known.count()))
        strays = apart.filter(F.col("group") != F.col("first"))
        counts = cut(strays.groupBy("hub").agg(F.count("*").alias("held"), F.ceil(cost).alias("stray_parts")))
        open_ = hot_join(apart, counts, "hub", "held", known.count()).withColumn("mine", F.pmod(F.xxhash64("id", F.lit(1)), F.col("stray_parts")))
        kind = ("hub", "id", "group")
        every = open_.select(*kind, F.col("part").alias("i"), F.explode(_upto(F.col("stray_parts"))).alias("j"), F.lit(0).alias("stray"))
        others = F.filter(_upto(F.col("parts")), lambda i: i != F.col("part"))  # its own chunk has compared it
        some = open_.filter(F.col("group") != F.col("first")).select(*kind, F.explode(others).alias("i"), F.col("mine").alias("j"), F.lit(1).alias("stray"))
        pairs = with_texts(every.union(some), ("hub", "i", "j"))
        more = pairs.mapInArrow(tiled(("hub", "i", "j"), True), "a bigint, b bigint")
        groups = connected_components(links.union(more))

    final = copies.join(groups, copies["id"] == groups["node"], "left").filter("component IS NOT NULL OR held > 1")
    named = cut(final.select("same", F.coalesce("component", "id").alias("component"), "held"))
    return hot_join(signed.select("id", "same"), named, "same", "held", total).select("id", "component").groupBy("id").agg(F.min("component").alias("component"))
