"""Resampled rank correlations: bootstrap over whole names, permutations of names or rows.

Every draw is a hash of (replicate, unit), so it depends on neither layout nor path. Replicates are the unit of work: a task
has the rows of all names once, as flat arrays, computes one replicate after the other, and only one row of each leaves it. Up to ``ROWS``
rows, a size that is counted first, the arrays travel as a broadcast. Up to ``HELD`` rows a Cartesian product with the tasks hands each
task the written chunks of rows: nothing passes the driver, and no row is shuffled for a replicate. Larger frames stay where they are:
replicates are then ordered by ranges of the hash and joined. Draws and results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.lineage import written
from seriesforge.operators import ranks

#: Rows that are broadcast (about 32 bytes each), and tasks that share the replicates.
ROWS, TASKS = 1_000_000, 64
#: Rows that a task holds (some 50 bytes each while it computes), and rows of a chunk that it is handed, a power of two by its
#: bits: an Arrow batch takes 10,000 chunks.
HELD, CHUNK_BITS = 1 << 23, 6
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def _hash_long(x: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """XXH64 of 8-byte integers, as ``xxhash64`` gives it for a bigint column."""
    h = np.asarray(seed).astype(np.uint64) + _P5 + np.uint64(8)
    h = h ^ (_rotated(np.asarray(x).astype(np.int64).view(np.uint64) * _P2, 31) * _P1)
    return _mixed(_rotated(h, 27) * _P1 + _P4)


def _hash_int(x: int, seed: np.ndarray) -> np.ndarray:
    h = seed + _P5 + np.uint64(4)
    h = h ^ (np.array([x], np.int64).view(np.uint64) & np.uint64(0xFFFFFFFF)) * _P1
    return _mixed(_rotated(h, 23) * _P2 + _P3)


def hashed(seed: int, *columns: np.ndarray) -> np.ndarray:
    """``xxhash64(columns..., seed)`` of bigint columns and an int, as signed integers."""
    h: np.ndarray | int = 42
    with np.errstate(over="ignore"):
        for c in columns:
            h = _hash_long(c, h)
        return _hash_int(seed, h).view(np.int64)


def hashed_order(k: int, n: int, seed: int, bits: int | None = None) -> np.ndarray:
    """The numbers below ``n`` in the order of ``xxhash64(k, number, seed)``, equal hashes in their own order.

    The lowest ``bits`` of a hash give way to the number, so that values are sorted instead of places; the few that agree
    in the others are put in order afterwards.
    """
    bits, step = n.bit_length() if bits is None else bits, 1 << 16
    key, alike = np.empty(n, np.int64), []
    for a in range(0, n, step):
        number = np.arange(a, min(n, a + step))
        key[a : a + step] = hashed(seed, np.array([k]), number) >> bits << bits | number
    key.sort()
    for a in range(0, n, step):
        top = key[a : a + step + 1] >> bits
        alike.append(a + np.flatnonzero(top[1:] == top[:-1]))
    key &= (1 << bits) - 1
    at = np.concatenate([np.zeros(0, np.int64), *alike])
    if len(at):
        at = np.unique(np.concatenate([at, at + 1]))
        key[at] = key[at][np.lexsort((key[at], hashed(seed, np.array([k]), key[at])))]
    return key


def joined_blocks(sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Places of the members of consecutive blocks of these sizes when the blocks follow each other in another order."""
    held, first = sizes[order].astype(np.int64), (np.cumsum(sizes) - sizes)[order]
    at = np.repeat((first - (np.cumsum(held) - held)).astype(np.int32), held)
    at += np.arange(len(at), dtype=np.int32)
    return at


def product_sum(a: np.ndarray, b: np.ndarray) -> int:
    """The exact sum of products of two arrays of integers from 0, in parts that cannot overflow."""
    step = max(1, ((1 << 63) - 1) // max(1, int(a.max(initial=0)) * int(b.max(initial=0))))
    return sum(int(a[i : i + step].astype(np.int64) @ b[i : i + step].astype(np.int64)) for i in range(0, len(a), step))


def _codes(values: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """(code from 0 in the order of the values, number of codes, the places in that order)."""
    order, n = np.argsort(values), len(values)
    held = values[order]
    del values  # where the caller has given it up, it goes here
    new = held[1:] != held[:-1]
    new[len(new) + 1 - max(1, int(np.isnan(held).sum())) :] = False  # NaN, the last, equals NaN
    del held
    code = np.zeros(n, np.int32)
    code[order[1:]] = np.cumsum(new, dtype=np.int32)
    return code, int(code.max(initial=-1)) + 1, order


def doubled_ranks(code: np.ndarray, n: int) -> np.ndarray:
    """Twice the average rank, an integer."""
    held = np.bincount(code, minlength=n)
    return (2 * (np.cumsum(held) - held) + held + 1)[code]


def _numbered(scored: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows that have both values, with ``_unit`` (the name's number from 0 in order), written; rows and names."""
    rows = written(scored.filter(F.col("y").isNotNull() & F.col("yhat").isNotNull()), "scored")
    names = written(ranks.positions(rows.select("name").distinct(), ["name"], "_unit").withColumn("_unit", F.col("_unit") - 1), "names")
    told = rows.withColumnRenamed("name", "_name").join(names, F.col("_name").eqNullSafe(F.col("name"))).drop("_name")
    return told, rows.count(), names.count()


def _collected(rows: DataFrame, columns: list[str]) -> list[np.ndarray]:
    """Units and columns of a frame of at most ``ROWS`` rows, in the order of name and date."""
    t = rows.select("_unit", "t", *columns).toArrow().sort_by([("_unit", "ascending"), ("t", "ascending"), *[(c, "ascending") for c in columns]])
    return [t["_unit"].to_numpy().astype(np.int32), *[t[c].to_numpy() for c in columns]]


def _packed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each chunk of rows that follow each other in that order: its place (_part, _chunk) and an array of each column; written."""
    flat = ["_unit", *columns]
    slim = rows.select(F.col("_unit").cast("int").alias("_unit"), "t", *columns)
    chunks = ranks.placed(slim, ["_unit", "t", *columns]).groupBy("_part", F.shiftright("_i", CHUNK_BITS).alias("_chunk"))
    held = chunks.agg(F.array_sort(F.collect_list(F.struct("_i", *flat))).alias("x"))
    return written(held.select("_part", "_chunk", *[F.col(f"x.{c}").alias(c) for c in flat]), "packed")


def _replicates(rows: DataFrame, columns: list[str], b: int, build: Callable[..., Callable[[int], tuple]], ddl: str, schema: pa.Schema, broadcast: bool) -> DataFrame:
    """What ``build([units, columns...])`` tells of each replicate."""
    spark, tasks = rows.sparkSession, min(b, TASKS)

    def told(one: Callable[[int], tuple], ks: list[int] | range) -> pa.RecordBatch:
        out = list(zip(*[one(k) for k in ks], strict=True)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    if broadcast:
        shared = spark.sparkContext.broadcast(_collected(rows, columns))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one = build(list(shared.value))
            for batch in batches:
                yield told(one, batch.column(0).to_pylist())

        return spark.range(0, b, 1, tasks).mapInArrow(run, ddl)

    packed = _packed(rows, columns)
    chunks = packed.count()

    def run_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = set(), []
        for batch in batches:
            own |= set(pc.unique(batch.column(0)).to_pylist())
            place, sizes = [batch.column(c).to_numpy() for c in (1, 2)], pc.list_value_length(batch.column(3)).to_numpy()
            parts.append([*place, sizes, *[np.array(c.flatten().to_numpy(zero_copy_only=False)) for c in batch.columns[3:]]])  # copies, so that the batch can go
            del batch
        if not own:
            return
        part, chunk, sizes = (np.concatenate([p.pop(0) for p in parts]) for _ in range(3))
        if len(own) > 1 or len(sizes) != chunks:
            raise ValueError(f"a task was handed {len(sizes)} of {chunks} chunks for {len(own)} shares of the replicates")
        order = np.lexsort((chunk, part))
        places, arrays = joined_blocks(sizes[order], np.argsort(order)), []  # where each row belongs
        while parts[0]:
            arrays.append(np.empty(len(places), parts[0][0].dtype))
            at = 0
            for values in (p.pop(0) for p in parts):
                arrays[-1][places[at : at + len(values)]] = values
                at += len(values)
        del places, values
        one = build(arrays)
        share = own.pop()
        for k in range(share * b // tasks, (share + 1) * b // tasks):
            yield told(one, [k])

    # one row of the left side in each task, and one partition on the right, which such a task reads once
    shares = spark.range(0, tasks, 1, tasks)
    return shares.crossJoin(packed.coalesce(1).hint("shuffle_replicate_nl")).mapInArrow(run_packed, ddl)


def _intervals(long: DataFrame) -> DataFrame:
    q = F.percentile("v", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))  # one value per replicate
    return long.groupBy("metric").agg(q.alias("q")).select("metric", *[F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("lo", "median", "hi"))])


def _bootstrap_of(n: int, seed: int) -> Callable[..., Callable[[int], tuple]]:
    def build(arrays: list[np.ndarray]) -> Callable[[int], tuple]:
        """From units, y, yhat and persistence, which are given up."""
        sums, step = np.zeros((5, n)), 1 << 18
        for i in range(0, len(arrays[0]), step):
            unit, y, p, persistence = (v[i : i + step] for v in arrays)
            e, f = y - p, np.nan_to_num(y - persistence)
            sums += [np.bincount(unit, v, n) for v in (np.ones(len(y)), y, y * y, e * e, f * f)]
            del unit, y, p, persistence  # views, which keep the arrays
        arrays.pop()
        cp, np_ = _codes(arrays.pop())[:2]
        cy, ny, by_y = _codes(arrays.pop())  # in this order only the forecast's ranks are looked up here and there
        unit, cy, cp = arrays.pop()[by_y], cy[by_y], cp[by_y]
        first = np.searchsorted(cy, np.arange(ny, dtype=np.int32))
        del by_y

        def weighted_ranks(held: np.ndarray) -> tuple[float, np.ndarray, float, float]:
            """(rows, average rank of each value, their sum, their squared deviations) where a value counts as often as it is held."""
            r = np.cumsum(held)
            m = float(r[-1])
            held *= 0.5
            r -= held
            r += 0.5
            total = 2 * float(held @ r)
            held *= r
            return m, r, total, 2 * float(held @ r) - total * total / m

        def one(k: int) -> tuple:
            if not n:
                return None, None, None
            times = np.bincount(hashed(seed, k * n + np.arange(n)) % n, minlength=n).astype(float)
            w = times[unit]
            held = np.add.reduceat(w, first)
            if np.count_nonzero(held) < 3:
                return None, None, None
            m, ry, a, spread_y = weighted_ranks(held)
            del held
            held = np.bincount(cp, w, np_)
            del w
            _, rp, q, spread_p = weighted_ranks(held)
            spread, step = spread_y * spread_p, 1 << 16
            both = sum(float((times[unit[i : i + step]] * ry[cy[i : i + step]]) @ rp[cp[i : i + step]]) for i in range(0, len(unit), step))
            rows, sy, syy, see, spp = sums @ times
            total = syy - sy * sy / rows
            return (both - a * q / m) / spread**0.5 if spread > 0 else None, 1 - see / total if total else None, 1 - see / max(spp, 1e-9)

        return one

    return build


def cluster_bootstrap(scored: DataFrame, b: int = 2000, seed: int = 11, rows_bound: int = ROWS, held_bound: int = HELD) -> DataFrame:
    """(metric, lo, median, hi): resamples of whole names; each replicate draws as many names as there are.

    Draw s of replicate k is name ``pmod(xxhash64(k * names + s, seed), names)``. Replicates with fewer than three distinct
    targets are left out. Rows without y or yhat are not counted.
    """
    rows, n_rows, n = _numbered(scored)
    if n_rows > max(rows_bound, held_bound):
        return _intervals(_bootstrap_joined(rows, n, b, seed))
    schema = pa.schema([(c, pa.float64()) for c in ("spearman", "r2", "skill")])
    told = _replicates(rows, ["y", "yhat", "persistence"], b, _bootstrap_of(n, seed), "spearman double, r2 double, skill double", schema, n_rows <= rows_bound)
    told = told.filter("skill IS NOT NULL")
    return _intervals(told.select(F.explode(F.create_map(*[x for c in schema.names for x in (F.lit(c), F.col(c))])).alias("metric", "v")))


def _weighted_ranks(drawn: DataFrame, column: str, part: str, out: str) -> DataFrame:
    """All columns plus the average rank of ``column`` in each replicate b, where a row counts m times; ``part``: its value range."""
    per = drawn.groupBy("b", part, column).agg(F.sum("m").alias("_n"))
    over = Window.partitionBy("b").orderBy(part)
    offsets = per.groupBy("b", part).agg(F.sum("_n").alias("_t")).select("b", part, (F.sum("_t").over(over) - F.col("_t")).alias("_o"))
    inside = F.sum("_n").over(Window.partitionBy("b", part).orderBy(column))
    told = per.withColumn("_c", inside).join(offsets, ["b", part]).select("b", part, column, (F.col("_o") + F.col("_c") - (F.col("_n") - 1) / 2).alias(out))
    return drawn.join(told, ["b", part, column])


def _value_range(df: DataFrame, column: str, out: str, n: int = 64) -> DataFrame:
    edges = sorted(set(df.approxQuantile(column, [i / n for i in range(1, n)], 0.01)))
    return df.withColumn(out, F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col(column))) if edges else F.lit(0))


def _bootstrap_joined(rows: DataFrame, n: int, b: int, seed: int) -> DataFrame:
    """(metric, v): the replicates by joins; ranks are taken inside (replicate, value range) over rows that count as often as drawn."""
    e, p = F.col("y") - F.col("yhat"), F.col("y") - F.col("persistence")
    sums = rows.groupBy("_unit").agg(F.count("*").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") ** 2).alias("syy"), F.sum(e * e).alias("see"), F.coalesce(F.sum(p * p), F.lit(0.0)).alias("spp"))
    draws = rows.sparkSession.range(b * n).select(F.floor(F.col("id") / n).alias("b"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int").alias("_unit"))
    times = draws.groupBy("b", "_unit").agg(F.count("*").alias("m"))
    cut = _value_range(_value_range(rows.select("_unit", "y", "yhat"), "y", "_ry"), "yhat", "_rp")
    drawn = times.join(cut, "_unit").select("b", "m", "y", "yhat", "_ry", "_rp")
    ranked = _weighted_ranks(_weighted_ranks(drawn, "y", "_ry", "ry"), "yhat", "_rp", "rp")
    m, ry, rp = F.col("m"), F.col("ry"), F.col("rp")
    sums_ranked = ranked.groupBy("b").agg(
        F.sum(m).alias("k"), F.sum(m * ry).alias("a"), F.sum(m * rp).alias("p"), F.sum(m * ry * rp).alias("ap"), F.sum(m * ry * ry).alias("aa"), F.sum(m * rp * rp).alias("pp")
    )
    spread = (F.col("aa") - F.col("a") ** 2 / F.col("k")) * (F.col("pp") - F.col("p") ** 2 / F.col("k"))
    rho = sums_ranked.select("b", F.when(spread > 0, (F.col("ap") - F.col("a") * F.col("p") / F.col("k")) / F.sqrt(spread)).alias("rho"))
    varied = drawn.groupBy("b").agg(F.count_distinct("y").alias("distinct_y")).filter("distinct_y >= 3").select("b")
    per = times.join(sums, "_unit").groupBy("b").agg(*[F.sum(F.col("m") * F.col(c)).alias(c) for c in ("n", "sy", "syy", "see", "spp")])
    r2 = 1 - F.col("see") / F.nullif(F.col("syy") - F.col("sy") ** 2 / F.col("n"), F.lit(0.0))
    told = F.create_map(F.lit("spearman"), F.col("rho"), F.lit("r2"), r2, F.lit("skill"), 1 - F.col("see") / F.greatest("spp", F.lit(1e-9)))
    return per.join(rho, "b").join(varied, "b").select(F.explode(told).alias("metric", "v"))


def _permutation_of(blocks: bool, n: int, seed: int) -> Callable[..., Callable[[int], tuple]]:
    def build(arrays: list[np.ndarray]) -> Callable[[int], tuple]:
        rp, ry = (doubled_ranks(*_codes(arrays.pop())[:2]).astype(np.int32) for _ in range(2))
        sizes = np.bincount(arrays.pop(), minlength=n)
        size = len(ry)
        seen = product_sum(ry, rp)
        spread = (ry.astype(float).var() * rp.astype(float).var()) ** 0.5 if size else 0.0
        observed = float(np.mean((ry - ry.mean()) * (rp - rp.mean())) / spread) if spread else None

        def one(k: int) -> tuple:
            order = hashed_order(k, len(sizes) if blocks else size, seed)
            if blocks:
                order = joined_blocks(sizes, order)
            return product_sum(ry[order], rp) >= seen, observed

        return one

    return build


def permutation_p(scored: DataFrame, b: int = 2000, blocks: bool = True, seed: int = 11, rows_bound: int = ROWS, held_bound: int = HELD) -> DataFrame:
    """(observed, p): share of permutations with at least the observed rank correlation, one added to both sides.

    ``blocks``: whole names' targets change places (concatenated in the drawn order); else single rows do. Ranks are
    taken once; a replicate k pairs them anew in the order of ``xxhash64(k, unit, seed)``, units being names or rows
    numbered from 0. Correlations of one frame are compared by their sums of products of ranks, which are exact.
    """
    rows, n_rows, n = _numbered(scored)
    if n_rows > max(rows_bound, held_bound):
        return _permuted_joined(rows, b, blocks, seed)
    schema = pa.schema([("more", pa.bool_()), ("observed", pa.float64())])
    told = _replicates(rows, ["y", "yhat"], b, _permutation_of(blocks, n, seed), "more boolean, observed double", schema, n_rows <= rows_bound)
    return told.agg(F.max("observed").alias("observed"), ((1 + F.count_if("more")) / (1 + F.count("*"))).alias("p"))


def _permuted_joined(rows: DataFrame, b: int, blocks: bool, seed: int) -> DataFrame:
    ranked = ranks.average_ranks(ranks.average_ranks(rows, "y", "ry"), "yhat", "rp")
    rows = written(ranks.positions(ranked, ["_unit", "t", "y", "yhat"]).select((F.col("pos") - 1).alias("pos"), "_unit", "ry", "rp"), "ranked")
    reps = rows.sparkSession.range(b).select(F.col("id").alias("b"))
    unit = F.col("_unit") if blocks else F.col("pos")
    # the drawn order is that of a hash; its upper bits cut each replicate into ranges of even size
    drawn = rows.select("_unit", "pos", "ry").crossJoin(F.broadcast(reps)).withColumn("h", F.xxhash64("b", unit, F.lit(seed))).withColumn("part", F.shiftright("h", 58))
    parts = drawn.groupBy("b", "part").agg(F.count("*").alias("k"))
    offsets = parts.select("b", "part", (F.sum("k").over(Window.partitionBy("b").orderBy("part")) - F.col("k")).alias("o"))
    inside = F.row_number().over(Window.partitionBy("b", "part").orderBy("h", "pos"))
    moved = drawn.withColumn("i", inside).join(offsets, ["b", "part"]).select("b", (F.col("i") + F.col("o") - 1).alias("slot"), "ry")
    product = ((2 * F.col("ry")).cast("long") * (2 * F.col("rp")).cast("long")).cast("decimal(38,0)")
    paired = moved.join(rows.select(F.col("pos").alias("slot"), "rp"), "slot").groupBy("b").agg(F.sum(product).alias("s"))
    seen = rows.agg(F.corr("ry", "rp").alias("observed"), F.sum(product).alias("seen"))
    return paired.crossJoin(F.broadcast(seen)).groupBy("observed").agg(((1 + F.count_if(F.col("s") >= F.col("seen"))) / (1 + F.count("*"))).alias("p"))
