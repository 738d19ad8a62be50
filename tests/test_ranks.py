"""Exact places, ranks, quantiles and lagged products, with values and groups that hold most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import ranks as R
from seriesforge.operators import resampling as S


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(rng.choice(["a", "a", "a", "b", None]), rng.choice([7.0, 7.0, 7.0, rng.random() * 20, float(rng.randrange(9))]), i) for i in range(6000)]


def test_average_ranks_with_a_value_that_holds_most_rows(spark, rows):
    df = spark.createDataFrame([*rows, ("a", None, -1)], "g string, v double, i int")

    def want(part):
        v = np.array([r[1] for r in part])
        return {r[2]: (v < r[1]).sum() + ((v == r[1]).sum() + 1) / 2 for r in part}

    assert {r["i"]: r["k"] for r in R.average_ranks(df, "v", "k").collect()} == want(rows)
    inside = {}
    for g in ("a", "b", None):
        inside |= want([r for r in rows if r[0] == g])
    assert {r["i"]: r["k"] for r in R.average_ranks(df, "v", "k", ["g"]).collect()} == inside
    assert R.average_ranks(df.limit(0), "v", "k").count() == 0


def test_one_value_or_name_is_spread_over_ranges(spark):
    # small ranges are joined otherwise
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(40_000).select(F.lit(1.0).alias("v"), F.lit("n").alias("name"), "id")
    for order, by in ((["v"], []), (["name", "v"], []), (["v"], ["name"])):
        held = [r["count"] for r in R.placed(df, order, by).groupBy("_part").count().collect()]
        assert len(held) >= 3 and max(held) < 20_000
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_input_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    from seriesforge.operators.stats import spearman

    df = spark.range(500).select((F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    told = spearman(df.mapInArrow(touch, df.schema), "a", "b").first()["spearman"]
    assert seen.value == 500
    a, b = np.arange(500) % 37, np.arange(500) % 11
    rank = lambda v: np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])
    assert told == pytest.approx(np.corrcoef(rank(a), rank(b))[0, 1])


def test_cumulative_sums(spark):
    df = spark.createDataFrame([(float(k * 7 % 101), k, 2.0 * k) for k in range(101)], "x double, p int, q double")
    got = {r["x"]: (r["cum_p"], r["cum_q"]) for r in R.cumulative(df, "x", ["p", "q"]).collect()}
    at = {float(k * 7 % 101): k for k in range(101)}
    assert got == {x: (sum(at[y] for y in at if y < x), 2.0 * sum(at[y] for y in at if y < x)) for x in at}


@pytest.mark.parametrize("small", [10_000, 100, 1])
def test_quantiles_equal_numpy(spark, rows, small):
    ps = [0.0, 0.1, 1 / 3, 0.5, 0.975, 1.0]
    df = spark.createDataFrame([*rows, ("a", None, -1)], "g string, v double, i int")
    got = R.quantiles(df, "v", ps, small=small).first()
    assert got["n"] == 6000 and got["q"] == pytest.approx(np.percentile([r[1] for r in rows], [100 * p for p in ps]), abs=1e-12)
    by = {r["g"]: r for r in R.quantiles(df, "v", ps, ["g"], small=small).collect()}
    for g in ("a", "b", None):
        v = [r[1] for r in rows if r[0] == g]
        assert by[g]["n"] == len(v) and by[g]["q"] == pytest.approx(np.percentile(v, [100 * p for p in ps]), abs=1e-12)
    assert R.quantiles(df.limit(0), "v", ps).count() == 0


@pytest.mark.parametrize("name", ["c", "v", "k", "lo", "held", "x", "at", "bin"])
def test_quantiles_of_large_groups_in_a_column_of_any_name(spark, rows, name):
    df = spark.createDataFrame([(g, v) for g, v, _ in rows], "g string, value double").withColumnRenamed("g", name)
    got = {r[name]: r["q"][0] for r in R.quantiles(df, "value", [0.5], [name], small=100).collect()}
    assert got == {g: pytest.approx(np.median([r[1] for r in rows if r[0] == g]), abs=1e-12) for g in ("a", "b", None)}


def test_medians_of_large_columns_fill_their_nulls(spark):
    from seriesforge.operators.risk import impute_medians

    df = spark.range(R.SMALL + 2).select("id", F.when(F.col("id") > 0, F.col("id").cast("double")).alias("a"), F.lit(None).cast("double").alias("b"))
    got = impute_medians(df, ["a", "b"])
    assert got.columns == df.columns and got.filter("id = 0").first()[1:] == (R.SMALL / 2 + 1, 0.0)
    assert got.filter("id > 0 AND a <> id OR b <> 0").count() == 0 and got.count() == R.SMALL + 2


def test_quantiles_of_far_apart_values(spark):
    rng = random.Random(2)
    v = [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 308) for _ in range(300)] + [0.0] * 50 + [1.7e308, -1.7e308]
    got = R.quantiles(spark.createDataFrame([(x,) for x in v], "v double"), "v", [0.0, 0.25, 0.5, 0.75, 1.0], small=5).first()["q"]
    assert got == [sorted(v)[k] for k in (0, 88, 175, 263, 351)] or got == pytest.approx(np.percentile(v, [0, 25, 50, 75, 100]), rel=1e-12)


@pytest.mark.parametrize("chunk", [16_384, 64, 7])
def test_lagged_products_equal_numpy(spark, chunk):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for g, n, lags in (("a", 300, 20), ("b", 5, 4), (None, 70, 69)):
        c = rng.normal(size=n)
        rows += [(g, k + 1, float(x), lags) for k, x in enumerate(c)]
        want |= {(g, lag): c[lag:] @ c[: n - lag] for lag in range(lags + 1)}
    df = spark.createDataFrame(rows, "g string, pos int, c double, lags int").repartition(5)
    got = {(r["g"], r["lag"]): r["p"] for r in R.lagged_products(df, ["g"], chunk=chunk).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    alone = {r["lag"]: r["p"] for r in R.lagged_products(df.filter("g = 'a'").drop("g"), chunk=chunk).collect()}
    assert all(alone[lag] == pytest.approx(want["a", lag], abs=1e-9) for lag in range(21))


def test_lagged_products_copy_few_rows(spark):
    """No row is copied once per lag: 40,000 rows over 70 lags are dealt as 40,000 and one halo a chunk."""
    df = spark.range(40_000).select(F.col("id").alias("pos"), F.lit(1.0).alias("c"), F.lit(69).alias("lags"))
    plan = R.lagged_products(df)
    assert {r["lag"]: r["p"] for r in plan.collect()} == {lag: 40_000.0 - lag for lag in range(70)}
    div = lambda x: F.call_function("div", x, F.lit(R.CHUNK).cast("long"))
    copies = df.select(F.explode(F.sequence(div(F.col("pos")), div(F.col("pos") + F.col("lags"))))).count()
    assert copies <= 40_000 + 3 * 69


def test_hashes_equal_sparks(spark):
    a, b = np.array([0, 1, -5, 2**40, -(2**62)]), np.array([3, 2**33, 0, -1, 7])
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a bigint, b bigint")
    for seed in (11, 0, -3):
        two = [r[0] for r in df.select(F.xxhash64("a", "b", F.lit(seed))).collect()]
        one = [r[0] for r in df.select(F.xxhash64("a", F.lit(seed))).collect()]
        assert S.hashed(seed, a, b).tolist() == two and S.hashed(seed, a).tolist() == one


@pytest.mark.parametrize("bits", [None, 54, 60, 63])
def test_hashed_order_equals_a_stable_sort_by_hash(bits):
    for n in (0, 1, 2, 1000, 70_000 if bits is None else 3000):
        for k in (0, 7):
            want = np.argsort(S.hashed(11, np.full(n, k), np.arange(n)), kind="stable")
            assert S.hashed_order(k, n, 11, bits).tolist() == want.tolist()


def test_sums_of_products_do_not_overflow():
    r = 2 * np.arange(5_000_000, dtype=np.int32)
    n = len(r)
    assert S.product_sum(r, r) == 4 * ((n - 1) * n * (2 * n - 1) // 6) > 1 << 63
    assert S.product_sum(r[:0], r[:0]) == 0


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(9)
    rows = [(f"n{i % 23:02}", i // 23, (y := float(rng.randrange(40))), y + rng.gauss(0, 30) if i % 5 else 1.0, None if i % 11 == 0 else rng.random()) for i in range(600)]
    return spark.createDataFrame([*rows, ("n00", 99, None, 1.0, 1.0)], "name string, t int, y double, yhat double, persistence double")


def test_frames_above_the_broadcast_are_handed_to_tasks_in_chunks(spark, scored, monkeypatch):
    """No row is joined with a replicate, and nothing is collected."""
    boot = {r["metric"]: r[1:] for r in S.cluster_bootstrap(scored, 30).collect()}
    perm = [S.permutation_p(scored, 30, blocks).first() for blocks in (True, False)]

    def refused(*args):
        raise AssertionError("rows x replicates, or all rows on the driver")

    for path in ("_bootstrap_joined", "_permuted_joined", "_collected"):
        monkeypatch.setattr(S, path, refused)
    for bits in (2, 14):
        monkeypatch.setattr(S, "CHUNK_BITS", bits, raising=False)
        got = {r["metric"]: r[1:] for r in S.cluster_bootstrap(scored, 30, rows_bound=10).collect()}
        assert set(got) == set(boot) and all(got[m] == pytest.approx(boot[m], abs=1e-12) for m in boot)
        for blocks, want in zip((True, False), perm, strict=True):
            told = S.permutation_p(scored, 30, blocks, rows_bound=10).first()
            assert told["p"] == want["p"] and told["observed"] == pytest.approx(want["observed"], abs=1e-12)


def test_frames_above_what_a_task_holds_are_joined_with_the_same_draws(spark, scored):
    boot = [{r["metric"]: r[1:] for r in S.cluster_bootstrap(scored, 12, **bounds).collect()} for bounds in ({}, {"rows_bound": 10, "held_bound": 10})]
    assert set(boot[0]) == set(boot[1]) and all(boot[0][m] == pytest.approx(boot[1][m], abs=1e-9) for m in boot[0])
    for blocks in (True, False):
        a, b = (S.permutation_p(scored, 12, blocks, **bounds).first() for bounds in ({}, {"rows_bound": 10, "held_bound": 10}))
        assert a["p"] == b["p"] and a["observed"] == pytest.approx(b["observed"], abs=1e-9)


def test_codes_follow_the_values():
    v = np.array([2.0, np.nan, -1.0, 2.0, np.nan, 0.0, -0.0])
    for x in (v, v[[0]], v[[1]], v[:0], v[[1, 4]], v[[0, 2, 3]]):
        distinct, want = np.unique(x, return_inverse=True)
        code, n, order = S._codes(x)
        assert code.tolist() == want.tolist() and n == len(distinct) and (np.diff(code[order]) >= 0).all()
