"""Operators against plain Python, and their edge cases: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import binascii
import math
import os
import random
from itertools import combinations

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from seriesforge.llm import embedding_dedup, language_id, packing, quality_rules, queries, sharding, simhash_dedup, token_counts, toxicity


def test_vectors_of_every_length_and_repeated_ids(spark):
    rng, rows = np.random.default_rng(2), []
    for d in (2, 3, 8, 16):
        base = rng.normal(size=(12, d))
        rows += [(i % 50, [float(np.float32(v)) for v in base[i % 12] + rng.normal(size=d) * (0.02, 0.25)[i % 2]], i % 2) for i in range(70)]
    rows += [rows[0]] * 30
    n, root = len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for a, b in combinations(range(n), 2):
        x, y = np.array(rows[a][1]), np.array(rows[b][1])
        if rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for k in range(n):
        least[find(k)] = min(least.get(find(k), 99), rows[k][0])
    want = sorted((rows[k][0], links[k], least[find(k)]) for k in range(n))
    for kind in ("array<float>", "array<double>"):
        out = embedding_dedup.embedding_groups(spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}, label int"), block_rows=24).collect()
        assert sorted((r["id"], r["n_links"], r["component"]) for r in out) == want


def test_mixture_is_the_best_penalised_set(spark):
    rng = random.Random(5)
    words = {"aa": ["kata", "tika", "kita"], "bb": ["molo", "olum", "lumo"], "cc": ["senre", "ersen", "resen"]}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    df = spark.createDataFrame([(i, text(x, 80), x) for i, x in enumerate(["aa", "bb", "cc"] * 6)], "doc_id bigint, text string, lang string")
    langs, table = language_id.learn(df)

    def best(at, counts):
        p, n, told = table[at], counts.sum(), []
        for size in (1, 2, 3):
            for chosen in combinations(range(3), size):
                pi = np.full(size, 1 / size)
                for _ in range(language_id.ROUNDS):
                    r = p[:, chosen] * pi
                    pi = (counts[:, None] * r / r.sum(1, keepdims=True)).sum(0) / n
                told.append((counts @ np.log(p[:, chosen] @ pi) - (size - 1) * max(0.5 * np.log(n + 1), language_id.MIN_SHARE * n), chosen, pi))
        return max(told)[1:]

    for a, b, c in [(40, 0, 0), (30, 30, 0), (10, 40, 0), (25, 25, 25), (0, 12, 60), (1, 0, 0)]:
        at, counts = language_id.ngram_counts(" ".join([text("aa", a), text("bb", b), text("cc", c)]))
        chosen, pi = best(at, counts)
        share = language_id.mixture(at, counts, table)
        assert tuple(np.flatnonzero(share)) == chosen and share[list(chosen)] == pytest.approx(pi, abs=1e-9)


def test_language_edges(spark):
    rows = [(1, "kata tika " * 20_000, "aa"), (1, "kata tika", "aa"), (1, "kata tika", "aa"), (2, "molo lumo", "bb"), (3, "MOLO", None), (4, None, "bb"), (None, "kata molo", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, score string")
    out = language_id.predict(df, language_id.learn(df)).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    assert len({(r["lang_pred"], r["score"]) for r in out if r["text"] == "kata tika"}) == 1
    assert {r["text"]: r["lang_pred"] for r in out}["MOLO"] == "bb"
    tie = language_id.predict(df.limit(1), (["aa", "bb"], np.full((language_id.BUCKETS, 2), 1 / language_id.BUCKETS))).first()
    assert tie["lang_pred"] == "aa"  # equal likelihoods: the first in order
    assert language_id.predict(df.limit(0), language_id.learn(df)).count() == 0
    assert language_id.learn(df.limit(0))[0] == []



def test_token_lengths_equal_the_library(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = ["", None, "plain words", "plain words", "x" * 30_000, "über\n\n  tabs\t", "<|endoftext|>", "word " * 30_000]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string, n_docs string")
    encode, want = token_counts.encoder(path).encode_ordinary, {}
    for t in texts:
        n = len(encode(t or ""))
        want[n] = want.get(n, 0) + 1
    assert {r["n_tokens"]: r["n_docs"] for r in token_counts.token_lengths(df, path).collect()} == want
    rows = token_counts.length_table(token_counts.token_lengths(df, path)).collect()
    assert sum(r["n_docs"] for r in rows) == len(texts) and {r["total_tokens"] for r in rows} == {sum(n * k for n, k in want.items())}
    assert [r["n_tokens"] for r in token_counts.with_length(df, path).orderBy("doc_id").collect()] == [len(encode(t or "")) for t in texts]
    assert token_counts.token_lengths(df.limit(0), path).count() == 0


def _place(x, n):
    """The permutation in plain Python."""
    p, (a, b) = sharding.PRIME, sharding.grid(n)
    while True:
        u, v, m, w = x // b, x % b, a, b
        for key in sharding.ROUND_KEYS:
            t = (v % p + key) % p
            t = (t * t + v // p % p + key) % p
            u, v, m, w = v, (u + (t * t + t) % p) % m, w, m
        x = u * b + v
        if x < n:
            return x


def test_shards_equal_plain_python(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "", "é" * 3, "text", "x" * 70_000])) for _ in range(300)] + [(7, "again")] * 200
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, slot string").repartition(3)
    raw = [(i, (t or "").encode()) for i, t in rows]
    want = sorted(((i is not None, i or 0), binascii.crc32(b), len(b) + 16) for i, b in raw)
    out = sorted(sharding.shard_rows(df, 6).collect(), key=lambda r: r["row_number"])
    assert [((r["id"] is not None, r["id"] or 0), r["text_crc32"], r["size"]) for r in out] == want
    for r in out:
        assert (r["shard"], r["slot"]) == (_place(r["row_number"], len(rows)) % 6, _place(r["row_number"], len(rows)) // 6)


def test_sharding_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(sf_dir, 'documents.parquet')}'")
    want = con.execute(queries.ORACLE_SQL["op8_sharding"]).df()
    got = queries.op8_sharding(spark, sf_dir).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    key = ["doc_id", "size", "text_crc32", "shard", "slot", "row_number", "law"]
    assert sorted(map(tuple, want[key].values.tolist())) == sorted(map(tuple, got[key].values.tolist()))


def _plain_best_fit(sizes, opened, lengths):
    bins, left = [], sum(sizes)
    for x in sizes:
        fits = [b for b in bins if b[0] >= x]
        if fits:
            chosen = min(fits, key=lambda b: b[0])
        else:
            chosen = [min((packing.bin_cost(c) / min(c, left), c) for c in opened if c >= x)[1], 0]
            bins.append(chosen)
        chosen[0] -= x
        chosen[1] += x
        left -= x
    return sum(packing.bin_cost(min(c for c in lengths if c >= used)) for _, used in bins)


def test_packing_is_best_fit_over_every_choice_of_lengths():
    rng, lengths = random.Random(9), (512, 1024, 2048, 4096)
    for _ in range(12):
        sizes = sorted((rng.choice([rng.randrange(1, 4097), 512, 700, 1024]) for _ in range(rng.randrange(1, 120))), reverse=True)
        choices = [(*c, 4096) for n in range(4) for c in combinations(lengths[:-1], n)]
        costs = {c: _plain_best_fit(sizes, c, lengths) for c in choices}
        for c in choices:
            assert packing.best_fit(sizes, c, lengths)[0] == pytest.approx(costs[c])
        assert packing.pack(sizes, lengths)[0] == pytest.approx(min(costs.values()))


def test_packing_repeated_rows(spark):
    df = spark.createDataFrame([(1, 300)] * 50 + [(None, 300), (2, None)], "doc_id bigint, n_tokens bigint")
    out = packing.pack_sequences(df, group_rows=20).collect()
    assert len(out) == 52 and sum(r["length"] for r in out) == 51 * 300
    assert len({(r["bin"], r["bin_offset"]) for r in out if r["bin"] is not None}) == 51


def test_toxicity_features_and_scores_equal_plain_python(spark):
    mask = (1 << 64) - 1

    def grams(text):
        code, out = [ord(c) for c in f" {' '.join((text or '').lower().split())} "], set()
        for n in toxicity.SIZES:
            for i in range(len(code) - n + 1):
                h = n
                for c in code[i : i + n]:
                    h = (h + c) * 0x9E3779B97F4A7C15 & mask
                    h ^= h >> 32
                out.add((h * 0xD6E8FEB86659FD93 & mask) >> (64 - toxicity.BITS))
        return sorted(out)

    rng = np.random.default_rng(1)
    weight = rng.normal(size=1 << toxicity.BITS)
    texts = ["", None, "A b", "naïve café\n\tTABS", "x", "same text", "same text", "long words " * 3000]
    df = spark.createDataFrame([(i, t, "s", "p") for i, t in enumerate(texts)], "doc_id bigint, text string, score string, predicted string")
    seen = np.zeros(1 << toxicity.BITS, bool)
    for r in toxicity.score(df, (weight, -0.3)).collect():
        at = grams(r["text"])
        assert toxicity.ngram_set(r["text"], seen).tolist() == at
        z = -0.3 + float(weight.astype(np.float32)[at].sum(dtype=np.float64))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z))))) and r["predicted"] == int(r["score"] >= 0.5)
    assert toxicity.score(df.limit(1), (np.zeros(1 << toxicity.BITS), 0.0)).first()["predicted"] == 1  # a tie at 0.5


def test_toxicity_weights_follow_log_count_ratios(spark):
    rows = [(i, ("badword " if i % 3 == 0 else "goodone ") + f"filler{i % 5}") for i in range(120)] + [(0, "badword filler0")] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(0, 0)], "doc_id bigint, toxic int")
    weight, _ = toxicity.fit(docs, labels)
    seen = np.zeros(1 << toxicity.BITS, bool)
    bad, good = (set(toxicity.ngram_set(w, seen).tolist()) for w in ("badword", "goodone"))
    assert weight[sorted(bad - good)].sum() > 0 > weight[sorted(good - bad)].sum()
    assert weight[sorted(toxicity.ngram_set("zzzz", seen).tolist())].sum() == pytest.approx(0, abs=1e-6)  # never seen


def test_fingerprints_replace_no_column_of_the_input(spark):
    df = spark.createDataFrame([(1, "a b c d e", 5, 6), (2, "a b c d e", 5, 6)], "doc_id bigint, text string, fp bigint, id bigint")
    out = simhash_dedup.simhash_groups(df).collect()
    assert {(r["id"], r["component"]) for r in out} == {(1, 1), (2, 1)} and out[0]["fp"] != 5


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_every_stage_takes_odd_tables(spark, sf_dir, name, stage):
    """Nulls in every column, empty and long texts, repeated rows, columns named like the operators' own; an empty table."""
    prose = " ".join(f"word{i}" for i in range(60)) + "."
    texts = [prose, prose, None, "", " \n\t", "word " * 5000, prose.upper(), "x"]
    rows = [(i, t, None if i == 4 else "en", "s", 5, "a", "b", 7, None, "t") for i, t in enumerate(texts)] + [(None,) * 10]
    rows += [rows[0]] * 2
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score string, component bigint, dedup_text string, n_tokens string"
    docs = spark.createDataFrame(rows, kind)
    out = stage(spark, docs, sf_dir)
    told = out.collect()
    assert told
    if name != "best_fit_packing":
        assert out.columns == docs.columns and {r["doc_id"] for r in told} <= {r[0] for r in rows}
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_quality_rules_equal_their_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(sf_dir, 'documents.parquet')}'")
    want = con.execute(queries.ORACLE_SQL["op3_quality_rules"]).df()
    got = queries.op3_quality_rules(spark, sf_dir).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, want[got.columns].values.tolist())) == sorted(map(tuple, got.values.tolist()))


def test_quality_rules_equal_their_sql_on_odd_texts():
    rng = random.Random(7)
    pieces = ["home", "About", "|", "»", "x#", "no!!", "word", "ends.", "été", "🙂", "a\u00a0b", "a\u2003b", "\u0085", "privacy policy", "Alle Rechte vorbehalten", "conditions d'utilisation"]
    texts = [None, "", " \n\t\n", "\n".join(["same line here."] * 4), "a b c d e f g h " * 9 + "and a tail without repeats.", "word " * 41 + "privacy policy."]
    for _ in range(400):
        lines = ["".join(rng.choice(pieces) + rng.choice([" ", " ", " ", "\t", "  ", "\r"]) for _ in range(rng.choice([1, 3, 5, 8, 16, 25, 42]))) for _ in range(rng.randrange(1, 6))]
        texts.append("\n".join(lines))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i % 300, t) for i, t in enumerate(texts)])
    told = con.execute(f"SELECT n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, punctuation_lines, navigation_lines, boilerplate_lines, n_kept_words FROM ({queries.ORACLE_SQL['op3_quality_rules']})")
    assert sorted(told.fetchall()) == sorted(quality_rules.measure(t)[:-1] for t in texts)
