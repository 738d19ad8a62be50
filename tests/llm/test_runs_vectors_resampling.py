"""Periodic runs, vector packing and importance resampling against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from seriesforge.llm import importance_resampling, periodic_runs, queries, vector_packing
from seriesforge.llm.vector_packing import Limits

DOC = "doc_id bigint, text string, runs string, key bigint, _place string, start string, id string, _equal string"


def _rows(texts):
    return [(i, t, "clash", 7, "p", "s", "i", "e") for i, t in texts]


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(24, 3 * q):
                found.setdefault((at, end + q), q)
            at = max(end, at + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng, seen = random.Random(1), 0
    for _ in range(400):
        words = []
        for _ in range(rng.randrange(1, 5)):
            base = [rng.choice("ab" if rng.random() < 0.6 else "abcdefgh").encode() for _ in range(rng.choice([1, 2, 3, 8, 9, 16, 17, 30, 33, 40]))]
            if rng.random() < 0.4:  # every gram of a period may occur in it twice
                base = base * 2 + [b"x"]
            words += [base[i % len(base)] for i in range(rng.randrange(1, 7 * len(base)))]
            words += [b"z"] * (rng.random() < 0.3)
        want = brute_runs(words)
        seen += len(want)
        assert periodic_runs.find_runs(words) == want
    assert seen > 300


def test_runs_of_long_texts_stay_cheap():
    assert periodic_runs.find_runs([b"a"] * 300_000) == [(0, 300_000, 1)]
    short, long = [b"a"], [b"a", b"b"]
    while len(long) < 3000:  # a word with as many repetitions as can be
        short, long = long, long + short
    assert periodic_runs.find_runs(long) == brute_runs(long)


def test_runs_of_documents(spark):
    texts = [(1, "x " + "a b c " * 9 + "y"), (2, None), (3, ""), (None, "a " * 40), (4, " \n\t"), (1, "x " + "a b c " * 9 + "y"), (5, "w " * 5000), (6, "é ü " * 12 + " ")]
    found = periodic_runs.periodic_runs(spark.createDataFrame(_rows(texts), DOC)).withColumn("best", periodic_runs.strongest())
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed_text, r.key, r.best and tuple(r.best)) for r in found.collect()), key=str)
    want = []
    for i, t in texts:
        words = (t or "").encode().split()
        runs = brute_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want.append((i, runs, b" ".join(w for k, w in enumerate(words) if k not in gone).decode(), 7, best))
    assert got == sorted(want, key=str)
    assert periodic_runs.periodic_runs(spark.createDataFrame([], DOC)).count() == 0


def test_strongest_run_by_exact_ratio(spark):
    rows = [([(0, 24, 7), (3, 48, 14), (9, 31, 9)],), ([(5, 31, 9), (0, 24, 7)],), ([],)]
    got = spark.createDataFrame(rows, "runs array<struct<start:bigint,length:bigint,period:bigint>>").select(periodic_runs.strongest().alias("b")).collect()
    assert [r.b and tuple(r.b) for r in got] == [(9, 31, 9), (5, 31, 9), None]


def test_echo_of_the_query():
    words = [str(k).encode() for k in range(50)]
    for i in range(300):
        h = zlib.crc32(str(i).encode())
        got = queries._echo(i, words)
        if h % 10:
            assert got == words
        else:
            a, p = h // 10 % 50, 1 + (50 - h // 10 % 50) // (3 + h // 10 % 8)
            assert got == [words[j] if j < a else words[a + (j - a) % p] for j in range(50)]


def _holds(sizes, prompts, limits, cut):
    out, bins, items = vector_packing.pack(sizes, prompts, limits, cut), {}, {}
    for p in out:
        assert p.length > 0
        bins.setdefault(p.bin, []).append(p)
        items.setdefault(p.item, []).append(p)
    for pieces in bins.values():
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(pieces) <= limits.segments
        assert sum(max(0, p.length - max(0, prompts[p.item] - p.start)) for p in pieces) <= limits.loss
        assert not cut or at == limits.tokens or at & (at - 1) == 0
    assert set(items) == {i for i, n in enumerate(sizes) if n}
    for i, pieces in items.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == sizes[i] and (cut or len(pieces) == 1)
    return len(bins)


def test_vector_packing_keeps_every_limit():
    rng = random.Random(2)
    for _ in range(300):
        tokens = rng.choice([8, 16, 100, 2048])
        limits = Limits(tokens, rng.randrange(1, 6), rng.choice([max(1, tokens // 8), tokens // 2, tokens]))
        sizes = [rng.randrange(rng.choice([3, 3 * tokens]) + 1) for _ in range(rng.randrange(60))]
        prompts = [rng.randrange(n + 3) for n in sizes]
        _holds(sizes, prompts, limits, True)
        sizes = [min(n, tokens) for n in sizes]
        _holds(sizes, [max(p, n - limits.loss) for n, p in zip(sizes, prompts, strict=True)], limits, False)
    with pytest.raises(ValueError):
        vector_packing.pack([9], [0], Limits(8, 2, 8), False)
    sizes = [min(2047, int(rng.lognormvariate(5.5, 1.2))) + 1 for _ in range(4000)]
    assert _holds(sizes, [0] * 4000, Limits(), True) <= sum(sizes) / 2048 * 1.01 + 12


def test_dot_product_takes_the_piece_in_the_direction_of_what_is_left():
    # half the tokens, all the loss is gone after the first: prompts go next, however short
    placed = vector_packing.pack([8, 4, 6], [0, 4, 0], Limits(16, 4, 8), cut=False)
    assert [p.item for p in placed if p.bin == 0] == [0, 1]


def test_encoder_equals_the_tokenizer():
    import json

    import public_tokenizers
    import regex
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    encode, kind = vector_packing.encoder(path)

    def same(text):
        return np.frombuffer(encode(text), kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids

    # ranks are the order of the merges, and every token encodes to itself
    with open(path) as f:
        merges = [m.split(" ") if isinstance(m, str) else m for m in json.load(f)["model"]["merges"]]
    vocab = tokenizer.get_vocab()
    made = [vocab[a + b] for a, b in merges]
    assert made == sorted(made) and len(set(made)) == len(made)
    for token, i in vocab.items():
        assert token == "<|endoftext|>" or [t.id for t in tokenizer.model.tokenize(token)] == [i]
    # every character that both are trusted with, in each kind of neighbourhood
    alike = regex.compile(f"[{vector_packing.ALIKE}]").match
    for c in filter(alike, map(chr, [*range(0xD800), *range(0xE000, 0x20000)])):
        assert same(f"a{c}1{c}! {c} x{c}{c}\n{c}'s {c}'{c}s  {c}  "), hex(ord(c))
    rng = random.Random(3)
    for _ in range(500):
        parts = ["the ", " ", "\n", "<|endoftext|>", "don't", "12", "é", "中", "ก", "\U0001f600", "\U00010940", "՘", "x" * 80, "ab", "!?", "\x00", "\u0085", "ₜ"]
        assert same("".join(rng.choice(parts) for _ in range(rng.randrange(30))))


def _packed(docs, **more):
    import public_tokenizers

    return vector_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True, **more)


def test_packed_documents_hold_every_id_once(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    texts += [(10**6, None), (10**6 + 1, ""), (None, "no id"), (10**6 + 2, "a long text of many words " * 9000), (10**6 + 3, "ก" * 5000)]
    texts += [(10**6 + 4, "again and again")] * 60
    df = spark.createDataFrame(_rows(texts), DOC)
    for more in ({}, {"group_bytes": 50_000}, {"limits": Limits(512, 8, 300)}):
        limits = more.get("limits", Limits())
        seqs, docs = {}, {}
        for r in _packed(df, **more).collect():
            ids = np.frombuffer(r.ids, "<u4")
            assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32 and r.loss_tokens == r.length
            seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
            docs.setdefault(r.id, []).append((r.start, ids, r.doc_tokens))
        for pieces in seqs.values():
            at = 0
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            assert at <= min(limits.tokens, limits.loss) and len(pieces) <= limits.segments and (at == limits.tokens or at & (at - 1) == 0)
        for i, t in texts:
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
            if i == 10**6 + 4:
                assert len(docs[i]) >= 60 and sum(len(x) for _, x, _ in docs[i]) == 60 * len(ids)
                continue
            pieces = sorted(docs[i], key=lambda p: p[0])
            assert np.concatenate([x for _, x, _ in pieces]).tolist() == ids and all(n == len(ids) for *_, n in pieces)
            assert [s for s, *_ in pieces] == np.cumsum([0, *[len(x) for _, x, _ in pieces]])[:-1].tolist()
    assert _packed(df.limit(0)).count() == 0


def test_packing_does_not_follow_the_layout(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a, b = (sorted(map(tuple, _packed(d).drop("ids").collect())) for d in (docs, docs.repartition(7, "text")))
    assert a == b


def test_prompts_bear_no_loss(spark):
    rows = [(i, "an answer of some words " * (i % 9), None if i % 5 == 0 else "a question, " * (i % 7)) for i in range(200)]
    limits = Limits(256, 16, 100)
    got = _packed(spark.createDataFrame(rows, "doc_id bigint, text string, ask string"), prompt_col="ask", limits=limits).collect()
    loss, per = {}, {}
    for r in got:
        loss[r.id] = loss.get(r.id, 0) + r.loss_tokens
        per[r.sequence_id] = per.get(r.sequence_id, 0) + r.loss_tokens
    encode, _ = vector_packing.encoder(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    assert loss == {i: len(encode(t)) // 2 + 1 for i, t, _ in rows}
    assert max(per.values()) <= 100


def _grams(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return words, [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_resample(docs, target):
    s, t = Counter(b for _, x in docs for b in _grams(x)[1]), Counter(b for x in target for b in _grams(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        words, grams = _grams(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in grams)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    drawn = [(*r[:4], k + 1 if k < 5 * len(fit) // 100 else None) for k, r in enumerate(fit)]
    return drawn + [(*r[:4], None) for r in out if r[4] < 20]


def test_resampling_equals_brute_force(spark):
    rng = random.Random(4)
    words = [f"W{k}é" if k % 5 == 0 else f"word{k}" for k in range(90)] + ["_", "--", "\x7f", "a.b", "ß\u0085x", "ſ", "K"]
    docs = [(k, " ".join(rng.choice(words) + rng.choice(["", ",", "\n", "  "]) for _ in range(rng.randrange(60)))) for k in range(700)]
    docs += [(None, docs[5][1] * 3), (900, None), (901, ""), (902, " .,"), (903, " ".join(words) * 300), docs[7], docs[7]] + [(904, docs[9][1] + " " + docs[8][1])] * 40
    target = [" ".join(rng.choice(words[:20]) for _ in range(30)) for _ in range(20)] + [None, ""]
    aims = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    got = importance_resampling.resample(spark.createDataFrame(_rows(docs), DOC), aims)
    assert got.columns == ["id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_resample(docs, target), key=str)
    assert importance_resampling.resample(spark.createDataFrame([], DOC), aims).count() == 0
    assert importance_resampling.resample(spark.createDataFrame(_rows(docs[:30]), DOC), aims.limit(0)).count() == 30


def test_bucket_gaps_come_back():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 400):
        x = np.sort(rng.choice([0, 1, 254, 255, 256, 9999, 5000], n)).astype(np.int64)
        assert (importance_resampling.unpacked(importance_resampling.packed(x)) == x).all()
