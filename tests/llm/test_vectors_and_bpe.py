import base64
import math

import numpy as np
import pytest

from seriesforge.llm import bpe, embedding_dedup
from seriesforge.llm.components import connected_components

KIND = "vec_id bigint, embedding array<float>, label int, kept string"


def test_embedding_groups_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = []
    for i in range(300):
        x = base[i % 40] + rng.normal(size=16) * (0.02, 0.2, 0.28)[i % 3]
        rows.append((i, [float(np.float32(v)) for v in x], i % 40 % 3, None))
    rows += [(300 + k, rows[0][1], 0, None) for k in range(80)]  # equal vectors
    rows += [(500, None, 0, None), (501, [0.0] * 16, 0, None), (502, [float("nan")] * 16, 0, None), (503, [None] + [1.0] * 15, 0, None), (504, rows[0][1], None, None), (505, [], 0, None)]
    good = [(i, np.array(x, np.float64), lab) for i, x, lab, _ in rows if i < 500]
    parent, links = {i: i for i, *_ in rows}, {i: 0 for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x, la in good:
        for b, y, lb in good:
            if a < b and la == lb and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    for block in (2048, 16):
        out = embedding_dedup.embedding_groups(spark.createDataFrame(rows, KIND), block_rows=block).collect()
        assert {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in out} == {i: (links[i], find(i), find(i) == i) for i, *_ in rows}
    assert embedding_dedup.embedding_groups(spark.createDataFrame([], KIND)).count() == 0


def test_components_of_chains_hubs_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers as P

    return P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


def test_encoding_equals_the_library_and_decodes(spark, vocabulary):
    import tiktoken

    path, pattern = vocabulary
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "plain words, don't they? 12345", "héllo wörld\n\n  tabs\t", "日本語 テキスト 😀👩‍👧", "a" * 3000, "=-" * 500, "<|endoftext|>", " " * 300 + "x", "über" * 4000]
    rng = np.random.default_rng(2)
    texts += ["".join(chr(c) for c in rng.integers(32, 0x2FF, 80)) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string")
    for r in bpe.encode_documents(df, path, pattern).collect():
        want = encoding.encode_ordinary(texts[r["doc_id"]] or "")
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert bytes(r["decoded"]).decode() == (texts[r["doc_id"]] or "")
    assert bpe.encode_documents(df.limit(0), path, pattern).count() == 0


def test_prefix_table_appends_and_edits(vocabulary):
    v = bpe.Vocabulary.load(*vocabulary)
    text = "internationalisation".encode()
    table = bpe.Prefixes(v, text[:5])
    for k in range(5, len(text)):
        table.append(text[k : k + 1])
        assert table.ids() == bpe.merge_bytes(text[: k + 1], v.ranks)
    table.replace(6, 9, b"XyZq")
    assert table.ids() == bpe.merge_bytes(text[:6] + b"XyZq" + text[9:], v.ranks)
    assert bpe.Prefixes(v).ids() == []


def test_seam_test_equals_merging_both_tokens(vocabulary):
    v = bpe.Vocabulary.load(*vocabulary)
    rng = np.random.default_rng(7)
    pairs = [tuple(rng.integers(0, len(v.token), 2).tolist()) for _ in range(4000)]
    for word in ("internationalisation", "Donaudampfschifffahrt", "aaaaaaaaaa", "don't-they", "0123456789"):
        data = word.encode()
        for cut in range(1, len(data)):
            pairs += [(a, b) for a in [v.ranks.get(data[i:cut]) for i in range(cut)] for b in [v.ranks.get(data[cut:j]) for j in range(cut + 1, len(data) + 1)] if a is not None and b is not None]
    for a, b in pairs:
        assert v.apart(a, b) == (bpe.merge_bytes(v.token[a] + v.token[b], v.ranks) == [a, b])


def test_edits_stop_where_the_table_rejoins(vocabulary):
    v, rng = bpe.Vocabulary.load(*vocabulary), np.random.default_rng(3)
    data = bytes(rng.choice(list(b"abcdefgh"), 4000).tolist())
    table = bpe.Prefixes(v, data)
    for at, end, new in ((1000, 1003, b"XYZ"), (5, 5, b"more"), (3900, 4000, b""), (0, 2, b""), (200, 230, b"e")):
        data = data[:at] + new + data[end:]
        again = table.replace(at, end, new)
        assert table.data == data and table.last == bpe.Prefixes(v, data).last and again < 300


def test_text_edits_cut_only_the_pieces_around_them(vocabulary):
    v, rng = bpe.Vocabulary.load(*vocabulary), np.random.default_rng(11)
    parts = ["don't", " we'll", "  ", "\n\n", " 12", "345", "über", " =-=", "x", "'", "re", "\t ", " naïve"]
    text = "".join(rng.choice(parts, 400))
    held = bpe.Encoded(v, text)
    for _ in range(300):
        a, b = sorted(rng.integers(0, len(text) + 1, 2).tolist())
        b = min(b, a + int(rng.integers(0, 6)))
        new = "".join(rng.choice(parts, int(rng.integers(0, 3))))
        text = text[:a] + new + text[b:]
        cut = held.replace(a, b, new)
        assert held.text == text and held.pieces == v.pattern.findall(text) and held.ids() == v.encode(text) and cut < 40
    held.append(" tail")
    assert held.ids() == v.encode(text + " tail") and bpe.Encoded(v).ids() == b""


def test_repeated_rows_are_encoded_alike(spark, vocabulary):
    df = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text")], "doc_id bigint, text string")
    assert len({bytes(r["ids"]) for r in bpe.encode_documents(df, *vocabulary).collect()}) == 1
