"""Results that do not follow the layout of the input, and inputs with the operators' own internal names."""

import math
import random

import numpy as np
import pytest

from seriesforge.llm import embedding_dedup, language_id, packing, quality_rules, toxicity
from seriesforge.llm.substring_dedup import remove_repeated_windows


def test_substring_dedup_with_its_own_names_as_columns(spark):
    passage = " ".join(f"w{k}" for k in range(30))
    rows = [(1, passage, "a", "b", 3), (2, f"x {passage} y", "c", "d", 4)]
    out = remove_repeated_windows(spark.createDataFrame(rows, "doc_id int, text string, _chunk string, _CHUNK_ string, block int")).orderBy("doc_id").collect()
    assert [r["dedup_removed"] for r in out] == [0, 30] and [(r["_chunk"], r["_CHUNK_"], r["block"]) for r in out] == [("a", "b", 3), ("c", "d", 4)]


@pytest.mark.parametrize("name", ["length", "start", "piece", "bin", "_row", "_size", "_group", "n"])
def test_packing_takes_sizes_of_any_name(spark, name):
    df = spark.createDataFrame([(k, 100 + k % 50, "x", "y") for k in range(40)] + [(40, None, "x", "y")], f"doc_id int, {name} int, other string, _row_ string")
    out = packing.pack_sequences(df, size_col=name).collect()
    assert sorted((r["doc_id"], r["other"], r["_row_"]) for r in out) == [(k, "x", "y") for k in range(41)]
    assert {r["doc_id"]: r["length"] for r in out} == {**{k: 100 + k % 50 for k in range(40)}, 40: 0}


def test_toxicity_does_not_follow_the_layout(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    told = []
    for d in (docs, docs.repartition(7, "doc_id"), docs.repartition(3).sortWithinPartitions("text")):
        weight, bias = toxicity.fit(d, labels)
        told.append((weight.tobytes(), bias))
    assert told[0] == told[1] == told[2]


def test_links_of_vectors_of_any_size(spark):
    near, far = [2.0, 4.0, 1.0], [1.0, -2.0, 0.5]
    rows, want, i = [], {}, 0
    for scale in (1e200, 1e-200, 1e-310, 1e308 / 4, 1.0):
        group = []
        for x in (near, [v * 0.5 for v in near], [2.1, 3.9, 1.1], far):
            rows.append((i, [v * scale for v in x], str(scale)))
            group.append(i)
            i += 1
        for j in group[:3]:
            want[j] = (2, group[0])
        want[group[3]] = (0, group[3])
    out = embedding_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")).collect()
    assert {r["id"]: (r["n_links"], r["component"]) for r in out} == want
    x, y = np.array(near), np.array([2.1, 3.9, 1.1])
    assert x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93


def test_sentences_of_other_scripts_stay():
    sentence = "यह एक लंबा वाक्य है जिसमें बहुत सारे शब्द हैं और जो अंत में एक दंड के साथ समाप्त होता है ताकि परीक्षण हो सके ।"
    assert len(sentence.split()) >= quality_rules.LONG_LINE_WORDS and quality_rules.line_verdict(sentence) is None
    assert quality_rules.line_verdict(sentence.replace("।", "")) == "punctuation"
    assert quality_rules.measure(sentence)[-1] == sentence
    for mark in "։؟۔።។။༎":
        assert quality_rules.line_verdict("word " * 25 + mark) is None
    assert quality_rules.line_verdict("ภาษาไทย ไม่มี " * 15) is None
    assert quality_rules.line_verdict("no mark at all ภาษา " * 8) == "punctuation"


def test_prose_about_policies_stays_and_foreign_menus_go():
    prose = "The court held that the cookie policy of the defendant, drafted in 2011 before the reform, breached the directive in two respects."
    assert quality_rules.line_verdict(prose) is None
    assert quality_rules.line_verdict("We use cookies to improve your experience. By continuing you accept our cookie policy.") == "boilerplate"
    assert quality_rules.line_verdict("Home Chi siamo Contatti Accedi Cerca Notizie") == "navigation"
    assert quality_rules.line_verdict("The Goblet Of Fire And Other Tales") is None


def test_languages_are_bounded_by_a_parameter(spark):
    df = spark.createDataFrame([(f"kata {x}", x) for x in ("aa", "bb", "cc")], "text string, lang string")
    assert language_id.learn(df, max_languages=3)[0] == ["aa", "bb", "cc"]
    with pytest.raises(ValueError, match="more than 2 languages"):
        language_id.learn(df, max_languages=2)


def test_toxicity_edges(spark):
    """Very long texts are scored whole; equal texts get equal scores, wherever they stand."""
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(["fair", "kind", "mild"] if k % 2 else ["vile", "foul", "kind"]) for _ in range(30))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2) for k, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    odd = [(1, "kind " * 50_000 + "vile foul " * 50_000), (2, "kind " * 50_000), (3, "vile foul"), (3, "vile foul"), (4, None), (5, "")]
    got = toxicity.score(spark.createDataFrame(odd, "doc_id bigint, text string").repartition(3), model).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by.values()) and min(by[1]) > max(by[2]) and by[4] == by[5]


def test_a_hot_bucket_without_links_grows_in_proportion(spark):
    """Fingerprints that share their upper 34 bits: rows shuffled grow with the bucket, not with its square."""
    from seriesforge.llm import simhash_dedup

    rng, dealt = np.random.default_rng(1), []
    for n in (4000, 8000):
        low = np.unique(rng.integers(0, 1 << 30, n))
        fps = low | 5 << 40
        df = spark.createDataFrame([(k, k) for k in fps.tolist()], "fp bigint, id bigint")
        links = simhash_dedup.near_links(df, 4, tile_rows=100)
        got = {tuple(sorted(r)) for r in links.collect()}
        want = {(a, b) for i, a in enumerate(fps.tolist()) for b in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ a) <= 4].tolist()}
        assert got == want and want
        dealt.append(_shuffled(links))
    assert 4000 < dealt[0] and dealt[1] <= 2.3 * dealt[0], dealt


def test_a_tight_hot_bucket_stays_in_tiles(spark):
    """Fingerprints of one neighbourhood would only be copied by another deal; the links are the same."""
    from itertools import combinations

    from seriesforge.llm import simhash_dedup

    fps = [sum(1 << b for b in c) for c in combinations(range(24), 3)]
    df = spark.createDataFrame([(k, k) for k in fps], "fp bigint, id bigint")
    got = simhash_dedup.connected_components(simhash_dedup.near_links(df, 4, spanning=True, tile_rows=100)).collect()
    assert len(got) == len(fps) and len({r["component"] for r in got}) == 1


def test_informed_masks_keep_every_near_pair():
    from seriesforge.llm import simhash_dedup

    rng = np.random.default_rng(2)
    fps = [int(x) & 0x0FF0_0000_FFFF_0003 for x in rng.integers(0, 1 << 62, 500)]
    ones = np.array([sum(f >> b & 1 for f in fps) for b in range(64)])
    masks = simhash_dedup.informed_masks(ones, len(fps), 4, 6)
    assert len(masks) == 15
    varying = [b for b in range(64) if 0 < ones[b] < len(fps)]
    for f in fps[:100]:
        g = f
        for b in rng.choice(varying, 4, replace=False).tolist():
            g ^= 1 << b
        assert any(f & m == g & m for m in masks)


def _shuffled(links):
    """Rows that the plan's last exchange wrote."""
    node = links._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    while "Exchange" not in node.nodeName():
        node = node.plan() if "QueryStage" in node.nodeName() else node.children().head()
    return node.metrics().apply("shuffleRecordsWritten").value()
