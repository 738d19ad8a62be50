"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm import (
    bpe, embedding_dedup, importance_resampling, language_id, packing, periodic_runs, quality_rules, sharding, simhash_dedup, token_counts,
    toxicity, vector_packing,
)
from seriesforge.llm.substring_dedup import remove_repeated_windows

SHARDS = 40


def _vocabulary(name: str) -> tuple[str, str]:
    """Path of a public vocabulary file and the pattern that cuts texts into pieces."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_windows(docs).select(
        "doc_id",
        F.col("dedup_words").alias("n_words"),
        F.col("dedup_removed").alias("n_removed"),
        F.sha2("dedup_text", 256).alias("kept_sha256"),
    )


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM d, unnest(range(1, len(ws) - 11)) AS u(i)),
f AS (SELECT k, min(doc_id) AS m FROM w GROUP BY k),
gone AS (SELECT DISTINCT w.doc_id, w.i + j AS p FROM w JOIN f USING (k), unnest(range(0, 13)) AS v(j) WHERE f.m < w.doc_id),
kept AS (
  SELECT d.doc_id, i, ws[i] AS word FROM d, unnest(range(1, len(ws) + 1)) AS u(i)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = d.doc_id AND g.p = u.i)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM kept GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return simhash_dedup.simhash_groups(docs).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.clean_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "punctuation_lines", "navigation_lines", "boilerplate_lines", "n_kept_words",
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(_table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept"
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", toxicity.fold("doc_id", 4) == 2)
    model = language_id.learn(docs.filter(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "langs")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _vocabulary("byte_bpe_50k.tiktoken")
    return token_counts.length_table(token_counts.token_lengths(_table(spark, sf_dir, "documents"), path))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(docs, *_vocabulary("byte_bpe_multi_50k.tiktoken"), digests=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(_table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _vocabulary("byte_bpe_50k.tiktoken")
    sized = token_counts.with_length(_table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "n_tokens")
    return packing.pack_sequences(sized)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", toxicity.fold("doc_id", 5) == 0)
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(toxicity.fold("doc_id", 5) != 0)
    model = toxicity.fit(docs.filter(~F.col("held_out")), labels)
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def _echo(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's texts: one document in ten ends in an echo of its own words (null ids never do)."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a, period = g % n, 1 + (n - g % n) // (3 + g % 8)
    return words[:a] + [words[a + k % period] for k in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"), prepare=_echo)
    best = found.select("doc_id", "runs", "collapsed_text", periodic_runs.strongest().alias("best"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op12_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _vocabulary("byte_bpe_50k.json")
    return vector_packing.pack_documents(_table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id").drop("loss_tokens")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.withColumnRenamed("id", "doc_id")


OP4_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
g AS (
  SELECT vec_id, label, list_transform(x, lambda v: v / m) AS x, sqrt(list_sum(list_transform(x, lambda v: (v / m) * (v / m)))) AS norm
  FROM (SELECT *, list_max(list_transform(x, lambda v: abs(v))) AS m FROM e)
  WHERE m > 0 AND label IS NOT NULL AND x IS NOT NULL AND len(x) = len(list_filter(x, lambda v: v IS NOT NULL AND isfinite(v)))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

#: CRC-32 of a list of bytes, with the table ``t`` of the view ``c``.
_CRC_TABLE = "SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)"


def _crc(text: str) -> str:
    listed = f"list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT))"
    return f"xor(list_reduce({listed}, lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295)::BIGINT"


def _op8_sql() -> str:
    """Row numbers, checksums and the permutation as SQL; the walk is a recursive query."""
    p, keys = sharding.PRIME, sharding.ROUND_KEYS
    first = f"((s.v % {p} + e.k) % {p})"
    second = f"(({first} * {first} + (s.v // {p}) % {p} + e.k) % {p})"
    state = "{{'u': {x} // b, 'v': {x} % b, 'm': a, 'w': b, 'k': 0::BIGINT}}"
    rounds = ", ".join(f"{{'u': 0::BIGINT, 'v': 0::BIGINT, 'm': 0::BIGINT, 'w': 0::BIGINT, 'k': {k}::BIGINT}}" for k in keys)

    def permuted(x: str) -> str:
        step = f"lambda s, e: {{'u': s.v, 'v': (s.u + ({second} * {second} + {second}) % {p}) % s.m, 'm': s.w, 'w': s.m, 'k': 0::BIGINT}}"
        return f"list_reduce([{state.format(x=x)}, {rounds}], {step})"

    return f"""
WITH RECURSIVE c AS ({_CRC_TABLE}),
d AS (SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size, list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)) AS bytes FROM documents),
k AS (SELECT doc_id, size, xor(list_reduce(bytes, lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM d, c),
n AS (SELECT count(*) AS n, floor(sqrt(greatest(count(*) - 1, 0)))::BIGINT + 1 AS a FROM documents),
g AS (SELECT n, a, greatest(1, (n + a - 1) // a)::BIGINT AS b FROM (SELECT n, a FROM n)),
o AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row_number FROM k),
w AS (
  SELECT row_number, r.u * b + r.v AS p FROM (SELECT row_number, b, {permuted('row_number')} AS r FROM o, g)
  UNION ALL
  SELECT row_number, r.u * b + r.v AS p FROM (SELECT row_number, b, {permuted('p')} AS r FROM w, g WHERE p >= n))
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {SHARDS})::INT AS shard, p // {SHARDS} AS slot, NULL::INT AS grown_shard, row_number FROM o JOIN w USING (row_number), g WHERE p < n
"""


def _op3_sql() -> str:
    """Base counts of the whole text, then the rules line by line; the windows of 8 words as text."""

    def listed(values) -> str:
        return ", ".join("'" + v.replace("'", "''") + "'" for v in values)

    word = r"[^\x20\x09-\x0D]+"
    # the rules read a line's words between white space of any kind
    visible = r"[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
    marks = "".join(f"\\x{{{ord(c):X}}}" for c in quality_rules.SENTENCE_MARKS)
    marked, capital = r"[^\x{0E00}-\x{0EFF}]", r"^\p{Lu}"
    phrases = " + ".join(f"CASE WHEN contains(lower(line), {listed([p])}) THEN {len(p.split())} ELSE 0 END" for p in quality_rules.BOILERPLATE)
    menu, separators, symbols = listed(sorted(quality_rules.MENU)), listed(quality_rules.SEPARATORS), listed(quality_rules.SYMBOLS)
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS ws FROM documents),
w AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k FROM d, unnest(range(1, len(ws) - 6)) AS u(i)),
again AS (SELECT r, unnest(list(i)) AS i FROM w GROUP BY r, k HAVING count(*) > 1),
repeated AS (SELECT r, count(DISTINCT i + j) AS n FROM again, unnest(range(0, 8)) AS v(j) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (
  SELECT r, line, len(regexp_extract_all(line, '{word}')) AS held, regexp_extract_all(line, '{visible}') AS ws,
    regexp_matches(line, '[{marks}]') AS ended,
    length(regexp_replace(line, '{marked}', '', 'g')) AS unmarked,
    list_filter(list_transform(string_split(line, chr(9)), lambda e: len(regexp_extract_all(e, '{visible}'))), lambda n: n > 0) AS entries FROM l),
c AS (
  SELECT r, line, held, ended, unmarked, entries, len(ws) AS n, length(array_to_string(ws, '')) AS chars, len(list_filter(ws, lambda x: regexp_matches(x, '{capital}'))) AS capital, len(list_filter(ws, lambda x: x IN ({separators}))) AS alone,
    len(list_filter(ws, lambda x: lower(x) IN ({menu}))) AS known, len(list_filter(ws, lambda x: right(x, 1) IN ({symbols}) OR suffix(x, '!!'))) AS odd FROM m),
v AS (
  SELECT r, line, held, CASE
    WHEN n = 0 THEN NULL
    WHEN alone >= 3 AND 4 * alone >= n - alone THEN 'navigation'
    WHEN n >= 3 AND NOT ended AND (n <= 15 OR contains(line, chr(9))) AND len(entries) >= 4 AND list_max(entries) <= 3 THEN 'navigation'
    WHEN n BETWEEN 3 AND 15 AND NOT ended AND known >= 3 AND 3 * known >= 2 * n THEN 'navigation'
    WHEN n BETWEEN 5 AND 15 AND NOT ended AND known > 0 AND 5 * capital >= 4 * n THEN 'navigation'
    WHEN n >= 5 AND 10 * odd >= 3 * n THEN 'punctuation'
    WHEN n >= {quality_rules.LONG_LINE_WORDS} AND NOT ended AND 2 * unmarked < chars THEN 'punctuation'
    WHEN n <= 40 AND {quality_rules.PHRASE_SHARE} * ({phrases}) >= n THEN 'boilerplate'
  END AS rule FROM c),
t AS (
  SELECT r, count(*) FILTER (rule = 'punctuation') AS punctuation_lines, count(*) FILTER (rule = 'navigation') AS navigation_lines,
    count(*) FILTER (rule = 'boilerplate') AS boilerplate_lines, coalesce(sum(held) FILTER (rule IS NULL), 0)::BIGINT AS n_kept_words,
    count(*) FILTER (held > 0) - count(DISTINCT line) FILTER (held > 0) AS n_dup_lines FROM v GROUP BY r),
b AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^{quality_rules.SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeated USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_kept_words <= {quality_rules.MAX_LOST} * n_words AS kept,
  punctuation_lines, navigation_lines, boilerplate_lines, n_kept_words FROM f JOIN t USING (r)
"""


def _op11_sql() -> str:
    """Lags from neighbouring occurrences of grams of 16, 32, ... words; then every maximal stretch along those lags."""
    levels, lags, k = [], [], 1
    while k < 1 << 16:  # words of the longest text, at least
        levels.append(f"""
g{2 * k} AS MATERIALIZED (
  SELECT a.r, a.i, dense_rank() OVER (ORDER BY a.v, b.v) AS v FROM g{k} a JOIN g{k} b ON a.r = b.r AND b.i = a.i + {k}
  QUALIFY count(*) OVER (PARTITION BY a.r, a.v, b.v) > 1)""")
        k *= 2
        if k >= periodic_runs.FIRST:
            low = 1 if k == periodic_runs.FIRST else k // 2 + 1
            lags.append(f"SELECT r, q FROM (SELECT r, lead(i) OVER (PARTITION BY r, v ORDER BY i) - i AS q FROM g{k}) WHERE q BETWEEN {low} AND {k}")
    return rf"""
WITH c AS ({_CRC_TABLE}),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_crc("coalesce(doc_id::VARCHAR, '')")} AS h FROM documents, c),
e AS (SELECT r, ws, len(ws) AS n, h % 10 = 0 AND doc_id IS NOT NULL AS echo, (h // 10) % greatest(len(ws), 1) AS a, 3 + (h // 10) % 8 AS f FROM d),
w AS MATERIALIZED (SELECT r, i, ws[1 + CASE WHEN echo AND i >= a THEN a + (i - a) % (1 + (n - a) // f) ELSE i END] AS word FROM e, unnest(range(0, n)) AS u(i)),
g1 AS MATERIALIZED (SELECT r, i, dense_rank() OVER (ORDER BY word) AS v FROM w),{",".join(levels)},
lags AS MATERIALIZED (SELECT DISTINCT r, q FROM ({" UNION ALL ".join(lags)})),
same AS (SELECT lags.r, q, x.i, x.i - row_number() OVER (PARTITION BY lags.r, q ORDER BY x.i) AS island
  FROM lags JOIN g1 x ON x.r = lags.r JOIN g1 y ON y.r = x.r AND y.i = x.i + q AND y.v = x.v),
stretch AS (SELECT r, q, min(i) AS s, count(*) + q AS length FROM same GROUP BY r, q, island HAVING count(*) + q >= greatest({periodic_runs.LEAST_WORDS}, {periodic_runs.LEAST_PERIODS} * q)),
runs AS MATERIALIZED (SELECT r, s AS start, length, min(q) AS period FROM stretch GROUP BY r, s, length),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) = 1),
told AS (SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, i FROM runs, unnest(range(start + period, start + length)) AS u(i)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def _op13_sql() -> str:
    """n-grams as text, buckets by CRC-32 of distinct ones, gains, noise and the draw."""
    grams = " UNION ALL ".join(
        f"SELECT benchmark, r, array_to_string(ws[i:i + {k}], ' ') AS g FROM t, unnest(range(1, len(ws) + 1 - {k})) AS u(i)" for k in range(importance_resampling.ORDERS)
    )
    m = importance_resampling.BUCKETS
    return rf"""
WITH c AS ({_CRC_TABLE}),
t AS MATERIALIZED (
  SELECT row_number() OVER () AS r, benchmark, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT false AS benchmark, doc_id, text FROM documents UNION ALL SELECT true, NULL, text FROM benchmark)),
g AS MATERIALIZED ({grams}),
b AS MATERIALIZED (SELECT g, {_crc("g")} % {m} AS bucket FROM (SELECT DISTINCT g FROM g), c),
f AS MATERIALIZED (SELECT benchmark, r, bucket, count(*) AS n FROM g JOIN b USING (g) GROUP BY ALL),
s AS (SELECT bucket, coalesce(sum(n) FILTER (NOT benchmark), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (benchmark), 0)::DOUBLE AS t FROM f GROUP BY bucket),
z AS (SELECT sum(s) + {m} AS s_all, sum(t) + {m} AS t_all FROM s),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * s_all / ((s + 1) * t_all)))::BIGINT AS gain FROM s, z),
w AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM f JOIN gain USING (bucket) WHERE NOT benchmark GROUP BY r),
o AS (
  SELECT r, doc_id, len(ws) >= 20 AS fit, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM t LEFT JOIN w USING (r) WHERE NOT benchmark),
p AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER () AS n FROM o WHERE fit)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM o LEFT JOIN p USING (r)
"""


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_language_id": op5_language_id,
    "op6_token_counts": op6_token_counts,
    "op7_bpe": op7_bpe,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_vector_packing": op12_vector_packing,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL = {
    "op1_substring_dedup": OP1_SQL,
    "op3_quality_rules": _op3_sql(),
    "op4_embedding_dedup": OP4_SQL,
    "op8_sharding": _op8_sql(),
    "op11_periodic_runs": _op11_sql(),
    "op13_importance_resampling": _op13_sql(),
}
