"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import align, decontaminate, hostrules, html, jaccard, langid, lines, packing, quality, resample, substring, topk, toxicity
from salesmart.llm.shared import table, tokenizer_file, vocabulary

SPACES = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = topk.exact_top_k(vectors.filter(F.col("id") % 100 == 0), vectors, k=10)
    return found.select("query_id", "rank", F.col("item_id").alias("vec_id"), "score")


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP2_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), capacity=4096, end_id=1)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"), least_chars=20, least_docs=3)
    return kept.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents),
k AS (SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, coalesce(k.doc_id <> f.keeper, false) AS dropped FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.dedup_substrings(table(spark, sf_dir, "documents"), size=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP4_SQL = f"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS words FROM documents),
p AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS again FROM p),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM r WHERE again),
k AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
j AS (SELECT k.*, g.place IS NOT NULL AS gone FROM k LEFT JOIN g USING (doc_id, place)),
s AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept FROM j GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN s USING (doc_id)
"""


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.5)
    return judged.select(F.col("doc.doc_id").alias("doc_id"), "evidence", "host_share", "path_share", "p_good", F.col("keep").cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return toxicity.score(docs, model, cut=0.7).select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, remainder(4) != 2)
    return langid.identify(docs, model).select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op11_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.judge(table(spark, sf_dir, "documents")).drop("n_lines")


HOST_RULES = {"symbols": ("n_symbols", "n_words", 5), "dup_lines": ("n_dup_lines", "n_lines", 30), "long_words": ("word_chars", "n_words", 1200), "short_words": ("n_words", "word_chars", 40)}
HOST_PRIORS = ", ".join(
    f"""sum({f}) / sum(n) AS mean_{f}, (sum({f} * {f} / n) - sum({f}) * sum({f}) / sum(n)) / (count(*) - 1) AS msb_{f},
    (sum({f}) - sum({f} * {f} / n)) / (sum(n) - count(*)) AS msw_{f}"""
    for f in ("failed", *HOST_RULES)
)
HOST_PULLS = ", ".join(
    f"""mean_{f}, CASE WHEN hosts < 2 OR docs <= hosts OR msb_{f} - msw_{f} <= 0 OR msb_{f} + (usual - 1) * msw_{f} <= 0 THEN 1000.0
    ELSE least(1000.0, greatest(1.0, (msb_{f} + (usual - 1) * msw_{f}) / (msb_{f} - msw_{f}) - 1)) END AS pull_{f}"""
    for f in ("failed", *HOST_RULES)
)
HOST_RATES = ", ".join(f"round((h.{f} + pull_{f} * mean_{f}) / (h.n + pull_{f}), 9) AS rate_{f}, greatest({0.5 if f == 'failed' else 0.25}::DOUBLE, 2 * mean_{f}) AS cut_{f}" for f in ("failed", *HOST_RULES))
OP11_SQL = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS words, string_split(coalesce(text, ''), chr(10)) AS lines,
           nullif(lower(regexp_extract(trim(source), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)', 1)), '') AS host FROM documents),
g AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
t AS (SELECT r, win FROM g GROUP BY r, win HAVING count(*) > 1),
c AS (SELECT r, count(DISTINCT place) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS place FROM g JOIN t USING (r, win)) GROUP BY r),
m AS (SELECT doc_id, r, host, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines FROM w),
d AS (SELECT doc_id, r, host, n_words, word_chars, n_symbols, CAST(len(full_lines) AS BIGINT) AS n_lines, CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM m LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {", ".join(f"100 * {a} > {k} * {b} AS near_{n}" for n, (a, b, k) in HOST_RULES.items())},
      100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines AS outright FROM d),
h AS (SELECT host, count(*)::DOUBLE AS n, (count(*) FILTER (base_failed OR outright))::DOUBLE AS failed, {", ".join(f"(count(*) FILTER (near_{n}))::DOUBLE AS {n}" for n in HOST_RULES)} FROM b WHERE host IS NOT NULL GROUP BY host),
p AS (SELECT count(*) AS hosts, sum(n) AS docs, (sum(n) - sum(n * n) / sum(n)) / (count(*) - 1) AS usual, {HOST_PRIORS} FROM h),
q AS (SELECT {HOST_PULLS} FROM p),
v AS (SELECT host, {HOST_RATES} FROM h, q)
SELECT doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN host IS NULL THEN NULL WHEN rate_failed >= cut_failed THEN 'blocked' WHEN {" OR ".join(f"rate_{n} >= cut_{n}" for n in HOST_RULES)} THEN 'watched' ELSE 'trusted' END AS host_verdict,
       NOT base_failed AND NOT outright AND NOT coalesce(rate_failed >= cut_failed, false) AND NOT ({" OR ".join(f"(near_{n} AND coalesce(rate_{n} >= cut_{n}, false))" for n in HOST_RULES)}) AS kept
FROM b LEFT JOIN v USING (host)
"""


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, least_words=20, seed=7)


#: CRC-32 byte by byte over a table of 256 remainders, made from the polynomial.
OP12_SQL = rf"""
WITH RECURSIVE steps AS (SELECT i, i AS v, 0 AS k FROM range(256) t(i) UNION ALL
                         SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS remainders FROM steps WHERE k = 8),
w AS (SELECT 0 AS side, doc_id, row_number() OVER () AS r, {r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS words FROM documents
      UNION ALL SELECT 1, NULL, row_number() OVER (), {r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} FROM benchmark),
f AS (SELECT side, r, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM w),
u AS (SELECT side, r, feature, count(*) AS n FROM f GROUP BY ALL),
e AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM u)),
c AS (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT)),
             lambda a, b: xor(a >> 8, remainders[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket FROM e, tab),
b AS (SELECT side, r, bucket, n FROM u JOIN c USING (feature)),
s AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM b GROUP BY bucket),
z AS (SELECT sum(s) AS whole, sum(t) AS wanted FROM s),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce(whole, 0) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(wanted, 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM s, z),
m AS (SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight FROM b JOIN g USING (bucket) WHERE side = 0 GROUP BY r),
d AS (SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w LEFT JOIN m USING (r) WHERE side = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) FILTER (n_words >= 20) OVER () AS able FROM d)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN place END AS rank FROM k
"""


def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_html_extraction": op10_html_extraction,
    "op11_host_rules": op11_host_rules,
    "op12_resample": op12_resample,
    "op13_align_tokenizers": op13_align_tokenizers,
}
SQL: dict[str, str] = {"op1_exact_top_k": OP1_SQL, "op2_jaccard_join": OP2_SQL, "op4_substring_dedup": OP4_SQL, "op7_line_dedup": OP7_SQL, "op11_host_rules": OP11_SQL, "op12_resample": OP12_SQL}
