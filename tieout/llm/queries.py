"""One query per operator, over its whole table, and the pipeline's operators' shared settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column
from pyspark.sql import functions as F

from tieout.llm import (
    chat,
    embedding_dedup,
    importance,
    language_id,
    packing,
    quality,
    quality_rules,
    simhash,
    substring_dedup,
    topk,
    url_filter,
    whitening,
    word_bpe,
)
from tieout.llm.common import table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: The rules that pages are judged by; fixed values.
URL_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


def remainder(by: int) -> Column:
    """crc32 of doc_id as text, by which rows are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(by))


def op1_language_id(spark, sf):
    documents = table(spark, sf, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    model = language_id.train(documents.where(~held_out))
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.predict(rows, model).drop("text")


def op2_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op3_embedding_near_dedup(spark, sf):
    return embedding_dedup.near_duplicates(table(spark, sf, "embeddings"))


def op4_chat_formatting(spark, sf):
    return chat.perspectives(table(spark, sf, "conversations"))


def op5_quality_classifier(spark, sf):
    documents = table(spark, sf, "documents")
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    model = quality.train(documents.where(~held_out), table(spark, sf, "labels"))
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    scored = quality.score(rows, model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_word_bpe(spark, sf):
    return word_bpe.digests(table(spark, sf, "documents"), WORD_VOCABULARY)


def op7_simhash_near_dedup(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op8_substring_dedup(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    found = substring_dedup.deduplicate(documents, keep_text=False)
    return found.drop("text").withColumnRenamed("kept", "kept_sha256")


def op9_exact_top_k(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op10_url_filters(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"), URL_RULES).drop("template")


#: The measures that every document reports, whatever rejects it.
RULE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op11_quality_rules(spark, sf):
    found = quality_rules.cascade(table(spark, sf, "documents"), given=RULE_MEASURES)
    repeated = 100 * F.col("n_repeat_words") > 20 * F.col("n_words")
    failed = ((F.col("n_words") < 10) | repeated).alias("base_failed")
    return found.select("doc_id", *RULE_MEASURES, failed, "kept")


def op12_importance_resampling(spark, sf):
    return importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_embedding_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_best_fit_packing, op3_embedding_near_dedup, op4_chat_formatting,
        op5_quality_classifier, op6_word_bpe, op7_simhash_near_dedup, op8_substring_dedup,
        op9_exact_top_k, op10_url_filters, op11_quality_rules,
        op12_importance_resampling, op13_embedding_whitening,
    )
}

ORACLES = {
    "op3_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
usable AS (
  SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
""",
    "op4_chat_formatting": chat.PERSPECTIVES_SQL,
    "op8_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS start, words FROM w WHERE len(words) >= 20),
h AS (SELECT doc_id, start, array_to_string(words[start : start + 19], ' ') AS phrase FROM s),
e AS (
  SELECT doc_id, start, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, start) > 1 AS again
  FROM h),
p AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM w),
g AS (
  SELECT p.doc_id, place, word, coalesce(max(CASE WHEN again THEN 1 ELSE 0 END) OVER (
           PARTITION BY p.doc_id ORDER BY place ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM p LEFT JOIN e ON e.doc_id = p.doc_id AND e.start = p.place),
r AS (
  SELECT doc_id, sum(gone) AS n_removed,
         string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0) AS kept
  FROM g GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)
""",
    "op9_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op10_url_filters": url_filter.judge_sql(URL_RULES),
    "op11_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (
  SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
v AS (
  SELECT r, unnest(range(1, len(words) - 3)) AS start, words FROM w WHERE len(words) >= 5),
f AS (SELECT r, start, array_to_string(words[start : start + 4], ' ') AS phrase FROM v),
g AS (SELECT r, start, count(*) OVER (PARTITION BY r, phrase) > 1 AS again FROM f),
p AS (SELECT DISTINCT r, unnest(range(start, start + 5)) AS place FROM g WHERE again),
n AS (SELECT r, count(*) AS n_repeat_words FROM p GROUP BY r),
m AS (
  SELECT w.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_lettered,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[•\-*]'))) AS n_bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipses
  FROM w JOIN l USING (r) LEFT JOIN n USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words
    OR word_chars > 10 * n_words OR 10 * n_lettered < 8 * n_words OR 10 * n_dup_lines > 3 * n_lines
    OR 10 * n_bullets > 9 * n_lines OR 10 * n_ellipses > 3 * n_lines) AS kept
FROM b
""",
    "op12_importance_resampling": r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS c FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM bits WHERE k < 8),
tab AS (SELECT i, c AS t FROM bits WHERE k = 8),
lower_cased AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  FROM benchmark),
w AS (
  SELECT side, r, doc_id,
    regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lower_cased),
u AS (SELECT side, r, unnest(words) AS word, unnest(range(len(words))) AS place FROM w),
o AS (
  SELECT side, r, word AS f FROM u
  UNION ALL
  SELECT a.side, a.r, a.word || ' ' || b.word
  FROM u a JOIN u b ON a.side = b.side AND a.r = b.r AND a.place + 1 = b.place),
n AS (SELECT side, r, f, count(*) AS n FROM o GROUP BY ALL),
d AS (SELECT DISTINCT f, hex(encode(f)) AS hx FROM n),
crc AS (
  SELECT f, hx, 1 AS pos, CAST(4294967295 AS BIGINT) AS c FROM d
  UNION ALL
  SELECT f, hx, pos + 2, xor(c >> 8, t)
  FROM crc JOIN tab ON i = xor(c, CAST('0x' || substr(hx, pos, 2) AS BIGINT)) & 255
  WHERE pos < length(hx)),
b AS (SELECT f, xor(c, 4294967295) % 10000 AS bucket FROM crc WHERE pos > length(hx)),
h AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 0), 0) AS s,
         coalesce(sum(n) FILTER (WHERE side = 1), 0) AS t
  FROM n JOIN b USING (f) GROUP BY bucket),
total AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM h),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE)
                                      / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM h, total),
m AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS total
  FROM n JOIN b USING (f) JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
e AS (
  SELECT w.r, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
    CASE WHEN n_features IS NULL THEN 0
         ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN m ON w.r = m.r WHERE side = 0),
z AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM e),
k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank,
         count(*) OVER () AS total
  FROM z WHERE n_words >= 20)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN rank <= 25 * total // 100 THEN rank END AS rank
FROM z LEFT JOIN k USING (r)
""",
}
