"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmetrics.llm.common import table

QUERIES = {}
ORACLE_SQL = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.bpe import encode_decode

    coded = encode_decode(table(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.licenses import scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents"))
    no_labels = F.array().cast("array<string>")
    base = F.coalesce(F.transform("base", lambda b: b.label), no_labels)
    own = F.coalesce(F.transform("detections", lambda d: d.label), no_labels)
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.select(
        "doc_id", "n_words",
        F.coalesce(F.aggregate("base", F.lit(0).cast("long"), lambda a, b: a + b.n), F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda d: d.score)), F.lit(0.0)),
                   F.when(F.size(base) > 0, 0.7).otherwise(0.0)).alias("score"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.line_dedup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op8_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(trim(line, E' \t\n\x0B\x0C\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.doc_id, k.i, k.line, r.key IS NOT NULL AND k.doc_id <> r.last AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.decontaminate import find_contamination

    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"), keep=["url"]).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.langid import fit, held_out, predict

    docs = table(spark, sf_dir, "documents")
    return predict(docs, *fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.ngram_join import link_documents

    return link_documents(table(spark, sf_dir, "documents"))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.secrets import scan_secrets

    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "word", "nth", F.sha2("finding", 256).alias("finding_sha256"), "kind", "score", "is_secret")


def _url_sql() -> str:
    from segmetrics.llm.urls import BASE_RULES, PATTERNS

    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ", ".join(f"({quote(r)}, {quote(r[:r.index('/')])}, {quote(r[r.index('/'):])}, {quote(a)})" for a, r in BASE_RULES)
    hits = " ".join(f"WHEN regexp_matches(low, {quote(p.regex)}) THEN {quote(p.name)}" for p in PATTERNS)
    acts = " ".join(f"WHEN {quote(p.name)} THEN {quote(p.action)}" for p in PATTERNS)
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH r(rule, h, p, action) AS (VALUES {rules}),
u AS (SELECT row_number() OVER () AS i, page_id, {low.format("coalesce(url, '')")} AS low,
             CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT i, page_id, low, {low.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT i, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
      FROM v JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY i),
x AS (SELECT v.*, f.rule, f.action, CASE WHEN f.rule IS NOT NULL THEN NULL {hits} END AS pattern FROM v LEFT JOIN f USING (i))
SELECT page_id, host, path, rule, pattern, coalesce(action, CASE pattern {acts} END, 'allow') AS verdict FROM x"""


ORACLE_SQL["op2_url_filters"] = _url_sql()
ORACLE_SQL["op9_decontaminate"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(a[s:s + n - 1], ' ') AS g, n
        FROM (SELECT item, a, least(13, len(a)) AS n, unnest(range(1, greatest(len(a) - 12, 1) + 1)) AS s FROM b WHERE len(a) > 0)),
dw AS (SELECT doc_id, s, n, array_to_string(a[s:s + n - 1], ' ') AS g
       FROM (SELECT doc_id, a, n, unnest(range(1, len(a) - n + 2)) AS s FROM w, (SELECT DISTINCT n FROM win) WHERE len(a) >= n)),
hit AS (SELECT dw.doc_id, dw.s, dw.n, win.item FROM dw JOIN win ON dw.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
who AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT w.doc_id, len(w.a) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.a) AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN who USING (doc_id)"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.hard_negatives import mine

    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), label=shifted)


ORACLE_SQL["op11_hard_negatives"] = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS z
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.z, b.z) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 5
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.spelling import group_variants

    return group_variants(table(spark, sf_dir, "documents"))


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmetrics.llm.quality import fit, judge

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, fit(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *[F.col(f"stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "rule", "kept")
