"""The registered queries of this subpackage, one per operator, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm import divergence, fill_middle, grammar, html_text, kneser_ney, mixing, near_dup, packing, pii, quality, sharding, topk, url_filter
from hitledger.llm.shared import stored, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@_register
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every text, the base rule and the verdict of certified cutoffs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = stored(quality.measure(docs, "m", keep_text=False), "measures")
    cutoffs = quality.calibrate(measured, table(spark, sf_dir, "labels"), "m")
    rows = quality.judge(measured, cutoffs, "m", "kept")
    columns = [F.col("m")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select("doc_id", *columns, quality.base_failed(F.col("m")).alias("base_failed"), "kept")


@_register
def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link_components(table(spark, sf_dir, "documents"), threshold=85)


ORACLE_SQL["op5_near_dup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
),
named AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, sets.doc_id = component_id AS kept
FROM sets JOIN named USING (doc_id)
"""


@_register
def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts by a model of the documents that are not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    model = kneser_ney.train(docs.where(~F.col("held_out")), order=2)
    return kneser_ney.score(docs, model).select("doc_id", "held_out", "lm.*", F.lit(model.train_tokens).cast("long").alias("train_tokens"))


@_register
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, width=4096)


@_register
def op9_grammar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as compressed id files and read back from them."""
    docs = table(spark, sf_dir, "documents")
    return grammar.read_shards(grammar.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0))


@_register
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20, scale=64.0)


ORACLE_SQL["op1_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 20
"""


@_register
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@_register
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_register
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.learn(docs), "found").select("doc_id", "found.*")


@_register
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page, its lines and its words."""
    rows = html_text.extract(table(spark, sf_dir, "pages"), "html", "text")
    return rows.select("page_id", "url", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), mixing.word_count("text").alias("n_words"))


@_register
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of all texts: digests of the outputs and of the texts rebuilt from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = fill_middle.fill_middle(docs, "fim").select("doc_id", "fim.*")
    digests = [F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLE_SQL["op11_fill_middle"] = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
),
hashed AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM units
),
cut AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM hashed
),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


@_register
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
words AS (SELECT doc, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
langs AS (SELECT lang, sum(n) AS n, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term),
dense AS (
  SELECT lang, source, term, kept.n AS lang_n, CAST(coalesce(counts.n, 0) AS HUGEINT) AS n
  FROM sources JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM dense GROUP BY lang, source),
shares AS (
  SELECT lang, source, term, dense.n, 1 + (1000000000 * (dense.n + 1)) // (total + v) AS p, 1 + (1000000000 * (lang_n + 1)) // (langs.n + v) AS q
  FROM dense JOIN totals USING (lang, source) JOIN langs USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((
    SELECT sum(((x.p - y.p) * (x.p - y.p)) // y.p) FROM shares x JOIN shares y ON x.term = y.term
    WHERE x.lang = a.lang AND x.source = a.source AND y.lang = a.lang AND y.source = b.source), 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT 'term' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


# Host, start of the path and verdict of each rule.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_register
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE_SQL["op13_url_filter"] = url_filter.judge_sql(URL_RULES)
