"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv.llm import (
    decontaminate, exact_dedup, hard_negatives, licenses, mixing, personal, phrase_dedup, prefix_join, quality, runs, token_files,
    toxicity, warc,
)
from kollektiv.llm.common import prepare, scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"


@register("op1_mix_sources", rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_WORDS})), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null')
           || CASE WHEN doc_id IS NULL OR count(*) OVER (PARTITION BY doc_id) > 1
                   THEN ':' || md5(coalesce(text, '')) || ':' || (row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) - 1)
                   ELSE '' END), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
           / (1.0 / (1.0 + 10.0 * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '%&$#*!|', '')))
                     / greatest(length(coalesce(text, '')), 1))) AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM per),
goals AS (
  SELECT source, source_size, n,
         coalesce(least(cap, (SELECT max(level) FROM levels WHERE cap >= level * weight) * weight), cap) AS target
  FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM goals),
ordered AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id NULLS FIRST, s.size) - s.size / 2 AS middle
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN middle <= budget THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ordered""")
def op1(spark, sf_dir):
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op2_warc_archives", """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS stored FROM p GROUP BY payload),
hex AS (SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, sha1(payload) AS h, stored
        FROM p JOIN firsts USING (payload)),
bits AS (SELECT *, list_aggregate(list_transform(range(0, 40), lambda i:
           lpad(bin(('0x' || substr(h, i + 1, 1))::INTEGER), 4, '0')), 'string_agg', '') AS b FROM hex)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', list_aggregate(list_transform(range(0, 5), lambda j:
           substr(b, i * 5 + j + 1, 1)::INTEGER * (1 << (4 - j))), 'sum')::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = stored THEN NULL ELSE stored END AS refers_to
FROM bits""")
def op2(spark, sf_dir):
    prepare(spark)
    return warc.pages_through_warc(table(spark, sf_dir, "pages"))


@register("op9_exact_dedup", f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d""")
def op9(spark, sf_dir):
    prepare(spark)
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op3_token_files")
def op3(spark, sf_dir):
    prepare(spark)
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, _tokenizer())
    return token_files.layout(token_files.checksums(spark, path))


@register("op4_toxicity")
def op4(spark, sf_dir):
    prepare(spark)
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_phrase_dedup")
def op10(spark, sf_dir):
    prepare(spark)
    return phrase_dedup.phrase_dedup(table(spark, sf_dir, "documents"))


@register("op5_jaccard_join", rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
           FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
reach AS (SELECT doc_id AS a, doc_id AS r FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, min(r) AS component_id
FROM sets s JOIN reach ON s.doc_id = reach.a GROUP BY s.doc_id, s.s""")
def op5(spark, sf_dir):
    prepare(spark)
    return prefix_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op6_quality")
def op6(spark, sf_dir):
    prepare(spark)
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_benchmark_leaks", rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
      FROM w WHERE len(w) >= 5),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
      FROM b WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT doc_id, i.item_id, n_shingles, count(*) AS n_common, count(*) / n_shingles::DOUBLE AS containment
FROM d JOIN i ON d.g = i.g JOIN n ON i.item_id = n.item_id
GROUP BY doc_id, i.item_id, n_shingles HAVING 100 * count(*) >= 80 * n_shingles""")
def op7(spark, sf_dir):
    prepare(spark)
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_license_scan")
def op8(spark, sf_dir):
    prepare(spark)
    return licenses.licenses(table(spark, sf_dir, "documents"))


@register("op11_periodic_runs")
def op11(spark, sf_dir):
    prepare(spark)
    return runs.run_digests(runs.periodic_runs(runs.plant(table(spark, sf_dir, "documents"))))


@register("op12_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, row_number() OVER () AS r
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.r AS anchor_row, b.vec_id AS id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, anchor_row, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_row, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_row = s.anchor_row AND NOT same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""")
def op12(spark, sf_dir):
    prepare(spark)
    vec_id, label = F.col("vec_id"), F.col("label")
    return hard_negatives.hard_negatives(hard_negatives.quantised(
        table(spark, sf_dir, "embeddings"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label), vec_id % 50 == 0))


@register("op13_personal_data")
def op13(spark, sf_dir):
    prepare(spark)
    return personal.span_digests(personal.find_personal(table(spark, sf_dir, "documents")))


@register("pipeline")
def pipeline(spark, sf_dir):
    from corpus_pipeline import run
    return run(spark, sf_dir)
