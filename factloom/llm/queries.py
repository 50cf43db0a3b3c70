"""The queries of this subpackage and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import decontaminate, exactdedup, htmltext, jaccardjoin, linededup, mixing, sharding, suffixdedup, toxicity, urlfilter
from factloom.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.digest(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digest(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.digest(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccardjoin.digest(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.digest(table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_sharding, op2_exact_dedup, op3_suffix_dedup, op4_mixing, op5_url_filter, op6_line_dedup, op7_toxicity, op8_jaccard_join, op9_html_extraction, op10_decontamination, pipeline)}

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

SQL = {
    "op4_mixing": mixing.sql(),
    "op2_exact_dedup": """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)""",
    "op5_url_filter": f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), {_UPPER}, {_LOWER}) AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule, rhost, rpath, verdict) AS (VALUES ('com/en/', 'com', '/en/', 'block'), ('example.com/en/7', 'example.com', '/en/7', 'allow'), ('net/de/', 'net', '/de/', 'allow'), ('example.net/de/8', 'example.net', '/de/8', 'block'), ('org/es/', 'org', '/es/', 'block')),
best AS (SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM parts p LEFT JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best""",
    "op6_line_dedup": f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
k AS (SELECT *, translate(trim(line, {_SPACE}), {_UPPER}, {_LOWER}) AS key FROM l),
hot AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, hot.key IS NOT NULL AND k.doc_id <> hot.last AS dropped FROM k LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256 FROM m GROUP BY doc_id""",
    "op10_decontamination": f"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(10, len(w)) AS n FROM bw WHERE len(w) > 0),
bwin AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bi)),
sizes AS (SELECT DISTINCT n FROM bwin),
dwin AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM dw, sizes)),
hits AS (SELECT d.doc_id, d.i, d.n, b.item_id FROM dwin d JOIN bwin b ON d.n = b.n AND d.g = b.g),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
