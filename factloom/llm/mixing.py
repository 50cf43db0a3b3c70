"""Mixing sources to target weights: iterative proportional fitting over token counts, then calibrated sampling.

1. Documents are summed to cells of (source, language, topic): token counts. Everything after works on the cells.
2. Raking: by turns the cells' weights are scaled so that the weights of each source, language and topic sum to its
   target share of all tokens; ``ROUNDS`` rounds over the three.
3. Calibration: a document's probability is min(1, rate * weight / tokens) of its cell, with the one rate at which the
   expected tokens are ``BUDGET`` of all. Cells that reach 1 are held there and the rate is solved for the others, until no
   further cell reaches 1. ``weight`` tells how often a token of the cell should count relative to an average one.
4. A document is sampled if a uniform number from the MD5 of its doc_id is below its probability: the same answer on
   every run, on any partitioning.
5. The mix holds a sampled document rate * weight times on average: cells held at probability 1 are repeated (the whole part
   for sure, the rest by the same uniform number), so that the marginals of the mix's tokens are the targets. ``BUDGET``
   is the share of the tokens that the mix holds at least once. The digest has one row per document; there, sampled tokens
   counted weight / probability times have the targets' marginals.

DataFrame operations only. Default targets flatten the observed shares: share**POWER, normalised. Topics come from
ordered text rules. Cells are as many as combinations that occur; no join or window has a document's row in it but the
last, which hands each document its cell's probability.

Defined results: a null source or language is a value of its own; null and empty texts have no tokens, and cells without
tokens have weight 0 and probability 1, as they change no share; a document without tokens is in the mix once at most; rows
of one doc_id are sampled alike; no rows give no rows; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factloom.llm.common import shielded, sized, written

DIMENSIONS = ("source", "lang", "topic")
ROUNDS, POWER, BUDGET, MAX_SOLVES = 10, 0.5, 0.8, 50
#: Ordered rules: the first pattern found names the topic; texts that fit none are prose.
TOPICS = (("licence", "[Ll]icen[cs]e|[Cc]opyright"), ("contact", "[a-z0-9]@[a-z0-9]"), ("table", " [|] "), ("shout", "[A-Z]!! "))
OTHER_TOPIC = "prose"
NONE = "(none)"


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def described(docs: DataFrame) -> DataFrame:
    """``docs`` with n_tokens, u (uniform in [0, 1)) and the cell's _source, _lang and _topic."""
    text = F.coalesce(F.col("text"), F.lit(""))
    u = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")), 1, 12), 16, 10).cast("double") / float(16**12)
    return docs.withColumns({"_tokens": F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"), "_u": u, "_source": F.coalesce("source", F.lit(NONE)), "_lang": F.coalesce("lang", F.lit(NONE)), "_topic": topic_of(text)})


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``: their marginals are the targets' shares of all tokens.

    A target is a DataFrame of a dimension's value and its ``share``; values without a target keep no weight.
    """
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        target = (targets or {}).get(d)
        if target is None:
            flat = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(POWER)).alias("p"))
            target = flat.select(d, (F.col("p") / F.sum("p").over(W.partitionBy(F.lit(1)))).alias("share"))
        out = out.join(target.select(d, F.col("share").alias(f"{d}_share")), d, "left").fillna(0.0, [f"{d}_share"])
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    out = written(out, "cells")
    for r in range(rounds):
        for d in DIMENSIONS:
            own = F.sum("weight").over(W.partitionBy(d))
            out = out.withColumn("weight", F.when(own > 0, F.col("weight") * F.col(f"{d}_share") * F.lit(total) / own).otherwise(0.0))
        if r % 2 or r == rounds - 1:
            out = written(out, "raked")
    return out


def calibrate(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Cells with ``probability``, ``weight`` per token and ``copies``, how often the mix holds a document on average."""
    per_token = cells.withColumn("weight", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0))
    goal = budget * float(cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0)
    rate = 0.0
    for _ in range(MAX_SOLVES):
        held = F.col("weight") * rate >= 1
        sums = per_token.agg(F.sum(F.when(held, F.col("tokens")).otherwise(0)).cast("double").alias("full"), F.sum(F.when(held, 0.0).otherwise(F.col("weight") * F.col("tokens"))).alias("open")).first()
        solved = (goal - (sums.full or 0.0)) / sums.open if sums.open else rate
        if solved <= rate:
            break
        rate = solved
    return per_token.withColumn("copies", F.when(F.col("tokens") > 0, F.col("weight") * rate).otherwise(1.0)).withColumn("probability", F.least(F.lit(1.0), F.col("copies")))


def weighted(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """``docs`` with _tokens, _topic, _weight, _probability, _sampled and _copies (how often the mix holds the row)."""
    full = described(docs)
    cells = full.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("tokens"))
    found = written(calibrate(rake(written(cells, "cells"), targets), budget), "calibrated")
    small = sized(found.select(*(F.col(d).alias(f"_{d}") for d in DIMENSIONS), F.col("weight").alias("_weight"), F.col("probability").alias("_probability"), F.col("copies").alias("_expected")), 120)
    whole = F.floor("_expected")
    copies = F.when(F.col("_tokens") > 0, whole + (F.col("_u") < F.col("_expected") - whole).cast("long")).otherwise((F.col("_u") < F.col("_probability")).cast("long"))
    return full.join(small, [f"_{d}" for d in DIMENSIONS], "left").withColumn("_sampled", F.col("_u") < F.col("_probability")).withColumn("_copies", copies)


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled rows of ``docs``, those of capped cells repeated, so that the tokens' marginals are the targets."""
    inner, restore = shielded(docs, "doc_id", "text", "source", "lang")
    held = weighted(inner, targets, budget).filter("_copies > 0")
    return restore(held.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its cell, tokens, weight, probability and whether it was sampled."""
    slim = written(described(docs.select("doc_id", "text", "source", "lang")).drop("text", "source", "lang"), "described")
    cells = slim.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("tokens"))
    found = written(calibrate(rake(written(cells, "cells"))), "calibrated")
    small = sized(found.select(*(F.col(d).alias(f"_{d}") for d in DIMENSIONS), "weight", "probability"), 120)
    out = slim.join(small, [f"_{d}" for d in DIMENSIONS], "left")
    return out.select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), (F.col("_u") < F.col("probability")).alias("sampled"))


def sql(documents: str = "documents") -> str:
    """The digest in DuckDB SQL; ``documents`` is a table of doc_id, text, source and lang."""
    topic = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS) + f" ELSE '{OTHER_TOPIC}' END"
    out = f"""WITH d0 AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, coalesce(text, '') AS t,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / {float(16**12)!r} AS u FROM {documents}),
d AS MATERIALIZED (SELECT doc_id, source, lang, {topic} AS topic, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens, u FROM d0),
c AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)"""
    for x in DIMENSIONS:
        out += f",\nt_{x} AS MATERIALIZED (SELECT {x}, p / sum(p) OVER () AS {x}_share FROM (SELECT {x}, pow(sum(tokens), {POWER}) AS p FROM c GROUP BY {x}))"
    out += ",\nr0 AS MATERIALIZED (SELECT c.*, tokens AS w, source_share, lang_share, topic_share, (SELECT sum(tokens) FROM c) AS total FROM c JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic))"
    k = 0
    for _ in range(ROUNDS):
        for x in DIMENSIONS:
            k += 1
            out += f",\nr{k} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {x}) > 0 THEN w * {x}_share * total / sum(w) OVER (PARTITION BY {x}) ELSE 0 END AS w) FROM r{k - 1})"
    out += f",\nq AS MATERIALIZED (SELECT source, lang, topic, tokens, total, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS weight FROM r{k}),\nl0 AS (SELECT 0.0::DOUBLE AS rate)"
    for i in range(1, 13):
        out += f",\nl{i} AS MATERIALIZED (SELECT greatest((SELECT rate FROM l{i - 1}), (SELECT ({BUDGET} * max(total) - sum(CASE WHEN weight * rate >= 1 THEN tokens ELSE 0 END)) / nullif(sum(CASE WHEN weight * rate >= 1 THEN 0 ELSE weight * tokens END), 0) FROM q, l{i - 1})) AS rate)"
    return out + """,
p AS (SELECT source, lang, topic, weight, CASE WHEN tokens > 0 THEN least(1.0, weight * rate) ELSE 1.0 END AS probability FROM q, l12)
SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS weight, round(probability, 6) AS probability, u < probability AS sampled FROM d JOIN p USING (source, lang, topic)"""


