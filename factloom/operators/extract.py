"""Extraction: one scan of the observations, all rules as literals, one explode. And the grouping into scored claims."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.functions.storage import spread
from factloom.sources.rules import RuleSet

#: Code points of a MAC address that name its vendor.
PREFIX = 8
EXTRACTION = "target_kind, target, value, witness_group, rule_id, start, end".split(", ")


def normalised(rules: RuleSet, kind: str, target: str, value: Column) -> Column:
    if kind == "link_basis":
        return expr.normalize_mac(value) if target == "mac" else expr.normalize_hostname(value) if target == "hostname_token" else value
    tables = rules.aliases.get(target)
    if tables is None:
        return value
    return expr.alias(value, tables, rules.rebrand.get(target, {}))


def _nested(pattern: str):
    """Arrow fallback for patterns whose group v is nested: Python's own re."""

    @F.pandas_udf("value string, start int, end int")
    def find(payload: pd.Series) -> pd.DataFrame:
        def one(text):
            m = re.search(pattern, text) if text is not None else None
            if not m or m.group("v") is None:
                return None, None, None
            v = m.group("v").strip()
            start = m.start("v") + len(m.group("v")) - len(m.group("v").lstrip())
            return v, start, start + len(v)

        return pd.DataFrame([one(t) for t in payload], columns=["value", "start", "end"]).astype({"start": "Int32", "end": "Int32"})

    return find


def _cell(kind: str, target: str, value: Column, group: Column, rule_id: str, start: Column, end: Column, when: Column) -> Column:
    body = F.struct(F.lit(kind).alias("target_kind"), F.lit(target).alias("target"), value.alias("raw"), group.alias("witness_group"), F.lit(rule_id).alias("rule_id"), start.cast("int").alias("start"), end.cast("int").alias("end"))
    return F.when(when & value.isNotNull() & (value != ""), body)


def _clean(rules: RuleSet) -> Column:
    """The normalised ``raw`` of a reading."""
    kind, target, raw = F.col("target_kind"), F.col("target"), F.col("raw")
    clean = F.when((kind == "link_basis") & target.isin("mac", "hostname_token"), F.when(target == "mac", normalised(rules, "link_basis", "mac", raw)).otherwise(normalised(rules, "link_basis", "hostname_token", raw)))
    for name in rules.aliases:
        clean = clean.when((kind != "link_basis") & (target == name), normalised(rules, "field", name, raw))
    return clean.otherwise(raw)


def extract(observations: DataFrame, rules: RuleSet) -> DataFrame:
    """obs_id, source and the columns of EXTRACTION: one row for each rule that found something in a mapped source."""
    return readings(observations, rules).filter("value <> ''").select("obs_id", "source", *EXTRACTION)


def readings(observations: DataFrame, rules: RuleSet, kind: str | None = None) -> DataFrame:
    """What ``extract`` returns, with the place among the rules (seq), the value before it was normalised (raw), and those it emptied.

    With ``kind``, those of one target_kind: the others are not matched, and seq counts within the kind.
    """
    e, groups, none = rules.extraction, rules.source_groups(), F.lit(None)
    source, payload = F.col("source"), F.coalesce("raw_payload", F.lit(""))
    ready = spread(observations).withColumn("witness", expr.lookup(groups, source)).filter("witness is not null")
    # each match, strip and list is a column of its own: the cells use them more than once
    spans, placed, cells = {"_ports": expr.port_list(F.col("open_ports")), "_prefix": F.substring(F.upper(expr.strip(F.col("mac"))), 1, PREFIX)}, {}, []
    wanted = lambda rule: kind in (None, rule["target_kind"])
    for n, (name, rule) in enumerate((n, r) for n, r in e.get("rules", {}).items() if wanted(r)):
        mine = source.isin(list(rule["sources"]))
        try:
            raw, lead = expr.first_span(payload, rule["pattern"])
            spans |= {f"_raw{n}": F.when(mine, raw), f"_lead{n}": F.when(mine, lead)}
            found = expr.placed(F.col(f"_raw{n}"), F.col(f"_lead{n}"))
            placed |= dict(zip((f"_value{n}", f"_start{n}", f"_end{n}"), found, strict=True))
        except expr.UnsupportedPattern:
            spans[f"_found{n}"] = _nested(rule["pattern"])(F.when(mine, payload))
            placed |= {f"_{c}{n}": F.col(f"_found{n}")[c] for c in ("value", "start", "end")}
        cells.append(_cell(rule["target_kind"], rule["target"], F.col(f"_value{n}"), F.col("witness"), f"extraction.yaml#{name}", F.col(f"_start{n}"), F.col(f"_end{n}"), mine))
    for n, (name, rule) in enumerate((n, r) for n, r in e.get("structured", {}).items() if wanted(r)):
        spans[f"_own{n}"] = expr.strip(F.col(rule["column"]))
        cells.append(_cell(rule["target_kind"], rule["target"], F.col(f"_own{n}"), F.lit("structured_column"), f"extraction.yaml#{name}", none, none, F.lit(True)))
    if kind in (None, "field"):
        prefix = F.col("_prefix")
        table = {k.upper(): v for k, v in e.get("oui", {}).get("map", {}).items()}
        cells.append(_cell("field", e.get("oui", {}).get("target", rules.fields[0]), expr.lookup(table, prefix).cast("string"), F.lit("oui"), "extraction.yaml#oui", none, none, F.length(prefix) == PREFIX))
        signatures = e.get("port_signatures", {})
        for name, rule in signatures.get("rules", {}).items():
            cells.append(_cell("field", signatures["target"], F.lit(name), F.lit("port_signature"), f"extraction.yaml#port_signatures.{name}", none, none, expr.signature(F.col("_ports"), rule)))
    if not cells:
        cells.append(_cell("field", "", none.cast("string"), none.cast("string"), "", none, none, F.lit(False)))
    ready = ready.withColumns(spans).withColumns(placed).withColumn("_cells", F.array(*cells))
    found = ready.select("obs_id", "source", F.posexplode(F.array_compact("_cells")).alias("seq", "x")).select("obs_id", "source", "seq", "x.*")
    return found.withColumn("value", _clean(rules)).select("obs_id", "source", "seq", "raw", *EXTRACTION)


def unmapped(observations: DataFrame, rules: RuleSet) -> DataFrame:
    """Observations of sources that no rule maps: they yield nothing."""
    return observations.filter(F.coalesce(~F.col("source").isin(list(rules.source_groups())), F.lit(True))).select("obs_id", "source")


def no_extraction(observations: DataFrame, extractions: DataFrame, rules: RuleSet) -> DataFrame:
    mapped = observations.filter(F.col("source").isin(list(rules.source_groups())))
    return mapped.join(extractions.select("obs_id"), "obs_id", "left_anti").select("obs_id", "source")


def payload_gaps(observations: DataFrame, extractions: DataFrame) -> DataFrame:
    """Observations with a payload from which no rule took a span."""
    return observations.filter(F.coalesce("raw_payload", F.lit("")) != "").join(extractions.filter("start is not null").select("obs_id"), "obs_id", "left_anti").select("obs_id", "source")


def backlog(observations: DataFrame, gaps: DataFrame) -> DataFrame:
    """The payloads that a list of gaps (obs_id) stands for: what new rules are to be made from."""
    return observations.join(gaps.select("obs_id"), "obs_id", "left_semi").select("obs_id", "source", "raw_payload")


def group_claims(extractions: DataFrame, *more: Column) -> DataFrame:
    """The claims with their witness groups and sources, and ``more`` aggregates of their extractions."""
    keys = ["obs_id", F.col("target_kind").alias("kind"), F.col("target").alias("key"), "value"]
    return extractions.groupBy(*keys).agg(F.array_sort(F.collect_set("witness_group")).alias("witness_groups"), F.array_sort(F.collect_set("source")).alias("sources"), *more)


def in_vocab(rules: RuleSet) -> Column:
    known = F.lit(True)
    for name in rules.closed:
        known = F.when((F.col("kind") == "field") & (F.col("key") == name), F.col("value").isin(sorted(rules.words(name)))).otherwise(known)
    return known


def claims(extractions: DataFrame, rules: RuleSet, **more: Column) -> DataFrame:
    """Scored claims, with ``more`` aggregates of the extractions they are made of. Groups that assert any other value on a claim's key contest it, unless they assert it too.

    All of an observation's claims on a key meet in one small window; both the grouping and the window are keyed by
    obs_id and key, so no partition grows with the number of observations.
    """
    rivals = F.array_distinct(F.flatten(F.collect_set("witness_groups").over(Window.partitionBy("obs_id", "kind", "key"))))
    grouped = group_claims(extractions, *(c.alias(n) for n, c in more.items())).withColumn("conflicts", F.array_except(rivals, "witness_groups"))
    weights, s = rules.scoring["base_weights"], rules.scoring
    weight = F.when(F.col("kind") == "field", expr.score(F.col("witness_groups"), F.col("conflicts"), weights, s["field_claims"])).otherwise(expr.score(F.col("witness_groups"), F.col("conflicts"), weights, s["identity_claims"]))
    return grouped.select("obs_id", "kind", "key", "value", weight.alias("weight"), "witness_groups", "sources", F.array_sort("conflicts").alias("conflicts"), in_vocab(rules).alias("in_vocab"), *more)
