"""Field resolution per entity, its view per observation, and the roll-ups.

Winners and runners-up are minima over (-weight, value), first per value and then per field: partial aggregates
instead of windows over an entity's claims. Witness groups are few, so pooled sets stay small in entities of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.sources.rules import RuleSet

UNDECIDABLE = "undecidable"


def _cells(claims: DataFrame, membership: DataFrame) -> DataFrame:
    """entity_id, field, value: strongest weight, groups and in_vocab of a value among an entity's members."""
    c = claims.filter("kind = 'field'").join(membership.select("obs_id", "entity_id"), "obs_id")
    groups = F.array_sort(F.array_distinct(F.flatten(F.collect_set("witness_groups"))))
    return c.groupBy("entity_id", F.col("key").alias("field"), "value").agg(F.max("weight").alias("weight"), groups.alias("groups"), F.first("in_vocab").alias("in_vocab"))


def resolve(claims: DataFrame, membership: DataFrame, rules: RuleSet) -> DataFrame:
    """entity_id, field, value, confidence, runner_up, runner_up_weight, witness_groups for each entity and field."""
    cells, key = _cells(claims, membership), ["entity_id", "field"]
    order = F.struct((-F.col("weight")).alias("w"), "value", "groups")
    ranked = F.when(F.col("in_vocab"), order)
    first = cells.groupBy(*key).agg(F.min(ranked).alias("win"), F.count(F.when(F.col("in_vocab"), 1)).alias("n"))
    rest = cells.join(first.filter("win is not null").select(*key, F.col("win.value").alias("winner")), key).filter("value <> winner")
    second = rest.groupBy(*key).agg(F.min(ranked).alias("next"), F.array_distinct(F.flatten(F.collect_set("groups"))).alias("against"))
    policy = rules.field_resolution.get("conflict_policy", {}).get("per_field", {})
    escape = expr.lookup({f: c["escape"] for f, c in rules.closed.items()}, F.col("field"))
    wanted = F.explode(F.array(*(F.lit(f) for f in rules.fields))).alias("field")
    every = membership.select("entity_id").distinct().select("entity_id", wanted)
    none, empty = F.col("win").isNull(), F.array().cast("array<string>")
    split = F.col("field").isin([f for f, p in policy.items() if p == UNDECIDABLE]) & (F.col("n") > 1)
    conflicts = F.array_except(F.coalesce("against", empty), F.col("win.groups"))
    confidence = expr.score(F.col("win.groups"), conflicts, rules.scoring["base_weights"], rules.scoring["field_claims"] | rules.scoring["entity_corroboration"])
    return every.join(first, key, "left").join(second, key, "left").select(
        *key,
        F.when(none, F.coalesce(escape, F.lit(""))).when(split, UNDECIDABLE).otherwise(F.col("win.value")).alias("value"),
        F.when(none | split, 0.0).otherwise(confidence).alias("confidence"),
        F.when(~(none | split), F.col("next.value")).alias("runner_up"),
        F.when(~(none | split) & F.col("next").isNotNull(), F.round(-F.col("next.w"), 6)).otherwise(0.0).alias("runner_up_weight"),
        F.when(none | split, empty).otherwise(F.col("win.groups")).alias("witness_groups"),
    )


def observe(claims: DataFrame, membership: DataFrame, resolved: DataFrame, rules: RuleSet) -> DataFrame:
    """obs_id, entity_id, field, value, confidence, provenance: what the entity's answer means for each member."""
    own = claims.filter("kind = 'field' and in_vocab").select("obs_id", F.col("key").alias("field"), F.col("value").alias("own"), "weight")
    best = own.groupBy("obs_id", "field").agg(F.max(F.struct("weight", F.col("own").alias("value"))).alias("best"))
    seen = membership.select("obs_id", "entity_id", "link_weight").join(resolved.select("entity_id", "field", "value", F.col("confidence").alias("whole")), "entity_id")
    rows = seen.join(best, ["obs_id", "field"], "left").join(own.withColumnRenamed("own", "value"), ["obs_id", "field", "value"], "left")
    absent, split, direct = F.col("value").isin(sorted(rules.absent())), F.col("value") == UNDECIDABLE, F.col("weight").isNotNull()
    reading = split & F.col("best").isNotNull()
    handed = F.round(F.col("whole") * F.greatest("link_weight", F.lit(0.0)) * float(rules.field_resolution["decay_base"]), 6)
    return rows.select(
        "obs_id", "entity_id", "field",
        F.when(~absent & reading, F.col("best.value")).otherwise(F.col("value")).alias("value"),
        F.when(absent, 0.0).when(reading, F.col("best.weight")).when(split, 0.0).when(direct, F.col("weight")).otherwise(handed).alias("confidence"),
        F.when(absent, "unknown").when(reading, "direct").when(split, "unknown").when(direct, "direct").otherwise("propagated").alias("provenance"),
    )


def rollup(resolved: DataFrame, rules: RuleSet) -> DataFrame:
    """entity_id, confidence (harmonic mean) and stability (how contested) over the fields that have a confidence."""
    w = rules.scoring["stability"]["weights"]
    live = F.col("confidence") > 0
    margin = F.when(live, F.greatest(F.lit(0.0), F.col("confidence") - F.col("runner_up_weight")) / F.col("confidence"))
    dependence = F.when(live, F.least(F.lit(1.0), F.greatest(F.lit(0), F.size("witness_groups") - 1) / 2.0))
    quiet = F.when(live, F.when(F.coalesce("runner_up", F.lit("")) != "", 0.0).otherwise(1.0))
    total = w["margin"] * F.avg(margin) + w["witness_dependence"] * F.avg(dependence) + w["live_conflict"] * F.avg(quiet)
    n, inverse = F.count(F.when(live, 1)), F.sum(F.when(live, 1 / F.col("confidence")))
    return resolved.groupBy("entity_id").agg(expr.harmonic(n, inverse).alias("confidence"), F.round(expr.clamp(F.coalesce(total, F.lit(0.0))), 6).alias("stability"))


def wide(observed: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per observation: each field's value and provenance."""
    flat = observed.groupBy("obs_id", "entity_id").pivot("field", rules.fields).agg(F.first("value").alias("value"), F.first("provenance").alias("provenance"))
    return flat.select("obs_id", "entity_id", *(x for f in rules.fields for x in (F.col(f"{f}_value").alias(f), F.col(f"{f}_provenance"))))


def wide_entities(resolved: DataFrame, rollups: DataFrame, rules: RuleSet) -> DataFrame:
    flat = resolved.groupBy("entity_id").pivot("field", rules.fields).agg(F.first("value").alias("value"), F.first("confidence").alias("confidence"))
    return flat.select("entity_id", *(x for f in rules.fields for x in (F.col(f"{f}_value").alias(f), F.col(f"{f}_confidence")))).join(rollups, "entity_id")


def final_output(observed: DataFrame, rollups: DataFrame, rules: RuleSet) -> DataFrame:
    """The consumers' table: banded confidence, and fields that only an own reading may fill."""
    out = rules.field_resolution["final_output"]
    w = wide(observed, rules).join(rollups.select("entity_id", F.col("confidence").alias("whole")), "entity_id")
    held = set(out.get("direct_only", ()))
    cells = [F.when(F.col(f"{f}_provenance") == "direct", F.col(f)).otherwise("").alias(f) if f in held else F.col(f) for f in out["columns"]]
    return w.select("obs_id", *cells, "entity_id", expr.band(F.col("whole"), out["confidence_bands"]).alias("confidence"))
