"""Evaluation against labels, diffs between runs, label tables, and label-free metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.operators.fields import UNDECIDABLE
from factloom.sources.rules import RuleSet

#: Label bases from strong to weak.
BASIS_PRECEDENCE = ("physical_inspection", "asset_inventory", "vendor_doc", "payload_inference")


def top1(claims: DataFrame) -> DataFrame:
    """obs_id, field, top1_claim: the heaviest field claim, the lowest value among equals."""
    best = F.min(F.struct((-F.col("weight")).alias("w"), "value"))
    return claims.filter("kind = 'field'").groupBy("obs_id", F.col("key").alias("field")).agg(best["value"].alias("top1_claim"))


def outcomes(labels: DataFrame, observed: DataFrame, resolved: DataFrame, rollups: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per field label of a known observation; ``correct`` is null where nothing can be decided."""
    marks = labels.filter("key_type = 'field'").select("obs_id", F.col("key").alias("field"), F.col("value").alias("expected"), "status", "labeler_certainty")
    seen = observed.select("obs_id", "entity_id", "field", F.col("value").alias("actual"), "provenance")
    rows = marks.join(seen, ["obs_id", "field"]).join(resolved.select("entity_id", "field", F.col("confidence").alias("field_confidence")), ["entity_id", "field"]).join(rollups, "entity_id").join(top1(claims), ["obs_id", "field"], "left")
    open_ = (F.col("actual") == UNDECIDABLE) | (F.col("status") == UNDECIDABLE)
    return rows.select("obs_id", F.col("field").alias("key"), "expected", "actual", F.when(~open_, F.col("actual") == F.col("expected")).alias("correct"), "provenance", "field_confidence", F.coalesce("top1_claim", F.lit("")).alias("top1_claim"), "labeler_certainty", "confidence", "stability")


def _ratio(hit, of):
    return F.round(F.sum(hit.cast("int")) / F.greatest(F.sum(of.cast("int")), F.lit(1)), 6), F.sum(of.cast("int")).cast("long")


def accuracy(outcome: DataFrame) -> DataFrame:
    """metric, scope, value, n: precision, recall, top-1 and propagated accuracy by field."""
    known = outcome.filter("correct is not null")
    direct, right = F.col("provenance") == "direct", F.col("correct")
    handed, claimed = F.col("provenance") == "propagated", F.col("top1_claim") != ""
    parts = {
        "extraction_recall": _ratio(direct & right, F.lit(True)),
        "extraction_precision": _ratio(direct & right, direct),
        "top1_claim_accuracy": _ratio(claimed & (F.col("top1_claim") == F.col("expected")), claimed),
        "propagated_value_accuracy": _ratio(handed & right, handed),
    }
    flat = known.groupBy("key").agg(*(c.alias(f"{m}_{x}") for m, (v, n) in parts.items() for c, x in ((v, "value"), (n, "n"))))
    rows = F.array(*(F.struct(F.lit(m).alias("metric"), F.col("key").alias("scope"), F.col(f"{m}_value").alias("value"), F.col(f"{m}_n").alias("n")) for m in parts))
    return flat.select(F.explode(rows).alias("x")).select("x.*")


def calibration(outcome: DataFrame) -> DataFrame:
    return outcome.filter("correct is not null").groupBy(expr.plain_decile(F.col("field_confidence")).alias("bucket")).agg(F.round(F.abs(F.avg(F.col("correct").cast("int")) - F.avg("field_confidence")), 6).alias("value"), F.count(F.lit(1)).alias("n"))


def accuracy_by_stability(outcome: DataFrame) -> DataFrame:
    return outcome.filter("correct is not null").groupBy(expr.plain_decile(F.col("stability")).alias("bucket")).agg(F.round(F.avg(F.col("correct").cast("int")), 6).alias("value"), F.count(F.lit(1)).alias("n"))


def stability_quadrants(outcome: DataFrame) -> DataFrame:
    """quadrant, value, n: accuracy of confident results, by stability; both rows are there, with 0 if nothing is in them."""
    sure, stable, right = F.col("field_confidence") >= 0.7, F.col("stability") >= 0.7, F.col("correct").cast("int")
    parts = {"high_conf_high_stab": sure & stable, "high_conf_low_stab": sure & ~stable}
    flat = outcome.filter("correct is not null").agg(*(x for q, c in parts.items() for x in (F.avg(F.when(c, right)).alias(f"{q}_value"), F.count(F.when(c, 1)).alias(f"{q}_n"))))
    rows = F.array(*(F.struct(F.lit(q).alias("quadrant"), F.round(F.coalesce(f"{q}_value", F.lit(0.0)), 6).alias("value"), F.col(f"{q}_n").alias("n")) for q in parts))
    return flat.select(F.explode(rows).alias("x")).select("x.*")


class LabelsMoved(ValueError):
    """Two runs were scored on different labels: their outcomes tell nothing about rules alone."""


def four_buckets(before: DataFrame, after: DataFrame, before_labels: str | None = None, after_labels: str | None = None) -> DataFrame:
    """obs_id, key, bucket, before and after (values) of the outcomes that both runs decided. Known hashes of the labels must be equal."""
    if before_labels is not None and after_labels is not None and before_labels != after_labels:
        raise LabelsMoved("the labels differ between the runs; make two passes")
    seen = lambda df: F.col("actual") if "actual" in df.columns else F.lit(None).cast("string")
    b = before.filter("correct is not null").select("obs_id", "key", F.col("correct").alias("was"), seen(before).alias("before"))
    a = after.filter("correct is not null").select("obs_id", "key", F.col("correct").alias("now"), seen(after).alias("after"))
    name = F.when(~F.col("was") & F.col("now"), "fixed").when(F.col("was") & ~F.col("now"), "broken").when(F.col("was"), "stable_correct").otherwise("stable_incorrect")
    return b.join(a, ["obs_id", "key"]).select("obs_id", "key", name.alias("bucket"), "before", "after")


def two_pass(baseline: DataFrame, rules_held: DataFrame | None, labels_held: DataFrame, baseline_labels: str, current_labels: str) -> DataFrame:
    """``four_buckets`` of either cause with ``delta``: labels (old rules, new labels) and rules (new rules, old labels), both against the baseline."""
    rule = four_buckets(baseline, labels_held).withColumn("delta", F.lit("rules"))
    if baseline_labels == current_labels:
        return rule
    if rules_held is None:
        raise LabelsMoved("the labels moved and no pass with the old rules was given")
    return four_buckets(baseline, rules_held).withColumn("delta", F.lit("labels")).unionByName(rule)


def propose_bump(buckets: DataFrame, before_keys: set[str], after_keys: set[str], before_words: set[str], after_words: set[str]) -> str:
    """What a change of rules did, as a version bump."""
    if before_keys != after_keys or before_words - after_words:
        return "major"
    if after_words - before_words:
        return "minor"
    return "patch" if buckets.filter("bucket in ('fixed', 'broken')").isEmpty() else "minor"


def regressions(buckets: DataFrame, changed_files: list[str]) -> DataFrame:
    """The broken cases, as they are logged."""
    return buckets.filter("bucket = 'broken'").select("obs_id", F.lit("field").alias("key_type"), "key", "before", "after", F.lit("|".join(sorted(changed_files))).alias("changed_rule_files"))


def pair_quality(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """Pairwise precision and recall of two partitions (obs_id, part), counted by cells: no pair is made."""
    both = truth.select("obs_id", F.col("part").alias("t")).join(predicted.select("obs_id", F.col("part").alias("p")), "obs_id")

    def pairs(*keys):
        return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("_".join(("n", *keys))))

    row = pairs("t", "p").crossJoin(pairs("t")).crossJoin(pairs("p"))  # three tables of one row
    return row.select(F.round(F.col("n_t_p") / F.greatest("n_p", F.lit(1)), 6).alias("pairwise_precision"), F.round(F.col("n_t_p") / F.greatest("n_t", F.lit(1)), 6).alias("pairwise_recall"), (F.col("n_p") - F.col("n_t_p")).alias("false_merge_count"), (F.col("n_t") - F.col("n_t_p")).alias("false_split_count"))


def unpivot_labels(table: DataFrame, fields: list[str]) -> DataFrame:
    """Long rows of a wide label table; a blank cell is no label."""
    return table.unpivot(["obs_id", "confidence"], fields, "key", "value").filter(F.trim("value") != "").select("obs_id", F.lit("field").alias("key_type"), "key", "value", F.col("confidence").alias("labeler_certainty"))


def label_pairs(table: DataFrame) -> DataFrame:
    """The pairs of one labelled entity, with the weaker certainty: the rows that a label file holds for its entities."""
    a = table.select("entity_id", F.col("obs_id").alias("a"), F.col("confidence").alias("ca"))
    b = table.select("entity_id", F.col("obs_id").alias("b"), F.col("confidence").alias("cb"))
    return a.join(b, "entity_id").filter("a < b").select("a", "b", expr.weaker_certainty(F.col("ca"), F.col("cb")).alias("labeler_certainty"))


def settle_labels(labels: DataFrame) -> DataFrame:
    """Labels by the strongest basis: agreed, adjudicated, or disputed where equals differ."""
    rank = F.coalesce(expr.lookup({b: n for n, b in enumerate(BASIS_PRECEDENCE)}, F.col("label_basis")), F.lit(len(BASIS_PRECEDENCE)))
    key = ["obs_id", "key_type", "key", "id_value"]
    rows = labels.withColumn("rank", rank).withColumn("id_value", F.when(F.col("key_type") == "link_basis", F.col("value")).otherwise(""))
    tier = rows.groupBy(*key).agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("all"))
    top = rows.join(tier, key).filter("rank = best")
    facts = top.groupBy(*key).agg(F.count(F.lit(1)).alias("top"), F.count_distinct("value").alias("values"), F.first("all").alias("all"), F.min("status").alias("own"))
    status = F.when(F.col("values") > 1, "disputed").when((F.col("top") > 1) & (F.col("all") == F.col("top")), "agreed").when(F.col("all") > 1, "adjudicated").otherwise(F.col("own"))
    kept = top.select(*key, "value", "label_basis").join(facts, key)
    return kept.groupBy("obs_id", "key_type", "key", "value").agg(F.first(status).alias("status"), F.first("label_basis").alias("label_basis"), F.first(F.when(F.col("values") > 1, F.col("top")).otherwise(1)).alias("labels"))


def intransitive(pairs: DataFrame) -> DataFrame:
    """x, a, b where x~a and x~b are labelled and a~b is not. Reads pairs (a, b) with a < b."""
    p = pairs.select("a", "b").distinct()
    ends = p.unionByName(p.select(F.col("b").alias("a"), F.col("a").alias("b")))
    two = ends.toDF("x", "a").join(ends.toDF("x", "b"), "x").filter("a < b")
    return two.join(p, ["a", "b"], "left_anti").select("x", "a", "b")


def reject_queue(claims: DataFrame) -> DataFrame:
    """Out-of-vocabulary values: key, value, number of observations and the first three of them."""
    rows = claims.filter("kind = 'field' and not in_vocab").select("key", "value", "obs_id").distinct()
    counted = rows.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"), F.min("obs_id").alias("o1"))
    second = rows.join(counted.select("key", "value", "o1"), ["key", "value"]).filter("obs_id > o1").groupBy("key", "value").agg(F.min("obs_id").alias("o2"))
    third = rows.join(second, ["key", "value"]).filter("obs_id > o2").groupBy("key", "value").agg(F.min("obs_id").alias("o3"))
    return counted.join(second, ["key", "value"], "left").join(third, ["key", "value"], "left").select("key", "value", "n", F.concat_ws("|", "o1", "o2", "o3").alias("examples"))


def ranked_rejects(queue: DataFrame, top: int | None = None) -> DataFrame:
    """``reject_queue`` from the most frequent on, in the order that a report lists them; ``top`` as the report's length."""
    out = queue.orderBy(F.desc("n"), "key", "value")
    return out.limit(top) if top else out


def metrics(observations: DataFrame, extractions: DataFrame, claims: DataFrame, membership: DataFrame, resolved: DataFrame, observed: DataFrame, rollups: DataFrame, rules: RuleSet) -> DataFrame:
    """metric, scope, value, n: what can be told of a run without labels. Histograms give the share, and n the total."""

    def rows(df, metric, scope, value, n):
        return df.select(F.lit(metric).alias("metric"), scope.cast("string").alias("scope"), F.round(F.coalesce(value.cast("double"), F.lit(0.0)), 6).alias("value"), n.cast("long").alias("n"))

    def shares(counted, total):
        """``counted`` with the sum of its k as ``total``, over the rows of equal ``total`` columns."""
        return counted.join(F.broadcast(counted.groupBy(*total).agg(F.sum("k").alias("total"))), total) if total else counted.crossJoin(F.broadcast(counted.agg(F.sum("k").alias("total"))))

    of = lambda prefix, *c: F.concat_ws(":", F.lit(prefix), *c)
    one, every, all_obs = F.lit("global"), F.count(F.lit(1)), observations.select(F.count(F.lit(1)).alias("obs"))
    known = ~F.col("value").isin(sorted(rules.absent() | {UNDECIDABLE}))
    rate = lambda c: F.avg(c.cast("double")).alias("v")
    by_field = resolved.groupBy("field").agg(rate(known), every.alias("n"), rate(F.col("value") == UNDECIDABLE).alias("u"))
    is_open = ~F.col("field").isin(list(rules.closed))
    by_provenance = observed.filter(is_open).groupBy("field").agg(*(rate(known & (F.col("provenance") == p)).alias(p) for p in ("direct", "propagated")), every.alias("n"))
    sizes = membership.groupBy("entity_id").agg(every.alias("k")).agg(rate(F.col("k") == 1), every.alias("n"))
    keyed = claims.groupBy("kind", "key").agg(every.alias("c"), rate(F.size("witness_groups") >= 2), rate(F.size("conflicts") > 0).alias("w")).crossJoin(F.broadcast(all_obs))
    name = F.concat_ws(":", "kind", "key")
    wins = claims.filter("kind = 'field' and in_vocab").join(membership.select("obs_id", "entity_id"), "obs_id").join(resolved.select("entity_id", F.col("field").alias("key"), F.col("value").alias("winner")), ["entity_id", "key"])
    source = wins.select(F.explode("sources").alias("source"), (F.col("value") == F.col("winner")).alias("won")).groupBy("source").agg(rate(F.col("won")), every.alias("n"))
    linked = membership.groupBy("link_basis").agg(every.alias("k")).crossJoin(F.broadcast(all_obs))
    agreement = membership.agg(rate(F.col("basis_agreement")), every.alias("n"))
    identified = observations.select("obs_id").join(claims.filter("kind = 'link_basis'").select("obs_id").distinct().withColumn("has", F.lit(1)), "obs_id", "left").agg(rate(F.col("has").isNull()), every.alias("n"))
    found = observations.select("obs_id", "source").join(extractions.select("obs_id").distinct().withColumn("has", F.lit(1)), "obs_id", "left")
    empty = found.agg(rate(F.col("has").isNull() & F.col("source").isin(list(rules.source_groups()))), every.alias("n"))
    pooled = resolved.groupBy("field").agg(F.avg(F.when(known, (F.size("witness_groups") >= 2).cast("double"))).alias("v"), F.count(F.when(known, 1)).alias("n"))
    rejects = shares(claims.filter("kind = 'field' and not in_vocab").groupBy("value").agg(every.alias("k")), [])
    hops = observed.filter("provenance = 'propagated'").agg(every.alias("n")).filter("n > 0")  # a value is handed on once, so every depth is 1
    by_confidence = shares(resolved.groupBy("field", expr.decile(F.col("confidence")).alias("b")).agg(every.alias("k")), ["field"])
    gap = claims.filter("kind = 'field' and not in_vocab").join(membership.select("obs_id", "entity_id"), "obs_id").select("entity_id", F.col("key").alias("field")).distinct().withColumn("gap", F.lit(1))
    escaped = expr.lookup({f: c["escape"] for f, c in rules.closed.items()}, F.col("field"))
    gaps = resolved.filter(~is_open).join(gap, ["entity_id", "field"], "left").groupBy("field").agg(rate(F.coalesce((F.col("gap") == 1) & (F.col("value") == escaped), F.lit(False))), every.alias("n"))
    parts = [
        rows(by_field.filter(is_open), "field_fill_rate", of("field", F.col("field")), F.col("v"), F.col("n")),
        rows(by_field.filter(~is_open), "known_rate", of("field", F.col("field")), F.col("v"), F.col("n")),
        rows(by_field, "undecidable_rate", of("field", F.col("field")), F.col("u"), F.col("n")),
        *(rows(by_provenance, "field_fill_rate", of("field", F.col("field"), F.lit(p)), F.col(p), F.col("n")) for p in ("direct", "propagated")),
        rows(gaps, "vocab_gap_rate", of("field", F.col("field")), F.col("v"), F.col("n")),
        rows(rejects, "vocab_reject_frequency", of("value", F.col("value")), F.col("k"), F.col("total")),
        rows(hops, "propagation_depth_distribution", F.lit("hop:1"), F.lit(1.0), F.col("n")),
        rows(by_confidence, "confidence_distribution", of("field", F.col("field"), F.lit("bucket"), F.col("b")), F.col("k") / F.col("total"), F.col("total")),
        rows(empty, "no_extraction_rate", one, F.col("v"), F.col("n")),
        rows(identified, "no_identity_claim_rate", one, F.col("v"), F.col("n")),
        rows(keyed, "claims_per_obs", name, F.col("c") / F.greatest("obs", F.lit(1)), F.col("obs")),
        rows(keyed, "corroboration_rate", name, F.col("v"), F.col("c")),
        rows(keyed, "conflict_rate", name, F.col("w"), F.col("c")),
        rows(pooled, "entity_corroboration_rate", of("field", F.col("field")), F.col("v"), F.col("n")),
        rows(source, "source_win_rate", of("source", F.col("source")), F.col("v"), F.col("n")),
        rows(sizes, "entity_count", one, F.col("n"), F.col("n")),
        rows(sizes, "singleton_rate", one, F.col("v"), F.col("n")),
        rows(linked, "link_basis_distribution", of("link_basis", F.col("link_basis")), F.col("k") / F.col("obs"), F.col("obs")),
        rows(agreement, "basis_agreement_rate", one, F.col("v"), F.col("n")),
        rows(agreement, "cross_basis_conflict_rate", one, 1 - F.col("v"), F.col("n")),
    ]
    for c, metric in (("confidence", "confidence_distribution"), ("stability", "stability_distribution")):
        h = shares(rollups.groupBy(expr.decile(F.col(c)).alias("b")).agg(every.alias("k")), [])
        parts.append(rows(h, metric, of("global:bucket", F.col("b")), F.col("k") / F.col("total"), F.col("total")))
    return reduce(DataFrame.unionByName, parts)
