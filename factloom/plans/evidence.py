"""Evidence-resolution queries over the driver's ``events``: each event is an observation of a session and a device."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.functions.storage import spread, written
from factloom.operators import entity, evaluate, extract, fields, lifecycle, replay, trace
from factloom.plans.stages import Stages
from factloom.sources.rules import RuleSet

FIELDS = ["tier", "item", "amount", "role"]


def event_rules(user_tier: bool = True) -> RuleSet:
    """The rules of the queries; ``user_tier=False`` leaves one out, for diffs between two versions."""
    seen = ["click", "view", "purchase"]
    regexes = {
        "k_tier": {"sources": seen, "pattern": r"k=(?P<v>\d)", "target_kind": "field", "target": "tier"},
        "user_tier": {"sources": ["purchase"], "pattern": r"user=(?P<v>\d)", "target_kind": "field", "target": "tier"},
        "k_item": {"sources": seen, "pattern": r"k=(?P<v>\d+)", "target_kind": "field", "target": "item"},
        "cents": {"sources": ["view", "purchase"], "pattern": r"cents=(?P<v>\d+)", "target_kind": "field", "target": "amount"},
        "error_user": {"sources": ["error"], "pattern": r"user=(?P<v>1\d*)", "target_kind": "link_basis", "target": "serial"},
    }
    return RuleSet(
        extraction={
            "rules": regexes if user_tier else {n: r for n, r in regexes.items() if n != "user_tier"},
            "structured": {"mac": {"column": "mac", "target_kind": "link_basis", "target": "mac"}, "hostname": {"column": "hostname", "target_kind": "link_basis", "target": "hostname_token"}},
            "oui": {"target": "tier", "map": {f"{k:02d}:00:01": "silver" for k in range(10, 36)}},
            "port_signatures": {"target": "role", "rules": {"camera": {"all_of": [554], "any_of": [80, 443]}, "web": {"any_of": [80], "none_of": [554]}, "switch": {"all_of": [22, 161]}}},
        },
        normalization={"aliases": {"tier": {"1": "bronze", "2": "silver", "3": "gold", "4": "copper"}, "role": {"WEB": "web server"}}, "rebrand": {"tier": {"copper": "bronze"}}},
        claims={
            "fields": FIELDS,
            "link_bases": ["mac", "serial", "hostname_token"],
            "closed_vocabulary_fields": {"tier": {"vocab_column": "tier", "escape": "Unknown"}, "role": {"vocab_column": "role", "escape": "unknown"}},
            "sources": {s: {"witness_group": s} for s in ("click", "view", "purchase", "error")},
        },
        scoring={
            "base_weights": {"click": 0.55, "view": 0.7, "purchase": 0.85, "error": 0.3, "oui": 0.5, "port_signature": 0.25, "structured_column": 0.8},
            "field_claims": {"b": 0.3, "r": 0.5, "conflict_penalty_per_group": 0.1, "max_conflict_penalty": 0.4},
            "identity_claims": {"b": 0.2, "r": 0.5, "conflict_penalty_per_group": 0.25, "max_conflict_penalty": 0.6},
            "entity_corroboration": {"b": 0.3, "r": 0.5, "conflict_penalty_per_group": 0.1, "max_conflict_penalty": 0.4},
            "stability": {"weights": {"margin": 0.5, "witness_dependence": 0.3, "live_conflict": 0.2}},
        },
        entity_resolution={"link_weight_threshold": 0.55, "basis_precedence": ["mac", "serial", "hostname_token"], "entity_id": {"prefix": "E-", "hash_length": 12}},
        field_resolution={"decay_base": 0.75, "conflict_policy": {"per_field": {"amount": "undecidable"}}, "final_output": {"columns": FIELDS, "direct_only": ["amount"], "confidence_bands": {"high": 0.7, "medium": 0.4}}},
        vocab={"tier": {"bronze", "silver", "gold", "Unknown"}, "role": {"camera", "web server", "switch", "unknown"}},
    )


def observations(spark: SparkSession, sf_dir: str, spread_first: bool = False) -> DataFrame:
    """``spread_first``: over all cores before anything is computed, as a file of this size is read by one task."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = (spread(e) if spread_first else e).select("event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    day = F.date_format("ts", "yyyy-MM-dd")
    return e.select(
        F.concat(F.lit("EV-"), F.lpad(F.col("event_id").cast("string"), 7, "0")).alias("obs_id"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("k="), F.col("k"), F.lit("; cents="), F.round(F.col("value") * 100).cast("long"), F.lit("; user="), F.col("user_id")).alias("raw_payload"),
        F.when(F.col("k") % 10 == 7, "").otherwise(F.concat_ws(":", two(F.col("k")), two(F.expr("user_id div 150")), F.date_format("ts", "dd"), F.date_format("ts", "HH"), F.lit("00"), F.lit("01"))).alias("mac"),
        F.when(F.col("user_id") % 10 == 3, "").otherwise(F.concat(F.lit(" U"), F.col("user_id"), F.lit("-"), day, F.lit(" "))).alias("hostname"),
        F.element_at(F.array(F.lit("80, 443"), F.lit("554,80"), F.lit("22,161,,"), F.lit("")), F.col("k") % 4 + 1).alias("open_ports"),
        "k", "user_id", day.alias("day"),
    )


class Run(Stages):
    """The stages over the events of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, rules: RuleSet | None = None, bodies: bool = True):
        super().__init__(observations(spark, sf_dir), rules or event_rules(), bodies)
        self._source = lambda: observations(spark, sf_dir, spread_first=True)

    def outcomes(self) -> DataFrame:
        return evaluate.outcomes(labels(self.observations), self.observed, self.resolved, self.rollups, self.claims)


def wide_labels(obs: DataFrame) -> DataFrame:
    """Ground truth made by rule: an event's tier, item and role follow from k, its entity is the user's day."""
    tier = F.when(F.col("k") % 10 == 7, "").when(F.col("k") < 20, "bronze").when(F.col("k") < 50, "silver").otherwise("gold")
    role = F.element_at(F.array(F.lit("web server"), F.lit("camera"), F.lit("switch"), F.lit("")), F.col("k") % 4 + 1)
    amount = F.when(F.col("source") == "click", "").otherwise(F.regexp_extract("raw_payload", r"cents=(\d+)", 1))
    sure = F.element_at(F.array(F.lit("high"), F.lit("medium"), F.lit("low")), F.col("k") % 3 + 1)
    return obs.select("obs_id", tier.alias("tier"), F.col("k").cast("string").alias("item"), amount.alias("amount"), role.alias("role"), F.concat_ws("|", "user_id", "day").alias("entity_id"), sure.alias("confidence"))


def labels(obs: DataFrame) -> DataFrame:
    return evaluate.unpivot_labels(wide_labels(obs), FIELDS).withColumn("status", F.lit("proposed"))


def competing_labels(obs: DataFrame) -> DataFrame:
    """Labels of several bases for the same things: some agree, some overrule, some dispute."""
    base = labels(obs).select("obs_id", "key_type", "key", "value", "status", F.lit("payload_inference").alias("label_basis"))
    hand = wide_labels(obs).join(obs.select("obs_id", "k"), "obs_id")

    def more(keep, value, basis):
        return hand.filter(keep).select("obs_id", F.lit("field").alias("key_type"), F.lit("item").alias("key"), value.alias("value"), F.lit("proposed").alias("status"), F.lit(basis).alias("label_basis"))

    item, five = F.col("item"), F.col("k") % 5
    return base.unionByName(more(five == 0, F.concat(item, F.lit("x")), evaluate.BASIS_PRECEDENCE[0])).unionByName(more(five <= 1, item, evaluate.BASIS_PRECEDENCE[1])).unionByName(more(five == 1, F.concat(item, F.lit("y")), evaluate.BASIS_PRECEDENCE[1])).unionByName(more(five == 2, item, "payload_inference"))


HASHED = ["obs_id", "source", "raw_payload", "mac", "hostname", "open_ports"]


def long_labels(obs: DataFrame) -> DataFrame:
    """The labels as a label file holds them."""
    return labels(obs).select("obs_id", "key_type", "key", "value", "status", F.lit("payload_inference").alias("label_basis"), "labeler_certainty", F.lit("false").alias("blinded"), F.lit("").alias("obs_hash"), F.lit("first").alias("labeled_by"), F.lit("").alias("labeled_at"))


def returned(obs: DataFrame) -> DataFrame:
    """What labellers send back: mostly sound rows, and some of each kind that may not be taken."""
    r = obs.join(wide_labels(obs).select("obs_id", "item"), "obs_id").filter("k % 4 = 0")
    odd = F.col("k") % 7
    fresh = F.concat(F.lit("sha256:"), expr.obs_hash(HASHED))
    return r.select("obs_id", F.when(odd == 1, "guess").otherwise("field").alias("key_type"), F.when(odd == 2, "colour").otherwise("item").alias("key"), F.when(odd == 3, " ").when(odd == 6, F.concat("item", F.lit("z"))).otherwise(F.col("item")).alias("value"), F.when(odd == 4, "sha256:old").otherwise(fresh).alias("obs_hash"), F.lit("second").alias("labeled_by"))


def _returned(run: Run) -> DataFrame:
    sent = lifecycle.packet(long_labels(run.observations), run.observations, HASHED)
    return lifecycle.returned_labels(sent, returned(run.observations), run.observations, HASHED, FIELDS)


def _applied(run: Run) -> DataFrame:
    accepted = _returned(run).filter("rejected is null").drop("rejected")
    vendor = long_labels(run.observations).filter("key = 'role'").withColumn("label_basis", F.lit("vendor_doc")).withColumn("labeled_by", F.lit("third"))
    other = vendor.filter("value = 'camera'").withColumn("value", F.lit("switch"))
    return lifecycle.apply_adjudicated(long_labels(run.observations), accepted.unionByName(vendor).unionByName(other))


def _two_pass(spark, d):
    old, new = Run(spark, d, event_rules(user_tier=False)), Run(spark, d)

    def scored(run: Run, moved: bool) -> DataFrame:
        marks = labels(run.observations)
        if moved:
            marks = marks.withColumn("value", F.when((F.col("key") == "tier") & (F.col("value") == "gold"), "silver").otherwise(F.col("value")))
        return evaluate.outcomes(marks, run.observed, run.resolved, run.rollups, run.claims)

    return evaluate.two_pass(scored(old, False), scored(old, True), scored(new, False), "first", "second")


def _text(df: DataFrame) -> DataFrame:
    """Arrays as joined strings, for tables that are compared or exported."""
    return df.select(*(F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes))


def _four_buckets(spark, d):
    return evaluate.four_buckets(Run(spark, d, event_rules(user_tier=False)).outcomes(), Run(spark, d).outcomes())


def _pairs(spark, d):
    run = Run(spark, d)
    return evaluate.pair_quality(wide_labels(run.observations).select("obs_id", F.col("entity_id").alias("part")), run.membership.select("obs_id", F.col("entity_id").alias("part")))


def _metrics(spark, d):
    r = Run(spark, d)
    kept = [written(df, name) for name, df in (("seen", r.observations.select("obs_id", "source")), ("extracted", r.extractions.select("obs_id").distinct()))]
    return evaluate.metrics(*kept, r.claims, r.membership, r.resolved, written(r.observed, "observed"), written(r.rollups, "rollups"), r.rules)


def _orphans(s: Stages) -> DataFrame:
    return replay.orphans(s.kept_steps())


def _replayed_claims(s: Stages) -> DataFrame:
    return replay.claims(s.steps("extraction", "claims")).select("obs_id", "key", "value", F.round("weight", 6).alias("weight"))


def _differences(s: Stages) -> DataFrame:
    return replay.differences(s.kept_steps(), s.claims, s.membership, s.resolved, s.rollups)


def _per(f: Callable[[Run], DataFrame], bodies: bool = True) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(Run(spark, sf_dir, bodies=bodies))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "extractions": _per(lambda r: r.extractions),
    "unmapped_source": _per(lambda r: extract.unmapped(r.observations, r.rules)),
    "no_extraction": _per(lambda r: extract.no_extraction(r.observations, r.extractions, r.rules)),
    "payload_gaps": _per(lambda r: extract.payload_gaps(r.observations, r.extractions)),
    "claims_scored": _per(lambda r: _text(extract.claims(r.extractions, r.rules))),
    "identity_edges": _per(lambda r: entity.pair_edges(r.claims, r.rules)),
    "merge_forest": _per(lambda r: entity.merge_forest(entity.pair_edges(r.claims, r.rules), r.rules)),
    "entity_components": _per(lambda r: entity.entities(r.observations, r.claims, r.rules)),
    "per_basis_components": _per(lambda r: entity.per_basis(r.claims, r.rules)),
    "membership": _per(lambda r: r.membership),
    "resolved_fields": _per(lambda r: _text(r.resolved)),
    "observation_fields": _per(lambda r: r.observed),
    "entity_rollup": _per(lambda r: r.rollups),
    "entities_wide": _per(lambda r: fields.wide_entities(r.resolved, r.rollups, r.rules)),
    "resolutions_wide": _per(lambda r: fields.wide(r.observed, r.rules)),
    "final_output": _per(lambda r: fields.final_output(r.observed, r.rollups, r.rules)),
    "top1_claim": _per(lambda r: evaluate.top1(r.claims)),
    "vocab_reject_queue": _per(lambda r: evaluate.reject_queue(r.claims)),
    "metrics_label_free": _metrics,
    "outcomes": _per(lambda r: r.outcomes()),
    "accuracy": _per(lambda r: evaluate.accuracy(r.outcomes())),
    "calibration": _per(lambda r: evaluate.calibration(r.outcomes())),
    "accuracy_by_stability": _per(lambda r: evaluate.accuracy_by_stability(r.outcomes())),
    "stability_quadrants": _per(lambda r: evaluate.stability_quadrants(r.outcomes())),
    "four_bucket": _four_buckets,
    "pairwise_quality": _pairs,
    "label_unpivot": _per(lambda r: labels(r.observations)),
    "label_pairs": _per(lambda r: evaluate.label_pairs(wide_labels(r.observations))),
    "label_precedence": _per(lambda r: evaluate.settle_labels(competing_labels(r.observations))),
    "label_transitivity": _per(lambda r: evaluate.intransitive(entity.pair_edges(r.claims, r.rules).filter("accepted"))),
    "label_vocabulary": _per(lambda r: lifecycle.out_of_vocabulary(competing_labels(r.observations).unionByName(labels(r.observations).select("obs_id", "key_type", "key", F.upper("value").alias("value"), "status", F.lit("vendor_doc").alias("label_basis"))), r.rules)),
    "label_changes": _per(lambda r: lifecycle.label_changes(long_labels(r.observations), long_labels(r.observations).filter("key <> 'amount'").withColumn("value", F.when(F.col("value") == "gold", "silver").otherwise(F.col("value"))))),
    "label_apply": _per(lambda r: _applied(r).select("obs_id", "key", "value", "status", "label_basis", "change", "refused")),
    "packet_stratum": _per(lambda r: lifecycle.packet_stratum(long_labels(r.observations), r.observations)),
    "packet": _per(lambda r: lifecycle.packet(long_labels(r.observations), r.observations, HASHED)),
    "returned_validation": _per(lambda r: _returned(r).select("obs_id", "key_type", "key", "value", "labeler_certainty", "labeled_by", "rejected")),
    "two_pass": _two_pass,
    "payload_backlog": _per(lambda r: extract.backlog(r.observations, extract.payload_gaps(r.observations, r.extractions))),
    "trace_steps": _per(lambda r: trace.counts(r.steps()), bodies=False),
    "trace_orphans": _per(lambda r: r.sliced(_orphans), bodies=False),
    "replay_claims": _per(lambda r: r.sliced(_replayed_claims, entities=False)),
    "replay_membership": _per(lambda r: replay.membership(r.assigned), bodies=False),
    "replay_differences": _per(lambda r: r.sliced(_differences)),
    "obs_hash": _per(lambda r: r.observations.select("obs_id", expr.obs_hash(["obs_id", "source", "raw_payload", "mac", "hostname", "open_ports"]).alias("obs_hash"))),
}
