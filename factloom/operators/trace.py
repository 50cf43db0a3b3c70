"""The derivation trace: one content-addressed step for each decision, with the steps it came from as parents.

Each stage is a DataFrame that carries the step ids of the one before; a body is canonical JSON (sorted keys, no white space, ASCII) and
its hash is the step's id, so equal decisions are one step and two runs give equal traces. Spark's JSON is canonical if the fields of a
struct are named in order, except for non-ASCII, control characters and numbers that are small, large or long (``odd``): those bodies
alone are made by an Arrow function. All else are joins and aggregates.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.functions.storage import written
from factloom.operators import entity, extract
from factloom.operators.fields import UNDECIDABLE
from factloom.sources.rules import RuleSet

STEP = ["step_id", "op", "parents", "body"]


canonical_json = json.JSONEncoder(sort_keys=True, separators=(",", ":"), default=str).encode


#: Where numbers in JSON of Spark may differ from canonical JSON: Java writes them with an exponent or with other digits.
#: It is [0-9]E-?[0-9]|[.][0-9]{9}, but with one small class in front, which Java tests by one look into a table; a negated or
#: joined class there costs more than all else of a step.
ODD_NUMBER = r"[.E](?:(?<=[.])[0-9]{9}|(?<=[0-9]E)-?[0-9])"


def odd(text: Column) -> Column:
    """Whether ``text``, JSON of Spark, may differ from canonical JSON. Spark writes control characters below the space as escapes."""
    return (F.octet_length(text) != F.length(text)) | F.contains(text, F.lit("\\u")) | F.contains(text, F.lit("\x7f")) | text.rlike(ODD_NUMBER)


def _addressed(text: pd.Series) -> pd.DataFrame:
    ids, bodies = [], []
    for t in text:
        if t is None:
            ids.append(None)
            bodies.append(None)
            continue
        body = json.loads(t)
        ids.append("sha256:" + hashlib.sha256(canonical_json(body).encode()).hexdigest())
        bodies.append(canonical_json({"step_id": ids[-1], **body}))
    return pd.DataFrame({"step_id": ids, "body": bodies})


def _strings(*columns) -> Column:
    return F.array(*columns).cast("array<string>")


def step(df: DataFrame, op, rule_id, inputs: Column | None = None, output: Column | None = None, parents: Column | None = None, **extra: Column) -> DataFrame:
    """``df`` with the step_id, op, parents and body of a step for each row."""
    op, rule_id = (x if isinstance(x, Column) else F.lit(x) for x in (op, rule_id))
    parents = F.coalesce(parents, _strings()) if parents is not None else _strings()
    every = extra | {"op": op, "rule_id": rule_id, "inputs": inputs if inputs is not None else _strings(), "output": output if output is not None else F.lit(None).cast("string"), "parents": parents}
    # the id stands among the fields, in order: the body is what comes before it, and what comes after
    before, after = ([every[n].alias(n) for n in sorted(every) if (n > "step_id") == late] for late in (False, True))
    text = lambda fields: F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    end = F.concat(F.lit(","), F.substring(text(after), 2, 1 << 30)) if after else F.lit("}")
    made = df.withColumns({"_op": op, "_parents": parents, "_before": text(before), "_end": end}).withColumns({"op": F.col("_op"), "parents": F.col("_parents"), "_before": F.expr("left(_before, length(_before) - 1)")})
    made = made.withColumn("_whole", F.concat("_before", "_end"))
    made = made.withColumns({"_made": F.pandas_udf(_addressed, "step_id string, body string")(F.when(odd(F.col("_whole")), F.col("_whole"))), "_id": F.concat(F.lit("sha256:"), F.sha2("_whole", 256))})
    made = made.withColumns({"step_id": F.coalesce("_made.step_id", "_id"), "body": F.coalesce(F.col("_made.body"), F.concat("_before", F.lit(',"step_id":"'), "_id", F.lit('"'), "_end"))})
    return made.drop("_op", "_parents", "_before", "_end", "_whole", "_made", "_id")


def _of(kind: str, column) -> Column:
    return F.concat(F.lit(f"{kind}:"), column)


def _decomposition(groups: Column, conflicts: Column, rules: RuleSet, name: str) -> Column:
    weights, coefficients = {k: float(v) for k, v in rules.scoring["base_weights"].items()}, rules.scoring.get(name) or {}
    if name == "entity_corroboration":
        coefficients = rules.scoring["field_claims"] | coefficients
    base = F.coalesce(F.array_max(F.transform(groups, lambda g: F.coalesce(expr.lookup(weights, g), F.lit(0.0)))), F.lit(0.0))
    return F.struct(
        expr.strongest_group(groups, rules.scoring["base_weights"]).alias("base_from"), base.alias("base_max"),
        F.round(expr.independence_bonus(F.size(groups), coefficients["b"], coefficients["r"]), 6).alias("bonus"), F.lit(name).alias("coefficient_set"),
        conflicts.alias("conflicting_groups"), F.round(expr.penalty(conflicts, coefficients).cast("double"), 6).alias("penalty"), groups.alias("witness_groups"),
    )


def extraction_steps(observations: DataFrame, rules: RuleSet, kind: str, keep: Callable = written) -> tuple[list[DataFrame], DataFrame, DataFrame]:
    """Steps of extraction and normalisation of one target_kind, its readings, and its extractions with the id of their last step.

    ``keep`` writes tables of steps here and below: ``written``, or ``without_bodies`` where no body is read.
    """
    found = extract.readings(observations, rules, kind)
    columns = {f"extraction.yaml#{n}": r["column"] for n, r in rules.extraction.get("structured", {}).items()}
    place = F.when(F.col("start").isNotNull(), F.concat(F.lit("raw_payload["), F.col("start"), F.lit(":"), F.col("end"), F.lit("]"))).when(F.col("rule_id") == "extraction.yaml#oui", F.lit("mac[0:8]")).otherwise(F.coalesce(expr.lookup(columns, F.col("rule_id")), F.lit("open_ports")))
    read = keep(step(found, "extract", F.col("rule_id"), F.array(F.concat(_of("obs", F.col("obs_id")), F.lit("#"), place)), F.col("raw")), "extract-steps")
    aliases, rebrand = rules.aliases, rules.rebrand
    names = {t: rules.suffix(b) for t, b in {"mac": "mac", "hostname_token": "hostname", **{t: f"{t}_alias" for t in aliases}}.items()}
    lifted = ~F.col("witness_group").isin("oui", "port_signature") | (F.col("raw") != F.col("value"))
    touched = F.col("target").isin(list(names)) & lifted & ((F.col("target_kind") == "link_basis") == F.col("target").isin("mac", "hostname_token"))
    first = F.col("value")
    for target, table in aliases.items():
        first = F.when(F.col("target") == target, expr.alias(F.col("raw"), table, {})).otherwise(first)
    own = read.filter(touched).withColumnRenamed("step_id", "read_id").drop("op", "parents", "body").withColumn("first", first)
    cleaned = keep(step(own, "normalize", F.concat(F.lit("normalization.yaml#"), expr.lookup(names, F.col("target"))), None, F.col("first"), _strings("read_id"), before=F.col("raw")), "normalize-steps")
    renamed = F.col("target").isin(list(rebrand)) & (F.col("first") != F.col("value"))
    hops = step(cleaned.filter(renamed).withColumnRenamed("step_id", "first_id").drop("op", "parents", "body"), "normalize", f"normalization.yaml#{rules.suffix('oem_rebrand')}", None, F.col("value"), _strings("first_id"), before=F.col("first"))
    hops = keep(hops, "rebrand-steps")
    # what was taken further has its last step in the next table: three disjoint sets, no join
    ends = [read.filter(~touched), cleaned.filter(~renamed), hops]
    last = reduce(DataFrame.unionByName, (t.filter("value <> ''").select("obs_id", "source", "seq", "target_kind", "target", "value", "witness_group", "step_id") for t in ends))
    return [read, cleaned, hops], read, last


def silent_steps(observations: DataFrame, readings: DataFrame, rules: RuleSet) -> list[DataFrame]:
    """Steps of the observations that no rule maps, and of those without a reading of any kind."""
    unmapped = step(extract.unmapped(observations, rules), "unmapped_source", "claims.yaml#sources", F.array(_of("obs", F.col("obs_id"))), F.col("source"))
    nothing = step(extract.no_extraction(observations, readings.filter("value <> ''"), rules), "no_extraction", "extraction.yaml", F.array(_of("obs", F.col("obs_id"))))
    return [unmapped, nothing]


def claims(last: DataFrame, rules: RuleSet) -> DataFrame:
    """The claims, with the ids of the steps that each comes from (from): grouped once, so that no join brings these to them."""
    of_claim = F.transform(F.array_sort(F.collect_list(F.struct("seq", "step_id"))), lambda x: x["step_id"])
    # one shuffle for what groups a claim's extractions and for the window over those that contest it
    return extract.claims(last.repartition("obs_id", "target_kind", "target"), rules, **{"from": of_claim})


def claim_steps(rows: DataFrame, rules: RuleSet, keep: Callable = written) -> DataFrame:
    """The claims with their steps; ``rows`` is what ``claims`` returns."""
    groups, conflicts = F.col("witness_groups"), F.col("conflicts")
    name = F.when(F.col("kind") == "field", "field_claims").otherwise("identity_claims")
    both = F.when(F.col("kind") == "field", _decomposition(groups, conflicts, rules, "field_claims")).otherwise(_decomposition(groups, conflicts, rules, "identity_claims"))
    scored = step(rows, "score", F.concat(F.lit("scoring.yaml#"), name), None, F.col("weight"), F.col("from"), key=F.col("key"), value=F.col("value"), decomposition=both)
    return keep(scored.drop("from"), "score-steps")


def unlinked_steps(observations: DataFrame, claims: DataFrame) -> DataFrame:
    """Steps of the observations without an identity claim."""
    without = observations.select("obs_id").distinct().join(claims.filter("kind = 'link_basis'").select("obs_id"), "obs_id", "left_anti")
    return step(without, "no_identity_claim", "claims.yaml#link_bases", F.array(_of("obs", F.col("obs_id"))))


def _ends() -> Column:
    return F.array(_of("obs", F.col("a")), _of("obs", F.col("b")))


def _link_weight() -> Column:
    return F.round("weight", 6).alias("link_weight")


def refused_steps(edges: DataFrame, rules: RuleSet) -> DataFrame:
    """Steps of the pairs below the threshold: no other step comes from them, nor they from any."""
    limit = float(rules.entity_resolution["link_weight_threshold"])
    return step(edges.filter("not accepted"), "merge_refused", "entity_resolution.yaml#link_weight_threshold", _ends(), None, None, reason=F.lit("below_threshold"), detail=F.struct("basis", _link_weight(), F.lit(limit).alias("threshold")))


def entity_steps(scored: DataFrame, membership: DataFrame, conflicts: DataFrame, linked: DataFrame, rules: RuleSet, keep: Callable = written) -> list[DataFrame]:
    """Steps of pairs and entities; ``scored`` has the identity claims.

    ``conflicts`` is what ``entity.cross_basis`` returns, ``linked`` what ``entity.linking`` does, with the step_id of the claim.
    """
    # ids travel as their 32 bytes, and with the pairs: no join brings them back
    short, whole = lambda c: F.unhex(F.substring(c, 8, 64)), lambda c: F.concat(F.lit("sha256:"), F.lower(F.hex(c)))
    edges = written(entity.pair_edges(scored.withColumn("id", short("step_id")), rules, ["id"]), "pair-edges")
    refused = refused_steps(edges, rules)
    # accepted pairs lie inside entities
    forest = entity.ordered_forest(edges, rules, membership.select(F.col("obs_id").alias("node"), F.col("entity_id").alias("component")), ["a_id", "b_id"])
    merges = keep(step(forest, F.when(F.col("merges"), "merge").otherwise("merge_redundant"), "entity_resolution.yaml#merge_order", _ends(), None, _strings(whole("a_id"), whole("b_id")), detail=F.struct("basis", _link_weight(), "value")).drop("a_id", "b_id"), "merge-steps")
    policy = rules.entity_resolution.get("cross_basis_conflict", {}).get("policy", "precedence_wins")
    crossed = step(conflicts, "merge_refused", "entity_resolution.yaml#basis_precedence", F.array(_of("obs", F.col("obs_id"))), None, None, reason=F.lit("cross_basis_conflict"), detail=F.struct("bases", F.lit(policy).alias("policy"), F.col("bases")[0].alias("precedence_winner")))
    # all pairs of an observation are in one component, and so in the order of their places there
    order = F.struct("place", short("step_id").alias("id"))
    touching = merges.select(F.explode(F.array("a", "b")).alias("obs_id"), order.alias("m")).groupBy("obs_id").agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: whole(m["id"])).alias("merge_ids"))
    best = linked.select("obs_id", F.col("step_id").alias("claim_id"))
    rows = membership.join(best, "obs_id", "left").join(touching, "obs_id", "left")
    from_ = F.concat(F.when(F.col("claim_id").isNotNull(), F.array("claim_id")).otherwise(_strings()), F.coalesce("merge_ids", _strings()))
    basis = F.when(F.col("link_basis") != "none", F.col("link_basis")).alias("link_basis")
    return [refused, merges, crossed, step(rows, "assign_entity", "entity_resolution.yaml#entity_id", F.array(_of("obs", F.col("obs_id"))), F.col("entity_id"), from_, detail=F.struct("basis_agreement", basis))]


def field_steps(scored: DataFrame, membership: DataFrame, resolved: DataFrame, observed: DataFrame, rollups: DataFrame, rules: RuleSet, keep: Callable = written) -> list[DataFrame]:
    own = written(scored.filter("kind = 'field'").join(membership.select("obs_id", "entity_id"), "obs_id").select("entity_id", F.col("key").alias("field"), "obs_id", "value", "weight", "witness_groups", "in_vocab", F.col("step_id").alias("claim_id")), "field-claims")
    of_obs, of_entity = F.array(_of("obs", F.col("obs_id"))), F.array(_of("entity", F.col("entity_id")))
    field, confidence, key = F.col("field"), F.col("confidence"), ["entity_id", "field"]
    rejected = step(own.filter("not in_vocab"), "vocab_reject", "claims.yaml#closed_vocabulary_fields", of_obs, F.col("value"), _strings("claim_id"), field=field)
    place = F.struct("obs_id", "value", "claim_id")
    cells = resolved.join(own.select(*key, "obs_id", F.col("value").alias("claimed"), "weight", F.col("witness_groups").alias("groups"), "in_vocab", "claim_id"), key, "left")
    wins = F.col("in_vocab") & (F.col("claimed") == F.col("value"))
    place = F.struct("obs_id", F.col("claimed").alias("value"), "claim_id")
    ids = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda x: x["claim_id"])
    facts = cells.groupBy(*key).agg(ids(F.when(F.col("in_vocab"), place)).alias("candidates"), F.array_sort(F.collect_set(F.when(F.col("in_vocab"), F.col("claimed")))).alias("values"), ids(F.when(wins, place)).alias("winning"), F.min(F.when(wins, F.struct((-F.col("weight")).alias("w"), "obs_id", "claim_id"))).alias("best"), F.flatten(F.collect_set(F.when(F.col("claimed") != F.col("value"), F.col("groups")))).alias("against"))
    rows = written(resolved.join(facts, key), "resolve-rows")
    none, split = F.size("candidates") == 0, (F.col("value") == UNDECIDABLE) & (F.size("values") > 1) & (F.size("winning") == 0)
    unknown = step(rows.filter(none), "resolve_field", "field_resolution.yaml#unknown_handling", of_entity, F.col("value"), None, field=field, confidence=F.lit(0.0))
    undecided = step(rows.filter(~none & split), "resolve_field", "field_resolution.yaml#conflict_policy.per_field", of_entity, F.col("value"), F.col("candidates"), field=field, confidence=F.lit(0.0), detail=F.struct(F.lit("temporal_field_disagreement").alias("reason"), "values"))
    won = rows.filter(~none & ~split)
    contesting = F.array_sort(F.array_except(F.array_distinct("against"), "witness_groups"))
    rescored = keep(step(won, "score_entity", "field_resolution.yaml#entity_corroboration", None, confidence, F.col("winning"), key=field, value=F.col("value"), decomposition=_decomposition(F.col("witness_groups"), contesting, rules, "entity_corroboration")), "rescore-steps")
    decided = rescored.withColumnRenamed("step_id", "rescore_id").drop("op", "parents", "body")
    decided = step(decided, "resolve_field", "field_resolution.yaml#conflict_policy", of_entity, F.col("value"), _strings("best.claim_id", "rescore_id"), field=field, confidence=confidence, detail=F.struct("runner_up", "runner_up_weight"))
    columns = [*key, "value", "confidence", *STEP]
    settled = keep(unknown.select(columns).unionByName(undecided.select(columns)).unionByName(decided.select(columns)), "resolve-steps")
    return [rejected, rescored, settled, *_observation_steps(own, membership, settled, observed, rules), *_rollup_steps(settled, rollups, rules)]


def _observation_steps(own: DataFrame, membership: DataFrame, settled: DataFrame, observed: DataFrame, rules: RuleSet) -> list[DataFrame]:
    key, of_obs, field = ["entity_id", "field"], F.array(_of("obs", F.col("obs_id"))), F.col("field")
    mine = own.filter("in_vocab").groupBy("obs_id", "field", "value").agg(F.max(F.struct("weight", "claim_id")).alias("mine"))
    rows = observed.join(settled.select(*key, F.col("value").alias("answer"), F.col("confidence").alias("whole"), F.col("step_id").alias("resolve_id")), key).join(mine, ["obs_id", "field", "value"], "left").join(membership.select("obs_id", "link_weight"), "obs_id")
    rows = written(rows, "observation-rows")
    absent, split = F.col("answer").isin(sorted(rules.absent())), F.col("answer") == UNDECIDABLE
    direct, value, confidence, provenance = F.col("provenance") == "direct", F.col("value"), F.col("confidence"), F.col("provenance")
    common = {"field": field, "provenance": provenance, "confidence": confidence}
    base = "field_resolution.yaml#"
    parts = [
        step(rows.filter(absent), "observation_field", base + "unknown_handling", of_obs, value, _strings("resolve_id"), **common),
        step(rows.filter(~absent & split & direct), "observation_field", base + "conflict_policy.per_field", of_obs, value, _strings("mine.claim_id"), **common, detail=F.struct(F.lit(UNDECIDABLE).alias("entity_value"))),
        step(rows.filter(~absent & split & ~direct), "observation_field", base + "conflict_policy.per_field", of_obs, value, _strings("resolve_id"), **common),
        step(rows.filter(~absent & ~split & direct), "observation_field", base + "conflict_policy", of_obs, value, _strings("mine.claim_id"), **common),
        step(rows.filter(provenance == "propagated"), "propagate", base + "decay_base", of_obs, value, _strings("resolve_id"), **common, detail=F.struct(F.lit(1).alias("hop"), "link_weight", F.col("whole").alias("source_confidence"))),
    ]
    return parts


def _rollup_steps(settled: DataFrame, rollups: DataFrame, rules: RuleSet) -> list[DataFrame]:
    live = F.when(F.col("confidence") > 0, F.struct("field", "confidence"))
    facts = settled.groupBy("entity_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("field", "step_id"))), lambda x: x["step_id"]).alias("from"), F.map_from_entries(F.array_sort(F.collect_list(live))).alias("contributing_fields"), F.array_sort(F.collect_list(F.when(F.col("confidence") <= 0, F.col("field")))).alias("excluded_unknown"))
    rows = written(rollups.join(facts, "entity_id"), "rollup-rows")
    weights = F.struct(*(F.lit(float(v)).alias(k) for k, v in sorted(rules.scoring["stability"]["weights"].items())))
    return [
        step(rows, "resolve_entity", "scoring.yaml#confidence_rollup", None, F.col("confidence"), F.col("from"), detail=F.struct("contributing_fields", "excluded_unknown")),
        step(rows, "stability", "scoring.yaml#stability", None, F.col("stability"), F.col("from"), detail=F.struct(weights.alias("weights"))),
    ]


def together(*parts: list[DataFrame], columns: list[str] = STEP) -> DataFrame:
    """``columns`` of the steps in ``parts``; a decision made twice is still there twice."""
    return reduce(DataFrame.unionByName, (p.select(columns) for part in parts for p in part))


def counts(steps: DataFrame) -> DataFrame:
    """op and the number n of its different steps; ids meet as their 32 bytes, not as text of more than twice that."""
    return steps.select(F.unhex(F.substring("step_id", 8, 64)).alias("id"), "op").distinct().groupBy("op").agg(F.count(F.lit(1)).alias("n"))
