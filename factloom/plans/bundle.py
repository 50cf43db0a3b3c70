"""A run from files to files: tables, trace, metrics, history and report in a folder of its own; the evaluation against labels."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.storage import written
from factloom.operators import evaluate, fields, replay
from factloom.operators.fields import UNDECIDABLE
from factloom.operators.lifecycle import version_verified
from factloom.plans.stages import Stages
from factloom.sources import files, tables
from factloom.sources.rules import RuleSet, canonical_file_hash, load_rules

#: Rejected values that a report lists; the table ``rejects`` has all.
REPORTED = 200
METRIC = ("metric", "n", "scope", "value")


def _line(*first: Column) -> Column:
    return F.to_json(F.struct(*first, *METRIC))


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def run_id(spark: SparkSession, input_hash: str, root: str) -> str:
    """Time and input; a number follows where that folder is taken."""
    first = f"{_now()}-{input_hash.removeprefix('sha256:')[:6]}"
    name, n = first, 1
    while files.exists(spark, f"{root}/{name}"):
        n += 1
        name = f"{first}-{n}"
    return name


def manifest(rules: RuleSet, input_hash: str, name: str, engine: str, registry_hash: str | None) -> dict:
    """What a run was made from. Definitions of metrics have a hash of their own: they change no result."""
    return {
        "run_id": name, "input_hash": input_hash, "engine_commit": engine, "metrics_hash": registry_hash,
        "rules_version": rules.version, "rules_rollup": rules.rollup, "rules_files": dict(rules.file_hashes), "version_verified": rules.version_verified,
        "absent_values": sorted(rules.absent()),
    }


def claims_table(stages: Stages, trace: DataFrame) -> DataFrame:
    steps = replay.claims(trace).select("obs_id", "key", "value", "derivation_step")
    return stages.claims.join(steps, ["obs_id", "key", "value"], "left").select("derivation_step", "obs_id", "kind", "key", "value", "weight", "witness_groups", "sources", "in_vocab")


def membership_table(stages: Stages, trace: DataFrame) -> DataFrame:
    return stages.membership.join(replay.assignments(trace), "obs_id", "left").select("derivation_step", "obs_id", "entity_id", "link_basis", "link_weight", "basis_agreement", F.coalesce("conflict_detail", F.lit("")).alias("conflict_detail"))


def entities_table(stages: Stages, trace: DataFrame) -> DataFrame:
    rows = fields.wide_entities(stages.resolved, stages.rollups, stages.rules)
    names = stages.rules.fields
    return rows.join(replay.entity_steps(trace), "entity_id", "left").select("derivation_step", "entity_id", *names, *(f"{f}_confidence" for f in names), "confidence", "stability")


def resolutions_table(stages: Stages, trace: DataFrame) -> DataFrame:
    rows = fields.wide(stages.observed, stages.rules).join(stages.rollups, "entity_id").join(replay.entity_steps(trace), "entity_id", "left")
    return rows.select("obs_id", "derivation_step", "entity_id", *(c for f in stages.rules.fields for c in (f, f"{f}_provenance")), "confidence", "stability")


def write_bundle(stages: Stages, folder: str, about: dict, single: bool = True) -> None:
    """The tables, each row with the run and the step it came from, the consumers' table, the trace and the manifest."""
    spark, trace = stages.observations.sparkSession, stages.trace
    files.write_json(spark, f"{folder}/manifest.json", about)
    for name, make, order in (("claims", claims_table, ["obs_id", "kind", "key", "value"]), ("membership", membership_table, ["obs_id"]), ("entities", entities_table, ["entity_id"]), ("resolutions", resolutions_table, ["obs_id"])):
        table = make(stages, trace).withColumn("run_id", F.lit(about["run_id"]))
        first = ["obs_id", "run_id"] if name == "resolutions" else ["run_id"]
        files.export_csv(table.select(*first, *(c for c in table.columns if c not in first)), f"{folder}/{name}.csv", order, single)
    files.export_csv(fields.final_output(stages.observed, stages.rollups, stages.rules), f"{folder}/final-output.csv", ["obs_id"], single)
    files.export_lines(trace, f"{folder}/trace.jsonl", F.col("body"), ["step_id"], single)


def metric_rows(stages: Stages) -> DataFrame:
    kept = [stages.once(n, m) for n, m in (("seen", lambda: stages.observations.select("obs_id", "source")), ("extracted", lambda: stages.extractions.select("obs_id").distinct()))]
    return evaluate.metrics(*kept, stages.claims, stages.membership, stages.resolved, written(stages.observed, "observed"), written(stages.rollups, "rollups"), stages.rules)


def append_history(metrics: DataFrame, path: str, name: str) -> None:
    """The run's metrics as one more file of the history."""
    metrics.select(_line(F.lit(name).alias("run_id")).alias("value")).coalesce(1).write.mode("append").text(path)


def cell(text) -> str:
    """A value that may stand in a cell of a table."""
    return str("" if text is None else text).replace("|", "\\|").replace("\n", " ")


def _table(head: list[str], rows: Iterable[list]) -> list[str]:
    return [f"| {' | '.join(head)} |", f"|{'---|' * len(head)}", *(f"| {' | '.join(cell(c) for c in r)} |" for r in rows)]


def report(about: dict, membership: DataFrame, resolved: DataFrame, claims: DataFrame, names: list[str], buckets: dict[str, int] | None = None, broken: DataFrame | None = None) -> str:
    """The run in Markdown, from aggregates of a few rows."""
    sizes = membership.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("entities"), F.count(F.when(F.col("n") == 1, 1)).alias("single"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    contested = membership.filter("not basis_agreement").count()
    absent = F.col("value").isin(about["absent_values"])
    cells = {r.field: r for r in resolved.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(absent, 1)).alias("unknown"), F.count(F.when(F.col("value") == UNDECIDABLE, 1)).alias("open"), F.avg("confidence").alias("mean")).collect()}
    known = [[f, cells[f].n - cells[f].unknown - cells[f].open, cells[f].unknown, cells[f].open, f"{cells[f].mean:.2f}"] for f in names if f in cells]
    rejects = evaluate.ranked_rejects(evaluate.reject_queue(claims), REPORTED).collect()
    lines = ["# Run report", "", "## Provenance", "", *(f"- `{k}`: `{about[k]}`" for k in ("run_id", "rules_version", "rules_rollup", "input_hash", "version_verified", "engine_commit"))]
    share = sizes.single / max(sizes.entities, 1)
    lines += ["", "## Entities", "", *_table(["Observations", "Entities", "Singletons", "Largest", "Contested"], [[sizes.rows, sizes.entities, f"{sizes.single} ({share:.0%})", sizes.largest, contested]])]
    lines += ["", "## Fields", "", *_table(["Field", "Known", "Unknown", "Undecidable", "Mean confidence"], known)]
    lines += ["", "## Values outside the vocabulary", "", *(_table(["Field", "Value", "Observations", "First ones"], ([r.key, r.value, r.n, r.examples.replace("|", ", ")] for r in rejects)) if rejects else ["None."])]
    if broken is not None:
        lines += ["", "## Against the baseline", ""]
        lines += _table(["Bucket", "Labels"], sorted(buckets.items())) if buckets is not None else ["No baseline was given."]
        rows = broken.orderBy("obs_id", "key").limit(REPORTED).collect()
        lines += ["", *(_table(["Observation", "Field", "Before", "After", "Changed rules"], ([r.obs_id, r.key, r.before, r.after, r.changed_rule_files] for r in rows)) if rows else ["Nothing broke."])]
    return "\n".join(lines) + "\n"


class RunResult:
    def __init__(self, folder: str, stages: Stages, about: dict):
        self.folder, self.stages, self.about = folder, stages, about

    def write_report(self, buckets: dict[str, int] | None = None, broken: DataFrame | None = None) -> None:
        s = self.stages
        text = report(self.about, s.membership, s.resolved, s.claims, s.rules.fields, buckets, broken)
        files.write_text(s.observations.sparkSession, f"{self.folder}/REPORT.md", text)


def run_pipeline(spark: SparkSession, observations: str, rules_folder: str, root: str, registry: str | None = None, engine: str = "unknown", single: bool = True) -> RunResult:
    """Read, derive and write: the entry of a run. ``registry``: the metrics that may be given; none, all of them."""
    rows = written(tables.read_observations(spark, observations), "observations")
    rules = load_rules(rules_folder)
    rules = rules if rules.version_verified is not None else _policed(spark, rules, root)
    input_hash = files.content_hash(spark, observations)
    name = run_id(spark, input_hash, root)
    stages, folder = Stages(rows, rules), f"{root}/{name}"
    about = manifest(rules, input_hash, name, engine, canonical_file_hash(registry) if registry else None)
    write_bundle(stages, folder, about, single)
    metrics = metric_rows(stages)
    metrics = written(tables.registered(metrics, tables.load_registry(registry), labels=False) if registry else metrics, "metrics")
    files.export_lines(metrics, f"{folder}/metrics.jsonl", _line(), ["metric", "scope"], single)
    files.export_csv(evaluate.reject_queue(stages.claims), f"{folder}/rejects.csv", ["key", "value"], single)
    append_history(metrics, f"{root}/history", name)
    result = RunResult(folder, stages, about)
    result.write_report()
    return result


def _policed(spark: SparkSession, rules: RuleSet, root: str) -> RuleSet:
    """``rules`` with version_verified: whether the last run's hash moved under an unchanged version."""
    from dataclasses import replace

    path = f"{root}/last_rules_state.json"
    known = json.loads(files.read_text(spark, path)) if files.exists(spark, path) else None
    files.write_json(spark, path, {"rollup": rules.rollup, "version": rules.version})
    return replace(rules, version_verified=known is None or known["rollup"] == rules.rollup or known["version"] != rules.version)


def scores(outcome: DataFrame) -> DataFrame:
    """metric, scope, value, n of the outcomes of labels."""
    calibration = evaluate.calibration(outcome).select(F.lit("confidence_calibration_error").alias("metric"), F.concat(F.lit("bucket:"), "bucket").alias("scope"), "value", "n")
    stable = evaluate.accuracy_by_stability(outcome).select(F.lit("accuracy_by_stability").alias("metric"), F.concat(F.lit("bucket:"), "bucket").alias("scope"), "value", "n")
    quadrants = evaluate.stability_quadrants(outcome).select(F.lit("accuracy_by_stability").alias("metric"), F.col("quadrant").alias("scope"), "value", "n")
    by_field = evaluate.accuracy(outcome).withColumn("scope", F.concat(F.lit("field:"), "scope"))
    return by_field.unionByName(calibration).unionByName(stable).unionByName(quadrants)


def evaluate_run(spark: SparkSession, observations: str, rules_folder: str, labels: str, root: str, runs_root: str, baseline: str | None = None, changed: Iterable[str] = (), registry: str | None = None, engine: str = "unknown", single: bool = True) -> str:
    """A run scored against labels, in a folder of its own. ``baseline``: the folder of an earlier evaluation on the same labels.

    That the labels are the same is checked before anything runs or is written.
    """
    labels_hash = files.content_hash(spark, labels)
    before = None
    if baseline is not None:
        before = json.loads(files.read_text(spark, f"{baseline}/eval_manifest.json"))
        if before["labels_hash"] != labels_hash:
            raise evaluate.LabelsMoved("the labels differ between the evaluations; make two passes")
    run = run_pipeline(spark, observations, rules_folder, runs_root, registry, engine, single)
    stages = run.stages
    outcome = written(evaluate.outcomes(tables.read_labels(spark, labels), stages.observed, stages.resolved, stages.rollups, stages.claims), "outcomes")
    name = run_id(spark, labels_hash, root)
    out = f"{root}/{name}"
    parent = labels.rsplit("/", 1)[0]
    version = files.read_text(spark, f"{parent}/VERSION").strip() if files.exists(spark, f"{parent}/VERSION") else None
    about = {"eval_id": name, "run_id": run.about["run_id"], "rules_rollup": run.about["rules_rollup"], "labels_hash": labels_hash, "labels_version": version, "labels_version_verified": version_verified(spark, labels)}
    about |= {"baseline_run_id": before and before["run_id"], "baseline_labels_hash": before and before["labels_hash"]}
    files.write_json(spark, f"{out}/eval_manifest.json", about)
    rows = scores(outcome)
    files.export_lines(tables.registered(rows, tables.load_registry(registry), labels=True) if registry else rows, f"{out}/metrics.jsonl", _line(), ["metric", "scope"], single)
    outcome.write.parquet(f"{out}/outcomes")
    counts, buckets = None, None
    if before is not None:
        buckets = written(evaluate.four_buckets(spark.read.parquet(f"{baseline}/outcomes"), outcome, before["labels_hash"], labels_hash), "buckets")
        counts = dict.fromkeys(("fixed", "broken", "stable_correct", "stable_incorrect"), 0) | {r.bucket: r["count"] for r in buckets.groupBy("bucket").count().collect()}
        files.write_json(spark, f"{out}/four_bucket.json", counts)
    else:
        buckets = evaluate.four_buckets(outcome, outcome).limit(0)
    broken = evaluate.regressions(buckets, list(changed))
    files.export_csv(broken, f"{out}/regressions.csv", ["obs_id", "key"], single)
    run.write_report(counts, broken)
    return out
