"""Labels as they move: checks, changes, adjudicated returns, packets for labellers, and what a change does to the version."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.operators.evaluate import BASIS_PRECEDENCE
from factloom.sources import files
from factloom.sources.rules import RuleSet, bumped

IDENTITY = ["obs_id", "key_type", "key", "id_value"]
BUMPS = ("patch", "minor", "major")
#: What each kind of change does to those who read the labels.
CHANGE_BUMP = {"provenance_upgraded": "patch", "corroborated": "patch", "value_changed": "minor", "added": "minor", "removed": "major"}
#: What is settled, what is hard to label, the keys of pair labels, and what labellers get to see.
STICKY = ("adjudicated", "agreed")
STRATUM = ("medium", "low")
PAIR_KEYS = ("same_device",)
PACKET = ("obs_id", "obs_hash", "source", "raw_payload", "mac", "hostname", "open_ports", "site")


class LabelError(ValueError):
    """Labels that may not be taken over as they are."""


def identity(df: DataFrame) -> DataFrame:
    """``df`` with id_value: two rows of a field compete, pair labels hold side by side."""
    return df.withColumn("id_value", F.when(F.col("key_type") == "field", "").otherwise(F.col("value")))


def undeclared_columns(columns: Iterable[str], fields: Iterable[str], others: Iterable[str] = ("obs_id", "entity_id", "confidence", "notes")) -> list[str]:
    """Columns of a wide label file that are no declared field: a mistyped header would drop that field's labels."""
    return sorted(set(columns) - set(fields) - set(others))


def check_import(wide: DataFrame, fields: list[str], existing: DataFrame | None = None, force: bool = False) -> None:
    """Refuses undeclared columns, and to overwrite labels that are more than inference."""
    if bad := undeclared_columns(wide.columns, fields):
        raise LabelError(f"undeclared label columns: {', '.join(bad)}")
    if existing is not None and not force and not existing.filter("label_basis <> 'payload_inference'").isEmpty():
        raise LabelError("labels beyond payload_inference would be lost")


def out_of_vocabulary(labels: DataFrame, rules: RuleSet) -> DataFrame:
    """obs_id, key and value of closed fields' labels that the vocabulary lacks: requests to change rules, not labels."""
    known = F.lit(True)
    for name in rules.closed:
        known = F.when(F.col("key") == name, F.col("value").isin(sorted(rules.words(name)))).otherwise(known)
    return labels.filter((F.col("key_type") == "field") & ~known).select("obs_id", "key", "value")


def label_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """obs_id, key_type, key, before, after and change (added, removed, value_changed) between two label sets."""
    b = identity(before).select(*IDENTITY, F.col("value").alias("before"))
    a = identity(after).select(*IDENTITY, F.col("value").alias("after"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(F.col("before") != F.col("after"), "value_changed")
    return b.join(a, IDENTITY, "full").select("obs_id", "key_type", "key", "before", "after", change.alias("change")).filter("change is not null")


def propose_bump(changes: DataFrame) -> str | None:
    """The strongest bump that the changes call for; none if there are none."""
    rank = expr.lookup({c: BUMPS.index(b) for c, b in CHANGE_BUMP.items()}, F.col("change"))
    top = changes.agg(F.max(rank).alias("top")).first()["top"]
    return None if top is None else BUMPS[top]


def apply_adjudicated(existing: DataFrame, accepted: DataFrame) -> DataFrame:
    """One row for each label of ``existing`` or ``accepted``: the label that holds, with ``change`` and ``refused``.

    All rows of one identity are settled together, the existing one among them: the strongest basis wins, and equals that differ are
    refused. ``change`` is added, value_changed, provenance_upgraded, corroborated (by another labeller) or null; ``refused`` says why
    returned rows changed nothing. A refused group without an existing label has no value.
    """
    columns = existing.columns
    rank = F.coalesce(expr.lookup({b: n for n, b in enumerate(BASIS_PRECEDENCE)}, F.col("label_basis")), F.lit(len(BASIS_PRECEDENCE)))
    whole = F.struct(*columns)
    rows = identity(existing).withColumn("new", F.lit(False)).unionByName(identity(accepted.select(columns)).withColumn("new", F.lit(True)))
    ranked = rows.withColumn("rank", rank).withColumn("row", whole)
    best = ranked.groupBy(*IDENTITY).agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("new"), 1)).alias("returned"), F.first(F.when(~F.col("new"), F.col("row")), ignorenulls=True).alias("old"))
    top = ranked.join(best, IDENTITY)
    tie = F.struct("new", F.coalesce("labeled_by", F.lit("")).alias("by"), "row")
    facts = top.groupBy(*IDENTITY).agg(
        F.first("all").alias("all"), F.first("returned").alias("returned"), F.first("old").alias("old"),
        F.count(F.when(F.col("rank") == F.col("best"), 1)).alias("top"), F.count_distinct(F.when(F.col("rank") == F.col("best"), F.col("value"))).alias("values"),
        F.min(F.when(F.col("rank") == F.col("best"), tie)).alias("first"),
        F.coalesce(F.max(F.col("new") & ~F.col("labeled_by").eqNullSafe(F.col("old.labeled_by"))), F.lit(False)).alias("another"),
    )
    win, old = F.col("first.row"), F.col("old")
    status = F.when((F.col("top") > 1) & (F.col("all") == F.col("top")), "agreed").when(F.col("all") > 1, "adjudicated").otherwise(win["status"])
    same = (win["value"] == old["value"]) & (win["label_basis"] == old["label_basis"])
    touched, disputed = F.col("returned") > 0, F.col("values") > 1
    change = F.when(~touched | disputed, None).when(old.isNull(), "added").when(same & (status == "agreed") & F.col("another"), "corroborated").when(same, None).when(win["value"] != old["value"], "value_changed").otherwise("provenance_upgraded")
    refused = F.when(touched & disputed, "disputed").when(touched & change.isNull(), "not superseded")
    settled = facts.withColumn("change", change).withColumn("refused", refused).withColumn("status_now", status)
    value = lambda c: F.when(F.col("change").isNull(), old[c]).otherwise(F.col("status_now") if c == "status" else win[c])
    return settled.select("obs_id", "key_type", "key", *(value(c).alias(c) for c in columns if c not in ("obs_id", "key_type", "key")), "change", "refused")


def _settled() -> Column:
    return F.col("status").isin(list(STICKY)) & (F.col("label_basis") != "payload_inference")


def packet_stratum(labels: DataFrame, observations: DataFrame, reopen: Iterable[str] = ()) -> DataFrame:
    """obs_id of what goes to labellers: not all of its rows settled and its hardest field of medium or low certainty, or reopened."""
    rank = expr.certainty_rank(F.col("labeler_certainty"))
    facts = labels.groupBy("obs_id").agg(F.bool_and(_settled()).alias("settled"), F.min(F.when(F.col("key_type") == "field", rank)).alias("weakest"))
    hard = [expr.CERTAINTY.index(c) for c in STRATUM]
    chosen = observations.select("obs_id").join(facts, "obs_id", "left")
    wanted = (~F.coalesce("settled", F.lit(False)) & F.col("weakest").isin(hard)) | F.col("obs_id").isin(list(reopen))
    return chosen.filter(F.coalesce(wanted, F.lit(False))).select("obs_id")


def packet(labels: DataFrame, observations: DataFrame, hashed: list[str], reopen: Iterable[str] = ()) -> DataFrame:
    """The evidence columns of the stratum, and the hash of the row they come from; nothing that a pipeline concluded."""
    rows = observations.join(packet_stratum(labels, observations, reopen), "obs_id", "left_semi").withColumn("obs_hash", F.concat(F.lit("sha256:"), expr.obs_hash(hashed)))
    return rows.select(*(c for c in PACKET if c in rows.columns))


def returned_labels(sent: DataFrame, returned: DataFrame, observations: DataFrame, hashed: list[str], fields: list[str]) -> DataFrame:
    """``returned`` as long labels with ``rejected``: the first reason why a row may not become ground truth, or null."""
    now = observations.select("obs_id", F.concat(F.lit("sha256:"), expr.obs_hash(hashed)).alias("current_hash"))
    rows = returned.join(sent.select("obs_id").distinct().withColumn("sent", F.lit(True)), "obs_id", "left").join(now, "obs_id", "left")
    field, pair = F.col("key_type") == "field", F.col("key_type") == "link_basis"
    declared = (field & F.col("key").isin(list(fields))) | (pair & F.col("key").isin(list(PAIR_KEYS)))
    reason = (
        F.when(F.col("sent").isNull(), "not in the packet")
        .when(~F.coalesce(field | pair, F.lit(False)), "no declared kind of label")
        .when(~F.coalesce(declared, F.lit(False)), "no declared key")
        .when(F.trim(F.coalesce("value", F.lit(""))) == "", "empty value")
        .when(~F.col("obs_hash").eqNullSafe(F.col("current_hash")), "stale obs_hash")
    )
    text = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in returned.columns else F.lit(default)
    certainty = text("labeler_certainty", "")
    return rows.select("obs_id", "key_type", "key", "value", F.lit("adjudicated").alias("status"), F.lit("physical_inspection").alias("label_basis"), F.when(certainty != "", certainty).otherwise("low").alias("labeler_certainty"), F.lit("true").alias("blinded"), "obs_hash", text("labeled_by", "adjudicator").alias("labeled_by"), text("labeled_at", "").alias("labeled_at"), reason.alias("rejected"))


LABEL_ORDER = ["obs_id", "key_type", "key", "value"]


def _beside(labels: str, name: str) -> str:
    return f"{labels.rsplit('/', 1)[0]}/{name}"


def version_verified(spark: SparkSession, labels: str) -> bool | None:
    """Whether the label file is what the last commit left, under its version; None where none is recorded."""
    state = _beside(labels, "last_label_state.json")
    if not files.exists(spark, state):
        return None
    known = json.loads(files.read_text(spark, state))
    return known["labels_hash"] == files.content_hash(spark, labels) and known["version"] == files.read_text(spark, _beside(labels, "VERSION")).strip()


def commit_labels(spark: SparkSession, labels: str, settled: DataFrame, source_run: str, applied_at: str) -> dict:
    """Replaces the label file by the ``settled`` rows (``apply_adjudicated``) that hold; the old file goes to the archive.

    The new file is written first, so that a lost job leaves the old one as it was. Nothing is done where nothing changed, and an archived version is
    never overwritten. Returns what happened, as the journal has it.
    """
    changes = settled.filter("change is not null").select("obs_id", "key_type", "key", "value", "change")
    bump, version = propose_bump(changes), files.read_text(spark, _beside(labels, "VERSION")).strip()
    before = files.content_hash(spark, labels)
    done = {"applied_at": applied_at, "source_run_id": source_run, "bump": bump, "version_before": version, "version_after": version, "archive": None, "labels_hash_before": before, "labels_hash_after": before}
    if bump is None:
        return done
    archive, fresh = _beside(labels, f"archive/{version}-labels.csv"), f"{labels}.new"
    if files.exists(spark, archive):
        raise LabelError(f"version {version} is archived already")
    files.export_csv(settled.filter("value is not null").drop("change", "refused"), fresh, LABEL_ORDER)
    files.move(spark, labels, archive)
    files.move(spark, fresh, labels)
    done |= {"version_after": bumped(version, bump), "archive": archive, "labels_hash_after": files.content_hash(spark, labels), "changes": {r.change: r["count"] for r in changes.groupBy("change").count().collect()}}
    files.write_text(spark, _beside(labels, "VERSION"), done["version_after"] + "\n")
    files.write_json(spark, _beside(labels, "last_label_state.json"), {"labels_hash": done["labels_hash_after"], "version": done["version_after"]})
    entry = spark.createDataFrame([(json.dumps(done, sort_keys=True),)], "value string")
    entry.coalesce(1).write.mode("append").text(_beside(labels, "journal"))
    return done
