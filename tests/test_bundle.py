"""A run from files to files, its evaluation, the label commit and rule proposals."""

import csv
import hashlib
import json
import re

import pytest

from factloom.operators import evaluate, extract, improve, lifecycle, replay
from factloom.plans import bundle
from factloom.plans.evidence import event_rules, observations, wide_labels
from factloom.sources import files, rules as rule_files, tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Rules, 60 observations and their labels as files."""
    import yaml

    at, rules = tmp_path_factory.mktemp("run"), event_rules()
    (at / "rules").mkdir()
    (at / "labels").mkdir()
    for name in rule_files.FILES:
        (at / "rules" / f"{name}.yaml").write_text(yaml.safe_dump(getattr(rules, name)))
    (at / "rules" / "canonical_vocab.csv").write_text("tier,role\n" + "\n".join(f"{a},{b}" for a, b in zip(sorted(rules.vocab["tier"]), sorted(rules.vocab["role"]), strict=True)))
    (at / "rules" / "VERSION").write_text("1.0.0\n")
    rows = observations(spark, "/root/testdata/sf0.001").orderBy("obs_id").limit(60)
    names = [c.split()[0] for c in tables.OBSERVATION.split(", ")]
    with open(at / "observations.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(names)
        out.writerows([r.asDict().get(n, "") for n in names] for r in rows.collect())
    marks = evaluate.unpivot_labels(wide_labels(rows), ["tier", "item"])
    columns = [c.split()[0] for c in tables.LABEL.split(", ")]
    with open(at / "labels" / "labels.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for r in sorted(marks.collect()):
            given = r.asDict() | {"status": "proposed", "label_basis": "payload_inference"}
            out.writerow([given.get(c, "") for c in columns])
    (at / "labels" / "VERSION").write_text("0.1.0\n")
    return at


def read(path):
    with open(path, newline="", encoding="utf-8") as f:
        return list(csv.DictReader(f))


def test_run_and_evaluation_write_what_can_be_read_back(spark, folder):
    args = (spark, f"{folder}/observations.csv", f"{folder}/rules", f"{folder}/labels/labels.csv", f"{folder}/evals", f"{folder}/runs")
    out = bundle.evaluate_run(*args)
    about = json.loads((folder / "evals" / out.rsplit("/", 1)[1] / "eval_manifest.json").read_text())
    run = folder / "runs" / about["run_id"]
    told = json.loads((run / "manifest.json").read_text())
    assert told["input_hash"] == "sha256:" + hashlib.sha256((folder / "observations.csv").read_bytes()).hexdigest()
    assert told["rules_version"] == "1.0.0" and told["version_verified"] and about["labels_version"] == "0.1.0" and about["labels_version_verified"] is None

    steps = [json.loads(line) for line in (run / "trace.jsonl").read_text().splitlines()]
    ids = [s["step_id"] for s in steps]
    assert ids == sorted(set(ids))
    claims, members, entities, seen = (read(run / f"{n}.csv") for n in ("claims", "membership", "entities", "resolutions"))
    assert len(members) == len(seen) == len(read(run / "final-output.csv")) == 60
    assert {m["entity_id"] for m in members} == {e["entity_id"] for e in entities}
    kinds = {s["step_id"]: s["op"] for s in steps}
    assert {kinds[r["derivation_step"]] for r in claims} == {"score"}
    assert {kinds[r["derivation_step"]] for r in members} == {"assign_entity"}
    assert {kinds[r["derivation_step"]] for r in entities + seen} == {"resolve_entity"}
    assert {r["in_vocab"] for r in claims} <= {"True", "False"} and {r["run_id"] for r in claims + members + entities + seen} == {about["run_id"]}
    order = [(c["obs_id"], c["kind"], c["key"], c["value"]) for c in claims]
    assert order == sorted(order) and list(entities[0])[2:4] == ["entity_id", "tier"]

    again = replay.claims(tables.read_trace(spark, str(run / "trace.jsonl")))
    assert {(r.obs_id, r.key, r.value) for r in again.collect()} == {(c["obs_id"], c["key"], c["value"]) for c in claims}
    metrics = [json.loads(line) for line in (run / "metrics.jsonl").read_text().splitlines()]
    assert {"metric": "entity_count", "scope": "global", "value": float(len(entities)), "n": len(entities)} in metrics
    history = [json.loads(r.value) for r in spark.read.text(f"{folder}/runs/history").collect()]
    assert len(history) == len(metrics) and {h["run_id"] for h in history} == {about["run_id"]}
    assert f"| 60 | {len(entities)} |" in (run / "REPORT.md").read_text()

    later = bundle.evaluate_run(*args, baseline=out, changed=["claims.yaml"])
    counts = json.loads((folder / "evals" / later.rsplit("/", 1)[1] / "four_bucket.json").read_text())
    assert counts["fixed"] == counts["broken"] == 0 and counts["stable_correct"] > 0
    assert read(f"{later}/regressions.csv") == []
    text = (folder / "labels" / "labels.csv").read_text()
    (folder / "labels" / "labels.csv").write_text(text + "\n")
    runs = sorted(p.name for p in (folder / "runs").iterdir())
    with pytest.raises(evaluate.LabelsMoved):
        bundle.evaluate_run(*args, baseline=out)
    assert runs == sorted(p.name for p in (folder / "runs").iterdir())  # refused before anything ran
    (folder / "labels" / "labels.csv").write_text(text)


def test_labels_are_archived_before_they_change(spark, folder):
    path = f"{folder}/labels/labels.csv"
    before, old = (folder / "labels" / "labels.csv").read_bytes(), tables.read_labels(spark, path)
    first = read(path)[0]
    new = old.filter(f"obs_id = '{first['obs_id']}' and key = '{first['key']}'").selectExpr("obs_id", "key_type", "key", "'other' as value", "'adjudicated' as status", "'physical_inspection' as label_basis", "'low' as labeler_certainty", "'true' as blinded", "obs_hash", "'second' as labeled_by", "labeled_at")
    nothing = lifecycle.commit_labels(spark, path, lifecycle.apply_adjudicated(old, new.limit(0)), "run", "now")
    assert nothing["bump"] is None and (folder / "labels" / "labels.csv").read_bytes() == before
    done = lifecycle.commit_labels(spark, path, lifecycle.apply_adjudicated(old, new), "run", "now")
    assert (done["bump"], done["version_after"]) == ("minor", "0.2.0")
    assert (folder / "labels" / "archive" / "0.1.0-labels.csv").read_bytes() == before
    rows = read(path)
    keys = [(r["obs_id"], r["key_type"], r["key"], r["value"]) for r in rows]
    assert keys == sorted(keys) and sum(r["value"] == "other" for r in rows) == 1 and len(rows) == len(before.splitlines()) - 1
    assert lifecycle.version_verified(spark, path)
    (folder / "labels" / "VERSION").write_text("0.1.0\n")
    assert lifecycle.version_verified(spark, path) is False
    with pytest.raises(lifecycle.LabelError, match="archived"):
        lifecycle.commit_labels(spark, path, lifecycle.apply_adjudicated(tables.read_labels(spark, path), new.selectExpr("obs_id", "key_type", "key", "'third' as value", "status", "'physical_inspection' as label_basis", "labeler_certainty", "blinded", "obs_hash", "labeled_by", "labeled_at").limit(0).unionByName(old.limit(1).selectExpr("'new' as obs_id", "key_type", "key", "value", "status", "label_basis", "labeler_certainty", "blinded", "obs_hash", "labeled_by", "labeled_at"))), "run", "now")


def test_proposals_are_checked_and_merged(spark, folder, tmp_path):
    rules = rule_files.load_rules(folder / "rules")
    backlog = spark.createDataFrame([("a", "click", "colour=red"), ("b", "view", None)], "obs_id string, source string, raw_payload string")
    good = {"name": "colour", "source": "click", "pattern": r"colour=(?P<v>\w+)", "target_kind": "field", "target": "tier", "tests": [{"payload": "colour=blue", "expect": "blue"}]}
    assert improve.rule_faults(good, rules, backlog) == []
    bad = good | {"name": "Colour", "source": "x", "target": "y", "pattern": r"(?P<v>size)", "tests": [{"payload": "colour", "expect": "blue"}]}
    assert len(improve.rule_faults(bad, rules, backlog)) == 4
    for change, part in (({"name": "k_tier"}, "taken"), ({"pattern": "("}, "compile"), ({"pattern": "colour"}, "group v"), ({"tests": []}, "no tests"), ({"pattern": r"size=(?P<v>\w+)", "tests": [{"payload": "size=1", "expect": "1"}]}, "nothing of the backlog")):
        assert any(part in f for f in improve.rule_faults(good | change, rules, backlog)), part
    rule = {"colour": {"sources": ["click"], "pattern": good["pattern"], "target_kind": "field", "target": "tier"}}
    assert [tuple(r) for r in improve.coverage(rule, backlog).collect()] == [("colour", 1)]

    queue = spark.createDataFrame([("tier", " Shiny  Gold")], "key string, value string")
    alias = {"block": "tier_alias", "surface": "shiny gold", "target": "gold"}
    assert improve.alias_faults(alias, rules, queue) == []
    assert [len(improve.alias_faults(alias | c, rules, queue, {("tier_alias", "x")})) for c in ({"block": "none"}, {"target": "red"}, {"surface": "x"}, {"surface": "Shiny Gold"})] == [1, 1, 2, 1]
    live = {p.name: p.read_bytes() for p in (folder / "rules").iterdir()}
    tried = improve.candidate(tmp_path / "one", folder / "rules", rule)
    assert "colour" in tried.extraction["rules"] and live == {p.name: p.read_bytes() for p in (folder / "rules").iterdir()}
    assert improve.accept(folder / "rules", tmp_path / "two", rule) == "1.1.0" and "colour" in rule_files.load_rules(folder / "rules").extraction["rules"]
    found = extract.extract(spark.createDataFrame([("a", "click", "colour=red", "", "", "")], "obs_id string, source string, raw_payload string, mac string, hostname string, open_ports string"), rule_files.load_rules(folder / "rules"))
    assert "red" in {r.value for r in found.collect()}
    buckets = spark.createDataFrame([("fixed",), ("stable_correct",)], "bucket string")
    assert improve.verdict(buckets)[0] and not improve.verdict(buckets.unionByName(spark.createDataFrame([("broken",)], "bucket string")))[0]


def test_exports_in_parts_keep_their_order(spark, tmp_path):
    df = spark.range(500).selectExpr("id", "id % 2 = 0 as even", "array('a', 'b') as tags")
    files.export_csv(df.repartition(7), f"{tmp_path}/x", ["id"], single=False)
    parts = sorted(p for p in (tmp_path / "x").iterdir() if re.match("part-", p.name))
    rows = [r for p in parts for r in read(p)]
    assert [int(r["id"]) for r in rows] == list(range(500)) and rows[0] == {"id": "0", "even": "True", "tags": "a|b"}
