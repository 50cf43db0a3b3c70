import hashlib
import json

import pytest

from factloom.operators import entity, evaluate, lifecycle, replay, trace
from factloom.plans.evidence import FIELDS, Run, event_rules
from factloom.sources import rules as rule_files
from factloom.sources import tables

LABEL = "obs_id string, key_type string, key string, value string, status string, label_basis string, labeled_by string"


def test_apply_settles_all_rows_of_a_label_at_once(spark):
    old = spark.createDataFrame([("a", "field", "tier", "gold", "proposed", "payload_inference", "x"), ("b", "field", "tier", "gold", "adjudicated", "asset_inventory", "x"), ("c", "link_basis", "same_device", "d", "proposed", "payload_inference", "x")], LABEL)
    new = spark.createDataFrame([("a", "field", "tier", "gold", "adjudicated", "vendor_doc", "y"), ("b", "field", "tier", "gold", "adjudicated", "asset_inventory", "y"), ("c", "link_basis", "same_device", "e", "adjudicated", "vendor_doc", "y"), ("f", "field", "tier", "gold", "adjudicated", "vendor_doc", "y"), ("f", "field", "tier", "silver", "adjudicated", "vendor_doc", "z")], LABEL)
    found = {(r.obs_id, r.value): (r.status, r.change, r.refused) for r in lifecycle.apply_adjudicated(old, new).collect()}
    assert found == {("a", "gold"): ("adjudicated", "provenance_upgraded", None), ("b", "gold"): ("agreed", "corroborated", None), ("c", "d"): ("proposed", None, None), ("c", "e"): ("adjudicated", "added", None), ("f", None): (None, None, "disputed")}
    again = {r.refused for r in lifecycle.apply_adjudicated(old, old.filter("obs_id = 'a'")).collect()}
    assert again == {None, "not superseded"}


def test_bumps_and_guards(spark):
    changes = spark.createDataFrame([("corroborated",), ("added",)], "change string")
    assert lifecycle.propose_bump(changes) == "minor" and lifecycle.propose_bump(changes.limit(0)) is None
    assert [rule_files.bumped("1.2.3", b) for b in ("major", "minor", "patch")] == ["2.0.0", "1.3.0", "1.2.4"]
    wide = spark.createDataFrame([("a", "gold")], "obs_id string, teir string")
    with pytest.raises(lifecycle.LabelError, match="teir"):
        lifecycle.check_import(wide, FIELDS)
    same = spark.createDataFrame([("a", "tier", True, "gold")], "obs_id string, key string, correct boolean, actual string")
    with pytest.raises(evaluate.LabelsMoved):
        evaluate.four_buckets(same, same, "one", "two")
    with pytest.raises(evaluate.LabelsMoved):
        evaluate.two_pass(same, None, same, "one", "two")
    buckets = evaluate.two_pass(same, same, same, "one", "one")
    assert [(r.bucket, r.delta) for r in buckets.collect()] == [("stable_correct", "rules")]
    assert evaluate.propose_bump(buckets, {"a"}, {"a"}, {"x"}, {"x", "y"}) == "minor" and evaluate.propose_bump(buckets, {"a"}, {"a"}, {"x"}, {"x"}) == "patch"
    assert evaluate.propose_bump(buckets, {"a"}, {"a", "b"}, set(), set()) == "major"


def test_a_hole_in_the_trace_is_named(spark):
    run = Run(spark, "/root/testdata/sf0.001")
    whole = run.trace
    assert replay.differences(whole, run.claims, run.membership, run.resolved, run.rollups).isEmpty()
    lost = whole.filter("op = 'assign_entity'").orderBy("step_id").first()
    first = whole.filter("op = 'extract'").orderBy("step_id").first()
    holed = whole.filter(~whole["step_id"].isin(lost.step_id, first.step_id))
    problems = {(r.part, r.problem.split(" ")[0]) for r in replay.differences(holed, run.claims, run.membership, run.resolved, run.rollups).collect()}
    assert ("membership", "not") in problems and any(part == "trace" for part, _ in problems)
    body = json.loads(lost.body)
    assert body["op"] == "assign_entity" and body["step_id"] == lost.step_id and body["parents"] == lost.parents


def test_claims_come_from_their_own_part_of_the_trace(spark):
    run = Run(spark, "/root/testdata/sf0.001")
    steps = run.steps("extraction", "claims")
    assert set(run._parts) == {"extraction", "claims"}  # no pair of observations was made
    assert not {r.op for r in steps.select("op").distinct().collect()} & {"merge", "merge_redundant", "resolve_field"}
    again = replay.claims(steps.unionByName(steps)).select("obs_id", "key", "value", "weight")
    want = run.claims.select("obs_id", "key", "value", "weight")
    assert again.count() == want.count() and again.exceptAll(want).isEmpty()


def test_bodies_are_canonical_json(spark):
    from pyspark.sql import functions as F

    texts = ["plain", 'q"\\/', "é𝔘", "\x7f\x01\t\n", "1E5", None]
    numbers = [0.7, 1e-5, 0.00012, 1 / 3, 123456789.5, -0.0, None]
    rows = spark.createDataFrame([(t, n, [t]) for t in texts for n in numbers], "t string, n double, l array<string>")
    made = trace.step(rows, "score", "r", F.array("t"), F.col("n"), F.col("l"), key=F.col("t"), value=F.col("n"), detail=F.struct("l", "n"), zeta=F.col("t")).collect()
    for r in made:
        body = {"op": "score", "rule_id": "r", "inputs": [r.t], "output": r.n, "parents": r.parents, "key": r.t, "value": r.n, "detail": {"l": r.l, "n": r.n}, "zeta": r.t}
        assert r.step_id == "sha256:" + hashlib.sha256(trace.canonical_json(body).encode()).hexdigest() and r.op == "score" and r.parents == r.l
        assert r.body == trace.canonical_json({"step_id": r.step_id, **body})
    run = Run(spark, "/root/testdata/sf0.001")
    assert all(s.body == trace.canonical_json(json.loads(s.body)) for s in run.trace.select("body").collect())


def test_a_part_makes_only_what_it_comes_from(spark):
    run = Run(spark, "/root/testdata/sf0.001")
    assert not run.steps("entities").isEmpty()
    assert set(run._halves) == {"link_basis"}  # no field is read or scored
    found = {(r.kind, r.n) for r in run._halves["link_basis"].scored.groupBy("kind").agg({"obs_id": "count"}).toDF("kind", "n").collect()}
    assert found == {("link_basis", run.claims.filter("kind = 'link_basis'").count())}
    # components stream through tasks, none is a pandas frame of its own
    plan = entity.merge_forest(entity.pair_edges(run.claims, run.rules), run.rules)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInArrow" in plan


def test_a_trace_without_bodies_has_the_same_steps(spark):
    lean, whole = Run(spark, "/root/testdata/sf0.001", bodies=False), Run(spark, "/root/testdata/sf0.001")
    kept = lean.kept_steps()
    assert kept.columns == ["step_id", "op", "parents"]
    assert all(hasattr(t, "written_path") and "body" not in t.columns for p in lean._parts.values() for t in p)
    ids = lambda df: {(r.step_id, r.op, *r.parents) for r in df.select("step_id", "op", "parents").collect()}
    assert ids(kept) == ids(whole.steps())
    assert replay.orphans(kept).isEmpty()


def test_small_graphs_are_settled_in_one_task(spark, monkeypatch):
    from pyspark.sql import functions as F

    from factloom.operators import graph

    edges = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(90) if i % 10] + [("n000", "n050")], "a string, b string")
    pairs = edges.select(*(F.struct(F.lit("k").alias("key"), F.col(c).alias("obs_id")).alias(c) for c in ("a", "b")))
    found = [{tuple(r) for r in graph.connected_components(e).collect()} for e in (edges, pairs)]
    rounds = []
    monkeypatch.setattr(graph, "_settled", lambda e, settled=graph._settled: rounds.append(e.count()) or settled(e))
    monkeypatch.setattr(graph, "TASK_EDGES", 5)
    assert found == [{tuple(r) for r in graph.connected_components(e).collect()} for e in (edges, pairs)]
    assert rounds and max(rounds) <= 5 and ("n050", "n000") in found[0] and len(found[0]) == 91


def test_files_are_read(spark, tmp_path):
    import yaml

    rules = event_rules()
    for name in rule_files.FILES:
        (tmp_path / f"{name}.yaml").write_text(yaml.safe_dump(getattr(rules, name)))
    words = sorted(rules.vocab["tier"])
    (tmp_path / "canonical_vocab.csv").write_text("tier,role\n" + "\n".join(f"{a},{b}" for a, b in zip(words, sorted(rules.vocab["role"]), strict=True)))
    (tmp_path / "VERSION").write_text("0.3.0\n")
    state = tmp_path / "state.json"
    first = rule_files.load_rules(tmp_path, {"click"}, state)
    assert first.version == "0.3.0" and first.vocab == rules.vocab and first.version_verified
    hashed = first.rollup
    (tmp_path / "claims.yaml").write_text((tmp_path / "claims.yaml").read_text().replace("\n", "\r\n"))
    assert rule_files.load_rules(tmp_path, None, state).rollup == hashed
    (tmp_path / "claims.yaml").write_text((tmp_path / "claims.yaml").read_text() + "# more\n")
    assert rule_files.load_rules(tmp_path, None, state).version_verified is False
    with pytest.raises(rule_files.RuleError, match="signup"):
        rule_files.load_rules(tmp_path, {"signup"})
    (tmp_path / "o.csv").write_text('obs_id,source,raw_payload,mac,hostname,open_ports,ip_address,site\n1,click,"a ""b"", c",,,"80, 443",,x\n')
    row = tables.read_observations(spark, str(tmp_path / "o.csv")).first()
    assert (row.raw_payload, row.mac, row.open_ports) == ('a "b", c', "", "80, 443")
    (tmp_path / "t.jsonl").write_text('{"a": 1}\n\n{"a": \n{"a": 2}\n')
    lines = {r.line: (r.a, r._corrupt_record is not None) for r in tables.read_jsonl(spark, str(tmp_path / "t.jsonl"), "a int").collect()}
    assert lines == {1: (1, False), 3: (None, True), 4: (2, False)}
    assert tables.fields_of(["tier", "tier_confidence", "stability"]) == ["tier"]
