import hashlib
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from factloom.functions.storage import RELEASE, scratch, shared_folder, written
from factloom.operators import entity, replay, trace
from factloom.plans.evidence import QUERIES, Run

SF = "/root/testdata/sf0.001"
VALUES = ["plain text, E-mail and 1.25", "a/b \"q\" \\ tab\t", "line\nfeed", "bell \x07", "del \x7f", "ümlaut", "emoji \U0001f600", "\\u0041", "", "EV-0000001"]
NUMBERS = [0.5, 0.123456789012, 1e-7, 1.5e-5, 1e20, 12345678.9, 1e7, -0.00025, 3.0, 0.0]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_are_those_of_canonical_json(spark):
    rows = [(v, n) for v in VALUES for n in NUMBERS]
    made = trace.step(spark.createDataFrame(rows, "v string, n double"), "op", "rule", None, F.col("v"), weight=F.col("n"))
    for r in made.select("v", "n", "step_id", "body").collect():
        body = {"op": "op", "rule_id": "rule", "inputs": [], "output": r["v"], "parents": [], "weight": r["n"]}
        assert r["step_id"] == "sha256:" + hashlib.sha256(trace.canonical_json(body).encode()).hexdigest()
        assert json.loads(r["body"]) == body | {"step_id": r["step_id"]}


def test_odd_text_is_told_at_the_cost_of_its_hash(spark):
    """The look for odd characters once took over ten times what the hash of the same text takes."""
    text = F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 6), F.lit(',"op":"score","inputs":["obs:EV-1#mac"],"weight":0.85'))
    table = spark.range(0, 60_000, 1, 1).select(text.alias("t")).cache()
    table.count()

    def seconds(c):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            table.agg(F.count(F.when(c, 1))).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    assert seconds(trace.odd(F.col("t"))) < 4 * seconds(F.sha2("t", 256) != "") + 0.2
    table.unpersist()


def test_claims_meet_their_steps_without_a_join(spark):
    run = Run(spark, SF, bodies=False)
    run._ready()
    made = plan(trace.claims(trace.extraction_steps(run.observations, run.rules, "link_basis", run.keep)[2], run.rules))
    assert "Join" not in made
    assert made.count("Exchange") == 1


def test_the_best_identity_claim_is_found_once(spark):
    run = Run(spark, SF, bodies=False)
    run.assigned  # noqa: B018
    linked, identity = run._kept["linked-steps"], run.identity
    assert "linked" not in run._kept
    again = entity.linking(identity, run.rules)
    assert linked.drop("step_id").exceptAll(again).isEmpty() and again.exceptAll(linked.drop("step_id")).isEmpty()
    scored = run._half("link_basis").scored.select("obs_id", F.col("key").alias("link_basis"), F.col("value").alias("link_value"), "step_id")
    assert linked.select(scored.columns).exceptAll(scored).isEmpty()


def test_best_claim_is_one_that_made_an_edge(spark):
    run = Run(spark, SF)
    rows = [("a", "mac", "m1", 0.9), ("a", "serial", "s", 0.6), ("b", "serial", "s", 0.6), ("c", "mac", "m2", 0.3), ("d", "mac", "m2", 0.3), ("d", "serial", "x", 0.2)]
    claims = spark.createDataFrame([(o, "link_basis", k, v, w) for o, k, v, w in rows], "obs_id string, kind string, key string, value string, weight double")
    got = {r["obs_id"]: (r["link_basis"], r["link_value"], r["link_weight"]) for r in entity.linking(claims, run.rules).collect()}
    assert got == {"a": ("serial", "s", 0.6), "b": ("serial", "s", 0.6), "c": ("mac", "m2", 0.3), "d": ("mac", "m2", 0.3)}


def test_steps_are_counted_by_their_bytes(spark):
    ids = ["sha256:" + hashlib.sha256(x).hexdigest() for x in (b"a", b"b", b"c")]
    steps = spark.createDataFrame([(ids[0], "x"), (ids[0], "x"), (ids[1], "x"), (ids[2], "y")], "step_id string, op string")
    assert {(r["op"], r["n"]) for r in trace.counts(steps).collect()} == {("x", 2), ("y", 1)}


def tables(spark):
    return set(os.listdir(shared_folder(spark).removeprefix("file://")))


@pytest.mark.parametrize("name", ["replay_claims", "replay_differences", "trace_orphans"])
def test_no_trace_is_left_on_disk(spark, name):
    """Every table of the trace once stayed in the shared folder: over 40 times the input."""
    before = tables(spark)
    QUERIES[name](spark, SF)
    left = tables(spark) - before
    assert [t[: len("factloom-result-")] for t in left] == ["factloom-result-"]


def test_slices_hold_all_steps_and_their_parents(spark):
    size, parents = 250, []

    def steps(stages):
        assert stages.observations.count() < 2 * size
        made = stages.kept_steps()
        parents.append(replay.orphans(made).count())
        return made.select("step_id", "op")

    got = Run(spark, SF, bodies=False).sliced(steps, size=size).distinct()
    whole = Run(spark, SF, bodies=False).steps().select("step_id", "op").distinct()
    assert len(parents) > 2 and not any(parents)
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
    assert got.filter("op = 'merge_refused'").count() > 0


def test_slices_report_a_missing_parent(spark):
    def broken(stages):
        return replay.orphans(stages.steps("claims", "extraction").filter("op <> 'normalize'"))

    run = [Run(spark, SF, bodies=False).sliced(broken, entities, size) for entities, size in ((True, 250), (False, 250), (False, 10**6))]
    found = [r.select("step_id", "parent").distinct() for r in run]
    assert found[2].count() > 0
    assert all(f.exceptAll(found[2]).isEmpty() and found[2].exceptAll(f).isEmpty() for f in found[:2])


def test_claims_of_slices_are_those_of_the_whole(spark):
    def claims(stages):
        return replay.claims(stages.steps("extraction", "claims"))

    parts, whole = (Run(spark, SF).sliced(claims, False, size) for size in (250, 10**6))
    assert parts.exceptAll(whole).isEmpty() and whole.exceptAll(parts).isEmpty()


def test_scratch_is_deleted_and_settings_return(spark):
    before, release = tables(spark), spark.conf.get(RELEASE)
    with pytest.raises(ValueError), scratch(spark) as lasting:
        kept = lasting(spark.range(5), "kept")
        with scratch(spark):
            written(spark.range(3), "gone")
        written(spark.range(4), "gone")
        raise ValueError
    assert [t for t in tables(spark) - before] == [os.path.basename(kept.written_path)]
    assert kept.count() == 5 and spark.conf.get(RELEASE) == release
