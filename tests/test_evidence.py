"""Evidence queries against DuckDB on the smallest tables, and published cases of the scoring rules."""

import glob
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.operators import entity, evaluate, extract, fields
from factloom.operators.graph import connected_components
from factloom.plans.evidence import QUERIES, event_rules
from factloom.plans.evidence_sql import SQL
from factloom.sources.rules import RuleError, RuleSet

DATA = "/root/testdata/sf0.001"
COEFF = {"b": 0.3, "r": 0.5, "conflict_penalty_per_group": 0.1, "max_conflict_penalty": 0.4}


def rows(columns, data):
    order = sorted(columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[columns.index(c)] for c in order)) for r in data), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    want, got = con.sql(SQL[name]), QUERIES[name](spark, DATA)
    assert sorted(want.columns) == sorted(got.columns)
    assert rows(want.columns, want.fetchall()) == rows(got.columns, [tuple(r) for r in got.collect()])


@pytest.mark.parametrize(
    ("groups", "against", "expected"),
    [(["a", "b"], [], 1.0), (["low"], [], 0.25), (["a"], ["b"], 0.75), (["half"], ["a", "b"], 0.3), ([], [], 0.0), (["new"], [], 0.0)],
)
def test_score(spark, groups, against, expected):
    row = spark.createDataFrame([(groups, against)], "g array<string>, c array<string>")
    weights = {"a": 0.85, "b": 0.7, "low": 0.25, "half": 0.5}
    assert row.select(expr.score(F.col("g"), F.col("c"), weights, COEFF)).first()[0] == expected


def test_bonus_saturates(spark):
    got = spark.range(1, 5).select(F.round(expr.independence_bonus(F.col("id"), 0.3, 0.5), 4)).collect()
    assert [r[0] for r in got] == [0.0, 0.15, 0.225, 0.2625]


@pytest.mark.parametrize("pattern", [r"k=(?P<v>\w+)", r"(a|b)+=\s*(?P<v>[^;]+);", r"(?P<v>\d+(\.\d+)?)x", r"^(?P<v>[^\]]+)\]"])
def test_spans_equal_python(spark, pattern):
    texts = ["k=été; k=b", "ab=  x y ;", "zz 12.5x 7x", "a]b]", "", "𝔘 k=v", None]
    v, s, e = expr.first_match(F.col("t"), pattern)
    got = [tuple(r) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(v, s, e).collect()]

    def python(t):
        m = re.search(pattern, t) if t is not None else None
        if not m:
            return (None, None, None)
        start = m.start("v") + len(m.group("v")) - len(m.group("v").lstrip())
        return (m.group("v").strip(), start, start + len(m.group("v").strip()))

    assert got == [python(t) for t in texts]


def test_nested_group_falls_back(spark):
    with pytest.raises(expr.UnsupportedPattern):
        expr.split_pattern(r"(x(?P<v>\d))?")
    base = event_rules()
    rules = RuleSet(**{n: getattr(base, n) for n in ("normalization", "claims", "scoring", "entity_resolution", "field_resolution", "vocab")}, extraction={"rules": {"r": {"sources": ["click"], "pattern": r"(a(?P<v>\d+)|b)", "target_kind": "field", "target": "item"}}})
    obs = spark.createDataFrame([("1", "click", "zza12"), ("2", "click", "b"), ("3", "view", "a1"), ("4", "click", None)], "obs_id string, source string, raw_payload string").withColumns({c: F.lit("") for c in ("mac", "open_ports")})
    assert [tuple(r) for r in extract.extract(obs, rules).select("obs_id", "value", "start", "end").collect()] == [("1", "12", 3, 5)]


def test_entity_id_and_components(spark):
    ids = spark.createDataFrame([(["OBS-003", "OBS-001", "OBS-002"],)], "m array<string>")
    assert ids.select(expr.entity_id(F.col("m"))).first()[0] == "E-dccf99f031f3"
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (None, 5)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert connected_components(edges.limit(0)).count() == 0


def test_threshold_and_contradiction(spark):
    rules = event_rules()
    claim = "obs_id string, kind string, key string, value string, weight double, witness_groups array<string>, sources array<string>, in_vocab boolean"
    g = ["structured_column"]
    cells = [("a", "mac", "M"), ("b", "mac", "M"), ("b", "hostname_token", "H"), ("c", "hostname_token", "H")]
    claims = spark.createDataFrame([(o, "link_basis", k, v, 0.8, g, [], True) for o, k, v in cells] + [(o, "link_basis", "serial", "S", 0.3, g, [], True) for o in "cd"], claim)
    obs = spark.createDataFrame([(o,) for o in "abcde"], "obs_id string")
    got = {r.obs_id: r for r in entity.membership(obs, claims, rules).collect()}
    assert len({got[o].entity_id for o in "abc"}) == 1 and len({r.entity_id for r in got.values()}) == 3
    assert got["b"].conflict_detail == "cross_basis_conflict: mac->a,hostname_token->b; precedence_winner=mac" and got["a"].basis_agreement
    assert (got["d"].link_basis, got["d"].link_weight) == ("serial", 0.3) and got["e"].link_basis == "none"
    forest = entity.merge_forest(entity.pair_edges(claims, rules), rules).collect()
    assert len(forest) == 2 and all(r.merges for r in forest)


def test_undecidable_and_propagated(spark):
    rules = event_rules()
    claim = "obs_id string, kind string, key string, value string, weight double, witness_groups array<string>, sources array<string>, in_vocab boolean"
    claims = spark.createDataFrame([("a", "field", "amount", "1", 0.7, ["view"], [], True), ("b", "field", "amount", "2", 0.85, ["purchase"], [], True), ("a", "field", "item", "7", 1.0, ["view", "purchase"], [], True), ("b", "field", "tier", "9", 0.85, ["purchase"], [], False)], claim)
    members = spark.createDataFrame([("a", "E", 0.9), ("b", "E", 0.9)], "obs_id string, entity_id string, link_weight double")
    resolved = fields.resolve(claims, members, rules)
    whole = {r.field: (r.value, r.confidence) for r in resolved.collect()}
    assert whole == {"amount": ("undecidable", 0.0), "item": ("7", 1.0), "tier": ("Unknown", 0.0), "role": ("unknown", 0.0)}
    seen = {(r.obs_id, r.field): (r.value, r.confidence, r.provenance) for r in fields.observe(claims, members, resolved, rules).collect()}
    assert seen["a", "amount"] == ("1", 0.7, "direct") and seen["b", "item"] == ("7", 0.675, "propagated") and seen["b", "tier"] == ("Unknown", 0.0, "unknown")


def test_broken_rules_are_refused():
    r = event_rules()
    parts = {n: getattr(r, n) for n in ("extraction", "normalization", "claims", "scoring", "entity_resolution", "field_resolution", "vocab")}
    with pytest.raises(RuleError, match="no base weight for oui"):
        RuleSet(**parts | {"scoring": r.scoring | {"base_weights": {k: v for k, v in r.scoring["base_weights"].items() if k != "oui"}}})
    with pytest.raises(RuleError, match="unknown basis"):
        RuleSet(**parts | {"entity_resolution": r.entity_resolution | {"basis_precedence": ["imei"]}})
    assert r.content_hash() != event_rules(user_tier=False).content_hash()


def test_four_buckets(spark):
    s = "obs_id string, key string, correct boolean"
    before = spark.createDataFrame([("1", "k", False), ("2", "k", True), ("3", "k", True), ("4", "k", False), ("5", "k", None)], s)
    after = spark.createDataFrame([("1", "k", True), ("2", "k", False), ("3", "k", True), ("4", "k", False), ("5", "k", True)], s)
    assert {r.obs_id: r.bucket for r in evaluate.four_buckets(before, after).collect()} == {"1": "fixed", "2": "broken", "3": "stable_correct", "4": "stable_incorrect"}


def test_stability_quadrants(spark):
    s = "correct boolean, field_confidence double, stability double"
    data = [(True, 0.7, 0.7), (False, 0.9, 0.9), (True, 0.9, 0.8), (False, 0.8, 0.69), (None, 0.9, 0.1), (True, 0.69, 0.1)]
    got = {r.quadrant: (r.value, r.n) for r in evaluate.stability_quadrants(spark.createDataFrame(data, s)).collect()}
    assert got == {"high_conf_high_stab": (0.666667, 3), "high_conf_low_stab": (0.0, 1)}
    assert {(r.value, r.n) for r in evaluate.stability_quadrants(spark.createDataFrame([], s)).collect()} == {(0.0, 0)}


def test_metrics_label_free(spark):
    rules = event_rules()
    claim = "obs_id string, kind string, key string, value string, weight double, witness_groups array<string>, conflicts array<string>, sources array<string>, in_vocab boolean"
    g, two = ["view"], ["view", "purchase"]
    claims = spark.createDataFrame(
        [("a", "field", "amount", "1", 0.7, g, ["purchase"], ["view"], True), ("b", "field", "amount", "2", 0.85, ["purchase"], [], ["purchase"], True), ("a", "field", "item", "7", 1.0, two, [], two, True)]
        + [("b", "field", "tier", "9", 0.85, ["purchase"], [], ["purchase"], False), ("c", "field", "tier", "9", 0.7, g, [], g, False), ("c", "field", "role", "tv", 0.7, g, [], g, False), ("a", "link_basis", "mac", "M", 0.8, g, [], g, True)],
        claim,
    )
    members = spark.createDataFrame([("a", "E", 0.9, "mac", True), ("b", "E", 0.9, "mac", False), ("c", "F", 0.0, "none", True)], "obs_id string, entity_id string, link_weight double, link_basis string, basis_agreement boolean")
    obs = spark.createDataFrame([("a", "view"), ("b", "purchase"), ("c", "view")], "obs_id string, source string")
    resolved = fields.resolve(claims, members, rules)
    found = evaluate.metrics(obs, claims.select("obs_id"), claims, members, resolved, fields.observe(claims, members, resolved, rules), fields.rollup(resolved, rules), rules).collect()
    got = {(r.metric, r.scope): (r.value, r.n) for r in found}
    assert len(got) == len(found)
    expected = {
        ("vocab_reject_frequency", "value:9"): (2.0, 3), ("vocab_reject_frequency", "value:tv"): (1.0, 3),
        ("propagation_depth_distribution", "hop:1"): (1.0, 1),
        ("confidence_distribution", "field:item:bucket:0.9"): (0.5, 2), ("confidence_distribution", "field:item:bucket:0.0"): (0.5, 2),
        ("confidence_distribution", "field:tier:bucket:0.0"): (1.0, 2), ("confidence_distribution", "field:role:bucket:0.0"): (1.0, 2), ("confidence_distribution", "field:amount:bucket:0.0"): (1.0, 2),
        ("confidence_distribution", "global:bucket:0.9"): (0.5, 2), ("confidence_distribution", "global:bucket:0.0"): (0.5, 2),
        ("field_fill_rate", "field:item"): (0.5, 2), ("field_fill_rate", "field:item:direct"): (0.333333, 3), ("field_fill_rate", "field:item:propagated"): (0.333333, 3),
        ("known_rate", "field:tier"): (0.0, 2), ("vocab_gap_rate", "field:tier"): (1.0, 2), ("vocab_gap_rate", "field:role"): (0.5, 2),
        ("entity_corroboration_rate", "field:item"): (1.0, 1), ("entity_corroboration_rate", "field:tier"): (0.0, 0),
        ("claims_per_obs", "field:amount"): (0.666667, 3), ("corroboration_rate", "field:item"): (1.0, 1), ("conflict_rate", "field:amount"): (0.5, 2),
        ("source_win_rate", "source:view"): (0.5, 2), ("source_win_rate", "source:purchase"): (0.5, 2),
        ("entity_count", "global"): (2.0, 2), ("singleton_rate", "global"): (0.5, 2), ("link_basis_distribution", "link_basis:mac"): (0.666667, 3), ("link_basis_distribution", "link_basis:none"): (0.333333, 3),
        ("basis_agreement_rate", "global"): (0.666667, 3), ("cross_basis_conflict_rate", "global"): (0.333333, 3), ("no_extraction_rate", "global"): (0.0, 3), ("no_identity_claim_rate", "global"): (0.666667, 3),
    }
    assert {k: got.get(k) for k in expected} == expected
    for metric in ("confidence_distribution", "stability_distribution", "link_basis_distribution"):
        assert sum(v for (m, scope), (v, _) in got.items() if m == metric and not scope.startswith("field:")) == pytest.approx(1, abs=1e-5)
