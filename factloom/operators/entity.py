"""Entity resolution: components of identity claims that share a value, without a pair table.

Every accepted edge unites its ends, so the partition is the components of the claims at or over the threshold, whatever
the order. Each observation is tied to the smallest one that holds the same (basis, value): edges grow with the claims
and not with the square of a bucket. ``pair_edges`` makes the pairs, for traces of small inputs only.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.functions.storage import written
from factloom.operators.graph import connected_components
from factloom.sources.rules import RuleSet


def identity(claims: DataFrame, rules: RuleSet) -> DataFrame:
    return claims.filter((F.col("kind") == "link_basis") & F.col("key").isin(rules.precedence))


def qualified(claims: DataFrame, rules: RuleSet) -> DataFrame:
    """Identity claims that may link: an edge's weight is the lesser of its ends', so both must reach the threshold."""
    return identity(claims, rules).filter(F.col("weight") >= float(rules.entity_resolution["link_weight_threshold"])).select("obs_id", "key", "value", "weight")


def buckets(claims: DataFrame, rules: RuleSet) -> DataFrame:
    """key, value, hub (smallest obs_id) and n of the values that at least two observations share."""
    return qualified(claims, rules).groupBy("key", "value").agg(F.min("obs_id").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def hub_edges(claims: DataFrame, rules: RuleSet) -> DataFrame:
    return qualified(claims, rules).join(buckets(claims, rules), ["key", "value"]).filter("obs_id <> hub").select("key", F.col("hub").alias("a"), F.col("obs_id").alias("b"))


def pair_edges(claims: DataFrame, rules: RuleSet, more: list[str] | None = None) -> DataFrame:
    """Every pair that shares a (basis, value), accepted or refused. Grows with the square of a bucket: for traces.

    The columns ``more`` of both claims go along, as a_* and b_*.
    """
    c, more = identity(claims, rules), more or []
    a, b = (c.select("key", "value", F.col("obs_id").alias(x), F.col("weight").alias(f"w{x}"), *(F.col(m).alias(f"{x}_{m}") for m in more)) for x in ("a", "b"))
    t = float(rules.entity_resolution["link_weight_threshold"])
    return a.join(b, ["key", "value"]).filter("a < b").select("a", "b", F.col("key").alias("basis"), "value", F.least("wa", "wb").alias("weight"), (F.least("wa", "wb") >= t).alias("accepted"), *(f"{x}_{m}" for x in ("a", "b") for m in more))


def merge_forest(edges: DataFrame, rules: RuleSet, parts: DataFrame | None = None) -> DataFrame:
    """Accepted pairs with ``merges``: whether the pair joined two parts, taken in the pinned order."""
    return ordered_forest(edges, rules, parts).drop("place")


def ordered_forest(edges: DataFrame, rules: RuleSet, parts: DataFrame | None = None, more: list[str] | None = None) -> DataFrame:
    """What ``merge_forest`` returns, with the place of a pair in the order of its component, and the columns ``more`` of ``edges``.

    A pair is judged inside its component (``parts`` has node and component, if they are known). A component's pairs stream
    through one task in their order: the task holds the component's nodes, not its pairs.
    """
    accepted = edges.filter("accepted")
    if parts is None:
        accepted = written(accepted, "accepted")
        parts = connected_components(accepted)
    rank = expr.lookup({b: n for n, b in enumerate(rules.precedence)}, F.col("basis"))
    kept = ["a", "b", "basis", "value", "weight", *(more or [])]
    placed = accepted.join(parts, accepted["a"] == parts["node"]).select("component", *kept, rank.alias("rank"))
    types = dict(placed.dtypes)

    def spanning(batches):
        part, root, place = None, {}, 0

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            merges = []
            for p, a, b in zip(*(batch.column(c).to_pylist() for c in ("component", "a", "b")), strict=True):
                if p != part:
                    part, root = p, {}
                x, y = sorted((find(a), find(b)))
                root[y] = x
                merges.append(x != y)
            places = pa.array(range(place, place + len(merges)), pa.int64())
            place += len(merges)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(merges, pa.bool_()), places], [*kept, "merges", "place"])

    order = ["component", F.col("weight").desc(), "rank", "a", "b", "basis", "value"]
    return placed.repartition("component").sortWithinPartitions(*order).mapInArrow(spanning, ", ".join(f"{c} {types[c]}" for c in kept) + ", merges boolean, place long")


def per_basis(claims: DataFrame, rules: RuleSet) -> DataFrame:
    """obs_id, key and part: an observation's component among the edges of one basis only; none where it is alone."""
    edges = hub_edges(claims, rules)
    node = lambda c: F.struct("key", F.col(c).alias("obs_id"))
    found = connected_components(edges.select(node("a").alias("a"), node("b").alias("b")))
    return found.select("node.obs_id", "node.key", F.col("component.obs_id").alias("part"))


def cross_basis(parts: DataFrame, rules: RuleSet) -> DataFrame:
    """obs_id and conflict_detail of the observations whose bases group them in ways that are not nested.

    Two components that share an observation are nested if the overlap has the size of one of them; sizes and overlaps are
    counted, the components are never gathered.
    """
    sizes = parts.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    sized = written(parts.join(sizes, ["key", "part"]), "parts")
    x = sized.select("obs_id", F.col("key").alias("k"), F.col("part").alias("p"), F.col("size").alias("s"))
    y = sized.select("obs_id", F.col("key").alias("k2"), F.col("part").alias("p2"), F.col("size").alias("s2"))
    both = x.join(y, "obs_id").filter("k <> k2")
    crossed = both.groupBy("k", "p", "k2", "p2").agg(F.count(F.lit(1)).alias("common"), F.first("s").alias("s"), F.first("s2").alias("s2")).filter("common < least(s, s2)").select("k", "p", "k2", "p2")
    rank = expr.lookup({b: n for n, b in enumerate(rules.precedence)}, F.col("k"))
    each = both.join(crossed, ["k", "p", "k2", "p2"], "left_semi").select("obs_id", rank.alias("rank"), "k", "p").distinct()
    listed = each.groupBy("obs_id").agg(F.array_sort(F.collect_list(F.struct("rank", "k", "p"))).alias("c"))
    text = F.concat(F.lit("cross_basis_conflict: "), F.array_join(F.transform("c", lambda v: F.concat(v["k"], F.lit("->"), v["p"])), ","), F.lit("; precedence_winner="), F.col("c")[0]["k"])
    return listed.select("obs_id", text.alias("conflict_detail"), F.array_distinct(F.transform("c", lambda v: v["k"])).alias("bases"))


def linking(claims: DataFrame, rules: RuleSet, *more: str) -> DataFrame:
    """obs_id, link_basis, link_weight, link_value and the columns ``more`` of the best claim that made an edge, else of the best own one."""
    shared = buckets(claims, rules).select("key", "value", F.lit(float(rules.entity_resolution["link_weight_threshold"])).alias("from_weight"))
    rank = expr.lookup({b: n for n, b in enumerate(rules.precedence)}, F.col("key"))
    alone = ~F.coalesce(F.col("weight") >= F.col("from_weight"), F.lit(False))
    rows = identity(claims, rules).select("obs_id", "key", "value", "weight", *more).join(shared, ["key", "value"], "left")
    best = rows.groupBy("obs_id").agg(F.min(F.struct(alone.alias("alone"), (-F.col("weight")).alias("w"), rank.alias("rank"), "value", "key", *more)).alias("x"))
    return best.select("obs_id", F.col("x.key").alias("link_basis"), (-F.col("x.w")).alias("link_weight"), F.col("x.value").alias("link_value"), *(f"x.{c}" for c in more))


def entities(observations: DataFrame, claims: DataFrame, rules: RuleSet) -> DataFrame:
    """obs_id and entity_id. The id hashes all members' sorted ids, which one task streams."""
    parts = connected_components(hub_edges(claims, rules))
    placed = observations.select("obs_id").distinct().join(parts, F.col("obs_id") == parts["node"], "left").select("obs_id", F.coalesce("component", "obs_id").alias("part"))
    scheme = rules.entity_resolution.get("entity_id", {})
    prefix, length = scheme.get("prefix", "E-"), scheme.get("hash_length", 12)

    def hashed(batches):
        """The hash of each part's ids, joined by |, while they stream in order: no part is gathered."""
        part, digest = None, None
        for batch in batches:
            parts, out = [], []
            for p, obs in zip(batch.column("part").to_pylist(), batch.column("obs_id").to_pylist(), strict=True):
                if p != part:
                    if digest is not None:
                        parts.append(part)
                        out.append(prefix + digest.hexdigest()[:length])
                    part, digest = p, hashlib.sha256(obs.encode())
                else:
                    digest.update(b"|" + obs.encode())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(out, pa.string())], ["part", "entity_id"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.string()), pa.array([prefix + digest.hexdigest()[:length]], pa.string())], ["part", "entity_id"])

    ids = placed.select("part", "obs_id").repartition("part").sortWithinPartitions("part", "obs_id").mapInArrow(hashed, "part string, entity_id string")
    return placed.join(ids, "part").select("obs_id", "entity_id")


def membership(observations: DataFrame, claims: DataFrame, rules: RuleSet, conflicts: DataFrame | None = None, parted: DataFrame | None = None, linked: DataFrame | None = None) -> DataFrame:
    """obs_id, entity_id, link_basis, link_weight, basis_agreement and conflict_detail.

    ``conflicts``, ``parted`` and ``linked`` are what ``cross_basis``, ``entities`` and ``linking`` return, if they are known.
    """
    if conflicts is None:
        conflicts = cross_basis(per_basis(claims, rules), rules)
    conflicts = conflicts.select("obs_id", "conflict_detail")
    rows = (entities(observations, claims, rules) if parted is None else parted).join(linking(claims, rules) if linked is None else linked, "obs_id", "left").join(conflicts, "obs_id", "left")
    return rows.select("obs_id", "entity_id", F.coalesce("link_basis", F.lit("none")).alias("link_basis"), F.coalesce("link_weight", F.lit(0.0)).alias("link_weight"), F.col("conflict_detail").isNull().alias("basis_agreement"), "conflict_detail")
