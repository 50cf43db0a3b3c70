"""Proposals for rules: what is wrong with them, what they would cover, and how they enter a rule folder. Who proposes is not known here."""

from __future__ import annotations

import re
import shutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import expr
from factloom.operators.extract import _nested
from factloom.sources.rules import FILES, RuleSet, bumped, load_rules

NAME = re.compile(r"[a-z][a-z0-9_]*")


def _matches(backlog: DataFrame, pattern: str) -> DataFrame:
    payload = F.coalesce("raw_payload", F.lit(""))
    try:
        value = expr.first_match(payload, pattern)[0]
    except expr.UnsupportedPattern:
        value = _nested(pattern)(payload)["value"]
    return backlog.withColumn("found", value).filter("found is not null")


def rule_faults(rule: dict, rules: RuleSet, backlog: DataFrame, taken: set[str] = frozenset()) -> list[str]:
    """Why a proposed rule (name, source, pattern, target_kind, target, tests) may not be taken; empty if it may.

    ``backlog``: obs_id, source and raw_payload of what no rule reads; a rule must match one of its source, if there are any.
    """
    name, source, target = rule.get("name", ""), rule.get("source"), rule.get("target")
    targets = rules.claims["fields"] if rule.get("target_kind") == "field" else rules.claims["link_bases"]
    checks = {
        f"name {name!r} is not in snake case": NAME.fullmatch(name),
        f"name {name!r} is taken": name not in taken and name not in rules.extraction.get("rules", {}),
        f"source {source!r} is not declared": source in rules.claims["sources"],
        f"target {target!r} is not declared": target in targets,
        "it brings no tests": rule.get("tests"),
    }
    faults = [text for text, fine in checks.items() if not fine]
    try:
        pattern = re.compile(rule.get("pattern", ""))
    except re.error as e:
        return [*faults, f"the pattern does not compile: {e}"]
    if "v" not in pattern.groupindex:
        return [*faults, "the pattern has no group v"]
    for test in rule.get("tests") or ():
        hit = pattern.search(test["payload"])
        got = (hit["v"] or "").strip() if hit else None
        if got != test["expect"].strip():
            faults.append(f"test {test['payload']!r} gives {got!r}")
    mine = backlog.filter(F.col("source") == source)
    if not mine.isEmpty() and _matches(mine, rule["pattern"]).isEmpty():
        faults.append("it matches nothing of the backlog")
    return faults


def coverage(proposed: dict[str, dict], backlog: DataFrame) -> DataFrame:
    """name and n: how many rows of the backlog each proposed rule reads."""
    hits = [_matches(backlog.filter(F.col("source").isin(list(r["sources"]))), r["pattern"]).select(F.lit(n).alias("name")) for n, r in proposed.items()]
    out = backlog.select(F.lit("").alias("name")).limit(0)
    for h in hits:
        out = out.unionByName(h)
    return out.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def blocks(rules: RuleSet) -> dict[str, str]:
    """The field that each alias block of the rules normalises."""
    own = {f"{f}_alias": f for f in rules.closed}
    return own | ({"oem_rebrand": "vendor"} if "vendor" in rules.closed else {})


def key_of(text: str) -> str:
    return " ".join(text.split()).lower()


def alias_faults(alias: dict, rules: RuleSet, queue: DataFrame, taken: set[tuple[str, str]] = frozenset()) -> list[str]:
    """Why a proposed alias (block, surface, target) may not be taken. ``queue``: the rejected values (key, value)."""
    block, surface, target = (alias.get(k, "") for k in ("block", "surface", "target"))
    field = blocks(rules).get(block)
    if field is None:
        return [f"unknown block {block!r}"]
    table = rules.rebrand.get(field, {}) if block == "oem_rebrand" else rules.aliases.get(field, {})
    seen = queue.filter((F.col("key") == field) & (expr.surface_key(F.col("value")) == key_of(surface)))
    checks = {
        f"surface {surface!r} is no lookup key": surface == key_of(surface),
        f"surface {surface!r} is mapped already": surface not in table,
        f"surface {surface!r} is proposed twice": (block, surface) not in taken,
        f"target {target!r} is no word of {field}": target in rules.words(field),
        f"surface {surface!r} was never rejected": not seen.isEmpty(),
    }
    return [text for text, fine in checks.items() if not fine]


def _merge(folder: Path, extraction: dict[str, dict], aliases: dict[str, dict[str, str]]) -> None:
    import yaml

    for name, more in (("extraction", {"rules": extraction}), ("normalization", {b: {"map": m} for b, m in aliases.items()})):
        path = folder / f"{name}.yaml"
        parts = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
        for block, entries in more.items():
            if name == "extraction":
                parts.setdefault(block, {}).update(entries)
            else:
                parts.setdefault(block, {}).setdefault("map", {}).update(entries["map"])
        path.write_text(yaml.safe_dump(parts, sort_keys=True), encoding="utf-8")


def candidate(folder: str | Path, rules_folder: str | Path, extraction: dict[str, dict] | None = None, aliases: dict[str, dict[str, str]] | None = None) -> RuleSet:
    """A copy of a rule folder with proposals merged in, to be evaluated; the live folder stays as it is."""
    folder, live = Path(folder), Path(rules_folder)
    folder.mkdir(parents=True, exist_ok=True)
    for name in (*(f"{f}.yaml" for f in FILES), "canonical_vocab.csv", "VERSION"):
        shutil.copy(live / name, folder / name)
    _merge(folder, extraction or {}, aliases or {})
    return load_rules(folder)


def accept(rules_folder: str | Path, scratch: str | Path, extraction: dict[str, dict] | None = None, aliases: dict[str, dict[str, str]] | None = None) -> str:
    """Merges proposals into a live folder, as a minor version, once a copy of it has loaded with them. Returns the version."""
    live = Path(rules_folder)
    if not extraction and not aliases:
        return load_rules(live).version
    version = bumped(candidate(scratch, live, extraction, aliases).version, "minor")
    _merge(live, extraction or {}, aliases or {})
    (live / "VERSION").write_text(version + "\n", encoding="utf-8")
    return load_rules(live).version


def verdict(buckets: DataFrame) -> tuple[bool, dict[str, int]]:
    """Whether a candidate fixes something and breaks nothing, and the counts of ``four_buckets``."""
    counts = dict.fromkeys(("fixed", "broken", "stable_correct", "stable_incorrect"), 0) | {r.bucket: r["count"] for r in buckets.groupBy("bucket").count().collect()}
    return counts["fixed"] > 0 and not counts["broken"], counts
