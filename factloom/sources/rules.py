"""Rules as data: six YAML files and a vocabulary become one RuleSet, checked before anything runs."""

from __future__ import annotations

import csv
import hashlib
import json
import re
from dataclasses import dataclass, field, replace
from pathlib import Path

FILES = ("extraction", "normalization", "claims", "scoring", "entity_resolution", "field_resolution")
COEFFICIENTS = ("field_claims", "identity_claims", "entity_corroboration")


class RuleError(ValueError):
    """A rule set that contradicts itself."""


@dataclass(frozen=True)
class RuleSet:
    extraction: dict
    normalization: dict
    claims: dict
    scoring: dict
    entity_resolution: dict
    field_resolution: dict
    vocab: dict[str, set[str]] = field(default_factory=dict)
    version: str = "0.0.0"
    file_hashes: dict[str, str] = field(default_factory=dict)
    version_verified: bool | None = None

    def __post_init__(self):
        problems = list(_problems(self))
        if problems:
            raise RuleError("; ".join(problems))

    @property
    def fields(self) -> list[str]:
        return list(self.claims["fields"])

    @property
    def closed(self) -> dict[str, dict]:
        return self.claims.get("closed_vocabulary_fields", {})

    @property
    def precedence(self) -> list[str]:
        return list(self.entity_resolution["basis_precedence"])

    @property
    def aliases(self) -> dict[str, dict[str, str]]:
        """Alias tables by target; in files they are blocks named ``<target>_alias`` with a ``map``."""
        n = self.normalization
        return n.get("aliases") or {b.removesuffix("_alias"): c.get("map") or {} for b, c in n.items() if b.endswith("_alias")}

    @property
    def rebrand(self) -> dict[str, dict[str, str]]:
        """Second hops by target; the block ``oem_rebrand`` of files is that of the vendor."""
        n = self.normalization
        return n.get("rebrand") or ({"vendor": n["oem_rebrand"].get("map") or {}} if "oem_rebrand" in n else {})

    def suffix(self, block: str) -> str:
        """The name of a normalisation in rule ids."""
        return (self.normalization.get(block) or {}).get("rule_id_suffix", block)

    def words(self, name: str) -> set[str]:
        return self.vocab.get(self.closed[name]["vocab_column"], set())

    def absent(self) -> set[str]:
        return {"", *(c["escape"] for c in self.closed.values())}

    def source_groups(self) -> dict[str, str]:
        return {s: c["witness_group"] for s, c in self.claims["sources"].items()}

    @property
    def rollup(self) -> str:
        """One hash of all rule files: of the JSON list of their hashes in the order of the file names."""
        hashes = self.file_hashes or {n: _sha256(json.dumps(getattr(self, n), sort_keys=True, default=str).encode()) for n in FILES}
        return _sha256(json.dumps([hashes[k] for k in sorted(hashes)], separators=(",", ":")).encode())

    def content_hash(self) -> str:
        return self.rollup


def _sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def file_hash(path: str | Path) -> str:
    """Hash of a file's bytes as they are."""
    return _sha256(Path(path).read_bytes())


def canonical_file_hash(path: str | Path) -> str:
    """Hash of a text file that line ends and blank lines at its ends do not change."""
    return _sha256((Path(path).read_text(encoding="utf-8").replace("\r\n", "\n").strip() + "\n").encode())


def _problems(r: RuleSet):
    keys = {"field": set(r.claims["fields"]), "link_basis": set(r.claims["link_bases"])}
    for name, rule in r.extraction.get("rules", {}).items():
        if rule["target"] not in keys.get(rule["target_kind"], ()):
            yield f"rule {name}: unknown target {rule['target']}"
        yield from (f"rule {name}: unknown source {s}" for s in rule["sources"] if s not in r.claims["sources"])
        if "v" not in re.compile(rule["pattern"]).groupindex:
            yield f"rule {name}: no group v"
    for name, rule in r.extraction.get("structured", {}).items():
        if rule["target"] not in keys.get(rule["target_kind"], ()):
            yield f"lift {name}: unknown target {rule['target']}"
    yield from (f"precedence names unknown basis {b}" for b in r.precedence if b not in keys["link_basis"])
    groups = {*r.source_groups().values(), "structured_column", "oui", "port_signature"}
    yield from (f"no base weight for {g}" for g in sorted(groups - set(r.scoring["base_weights"])))
    yield from (f"coefficients {c} are missing" for c in COEFFICIENTS if c not in r.scoring)
    yield from (f"policy for unknown field {f}" for f in r.field_resolution.get("conflict_policy", {}).get("per_field", {}) if f not in keys["field"])
    out = r.field_resolution["final_output"]
    if set(out["columns"]) != keys["field"]:
        yield "final_output must name every field"
    yield from (f"direct_only names unknown field {f}" for f in out.get("direct_only", ()) if f not in keys["field"])
    if not out["confidence_bands"]["high"] >= out["confidence_bands"]["medium"]:
        yield "confidence bands are out of order"
    for name, column in r.closed.items():
        words = r.vocab.get(column["vocab_column"], set())
        if words and column["escape"] not in words:
            yield f"escape {column['escape']} of {name} is no word of the vocabulary"
        hops = r.rebrand.get(name, {})
        yield from (f"alias {k} of {name} leads to {v}, no word of the vocabulary" for k, v in r.aliases.get(name, {}).items() if words and hops.get(v.lower(), v) not in words)
    oui = r.extraction.get("oui", {})
    target = oui.get("target", r.fields[0])
    if target in r.closed and r.words(target):
        known = r.words(target)
        yield from (f"prefix {k} names {v}, no word of the vocabulary" for k, v in oui.get("map", {}).items() if v not in known)
    if r.entity_resolution.get("cross_basis_conflict", {}).get("policy", "precedence_wins") != "precedence_wins":
        yield "only the policy precedence_wins is supported"


def load_vocab(path: str | Path) -> dict[str, set[str]]:
    """Independent columns, padded to equal length: blanks are no words."""
    words: dict[str, set[str]] = {}
    with open(path, newline="", encoding="utf-8") as f:
        for row in csv.DictReader(f):
            for column, value in row.items():
                if (value or "").strip():
                    words.setdefault(column, set()).add(value.strip())
    return words


def load_rules(folder: str | Path, observed_sources: set[str] | None = None, state_path: str | Path | None = None) -> RuleSet:
    """The rules of a folder. ``observed_sources`` must all be mapped; ``state_path`` keeps the last hash, which polices the version."""
    import yaml

    folder = Path(folder)
    parts = {n: yaml.safe_load((folder / f"{n}.yaml").read_text(encoding="utf-8")) or {} for n in FILES}
    hashes = {f.name: canonical_file_hash(f) for f in [*(folder / f"{n}.yaml" for n in FILES), folder / "canonical_vocab.csv"]}
    version = folder / "VERSION"
    rules = RuleSet(**parts, vocab=load_vocab(folder / "canonical_vocab.csv"), version=version.read_text().strip() if version.exists() else "0.0.0", file_hashes=hashes)
    unmapped = sorted((observed_sources or set()) - set(rules.claims["sources"]))
    if unmapped:
        raise RuleError("; ".join(f"observed source {s} is not mapped" for s in unmapped))
    if state_path is None:
        return rules
    state = Path(state_path)
    known = json.loads(state.read_text(encoding="utf-8")) if state.exists() else None
    state.write_text(json.dumps({"rollup": rules.rollup, "version": rules.version}), encoding="utf-8")
    return replace(rules, version_verified=known is None or known["rollup"] == rules.rollup or known["version"] != rules.version)


def bumped(version: str, bump: str) -> str:
    """The next version: a bump of a part sets those after it to 0."""
    parts = [int(x) for x in version.split(".")]
    at = ("major", "minor", "patch").index(bump)
    return ".".join(str(x) for x in [*parts[:at], parts[at] + 1, *([0] * (2 - at))])
