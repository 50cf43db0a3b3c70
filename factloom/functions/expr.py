"""Column builders shared by the operators: text normalisers, the scoring formula, buckets and bands. All JVM-side."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flags under which Java reads a pattern as Python reads one for str: \n alone ends lines, classes know Unicode.
PYTHON_FLAGS = "(?dU)"


def strip(c: Column) -> Column:
    """All Unicode white space off both ends; ``trim`` takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def surface_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(strip(c), r"(?U)\s+", " "))


def normalize_mac(c: Column) -> Column:
    return F.upper(F.translate(c, ":-. ", ""))


def normalize_hostname(c: Column) -> Column:
    return F.lower(strip(c))


def literal_map(pairs: dict[str, object]) -> Column | None:
    """A map literal; the rules bound its size, no data does."""
    return F.create_map(*(F.lit(x) for kv in sorted(pairs.items()) for x in kv)) if pairs else None


def lookup(pairs: dict[str, object], key: Column) -> Column:
    table = literal_map(pairs)
    return F.lit(None) if table is None else F.try_element_at(table, key)


def bind(value: Column, f) -> Column:
    """``f`` of ``value``, which is computed once however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def alias(c: Column, *tables: dict[str, str]) -> Column:
    """Whole-key alias lookups, one hop for each table; a key that is missing stays a key."""
    key = surface_key(c)
    for n, table in enumerate(tables):
        by_key = {" ".join(k.split()).lower(): v for k, v in table.items()}
        if by_key:
            key = bind(key, _hop(by_key, surface_key if n else lambda k: k))
    return key


def _hop(table: dict[str, str], shape):
    return lambda k: F.coalesce(lookup(table, shape(k)), k)


class UnsupportedPattern(ValueError):
    """The group ``v`` is not at the pattern's top level, or the pattern refers to groups by number."""


def split_pattern(pattern: str) -> tuple[str, str, str]:
    """(before, value, after) around the top-level group ``v`` of a Python pattern, in Java's spelling."""
    re.compile(pattern)
    depth, in_class, i, start, at_top, spans = 0, False, 0, None, False, None
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            if not in_class and pattern[i + 1 : i + 2].isdigit() and pattern[i + 1] != "0":
                raise UnsupportedPattern(pattern)
            i += 2
            continue
        if in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
            if pattern[i + 1 : i + 2] in ("]", "^"):
                i += 1 + (pattern[i + 1 : i + 3] == "^]")
        elif c == "(":
            if pattern.startswith("(?P<v>", i):
                at_top, start, level = depth == 0, i, depth
            depth += 1
        elif c == ")":
            depth -= 1
            if start is not None and spans is None and depth == level:
                spans = (start, i + 1)
        elif c == "|" and depth == 0:
            raise UnsupportedPattern(pattern)
        i += 1
    if spans is None or not at_top:
        raise UnsupportedPattern(pattern)
    parts = pattern[: spans[0]], pattern[spans[0] + 6 : spans[1] - 1], pattern[spans[1] :]
    if pattern[spans[1] : spans[1] + 1] in ("*", "?", "+", "{"):
        raise UnsupportedPattern(pattern)
    return tuple(p.replace("(?P<", "(?<") for p in parts)  # type: ignore[return-value]


def first_match(payload: Column, pattern: str) -> tuple[Column, Column, Column]:
    """(value, start, end) of the stripped group ``v`` in the first match, in code points; nulls if nothing matches."""
    before, value, after = split_pattern(pattern)
    inner = re.compile(before.replace("(?<", "(?P<")).groups if before else 0
    java = f"{PYTHON_FLAGS}\\A([\\s\\S]*?)({before})({value}){after}"
    found = F.regexp_like(payload, F.lit(java))
    raw = F.regexp_extract(payload, java, 3 + inner)
    lead = F.length(raw) - F.length(F.regexp_replace(raw, r"(?U)^\s+", ""))
    start = F.length(F.regexp_extract(payload, java, 1)) + F.length(F.regexp_extract(payload, java, 2)) + lead
    text = strip(raw)
    return F.when(found, text), F.when(found, start), F.when(found, start + F.length(text))


def first_span(payload: Column, pattern: str) -> tuple[Column, Column]:
    """(raw, lead): the group ``v`` of the first match and the code points before it; "" and 0 if nothing matches.

    Only two runs of the pattern, whatever is made of them later: see ``placed``.
    """
    before, value, after = split_pattern(pattern)
    inner = re.compile(before.replace("(?<", "(?P<")).groups if before else 0
    java = f"{PYTHON_FLAGS}\\A([\\s\\S]*?({before}))({value}){after}"
    return F.regexp_extract(payload, java, 3 + inner), F.length(F.regexp_extract(payload, java, 1))


def placed(raw: Column, lead: Column) -> tuple[Column, Column, Column]:
    """(value, start, end) of the stripped ``raw``, in code points."""
    text = strip(raw)
    start = lead + F.length(raw) - F.length(F.regexp_replace(raw, r"(?U)^\s+", ""))
    return text, start, start + F.length(text)


def port_list(c: Column) -> Column:
    """Distinct ports of a comma list; a part that is no integer raises, as it would be a broken input."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: strip(x) != "")
    return F.array_distinct(F.transform(parts, lambda x: strip(x).cast("int")))


def signature(ports: Column, rule: dict) -> Column:
    def has(p: int) -> Column:
        return F.array_contains(ports, p)

    ok = F.lit(True)
    for p in rule.get("all_of", ()):
        ok = ok & has(p)
    if rule.get("any_of"):
        hit = F.lit(False)
        for p in rule["any_of"]:
            hit = hit | has(p)
        ok = ok & hit
    for p in rule.get("none_of", ()):
        ok = ok & ~has(p)
    return ok


def independence_bonus(k: Column, b: float, r: float) -> Column:
    return F.when(k < 2, F.lit(0.0)).otherwise(F.lit(float(b)) * (1 - F.pow(F.lit(float(r)), (k - 1).cast("double"))))


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def penalty(conflicts: Column, coeff: dict) -> Column:
    return F.least(F.lit(float(coeff["max_conflict_penalty"])), F.size(conflicts) * F.lit(float(coeff["conflict_penalty_per_group"])))


def score(groups: Column, conflicts: Column, weights: dict[str, float], coeff: dict) -> Column:
    """Strongest group plus saturating bonus minus capped penalty, in [0, 1]. The one formula of all scopes."""
    base = F.coalesce(F.array_max(F.transform(groups, lambda g: F.coalesce(lookup({k: float(v) for k, v in weights.items()}, g), F.lit(0.0)))), F.lit(0.0))
    return F.round(clamp(base + independence_bonus(F.size(groups), coeff["b"], coeff["r"]) - penalty(conflicts, coeff)), 6)


def strongest_group(groups: Column, weights: dict[str, float]) -> Column:
    """The group that gives the base: the highest weight, the first by name among equals."""
    ranked = F.transform(groups, lambda g: F.struct((-F.coalesce(lookup({k: float(v) for k, v in weights.items()}, g), F.lit(0.0))).alias("w"), g.alias("g")))
    return F.array_min(ranked)["g"]


def harmonic(n: Column, sum_of_inverses: Column) -> Column:
    return F.when(n == 0, F.lit(0.0)).otherwise(F.round(n / sum_of_inverses, 6))


def decile(c: Column) -> Column:
    """Bucket of label-free histograms: rounded first, so that 0.7 written as 0.69999999 stays in its bucket."""
    return F.format_string("%.1f", F.least(F.floor(F.round(c, 6) * 10 + F.lit(1e-9)) / 10, F.lit(0.9)))


def plain_decile(c: Column) -> Column:
    """Bucket of the evaluation: neither rounded nor nudged."""
    return F.format_string("%.1f", F.least(F.floor(c * 10) / 10, F.lit(0.9)))


def band(c: Column, bands: dict[str, float]) -> Column:
    return F.when(c >= bands["high"], "high").when(c >= bands["medium"], "medium").otherwise("low")


#: Certainties from weak to strong; an unknown one ranks lowest.
CERTAINTY = ("low", "medium", "high")


def certainty_rank(c: Column) -> Column:
    return F.coalesce(lookup({v: n for n, v in enumerate(CERTAINTY)}, c), F.lit(0))


def weaker_certainty(a: Column, b: Column) -> Column:
    return F.when(certainty_rank(a) <= certainty_rank(b), a).otherwise(b)


def obs_hash(columns: list[str]) -> Column:
    """Fingerprint of an observation: its values in the order of the sorted column names."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(columns))), 256)


def entity_id(members: Column, prefix: str = "E-", length: int = 12) -> Column:
    """Content-addressed: the hash of the sorted member ids."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.array_join(F.array_sort(members), "|"), 256), 1, length))
