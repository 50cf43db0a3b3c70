"""URL filters: a Bloom filter cascade gives exact membership of URL keys in a rule list without joins.

A rule is ``host/path-prefix`` with a verdict; it fits its host and all subdomains, for paths that start with
its own. Each page offers one key for every shape (labels of the host, length of the path prefix) that some rule
has: those keys of all pages are the key universe. Level 1 of the cascade encodes the listed keys; level 2 the keys
of the universe that pass level 1 without being listed; level 3 the listed keys that pass level 2, and so on until
a level lets nothing wrong through. For every key of the universe, walking the levels is exact.

Sizing: level 1 has a false positive rate of about half of listed/universe, the others 1/2, so the cascade holds a few
bits for each listed key and log2(universe/listed) of them: it does not grow with the pages. Everything is DataFrame
expressions: the only shuffle is the distinct of false positives, as many as there are listed keys.

Defined results: null url or no ``://`` gives empty host and path, fits no rule and is allowed; repeated rows get
equal verdicts; an empty rule list allows all; extra columns pass, and ours get an underscore where a name is taken. Where no rule fits, no listed key was
found, which the method answers with ``allow``. Of fitting rules the longest (code points of the rule) wins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import free_names, named, written

MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path without a scheme, as in ``example.com/en/7``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2] if "/" in self.text else ""

    @property
    def shape(self) -> tuple[int, int]:
        return self.host.count(".") + 1, len(self.path)


@dataclass
class Level:
    bits: int
    hashes: int
    words: np.ndarray


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """True for listed keys, false for all others of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)
        for k, level in reversed(list(enumerate(self.levels))):
            # out of an odd level (k even) means not listed, out of an even one listed
            out = F.when(~_passes(key, level), F.lit(k % 2 == 1)).otherwise(out)
        return out

    @property
    def bytes(self) -> int:
        return sum(8 * len(x.words) for x in self.levels)


def _position(key: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits).cast("long"))


def _passes(key: Column, level: Level) -> Column:
    words = F.lit(level.words)  # one array literal, whatever its size
    out = F.lit(True)
    for seed in range(level.hashes):
        at = _position(key, seed + 101 * level.bits, level.bits)
        word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
        out = out & (word.bitwiseAND(_bit(at)) != 0)
    return out


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))


def _encode(keys: DataFrame, n: int, rate: float) -> Level:
    """A level for the n distinct values of ``key``: bit positions are grouped to words on the executors."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(n * hashes / math.log(2) / 64))
    at = F.explode(F.array(*[_position(F.col("key"), seed + 101 * bits, bits) for seed in range(hashes)])).alias("at")
    rows = keys.select(at).groupBy(F.floor(F.col("at") / 64).alias("w")).agg(F.bit_or(_bit(F.col("at"))).alias("bits")).collect()  # bounded by the level's words
    words = np.zeros(bits // 64, np.int64)
    for r in rows:
        words[r.w] = r.bits
    return Level(bits, hashes, words)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of the ``key`` column of ``listed`` that is exact on the ``key`` column of ``universe``."""
    listed = written(listed.filter(F.col("key").isNotNull()).distinct(), "listed")
    r = listed.count()
    if not r:
        return Cascade()
    s = universe.agg(F.approx_count_distinct("key")).first()[0]
    out = Cascade([_encode(listed, r, min(0.5, 0.5 * r / max(s, 1)))])
    # the one scan of the universe for false positives; later levels read these and the listed keys alone
    wrong = written(universe.filter(_passes(F.col("key"), out.levels[0])).select("key").distinct().join(listed, "key", "left_anti"), "wrong")
    included, excluded = listed, wrong
    for _ in range(MAX_LEVELS):
        n = excluded.count()
        if not n:
            return out
        out.levels.append(_encode(excluded, n, 0.5))
        passed = included.filter(_passes(F.col("key"), out.levels[-1]))
        included, excluded = excluded, passed
    raise RuntimeError("the cascade did not end: keys with equal hashes")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first :// up to / ? # or end, ASCII lower case; path from there up to ? # or end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def key_of(host: Column, path: Column, shape: tuple[int, int]) -> Column:
    """The key of one shape: the last labels of the host and the first code points of the path; null if it has fewer."""
    labels, length = shape
    fits = (F.length(path) >= length) & (F.size(F.split(host, "\\.")) >= labels)
    return F.when(fits, F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length) if length else F.lit("")))


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict (``block`` or ``allow``)."""
    spark: SparkSession = pages.sparkSession
    names = free_names(pages, "host", "path", "rule", "verdict")
    host, path = url_parts(F.col(f"`{named(pages, 'url')}`"))
    parts = pages.withColumn(names[0], host).withColumn(names[1], path)
    host, path = F.col(names[0]), F.col(names[1])
    shapes = sorted({r.shape for r in rules}, key=lambda x: (-x[0], -x[1]))
    # a rule's key is its text; of several verdicts for one key, block holds
    verdicts = _verdicts(rules)
    listed = spark.createDataFrame(list(verdicts.items()), "key string, verdict string")
    keys = F.array(*[key_of(host, path, x) for x in shapes]) if shapes else F.array(F.lit(None).cast("string"))
    universe = parts.select(F.explode(keys).alias("key")).filter("key is not null")
    cascade = build_cascade(listed.select("key"), universe)
    # the listed keys are the universe of a second cascade, which holds those that block
    blocks = build_cascade(listed.filter("verdict = 'block'").select("key"), listed.select("key"))
    # keys of longer rules first; the cascade has proved that the first hit is a listed key
    longest = sorted(shapes, key=lambda x: -max(len(r.host + r.path) for r in rules if r.shape == x))
    probe = F.lit(None).cast("string")
    for shape in reversed(longest):
        key = key_of(host, path, shape)
        probe = F.when(key.isNotNull() & cascade.contains(key), _longer(key, probe)).otherwise(probe)
    out = parts.withColumn(names[2], probe)
    rule = F.col(names[2])
    return out.withColumn(names[3], F.when(rule.isNull(), F.lit(default)).when(blocks.contains(rule), F.lit("block")).otherwise(F.lit("allow")))


def _verdicts(rules: list[Rule]) -> dict[str, str]:
    """The verdict of each rule's key."""
    out: dict[str, str] = {}
    for r in rules:
        key = r.host + r.path
        out[key] = "block" if "block" in (r.verdict, out.get(key)) else "allow"
    return out


def _longer(a: Column, b: Column) -> Column:
    return F.when(b.isNull() | (F.length(a) >= F.length(b)), a).otherwise(b)


#: The rules of the query.
RULES = [Rule("com/en/", "block"), Rule("example.com/en/7", "allow"), Rule("net/de/", "allow"), Rule("example.net/de/8", "block"), Rule("org/es/", "block")]


def digest(pages: DataFrame) -> DataFrame:
    """The contract of op5."""
    return filter_urls(pages.select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")
