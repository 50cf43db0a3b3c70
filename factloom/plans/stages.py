"""The stages of a run over any observations; those that several others read are written once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import partial
from threading import RLock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.storage import at_once, scratch, spread, without_bodies, written
from factloom.operators import entity, extract, fields, trace
from factloom.sources.rules import RuleSet

PARTS = ("extraction", "claims", "entities", "fields")
KINDS = ("link_basis", "field")
#: Observations whose trace is on disk at once.
SLICE = 300_000


class Half:
    """Of one target_kind: the steps of its readings, these, its claims, and ``scored``, these with their steps."""

    def __init__(self, stages: Stages, kind: str):
        self.steps, self.readings, last = trace.extraction_steps(stages.observations, stages.rules, kind, stages.keep)
        self._rows = written(trace.claims(last, stages.rules), "claims")
        self.claims = self._rows.drop("from")
        self._stages, self._lock, self._scored = stages, RLock(), None

    @property
    def scored(self) -> DataFrame:
        with self._lock:
            if self._scored is None:
                self._scored = trace.claim_steps(self._rows, self._stages.rules, self._stages.keep)
            return self._scored


class Stages:
    """``bodies``: whether tables of steps hold their bodies; without them, ``steps`` has none either.

    Parts of the trace are made at once: what two of them need is made by the first that asks, while the other waits.
    """

    def __init__(self, observations: DataFrame, rules: RuleSet, bodies: bool = True):
        self.rules, self.observations, self.keep = rules, observations, written if bodies else without_bodies
        self.columns = trace.STEP if bodies else [c for c in trace.STEP if c != "body"]
        self._locks: dict[str, RLock] = defaultdict(RLock)
        self._kept: dict[str, DataFrame] = {}
        self._halves: dict[str, Half] = {}
        self._parts: dict[str, list[DataFrame]] = {}
        self._tracing, self._source = False, lambda: spread(observations)
        self._across: list[DataFrame] = []

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self._locks[name]:
            if name not in self._kept:
                self._kept[name] = written(make(), name)
            return self._kept[name]

    @property
    def extractions(self) -> DataFrame:
        return extract.extract(self.observations, self.rules)

    @property
    def claims(self) -> DataFrame:
        if "claims" not in self._kept and set(self._halves) == set(KINDS):  # they are in the trace's tables
            return self._halves["link_basis"].claims.unionByName(self._halves["field"].claims)
        return self.once("claims", lambda: extract.claims(self.extractions, self.rules))

    @property
    def identity(self) -> DataFrame:
        """The claims that entities are made of."""
        return self._claims_of("link_basis")

    def _claims_of(self, kind: str) -> DataFrame:
        return self._half(kind).claims if self._tracing or kind in self._halves else self.claims.filter(F.col("kind") == kind)

    @property
    def parted(self) -> DataFrame:
        """Observations and their entities, which hold no more than the identity claims tell."""
        return self.once("entities", lambda: entity.entities(self.observations, self.identity, self.rules))

    @property
    def crossed(self) -> DataFrame:
        return self.once("crossed", lambda: entity.cross_basis(entity.per_basis(self.identity, self.rules), self.rules))

    @property
    def linked(self) -> DataFrame:
        """Each observation's best identity claim; in a trace with its step."""
        if self._tracing:
            return self.once("linked-steps", lambda: entity.linking(self._half("link_basis").scored, self.rules, "step_id"))
        return self.once("linked", lambda: entity.linking(self.identity, self.rules))

    @property
    def membership(self) -> DataFrame:
        with self._locks["membership"]:
            if "membership" not in self._kept:
                at_once(self.observations.sparkSession, lambda: self.crossed, lambda: self.parted, lambda: self.linked)
            return self.once("membership", lambda: entity.membership(self.observations, self.identity, self.rules, self.crossed, self.parted, self.linked))

    @property
    def resolved(self) -> DataFrame:
        return self.once("resolved", lambda: fields.resolve(self._claims_of("field"), self.membership, self.rules))

    @property
    def observed(self) -> DataFrame:
        return fields.observe(self._claims_of("field"), self.membership, self.resolved, self.rules)

    @property
    def rollups(self) -> DataFrame:
        return fields.rollup(self.resolved, self.rules)

    def _half(self, kind: str) -> Half:
        """Readings, claims and their steps of one target_kind: entities need those of identity alone, fields the others."""
        with self._locks[f"half {kind}"]:
            if kind not in self._halves:
                self._halves[kind] = Half(self, kind)
            return self._halves[kind]

    def _made(self, part: str) -> list[DataFrame]:
        """The steps of one part of the trace, made once."""
        with self._locks[f"part {part}"]:
            if part not in self._parts:
                self._parts[part] = self._make(part)
            return self._parts[part]

    def _make(self, part: str) -> list[DataFrame]:
        spark, both = self.observations.sparkSession, [partial(self._half, k) for k in KINDS]
        if part == "extraction":
            links, values = at_once(spark, *both)
            readings = links.readings.select("obs_id", "value").unionByName(values.readings.select("obs_id", "value"))
            return [*links.steps, *values.steps, *trace.silent_steps(self.observations, readings, self.rules)]
        if part == "claims":
            links, values = at_once(spark, *both)
            scored = at_once(spark, lambda: links.scored, lambda: values.scored)
            return [*scored, trace.unlinked_steps(self.observations, links.claims)]
        if part == "entities":
            scored, membership = at_once(spark, lambda: self._half("link_basis").scored, lambda: self.membership)
            return self._across + trace.entity_steps(scored, membership, self.crossed, self.linked, self.rules, self.keep)
        scored, resolved = at_once(spark, lambda: self._half("field").scored, lambda: self.resolved)
        return trace.field_steps(scored, self.membership, resolved, written(self.observed, "observed"), self.rollups, self.rules, self.keep)

    def _ready(self) -> None:
        """All parts of a trace read the observations: they are computed once."""
        if not self._tracing:
            self.observations, self._tracing = self.once("observations", self._source), True

    @property
    def assigned(self) -> DataFrame:
        """The steps that assign entities, with their bodies, which no table holds."""
        self._ready()
        return trace.together(self._made("entities")[-1:])

    def steps(self, *parts: str) -> DataFrame:
        """The steps of some PARTS of the trace, or of all; no op is in two parts. Equal steps are not yet one: ``replay`` reads both forms."""
        self._ready()
        made = at_once(self.observations.sparkSession, *(partial(self._made, p) for p in parts or PARTS))
        return trace.together(*made, columns=self.columns)

    def kept_steps(self) -> DataFrame:
        """All steps, each table of them written: for readers that go over them more than once."""


        def settle(part: str) -> None:
            spark, made = self.observations.sparkSession, self._made(part)
            self._parts[part] = at_once(spark, *((lambda s=s: s if hasattr(s, "written_path") else written(s.select(self.columns), "steps")) for s in made))

        self._ready()
        at_once(self.observations.sparkSession, *(partial(settle, p) for p in PARTS))
        return self.steps()

    @property
    def trace(self) -> DataFrame:
        return self.once("trace", lambda: self.steps().dropDuplicates(["step_id"]))

    def sliced(self, result: Callable[[Stages], DataFrame], entities: bool = True, size: int = SLICE) -> DataFrame:
        """What ``result`` makes of the stages, for one slice of the observations after the other: disk holds one slice's trace.

        All steps that a step comes from are in its slice: those of extractions and claims are of one observation; with
        ``entities`` a slice has whole entities, and so their accepted pairs and fields. Refused pairs, from which nothing
        comes, may lie across slices: the first slice has those.
        """
        spark = self.observations.sparkSession
        with scratch(spark) as lasting:
            self._ready()
            n = -(-self.observations.count() // size)
            if n <= 1:
                return lasting(result(self), "result")
            slices, found = (self._whole_entities if entities else self._any_observations)(n), []
            for stages in slices:
                with scratch(spark):
                    found.append(lasting(result(stages), "result"))
        return spark.read.schema(found[0].schema).parquet(*(f.written_path for f in found))

    def _slice(self, rows: DataFrame) -> Stages:
        return Stages(rows.select(self.observations.columns), self.rules, self.keep is written)

    def _any_observations(self, n: int) -> list[Stages]:
        place = F.pmod(F.xxhash64("obs_id"), F.lit(n)).cast("int")
        rows = written(self.observations.withColumn("_slice", place).repartition("_slice"), "sliced", "_slice")
        return [self._slice(rows.filter(F.col("_slice") == i)) for i in range(n)]

    def _whole_entities(self, n: int) -> list[Stages]:
        spark, rules = self.observations.sparkSession, self.rules
        with scratch(spark) as lasting:
            links = written(extract.claims(extract.readings(self.observations, rules, "link_basis").filter("value <> ''"), rules), "claims")
            crossed, parted = at_once(
                spark,
                lambda: written(entity.cross_basis(entity.per_basis(links, rules), rules), "crossed"),
                lambda: written(entity.entities(self.observations, links, rules), "entities"),
            )
            placed = parted.withColumn("_slice", F.pmod(F.xxhash64("entity_id"), F.lit(n)).cast("int"))
            place = placed.select("obs_id", "_slice")
            # an observation without id has no entity
            rows = self.observations.join(placed, "obs_id", "left").fillna(0, ["_slice"])
            rows = lasting(rows.repartition("_slice"), "sliced", "_slice")
            crossed = lasting(crossed.join(place, "obs_id").repartition("_slice"), "crossed", "_slice")
            across = entity.pair_edges(links.join(place, "obs_id"), rules, ["_slice"]).filter("not accepted and a__slice <> b__slice")
            across = lasting(across, "across")
        out = []
        for i in range(n):
            own = rows.filter(F.col("_slice") == i)
            stages = self._slice(own)
            stages._kept["entities"] = own.filter("entity_id is not null").select("obs_id", "entity_id").distinct()
            stages._kept["crossed"] = crossed.filter(F.col("_slice") == i).drop("_slice")
            out.append(stages)
        out[0]._across = [trace.refused_steps(across, rules)]
        return out
