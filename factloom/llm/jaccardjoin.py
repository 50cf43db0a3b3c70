"""N-gram Jaccard join: count vectors in R-trees find the candidates, which are verified on their sets.

Let t be the threshold (a ratio of integers). Two sets link when |A & B| >= t |A | B|; then at most
(1 - t) / (1 + t) * (|A| + |B|) shingles are in one of them only.

1. *Points.* Shingles are hashed into ``GROUPS`` groups; a set is the point of its groups' counts. The sum of the coordinate
   minima of two points bounds the overlap of their sets. Sets of equal content share an id of 128 bits, so copies take part once.
2. *Regions.* One R-tree over all points of a corpus fits no task, and its boxes would meet in so many dimensions; so points that may
   link are first brought together. With more groups than differing shingles two linked sets agree on the whole content of some
   groups: each set sends a digest of the content of its fullest groups, more of them than differ (``digests``). Sets that
   send an equal digest are in one region. No pair is made here, and a passage that many texts share fills few groups wholly.
3. *R-trees.* All pairs come from the search of an R-tree over the points of a region, whose boxes (largest coordinates, smallest size)
   bound the overlap of all below them. First each set is searched in its largest region only, and of what is found a spanning forest goes
   on; the most central set of the region, which shares most, is in each of its pages. What is verified is contracted to
   components.
4. Then all regions that hold several components are searched for pairs between them, from the members of all components but the largest:
   first the best pair of a set and a component, then, after these are verified and contracted, all that are left.
5. Components of all links; members of one set id share theirs.

Regions beyond a page are cut: each page of searching sets meets each page of the others in a task of its own. Digests are shuffled once,
16 bytes each; a task streams them. A set is sent once for each hub that it is compared to, and verification streams them too.

Defined results: null and empty texts and texts without words have an empty set and link with nothing; a text of fewer
words than a shingle is one shingle; a null doc_id counts as the lowest; repeated rows are copies; extra columns pass, also those
named as ours. ``dedup`` decides for each row: where rows share a doc_id, each goes or stays by its own text.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import bucketed, discard, doc_key, free_names, from_key, named, released, row_key, sized, written
from factloom.llm.shingles import shingle_sets, sums_by
from factloom.llm.textscan import mix
from factloom.operators.graph import connected_components

#: Coordinates of a count vector.
GROUPS = 256
#: Sizes of one class differ by this factor at most.
CLASS_RATIO = 1.5
#: Up to this size each shingle is a group of its own.
SMALL = 24
#: Members of a region that one R-tree holds, and that search it in one task.
PAGE = 512
FANOUT = 16
#: Sets that a task compares to one hub.
TASK_SETS = 256
FULL = 65535
#: Sets in a bucket of their table, which is shuffled once and joined in each round.
BUCKET_BYTES = 64 << 20


@dataclass(frozen=True)
class Threshold:
    num: int
    den: int

    def __post_init__(self) -> None:
        if self.num * CLASS_RATIO < self.den:
            raise ValueError(f"a threshold under 1/{CLASS_RATIO} would reach beyond the next size class")

    def linked(self, overlap: int, a: int, b: int) -> bool:
        return overlap > 0 and self.den * overlap >= self.num * (a + b - overlap)

    def needed(self, total):
        """The least overlap of two linked sets of ``total`` shingles together."""
        return -(-self.num * total // (self.num + self.den))

    def differing(self, size: int) -> int:
        """The most shingles in one of two linked sets only, if neither has more than ``size``."""
        return 2 * (size * (self.den - self.num)) // (self.num + self.den)


def size_class(size):
    """The number of a size's class."""
    return np.floor(np.log(np.maximum(size, 1)) / math.log(CLASS_RATIO) + 1e-9).astype(np.int64)


def highest(k: int) -> int:
    """The largest size of class ``k``."""
    return math.ceil(CLASS_RATIO ** (k + 1))


def points(docs: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """``keys`` with size, sid (128-bit id of the set; null if empty) and vector (counts of its groups) of each document."""
    fields = [f for f in docs.schema if f.name in keys]

    def scan(batches):
        for batch in batches:
            size, ids = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            vectors: list[bytes] = []
            for first, end, rows, h in shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), n):
                size[first:end] = np.bincount(rows, minlength=end - first)
                for at, sid in set_ids(rows, h):
                    ids[first + at] = sid
                vectors += [v.tobytes() for v in count_vectors(rows, h, end - first)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(size), pa.array(ids, pa.binary()), pa.array(vectors, pa.binary())], [*(f.name for f in fields), "size", "sid", "vector"])

    return docs.select(*keys, "text").mapInArrow(released(scan), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", size long, sid binary, vector binary")


def set_ids(rows: np.ndarray, h: np.ndarray) -> list[tuple[int, bytes]]:
    """(row, 128-bit id of its content) of the rows that have shingles."""
    if not len(h):
        return []
    at, one = sums_by(mix(h + np.uint64(0x5851F42D4C957F2D)), rows)
    _, two = sums_by(mix(h ^ np.uint64(0x14057B7EF767814F)), rows)
    size = np.bincount(rows)[at].astype(np.uint64)
    both = np.stack([mix(one + size), mix(two ^ size)], axis=1).astype(np.uint64)
    return [(r, b.tobytes()) for r, b in zip(at.tolist(), both, strict=True)]


def short_id(sid):
    """64 bits of the set id for the digests' shuffle; sets that share them are told apart afterwards."""
    return F.xxhash64(sid)


def count_vectors(rows: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    cells = rows * GROUPS + (h >> np.uint64(56)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=n * GROUPS), FULL).reshape(n, GROUPS).astype(np.uint16)


def digests(rows: np.ndarray, h: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """(row, digest) of the groups that each set sends to its own size class and to that of its largest partners.

    Linked sets of a class differ in at most d groups. A set sends all its groups that hold r shingles or more, for the largest r that
    more than d of its groups hold. Of two linked sets take that with the larger r: one of the more than d groups that it sends
    is equal in the other, which holds r there as well and so sends it too. (r is 0, and empty groups are sent, only by sets with d
    or fewer groups that hold any.)
    """
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = np.bincount(rows)
    own, largest = size_class(size), size_class(np.maximum(size * t.den // t.num, 1))
    content = mix(h ^ np.uint64(0x2545F4914F6CDD1D))
    spread = mix(h + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    out_rows, out = [], []
    for k in range(int(own[size > 0].min()), int(largest.max()) + 1):
        sends = (size > 0) & ((own == k) | (largest == k))
        if not sends.any():
            continue
        mine, d, salt = sends[rows], t.differing(highest(k)), mix(np.array([k << 32], np.uint64))
        if not d or highest(k) <= SMALL:  # whole sets, or shingles
            row, total = sums_by(content[mine], rows[mine]) if not d else (rows[mine], content[mine])
            out_rows.append(row)
            out.append(mix(total + salt))
            continue
        groups = d + d // 4 + 2
        cell = rows[mine] * groups + (spread[mine] * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        at, total = sums_by(content[mine][order], cell[order])
        load = np.bincount(cell)[at]
        row, group = at // groups, at % groups
        # the load of the (d + 1)-th fullest group of each row
        ranked = np.lexsort((-load, row))
        start = np.searchsorted(row[ranked], np.arange(len(size)))
        held = np.bincount(row, minlength=len(size))
        least = np.where(held > d, load[ranked][np.minimum(start + d, len(load) - 1)], 0)
        send = load >= least[row]
        salts = mix(np.arange(groups, dtype=np.uint64) + salt)
        out_rows.append(row[send])
        out.append(mix(total[send] + salts[group[send]]))
        for r in np.flatnonzero(sends & (held <= d)):
            empty = np.setdiff1d(np.arange(groups), group[row == r])
            out_rows.append(np.full(len(empty), r))
            out.append(mix(salts[empty]))
    return np.concatenate(out_rows), np.concatenate(out)


def routed(docs: DataFrame, n: int, t: Threshold) -> DataFrame:
    """(digest, sid): each set's digests, once for each task that has a copy of it."""

    def scan(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for _, _, rows, h in shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), n):
                sid = [None] * (int(rows[-1]) + 1 if len(rows) else 0)
                new = np.zeros(len(sid), bool)
                for r, i in set_ids(rows, h):
                    if i not in seen:
                        seen.add(i)
                        new[r], sid[r] = True, i
                own = new[rows]
                row, digest = digests(rows[own], h[own], t)
                yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), pa.array(sid, pa.binary()).take(pa.array(row))], ["digest", "sid"])

    return docs.select("text").mapInArrow(released(scan), "digest long, sid binary").select("digest", short_id("sid").alias("short"))


def regions(sig: DataFrame) -> DataFrame:
    """(digest, short) of the digests that several sets send.

    The only shuffle of all digests. Each task streams its sorted rows and holds one of them at a time, so neither a
    frequent digest nor a large task needs memory. A set that sent a digest twice (repeated rows) counts once.
    """

    def scan(batches):
        held = None  # the last row: digest, short, whether its region has an earlier row
        for batch in batches:
            d, s = (batch.column(c).to_numpy() for c in ("digest", "short"))
            if held:
                d, s = np.append(held[0], d), np.append(held[1], s)
            if not len(d):
                continue
            again = np.append(False, (d[1:] == d[:-1]) & (s[1:] == s[:-1]))
            d, s = d[~again], s[~again]
            follows = np.append(bool(held and held[2]), d[1:] == d[:-1])
            inside = np.flatnonzero(follows[:-1] | follows[1:])
            held = (d[-1], s[-1], follows[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[inside]) for x in (d, s)], ["digest", "short"])
        if held and held[2]:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in held[:2]], ["digest", "short"])

    return sig.repartition("digest").sortWithinPartitions("digest", "short").mapInArrow(released(scan), "digest long, short long")


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(sid, hashes) of the documents ``wanted`` (did)."""

    def scan(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for _, _, rows, h in shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), n):
                ids, lists = [], []
                for r, sid in set_ids(rows, h):
                    if sid not in seen:
                        seen.add(sid)
                        ids.append(sid)
                        lists.append(h[np.searchsorted(rows, r) : np.searchsorted(rows, r, "right")].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(lists, pa.binary())], ["sid", "hashes"])

    near = docs.join(sized(wanted.select("did").distinct(), 24), "did", "left_semi").select("text")
    return near.mapInArrow(released(scan), "sid binary, hashes binary")


class CountVectorTree:
    """An R-tree over count vectors, packed along the order of size and vector.

    Nodes keep the largest value of each coordinate and the smallest size below them: the sum of coordinate minima
    with a query's vector bounds the overlap with every set below, and the size bounds the overlap that is needed.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, t: Threshold):
        self.t = t
        self.order = np.lexsort((*vectors.T[:4], sizes))
        self.levels = [(vectors[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FANOUT:
            most, least = self.levels[-1]
            cut = np.arange(0, len(least), FANOUT)
            self.levels.append((np.maximum.reduceat(most, cut), np.minimum.reduceat(least, cut)))

    def search(self, vector: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points that may link with the query, and by how much the bound exceeds the overlap needed."""
        at, over = np.arange(len(self.levels[-1][1])), None
        for depth in range(len(self.levels) - 1, -1, -1):
            most, least = self.levels[depth]
            low = np.minimum(most[at], vector)
            over = low.sum(axis=1, dtype=np.int64) - self.t.needed(size + least[at])
            over[(low == FULL).any(axis=1)] = 1 << 40  # counts that did not fit bound nothing
            fits = over >= 0
            at, over = at[fits], over[fits]
            if depth:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[depth - 1][1])]
        return self.order[at], over

    def forest(self, first: np.ndarray) -> list[tuple[int, int]]:
        """A spanning forest of the pairs that the search finds, grown from the points in the order ``first``."""
        vectors, sizes = self.levels[0]
        place = np.empty(len(sizes), np.int64)
        place[self.order] = np.arange(len(sizes))
        new, left, pairs = np.ones(len(sizes), bool), len(sizes), []
        for start in first.tolist():
            if not left:
                break
            if not new[start]:
                continue
            new[start] = False
            left -= 1
            todo = [start]
            while todo and left:
                i = todo.pop(0)
                found, _ = self.search(vectors[place[i]], int(sizes[place[i]]))
                found = found[new[found]]
                new[found] = False
                left -= len(found)
                pairs += [(i, j) for j in found.tolist()]
                todo += found.tolist()
        return pairs


def _streamed(df: DataFrame, keys: list[str], order: list[str], judge: Callable, schema: str) -> DataFrame:
    """``judge(table)`` of the rows of each value of ``keys``, which one task streams and holds a group at a time."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            change[0] = last is not None and tuple(c[0] for c in cols) != last
            cuts = np.flatnonzero(change).tolist()
            at = 0
            for cut in cuts:
                if cut > at:
                    held.append(batch.slice(at, cut - at))
                yield from judge(pa.Table.from_batches(held)).to_batches()
                held, at = [], cut
            held.append(batch.slice(at))
            last = tuple(c[-1] for c in cols)
        if held:
            yield from judge(pa.Table.from_batches(held)).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(released(run), schema)


def _vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.uint16).reshape(-1, GROUPS)
    return v, table.column("size").to_numpy()


def _pairs(table: pa.Table, pairs: list[tuple[int, int]]) -> pa.Table:
    sid = table.column("sid").combine_chunks()
    a, b = (pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))
    return pa.table({"a": sid.take(a), "b": sid.take(b)})


def _home_pairs(members: DataFrame, ids: DataFrame, t: Threshold) -> DataFrame:
    """(a, b): a spanning forest of what the R-tree finds in each set's largest region."""
    counts = members.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    home = members.join(sized(written(counts, "counts"), 24), "digest").groupBy("short").agg(F.sum("n").alias("shares"), F.max(F.struct("n", "digest")).alias("home")).select("short", "shares", F.col("home.digest").alias("region"))
    placed = written(ids.join(home, "short").select("region", "shares", "sid", "size", "vector"), "home")
    regions = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("shares", "sid")).alias("hub")).filter("n > 1")
    regions = written(regions.select("region", F.ceil(F.col("n") / PAGE).cast("int").alias("pages"), "hub.sid").withColumnRenamed("sid", "hub"), "home-regions")
    paged = placed.join(sized(regions, 48), "region")
    own = paged.withColumn("page", F.pmod(F.xxhash64("sid"), F.col("pages")).cast("int"))
    hubs = paged.filter((F.col("sid") == F.col("hub")) & (F.col("pages") > 1)).withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    hubs = hubs.filter(F.col("page") != F.pmod(F.xxhash64("sid"), F.col("pages")))
    columns = ["region", "page", "shares", "sid", "size", "vector"]

    def judge(table):
        v, s = _vectors(table)
        tree = CountVectorTree(v, s, t)
        return _pairs(table, tree.forest(np.argsort(-table.column("shares").to_numpy(), kind="stable")) if len(s) > 1 else [])

    return _streamed(own.select(columns).unionByName(hubs.select(columns)), ["region", "page"], ["sid"], judge, "a binary, b binary")


def _between(members: DataFrame, ids: DataFrame, near: DataFrame, t: Threshold, best: bool) -> DataFrame:
    """(digest, a, b): pairs between components that the R-tree finds in regions that hold several; ``best``: of a set and a component one."""
    labels = ids.select("short", "sid").join(sized(near, 48), F.col("sid") == F.col("node"), "left").select("short", "sid", F.coalesce("component", "sid").alias("component"))
    placed = written(members.join(sized(written(labels, "component-ids"), 56), "short").select("digest", "sid", "component"), "placed")
    held = placed.groupBy("digest", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n")).filter("top.n < n")
    open_regions = written(held.select("digest", F.col("top.component").alias("top"), F.ceil(F.col("n") / PAGE).cast("int").alias("pages"), F.ceil((F.col("n") - F.col("top.n")) / PAGE).cast("int").alias("ask_pages")), "open")
    rows = written(placed.join(sized(open_regions, 48), "digest"), "open-members").join(ids.select("sid", "size", "vector"), "sid")
    page, ask_page = (F.pmod(F.xxhash64("sid"), F.col(c)).cast("int") for c in ("pages", "ask_pages"))
    columns = ["digest", "page", "ask_page", "asks", "sid", "component", "size", "vector"]
    kept = rows.withColumn("asks", F.lit(0)).withColumn("page", page).withColumn("ask_page", F.explode(F.sequence(F.lit(0), F.col("ask_pages") - 1)))
    asking = rows.filter(F.col("component") != F.col("top")).withColumn("asks", F.lit(1)).withColumn("ask_page", ask_page).withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))

    def judge(table):
        v, s = _vectors(table)
        asks = table.column("asks").to_numpy() == 1
        held, comp = np.flatnonzero(~asks), table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
        pairs = []
        if len(held):
            tree = CountVectorTree(v[held], s[held], t)
            for i in np.flatnonzero(asks).tolist():
                found, over = tree.search(v[i], int(s[i]))
                found = held[found]
                other = comp[found] != comp[i]
                found, over = found[other], over[other]
                if best and len(found):
                    found = found[np.lexsort((found, -over))]
                    found = found[np.unique(comp[found], return_index=True)[1]]
                pairs += [(i, j) for j in found.tolist()]
        digest = table.column("digest")[0].as_py()
        return _pairs(table, pairs).append_column("digest", pa.array([digest] * len(pairs), pa.int64()))

    found = _streamed(kept.select(columns).unionByName(asking.select(columns)), ["digest", "page", "ask_page"], ["asks", "sid"], judge, "a binary, b binary, digest long")
    return written(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "digest"), "between")


def _verified(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """The (a, b) of ``pairs``, a written table, that link.

    A hub's set is followed by those compared to it; a task streams them and holds two. Hubs of many pairs are spread over tasks.
    """
    hubs = written(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TASK_SETS).cast("int").alias("parts")), "hubs")
    others = pairs.join(sized(hubs, 32), "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    others = others.join(sets, others["b"] == sets["sid"]).select("a", "part", F.lit(1).alias("kind"), "sid", "hashes")
    first = hubs.join(sets, hubs["a"] == sets["sid"]).select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "sid", "hashes")

    def verify(batches):
        hub = b""
        for batch in batches:
            a, b = [], []
            for x, kind, sid, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "kind", "sid", "hashes")), strict=True):
                own = np.frombuffer(raw, np.uint64)
                if not kind:
                    hub = own
                elif t.linked(len(np.intersect1d(hub, own, assume_unique=True)), len(hub), len(own)):
                    a.append(x)
                    b.append(sid)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return first.unionByName(others).repartition("a", "part").sortWithinPartitions("a", "part", "kind").mapInArrow(released(verify), "a binary, b binary")


def components(docs: DataFrame, n: int, t: Threshold, keys: list[str]) -> DataFrame:
    """``keys``, size and label of each document of ``docs`` (did, text and keys): rows share a label if links or copies connect them."""
    rows = written(points(docs, n, keys), "points")
    members = written(regions(routed(docs, n, t)), "members")
    first = rows.filter("sid is not null").groupBy("sid").agg(F.min("did").alias("did")).withColumn("short", short_id("sid"))
    alike = first.groupBy("short").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("short")  # different sets, equal 64 bits: a region of its own
    members = members.unionByName(written(alike.select(F.col("short").alias("digest"), "short"), "alike"))
    inside = written(members.select("short").distinct(), "inside")
    chosen = written(first.join(sized(inside, 24), "short"), "chosen")
    ids = written(rows.join(sized(chosen.select("sid", "did", "short"), 48), ["sid", "did"]).select("short", "sid", "size", "vector").dropDuplicates(["sid"]), "ids")
    bytes_ = ids.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"] * 8
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bytes_ // BUCKET_BYTES))
    every = sets_of(docs, chosen, n).repartition(buckets, "sid").join(sized(chosen.select("sid"), 32), "sid", "left_semi")
    sets = bucketed(every.dropDuplicates(["sid"]), "sets", "sid", buckets)
    tried = written(_home_pairs(members, ids, t).distinct(), "home-pairs")
    links = written(_verified(tried, sets, t), "links")
    near = connected_components(links, task_edges=0)
    some = _between(members, ids, near, t, best=True)
    if not some.isEmpty():
        best = written(some.select("a", "b").distinct().join(tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti"), "best-pairs")
        links = written(links.unionByName(_verified(best, sets, t)), "links")
        near = connected_components(links, task_edges=0)
        again = members.join(sized(written(some.select("digest").distinct(), "again"), 16), "digest")
        rest = _between(again, ids, near, t, best=False).select("a", "b").distinct()
        both = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).unionByName(best)
        rest = written(rest.join(both, ["a", "b"], "left_anti"), "rest-pairs")
        if not rest.isEmpty():
            links = written(links.unionByName(_verified(rest, sets, t)), "links")
            near = connected_components(links, task_edges=0)
    discard(ids, sets)
    labels = near.select(F.col("node").alias("sid"), "component")
    return rows.join(sized(labels, 48), "sid", "left").select(*keys, "size", F.coalesce("component", "sid").alias("label"))


def clusters(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """did, size and root (smallest did reachable by links) of each document of ``docs`` (did, text)."""
    found = written(components(docs, n, Threshold(num, den), ["did"]), "clusters")
    roots = found.filter("label is not null").groupBy("label").agg(F.min("did").alias("root"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("label", "root")
    return found.join(sized(written(roots, "roots"), 32), "label", "left").select("did", "size", F.coalesce("root", "did").alias("root"))


def dedup(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id, of its rows any one text; rows without words all stay."""
    uid, text = free_names(docs, "uid")[0], named(docs, "text")
    own = docs.select(doc_key(named(docs, "doc_id")).alias("did"), row_key(named(docs, "doc_id"), text).alias("uid"), F.col(text).alias("text"))
    found = written(components(own, n, Threshold(num, den), ["did", "uid"]).filter("label is not null"), "groups")
    several = found.groupBy("label").agg(F.min(F.struct("did", "uid")).alias("root"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    in_groups = written(found.join(sized(written(several, "several"), 64), "label").select("uid", (F.col("uid") == F.col("root.uid")).alias("stays")), "in-groups")
    gone = written(in_groups.filter(~F.col("stays")).select(F.col("uid").alias(uid)).distinct(), "gone")
    left = docs.withColumn(uid, row_key(named(docs, "doc_id"), text)).join(sized(gone, 24), uid, "left_anti")
    twice = written(in_groups.filter("stays").groupBy("uid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("uid").alias(uid)), "twice")
    if not twice.isEmpty():  # rows of equal doc_id and text: one stays
        left = left.join(sized(twice, 24), uid, "left_anti").unionByName(left.join(sized(twice, 24), uid, "left_semi").dropDuplicates([uid]))
    return left.select(docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The contract of op8."""
    found = clusters(docs.select(doc_key().alias("did"), "text"), 3, 90, 100)
    return found.select(from_key("did").alias("doc_id"), F.col("size").alias("n_shingles"), from_key("root").alias("component_id"))
