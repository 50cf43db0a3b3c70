"""Sharding: minimax contiguous partition of ordered atomic groups.

Documents of equal text are one group, ordered by their smallest doc_id. The smallest capacity that lets a greedy fill
need no more than the given shards is found by binary search; the cuts keep every shard within that capacity.

The groups are never gathered. Their order is made by a range partitioning of (leader, text, document), which also
splits a group that holds a third of all rows over many tasks; two numbers from each partition turn places inside
partitions into places overall. The search then runs on the driver over a grid of at most ``GRID`` cells with
the first and the last group start of each cell. A cell may hide starts: the search is done once as if a cut
could be anywhere in such a cell and once as if nowhere. Where the two capacities differ, the cells that cuts
can fall into are divided by another pass over the places; a few passes give the exact minimum.

Defined results: null text is a group of its own with no bytes; a null doc_id comes first; repeated rows follow each
other in one group; fewer groups than shards leave shards empty; no rows give no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import doc_key, free_names, from_key, released, shielded, sized, written

GRID = 1 << 16
ROW_BYTES = 16
PLACED = "did long, g binary, crc long, size long, pid int, idx long, off long, starts boolean"


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + ROW_BYTES).cast("long")


def text_group(text: str = "text") -> Column:
    """128 bits of the text's SHA-256; another value for null."""
    return F.unhex(F.coalesce(F.substring(F.sha2(F.col(text), 256), 1, 32), F.lit("00")))


def _number(batches):
    """Places inside the partition: row index, bytes before, and whether a group starts here."""
    pid, rows, size_before, last = TaskContext.get().partitionId(), 0, 0, None
    for b in batches:
        if not b.num_rows:
            continue
        size = b.column("size").to_numpy()
        ends = np.cumsum(size)
        groups = b.column("g").to_pylist()
        starts = (b.column("did").to_numpy() == b.column("leader").to_numpy()) & np.array([x != y for x, y in zip(groups, [last, *groups[:-1]], strict=True)])
        yield pa.RecordBatch.from_arrays([b.column("did"), b.column("g"), b.column("crc"), b.column("size"), pa.array(np.full(len(size), pid, np.int32)), pa.array(np.arange(rows, rows + len(size))), pa.array(ends - size + size_before), pa.array(starts)], ["did", "g", "crc", "size", "pid", "idx", "off", "starts"])
        rows += len(size)
        size_before += int(ends[-1])
        last = groups[-1]


def placed(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents with ``row`` and ``start`` (rows and bytes before them in the order of groups), and all bytes."""
    spark = docs.sparkSession
    crc = F.coalesce(F.crc32(F.col("text")), F.lit(0)).cast("long")
    keyed = written(docs.select(doc_key().alias("did"), text_group().alias("g"), crc.alias("crc"), text_size().alias("size")), "keyed")
    several = written(keyed.groupBy("g").agg(F.min("did").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "leaders")
    led = keyed.join(sized(several, 64), "g", "left").withColumn("leader", F.coalesce("leader", "did"))
    order = ("leader", "g", "did")
    inside = written(led.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(released(_number), PLACED), "placed")
    parts = inside.groupBy("pid").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).collect()  # a row for each partition
    offsets, rows, size = [], 0, 0
    for r in sorted(parts, key=lambda r: r.pid):
        offsets.append((r.pid, rows, size))
        rows, size = rows + r.rows, size + r.bytes
    before = F.broadcast(spark.createDataFrame(offsets, "pid int, rows_before long, bytes_before long"))
    whole = inside.join(before, "pid").select("did", "g", "crc", "size", "starts", (F.col("idx") + F.col("rows_before")).alias("row"), (F.col("off") + F.col("bytes_before")).alias("start"))
    return whole, size


class Cuts:
    """Known group starts with the gaps between them that may hide more."""

    def __init__(self, total: int, cells: dict[int, tuple[int, int, int]]):
        """cells: number -> (first start, last start, starts) in the cell."""
        at, hides = [0], []
        for _, (first, last, n) in sorted(cells.items()):
            for x, hidden in ((first, False), (last, n > 2)):
                if x > at[-1]:
                    at.append(x)
                    hides.append(hidden)
        at.append(total)
        hides.append(False)
        self.at, self.hides, self.total = at, hides, total

    def reach(self, start: int, capacity: int, anywhere: bool) -> int:
        """The farthest cut within the capacity."""
        if start + capacity >= self.total:
            return self.total
        i = bisect_right(self.at, start + capacity) - 1
        return start + capacity if anywhere and self.hides[i] else max(start, self.at[i])

    def fill(self, shards: int, capacity: int, anywhere: bool) -> list[int]:
        out = [0]
        for _ in range(shards):
            out.append(self.reach(out[-1], capacity, anywhere))
        return out

    def capacity(self, shards: int, anywhere: bool) -> int:
        low, high = ceil(self.total / shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.fill(shards, mid, anywhere)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def cut(self, shards: int, capacity: int) -> list[int]:
        """Starts of shards 1.. within the capacity, each as near as it can be to an even share of what is left."""
        least = [self.total]
        for _ in range(shards - 1):
            least.append(self.at[bisect_left(self.at, least[-1] - capacity)])
        least.reverse()  # least[j]: where shard j has to end at the earliest
        out, now = [], 0
        for j in range(shards - 1):
            most = self.reach(now, capacity, False)
            low = min(most, max(least[j], self.at[min(bisect_right(self.at, now), len(self.at) - 1)]))
            even = now + (self.total - now) / (shards - j)
            i = bisect_left(self.at, even)
            near = min(self.at[max(0, i - 1) : i + 1], key=lambda x: abs(x - even))
            now = min(max(near, low), most)
            out.append(now)
        return out


def find_cuts(whole: DataFrame, total: int, shards: int, grid: int = GRID) -> tuple[int, list[int]]:
    """(capacity, starts of shards 1..): the exact minimax capacity over the group starts."""
    step = max(1, ceil(total / grid))
    starts = whole.filter("starts").select("start")

    def cells(df: DataFrame, step: int) -> dict[int, tuple[int, int, int]]:
        found = df.groupBy(F.floor(F.col("start") / step).alias("cell")).agg(F.min("start").alias("a"), F.max("start").alias("b"), F.count(F.lit(1)).alias("n")).collect()
        return {r.cell * step: (r.a, r.b, r.n) for r in found}  # at most `grid` cells

    known = cells(starts, step)
    while True:
        cuts = Cuts(total, known)
        low, high = cuts.capacity(shards, True), cuts.capacity(shards, False)
        if low == high or step == 1:
            return high, cuts.cut(shards, high)
        first, last = cuts.fill(shards, low, False), cuts.fill(shards, high, True)
        wide = [c for c, (a, b, n) in known.items() if n > 2 and any(x <= b and a <= y for x, y in zip(first[1:], last[1:], strict=True))]
        if not wide:
            return high, cuts.cut(shards, high)
        finer = max(1, ceil(step / max(2, grid // len(wide))))
        own = starts.filter((F.floor(F.col("start") / step) * step).isin(wide))
        for c in wide:
            del known[c]
        known |= cells(own, finer)  # keyed by their first byte, as the undivided coarser ones are
        step = finer


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """did, g, crc, size, shard and slot (gapless from 0 in each shard) of every document."""
    whole, total = placed(docs)
    if not total:
        return whole.select("did", "g", "crc", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    _, cuts = find_cuts(whole, total, shards)
    starts = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    dealt = whole.withColumn("shard", F.size(F.filter(starts, lambda c: c <= F.col("start"))))
    first = {r.shard: r.first for r in dealt.groupBy("shard").agg(F.min("row").alias("first")).collect()}
    base = F.element_at(F.array(*[F.lit(first.get(s, 0)).cast("long") for s in range(shards)]), F.col("shard") + 1)
    return dealt.select("did", "g", "crc", "size", "shard", (F.col("row") - base).alias("slot"))


def write_shards(docs: DataFrame, shards: int, path: str) -> None:
    """Parquet folders shard=0.. under ``path``, in the order of slots."""
    found = written(assign(docs, shards).select("did", "g", "shard", "slot").dropDuplicates(["did", "g"]), "shards")
    inner, _ = shielded(docs, "doc_id", "text")
    own = inner.withColumn("did", doc_key()).withColumn("g", text_group())
    dealt = own.join(sized(found, 40), ["did", "g"]).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    shard = free_names(docs, "shard")[0]
    dealt.select(*(F.col(f"`{n}`").alias(c) for n, c in zip(inner.columns, docs.columns, strict=True)), F.col("shard").alias(shard)).write.partitionBy(shard).parquet(path)


def digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The contract of op1."""
    found = assign(docs.select("doc_id", "text"), shards)
    return found.select(from_key("did").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
