"""Exact dedup: an extendible-hash index on shared files, whose owner tasks chain collisions and compare bytes.

* A text's key is a 64-bit hash of its normalised form (runs of ASCII white space become one space).
* The directory maps the first bits of a key to a bucket. It starts as one bucket; buckets over capacity split, and
  the directory doubles when a split needs one more bit. Only counts of prefixes reach the driver, a few thousand
  at most; capacity grows with the keys so that the directory stays within ``MAX_BUCKETS``.
* Keys of one row need no comparison: they enter the index without their text. Texts of keys with several rows are
  combined in the map tasks (one entry for each distinct text and task, so a text that a third of all rows hold
  costs one entry a task) and sent to their buckets' owners.
* An owner task has a range of buckets, sorted by key. It chains entries of equal key, compares their bytes, and writes
  its pages to the shared folder: one entry for each distinct text with the smallest doc_id and the count.

Defined results: null counts as empty; a null doc_id counts as the lowest; rows that tie on the smallest doc_id of
their text all stay; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import SPACE_CLASS, doc_key, from_key, shielded, sized, written

MAX_BUCKETS = 1 << 14
MAX_DEPTH = 24
#: Directory bits that one count over the keys adds.
COUNT_BITS = 8
COMBINE_BYTES = 32 << 20
ENTRY = "key long, did long, n long, text binary"
PAGE = "key long, chain int, sha binary, keep long, n long"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS + "+", " ")


@dataclass(frozen=True)
class Directory:
    """``slots`` has a bucket number for each value of the first ``depth`` bits."""

    depth: int
    slots: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return self.slots[-1] + 1

    def bucket(self, key: Column) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in self.slots]), (_prefix(key, self.depth) + 1).cast("int"))


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def build_directory(entries: DataFrame, capacity: int = 4096) -> Directory:
    """The directory for the ``key`` column, of one row for each key."""
    total = entries.count()
    capacity = max(capacity, math.ceil(2 * total / MAX_BUCKETS))
    full, depth, leaves = [0] if total > capacity else [], 0, [(0, 0)]
    while full and depth < MAX_DEPTH:
        deeper = min(MAX_DEPTH, depth + COUNT_BITS)
        own = entries if not depth else entries.filter(_prefix(F.col("key"), depth).isin(full))
        counts = {r.p: r["count"] for r in own.groupBy(_prefix(F.col("key"), deeper).alias("p")).count().collect()}
        leaves = [x for x in leaves if x[0] != depth or x[1] not in set(full)]
        again = []

        def split(bits: int, prefix: int) -> None:
            width = deeper - bits
            held = sum(counts.get(p, 0) for p in range(prefix << width, (prefix + 1) << width))
            if held <= capacity or bits == deeper:
                leaves.append((bits, prefix))
                if held > capacity:
                    again.append(prefix)
            else:  # an overfull bucket: one more bit tells its halves apart
                split(bits + 1, 2 * prefix)
                split(bits + 1, 2 * prefix + 1)

        for prefix in full:
            split(depth, prefix)
        full, depth = again, deeper
    bits = max(d for d, _ in leaves)
    slots = []
    for number, (d, prefix) in enumerate(sorted(leaves, key=lambda x: x[1] << (bits - x[0]))):
        slots += [number] * (1 << (bits - d))
    return Directory(bits, tuple(slots))


def _combine(batches):
    """Distinct texts of this task with their smallest doc_id and count; what exceeds memory is passed on early."""
    held: dict[tuple[int, bytes], list[int]] = {}
    size = 0

    def out():
        keys = list(held)
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int64()), pa.array([held[k][0] for k in keys], pa.int64()), pa.array([held[k][1] for k in keys], pa.int64()), pa.array([t for _, t in keys], pa.binary())], ["key", "did", "n", "text"])

    for batch in batches:
        for key, did, text in zip(batch.column("key").to_pylist(), batch.column("did").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            entry = held.get((key, text))
            if entry is None:
                held[key, text] = [did, 1]
                size += len(text)
            else:
                entry[0] = min(entry[0], did)
                entry[1] += 1
        if size > COMBINE_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


def _chain(batches):
    """Pages from entries sorted by key: equal keys are chained, and a text joins the entry with its very bytes."""
    rows: list[tuple] = []
    now, chain = None, []

    def close():
        for place, (text, keep, n) in enumerate(chain):
            rows.append((now, place, None if text is None else hashlib.sha256(text).digest(), keep, n))

    def page():
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["key", "chain", "sha", "keep", "n"])

    for batch in batches:
        for key, did, n, text in zip(*(batch.column(c).to_pylist() for c in ("key", "did", "n", "text")), strict=True):
            if key != now:
                close()
                now, chain = key, []
            for entry in chain:
                if entry[0] == text:
                    entry[1] = min(entry[1], did)
                    entry[2] += n
                    break
            else:
                chain.append([text, did, n])
        if len(rows) > 20_000:
            yield page()
            rows.clear()
    close()
    if rows:
        yield page()


def build_index(docs: DataFrame, capacity: int = 4096, key_bits: int = 64) -> tuple[DataFrame, DataFrame, Directory]:
    """(rows, pages, directory): rows have did, key and sha of each document; pages the index entries.

    ``key_bits`` under 64 makes collisions likely, for tests.
    """

    def keyed(df: DataFrame) -> DataFrame:
        key = F.xxhash64("text")
        return df.withColumn("key", key if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits))

    texts = keyed(docs.select(doc_key().alias("did"), normalised().alias("text")))
    rows = written(texts.select("did", "key", F.unhex(F.sha2("text", 256)).alias("sha")), "fingerprints")
    entries = written(rows.groupBy("key").agg(F.min("did").alias("did"), F.count(F.lit(1)).alias("n")), "keys")
    directory = build_directory(entries, capacity)
    shared = written(entries.filter("n > 1").select("key"), "shared-keys")
    several = texts.join(sized(shared, 40), "key", "left_semi").select("key", "did", "text").mapInArrow(_combine, ENTRY)
    single = entries.filter("n = 1").select("key", "did", "n", F.lit(None).cast("binary").alias("text"))
    routed = several.unionByName(single).withColumn("bucket", directory.bucket(F.col("key")))
    owned = routed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "did")
    # buckets and keys are both in the order of the key's unsigned bits, so a key's entries have one owner
    pages = written(owned.drop("bucket").mapInArrow(_chain, PAGE), "pages")
    return rows, pages, directory


def duplicates(docs: DataFrame, capacity: int = 4096, key_bits: int = 64) -> DataFrame:
    """One row per document: did, keep, n and sha."""
    rows, pages, _ = build_index(docs, capacity, key_bits)
    several = pages.filter("n > 1").select("key", "sha", "keep", "n")
    found = rows.join(sized(several, 120), ["key", "sha"], "left")
    return found.select("did", F.coalesce("keep", "did").alias("keep"), F.coalesce("n", F.lit(1)).cast("long").alias("n"), "sha")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text a row with a smaller doc_id holds."""
    inner, restore = shielded(docs, "doc_id", "text")
    dropped = written(duplicates(inner).filter("did <> keep").select("did", "sha"), "dropped")
    marked = inner.withColumn("_did", doc_key()).withColumn("_sha", F.unhex(F.sha2(normalised(), 256)))
    gone = sized(dropped, 80)
    return restore(marked.join(gone, (F.col("_did") == gone["did"]) & (F.col("_sha") == gone["sha"]), "left_anti"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract of op2."""
    found = duplicates(docs.select("doc_id", "text"))
    return found.select(from_key("did").alias("doc_id"), from_key("keep").alias("keep_id"), F.col("n").alias("group_size"), (F.col("did") == F.col("keep")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
