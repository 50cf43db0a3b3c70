"""Suffix-array dedup: a logarithmic family of sparse suffix arrays finds all byte strings of length L that repeat.

*Sparse suffixes.* Every window of L bytes names one anchor: the start of its K-byte string of smallest hash (leftmost of
equals). The choice depends on the window's bytes alone, so equal windows, wherever they stand, have their
anchors at equal places, and only suffixes that start at anchors need to be indexed: about 2 in L - K + 2. Consecutive windows with
one anchor form an entry; its bytes are those its windows cover, the head before the anchor and the suffix from it.

*Logarithmic family.* Texts come in batches. A batch's suffix array is its entries in the order of their suffixes (first bytes,
then the hash of the K bytes), equal ones with their count. It is merge-scanned against each existing level for shared
K-byte prefixes, then becomes a level; levels of equal size are merged, so n batches leave log2(n) levels and each entry is
merged log2(n) times. Levels hold no text: what shares no K bytes can not match L. The suffixes that do are fetched with their
bytes, by a filter of bounded size on the K-byte hashes, and equal ones counted in the map tasks.

*Matches.* The fetched suffixes are sorted by their bytes over all partitions, and each is compared, byte by byte, with its
neighbours: the common prefix of r bytes and the common head of h bytes say that the windows that start up to h before the anchor
and at most L - r repeat. The same is done in the order of the heads, read backwards. The neighbours have the longest common prefix
(head) that any other entry has, so windows beyond those two lengths repeat nowhere; the few between them that no neighbour settles
are looked up one by one among the windows of equal place and bytes. Windows of suffixes that occur twice with all their bytes all
repeat. Ranges are dealt by sampled bytes, so a passage that a third of all texts share spreads over many tasks.

Defined results: null is empty; texts under L bytes lose nothing; rows that repeat are copies and lose all windows;
overlapping and adjacent windows merge to one run; very long texts are cut to overlapping pieces inside a task;
extra columns pass through, also those named as ours; ``remove_repeats`` leaves null texts null and decodes what is left,
dropping bytes of characters cut in two.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import appended, discard, free_names, named, released, replaced_text, row_key, sized, written
from factloom.llm.textscan import blocks, bytes_and_offsets, prefix_sums, span_hashes

LENGTH, GRAM = 400, 100
BATCHES = 4
#: Windows of one piece of a long text.
PIECE = (1 << 20) - 4096
#: Largest size of the filter on K-byte hashes; beyond it more suffixes are fetched, and dropped by the join.
FILTER_BYTES = 16 << 20
FILTER_CHUNK = 1 << 16
#: Bytes of distinct suffixes that a task holds before it hands them on.
TASK_BYTES = 32 << 20
#: Suffixes that a task of the sorted order holds on average.
RANGE = 50_000


def _pieces(offsets: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(row, first byte, end byte): all windows of texts that have one; pieces overlap by length - 1."""
    out = []
    for row in np.flatnonzero(np.diff(offsets) >= length).tolist():
        a, b = int(offsets[row]), int(offsets[row + 1])
        out += [(row, s, min(b, s + PIECE + length - 1)) for s in range(a, b - length + 1, PIECE)]
    return out


def anchors(text: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows, prefix sums) of the entries of consecutive pieces that end at ``ends``."""
    n, width = len(text), length - gram + 1
    sums = prefix_sums(text, 3)
    at = np.arange(n - gram + 1)
    h = span_hashes(sums, at, at + gram) & np.uint64(0xFFFFFFFF00000000)
    least = h | at.astype(np.uint64)
    piece_end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    least[piece_end[: len(at)] < at + gram] = np.uint64(2**64 - 1)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    rest = width - step
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    window = np.arange(n - length + 1)
    window = window[piece_end[: len(window)] >= window + length]
    anchor = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    return anchor[first], window[first], np.diff(np.append(first, len(window))), sums


def _entries(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, start in the row, windows, anchor in the block, window in the block, key, block) for each block of pieces."""
    pieces = _pieces(offsets, length)
    if not pieces:
        return
    bounds = np.cumsum([0] + [e - s for _, s, e in pieces])
    joined = np.concatenate([data[s:e] for _, s, e in pieces])
    rows, starts = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    for first, end, part, own in blocks(joined, bounds):
        anchor, window, n, sums = anchors(part, own[1:], length, gram)
        piece = np.searchsorted(own, window, "right") - 1
        row = rows[first:end][piece]
        start = window - own[piece] + starts[first:end][piece] - offsets[row]
        yield row, start, n, anchor, window, span_hashes(sums, anchor, anchor + gram).view(np.int64), part


class LogarithmicIndex:
    """Levels of suffix arrays; level sizes in batches are distinct powers of two."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.levels: list[tuple[int, DataFrame]] = []
        self.shared: list[DataFrame] = []  # keys found to repeat, by merge-scan

    def suffix_array(self, batch: DataFrame) -> DataFrame:
        """(first, key, n) in the order of the suffixes: first 8 bytes as a number, hash of K bytes, how often."""
        length, gram = self.length, self.gram

        def scan(batches):
            for part in batches:
                data, offsets = bytes_and_offsets(part.column("text"))
                for _, _, _, anchor, _, key, text in _entries(data, offsets, length, gram):
                    head = np.zeros((len(anchor), 8), np.uint8)
                    head[:, : min(8, gram)] = text[anchor[:, None] + np.arange(min(8, gram))]
                    first = head.view(">u8").ravel().astype(np.uint64) >> np.uint64(1)
                    own, n = np.unique(np.stack([first.view(np.int64), key]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(own[0]), pa.array(own[1]), pa.array(n)], ["first", "key", "n"])

        found = batch.select("text").mapInArrow(released(scan), "first long, key long, n long")
        return written(found.groupBy("first", "key").agg(F.sum("n").alias("n")).sortWithinPartitions("first", "key"), "suffixes")

    def insert(self, batch: DataFrame) -> None:
        new = self.suffix_array(batch)
        found = new.filter("n > 1").select("key")
        for _, level in self.levels:
            found = found.unionByName(new.select("first", "key").join(level.select("first", "key"), ["first", "key"], "left_semi").select("key"))
        self.shared.append(written(found.distinct(), "shared"))
        self.levels.append((1, new))

    def merge(self) -> None:
        """Merge levels of equal size until all differ."""
        while len({size for size, _ in self.levels}) < len(self.levels):
            self.levels.sort(key=lambda x: -x[0])
            (size, a), (_, b) = next((x, y) for x, y in zip(self.levels, self.levels[1:], strict=False) if x[0] == y[0])
            both = a.unionByName(b).groupBy("first", "key").agg(F.sum("n").alias("n"))
            merged = written(both.sortWithinPartitions("first", "key"), "level")
            self.levels = [x for x in self.levels if x[1] is not a and x[1] is not b] + [(2 * size, merged)]
            discard(a, b)

    def repeated(self) -> DataFrame:
        """(key) of the K-byte prefixes that occur more than once."""
        keys = self.shared[0]
        for more in self.shared[1:]:
            keys = keys.unionByName(more)
        out = written(keys.distinct(), "repeated")
        discard(*self.shared, *(level for _, level in self.levels))
        return out


def key_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter with two bits a key, of bounded size: bytes in chunks, each made of the keys' bits by the executors."""
    n = keys.count()
    size = FILTER_CHUNK
    while size < FILTER_BYTES and size < 2 * n:
        size *= 2

    def bits(batches):
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in _filter_bits(batch.column("key").to_numpy().view(np.uint64), size):
                for c in np.unique(at // (FILTER_CHUNK * 8)).tolist():
                    chunk = own.setdefault(c, np.zeros(FILTER_CHUNK * 8, bool))
                    chunk[at[at // (FILTER_CHUNK * 8) == c] % (FILTER_CHUNK * 8)] = True
        for c, chunk in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([np.packbits(chunk).tobytes()], pa.binary())], ["chunk", "bits"])

    def merge(parts):
        held, chunk = None, None
        for batch in parts:
            for c, b in zip(batch.column("chunk").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                if c != held:
                    if held is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([chunk.tobytes()], pa.binary())], ["chunk", "bits"])
                    held, chunk = c, np.zeros(FILTER_CHUNK, np.uint8)
                chunk |= np.frombuffer(b, np.uint8)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([chunk.tobytes()], pa.binary())], ["chunk", "bits"])

    schema = "chunk int, bits binary"
    out = np.zeros(size, np.uint8)
    made = keys.coalesce(max(1, min(64, n // 100_000 + 1))).mapInArrow(released(bits), schema).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(released(merge), schema)
    for row in made.collect():  # FILTER_BYTES at most
        out[row["chunk"] * FILTER_CHUNK : (row["chunk"] + 1) * FILTER_CHUNK] = np.frombuffer(row["bits"], np.uint8)
    return out


def _filter_bits(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size * 8 - 1)
    return (keys & mask).astype(np.int64), ((keys >> np.uint64(30)) & mask).astype(np.int64)


def fetched(docs: DataFrame, keys: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, cid, head, suffix, lead, n, uid, start) of the entries of ``keys``: places and, once for each task, bytes.

    A row with uid is a place of the entry ``cid``; a row without has its bytes (head reversed) and how many places the task saw.
    ``lead`` is the first window's distance from the anchor.
    """
    held = docs.sparkSession.sparkContext.broadcast(key_filter(keys))

    def scan(batches):
        bits = held.value
        seen: dict[bytes, list] = {}
        size = 0

        def rows():
            cids = list(seen)
            cols = list(zip(*seen.values(), strict=True)) if seen else [[]] * 4
            k = len(cids)
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cids, pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary()), pa.nulls(k, pa.int32()), pa.array(cols[3], pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32())], NAMES)

        for batch in batches:
            data, offsets = bytes_and_offsets(batch.column("text"))
            uid = batch.column("uid")
            for row, start, n, anchor, window, key, text in _entries(data, offsets, length, gram):
                one, two = _filter_bits(key.view(np.uint64), len(bits))
                at = np.flatnonzero((bits[one >> 3] >> (7 - (one & 7)).astype(np.uint8) & 1) & (bits[two >> 3] >> (7 - (two & 7)).astype(np.uint8) & 1))
                if not len(at):
                    continue
                raw, ids = text.tobytes(), []
                for i in at.tolist():
                    a, w = int(anchor[i]), int(window[i])
                    head, suffix = raw[w:a][::-1], raw[a : w + int(n[i]) - 1 + length]
                    cid = xxhash.xxh3_128_digest(len(head).to_bytes(4, "big") + head + suffix)
                    ids.append(cid)
                    if cid in seen:
                        seen[cid][3] += 1
                    else:
                        seen[cid] = [int(key[i]), head, suffix, 1]
                        size += len(head) + len(suffix) + 200
                k = len(at)
                yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(ids, pa.binary()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array((anchor - window)[at].astype(np.int32)), pa.nulls(k, pa.int64()), uid.take(pa.array(row[at])), pa.array(start[at].astype(np.int32))], NAMES)
                if size > TASK_BYTES:
                    yield rows()
                    seen.clear()
                    size = 0
        yield rows()

    return docs.select("uid", "text").mapInArrow(released(scan), "key long, cid binary, head binary, suffix binary, lead int, n long, uid binary, start int")


NAMES = ["key", "cid", "head", "suffix", "lead", "n", "uid", "start"]


def _common(a: bytes, b: bytes) -> int:
    return len(os.path.commonprefix((a, b)))


def _neighbours(entries: DataFrame, columns: list[str], length: int) -> DataFrame:
    """(cid, low, high, most): windows that repeat in a neighbour of the sorted order, and the longest common string of the first column.

    Each range of the order is a task; where ranges meet, the last entry of one and the first of the next are compared on the
    driver, two entries of some hundred bytes for each range.
    """
    schema = "cid binary, low int, high int, most int, part int, edge int, head binary, suffix binary"
    names = ["cid", "low", "high", "most", "part", "edge", "head", "suffix"]
    by_suffix = columns[0] == "suffix"

    def compared(x, y):
        h, r = _common(x[1], y[1]), _common(x[2], y[2])
        return [(e[0], length - r, h, r if by_suffix else h) for e in (x, y)]

    def table(found, edges):
        rows = [(*f, None, None, None, None) for f in found] + [(e[0], None, None, None, p, k, e[1], e[2]) for e, p, k in edges]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
        types = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    def scan(batches):
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            found, edges = [], []
            for e in zip(batch.column("cid").to_pylist(), batch.column("head").to_pylist(), batch.column("suffix").to_pylist(), strict=True):
                if last is None:
                    edges.append((e, part, 0))
                else:
                    found += compared(last, e)
                last = e
            yield table(found, edges)
        if last is not None:
            yield table([], [(last, part, 1)])

    spark = entries.sparkSession
    ranges = entries.count() // RANGE + 1
    ordered = entries.select("cid", "head", "suffix").repartitionByRange(max(ranges, 8), *columns).sortWithinPartitions(*columns)
    out = written(ordered.mapInArrow(released(scan), schema), "neighbours")
    ends = sorted((r.part, r.edge, bytes(r.cid), bytes(r["head"]), bytes(r.suffix)) for r in out.filter("edge is not null").collect())
    found = [f for x, y in zip(ends[1::2], ends[2::2], strict=False) for f in compared(x[2:], y[2:])]
    met = spark.createDataFrame([(bytearray(c), a, b, m) for c, a, b, m in found], "cid binary, low int, high int, most int")
    return out.filter("edge is null").select("cid", "low", "high", "most").unionByName(met)


def _verdicts(entries: DataFrame, length: int) -> DataFrame:
    """(cid, runs): for each entry (key, cid, head, suffix, n) the ranges of distances from the anchor at which repeated windows start."""
    own = entries.select("cid", "key", F.length("head").alias("most_high"), (F.lit(length) - F.length("suffix")).alias("least_low"), "n")
    right = _neighbours(entries, ["suffix", "head"], length).withColumn("side", F.lit(0))
    left = _neighbours(entries, ["head", "suffix"], length).withColumn("side", F.lit(1))
    near = right.unionByName(left).groupBy("cid").agg(F.max(F.when(F.col("side") == 0, F.col("most"))).alias("suffix_most"), F.max(F.when(F.col("side") == 1, F.col("most"))).alias("head_most"), F.collect_list(F.when(F.col("low") <= F.col("high"), F.struct("low", "high"))).alias("runs"))
    judged = own.join(near, "cid", "left")

    def settle(batches):
        for batch in batches:
            cids, runs, gaps = [], [], []
            for cid, high, low, n, s, h, found in zip(*(batch.column(c).to_pylist() for c in ("cid", "most_high", "least_low", "n", "suffix_most", "head_most", "runs")), strict=True):
                own_runs = [(low, high)] if n > 1 else merged([(max(r["low"], low), min(r["high"], high)) for r in found or ()])
                open_gaps, at = [], max(low, length - (s or 0))
                for a, b in [*own_runs, (min(high, h or 0) + 1, None)]:
                    if at < a and n == 1:
                        open_gaps.append((at, min(a - 1, min(high, h or 0))))
                    at = max(at, (b or 0) + 1)
                cids.append(cid)
                runs.append([{"low": a, "high": b} for a, b in own_runs])
                gaps.append([{"low": a, "high": b} for a, b in open_gaps if a <= b])
            spans = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.binary()), batch.column("key"), pa.array(runs, spans), pa.array(gaps, spans)], ["cid", "key", "runs", "gaps"])

    span = "array<struct<low:int,high:int>>"
    settled = written(judged.mapInArrow(released(settle), f"cid binary, key long, runs {span}, gaps {span}"), "settled")
    asked = written(settled.select("key", F.explode("gaps").alias("gap")).select("key", F.explode(F.sequence("gap.low", "gap.high")).alias("at")).groupBy("key").agg(F.collect_set("at").alias("ats")), "asked")
    if asked.isEmpty():
        return settled.select("cid", "runs").filter(F.size("runs") > 0)
    # An equal window of another entry lies in that entry's runs or gaps too: both share its bytes, so neither's neighbours have
    # less in common. Only those windows are looked up, by their bytes; a key has at most as many `ats` as an entry has windows.
    inside = lambda at: F.exists(F.concat("runs", "gaps"), lambda s: (s["low"] <= at) & (at <= s["high"]))
    near = settled.filter((F.size("runs") > 0) | (F.size("gaps") > 0)).join(sized(asked, 24 + 4 * length), "key")
    near = written(near.select("cid", F.explode(F.filter("ats", inside)).alias("at")), "near")
    window = F.concat(F.hex(F.substring("head", F.lit(1), F.col("at"))), F.lit("|"), F.hex(F.substring("suffix", F.lit(1), F.lit(length) - F.col("at"))))
    windows = entries.join(sized(near, 32), "cid").select("cid", "at", "key", F.sha2(window, 256).alias("bytes"), "n")
    windows = written(windows, "windows")
    often = windows.groupBy("key", "at", "bytes").agg(F.sum("n").alias("c")).filter("c > 1").select("key", "at", "bytes")
    more = windows.join(often, ["key", "at", "bytes"], "left_semi").select("cid", F.struct(F.col("at").alias("low"), F.col("at").alias("high")).alias("run"))
    runs = settled.select("cid", F.explode("runs").alias("run")).unionByName(more).groupBy("cid").agg(F.collect_set("run").alias("runs"))
    return runs


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges (both ends in) in order, those that meet made one; empty ones gone."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if a > b:
            continue
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """(uid, spans): the merged byte ranges of each text that repeated windows cover; ``docs`` has uid and text."""
    index = LogarithmicIndex(length, gram)
    number = F.pmod(F.xxhash64("uid"), F.lit(batches))
    for b in range(batches):
        index.merge()
        index.insert(docs.filter(number == b))
    keys = index.repeated()
    found = written(fetched(docs, keys, length, gram).join(sized(keys, 24), "key", "left_semi"), "fetched")
    entries = written(found.filter("uid is null").groupBy("key", "head", "suffix").agg(F.sum("n").alias("n"), F.min("cid").alias("cid")), "entries")
    places = found.filter("uid is not null").select("cid", "uid", "start", "lead")
    verdicts = written(_verdicts(entries, length), "verdicts")
    discard(keys, entries)
    # a window that starts k before the anchor starts lead - k after the entry's first
    hits = places.join(sized(verdicts, 400), "cid").select("uid", (F.col("start") + F.col("lead")).alias("anchor"), F.explode("runs").alias("run"))
    covered = hits.select("uid", (F.col("anchor") - F.col("run.high")).alias("a"), (F.col("anchor") - F.col("run.low") + length).alias("b"))

    def merge(parts):
        """Of sorted ranges those that meet made one: one row is held at a time."""
        held = None
        for batch in parts:
            out = []
            for uid, a, b in zip(*(batch.column(c).to_pylist() for c in ("uid", "a", "b")), strict=True):
                if held and held[0] == uid and a <= held[2]:
                    held = (uid, held[1], max(b, held[2]))
                else:
                    if held:
                        out.append(held)
                    held = (uid, a, b)
            yield _span_rows(out)
        if held:
            yield _span_rows([held])

    runs = covered.distinct().repartition("uid").sortWithinPartitions("uid", "a").mapInArrow(released(merge), "uid binary, a int, b int")
    spans = written(runs.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")), "spans")
    discard(found, verdicts)
    return spans


def _span_rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())], ["uid", "a", "b"])


def _marked(docs: DataFrame, length: int, gram: int, batches: int, uid: str, spans: str) -> DataFrame:
    """``docs`` with the last column ``spans``."""
    own = docs.withColumn(uid, row_key())
    found = repeated_spans(own.select(F.col(uid).alias("uid"), F.col(named(docs, "text")).alias("text")), length, gram, batches)
    return own.join(sized(found, 64).select(F.col("uid").alias(uid), F.col("spans").alias(spans)), uid, "left").select(*docs.columns, spans)


def _kept(text: bytes | None, spans: list | None) -> bytes:
    text, out, at = text or b"", [], 0
    for s in spans or ():
        out.append(text[at : s["a"]])
        at = s["b"]
    return b"".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """``docs`` with all repeated windows cut out of ``text``."""
    uid, spans = free_names(docs, "uid", "spans")
    return replaced_text(_marked(docs, length, gram, batches, uid, spans), spans, lambda text, by: _kept(text, by).decode(errors="ignore").encode())


def digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """The contract of op3."""

    def digests(batch):
        n, removed, runs, shas = [], [], [], []
        for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
            kept = _kept(text, spans)
            n.append(len(text or b""))
            removed.append(n[-1] - len(kept))
            runs.append(len(spans or ()))
            shas.append(hashlib.sha256(kept).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(shas, pa.string())]

    marked = _marked(docs.select(F.col("doc_id").cast("long"), "text"), length, gram, batches, "uid", "spans")
    columns = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return appended(marked, columns, lambda: digests).drop("text", "spans")
