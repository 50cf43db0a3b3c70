"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams scans every training window.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, so ASCII letters, digits and everything
beyond ASCII. A window is ``n`` consecutive words of an item; a shorter item is one window of its own length.

The set holds each item's words once and 16 bytes for each window: its hash, item and place. It goes to the executors only while
it is within ``MAX_BYTES``; a larger benchmark is scanned in several passes of such sets, so memory stays bounded at any
benchmark size (a single larger item is a pass of its own). A hash hit counts only after the words themselves compare equal.

Defined results: null or empty text has no words and is clean; items without words hold no window; repeated
items each count; extra columns of ``docs`` pass, and ours get an underscore where a name is taken; a document is judged by
itself, so repeated rows get equal results. Cutting spans out leaves null texts null and clean texts as they are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.llm.common import free_names, named, released, replaced_text, small_batches
from factloom.llm.textscan import blocks, bytes_and_offsets, lower_table, prefix_sums, span_hashes, window_hashes, word_spans

WORD_BYTES = lower_table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)
_TABLE = np.frombuffer(WORD_BYTES, np.uint8)
#: Bytes of one pass's set: item words and WINDOW_BYTES for each window.
MAX_BYTES, WINDOW_BYTES = 64 << 20, 16
NAMES = ("n_words", "n_hit", "item_ids", "spans")
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def _word_hashes(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, index of each text's first word) of normalised bytes; equal words have equal hashes."""
    starts, ends, first = word_spans(text != 32, offsets)
    return span_hashes(prefix_sums(text, 10), starts, ends), starts, ends, first


class WindowSet:
    """Windows of benchmark items by length: sorted hashes with their item and place; the items' words for the proof."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.ids = [i for i, _ in items]
        self.texts = [b" ".join(words_of(t)) for _, t in items]
        parts = defaultdict(list)
        for k, text in enumerate(self.texts):
            if text:
                words = _word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
                size = min(n, len(words))
                h = window_hashes(words, size)
                parts[size].append((h, np.full(len(h), k, np.int32), np.arange(len(h), dtype=np.int32)))
        self.by_size = {}
        for size, own in parts.items():
            h, item, place = (np.concatenate(x) for x in zip(*own, strict=True))
            order = np.argsort(h, kind="stable")
            # one bit for each value of the low 16 bits rejects nearly all windows before the binary search
            seen = np.zeros(1 << 16, bool)
            seen[(h & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.by_size[size] = (h[order], item[order], place[order], seen)

    def finder(self):
        """A function from a block of texts to each one's words, hits (word range, item ids) and the words' byte ranges."""
        item_words = lru_cache(4096)(lambda k: self.texts[k].split())

        def find(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, list], np.ndarray, np.ndarray]:
            text = _TABLE[data]
            words, starts, ends, first = _word_hashes(text, offsets)
            row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            hits = defaultdict(list)
            for size, (hashes, item, place, seen) in self.by_size.items():
                h = window_hashes(words, size)
                at = np.flatnonzero(seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
                at = at[row_of[at] == row_of[at + size - 1]]
                low, high = np.searchsorted(hashes, h[at]), np.searchsorted(hashes, h[at], "right")
                for i, a, b in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
                    got = text[starts[i] : ends[i + size - 1]].tobytes().split()
                    ids = {self.ids[k] for k, p in zip(item[a:b].tolist(), place[a:b].tolist(), strict=True) if item_words(k)[p : p + size] == got}
                    if ids:
                        hits[int(row_of[i])].append((i, i + size, ids))
            return first, hits, starts, ends

        return find


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _passes(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, bytes]]]:
    """Items in runs of at most MAX_BYTES, fetched one run at a time."""
    own: list[tuple[str, bytes]] = []
    total = 0
    for row in benchmark.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        raw = (row[1] or "").encode()
        size = len(raw) + WINDOW_BYTES * len(words_of(raw))
        if own and total + size > MAX_BYTES:
            yield own
            own, total = [], 0
        own.append((str(row[0]), raw))
        total += size
    yield own


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, item_id: str = "item_id", names: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted as strings) and spans (UTF-8 byte ranges that were hit)."""
    names = list(names or free_names(docs, *NAMES))
    out = docs
    for k, items in enumerate(_passes(benchmark, item_id, "text")):
        out = _scan(out, items, n, names, again=k > 0)
    return out


def _scan(docs: DataFrame, items: list, n: int, names: list[str], again: bool) -> DataFrame:
    """One pass; hits of later passes are joined to those of earlier ones."""
    small_batches(docs.sparkSession)
    windows = docs.sparkSession.sparkContext.broadcast(WindowSet(items, n))
    text = named(docs, "text")
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = StructType(kept + StructType.fromDDL(f"`{names[0]}` long, `{names[1]}` long, `{names[2]}` array<string>, `{names[3]}` array<struct<start:int,end:int>>").fields)

    def scan(batches):
        find = windows.value.finder()
        for batch in batches:
            data, offsets = bytes_and_offsets(batch.column(text))
            old = batch.select(names[2:]).to_pylist() if again else None
            n_words, n_hit, ids, spans = [], [], [], []
            for first_row, _, part, own in blocks(data, offsets):
                first, hits, starts, ends = find(part, own)
                for row in range(len(own) - 1):
                    hit = hits.get(row, ())
                    found = [(int(starts[a] - own[row]), int(ends[b - 1] - own[row])) for a, b in merged([x[:2] for x in hit])]
                    item_ids = {i for x in hit for i in x[2]}
                    if again and old[first_row + row][names[3]]:
                        found = merged(found + [(x["start"], x["end"]) for x in old[first_row + row][names[3]]])
                        item_ids |= set(old[first_row + row][names[2]])
                    raw = part[own[row] : own[row + 1]].tobytes() if found else b""
                    n_words.append(int(first[row + 1] - first[row]))
                    n_hit.append(sum(len(words_of(raw[a:b])) for a, b in found))
                    ids.append(sorted(item_ids))
                    spans.append([{"start": a, "end": b} for a, b in found])
            arrays = [batch.column(f.name) for f in kept] + [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(ids, pa.list_(pa.string())), pa.array(spans, SPANS)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.mapInArrow(released(scan), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (remove="spans") with the hit spans cut out of their texts."""
    names = free_names(docs, *NAMES)
    marked = contamination(docs, benchmark, n, names=names)
    if remove == "documents":
        return marked.filter(F.col(names[1]) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))

    def cut(text: bytes, spans: list) -> bytes:
        out, at = [], 0
        for s in spans:
            out.append(text[at : s["start"]])
            at = s["end"]
        return b"".join([*out, text[at:]])

    return replaced_text(marked.select(*(F.col(f"`{c}`") for c in docs.columns), names[3]), names[3], cut)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract of op10: one row per document with counts and a digest of the items found."""
    found = contamination(docs.select("doc_id", "text"), benchmark).drop("text")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
