"""Line dedup: hashes are range-partitioned with a secondary sort by document, streamed, and answered by bitmaps.

1. Each text's lines of at least ``min_chars`` code points (stripped, A-Z lower-cased) become rows of 96 hash bits,
   document, row key and position; texts stay where they are.
2. Rows are range-partitioned by (hash, document) and sorted by position as well. A frequent line thus spreads over
   as many partitions as it needs; a document's copies of a line stay together.
3. Each partition is streamed once, a few documents' rows of one line held at a time. Lines whose rows lie inside one partition are
   settled there; the first and the last line of a partition may go on next door, so what is not yet sure of them leaves undecided, and
   one sum over those rows (at most two hashes for each partition, hence a broadcast of bounded size) settles them.
4. The result is one compressed bitmap for each text that loses lines: bit i says that line i stays. Texts without
   a bitmap stay whole.

Defined results: null and empty texts are one empty line; documents are told apart by doc_id (null is one id, lower than
all others); rows that repeat a doc_id count as one document, each row with a bitmap of its own text; lines repeated
inside the largest document stay there; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import SPACE_BYTES, doc_key, free_names, named, replaced_text, row_key, sized, written

ROWS = "hi long, lo int, did long, uid binary, pos int"
STREAMED = "hi long, lo int, did long, uid binary, pos int, opens long, settled boolean"


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    def lines(batches):
        for batch in batches:
            hi, lo, at, pos = [], [], [], []
            digest, space = xxhash.xxh3_128_intdigest, SPACE_BYTES
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                for k, line in enumerate((text or b"").split(b"\n")):
                    if len(line) >= min_chars:
                        key = line.strip(space).lower()
                        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                            h = digest(key)
                            hi.append(h >> 64)
                            lo.append(h & 0xFFFFFFFF)
                            at.append(i)
                            pos.append(k)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.array(hi, np.uint64).view(np.int64)), pa.array(np.array(lo, np.uint32).view(np.int32)), batch.column("did").take(rows), batch.column("uid").take(rows), pa.array(pos, pa.int32())], ["hi", "lo", "did", "uid", "pos"])

    return docs.select(doc_key().alias("did"), "uid", "text").mapInArrow(lines, ROWS)


def _stream(min_docs: int):
    """Streams sorted rows and holds those of one line's first ``min_docs`` - 1 documents, or of its last, at a time.

    Rows of a line that ``min_docs`` documents have been seen to hold are settled as soon as a larger document follows. Of the first
    and the last line of a partition the other rows leave undecided: ``opens`` says for how many documents a row stands.
    """

    def stream(batches):
        held, base, first = None, 0, True  # rows of the open line, documents of it that were settled before, whether no line came before
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            hi, lo, did = (t.column(c).to_numpy() for c in ("hi", "lo", "did"))
            new_line = np.ones(len(hi), bool)
            new_line[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            opens = new_line.copy()
            opens[1:] |= did[1:] != did[:-1]
            start = np.flatnonzero(new_line)
            end = np.append(start[1:], len(hi))
            line = np.cumsum(new_line) - 1
            n_docs = np.add.reduceat(opens.astype(np.int64), start)
            n_docs[0] += base
            settled = (n_docs >= min_docs)[line] & (did != did[end - 1][line])
            yield from _marked_rows(t, np.flatnonzero(settled), opens, True)
            open_line = line == len(start) - 1
            if first and len(start) > 1:
                yield from _edge_rows(t, np.flatnonzero((line == 0) & ~settled), opens, int(n_docs[0]))
            first = first and len(start) == 1
            left = np.flatnonzero(open_line & ~settled)
            base = int(n_docs[-1]) - int(opens[left].sum())
            held = t.take(pa.array(left))
        if held is not None:
            did = held.column("did").to_numpy()
            opens = np.append(True, did[1:] != did[:-1])
            yield from _edge_rows(held, np.arange(len(did)), opens, base + int(opens.sum()))

    return stream


def _marked_rows(t: pa.Table, at: np.ndarray, opens: np.ndarray, settled: bool):
    out = t.take(pa.array(at)).append_column("opens", pa.array(opens[at].astype(np.int64))).append_column("settled", pa.array(np.full(len(at), settled)))
    return out.to_batches()


def _edge_rows(t: pa.Table, at: np.ndarray, opens: np.ndarray, n_docs: int):
    """Undecided rows of a line that stand for ``n_docs`` documents, those settled before them included."""
    opens = opens.astype(np.int64)
    opens[at[0]] += n_docs - int(opens[at].sum())
    return _marked_rows(t, at, opens, False)


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(uid, pos) of the lines to drop."""
    rows = line_rows(docs, min_chars).repartitionByRange("hi", "lo", "did").sortWithinPartitions("hi", "lo", "did", "uid", "pos")
    streamed = written(rows.mapInArrow(_stream(min_docs), STREAMED), "lines")
    open_rows = streamed.filter(~F.col("settled"))
    edges = open_rows.groupBy("hi", "lo").agg(F.sum("opens").alias("n"), F.max("did").alias("last")).filter(F.col("n") >= min_docs)
    late = open_rows.join(F.broadcast(edges), ["hi", "lo"]).filter(F.col("did") != F.col("last"))  # two hashes a partition at most
    return streamed.filter("settled").select("uid", "pos").unionByName(late.select("uid", "pos"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(uid, n_dropped, bitmap): one row for each text that loses lines; see ``unpack``."""

    def pack(batches):
        for batch in batches:
            out = []
            for pos in batch.column("pos").to_pylist():
                keep = np.ones(max(pos) // 8 * 8 + 8, bool)
                keep[pos] = False
                out.append(zlib.compress(np.packbits(keep).tobytes(), 6))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("n_dropped"), pa.array(out, pa.binary())], ["uid", "n_dropped", "bitmap"])

    lists = dropped_lines(docs, min_chars, min_docs).groupBy("uid").agg(F.collect_set("pos").alias("pos"))
    return lists.select("uid", F.size("pos").cast("long").alias("n_dropped"), "pos").mapInArrow(pack, "uid binary, n_dropped long, bitmap binary")


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Which of n lines stay; lines after the bitmap's end do."""
    own = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)
    keep = np.ones(n_lines, bool)
    keep[: min(n_lines, len(own))] = own[:n_lines]
    return keep


def _marked(docs: DataFrame, min_chars: int, min_docs: int, uid: str, n_dropped: str, bitmap: str) -> DataFrame:
    """``docs`` with n_dropped and, last, the bitmap."""
    own = docs.withColumn(uid, row_key(named(docs, "doc_id"), named(docs, "text")))
    slim = own.select(F.col(f"`{named(docs, 'doc_id')}`").alias("doc_id"), F.col(f"`{named(docs, 'text')}`").alias("text"), F.col(uid).alias("uid"))
    bitmaps = written(keep_bitmaps(slim, min_chars, min_docs), "bitmaps")
    found = sized(bitmaps, 104).select(F.col("uid").alias(uid), F.col("n_dropped").alias(n_dropped), F.col("bitmap").alias(bitmap))
    return own.join(found, uid, "left").select(*(F.col(f"`{c}`") for c in docs.columns), n_dropped, bitmap)


def _kept_lines(text: bytes | None, bitmap: bytes | None) -> tuple[bytes, int]:
    text = text or b""
    n = text.count(b"\n") + 1
    if bitmap is None:
        return text, n
    lines = text.split(b"\n")
    return b"\n".join([x for x, k in zip(lines, unpack(bitmap, n).tolist(), strict=True) if k]), n


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``; null texts stay null."""
    uid, n_dropped, bitmap = free_names(docs, "uid", "n_dropped", "bitmap")
    marked = _marked(docs, min_chars, min_docs, uid, n_dropped, bitmap).drop(n_dropped)
    return replaced_text(marked, bitmap, lambda text, by: _kept_lines(text, by)[0])


def digest(docs: DataFrame) -> DataFrame:
    """The contract of op6."""

    def digests(batches):
        for batch in batches:
            n_lines, shas = [], []
            for text, bitmap in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("bitmap").to_pylist(), strict=True):
                kept, n = _kept_lines(text, bitmap)
                n_lines.append(n)
                shas.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_lines, pa.int64()), batch.column("n_dropped"), pa.array(shas)], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    marked = _marked(docs.select(F.col("doc_id").cast("long"), "text"), 40, 5, "uid", "n_dropped", "bitmap").select("doc_id", "text", "bitmap", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
    return marked.mapInArrow(digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
