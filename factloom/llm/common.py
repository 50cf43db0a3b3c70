"""Shared plumbing: written intermediate tables, joins guarded by size, text normalisation rules.

Intermediate tables go to the folder that the session names in ``spark.checkpoint.dir``; executors share
it, so a lost executor costs a re-read and no recomputation. Only where the setting is absent (tests, one
machine) a folder of our own is set.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.functions import storage
from factloom.functions.storage import discard, shared_folder  # noqa: F401

#: The ASCII white space of all the text contracts: \x20 and \x09-\x0D.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: A small side may be broadcast up to this many bytes (estimated from its counted rows).
BROADCAST_BYTES = 24 << 20
#: Rows of an Arrow batch: whole texts and sets of hashes are rows here, and JVM and Python hold a batch of each task.
BATCH_ROWS = 2048
#: Stands for a null doc_id in keys; no real id has it.
NULL_ID = -(2**63)


def small_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches to BATCH_ROWS, so that memory does not follow the number of rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """As ``storage.written``, with small Arrow batches."""
    small_batches(df.sparkSession)
    return storage.written(df, name)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``storage.bucketed``, with small Arrow batches."""
    small_batches(df.sparkSession)
    return storage.bucketed(df, name, key, buckets)


def give_back() -> None:
    """Free memory of this process goes back to the system: allocators keep it, and Python workers are used again by all later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


def released(run: Callable) -> Callable:
    """``run``, a function of Arrow batches, after which each task gives its memory back."""

    def own(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return own


def sized(small: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``small`` with a broadcast hint if its counted rows fit ``limit``; else as it is, for a shuffled join.

    ``small`` should be a written table, whose count comes from Parquet footers.
    """
    return F.broadcast(small) if small.count() * row_bytes <= limit else small


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that tell rows apart: equal for equal doc_id and text only; null texts count as empty."""
    parts = F.concat_ws("\x00", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit("")))
    return F.substring(F.unhex(F.sha2(parts, 256)), 1, 16)


def doc_key(c: str = "doc_id") -> Column:
    """doc_id as a non-null long."""
    return F.coalesce(F.col(c).cast("long"), F.lit(NULL_ID))


def from_key(c: str) -> Column:
    """The doc_id behind a ``doc_key`` column."""
    return F.when(F.col(c) != NULL_ID, F.col(c))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores added to those that a column of ``df`` has, ignoring case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(df: DataFrame, column: str) -> str:
    """The name that ``df`` gives ``column``: the same but for case."""
    return next(c for c in df.columns if c.lower() == column.lower())


def appended(df: DataFrame, columns: str, make: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """``df`` with the ``columns`` (DDL) that ``make()``, called once in each task, computes from a batch."""
    small_batches(df.sparkSession)
    more = StructType.fromDDL(columns)
    schema = StructType(df.schema.fields + more.fields)
    names = schema.names

    def run(batches):
        own = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *own(batch)], names)

    return df.mapInArrow(released(run), schema)


def replaced_text(df: DataFrame, extra: str, cut: Callable[[bytes, object], bytes]) -> DataFrame:
    """``df`` without its last column ``extra``; where that is not null, ``text`` is ``cut(text, extra)``. Null texts stay null."""
    small_batches(df.sparkSession)
    text = named(df, "text")
    schema = StructType([f for f in df.schema.fields if f.name != extra])

    def run(batches):
        for batch in batches:
            if batch.column(extra).null_count < batch.num_rows:
                raw, by = batch.column(text).cast(pa.binary()).to_pylist(), batch.column(extra).to_pylist()
                out = pa.array([t if t is None or b is None else cut(t, b) for t, b in zip(raw, by, strict=True)], pa.binary())
                batch = batch.set_column(batch.schema.get_field_index(text), text, out.cast(batch.schema.field(text).type))
            yield batch.select(schema.names)

    return df.mapInArrow(released(run), schema)


def shielded(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but those ``needed`` renamed out of the way, and a function that selects and names them as they were."""
    names = {c: c.lower() if c.lower() in needed else f"passes {i}" for i, c in enumerate(df.columns)}
    inner = df.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    return inner, lambda out: out.select(*(F.col(f"`{n}`").alias(c) for c, n in names.items()))
