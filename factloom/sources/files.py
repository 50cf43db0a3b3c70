"""Small files and sorted exports on any file system that Hadoop reaches."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _unsealed(spark: SparkSession, path: str) -> None:
    """Without the checksum that local file systems keep beside a file: people edit these files by hand."""
    p, fs = _path(spark, path)
    if fs.getScheme() == "file":
        seal = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.crc")
        fs.getRaw().delete(seal, False)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    _unsealed(spark, path)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value, indent=2, sort_keys=True) + "\n")


def move(spark: SparkSession, source: str, target: str) -> None:
    p, fs = _path(spark, source)
    to, _ = _path(spark, target)
    if to.getParent() is not None:
        fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def content_hash(spark: SparkSession, path: str) -> str:
    """The SHA-256 of one file's bytes, read as a stream; of a folder, that of its files' names, lengths and times."""
    p, fs = _path(spark, path)
    if fs.getFileStatus(p).isFile():
        stream = fs.open(p)
        try:
            return "sha256:" + spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(path)).select("path", "length", F.col("modificationTime").cast("long").alias("at"))
    lines = sorted(f"{r.path} {r.length} {r.at}" for r in parts.toLocalIterator())
    return "sha256:" + hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _one_part(df: DataFrame, path: str, write) -> None:
    """``write`` makes a folder of one part, which becomes the file ``path``."""
    spark, folder = df.sparkSession, f"{path}.parts"
    write(df.coalesce(1), folder)
    p, fs = _path(spark, folder)
    part = next(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    remove(spark, path)
    move(spark, part, path)
    _unsealed(spark, path)
    remove(spark, folder)


def _cell(name: str, type_: str) -> Column:
    c = F.col(f"`{name}`")
    if type_ == "boolean":
        return F.when(c, "True").when(~c, "False").alias(name)
    return (F.array_join(c, "|") if type_.startswith("array") else c).alias(name)


def export_csv(df: DataFrame, path: str, order: list[str], single: bool = True) -> None:
    """A quoted CSV export with a header, in the order of ``order``; lists are joined by ``|``, truth is True or False.

    ``single``: one file, which one task writes, as the consumers of small runs expect; else a folder of parts in order.
    """
    rows = df.orderBy(*order).select(*(_cell(*c) for c in df.dtypes))

    def write(out: DataFrame, to: str) -> None:
        out.write.csv(to, mode="overwrite", header=True, quote='"', escape='"', emptyValue="", nullValue="")

    _one_part(rows, path, write) if single else write(rows, path)


def export_lines(df: DataFrame, path: str, line: Column, order: list[str], single: bool = True) -> None:
    """One text line for each row, in order."""
    rows = df.orderBy(*order).select(line.alias("value"))

    def write(out: DataFrame, to: str) -> None:
        out.write.mode("overwrite").text(to)

    _one_part(rows, path, write) if single else write(rows, path)
