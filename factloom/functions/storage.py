"""Intermediate tables in the folder that the session's executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Local property of the job at hand: the folder, below the shared one, of the ``scratch`` it is in. Threads of ``at_once`` inherit it.
SCRATCH = "factloom.scratch"
#: Whether a query's shuffle files go when it ends, and not when the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only on one machine (tests), where none is set, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage and survives lost executors.

    With ``by``, in a folder for each value of this column: reads of one value leave the others alone.
    """
    spark = df.sparkSession
    within = spark.sparkContext.getLocalProperty(SCRATCH) or ""
    path = f"{shared_folder(spark)}/{within}factloom-{name}-{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd") if within else df.write
    (out.partitionBy(by) if by else out).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """What is ``written`` inside is deleted at the end, and shuffle files as soon as their query is over.

    Gives a ``written`` for what has to outlast it.
    """
    sc, outer = spark.sparkContext, spark.sparkContext.getLocalProperty(SCRATCH) or ""
    inner, release = f"{outer}scratch-{uuid.uuid4().hex}/", spark.conf.get(RELEASE)

    def lasting(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        now = sc.getLocalProperty(SCRATCH)
        sc.setLocalProperty(SCRATCH, outer)
        try:
            return written(df, name, by)
        finally:
            sc.setLocalProperty(SCRATCH, now)

    sc.setLocalProperty(SCRATCH, inner)
    spark.conf.set(RELEASE, "true")
    try:
        yield lasting
    finally:
        spark.conf.set(RELEASE, release)
        sc.setLocalProperty(SCRATCH, outer)
        _delete(spark, f"{shared_folder(spark)}/{inner}")


def without_bodies(df: DataFrame, name: str) -> DataFrame:
    """``written``, but for the body of each step: for traces of which ids and parents alone are read."""
    return written(df.drop("body"), name)


def at_once(spark: SparkSession, *jobs: Callable) -> list:
    """What each of ``jobs`` returns; their Spark jobs share the cores, as tables of few partitions leave most of them idle."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def spread(df: DataFrame, *keys) -> DataFrame:
    """``df`` over all cores, by ``keys`` if given: a small file is one partition, however long its rows take to compute."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``written``, in ``buckets`` by ``key``: joins on it do not shuffle the table again. ``df`` is partitioned so already.

    With fewer buckets than shuffle partitions Spark would shuffle it nevertheless.
    """
    spark, uid = df.sparkSession, uuid.uuid4().hex
    path, table = f"{shared_folder(spark)}/factloom-{name}-{uid}", f"factloom_{name}_{uid}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table, format="parquet")
    out = spark.table(table)
    out.written_path, out.written_table = path, table
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` or ``bucketed`` made and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        if name := getattr(df, "written_table", None):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(spark, df.written_path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
