"""Session settings and the shared scratch area."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def session_builder(app_name: str) -> SparkSession.Builder:
    """A builder with the settings the operators rely on.

    Nothing here depends on cluster size: adaptive execution picks the number of
    reduce partitions, splits hot join partitions and turns joins into broadcasts
    once it has seen real sizes.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot join partition even where the next step then needs a shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )


# Bytes one reduce task should see.
SHUFFLE_BYTES = 128 * 1024 * 1024


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with enough partitions for ``input_bytes``.

    Adaptive execution merges partitions that turn out small but does not cut ordinary
    ones that are large, so the starting number has to fit the input.
    """
    partitions = max(math.ceil(input_bytes / SHUFFLE_BYTES), spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    return partitions


# Buckets that Spark allows a table.
MOST_BUCKETS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset it is the warehouse, which Spark itself writes tables to from every
    executor. A machine's own temporary folder is never used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


# What is staged within which contexts. Each thread, and each task of an event loop, has its own.
_areas: ContextVar[tuple[list[str], ...]] = ContextVar("areas", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has been given."""
    path = f"{shared_dir(spark)}/feedquality/{name}-{uuid.uuid4().hex}"
    for area in _areas.get():
        area.append(path)
    return path


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete, on the way out, what this thread staged within. Results are lazy and read staged
    copies, so whatever is wanted of them has to be written before."""
    area: list[str] = []
    outer = _areas.set((*_areas.get(), area))
    try:
        yield
    finally:
        _areas.reset(outer)
        for path in area:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete what lies at ``path``, if anything."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy survives the loss of any executor, cuts the lineage, and gives the
    optimizer true sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, name: str, column: str) -> DataFrame:
    """As ``stage``, in as many buckets of ``column`` as a shuffle has partitions: a join or an
    aggregate on it reads the copy where it lies and moves the other side only.

    For wide rows that are joined more than once. Spark takes buckets from the catalog alone, so the
    copy is a table of the current database until it has been resolved; its files stay.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    buckets = min(int(initial or spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    table = f"feedquality_{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).saveAsTable(table, format="parquet", path=path)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")  # of a table with a path of its own only the entry goes
