"""The folder that the driver and all executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; one of our own where it is unset and all runs in one process. A cluster without it is refused."""
    context = spark.sparkContext._jsc.sc()
    have = spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        current = context.getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not context.isLocal():
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that all of them and the driver share")
        have = "file://" + tempfile.mkdtemp(prefix="folioforge-")
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(have)
    return have


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Set while a table is written: the shuffle files of the job go when it ends, not when the driver happens to collect its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _tidied(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)


#: Share of the driver's largest heap that may be taken from the system before what is free in it is given back.
_HEAP_SHARE = 0.6


def _trimmed(spark: SparkSession) -> None:
    """Plans leave much garbage; a heap that once grew by it keeps its size until a full collection."""
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > _HEAP_SHARE * heap.maxMemory():
        spark._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with _tidied(spark):
        df.write.option("compression", "zstd").parquet(path)
    _trimmed(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` made, once nothing that is still to run reads them."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._written_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list[str], number: str = "n") -> DataFrame:
    """df with a number from 1 in the order of columns. Ranges are sorted apart; only their sizes meet in one task."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")  # sampled once: ranges stay as they are
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before: Column = F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    starts = sizes.select(F.col("__part").alias("__range"), F.coalesce(before, F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    out = dealt.withColumn(number, own).join(F.broadcast(starts), F.col("__part") == F.col("__range"))
    return out.withColumn(number, (F.col(number) + F.col("__before")).cast("bigint")).drop("__part", "__range", "__before")
