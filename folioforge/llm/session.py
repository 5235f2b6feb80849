"""Session helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.sources.shared import discard, fresh_path, shared_dir, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


__all__ = ["discard", "fresh_path", "partitions", "shared_dir", "table", "written"]
