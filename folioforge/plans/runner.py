"""Stages over records, resumed where they stopped.

A stage turns the validated outputs of the one before it into its own. What it did is written as one
table of rows (entity_id, input_sha256, output, output_sha256, status), so the ledger of a stage and
its outputs are the same files and are committed together: a run that breaks leaves either both or
none. A later run finds, for each stage, the records that it has not validated on this very input,
and works on those alone; records that failed are tried again, all others stay as they are.

What is open is found by digests: only those are joined, and an output is known by its file and row.
Texts are read where all of them are taken, and where some are, those alone are shuffled: Spark's
Bloom filters drop the others where they are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.sources.shared import written

ROWS = "entity_id string, input_sha256 string, output string, output_sha256 string, status string, done_at timestamp"
_KEYS = ["entity_id", "input_sha256"]
_DONE = ["entity_id", "input_sha256", "output", "output_sha256"]

#: Set while a stage works: rows that a join will not find are dropped before its shuffle, whatever the size of the tables. The filter itself is of bounded size.
_FILTERS = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g"}


@contextmanager
def _filtered(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _FILTERS}
    for k, v in _FILTERS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass
class Stage:
    """make: rows of entity_id, input_sha256, output (of the stage before, or the input) with a new output; valid: whether an output is."""

    name: str
    make: Callable[[DataFrame], DataFrame]
    valid: Callable[[Column], Column] = lambda output: output.isNotNull()


class Runner:
    """Keeps each stage's tables below a folder that all workers share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _runs(self, stage: str) -> list[str]:
        """Tables of the stage whose job was committed."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{stage}")
        system = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(place):
            return []
        runs = [f.getPath() for f in system.listStatus(place)]
        return sorted(r.toString() for r in runs if system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(r, "_SUCCESS")))

    def ledger(self, stage: str) -> DataFrame:
        """All that the stage ever did, with its name."""
        runs = self._runs(stage)
        rows = self.spark.read.schema(ROWS).parquet(*runs) if runs else self.spark.createDataFrame([], ROWS)
        return rows.withColumn("stage", F.lit(stage))

    def _placed(self, runs: list[str]) -> DataFrame:
        """Validated rows of some tables, with their file and row as one name."""
        return self.spark.read.schema(ROWS).parquet(*runs).select("*", F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias("at")).where("status = 'validated'")

    def _found(self, runs: list[str], wanted: DataFrame) -> DataFrame:
        """wanted (entity_id, input_sha256, and more) with the digest and the place of the last validated output on this very input; nulls where there is none. No text is read."""
        if not runs:
            return wanted.select("*", *[F.lit(None).cast("string").alias(c) for c in ("output_sha256", "at")])
        last = Window.partitionBy(*_KEYS).orderBy(F.desc("done_at"), F.desc("output_sha256"), "at")
        good = self._placed(runs).select(*_KEYS, "output_sha256", "at", F.row_number().over(last).alias("n")).where("n = 1").drop("n")
        return wanted.join(good, _KEYS, "left")

    def _taken(self, runs: list[str], places: DataFrame) -> DataFrame:
        """entity_id, input_sha256, output, output_sha256 of the rows at some places (a column), each as often as it is there."""
        if not runs:
            return self.spark.createDataFrame([], ROWS).select(*_DONE)
        rows, (place,) = self._placed(runs), places.columns
        n = places.count()
        if n == rows.count() and n == places.agg(F.count_distinct(place)).first()[0]:
            return rows.select(*_DONE)
        return rows.join(places.select(F.col(place).alias("wanted")), F.col("at") == F.col("wanted")).select(*_DONE)

    def outputs(self, stage: str, items: DataFrame) -> DataFrame:
        """The stage's last validated output for each of the items (entity_id, input_sha256) on this very input."""
        runs = self._runs(stage)
        return self._taken(runs, written(self._found(runs, items.select(*_KEYS)).where("at is not null").select("at"), "stage-places"))

    def run(self, items: DataFrame, stages: list[Stage]) -> DataFrame:
        """items: entity_id, output. Runs every stage on what is open; returns entity_id, input_sha256, output, output_sha256 of the last one.

        Records that a stage cannot validate go no further, and are tried again by the next run.
        """
        given = items.select("entity_id", "output").withColumn("input_sha256", tx.digest(F.col("output")))
        keys, runs = written(given.select(*_KEYS, F.lit(None).cast("string").alias("source")), "stage-keys"), None
        for stage in stages:
            before = self._runs(stage.name)
            found = written(self._found(before, keys).withColumn("state", F.when(F.col("at").isNull(), "open").otherwise("done")), "stage-records")
            todo = found.where("state = 'open'")
            if n := todo.count():
                if runs is not None:
                    work = self._taken(runs, todo.select("source")).select("entity_id", F.col("output_sha256").alias("input_sha256"), "output")
                elif n == keys.count():
                    work = given
                else:  # a struct of nulls equals another
                    work = given.join(todo.select(F.struct(*_KEYS).alias("open")), F.struct(*_KEYS) == F.col("open"), "left_semi")
                path = self._work(stage, work)
                new = self._found([path], todo.select(*_KEYS)).where("at is not null")
                done = found.where("state = 'done'").select("entity_id", "output_sha256", "at").unionByName(new.select("entity_id", "output_sha256", "at"))
                found = written(done, "stage-records")
            runs = self._runs(stage.name)
            keys = found.select("entity_id", F.col("output_sha256").alias("input_sha256"), F.col("at").alias("source"))
        return self._taken(runs, keys.select("source"))

    def _work(self, stage: Stage, todo: DataFrame) -> str:
        """Runs a stage on some records; returns the table of what it did."""
        made = stage.make(todo.select("entity_id", "input_sha256", "output")).select("entity_id", "input_sha256", "output")
        status = F.when(F.coalesce(stage.valid(F.col("output")), F.lit(False)), "validated").otherwise("failed")
        rows = made.select("entity_id", "input_sha256", "output", tx.digest(F.col("output")).alias("output_sha256"), status.alias("status"), F.current_timestamp().alias("done_at"))
        path = f"{self.folder}/{stage.name}/run-{uuid.uuid4().hex}"
        with _filtered(self.spark):
            rows.write.option("compression", "zstd").parquet(path)
        return path
