"""Incremental work: registries that only grow, and a ledger of what was done on which input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.rules import numbered_by_first
from folioforge.sources.shared import written


def extended_registry(registry: DataFrame, seen: DataFrame, *, name: str = "canonical_name", identity: str = "character_id", prefix: str = "CHAR", order: list[str]) -> DataFrame:
    """The registries of all projects with new names appended; given ids never change."""
    fresh = seen.join(registry.select("project_id", name), ["project_id", name], "left_anti")
    last = registry.groupBy("project_id").agg(F.max(F.regexp_extract(identity, r"([0-9]+)\z", 1).cast("int")).alias("last"))
    return registry.select("project_id", identity, name).unionByName(numbered_by_first(fresh, name, order, prefix, last).select("project_id", F.col("id").alias(identity), name))


def open_work(items: DataFrame, ledger: DataFrame, stage: str) -> DataFrame:
    """Items (entity_id, input_sha256) that the stage has not validated on this very input."""
    done = ledger.where((F.col("stage") == stage) & (F.col("status") == "validated")).select("entity_id", "input_sha256").distinct()
    return items.join(done, ["entity_id", "input_sha256"], "left_anti")


def _prints(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A fingerprint of each group's rows, in any order: their number and two sums of 64-bit hashes, which are added up before the shuffle."""
    row = [c for c in df.columns]
    marks = [F.col(c).isNull() for c in row]  # hashes pass over nulls
    sums = [F.sum(F.xxhash64(F.lit(seed), *row, *marks).cast("decimal(38,0)")) for seed in (1, 2)]
    return df.groupBy(*keys).agg(F.struct(F.count(F.lit(1)).alias("n"), sums[0].alias("s1"), sums[1].alias("s2")).alias(name))


def differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The keys (project_id, chapter_id, ...) of groups whose rows are not the same in two runs.

    As in a tree of digests, groups are compared from the top: by the first key, then, below those
    that differ, by the first two, and so on. Rows of equal groups are never shuffled.
    """
    x, y, found = a, b, None
    for depth in range(1, len(keys) + 1):
        level = keys[:depth]
        other = _prints(y, level, "there").select(*[F.col(k).alias(f"{k}_") for k in level], "there")
        on = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in level]
        both = _prints(x, level, "here").join(other, on, "full").where(~F.col("here").eqNullSafe(F.col("there")))
        found = written(both.select(*[F.when(F.col("here").isNotNull(), F.col(k)).otherwise(F.col(f"{k}_")).alias(k) for k in level]), "differing")
        if depth < len(keys):
            x, y = within(a, found), within(b, found)
    return found


def within(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of df whose keys are among those given; nulls are equal."""
    named = keys.select(*[F.col(k).alias(f"{k}_") for k in keys.columns])
    return df.join(named, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys.columns], "left_semi")


def differences(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of one run that the other lacks, with the side. With keys, only groups that differ are compared row by row."""
    if keys:
        found = differing(a, b, keys)
        a, b = within(a, found), within(b, found)
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))
