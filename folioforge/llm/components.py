"""Connected components of a table of links by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folioforge.llm.session import discard, written


def _lowest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    kept = down.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, *, max_rounds: int = 64) -> DataFrame:
    """links: two bigint columns. Returns (id, component), the smallest id reachable, for each linked id.

    Rounds work on a table of links only; a node with very many links is aggregated before the
    shuffle, and joins on it can be split (by sorts, never by a broadcast from the driver). Each round is written to the shared folder, and the one before it deleted.
    """
    a, b = links.columns
    edges = written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        seen = Observation()
        last, edges = edges, written(_small_star(_large_star(edges)).observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "links")
        discard(last)
        now = tuple(seen.get.values())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = written(edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()), "components")
    discard(edges)
    return out
