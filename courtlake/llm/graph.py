"""Connected components of a link table, by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import drop_stored, stored


def _minimum(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minimum(both).select("u", F.least("m", "u").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    low = _minimum(down)
    near = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every linked node: columns node, component.  `links` has long columns u and v.

    A round is two joins over the link table; the number of rounds grows with the logarithm of the longest chain.
    Every round is written to the shared folder, so that lineage stays short.  Null ends and loops are left out;
    nodes without links don't appear.
    """
    links = stored(links.select("u", "v").filter("u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        old, links = links, stored(_small_star(_large_star(links)))
        drop_stored(old)
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before is not None and tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    stars = links.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
