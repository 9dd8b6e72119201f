"""Connected components of an edge table, by alternating large and small stars.

No edge goes to the Spark driver; each round is written to the shared folder, so a lost executor
repeats one round at most. Minima are partial aggregations, so a hub costs one row per task there;
they are dealt anew before they join the edges, since adaptive execution splits a hub's edges only
where neither side of a join was aggregated in the same stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import remove, scratch


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u, v: long) to (node, root): each node that has an edge, and the smallest node it reaches."""
    spark = edges.sparkSession

    def keep(df: DataFrame, before: str | None) -> tuple[DataFrame, str]:
        path = scratch(spark, "stars")
        df.write.parquet(path)
        if before:
            remove(spark, before)
        return spark.read.schema("u long, v long").parquet(path), path

    current, path = keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), None)
    state = _sum(current)
    anew = lambda df: df.repartition(F.xxhash64("u", "m"))
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(anew(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(anew(lower), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        current, path = keep(small, path)
        now = _sum(current)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
