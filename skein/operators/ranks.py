"""Exact ranks and quantiles of groups of any size.

Equal values are counted first. A group whose counts fit a task is one window; one that doesn't is cut by ranges of its values, over all
groups at once: each part is ranked by itself, and offsets from the parts' sums before it make the ranks those of the whole group. Which way is taken follows from
Spark's estimate of the table's size; results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import written

#: Tables that Spark estimates at more bytes are cut.
SPREAD_BYTES = 256 << 20


def is_large(df: DataFrame) -> bool:
    """By Spark's estimates of the tables that it is read from, as joins are estimated by products; frames that the driver has made count nothing. Nothing runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 62) > SPREAD_BYTES


def running(counts: DataFrame, by: list[str], value: str, n: str = "_n", spread: bool | None = None) -> DataFrame:
    """counts (one row for each group and value) with _upto, the sum of n of the group's values up to this one, and _all, that of all. Null groups are groups, and null values come first."""
    group = Window.partitionBy(*by)
    if not (is_large(counts) if spread is None else spread):
        return counts.withColumns({"_upto": F.sum(n).over(group.orderBy(value)), "_all": F.sum(n).over(group)})
    # Written, so that the parts are the same whenever they are read.
    parts = written(counts.repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy(*by, "_part").agg(F.sum(n).alias("_sum"))
    whole = Window.partitionBy(*by)
    before = sums.withColumns({"_before": F.sum("_sum").over(whole.orderBy("_part")) - F.col("_sum"), "_all": F.sum("_sum").over(whole)})
    names = [f"_by{k}" for k in range(len(by))]
    before = before.select(*(F.col(c).alias(x) for c, x in zip(by, names)), F.col("_part").alias("_of"), "_before", "_all")  # a row for each part and group in it
    same = F.col("_part") == F.col("_of")
    for c, x in zip(by, names):
        same &= F.col(c).eqNullSafe(F.col(x))
    inside = parts.withColumn("_inside", F.sum(n).over(Window.partitionBy("_part", *by).orderBy(value)))
    return inside.join(before, same).withColumn("_upto", F.col("_before") + F.col("_inside")).select(*counts.columns, "_upto", "_all")


def quantiles(df: DataFrame, value: str | Column, by: list[str], shares: list[float], out: str = "_q", spread: bool | None = None) -> DataFrame:
    """by and out: the quantiles of each group's known values, between two by their distance."""
    x = F.col(value) if isinstance(value, str) else value
    large = is_large(df) if spread is None else spread
    if not large:
        return df.groupBy(*by).agg(F.percentile(x, F.array(*(F.lit(s) for s in shares))).alias(out))
    counts = df.select(*by, x.cast("double").alias("_v")).where(F.col("_v").isNotNull()).groupBy(*by, "_v").agg(F.count("*").alias("_n"))
    ranked = running(counts, by, "_v", spread=True)
    at = [F.lit(s) * (F.col("_all") - 1) for s in shares]
    holds = lambda place: (F.col("_upto") - F.col("_n") <= place) & (place < F.col("_upto"))
    ends = [F.max(F.when(holds(end(p)), F.col("_v"))) for p in at for end in (F.floor, F.ceil)]
    sums = ranked.groupBy(*by).agg(F.max("_all").alias("_all"), *(e.alias(f"_e{k}") for k, e in enumerate(ends)))

    def between(k: int) -> Column:
        low, high, place = F.col(f"_e{2 * k}"), F.col(f"_e{2 * k + 1}"), at[k]
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    found = sums.select(*by, F.array(*(between(k) for k in range(len(shares)))).alias(out))
    # Groups without a known value have none.
    names = [f"_by{k}" for k in range(len(by))]
    groups = df.select(*(F.col(c).alias(x) for c, x in zip(by, names))).distinct()
    same = F.lit(True)
    for c, name in zip(by, names):
        same &= F.col(c).eqNullSafe(F.col(name))
    return groups.join(found, same, "left").select(*(F.col(x).alias(c) for c, x in zip(by, names)), out) if by else found
