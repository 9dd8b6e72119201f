"""Folds, permutations, subsamples and bootstrap draws, reproducible by hashing instead of random state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(seed: int | Column, *ids: str) -> Column:
    """A reproducible random order: md5 of the seed and the ids."""
    return F.md5(F.concat_ws("-", seed if isinstance(seed, Column) else F.lit(seed), *(F.col(i).cast("string") for i in ids)).cast("binary"))


def hash_rank(df: DataFrame, by: list[str], seed: int | str | Column, unit: str, out: str, per_part: int = 100_000) -> DataFrame:
    """df with each row's place (from 1) in its group's hash order, ties by unit.

    Hashes are even, so their first digits cut each group into parts of at most about per_part
    rows; a row's place is its place in its part and the counts of the parts before it. No task
    sees more than a part of a group, and the places are those of one window over the group.
    """
    hashed = df.withColumn("_h", hash_order(seed if isinstance(seed, Column) else F.lit(seed), unit))
    # The largest group decides: a table of many draws has no more parts than its draws' rows ask for.
    digits, n = 0, (df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0) if by else df.count()
    while n > per_part * 16**digits:
        digits += 1
    if not digits:
        return hashed.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy("_h", unit))).drop("_h")
    cut = hashed.withColumn("_part", F.substring("_h", 1, digits))
    counts = cut.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_n")).drop("_n")
    inside = cut.withColumn("_inside", F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_h", unit)))
    same, names = F.col("_part") == F.col("_in_part"), [f"_by{k}" for k in range(len(by))]
    for name, c in zip(names, by):
        same &= F.col(c).eqNullSafe(F.col(name))  # null groups have places too
    before = before.select(*(F.col(c).alias(name) for name, c in zip(names, by)), F.col("_part").alias("_in_part"), "_before")
    return inside.join(before, same).withColumn(out, (F.col("_before") + F.col("_inside")).cast("int")).drop("_h", "_part", "_inside", "_before", "_in_part", *names)


def stratified_folds(df: DataFrame, label: str, unit: str, folds: int = 5, seed: int = 42, per_part: int = 100_000) -> DataFrame:
    """df with a fold number: dealt in turn within each class (null is one), in hash order."""
    return hash_rank(df, [label], seed, unit, "_rank", per_part).withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds))).drop("_rank")


def subsamples(df: DataFrame, unit: str, draws: int, share: float = 0.8, seed: int = 42) -> DataFrame:
    """(draw, unit): for each draw the share of units that come first in its order, without replacement. One row for each unit and draw."""
    units = df.select(unit).distinct()
    n = units.count()
    every = units.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    return hash_rank(every, ["draw"], F.concat_ws("/", F.lit(seed), "draw"), unit, "_rank").where(F.col("_rank") <= int(n * share)).select("draw", unit)


def permuted(df: DataFrame, unit: str, label: str, draws: int, seed: int = 100, keep: list[str] | None = None) -> DataFrame:
    """(draw, unit, label): in each draw the labels in another order, every label once. keep: columns of the unit that come with it.

    The places of units are the same in every draw, so a row for each unit meets the draws' rows. These are shuffled, not broadcast: Spark estimates
    exploded rows at the size of what they come from.
    """
    keep = keep or []
    places = hash_rank(df.select(unit, *keep), [], "place", unit, "_k")
    every = df.select(unit, label).withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    labels = hash_rank(every, ["draw"], F.concat_ws("/", F.lit(seed), "draw"), unit, "_k").select("draw", label, "_k")
    return labels.join(places.hint("shuffle_hash"), "_k").select("draw", unit, label, *keep)


def bootstrap(df: DataFrame, unit: str, draws: int, seed: int = 42) -> DataFrame:
    """(draw, unit, ...): as many rows as df has in each draw, with replacement.

    Slot k of a draw takes the row whose number is a hash of the slot modulo the count; the join
    is on that number, so draws spread evenly. Slots are shuffled, not broadcast: Spark estimates them at the size of one draw.
    """
    n = df.count()
    if not n:
        return df.withColumn("draw", F.lit(0)).select("draw", *df.columns)
    numbered = hash_rank(df, [], "number", unit, "_k").withColumn("_k", F.col("_k") - 1)
    slots = df.sparkSession.range(n).withColumnRenamed("id", "_slot").withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    pick = F.conv(F.substring(hash_order(F.concat_ws("/", F.lit(seed), "draw"), "_slot"), 1, 8), 16, 10).cast("long")
    return slots.withColumn("_k", F.pmod(pick, F.lit(n)).cast("int")).join(numbered.hint("shuffle_hash"), "_k").select("draw", *df.columns)


def null_summary(null: DataFrame, value: str, real: float, floor: float = 0.001) -> DataFrame:
    """Mean, deviation (population, at least floor), sigmas of the real value, and its p (at least 1 / n) against a null distribution."""
    out = null.agg(F.avg(value).alias("null_mean"), F.greatest(F.stddev_pop(value), F.lit(floor)).alias("null_std"), F.avg((F.col(value) >= real).cast("double")).alias("_p"), F.count("*").alias("n"))
    return out.select("null_mean", "null_std", ((F.lit(real) - F.col("null_mean")) / F.col("null_std")).alias("sigma"), F.greatest("_p", 1.0 / F.col("n")).alias("p"), "n")


def interval(df: DataFrame, value: str, by: list[str], low: float = 0.025, high: float = 0.975) -> DataFrame:
    q = F.percentile(value, F.array(F.lit(low), F.lit(high)))
    return df.groupBy(*by).agg(q.alias("_q"), F.count(value).alias("n")).select(*by, F.col("_q")[0].alias("low"), F.col("_q")[1].alias("high"), "n")
