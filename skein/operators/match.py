"""Matching weights to observations: fallbacks in order, first and last wins, semi-join reduction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.keys import flipped_key


def _ordered(order: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key: the first in an order that has to be unique within a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_ordered(order)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_wins(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """One row for each key: that of the highest sequence number. An aggregation, so a hot key is combined in the tasks that read it."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), sequence).alias("_row"))
    return best.select(*keys, *(F.col("_row")[c].alias(c) for c in others)).select(*df.columns)


def exact_then_fallback(weights: DataFrame, observed: DataFrame, key: str, fallback_key: str, observed_fallback: str | None = None) -> DataFrame:
    """Weights joined to observations by key, and those of the observations that no weight of the same score met by it joined by the fallback key.

    weights: pgs_id, key, fallback_key, ...; observed: key, fallback (observed_fallback), dosage. The
    result has the columns of weights, dosage and source ('key' or 'fallback').
    """
    other = observed_fallback or fallback_key
    seen = observed.where(F.col("dosage").isNotNull()).select(F.col(key).alias("_key"), F.col(other).alias("_fallback"), "dosage")
    by_key = weights.join(seen, F.col(key) == F.col("_key")).select(*weights.columns, "dosage", F.lit("key").alias("source"))
    taken = by_key.select(F.col("pgs_id").alias("_pgs"), F.col(key).alias("_taken")).distinct()
    by_fallback = weights.join(seen, F.col(fallback_key) == F.col("_fallback"))
    by_fallback = by_fallback.join(taken, (F.col("pgs_id") == F.col("_pgs")) & (F.col("_key") == F.col("_taken")), "left_anti")
    return by_key.unionByName(by_fallback.select(*weights.columns, "dosage", F.lit("fallback").alias("source")))


def exact_then_fallback_totals(weights: DataFrame, observed: DataFrame, key: str, fallback_key: str, observed_fallback: str | None = None) -> DataFrame:
    """source, pgs_id, n and total: how many rows exact_then_fallback has of each source and score, and the sum of their dosages.

    Weights and observations of equal keys are counted before they meet, so that keys that many rows share cost what the tables have, not the pairs of their rows.
    """
    other = observed_fallback or fallback_key
    seen = observed.where(F.col("dosage").isNotNull()).groupBy(F.col(key).alias("_key"), F.col(other).alias("_fallback")).agg(F.count("*").alias("_n"), F.sum("dosage").alias("_d"))
    own = weights.groupBy(F.col("pgs_id").alias("_pgs"), F.col(key).alias("_taken")).agg(F.count("*").alias("_w"))
    by_key = own.join(seen.groupBy("_key").agg(F.sum("_n").alias("_n"), F.sum("_d").alias("_d")), F.col("_taken") == F.col("_key")).select(F.lit("key").alias("source"), F.col("_pgs").alias("pgs_id"), "_w", "_n", "_d")
    named = weights.groupBy("pgs_id", F.col(fallback_key).alias("_name")).agg(F.count("*").alias("_w"))
    by_fallback = named.join(seen, F.col("_name") == F.col("_fallback")).join(own.drop("_w"), (F.col("pgs_id") == F.col("_pgs")) & (F.col("_key") == F.col("_taken")), "left_anti")
    both = by_key.unionByName(by_fallback.select(F.lit("fallback").alias("source"), "pgs_id", "_w", "_n", "_d"))
    return both.groupBy("source", "pgs_id").agg(F.sum(F.col("_w") * F.col("_n")).alias("n"), F.sum(F.col("_w") * F.col("_d")).alias("total"))


def fallback_flip(effect: Column, other: Column, ref: Column, alt: Column) -> Column:
    """Flip of a row matched by name: by the effect allele if it is one of the pair (the reference first), else by the other allele, else 0."""
    return F.when(effect == ref, 1).when(effect == alt, 0).when(other == ref, 0).when(other == alt, 1).otherwise(0)


def exact_else_flipped(panel: DataFrame, target: DataFrame, key: str = "vkey", dosage: str = "dosage") -> DataFrame:
    """panel with the target's dosage: by key, else 2 - dosage by the key with its alleles exchanged, else 0; and how it was found (exact, flip, none)."""
    t = target.groupBy(key).agg(F.first(dosage, ignorenulls=True).alias("_d"))
    exact = t.select(F.col(key).alias("_e"), F.col("_d").alias("_exact"))
    flipped = t.select(F.col(key).alias("_f"), F.col("_d").alias("_flip"))
    out = panel.join(exact, F.col(key) == F.col("_e"), "left").join(flipped, flipped_key(F.col(key)) == F.col("_f"), "left")
    how = F.when(F.col("_e").isNotNull(), "exact").when(F.col("_f").isNotNull(), "flip").otherwise("none")
    value = F.when(F.col("_e").isNotNull(), F.col("_exact")).when(F.col("_f").isNotNull(), 2.0 - F.col("_flip")).otherwise(0.0)
    return out.withColumn("matched", how).withColumn(dosage, value.cast("double")).drop("_e", "_exact", "_f", "_flip")


def reduced_to(weights: DataFrame, *others: DataFrame, key: str = "vkey") -> DataFrame:
    """The rows of weights whose key all others have: one semi join after another."""
    for other in others:
        weights = weights.join(other.select(key).distinct(), key, "left_semi")
    return weights


def not_in(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on).distinct(), on, "left_anti")


def left_default(df: DataFrame, other: DataFrame, on: list[str], defaults: dict[str, object]) -> DataFrame:
    """A left join whose missing values are defaults."""
    joined = df.join(other, on, "left")
    return joined.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in joined.columns])


def at_position(weights: DataFrame, target: DataFrame, on: tuple[str, str] = ("chrom", "pos"), condition: Column | None = None) -> DataFrame:
    """An equality join on the position with a further condition on the alleles."""
    joined = weights.join(target, list(on))
    return joined.where(condition) if condition is not None else joined
