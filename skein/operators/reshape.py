"""Long and wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide(df: DataFrame, row: str, column: str, value: str, columns: list, sequence: str | None = None, how: str = "last") -> DataFrame:
    """One row for each row key and one column for each of columns (stated, so no pass looks for them). how: last (by sequence) or sum."""
    cell = F.sum(value) if how == "sum" else F.max_by(value, sequence) if sequence else F.max(value)
    return df.groupBy(row).pivot(column, columns).agg(cell)


def long(df: DataFrame, ids: list[str], values: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def ranked(df: DataFrame, by: list[str], order: list, out: str = "rank") -> DataFrame:
    from pyspark.sql import Window

    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def top_k_accuracy(predictions: DataFrame, unit: str, truth: str, candidate: str, p: str, ks: tuple[int, ...] = (1, 3)) -> DataFrame:
    """Share of units whose true class is among their k most probable candidates, ties in the candidates' order."""
    placed = ranked(predictions, [unit], [F.desc(p), F.col(candidate)]).where(F.col(truth) == F.col(candidate))
    units = predictions.groupBy(unit).agg(F.first(truth).alias(truth))
    joined = units.join(placed.select(unit, "rank"), unit, "left")
    return joined.agg(F.count("*").alias("n"), *(F.avg(F.coalesce((F.col("rank") <= k).cast("double"), F.lit(0.0))).alias(f"top{k}") for k in ks))
