"""Statistics within groups: z-scores, percentiles, robust scales, ROC, projections, regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.ranks import is_large, quantiles, running
from skein.operators.regression import normalising_fits

MAD_SCALE = 1.4826


def guarded_z(value: Column, mean: Column, std: Column) -> Column:
    """(value - mean) / std, 0 where std is 0."""
    return F.when(std > 0, (value - mean) / std).otherwise(0.0)


def z_within(df: DataFrame, value: str, by: list[str], out: str = "z") -> DataFrame:
    """Each row's z-score in its group, by population mean and standard deviation."""
    stats = df.groupBy(*by).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    return df.join(stats, by).withColumn(out, guarded_z(F.col(value), F.col("_mean"), F.col("_std"))).drop("_mean", "_std")


def percentile_rank(n_below: Column, n_upto: Column, n: Column) -> Column:
    """Percentile of a score among n others by mean rank: those below, and those not above."""
    return 50.0 * (n_below + n_upto + F.when(n_upto > n_below, 1).otherwise(0)) / n


def percentiles_within(df: DataFrame, value: str, by: list[str], out: str = "percentile", spread: bool | None = None) -> DataFrame:
    """Each row's percentile among all rows of its group. Counts of equal values come first, so ties cost nothing. spread: see ranks.running."""
    ranked = running(df.groupBy(*by, value).agg(F.count("*").alias("_n")), by, value, spread=spread)
    rank = percentile_rank(F.col("_upto") - F.col("_n"), F.col("_upto"), F.col("_all"))
    return df.join(ranked.select(*by, value, rank.alias(out)), [*by, value])


def winsorised(df: DataFrame, value: str, by: list[str], low: float = 0.005, high: float = 0.995, out: str = "z", spread: bool | None = None) -> DataFrame:
    """Values clipped to quantiles of their group and standardised by the clipped mean and sample deviation (0 counts as 1). spread: see ranks.running."""
    bounds = quantiles(df, value, by, [low, high], spread=spread)
    clipped = df.join(bounds, by).withColumn("clipped", F.least(F.greatest(F.col(value).cast("double"), F.col("_q")[0]), F.col("_q")[1])).drop("_q")
    stats = clipped.groupBy(*by).agg(F.avg("clipped").alias("_mean"), F.stddev_samp("clipped").alias("_std"))
    std = F.when(F.coalesce(F.col("_std"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("_std"))
    return clipped.join(stats, by).withColumn(out, (F.col("clipped") - F.col("_mean")) / std).drop("_mean", "_std")


def robust_scale(df: DataFrame, value: str, by: list[str], floor: bool = True, spread: bool | None = None) -> DataFrame:
    """center (median) and scale (1.4826 times the median distance from it; the sample deviation where that is nearly 0, then 1) of each group.

    floor: whether a deviation that is nearly 0 too becomes 1. spread: see ranks.running.
    """
    large = is_large(df) if spread is None else spread
    centers = quantiles(df, value, by, [0.5], spread=large).select(*by, F.col("_q")[0].alias("center"))
    joined = df.join(centers, by)
    far = F.abs(F.col(value) - F.col("center"))
    moments = [F.first("center").alias("center"), F.stddev_samp(value).alias("_std"), F.count(value).alias("_n")]
    if large:
        mad = quantiles(joined, far, by, [0.5], spread=True).select(*by, (F.col("_q")[0] * MAD_SCALE).alias("_mad"))
        found = joined.groupBy(*by).agg(*moments).join(mad, by)
    else:
        found = joined.groupBy(*by).agg(*moments, (F.median(far) * MAD_SCALE).alias("_mad"))
    second = F.when(F.col("_n") > 1, F.col("_std")).otherwise(1.0)
    scale = F.when(F.col("_mad") >= 1e-8, F.col("_mad")).otherwise(F.when(second >= 1e-8, second).otherwise(F.lit(1.0)) if floor else second)
    return found.select(*by, "center", scale.alias("scale"))


def iqr_thresholds(df: DataFrame, value: str, by: list[str], first: float = 4.0, second: float = 2.0, spread: bool | None = None) -> DataFrame:
    """t1 and t2: so many interquartile ranges above the third quartile. spread: see ranks.running."""
    q = quantiles(df, value, by, [0.25, 0.5, 0.75], spread=spread)
    iqr = F.col("_q")[2] - F.col("_q")[0]
    return q.select(*by, (F.col("_q")[2] + first * iqr).alias("t1"), (F.col("_q")[2] + second * iqr).alias("t2"))


def with_iqr_thresholds(df: DataFrame, value: str, by: list[str], first: float = 4.0, second: float = 2.0) -> DataFrame:
    """df with t1 and t2 of its group, as iqr_thresholds has them, by a window: for groups that a task can hold, where rows lie by group already."""
    q = F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.75))).over(Window.partitionBy(*by))
    x, iqr = df.withColumn("_q", q), F.col("_q")[1] - F.col("_q")[0]
    return x.withColumns({"t1": F.col("_q")[1] + first * iqr, "t2": F.col("_q")[1] + second * iqr}).drop("_q")


def convergence(df: DataFrame, groups: list[Column], within: list[str] | None = None) -> Column:
    """How many other rows share a group key, the most over several keys; a null key has none. Windows over the keys."""
    counts = [F.when(g.isNotNull(), F.count("*").over(Window.partitionBy(*(within or []), g)) - 1).otherwise(0) for g in groups]
    return F.greatest(*counts) if len(counts) > 1 else counts[0]


def most_common(df: DataFrame, by: list[str], value: str, position: str) -> DataFrame:
    """The most frequent value of each group; of equals the one that came first."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"), F.min(position).alias("_first"))
    best = counts.groupBy(*by).agg(F.max_by(F.struct(value, "n"), F.struct(F.col("n"), -F.col("_first"))).alias("_best"))
    return best.select(*by, F.col("_best")[value].alias(value), F.col("_best")["n"].alias("n"))


def rank_auc(df: DataFrame, value: str, label: str, by: list[str], symmetric: bool = True, spread: bool | None = None) -> DataFrame:
    """Area under the ROC curve of a value for a 0/1 label in each group, ties at their mean rank; by distinct values, so the window is over counts.

    Groups of one class have no area. symmetric: the larger of the area and its complement. spread: see ranks.running.
    """
    y = F.col(label).cast("long")
    counts = df.where(F.col(value).isNotNull() & F.col(label).isNotNull()).groupBy(*by, value).agg(F.sum(y).alias("_pos"), F.count("*").alias("_n"))
    below = F.col("_upto") - F.col("_n")
    ranks = running(counts, by, value, spread=spread).withColumn("_sum", F.col("_pos") * (below + (F.col("_n") + 1) / 2))
    total = ranks.groupBy(*by).agg(F.sum("_sum").alias("_s"), F.sum("_pos").alias("n_pos"), (F.sum("_n") - F.sum("_pos")).alias("n_neg"))
    auc = (F.col("_s") - F.col("n_pos") * (F.col("n_pos") + 1) / 2) / (F.col("n_pos") * F.col("n_neg"))
    if symmetric:
        auc = F.greatest(auc, 1 - auc)
    return total.where("n_pos > 0 and n_neg > 0").select(*by, "n_pos", "n_neg", auc.alias("auc"))


def confusion(df: DataFrame, truth: Column, predicted: Column, by: list[str]) -> DataFrame:
    """Counts and rates (rounded, 0 where undefined) of a 0/1 prediction."""
    c = lambda t, p: F.count_if((truth == t) & (predicted == p))
    rate = lambda a, b: F.when(F.col(a) + F.col(b) > 0, F.round(F.try_divide(F.col(a), F.col(a) + F.col(b)), 4)).otherwise(0.0)
    out = df.groupBy(*by).agg(c(1, 1).alias("tp"), c(0, 1).alias("fp"), c(0, 0).alias("tn"), c(1, 0).alias("fn"))
    return out.select(*by, "tp", "fp", "tn", "fn", rate("tp", "fn").alias("sensitivity"), rate("tn", "fp").alias("specificity"), rate("tp", "fp").alias("ppv"))


def confusion_cells(df: DataFrame, truth: str, predicted: str, n: str = "n") -> DataFrame:
    """(truth, predicted, n) for all pairs of classes that the table has, null as a class of its own; long, since the classes aren't stated."""
    counts = df.groupBy(F.col(truth).alias("_t"), F.col(predicted).alias("_p")).agg(F.count("*").alias("_n"))
    cells = counts.select(F.col("_t").alias(truth)).distinct().crossJoin(counts.select(F.col("_p").alias(predicted)).distinct())  # the result has a row for each pair of classes
    found = cells.join(counts, F.col(truth).eqNullSafe(F.col("_t")) & F.col(predicted).eqNullSafe(F.col("_p")), "left")
    return found.select(truth, predicted, F.coalesce("_n", F.lit(0)).cast("long").alias(n))


def confusion_matrix(df: DataFrame, truth: str, predicted: str, classes: list[str]) -> DataFrame:
    """One row for each true class, one column for each predicted class, zeros filled in."""
    spark = df.sparkSession
    wide = df.groupBy(truth).pivot(predicted, classes).count()
    return spark.createDataFrame([(c,) for c in classes], f"{truth} string").join(wide, truth, "left").fillna(0, classes)


def weighted_projection(df: DataFrame, value: str, weight: str, by: list[str]) -> DataFrame:
    """Sum of value * weight over the root of the squared weights that have a value; the share of absolute weight that has one; and how many have."""
    x, w = F.col(value), F.col(weight).cast("double")
    used = F.when(x.isNotNull(), w)
    out = df.groupBy(*by).agg(F.sum(x * w).alias("_num"), F.sqrt(F.sum(used * used)).alias("_norm"), F.coalesce(F.sum(F.abs(used)), F.lit(0.0)).alias("_used"), F.sum(F.abs(w)).alias("_all"), F.count(x).alias("n_available"))
    return out.select(*by, F.when(F.col("_norm") > 0, F.col("_num") / F.col("_norm")).alias("score"), F.when(F.col("_all") > 0, F.col("_used") / F.col("_all")).otherwise(0.0).alias("reliability"), "n_available")


def simple_regression(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Slope, intercept and residual deviation (population) of y on x in each group; built-in aggregates only."""
    out = df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"), F.regr_count(y, x).alias("n"))
    left = F.greatest(F.col("_syy") - F.col("slope") * F.col("slope") * F.col("_sxx"), F.lit(0.0))
    return out.select(*by, "slope", "intercept", F.sqrt(left / F.col("n")).alias("residual_std"), "n")


def fitted_design(design: DataFrame, columns: list[str]) -> tuple[np.ndarray, int]:
    """The inverse of X'X of a design with an intercept, from one aggregation (its size is that of the columns squared)."""
    names = ["_one", *columns]
    cell = lambda c: F.lit(1.0) if c == "_one" else F.col(c).cast("double")
    row = design.agg(F.count("*"), *(F.sum(cell(a) * cell(b)) for k, a in enumerate(names) for b in names[k:])).first()
    out, at = np.zeros((len(names), len(names))), 1
    for i in range(len(names)):
        for j in range(i, len(names)):
            out[i, j] = out[j, i] = row[at] or 0.0
            at += 1
    return np.linalg.pinv(out), row[0]


def residualised(values: DataFrame, design: DataFrame, columns: list[str], value: str = "score", unit: str = "sample_id", by: str = "pgs_id") -> DataFrame:
    """values (by, unit, value) with the residual of a least-squares fit on the design's columns and an intercept, for each by.

    All groups share one design: its inverse is computed once, and each group's coefficients are
    sums, so nothing but grouped aggregation runs over the values.
    """
    inverse, _ = fitted_design(design, columns)
    joined = values.join(design.select(unit, *columns), unit)
    xs = [F.lit(1.0), *(F.col(c).cast("double") for c in columns)]
    sums = joined.groupBy(by).agg(*(F.sum(x * F.col(value)).alias(f"_xy{k}") for k, x in enumerate(xs)))
    betas = sums.select(by, *(sum((F.lit(float(inverse[i, k])) * F.col(f"_xy{k}") for k in range(len(xs))), F.lit(0.0)).alias(f"_b{i}") for i in range(len(xs))))
    fitted = sum((F.col(f"_b{k}") * x for k, x in enumerate(xs)), F.lit(0.0))
    return joined.join(betas, by).select(by, unit, value, (F.col(value) - fitted).alias("residual"))


def coefficients(values: DataFrame, design: DataFrame, columns: list[str], value: str = "score", unit: str = "sample_id", by: str = "pgs_id") -> DataFrame:
    """by, intercept and coefs (array) of the fits of residualised."""
    inverse, _ = fitted_design(design, columns)
    joined = values.join(design.select(unit, *columns), unit)
    xs = [F.lit(1.0), *(F.col(c).cast("double") for c in columns)]
    sums = joined.groupBy(by).agg(*(F.sum(x * F.col(value)).alias(f"_xy{k}") for k, x in enumerate(xs)))
    beta = lambda i: sum((F.lit(float(inverse[i, k])) * F.col(f"_xy{k}") for k in range(len(xs))), F.lit(0.0))
    return sums.select(by, beta(0).alias("intercept"), F.array(*(beta(i) for i in range(1, len(xs)))).alias("coefs"))


def percentiles_of(targets: DataFrame, ref: DataFrame, by: list[str], value: str = "score", out: str = "percentile", spread: bool | None = None) -> DataFrame:
    """targets with the percentile of their value among the reference's values of their group, null without any.

    Both sides' values are counted together and ranked by distinct values, so no target meets a reference row. spread: see ranks.running.
    """
    both = ref.select(*by, F.col(value).alias("_v"), F.lit(1).alias("_r")).unionByName(targets.select(*by, F.col(value).alias("_v"), F.lit(0).alias("_r")))
    counts = both.groupBy(*by, "_v").agg(F.sum("_r").alias("_n"))
    ranked = running(counts, by, "_v", spread=spread).where("_all > 0")
    rank = percentile_rank(F.col("_upto") - F.col("_n"), F.col("_upto"), F.col("_all"))
    return targets.join(ranked.select(*by, F.col("_v").alias(value), rank.alias(out)), [*by, value], "left")


def normalise(ref_scores: DataFrame, ref_pcs: DataFrame, targets: DataFrame, n_pcs: int = 4) -> DataFrame:
    """Scores of target samples normalised against a reference.

    ref_scores: pgs_id, sample_id, score. ref_pcs: sample_id, population, pc (array). targets:
    sample_id, pgs_id, score, population, pc. Result: sample_id, pgs_id, z_population,
    percentile, z_norm1 (by the residuals' deviation), z_norm2 (by the predicted variance). Population
    statistics are plain aggregations, the two regressions of all scores are fitted together by rounds of
    grouped aggregation, and their fits are applied to targets as expressions.
    """
    ref = ref_scores.join(ref_pcs, "sample_id")
    stats = ref.groupBy("pgs_id", "population").agg(F.avg("score").alias("_mean"), F.stddev_pop("score").alias("_std"))
    # Renamed, so that targets may come from the same tables as the reference.
    aimed = targets.select(*(F.col(c).alias(c) for c in ("sample_id", "pgs_id", "score", "population", "pc")))
    placed = percentiles_of(aimed, ref, ["pgs_id", "population"]).join(stats, ["pgs_id", "population"], "left")
    fits = normalising_fits(ref.select("pgs_id", "score", "pc"), n_pcs)
    shifted = F.zip_with(F.slice("pc", 1, n_pcs), "_pc_mean", lambda a, b: a.cast("double") - b)
    x = placed.join(fits, "pgs_id", "left").withColumn("_x", F.zip_with(shifted, "_pc_std", lambda a, b: a / b))
    at = lambda c: F.get(c, F.lit(0)) + F.aggregate(F.zip_with("_x", F.slice(c, 2, n_pcs), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    left, variance = F.col("score") - F.col("_center") - at("_beta"), F.exp(at("_gamma"))
    x = x.withColumns({"_left": left, "_variance": variance}).withColumn("z_norm1", F.when(F.col("_deviation") > 0, F.col("_left") / F.col("_deviation")).when(F.col("_deviation").isNotNull(), 0.0))
    usable = (F.col("_variance") > 0) & (F.col("_variance") < float("inf"))
    second = F.when(usable, F.col("_left") / F.sqrt("_variance")).otherwise(F.col("z_norm1"))
    return x.select("sample_id", "pgs_id", F.when(F.col("_mean").isNotNull(), guarded_z(F.col("score"), F.col("_mean"), F.col("_std"))).alias("z_population"), "percentile", "z_norm1", second.alias("z_norm2"))
