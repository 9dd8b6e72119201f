"""Regressions of many groups at once: each round is one grouped aggregation over the rows of all groups.

A group's rows are never brought together. Sums of products are combined where rows are read; what belongs to a group is a row of small
sums, and the small linear systems are solved by expressions on it. Rounds are cut by tables, so a lost executor repeats one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.session import written

#: A pivot under this share of its diagonal counts as 0: what depends on other columns gets no coefficient.
VANISHED = 1e-12


def _sum(parts: list[Column]) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def products(xs: list[Column], weight: Column | None = None) -> list[Column]:
    """Sums of the products of columns, as a{i}_{j} for i <= j."""
    w = F.lit(1.0) if weight is None else weight
    return [F.sum(w * xs[i] * xs[j]).alias(f"a{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))]


def solved(sums: DataFrame, n: int, out: str) -> DataFrame:
    """sums with {out}0 to {out}n-1: solutions of a x = b for the symmetric a{i}_{j} and b{i} of each row, by elimination in expressions."""
    df = sums.withColumns({f"_whole{k}": F.col(f"a{k}_{k}") for k in range(n)})
    fine = [F.col(f"a{k}_{k}") > F.col(f"_whole{k}") * VANISHED for k in range(n)]
    for k in range(n):
        share = {i: F.when(fine[k], F.col(f"a{k}_{i}") / F.col(f"a{k}_{k}")).otherwise(0.0) for i in range(k + 1, n)}
        new = {f"b{i}": F.col(f"b{i}") - share[i] * F.col(f"b{k}") for i in share}
        new |= {f"a{i}_{j}": F.col(f"a{i}_{j}") - share[i] * F.col(f"a{k}_{j}") for i in share for j in range(i, n)}
        df = df.withColumns(new) if new else df
    for i in reversed(range(n)):
        left = _sum([F.col(f"b{i}"), *(-F.col(f"a{i}_{j}") * F.col(f"{out}{j}") for j in range(i + 1, n))])
        df = df.withColumn(f"{out}{i}", F.when(fine[i], left / F.col(f"a{i}_{i}")).otherwise(0.0))
    return df


def _solution(df: DataFrame, by: str, n: int, out: str, *others: Column) -> DataFrame:
    return solved(df, n, out).select(by, *(f"{out}{k}" for k in range(n)), *others)


def least_squares(rows: DataFrame, by: str, xs: list[str], y: str, out: str = "beta") -> DataFrame:
    """by and {out}0 (of the constant) to {out}k: the least-squares fit of y on xs in each group."""
    cells = [F.lit(1.0), *(F.col(x) for x in xs)]
    sums = rows.groupBy(by).agg(*products(cells), *(F.sum(x * F.col(y)).alias(f"b{k}") for k, x in enumerate(cells)))
    return _solution(sums, by, len(cells), out)


def gamma_regressions(rows: DataFrame, by: str, xs: list[str], y: str, alpha: float = 1.0, rounds: int = 200, tolerance: float = 1e-10, out: str = "gamma") -> DataFrame:
    """by and {out}0 (of the constant) to {out}k: gamma regressions with a log link of y > 0 on xs in each group, with a squared penalty alpha on all but the constant.

    Newton's method on half the mean deviance, for all groups in step: a round evaluates each group's candidate (loss, gradient, second derivatives) in one
    aggregation; one that doesn't lower its loss is tried again with half the step. Groups whose gradient has vanished leave the rounds.
    """
    n = len(xs) + 1
    cells = [F.lit(1.0), *(F.col(x) for x in xs)]
    eta = _sum([F.col(f"_t{k}") * x for k, x in enumerate(cells)])

    def evaluated(candidates: DataFrame) -> DataFrame:
        """candidates (by, _t0, ...) with their loss, largest gradient and Newton step (_d)."""
        at = rows.join(candidates, by).withColumn("_eta", eta).withColumn("_ratio", F.col(y) * F.exp(-F.col("_eta")))
        sums = at.groupBy(by, *(f"_t{k}" for k in range(n))).agg(F.count("*").alias("_n"), F.sum(F.col("_ratio") + F.col("_eta")).alias("_loss"), *products(cells, F.col("_ratio")), *(F.sum((1 - F.col("_ratio")) * x).alias(f"b{k}") for k, x in enumerate(cells)))
        penalty = lambda k: 0.0 if k == 0 else alpha
        mean = {f"a{i}_{j}": F.col(f"a{i}_{j}") / F.col("_n") + (penalty(i) if i == j else 0.0) for i in range(n) for j in range(i, n)}
        mean |= {f"b{k}": F.col(f"b{k}") / F.col("_n") + penalty(k) * F.col(f"_t{k}") for k in range(n)}
        loss = F.col("_loss") / F.col("_n") + _sum([F.lit(0.5 * penalty(k)) * F.col(f"_t{k}") * F.col(f"_t{k}") for k in range(n)])
        sums = sums.withColumns(mean).withColumns({"_loss": loss, "_far": F.greatest(*(F.abs(f"b{k}") for k in range(n)), F.lit(0.0))})
        return solved(sums, n, "_d").select(by, "_loss", "_far", *(f"_t{k}" for k in range(n)), *(f"_d{k}" for k in range(n)))

    first = rows.groupBy(by).agg(F.log(F.greatest(F.avg(y), F.lit(1e-300))).alias("_t0")).select(by, "_t0", *(F.lit(0.0).alias(f"_t{k}") for k in range(1, n)))
    state = written(evaluated(first).withColumn("_size", F.lit(1.0)), "gamma-state")
    finished = None
    for _ in range(rounds):
        moving = (F.col("_far") >= tolerance) & (F.col("_size") > 1e-8)
        done = state.where(~moving)
        finished = done if finished is None else finished.unionByName(done)
        state = state.where(moving)
        if state.isEmpty():
            break
        tried = evaluated(state.select(by, *(F.col(f"_t{k}") - F.col("_size") * F.col(f"_d{k}") for k in range(n))).toDF(by, *(f"_t{k}" for k in range(n))))
        old = state.select(by, *(F.col(c).alias(f"_old{c}") for c in state.columns if c != by))
        better = F.col("_loss") <= F.col("_old_loss") + 1e-14 * F.abs("_old_loss")  # a loss that isn't a number is no better
        columns = ["_loss", "_far", *(f"_t{k}" for k in range(n)), *(f"_d{k}" for k in range(n))]
        state = written(old.join(tried, by).select(by, *(F.when(better, F.col(c)).otherwise(F.col(f"_old{c}")).alias(c) for c in columns), F.when(better, 1.0).otherwise(F.col("_old_size") / 2).alias("_size")), "gamma-state")
    else:
        finished = finished.unionByName(state)
    return finished.select(by, *(F.col(f"_t{k}").alias(f"{out}{k}") for k in range(n)))


def normalising_fits(ref: DataFrame, n_pcs: int) -> DataFrame:
    """For each score of ref (pgs_id, score, pc): what normalises it against the samples' components.

    _center (mean score), _pc_mean and _pc_std (0 counts as 1), _beta (least squares of the centred score on standardised components),
    _deviation (of its residuals) and _gamma (gamma regression of the squared residuals, null where one is 0). Components that a sample lacks count as 0.
    """
    by, xs = "pgs_id", [f"x{k}" for k in range(n_pcs)]
    plain = ref.select(by, F.col("score").cast("double").alias("y"), *(F.coalesce(F.get("pc", F.lit(k)).cast("double"), F.lit(0.0)).alias(x) for k, x in enumerate(xs))).where("y is not null")
    moments = plain.groupBy(by).agg(F.avg("y").alias("_center"), *(F.avg(x).alias(f"_m{x}") for x in xs), *(F.stddev_pop(x).alias(f"_s{x}") for x in xs))
    moments = written(moments.withColumns({f"_s{x}": F.when(F.col(f"_s{x}") == 0, 1.0).otherwise(F.col(f"_s{x}")) for x in xs}), "moments")
    shaped = plain.join(moments, by).select(by, (F.col("y") - F.col("_center")).alias("y"), *(((F.col(x) - F.col(f"_m{x}")) / F.col(f"_s{x}")).alias(x) for x in xs))
    shaped = written(shaped, "standardised")
    betas = written(least_squares(shaped, by, xs, "y"), "betas")
    fitted = _sum([F.col("beta0"), *(F.col(f"beta{k + 1}") * F.col(x) for k, x in enumerate(xs))])
    left = shaped.join(betas, by).select(by, *xs, (F.col("y") - fitted).alias("left"))
    spread = written(left.groupBy(by).agg(F.avg("left").alias("_left_mean"), F.stddev_pop("left").alias("_deviation")), "residual-moments")
    squared = written(left.join(spread, by).select(by, *xs, F.pow(F.col("left") - F.col("_left_mean"), F.lit(2.0)).alias("y")), "squared-residuals")
    usable = squared.groupBy(by).agg(F.min("y").alias("_least")).where("_least > 0").select(by)
    gammas = gamma_regressions(squared.join(usable, by, "left_semi"), by, xs, "y")
    array = lambda prefix, names: F.array(*(F.col(f"{prefix}{k}") for k in names))
    out = moments.join(betas, by).join(spread, by).join(gammas, by, "left")
    gamma = F.when(F.col("gamma0").isNotNull(), array("gamma", range(n_pcs + 1)))
    return out.select(by, "_center", array("_m", xs).alias("_pc_mean"), array("_s", xs).alias("_pc_std"), array("beta", range(n_pcs + 1)).alias("_beta"), "_deviation", gamma.alias("_gamma"))
