"""Nightly scores of a cohort: every sample by every published score, normalised within its population.

Reads the calls (lineitem by order: the sample is the order's customer, the variant the part), the samples (customer, with its nation's
region as population) and the weight tables (part: the score is the brand). Of a variant that was called twice the first call stands, and of two calls of one line number that of the lower dosage.
Writes, partitioned by population,

- ``scores``: sample_id, pgs_id, raw_score, variants_matched, match_rate, z and percentile (both among the population's samples);
- ``summary``: pgs_id, n_samples, mean, std, n_elevated (samples at least ``elevated`` deviations from the mean).

A run replaces the partitions of the populations it was asked for and no others (dynamic partition overwrite), so it can be run again
after a failure, or for one population. Raw scores are rounded before they are compared, and what is computed from them is rounded too: sums of doubles depend on
their order in the last bits, and so would ties and the files of two runs.

    python -m jobs.cohort_scores --tables s3://cohort/tables --out s3://cohort/scores
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.settings import log, main
from skein.operators import match, score, stats
from skein.session import written

DEFAULTS = {"tables": None, "out": None, "populations": [], "scores": [], "digits": 6, "elevated": 1.5}
SCORES = "sample_id long, pgs_id string, raw_score double, variants_matched long, match_rate double, z double, percentile double, population string"
SUMMARY = "pgs_id string, n_samples long, mean double, std double, n_elevated long, population string"


def samples_of(spark: SparkSession, tables: str) -> DataFrame:
    """sample_id and population, empty for customers without a nation."""
    read = lambda name: spark.read.parquet(f"{tables}/{name}.parquet")
    places = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("population"))
    return read("customer").join(places, "c_nationkey", "left").select(F.col("c_custkey").alias("sample_id"), F.coalesce("population", F.lit("")).alias("population"))


def calls_of(spark: SparkSession, tables: str, samples: DataFrame) -> DataFrame:
    """sample_id, population, variant, dosage and flip: the first call of each sample and variant."""
    orders = spark.read.parquet(f"{tables}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("sample_id")).join(samples, "sample_id")
    lines = spark.read.parquet(f"{tables}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("variant"), F.pmod(F.col("l_quantity").cast("int"), F.lit(3)).alias("dosage"), F.pmod("l_linenumber", F.lit(2)).alias("flip"))
    return match.first_wins(lines.join(orders, "l_orderkey"), ["sample_id", "variant"], ["l_orderkey", "l_linenumber", "dosage"])


def weights_of(spark: SparkSession, tables: str) -> DataFrame:
    """pgs_id, variant, weight and model of all published scores."""
    return spark.read.parquet(f"{tables}/part.parquet").select(F.col("p_brand").alias("pgs_id"), F.col("p_partkey").alias("variant"), (F.col("p_retailprice").cast("double") / 1000 - 1).alias("weight"), F.pmod("p_size", F.lit(3)).cast("int").alias("model"))


def normalised(scores: DataFrame, digits: int) -> DataFrame:
    """scores with z and percentile among the samples of a population, of which no name becomes null."""
    group = ["population", "pgs_id"]
    rounded = scores.withColumn("raw_score", F.round("raw_score", digits) + F.lit(0.0))
    out = stats.percentiles_within(stats.z_within(rounded, "raw_score", group), "raw_score", group)
    return out.withColumns({"population": F.nullif("population", F.lit("")), **{c: F.round(c, digits) + F.lit(0.0) for c in ("z", "percentile")}})


def run(spark: SparkSession, tables: str, out: str, populations: list[str] = (), scores: list[str] = (), digits: int = 6, elevated: float = 1.5) -> DataFrame:
    """Scores a cohort into out. populations and scores: which (none: all). Returns all scores under out."""
    samples = samples_of(spark, tables)
    samples = samples.where(F.col("population").isin(*populations)) if populations else samples
    weights = weights_of(spark, tables)
    weights = weights.where(F.col("pgs_id").isin(*scores)) if scores else weights
    log.info("read %d samples and %d weight rows from %s", samples.count(), weights.count(), tables)
    meta = weights.groupBy("pgs_id").agg(F.count("*").alias("num_original"))
    matched = calls_of(spark, tables, samples).join(weights, "variant")
    # Written: means, ranks and rows are each read from it, and would each match the calls anew.
    raw = written(score.weighted_scores(matched, meta, by=("sample_id", "population", "pgs_id")), "raw-scores")
    rows = normalised(raw, digits).select(*(n.split()[0] for n in SCORES.split(", ")))
    _replace(rows, f"{out}/scores")
    stored = spark.read.schema(SCORES).parquet(f"{out}/scores")
    fresh = stored.where(F.col("population").isin(*populations)) if populations else stored
    far = F.count_if(F.abs("z") >= elevated)
    summary = fresh.groupBy("population", "pgs_id").agg(F.count("*").alias("n_samples"), F.round(F.avg("raw_score"), digits).alias("mean"), F.round(F.stddev_pop("raw_score"), digits).alias("std"), far.alias("n_elevated"))
    _replace(summary.select(*(n.split()[0] for n in SUMMARY.split(", "))), f"{out}/summary")
    for r in fresh.groupBy("population").agg(F.count("*").alias("rows"), F.countDistinct("sample_id").alias("samples"), F.countDistinct("pgs_id").alias("scores")).orderBy("population").collect():  # a row for each population
        log.info("wrote %d rows of %d samples and %d scores of %s to %s/scores", r.rows, r.samples, r.scores, r.population, out)
    return stored


def _replace(rows: DataFrame, path: str) -> None:
    """Writes rows by population, in place of what these populations had. Rows are dealt by population, and adaptive execution splits those of a large one."""
    rows.hint("rebalance", "population").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("population").parquet(path)


if __name__ == "__main__":
    main("cohort_scores", run, DEFAULTS)
