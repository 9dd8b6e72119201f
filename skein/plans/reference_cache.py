"""Scores of the reference panel, kept by what they were computed from.

A score's reference scores depend on the panel and on those of its weight rows that panel and target both have. The digest of these rows is the
address they are stored under, within the panel's own address and a version: another target that has the same variants of a score, or the same target again, finds
them, and a changed weight, another overlap, panel or version doesn't. Looking up costs the semi joins and one aggregation over keys;
the panel's genotypes are only joined for what an anti join finds missing.

A run's new scores are written to a folder named by what was missing, then their addresses to the index, which alone says what the store has: a run that
dies before that leaves nothing that is ever read, and one that is repeated replaces its own folder. The scores of a request without a single
variant in the panel are no rows, with or without the store.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.match import reduced_to
from skein.operators.score import panel_scores
from skein.session import written

#: Of what stored scores mean; those of another version aren't read.
CACHE_VERSION = 3
SCORES = "pgs_id {0}, digest string, sample {1}, score double, batch string"
INDEX = "pgs_id {0}, digest string, batch string"


def rows_digest(*values: Column) -> Column:
    """An aggregate over rows in any order: their number, the exclusive or and the sum of their hashes."""
    h = F.xxhash64(*values)
    return F.md5(F.concat_ws("-", F.count("*").cast("string"), F.bit_xor(h).cast("string"), F.sum(h.cast("decimal(20,0)")).cast("string")).cast("binary"))


def panel_address(panel: DataFrame) -> str:
    """A panel's address, from one pass over it."""
    return panel.agg(rows_digest("vkey", "dosages", "afreq")).first()[0]


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; empty where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def reference_scores(weights: DataFrame, genotypes: DataFrame, panel: DataFrame, store: str, impute: bool = True, address: str | None = None, version: int = CACHE_VERSION) -> DataFrame:
    """pgs_id, sample, score and cached (whether it was found) of the panel, over the keys that target and panel both have.

    store: the folder of stored scores. address: of the panel, if it is known by another name than its content.
    """
    spark = weights.sparkSession
    kinds = [weights.schema["pgs_id"].dataType.simpleString(), "int"]
    root = f"{store}/version={version}/panel={address or panel_address(panel)}-{'imputed' if impute else 'called'}"
    used = written(reduced_to(weights.select("pgs_id", "vkey", "weight", "flip", "model"), genotypes.where("dosage is not null"), panel), "used-weights")
    wanted = used.groupBy("pgs_id").agg(rows_digest("vkey", "weight", "flip", "model").alias("digest"))
    index = _stored(spark, f"{root}/index", INDEX.format(*kinds)).dropDuplicates(["pgs_id", "digest"])
    # Written, since the index is about to grow.
    known = written(wanted.join(index, ["pgs_id", "digest"], "left"), "known-scores")
    missing = known.where("batch is null").select("pgs_id", "digest")
    batch = missing.agg(rows_digest("pgs_id", "digest")).first()[0]
    fresh = panel_scores(used.join(missing.select("pgs_id"), "pgs_id", "left_semi"), panel, impute=impute)
    if not missing.isEmpty():
        fresh.join(missing, "pgs_id").select("pgs_id", "digest", F.col("sample").cast("int").alias("sample"), "score").write.mode("overwrite").parquet(f"{root}/scores/batch={batch}")
        missing.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{root}/index")
    at = known.select("pgs_id", "digest", F.coalesce("batch", F.lit(batch)).alias("batch"), F.col("batch").isNotNull().alias("cached"))
    scores = _stored(spark, f"{root}/scores", SCORES.format(*kinds))
    return scores.join(at, ["pgs_id", "digest", "batch"]).select("pgs_id", "sample", "score", "cached")
