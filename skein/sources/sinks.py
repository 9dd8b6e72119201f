"""Writers: stores as Parquet, tables as tab-separated text, reports as JSON."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.keys import unordered_checksum
from skein.operators.score import qc_counts
from skein.session import remove

STORE_VERSION = 2
#: Of keyed stores: the same for all that are to be joined. So many tasks take part in a join, each with that share of either side.
BUCKETS = 64


def write_genotypes(genotypes: DataFrame, path: str) -> None:
    """A genotype store: by sample, sorted by key inside files, so readers of a key range skip row groups."""
    genotypes.select("sample_id", "build", "vkey", F.col("dosage").cast("double").alias("dosage"), "rsid", "chrom", "pos", "ref", "alt").repartition("sample_id", F.shiftright("vkey", 56)).sortWithinPartitions("sample_id", "vkey").write.mode("overwrite").partitionBy("sample_id").parquet(path)


def read_genotypes(spark: SparkSession, path: str, samples: list[str] | None = None) -> DataFrame:
    """A genotype store, or some of its samples: their folders only are read."""
    rows = spark.read.schema("build string, vkey long, dosage double, rsid string, chrom string, pos int, ref string, alt string, sample_id string").parquet(path)
    return rows.where(F.col("sample_id").isin(samples)) if samples is not None else rows


def write_keyed(df: DataFrame, path: str, key: str = "vkey", buckets: int = BUCKETS, dealt: bool = False) -> None:
    """A store dealt into buckets by the hash of a key, sorted in each: two such stores are joined on the key where they lie, without a shuffle.

    The table's name is only there to write it; what stays is the folder, which is replaced. The writer's schema is read from its files.
    dealt: df is repartitioned into so many by the key already.
    """
    spark, name = df.sparkSession, f"keyed_{uuid.uuid4().hex}"
    remove(spark, path)
    (df if dealt else df.repartition(buckets, key)).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def read_keyed(spark: SparkSession, path: str, key: str = "vkey", buckets: int = BUCKETS) -> DataFrame:
    """What write_keyed has written with this key and number of buckets."""
    name = f"keyed_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the frame knows its files


def write_panel(panel: DataFrame, samples: DataFrame, path: str) -> None:
    """A panel store: variants in ranges of their keys, sorted, so readers of a range skip files and row groups; its samples beside it."""
    panel.repartitionByRange("vkey").sortWithinPartitions("vkey").write.mode("overwrite").parquet(f"{path}/version={STORE_VERSION}/variants")
    samples.write.mode("overwrite").parquet(f"{path}/version={STORE_VERSION}/samples")


def read_panel(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    root = f"{path}/version={STORE_VERSION}"
    return spark.read.parquet(f"{root}/variants"), spark.read.parquet(f"{root}/samples")


def write_score_input(weights: DataFrame, path: str) -> None:
    """Weights as tab-separated text (ID, A1, WEIGHT, KEY), a folder for each score and model. weights: pgs_id, vkey, weight, flip, model, and effect, chrom and pos."""
    model = F.element_at(F.array(F.lit("additive"), F.lit("dominant"), F.lit("recessive")), F.col("model") + 1)
    rows = weights.select("pgs_id", model.alias("model"), F.concat_ws(":", "chrom", "pos").alias("ID"), F.col("effect").alias("A1"), F.col("weight").cast("string").alias("WEIGHT"), F.col("vkey").alias("KEY"))
    rows.repartition("pgs_id", "model").sortWithinPartitions("pgs_id", "model", "KEY").write.mode("overwrite").partitionBy("pgs_id", "model").option("sep", "\t").option("header", True).csv(path)


def qc_report(genotypes: DataFrame) -> DataFrame:
    """One row of counts, rates and checksums for each sample. Checksums don't depend on row order."""
    counts = qc_counts(genotypes)
    sums = genotypes.groupBy("sample_id").agg(F.first("build").alias("build"), unordered_checksum(F.col("vkey")).alias("keys_checksum"), unordered_checksum(F.col("vkey"), F.col("dosage")).alias("dosage_checksum"))
    return counts.join(sums, "sample_id")


def write_weights(weights: DataFrame, meta: DataFrame, path: str, buckets: int = 64) -> None:
    """A weight store with its meta table. Scores are dealt into buckets, which are folders."""
    bucket = F.pmod(F.xxhash64("pgs_id"), F.lit(buckets)).cast("int")
    weights.withColumn("bucket", bucket).repartition("bucket", "pgs_id").sortWithinPartitions("pgs_id", "vkey").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={STORE_VERSION}/weights")
    meta.write.mode("overwrite").parquet(f"{path}/version={STORE_VERSION}/meta")


def read_weights(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    root = f"{path}/version={STORE_VERSION}"
    return spark.read.parquet(f"{root}/weights").drop("bucket"), spark.read.parquet(f"{root}/meta")


def _text(c: Column, digits: int) -> Column:
    """A number with fixed digits, NA if missing."""
    return F.coalesce(F.format_string(f"%.{digits}f", c), F.lit("NA"))


def score_table(scores: DataFrame) -> DataFrame:
    return scores.select("sample_id", "pgs_id", _text(F.col("raw_score"), 8).alias("raw_score"), "variants_matched", "variants_total", _text(F.col("match_rate"), 6).alias("match_rate"))


def match_table(scores: DataFrame) -> DataFrame:
    return scores.select("pgs_id", "variants_total", "variants_matched", "variants_missing", _text(F.col("match_rate"), 6).alias("match_rate"))


def ancestry_table(samples: DataFrame, populations: list[str], n_pcs: int = 10) -> DataFrame:
    """samples (sample_id, pc, pop_probs, most_similar, low_confidence) as text."""
    pcs = [_text(F.get("pc", F.lit(k)), 4).alias(f"PC{k + 1}") for k in range(n_pcs)]
    probs = [_text(F.try_element_at("pop_probs", F.lit(p)), 4).alias(f"RF_P_{p}") for p in sorted(populations)]
    return samples.select("sample_id", *pcs, *probs, F.col("most_similar").alias("MostSimilarPop"), F.initcap(F.col("low_confidence").cast("string")).alias("LowConfidence"))


def adjusted_table(scores: DataFrame) -> DataFrame:
    """sample_id, pgs_id, raw_score, z_population, z_norm1, z_norm2, percentile, population as text."""
    return scores.select("sample_id", "pgs_id", _text(F.col("raw_score"), 8).alias("SUM"), _text(F.col("z_population"), 6).alias("Z_MostSimilarPop"), _text(F.col("z_norm1"), 6).alias("Z_norm1"), _text(F.col("z_norm2"), 6).alias("Z_norm2"), _text(F.col("percentile"), 4).alias("percentile_MostSimilarPop"), F.coalesce("population", F.lit("NA")).alias("MostSimilarPop"))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


class RunRecord:
    """config, benchmark and log of a run, as small text files under a path on any file system.

    Used as a context: step(name) times a part, log adds a line; both files are written at the end, also of a run that fails.
    """

    def __init__(self, spark: SparkSession, path: str, **config) -> None:
        self.spark, self.path, self.config = spark, path.rstrip("/"), config
        self.steps: dict[str, float] = {}
        self.facts: dict[str, object] = {}
        self.lines: list[str] = []

    def log(self, line: str) -> None:
        self.lines.append(f"[{time.strftime('%Y-%m-%d %H:%M:%S')}] {line}")

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        begun = time.time()
        self.log(f"{name}: begins")
        try:
            yield
        finally:
            self.steps[name] = round(time.time() - begun, 3)
            self.log(f"{name}: {self.steps[name]} s")

    def __enter__(self) -> RunRecord:
        self.begun = time.time()
        self._write("config.json", json.dumps(self.config | {"created": time.strftime("%Y-%m-%dT%H:%M:%S%z")}, default=str, indent=2))
        return self

    def __exit__(self, kind, error, _) -> None:
        if error:
            self.log(f"failed: {kind.__name__}: {error}")
        conf = self.spark.sparkContext
        about = {"timestamp": time.strftime("%Y-%m-%dT%H:%M:%S%z"), **self.config, **self.facts, "total_time_seconds": round(time.time() - self.begun, 3), "steps": self.steps, "master": conf.master, "parallelism": conf.defaultParallelism, "ok": error is None}
        self._write("benchmark.json", json.dumps(about, default=str, indent=2))
        self._write("pipeline.log", "\n".join(self.lines) + "\n")

    def _write(self, name: str, text: str) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
        out.write(text.encode())
        out.close()


def quality_table(quality: DataFrame) -> DataFrame:
    """The columns of a quality table in order, rows without an error, by id."""
    names = ["pgs_id", "total", "label", "performance", "applicability", "match_confidence", "performance_source", "trait", "method_name", "variants_number", "performance_detail", "applicability_detail", "match_detail"]
    return quality.where("error is null").select(*names).orderBy("pgs_id")
