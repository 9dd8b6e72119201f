"""From calls and score files to normalised scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import ml, space, stats
from skein.operators.dosage import standardised
from skein.operators.match import exact_else_flipped, fallback_flip, first_wins, reduced_to
from skein.operators.score import panel_scores, weighted_scores
from skein.functions.keys import FIELD, FIELD_BITS
from skein.plans.reference_cache import reference_scores
from skein.sources import sinks, text


def sync_scores(spark: SparkSession, path: str, requested: list[str], target: DataFrame | None = None, store: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(weights, rsid rows, meta, status) of the requested scores from one scan of all score files.

    store: a folder the parsed rows are written to and read from, so that text is parsed once.
    status: pgs_id and ok, missing (no file), no_variants (no usable row) or no_keys (no row that stands on a key).
    """
    ids = spark.createDataFrame([(i.upper(),) for i in dict.fromkeys(requested)], "pgs_id string")
    rows = text.read_scores(spark, path).join(F.broadcast(ids), "pgs_id", "left_semi")  # the ids of one request
    if store:
        rows.write.mode("overwrite").parquet(store)
        rows = spark.read.parquet(store)
    weights = text.weight_rows(rows, target)
    meta = text.weight_meta(rows, weights)
    state = F.when(F.col("num_original").isNull(), "missing").when(F.col("num_original") == 0, "no_variants").when(F.col("num_variants") == 0, "no_keys").otherwise("ok")
    status = ids.join(meta, "pgs_id", "left").select("pgs_id", state.alias("status"))
    return weights, text.rsid_rows(rows), meta, status


def matched_rows(genotypes: DataFrame, weights: DataFrame, by_name: DataFrame | None = None) -> DataFrame:
    """Weights on the observations they meet: by key; and by rs number those whose observation no key of the score met.

    Columns: sample_id, pgs_id, vkey, dosage, weight, flip, model, source.
    """
    seen = first_wins(genotypes, ["sample_id", "vkey"], ["line_no"]) if "line_no" in genotypes.columns else genotypes
    by_key = weights.join(seen.select("sample_id", "vkey", "dosage"), "vkey").where("dosage is not null").select("sample_id", "pgs_id", "vkey", "dosage", "weight", "flip", "model", F.lit("key").alias("source"))
    if by_name is None:
        return by_key
    taken = by_key.select("sample_id", "pgs_id", "vkey").distinct()
    # A name that several observations have stands for the one of the smallest key.
    named = seen.where("rsid is not null").groupBy("sample_id", "rsid").agg(F.min("vkey").alias("vkey"), F.min_by("dosage", "vkey").alias("dosage")).where("dosage is not null")
    ref, alt = F.shiftright("vkey", FIELD_BITS).bitwiseAND(F.lit(FIELD)).cast("int"), F.col("vkey").bitwiseAND(F.lit(FIELD)).cast("int")
    more = by_name.join(named, "rsid").join(taken, ["sample_id", "pgs_id", "vkey"], "left_anti")
    flip = fallback_flip(F.col("eff14"), F.col("oth14"), ref, alt)
    return by_key.unionByName(more.select("sample_id", "pgs_id", "vkey", "dosage", "weight", flip.alias("flip"), "model", F.lit("name").alias("source")))


def score_samples(genotypes: DataFrame, weights: DataFrame, meta: DataFrame, by_name: DataFrame | None = None) -> DataFrame:
    """All scores of all samples at once."""
    return weighted_scores(matched_rows(genotypes, weights, by_name), meta)


def store_cohort(genotypes: DataFrame, weights: DataFrame, meta: DataFrame, path: str, buckets: int = sinks.BUCKETS) -> None:
    """Stores a cohort's first observations and all scores' weights by key, for score_cohort. Rows without a dosage are left out."""
    seen = first_wins(genotypes, ["sample_id", "vkey"], ["line_no"]) if "line_no" in genotypes.columns else genotypes
    sinks.write_keyed(seen.where("dosage is not null").select("sample_id", "vkey", F.col("dosage").cast("double").alias("dosage")), f"{path}/genotypes", buckets=buckets)
    sinks.write_keyed(weights.select("pgs_id", "vkey", "weight", "flip", "model"), f"{path}/weights", buckets=buckets)
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def score_cohort(spark: SparkSession, path: str, buckets: int = sinks.BUCKETS) -> DataFrame:
    """All scores of all samples of a stored cohort. Neither the genotypes nor the weights are shuffled: buckets of a key meet where they are read, and sums leave the join."""
    return score_samples(sinks.read_keyed(spark, f"{path}/genotypes", buckets=buckets), sinks.read_keyed(spark, f"{path}/weights", buckets=buckets), spark.read.parquet(f"{path}/meta"))


def score_reference(weights: DataFrame, genotypes: DataFrame, panel: DataFrame, impute: bool = True) -> DataFrame:
    """Scores of the reference panel over the keys that target and panel both have."""
    return panel_scores(reduced_to(weights, genotypes.where("dosage is not null"), panel), panel, impute=impute)


#: Of the saved form of a reference.
REFERENCE_VERSION = 4


@dataclass
class Reference:
    """What normalisation needs of a reference: its decomposition, samples and a population model. Variants and samples are tables."""

    directions: DataFrame  # vkey, mean, std, u (array)
    s: np.ndarray
    places: ml.Places
    samples: DataFrame  # sample_id, sample (index), population, pc, unrelated
    populations: list[str]
    model: RandomForestClassificationModel
    dims: int = 10

    @classmethod
    def build(cls, panel: DataFrame, samples: DataFrame, dims: int = 10, trees: int = 100, seed: int = 42) -> Reference:
        """From a panel (vkey, dosages by sample): its decomposition over blocks of variants, and a forest on the first components."""
        spark = panel.sparkSession
        s, v = space.principal_components(panel, settled=dims, seed=seed)
        places = spark.createDataFrame([(int(k), x.tolist()) for k, x in enumerate(v[:, :dims] * s[:dims])], "sample int, pc array<double>")  # a row for each sample
        located = samples.join(places, "sample")
        names = sorted(r.population for r in samples.select("population").distinct().collect())
        label = F.array_position(F.array(*(F.lit(n) for n in names)), F.col("population")) - 1
        shaped = ml.features(located.withColumns({"_pc": F.slice("pc", 1, 5), "label": label.cast("double")}), ["_pc"])
        return cls(space.directions(panel, s, v, ["vkey"]), s, ml.Places.of(v), located, names, ml.train_forest(shaped, "label", trees, 8, seed), dims)

    def save(self, path: str) -> None:
        """Writes all parts under path, by version."""
        spark, root = self.directions.sparkSession, f"{path}/version={REFERENCE_VERSION}"
        self.directions.write.mode("overwrite").parquet(f"{root}/directions")
        self.samples.write.mode("overwrite").parquet(f"{root}/samples")
        about = [(self.populations, self.dims, self.s.tolist(), self.places.n, self.places.mean.tolist(), self.places.gram.tolist())]
        spark.createDataFrame(about, "populations array<string>, dims int, s array<double>, n long, mean array<double>, gram array<array<double>>").write.mode("overwrite").parquet(f"{root}/about")
        self.model.write().overwrite().save(f"{root}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Reference:
        root = f"{path}/version={REFERENCE_VERSION}"
        about = spark.read.parquet(f"{root}/about").first()
        places = ml.Places(about.n, np.array(about["mean"]), np.array(about.gram).reshape(len(about.s), -1))
        return cls(spark.read.parquet(f"{root}/directions"), np.array(about.s), places, spark.read.parquet(f"{root}/samples"), list(about.populations), RandomForestClassificationModel.load(f"{root}/model"), about.dims)


def project(genotypes: DataFrame, reference: Reference, least: int = 1000) -> DataFrame:
    """(sample_id, pc, n_found) of target samples; samples with fewer than least of the reference's variants are left out."""
    ids = genotypes.select("sample_id").distinct()
    panel = ids.crossJoin(reference.directions.select("vkey"))  # each sample has a row for each variant
    target = genotypes.where("dosage is not null").select("sample_id", "vkey", "dosage")
    found = _by_sample(panel, target)
    enough = found.groupBy("sample_id").agg(F.count_if(F.col("matched") != "none").alias("n_found")).where(F.col("n_found") >= least)
    z = found.join(enough, "sample_id").join(reference.directions.select("vkey", "mean", "std"), "vkey").select("sample_id", "vkey", standardised(F.col("dosage"), F.col("mean"), F.col("std")).alias("w"))
    return ml.project_samples(z, reference.directions, reference.s, reference.places, variant="vkey", dims=reference.dims).join(enough, "sample_id")


def _by_sample(panel: DataFrame, target: DataFrame) -> DataFrame:
    """exact_else_flipped within each sample."""
    from skein.functions.keys import flipped_key

    t = target.groupBy("sample_id", "vkey").agg(F.first("dosage").alias("_d"))
    exact = t.select("sample_id", F.col("vkey"), F.col("_d").alias("_e"))
    flip = t.select("sample_id", flipped_key(F.col("vkey")).alias("vkey"), F.col("_d").alias("_f"))
    out = panel.join(exact, ["sample_id", "vkey"], "left").join(flip, ["sample_id", "vkey"], "left")
    how = F.when(F.col("_e").isNotNull(), "exact").when(F.col("_f").isNotNull(), "flip").otherwise("none")
    return out.withColumns({"matched": how, "dosage": F.coalesce(F.col("_e").cast("double"), 2.0 - F.col("_f").cast("double"), F.lit(0.0))})


def adjust(genotypes: DataFrame, scores: DataFrame, weights: DataFrame, panel: DataFrame, reference: Reference, least: int = 1000, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(ancestry, adjusted scores) of target samples: project, classify, score the panel, normalise. Scores without a reference stay, unadjusted.

    store: a folder of stored reference scores, so that only those are computed that no run has had before.
    """
    located = project(genotypes, reference, least)
    named = ml.classify_population(reference.model, reference.populations, located)
    panel_rows = reference_scores(weights, genotypes, panel, store) if store else score_reference(weights, genotypes, panel)
    by_sample = panel_rows.join(reference.samples.where("unrelated").select("sample", "sample_id", "population", "pc"), "sample")
    ref_scores, ref_pcs = by_sample.select("pgs_id", "sample_id", "score"), reference.samples.where("unrelated").select("sample_id", "population", "pc")
    targets = scores.join(named.select("sample_id", "pc", F.col("most_similar").alias("population")), "sample_id").select("sample_id", "pgs_id", F.col("raw_score").alias("score"), "population", "pc")
    z = stats.normalise(ref_scores, ref_pcs, targets)
    adjusted = scores.join(z, ["sample_id", "pgs_id"], "left").join(named.select("sample_id", F.col("most_similar").alias("population")), "sample_id", "left")
    return named, adjusted


def run(spark: SparkSession, vcf: str, score_files: str, requested: list[str], out: str, missing: str = "zero") -> DataFrame:
    """Calls to raw scores, with the stores, the tables and a record of the run written under out."""
    with sinks.RunRecord(spark, out, input=vcf, pgs_ids=requested, missing=missing) as record:
        with record.step("calls"):
            sinks.write_genotypes(text.read_vcf(spark, vcf, missing=missing), f"{out}/genotypes")
            genotypes = sinks.read_genotypes(spark, f"{out}/genotypes")
            sinks.write_json(sinks.qc_report(genotypes), f"{out}/qc")
            record.facts["variant_count"] = genotypes.count()
        with record.step("scores"):
            weights, by_name, meta, status = sync_scores(spark, score_files, requested, genotypes, f"{out}/score_rows")
            sinks.write_weights(weights, meta, f"{out}/weights")
            sinks.write_tsv(status, f"{out}/status")
        with record.step("scoring"):
            stored, stored_meta = sinks.read_weights(spark, f"{out}/weights")
            scores = score_samples(genotypes, stored, stored_meta, by_name)
            sinks.write_tsv(sinks.score_table(scores), f"{out}/scores")
            sinks.write_tsv(sinks.match_table(scores), f"{out}/match_rates")
    return scores


__all__ = ["Reference", "adjust", "exact_else_flipped", "matched_rows", "project", "run", "score_reference", "score_samples", "sync_scores"]
