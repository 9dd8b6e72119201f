"""A frozen model: module fits, forests and metadata as tables and saved models, and a patient's report from it."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import ml, stats
from skein.plans import cohort, report
from skein.sources import text

POPULATIONS = cohort.POPULATIONS


@dataclass
class Bundle:
    fits: DataFrame  # module, intercept, coefs, center, scale
    weights: DataFrame  # module, pgs_id, loading, weight
    modules: DataFrame  # module, size, mean_jaccard, primary_domain, primary_trait
    metadata: DataFrame  # see report.score_metadata
    forests: dict[str, RandomForestClassificationModel]
    drivers: DataFrame  # disease, place, feature, importance
    module_order: list
    age_mean: float
    age_std: float
    n_pcs: int = 10


def feature_names(module_order: list) -> list[str]:
    return [f"z_{m}" for m in module_order] + [f"rel_{m}" for m in module_order] + [f"RF_P_{p}" for p in POPULATIONS] + ["sex", "age"]


def feature_rows(scores: DataFrame, people: DataFrame, module_order: list, age_mean: float, age_std: float) -> DataFrame:
    """(sample_id, features): module scores, their reliabilities, population probabilities, sex (1 for M) and standardised age.

    scores: sample_id, module, z, reliability. people: sample_id, pop_probs (map), sex, age.
    """
    by_module = scores.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("module", F.struct("z", "reliability")))).alias("_m"))
    x = people.join(by_module, "sample_id", "left")
    cell = lambda m, name: F.try_element_at("_m", F.lit(m))[name]
    values = [cell(m, "z") for m in module_order] + [cell(m, "reliability") for m in module_order] + [F.try_element_at("pop_probs", F.lit(p)) for p in POPULATIONS]
    age = (F.col("age") - age_mean) / age_std if age_std > 0 else F.lit(0.0)
    return ml.features(x.withColumn("_v", F.array(*(v.cast("double") for v in values), F.when(F.col("sex") == "M", 1.0).otherwise(0.0), age.cast("double"))), ["_v"]).drop("_v", "_m")


def primary(members: DataFrame, metadata: DataFrame) -> DataFrame:
    """(module, primary_domain, primary_trait): the most common of a module's scores, of equals the first by id."""
    x = members.join(metadata.select("pgs_id", "domain", "trait"), "pgs_id", "left").withColumn("place", F.regexp_extract("pgs_id", "([0-9]+)$", 1).try_cast("long"))
    x = x.withColumn("place", F.coalesce("place", F.xxhash64("pgs_id")))
    domain = stats.most_common(x.where("domain is not null"), ["module"], "domain", "place").select("module", F.col("domain").alias("primary_domain"))
    trait = stats.most_common(x.withColumn("trait", F.coalesce("trait", F.lit(""))), ["module"], "trait", "place").select("module", F.col("trait").alias("primary_trait"))
    return members.select("module").distinct().join(domain, "module", "left").join(trait, "module", "left")


def build(ref_scores: DataFrame, ref_pcs: DataFrame, modules: DataFrame, members: DataFrame, quality: DataFrame, metadata: DataFrame, patients: DataFrame, patient_pcs: DataFrame, people: DataFrame, diseases: list[str], healthy: str = "Healthy", trees: int = 500, depth: int = 12, seed: int = 42, n_pcs: int = 10) -> Bundle:
    """Fits everything a report needs. patients: sample_id, pgs_id, z; people: sample_id, label, sex, age, pop_probs; components as columns pc1, pc2, ...."""
    columns = [f"pc{k + 1}" for k in range(n_pcs)]
    weights = cohort.module_weights(members, quality, default=0.0, scaled=False)
    fits = cohort.fit_modules(weights, ref_scores, ref_pcs, columns)
    scores = cohort.module_scores(fits, weights, patients, patient_pcs, columns)
    order = sorted(r.module for r in fits.select("module").collect())
    ages = people.agg(F.avg("age").alias("m"), F.stddev_pop("age").alias("s")).first()
    rows = feature_rows(scores, people, order, ages.m or 0.0, ages.s or 0.0)
    forests, drivers = {}, []
    for disease in sorted(diseases):
        own = rows.where(F.col("label").isin(disease, healthy)).withColumn("_y", (F.col("label") == disease).cast("double"))
        forests[disease] = ml.train_forest(own, "_y", trees, depth, seed)
        drivers += [(disease, k, name, value) for k, (name, value) in enumerate(ml.importances(forests[disease], feature_names(order), 20), 1)]
    spark = ref_scores.sparkSession
    about = modules.select(F.col("community").alias("module"), "size", "mean_jaccard").join(primary(members, metadata), "module", "left")
    return Bundle(fits, weights, about, metadata, forests, spark.createDataFrame(drivers, "disease string, place int, feature string, importance double"), order, ages.m or 0.0, ages.s or 0.0, n_pcs)


def save(bundle: Bundle, path: str) -> None:
    for name in ("fits", "weights", "modules", "metadata", "drivers"):
        getattr(bundle, name).write.mode("overwrite").parquet(f"{path}/{name}")
    for disease, model in bundle.forests.items():
        model.write().overwrite().save(f"{path}/forests/{disease}")
    about = json.dumps({"diseases": sorted(bundle.forests), "module_order": bundle.module_order, "age_mean": bundle.age_mean, "age_std": bundle.age_std, "n_pcs": bundle.n_pcs})
    bundle.fits.sparkSession.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark: SparkSession, path: str) -> Bundle:
    about = json.loads(spark.read.text(f"{path}/about").first().value)
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("fits", "weights", "modules", "metadata", "drivers")}
    forests = {d: RandomForestClassificationModel.load(f"{path}/forests/{d}") for d in about["diseases"]}
    return Bundle(**tables, forests=forests, module_order=about["module_order"], age_mean=about["age_mean"], age_std=about["age_std"], n_pcs=about["n_pcs"])


def probabilities(bundle: Bundle, rows: DataFrame) -> DataFrame:
    """(sample_id, disease, probability) of all forests."""
    out = None
    for disease, model in sorted(bundle.forests.items()):
        part = ml.probabilities(model, rows, "_p").select("sample_id", F.lit(disease).alias("disease"), F.element_at("_p", 2).alias("probability"))
        out = part if out is None else out.unionByName(part)
    return out


def module_profile(bundle: Bundle, scores: DataFrame) -> DataFrame:
    """Each sample's modules with their traits and the diseases among whose drivers they are."""
    driven = bundle.drivers.where(F.col("feature").startswith("z_")).withColumn("module", F.substring("feature", 3, 100)).groupBy("module").agg(F.sort_array(F.collect_list("disease")).alias("diseases_driven"))
    x = scores.join(bundle.modules, "module", "left").withColumn("_m", F.col("module").cast("string")).join(driven.withColumnRenamed("module", "_m"), "_m", "left")
    return x.select("sample_id", F.col("module").alias("module_id"), F.bround("z", 4).alias("z_score"), F.bround("reliability", 4).alias("reliability"), F.col("size").alias("n_pgs"), "primary_trait", "primary_domain", "mean_jaccard", F.coalesce("diseases_driven", F.array().cast("array<string>")).alias("diseases_driven"))


def driving_modules(bundle: Bundle, scores: DataFrame, z_scores: DataFrame, k: int = 10) -> DataFrame:
    """(sample_id, disease, driving_modules): of each disease's k most important features those that are modules, with members and the sample's scores."""
    top = bundle.drivers.where((F.col("place") <= k) & F.col("feature").startswith("z_")).withColumn("_m", F.substring("feature", 3, 100))
    named = bundle.weights.join(bundle.metadata.select("pgs_id", "trait", "family", "quality_label", "variants"), "pgs_id", "left")
    samples = scores.select("sample_id").distinct()
    detail = samples.crossJoin(named).join(z_scores, ["sample_id", "pgs_id"], "left")  # one row for each sample and member
    member = F.struct("pgs_id", F.bround("z", 4).alias("z_score"), "trait", "family", "quality_label", "variants", F.bround("loading", 4).alias("loading"))
    members = detail.groupBy("sample_id", "module").agg(F.sort_array(F.collect_list(member)).alias("member_pgs"))
    x = scores.withColumn("_m", F.col("module").cast("string")).join(top, "_m").join(members, ["sample_id", "module"]).join(bundle.modules, "module", "left")
    row = F.struct("place", F.col("module").alias("module_id"), F.bround("z", 4).alias("patient_z"), F.bround("importance", 4).alias("importance"), F.when(F.col("z") > 0, "elevated").otherwise("reduced").alias("direction"), F.col("size").alias("n_member_pgs"), "primary_domain", "primary_trait", "mean_jaccard", "member_pgs")
    return x.groupBy("sample_id", "disease").agg(F.transform(F.sort_array(F.collect_list(row)), lambda r: r.dropFields("place")).alias("driving_modules"))


def patient_report(bundle: Bundle, z_scores: DataFrame, people: DataFrame, nice: dict[str, str] | None = None) -> DataFrame:
    """(sample_id, report) of samples: z_scores (sample_id, pgs_id, z) and people (sample_id, pc array, pop_probs, sex, age)."""
    columns = [f"pc{k + 1}" for k in range(bundle.n_pcs)]
    pcs = people.select("sample_id", *(F.coalesce(F.get("pc", F.lit(k)), F.lit(0.0)).alias(c) for k, c in enumerate(columns)))
    scores = cohort.module_scores(bundle.fits, bundle.weights, z_scores, pcs, columns)
    found = probabilities(bundle, feature_rows(scores, people, bundle.module_order, bundle.age_mean, bundle.age_std))
    best = F.array_max(F.transform(F.map_entries("pop_probs"), lambda e: F.struct(e["value"], e["key"])))
    ancestry = F.struct(best["key"].alias("predicted_population"), F.transform_values("pop_probs", lambda _, v: F.bround(v, 4)).alias("probabilities"), F.transform("pc", lambda v: F.bround(v, 6)).alias("principal_components"))
    usable = scores.where("n_available > 0").groupBy("sample_id").agg(F.count("*").alias("modules_available"), F.bround(F.avg("reliability"), 4).alias("mean_reliability"))
    profile = people.select("sample_id", "sex", "age", ancestry.alias("ancestry")).join(usable, "sample_id", "left").fillna(0, ["modules_available", "mean_reliability"])
    return report.report(z_scores, bundle.metadata, profile, found, module_profile(bundle, scores), nice, driving_modules(bundle, scores, z_scores))


def read_patient(spark: SparkSession, job: str, sex: str, age: float) -> tuple[DataFrame, DataFrame]:
    """(z_scores, people) of one job folder; the sample is named by the folder."""
    name = job.rstrip("/").rsplit("/", 1)[-1]
    z = text.read_patient(spark, f"{job}/results/scores_adjusted.tsv").select(F.lit(name).alias("sample_id"), "pgs_id", "z")
    people = text.read_ancestry(spark, f"{job}/results/ancestry.tsv").limit(1).select(F.lit(name).alias("sample_id"), "pc", "pop_probs", F.lit(sex).alias("sex"), F.lit(float(age)).alias("age"))
    return z, people
