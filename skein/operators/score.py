"""Weighted scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.dosage import dosage_model, imputed


def weighted_scores(matched: DataFrame, meta: DataFrame | None = None, by: tuple[str, ...] = ("sample_id", "pgs_id")) -> DataFrame:
    """Sum of model(dosage) * weight over matched rows (weight, flip, model, dosage), how many there were, and their share of meta.num_original.

    Scores of meta without any match come out as 0. The sums are partial aggregations: a score of
    millions of rows is combined where its rows are read.
    """
    part = dosage_model(F.col("dosage"), F.coalesce(F.col("flip"), F.lit(0)), F.coalesce(F.col("model"), F.lit(0))) * F.col("weight").cast("double")
    seen = F.col("dosage").isNotNull()
    if meta is None:
        return matched.where(seen).groupBy(*by).agg(F.sum(part).alias("raw_score"), F.count("*").alias("variants_matched"))
    keys = [k for k in by if k != "pgs_id"]
    named = meta.select("pgs_id", "num_original")
    if keys:  # the result has a row for each sample and score: those without a match are put beside the others of their sample, so that matches are computed once
        sums = matched.groupBy(*by).agg(F.sum(F.when(seen, part)).alias("raw_score"), F.count(F.when(seen, 1)).alias("variants_matched"))
        whole = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.col("pgs_id").isNotNull())  # a null meets no score
        each = sums.groupBy(*keys).agg(F.collect_list(F.when(whole, F.struct("pgs_id", "raw_score", "variants_matched"))).alias("_found"))
        ids = F.broadcast(named.agg(F.collect_set("pgs_id").alias("_ids")))
        none = F.transform(F.array_except("_ids", F.transform("_found", lambda x: x["pgs_id"])), lambda i: F.struct(i.alias("pgs_id"), F.lit(None).cast("double").alias("raw_score"), F.lit(None).cast("long").alias("variants_matched")))
        out = each.crossJoin(ids).select(*keys, F.inline(F.concat("_found", none))).join(F.broadcast(named), "pgs_id")
    else:
        out = named.join(matched.where(seen).groupBy(*by).agg(F.sum(part).alias("raw_score"), F.count("*").alias("variants_matched")), list(by), "left")
    n = F.coalesce(F.col("variants_matched"), F.lit(0))
    rate = F.when(F.col("num_original") > 0, F.round(n / F.col("num_original"), 6)).otherwise(0.0)
    return out.select(*by, F.coalesce("raw_score", F.lit(0.0)).alias("raw_score"), n.alias("variants_matched"), F.col("num_original").alias("variants_total"), (F.col("num_original") - n).alias("variants_missing"), rate.alias("match_rate"))


def panel_scores(weights: DataFrame, panel: DataFrame, key: str = "vkey", impute: bool = True) -> DataFrame:
    """Scores of each sample of a panel (key, dosages array, afreq): pgs_id, sample (index), score.

    The panel holds one row for each variant, so the join moves each row once for all samples.
    impute: a missing dosage counts as twice the allele's frequency, before flip and model.
    """
    joined = weights.join(panel, key).select("pgs_id", "weight", "flip", "model", "afreq", F.posexplode("dosages").alias("sample", "d"))
    dosage = imputed(F.col("d"), F.col("afreq")) if impute else F.col("d").cast("double")
    part = dosage_model(dosage, F.col("flip"), F.col("model")) * F.col("weight").cast("double")
    return joined.groupBy("pgs_id", "sample").agg(F.coalesce(F.sum(part), F.lit(0.0)).alias("score"))


def weight_stats(weights: DataFrame, by: tuple[str, ...] = ("pgs_id",)) -> DataFrame:
    w = F.col("weight").cast("double")
    return weights.groupBy(*by).agg(F.count("*").alias("num_variants"), F.sum(w).alias("weight_sum"), F.avg(w).alias("weight_mean"), F.min(w).alias("weight_min"), F.max(w).alias("weight_max"))


def qc_counts(genotypes: DataFrame, by: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """Counts of a genotype table (dosage, rsid)."""
    d, n = F.col("dosage"), F.count("*")
    valid = F.count("dosage")
    return genotypes.groupBy(*by).agg(
        n.alias("total_variants"), valid.alias("valid_genotypes"), (n - valid).alias("missing_genotypes"), F.count_if(d == 1).alias("het"), F.count_if(d == 2).alias("hom_alt"), F.count_if(d == 0).alias("hom_ref"),
        F.count_if(F.coalesce(F.col("rsid").startswith("rs"), F.lit(False))).alias("rsid_count"), F.round(1 - valid / n, 6).alias("missingness_rate"))
