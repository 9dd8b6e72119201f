"""Dosages: genotype expansion, dosage models, imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADDITIVE, DOMINANT, RECESSIVE = 0, 1, 2


def dosage_model(dosage: Column, flip: Column, model: Column) -> Column:
    """The dosage a weight applies to: counted from the other side where flip is 1, then by model (0 additive, 1 dominant, 2 recessive)."""
    d = F.when(flip == 1, F.lit(2.0) - dosage).otherwise(dosage.cast("double"))
    return F.when(d.isNotNull() & (model == DOMINANT), F.least(d, F.lit(1.0))).when(model == RECESSIVE, F.when(d >= 2, 1.0).when(d.isNotNull(), 0.0)).otherwise(d)


def imputed(dosage: Column, frequency: Column) -> Column:
    """A missing dosage as twice the allele's frequency."""
    return F.coalesce(dosage.cast("double"), 2.0 * frequency)


def standardised(value: Column, mean: Column, std: Column) -> Column:
    """(value - mean) / std; 0 where that is no finite number."""
    z = F.try_divide(value - mean, std)
    return F.when(z.isNull() | F.isnan(z) | (F.abs(z) == float("inf")), 0.0).otherwise(z)


def genotype_alleles(genotype: Column) -> Column:
    """The called alleles of a genotype such as 0/1 or 1|2, as strings."""
    return F.split(F.regexp_replace(F.get(F.split(genotype, ":"), F.lit(0)), r"\|", "/"), "/")


def allele_dosage(genotype: Column, number: Column, missing: str = "zero") -> Column:
    """How often an allele is called. missing: what ./. becomes, zero or null."""
    alleles = genotype_alleles(genotype)
    odd = F.exists(alleles, lambda a: ~a.rlike(r"^([0-9]+|\.)$"))
    count = F.size(F.filter(alleles, lambda a: a.try_cast("int") == number)).cast("float")
    if missing == "null":
        odd = odd | F.forall(alleles, lambda a: a == ".")
    return F.when(~odd, count)


def nonref_dosage(genotype: Column) -> Column:
    """How many called alleles are not the reference; null if any is missing."""
    alleles = genotype_alleles(genotype)
    return F.when(~F.exists(alleles, lambda a: a.try_cast("int").isNull()), F.size(F.filter(alleles, lambda a: a.try_cast("int") != 0)).cast("float"))


def expand_alternatives(variants: DataFrame, alt: str = "alt", genotype: str = "genotype", missing: str = "zero") -> DataFrame:
    """One row for each alternative allele with its number (from 1) and dosage; missing (*) and absent (.) alternatives are left out."""
    rows = variants.select(*[c for c in variants.columns if c != alt], F.posexplode(F.split(alt, ",")).alias("_k", alt))
    rows = rows.where(~F.col(alt).isin("*", ".", "")).withColumn("alt_index", F.col("_k") + 1).drop("_k")
    return rows.withColumn("dosage", allele_dosage(F.col(genotype), F.col("alt_index"), missing))
