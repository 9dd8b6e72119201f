"""Lenient reading of cells: null tokens, candidates in order of preference, orientation of alleles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.keys import BASES, PAIRED, complement, palindromic

#: Cells that mean nothing (fixed values).
NULL_TOKENS = (".", "", "NA", "None")
CHROMOSOME_COLUMNS = ("hm_chr", "chr_name", "chromosome")
POSITION_COLUMNS = ("hm_pos", "chr_position", "bp")
WEIGHT_COLUMNS = ("effect_weight", "weight", "beta", "or")
OTHER_ALLELE_COLUMNS = ("other_allele", "reference_allele", "hm_inferotherallele")
RSID_COLUMNS = ("rsid", "hm_rsid")


def clean(cell: Column, tokens=NULL_TOKENS) -> Column:
    """A trimmed cell, null if it is a null token."""
    return F.when(~F.trim(cell).isin(*tokens), F.trim(cell))


def no_nan(value: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def first_of(cells: list[Column]) -> Column:
    return F.coalesce(*cells) if cells else F.lit(None)


def log_odds(odds: Column) -> Column:
    """The natural logarithm of a positive odds ratio; others as they are."""
    return F.when(odds > 0, F.ln(odds)).otherwise(odds)


def weight_of(cells: dict[str, Column]) -> Column:
    """The first weight column that parses; an odds ratio as its logarithm. cells: cleaned cells by column name."""
    found = [log_odds(c.try_cast("double")) if name == "or" else c.try_cast("double") for name in WEIGHT_COLUMNS if (c := cells.get(name)) is not None]
    return first_of(found).cast("double")


def other_allele_of(cells: dict[str, Column], effect: Column) -> Column:
    """The first unambiguous other allele; else the other side of a description chr:pos:ref:alt that has the effect allele."""
    given = [F.when(~F.upper(cells[n]).contains("/"), F.upper(cells[n])) for n in OTHER_ALLELE_COLUMNS if n in cells]
    if (described := cells.get("variant_description")) is not None:
        parts = F.split(described, ":")
        ref, alt = F.upper(F.get(parts, F.lit(2))), F.upper(F.get(parts, F.lit(3)))
        given.append(F.when(F.size(parts) >= 4, F.when(effect == alt, ref).when(effect == ref, alt)))
    return first_of(given).cast("string")


def model_code(dominant: Column, recessive: Column) -> Column:
    """1 dominant, 2 recessive, 0 additive, of cells that say true."""
    yes = lambda c: F.coalesce(F.lower(c) == "true", F.lit(False))
    return F.when(yes(dominant), 1).when(yes(recessive), 2).otherwise(0)


def is_rsid(name: Column) -> Column:
    return F.coalesce(name.startswith("rs"), F.lit(False))


def orientations(effect: Column, other: Column) -> Column:
    """The ways a pair of alleles may stand in a genotype table: array of (ref, alt, flip), each pair once; empty for palindromes.

    Flip 1: the effect allele is the reference, so a dosage counts from the other side.
    """
    pair = lambda r, a, f: F.struct(r.alias("ref"), a.alias("alt"), F.lit(f).alias("flip"))
    own = [pair(other, effect, 0), pair(effect, other, 1)]
    turned = [pair(complement(other), complement(effect), 0), pair(complement(effect), complement(other), 1)]
    # Longer alleles that pair with each other stand in both strands alike.
    return F.when(palindromic(effect, other), F.slice(F.array(*own), 1, 0)).when(effect == other, F.array(own[0], turned[0])).when(complement(effect) == other, F.array(*own)).otherwise(F.array(*own, *turned))


def _wildcard_rows(base: str) -> list[tuple[str, str, int]]:
    rows: list[tuple[str, str, int]] = []
    for allele in (base, PAIRED[BASES.index(base)]):
        for other in BASES:
            if other != allele and PAIRED[BASES.index(other)] != allele:
                rows += [(other, allele, 0), (allele, other, 1)]
    return rows


def wildcards(effect: Column) -> Column:
    """Where the other allele isn't known: all pairs a single base or its complement can stand in, as orientations; null for longer alleles."""

    def table_of(base: str) -> Column:
        return F.array(*(F.struct(F.lit(r).alias("ref"), F.lit(a).alias("alt"), F.lit(f).alias("flip")) for r, a, f in _wildcard_rows(base)))

    return reduce(lambda chain, b: chain.when(effect == b, table_of(b)), BASES[1:], F.when(effect == BASES[0], table_of(BASES[0])))


def orientation_to(effect: Column, ref: Column, alt: Column) -> Column:
    """Flip of an effect allele against a known pair: 1 if it is the reference, 0 if the alternative, then the same for its complement; null if neither or if the pair is a palindrome."""
    pair = complement(effect)
    return F.when(palindromic(ref, alt), F.lit(None)).when(effect == ref, 1).when(effect == alt, 0).when(pair == ref, 1).when(pair == alt, 0)
