"""Packed 64-bit keys of (chromosome, position, two strings), and what belongs to them.

A key is chromosome (8 bits), position (28), and the low 14 bits of the 32-bit FNV-1a hash of
each string. The highest bit is never set, so signed order is unsigned order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: FNV-1a, 32 bits (fixed values).
FNV_OFFSET, FNV_PRIME = 2166136261, 16777619
FIELD_BITS, POSITION_BITS = 14, 28
FIELD, MAX_POSITION = (1 << FIELD_BITS) - 1, (1 << POSITION_BITS) - 1
#: Names of chromosomes that are not their number (fixed values).
NAMED_CHROMOSOMES = {"X": 23, "Y": 24, "M": 25, "MT": 25}
BASES = "ACGT"
PAIRED = "TGCA"


def fnv1a_of(text: str) -> int:
    out = FNV_OFFSET
    for byte in text.encode():
        out = (out ^ byte) * FNV_PRIME & 0xFFFFFFFF
    return out


def fnv1a(text: Column) -> Column:
    """The 32-bit FNV-1a hash of an ASCII string, as a long. Single bases, what most alleles are, are looked up."""
    step = lambda h, k: (h.bitwiseXOR(F.ascii(F.substr(text, k, F.lit(1))).cast("long")) * F.lit(FNV_PRIME)).bitwiseAND(F.lit(0xFFFFFFFF))
    start = F.lit(FNV_OFFSET).cast("long")
    known = F
    for base in BASES:
        known = known.when(text == base, F.lit(fnv1a_of(base)).cast("long"))
    return known.when(F.length(text) > 0, F.aggregate(F.sequence(F.lit(1), F.length(text)), start, step)).when(text.isNotNull(), start)


def fnv14(text: Column) -> Column:
    return fnv1a(text).bitwiseAND(F.lit(FIELD))


def chromosome(name: Column, last: int = 25) -> Column:
    """The number of a chromosome, with or without the prefix chr; 0 if unknown or beyond last."""
    bare = F.regexp_replace(name, "^chr", "")
    number = F.when(bare.rlike("^([1-9]|1[0-9]|2[0-2])$"), bare.try_cast("int"))
    for text, code in NAMED_CHROMOSOMES.items():
        number = number.when(bare == text, F.lit(code))
    number = number.otherwise(F.lit(0))
    return F.when(number <= last, number).otherwise(F.lit(0))


def pack(chrom: Column, position: Column, first: Column, second: Column) -> Column:
    """The key of a chromosome number, a position (capped), and two 14-bit fields; 0 where the chromosome is 0."""
    key = F.shiftleft(chrom.cast("long"), 56).bitwiseOR(F.shiftleft(F.least(position.cast("long"), F.lit(MAX_POSITION)), POSITION_BITS)).bitwiseOR(F.shiftleft(first, FIELD_BITS)).bitwiseOR(second)
    return F.when(chrom == 0, F.lit(0).cast("long")).otherwise(key)


def variant_key(chrom: Column, position: Column, ref: Column, alt: Column, autosomes: bool = False) -> Column:
    return pack(chromosome(chrom, 22 if autosomes else 25), position, fnv14(ref), fnv14(alt))


def flipped_key(key: Column) -> Column:
    """The key with its two string fields exchanged."""
    upper = F.shiftleft(F.shiftright(key, 2 * FIELD_BITS), 2 * FIELD_BITS)
    first, second = F.shiftright(key, FIELD_BITS).bitwiseAND(F.lit(FIELD)), key.bitwiseAND(F.lit(FIELD))
    return upper.bitwiseOR(F.shiftleft(second, FIELD_BITS)).bitwiseOR(first)


def complement(allele: Column) -> Column:
    """The upper-cased allele with each base replaced by its pair; other letters stay."""
    return F.translate(F.upper(allele), BASES, PAIRED)


def palindromic(first: Column, second: Column) -> Column:
    """Two single bases that pair with each other: their strand can't be told."""
    return (F.length(first) == 1) & (F.length(second) == 1) & first.isin(*BASES) & (F.translate(first, BASES, PAIRED) == second)


def checksum(value: Column) -> Column:
    """md5 over a group's values in order, comma-joined. For groups that fit a row; see unordered_checksum."""
    return F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(value)), lambda x: x.cast("string")), ",").cast("binary"))


def unordered_checksum(*values: Column) -> Column:
    """An aggregate over rows in any order, without collecting them."""
    return F.bit_xor(F.xxhash64(*values))
