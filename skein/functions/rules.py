"""Rule tables as ordered conditional expressions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Method names by tier, the best first (fixed values; case doesn't count).
METHOD_TIERS = (
    (20, ("PRS[-_]?CS", "LDpred", "SBayes", "DBSLMM", "PROSPER", "SDPR", "AnnoPred", "PolyFun", "SBLUP", "BOLT[-_]?LMM", "shaPRS")),
    (17, ("snpnet", "lassosum", "LASSO", r"elastic\s*net", r"penalized\s*regression", "bigstatsr", "GenoBoost", "SparSNP", r"Random\s*(?:survival\s*)?forest", "stepwise", r"Select\s*and\s*Shrink", "(?:^|[^a-zA-Z])S4(?:[^a-zA-Z]|$)")),
    (14, ("PRSice", "PRSmix", r"P\s*\+\s*T", r"C\s*\+\s*T", r"Pruning\s*(?:and|&)\s*Threshold", r"Clumping\s*(?:and|&)\s*Threshold", "CT[-_]?SLEB", "PLINK", r"LD[-_\s]*clump", r"LD[-_\s]*prun", "clump(?:ing|ed)", "pt_clump", "megaprs", "RFDiseasemetaPRS", "mJam", "GCTA[-_]?COJO")),
    (10, ("metaGRS", "MetaPRS", "PRSsum", "MultiPRS", r"integrative\s*P[GR]S", "composite", "summation")),
    (7, (r"genome[-_\s]*wide\s*signif", r"Genomewide[-\s]*signif", "GWAS", "susceptibility", "curated", "fine[-_]?mapping", r"significant\s*(?:SNP|variant)", r"Variants?\s*(?:associated|significantly)", r"risk\s*allele", r"variants?\s*from\s*\w+\s*et\s*al", "HLA", r"independent\s*(?:genome|SNP|variant)", r"Weighted\s*sum")),
)
METHOD_DEFAULT = 4
#: Population to the codes and names of its ancestries (fixed values); multi-ancestry codes.
ANCESTRY_CODES = {
    "EUR": ("EUR", "European"),
    "AFR": ("AFR", "African"),
    "EAS": ("EAS", "East Asian", "ASN", "Asian unspecified"),
    "SAS": ("SAS", "South Asian"),
    "AMR": ("AMR", "Hispanic or Latin American"),
    "MID": ("GME", "Greater Middle Eastern"),
    "OTH": (),
}
ANCESTRY_ALIASES = {"CSA": "SAS"}
MULTI_CODES = ("MAE", "MAO")
QUALITY_SUFFIXES = (" susceptibility", " level", " variation", " tendency")


def steps(value: Column, bounds: list[tuple[float, int]], otherwise: int, test=lambda v, b: v >= b) -> Column:
    """The value of the first bound that holds."""
    chain = F
    for bound, out in bounds:
        chain = chain.when(test(value, bound), F.lit(out))
    return chain.otherwise(F.lit(otherwise))


def required(pattern: str) -> str:
    """In lower case, a piece that every match of a pattern has in it, whatever its case; empty where that isn't plain to see."""
    if re.search(r"\\(?![sSwWdDbB])[A-Za-z0-9]", pattern) or not pattern.isascii():
        return ""
    rest, before = pattern, None
    while rest != before:  # groups and classes, from the inside
        before, rest = rest, re.sub(r"\[[^\[\]]*\]|\((?:\\.|[^()\\])*\)", "\\\\s", rest)
    rest = re.sub(r"(?:\\.|[^\\])(?:[?*]|\{[^}]*\})", " ", rest)
    rest = re.sub(r"\\[A-Za-z]", " ", rest).replace("\\+", "\0").replace("+", " ")
    if re.search(r"[|()\[\]{}\\?*]", rest):
        return ""
    return max(re.findall(r"[A-Za-z0-9]+|\0", rest), key=lambda x: (len(x), x == "\0"), default="").lower().replace("\0", "+")


def tier_by_pattern(text: Column, tiers=METHOD_TIERS, default: int = METHOD_DEFAULT) -> Column:
    """The best tier that has a pattern in the text: one alternation for each tier, tried only on texts that have a piece which one of its patterns requires."""
    low, found = F.lower(text), []
    for score, patterns in tiers:
        match, pieces = text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), {required(p) for p in patterns}
        found.append(F.when(match if "" in pieces else reduce(or_, (low.contains(x) for x in sorted(pieces))) & match, F.lit(score)))
    return F.coalesce(F.greatest(F.lit(default), *found), F.lit(default))


def first_keyword(text: Column, keywords: list[tuple[str, str]], otherwise: str | None) -> Column:
    """What belongs to the first keyword, in the list's order, that the text has."""
    chain = F
    for word, out in keywords:
        chain = chain.when(text.contains(word), F.lit(out))
    return chain.otherwise(F.lit(otherwise).cast("string"))


def first_mapped(items: Column, mapping: dict[str, str | None]) -> Column:
    """What the first item of an array that has one is mapped to."""
    known = {k: v for k, v in mapping.items() if v}
    if not known:
        return F.lit(None).cast("string")
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    return F.get(F.filter(F.transform(items, lambda x: F.try_element_at(table, x)), lambda x: x.isNotNull()), F.lit(0))


def performance(auroc: Column, r2: Column, odds: Column, n_evals: Column, method: Column, gwas_n: Column) -> Column:
    """struct(score, source): 0 to 40 from the best measure there is, else estimated from the method's tier."""
    n = F.coalesce(n_evals, F.lit(0))
    many = lambda s: F.when(n >= 10, F.least(F.lit(40), s + 2)).otherwise(s)
    by_auroc = F.rint(F.greatest(F.lit(0.0), F.least(F.lit(40.0), (auroc - 0.5) * 80))).cast("int")
    by_r2 = steps(r2, [(0.30, 36), (0.20, 30), (0.10, 22), (0.05, 16), (0.02, 12), (0.01, 8)], 4)
    by_odds = F
    for high, low, out in ((3.0, 0.33, 32), (2.0, 0.5, 26), (1.5, 0.67, 20), (1.3, 0.77, 14), (1.1, 0.91, 8)):
        by_odds = by_odds.when((odds >= high) | (odds <= low), F.lit(out))
    by_odds = by_odds.otherwise(F.lit(4))
    proxy = F.rint(tier_by_pattern(method) * 1.2).cast("int")
    sized = F.when(gwas_n >= 500_000, F.least(F.lit(28), proxy + 4)).when(gwas_n >= 100_000, F.least(F.lit(26), proxy + 2)).otherwise(proxy)
    value = lambda s, kind: F.struct(s.cast("int").alias("score"), F.lit(kind).alias("source"))
    return (
        F.when((auroc >= 0.5) & (auroc <= 1.0), value(many(by_auroc), "measured"))
        .when((r2 >= 0) & (r2 <= 1.0), value(many(by_r2), "measured"))
        .when(odds > 0, value(by_odds, "measured"))
        .when(n > 0, value(F.lit(10), "partial"))
        .otherwise(value(sized, "estimated"))
    )


def applicability(gwas: Column, evaluated: Column, ancestries: Column, population: str, alias: bool = True) -> Column:
    """struct(gwas, eval, cohort, score): 0 to 30 for a population, from maps of code to per cent and the names of evaluated ancestries.

    alias: populations known by another code share its ancestries.
    """
    codes = ANCESTRY_CODES.get(ANCESTRY_ALIASES.get(population, population) if alias else population, ())
    short = [c for c in codes if len(c) <= 5]
    share = lambda dist, names: sum((F.coalesce(F.try_element_at(dist, F.lit(c)), F.lit(0.0)) for c in names), F.lit(0.0))
    has = lambda dist: F.coalesce(F.size(dist) > 0, F.lit(False))
    own, multi = share(gwas, short), share(gwas, MULTI_CODES)
    by_gwas = F.when(~has(gwas), 5).when(own >= 50, 12).when(own >= 20, 9).when((own > 0) | (multi > 0), 6).otherwise(3)
    by_eval = F.when(~has(evaluated), 4).when(share(evaluated, short) > 0, 10).when(share(evaluated, MULTI_CODES) > 0, 6).otherwise(2)
    names = F.coalesce(ancestries, F.array().cast("array<string>"))
    wanted = [c.lower() for c in codes] + (["middle eastern", "persian"] if population == "MID" else [])
    hit = lambda word: F.exists(names, lambda a: F.lower(a).contains(word))
    matched = F.lit(False)
    for word in wanted:
        matched = matched | hit(word)
    by_cohort = F.when(matched, 8).when(hit("multi"), 4).otherwise(0)
    return F.struct(by_gwas.alias("gwas"), by_eval.alias("eval"), by_cohort.alias("cohort"), (by_gwas + by_eval + by_cohort).alias("score"))


def match_confidence(match_rate: Column, z: Column) -> Column:
    """0 to 30 from how much of a score was found and how far out the result lies."""
    below = lambda v, b: v < b
    cover = F.when(match_rate.isNull(), 9).otherwise(steps(match_rate, [(0.02, 0), (0.05, 1), (0.15, 4), (0.25, 7), (0.35, 10), (0.50, 13), (0.65, 16)], 18, below))
    stable = F.when(z.isNull(), 6).when(match_rate < 0.02, 0).otherwise(steps(F.abs(z), [(4, 12), (7, 8), (10, 4)], 0, lambda v, b: v <= b))
    return cover + stable


def quality_label(total: Column, match_rate: Column, z: Column) -> Column:
    """The label of a total; little coverage or a far-out result overrule it."""
    gated = F.coalesce(match_rate < 0.05, F.lit(False)) | F.coalesce(F.abs(z) > 10, F.lit(False))
    return F.when(gated, "discard").when(total >= 60, "confident").when(total >= 40, "likely").when(total >= 25, "uncertain").otherwise("discard")


def importance(z: Column, quality: Column, evidence: Column, reportable: Column, proxy: Column, technical: Column, flags: Column, variants: Column) -> Column:
    """|z| weighed by quality, evidence and reportability, less the penalties. Nulls stand for absent values."""
    has = lambda flag: F.coalesce(F.array_contains(flags, flag), F.lit(False))
    cut = lambda when, by: F.when(F.coalesce(when, F.lit(False)), F.lit(by)).otherwise(F.lit(1.0))
    base = F.abs(z) * F.greatest(F.coalesce(quality, F.lit(0.0)) / 100.0, F.lit(0.1)) * (0.3 + F.coalesce(evidence, F.lit(0.5))) * (0.5 + 0.7 * F.coalesce(reportable, F.lit(0.5)))
    return base * cut(proxy, 0.5) * cut(technical, 0.3) * cut(has("limited_evidence"), 0.6) * cut(has("no_performance_metrics"), 0.5) * cut((variants > 0) & (variants < 500), 0.6)


def direction(z: Column, up: str = "up", down: str = "down") -> Column:
    """Zero counts as down."""
    return F.when(z > 0, up).otherwise(down)


def trait_key(trait: Column) -> Column:
    """A trait's name without case and without the suffixes, wherever they stand; null if empty."""
    out = F.trim(F.lower(trait))
    for suffix in QUALITY_SUFFIXES:
        out = F.replace(out, F.lit(suffix), F.lit(""))
    return F.nullif(F.trim(out), F.lit(""))


def tier(value: Column, t1: Column, t2: Column) -> Column:
    return F.when(value >= t1, "T1").when(value >= t2, "T2").otherwise("T3")


def strength(p: Column, rank: Column) -> Column:
    """A probability's label, capped by its rank: the first has no cap, ranks to 4 at most STRONG, others at most MODERATE."""
    label = F.when(p >= 0.65, "STRONGEST").when(p >= 0.50, "STRONG").when(p >= 0.30, "MODERATE").otherwise("WEAK")
    return F.when(rank == 1, label).when(rank <= 4, F.when(label == "STRONGEST", "STRONG").otherwise(label)).otherwise(F.when(label.isin("STRONGEST", "STRONG"), "MODERATE").otherwise(label))


def risk_level(mean_z: Column, n_elevated: Column, n: Column) -> Column:
    share = F.when(n > 0, n_elevated / n)
    clear = F.abs(mean_z) >= 0.3
    return (
        F.when(n == 0, "INSUFFICIENT_DATA")
        .when((mean_z >= 1.5) | ((share >= 0.40) & clear), "ELEVATED")
        .when((mean_z >= 0.8) | ((share >= 0.33) & clear), "MILDLY_ELEVATED")
        .otherwise("TYPICAL")
    )
