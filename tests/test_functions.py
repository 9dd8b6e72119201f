"""Keys, cleaning and rules against hand-computed vectors."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.functions import clean, domains, keys, rules
from skein.operators import dosage

HASHES = {"A": 3289118412, "C": 3322673650, "G": 3255563174, "T": 3507227459, "AT": 919941448, "ACGT": 1308154766, "rs429358": 428115933, "": 2166136261}


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_fnv1a(spark):
    rows = spark.createDataFrame([(k,) for k in HASHES], "s string").select("s", keys.fnv1a(F.col("s")).alias("h"), keys.fnv14(F.col("s")).alias("l")).collect()
    assert {x.s: x.h for x in rows} == HASHES and all(x.l == x.h & 0x3FFF for x in rows)


def test_variant_key(spark):
    rows = [("19", 44908684, "T", "C"), ("chr1", 1, "A", "G"), ("X", 5, "A", "C"), ("GL1", 5, "A", "C"), ("MT", 1 << 29, "A", "C")]
    df = spark.createDataFrame(rows, "c string, p int, r string, a string")
    got = df.select(keys.variant_key(*map(F.col, "cpra")).alias("k"), keys.variant_key(*map(F.col, "cpra"), autosomes=True).alias("auto")).collect()
    assert [got[0].k, got[1].k] == [1381149369835780594, 72057594536211366] and got[3].k == 0
    assert got[2].k >> 56 == 23 and got[2].auto == 0 and got[4].k >> 56 == 25 and (got[4].k >> 28) & keys.MAX_POSITION == keys.MAX_POSITION


def test_flip_and_complement_are_involutions(spark):
    df = spark.createDataFrame([("7", p, a, b) for p, (a, b) in enumerate([("A", "C"), ("AT", "G"), ("acg", "TTT"), ("N", "*")], 1)], "c string, p int, r string, a string")
    x = df.withColumn("k", keys.variant_key(*map(F.col, "cpra"))).withColumn("f", keys.flipped_key(F.col("k")))
    for row in x.select("k", "f", keys.flipped_key(F.col("f")).alias("ff"), keys.variant_key(F.col("c"), F.col("p"), F.col("a"), F.col("r")).alias("swapped"), keys.complement(keys.complement(F.col("r"))).alias("cc"), F.upper("r").alias("u")).collect():
        assert row.k == row.ff and row.f == row.swapped and row.cc == row.u


@pytest.mark.parametrize("model, flip, want", [(0, 0, [0, 1, 2]), (0, 1, [2, 1, 0]), (1, 0, [0, 1, 1]), (1, 1, [1, 1, 0]), (2, 0, [0, 0, 1]), (2, 1, [1, 0, 0])])
def test_dosage_model(spark, model, flip, want):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "d int")
    got = [x.m for x in df.select(dosage.dosage_model(F.col("d"), F.lit(flip), F.lit(model)).alias("m")).collect()]
    assert got == [*map(float, want), None]


@pytest.mark.parametrize("genotype, zero, null", [("0/0", (0, 0), (0, 0)), ("0/1:30", (1, 0), (1, 0)), ("1/2", (1, 1), (1, 1)), ("2|2", (0, 2), (0, 2)), ("./.", (0, 0), (None, None)), ("./1", (1, 0), (1, 0)), ("0/x", (None, None), (None, None))])
def test_alternatives(spark, genotype, zero, null):
    df = spark.createDataFrame([("A", "G,T,*", genotype)], "ref string, alt string, genotype string")
    for mode, want in (("zero", zero), ("null", null)):
        assert tuple(x.dosage for x in dosage.expand_alternatives(df, missing=mode).orderBy("alt_index").collect()) == want
    whole = one(spark, d=dosage.nonref_dosage(F.lit(genotype))).d
    assert whole == {"0/0": 0, "0/1:30": 1, "1/2": 2, "2|2": 2}.get(genotype)


def test_orientations(spark):
    got = one(spark, a=clean.orientations(F.lit("A"), F.lit("G")), p=clean.orientations(F.lit("A"), F.lit("T")), s=clean.orientations(F.lit("AT"), F.lit("G")), w=clean.wildcards(F.lit("A")), x=clean.wildcards(F.lit("AC")))
    assert [tuple(x) for x in got.a] == [("G", "A", 0), ("A", "G", 1), ("C", "T", 0), ("T", "C", 1)] and got.p == [] and len(got.s) == 4 and got.x is None
    assert {"".join(map(str, x)) for x in got.w} == {"CA0", "AC1", "GA0", "AG1", "CT0", "TC1", "GT0", "TG1"}


def test_orientation_to_target(spark):
    rows = [("A", "A", "G", 1), ("A", "G", "A", 0), ("A", "T", "G", 1), ("A", "C", "T", 0), ("A", "A", "T", None), ("A", "C", "G", None), ("AT", "AT", "A", 1)]
    df = spark.createDataFrame(rows, "e string, r string, a string, want int")
    assert all(x.got == x.want for x in df.select(clean.orientation_to(F.col("e"), F.col("r"), F.col("a")).alias("got"), "want").collect())


def test_cleaning(spark):
    got = one(spark, a=clean.clean(F.lit(" NA ")), b=clean.clean(F.lit(" x")), c=clean.log_odds(F.lit(1.0)), d=clean.log_odds(F.lit(-2.0)), e=clean.no_nan(F.lit(float("nan"))), f=clean.model_code(F.lit("TRUE"), F.lit("true")), g=clean.model_code(F.lit(None).cast("string"), F.lit("True")), h=clean.model_code(F.lit("no"), F.lit(None).cast("string")))
    assert tuple(got) == (None, "x", 0.0, -2.0, None, 1, 2, 0)
    cells = {"other_allele": F.lit("A/C"), "hm_inferotherallele": F.lit(None).cast("string"), "variant_description": F.lit("1:5:g:a")}
    assert one(spark, x=clean.other_allele_of(cells, F.lit("A"))).x == "G"
    assert one(spark, x=clean.weight_of({"effect_weight": F.lit("x"), "or": F.lit("2.718281828459045")})).x == pytest.approx(1.0)


@pytest.mark.parametrize("auroc, want", [(0.53125, 2), (0.5078125, 1), (0.75, 20), (0.5, 0), (1.0, 40)])
def test_half_even(spark, auroc, want):
    null = F.lit(None).cast("double")
    x = one(spark, p=rules.performance(F.lit(auroc), null, null, F.lit(0), F.lit("x"), F.lit(None).cast("long")))
    assert (x.p.score, x.p.source) == (want, "measured")


def test_performance_order(spark):
    null = F.lit(None).cast("double")
    case = lambda *a: one(spark, p=rules.performance(*a)).p
    assert tuple(case(F.lit(0.4), F.lit(0.2), null, F.lit(12), F.lit("x"), F.lit(0))) == (32, "measured")
    assert tuple(case(null, null, F.lit(0.4), F.lit(3), F.lit("x"), F.lit(0))) == (26, "measured")
    assert tuple(case(null, null, null, F.lit(3), F.lit("x"), F.lit(0))) == (10, "partial")
    assert tuple(case(null, null, null, F.lit(None).cast("int"), F.lit("LDpred2"), F.lit(600_000))) == (28, "estimated")
    assert tuple(case(null, null, null, F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("long"))) == (5, "estimated")


def test_applicability(spark):
    dist = lambda **k: F.create_map(*(F.lit(x) for kv in k.items() for x in kv)) if k else F.lit(None).cast("map<string,double>")
    names = lambda *n: F.array(*(F.lit(x) for x in n)) if n else F.lit(None).cast("array<string>")
    case = lambda *a, **k: tuple(one(spark, p=rules.applicability(*a, **k)).p)
    assert case(dist(EUR=60.0), dist(EUR=1.0), names("European descent"), "EUR") == (12, 10, 8, 30)
    assert case(dist(), dist(), names(), "EUR") == (5, 4, 0, 9)
    assert case(dist(MAE=10.0), dist(MAO=1.0), names("multi-ancestry"), "AFR") == (6, 6, 4, 16)
    assert case(dist(AFR=90.0), dist(AFR=1.0), names("Persian"), "MID") == (3, 2, 8, 13)
    assert case(dist(SAS=90.0), dist(), names(), "CSA") == (12, 4, 0, 16) and case(dist(SAS=90.0), dist(), names(), "CSA", alias=False) == (3, 4, 0, 7)


@pytest.mark.parametrize("rate, z, points, label", [(None, None, 15, "likely"), (0.01, 1.0, 0, "discard"), (0.04, 1.0, 13, "discard"), (0.5, 4.0, 28, "confident"), (0.7, 11.0, 18, "discard"), (0.7, -7.0, 26, "likely")])
def test_confidence_and_label(spark, rate, z, points, label):
    m, s = F.lit(rate).cast("double"), F.lit(z).cast("double")
    x = one(spark, p=rules.match_confidence(m, s), l=rules.quality_label(F.lit(60 if label == "confident" else 45), m, s))
    assert (x.p, x.l) == (points, label)


@pytest.mark.parametrize("p, rank, want", [(0.70, 1, "STRONGEST"), (0.70, 2, "STRONG"), (0.70, 5, "MODERATE"), (0.29, 1, "WEAK"), (0.31, 9, "MODERATE")])
def test_strength(spark, p, rank, want):
    assert one(spark, x=rules.strength(F.lit(p), F.lit(rank))).x == want


@pytest.mark.parametrize("mean, e, n, want", [(1.5, 0, 9, "ELEVATED"), (0.3, 2, 5, "ELEVATED"), (0.29, 9, 10, "TYPICAL"), (0.0, 0, 0, "INSUFFICIENT_DATA"), (0.8, 0, 9, "MILDLY_ELEVATED"), (-0.3, 34, 100, "MILDLY_ELEVATED")])
def test_risk(spark, mean, e, n, want):
    assert one(spark, x=rules.risk_level(F.lit(mean), F.lit(e), F.lit(n))).x == want


def test_importance_and_traits(spark):
    none = F.lit(None)
    x = one(
        spark, plain=rules.importance(F.lit(-2.0), F.lit(50.0), F.lit(0.7), F.lit(1.0), F.lit(False), F.lit(False), F.array().cast("array<string>"), F.lit(1000)),
        worst=rules.importance(F.lit(1.0), none.cast("double"), none.cast("double"), none.cast("double"), F.lit(True), F.lit(True), F.array(F.lit("limited_evidence"), F.lit("no_performance_metrics")), F.lit(10)),
        trait=rules.trait_key(F.lit(" LDL level Susceptibility ")), none=rules.trait_key(F.lit("  ")))
    assert x.plain == pytest.approx(2 * 0.5 * 1.0 * 1.2) and x.worst == pytest.approx(0.1 * 0.8 * 0.85 * 0.5 * 0.3 * 0.6 * 0.5 * 0.6) and x.trait == "ldl" and x.none is None


def test_domains(spark):
    a = lambda *v: F.array(*(F.lit(x) for x in v)).cast("array<string>")
    x = one(
        spark, f=domains.domain(F.lit("Gout"), a("cardiology"), a(), F.lit("")), o=domains.domain(F.lit("None such"), a("dentistry", "andrology"), a("Cancer"), F.lit("")), c=domains.domain(F.lit(None).cast("string"), a(), a("Other trait", "Cancer"), F.lit("")),
        d=domains.domain(F.lit(None).cast("string"), a(), a(), F.lit("anthropometric")), n=domains.domain(F.lit(None).cast("string"), a("dentistry"), a(), F.lit("x")),
        s=domains.subsection(F.lit("behavior_lifestyle"), F.lit("Alcohol and SMOKing"), a(), a()), b=domains.subsection(F.lit("biomarker_lab"), F.lit("x"), a(), a("Cancer", "Inflammatory measurement")), i=domains.subsection(F.lit("imaging_structure"), F.lit(None).cast("string"), a(), a()), z=domains.subsection(F.lit("disease"), F.lit("x"), a(), a()))
    assert tuple(x) == ("Musculoskeletal", "Nephrology_Urology", "Oncology", "Endocrinology", None, "Smoking", "Inflammatory", "Brain_Structure", None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ACGTacgtN", min_size=0, max_size=6), min_size=1, max_size=20))
def test_hash_of_any_bases(spark, words):
    def plain(s):
        h = 0x811C9DC5
        for b in s.encode():
            h = (h ^ b) * 0x01000193 & 0xFFFFFFFF
        return h

    got = spark.createDataFrame(list(enumerate(words)), "i int, s string").orderBy("i").select(keys.fnv1a(F.col("s")).alias("h")).collect()
    assert [x.h for x in got] == [plain(w) for w in words]


def test_every_tier_pattern_requires_a_piece():
    """Alternations once ran over every text; a text without any of a tier's pieces can't match."""
    pieces = {p: rules.required(p) for _, ps in rules.METHOD_TIERS for p in ps}
    assert all(pieces.values()) and pieces[r"P\s*\+\s*T"] == "+" and pieces[r"variants?\s*from\s*\w+\s*et\s*al"] == "variant"
    assert [rules.required(p) for p in (r"\x41b", "a|b", "ab?c", "(a(b|c))?d", "[A-Z]", "é", "abc{0,1}d")] == ["", "", "a", "d", "", "", "ab"]
