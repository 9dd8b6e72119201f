"""Files to scores, reports and cohorts."""

import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.functions import domains
from skein.operators import resample
from skein.plans import cohort, report, scoring
from skein.sources import sinks, text
from skein.streaming import jobs

VCF = """##fileformat=VCFv4.2
##reference=GRCh38.fa
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2
chr1\t100\trs1\tA\tG\t.\t.\t.\tGT\t0/1\t1/1
1\t100\trs1b\tA\tG\t.\t.\t.\tGT\t1/1\t0/0
chr2\t200\trs2\tC\tT,G\t.\t.\t.\tGT:DP\t1|2:9\t0/0
chr3\t300\t.\tG\tA\t.\t.\t.\tGT\t./.\t0/1
chr3\tx\t.\tG\tA\t.\t.\t.\tGT\t0/1\t0/1
chrUn\t5\t.\tG\tA\t.\t.\t.\tGT\t0/1\t0/1
chr4\t400\trs4\tT\t*\t.\t.\t.\tGT\t0/1\t0/1
short\t1
"""
SCORES = """#comment
rsID\tchr_name\tchr_position\teffect_allele\tother_allele\teffect_weight\tis_dominant
rs1\t1\t100\tg\tA\t0.5\t
rs2\t2\t200\tC\tT\t1.0\ttrue
rs3\t3\t300\tT\tC\t2.0\t
rs9\t9\t900\tA\tT\t4.0\t
rs8\t8\tNA\tA\tC\t4.0\t
rs7\t7\t700\tA\tC\tx\t
"""
ALONE = """chr_name chr_position effect_allele or
1 100 G 2.718281828459045
3 300 AT 1.0
5 500 A 0.5
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "s").mkdir()
    with gzip.open(tmp_path / "calls.vcf.gz", "wt") as f:
        f.write(VCF)
    (tmp_path / "s" / "PGS000001.txt").write_text(SCORES)
    with gzip.open(tmp_path / "s" / "pgs000002_hmPOS_GRCh38.txt.gz", "wt") as f:
        f.write(ALONE)
    return tmp_path


def test_read_vcf(spark, files):
    rows = text.read_vcf(spark, str(files / "calls.vcf.gz")).orderBy("chrom", "pos", "alt").collect()
    assert [(r.chrom, r.alt, r.dosage) for r in rows] == [("chr1", "G", 1.0), ("chr2", "G", 1.0), ("chr2", "T", 1.0), ("chr3", "A", 0.0)]
    assert {(r.sample_id, r.build) for r in rows} == {("S1", "GRCh38")} and rows[0].rsid == "rs1"
    second = text.read_vcf(spark, str(files / "calls.vcf.gz"), 1, missing="null").where("chrom = 'chr1'").first()
    assert (second.sample_id, second.dosage) == ("S2", 2.0)


def test_read_scores(spark, files):
    rows = {(r.pgs_id, r.pos): r for r in text.read_scores(spark, str(files / "s")).collect() if r.pos}
    one = rows["PGS000001", 100]
    assert (one.effect, one.other, one.weight, one.model, one.rsid, one.usable) == ("G", "A", 0.5, 0, "rs1", True)
    assert rows["PGS000001", 200].model == 1 and not rows["PGS000001", 700].usable
    assert rows["PGS000002", 100].weight == pytest.approx(1.0) and rows["PGS000002", 100].other is None


def test_scoring_end_to_end(spark, files):
    out = str(files / "out")
    scores = {r.pgs_id: r for r in scoring.run(spark, str(files / "calls.vcf.gz"), str(files / "s"), ["pgs000001", "PGS000002", "PGS000009"], out).collect()}
    # rs1 0.5 * 1; rs2 flipped and dominant min(2 - 1, 1) * 1; rs3 on the other strand (A, flip 0) 0 * 2; rs9 a palindrome.
    assert scores["PGS000001"].raw_score == pytest.approx(1.5) and (scores["PGS000001"].variants_matched, scores["PGS000001"].variants_total) == (3, 4)
    # 1:100 G is the target's alternative; AT meets nothing and is no single base; 5:500 A as a wildcard meets nothing.
    assert scores["PGS000002"].raw_score == pytest.approx(1.0) and scores["PGS000002"].variants_total == 3
    status = {r.pgs_id: r.status for r in spark.read.option("sep", "\t").option("header", True).csv(f"{out}/status").collect()}
    assert status == {"PGS000001": "ok", "PGS000002": "ok", "PGS000009": "missing"}
    qc = json.loads(spark.read.text(f"{out}/qc").first().value)
    assert (qc["total_variants"], qc["het"], qc["hom_ref"], qc["rsid_count"]) == (4, 3, 1, 3)
    table = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/scores").where("pgs_id = 'PGS000001'").first()
    assert table.raw_score == "1.50000000" and table.match_rate == "0.750000"


def test_name_fallback(spark, files):
    g = text.read_vcf(spark, str(files / "calls.vcf.gz"))
    rows = spark.createDataFrame([("P", "1", 999, "G", "A", 0.5, 0, "rs1", True, 1)], "pgs_id string, chrom string, pos int, effect string, other string, weight double, model int, rsid string, usable boolean, line_no long")
    found = scoring.matched_rows(g, text.weight_rows(rows), text.rsid_rows(rows)).collect()
    assert [(r.source, r.dosage, r.flip) for r in found] == [("name", 1.0, 0)]


def test_panel_readers(spark, tmp_path):
    (tmp_path / "v").write_text("#CHROM POS ID REF ALT\nchr1\t5\tx\ta\tg,t\nbad\tline\n")
    (tmp_path / "f").write_text("#CHROM\tID\tREF\tALT\tALT_FREQS\n1\tx\tA\tG\t0.25\n")
    (tmp_path / "p").write_text("#FID IID SEX\nf1 s1 1\nf2 s2 2\n")
    (tmp_path / "sum.sscore").write_text("#FID\tIID\tP1_SUM\tP2_SUM\nf\ts1\t1.5\t2\nf\ts2\t3\tx\n")
    assert [tuple(r) for r in text.read_variants(spark, str(tmp_path / "v")).collect()] == [("1", 5, "A", "G")]
    assert [tuple(r) for r in text.read_frequencies(spark, str(tmp_path / "f")).collect()] == [("x", 0.25)]
    samples = text.read_samples(spark, str(tmp_path / "p"))
    assert [r.iid for r in samples.orderBy("line_no").collect()] == ["s1", "s2"]
    every = text.read_sums(spark, str(tmp_path / "sum.sscore"), spark.createDataFrame([("s1",), ("s9",)], "sample_id string"))
    assert {(r.sample_id, r.pgs_id): r.score for r in every.collect()} == {("s1", "P1"): 1.5, ("s1", "P2"): 2.0, ("s9", "P1"): 0.0, ("s9", "P2"): 0.0}


def _job(root, name, z):
    d = root / "jobs" / name / "results"
    d.mkdir(parents=True)
    (d / "scores_adjusted.tsv").write_text("sample_id\tpgs_id\tSUM\tZ_MostSimilarPop\tZ_norm1\tZ_norm2\tpercentile_MostSimilarPop\tMostSimilarPop\n" + "".join(f"s\tP{k}\t1\t0\t{v}\t0\t50\tEUR\n" for k, v in enumerate(z)))
    (d / "ancestry.tsv").write_text("sample_id\tPC1\tPC2\tRF_P_EUR\tRF_P_AFR\tMostSimilarPop\tLowConfidence\ns\t1.5\tx\t0.9\t0.1\tEUR\tFalse\n")


def test_jobs(spark, tmp_path):
    _job(tmp_path, "src_J1_x", ["1.5", "nan", "NA"])
    _job(tmp_path, "src_J2_x", ["2"])
    (tmp_path / "m.csv").write_text("barcode,job_id,label\nB1,J1,old\nB1,J1,new\n")
    manifest = text.read_manifest(spark, str(tmp_path / "m.csv"))
    assert manifest.first().label == "new"
    assert {(r.barcode, r.pgs_id): r.z for r in text.read_jobs(spark, str(tmp_path), manifest).collect()} == {("B1", "P0"): 1.5, ("B1", "P1"): 0.0, ("B1", "P2"): 0.0}
    assert [r.job_id for r in text.skipped_jobs(spark, str(tmp_path), manifest).collect()] == ["J2"]
    assert {r.pgs_id: r.z for r in text.read_patient(spark, str(tmp_path / "jobs/src_J2_x/results/scores_adjusted.tsv")).collect()} == {"P0": 2.0}
    a = text.read_ancestry(spark, str(tmp_path / "jobs/*/results/ancestry.tsv")).first()
    assert a.pc[:3] == [1.5, 0.0, 0.0] and a.pop_probs == {"EUR": 0.9, "AFR": 0.1} and a.low_confidence is False
    shown = sinks.ancestry_table(text.read_ancestry(spark, str(tmp_path / "jobs/*/results/ancestry.tsv")), ["EUR", "AFR"]).first()
    assert (shown.PC1, shown.RF_P_AFR, shown.LowConfidence) == ("1.5000", "0.1000", "False")


def test_stream(spark, tmp_path):
    _job(tmp_path, "src_J1_x", ["1.0", "bad"])
    rows = jobs.result_stream(spark, f"{tmp_path}/jobs/*/results/scores_adjusted.tsv")
    q = jobs.keep_latest(rows, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(60)
    assert {r.pgs_id: r.z for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {"P0": 1.0, "P1": 0.0}


def test_quality(spark, tmp_path):
    catalog = [{"id": "P1", "method_name": "LDpred", "trait_reported": "t", "variants_number": 9, "ancestry_distribution": {"gwas": {"count": 200000, "dist": {"EUR": 80}}, "eval": {"dist": {"EUR": 100}}}}, {"id": "P2"}]
    (tmp_path / "c.json").write_text(json.dumps(catalog))
    (tmp_path / "p.json").write_text(json.dumps({"P2": {"auroc_median": 0.75, "auroc_n": 3, "n_evals": 12, "eval_ancestries": ["European"]}}))
    wanted = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "pgs_id string")
    rates = spark.createDataFrame([("P2", 0.6)], "pgs_id string, match_rate double")
    out = report.score_quality(text.read_catalog(spark, str(tmp_path / "c.json")), text.read_performance(spark, str(tmp_path / "p.json")), rates, requested=wanted)
    rows = {r.pgs_id: r for r in out.collect()}
    assert (rows["P1"].performance, rows["P1"].applicability, rows["P1"].match_confidence, rows["P1"].label) == (26, 22, 15, "confident")
    assert (rows["P2"].performance, rows["P2"].applicability, rows["P2"].match_confidence, rows["P2"].label) == (22, 17, 22, "confident")
    assert rows["P2"].performance_detail == "AUROC=0.750 (3 studies), 12 evals" and rows["P2"].match_detail == "cov=60% good; Z=?"
    assert rows["P3"].label == "discard" and rows["P3"].error == "not in catalog" and rows["P3"].total is None
    assert [r.pgs_id for r in sinks.quality_table(out).collect()] == ["P1", "P2"]
    assert report.quality_summary(out).count() == 3


def _metadata(spark):
    rows = [(f"P{k}", "LDL level" if k % 2 else "Height", ["Gout", "Stroke", None][k % 3], json.dumps(["cardiology"] if k % 4 == 0 else []), json.dumps([]), ["biomarker_lab", "anthropometric", "disease"][k % 3], 1000, "LDpred", "text", 0.5, 0.5, False, False, json.dumps(["limited_evidence"] if k == 5 else [])) for k in range(24)]
    names = "pgs_id string, short_report_label string, family_primary string, organ_system_tags_json string, categories_json string, phenotype_type string, variants_number long, method_name string, plain_language_summary string, reportability_score double, catalog_evidence_score double, proxy_trait_flag boolean, technical_trait_flag boolean, quality_flags_json string"
    quality = spark.createDataFrame([(f"P{k}", 60.0, "discard" if k == 3 else "likely") for k in range(24)], "pgs_id string, total double, label string")
    return report.score_metadata(text.metadata_lists(spark.createDataFrame(rows, names)), quality)


def test_report(spark):
    z = spark.createDataFrame([("S", f"P{k}", float("nan") if k == 1 else 11.0 if k == 2 else 9.0 if k == 0 else 0.1 * k - 1) for k in range(24)], "sample_id string, pgs_id string, z double")
    profile = spark.createDataFrame([("S", "F", 40.0)], "sample_id string, sex string, age double")
    p = spark.createDataFrame([("S", "b", 0.7), ("S", "a", 0.7), ("S", "c", 0.1)], "sample_id string, disease string, probability double")
    row = report.report(z, _metadata(spark), profile, p, nice={"a": "Nice A"}).first()
    out = json.loads(row.report)
    assert out["patient"]["pgs_scored"] == 24 and out["patient"]["pgs_after_filter"] == 21 and sum(out["patient"]["tier_counts"].values()) == 21
    assert list(out["clinical_circos"]["domains"]) == list(domains.DOMAIN_ORDER)
    assert out["clinical_circos"]["domains"]["Oncology"]["risk_level"] == "INSUFFICIENT_DATA"
    top = out["clinical_circos"]["domains"]["Musculoskeletal"]["pgs"][0]
    assert top["pgs_id"] == "P0" and top["tier"] == "T1" and top["key"] == "P0.T1.elevated" and top["trait"] == "Height"
    low = [x for d in out["clinical_circos"]["domains"].values() for x in d.get("pgs", []) if x["tier"] == "T3"]
    assert low and all("trait" not in x for x in low)
    assert [(x["disease"], x["strength"]) for x in out["disease_similarity"]["ranking"]] == [("a", "STRONGEST"), ("b", "STRONG"), ("c", "WEAK")]
    assert out["phenotype_landscapes"]["anthropometric"]["n_pgs"] == sum(s["n_pgs"] for s in out["phenotype_landscapes"]["anthropometric"]["subsections"].values())
    assert set(out["suggested_monitoring"]["recommendations"]) <= set(out["suggested_monitoring"]["elevated_domains"])

def test_report_computes_tiers_once(spark):
    """What the report reads is stored by sample: neither metadata nor tiers are computed again for a section."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    meta = _metadata(spark)
    z = spark.createDataFrame([(s, f"P{k}", 0.3 * k - 2 + 0.1 * len(s or "")) for s in ("S", "TT", None) for k in range(20)], "sample_id string, pgs_id string, z double")
    profile = spark.createDataFrame([("S", "F"), ("TT", "M")], "sample_id string, sex string")
    counted = meta.mapInArrow(count, meta.schema)
    out = {r.sample_id: json.loads(r.report) for r in report.report(z, counted, profile).collect()}
    assert seen.value == meta.count() and set(out) == {"S", "TT"}
    tiers = [(r.sample_id, r.tier) for r in report.tiers(report.kept_scores(z, meta)).collect()]
    for s, r in out.items():
        assert r["patient"]["tier_counts"] == {t: tiers.count((s, t)) for t in ("T1", "T2", "T3")}


def test_tier_convergence(spark):
    z = spark.createDataFrame([("S", f"P{k}", 1.0 if k < 12 else -1.0) for k in range(24)], "sample_id string, pgs_id string, z double")
    rows = {r.pgs_id: r for r in report.tiers(report.kept_scores(z, _metadata(spark))).collect()}
    assert "P3" not in rows
    up = [k for k in range(12) if k != 3]
    family, trait = sum(k % 3 == 0 for k in up) - 1, sum(k % 2 == 0 for k in up) - 1
    assert rows["P0"].convergence == max(family, trait)


@pytest.fixture(scope="module")
def reference(spark):
    rng = np.random.default_rng(8)
    n, m = 36, 240
    freq = np.where(np.arange(m)[:, None] % 2 == np.repeat([0, 1, 0], n // 3)[None, :], 0.7, 0.2)
    return rng.binomial(2, freq).astype(float), n, m


def test_ancestry(spark, reference, tmp_path):
    d, n, m = reference
    from skein.functions.keys import variant_key

    pos = spark.createDataFrame([(k, "1", 10 + k, "A", "G") for k in range(m)], "variant_index int, chrom string, pos int, ref string, alt string").withColumn("vkey", variant_key(*map(F.col, ("chrom", "pos", "ref", "alt"))))
    keys = {r.variant_index: r.vkey for r in pos.collect()}
    samples = spark.createDataFrame([(k, f"r{k}", ["EUR", "AFR", "EUR"][k * 3 // n], True) for k in range(n)], "sample int, sample_id string, population string, unrelated boolean")
    panel = spark.createDataFrame([(keys[k], [int(x) for x in d[k]], float(d[k].mean() / 2)) for k in range(m)], "vkey long, dosages array<int>, afreq double")
    ref = scoring.Reference.build(panel, samples, dims=4, trees=20)
    g = spark.createDataFrame([("t", keys[k], float(d[k, 15]), None) for k in range(m)], "sample_id string, vkey long, dosage float, rsid string")
    w = spark.createDataFrame([("p", keys[k], 0.1 * ((k % 5) - 2), 0, 0) for k in range(m)], "pgs_id string, vkey long, weight double, flip int, model int")
    meta = spark.createDataFrame([("p", m)], "pgs_id string, num_original long")
    scores = scoring.score_samples(g, w, meta)
    ref.save(str(tmp_path / "ref"))
    ref = scoring.Reference.load(spark, str(tmp_path / "ref"))
    named, adjusted = scoring.adjust(g, scores, w, panel, ref, least=100)
    who, row = named.first(), adjusted.first()
    assert who.most_similar == "AFR" and who.n_found == m and len(who.pc) == 4
    want = (d * (0.1 * ((np.arange(m) % 5) - 2))[:, None]).sum(0)
    own = want[12:24]
    assert row.raw_score == pytest.approx(want[15]) and row.z_population == pytest.approx((want[15] - own.mean()) / own.std()) and np.isfinite(row.z_norm1) and np.isfinite(row.z_norm2)
    assert sinks.adjusted_table(adjusted).first().MostSimilarPop == "AFR"
    assert scoring.project(g, ref, least=10_000).count() == 0


def test_stored_cohort_is_scored_without_a_shuffle(spark, tmp_path):
    rng = np.random.default_rng(5)
    genotypes = spark.createDataFrame([(f"s{i}", int(k), float(rng.integers(0, 3)) if rng.random() > 0.1 else None, line) for i in range(5) for k in range(40) for line in (1, 2)], "sample_id string, vkey long, dosage double, line_no int")
    weights = spark.createDataFrame([(f"p{p}", int(k), float(rng.normal()), int(k % 2), int(p % 3)) for p in range(4) for k in rng.choice(60, 25, replace=False)], "pgs_id string, vkey long, weight double, flip int, model int")
    meta = weights.groupBy("pgs_id").agg(F.count("*").alias("num_original"))
    want = {(r.sample_id, r.pgs_id): r for r in scoring.score_samples(genotypes, weights, meta).collect()}
    path = f"file://{tmp_path}/cohort"
    for _ in range(2):  # a second time replaces the first
        scoring.store_cohort(genotypes, weights, meta, path, 4)
    tables = [x.name for x in spark.catalog.listTables()]
    got = scoring.score_cohort(spark, path, 4)
    rows = {(r.sample_id, r.pgs_id): r for r in got.collect()}
    assert set(rows) == set(want) and all(rows[k].raw_score == pytest.approx(want[k].raw_score) and rows[k].variants_matched == want[k].variants_matched for k in want)
    assert [x.name for x in spark.catalog.listTables()] == tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = scoring.matched_rows(sinks.read_keyed(spark, f"{path}/genotypes", buckets=4), sinks.read_keyed(spark, f"{path}/weights", buckets=4))
        plan = joined.groupBy("pgs_id").agg(F.sum("weight"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above, below = plan.split("SortMergeJoin", 1)
    assert "Exchange" in above and "Exchange" not in below and below.count("Bucketed: true") == 2


def test_cohort(spark):
    rng = np.random.default_rng(9)
    n, scores = 48, [f"P{k}" for k in range(12)]
    base = rng.normal(size=(3, n))
    x = np.array([base[k % 3] + 0.3 * rng.normal(size=n) for k in range(12)])
    ref = spark.createDataFrame([(p, f"s{i:02d}", float(x[k, i])) for k, p in enumerate(scores) for i in range(n)], "pgs_id string, sample_id string, score double")
    modules, members = cohort.stable_modules(ref, k=4, draws=2, blocks=2)
    found = members.toPandas().groupby("module").pgs_id.apply(frozenset)
    assert set(found) == {frozenset(scores[k::3]) for k in range(3)} and {r.mean_jaccard for r in modules.collect()} == {1.0}
    # A draw's edges are those of its samples alone, clipped and standardised anew.
    picked = resample.subsamples(ref, "sample_id", 2, 0.8, 42).where("draw = 1").select("sample_id")
    drawn = cohort.drawn_edges(ref, 2, 0.8, 4, blocks=2).where("draw = 1").drop("draw")
    alone = cohort.correlation_edges(ref.join(picked, "sample_id", "left_semi"), 4, blocks=2)
    pairs = lambda d: {(r.src, r.dst): r["corr"] for r in d.collect()}
    assert pairs(drawn) == pytest.approx(pairs(alone)) and len(pairs(alone)) > 5
    quality = spark.createDataFrame([(p, 50.0) for p in scores[:-1]], "pgs_id string, total double")
    w = cohort.module_weights(members, quality)
    pcs = spark.createDataFrame([(f"s{i:02d}", float(v)) for i, v in enumerate(rng.normal(size=n))], "sample_id string, pc1 double")
    fits = cohort.fit_modules(w, ref, pcs, ["pc1"])
    z = ref.withColumnRenamed("score", "z")
    out = cohort.module_scores(fits, w, z, pcs, ["pc1"]).toPandas()
    assert len(out) == 3 * n and out.z.abs().max() <= 10 and (out.reliability == 1).all()
    assert cohort.module_table(cohort.module_scores(fits, w, z, pcs, ["pc1"]), sorted(out.module.unique().tolist())).count() == n
    few = cohort.module_scores(fits, w, z.where("pgs_id = 'P0' and sample_id = 's00'"), pcs, ["pc1"]).toPandas()
    assert len(few) == 3 and sorted(few.n_available) == [0, 0, 1]


def test_cohort_in_one_call(spark, tmp_path):
    from skein import __main__ as cli

    rng = np.random.default_rng(3)
    n, scores = 30, [f"P{k}" for k in range(9)]
    base = rng.normal(size=(3, n))
    (tmp_path / "m").mkdir()
    for k, p in enumerate(scores):
        np.save(tmp_path / "m" / f"{p}.npy", (base[k % 3] + 0.2 * rng.normal(size=n)).astype(np.float32))
    (tmp_path / "pcs.tsv").write_text("sample_id\tpc1\tpc2\n" + "".join(f"r{i}\t{rng.normal()}\t{rng.normal()}\n" for i in range(n)))
    rows = []
    for i in range(24):
        label = ["Healthy", "A", "B"][i % 3]
        _job(tmp_path, f"src_J{i}_x", [f"{rng.normal() * 0.2 + (3 if label == 'A' and k % 3 == 0 or label == 'B' and k % 3 == 1 else 0):.3f}" for k in range(9)])
        rows.append(f"B{i},J{i},{label},{'MF'[i % 2]},{30 + i}")
    (tmp_path / "manifest.csv").write_text("barcode,job_id,label,sex,age\n" + "\n".join(rows) + "\n")
    (tmp_path / "q.tsv").write_text("pgs_id\ttotal\n" + "".join(f"{p}\t{50 + k}\n" for k, p in enumerate(scores)))
    spark.createDataFrame([(p, ["fa", "fb", "fc"][k % 3], k == 3) for k, p in enumerate(scores)], "pgs_id string, family_primary string, proxy_trait_flag boolean").write.parquet(str(tmp_path / "meta"))
    sizes = {"k": 3, "boots": 1, "folds": 3, "trees": 30, "depth": 4, "permutations": 1, "null_trees": 2, "null_depth": 2, "draws": 5, "min_jaccard": 0.5}
    out = tmp_path / "out"
    cli.main(["cohort", "--root", str(tmp_path), "--manifest", str(tmp_path / "manifest.csv"), "--matrix", str(tmp_path / "m"), "--pcs", str(tmp_path / "pcs.tsv"), "--quality", str(tmp_path / "q.tsv"), "--metadata", str(tmp_path / "meta"), "--families", "A=fa,B=fb", "--out", str(out), "--sizes", json.dumps(sizes)])
    wanted = {"z_scores", "z_matrix", "patient_ancestry", "atlas_modules", "patient_module_scores", "per_fold_aucs", "patient_predictions", "confusion", "confusion_matrix", "models", "feature_importances", "permutation_null", "intervals", "margins_all", "margins_clean", "results", "config.json", "benchmark.json", "pipeline.log"}
    assert wanted <= {p.name for p in out.iterdir()}
    about = json.loads((out / "benchmark.json").read_text())
    assert about["ok"] and about["atlas"]["n_retained"] == 3 and about["multiclass"]["top1"] > 0.8 and set(about["steps"]) == {"scores of the cohort", "atlas", "module scores", "classifiers", "checks"}
    table = {r.sample_id: r for r in spark.read.option("sep", "\t").option("header", True).csv(str(out / "patient_predictions")).collect()}
    assert len(table) == 24 and sum(table[f"B{i}"].top1_disease == "AB"[i % 3 - 1] for i in range(24) if i % 3) >= 13
    assert {r.disease: (r.n_own, r.n_all) for r in spark.read.json(str(out / "margins_clean")).collect()} == {"A": (2, 9), "B": (3, 9)}
    atlas = {r.module: {m.pgs_id for m in r.members} for r in spark.read.json(str(out / "atlas_modules")).collect()}
    assert sorted(map(sorted, atlas.values())) == [sorted(scores[k::3]) for k in range(3)]


def test_panel_store(spark, files, tmp_path):
    from skein.functions.keys import variant_key

    panel, samples = text.read_panel(spark, str(files / "calls.vcf.gz"), frequencies=spark.createDataFrame([("rs2", 0.125)], "id string, afreq double"))
    sinks.write_panel(panel, samples, str(tmp_path / "p"))
    panel, samples = sinks.read_panel(spark, str(tmp_path / "p"))
    assert [tuple(r) for r in samples.orderBy("place").collect()] == [(0, "S1"), (1, "S2")]
    assert {r.id: (r.dosages, r.afreq) for r in panel.collect()} == {"rs1": ([1, 2], 0.75), "rs2": ([1, 0], 0.125), ".": ([None, 1], 0.5)}
    key = spark.range(1).select(variant_key(F.lit("1"), F.lit(100), F.lit("A"), F.lit("G"))).first()[0]
    assert panel.where("id = 'rs1'").first().vkey == key
    few, one = text.read_panel(spark, str(files / "calls.vcf.gz"), ["S2", "S7"])
    assert [r.sample_id for r in one.collect()] == ["S2"] and {tuple(r.dosages) for r in few.collect()} == {(2,), (0,), (1,)}


def test_narrow_scores_and_their_tables(spark, files, tmp_path):
    rows = text.parse_scores_narrow(text.lines(spark, str(files / "s")))
    got = sorted((r.pgs_id, r.chrom, r.pos, r.effect, r.other, r.weight, r.model) for r in rows.collect())
    assert got == [("PGS000001", "1", 100, "G", "A", 0.5, 0), ("PGS000001", "2", 200, "C", "T", 1.0, 1), ("PGS000001", "3", 300, "T", "C", 2.0, 0), ("PGS000001", "9", 900, "A", "T", 4.0, 0)]
    sinks.write_score_input(rows.withColumn("vkey", F.col("pos").cast("long")), str(tmp_path / "w"))
    assert sorted(p.name for p in (tmp_path / "w" / "pgs_id=PGS000001").iterdir()) == ["model=additive", "model=dominant"]
    table = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "w/pgs_id=PGS000001/model=dominant")).collect()
    assert [tuple(r) for r in table] == [("2:200", "C", "1.0", "200")]


def test_score_vectors_and_metadata(spark, tmp_path):
    (tmp_path / "m").mkdir()
    np.save(tmp_path / "m" / "P1.npy", np.array([0.5, -1.0], np.float32))
    np.save(tmp_path / "m" / "P2.npy", np.array([[2.0], [3.0]]))
    got = sorted(map(tuple, text.read_matrix(spark, str(tmp_path / "m"), spark.createDataFrame([(1, "b"), (0, "a")], "place long, sample_id string")).collect()))
    assert got == [("P1", "a", 0.5), ("P1", "b", -1.0), ("P2", "a", 2.0), ("P2", "b", 3.0)]
    spark.createDataFrame([("P1", "f", None, 1.0), ("P2", None, True, 2.0)], "pgs_id string, family_primary string, technical_trait_flag boolean, more double").write.parquet(str(tmp_path / "meta"))
    assert sorted(map(tuple, text.read_metadata(spark, str(tmp_path / "meta")).collect())) == [("P1", "f", False, False), ("P2", None, False, True)]


def test_run_record_of_a_failed_run(spark, tmp_path):
    with pytest.raises(ZeroDivisionError), sinks.RunRecord(spark, f"file://{tmp_path}/r", input="x") as record, record.step("first"):
        1 / 0
    about = json.loads((tmp_path / "r/benchmark.json").read_text())
    assert not about["ok"] and "first" in about["steps"] and "failed: ZeroDivisionError" in (tmp_path / "r/pipeline.log").read_text()


def test_genotype_store(spark, files):
    sinks.write_genotypes(text.read_vcf(spark, str(files / "calls.vcf.gz")), str(files / "g"))
    sinks.write_genotypes(text.read_vcf(spark, str(files / "calls.vcf.gz"), 1), str(files / "g2"))
    stored = sinks.read_genotypes(spark, str(files / "g"), ["S1", "S9"])
    assert sorted(map(tuple, stored.select("sample_id", "vkey", "dosage", "rsid").collect()), key=str) == sorted(map(tuple, text.read_vcf(spark, str(files / "calls.vcf.gz")).select("sample_id", "vkey", "dosage", "rsid").collect()), key=str)
    assert sinks.read_genotypes(spark, str(files / "g"), ["S2"]).count() == 0


def test_classifiers(spark):
    from skein.operators import ml

    rng = np.random.default_rng(10)
    labels = ["Healthy"] * 24 + ["A"] * 16 + ["B"] * 16
    rows = [(f"u{k:02d}", y, float((y == "A") + 0.2 * rng.normal()), float((y == "B") + 0.2 * rng.normal())) for k, y in enumerate(labels)]
    df = ml.features(spark.createDataFrame(rows, "u string, label string, a double, b double"), ["a", "b"])
    p = cohort.one_against_healthy(df, "u", "label", ["A", "B"], folds=2, trees=5, depth=3).cache()
    assert {r.disease: r.auc > 0.9 for r in cohort.fold_areas(p).collect()} == {"A": True, "B": True}
    truth = df.where("label <> 'Healthy'").select("u", F.col("label").alias("truth"))
    assert cohort.ranked_accuracy(p, truth, "u", (1, 2)).first().top1 > 0.8
    table = cohort.prediction_table(p, "u", ["A", "B"]).toPandas()
    assert len(table) == 56 and list(table.columns) == ["u", "A", "B", "top1_disease", "top1_p", "top2_disease", "top2_p", "top3_disease", "top3_p"] and (table.top1_p == table[["A", "B"]].max(axis=1)).all()
    iv = {r.disease: r for r in cohort.area_intervals(p, "u", 10).collect()}
    assert iv["A"].low <= iv["A"].auc + 1e-9 and iv["A"].high <= 1.0
    z = df.select(F.col("u").alias("sample_id"), F.explode(F.create_map(F.lit("PA"), "a", F.lit("PB"), "b", F.lit("PC"), F.lit(1.0))).alias("pgs_id", "z"))
    marks = df.where("label in ('A', 'Healthy')").select(F.col("u").alias("sample_id"), F.lit("A").alias("disease"), (F.col("label") == "A").cast("int").alias("label"))
    single = cohort.stress_test(z, marks)
    assert {r.pgs_id for r in single.collect()} == {"PA", "PB"}
    row = cohort.compared(cohort.fold_areas(p), single, spark.createDataFrame([("A", "PA")], "disease string, pgs_id string")).first()
    assert row.n_own == 1 and row.n_all == 2 and row.best_own == row.best_all
    null = cohort.permutation_null(df.drop("features").transform(lambda d: ml.features(d, ["a", "b"])), "u", "label", ["A", "B"], draws=1, folds=2, trees=3, depth=2)
    assert 0 <= null.first().top1 <= 1


def test_bundle(spark, tmp_path):
    from skein import __main__ as cli
    from skein.plans import bundle

    rng = np.random.default_rng(12)
    n, scores = 40, [f"P{k}" for k in range(6)]
    labels = ["Healthy"] * 16 + ["A"] * 12 + ["B"] * 12
    shift = {"A": np.array([2.0, 0] * 3), "B": np.array([0, 2.0] * 3), "Healthy": np.zeros(6)}
    ref = spark.createDataFrame([(p, f"r{i}", float(v)) for i in range(30) for p, v in zip(scores, rng.normal(size=6))], "pgs_id string, sample_id string, score double")
    pcs = lambda letter, m: spark.createDataFrame([(f"{letter}{i}", *map(float, rng.normal(size=2))) for i in range(m)], "sample_id string, pc1 double, pc2 double")
    members = spark.createDataFrame([(k % 2, p, 0.5) for k, p in enumerate(scores)], "module int, pgs_id string, loading double")
    modules = spark.createDataFrame([(0, 3, 0.9), (1, 3, 0.8)], "community int, size long, mean_jaccard double")
    quality = spark.createDataFrame([(p, 50.0) for p in scores], "pgs_id string, total double")
    z = spark.createDataFrame([(f"u{i}", p, float(v)) for i, y in enumerate(labels) for p, v in zip(scores, rng.normal(size=6) * 0.3 + shift[y])], "sample_id string, pgs_id string, z double")
    people = spark.createDataFrame([(f"u{i}", y, "M" if i % 2 else "F", 40.0 + i, {"EUR": 0.9, "AFR": 0.1}) for i, y in enumerate(labels)], "sample_id string, label string, sex string, age double, pop_probs map<string,double>")
    made = bundle.build(ref, pcs("r", 30), modules, members, quality, _metadata(spark), z, pcs("u", n), people, ["A", "B"], trees=5, depth=3, n_pcs=2)
    bundle.save(made, str(tmp_path / "model"))
    _job(tmp_path, "src_J1_x", ["2.0", "0.1", "2.1", "-0.2", "1.9", "0.0"])
    cli.main(["analyze", "--model", str(tmp_path / "model"), "--job", str(tmp_path / "jobs/src_J1_x"), "--sex", "M", "--age", "50", "--out", str(tmp_path / "out")])
    out = json.loads(spark.read.text(str(tmp_path / "out/report")).first().value)
    assert out["patient"]["barcode"] == "src_J1_x" and out["patient"]["ancestry"]["predicted_population"] == "EUR" and out["patient"]["modules_available"] == 2
    ranked = out["disease_similarity"]["ranking"]
    assert ranked[0]["disease"] == "A" and len(ranked) == 2 and {m["module_id"] for d in ranked for m in d["driving_modules"]} <= {0, 1}
    member = next(m for d in ranked for m in d["driving_modules"])["member_pgs"][0]
    assert member["loading"] == 0.5 and "trait" in member
    assert len(out["disease_similarity"]["module_profile"]) == 2
