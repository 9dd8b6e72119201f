"""Quality of scores, tiers, and a patient's nested report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import domains, rules
from skein.functions.clean import no_nan
from skein.operators import stats
from skein.operators.match import left_default
from skein.session import scratch
from skein.sources.sinks import read_keyed, write_keyed


def score_quality(catalog: DataFrame, performance: DataFrame | None = None, match_rates: DataFrame | None = None, z_scores: DataFrame | None = None, population: str = "EUR", requested: DataFrame | None = None, alias: bool = True) -> DataFrame:
    """Each score's three axes, total and label. catalog: see read_catalog; performance (id, performance); match_rates (pgs_id, match_rate); z_scores (pgs_id, z).

    requested (pgs_id): scores that the catalogue lacks get the label discard and an error.
    """
    entries = catalog.withColumnRenamed("id", "pgs_id")
    if requested is not None:
        entries = requested.select("pgs_id").join(entries.withColumn("_known", F.lit(True)), "pgs_id", "left")
    else:
        entries = entries.withColumn("_known", F.lit(True))
    from skein.sources.text import PERFORMANCE

    with_perf = entries.join(performance.withColumnRenamed("id", "pgs_id"), "pgs_id", "left") if performance is not None else entries.withColumn("performance", F.lit(None).cast(PERFORMANCE))
    rated = with_perf.join(match_rates.select("pgs_id", "match_rate"), "pgs_id", "left") if match_rates is not None else with_perf.withColumn("match_rate", F.lit(None).cast("double"))
    x = rated.join(z_scores.select("pgs_id", "z"), "pgs_id", "left") if z_scores is not None else rated.withColumn("z", F.lit(None).cast("double"))
    p, dist = F.col("performance"), F.col("ancestry_distribution")
    perf = rules.performance(p["auroc_median"], p["r2_max"], p["or_median"], p["n_evals"], F.col("method_name"), dist["gwas"]["count"])
    fit = rules.applicability(dist["gwas"]["dist"], dist["eval"]["dist"], p["eval_ancestries"], population, alias)
    y = x.select("*", perf.alias("_perf"), fit.alias("_fit"), rules.match_confidence(F.col("match_rate"), F.col("z")).alias("match_confidence"))
    total = F.col("_perf.score") + F.col("_fit.score") + F.col("match_confidence")
    known = F.col("_known").isNotNull()
    detail = F.concat(F.lit("gwas="), "_fit.gwas", F.lit("/12, eval="), "_fit.eval", F.lit("/10, pop_eval="), "_fit.cohort", F.lit("/8"))
    text = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    return y.select(
        "pgs_id", F.when(known, total).alias("total"), F.when(known, rules.quality_label(total, F.col("match_rate"), F.col("z"))).otherwise("discard").alias("label"),
        F.when(known, F.col("_perf.score")).alias("performance"), F.when(known, F.col("_fit.score")).alias("applicability"), F.when(known, F.col("match_confidence")).alias("match_confidence"), F.when(known, F.col("_perf.source")).alias("performance_source"),
        text("trait_reported", "").alias("trait"), text("method_name", "").alias("method_name"), F.coalesce("variants_number", F.lit(0)).alias("variants_number"),
        _performance_detail(p, F.col("_perf.source"), F.col("method_name")).alias("performance_detail"), F.when(known, detail).alias("applicability_detail"), _match_detail(F.col("match_rate"), F.col("z")).alias("match_detail"),
        F.when(~known, "not in catalog").alias("error"))


def _performance_detail(p: Column, source: Column, method: Column) -> Column:
    count = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    more = F.when(p["n_evals"] >= 10, F.concat(F.lit(", "), p["n_evals"], F.lit(" evals"))).otherwise("")
    return (
        F.when(source == "estimated", F.concat(F.lit("est. from method ("), F.substring(F.coalesce(method, F.lit("?")), 1, 40), F.lit(")")))
        .when(source == "partial", F.concat(p["n_evals"], F.lit(" evals (no AUROC/R²/OR)")))
        .when(p["auroc_median"].between(0.5, 1.0), F.concat(F.format_string("AUROC=%.3f (", p["auroc_median"]), count(p["auroc_n"]), F.lit(" studies)"), more))
        .when(p["r2_max"].between(0.0, 1.0), F.concat(F.format_string("R²=%.4f (", p["r2_max"]), count(p["r2_n"]), F.lit(" studies)"), more))
        .otherwise(F.concat(F.format_string("OR=%.2f (", p["or_median"]), count(p["or_n"]), F.lit(" studies)")))
    )


def _match_detail(rate: Column, z: Column) -> Column:
    fine, whole = F.format_string("cov=%.1f%%", rate * 100), F.format_string("cov=%.0f%%", rate * 100)
    names = [(0.15, " very low"), (0.25, " low"), (0.35, " fair"), (0.50, " adequate"), (0.65, " good")]
    cover = F.when(rate.isNull(), F.lit("cov=?")).when(rate < 0.02, F.concat(fine, F.lit(" NONE"))).when(rate < 0.05, F.concat(fine, F.lit(" negligible")))
    for bound, name in names:
        cover = cover.when(rate < bound, F.concat(whole, F.lit(name)))
    cover = cover.otherwise(F.concat(whole, F.lit(" excellent")))
    far = F.format_string("|Z|=%.0f", F.abs(z))
    stable = F.when(z.isNull(), F.lit("Z=?")).when(rate < 0.02, F.lit("Z=N/A")).when(F.abs(z) <= 4, F.format_string("Z=%.1f", z)).when(F.abs(z) <= 7, F.concat(F.format_string("Z=%.1f", z), F.lit(" elevated"))).when(F.abs(z) <= 10, F.concat(far, F.lit(" high"))).otherwise(F.concat(far, F.lit(" extreme")))
    return F.concat_ws("; ", cover, stable)


def quality_summary(quality: DataFrame) -> DataFrame:
    """Counts and totals by label and source of the performance axis."""
    return quality.groupBy("label", "performance_source").agg(F.count("*").alias("n"), F.avg("total").alias("mean"), F.median("total").alias("median"), F.min("total").alias("least"), F.max("total").alias("most"))


def score_metadata(meta: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """Metadata of scores (lists as arrays) with domain, subsection and quality: what tiers and reports read."""
    null_as = lambda c, v: F.coalesce(F.col(c), F.lit(v))
    out = meta.select(
        "pgs_id", F.col("short_report_label").alias("trait"), F.col("family_primary").alias("family"), F.col("organ_system_tags").alias("organ_systems"), "categories", "phenotype_type", F.col("variants_number").alias("variants"), F.col("method_name").alias("method"), F.col("plain_language_summary").alias("plain_language"),
        domains.domain(F.col("family_primary"), F.col("organ_system_tags"), F.col("categories"), F.col("phenotype_type")).alias("domain"), domains.subsection(F.col("phenotype_type"), F.col("short_report_label"), F.col("organ_system_tags"), F.col("categories")).alias("phenotype_subsection"),
        null_as("reportability_score", 0.0).alias("reportability_score"), null_as("catalog_evidence_score", 0.0).alias("catalog_evidence_score"), null_as("proxy_trait_flag", False).alias("proxy_trait_flag"), null_as("technical_trait_flag", False).alias("technical_trait_flag"), "quality_flags")
    if quality is None:
        return out.withColumns({"quality_score": F.lit(0.0), "quality_label": F.lit("unknown")})
    return left_default(out, quality.select("pgs_id", F.col("total").cast("double").alias("quality_score"), F.col("label").alias("quality_label")), ["pgs_id"], {"quality_score": 0.0, "quality_label": "unknown"})


def kept_scores(z_scores: DataFrame, metadata: DataFrame) -> DataFrame:
    """(sample_id, pgs_id, z, metadata) that a report uses: finite, |z| at most 10, known and not discarded."""
    return z_scores.join(metadata, "pgs_id").where(no_nan(F.col("z")).isNotNull() & (F.abs("z") <= 10) & (F.col("quality_label") != "discard"))


def tiers(kept: DataFrame, dealt: bool = False) -> DataFrame:
    """kept with importance (boosted by agreeing peers, rounded after tiering), convergence, t1, t2, tier and direction, for each sample.

    dealt: kept lies by sample, and all is computed there: a sample's scores are one task's, as its report is.
    """
    up = rules.direction(F.col("z"))
    family = F.when(F.col("family") != "", F.concat_ws("\x1f", "family", up))
    trait = F.when(rules.trait_key(F.col("trait")).isNotNull(), F.concat_ws("\x1f", rules.trait_key(F.col("trait")), up))
    base = rules.importance(F.col("z"), F.col("quality_score"), F.col("catalog_evidence_score"), F.col("reportability_score"), F.col("proxy_trait_flag"), F.col("technical_trait_flag"), F.col("quality_flags"), F.col("variants"))
    x = kept.withColumns({"_f": family, "_t": trait})
    x = x.withColumn("convergence", stats.convergence(x, [F.col("_f"), F.col("_t")], ["sample_id"])).drop("_f", "_t")
    x = x.withColumn("importance", base * (1.0 + 0.15 * F.least(F.col("convergence"), F.lit(8))))
    y = stats.with_iqr_thresholds(x.where("sample_id is not null"), "importance", ["sample_id"]) if dealt else x.join(stats.iqr_thresholds(x, "importance", ["sample_id"]), "sample_id")
    return y.withColumn("tier", rules.tier(F.col("importance"), F.col("t1"), F.col("t2"))).withColumn("importance", F.bround("importance", 2)).withColumn("direction", rules.direction(F.col("z"), "elevated", "reduced"))


def _stored_tiers(kept: DataFrame) -> DataFrame:
    """tiers of kept, computed once and stored by sample: what is grouped or joined by sample is read from there without a shuffle."""
    spark = kept.sparkSession
    path, parts = scratch(spark, "tiers"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_keyed(tiers(kept.repartition(parts, "sample_id"), dealt=True), path, "sample_id", parts, dealt=True)
    return read_keyed(spark, path, "sample_id", parts)


def entries(tiered: DataFrame, url: str | None = None) -> DataFrame:
    """tiered with entry: what a report says of a score; T1 says most, T3 least. Absent fields are null and left out of JSON."""
    key = F.concat_ws(".", "pgs_id", "tier", "direction")
    first, second = F.col("tier") == "T1", F.col("tier").isin("T1", "T2")
    only = lambda when, c: F.when(when, F.col(c)).alias(c)
    link = F.when(first, F.concat(F.lit(url or ""), "pgs_id", F.lit("/"))) if url else F.lit(None).cast("string")
    return tiered.withColumn("entry", F.struct(
        "pgs_id", key.alias("key"), "tier", F.bround("z", 4).alias("z_score"), "direction", "importance", *(only(second, c) for c in ("convergence", "trait", "quality_score", "quality_label", "variants", "method")),
        *(only(first, c) for c in ("plain_language", "family", "organ_systems", "categories", "phenotype_type", "domain", "reportability_score", "catalog_evidence_score")), link.alias("catalog_url")))


def _listed() -> Column:
    """Entries of a group, the most important first."""
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("entry.importance")).alias("_k"), F.col("entry.pgs_id").alias("_i"), "entry")))
    return F.transform(ordered, lambda x: x["entry"])


def _counts() -> list[Column]:
    z = F.bround("z", 4)
    n = lambda t: F.count_if(F.col("tier") == t).alias(t)
    mean = F.avg(z.cast("decimal(20,4)")).cast("double")  # exact, whatever the order of rows: it is rounded again
    return [F.count("*").alias("n_pgs"), F.count_if(F.abs(z) >= 1.5).alias("n_elevated"), mean.alias("_mean"), F.struct(n("T1"), n("T2"), n("T3")).alias("tier_counts")]


def domain_section(tiered: DataFrame) -> DataFrame:
    """(sample_id, domain, n_pgs, n_elevated, mean_z, risk_level, color, tier_counts, pgs): every domain of every sample, in order, empty ones too."""
    spark = tiered.sparkSession
    order = spark.createDataFrame([(k, d, domains.DOMAIN_COLORS.get(d, "#9e9e9e")) for k, d in enumerate(domains.DOMAIN_ORDER)], "place int, domain string, color string")
    found = entries(tiered).where(F.col("domain").isin(*domains.DOMAIN_ORDER)).groupBy("sample_id", "domain").agg(*_counts(), _listed().alias("pgs"))
    every = tiered.select("sample_id").distinct().crossJoin(F.broadcast(order))  # eleven rows
    x = every.join(found, ["sample_id", "domain"], "left")
    n, e, m = (F.coalesce(F.col(c), F.lit(0)) for c in ("n_pgs", "n_elevated", "_mean"))
    return x.select("sample_id", "place", "domain", n.alias("n_pgs"), e.alias("n_elevated"), F.bround(m.cast("double"), 3).alias("mean_z"), rules.risk_level(m, e, n).alias("risk_level"), "color", "tier_counts", "pgs")


def landscape_section(tiered: DataFrame) -> DataFrame:
    """(sample_id, landscape, subsection, n_pgs, n_elevated, mean_z, tier_counts, pgs), and a row of totals for each landscape (subsection null)."""
    pick = rules.first_mapped(F.array("phenotype_type"), domains.LANDSCAPES)
    x = entries(tiered).withColumns({"landscape": pick, "subsection": F.coalesce("phenotype_subsection", F.lit("other"))}).where("landscape is not null")
    parts = x.groupBy("sample_id", "landscape", "subsection").agg(*_counts(), _listed().alias("pgs"))
    totals = x.groupBy("sample_id", "landscape").agg(*_counts()).withColumns({"subsection": F.lit(None).cast("string"), "pgs": F.lit(None).cast(parts.schema["pgs"].dataType)})
    return parts.unionByName(totals.select(*parts.columns)).withColumn("mean_z", F.bround("_mean", 3)).drop("_mean")


def ranking(probabilities: DataFrame, nice: dict[str, str] | None = None) -> DataFrame:
    """(sample_id, disease, probability) ranked, ties by name, with a label and a readable name."""
    place = F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("probability"), "disease"))
    x = probabilities.withColumn("rank", place)
    names = F.create_map(*(F.lit(v) for kv in nice.items() for v in kv)) if nice else None
    name = F.coalesce(F.try_element_at(names, "disease"), F.col("disease")) if nice else F.col("disease")
    return x.select("sample_id", "rank", "disease", name.alias("disease_name"), F.bround("probability", 6).alias("probability"), rules.strength(F.col("probability"), F.col("rank")).alias("strength"))


def monitoring(sections: DataFrame) -> DataFrame:
    """sample_id, elevated_domains and recommendations (domain to tests) of the domains whose risk is raised."""
    spark = sections.sparkSession
    known = spark.createDataFrame([(d, list(m)) for d, m in domains.MONITORS.items()], "domain string, tests array<string>")
    raised = sections.where(F.col("risk_level").isin("ELEVATED", "MILDLY_ELEVATED")).join(F.broadcast(known), "domain", "left")  # eleven rows
    ordered = F.sort_array(F.collect_list(F.struct("place", "domain", "tests")))
    out = raised.groupBy("sample_id").agg(ordered.alias("_o"))
    with_tests = F.filter("_o", lambda x: x["tests"].isNotNull())
    return out.select("sample_id", F.transform("_o", lambda x: x["domain"]).alias("elevated_domains"), F.map_from_arrays(F.transform(with_tests, lambda x: x["domain"]), F.transform(with_tests, lambda x: x["tests"])).alias("recommendations"))


def report(z_scores: DataFrame, metadata: DataFrame, profile: DataFrame, probabilities: DataFrame | None = None, modules: DataFrame | None = None, nice: dict[str, str] | None = None, drivers: DataFrame | None = None) -> DataFrame:
    """(sample_id, report): the nested report of each sample as JSON.

    z_scores: sample_id, pgs_id, z. profile: sample_id and what is said of the sample (any columns).
    probabilities: sample_id, disease, probability. modules: sample_id, module_id, z_score, reliability, …. drivers: sample_id, disease, driving_modules.
    """
    kept = kept_scores(z_scores, metadata)
    tiered = _stored_tiers(kept)
    doms = domain_section(tiered)
    scored = z_scores.groupBy("sample_id").agg(F.count("*").alias("pgs_scored"))
    filtered = tiered.groupBy("sample_id").agg(F.count("*").alias("pgs_after_filter"), F.struct(F.bround(F.max("t1"), 2).alias("T1"), F.bround(F.max("t2"), 2).alias("T2")).alias("tier_thresholds"), F.struct(*(F.count_if(F.col("tier") == t).alias(t) for t in ("T1", "T2", "T3"))).alias("tier_counts"))
    patient = profile.join(scored, "sample_id").join(filtered, "sample_id", "left")
    said = [c for c in patient.columns if c != "sample_id"]
    out = patient.select("sample_id", F.struct(F.col("sample_id").alias("barcode"), *said).alias("patient"))
    listed = F.sort_array(F.collect_list(F.struct("place", F.struct("domain", "n_pgs", "n_elevated", "mean_z", "risk_level", "color", "tier_counts", "pgs").alias("x"))))
    by_domain = doms.groupBy("sample_id").agg(F.transform(listed, lambda x: x["x"]).alias("_d"))
    out = out.join(by_domain.select("sample_id", F.map_from_arrays(F.transform("_d", lambda x: x["domain"]), F.transform("_d", lambda x: x.dropFields("domain"))).alias("domains")), "sample_id", "left")
    loose = entries(tiered).where(~F.coalesce(F.col("domain").isin(*domains.DOMAIN_COLORS), F.lit(False))).groupBy("sample_id").agg(F.struct(F.count("*").alias("n_pgs"), _listed().alias("pgs")).alias("unclassified"))
    out = out.join(loose, "sample_id", "left")
    lands = landscape_section(tiered)
    total = lands.where("subsection is null").select("sample_id", "landscape", F.col("n_pgs").alias("_n"), F.col("tier_counts").alias("_t"))
    part = lands.where("subsection is not null").groupBy("sample_id", "landscape").agg(F.sort_array(F.collect_list(F.struct("subsection", "n_pgs", "mean_z", "n_elevated", "tier_counts", "pgs"))).alias("_s"))
    sub = F.map_from_arrays(F.transform("_s", lambda x: x["subsection"]), F.transform("_s", lambda x: x.dropFields("subsection")))
    land = part.join(total, ["sample_id", "landscape"]).select("sample_id", "landscape", F.struct(F.col("_n").alias("n_pgs"), sub.alias("subsections"), F.col("_t").alias("tier_counts")).alias("l"))
    out = out.join(land.groupBy("sample_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("landscape", "l")), lambda a, b: F.when(a["landscape"] < b["landscape"], -1).otherwise(1))).alias("phenotype_landscapes")), "sample_id", "left")
    fields = ["patient", F.struct("domains", "unclassified").alias("clinical_circos"), "phenotype_landscapes"]
    if probabilities is not None:
        ranked, said = ranking(probabilities, nice), ["rank", "disease", "disease_name", "probability", "strength"]
        if drivers is not None:
            ranked, said = ranked.join(drivers, ["sample_id", "disease"], "left"), [*said, "driving_modules"]
        out = out.join(ranked.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct(*said))).alias("ranking")), "sample_id", "left")
    if modules is not None:
        said = [c for c in modules.columns if c != "sample_id"]
        out = out.join(modules.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct(*said))).alias("module_profile")), "sample_id", "left")
    similar = [c for c, given in (("ranking", probabilities), ("module_profile", modules)) if given is not None]
    if similar:
        fields.append(F.struct(*similar).alias("disease_similarity"))
    out = out.join(monitoring(doms), "sample_id", "left")
    fields.append(F.struct(F.coalesce("elevated_domains", F.array().cast("array<string>")).alias("elevated_domains"), "recommendations").alias("suggested_monitoring"))
    return out.select("sample_id", F.to_json(F.struct(*fields)).alias("report"))
