"""Cohort analysis: a graph of scores, stable modules, module scores, classifiers and their checks."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.operators import forests, graph, ml, resample, stats
from skein.operators.reshape import top_k_accuracy, wide
from skein.session import written
from skein.sources import sinks, text

POPULATIONS = ("AFR", "AMR", "CSA", "EAS", "EUR", "MID")
#: Models that the driver has fitted at a time: each is a distributed job, and small ones leave executors idle.
PARALLEL = 4


def _each(f: Callable, items: Iterable) -> list:
    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(f, items))


def standard_vectors(ref_scores: DataFrame) -> DataFrame:
    """(pgs_id, v): winsorised and standardised scores over the samples in order."""
    z = stats.winsorised(ref_scores, "score", ["pgs_id"])
    return z.groupBy("pgs_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("sample_id", "z"))), lambda x: x["z"]).alias("v"))


def correlation_edges(ref_scores: DataFrame, k: int = 15, threshold: float = 0.18, blocks: int | None = None) -> DataFrame:
    """Edges of scores that are each among the other's k most correlated."""
    return graph.reciprocal(graph.block_correlations(standard_vectors(ref_scores), "pgs_id", "v", k, threshold, blocks, standardise=False))


def drawn_edges(ref_scores: DataFrame, draws: int = 25, share: float = 0.8, k: int = 15, threshold: float = 0.18, seed: int = 42, blocks: int | None = None) -> DataFrame:
    """correlation_edges of each draw (a column) of samples, clipped and standardised by itself. All draws' products come from blocks that are sent once.

    Every score has a value for the same samples, as a panel's scores have.
    """
    raw = ref_scores.groupBy("pgs_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("sample_id", "score"))), lambda x: x["score"]).alias("v"))
    order = F.row_number().over(Window.orderBy("sample_id")) - 1
    ids = ref_scores.select("sample_id").distinct().withColumn("at", order)  # the panel's samples
    picked = resample.subsamples(ref_scores, "sample_id", draws, share, seed).join(ids, "sample_id").groupBy("draw").agg(F.sort_array(F.collect_list("at")).alias("at"))
    places = {r.draw: r["at"] for r in picked.collect()}  # draws times samples
    return graph.reciprocal(graph.block_correlations(raw, "pgs_id", "v", k, threshold, blocks, draws=places, clip=(0.005, 0.995)))


def stable_modules(ref_scores: DataFrame, k: int = 15, threshold: float = 0.18, draws: int = 25, share: float = 0.8, min_size: int = 3, min_jaccard: float = 0.70, seed: int = 42, draw_k: int | None = None, blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(modules, members): communities of the graph that come out again in graphs of subsamples.

    modules: community, size, mean_jaccard. members: module, pgs_id, loading. draw_k: neighbours
    in the subsamples' graphs, if not k.
    """
    base = graph.communities(correlation_edges(ref_scores, k, threshold, blocks).withColumn("draw", F.lit(-1)), ["draw"], seed).select("node", "community")
    again = graph.communities(drawn_edges(ref_scores, draws, share, draw_k or k, threshold, seed, blocks), ["draw"], seed)
    modules = graph.retained(graph.stability(base, again), min_size, min_jaccard)
    kept = base.join(modules.select("community"), "community").select(F.col("community").alias("module"), F.col("node").alias("pgs_id"))
    members = graph.loadings(kept.join(standard_vectors(ref_scores), "pgs_id"), "module", "pgs_id", "v")
    return modules, members


def module_weights(members: DataFrame, quality: DataFrame, default: float = 0.5, scaled: bool = True) -> DataFrame:
    """members with weight = loading * quality (pgs_id, total), by its share of the largest if scaled; default where it is missing."""
    largest = quality.agg(F.max("total").alias("_max"))
    q = quality.crossJoin(F.broadcast(largest)).select("pgs_id", ((F.col("total") / F.col("_max")) if scaled else F.col("total")).cast("double").alias("_q"))  # one row
    return members.join(q, "pgs_id", "left").withColumn("weight", F.col("loading") * F.coalesce("_q", F.lit(default))).drop("_q")


def fit_modules(weights: DataFrame, ref_scores: DataFrame, pcs: DataFrame, columns: list[str]) -> DataFrame:
    """(module, intercept, coefs, center, scale): the reference's module projections, fitted on components and scaled robustly."""
    residual = stats.residualised(ref_scores, pcs, columns).select("pgs_id", "sample_id", F.col("residual").alias("x"))
    projected = stats.weighted_projection(residual.join(weights, "pgs_id"), "x", "weight", ["module", "sample_id"])
    beta = stats.coefficients(projected, pcs, columns, "score", "sample_id", "module")
    left = stats.residualised(projected, pcs, columns, "score", "sample_id", "module")
    return beta.join(stats.robust_scale(left, "residual", ["module"]), "module")


def module_scores(fits: DataFrame, weights: DataFrame, z_scores: DataFrame, pcs: DataFrame, columns: list[str], limit: float = 10.0, extreme_share: float | None = None) -> DataFrame:
    """(sample_id, module, z, reliability, n_available) of samples (sample_id, pgs_id, z): projection less the fit, scaled, missing as 0, clipped.

    Samples without components count as at their origin. extreme_share: modules beyond the limit
    in at least this share of samples are left out, judged before clipping.
    """
    every = z_scores.select("sample_id").distinct().join(weights.select("module", "pgs_id", "weight"))  # a row for each sample and member
    x = every.join(z_scores, ["sample_id", "pgs_id"], "left")
    projected = stats.weighted_projection(x, "z", "weight", ["sample_id", "module"])
    joined = projected.join(pcs.select("sample_id", F.array(*(F.col(c).cast("double") for c in columns)).alias("_pc")), "sample_id", "left").join(fits, "module")
    fitted = F.col("intercept") + F.aggregate(F.zip_with("coefs", F.coalesce("_pc", F.array(*(F.lit(0.0) for _ in columns))), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    raw = joined.withColumn("_z", F.when(F.col("scale") > 1e-8, (F.col("score") - fitted - F.col("center")) / F.col("scale")).otherwise(0.0))
    if extreme_share is not None:
        wild = raw.groupBy("module").agg(F.avg((F.abs("_z") > limit).cast("double")).alias("_share")).where(F.col("_share") >= extreme_share)
        raw = raw.join(wild.select("module"), "module", "left_anti")
    z = F.least(F.greatest(F.coalesce("_z", F.lit(0.0)), F.lit(-limit)), F.lit(limit))
    return raw.select("sample_id", "module", z.alias("z"), "reliability", "n_available")


def one_against_healthy(features: DataFrame, unit: str, label: str, diseases: list[str], healthy: str = "Healthy", folds: int = 5, trees: int = 500, depth: int = 12, seed: int = 42) -> DataFrame:
    """(unit, disease, label, fold, p): for each disease a forest against the healthy, out of fold; the other diseases' samples are scored and not learned from."""

    def one(disease: str) -> DataFrame:
        own = features.where(F.col(label).isin(disease, healthy)).withColumn("_y", (F.col(label) == disease).cast("double"))
        others = features.where(~F.col(label).isin(disease, healthy))
        found = ml.cross_validated(own, unit, "_y", folds, trees, depth, seed, others)
        return found.withColumn("disease", F.lit(disease))

    return reduce(DataFrame.unionByName, _each(one, sorted(diseases)))


def fold_areas(predictions: DataFrame) -> DataFrame:
    """(disease, auc, folds): mean area over folds."""
    by_fold = stats.rank_auc(predictions.where("label is not null"), "p", "label", ["disease", "fold"], symmetric=False)
    return by_fold.groupBy("disease").agg(F.avg("auc").alias("auc"), F.count("*").alias("folds"))


def area_intervals(predictions: DataFrame, unit: str, draws: int = 1000, seed: int = 42) -> DataFrame:
    """(disease, auc, low, high, n): the pooled area and its bootstrap interval, for each disease."""
    own = predictions.where("label is not null").select(unit, "disease", "label", "p")
    parts = []
    for disease in sorted(r.disease for r in own.select("disease").distinct().collect()):
        drawn = resample.bootstrap(own.where(F.col("disease") == disease), unit, draws, seed)
        parts.append(stats.rank_auc(drawn, "p", "label", ["disease", "draw"], symmetric=False))
    intervals = resample.interval(reduce(DataFrame.unionByName, parts), "auc", ["disease"])
    return stats.rank_auc(own, "p", "label", ["disease"], symmetric=False).select("disease", "auc").join(intervals, "disease")


def prediction_table(predictions: DataFrame, unit: str, diseases: list[str]) -> DataFrame:
    """One row for each unit: its probability of each disease, and the three most probable with theirs."""
    place = F.row_number().over(Window.partitionBy(unit).orderBy(F.desc("p"), "disease"))
    top = predictions.withColumn("_k", place).where("_k <= 3").groupBy(unit).agg(*(F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"top{k}_{n}") for k in (1, 2, 3) for c, n in (("disease", "disease"), ("p", "p"))))
    return wide(predictions, unit, "disease", "p", diseases).join(top, unit)


def module_table(scores: DataFrame, modules: list) -> DataFrame:
    """One row for each sample: its score of each module, as columns z_<module>."""
    out = wide(scores, "sample_id", "module", "z", modules)
    return out.select("sample_id", *(F.col(f"`{m}`").alias(f"z_{m}") for m in modules))


def ranked_accuracy(predictions: DataFrame, truth: DataFrame, unit: str, ks: tuple[int, ...] = (1, 3)) -> DataFrame:
    """Share of diseased units whose disease is among the k most probable. truth: unit, truth."""
    return top_k_accuracy(predictions.join(truth, unit), unit, "truth", "disease", "p", ks)


def permutation_null(features: DataFrame, unit: str, label: str, diseases: list[str], draws: int = 100, healthy: str = "Healthy", folds: int = 5, trees: int = 200, depth: int = 8, seed: int = 100) -> DataFrame:
    """(draw, top1, top3): accuracies of models refitted on disease labels dealt anew among the diseased; the healthy keep theirs.

    The forests of all draws, diseases and folds grow together, in as many passes as they have levels.
    """
    well = F.col(label) == healthy
    sick = resample.permuted(features.where(~well).select(unit, label), unit, label, draws, seed)
    same = features.where(well).select(unit, label).withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    dealt = written(sick.select("draw", unit, label).unionByName(same.select(F.col("draw").cast(sick.schema["draw"].dataType).alias("draw"), unit, label)))
    y = F.when(F.col(label) == F.col("disease"), 1).when(well, 0)
    labels = dealt.withColumn("disease", F.explode(F.array(*(F.lit(d) for d in sorted(diseases))))).select("draw", "disease", unit, y.alias("y"))
    units = features.select(unit, vector_to_array("features").alias("x"))
    found = forests.out_of_fold(labels, units, ["draw", "disease"], unit, "x", folds, trees, depth, seed)
    place = F.row_number().over(Window.partitionBy("draw", unit).orderBy(F.desc("p"), "disease"))
    truth = dealt.where(~well).select("draw", unit, F.col(label).alias("truth"))
    right = found.withColumn("_place", place).join(truth, ["draw", unit]).where(F.col("disease") == F.col("truth"))
    hits = right.groupBy("draw").agg(F.count_if(F.col("_place") <= 1).alias("_one"), F.count_if(F.col("_place") <= 3).alias("_three"))
    n = truth.groupBy("draw").agg(F.count("*").alias("_n"))
    return n.join(hits, "draw", "left").select("draw", *((F.coalesce(c, F.lit(0)) / F.col("_n")).alias(name) for c, name in (("_one", "top1"), ("_three", "top3"))))


def stress_test(z_scores: DataFrame, cohort: DataFrame, min_std: float = 1e-8) -> DataFrame:
    """(disease, pgs_id, auc): every score's own area for every disease. cohort: sample_id, disease, label (0/1). Nearly constant scores are left out."""
    x = z_scores.join(cohort, "sample_id")
    steady = x.groupBy("disease", "pgs_id").agg(F.stddev_pop("z").alias("_s")).where(F.col("_s") >= min_std).select("disease", "pgs_id")
    return stats.rank_auc(x.join(steady, ["disease", "pgs_id"]), "z", "label", ["disease", "pgs_id"])


def compared(model: DataFrame, single: DataFrame, named: DataFrame) -> DataFrame:
    """For each disease: how many of its named scores (disease, pgs_id) and of all scores the model beats, the best of each, and the margins."""
    own = single.join(named, ["disease", "pgs_id"], "left_semi").select("disease", "pgs_id", F.col("auc").alias("own"))
    x = single.withColumnRenamed("auc", "other").join(own, ["disease", "pgs_id"], "left").join(model.select("disease", "auc"), "disease")
    beats = lambda c: F.count_if(F.col("auc") > F.col(c))
    return x.groupBy("disease").agg(F.max("auc").alias("auc"), F.count("own").alias("n_own"), beats("own").alias("beaten_own"), F.max("own").alias("best_own"), F.count("*").alias("n_all"), beats("other").alias("beaten_all"), F.max("other").alias("best_all"), F.median(F.col("auc") - F.col("own")).alias("median_margin"))


def people_of(spark: SparkSession, jobs: str, manifest: DataFrame, n_pcs: int = 10) -> DataFrame:
    """(sample_id, label, sex, age, pop_probs, pc1, ...) of the manifest's barcodes: places and populations from their jobs' ancestry tables."""
    found = text.read_ancestry(spark, f"{jobs}/jobs/*/results/ancestry.tsv").select(text.job_id(F.col("file")).alias("job_id"), "pc", "pop_probs")
    x = manifest.join(found, "job_id", "left").groupBy("barcode").agg(*(F.max_by(c, "job_id").alias(c) for c in ("label", "sex", "age", "pc", "pop_probs")))
    pcs = [F.coalesce(F.get("pc", F.lit(k)), F.lit(0.0)).alias(f"pc{k + 1}") for k in range(n_pcs)]
    return x.select(F.col("barcode").alias("sample_id"), "label", "sex", F.col("age").try_cast("double").alias("age"), "pop_probs", *pcs)


def run(spark: SparkSession, jobs: str, manifest: str, ref_scores: DataFrame, ref_pcs: DataFrame, quality: DataFrame, metadata: DataFrame, families: dict[str, str], out: str, healthy: str = "Healthy", n_pcs: int = 10, k: int = 15, threshold: float = 0.18, boots: int = 25, folds: int = 5, trees: int = 500, depth: int = 12, permutations: int = 100, null_trees: int = 200, null_depth: int = 8, draws: int = 1000, seed: int = 42, min_size: int = 3, min_jaccard: float = 0.70) -> None:
    """The whole analysis of a cohort, from its jobs' results to the tables, reports and models under out.

    ref_scores: pgs_id, sample_id, score. ref_pcs: sample_id, pc1, .... quality: pgs_id, total.
    metadata: see text.read_metadata. families: the metadata's family of each disease, whose scores it is compared to.
    """
    from skein.plans.bundle import feature_names, feature_rows

    columns = [f"pc{i + 1}" for i in range(n_pcs)]
    with sinks.RunRecord(spark, out, jobs=jobs, manifest=manifest, k=k, threshold=threshold, boots=boots, folds=folds, trees=trees, permutations=permutations, seed=seed) as record:
        with record.step("scores of the cohort"):
            rows = text.read_manifest(spark, manifest)
            people = written(people_of(spark, jobs, rows, n_pcs))
            text.read_jobs(spark, jobs, rows).withColumnRenamed("barcode", "sample_id").write.mode("overwrite").parquet(f"{out}/z_scores")
            z = spark.read.parquet(f"{out}/z_scores")
            ids = sorted(r.pgs_id for r in z.select("pgs_id").distinct().collect())  # the columns of the wide table
            sinks.write_tsv(wide(z, "sample_id", "pgs_id", "z", ids), f"{out}/z_matrix")
            sinks.write_tsv(people.select("sample_id", "label", *(F.try_element_at("pop_probs", F.lit(p)).alias(f"RF_P_{p}") for p in POPULATIONS)), f"{out}/patient_ancestry")
        with record.step("atlas"):
            residual = written(stats.residualised(ref_scores, ref_pcs, columns).select("pgs_id", "sample_id", F.col("residual").alias("score")))
            modules, members = (written(x) for x in stable_modules(residual, k, threshold, boots, seed=seed, min_size=min_size, min_jaccard=min_jaccard))
            listed = F.sort_array(F.collect_list(F.struct("pgs_id", F.round("loading", 5).alias("loading"))))
            sinks.write_json(members.groupBy("module").agg(listed.alias("members")).join(modules.withColumnRenamed("community", "module"), "module"), f"{out}/atlas_modules")
        with record.step("module scores"):
            weights = module_weights(members, quality)
            fits = written(fit_modules(weights, residual, ref_pcs, columns))
            scores = written(module_scores(fits, weights, z, people.select("sample_id", *columns), columns))
            order = sorted(r.module for r in fits.select("module").collect())
            both = [wide(scores, "sample_id", "module", c, order).select("sample_id", *(F.round(f"`{m}`", 4).alias(f"{name}_{m}") for m in order)) for name, c in (("z", "z"), ("rel", "reliability"))]
            sinks.write_tsv(people.select("sample_id", "label").join(both[0], "sample_id").join(both[1], "sample_id"), f"{out}/patient_module_scores")
        with record.step("classifiers"):
            ages = people.agg(F.avg("age").alias("m"), F.stddev_pop("age").alias("s")).first()
            full = written(feature_rows(scores, people, order, ages.m or 0.0, ages.s or 0.0))
            genome = written(ml.features(full.drop("features").join(both[0], "sample_id").join(both[1], "sample_id"), [c for part in both for c in part.columns[1:]]).select("sample_id", "label", "features"))
            diseases = sorted(r.label for r in people.select("label").distinct().collect() if r.label not in (healthy, None))
            found, plain = (written(one_against_healthy(x, "sample_id", "label", diseases, healthy, folds, trees, depth, seed)) for x in (full, genome))
            truth = people.where(F.col("label") != healthy).select("sample_id", F.col("label").alias("truth"))
            right, right_plain = (ranked_accuracy(x, truth, "sample_id").first() for x in (found, plain))
            sinks.write_json(stats.rank_auc(found.where("label is not null"), "p", "label", ["disease", "fold"], symmetric=False), f"{out}/per_fold_aucs")
            renamed = prediction_table(plain, "sample_id", diseases).select("sample_id", *(F.col(f"`{d}`").alias(f"genome_prob_{d}") for d in diseases), F.col("top1_disease").alias("genome_rank1"))
            sinks.write_tsv(people.select("sample_id", F.col("label").alias("true_label")).join(prediction_table(found, "sample_id", diseases), "sample_id").join(renamed, "sample_id"), f"{out}/patient_predictions")
            sinks.write_json(stats.confusion(found.where("label is not null").withColumn("_hit", (F.col("p") >= 0.5).cast("int")), F.col("label"), F.col("_hit"), ["disease"]), f"{out}/confusion")
            best = found.groupBy("sample_id").agg(F.max_by("disease", F.struct("p", F.lit(0))).alias("predicted")).join(truth, "sample_id")
            sinks.write_json(stats.confusion_matrix(best, "truth", "predicted", diseases), f"{out}/confusion_matrix")

            def final(disease: str) -> list[tuple]:
                own = full.where(F.col("label").isin(disease, healthy)).withColumn("_y", (F.col("label") == disease).cast("double"))
                model = ml.train_forest(own, "_y", trees, depth, seed)
                model.write().overwrite().save(f"{out}/models/{disease}")
                return [(disease, place, name, value) for place, (name, value) in enumerate(ml.importances(model, feature_names(order), 20), 1)]

            top = [row for part in _each(final, diseases) for row in part]
            sinks.write_json(spark.createDataFrame(top, "disease string, place int, feature string, importance double"), f"{out}/feature_importances")
        with record.step("checks"):
            null = permutation_null(full.select("sample_id", "label", "features"), "sample_id", "label", diseases, permutations, healthy, folds, null_trees, null_depth)
            null = written(null)
            sinks.write_json(null, f"{out}/permutation_null")
            sigma = resample.null_summary(null, "top1", right.top1).first() if permutations else None
            intervals = written(area_intervals(found, "sample_id", draws, seed))
            sinks.write_json(intervals, f"{out}/intervals")
            names = spark.createDataFrame([(d,) for d in diseases], "disease string")
            cohort = people.select("sample_id", F.col("label").alias("_l")).crossJoin(F.broadcast(names)).where((F.col("_l") == F.col("disease")) | (F.col("_l") == healthy)).select("sample_id", "disease", (F.col("_l") == F.col("disease")).cast("int").alias("label"))  # a row for each disease
            single = written(stress_test(z, cohort))
            own = spark.createDataFrame(list(families.items()), "disease string, family_primary string")
            for name, kept in (("margins_all", metadata), ("margins_clean", metadata.where("not proxy_trait_flag and not technical_trait_flag"))):
                sinks.write_json(compared(fold_areas(found), single, kept.join(F.broadcast(own), "family_primary").select("disease", "pgs_id")), f"{out}/{name}")
            record.facts |= {
                "multiclass": {"top1": right.top1, "top3": right.top3}, "multiclass_genome": {"top1": right_plain.top1, "top3": right_plain.top3},
                "permutation": sigma.asDict() if sigma else None, "atlas": {"n_ref_samples": ref_pcs.count(), "n_retained": len(order), "n_boot": boots}, "metadata": {"n_patients": people.count(), "n_diseases": len(diseases)}}
            sinks.write_json(spark.createDataFrame([(json.dumps(record.facts, default=str),)], "results string"), f"{out}/results")
