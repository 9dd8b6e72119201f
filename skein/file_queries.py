"""Readers and writers of text files as queries: tables are written as the files that a reader takes, under a new folder of the shared one, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import rules
from skein.operators import score
from skein.queries import W_SQL, query, r, t, weights
from skein.session import shared_dir
from skein.sources import sinks, text


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _tsv(df: DataFrame, path: str, order: list[str] | None = None) -> str:
    """df as a table of tabs with a header; where the order means something, in files of ranges whose names have this order."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out.write.option("sep", "\t").option("header", True).csv(path)
    return path


def _lines(df: DataFrame, path: str) -> str:
    df.write.text(path)
    return path


@query("""SELECT CAST(c_custkey AS VARCHAR) AS sample_id, pgs_id, round(CASE pgs_id WHEN 'P1' THEN c_acctbal + c_nationkey ELSE c_custkey % 7 + c_acctbal END, 4) + 0.0 AS score FROM customer, (SELECT unnest(['P1', 'P2']) AS pgs_id)""")
def q80_score_sums(spark, d):
    """Two wide score tables of the same samples, whose sums add up."""
    c, path = t(spark, d, "customer"), _folder(spark, "sums")
    wide = lambda a, b: c.select(F.lit("f").alias("#FID"), F.col("c_custkey").alias("IID"), a.cast("double").alias("P1_SUM"), b.cast("double").alias("P2_SUM"))
    _tsv(wide(F.col("c_acctbal"), F.pmod("c_custkey", F.lit(7))).unionByName(wide(F.col("c_nationkey"), F.col("c_acctbal"))), path)
    return text.read_sums(spark, path).select("sample_id", "pgs_id", r(F.col("score"), 4).alias("score"))


@query("SELECT CAST(c_nationkey AS VARCHAR) AS job_id, CAST(max(c_custkey) AS VARCHAR) AS barcode, arg_max(c_mktsegment, c_custkey) AS label FROM customer GROUP BY 1")
def q81_manifest(spark, d):
    """A manifest with a row for each customer: of equal jobs the last row stands."""
    path = _folder(spark, "manifest")
    rows = t(spark, d, "customer").select(F.col("c_nationkey").alias("job_id"), F.col("c_custkey").alias("barcode"), F.col("c_mktsegment").alias("label"))
    rows.repartitionByRange("barcode").sortWithinPartitions("barcode").write.option("header", True).csv(path)
    return text.read_manifest(spark, path).select("job_id", "barcode", "label")


@query("""SELECT 'PGS' || s_suppkey AS id, s_nationkey AS n_evals, round(0.5 + (s_suppkey % 10) / 20.0::DOUBLE, 6) AS auroc, s_suppkey % 5 * 1000 AS variants_number, s_name AS trait_reported,
  round(s_suppkey % 101::DOUBLE, 6) AS eur, CAST(least(40, greatest(0, round_even((0.5 + (s_suppkey % 10) / 20.0::DOUBLE - 0.5) * 80, 0)) + CASE WHEN s_nationkey >= 10 THEN 2 ELSE 0 END) AS INT) AS points FROM supplier""")
def q82_catalog(spark, d):
    """Suppliers as a catalogue of scores and a file of their measures, read back and rated."""
    s, folder = t(spark, d, "supplier").withColumn("id", F.concat(F.lit("PGS"), "s_suppkey")), _folder(spark, "catalog")
    gwas = F.struct(F.lit(1).cast("long").alias("count"), F.create_map(F.lit("EUR"), (F.col("s_suppkey") % 101).cast("double")).alias("dist"))
    s.select("id", F.lit("LDpred").alias("method_name"), F.col("s_name").alias("trait_reported"), (F.col("s_suppkey") % 5 * 1000).alias("variants_number"), F.struct(gwas.alias("gwas")).alias("ancestry_distribution")).write.json(f"{folder}/scores")
    measures = F.struct((0.5 + (F.col("s_suppkey") % 10) / 20.0).alias("auroc_median"), F.col("s_nationkey").cast("long").alias("n_evals"))
    # The file maps each score to its measures: one object, as the reader takes it.
    s.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("id", measures.alias("m"))))).alias("value")).write.text(f"{folder}/performance")
    found = spark.read.schema(text.CATALOG_SCHEMA).json(f"{folder}/scores").join(text.read_performance(spark, f"{folder}/performance/*.txt"), "id")
    p, none = F.col("performance"), F.lit(None).cast("double")
    rated = rules.performance(p["auroc_median"], none, none, p["n_evals"], F.col("method_name"), none)
    return found.select("id", p["n_evals"].cast("int").alias("n_evals"), r(p["auroc_median"]).alias("auroc"), "variants_number", "trait_reported", r(F.col("ancestry_distribution.gwas.dist")["EUR"]).alias("eur"), rated["score"].alias("points"))


@query("""SELECT 's' || p_partkey AS id, round(CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size / 100.0::DOUBLE END, 6) AS afreq, p_partkey % 3 = 0 AS kept FROM part""")
def q83_panel_lists(spark, d):
    """part as a panel's sample list and its frequency list; a third of the samples are asked for."""
    part, folder = t(spark, d, "part").withColumn("id", F.concat(F.lit("s"), "p_partkey")), _folder(spark, "lists")
    ordered = part.repartitionByRange(1, "p_partkey").sortWithinPartitions("p_partkey")
    head = lambda line: spark.createDataFrame([(line,)], "value string")
    _lines(head("#FID\tIID\tSEX").unionByName(ordered.select(F.concat_ws("\t", F.lit("f"), "id", F.lit("1")).alias("value"))).coalesce(1), f"{folder}/psam")
    _lines(head("#CHROM\tID\tREF\tALT\tALT_FREQS").unionByName(part.select(F.concat_ws("\t", F.lit("1"), "id", F.lit("A"), F.lit("G"), F.when(F.col("p_size") % 9 == 0, "nan?").otherwise((F.col("p_size") / 100).cast("string"))).alias("value"))), f"{folder}/afreq")
    wanted = part.where("p_partkey % 3 = 0").select(F.col("id").alias("iid"))
    kept = text.read_samples(spark, f"{folder}/psam", wanted).select(F.col("iid").alias("id"), F.lit(True).alias("_kept"))
    everyone = text.read_samples(spark, f"{folder}/psam").select(F.col("iid").alias("id"))
    out = everyone.join(text.read_frequencies(spark, f"{folder}/afreq"), "id").join(kept, "id", "left")
    return out.select("id", r(F.col("afreq")).alias("afreq"), F.coalesce("_kept", F.lit(False)).alias("kept"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS sample_id, round(c_acctbal / 1000, 6) + 0.0 AS pc1, round(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_nationkey END::DOUBLE, 6) AS pc2, 0.0::DOUBLE AS pc10,
  round((c_custkey % 11) / 10.0::DOUBLE, 6) AS eur, round(1 - (c_custkey % 11) / 10.0::DOUBLE, 6) + 0.0 AS afr, c_mktsegment AS most_similar, c_custkey % 2 = 0 AS low_confidence FROM customer""")
def q84_ancestry(spark, d):
    """Customers as an ancestry table: cells that aren't numbers are 0, columns that it lacks too."""
    k, path = F.col("c_custkey"), _folder(spark, "ancestry")
    rows = t(spark, d, "customer").select(k.alias("sample_id"), (F.col("c_acctbal") / 1000).alias("PC1"), F.when(k % 4 == 0, "none").otherwise(F.col("c_nationkey").cast("string")).alias("PC2"), ((k % 11) / 10).alias("RF_P_EUR"), (1 - (k % 11) / 10).alias("RF_P_AFR"), F.col("c_mktsegment").alias("MostSimilarPop"), F.when(k % 2 == 0, "True").otherwise("False").alias("LowConfidence"))
    found = text.read_ancestry(spark, _tsv(rows, path))
    pc = lambda n: r(F.get("pc", F.lit(n - 1)))
    return found.select("sample_id", pc(1).alias("pc1"), pc(2).alias("pc2"), pc(10).alias("pc10"), r(F.col("pop_probs")["EUR"]).alias("eur"), r(F.col("pop_probs")["AFR"]).alias("afr"), "most_similar", "low_confidence")


@query("""SELECT 'P' || (o_custkey % 50) AS pgs_id, round(arg_max(CAST(o_totalprice AS DOUBLE), o_orderkey), 4) + 0.0 AS z FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1""")
def q85_patient(spark, d):
    """orders as one patient's adjusted scores: rows without a number are left out, of equal scores the last stands."""
    path = _folder(spark, "patient")
    rows = t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("P"), F.pmod("o_custkey", F.lit(50))).alias("pgs_id"), F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice").cast("string")).otherwise("NA").alias("Z_norm1"), F.lit("9").alias("Z_norm2"))
    return text.read_patient(spark, _tsv(rows, path, ["o_orderkey"])).select("pgs_id", r(F.col("z"), 4).alias("z"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS pgs_id, CASE WHEN p_size % 4 <> 0 THEN p_type END AS family_primary, coalesce(CASE WHEN p_size % 3 <> 0 THEN p_size % 2 = 0 END, false) AS proxy_trait_flag, false AS technical_trait_flag FROM part")
def q86_metadata(spark, d):
    """part as a metadata table that lacks a column: missing flags are false."""
    path, size = _folder(spark, "metadata"), F.col("p_size")
    t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("pgs_id"), F.when(size % 4 != 0, F.col("p_type")).alias("family_primary"), F.when(size % 3 != 0, size % 2 == 0).alias("proxy_trait_flag")).write.parquet(path)
    return text.read_metadata(spark, path)


@query(f"""WITH {W_SQL} SELECT 'a' AS sample_id, CAST(pgs_id AS VARCHAR) AS pgs_id, round(sum(d * weight), 4) + 0.0 AS raw_score, count(*) AS variants_matched, count(*) AS variants_total, 1.0::DOUBLE AS match_rate FROM s GROUP BY pgs_id""")
def q87_score_tables(spark, d):
    """Scores of lineitem, written as a table of tabs and read back."""
    path = _folder(spark, "scores")
    w = weights(spark, d).withColumn("sample_id", F.lit("a"))
    scores = score.weighted_scores(w, w.groupBy("pgs_id").agg(F.count("*").alias("num_original")))
    sinks.write_tsv(sinks.score_table(scores), path)
    return text.read_raw_scores(spark, path).select("sample_id", "pgs_id", r(F.col("raw_score"), 4).alias("raw_score"), "variants_matched", "variants_total", "match_rate")
