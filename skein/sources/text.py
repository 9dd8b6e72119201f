"""Text formats: variant calls, score files, variant lists, panels, results.

Everything is read with Spark's own readers, so paths may be folders, globs and any file system
Spark knows; gzip files are read whole by one task each and dealt out afterwards, unless they are read by
blocks (``read_calls``, ``blocks.block_lines``). Line order is
kept by an id where the meaning depends on it (headers first, first row wins).
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import clean
from skein.functions.keys import complement, fnv14, variant_key
from skein.operators.dosage import allele_dosage, expand_alternatives
from skein.operators.match import first_wins
from skein.sources.blocks import SPLIT, block_lines

VCF_FIXED = ("chrom", "pos", "id", "ref", "alt")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of the lines of text files; numbers ascend within a file, not always by one."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line_no"), "value")


def vcf_header(text: DataFrame) -> DataFrame:
    """file, build (of the last header line that names one, else unknown) and the sample names of each call file."""
    low = F.lower("value")
    build = F.when(low.rlike("grch38|hg38"), "GRCh38").when(low.rlike("grch37|hg19"), "GRCh37")
    heads = text.where(F.col("value").startswith("#"))
    named = heads.withColumn("_b", F.when(F.col("value").startswith("##"), build)).groupBy("file").agg(
        F.max_by("_b", F.when(F.col("_b").isNotNull(), F.col("line_no"))).alias("build"), F.max(F.when(F.col("value").startswith("#CHROM"), F.slice(F.split("value", "\t"), 10, 100_000))).alias("samples"))
    return named.select("file", F.coalesce("build", F.lit("unknown")).alias("build"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def read_vcf(spark: SparkSession, path: str, sample_index: int = 0, missing: str = "zero", hashed: bool = True) -> DataFrame:
    """parse_vcf of files."""
    return parse_vcf(lines(spark, path), sample_index, missing, hashed)


def read_calls(spark: SparkSession, path: str, sample_index: int = 0, missing: str = "zero", hashed: bool = True, split_bytes: int = SPLIT, regions: list[str] | None = None, in_order: bool = False) -> DataFrame:
    """read_vcf of block-compressed files: many tasks read one file, and only the sample's column and, if stated, the regions leave them."""
    return parse_vcf(block_lines(spark, path, split_bytes, [*range(9), 9 + sample_index], regions, in_order), 0, missing, hashed)


def parse_vcf(text: DataFrame, sample_index: int = 0, missing: str = "zero", hashed: bool = True) -> DataFrame:
    """Genotypes of a sample: sample_id, build, vkey, chrom, pos, ref, alt, dosage, rsid, line_no; one row for each alternative allele, the first of equal variants.

    Lines of fewer than ten fields or without an integer position are skipped, and so are
    chromosomes without a number. hashed: equal means equal keys, else equal alleles.
    """
    f = F.split("value", "\t")
    body = text.where(~F.col("value").startswith("#")).where(F.size(f) >= 10)
    rows = body.select("file", "line_no", *(F.get(f, F.lit(k)).alias(n) for k, n in enumerate(VCF_FIXED)), F.get(f, F.lit(9 + sample_index)).alias("genotype"))
    rows = rows.withColumn("pos", F.col("pos").try_cast("int")).where("pos is not null and genotype is not null").withColumns({"ref": F.upper("ref"), "alt": F.upper("alt")})
    rows = expand_alternatives(rows, missing=missing).withColumn("vkey", variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))).where("vkey <> 0")
    rows = rows.withColumn("rsid", F.when(clean.is_rsid(F.col("id")), F.lower("id")))
    once = first_wins(rows, ["file", "vkey"] if hashed else ["file", "chrom", "pos", "ref", "alt"], ["line_no", "alt_index"])
    head = vcf_header(text)
    return once.join(F.broadcast(head), "file", "left").select(F.coalesce(F.get("samples", F.lit(sample_index)), F.lit("sample")).alias("sample_id"), F.coalesce("build", F.lit("unknown")).alias("build"), "vkey", "chrom", "pos", "ref", "alt", "dosage", "rsid", "line_no")  # one header row for each file


def parse_panel(text: DataFrame, keep: list[str] | None = None, frequencies: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(panel, samples) of call lines with many samples: panel vkey, id, dosages (of the first alternative, null where not called) and afreq; samples place and sample_id, in the dosages' order.

    keep: the samples to take. frequencies (id, afreq): in place of the panel's own. A variant is one row from line to
    store, so the panel is spread however many variants it has; of equal keys the first line stands.
    """
    head = vcf_header(text).select("file", "samples")
    wanted = F.array(*(F.lit(s) for s in keep)) if keep is not None else None
    at = F.transform("samples", lambda n, k: F.struct(k.alias("k"), n.alias("n")))
    at = F.filter(at, lambda x: F.array_contains(wanted, x["n"])) if keep is not None else at
    head = head.withColumn("at", at)
    samples = head.orderBy("file").limit(1).select(F.posexplode("at").alias("place", "_x")).select("place", F.col("_x.n").alias("sample_id"))
    f = F.split("value", "\t")
    part = lambda k: F.get(f, F.lit(k))
    rows = text.where(~F.col("value").startswith("#")).where(F.size(f) >= 10).join(F.broadcast(head.select("file", "at")), "file")  # one header row for each file
    alt = F.get(F.split(part(4), ","), F.lit(0))
    rows = rows.where(part(1).try_cast("int").isNotNull() & ~alt.isin("*", ".", ""))
    keyed = rows.select("line_no", variant_key(part(0), part(1).try_cast("int"), F.upper(part(3)), F.upper(alt)).alias("vkey"), part(2).alias("id"), F.transform("at", lambda x: allele_dosage(F.get(f, x["k"] + 9), F.lit(1), "null").cast("tinyint")).alias("dosages"))
    once = first_wins(keyed.where("vkey <> 0"), ["vkey"], ["line_no"])
    known = F.filter("dosages", lambda x: x.isNotNull())
    own = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / (2 * F.size(known))).otherwise(0.0)
    if frequencies is not None:
        named = frequencies.where("afreq is not null").groupBy("id").agg(F.min("afreq").alias("_f"))
        once = once.join(named, "id", "left").withColumn("afreq", F.coalesce("_f", own)).drop("_f")
    else:
        once = once.withColumn("afreq", own)
    return once.select("vkey", "id", "dosages", "afreq"), samples


def read_panel(spark: SparkSession, path: str, keep: list[str] | None = None, frequencies: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """parse_panel of files."""
    return parse_panel(lines(spark, path), keep, frequencies)


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, ref, alt (the first) of a variant list with the columns chrom, pos, id, ref, alt."""
    f = F.split("value", r"\s+")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) >= 5)
    part = lambda k: F.get(f, F.lit(k))
    return rows.select(F.regexp_replace(part(0), "^chr", "").alias("chrom"), part(1).try_cast("int").alias("pos"), F.upper(part(3)).alias("ref"), F.upper(F.get(F.split(part(4), ","), F.lit(0))).alias("alt")).where("pos is not null")


def _table_rows(text: DataFrame) -> DataFrame:
    """file, line_no, cells and at (map of lower-cased column name to its place) of files whose first line without # is a header. Tabs part cells; where there are none, white space does."""
    text = text.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    cut = lambda c: F.when(c.contains("\t"), F.split(c, "\t")).otherwise(F.split(F.trim(c), r"\s+"))
    heads = text.groupBy("file").agg(F.min("line_no").alias("_head"), F.min_by("value", "line_no").alias("_header")).withColumn("_names", cut(F.lower("_header")))
    last = lambda name, k: ~F.exists(F.slice(F.col("_names"), k + 2, F.size("_names")), lambda y: y == name)
    placed = F.filter(F.transform("_names", lambda n, k: F.when(last(n, k), F.struct(n.alias("key"), k.alias("value")))), lambda x: x.isNotNull())
    heads = heads.select("file", "_head", F.map_from_entries(placed).alias("at"))  # one header for each file, read once
    rows = text.join(F.broadcast(heads), "file").where("line_no > _head")
    return rows.select("file", "line_no", cut(F.col("value")).alias("cells"), "at").where(F.size("cells") >= 4)


class _Cells(dict):
    """Cleaned cells by column name, as expressions on cells and at; names that a file lacks are null."""

    def __init__(self, names, tokens=clean.NULL_TOKENS) -> None:
        super().__init__({n: clean.clean(F.get(F.col("cells"), F.try_element_at(F.col("at"), F.lit(n))), tokens) for n in names})


#: What the narrower reading of score files takes: fewer columns, and fewer cells that mean nothing (fixed values).
NARROW = {"chrom": ("hm_chr", "chr_name"), "pos": ("hm_pos", "chr_position"), "other": ("other_allele", "hm_inferotherallele"), "weight": "effect_weight", "tokens": (".", "", "NA")}


def parse_scores_narrow(text: DataFrame) -> DataFrame:
    """Usable rows of score files by the narrower reading: pgs_id, line_no, chrom (without chr), pos, effect, other (null where it names several), weight, model."""
    c = _Cells({*NARROW["chrom"], *NARROW["pos"], *NARROW["other"], NARROW["weight"], "effect_allele", "is_dominant", "is_recessive"}, NARROW["tokens"])
    first = lambda names: clean.first_of([c[n] for n in names])
    other = first(NARROW["other"])
    rows = _table_rows(text).select(
        score_id(F.col("file")).alias("pgs_id"), "line_no", F.regexp_replace(first(NARROW["chrom"]), "^[chr]+", "").alias("chrom"), first(NARROW["pos"]).try_cast("int").alias("pos"), F.upper(c["effect_allele"]).alias("effect"),
        F.upper(F.when(~other.contains("/"), other)).alias("other"), c[NARROW["weight"]].try_cast("double").alias("weight"), clean.model_code(c["is_dominant"], c["is_recessive"]).alias("model"))
    return rows.where("chrom is not null and pos is not null and effect is not null and weight is not null")


def score_id(file: Column) -> Column:
    """The score that a file is named after."""
    return F.upper(F.regexp_extract(file, r"([^/]+?)(?:_hmPOS_GRCh\d+)?(?:\.txt|\.tsv)?(?:\.gz)?$", 1))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """parse_scores of files."""
    return parse_scores(lines(spark, path))


def parse_scores(text: DataFrame) -> DataFrame:
    """Rows of score files: pgs_id (of the file's name), line_no, chrom, pos, effect, other, weight, model, rsid, usable.

    Columns are found by name, each from several candidates in order of preference; a row is
    usable if it has a chromosome, a position other than 0, an effect allele and a weight.
    """
    c = _Cells({*clean.CHROMOSOME_COLUMNS, *clean.POSITION_COLUMNS, *clean.WEIGHT_COLUMNS, *clean.OTHER_ALLELE_COLUMNS, *clean.RSID_COLUMNS, "effect_allele", "variant_description", "is_dominant", "is_recessive"})
    effect = F.upper(c["effect_allele"])
    rows = _table_rows(text).select(
        score_id(F.col("file")).alias("pgs_id"), "line_no",
        clean.first_of([c[n] for n in clean.CHROMOSOME_COLUMNS]).alias("chrom"), clean.first_of([c[n].try_cast("int") for n in clean.POSITION_COLUMNS]).alias("pos"), effect.alias("effect"),
        clean.other_allele_of(c, effect).alias("other"), clean.weight_of(c).alias("weight"), clean.model_code(c["is_dominant"], c["is_recessive"]).alias("model"), clean.first_of([c[n] for n in clean.RSID_COLUMNS]).alias("rsid"))
    usable = F.col("chrom").isNotNull() & (F.coalesce("pos", F.lit(0)) != 0) & F.col("effect").isNotNull() & F.col("weight").isNotNull()
    return rows.withColumn("usable", usable)


def weight_rows(scores: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Usable score rows as weights on variant keys: pgs_id, vkey, weight, flip, model, rank (of the row and orientation), source.

    A row with both alleles stands in its orientations, palindromes in none. A row without the
    other allele is resolved against the target's variants at its position, and as a wildcard
    where it meets none. Of rows of one score on one key the first stands.
    """
    rows = scores.where("usable")
    keyed = lambda df: df.withColumn("vkey", variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"), autosomes=True)).where("vkey <> 0")
    base = ("pgs_id", "line_no", "chrom", "pos", "effect", "weight", "model")
    both = rows.where("other is not null").select(*base, F.posexplode(clean.orientations(F.col("effect"), F.col("other"))).alias("k", "o")).select(*base, "k", "o.ref", "o.alt", "o.flip", F.lit("both").alias("source"))
    alone = rows.where("other is null").select(*base)
    if target is not None:
        known = target.select("chrom", "pos", "ref", "alt").distinct()
        met = alone.join(known, ["chrom", "pos"]).withColumn("flip", clean.orientation_to(F.col("effect"), F.col("ref"), F.col("alt"))).where("flip is not null")
        resolved = met.select(*base, F.lit(0).alias("k"), "ref", "alt", "flip", F.lit("target").alias("source"))
        alone = alone.join(met.select("pgs_id", "line_no").distinct(), ["pgs_id", "line_no"], "left_anti")
        both = both.unionByName(resolved)
    wild = alone.select(*base, F.posexplode(clean.wildcards(F.col("effect"))).alias("k", "o")).select(*base, "k", "o.ref", "o.alt", "o.flip", F.lit("wildcard").alias("source"))
    out = keyed(both.unionByName(wild))
    return first_wins(out, ["pgs_id", "vkey"], ["line_no", "k", "ref", "alt"]).select("pgs_id", "vkey", "weight", "flip", "model", "line_no", "source")


def rsid_rows(scores: DataFrame) -> DataFrame:
    """Usable score rows with an rs number: pgs_id, rsid, weight, eff14, oth14, model. Palindromes stay in."""
    rows = scores.where("usable").where(clean.is_rsid(F.col("rsid")))
    return rows.select("pgs_id", F.lower("rsid").alias("rsid"), "weight", fnv14(F.col("effect")).cast("int").alias("eff14"), F.coalesce(fnv14(F.col("other")), F.lit(0)).cast("int").alias("oth14"), "model", "line_no")


def weight_meta(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """pgs_id, num_original (usable rows), num_variants (keys), num_skipped (rows on no key) and the weights' statistics."""
    w = F.col("weight").cast("double")
    original = scores.groupBy("pgs_id").agg(F.count_if("usable").alias("num_original"))
    keys = weights.groupBy("pgs_id").agg(F.count("*").alias("num_variants"), F.count_distinct("line_no").alias("_rows"), F.sum(w).alias("weight_sum"), F.avg(w).alias("weight_mean"), F.min(w).alias("weight_min"), F.max(w).alias("weight_max"))
    zero = F.lit(0).cast("long")
    return original.join(keys, "pgs_id", "left").select("pgs_id", "num_original", F.coalesce("num_variants", zero).alias("num_variants"), (F.col("num_original") - F.coalesce("_rows", zero)).alias("num_skipped"), "weight_sum", "weight_mean", "weight_min", "weight_max")


def read_tsv(spark: SparkSession, path: str, schema: str | None = None, null: str = "NA") -> DataFrame:
    reader = spark.read.option("sep", "\t").option("header", True).option("nullValue", null)
    return (reader.schema(schema) if schema else reader).csv(path)


SCORES_SCHEMA = "sample_id string, pgs_id string, raw_score double, variants_matched long, variants_total long, match_rate double, time_seconds double"


def read_raw_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, SCORES_SCHEMA)


def read_samples(spark: SparkSession, path: str, keep: DataFrame | None = None) -> DataFrame:
    """Sample ids of a panel's sample list (with or without a family column), in order (position); of keep (iid) only, if given."""
    text = lines(spark, path)
    header = text.where(F.col("value").startswith("#")).agg(F.min_by("value", "line_no").alias("_h"))
    f = F.split("value", r"\s+")
    rows = text.where(~F.col("value").startswith("#") & (F.trim("value") != "")).crossJoin(header)  # one row
    iid = F.when(F.upper(F.coalesce("_h", F.lit(""))).startswith("#FID"), F.get(f, F.lit(1))).otherwise(F.get(f, F.lit(0)))
    out = rows.select("line_no", iid.alias("iid"))
    return out.join(keep.select("iid").distinct(), "iid", "left_semi") if keep is not None else out


def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """id and afreq (fifth column) of a frequency list."""
    f = F.split("value", r"\s+")
    return spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) >= 5).select(F.get(f, F.lit(1)).alias("id"), F.get(f, F.lit(4)).try_cast("double").alias("afreq"))


def read_sums(spark: SparkSession, path: str, samples: DataFrame | None = None) -> DataFrame:
    """(sample_id, pgs_id, score) of wide score tables whose score columns end in _SUM; scores of several files of one sample add up. samples (sample_id): each gets a row, 0 where it has none."""
    wide = spark.read.option("sep", "\t").option("header", True).csv(path)
    iid = next(c for c in wide.columns if c.lstrip("#") == "IID")
    sums = [c for c in wide.columns if c.endswith("_SUM")]
    renamed = wide.select(F.col(iid).alias("sample_id"), *(F.col(f"`{c}`").try_cast("double").alias(c[: -len("_SUM")]) for c in sums))
    long = renamed.unpivot(["sample_id"], [c[: -len("_SUM")] for c in sums], "pgs_id", "score").groupBy("sample_id", "pgs_id").agg(F.sum("score").alias("score"))
    if samples is None:
        return long
    every = samples.select("sample_id").distinct().crossJoin(long.select("pgs_id").distinct())  # the result has a row for each pair
    return every.join(long, ["sample_id", "pgs_id"], "left").fillna(0.0, ["score"])


def place() -> Column:
    """Where a row of files stands: by the files' names, and in a file from its begin. Splits of a file are read in the order of their tasks' numbers."""
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())


def read_manifest(spark: SparkSession, path: str, key: str = "job_id") -> DataFrame:
    """A manifest's rows by key, the last of equal ones."""
    rows = spark.read.option("header", True).csv(path).withColumn("_seq", place())
    others = [c for c in rows.columns if c not in (key, "_seq")]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), "_seq").alias("_r"))
    return best.select(key, *(F.col("_r")[c].alias(c) for c in others))


def job_id(path: Column) -> Column:
    """The second part, by underscores, of the job folder's name."""
    folder = F.regexp_extract(path, r"([^/]+)/results/[^/]+$", 1)
    return F.coalesce(F.get(F.split(folder, "_"), F.lit(1)), F.lit(""))


def read_jobs(spark: SparkSession, root: str, manifest: DataFrame, not_a_number: float | None = 0.0) -> DataFrame:
    """(barcode, pgs_id, z) of all jobs in the manifest: jobs/*/results/scores_adjusted.tsv, the last row of each pair.

    z is Z_norm1, else Z_MostSimilarPop; what isn't a finite number becomes not_a_number.
    """
    rows = spark.read.option("sep", "\t").option("header", True).csv(f"{root}/jobs/*/results/scores_adjusted.tsv")
    name = "Z_norm1" if "Z_norm1" in rows.columns else "Z_MostSimilarPop"
    z = clean.no_nan(F.col(name).try_cast("double")) if name in rows.columns else F.lit(None).cast("double")
    tagged = rows.select(job_id(F.col("_metadata.file_path")).alias("job_id"), "pgs_id", F.coalesce(z, F.lit(not_a_number)).alias("z"), F.monotonically_increasing_id().alias("_seq"))
    joined = tagged.join(F.broadcast(manifest.select("job_id", "barcode")), "job_id")  # one row for each job
    return joined.groupBy("barcode", "pgs_id").agg(F.max_by("z", "_seq").alias("z"))


def skipped_jobs(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Job ids that have results and no manifest row."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(f"{root}/jobs/*/results/scores_adjusted.tsv")
    return rows.select(job_id(F.col("_metadata.file_path")).alias("job_id")).distinct().join(manifest, "job_id", "left_anti")


def read_ancestry(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, pc (array of ten), pop_probs (map), most_similar, low_confidence of ancestry tables; cells that aren't numbers are 0."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0)
    pops = [c for c in rows.columns if c.startswith("RF_P_")]
    probs = F.create_map(*(x for c in pops for x in (F.lit(c[5:]), number(c)))) if pops else F.create_map().cast("map<string,double>")
    return rows.select("sample_id", F.array(*(number(f"PC{k}") for k in range(1, 11))).alias("pc"), probs.alias("pop_probs"), F.col("MostSimilarPop").alias("most_similar"), (F.lower("LowConfidence") == "true").alias("low_confidence"), F.col("_metadata.file_path").alias("file"))


def read_patient(spark: SparkSession, path: str) -> DataFrame:
    """(pgs_id, z) of one patient's adjusted scores, by the best z column there is; rows without a number are left out."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    z = next((c for c in ("Z_norm1", "Z_norm2", "Z_MostSimilarPop", "Z") if c in rows.columns), rows.columns[-1])
    pgs = next((c for c in ("pgs_id", "PGS", "pgs") if c in rows.columns), rows.columns[0])
    kept = rows.select(F.col(pgs).alias("pgs_id"), F.col(z).try_cast("double").alias("z"), place().alias("_seq")).where("z is not null")
    return kept.groupBy("pgs_id").agg(F.max_by("z", "_seq").alias("z"))


CATALOG_SCHEMA = "id string, method_name string, trait_reported string, variants_number long, ancestry_distribution struct<gwas:struct<count:long,dist:map<string,double>>,eval:struct<dist:map<string,double>>>"
PERFORMANCE = "struct<auroc_median:double,auroc_n:long,r2_max:double,r2_n:long,or_median:double,or_n:long,n_evals:long,eval_ancestries:array<string>>"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(CATALOG_SCHEMA).json(path)


def read_performance(spark: SparkSession, path: str) -> DataFrame:
    """id and performance (struct) of a file that maps ids to measures."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{PERFORMANCE}>")).alias("id", "performance"))


#: What cohorts read of the scores' metadata.
METADATA_COLUMNS = ("pgs_id", "family_primary", "proxy_trait_flag", "technical_trait_flag")


def read_metadata(spark: SparkSession, path: str, columns: tuple[str, ...] = METADATA_COLUMNS) -> DataFrame:
    """Some columns of a metadata table; those that it lacks are null strings, missing flags false."""
    found = spark.read.parquet(path)
    cell = lambda c: F.col(c) if c in found.columns else F.lit(None).cast("boolean" if c.endswith("_flag") else "string")
    return found.select(*((F.coalesce(cell(c).cast("boolean"), F.lit(False)) if c.endswith("_flag") else cell(c)).alias(c) for c in columns))


def read_matrix(spark: SparkSession, path: str, samples: DataFrame | None = None) -> DataFrame:
    """(pgs_id, place, score) of a folder of .npy files, one vector for each score, named by the file; with samples (place, sample_id), those in place of the numbers.

    Files are read by Spark, so the folder can be on any file system; a file is one row of a task.
    """

    def opened(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part["path"], part["content"]):
                values = np.load(io.BytesIO(content), allow_pickle=False).astype(float).ravel()
                yield pd.DataFrame({"pgs_id": path.rsplit("/", 1)[-1].removesuffix(".npy"), "place": np.arange(len(values), dtype=np.int64), "score": values})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path).select("path", "content")
    long = files.mapInPandas(opened, "pgs_id string, place long, score double")
    return long.join(samples.select("place", "sample_id"), "place").select("pgs_id", "sample_id", "score") if samples is not None else long


def complemented(df: DataFrame, allele: str) -> DataFrame:
    return df.withColumn(allele, complement(F.col(allele)))


def metadata_lists(df: DataFrame) -> DataFrame:
    """JSON list columns (named …_json) as arrays."""
    names = [c for c in df.columns if c.endswith("_json")]
    return df.select(*[c for c in df.columns if c not in names], *(F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>")).alias(c[: -len("_json")]) for c in names))
