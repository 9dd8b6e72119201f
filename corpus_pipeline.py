"""A corpus pipeline over ``documents``: rules, classifier, near duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and
returns the columns of documents; the last returns what encoding gives. ``run`` writes each
stage's rows to the shared folder and reads them again for the next.

Models are fitted on labelled rows of the documents table itself (its bounded, documented
sample), since after the first stage hardly any bad row is left to learn from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import bpe, compression_classifier, ngram_join, positional_index, quality_rules
from skein.llm.common import mark, scratch, sweep, table, written

#: Near duplicates of the stage share this much of their shingles of so many words (op10's query has its own contract, 4 and 85).
SHINGLE, PERCENT = 5, 80


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    rules = quality_rules.learn_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct(*docs.columns).alias("document"), "text")  # so that no statistic replaces a column
    # A row number keeps the filter above the statistics; pushed below, it would compute them once for each rule that names them.
    judged = quality_rules.apply_rules(packed, rules).withColumn("_row", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_row") >= 0)).select("document.*")


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half go."""
    model = compression_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return compression_classifier.scored(docs, model).where("predicted = 1").select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with a stored number of each row (_row), so that a decision meets its own row only: ids can be null or repeat."""
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed-rows")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row stays, that of the smallest id (null ids come last); of rows without words with one id and one text, one."""
    rows = keyed(docs)
    found = ngram_join.classes(rows, SHINGLE, PERCENT, key="_row").select(F.col("doc_id").alias("_row"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("_class"))
    facts = rows.select("_row", "doc_id", "source", "lang", "n_chars", F.xxhash64("text").alias("_text")).join(found, "_row")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "source", "lang", "n_chars", "_row"))
    own = [F.when(F.col("_class").isNull(), F.col(c)).alias(f"_own{c}") for c in ("doc_id", "_text")]
    kept = facts.groupBy("_class", *own).agg(least.alias("_least")).select("_least._row")
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    rows = keyed(docs)
    found = positional_index.hits(rows, table(spark, sf_dir, "benchmark"), key="_row")
    return rows.join(found.where(F.size("spans") > 0).select(F.col("doc_id").alias("_row")), "_row", "left_anti").select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, and digests of the ids and of the text they decode to."""
    # Small caches: the workers of a pipeline have other stages' memory behind them.
    return bpe.digests(docs, bpe.prepared(docs, bpe.default_vocabulary(), cache=80_000, group=1 << 20))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encoding_stage),
]

#: Learned models, similarity classes and BPE have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        begun = mark()
        kept = stage(spark, docs, sf_dir)
        path = scratch(spark, name.replace(" ", "-"))
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        sweep(spark, begun, path)  # the stage's own tables have been read for the last time
    return docs
