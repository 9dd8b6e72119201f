"""Catalogue of descriptions, as they arrive: each text is rated by the method it names and filed under the traits it names.

Texts (documents: doc_id, text, lang, source) come as files under a folder, ever more of them. A run takes the files that no run before it
took, as a stream that ends when there are none left; Spark's checkpoint knows which those are. Each batch is written under its own number,

    out/catalogue/batch=N/lang=..: doc_id, source, n_chars, method_tier, behaviour, body

so a batch that fails and comes again replaces itself. A document that comes again counts by its last batch, and by its longest text within one. When the stream
has ended, the counts of the languages that documents came to or left since their counts were made are made anew,

    out/summary/lang=..: source, n_documents, n_named (by a method better than the default), best_tier, top_behaviour, upto

and replace the old ones (dynamic partition overwrite). upto is each language's high-water mark: the last batch that its documents are of. A run that dies between
the two leaves it behind, and the next one makes up for it. A language that has lost all its documents keeps a row of zeros.
The checkpoint is in out, since it says what out has: to start from nothing, take a new out.

    python -m jobs.text_catalogue --tables s3://catalogue/tables --out s3://catalogue/filed
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.settings import log, main
from skein.functions import domains, rules
from skein.operators import match, stats

DEFAULTS = {"tables": None, "out": None, "files_per_batch": 100}
CATALOGUE = "doc_id long, source string, n_chars long, method_tier int, behaviour string, body string, batch long, lang string"
SUMMARY = "source string, n_documents long, n_named long, best_tier int, top_behaviour string, upto long, lang string"


def filed(texts: DataFrame) -> DataFrame:
    """A text's method tier, and the first trait of each list that it names; nulls count as empty texts."""
    text = F.coalesce("text", F.lit(""))
    low = F.lower(text)
    return texts.select(
        "doc_id", "source", F.char_length(text).cast("long").alias("n_chars"), rules.tier_by_pattern(text).cast("int").alias("method_tier"),
        rules.first_keyword(low, list(domains.BEHAVIOR_KEYWORDS), "Other_Behavioral").alias("behaviour"), rules.first_keyword(low, list(domains.BODY_KEYWORDS), "Other_Body").alias("body"), "lang")


def catalogue(spark: SparkSession, out: str) -> DataFrame:
    """All that out has: of a document that came more than once, the last."""
    rows = _rows(spark, out)
    latest = match.last_wins(rows.withColumn("_seq", F.struct("batch", "n_chars", "method_tier", "behaviour", "body", "source", "lang")), ["doc_id"], "_seq")
    return latest.drop("_seq")


def _rows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(CATALOGUE).parquet(f"{out}/catalogue")


def summarised(rows: DataFrame, due: DataFrame) -> DataFrame:
    """Counts by language and source of rows, for the languages of due (lang, upto); zeros for a language without rows."""
    by = ["lang", "source"]
    keyed = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in by})
    langs = due.withColumn("lang", F.coalesce("lang", F.lit("")))
    counts = keyed.join(langs.select("lang"), "lang", "left_semi").groupBy(*by).agg(F.count("*").alias("n_documents"), F.count_if(F.col("method_tier") > rules.METHOD_DEFAULT).alias("n_named"), F.max("method_tier").alias("best_tier"))
    top = stats.most_common(keyed, by, "behaviour", "doc_id").select(*by, F.col("behaviour").alias("top_behaviour"))
    out = langs.join(counts.join(top, by, "left"), "lang", "left").fillna(0, ["n_documents", "n_named"])
    return out.select(F.nullif("source", F.lit("")).alias("source"), "n_documents", "n_named", "best_tier", "top_behaviour", "upto", F.nullif("lang", F.lit("")).alias("lang"))


def due_languages(spark: SparkSession, out: str) -> DataFrame:
    """lang and upto of the languages whose counts are older than the last batch of a document that is or was filed under them."""
    documents = _rows(spark, out).groupBy("doc_id").agg(F.collect_set(F.coalesce("lang", F.lit(""))).alias("langs"), F.max("batch").alias("batch"))
    last = documents.select(F.explode("langs").alias("lang"), "batch").groupBy("lang").agg(F.max("batch").alias("upto"))
    try:
        made = spark.read.schema(SUMMARY).parquet(f"{out}/summary").groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.max("upto").alias("_made"))
    except AnalysisException as e:  # none yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        made = spark.createDataFrame([], "lang string, _made long")
    return last.join(made, "lang", "left").where(F.col("upto") > F.coalesce("_made", F.lit(-1))).select(F.nullif("lang", F.lit("")).alias("lang"), "upto")


def run(spark: SparkSession, tables: str, out: str, files_per_batch: int = 100) -> DataFrame:
    """Files what has come under tables since the last run. Returns the whole catalogue under out."""
    path, written = f"{tables}/documents.parquet", []
    schema = spark.read.parquet(path).schema
    # A pattern that fits this path alone: a stream takes a single file only by a pattern, and a folder as well.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")

    def write(batch: DataFrame, number: int) -> None:
        target = f"{out}/catalogue/batch={number}"
        filed(batch).write.mode("overwrite").partitionBy("lang").parquet(target)
        counts = batch.sparkSession.read.schema(CATALOGUE).option("basePath", f"{out}/catalogue").parquet(target).groupBy("lang").count().collect()  # a row for each language
        written.append(sum(r["count"] for r in counts))
        log.info("batch %d: wrote %d rows of %d languages to %s", number, written[-1], len(counts), target)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d rows that are new under %s in %d batches", sum(written), path, len(written))
    due = due_languages(spark, out).collect()  # a row for each language
    if due:
        summarised(catalogue(spark, out), spark.createDataFrame(due, "lang string, upto long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lang").parquet(f"{out}/summary")
    log.info("counts of %s replaced in %s/summary", sorted(str(r.lang) for r in due) or "no language", out)
    return catalogue(spark, out)


if __name__ == "__main__":
    main("text_catalogue", run, DEFAULTS)
