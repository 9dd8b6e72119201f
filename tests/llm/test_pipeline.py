"""The pipeline against its parts computed plainly."""

import hashlib
import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from skein.llm import bpe, ngram_join, positional_index
from skein.llm.common import table

D = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(D), reason="needs the test tables")
def test_pipeline_equals_plain_steps(spark):
    from tokenizers import Tokenizer

    docs = table(spark, D, "documents")
    first = corpus_pipeline.quality_rules_stage(spark, docs, D)
    second = corpus_pipeline.quality_classifier_stage(spark, first, D)
    assert first.columns == second.columns == docs.columns and second.count() <= first.count() < docs.count()
    texts = {r.doc_id: r.text for r in second.select("doc_id", "text").collect()}
    roots = ngram_join.brute_force(sorted(texts.items()), 5, 80)
    kept = {d: t for d, t in texts.items() if roots[d][1] == d}
    items = [tuple(r) for r in table(spark, D, "benchmark").select("item_id", "text").collect()]
    hit = positional_index.brute_force(sorted(kept.items()), items)
    clean = {d: t for d, t in kept.items() if not hit[d][4]}
    library = Tokenizer.from_file(bpe.default_vocabulary())
    want = {}
    for d, t in clean.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, D).collect()} == want


def test_stages_edges(spark):
    rows = [(1, "a b c d e f g h i j k l m n o", "en", "s", 0), (1, "a b c d e f g h i j k l m n o", "en", "s", 0), (None, None, None, None, None), (None, "q r s t u v w x y z a b c", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates_stage(spark, docs, D).select("doc_id", F.coalesce("text", F.lit("-")).alias("t")).collect()
    assert sorted((r.doc_id or 0, r.t[:1]) for r in out) == [(0, "-"), (0, "q"), (1, "a")]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), D).count() == 0
        stage(spark, docs, D).count()


def test_near_duplicates_of_five_words_and_four_fifths(spark):
    words = [f"w{k}" for k in range(104)]
    texts = [" ".join(words + [f"{name}{k}" for k in range(n)]) for name, n in (("a", 0), ("b", 22), ("c", 25), ("d", 26))]
    texts += [" ".join(f"{name}{k}" for k in range(60)) for name in "xy"]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    roots = ngram_join.brute_force(list(enumerate(texts)), 5, 80)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates_stage(spark, docs, D).collect()}
    assert kept == {d for d in roots if roots[d][1] == d} == {0, 3, 4, 5}


def test_stages_decide_by_row(spark, tmp_path):
    long = lambda name, n=40: " ".join(f"{name}{k}" for k in range(n))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, long("a"), "1"), (7, long("a") + " z", "copy of 1"), (7, long("b"), "repeats the id"), (None, long("a") + " y", "null copy"), (None, long("c"), "null first"), (None, long("c") + " x", "null second"), (None, long("d"), "null alone"), (9, long("e"), "9"), (9, long("e") + " w", "own copy")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], schema)
    kept = sorted(r.source for r in corpus_pipeline.near_duplicates_stage(spark, docs, D).collect())
    assert kept == ["1", "9", "null alone", "null first", "repeats the id"]

    spark.createDataFrame([(1, long("q", 12)), (None, long("u", 12))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(3, "x " + long("q", 12), "hit"), (3, long("f"), "same id"), (None, long("q", 12) + " y", "null hit"), (None, long("g"), "null clean"), (4, long("u", 12), "hit by the item of a null id"), (5, None, "no text")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], schema)
    kept = sorted(r.source for r in corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).collect())
    assert kept == ["no text", "null clean", "same id"]
