"""The jobs: results against SQL, runs again, growing input."""

import json
import logging
import shutil
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

from jobs import cohort_scores, registered, settings, text_catalogue
from skein.functions import rules

D = "/root/testdata/sf0.001"


def sql(text, d=D):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "part", "documents"):
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    return con.sql(text)


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("name", ["job1_cohort_scores", "job2_text_catalogue"])
def test_registered_jobs_equal_their_sql(spark, name):
    got, want = registered.queries()[name](spark, D), sql(registered.oracle_sql()[name])
    assert rows(got.select(*want.columns)) == Counter(want.fetchall()) and sorted(got.columns) == sorted(want.columns)


def test_cohort_runs_again_and_by_population(spark, tmp_path, caplog):
    out = f"file://{tmp_path}/out"
    with caplog.at_level(logging.INFO, "jobs"):
        first = rows(cohort_scores.run(spark, D, out))
    assert f"read 150 samples and 200 weight rows from {D}" in caplog.text and f"to {out}/scores" in caplog.text
    assert rows(cohort_scores.run(spark, D, out)) == first
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    # A population's own run replaces it alone.
    one = rows(cohort_scores.run(spark, D, out, populations=["ASIA"], scores=["Brand#11"]))
    assert {r for r in one if r[-1] != "ASIA"} == {r for r in first if r[-1] != "ASIA"}
    assert {(r[-1], r[1]) for r in one if r[-1] == "ASIA"} == {("ASIA", "Brand#11")}
    summary = spark.read.schema(cohort_scores.SUMMARY).parquet(f"{out}/summary").collect()
    assert len([r for r in summary if r.population == "ASIA"]) == 1
    counts = Counter((r[-1], r[1]) for r in one.elements())
    assert {(r.population, r.pgs_id): r.n_samples for r in summary} == counts
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def copied(spark, tmp_path, edit):
    """The tables of the cohort in a folder of their own, one of them changed."""
    for t in ("region", "nation", "customer", "orders", "lineitem", "part"):
        df = spark.read.parquet(f"{D}/{t}.parquet")
        edit.get(t, lambda x: x)(df).write.parquet(f"{tmp_path}/tables/{t}.parquet")
    return f"{tmp_path}/tables"


def test_cohort_edges(spark, tmp_path):
    tables = copied(spark, tmp_path, {
        "customer": lambda c: c.withColumn("c_nationkey", c.c_nationkey * (c.c_custkey > 20).cast("int") - (c.c_custkey <= 20).cast("int")),  # no nation
        "lineitem": lambda x: x.unionByName(x.withColumn("l_linenumber", x.l_linenumber + 100))})  # every call twice: the first stands
    got = cohort_scores.run(spark, tables, f"file://{tmp_path}/out")
    want = {(r.sample_id, r.pgs_id): (r.raw_score, r.variants_matched) for r in cohort_scores.run(spark, D, f"file://{tmp_path}/plain").collect()}
    got = got.collect()
    assert {(r.sample_id, r.pgs_id): (r.raw_score, r.variants_matched) for r in got} == want
    assert {r.population for r in got if r.sample_id <= 20} == {None}
    empty = copied(spark, tmp_path / "e", {"lineitem": lambda x: x.limit(0)})
    assert cohort_scores.run(spark, empty, f"file://{tmp_path}/none").count() == 0


TEXT = "doc_id long, text string, lang string, source string, n_chars long"


def arrive(spark, folder, *docs):
    spark.createDataFrame([(*d, "s", 0) for d in docs], TEXT).coalesce(1).write.mode("append").parquet(f"{folder}/documents.parquet")


def test_catalogue_takes_only_what_is_new(spark, tmp_path, caplog):
    tables, out = f"file://{tmp_path}/tables", f"file://{tmp_path}/out"
    caplog.set_level(logging.INFO, "jobs")
    arrive(spark, tables, (1, "A score by LDpred of coffee intake", "en"), (2, None, None), (3, "", "en"), (4, "Taille: height", "fr"))
    first = text_catalogue.run(spark, tables, out)
    by_id = {r.doc_id: r for r in first.collect()}
    assert set(by_id) == {1, 2, 3, 4} and (by_id[1].method_tier, by_id[3].method_tier, by_id[2].n_chars, by_id[2].lang) == (20, rules.METHOD_DEFAULT, 0, None)
    assert by_id[4].body == "Height" and {r.batch for r in by_id.values()} == {0}
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/catalogue/batch=0").rglob("*.parquet")}
    french = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/summary/lang=fr").rglob("*.parquet")}
    # Nothing new: the same result, nothing read.
    caplog.clear()
    assert rows(text_catalogue.run(spark, tables, out)) == Counter(map(tuple, by_id.values()))
    assert "read 0 rows" in caplog.text
    # More files: only these are read, and only their languages counted anew.
    arrive(spark, tables, (5, "PRSice clumping", "en"), (1, "Now metaGRS, sleep", "en"))
    arrive(spark, tables, (6, "x" * 100_000, "de"))
    caplog.clear()
    second = {r.doc_id: r for r in text_catalogue.run(spark, tables, out).collect()}
    assert "read 3 rows" in caplog.text and set(second) == {1, 2, 3, 4, 5, 6}
    assert (second[1].method_tier, second[1].batch) == (10, 1) and second[4] == by_id[4] and second[6].n_chars == 100_000
    assert {p: p.stat().st_mtime_ns for p in kept} == kept and {p: p.stat().st_mtime_ns for p in french} == french
    summary = {(r.lang, r.source): r for r in spark.read.schema(text_catalogue.SUMMARY).parquet(f"{out}/summary").collect()}
    assert set(summary) == {("en", "s"), ("fr", "s"), ("de", "s"), (None, "s")}
    assert (summary["en", "s"].n_documents, summary["en", "s"].n_named, summary["en", "s"].best_tier) == (3, 2, 14)
    # Documents that come again in another language leave the old one.
    arrive(spark, tables, (4, "moved", "en"), (2, "moved too", "fr"))
    text_catalogue.run(spark, tables, out)
    summary = {(r.lang, r.source): r.n_documents for r in spark.read.schema(text_catalogue.SUMMARY).parquet(f"{out}/summary").collect()}
    assert summary == {("en", "s"): 4, ("fr", "s"): 1, ("de", "s"): 1, (None, None): 0}


def test_catalogue_makes_up_for_a_run_that_died_before_it_counted(spark, tmp_path, monkeypatch):
    tables, out = f"file://{tmp_path}/tables", f"file://{tmp_path}/out"
    arrive(spark, tables, (1, "LDpred", "en"), (2, "b", "fr"))
    text_catalogue.run(spark, tables, out)
    arrive(spark, tables, (3, "c", "en"), (2, "moved", "de"))
    real = text_catalogue.summarised
    monkeypatch.setattr(text_catalogue, "summarised", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        text_catalogue.run(spark, tables, out)
    monkeypatch.setattr(text_catalogue, "summarised", real)
    assert {r.lang: r.upto for r in text_catalogue.due_languages(spark, out).collect()} == {"en": 1, "fr": 1, "de": 1}
    text_catalogue.run(spark, tables, out)  # nothing new, but counts to make
    assert text_catalogue.due_languages(spark, out).isEmpty()
    summary = {r.lang: (r.n_documents, r.upto) for r in spark.read.schema(text_catalogue.SUMMARY).parquet(f"{out}/summary").collect()}
    assert summary == {"en": (2, 1), "fr": (0, 1), "de": (1, 1)}


def test_catalogue_takes_files_in_batches(spark, tmp_path):
    tables, out = f"file://{tmp_path}/tables", f"file://{tmp_path}/out"
    for k in range(5):
        arrive(spark, tables, (k, "t" * k, "en"))
    got = text_catalogue.run(spark, tables, out, files_per_batch=2).collect()
    assert sorted(r.doc_id for r in got) == list(range(5)) and {r.batch for r in got} == {0, 1, 2}


def test_catalogue_batch_that_comes_again_replaces_itself(spark, tmp_path):
    tables, out = f"file://{tmp_path}/tables", f"file://{tmp_path}/out"
    arrive(spark, tables, (1, "LDpred", "en"), (1, "LDpred", "en"), (2, "b", "en"))
    first = rows(text_catalogue.run(spark, tables, out))
    assert len(first) == 2
    shutil.rmtree(tmp_path / "out/checkpoint/commits")  # as if the run had died before it committed
    assert rows(text_catalogue.run(spark, tables, out)) == first
    assert len(list((tmp_path / "out/catalogue").glob("batch=*"))) == 1


def test_settings(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"out": "o", "digits": 3}))
    assert settings.settings(tmp_path / "c.json", cohort_scores.DEFAULTS, {"tables": "t", "out": None}) == cohort_scores.DEFAULTS | {"out": "o", "digits": 3, "tables": "t"}
    (tmp_path / "d.json").write_text('{"ouput": 1}')
    with pytest.raises(ValueError, match="ouput"):
        settings.settings(tmp_path / "d.json", cohort_scores.DEFAULTS, {})


def test_command_line(tmp_path):
    done = subprocess.run([sys.executable, "-m", "jobs.text_catalogue", "--tables", D, "--out", f"file://{tmp_path}/out"], capture_output=True, text=True, timeout=170, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 200 rows" in done.stderr and list((tmp_path / "out/summary").glob("lang=*"))
