"""The store of reference scores: hits, misses, versions, runs that died."""

import shutil

import pytest

from skein.operators.score import panel_scores
from skein.plans import reference_cache as rc
from skein.plans.scoring import score_reference

WEIGHTS = "pgs_id string, vkey long, weight double, flip int, model int"


@pytest.fixture
def tables(spark):
    weights = spark.createDataFrame([(p, k, 0.5 * k + len(p), k % 2, k % 3) for p in ("a", "b", "cc") for k in range(1, 9)] + [("far", 99, 1.0, 0, 0)], WEIGHTS)
    genotypes = spark.createDataFrame([("s", k, 1 if k != 8 else None) for k in range(1, 9)], "sample_id string, vkey long, dosage int")
    panel = spark.createDataFrame([(k, [k % 3, None, 2], 0.1 * k) for k in range(1, 9)], "vkey long, dosages array<int>, afreq double")
    return weights, genotypes, panel


@pytest.fixture
def counted(monkeypatch):
    """The scores that the panel was joined for, run by run."""
    seen = []

    def counting(used, panel, **how):
        seen.append(sorted(r.pgs_id for r in used.select("pgs_id").distinct().collect()))
        return panel_scores(used, panel, **how)

    monkeypatch.setattr(rc, "panel_scores", counting)
    return seen


def got(df):
    return {(r.pgs_id, r.sample): (round(r.score, 9), r.cached) for r in df.collect()}


def plain(weights, genotypes, panel):
    return {(r.pgs_id, r.sample): round(r.score, 9) for r in score_reference(weights, genotypes, panel).collect()}


def test_second_run_scores_nothing(spark, tables, counted, tmp_path):
    weights, genotypes, panel = tables
    store, want = f"file://{tmp_path}/s", plain(*tables)
    assert len(want) == 9
    assert got(rc.reference_scores(*tables, store)) == {k: (v, False) for k, v in want.items()}
    assert got(rc.reference_scores(*tables, store)) == {k: (v, True) for k, v in want.items()}
    assert counted == [["a", "b", "cc"], []]
    # A stale version: everything anew. Called genotypes alone: another address.
    assert not any(hit for _, hit in got(rc.reference_scores(*tables, store, version=rc.CACHE_VERSION + 1)).values())
    assert not any(hit for _, hit in got(rc.reference_scores(*tables, store, impute=False)).values())
    assert counted[2:] == [["a", "b", "cc"]] * 2


def test_only_what_changed_is_scored(spark, tables, counted, tmp_path):
    weights, genotypes, panel = tables
    store = f"file://{tmp_path}/s"
    rc.reference_scores(weights.where("pgs_id <> 'cc'"), genotypes, panel, store)
    # A new score, a changed weight, and a score whose overlap with the target stays as it was.
    changed = weights.selectExpr("pgs_id", "vkey", "if(pgs_id = 'b' and vkey = 3, weight + 1, weight) weight", "flip", "model")
    out = got(rc.reference_scores(changed, genotypes, panel, store))
    assert out == {k: (v, k[0] == "a") for k, v in plain(changed, genotypes, panel).items()} and counted[-1] == ["b", "cc"]
    # Another target that lacks one variant: other addresses for all scores that have it.
    fewer = genotypes.where("vkey <> 2")
    some = changed.where("pgs_id <> 'a' or vkey <> 2")
    got(rc.reference_scores(some, fewer, panel, store))
    assert counted[-1] == ["a", "b", "cc"]
    got(rc.reference_scores(some, genotypes.where("vkey <> 2 or vkey = 99"), panel, store))
    assert counted[-1] == []
    # Another panel: another address.
    got(rc.reference_scores(changed, genotypes, panel.where("vkey <> 5"), store))
    assert counted[-1] == ["a", "b", "cc"]


def test_repeated_rows_change_the_address(spark, tables, counted, tmp_path):
    weights, genotypes, panel = tables
    store = f"file://{tmp_path}/s"
    rc.reference_scores(*tables, store)
    twice = weights.unionByName(weights.where("pgs_id = 'a'")).unionByName(weights.where("pgs_id = 'b' and vkey = 1"))
    assert got(rc.reference_scores(twice, genotypes, panel, store)) == {k: (v, k[0] == "cc") for k, v in plain(twice, genotypes, panel).items()}


def test_a_run_that_died_leaves_nothing_that_is_read(spark, tables, counted, tmp_path):
    store, want = f"file://{tmp_path}/s", plain(*tables)
    rc.reference_scores(*tables, store)
    for index in (tmp_path / "s").rglob("index"):
        shutil.rmtree(index)
    out = got(rc.reference_scores(*tables, store))
    assert out == {k: (v, False) for k, v in want.items()} and counted == [["a", "b", "cc"]] * 2
    assert rc.reference_scores(*tables, store).count() == len(want)


def test_empty_requests(spark, tables, tmp_path):
    weights, genotypes, panel = tables
    store = f"file://{tmp_path}/s"
    assert rc.reference_scores(weights.limit(0), genotypes, panel, store).count() == 0
    assert rc.reference_scores(weights.where("pgs_id = 'far'"), genotypes, panel, store).count() == 0
