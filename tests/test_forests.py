"""Many forests in one job: against single ones and MLlib's, for rules that are known, and in the number of passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import forests, ml, stats
from skein.plans import cohort


@pytest.fixture(scope="module")
def cohorts(spark):
    """Units with four features; two cohorts: y follows the first feature, and the difference of the second and third."""
    rng = np.random.default_rng(21)
    x = rng.normal(size=(160, 4))
    units = spark.createDataFrame([(f"u{k:03d}", v.tolist()) for k, v in enumerate(x)], "u string, x array<double>").persist()
    rows = [("a", f"u{k:03d}", int(v[0] + 0.4 * rng.normal() > 0)) for k, v in enumerate(x)] + [("b", f"u{k:03d}", int(v[1] - v[2] > 0) if k % 4 else None) for k, v in enumerate(x)]
    return units, spark.createDataFrame(rows, "c string, u string, y int").persist()


def areas(found):
    return {r.c: r.auc for r in stats.rank_auc(found.where("label is not null"), "p", "label", ["c"], symmetric=False).collect()}


def test_cohorts_together_are_those_alone(cohorts):
    units, labels = cohorts
    how = {"keys": ["c"], "unit": "u", "x": "x", "folds": 3, "trees": 12, "depth": 4}
    both = forests.out_of_fold(labels, units, **how)
    rows = lambda d: sorted((r.c, r.u, r.label, r.fold, round(r.p, 9)) for r in d.collect())
    together = rows(both)
    assert together == sorted(rows(forests.out_of_fold(labels.where("c = 'a'"), units, **how)) + rows(forests.out_of_fold(labels.where("c = 'b'"), units, **how)), key=lambda r: r)
    got = areas(both)
    assert got["a"] > 0.9 and got["b"] > 0.7
    assert len(together) == 320 and all(0 <= r[4] <= 1 for r in together) and sum(r[3] is None for r in together) == 40
    folds = both.where("label is not null").groupBy("c", "label", "fold").count().groupBy("c", "label").agg((F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r.d <= 1 for r in folds)


def test_about_as_good_as_single_forests(cohorts):
    units, labels = cohorts
    one = labels.where("c = 'a'").join(units, "u").withColumn("y", F.col("y").cast("double"))
    single = ml.cross_validated(ml.features(one, ["x"]), "u", "y", 3, 30, 4).withColumn("c", F.lit("a"))
    many = forests.out_of_fold(labels.where("c = 'a'"), units, ["c"], "u", "x", 3, 30, 4)
    assert areas(many)["a"] == pytest.approx(areas(single)["a"], abs=0.04)


def test_passes_do_not_grow_with_the_models(spark, cohorts, monkeypatch):
    units, labels = cohorts
    counts = []
    for n in (1, 7):
        seen = []
        monkeypatch.setattr(forests, "written", lambda df, name, seen=seen: seen.append(name) or df)
        more = labels.where("c = 'a'").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n))))
        forests.out_of_fold(more, units, ["c", "k"], "u", "x", 2, 3, 2)
        counts.append(len(seen))
    assert counts[0] == counts[1]


def test_splits_are_the_best_ones(spark):
    """One feature: every sample's best cut is where the classes part, so leaves are pure."""
    units = spark.createDataFrame([(k, [float(k)]) for k in range(40)], "u int, x array<double>")
    features, n = forests.binned(units, "u", "x")
    rows = spark.createDataFrame([("m", k, int(k >= 17), k % 5 != 0) for k in range(40)], "m string, u int, y int, learns boolean")
    p = {r.u: r.p for r in forests.predictions(rows, features, ["m"], "u", n, 9, 1).collect()}
    assert set(p) == set(range(0, 40, 5)) and all(p[k] == (k >= 17) for k in p if k != 15) and 0 <= p[15] <= 1


def test_edges(spark):
    units = spark.createDataFrame([(1, [1.0, None]), (2, [float("nan"), 2.0]), (3, None), (4, [3.0, 3.0])], "u int, x array<double>")
    features, n = forests.binned(units, "u", "x")
    assert n == 2 and features.count() == 4
    rows = spark.createDataFrame([("m", 1, 1, True), ("m", 2, 0, True), ("m", 3, None, False), ("m", 4, None, False), ("none", 1, None, False), ("one", 1, 1, True), ("one", 2, None, False)], "m string, u int, y int, learns boolean")
    got = {(r.m, r.u): r.p for r in forests.predictions(rows, features, ["m"], "u", n, 5, 2).collect()}
    assert {k for k in got if k[0] == "m"} <= {("m", 3), ("m", 4)} and ("none", 1) not in got and got["one", 2] == 1.0
    assert forests.predictions(rows.limit(0), features, ["m"], "u", n, 5, 2).count() == 0


def test_null_of_dealt_labels_is_near_chance(spark):
    rng = np.random.default_rng(31)
    labels = ["Healthy"] * 24 + ["A"] * 16 + ["B"] * 16
    df = spark.createDataFrame([(f"s{k:02d}", y, *map(float, rng.normal(size=3) + (2.0 if y == "A" else 0))) for k, y in enumerate(labels)], "u string, label string, a double, b double, c double")
    null = cohort.permutation_null(ml.features(df, ["a", "b", "c"]), "u", "label", ["A", "B"], draws=6, folds=2, trees=6, depth=3).collect()
    assert len(null) == 6 and all(r.top3 == 1.0 for r in null) and 0.3 < np.mean([r.top1 for r in null]) < 0.7


@pytest.mark.parametrize("trees", [2, 23])
def test_blocks_and_one_block_give_the_same(spark, cohorts, trees):
    units, labels = cohorts
    features, n = forests.binned(units, "u", "x")
    rows = labels.select("c", "u", "y", (F.hash("u") % 4 != 0).alias("learns"))
    p = lambda **k: {(r.c, r.u): r.p for r in forests.predictions(rows, features, ["c"], "u", n, trees, 3, **k).collect()}
    one, many = p(), p(block=40)
    assert set(one) == set(many) and one == pytest.approx(many, abs=1e-12)


def test_one_block_is_one_pass(spark, cohorts, monkeypatch):
    """Nothing is written level by level, and no row is made for a unit and tree."""
    units, labels = cohorts
    seen = []
    monkeypatch.setattr(forests, "written", lambda df, name: seen.append(df) or df)
    forests.out_of_fold(labels, units, ["c"], "u", "x", 2, 40, 6)
    assert len(seen) <= 4


def test_features_are_drawn_by_the_hash_of_spark(spark):
    row = spark.sql("SELECT xxhash64(43, 'd', 2) AS model, transform(sequence(0, 4), j -> pmod(xxhash64(43, 'd', 2, 7, 11L, j), 64)) AS tries").first()
    assert forests._tries(row.model, 7, np.array([11]), 5, 64).tolist() == [row.tries]


def test_folds_of_a_table_are_grown_together(cohorts, monkeypatch):
    """Not a job of MLlib for each fold and group of nodes; units outside are scored by every fold."""
    units, labels = cohorts
    monkeypatch.setattr(ml.RandomForestClassifier, "fit", lambda *a: pytest.fail("a forest was grown by itself"))
    rows = ml.features(labels.where("c = 'b'").join(units, "u").withColumn("y", F.col("y").cast("double")), ["x"])
    got = ml.cross_validated(rows.where("y is not null"), "u", "y", 3, 30, 4, others=rows.where("y is null")).withColumn("c", F.lit("b"))
    assert areas(got)["b"] > 0.7
    assert got.count() == 160 and got.where("fold is null and label is null and p between 0 and 1").count() == 40
