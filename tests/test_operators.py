"""Operators against hand-computed values and NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import graph, match, ml, regression, resample, reshape, score, stats


def test_score_example(spark):
    g = spark.createDataFrame([("s", 1, 1.0), ("s", 2, 2.0), ("s", 3, None)], "sample_id string, k long, dosage double")
    w = spark.createDataFrame([("p", 1, 0.5, 0, 0), ("p", 2, -0.2, 1, 0), ("p", 3, 9.0, 0, 0), ("p", 4, 1.0, 0, 0)], "pgs_id string, k long, weight double, flip int, model int")
    meta = spark.createDataFrame([("p", 4), ("q", 3), ("z", 0)], "pgs_id string, num_original long")
    rows = {r.pgs_id: r for r in score.weighted_scores(w.join(g, "k"), meta).collect()}
    assert (rows["p"].raw_score, rows["p"].variants_matched, rows["p"].variants_missing, rows["p"].match_rate) == (0.5, 2, 2, 0.5)
    assert (rows["q"].raw_score, rows["q"].match_rate, rows["z"].match_rate) == (0.0, 0.0, 0.0)


def test_panel_scores(spark):
    panel = spark.createDataFrame([(1, [0, 1, None], 0.25), (2, [2, 2, 1], 0.5)], "vkey long, dosages array<int>, afreq double")
    w = spark.createDataFrame([("p", 1, 1.0, 0, 0), ("p", 2, 2.0, 1, 1)], "pgs_id string, vkey long, weight double, flip int, model int")
    assert [r.score for r in score.panel_scores(w, panel).orderBy("sample").collect()] == [0.0, 1.0, 0.5 + 2.0]
    assert [r.score for r in score.panel_scores(w, panel, impute=False).orderBy("sample").collect()] == [0.0, 1.0, 2.0]


def test_fallback_and_wins(spark):
    w = spark.createDataFrame([("p", 1, "a"), ("p", 9, "b"), ("q", 9, "a")], "pgs_id string, k long, rs string")
    o = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "k long, rs string, dosage double")
    got = sorted((r.pgs_id, r.source, r.dosage) for r in match.exact_then_fallback(w, o, "k", "rs").collect())
    assert got == [("p", "fallback", 2.0), ("p", "key", 1.0), ("q", "fallback", 1.0)]
    e = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b")], "k int, seq int, v string")
    assert match.first_wins(e, ["k"], ["seq"]).first().v == "a" and match.last_wins(e, ["k"], "seq").first().v == "c"
    flips = spark.createDataFrame([(5, 6, 5, 6, 1), (6, 5, 5, 6, 0), (7, 5, 5, 6, 0), (7, 6, 5, 6, 1), (7, 8, 5, 6, 0), (5, 0, 5, 5, 1)], "e int, o int, r int, a int, want int")
    assert all(x.got == x.want for x in flips.select(match.fallback_flip(*map(F.col, "eora")).alias("got"), "want").collect())


def test_statistics_examples(spark):
    pop = spark.createDataFrame([("g", v) for v in (1.0, 2.0, 2.0, 3.0)], "g string, v double")
    assert {r.v: r.percentile for r in stats.percentiles_within(pop, "v", ["g"]).collect()}[2.0] == 62.5
    one = lambda lt, le: spark.range(1).select(stats.percentile_rank(F.lit(lt), F.lit(le), F.lit(4)).alias("p")).first().p
    assert [one(1, 3), one(0, 0), one(4, 4)] == [62.5, 0.0, 100.0]
    mad = stats.robust_scale(spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double"), "v", ["g"]).first()
    assert (mad.center, mad.scale) == (3.0, pytest.approx(1.4826))
    flat = stats.robust_scale(spark.createDataFrame([("a", 5.0), ("a", 5.0), ("a", 5.0), ("b", 1.0)], "g string, v double"), "v", ["g"])
    assert {r.scale for r in flat.collect()} == {1.0}
    auc = stats.rank_auc(spark.createDataFrame([("g", 0, 1), ("g", 0, 2), ("g", 1, 2), ("g", 1, 3), ("h", 1, 1)], "g string, y int, x int"), "x", "y", ["g"]).collect()
    assert [(r.g, r.auc) for r in auc] == [("g", 0.875)]
    t = stats.iqr_thresholds(spark.createDataFrame([("g", float(v)) for v in range(5)], "g string, v double"), "v", ["g"]).first()
    assert (t.t2, t.t1) == (7.0, 11.0)
    p = stats.weighted_projection(spark.createDataFrame([("g", 1.0, 1.0), ("g", None, 2.0), ("g", 2.0, -1.0), ("h", None, 1.0)], "g string, x double, w double"), "x", "w", ["g"])
    got = {r.g: r for r in p.collect()}
    assert got["g"].score == pytest.approx(-(2**-0.5)) and (got["g"].reliability, got["g"].n_available) == (0.5, 2) and got["h"].score is None


def test_auc_of_negated_values(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("g", int(y), float(x)) for y, x in zip(rng.integers(0, 2, 80), rng.integers(0, 9, 80))], "g string, y int, x double")
    a = stats.rank_auc(df, "x", "y", ["g"], symmetric=False).first().auc
    assert a + stats.rank_auc(df.withColumn("x", -F.col("x")), "x", "y", ["g"], symmetric=False).first().auc == pytest.approx(1.0)


def test_residuals_equal_least_squares(spark):
    rng = np.random.default_rng(2)
    pcs, y = rng.normal(size=(40, 3)), rng.normal(size=(40, 2))
    design = spark.createDataFrame([(f"s{i}", *map(float, pcs[i])) for i in range(40)], "sample_id string, a double, b double, c double")
    values = spark.createDataFrame([(f"p{j}", f"s{i}", float(y[i, j])) for i in range(40) for j in range(2)], "pgs_id string, sample_id string, score double")
    x = np.c_[np.ones(40), pcs]
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    want = y - x @ beta
    got = {(r.pgs_id, r.sample_id): r.residual for r in stats.residualised(values, design, ["a", "b", "c"]).collect()}
    assert all(got[f"p{j}", f"s{i}"] == pytest.approx(want[i, j], abs=1e-9) for i in range(40) for j in range(2))
    fits = {r.pgs_id: [r.intercept, *r.coefs] for r in stats.coefficients(values, design, ["a", "b", "c"]).collect()}
    assert np.allclose([fits["p0"], fits["p1"]], beta.T)


def gamma_fit(x: np.ndarray, y: np.ndarray, alpha: float = 1.0, rounds: int = 1000) -> np.ndarray:
    """One group's coefficients by itself: coefficients (intercept first) of a gamma regression with a log link and a squared penalty on all but the intercept: Newton's method on half the mean deviance."""
    design = np.c_[np.ones(len(x)), x]
    penalty = np.r_[0.0, np.full(x.shape[1], alpha)]
    beta = np.zeros(design.shape[1])
    beta[0] = np.log(max(y.mean(), 1e-300))

    def loss(b):
        eta = design @ b
        return float(np.mean(y * np.exp(-eta) + eta) + 0.5 * (penalty * b * b).sum())

    now = loss(beta)
    for _ in range(rounds):
        ratio = y * np.exp(-(design @ beta))
        gradient = design.T @ (1 - ratio) / len(y) + penalty * beta
        hessian = (design * ratio[:, None]).T @ design / len(y) + np.diag(penalty)
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        size = 1.0
        while size > 1e-8 and not (new := loss(beta - size * step)) <= now:
            size /= 2
        beta = beta - size * step
        if abs(now - new) < 1e-14 and np.abs(gradient).max() < 1e-10:
            break
        now = new
    return beta


def test_gamma_fit_is_stationary():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4))
    y = rng.gamma(2.0, np.exp(0.3 * x[:, 0]))
    b = gamma_fit(x, y)
    design = np.c_[np.ones(200), x]
    gradient = design.T @ (1 - y * np.exp(-design @ b)) / 200 + np.r_[0, b[1:]]
    assert np.abs(gradient).max() < 1e-9


def test_gamma_regressions_equal_single_fits(spark):
    rng = np.random.default_rng(12)
    rows, want = [], {}
    for g, n in (("a", 400), ("b", 60), ("c", 7), ("wild", 90), ("one", 1), ("flat", 30)):
        x = rng.normal(size=(n, 3))
        x = (x - x.mean(0)) / np.where(x.std(0) == 0, 1, x.std(0))
        if g == "flat":
            x[:, 1], x[:, 2] = 0.0, x[:, 0]  # no column, and twice the same
        y = np.exp(x @ [0.5, -0.3, 0.1]) * rng.gamma(1.0, size=n) * (1e-6 if g == "b" else 1e5 if g == "a" else 1)
        if g == "wild":
            y = y**12
        want[g] = gamma_fit(x, y)
        rows += [(g, float(b), *map(float, a)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "g string, y double, x0 double, x1 double, x2 double")
    got = {r.g: [r[f"gamma{k}"] for k in range(4)] for r in regression.gamma_regressions(df, "g", ["x0", "x1", "x2"], "y").collect()}
    assert set(got) == set(want) and all(got[g] == pytest.approx(want[g], rel=1e-8, abs=1e-8) for g in want)
    assert regression.gamma_regressions(df.limit(0), "g", ["x0", "x1", "x2"], "y").count() == 0


def test_least_squares_of_groups(spark):
    rng = np.random.default_rng(13)
    a, b = rng.normal(size=(50, 3)), rng.normal(size=(4, 3))
    b[:, 2] = b[:, 0] - 2 * b[:, 1]  # depends on the others: no coefficient of its own, the same fit
    rows = [(g, float(y), *map(float, x)) for g, xs, ys in (("a", a, a @ [1, 2, 3] + rng.normal(size=50)), ("b", b, rng.normal(size=4))) for x, y in zip(xs, ys)]
    df = spark.createDataFrame(rows, "g string, y double, x0 double, x1 double, x2 double")
    got = {r.g: np.array([r[f"beta{k}"] for k in range(4)]) for r in regression.least_squares(df, "g", ["x0", "x1", "x2"], "y").collect()}
    for g, x in (("a", a), ("b", b)):
        y, design = np.array([r[1] for r in rows if r[0] == g]), np.c_[np.ones(len(x)), x]
        assert design @ got[g] == pytest.approx(design @ np.linalg.lstsq(design, y, rcond=None)[0], abs=1e-8)
    assert got["b"][3] == 0


def test_normalise_runs_no_python(spark):
    ref = spark.createDataFrame([("p", f"s{k}", float(k % 7)) for k in range(30)], "pgs_id string, sample_id string, score double")
    places = spark.createDataFrame([(f"s{k}", "A", [float(k % 3), float(k % 5)]) for k in range(30)], "sample_id string, population string, pc array<double>")
    plan = stats.normalise(ref, places, ref.join(places, "sample_id"), 2)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan


def test_normalise(spark):
    rng = np.random.default_rng(4)
    pcs, scores = rng.normal(size=(60, 5)), rng.normal(size=60)
    pops = ["A" if k % 2 else "B" for k in range(60)]
    ref = spark.createDataFrame([("p", f"s{k}", float(scores[k])) for k in range(60)], "pgs_id string, sample_id string, score double")
    places = spark.createDataFrame([(f"s{k}", pops[k], pcs[k].tolist()) for k in range(60)], "sample_id string, population string, pc array<double>")
    target = spark.createDataFrame([("t", "p", 0.7, "A", pcs[3].tolist())], "sample_id string, pgs_id string, score double, population string, pc array<double>")
    row = stats.normalise(ref, places, target).first()
    own = scores[np.array(pops) == "A"]
    assert row.z_population == pytest.approx((0.7 - own.mean()) / own.std()) and row.percentile == pytest.approx(100 * (own < 0.7).mean())
    x = (pcs[:, :4] - pcs[:, :4].mean(0)) / pcs[:, :4].std(0)
    design = np.c_[np.ones(60), x]
    centered = scores - scores.mean()
    beta = np.linalg.lstsq(design, centered, rcond=None)[0]
    left = 0.7 - scores.mean() - design[3] @ beta
    assert row.z_norm1 == pytest.approx(left / (centered - design @ beta).std()) and np.isfinite(row.z_norm2) and np.sign(row.z_norm2) == np.sign(row.z_norm1)


def test_draws_from_one_product_equal_single_products(spark):
    rng = np.random.default_rng(15)
    base = rng.normal(size=(3, 40))
    v = [(k, (base[k % 3] + 0.8 * rng.normal(size=40)).tolist()) for k in range(26)]
    df = spark.createDataFrame(v, "item long, v array<double>")
    draws = {n: sorted(rng.choice(40, 30, replace=False).tolist()) for n in range(4)}
    rows = lambda d: sorted((r.a, r.b, round(r["corr"], 12)) for r in d.collect())
    got = graph.block_correlations(df, "item", "v", 5, 0.2, blocks=3, draws=draws)
    for n, at in draws.items():
        alone = df.select("item", F.array(*(F.get("v", F.lit(k)) for k in at)).alias("v"))
        assert rows(got.where(F.col("draw") == n)) == rows(graph.block_correlations(alone, "item", "v", 5, 0.2, blocks=3))
    edges = graph.reciprocal(got)
    assert {r.draw for r in edges.collect()} == set(draws) and edges.where("draw = 2").drop("draw").exceptAll(graph.reciprocal(got.where("draw = 2").drop("draw"))).isEmpty()
    # Each vector is sent once for each block, and each pair of blocks multiplied once.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Union" not in plan


def test_spread_communities_are_as_good(spark):
    rng = np.random.default_rng(23)
    edges, graphs = [], {0: (5, 24, 0.35, 0.02), 1: (3, 20, 0.3, 0.05)}
    for g, (groups, size, inner, outer) in graphs.items():
        n = groups * size
        edges += [(g, a, b, float(0.2 + rng.random())) for a in range(n) for b in range(a + 1, n) if rng.random() < (inner if a % groups == b % groups else outer)]
    edges += [(2, 1, 1, 3.0), (2, 4, 5, 1.0), (3, 7, 8, 0.0)]  # a loop, a pair, a graph without weight
    df = spark.createDataFrame(edges, "draw int, src long, dst long, abs_corr double")
    got = graph.spread_communities(df, ["draw"]).toPandas()
    for g, (groups, size, *_) in graphs.items():
        own = [e[1:] for e in edges if e[0] == g]
        part = got[got.draw == g]
        place = dict(zip(part.node, part.community))
        assert len(place) == groups * size and all(min(n for n in place if place[n] == c) == c for c in set(place.values()))
        assert graph.modularity(own, place) >= 0.99 * graph.modularity(own, graph.louvain(own)) > 0.3
    small = {(r.draw, r.node): r.community for r in got.itertuples() if r.draw > 1}
    assert small == {(2, 1): 1, (2, 4): 4, (2, 5): 4, (3, 7): 7, (3, 8): 8}
    assert graph.spread_communities(df.limit(0), ["draw"]).count() == 0


def test_graph(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(4, 50))
    v = [(k, (base[k % 4] + 0.4 * rng.normal(size=50)).tolist()) for k in range(32)]
    df = spark.createDataFrame(v, "item long, v array<double>")
    near = graph.block_correlations(df, "item", "v", 7, 0.3, blocks=3)
    r = np.corrcoef([x for _, x in v]) - np.eye(32)
    for row in near.collect():
        assert row["corr"] == pytest.approx(r[row.a, row.b]) and row.b in np.argsort(-np.abs(r[row.a]))[:7]
    edges = graph.reciprocal(near)
    found = edges.collect()
    assert found and all(e.src < e.dst for e in found)
    place = graph.louvain([(e.src, e.dst, e.abs_corr) for e in found])
    triples = [(e.src, e.dst, e.abs_corr) for e in found]
    assert {frozenset(n for n in place if place[n] == c) for c in place.values()} == {frozenset(range(k, 32, 4)) for k in range(4)} and graph.modularity(triples, place) > 0.6
    spread = {r.node: r.community for r in graph.communities(edges.withColumn("draw", F.lit(0)), ["draw"]).collect()}
    assert spread == place
    assert {r.node: r.component for r in graph.components(edges).collect()} == {n: n % 4 for n in range(32)}
    members = spark.createDataFrame([(k % 4, *x) for k, x in enumerate(v)], "m long, item long, v array<double>")
    loads = graph.loadings(members, "m", "item", "v").toPandas()
    assert np.allclose(loads.groupby("m").loading.apply(lambda s: (s**2).sum()), 1) and (loads.groupby("m").loading.mean() > 0).all()


def test_jaccard_and_stability(spark):
    a = spark.createDataFrame([(1, x) for x in "abc"] + [(2, x) for x in "xy"], "community int, node string")
    b = spark.createDataFrame([(0, 7, x) for x in "bcd"] + [(1, 8, x) for x in "abc"], "draw int, community int, node string")
    assert [tuple(r) for r in graph.jaccard_pairs(a, b.where("draw = 0")).collect()] == [(1, 7, 2, 0.5)]
    assert {r.community: (r.size, r.mean_jaccard) for r in graph.stability(a, b).collect()} == {1: (3, 0.75), 2: (2, 0.0)}
    assert graph.retained(graph.stability(a, b)).count() == 1


def _by_the_formulas(u, s, v, b, dims, study, online):
    """Online augmentation, decomposition and Procrustes as published, over the whole matrices: decompose [U S V', b], then align
    the reference's new places to its old ones, with columns of their own for the components that the old ones lack."""
    x = np.c_[(u[:, :online] * s[:online]) @ v[:, :online].T, b]
    _, d, wt = np.linalg.svd(x, full_matrices=False)
    study = min(study, online + 1, len(d))
    moved = (wt.T * d)[:, :study]
    old, new = v[:, :dims] * s[:dims], moved[:-1]
    extra = np.zeros((len(old), study - dims))
    while True:
        target = np.hstack([old, extra])
        l, c, r = np.linalg.svd((target - target.mean(0)).T @ (new - new.mean(0)))
        turn = r.T @ l.T * c.sum() / ((new - new.mean(0)) ** 2).sum()
        fitted = (new - new.mean(0)) @ turn + target.mean(0)
        if study == dims or ((fitted[:, dims:] - extra) ** 2).sum() < 1e-6 * ((fitted[:, dims:] - fitted[:, dims:].mean(0)) ** 2).sum():
            return ((moved[-1] - new.mean(0)) @ turn + target.mean(0))[:dims]
        extra = fitted[:, dims:]


@pytest.mark.parametrize("centred", [True, False])
def test_projection_equals_the_formulas(centred):
    rng = np.random.default_rng(6)
    for dims, study, online in ((3, 6, 40), (5, 5, 30), (10, 20, 40), (2, 4, 4)):
        z = rng.normal(size=(120, 60)) + 3 * rng.normal(size=(120, 3)) @ rng.normal(size=(3, 60))
        z = z - z.mean(1, keepdims=True) if centred else z + 0.3
        u, s, vt = np.linalg.svd(z, full_matrices=False)
        u, s, v = u[:, :online], s[:online], vt[:online].T
        places = ml.Places.of(v)
        if centred:
            assert np.allclose(places.mean, 0) and np.allclose(places.gram, np.eye(online)[: len(s), : len(s)])
        for b in (z[:, 0], rng.normal(size=120), np.zeros(120), 100 * z[:, 1]):
            assert ml.project_sample(u, s, places, b, dims, study, online) == pytest.approx(_by_the_formulas(u, s, v, b, dims, study, online), rel=1e-9, abs=1e-9)


def test_projection_of_reference_sample_stays():
    rng = np.random.default_rng(6)
    z = rng.normal(size=(300, 60)) + 3 * rng.normal(size=(300, 3)) @ rng.normal(size=(3, 60))
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    places = vt[:3].T * s[:3]
    got = np.array([ml.project_sample(u, s, ml.Places.of(vt.T), z[:, k], 3, 6, 40) for k in range(5)])
    assert np.abs(got - places[:5]).max() < 0.2 * np.abs(places).max()
    assert ml.project_sample(u[:, :0], s[:0], ml.Places.standard(60, 0), z[:, 0], 3).tolist() == [0, 0, 0]


def test_projection_onto_all_samples(spark, tmp_path):
    from skein.queries import Q

    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(200, 12)), 3 + rng.normal(size=(60, 12)) @ rng.normal(size=(12, 12))])  # those of larger ids are of another kind
    spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    z = ((x - x.mean(0)) / x.std(0)).T
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    got = {int(r.sample_id): np.abs(r.pc) for r in Q["q63_projection_of_samples"](spark, str(tmp_path)).collect()}
    assert len(got) == 260
    for k in (0, 77, 199, 200, 259):
        want = ml.project_sample(u[:, :40], s[:40], ml.Places.of(vt[:40].T), z[:, k], 10, 12)
        assert got[k] == pytest.approx(np.abs(want), rel=1e-5, abs=1e-6)


def test_resampling(spark):
    df = spark.createDataFrame([(k, k % 3) for k in range(60)], "u long, y int")
    folds = resample.stratified_folds(df, "y", "u").groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds} == {4} and len(folds) == 15
    drawn = resample.subsamples(df, "u", 3).groupBy("draw").agg(F.count("*").alias("n"), F.countDistinct("u").alias("d")).collect()
    assert {(r.n, r.d) for r in drawn} == {(48, 48)} and len(drawn) == 3
    mixed = resample.permuted(df, "u", "y", 4)
    assert {tuple(sorted(r.l)) for r in mixed.groupBy("draw").agg(F.collect_list("y").alias("l")).collect()} == {tuple(sorted(k % 3 for k in range(60)))}
    assert mixed.join(df.withColumnRenamed("y", "old"), "u").where("y <> old").count() > 0
    boot = resample.bootstrap(df, "u", 5).groupBy("draw").agg(F.count("*").alias("n"), F.countDistinct("u").alias("d")).collect()
    assert {r.n for r in boot} == {60} and all(r.d < 60 for r in boot)
    one = resample.hash_rank(df, ["y"], 7, "u", "k")
    parts = resample.hash_rank(df, ["y"], 7, "u", "k", per_part=5)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, parts.select(*one.columns).collect()))
    assert resample.bootstrap(df.limit(0), "u", 5).count() == 0


def test_null_groups_have_places_in_parts(spark):
    df = spark.createDataFrame([(k, [0, 1, None][k % 3]) for k in range(60)], "u long, y int")
    one, parts = resample.stratified_folds(df, "y", "u"), resample.stratified_folds(df, "y", "u", per_part=5)
    assert parts.columns == one.columns and sorted(map(str, parts.collect())) == sorted(map(str, one.collect()))
    assert parts.where("y is null").count() == 20


def test_confusion_matrix_has_all_classes(spark, tmp_path):
    import duckdb
    from skein.queries import Q, SQL

    rows = [("de", "src0"), ("de", "src7"), ("de", "src7"), ("nl", "src19"), (None, "src0"), ("en", None), (None, None)]
    spark.createDataFrame(rows, "lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.lang, r.source): r.n for r in Q["q37c_confusion_matrix_whole"](spark, str(tmp_path)).collect()}
    assert got == {(a, b): rows.count((a, b)) for a in ("de", "nl", "en", None) for b in ("src0", "src7", "src19", None)}
    con = duckdb.connect()
    con.sql(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == {(a, b): n for a, b, n in con.sql(SQL["q37c_confusion_matrix_whole"]).fetchall()}


def test_queries_resample_in_full(spark, monkeypatch):
    import duckdb
    from skein import queries

    d, con = "/root/testdata/sf0.001", duckdb.connect()
    con.sql(f"create view labels as from '{d}/labels.parquet'")
    for name, draws in (("q50_permutation", 100), ("q51_bootstrap", 1000)):
        got, want = tuple(queries.Q[name](spark, d).first()), con.sql(queries.SQL[name]).fetchall()[0]
        assert got == pytest.approx(want, abs=2e-6) and got[-1] == draws

    picked = queries._component_draws(spark, d)
    n = len(t.embedding) if (t := queries.t(spark, d, "embeddings").first()) else 0
    assert len(picked) == 25 and {len(set(p)) for p in picked.values()} == {int(n * 0.8)} and set().union(*picked.values()) == set(range(n))
    seen, fit = [], ml.train_forest
    monkeypatch.setattr(ml, "train_forest", lambda df, label, trees, depth, seed: seen.append((trees, depth)) or fit(df, label, 2, 2, seed))
    queries.Q["q62_forest"](spark, d)
    assert seen == [(500, 12)] * 5


def test_forest_and_validation(spark):
    rows = [(k, [float(k % 2) + 0.01 * k, 1.0, None], float(k % 2)) for k in range(60)]
    df = ml.features(spark.createDataFrame(rows, "u long, x array<double>, y double"), ["x"])
    out = ml.cross_validated(df, "u", "y", 3, 5, 3)
    auc = stats.rank_auc(out.withColumn("g", F.lit(1)), "p", "label", ["g"], symmetric=False).first().auc
    assert auc > 0.95
    model = ml.train_forest(df, "y", 5, 3)
    assert ml.importances(model, ["a", "b", "c"], 2)[0][0] == "a"
    named = ml.classify_population(model, ["even", "odd"], spark.createDataFrame([("s", [1.5, 1.0, 0.0])], "sample_id string, pc array<double>"), 3).first()
    assert named.most_similar == "odd" and not named.low_confidence and named.pop_probs["odd"] > 0.5


def test_reshape(spark):
    df = spark.createDataFrame([("a", "x", 1, 0), ("a", "x", 2, 1), ("b", "y", 3, 0)], "r string, c string, v int, seq int")
    wide = {r.r: (r.x, r.y) for r in reshape.wide(df, "r", "c", "v", ["x", "y"], "seq").collect()}
    assert wide == {"a": (2, None), "b": (None, 3)}
    acc = reshape.top_k_accuracy(spark.createDataFrame([(1, "a", "a", 0.9), (1, "a", "b", 0.9), (2, "b", "a", 0.9), (2, "b", "b", 0.1)], "u int, truth string, cand string, p double"), "u", "truth", "cand", "p", (1, 2)).first()
    assert (acc.n, acc.top1, acc.top2) == (2, 0.5, 1.0)
