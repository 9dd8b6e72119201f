"""Steps whose work or memory once grew faster than their input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import graph, match, resample, score
from skein.sources import text


def by_sorting(x, y, k, threshold, same):
    r = np.clip(x @ y.T / (x.shape[1] - 1), -1, 1)
    if same:
        np.fill_diagonal(r, 0.0)
    order = np.argsort(-np.abs(r), axis=1, kind="stable")[:, :k]
    return {(i, int(j), float(r[i, j])) for i, row in enumerate(order) for j in row if abs(r[i, j]) >= threshold}


@pytest.mark.parametrize("same", [False, True])
def test_strongest_of_tiles_are_those_of_a_sort(monkeypatch, same):
    monkeypatch.setattr(graph, "TILE_ITEMS", 64)
    rng = np.random.default_rng(3)
    x = rng.integers(-1, 2, (150, 16)).astype(float)  # products are whole numbers: many ties, and exact
    y = x if same else rng.integers(-1, 2, (170, 16)).astype(float)
    x[::3] = x[0]
    rows, columns = graph.strongest(x, None if same else y, 3, 0.1)
    assert set(zip(*(c.tolist() for c in rows))) == by_sorting(x, y, 3, 0.1, same)
    if not same:
        assert set(zip(*(c.tolist() for c in columns))) == by_sorting(y, x, 3, 0.1, False)


def test_strongest_are_told_apart_beyond_single_precision(monkeypatch):
    """Others that are alike but for 1e-10, in any order, and in more than a tile."""
    monkeypatch.setattr(graph, "STRIP", (16, 64))
    rng = np.random.default_rng(4)
    x = graph.standard(rng.normal(size=(40, 20)))
    y = graph.standard(np.repeat(x, 12, axis=0)[rng.permutation(480)] + 1e-5 * rng.normal(size=(480, 20)))
    rows, columns = graph.strongest(x, y, 5, 0.2)
    for got, want in ((rows, by_sorting(x, y, 5, 0.2, False)), (columns, by_sorting(y, x, 5, 0.2, False))):
        assert set(zip(got[0].tolist(), got[1].tolist())) == {(i, j) for i, j, _ in want}
        assert dict(zip(zip(*(c.tolist() for c in got[:2])), got[2])) == pytest.approx({(i, j): r for i, j, r in want}, abs=1e-14)


def test_neighbours_of_an_item_leave_one_task(spark, monkeypatch):
    """Each block of others once gave k for each item (and draw), which were shuffled and ranked: rows grew with items times blocks."""
    monkeypatch.setattr(graph, "STRIP", (8, 16))
    rng = np.random.default_rng(6)
    m = rng.integers(-2, 3, (90, 12)).astype(float)
    m[60:] = m[:30]  # equal ones: ties go to the first name
    names = [f"n{k:02d}" for k in rng.permutation(90)]
    vectors = spark.createDataFrame([(n, v.tolist()) for n, v in zip(names, m)], "item string, v array<float>")
    draws = {3: list(range(9)), 5: list(range(2, 12))}
    got = graph.block_correlations(vectors, "item", "v", 4, 0.3, blocks=5, draws=draws)
    assert "Window" not in plan(got) and plan(got).count("Exchange") == 1
    order = np.argsort(names)
    want = {}
    for n, at in draws.items():
        z = graph.standard(m[order][:, at])
        r = np.round(np.clip(z @ z.T / (len(at) - 1), -1, 1), 12)
        np.fill_diagonal(r, 0.0)
        for i in range(90):
            for j in np.argsort(-np.abs(r[i]), kind="stable")[:4]:
                if abs(r[i, j]) >= 0.3:
                    want[n, names[order[i]], names[order[j]]] = r[i, j]
    found = {(r.draw, r.a, r.b): r["corr"] for r in got.collect()}
    assert {k: len([1 for x in found if x[:2] == k]) for k in {x[:2] for x in found}} == {k: len([1 for x in want if x[:2] == k]) for k in {x[:2] for x in want}}
    assert sorted((n, a, round(abs(r), 9)) for (n, a, _), r in found.items()) == sorted((n, a, round(abs(r), 9)) for (n, a, _), r in want.items())
    ones = lambda d: {k for k, r in d.items() if abs(r) > 1 - 1e-9}
    assert ones(found) == ones(want) and len(ones(want)) >= 120


def test_blocks_do_not_grow_with_the_items():
    """A vector is sent once for each block, and k leave a task for each item."""
    assert graph.block_count(100) == 4 and graph.block_count(100_000) <= 25 and graph.block_count(500_000) <= 25


def test_reciprocal_computes_the_pairs_once(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5), (3, 1, 0.4), (2, 3, -0.9), (3, 2, -0.9)], "a int, b int, corr double")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = graph.reciprocal(pairs.mapInArrow(count, pairs.schema))
    assert sorted(map(tuple, edges.collect())) == [(1, 2, 0.5, 0.5), (2, 3, -0.9, 0.9)]
    assert seen.value == 5


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_draws_are_not_broadcast(spark):
    """Spark estimates exploded rows at the size of what they come from, and would send all draws through the driver."""
    units = spark.createDataFrame([(k, k % 2, k % 3) for k in range(40)], "u long, y int, v int")
    for df in (resample.bootstrap(units, "u", 50), resample.permuted(units, "u", "y", 50, keep=["v"])):
        assert "BroadcastExchange" not in plan(df)
    mixed = resample.permuted(units, "u", "y", 3, keep=["v"]).collect()
    assert len(mixed) == 120 and all(r.v == r.u % 3 for r in mixed) and all(sum(r.y for r in mixed if r.draw == d) == 20 for d in range(3))
    assert resample.permuted(units, "u", "y", 3).columns == ["draw", "u", "y"]


def test_correlation_totals_are_those_of_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(graph, "TILE_ITEMS", 16)
    rng = np.random.default_rng(5)
    m = rng.normal(size=(60, 12))
    vectors = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(rng.permutation(60) * 7, m)], "item long, v array<double>")
    c = graph.pair_correlations(spark.createDataFrame([(r.item, k, float(x)) for r in vectors.collect() for k, x in enumerate(graph.standard(np.array([r.v]))[0])], "item long, k int, z double"), "item", "k", "z")
    want = {r.a: r for r in c.groupBy("a").agg(F.count("*").alias("n"), F.sum("corr").alias("total"), F.max("corr").alias("most"), F.min("corr").alias("least")).collect()}
    got = graph.correlation_totals(vectors, "item", "v", blocks=3).collect()
    assert len(got) == len(want) == 59
    for r in got:
        w = want[r.a]
        assert r.n == w.n and np.allclose([r.total, r.most, r.least], [w.total, w.most, w.least], atol=1e-12)


def test_fallback_totals_are_those_of_the_rows(spark):
    w = spark.createDataFrame([("p", 1, "a"), ("p", 1, "a"), ("p", 9, "b"), ("q", 9, "a"), ("q", None, "b"), ("r", 2, None)], "pgs_id string, k long, rs string")
    o = spark.createDataFrame([(1, "a", 1.0), (1, "b", 0.5), (2, "b", 2.0), (2, "b", 3.0), (3, "c", None), (None, "a", 4.0), (9, None, 8.0)], "k long, rs string, dosage double")
    want = match.exact_then_fallback(w, o, "k", "rs").groupBy("source", "pgs_id").agg(F.count("*").alias("n"), F.sum("dosage").alias("total"))
    got = match.exact_then_fallback_totals(w, o, "k", "rs")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_fallback_totals_do_not_list_the_pairs(spark):
    """A key that 20,000 rows of either table share has 4 * 10^8 pairs."""
    w = spark.range(20_000).select(F.lit("p").alias("pgs_id"), F.lit(-1).alias("k"), F.lit("a").alias("rs"))
    o = spark.range(20_000).select(F.lit(1).alias("k"), F.lit("a").alias("rs"), F.lit(2.0).alias("dosage"))
    assert list(map(tuple, match.exact_then_fallback_totals(w, o, "k", "rs").collect())) == [("fallback", "p", 400_000_000, 800_000_000.0)]


def test_last_row_of_a_patient_is_that_of_the_last_file(spark, tmp_path):
    """Spark reads large files first, whatever their names."""
    (tmp_path / "part-0.csv").write_text("pgs_id\tZ_norm1\nA\t1.0\n")
    (tmp_path / "part-1.csv").write_text("pgs_id\tZ_norm1\nA\t2.0\n" + "B\t3.0\n" * 500_000)
    assert {r.pgs_id: r.z for r in text.read_patient(spark, str(tmp_path)).collect()} == {"A": 2.0, "B": 3.0}


def test_scores_of_all_samples_match_once(spark):
    """Samples are taken from the sums, not from the matches once more."""
    seen = spark.sparkContext.accumulator(0)
    rows = [(1, "p", 1.0, 0.5), (1, "p", 2.0, 0.5), (2, "q", None, 1.0), (2, "x", 1.0, 1.0), (None, "q", 1.0, 1.0), (3, None, 1.0, 1.0)]
    matched = spark.createDataFrame(rows, "sample_id int, pgs_id string, dosage double, weight double").withColumns({"flip": F.lit(0), "model": F.lit(0)})

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    meta = spark.createDataFrame([("p", 4), ("q", 0)], "pgs_id string, num_original long")
    got = score.weighted_scores(matched.mapInArrow(count, matched.schema), meta)
    out = {(r.sample_id, r.pgs_id): (r.raw_score, r.variants_matched, r.variants_missing, r.match_rate) for r in got.collect()}
    zeros = {(s, p): (0.0, 0, n, 0.0) for s in (1, 2, 3, None) for p, n in (("p", 4), ("q", 0))}
    assert out == zeros | {(1, "p"): (1.5, 2, 2, 0.5)}
    assert seen.value == len(rows)


def test_jaccard_counts_pairs_where_they_are_made(spark):
    """Of many groups, sizes once met pairs in two joins that shuffled all of these again. Nulls: a null group has no pairs, a null member counts in sizes alone."""
    left = [("a", 1), ("a", 1), ("a", 2), ("a", None), ("a", None), ("b", 2), ("b", 3), (None, 1), ("c", None)]
    right = [("a", 2), ("x", 1), ("x", 2), ("x", 9), ("y", 3), ("y", None), (None, 3), ("z", 8)]
    frames = [spark.createDataFrame(rows, "community string, node int") for rows in (left, right)]
    sets = [{g: {m for x, m in rows if x == g} for g, _ in rows if g} for rows in (left, right)]
    want = {(g, h): (n, n / (len(s) + len(o) - n)) for g, s in sets[0].items() for h, o in sets[1].items() if (n := len((s & o) - {None}))}
    out = graph.jaccard_pairs(*frames)
    assert sorted(map(tuple, out.collect())) == sorted((*k, *v) for k, v in want.items())
    assert "Join" not in plan(out)


def by_looking_at_all(near, degree, order, total):
    """Greedy moves that look at every node in every round."""
    place, inside, moved, looks = list(range(len(near))), list(degree), True, 0
    while moved:
        moved = False
        for n in order:
            looks += len(near[n])
            links = {}
            for m, w in near[n]:
                links[place[m]] = links.get(place[m], 0.0) + w
            here, best = place[n], place[n]
            inside[here] -= degree[n]
            gain = links.get(here, 0.0) - inside[here] * degree[n] / (2 * total)
            for c in sorted(links):
                if (g := links[c] - inside[c] * degree[n] / (2 * total)) > gain + 1e-12:
                    best, gain = c, g
            inside[best] += degree[n]
            moved, place[n] = moved or best != here, best
    return place, looks


def test_nodes_that_cannot_move_are_passed_over():
    class Counted(list):
        looks = 0

        def __iter__(self):
            Counted.looks += len(self)
            return super().__iter__()

    rng = np.random.default_rng(8)
    seen = 0
    for k in range(30):
        n = int(rng.integers(2, 400))
        edges = {tuple(sorted(map(int, rng.choice(n, 2, replace=False)))): float(rng.choice([0.5, 1.0, rng.random()])) for _ in range(4 * n)}
        near = [Counted() for _ in range(n)]
        for (a, b), w in edges.items():
            near[a].append((b, w))
            near[b].append((a, w))
        degree, order = [sum(w for _, w in list(x)) for x in near], rng.permutation(n).tolist()
        Counted.looks = 0
        got = graph._settled(near, degree, order, sum(edges.values()))
        looked = Counted.looks
        want, looks = by_looking_at_all(near, degree, order, sum(edges.values()))
        assert got == want
        seen += looked / looks / 30
    assert seen < 0.95


def test_communities_are_found_once(spark):
    """Stability reads those of the draws three times and those of the base twice."""
    edges = spark.createDataFrame([(d, a, b, 1.0) for d in range(3) for a, b in ((1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6))], "draw int, src int, dst int, abs_corr double")
    found = graph.communities(edges, ["draw"])
    assert "InPandas" not in plan(found)
    assert {tuple(r) for r in found.collect()} == {(d, n, 1 if n < 4 else 4) for d in range(3) for n in range(1, 7)}
    assert sorted(map(tuple, graph.stability(found.where("draw = 0").drop("draw"), found).collect())) == [(1, 3, 1.0), (4, 3, 1.0)]
