"""Ranks and quantiles of groups that are cut by ranges, against those of one window a group."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import ranks, stats


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(v) if v is not None else None, int(y)) for g, vs in (("a", rng.normal(size=900)), ("b", rng.integers(0, 9, 700)), (None, rng.normal(size=80)), ("one", [3.0]), ("none", [None, None]), ("same", [2.0] * 40)) for v, y in zip(vs, rng.integers(0, 2, 1000))]
    return spark.createDataFrame(rows, "g string, v double, y int").repartition(5).persist()


def rows(df, digits=9):
    return sorted((tuple(round(x, digits) if isinstance(x, float) else [round(z, digits) for z in x] if isinstance(x, list) else x for x in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("by", [["g"], [], ["g", "y"]])
def test_cut_groups_have_the_same_ranks_and_quantiles(values, by):
    counts = values.groupBy(*by, "v").agg(F.count("*").alias("_n"))
    assert rows(ranks.running(counts, by, "v", spread=True)) == rows(ranks.running(counts, by, "v", spread=False))
    shares = [0.0, 0.005, 0.25, 0.5, 0.77, 1.0]
    assert rows(ranks.quantiles(values, "v", by, shares, spread=True)) == rows(ranks.quantiles(values, "v", by, shares, spread=False))


def test_statistics_are_the_same_either_way(values):
    known = values.where("g is not null and v is not null")
    for f in (
        lambda spread: stats.percentiles_within(known, "v", ["g"], spread=spread),
        lambda spread: stats.winsorised(known, "v", ["g"], spread=spread),
        lambda spread: stats.robust_scale(known, "v", ["g"], spread=spread),
        lambda spread: stats.iqr_thresholds(known, "v", ["g"], spread=spread),
        lambda spread: stats.rank_auc(values, "v", "y", ["g"], spread=spread),
        lambda spread: stats.percentiles_of(known.select("g", F.col("v").alias("score")), known.select("g", (F.col("v") + 0.5).alias("score")), ["g"], spread=spread),
    ):
        assert rows(f(True)) == rows(f(False))


def test_one_group_is_spread_over_all_parts(spark):
    one = spark.range(200_000).select(F.lit("g").alias("g"), F.xxhash64("id").cast("double").alias("v"), F.lit(1).alias("_n"))
    got = ranks.running(one, ["g"], "v", spread=True)
    assert got.agg(F.max("_upto"), F.countDistinct("_upto"), F.min("_all"), F.max("_all")).first() == (200_000, 200_000, 200_000, 200_000)
    # The window's rows are dealt by part: its largest task has a part's share (small parts are put together elsewhere).
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = one.repartitionByRange("g", "v").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 80_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("_part" in line for line in plan.splitlines() if "Window" in line and "_inside" in line)


def test_which_way_follows_from_the_estimate(spark, tmp_path, monkeypatch):
    spark.createDataFrame([("a", float(k % 50)) for k in range(400)], "g string, v double").write.parquet(f"{tmp_path}/v")
    values = spark.read.parquet(f"{tmp_path}/v")
    joined = values.join(values.withColumnRenamed("v", "other"), "g").join(spark.createDataFrame([("a",)], "g string"), "g")
    assert not ranks.is_large(values.groupBy("g").count()) and not ranks.is_large(joined)
    monkeypatch.setattr(ranks, "SPREAD_BYTES", 10)
    assert ranks.is_large(values) and ranks.is_large(joined)
    assert "_before" in ranks.running(values.groupBy("g", "v").agg(F.count("*").alias("_n")), ["g"], "v")._jdf.queryExecution().analyzed().toString()
    assert rows(stats.percentiles_within(values.where("g = 'a'"), "v", ["g"])) == rows(stats.percentiles_within(values.where("g = 'a'"), "v", ["g"], spread=False))


def test_empty(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert ranks.quantiles(none, "v", ["g"], [0.5], spread=True).count() == 0
    assert stats.percentiles_within(none, "v", ["g"], spread=True).count() == 0
