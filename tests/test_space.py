"""Principal components over blocks of variants, against a dense decomposition."""

import numpy as np
import pytest

from skein.operators import space
from skein.operators.dosage import standardised
from pyspark.sql import functions as F


def panel_of(spark, x, parts=4):
    rows = [(k, [None if np.isnan(c) else int(c) for c in row]) for k, row in enumerate(x)]
    return spark.createDataFrame(rows, "vkey long, dosages array<int>").repartition(parts)


def dense(x):
    known = np.isfinite(x)
    n = known.sum(1)
    mean = np.where(known, x, 0).sum(1) / np.maximum(n, 1)
    z = np.where(known, x - mean[:, None], 0)
    std = np.sqrt((z**2).sum(1) / np.maximum(n, 1))
    z = np.where(std[:, None] > 0, z / np.where(std > 0, std, 1)[:, None], 0)
    return z, np.linalg.svd(z, full_matrices=False)


def structured(rng, m, n, groups=5, missing=0.02):
    f = rng.beta(0.8, 0.8, size=(m, groups))
    x = rng.binomial(2, f[:, np.arange(n) % groups]).astype(float)
    x[rng.random(x.shape) < missing] = np.nan
    x[3] = 1.0
    x[5] = np.nan
    return x


@pytest.mark.parametrize(("m", "n", "block", "most"), [(400, 60, 32, 256), (900, 300, 24, 96)])
def test_first_components_equal_the_dense_ones(spark, monkeypatch, m, n, block, most):
    monkeypatch.setattr(space, "CHUNK", 50)
    x = structured(np.random.default_rng(m), m, n)
    z, (u, s, vt) = dense(x)
    panel = panel_of(spark, x)
    got, v = space.principal_components(panel, block=block, most=most, settled=10)
    assert got.shape == (40,) and got[:10] == pytest.approx(s[:10], rel=1e-9)
    gaps = np.minimum(s[:10] - s[1:11], np.r_[np.inf, s[:9] - s[1:10]]) / s[0]
    sharp = gaps > 1e-3  # close values share a plane, not their directions
    assert sharp.sum() >= 4 and np.abs(np.abs((v[:, :10] * vt[:10].T).sum(0)) - 1)[sharp].max() < 1e-6
    assert v.T @ v == pytest.approx(np.eye(40), abs=1e-9)
    rows = {r.vkey: r for r in space.directions(panel, got, v, ["vkey"]).collect()}
    mine = np.array([rows[k].u for k in range(m)])
    assert mine.T @ mine == pytest.approx(np.eye(40), abs=1e-7) and np.abs(np.abs((mine[:, :10] * u[:, :10]).sum(0)) - 1)[sharp].max() < 1e-6
    assert rows[3].std == 0 and rows[5].mean == 0 and not any(rows[3].u)


def test_few_samples_variants_or_none(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, size=(6, 9)).astype(float)
    z, (u, s, vt) = dense(x)
    got, v = space.principal_components(panel_of(spark, x))
    rank = (s > 1e-5 * s[0]).sum()
    assert got == pytest.approx(s[:rank]) and v.shape == (9, rank)
    assert space.principal_components(panel_of(spark, np.ones((4, 5))))[0].size == 0
    assert space.principal_components(spark.createDataFrame([], "vkey long, dosages array<int>"))[0].size == 0
    again = space.principal_components(panel_of(spark, x, 2))[1]
    assert again == pytest.approx(v, abs=1e-9)  # signs too


def test_standardised_as_targets_are(spark):
    """Panel rows and a target's are standardised alike."""
    x = np.random.default_rng(8).integers(0, 3, size=(20, 30)).astype(float)
    panel = panel_of(spark, x)
    s, v = space.principal_components(panel, dims=3)
    rows = space.directions(panel, s, v, ["vkey"]).join(spark.createDataFrame([(k, float(x[k, 4])) for k in range(20)], "vkey long, dosage double"), "vkey")
    inside = rows.select(*(F.sum(standardised(F.col("dosage"), F.col("mean"), F.col("std")) * F.get("u", F.lit(j))) for j in range(3))).first()
    assert np.array(inside) == pytest.approx(v[4] * s, abs=1e-9)
