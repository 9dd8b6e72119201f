"""Dense algebra and classifiers: projection of new samples, population and disease forests, feature vectors."""

from __future__ import annotations

from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import forests
from skein.session import written


class Places(NamedTuple):
    """The reference samples' places as projection needs them: their number, their mean and their Gram matrix about it. None of it grows with the samples."""

    n: int
    mean: np.ndarray
    gram: np.ndarray

    @classmethod
    def of(cls, v: np.ndarray) -> Places:
        """Of places as rows (right vectors of a decomposition)."""
        about = v - v.mean(0)
        return cls(len(v), v.mean(0), about.T @ about)

    @classmethod
    def standard(cls, n: int, dims: int) -> Places:
        """Of orthonormal, centred places: those of a matrix whose rows have mean 0."""
        return cls(n, np.zeros(dims), np.eye(dims))

    def first(self, dims: int) -> Places:
        return Places(self.n, self.mean[:dims], self.gram[:dims, :dims])


def place(s: np.ndarray, places: Places, inside: np.ndarray, square: float, dims: int = 10, study_dims: int = 20, online_dims: int = 40, rounds: int = 10_000, tolerance: float = 1e-6) -> np.ndarray:
    """Components of a standardised sample in the reference's space, by online augmentation of its decomposition and a Procrustes alignment to the old places.

    inside, square: the sample's products with the reference's directions, and its square, which are all that is needed of it.
    The reference's new places are its old ones (v) times a small matrix, and so are the places to align to; means, cross products
    and distances between them follow from v's mean and Gram matrix. Where fewer components are wanted than aligned, the missing ones
    are what the last alignment gives (v times ``fill`` plus ``level``), until they settle.
    """
    k = min(online_dims, len(s))
    n, mean, gram = places.first(k)
    inside = np.asarray(inside)[:k]
    outside = np.sqrt(max(0.0, square - inside @ inside))
    _, values, turned = np.linalg.svd(np.block([[np.diag(s[:k]), inside[:, None]], [np.zeros((1, k)), np.full((1, 1), outside)]]))
    wide = min(study_dims, k + 1)
    moved = turned.T[:, :wide] * values[:wide]
    new, own = moved[:k], moved[k]
    inner = gram @ new
    size = float((new * inner).sum())
    if size <= 0:
        return np.zeros(dims)
    dims = min(dims, k)
    target, fill, level = np.diag(s[:k])[:, :dims], np.zeros((k, max(0, wide - dims))), np.zeros(max(0, wide - dims))
    for _ in range(rounds):
        left, cross, right = np.linalg.svd(np.hstack([target, fill]).T @ inner, full_matrices=False)
        turn = (right.T @ left.T) * (cross.sum() / size)
        shift = np.r_[mean @ target, mean @ fill + level] - mean @ new @ turn
        if wide <= dims:
            break
        change, step = (new @ turn)[:, dims:] - fill, shift[dims:] - level
        fill, level = fill + change, shift[dims:]
        spread = float((fill * (gram @ fill)).sum())
        far = float((change * (gram @ change)).sum()) + n * float(((mean @ change + step) ** 2).sum())
        if spread <= 0 or far / spread < tolerance:
            break
    return (own @ turn + shift)[:dims]


def project_sample(u: np.ndarray, s: np.ndarray, places: Places, sample: np.ndarray, dims: int = 10, study_dims: int = 20, online_dims: int = 40) -> np.ndarray:
    """place of a sample that is at hand."""
    return place(s, places, u.T @ sample, float(sample @ sample), dims, study_dims, online_dims)


def reference_space(df: DataFrame, vector: str, mean: list[float], std: list[float], dims: int) -> tuple[np.ndarray, np.ndarray, Places]:
    """(u, s, places) of all vectors, standardised by component: directions, singular values and places, for project_sample.

    u and s come from the Gram matrix of the components, summed in the tasks. As components are centred, so are the places, whose Gram matrix is 1.
    """
    n, center, scale = len(mean), np.array(mean, float), np.array(std, float)

    def summed(batches):
        total = np.zeros((n, n))
        for batch in batches:
            part = [x for x in batch.column(0).to_pylist() if x is not None]
            z = np.full((len(part), n), np.nan)
            for k, x in enumerate(part):
                z[k, : len(x)] = [np.nan if c is None else c for c in x]
            with np.errstate(all="ignore"):
                z = (z - center) / scale
            z[~np.isfinite(z)] = 0.0
            total += z.T @ z
        i, j = np.indices((n, n))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "g"])

    gram = np.zeros((n, n))
    for r in df.select(vector).mapInArrow(summed, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():  # components squared
        gram[r.i, r.j] = r.g
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(dims, int((values > 1e-10 * max(values[0], 1e-300)).sum())) if n else 0
    u = vectors[:, :k] * np.where(vectors[np.abs(vectors).argmax(0), np.arange(n)] < 0, -1.0, 1.0)[:k]
    return u, np.sqrt(values[:k]), Places.standard(df.count(), k)


def project_samples(standardised: DataFrame, directions: DataFrame, s: np.ndarray, places: Places, variant: str = "variant_index", sample: str = "sample_id", value: str = "w", dims: int = 10) -> DataFrame:
    """(sample, pc array) of long standardised rows. directions: variant and u (array).

    A sample's products with the directions are sums over its variants, combined where they are read; a task then sees a row of sums for each sample.
    """
    k, dims = len(s), min(dims, len(s))
    w = F.col(value).cast("double")
    joined = standardised.select(sample, variant, w.alias("_w")).join(directions.select(variant, "u"), variant)
    sums = joined.groupBy(sample).agg(F.array(*(F.sum(F.col("_w") * F.get("u", F.lit(j))) for j in range(k))).cast("array<double>").alias("inside"), F.sum(F.col("_w") * F.col("_w")).alias("square"))

    def run(batches):
        for batch in batches:
            pcs = [place(s, places, np.array(inside, float), square, dims, min(2 * dims, k)).tolist() for inside, square in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pcs, pa.list_(pa.float64()))], [sample, "pc"])

    return sums.select(F.col(sample).cast("string").alias(sample), "inside", "square").mapInArrow(run, f"{sample} string, pc array<double>")


def features(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """A vector column of numeric and array columns in order; missing values are 0."""
    parts = []
    for c in columns:
        if df.schema[c].dataType.typeName() == "array":
            parts.append(F.transform(F.col(c), lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0))))
        else:
            parts.append(F.array(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))))
    return df.withColumn(out, array_to_vector(F.concat(*parts)))


class Forest:
    """A forest that rows are to grow. By itself it is MLlib's model, grown when it is first used; folds of one table are grown together (cross_validated)."""

    def __init__(self, rows: DataFrame, label: str, trees: int, depth: int, seed: int, balanced: bool) -> None:
        self.rows, self.label, self.trees, self.depth, self.seed, self.balanced = rows, label, trees, depth, seed, balanced

    @cached_property
    def model(self) -> RandomForestClassificationModel:
        df, label = self.rows, self.label
        forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=self.trees, maxDepth=self.depth, seed=self.seed)
        if self.balanced:
            n = df.count()
            sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
            weight = F.lit(1.0)
            for value, size in sizes.items():
                weight = F.when(F.col(label) == value, F.lit(n / (len(sizes) * size))).otherwise(weight)
            df, forest = df.withColumn("_weight", weight), forest.setWeightCol("_weight")
        return forest.fit(df)

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.model, name)


def train_forest(df: DataFrame, label: str, trees: int = 500, depth: int = 12, seed: int = 42, balanced: bool = True) -> Forest:
    """A forest on the column features. balanced: classes weigh the same."""
    return Forest(df, label, trees, depth, seed, balanced)


def probabilities(model: RandomForestClassificationModel | Forest, df: DataFrame, out: str = "probabilities") -> DataFrame:
    kept = [c for c in df.columns if c != "features"]
    return model.transform(df).select(*kept, vector_to_array("probability").alias(out))


def classify_population(model: RandomForestClassificationModel, classes: list[str], samples: DataFrame, n_pcs: int = 5, min_probability: float = 0.5) -> DataFrame:
    """samples (pc array) with pop_probs (map), most_similar (the first of the largest) and low_confidence."""
    shaped = features(samples.withColumn("_pc", F.slice("pc", 1, n_pcs)), ["_pc"]).drop("_pc")
    out = probabilities(model, shaped, "_p")
    names = F.array(*(F.lit(c) for c in classes))
    best = F.array_max("_p")
    return out.withColumn("pop_probs", F.map_from_arrays(names, F.col("_p"))).withColumn("most_similar", F.element_at(names, F.array_position("_p", best).cast("int"))).withColumn("low_confidence", best < min_probability).drop("_p")


def cross_validated(df: DataFrame, unit: str, label: str, folds: int = 5, trees: int = 500, depth: int = 12, seed: int = 42, others: DataFrame | None = None, first_nonzero: bool = True) -> DataFrame:
    """(unit, label, fold, p): out-of-fold probabilities of class 1, folds stratified by hash order.

    others: rows outside the cohort are scored by every fold's model; first_nonzero takes the
    first model's probability that isn't 0, otherwise their mean is taken. All folds' trees grow together (forests), by MLlib's law (Poisson draws,
    32 bins, the square root of the features at each node) from other random numbers than MLlib's.
    """
    from skein.operators.resample import stratified_folds

    dealt = written(stratified_folds(df, label, unit, folds, seed), "folds")
    asked = [train_forest(dealt.where(F.col("fold") != fold), label, trees, depth, seed) for fold in range(folds)]
    how = asked[0]
    vector = vector_to_array("features").alias("x")
    units = dealt.select(unit, vector)
    every = dealt.select(unit, F.col(label).cast("int").alias("y"), "fold")
    if others is not None:
        units = units.unionByName(others.select(unit, vector))
        every = every.unionByName(others.select(unit, F.lit(None).cast("int").alias("y"), F.lit(None).cast(dealt.schema["fold"].dataType).alias("fold")))
    binned, n = forests.binned(units, unit, "x")
    rows = every.withColumn("_model", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).withColumn("learns", F.coalesce(F.col("fold") != F.col("_model"), F.lit(False)))
    found = written(forests.predictions(rows.select("_model", unit, "y", "learns"), binned, ["_model"], unit, n, how.trees, how.depth, how.seed, how.balanced, distinct=True), "fold-shares")
    own = dealt.select(unit, F.col(label).cast("int").alias("label"), "fold")
    out = own.join(found.withColumnRenamed("_model", "fold"), ["fold", unit], "left").select(unit, "label", "fold", "p")
    if others is not None:
        known = F.when(F.col("p") != 0, F.col("p"))
        p = F.coalesce(F.min_by(known, F.when(F.col("p") != 0, F.col("_model"))), F.lit(0.0)) if first_nonzero else F.avg("p")
        outside = found.join(others.select(unit), unit, "left_semi").groupBy(unit).agg(p.alias("p"))
        out = out.unionByName(outside.select(unit, F.lit(None).cast("int").alias("label"), F.lit(None).cast("int").alias("fold"), "p"))
    return out


def importances(model: RandomForestClassificationModel, names: list[str], k: int) -> list[tuple[str, float]]:
    """The k most important features."""
    values = model.featureImportances.toArray()
    order = np.argsort(-values, kind="stable")[:k]
    return [(names[i], float(values[i])) for i in order]
