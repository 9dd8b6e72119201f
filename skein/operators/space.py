"""Principal components of a panel that no single machine holds: block Lanczos over blocks of variants.

A panel's rows are variants with one dosage for each sample. A pass multiplies a block of vectors over samples by X'X: each task standardises its
own variants and adds up their part, the parts are summed in two stages, and the sums, samples by block, go to the driver. The driver keeps
a basis of such vectors and decomposes the small projected matrix; the basis grows by a block a pass until the wanted components' residuals have vanished, and is
cut back to the best of it when it is full. So nothing the size of the panel is anywhere: what the driver and each task hold is (basis or block) x samples,
that is as many rows of the panel as the basis has vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Samples of a partial sum's row, and partial sums of a first-stage group at a time.
CHUNK, SALTS = 4096, 32
#: Cells of a panel that a task standardises at once.
CELLS = 1 << 22


def _standardised(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows with their standardised dosages, means and deviations, a bounded number at once. Missing dosages count as the mean, and rows without spread as zeros."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, CELLS // max(1, len(batch.column(at)[0])))
        for k in range(0, batch.num_rows, step):
            part = batch.slice(k, step)
            column = part.column(at)
            x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, -1)
            known = np.isfinite(x)
            n = np.maximum(known.sum(1), 1)
            mean = np.where(known, x, 0).sum(1) / n
            z = np.where(known, x - mean[:, None], 0.0)
            std = np.sqrt((z * z).sum(1) / n)
            z /= np.where(std > 0, std, 1.0)[:, None]
            z[std <= 0] = 0.0
            yield part, z, mean, std


def _summed(parts: DataFrame, by: list[str]) -> DataFrame:
    """Partial sums (chunk, salt, data) of a group, added up."""

    def add(group: pa.Table) -> pa.Table:
        total = None
        for cell in group.column("data"):
            x = np.frombuffer(cell.as_buffer())
            total = x.copy() if total is None else total + x
        return pa.table({"chunk": pa.array([group.column("chunk")[0].as_py()], pa.int32()), "salt": pa.array([0], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    return parts.groupBy(*by).applyInArrow(add, "chunk int, salt int, data binary")


def multiplied(panel: DataFrame, block: np.ndarray, dosages: str = "dosages") -> np.ndarray:
    """X'X block, for the standardised panel X and a block of vectors over its samples."""
    n, width = block.shape
    shipped = panel.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, total = shipped.value, np.zeros((n, width))
        for _, z, _, _ in _standardised(batches, 0):
            total += z.T @ (z @ w)
        chunks = [total[k : k + CHUNK].tobytes() for k in range(0, n, CHUNK)]
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array([salt] * len(chunks), pa.int32()), pa.array(chunks, pa.binary())], ["chunk", "salt", "data"])

    parts = panel.select(dosages).mapInArrow(run, "chunk int, salt int, data binary")
    out = np.zeros((n, width))
    for r in _summed(_summed(parts, ["chunk", "salt"]), ["chunk"]).collect():  # samples x block
        out[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.data).reshape(-1, width)
    shipped.unpersist()
    return out


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what a block has outside another basis; directions that are there already are left out."""
    scale = np.linalg.norm(block, axis=0)
    block = block[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-10]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def principal_components(panel: DataFrame, dims: int = 40, settled: int = 10, block: int = 32, most: int = 256, passes: int = 60, tolerance: float = 1e-9, seed: int = 42, dosages: str = "dosages") -> tuple[np.ndarray, np.ndarray]:
    """(s, v) of the standardised panel: its largest singular values, and the samples' places as rows. The first ``settled`` are exact to the tolerance.

    Columns of v have the sign that makes their entry of largest size positive.
    """
    n = panel.select(F.size(dosages)).first()
    n = n[0] if n else 0
    if n <= 0:
        return np.zeros(0), np.zeros((0, 0))
    rng = np.random.default_rng(seed)
    basis, images = np.zeros((n, 0)), np.zeros((n, 0))
    fresh = rng.normal(size=(n, min(block, n)))
    values, vectors = np.zeros(0), np.zeros((0, 0))
    for _ in range(passes):
        fresh = _new_directions(fresh, basis)
        if not fresh.shape[1]:
            break
        if basis.shape[1] + fresh.shape[1] > most:  # cut back to the best
            keep = min(len(values), max(dims + block, most // 2))
            basis, images = basis @ vectors[:, :keep], images @ vectors[:, :keep]
            fresh = _new_directions(fresh, basis)
        basis, images = np.hstack([basis, fresh]), np.hstack([images, image := multiplied(panel, fresh, dosages)])
        small = basis.T @ images
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        if values[0] <= 0:
            break
        first = vectors[:, : min(settled, len(values))]
        residual = np.linalg.norm(images @ first - (basis @ first) * values[: first.shape[1]], axis=0)
        if basis.shape[1] >= min(dims, n) and residual.max() <= tolerance * values[0]:
            break
        fresh = image
    k = min(dims, int((values > 1e-10 * max(values[0], 1e-300)).sum())) if len(values) else 0
    v = basis @ vectors[:, :k]
    if k:
        v *= np.where(v[np.abs(v).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    return np.sqrt(values[:k]), v


def directions(panel: DataFrame, s: np.ndarray, v: np.ndarray, keys: list[str], dosages: str = "dosages") -> DataFrame:
    """keys, mean, std and u (the variant's entries in the left singular vectors) of each row of a panel."""
    weights = v / s if len(s) else np.zeros((0, 0))
    shipped = panel.sparkSession.sparkContext.broadcast(weights)
    kinds = [f"{c} {panel.schema[c].dataType.simpleString()}" for c in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shipped.value
        for part, z, mean, std in _standardised(batches, len(keys)):
            u = z @ w if w.size else np.zeros((len(z), 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * u.shape[1], pa.int32()), pa.array(u.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(keys))), pa.array(mean), pa.array(std), lists], [*keys, "mean", "std", "u"])

    return panel.select(*keys, dosages).mapInArrow(run, ", ".join([*kinds, "mean double", "std double", "u array<double>"]))
