"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from good and one from bad labelled text. A text
is compressed with both, in blocks so that long texts are not judged by what they
themselves repeat; the difference of the sizes and the size under the good dictionary, each a
share of the text, go through a logistic calibration fitted on labelled rows that the
dictionaries have not seen.

Fitting reads at most ``max_labelled`` texts of each class (those of the smallest hash, of at
most ``max_text_bytes``, one for each id and ``max_class_bytes`` together), on the driver, whatever the size of the corpus; the
sample is weighted back to the classes' true shares. Scoring is one pass without a shuffle; two dictionaries of
``dictionary_bytes`` and three numbers are broadcast.

Defined results: null and empty texts get the score of a text without evidence (the share of
good labels); null ids and repeated rows are carried; an empty table gives no rows; without
labels of both classes every score is the share of good ones (0.5 without any).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import only, release, table, written

BLOCK = 2048
LEVEL = 3
#: Bytes of a frame that hold no content.
FRAME = 9


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    prior: float
    level: int = LEVEL

    def scorer(self) -> Scorer:
        return Scorer(self)


def _blocks(text: str) -> list[bytes]:
    data = text.encode()
    return [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.tools = model, []
        for data in (model.good, model.bad):
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=model.level)
            self.tools.append(zstandard.ZstdCompressor(level=model.level, dict_data=d, write_content_size=False, write_dict_id=False))

    def features(self, text: str) -> tuple[float, float]:
        """(bad size - good size, good size), as shares of the text."""
        blocks = _blocks(text)
        n = sum(map(len, blocks))
        good, bad = (sum(len(t.compress(b)) - FRAME for b in blocks) for t in self.tools)
        return (bad - good) / n, good / n

    def score(self, text: str | None) -> float:
        m = self.model
        if not text or not m.good:
            return m.prior
        a, b = self.features(text)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, m.weights[0] + m.weights[1] * a + m.weights[2] * b))))


def _dictionary(texts: list[str], size: int) -> bytes:
    blocks = [b for t in texts for b in _blocks(t)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return zstandard.ZstdCompressionDict(b"".join(blocks)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT).as_bytes()


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    beta = np.zeros(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        gradient = z.T @ (w * (p - y)) + ridge * beta
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + ridge * np.eye(3), gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] - (beta[1:] * mean / scale).sum()), *map(float, beta[1:] / scale)


def fit(rows: list[tuple[int, str, int]], shares: dict[int, float], dictionary_bytes: int = 112_640) -> Model:
    """rows: (label 0 or 1, text, fold): fold 0 trains the dictionaries, fold 1 calibrates. shares: of all labels."""
    prior = shares.get(1, 0.0) / (sum(shares.values()) or 1) if shares else 0.5
    parts = {(label, fold): [t for a, t, f in rows if a == label and f == fold and t] for label in (0, 1) for fold in (0, 1)}
    if not all(parts.values()):
        return Model(b"", b"", (0.0, 0.0, 0.0), prior)
    room = max(1, min(sum(len(t) for t in parts[label, 0]) for label in (0, 1)))
    chosen = {}
    for label in (0, 1):  # as much text of the one as of the other
        held, chosen[label] = 0, []
        for t in parts[label, 0]:
            if held < max(room, 4 * dictionary_bytes):
                chosen[label].append(t)
                held += len(t)
    draft = Model(_dictionary(chosen[1], dictionary_bytes), _dictionary(chosen[0], dictionary_bytes), (0.0, 0.0, 0.0), prior)
    scorer = draft.scorer()
    x = np.array([scorer.features(t) for label in (0, 1) for t in parts[label, 1]])
    y = np.repeat([0.0, 1.0], [len(parts[0, 1]), len(parts[1, 1])])
    w = np.repeat([shares[k] / len(parts[k, 1]) for k in (0, 1)], [len(parts[k, 1]) for k in (0, 1)]) * len(y) / sum(shares.values())
    return Model(draft.good, draft.bad, _logistic(x, y, w), prior)


def held_out(key: str = "doc_id"):
    """Rows that nothing is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, max_text_bytes: int = 1 << 18, dictionary_bytes: int = 112_640, max_class_bytes: int = 24 << 20) -> Model:
    """A model of the labels of docs that are not held out."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label"))
    shares = {r.label: float(r["count"]) for r in usable.groupBy("label").count().collect()}
    few = None
    for label in (0, 1):
        part = usable.where(F.col("label") == label).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
        few = part if few is None else few.unionByName(part)
    chosen = docs.join(F.broadcast(few.distinct()), docs["doc_id"] == few["_id"]).where(F.octet_length("text").between(1, max_text_bytes))
    # Rows that repeat an id give one text; what each class holds is summed over numbers alone.
    single = written(chosen.groupBy("_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"))).alias("t")).select("_id", "label", "t.text"), "labelled-texts")
    held = F.sum("bytes").over(Window.partitionBy("label").orderBy(F.xxhash64("_id"), "_id"))
    fits = single.select("_id", "label", F.octet_length("text").cast("long").alias("bytes")).withColumn("held", held).where(F.col("held") <= max_class_bytes).select("_id", "label")
    rows = single.join(F.broadcast(fits), ["_id", "label"]).select("label", "text", F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(2)).cast("int").alias("fold"), "_id").collect()
    rows.sort(key=lambda r: (r._id, r.label, r.text))
    return fit([(r.label, r.text, r.fold) for r in rows], shares, dictionary_bytes)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs plus score and predicted (columns of these names are replaced)."""
    docs = docs.drop("score", "predicted")
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        scorer = shipped.value.scorer()
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], [*batch.schema.names, "score", "predicted"])
        release()

    return docs.mapInArrow(run, schema)


def scores(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """key, score and predicted: the text stays in the worker."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        scorer = shipped.value.scorer()
        for batch in batches:
            found = [scorer.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())], [key, "score", "predicted"])
        release()

    return docs.select(key, "text").mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
