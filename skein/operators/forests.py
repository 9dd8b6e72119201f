"""Many forests in one job: trees of all models grow level by level from shared histograms.

A model is a row's key columns (a draw, a disease, a fold, ...). Every model learns from its own labels on the same binned features. Units are packed into blocks of a
bounded size, once: a row for each model, block and chunk of trees has the units' bins, labels and times drawn as bytes. A level is one pass over these rows: each
walks its units down the splits so far, counts them by node, feature, bin and class, and a tree's counts are added where its splits are chosen. So the number of passes is
the depth, however many models there are, and what is shuffled grows with blocks and nodes, not with units times trees. Where all units fit one block, a row has all that its
trees learn from, and they grow to their end in one pass. Units that a model doesn't learn from leave with the share of the leaf they come to.

Samples are drawn by hashing (so many times by a Poisson law, as bagging of large tables does), and so are each node's features: results are the same on every engine and
after a lost executor, up to sums' last bits, which gains are rounded against.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.resample import hash_rank
from skein.session import written

BINS = 32
#: Bytes of bins and draws in a block of units, and trees in a chunk.
BLOCK_BYTES, CHUNK = 12 << 20, 20
#: Of a Poisson law of mean 1: the probability of at most so many.
POISSON = [math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) for k in range(8)]


def binned(units: DataFrame, unit: str, x: str, bins: int = BINS) -> tuple[DataFrame, int]:
    """(unit and _bins, number of features): the place of each value of x (array) among its feature's quantiles, a byte each, missing values as 0."""
    if bins > 256:
        raise ValueError(f"{bins} bins, over 256")
    values = units.select(F.posexplode(x).alias("f", "x")).select("f", F.coalesce(F.nanvl("x", F.lit(0.0)), F.lit(0.0)).alias("x"))
    cuts = values.groupBy("f").agg(F.array_sort(F.array_distinct(F.percentile_approx("x", [k / bins for k in range(1, bins)], 10_000))).alias("cuts"))
    found = {r.f: np.array(r.cuts) for r in cuts.collect()}  # bins for each feature
    kind = units.schema[unit].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            values = np.zeros((len(rows), len(found)))
            for k, row in enumerate(rows):
                values[k, : len(row or ())] = [0.0 if v is None or v != v else v for v in row or ()]
            places = np.zeros(values.shape, np.uint8)
            lengths = np.array([len(row or ()) for row in rows])
            for f in range(len(found)):
                places[:, f] = np.where(lengths > f, np.searchsorted(found[f], values[:, f]), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in places], pa.binary())], [unit, "_bins"])

    return written(units.select(unit, F.col(x).cast("array<double>").alias(x)).mapInArrow(run, f"{unit} {kind}, _bins binary"), "binned"), len(found)


def _u(seed: int, tree: Column, *names: str) -> Column:
    """A number in [0, 1) from the hash of columns and a tree."""
    first, unit = names[:-1], names[-1]
    return F.pmod(F.xxhash64(F.lit(seed), *(F.col(c).cast("string") for c in first), tree.cast("string"), F.col(unit).cast("string")), F.lit(1 << 50)) / float(1 << 50)


def _gini(p: np.ndarray, n: np.ndarray) -> np.ndarray:
    return 2 * (p / n) * (1 - p / n)


class _Grown:
    """Splits of a chunk's trees so far, by tree and node: feature (-1: none), bin and the share of class 1 (nan: not told yet)."""

    def __init__(self, trees: int) -> None:
        self.f, self.b, self.share = (np.full((trees, 2), v, t) for v, t in ((-1, np.int32), (0, np.int16), (np.nan, np.float64)))

    def put(self, tree, node, f, b, share) -> None:
        if len(node) and (wide := 1 << int(np.max(node)).bit_length()) > self.f.shape[1]:
            more = wide - self.f.shape[1]
            self.f, self.b, self.share = (np.pad(a, ((0, 0), (0, more)), constant_values=v) for a, v in ((self.f, -1), (self.b, 0), (self.share, np.nan)))
        self.f[tree, node], self.b[tree, node], self.share[tree, node] = f, b, share

    def walk(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """The node that each unit comes to."""
        node = np.ones(len(bins), np.int64)
        at = np.arange(len(bins))
        while len(at):
            known = node[at] < self.f.shape[1]
            at = at[known]
            f = self.f[tree, node[at]]
            at, f = at[f >= 0], f[f >= 0]
            node[at] = 2 * node[at] + (bins[at, f] > self.b[tree, node[at]])
        return node


def _counts(bins: np.ndarray, y: np.ndarray, times: np.ndarray, place: np.ndarray, tries: np.ndarray, width: int) -> np.ndarray:
    """Times by node's place, try, bin and class."""
    nodes, tried = tries.shape
    at = np.arange(len(bins))
    out = np.zeros((nodes, tried, width, 2), np.int64)
    for j in range(tried):
        cell = (place * width + bins[at, tries[place, j]]) * 2 + y
        out[:, j] = np.bincount(cell, times, nodes * width * 2).reshape(nodes, width, 2)
    return out


def _best(counts: np.ndarray, tries: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature or -1, bin) of each node's best split: of equal gains that of the first feature, and of its first bin."""
    if not counts.shape[1]:
        return np.full(len(counts), -1), np.zeros(len(counts), int)
    upto = (counts * scale).cumsum(2)
    all_, left = upto[:, :, -1:], upto
    n, nl = all_.sum(-1), left.sum(-1)
    p, pl = all_[..., 1], left[..., 1]
    seen = counts.sum(-1).cumsum(2)
    inner = (seen > 0) & (seen < seen[:, :, -1:])
    nr, pr = n - nl, p - pl
    with np.errstate(all="ignore"):
        gain = np.where(inner, np.round(_gini(p, n) - nl / n * _gini(pl, nl) - nr / n * _gini(pr, nr), 10), 0.0)
    top = gain.max((1, 2), keepdims=True)
    width = counts.shape[2]
    order = np.where(gain == top, tries[:, :, None].astype(np.int64) * width + np.arange(width), np.iinfo(np.int64).max).min((1, 2))
    good = top[:, 0, 0] > 0
    return np.where(good, order // width, -1), np.where(good, order % width, 0)


def _shares(counts: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Of counts by node and class, the weighted share of class 1."""
    weighed = counts * scale
    return weighed[:, 1] / weighed.sum(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P[2]
    h = (h ^ (h >> np.uint64(29))) * _P[3]
    return h ^ (h >> np.uint64(32))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


#: Constants of xxHash, whose 64 bits Spark's xxhash64 carries from column to column.
_P = dict(enumerate(map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)), 1))


def _with_int(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    return _mixed(_turned((h + _P[5] + np.uint64(4)) ^ (x * _P[1]), 23) * _P[2] + _P[3])


def _with_long(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    return _mixed(_turned((h + _P[5] + np.uint64(8)) ^ (_turned(x * _P[2], 31) * _P[1]), 27) * _P[1] + _P[4])


def _tries(model: int, tree: int, nodes: np.ndarray, tried: int, n_features: int, distinct: bool = False) -> np.ndarray:
    """The features that each node tries, numbers from its hash (xxhash64 of the model's columns, tree, node and try); one that is drawn twice is tried twice.

    distinct: the first features in the order of the hash of each, so that none is drawn twice.
    """
    of = lambda x: np.atleast_1d(np.asarray(x, np.int64)).view(np.uint64)
    h = _with_long(of(nodes), _with_int(of(tree), of(model)))
    if distinct:
        return np.argsort(_with_int(of(np.arange(n_features))[None, :], h[:, None]), axis=1, kind="stable")[:, :tried]
    h = _with_int(of(np.arange(tried))[None, :], h[:, None])
    return h.view(np.int64) % max(1, n_features)


def predictions(rows: DataFrame, features: DataFrame, keys: list[str], unit: str, n_features: int, trees: int = 200, depth: int = 8, seed: int = 42, balanced: bool = True, block: int | None = None, distinct: bool = False) -> DataFrame:
    """keys, unit and p: the mean share of class 1 in the leaves of each model's trees, for the units that it doesn't learn from.

    rows: keys, unit, y (0 or 1) and learns. features: unit and _bins, of binned. balanced: the classes of a model weigh the same. Keys are not null. A model without
    units to learn from has no predictions. block: units in a block (by default as many as BLOCK_BYTES hold).
    distinct: whether a node tries no feature twice, as MLlib does.
    """
    spark, chunk = rows.sparkSession, min(CHUNK, trees)
    tried = max(1, math.isqrt(n_features - 1) + 1) if n_features else 0
    block = block or max(256, BLOCK_BYTES // (n_features + chunk))
    n_blocks, n_chunks = max(1, -(-features.count() // block)), -(-trees // chunk)
    sizes = rows.where("learns").groupBy(*keys).agg(F.count("*").cast("double").alias("_n"), F.sum(F.col("y").cast("double")).alias("_pos"))
    # What a unit of class 0 and of class 1 weighs.
    weigh = lambda k: F.when(k > 0, F.col("_n") / (2 * k)).otherwise(0.0) if balanced else F.lit(1.0)
    sizes = sizes.select(*keys, F.xxhash64(F.lit(seed + 1), *keys).alias("_hash"), F.array(weigh(F.col("_n") - F.coalesce("_pos", F.lit(0.0))), weigh(F.coalesce("_pos", F.lit(0.0)))).alias("_scale"))
    law = lambda u: reduce(lambda chain, k: chain.when(u < POISSON[k], F.lit(k)), range(len(POISSON)), F).otherwise(len(POISSON)).cast("tinyint")
    first = F.col("_chunk") * chunk
    drawn = F.transform(F.transform(F.sequence(first, F.least(first + chunk, F.lit(trees)) - 1), lambda tree: _u(seed, tree, *keys, unit)), law)
    part = [*keys, "_chunk", "_block"]
    dealt = rows.join(features, unit).withColumn("_block", F.pmod(F.xxhash64(unit), F.lit(n_blocks)).cast("int")).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    dealt = dealt.select(*part, unit, "_bins", (F.coalesce(F.col("y").cast("double"), F.lit(0.0)) == 1).alias("_y"), F.when(F.col("learns"), drawn).alias("_times"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in [*keys, unit]}
    named = ", ".join(f"{c} {kinds[c]}" for c in keys)

    def pack(table: pa.Table) -> pa.Table:
        """A row of a block: the units that it learns from and those that it doesn't."""
        column = {c: table[c].combine_chunks() for c in table.column_names}
        known = column["_times"].is_valid()
        learns = np.asarray(known)
        bins = np.frombuffer(b"".join(column["_bins"].to_pylist()), np.uint8).reshape(table.num_rows, n_features)
        others = column[unit].filter(pa.array(~learns))
        bytes_ = (bins[learns], np.asarray(column["_y"])[learns].astype(np.uint8), np.asarray(column["_times"].filter(known).flatten()).astype(np.uint8), bins[~learns])
        values = [*(column[c][:1] for c in part), *(pa.array([x.tobytes()], pa.binary()) for x in bytes_), pa.ListArray.from_arrays(pa.array([0, len(others)], pa.int32()), others)]
        return pa.table(values, names=[*part, "_in", "_iny", "_times", "_out", "_units"])

    tasks = 8 * spark.sparkContext.defaultParallelism
    packed = dealt.repartition(tasks, *part).groupBy(*part).applyInArrow(pack, f"{named}, _chunk int, _block int, _in binary, _iny binary, _times binary, _out binary, _units array<{kinds[unit]}>")
    packed = written(packed.join(sizes, keys), "forest-blocks")
    told = f"{named}, {unit} {kinds[unit]}, _s double, _k long"

    def parts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        inside, outside = (np.frombuffer(row[c], np.uint8).reshape(-1, n_features) if n_features else np.zeros((len(row[n]), 0), np.uint8) for c, n in (("_in", "_iny"), ("_out", "_units")))
        return inside, outside, np.frombuffer(row["_iny"], np.uint8).astype(np.int64), np.frombuffer(row["_times"], np.uint8).reshape(len(inside), trees_of(row))

    def leave(row: dict, outside: np.ndarray, grown: _Grown, n: int) -> pa.RecordBatch:
        total, seen = np.zeros(len(outside)), np.zeros(len(outside), np.int64)
        for k in range(n):
            share = grown.share[k, grown.walk(k, outside)] if not np.isnan(grown.share[k, 1]) else np.full(len(outside), np.nan)
            total += np.nan_to_num(share)
            seen += ~np.isnan(share)
        kept = seen > 0
        units = row["_units"].filter(pa.array(kept))
        return pa.RecordBatch.from_arrays([*(pa.array([row[c]] * len(units), row["_types"][c]) for c in keys), units, pa.array(total[kept]), pa.array(seen[kept])], [*keys, unit, "_s", "_k"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names if c != "_units"}
                yield row | {"_units": batch.column("_units").slice(k, 1).flatten(), "_types": {c: batch.schema.field(c).type for c in keys}}

    def trees_of(row: dict) -> int:
        return min(chunk, trees - row["_chunk"] * chunk)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All levels of a chunk whose units are one block."""
        for row in read(batches):
            inside, outside, y, times = parts(row)
            scale, n = np.array(row["_scale"]), trees_of(row)
            grown = _Grown(n)
            width = int(inside.max(initial=0)) + 1
            for k in range(n):
                at = np.flatnonzero(times[:, k]) if len(inside) else np.zeros(0, int)
                bins, own, w, node = inside[at], y[at], times[at, k].astype(float), np.ones(len(at), np.int64)
                for level in range(depth + 1):
                    nodes, place = np.unique(node, return_inverse=True)
                    if not len(nodes):
                        break
                    totals = np.bincount(place * 2 + own, w, 2 * len(nodes)).reshape(-1, 2)
                    f, b = np.full(len(nodes), -1), np.zeros(len(nodes), int)
                    if level < depth and tried:
                        mixed = np.flatnonzero(totals.min(1) > 0)  # a pure node has no gain
                        to = np.full(len(nodes), -1)
                        to[mixed] = np.arange(len(mixed))
                        some = to[place] >= 0
                        tries = _tries(row["_hash"], row["_chunk"] * chunk + k, nodes[mixed], tried, n_features, distinct)
                        f[mixed], b[mixed] = _best(_counts(bins[some], own[some], w[some], to[place[some]], tries, width), tries, scale)
                    grown.put(k, nodes, f, b, _shares(totals, scale))
                    go = f[place] >= 0
                    bins, own, w, place, node = bins[go], own[go], w[go], place[go], node[go]
                    node = 2 * node + (bins[np.arange(len(bins)), f[place]] > b[place])
            yield leave(row, outside, grown, n)

    if n_blocks == 1:
        found = packed.mapInArrow(grow, told)
        return written(found, "forest-leaves").groupBy(*keys, unit).agg((F.sum("_s") / F.sum("_k")).alias("p"))

    def known(row: dict) -> _Grown:
        grown = _Grown(trees_of(row))
        if row["_grown"]:
            t, node, f, b, share = (np.array([x[c] for x in row["_grown"]]) for c in ("tree", "node", "f", "b", "share"))
            grown.put(t - row["_chunk"] * chunk, node, f, b, share)
        return grown

    def count(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in read(batches):
                inside, _, y, times = parts(row)
                grown = known(row)
                for k in range(trees_of(row)):
                    at = np.flatnonzero(times[:, k]) if len(inside) else np.zeros(0, int)
                    node = grown.walk(k, inside[at])
                    at, node = at[node >= 1 << level], node[node >= 1 << level]
                    if not len(at):
                        continue
                    nodes, place = np.unique(node, return_inverse=True)
                    tree, own, w = row["_chunk"] * chunk + k, y[at], times[at, k].astype(float)
                    totals = np.bincount(place * 2 + own, w, 2 * len(nodes)).reshape(-1, 2).astype(np.int64)
                    tries = _tries(row["_hash"], tree, nodes, tried, n_features, distinct)
                    width = int(inside.max(initial=0)) + 1
                    counts = _counts(inside[at], own, w, place, tries, width) if level < depth else np.zeros((len(nodes), 0, width, 2), np.int64)
                    cells = np.flatnonzero(counts)  # deep nodes have few
                    flat = [nodes.astype(np.int64), totals, cells.astype(np.int64), counts.ravel()[cells].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([*(pa.array([row[c]], row["_types"][c]) for c in keys), pa.array([row["_chunk"]], pa.int32()), pa.array([tree], pa.int32()), pa.array([row["_hash"]], pa.int64()), pa.array([row["_scale"]], pa.list_(pa.float64())), pa.array([width], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in flat)], [*keys, "_chunk", "_tree", "_hash", "_scale", "_width", "_nodes", "_totals", "_cells", "_counts"])

        return run

    def choose(level: int):
        def run(table: pa.Table) -> pa.Table:
            """A tree's counts of all blocks, added, and its nodes' splits."""
            found, width = table.to_pylist(), max(table["_width"].to_pylist())
            tree, scale = found[0]["_tree"], np.array(found[0]["_scale"])
            nodes = np.unique(np.concatenate([np.frombuffer(r["_nodes"], np.int64) for r in found]))
            tries = _tries(found[0]["_hash"], tree, nodes, tried, n_features, distinct)
            last = level == depth or not tried
            totals, counts = np.zeros((len(nodes), 2), np.int64), np.zeros((len(nodes), 0 if last else tried, width, 2), np.int64)
            for r in found:
                own = np.frombuffer(r["_nodes"], np.int64)
                to = np.searchsorted(nodes, own)
                totals[to] += np.frombuffer(r["_totals"], np.int64).reshape(-1, 2)
                if not last:
                    n, j, x, y = np.unravel_index(np.frombuffer(r["_cells"], np.int64), (len(own), tried, r["_width"], 2))
                    counts[to[n], j, x, y] += np.frombuffer(r["_counts"], np.int32)
            f, b = _best(counts, tries, scale)
            one = [pa.array([found[0][c]] * len(nodes), table.schema.field(c).type) for c in [*keys, "_chunk", "_tree"]]
            return pa.table([*one, pa.array(nodes), pa.array(f.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(_shares(totals, scale))], names=[*keys, "_chunk", "_tree", "_node", "_f", "_b", "_share"])

        return run

    def beside(nodes: DataFrame | None) -> DataFrame:
        """packed with the splits so far."""
        kind = "array<struct<tree:int,node:bigint,f:int,b:int,share:double>>"
        if nodes is None:
            return packed.withColumn("_grown", F.lit(None).cast(kind))
        lists = nodes.groupBy(*keys, "_chunk").agg(F.collect_list(F.struct(F.col("_tree").alias("tree"), F.col("_node").alias("node"), F.col("_f").alias("f"), F.col("_b").alias("b"), F.col("_share").alias("share"))).cast(kind).alias("_grown"))
        return packed.join(lists, [*keys, "_chunk"])

    nodes, tree = None, [*keys, "_chunk", "_tree"]
    for level in range(depth + 1 if tried else 1):
        counts = beside(nodes).mapInArrow(count(level), f"{named}, _chunk int, _tree int, _hash long, _scale array<double>, _width int, _nodes binary, _totals binary, _cells binary, _counts binary")
        new = written(counts.repartition(tasks, *tree).groupBy(*tree).applyInArrow(choose(level), f"{named}, _chunk int, _tree int, _node long, _f int, _b int, _share double"), "forest-nodes")
        nodes = new if nodes is None else nodes.unionByName(new)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in read(batches):
            yield leave(row, parts(row)[1], known(row), trees_of(row))

    return written(beside(nodes).mapInArrow(out, told), "forest-leaves").groupBy(*keys, unit).agg((F.sum("_s") / F.sum("_k")).alias("p"))


def out_of_fold(labels: DataFrame, units: DataFrame, keys: list[str], unit: str, x: str, folds: int = 5, trees: int = 200, depth: int = 8, seed: int = 42, first_nonzero: bool = True) -> DataFrame:
    """keys, unit, label, fold and p, for all cohorts (keys) at once: out-of-fold probabilities of class 1, folds stratified by hash order.

    labels: keys, unit and y (0, 1, or null for units of a cohort that are scored and not learned from: by the first fold whose probability isn't 0, else by the mean).
    """
    features, n = binned(units, unit, x)
    own = hash_rank(labels.where("y is not null"), [*keys, "y"], seed, unit, "_rank").withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank")
    dealt = written(own.unionByName(labels.where("y is null").withColumn("fold", F.lit(None).cast("int"))).select(*keys, unit, F.col("y").cast("int").alias("y"), "fold"), "folds")
    rows = dealt.withColumn("_model", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).withColumn("learns", F.coalesce(F.col("fold") != F.col("_model"), F.lit(False)))
    found = predictions(rows.select(*keys, "_model", unit, "y", "learns"), features, [*keys, "_model"], unit, n, trees, depth, seed)
    known = F.when(F.col("p") != 0, F.col("p"))
    p = F.coalesce(F.min_by(known, F.when(F.col("p") != 0, F.col("_model"))), F.lit(0.0)) if first_nonzero else F.avg("p")
    return dealt.join(found.groupBy(*keys, unit).agg(p.alias("p")), [*keys, unit], "left").select(*keys, unit, F.col("y").alias("label"), "fold", "p")
