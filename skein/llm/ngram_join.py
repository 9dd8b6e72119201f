"""N-gram Jaccard join: near-duplicate classes of documents by exact set similarity.

Documents with equal shingle sets are one class from the start. For the others:

1. One global order of shingles. Frequent ones (found in the tasks' own counts; a hint that
   only costs or saves time) come last; of the rest a fixed class of hashes comes first,
   ordered by frequency, then all others by hash. Two sets that are similar enough share a
   shingle among the first n - ceil(t n) + 1 of each in that order.
2. A shingle of these that only one set has is dropped. The sets that share one are its group. Each
   set comes with its size and a parity bitmap of its shingles: two bitmaps differ in at most as
   many bits as the sets differ in shingles, so a pair is left out for good if its sizes or its
   bitmaps are too far apart. What is left of a group is sent as a spanning forest. In a group of
   more than GROUP sets (a hot shingle, which is salted on its way) the sets of like size are linked to the
   smallest of theirs instead. Components of these links hold every similar pair, and
   unlike texts that share a passage don't chain into one component.
3. Only sets in such a component are fetched. Each component is joined in one task by a trie of
   its sets: a walk shares the overlap with all sets that begin alike, and leaves a subtree when
   the rest of either side is too short, or when all in it are in the walker's class already.
   A component of more than BLOCK sets is dealt into blocks: each block is joined alone, then a few
   sets of each class found, so that most classes meet, and then every set outside a component's
   largest class against all of its sets, block by block. A large group of copies so costs about
   what its rows cost, no task holds more than two blocks, and no pair of classes is left out.

Only edges of a spanning forest leave a task, so a group of copies costs as many edges as it
has members. Everything is exact but for hashes of shingles (62 bits, under a key drawn for the
run) and of sets (64 bits).

Defined results: null and empty texts have no shingles and are linked with nothing; rows of a
null id get their count and a null class; rows that repeat an id each get a row; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import only, release, scratch, table, written
from skein.llm.components import components
from skein.llm.shingles import fresh_key, set_id, shingle_sets, words_of

SHINGLE = 4
PERCENT = 85
BLOCK = 2048
#: Sets of each class of a block that meet those of other blocks first.
MEETING = 32
#: Sets of a shingle's group that are compared in one task.
GROUP = 1024
#: Pairs of such a group that are compared at once.
PAIRS = 1 << 15
#: Words of 64 bits that a set's bitmap can have.
WIDTHS = (1, 2, 4, 8, 16)
#: Parts that the sets of a frequent shingle are dealt into.
SALTS = 256
#: A shingle is frequent in a task if so many of its documents, and such a share, have it.
FREQUENT, FREQUENT_SHARE, MOST_FREQUENT = 8, 0.004, 200_000
_READ = 2 << 20
#: Entries that a worker remembers to save work.
HELD = 500_000


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """The smallest intersection of sets of a and b members with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def first_class(percent: int) -> int:
    """Hashes whose top byte is below this are the class that is ordered by frequency: over one and a half times as many as a prefix has."""
    return min(256, 4 * (100 - percent))


def size_classes(percent: int, most: int = 1 << 40) -> np.ndarray:
    """Where classes of set sizes begin: sets that can be similar are in the same class or in neighbours."""
    begins = [1]
    while begins[-1] < most:
        begins.append(100 * begins[-1] // percent + 1)
    return np.array(begins, np.int64)


def bitmap(s: np.ndarray) -> bytes:
    """For each remainder of hashes whether an odd number of the set has it: about a bit for each shingle, up to 1,024."""
    width = next((w for w in WIDTHS if 64 * w >= len(s)), WIDTHS[-1])
    odd = np.bincount((s % np.uint64(64 * width)).astype(np.int64), minlength=64 * width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _read(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Batches cut so that each has a few MB of text."""
    for batch in batches:
        texts, at, held = [], 0, 0
        for k, value in enumerate(batch.column(column)):
            texts.append(value.as_py())
            held += len(texts[-1] or "")
            if held >= _READ or k == batch.num_rows - 1:
                yield batch.slice(at, k + 1 - at), texts
                texts, at, held = [], k + 1, 0


def _named(batches: Iterator[pa.RecordBatch], size: int, percent: int, key: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Rows (0, id, print, set, n, bitmap, size class) of all documents and (1, null, null, shingle, count, null, null) of the task's frequent shingles."""
    only("shingles")
    names, counts, docs = [], [], 0
    held, begins = 0, size_classes(percent)

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *names]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([np.zeros(0), *counts]), len(keys)).astype(np.int64)

    def batch_of(kind: int, ids: pa.Array, prints: pa.Array, name: list | np.ndarray, n: np.ndarray, bits: pa.Array, level: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int8)), ids, prints, pa.array(name, pa.int64()), pa.array(n, pa.int64()), bits, level], ["kind", "doc_id", "print", "name", "n", "bits", "level"])

    for batch, texts in _read(batches):
        sets = shingle_sets(texts, size, key)
        docs += len(sets)
        keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
        names.append(keys[n > 1])
        counts.append(n[n > 1])
        held += len(names[-1])
        if held > HELD:
            keys, n = merged()
            names, counts, held = [keys[n > 2]], [n[n > 2]], int((n > 2).sum())
        sizes = np.array([len(s) for s in sets], np.int64)
        yield batch_of(0, batch.column(0), batch.column(2), [set_id(s) for s in sets], sizes, pa.array([bitmap(s) for s in sets], pa.binary()), pa.array(np.searchsorted(begins, sizes, "right"), pa.int64()))
    keys, n = merged()
    hot = n >= max(FREQUENT, FREQUENT_SHARE * docs)
    some = int(hot.sum())
    yield batch_of(1, pa.nulls(some, pa.int64()), pa.nulls(some, pa.int64()), keys[hot].view(np.int64), n[hot], pa.nulls(some, pa.binary()), pa.nulls(some, pa.int64()))
    names = counts = keys = n = None
    release()


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, percent: int, key: tuple[int, int], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(shingle, salt, set, first, p) of what may be among a set's first p: all of the first class (so many as first says), and as many others as it lacks. Salt is 0 but for frequent shingles."""
    only("shingles")
    seen: set[int] = set()
    out = tokens = None
    limit = first_class(percent) << 56
    for _, texts in _read(batches):
        out: list[tuple[np.ndarray, int, int, int, int]] = []
        for s in shingle_sets(texts, size, key):
            if not len(s) or (name := set_id(s)) in seen:
                continue
            if len(seen) < HELD:
                seen.add(name)
            p = prefix_length(len(s), percent)
            at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1) if len(frequent) else None
            hot = frequent[at] == s if at is not None else np.zeros(len(s), bool)
            cold = s[~hot]
            first = int(np.searchsorted(cold, np.uint64(limit))) if limit < 1 << 64 else len(cold)
            sent = cold[: max(first, p)]
            if len(sent) < p:
                out.append((s[hot][: p - len(sent)], 1 + name % SALTS, name, first, p))
            out.append((sent, 0, name, first, p))
        n = [len(x[0]) for x in out]
        column = lambda k: pa.array(np.repeat(np.array([x[k] for x in out], np.int64), n))
        tokens = np.concatenate([np.zeros(0, np.uint64), *(x[0] for x in out)]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(tokens), *(column(k) for k in range(1, 5))], ["shingle", "salt", "name", "first", "p"])
    seen = out = tokens = None
    release()


class _Near:
    """Finds the pairs of groups whose sizes and bitmaps let them be similar, and gives a spanning forest of them."""

    def __init__(self, percent: int) -> None:
        self.percent, self.root = percent, {}

    def find(self, x: int) -> int:
        root = self.root
        if x not in root:
            return x
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = root[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.root[max(a, b)] = min(a, b)
        return True

    def may(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether rows i and j (size[i] <= size[j]) can be similar."""
        a, b, percent = self.size[i], self.size[j], self.percent
        allowed = a + b - 2 * -(-percent * (a + b) // (100 + percent))
        out = 100 * a >= percent * b
        for w, bits in self.bits.items():
            at = np.flatnonzero(out & (self.width[i] == w))
            if len(at):
                out[at] = np.bitwise_count(bits[i[at]] ^ bits[j[at]]).sum(axis=1) <= allowed[at]
        return out

    def edges(self, shingle: np.ndarray, size: np.ndarray, name: np.ndarray, maps: list[bytes]) -> list[tuple[int, int]]:
        """Of rows ordered by shingle and size, whole groups."""
        self.size, n = size, len(size)
        self.width = np.array([len(m) // 8 for m in maps], np.int64)
        folded = np.zeros((n, WIDTHS[-1]), np.uint64)
        for w in WIDTHS:
            at = np.flatnonzero(self.width == w)
            folded[at, :w] = np.frombuffer(b"".join([maps[k] for k in at.tolist()]), np.uint64).reshape(-1, w)
        self.bits = {WIDTHS[-1]: folded}
        for w in WIDTHS[-2::-1]:  # a bitmap of half the width is one half over the other
            folded = folded[:, :w] ^ folded[:, w:]
            self.bits[w] = folded
        begins = np.concatenate(([0], np.flatnonzero(shingle[1:] != shingle[:-1]) + 1, [n]))
        members = np.diff(begins)
        group = np.repeat(np.arange(len(members)), members)
        few = members[group] <= 8
        links: list[tuple[int, int]] = []
        names = name.tolist()
        for d in range(1, 8):
            i = np.flatnonzero(few[: n - d] & (group[: n - d] == group[d:])) if n > d else np.zeros(0, np.int64)
            i = i[self.may(i, i + d)]
            if len(i):
                pairs = np.unique(np.stack((name[i], name[i + d])), axis=1).tolist()
                links += [(a, b) for a, b in zip(*pairs) if self.union(a, b)]
        for g in np.flatnonzero(members > 8).tolist():
            lo, hi = int(begins[g]), int(begins[g + 1])
            roots = np.array([self.find(x) for x in names[lo:hi]], np.int64)
            at, step = np.arange(hi - lo), max(1, PAIRS // (hi - lo))
            for top in range(0, hi - lo, step):
                if (roots == roots[0]).all():  # nothing is left to link, as in most groups of classes that earlier groups have linked
                    break
                j, i = np.nonzero((roots != roots[top : top + step, None]) & (at < at[top : top + step, None]))
                j += top
                near = self.may(i + lo, j + lo)
                if near.any():
                    pairs = np.unique(np.stack((roots[i[near]], roots[j[near]])), axis=1).tolist()
                    links += [(a, b) for a, b in zip(*pairs) if self.union(a, b)]
                    roots = np.array([self.find(x) for x in roots.tolist()], np.int64)
        if len(self.root) > HELD:
            self.root.clear()  # costs repeated links, no link
        return links


def _near(batches: Iterator[pa.RecordBatch], percent: int, held_rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of rows (shingle, size, name, bits), ordered by shingle and size."""
    only("shingles")
    near, held, batch = _Near(percent), None, None

    def found(rows: pa.RecordBatch) -> pa.RecordBatch:
        links = near.edges(*(rows.column(k).to_numpy(zero_copy_only=False) for k in range(3)), rows.column(3).to_pylist())
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], ["u", "v"])

    for batch in batches:
        held = pa.concat_batches([held, batch]) if held is not None else batch
        if held.num_rows >= held_rows:
            shingle = held.column(0).to_numpy(zero_copy_only=False)
            if cut := int(np.searchsorted(shingle, shingle[-1])):  # the last group may go on
                yield found(held.slice(0, cut))
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield found(held)
    near = held = batch = None
    release()


class _Node:
    __slots__ = ("kids", "docs", "tail", "low", "deep", "root")

    def __init__(self, low: int, deep: int, root: int) -> None:
        self.kids: dict[int, _Node] = {}
        self.docs: list[int] = []  # sets that end here
        self.tail: tuple[int, list[int], int] | None = None  # one set whose path isn't laid out yet: its number, path and place
        self.low, self.deep, self.root = low, deep, root  # smallest set, longest rest; the class of all below, -1 if of several


def trie_links(sets: list[np.ndarray], percent: int = PERCENT, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs of set numbers whose edges connect what similar pairs connect (a spanning forest of the similarity graph).

    known: a class for each set; sets of one class count as connected already.
    """
    sizes = [len(s) for s in sets]
    if len(sets) < 2:
        return []
    flat = np.concatenate(sets)
    _, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    # Most frequent first, so that paths share their beginnings; what one set alone has is in no overlap.
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    shared = counts[at] > 1
    ranks, bounds = rank[at], np.concatenate(([0], np.cumsum(sizes)))
    paths = [np.sort(ranks[a:b][shared[a:b]]).tolist() for a, b in zip(bounds, bounds[1:])]
    first: dict[int, int] = {}
    parent = [first.setdefault(c, k) for k, c in enumerate(known)] if known else list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links: list[tuple[int, int]] = []
    top = _Node(0, 0, -2)

    def join(a: int, b: int, overlap: int) -> None:
        if 100 * overlap >= percent * (sizes[a] + sizes[b] - overlap) and (x := find(a)) != (y := find(b)):
            parent[max(x, y)] = min(x, y)
            links.append((a, b))

    def walk(doc: int) -> None:
        path, size, own = paths[doc], sizes[doc], set(paths[doc])
        n, least_size = len(path), -(-percent * size // 100)
        stack = [(top, 0, 0)]
        while stack:
            node, k, overlap = stack.pop()
            if node.root >= 0 and find(node.root) == find(doc):
                continue
            for other in node.docs:
                if sizes[other] >= least_size:
                    join(doc, other, overlap)
            if node.tail:
                other, rest, place = node.tail
                if sizes[other] >= least_size and find(other) != find(doc):
                    join(doc, other, overlap + len(own.intersection(rest[place:])))
                continue
            match = path[k] if k < n else -1
            todo = []
            for token, kid in node.kids.items():
                j, more = k, overlap
                if token == match:
                    j, more = k + 1, overlap + 1
                elif token > match >= 0:
                    j = bisect_left(path, token, k)
                    if j < n and path[j] == token:
                        j, more = j + 1, overlap + 1
                if more + min(n - j, kid.deep) >= least_overlap(size, max(kid.low, least_size), percent):
                    todo.append((token != match, (kid, j, more)))
            # The branch that goes on alike is walked first: a link found there lets whole subtrees go.
            stack += [x for far, x in todo if far] + [x for far, x in todo if not far]

    def touch(node: _Node, doc: int, rest: int) -> None:
        node.low, node.deep = min(node.low, sizes[doc]) if node.low else sizes[doc], max(node.deep, rest)
        if node.root == -2:
            node.root = doc
        elif node.root >= 0 and find(node.root) != find(doc):
            node.root = -1

    def lay(node: _Node, doc: int, place: int) -> None:
        path = paths[doc]
        while True:
            touch(node, doc, len(path) - place)
            if node.tail:
                other, rest, at_ = node.tail
                node.tail = None
                if at_ == len(rest):
                    node.docs.append(other)
                else:
                    kid = node.kids[rest[at_]] = _Node(sizes[other], len(rest) - at_ - 1, other)
                    kid.tail = (other, rest, at_ + 1)
            if place == len(path):
                node.docs.append(doc)
                return
            token = path[place]
            place += 1
            kid = node.kids.get(token)
            if kid is None:
                kid = node.kids[token] = _Node(sizes[doc], len(path) - place, doc)
                kid.tail = (doc, path, place)
                return
            node = kid

    for doc in sorted(range(len(sets)), key=lambda d: sizes[d]):
        walk(doc)
        lay(top, doc, 0)
    return links


def _fetch(batches: Iterator[pa.RecordBatch], size: int, key: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """(root, block, blocks, name, shingles) of candidate documents (root, block, blocks, name, text)."""
    only("shingles")
    for batch, texts in _read(batches, 4):
        sets = shingle_sets(texts, size, key)
        keep = [k for k, (s, name) in enumerate(zip(sets, batch.column(3).to_pylist())) if set_id(s) == name]
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array([sets[k].tobytes() for k in keep], pa.binary())], ["root", "block", "blocks", "name", "shingles"])
    release()


def _joined(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of rows (key, name, class, shingles), ordered by key and name; a set that comes twice counts once."""
    only("shingles")
    key, names, known, sets = None, [], [], []

    def edges() -> pa.RecordBatch:
        links = trie_links(sets, percent, known)
        return pa.RecordBatch.from_arrays([pa.array([names[x[k]] for x in links], pa.int64()) for k in range(2)], ["u", "v"])

    for batch in batches:
        for k, name, own, data in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3)):
            if k != key:
                if len(sets) > 1:
                    yield edges()
                key, names, known, sets = k, [], [], []
            if not names or names[-1] != name:
                names.append(name)
                known.append(own)
                sets.append(np.frombuffer(data.as_py(), np.uint64))
    if len(sets) > 1:
        yield edges()
    names = known = sets = batch = None
    release()


def _links(rows: DataFrame, key: list[str], own: str, percent: int) -> DataFrame:
    """Edges within each key of rows (name, shingles and a class)."""
    keyed = rows.select(F.xxhash64(*key).alias("key"), "name", F.col(own).alias("class"), "shingles")
    return keyed.repartition(F.col("key")).sortWithinPartitions("key", "name").mapInArrow(lambda b: _joined(b, percent), "u long, v long")


def _classed(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows with the class (own) that links put them in."""
    found = components(links).select(F.col("node").alias("name"), F.col("root").alias("_own"))
    return rows.join(found, "name", "left").withColumn("own", F.coalesce("_own", "name")).drop("_own")


def _large(rows: DataFrame, links: DataFrame, block: int, percent: int) -> DataFrame:
    """links and what else connects the classes of components of several blocks (rows of theirs only)."""
    most, per = rows.agg(F.max("blocks")).first()[0], max(2, block // MEETING)
    reach = 1
    while reach < most:
        # Sets of each class of a group of blocks meet those of the groups next to it.
        here = _classed(rows.withColumn("_g", F.floor(F.col("block") / reach)), links)
        several = here.groupBy("root", "_g", "own").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
        rank = F.row_number().over(Window.partitionBy("root", "_g", "own").orderBy(F.xxhash64("name", F.lit(reach)), "name"))
        meeting = here.join(several, ["root", "_g", "own"]).withColumn("_rank", rank).where(F.col("_rank") <= MEETING).withColumn("_at", F.floor(F.col("_g") / per))
        links = links.unionByName(written(_links(meeting, ["root", "_at"], "own", percent), "links"))
        reach *= per
    here = written(_classed(rows, links), "classed")
    largest = here.groupBy("root", "own").agg(F.count("*").alias("_n")).groupBy("root").agg(F.max_by("own", F.struct("_n", "own")).alias("_main"))
    marked = here.join(largest, "root").withColumn("_out", F.col("own") != F.col("_main"))
    left = marked.groupBy("root").agg(F.ceil(F.count_if("_out") / block).cast("int").alias("_parts")).where("_parts > 0")
    both = marked.join(left, "root")
    inside = both.withColumns({"_i": F.col("block"), "_s": F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))})
    outside = both.where("_out").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("_s", F.pmod(F.xxhash64("name", F.lit(1)), F.col("_parts").cast("long")).cast("int"))
    tasks = inside.select("root", "_i", "_s", "name", "own", "shingles").unionByName(outside.select("root", "_i", "_s", "name", "own", "shingles"))
    return links.unionByName(_links(tasks, ["root", "_i", "_s"], "own", percent))


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text", block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) of each row of docs."""
    spark = docs.sparkSession
    # A row is found again by its id and a print of its text: ids may repeat, with other texts.
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("print"))
    path, hashed = scratch(spark, "shingle-sets"), fresh_key()
    named_schema = "kind byte, doc_id long, print long, name long, n long, bits binary, level long"
    source.mapInArrow(lambda b: _named(b, size, percent, hashed), named_schema).write.parquet(path)
    stored = spark.read.schema(named_schema).parquet(path)
    named = stored.where("kind = 0").drop("kind")
    top = stored.where("kind = 1").groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(MOST_FREQUENT)
    frequent = np.sort(np.array([r.name for r in top.select("name").collect()], np.int64).view(np.uint64))
    shipped = spark.sparkContext.broadcast(frequent)  # MOST_FREQUENT numbers at most
    # One document of each set, by its id and print.
    facts = named.where("n > 0").groupBy("name").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "print"))).alias("least"), F.first("n").alias("size"), F.first("bits").alias("bits"), F.first("level").alias("level"))

    sent = source.select("doc_id", "text").mapInArrow(lambda b: _prefixes(b, size, percent, hashed, shipped.value), "shingle long, salt long, name long, first long, p long")
    same = Window.partitionBy("shingle", "salt")
    several = sent.select("*", F.count("*").over(same).alias("n"), F.min("name").over(same).alias("_a"), F.max("name").over(same).alias("_b")).where("salt > 0 or _a <> _b")
    # What a set sent is of the first class up to the count "first"; frequent shingles of these hashes were sent after it and always count.
    is_first = f"shiftrightunsigned(shingle, 56) < {first_class(percent)}"
    ranked = several.withColumn("ranked", F.expr(is_first) & (F.col("salt") == 0)).withColumn("_s", F.struct(F.when(F.col("salt") == 0, F.col("n")).otherwise(1 << 62).alias("n"), "shingle"))
    by_set = ranked.groupBy("name").agg(
        F.collect_set(F.when(F.col("ranked"), F.col("_s"))).alias("r"), F.collect_set(F.when(~F.col("ranked"), F.col("_s"))).alias("o"), F.max("first").alias("first"), F.max("p").alias("p"))
    room = F.col("p") - (F.col("first") - F.size("r"))
    chosen = F.concat(F.slice(F.sort_array("r"), 1, F.greatest(room, F.lit(0)).cast("int")), "o")
    listed = by_set.select("name", F.explode(chosen).alias("_s")).join(facts, "name")
    members = written(listed.select("_s.shingle", "_s.n", "name", "size", "level", "bits"), "members")
    near = members.where(F.col("n") <= group).select("shingle", "size", "name", "bits").repartition(F.col("shingle")).sortWithinPartitions("shingle", "size", "name").mapInArrow(lambda b: _near(b, percent), "u long, v long")
    alike = members.where(F.col("n") > group).select("shingle", "name", F.explode(F.array("level", F.col("level") + 1)).alias("level"))
    stars = alike.groupBy("shingle", "level").agg(F.min("name").alias("star")).repartition(F.xxhash64("shingle", "level", "star"))
    hubs = alike.join(stars, ["shingle", "level"]).where("name <> star").select(F.col("name").alias("u"), F.col("star").alias("v"))
    groups = components(near.unionByName(hubs))

    # What is counted for a root is dealt anew before it joins, so that adaptive execution can split the rows of a large root.
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).repartition(F.xxhash64("root", "blocks"))
    placed = groups.join(sizes, "root").select("root", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int").alias("block"), "blocks", F.col("node").alias("name"))
    wanted = placed.join(facts.where("least is not null").select("name", "least.doc_id", "least.print"), "name")
    fetched = source.join(wanted.hint("shuffle_hash"), ["doc_id", "print"]).select("root", "block", "blocks", "name", "text")
    rows = written(fetched.mapInArrow(lambda b: _fetch(b, size, hashed), "root long, block int, blocks int, name long, shingles binary"), "candidate-sets")
    links = written(_links(rows, ["root", "block"], "name", percent), "links")
    large = rows.where("blocks > 1")
    if large.limit(1).count():
        links = _large(large, links, block, percent)
    linked = components(links)

    roots = named.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("least")).join(linked, F.col("name") == F.col("node"), "left").select("name", "least", F.coalesce("root", "name").alias("root"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id")).repartition(F.xxhash64("root", "component_id"))
    found = roots.join(least, "root").select("name", "component_id")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).cast("long")
    return named.join(found, "name", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


def brute_force(docs: list[tuple[int, str | None]], size: int = SHINGLE, percent: int = PERCENT) -> dict[int, tuple[int, int]]:
    """What query returns, by comparing all pairs; for tests."""
    sets = {}
    for doc, text in docs:
        w = words_of(text)
        sets[doc] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    by_size = sorted((d for d in ids if sets[d]), key=lambda d: len(sets[d]))
    for k, a in enumerate(by_size):
        for b in by_size[k + 1 :]:
            if 100 * len(sets[a]) < percent * len(sets[b]):
                break
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and (x := find(a)) != (y := find(b)):
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}
