"""Benchmark decontamination over a distributed positional inverted index.

The corpus is cut into segments of documents. Each segment is one row: its terms, and for
each term the ascending list of its positions in the segment (documents follow each other
with a gap between them, so that no phrase crosses a border). The row is written to the
shared folder and searched from there. A phrase is looked up by intersecting the lists of
its terms, each shifted by the term's place in the phrase, from the rarest term on; all
phrases of a block are intersected at once. A proximity match lets up to ``slack`` other words
stand between them: the shifted lists then meet within an interval, and what is left is followed
from the rarest term outwards. A segment holds whole documents only, so hits of a document are
complete where its segment is searched, and nothing is shuffled.

Phrases come from a stated query set, a table. Its windows are made and grouped by the executors and
stored; the driver sees one block of about ``block_windows`` of them at a time, to broadcast it. With several
blocks the stored index is read once for each, and the word intervals are joined per document.

Words: A-Z lower-cased, runs of digits, a-z and all that is not ASCII.

Defined results: null and empty texts have no words and no hits; null or repeated ids keep
their rows; an item without words is never found; an item of fewer words than a window is one
window; an item is named once however often the table has its id; an item of a null id is searched,
but not in the list of items; empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import only, release, scratch, table, written

WINDOW = 10
#: Words of a segment; a longer document is a segment of its own.
SEGMENT_WORDS = 1_000_000
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
INDEX = "segment long, rows long, ids binary, starts binary, counts binary, terms array<binary>, offsets binary, positions binary"


def split_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_LOWER).split() if text else []


def _segment(number: int, ids: list, counts: list[int], codes: list[np.ndarray], terms: dict[bytes, int]) -> dict:
    """The index row of so many documents. A gap of one position follows each document."""
    counts_ = np.array(counts, np.int64)
    starts = np.concatenate(([0], np.cumsum(counts_ + 1)))[:-1]
    flat = np.concatenate([np.zeros(0, np.int32), *codes])
    where = np.repeat(np.arange(len(counts_), dtype=np.int64), counts_) + np.arange(len(flat))  # a gap for each document before
    order = np.argsort(flat, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=len(terms)))))
    return {"segment": number, "rows": len(ids), "ids": np.array([0 if i is None else i for i in ids], np.int64).tobytes() + np.array([i is None for i in ids], np.int8).tobytes(),
            "starts": starts.astype(np.int64).tobytes(), "counts": counts_.tobytes(), "terms": list(terms), "offsets": offsets.astype(np.int64).tobytes(), "positions": where[order].astype(np.int32).tobytes()}


def _index(batches: Iterator[pa.RecordBatch], segment_words: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("segment", pa.int64()), ("rows", pa.int64()), *((n, pa.binary()) for n in ("ids", "starts", "counts")), ("terms", pa.list_(pa.binary())), ("offsets", pa.binary()), ("positions", pa.binary())])

    def fresh() -> tuple:
        return [], [], [], defaultdict(count().__next__), 0

    only()
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    ids, counts, codes, terms, total = fresh()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = split_words(text.as_py())
            if ids and total + len(found) > segment_words:
                yield pa.RecordBatch.from_pylist([_segment(number, ids, counts, codes, terms)], schema)
                number += 1
                ids, counts, codes, terms, total = fresh()
            ids.append(key)
            counts.append(len(found))
            codes.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
            total += len(found)
    if ids:
        yield pa.RecordBatch.from_pylist([_segment(number, ids, counts, codes, terms)], schema)
    ids = counts = codes = terms = None
    release()


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """One row for each segment of docs (key: an integer column)."""
    return docs.select(F.col(key).cast("long"), text).mapInArrow(lambda b: _index(b, segment_words), INDEX)


class Segment:
    """An index row, read in place."""

    def __init__(self, row: dict) -> None:
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.rows, self.starts, self.counts = row["rows"], read("starts", np.int64), read("counts", np.int64)
        self.ids, self.null = np.frombuffer(row["ids"], np.int64, self.rows), np.frombuffer(row["ids"], np.int8, self.rows, 8 * self.rows)
        self.offsets, self.positions = read("offsets", np.int64), read("positions", np.int32)
        self.code = {t: k for k, t in enumerate(row["terms"])}
        self.size = int(self.starts[-1] + self.counts[-1] + 1) if self.rows else 0
        # The lists one after another, each entry as term * size + position: ascending throughout.
        self.keys = np.repeat(np.arange(len(self.offsets) - 1, dtype=np.int64) * self.size, np.diff(self.offsets)) + self.positions

    def within(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each term stands at a place from low to high."""
        if not len(self.keys):
            return np.zeros(len(codes), bool)
        base = codes * self.size
        at = np.searchsorted(self.keys, base + np.maximum(low, 0))
        return (high >= 0) & (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= base + np.minimum(high, self.size - 1))

    def phrases(self, phrases: list[tuple[bytes, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of all exact occurrences."""
        phrase, place, _ = self._matches(phrases, 0)
        return phrase, place

    def near(self, phrases: list[tuple[bytes, ...]], slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first, last): for each place of a phrase's rarest term the closest others around it in their order, where at most slack other words stand between them in all."""
        return self._matches(phrases, slack)

    def _matches(self, phrases: list[tuple[bytes, ...]], slack: int) -> tuple[np.ndarray, ...]:
        lengths = sorted({len(p) for p in phrases} - {0})
        found = [self._of_length(n, [k for k, p in enumerate(phrases) if len(p) == n], phrases, slack) for n in lengths]
        return tuple(np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in range(3))

    def _of_length(self, n: int, which: list[int], phrases: list[tuple[bytes, ...]], slack: int) -> tuple[np.ndarray, ...]:
        get = self.code.get
        codes = np.array([[get(t, -1) for t in phrases[k]] for k in which], np.int64).reshape(-1, n)
        known = (codes >= 0).all(axis=1)
        which, codes = np.array(which, np.int64)[known], codes[known]
        sizes = np.diff(self.offsets)
        order = np.argsort(sizes[codes] if len(codes) else codes, axis=1, kind="stable")  # rarest term first
        rarest = np.take_along_axis(codes, order[:, :1], 1)[:, 0]
        n_first = sizes[rarest] if len(rarest) else rarest
        out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
        # So many candidates at a time that memory stays bounded.
        parts = np.searchsorted(np.cumsum(n_first), np.arange(0, int(n_first.sum()) + 1, 2_000_000)) if len(n_first) else []
        edges = sorted({0, len(which), *map(int, parts)})
        for lo, hi in zip(edges, edges[1:]):
            own = n_first[lo:hi]
            phrase = np.repeat(np.arange(lo, hi), own)
            inside = np.arange(len(phrase)) - np.repeat(np.cumsum(own) - own, own)
            place = self.positions[self.offsets[rarest[phrase]] + inside].astype(np.int64)
            for step in range(1, n):
                if not len(phrase):
                    break
                term = order[phrase, step]
                shift = term - order[phrase, 0]
                keep = self.within(codes[phrase, term], place + shift - slack * (shift < 0), place + shift + slack * (shift > 0))
                phrase, place = phrase[keep], place[keep]
            first, last = (place - order[phrase, 0], place - order[phrase, 0] + n - 1) if not slack else self._around(codes[phrase], order[phrase, 0], place)
            keep = (first >= 0) & (last - first <= n - 1 + slack)
            keep &= self.document(first) == self.document(last)
            out.append((which[phrase[keep]], first[keep], last[keep]))
        return tuple(np.concatenate([o[k] for o in out]) for k in range(3))

    def _around(self, codes: np.ndarray, anchor: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each anchor's place outwards, the closest place of the term before and of the term after, and so on; first is -1 where a term is missing."""
        ends, n = [], codes.shape[1]
        for way in (-1, 1):
            at, lost = place.copy(), np.zeros(len(place), bool)
            for step in range(1, n):
                j = anchor + way * step
                todo = np.flatnonzero((j >= 0) & (j < n) & ~lost)
                code = codes[todo, j[todo]]
                here = code * self.size + at[todo]
                k = np.searchsorted(self.keys, here, "left") - 1 if way < 0 else np.searchsorted(self.keys, here, "right")
                key = self.keys[np.clip(k, 0, len(self.keys) - 1)]
                lost[todo] = (k < 0) | (k >= len(self.keys)) | (key // self.size != code)
                at[todo] = key - code * self.size
            ends.append(np.where(lost, -1 if way < 0 else 4 * self.size, at))
        return ends[0], ends[1]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1


def windows_of(items: list[tuple[int, str | None]], size: int = WINDOW) -> dict[tuple[bytes, ...], list[int]]:
    """Windows of so many words to the items that have them; those of null ids are searched and not named. An item of fewer words, but not none, is one window."""
    found: dict[tuple[bytes, ...], set[int]] = {}
    for item, text in items:
        w = split_words(text)
        for window in {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else ():
            found.setdefault(window, set()).update([] if item is None else [item])
    return {window: sorted(named) for window, named in found.items()}


def _item_windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            windows = [b" ".join(w) for w in windows_of([(0, text.as_py())], size)]
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array([item] * len(windows), pa.int64())], ["window", "item"])


def stored_windows(items: DataFrame, size: int = WINDOW, block_windows: int = 100_000, most_items: int = 4096) -> tuple[DataFrame, int]:
    """(block, window, items) of a query set (item_id, text), in the shared folder, and how many blocks there are.

    A window that more than most_items items have is a row for each part of them.
    """
    pairs = items.select(F.col("item_id").cast("long"), F.col("text")).mapInArrow(lambda b: _item_windows(b, size), "window binary, item long")
    counted = pairs.groupBy("window").agg(F.ceil(F.count("*") / most_items).alias("parts")).repartition(F.xxhash64("window", "parts"))
    grouped = pairs.join(counted, "window").groupBy("window", F.pmod(F.xxhash64("item"), F.col("parts")).alias("part")).agg(F.array_sort(F.collect_set("item")).alias("items"))
    stored = written(grouped, "item-windows")
    weight = stored.agg(F.coalesce(F.sum(1 + F.size("items") / 16), F.lit(0)).alias("w")).first().w
    blocks = max(1, int(-(-weight // block_windows)))
    return stored.select(F.pmod(F.xxhash64("window", "part"), F.lit(blocks)).cast("int").alias("block"), "window", "items"), blocks


HITS = "doc_id long, n_words long, spans array<array<long>>, items array<long>, near_items array<long>, segment long, _row long"


def _search(batches: Iterator[pa.RecordBatch], block: list[tuple[bytes, list[int]]], slack: int, all_rows: bool) -> Iterator[pa.RecordBatch]:
    """Rows of HITS: all documents, or those with a hit."""
    only()
    windows = [(tuple(w.split(b" ")), items) for w, items in block]
    phrases, lengths = [w for w, _ in windows], np.array([len(w) for w, _ in windows], np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            seg = Segment(row)
            phrase, place = seg.phrases(phrases)
            order = np.argsort(place, kind="stable")
            phrase, place = phrase[order], place[order]
            doc, end = seg.document(place), place + lengths[phrase] if len(phrase) else place
            spans: dict[int, list[list[int]]] = defaultdict(list)
            items: dict[int, set[int]] = defaultdict(set)
            near: dict[int, set[int]] = defaultdict(set)
            for d, p, a, b in zip(doc.tolist(), phrase.tolist(), (place - seg.starts[doc]).tolist(), (end - seg.starts[doc]).tolist()):
                items[d].update(windows[p][1])
                last = spans[d]
                if last and a <= last[-1][1]:
                    last[-1][1] = max(b, last[-1][1])
                else:
                    last.append([a, b])
            if slack:
                phrase, first, _ = seg.near(phrases, slack)
                for d, p in zip(seg.document(first).tolist(), phrase.tolist()):
                    near[d].update(windows[p][1])
            rows = list(range(seg.rows)) if all_rows else sorted({*spans, *near})
            ids = pa.array(seg.ids, pa.int64(), mask=seg.null.astype(bool)).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(seg.counts[rows], pa.int64()), pa.array([spans.get(k, []) for k in rows], pa.list_(pa.list_(pa.int64()))),
                *(pa.array([sorted(x.get(k, ())) for k in rows], pa.list_(pa.int64())) for x in (items, near)), pa.array([row["segment"]] * len(rows), pa.int64()), pa.array(rows, pa.int64())],
                ["doc_id", "n_words", "spans", "items", "near_items", "segment", "_row"])
            seg = row = spans = items = near = None
        batch = None
    release()


def search(index: DataFrame, items: DataFrame, size: int = WINDOW, block_windows: int = 100_000, slack: int = 0) -> DataFrame:
    """doc_id, n_words, spans (first word, word after the last; disjoint, ascending), items, and near_items (with up to slack other words between a window's words; none if slack is 0) of each document.

    index has to be stored: its segments are numbered for good. items (item_id, text) is a
    stated query set; it is broadcast in blocks of about block_windows windows.
    """
    spark = index.sparkSession
    windows, blocks = stored_windows(items, size, block_windows)

    def one(number: int) -> DataFrame:
        block = [(bytes(r.window), list(r["items"])) for r in windows.where(F.col("block") == number).collect()]
        shipped = spark.sparkContext.broadcast(sorted(block))
        return index.mapInArrow(lambda b: _search(b, shipped.value, slack, number == 0), HITS)

    if blocks == 1:
        return one(0).drop("segment", "_row")
    paths = []
    for number in range(blocks):
        paths.append(scratch(spark, "hits"))
        one(number).write.parquet(paths[-1])
    # A document is told from others of the same id by its segment and its place there.
    lists = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    merged = spark.read.schema(HITS).parquet(*paths).groupBy("segment", "_row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), lists("items"), lists("near_items"))
    return merged.drop("segment", "_row").mapInArrow(_merged, "doc_id long, n_words long, spans array<array<long>>, items array<long>, near_items array<long>")


def joined(spans: np.ndarray) -> np.ndarray:
    """Spans (begin, end) in any order as disjoint ascending ones; those that touch become one."""
    if len(spans) < 2:
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    ends = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.r_[True, spans[1:, 0] > ends[:-1]])
    return np.stack([spans[first, 0], np.r_[ends[first[1:] - 1], ends[-1]]], 1)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the spans of all blocks joined."""
    for batch in batches:
        found = [joined(np.zeros((0, 2), np.int64) if (x := cell.values) is None else x.flatten().to_numpy().reshape(-1, 2)) for cell in batch.column(2)]
        flat = np.concatenate([np.zeros((0, 2), np.int64), *found])
        pairs = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * 2), pa.array(flat.ravel()))
        spans = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pairs)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans, batch.column(3), batch.column(4)], ["doc_id", "n_words", "spans", "items", "near_items"])


def _near(batches: Iterator[pa.RecordBatch], items: list[tuple[int, tuple[bytes, ...]]], slack: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            seg = Segment(row)
            phrase, first, last = seg.near([p for _, p in items], slack)
            doc = seg.document(first)
            ids = pa.array(seg.ids, pa.int64(), mask=seg.null.astype(bool)).take(pa.array(doc, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([items[k][0] for k in phrase.tolist()], pa.int64()), *(pa.array(x - seg.starts[doc], pa.int64()) for x in (first, last))], ["doc_id", "item_id", "first", "last"])


def proximity(index: DataFrame, items: list[tuple[int, str | None]], slack: int = 3) -> DataFrame:
    """doc_id, item_id, first, last: where an item's words stand in order, with at most slack others between them in all, around each place of its rarest word. items: a list that the caller holds."""
    phrases = [(i, tuple(w)) for i, t in items if (w := split_words(t))]
    shipped = index.sparkSession.sparkContext.broadcast(phrases)
    return index.mapInArrow(lambda b: _near(b, shipped.value, slack), "doc_id long, item_id long, first long, last long")


def stored_index(docs: DataFrame, key: str = "doc_id", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of docs, written to the shared folder."""
    spark = docs.sparkSession
    path = scratch(spark, "positional-index")
    build_index(docs, key, segment_words=segment_words).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, key: str = "doc_id", slack: int = 0) -> DataFrame:
    """doc_id (the key), n_words, spans, items and near_items of each row of docs."""
    return search(stored_index(docs, key), benchmark, size, slack=slack)


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))
    names = F.array_sort(F.transform(F.array_distinct("items"), lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near"))


def query(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and n_near: items of which a window stands there with up to two other words in it."""
    return digest(hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slack=2))


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], size: int = WINDOW) -> dict[int, tuple]:
    """What query returns, by plain search; for tests."""
    found, out = windows_of(items, size), {}
    for doc, text in docs:
        w, hit, names = split_words(text), set(), set()
        for n in {len(x) for x in found}:
            for k in range(len(w) - n + 1):
                if (own := found.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    names.update(own)
        joined = ",".join(sorted(map(str, names)))
        out[doc] = (len(w), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))
    return out
