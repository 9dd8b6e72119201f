"""Byte-level BPE encoding and decoding over a transducer lexicon.

The frequent words of the corpus (counted over all of it, the ``lexicon_size`` most
frequent kept) are merged once on the driver and compiled into a minimal acyclic
transducer with their ids as outputs. Each Python worker maps it into memory; words
that it doesn't hold are merged exactly, many at a time (each round makes one merge
in every word), and with a heap where they are long. Texts are whole;
they are cut only where the tokenizer itself always cuts.

The vocabulary file is read on the driver and travels, with the lexicon, as a broadcast
of a few MB: its size is that of the vocabulary and of lexicon_size words, not of the corpus.

Defined results: a null text counts as empty and has no ids; special tokens that stand in
a text as text are encoded as special tokens, as the library does by default; repeated rows
each get a row; an empty table gives no rows; other columns are carried or left unread.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import keeps, only, release, table, written
from skein.llm.transducer import Transducer, compile_transducer

#: White space as Unicode has it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The tokenizer's own cut of a text (a fixed value).
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A coarser cut that never crosses a border of the fine one.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
RARE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Chunks that a worker remembers of each kind: fewer take less memory and more time. A parameter, as are the characters at once.
CACHE = 200_000
#: Characters whose words are encoded at once.
GROUP = 2 << 20


def byte_letters() -> dict[str, int]:
    """Letter to byte, as byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Token bytes by id, merges by pair of ids, and special tokens, of a tokenizer file (JSON, byte-level BPE)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in s) for s, i in ids.items() if s not in self.special}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.byte_id = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        #: pair of ids (as one number) to rank; rank to the id that the pair becomes
        self.rank_of: dict[int, int] = {}
        self.merged: list[int] = []
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank_of.setdefault(ids[a] << 24 | ids[b], len(self.merged))
            self.merged.append(ids[a + b])

    def merge(self, word: bytes) -> list[int]:
        """The exact ids of one piece: lowest rank first, leftmost of equals."""
        ids = list(map(self.byte_id.__getitem__, word))
        return self._merge_short(ids) if len(ids) <= 64 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank, merged, none = self.rank_of.get, self.merged, len(self.merged)
        ranks = [rank(a << 24 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            k = ranks.index(best)
            ids[k] = new = merged[best]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank(ids[k - 1] << 24 | new, none)
            if k < len(ranks):
                ranks[k] = rank(new << 24 | ids[k + 1], none)
        return ids

    def _tables(self) -> tuple[np.ndarray, ...]:
        """Byte to id; rank of two bytes; an open-addressed table of pairs and their ranks; rank to id."""
        if not hasattr(self, "_arrays"):
            none, size = len(self.merged), 1 << (4 * len(self.merged) + 1).bit_length()
            byte_id = np.array(self.byte_id, np.int64)
            pairs = np.full(size, -1, np.int64)
            ranks = np.full(size, none, np.int64)
            keys = np.array(list(self.rank_of), np.int64)
            for key, rank, at in zip(keys.tolist(), self.rank_of.values(), self._slots(keys, size).tolist()):
                while pairs[at] >= 0:
                    at = (at + 1) & (size - 1)
                pairs[at], ranks[at] = key, rank
            both = np.array([[self.rank_of.get(a << 24 | b, none) for b in self.byte_id] for a in self.byte_id], np.int64)
            self._arrays = byte_id, both, pairs, ranks, np.array(self.merged, np.int64)
        return self._arrays

    @staticmethod
    def _slots(keys: np.ndarray, size: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        _, _, pairs, ranks, _ = self._tables()
        keys = left << 24 | right
        at = self._slots(keys, len(pairs))
        lost = np.flatnonzero((pairs[at] != keys) & (pairs[at] >= 0))
        while len(lost):
            at[lost] = (at[lost] + 1) & (len(pairs) - 1)
            lost = lost[(pairs[at[lost]] != keys[lost]) & (pairs[at[lost]] >= 0)]
        return ranks[at]

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """merge of each word (none empty): in every round each word makes its lowest, leftmost merge."""
        out: list = [self.merge(w) if len(w) > 64 else None for w in words]
        which = np.array([k for k, o in enumerate(out) if o is None], np.int64)
        if not len(which):
            return out
        byte_id, both, _, _, merged = self._tables()
        none = len(merged)
        lengths = np.array([len(words[k]) for k in which.tolist()], np.int64)
        data = np.frombuffer(b"".join([words[k] for k in which.tolist()]), np.uint8)
        ids = byte_id[data]
        rank = np.full(len(data), none, np.int64)
        rank[:-1] = both[data[:-1], data[1:]]
        rank[np.cumsum(lengths) - 1] = none  # a word's last letter pairs with nothing
        while len(which):
            starts = np.cumsum(lengths) - lengths
            least = np.minimum.reduceat(rank, starts)
            going = least < none
            if 4 * going.sum() < 3 * len(going) or not going.any():
                flat, ends = ids.tolist(), starts + lengths
                for k in np.flatnonzero(~going).tolist():
                    out[which[k]] = flat[starts[k] : ends[k]]
                keep = np.repeat(going, lengths)
                ids, rank, which, lengths, least = ids[keep], rank[keep], which[going], lengths[going], least[going]
                starts = np.cumsum(lengths) - lengths
                going = np.ones(len(which), bool)
                if not len(which):
                    break
            word = np.repeat(np.arange(len(which)), lengths)
            low = np.flatnonzero((rank == least[word]) & (rank < none))
            at = low[np.concatenate(([True], word[low[1:]] != word[low[:-1]]))]  # the leftmost in each word
            owner = word[at]
            ids[at] = merged[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            after, end = at + 2, starts[owner] + lengths[owner]
            inner = after < end
            rank[at] = none
            rank[at[inner]] = self._ranks(ids[at[inner]], ids[after[inner]])
            before = at > starts[owner]
            rank[at[before] - 1] = self._ranks(ids[at[before] - 1], ids[at[before]])
            ids, rank = ids[keep], rank[keep]
            lengths = lengths - np.bincount(owner, minlength=len(lengths))
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        rank, merged, n = self.rank_of.get, self.merged, len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := rank(ids[k] << 24 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j < 0 or ids[j] != b:
                continue
            ids[k], ids[j], after[k] = merged[r], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] >= 0 and (r := rank(ids[left] << 24 | ids[after[left]])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[after[left]]))
        return [i for i in ids if i >= 0]


class _Chunks(dict):
    """Chunk to (its ids as text, the bytes they decode to)."""

    def __init__(self, encoder: Encoder, lead: str, most: int) -> None:
        super().__init__()
        self.encoder, self.lead, self.most = encoder, lead, most

    def learn(self, chunks: set[str]) -> None:
        """Encodes all chunks that aren't known, at once."""
        if len(self) > self.most:  # what the texts at hand have stays
            kept = {c: self[c] for c in chunks if c in self}
            self.clear()
            self.update(kept)
        new, lead, encoder = [c for c in chunks if c not in self], self.lead, self.encoder
        whole, cut = [c for c in new if c.isalpha()], [c for c in new if not c.isalpha()]
        own = [PIECE.findall(lead + c) for c in cut]
        # A chunk of letters is one piece, with or without a space before it.
        ids_of = encoder.many([(lead + c).encode() for c in whole] + [p.encode() for o in own for p in o])
        text_of, bytes_of = encoder.text_of.__getitem__, encoder.bytes_of.__getitem__
        texts = [",".join(map(text_of, ids)) for ids in ids_of]
        words = [b"".join(map(bytes_of, ids)) for ids in ids_of]
        self.update(zip(whole, zip(texts, words)))
        at = len(whole)
        for c, o in zip(cut, own):
            end = at + len(o)
            self[c] = (",".join(texts[at:end]), b"".join(words[at:end]))
            at = end

    def __missing__(self, chunk: str) -> tuple[str, bytes]:
        if chunk.isalpha():  # one piece, with or without a space before it
            word = (self.lead + chunk).encode()
            ids = self.encoder.lexicon.get(word) or self.encoder.vocabulary.merge(word)
        else:
            ids = self.encoder.chunk_ids(self.lead + chunk)
        self[chunk] = out = (",".join([self.encoder.text_of[i] for i in ids]), b"".join([self.encoder.bytes_of[i] for i in ids]))
        return out


class Encoder:
    """Encodes texts with a vocabulary and a compiled lexicon."""

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes, cache: int = CACHE) -> None:
        self.vocabulary, self.lexicon = vocabulary, Transducer.from_bytes(lexicon)
        self.longest = self.lexicon.longest
        self.read: dict[bytes, list[int]] = {}  # what was read from the lexicon: at most what it holds
        self.text_of = [str(i) for i in range(1 + max(vocabulary.bytes_of))]
        self.bytes_of = [vocabulary.bytes_of.get(i, b"") for i in range(len(self.text_of))]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.bare, self.spaced = _Chunks(self, "", cache), _Chunks(self, " ", cache)

    def many(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece: the lexicon's, else merged."""
        out = list(map(self.read.get, pieces))
        longest = self.longest
        unread = [k for k, ids in enumerate(out) if ids is None and len(pieces[k]) <= longest]
        held = self.lexicon.accepts([pieces[k] for k in unread]).tolist()
        for k, h in zip(unread, held):
            if h:
                out[k] = self.read[pieces[k]] = self.lexicon.get(pieces[k])
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self.vocabulary.merge_many([pieces[k] for k in rest])):
            out[k] = ids
        return out

    def chunk_ids(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for piece in PIECE.findall(chunk):
            word = piece.encode()
            ids += self.lexicon.get(word) or self.vocabulary.merge(word)
        return ids

    def forget(self) -> None:
        """Empties the caches: a worker that waits holds no words of texts it has done."""
        self.bare.clear()
        self.spaced.clear()

    @staticmethod
    def _simple(text: str) -> bool:
        """Whether a text's white space is single spaces and line ends between words."""
        odd = "  " in text or " \n" in text or "\n " in text or "\n\n" in text or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text
        return not odd and text[0] not in " \n" and text[-1] not in " \n" and (text.isascii() or not RARE_SPACE.search(text))

    def encode_all(self, texts: list[str | None]) -> Iterator[list[tuple[str, bytes]]]:
        """encode of each text: what no cache knows of all their words is encoded first, at once."""
        bare: set[str] = {"\n"}
        spaced: set[str] = set()
        cuts: list = []
        for text in texts:
            if not text or (self.special and self.special.search(text)):
                cuts.append(None)
            elif self._simple(text):
                lines = []
                for line in text.split("\n"):
                    first, *rest = line.split(" ")
                    bare.add(first)
                    spaced.update(rest)
                    lines.append((first, rest))
                cuts.append(lines)
            else:
                cuts.append(CHUNK.findall(text))
                bare.update(cuts[-1])
        self.bare.learn(bare)
        self.spaced.learn(spaced)
        of_bare, of_spaced = self.bare.__getitem__, self.spaced.__getitem__
        for text, cut in zip(texts, cuts):
            if cut is None:
                yield self.encode(text)
            elif isinstance(cut[0], str):
                yield list(map(of_bare, cut))
            else:
                out: list[tuple[str, bytes]] = []
                for first, rest in cut:
                    out.append(of_bare(first))
                    out.extend(map(of_spaced, rest))
                    out.append(of_bare("\n"))
                out.pop()
                yield out

    def _plain(self, text: str, out: list[tuple[str, bytes]]) -> None:
        if self._simple(text):
            for k, line in enumerate(text.split("\n")):
                if k:
                    out.append(self.bare["\n"])
                first, *rest = line.split(" ")
                out.append(self.bare[first])
                out.extend(map(self.spaced.__getitem__, rest))
        else:
            out.extend(map(self.bare.__getitem__, CHUNK.findall(text)))

    def encode(self, text: str | None) -> list[tuple[str, bytes]]:
        """The chunks of a text: their ids as text and the bytes they decode to."""
        out: list[tuple[str, bytes]] = []
        if text and self.special and self.special.search(text):
            for k, part in enumerate(self.special.split(text)):
                if k % 2:
                    out.append((str(self.vocabulary.special[part]), part.encode()))
                elif part:
                    self._plain(part, out)
        elif text:
            self._plain(text, out)
        return out

    def ids(self, text: str | None) -> list[int]:
        return [int(i) for ids, _ in self.encode(text) for i in ids.split(",")]

    def decode(self, ids) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, size: int, text_col: str = "text", longest: int = 14) -> list[str]:
    """The size most frequent words of up to longest bytes (cut at spaces and line ends) of all texts, of those that come twice.

    Counts go to the shared folder. The driver gets how many words have each count (its leading 12 bits, so
    some thousand numbers at most), then the words above the count at which size is reached, and of
    the words of that count as many as there is room for, those of the smallest hashes.
    """
    words = docs.select(F.explode(F.split(F.replace(text_col, F.lit("\n"), F.lit(" ")), " ")).alias("word")).where(F.octet_length("word").between(1, longest))
    counted = written(words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "word-counts")
    ranked = counted.select("word", F.length(F.bin("n")).alias("bits"), F.expr("shiftright(n, greatest(length(bin(n)) - 12, 0))").alias("lead"))
    room = size
    for r in ranked.groupBy("bits", "lead").agg(F.count("*").alias("words")).orderBy(F.desc("bits"), F.desc("lead")).collect():
        if r.words > room:
            break
        room -= r.words
    else:
        return sorted(r.word for r in counted.select("word").collect())
    above = ranked.where((F.col("bits") > r.bits) | (F.col("bits") == r.bits) & (F.col("lead") > r.lead)).select("word").collect()
    cells = 1 << 40
    enough = min(cells, int(cells * (1.2 * room + 64) / r.words))  # of so many hashes more than room words are sure to have one
    equal = ranked.where((F.col("bits") == r.bits) & (F.col("lead") == r.lead)).select("word", F.pmod(F.xxhash64("word"), F.lit(cells)).alias("h")).where(F.col("h") < enough).collect()
    return sorted([x.word for x in above] + [x.word for x in sorted(equal, key=lambda x: (x.h, x.word))[:room]])


def compile_lexicon(vocabulary: Vocabulary, words: list[str]) -> bytes:
    """Words, bare and after a space, to their ids."""
    pieces = {p.encode() for w in words for lead in ("", " ") for p in PIECE.findall(lead + w)}
    return compile_transducer((p, tuple(vocabulary.merge(p))) for p in pieces)


class _Shipped:
    """A broadcast vocabulary and lexicon; one encoder for each Python worker."""

    _of: dict[int, Encoder] = {}

    def __init__(self, spark, vocabulary: Vocabulary, lexicon: bytes, cache: int = CACHE, group: int = GROUP) -> None:
        self.data, self.group = spark.sparkContext.broadcast(pickle.dumps((vocabulary, lexicon, cache))), group
        self.key = hash((len(lexicon), hashlib.sha256(lexicon).hexdigest(), cache))

    def encoder(self) -> Encoder:
        only("bpe")
        if self.key not in self._of:
            self._of.clear()
            self._of[self.key] = Encoder(*pickle.loads(self.data.value))
        return self._of[self.key]


keeps("bpe", _Shipped._of.clear)


def _groups(column: pa.Array, size: int = GROUP) -> Iterator[list[str | None]]:
    """The texts of a column, a few MB at a time."""
    texts, held = [], 0
    for value in column:
        texts.append(value.as_py())
        held += len(texts[-1] or "")
        if held > size:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


def prepared(docs: DataFrame, path: str, lexicon_size: int = 50_000, cache: int = CACHE, group: int = GROUP) -> _Shipped:
    """What encode, decode and digests need. cache, group: what a worker remembers and encodes at once; results don't depend on them."""
    vocabulary = Vocabulary(path)
    return _Shipped(docs.sparkSession, vocabulary, compile_lexicon(vocabulary, frequent_words(docs, lexicon_size)), cache, group)


def encode(docs: DataFrame, shipped: _Shipped, key: str = "doc_id") -> DataFrame:
    """key and ids (array of int) of each text."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shipped.encoder()
        for batch in batches:
            ids = []
            for texts in _groups(batch.column(1), shipped.group):
                ids += [[int(i) for c in chunks for i in c[0].split(",")] for chunks in encoder.encode_all(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    return docs.select(key, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, shipped: _Shipped, key: str = "doc_id") -> DataFrame:
    """key and text of each row of ids."""
    schema = f"{key} {encoded.schema[key].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shipped.encoder()
        for batch in batches:
            texts = [encoder.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, shipped: _Shipped, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, and digests of the ids and of what they decode to: encoding and decoding in one pass, without the ids leaving the worker."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shipped.encoder()
        gc.disable()  # what is made here has no cycles, and looking for some takes a fifth of the time
        try:
            for batch in batches:
                n, ids_sha, text_sha = [], [], []
                for texts in _groups(batch.column(1), shipped.group):
                    for chunks in encoder.encode_all(texts):
                        ids = ",".join([c[0] for c in chunks])
                        n.append(ids.count(",") + 1 if chunks else 0)
                        ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                        text_sha.append(hashlib.sha256(b"".join([c[1] for c in chunks])).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:  # also where a consumer stops early
            gc.enable()
            encoder.forget()
            release()

    return docs.select(key, "text").mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, prepared(docs, vocabulary or default_vocabulary()))
