"""Phrases whose words keep company, by vertical positional inverted lists.

Texts are cut into pieces at punctuation and line ends, pieces into words. Workers number the words they
read in one stream for each language and store, for each stretch of the stream (a segment), the list of
positions of each word; a place is left free where a piece ends, so words of two pieces are never
neighbours. A phrase of one word more comes from merging the list of a frequent phrase's last places
with the lists of frequent words: what stands one place further on extends it. The length of the merged
list is the phrase's exact number of occurrences in the segment; sums over segments are exact frequencies.

The lists are stored once and never shuffled. Each further length is a pass over them that sends a hash and a number for each
phrase of a segment; hashes whose sums are frequent come back as a bitmap of fixed size, which stops the lists of
other phrases early. The bitmap only spares work: it knows every frequent phrase and, by chance, some others, whose exact sums, counted by
text in the next pass, are then found too low. Where it is too full to spare anything, a pass sends a row for each distinct phrase of a
segment at most, that is one a word. No task has more than its own segments, of SEGMENT places or little more, however often a word or phrase occurs.

A phrase of two words or more is scored at each cut by floor(1,000,000 f(phrase)^2 / (f(left) f(right))),
the lowest counting (ties go to the first cut); a phrase inside a longer frequent one that has at least half of its
occurrences is dropped. Arithmetic is on decimals of whole numbers: exact for frequencies under 10^15.

Defined results: null and empty texts have no words; a null language is ``und``, together with a language
of that name; repeated rows count each time; texts of any length are read whole, in parts that end
between words; ties in score and frequency go by the phrase's bytes; an empty table gives no rows; other
columns are not read. A word has neither blanks nor tabs nor any of the marks, so joining by a blank is
reversible.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skein.llm.common import mark, only, release, scratch, sweep, table, written

MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
#: A candidate is dropped for a longer one with this share of its occurrences, in percent.
COVERED = 50
#: Places of a segment; a piece isn't cut, so one can be longer.
SEGMENT = 1 << 20
#: Bytes of a text that are parted into words at once, or up to the next border.
PART = 1 << 21
#: A-Z to a-z, and all marks that end a piece to one of them.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x2E if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_BORDER = re.compile(rb"[ \t.]")
_END = b"."
#: Spark's setting by which the shuffle files of a query go when it ends, not when the driver's memory is next cleaned; each step here is stored.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bits of the bitmap of frequent phrases; the last bits of a hash are its place in it.
FILTER = 1 << 27
#: Bits of a hash that are sent.
KEY = 1 << 40
#: A row for each segment: its words, joined by blanks, where each one's list ends, and the lists one after another, as differences (32-bit numbers).
POSTINGS = "lang string, words binary, ends binary, places binary"
#: A phrase by its hash alone, or by its language and text with a tab between.
COUNTS = "key long, name string, n long"


def words_of(text: bytes, part: int = PART) -> Iterator[list[bytes]]:
    """The words of a text in order, with a mark of its own where a piece ends; in parts."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > part:
            border = _BORDER.search(text, at + part)
            end = border.end() if border else end
        yield text[at:end].translate(_BYTES).replace(_END, b" . ").split()
        at = end


class _Stream:
    """Words of one language as numbers, in order."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {_END: 0}
        self.codes = array("i")

    def add(self, words: list[bytes]) -> None:
        numbers = self.numbers
        self.codes.extend([numbers.setdefault(w, len(numbers)) for w in words])

    def lists(self) -> tuple[bytes, bytes, bytes]:
        """words, ends and places of a segment."""
        codes = np.frombuffer(self.codes, np.int32)
        order = np.argsort(codes, kind="stable").astype(np.int32)
        ends = np.cumsum(np.bincount(codes, minlength=len(self.numbers)))
        return b" ".join(list(self.numbers)[1:]), (ends[1:] - ends[0]).astype(np.int32).tobytes(), np.diff(order[ends[0] :], prepend=np.int32(0)).tobytes()


def postings(docs: DataFrame, text: str = "text", lang: str = "lang", segment: int = SEGMENT, part: int = PART) -> DataFrame:
    """The lists of all words, a row for each segment of a language's stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        streams: dict[str, _Stream] = {}

        def stored(names: list[str]) -> Iterator[pa.RecordBatch]:
            for name in names:
                cells = streams.pop(name).lists()
                if cells[0]:
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), *(pa.array([c], pa.binary()) for c in cells)], ["lang", "words", "ends", "places"])

        held = 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                for words in words_of(value.as_py() or b"", part):
                    stream = streams.setdefault(name, _Stream())
                    held += len(words)
                    if len(stream.codes) >= segment and _END in words:
                        border = words.index(_END)
                        stream.add(words[:border])
                        yield from stored([name])
                        stream, words = streams.setdefault(name, _Stream()), words[border + 1 :]
                        held = sum(len(s.codes) for s in streams.values()) + len(words)
                    stream.add(words)
                if name in streams:
                    streams[name].codes.append(0)
                    held += 1
                if held >= segment:
                    yield from stored(list(streams))
                    held = 0
        yield from stored(list(streams))
        release()

    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.col(text).cast("string")).mapInArrow(run, POSTINGS)


def _mixed(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hashes of phrases with a word more."""
    h = (keys * np.uint64(0x9E3779B97F4A7C15)) ^ more
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _known(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether each hash is in a bitmap."""
    at = keys & np.uint64(FILTER - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


class _Lists:
    """The lists of a segment's phrases of one size: places (of the last words, ascending), the phrase that ends at each, and for each phrase
    its hash, that of what follows its first word, its number, and the phrase and word that it was made of."""

    __slots__ = ("places", "phrase", "keys", "tails", "n", "heads", "lasts")

    def __init__(self, places, phrase, keys, tails, n, heads, lasts) -> None:
        self.places, self.phrase, self.keys, self.tails, self.n, self.heads, self.lasts = places, phrase, keys, tails, n, heads, lasts

    def only(self, known: np.ndarray) -> _Lists:
        """The lists of some phrases, which are numbered anew."""
        stays, number = known[self.phrase], np.cumsum(known, dtype=np.int32) - 1
        part = lambda x: None if x is None else x[known]
        return _Lists(self.places[stays], number[self.phrase[stays]], self.keys[known], part(self.tails), self.n[known], part(self.heads), part(self.lasts))

    def extended(self, words: _Lists) -> _Lists:
        """Merged with the lists of words, one place further on."""
        if not len(words.places):
            at = np.zeros(0, np.int64)
            met = np.zeros(len(self.places), bool)
        else:
            at = np.minimum(np.searchsorted(words.places, self.places + np.int32(1)), len(words.places) - 1)
            met = words.places[at] == self.places + 1
        at = at[met] if len(at) else at
        pairs, phrase, n = np.unique(self.phrase[met].astype(np.int64) * len(words.keys) + words.phrase[at], return_inverse=True, return_counts=True)
        heads, lasts = pairs // max(1, len(words.keys)), pairs % max(1, len(words.keys))
        last = words.keys[lasts]
        return _Lists(words.places[at], phrase.astype(np.int32), _mixed(self.keys[heads], last), last if self.tails is None else _mixed(self.tails[heads], last), n, heads, lasts)


def _words(lang: str, words: list[bytes], ends: bytes, places: bytes) -> _Lists:
    n = np.diff(np.frombuffer(ends, np.int32), prepend=np.int32(0))
    place, start = np.cumsum(np.frombuffer(places, np.int32), dtype=np.int32), lang.encode() + b" "
    order = np.argsort(place, kind="stable")
    keys = np.array([xxhash.xxh3_64_intdigest(start + w) for w in words], np.uint64)
    return _Lists(place[order], np.repeat(np.arange(len(words), dtype=np.int32), n)[order], keys, None, n, None, None)


def counted(lists: DataFrame, filters: list, exact: int, hashed: int) -> DataFrame:
    """The sums over all segments that reach a phrase: (key, lang, phrase, n) of each segment's phrases.

    exact: the size of phrases to send as texts (0: none); hashed: of those to send as hashes alone (0: none). filters: for each size from one
    word on, the broadcast bitmap that its phrases have to be in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        bitmaps = [np.frombuffer(f.value, np.uint8) for f in filters]

        def sent(keys: np.ndarray | None, names: list[bytes] | None, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(n), 50_000):
                some = slice(k, k + 50_000)
                count = len(n[some])
                key = pa.nulls(count, pa.int64()) if keys is None else pa.array((keys[some] & np.uint64(KEY - 1)).astype(np.int64))
                name = pa.nulls(count, pa.string()) if names is None else pa.array(names[some], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([key, name, pa.array(n[some].astype(np.int64))], ["key", "name", "n"])

        for batch in batches:
            for lang, words, ends, places in ([c[k].as_py() for c in batch.columns] for k in range(batch.num_rows)):
                words, start = words.split(b" "), lang.encode() + b"\t"
                one = _words(lang, words, ends, places or b"")
                del places
                if exact == 1:
                    yield from sent(one.keys, [start + w for w in words], one.n)
                    continue
                known = _known(one.keys, bitmaps[0])
                words = [words[k] for k in np.flatnonzero(known).tolist()]
                one = now = one.only(known)
                texts = [start + w for w in words]
                for size in range(2, max(exact, hashed) + 1):
                    now = now.extended(one)
                    if size > 2:
                        now = now.only(_known(now.tails, bitmaps[size - 2]))
                    if size == hashed:
                        yield from sent(now.keys, None, now.n)
                        break
                    now = now.only(_known(now.keys, bitmaps[size - 1]))
                    texts = [texts[h] + b" " + words[w] for h, w in zip(now.heads.tolist(), now.lasts.tolist())]
                    if size == exact:
                        yield from sent(None, texts, now.n)
        release()

    columns = POSTINGS.replace(" string", "").replace(" binary", "").split(", ")
    if exact == 1:  # counts need no places
        lists = lists.withColumn("places", F.lit(None).cast("binary"))
    return lists.select(*columns).mapInArrow(run, COUNTS)


def bitmap_of(frequent: DataFrame) -> bytes:
    """The bitmap of the hashes (key) of a table: FILTER bits, however many there are."""
    at = F.col("key").bitwiseAND(F.lit(FILTER - 1)) + 1
    parts = frequent.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = bytearray(FILTER // 8)
    for r in parts.toLocalIterator():  # FILTER / 32,768 rows at most
        begin = (r.k - 1) * 4096
        part = r.bits[: len(out) - begin]
        out[begin : begin + len(part)] = part
    return bytes(out)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, phrase, size and a of all phrases that occur min_count times or more; lang and n, the number of all words."""
    spark = docs.sparkSession
    path = scratch(spark, "postings")
    postings(docs, text, lang).write.option("compression", "zstd").parquet(path)
    lists = spark.read.schema(POSTINGS).parquet(path)
    named = lambda df: df.select(F.substring_index("name", "\t", -1).alias("phrase"), F.expr("left(name, length(name) - length(substring_index(name, '\t', -1)) - 1)").alias("lang"), "a", "key")
    words = written(named(counted(lists, [], 1, 0).groupBy("name").agg(F.sum("n").alias("a"), F.first("key").alias("key"))), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    phrases = words.where(F.col("a") >= min_count)
    filters = [spark.sparkContext.broadcast(bitmap_of(phrases))]  # bounded by FILTER
    phrases = phrases.select("lang", "phrase", F.lit(1).alias("size"), "a")
    for exact in range(1, max_words + 1):
        hashed = exact + 1 if exact < max_words else 0
        sums = counted(lists, filters, exact if exact > 1 else 0, hashed).groupBy("key", "name").agg(F.sum("n").alias("a"))
        found = written(sums.where(F.col("a") >= min_count), "phrase-counts")
        if exact > 1:
            phrases = phrases.unionByName(named(found.where("name is not null")).select("lang", "phrase", F.lit(exact).alias("size"), "a"))
        if hashed:
            filters.append(spark.sparkContext.broadcast(bitmap_of(found.where("name is null"))))
    for f in filters:
        f.unpersist()
    return phrases, totals


def scored(phrases: DataFrame, covered: int = COVERED) -> DataFrame:
    """lang, phrase, a, l, r and score of the candidates among frequent phrases, without those that a longer one covers."""
    whole = lambda c: F.col(c).cast("decimal(15,0)")
    many = phrases.where("size >= 2")
    cuts = many.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - size)")})
    part = lambda side, f: phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(f))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    cuts = cuts.withColumns({"_over": F.lit(1_000_000).cast("decimal(7,0)") * (whole("a") * whole("a")), "_under": whole("l") * whole("r")})
    cuts = cuts.withColumn("score", F.expr("_over div _under"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_best")).select("lang", "phrase", "a", "_best.l", "_best.r", "_best.score")
    inside = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(_words, s, m), ' '))))")
    longer = phrases.where("size >= 3").withColumn("_words", F.split("phrase", " ")).select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("_a"))
    most = longer.groupBy("lang", "phrase").agg(F.max("_a").alias("_longer"))
    return best.join(most, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < covered * F.col("a"))).drop("_longer")


def strongest(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """candidates with rank, the first of each language. A language's rows are ranked in parts first, so what meets in its task is bounded."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parts = candidates.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top).drop("_part", "rank")
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the strongest phrases of each language."""
    spark, begun = docs.sparkSession, mark()
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        phrases, totals = frequent_phrases(docs, text, lang, min_count, max_words)
        phrases = written(phrases, "phrases")
        out = strongest(scored(phrases, covered), top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        path = scratch(spark, "collocations")
        out.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    sweep(spark, begun, path)
    return spark.read.schema(out.schema).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: The same over strings: neighbours by window functions, products in 128 bits.
SQL = r"""WITH pieces AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece,
  row_number() OVER () AS p FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS ws FROM pieces),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
q AS (SELECT * FROM f WHERE a >= 10),
c AS (SELECT lang, m, phrase, a, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS ws FROM q WHERE m >= 2),
s AS (SELECT c.lang, c.m, c.phrase, c.a, k, x.a AS l, y.a AS r, CAST((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM c JOIN q x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:k], ' ') AND x.m = k JOIN q y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1:], ' ') AND y.m = c.m - k),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM s) WHERE o = 1),
i AS (SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase FROM q WHERE m = 3),
o AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
  FROM b JOIN n USING (lang) LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * a) WHERE rank <= 2000"""
