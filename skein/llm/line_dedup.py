"""Repeated lines: of a long line that many documents share, one document keeps its own.

The lines of each text are exploded with their positions; a line's key, its text without white space at both ends and
with A-Z lower-cased, is hashed where it is long enough. Documents are counted once for each hash, and what is held by
enough of them is joined back to the positions. Texts are then put together again without those, by position.

Only hashes and positions are shuffled until then, and stored once, so that no text is cut or hashed twice. Counting is two partial
aggregations, first by hash and document, then by hash: a line that a third of all documents hold is a row a task. The join back to
the positions is one of stored tables, whose large partitions adaptive execution splits. What a text loses is a list no longer than its
own lines. Everything is built-in functions: no Python in tasks.

Hashes are the first 128 bits of SHA-256, of keys as of texts, so nobody can plant two lines that meet.

Defined results: a document is an id; rows that repeat an id are one document, and so are rows of a null id, which is smaller than any other. The
document of the largest id that holds a line keeps all its lines of that key, other documents lose all of theirs. Null and empty texts
are one empty line; lines of white space are lines; texts may have any length and number of lines; repeated rows each get a row; an
empty table gives no rows; all columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import let, table, written

MIN_CHARS, MIN_DOCS = 40, 5
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(value: Column) -> Column:
    """The first 128 bits of SHA-256."""
    return F.unhex(F.substring(F.sha2(value.cast("binary"), 256), 1, 32))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANK))
    # lower() on ASCII alone is the same and many times faster.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def long_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, text digest, line (position from 0) and hash of the lines whose keys have min_chars code points or more."""
    rows = docs.select(F.col(key).alias("doc"), digest(F.coalesce(F.col(text), F.lit(""))).alias("text"), F.posexplode(lines_of(F.col(text))).alias("line", "_line"))
    # A key is no longer than its line: short lines go before anything is trimmed.
    rows = rows.where(F.char_length("_line") >= min_chars).where(F.char_length(F.btrim("_line", F.lit(BLANK))) >= min_chars)
    return rows.select("doc", "text", "line", digest(key_of(F.col("_line"))).alias("hash"))


def repeated(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """hash and keeper: the hashes that min_docs documents or more hold, and the largest id of these."""
    held = lines.groupBy("hash", "doc").agg(F.lit(1).alias("_one"))
    return held.groupBy("hash").agg(F.count("_one").alias("_docs"), F.max("doc").alias("keeper")).where(F.col("_docs") >= min_docs).drop("_docs")


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """document (all columns of docs), n_lines, n_dropped and kept (the text that stays)."""
    lines = written(long_lines(docs, text, key, min_chars), "long-lines")
    often = written(repeated(lines, min_docs), "repeated-lines")
    lost = lines.join(often, "hash").where(~F.col("doc").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy("doc", "text").agg(F.collect_set("line").alias("_lost"))
    packed = docs.select(F.struct(*docs.columns).alias("document"), F.col(key).alias("_doc"), F.col(text).alias("_value"), digest(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    joined = packed.join(lost, packed["_doc"].eqNullSafe(lost["doc"]) & (packed["_text"] == lost["text"]), "left")
    joined = joined.select("document", "_value", F.coalesce("_lost", F.array().cast("array<int>")).alias("_lost"))
    n = F.size(lines_of(F.col("_value")))
    # array_except is a hash set on whole numbers: linear, however many lines go.
    left = lambda all_lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_lost")), lambda k: F.get(all_lines, k)), "\n")
    kept = F.when(F.size("_lost") == 0, F.coalesce("_value", F.lit(""))).otherwise(let(lines_of(F.col("_value")), left))
    return joined.select("document", n.cast("long").alias("n_lines"), F.size("_lost").cast("long").alias("n_dropped"), kept.alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("document.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT k.*, o.key IS NOT NULL AND doc_id <> keeper AS dropped FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256 FROM d GROUP BY 1"""
