"""Token counts as rollups that signed deltas maintain.

A batch is a table of signed rows: an insert counts 1, a delete -1, and a revised count is a
delete of the old one with an insert of the new. A batch is reduced to additive sums by source,
language and tokenizer version (partial aggregation: a hot source costs one row per task).

The store is a log of versions. Each attempt writes its sums to a folder of a new name; a version
is a small file that lists the folders that count and the names of all batches they hold. It is
written aside and then renamed to the next number, which fails if that is taken, so of two writers
one begins again with what the other has published. What an attempt that died has left is in no version
and is never read; a batch that is committed again under its name changes nothing. ``compact``
folds the folders of a version into one. Totals are one scan over the folders of the last version.

Defined results: null texts have no tokens; null sources, languages or versions are groups of
their own; repeated rows each count; an empty batch commits and adds nothing; other columns are
not read; groups whose documents and tokens all came to nothing are left out of the totals.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import remove, scratch, table, written

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_chars")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"
#: Two versions of a counter: stretches without white space; the same with signs counted apart from letters and digits.
SPACE, BLANKS = "\\x20\\x09-\\x0D", " \t\n\x0b\x0c\r"


def _marks(text: Column, word: str) -> Column:
    """How many signs are left when each match of word is one letter and white space is gone: no list of matches is made."""
    return F.length(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), word, "a"), BLANKS, "")).cast("long")


def words_v1(text: Column) -> Column:
    return _marks(text, f"[^{SPACE}]+")


def words_v2(text: Column) -> Column:
    signs = "\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E"
    return _marks(text, f"[^{SPACE}{signs}]+")


def counted(docs: DataFrame, **tokenizers: Column) -> DataFrame:
    """doc_id, source, lang, n_chars and a count for each tokenizer: what signed rows are made of, without the text."""
    n_chars = F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    return docs.select("doc_id", "source", "lang", n_chars.alias("n_chars"), *(c.alias(name) for name, c in tokenizers.items()))


def rows(counts: DataFrame, tokenizer: str, n_tokens: str, sign: int = 1) -> DataFrame:
    """Counted documents as signed rows of a tokenizer version; n_tokens names its column."""
    return counts.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"), (F.col(n_tokens) * sign).alias("n_tokens"), (F.col("n_chars") * sign).alias("n_chars"))


def rolled(signed: DataFrame) -> DataFrame:
    return signed.groupBy(*KEYS).agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMS))


@dataclass(frozen=True)
class Version:
    """What counts: folders of sums, and the names of the batches in them."""

    number: int = 0
    folders: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)


class Store:
    """Committed batches under a path that all executors see."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._log = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_versions")
        self._fs = self._log.getFileSystem(self._conf)

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._log, name)

    def version(self) -> Version:
        """The last version."""
        if not self._fs.exists(self._log):
            return Version()
        numbers = [int(n) for s in self._fs.listStatus(self._log) if (n := s.getPath().getName()).isdigit()]
        if not numbers:
            return Version()
        stream = self._fs.open(self._file(f"{max(numbers):012d}"))
        try:
            return Version(**json.loads(bytes(stream.readAllBytes())))
        finally:
            stream.close()

    def _publish(self, new: Version) -> bool:
        """Makes new the last version; False if another writer has its number."""
        aside = self._file(f".{uuid.uuid4().hex}")
        out = self._fs.create(aside)
        out.write(json.dumps(vars(new)).encode())
        out.close()
        names = self._jvm.org.apache.hadoop.fs
        none = self.spark.sparkContext._gateway.new_array(getattr(names, "Options$Rename"), 0)
        target = self._file(f"{new.number:012d}")
        try:
            names.FileContext.getFileContext(aside.toUri() if aside.toUri().getScheme() else self._fs.getUri(), self._conf).rename(aside, target, none)
        except Py4JJavaError:
            if not self._fs.exists(target):
                raise
            self._fs.delete(aside, False)
            return False
        return True

    def committed(self, name: str) -> bool:
        return name in self.version().names

    def commit(self, name: str, signed: DataFrame) -> bool:
        """Adds a batch once; False if a batch of this name counts already."""
        if self.committed(name):
            return False
        folder = f"batch-{uuid.uuid4().hex}"
        rolled(signed).write.parquet(f"{self.path}/{folder}")
        while True:
            last = self.version()
            if name in last.names:
                remove(self.spark, f"{self.path}/{folder}")
                return False
            if self._publish(Version(last.number + 1, [*last.folders, folder], [*last.names, name])):
                return True

    def _sums(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return rolled(self.spark.read.schema(SCHEMA).parquet(*(f"{self.path}/{f}" for f in folders))).where("n_docs <> 0 or n_tokens <> 0 or n_chars <> 0")

    def totals(self) -> DataFrame:
        return self._sums(self.version().folders)

    def compact(self) -> bool:
        """Folds all that counts into one folder; False if another compaction came first."""
        seen, folder = self.version(), f"base-{uuid.uuid4().hex}"
        self._sums(seen.folders).write.parquet(f"{self.path}/{folder}")
        while True:
            last = self.version()
            if not {*seen.folders} <= {*last.folders}:
                remove(self.spark, f"{self.path}/{folder}")
                return False
            if self._publish(Version(last.number + 1, [folder, *(f for f in last.folders if f not in seen.folders)], last.names)):
                return True

    def vacuum(self) -> None:
        """Deletes the folders that the last version doesn't list. Nothing may be reading or writing."""
        held = {*self.version().folders, "_versions"}
        for status in self._fs.listStatus(self._log.getParent()):
            if status.getPath().getName() not in held:
                self._fs.delete(status.getPath(), True)


def query(spark, sf_dir: str) -> DataFrame:
    """Three batches over whole tables: all documents by version 1; German and Spanish ones revised to version 2; toxic ones deleted. The second comes twice."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), table(spark, sf_dir, "labels")
    second = F.coalesce(F.col("lang").isin("de", "es"), F.lit(False))
    counts = written(counted(docs, v1=words_v1(F.col("text")), v2=F.when(second, words_v2(F.col("text")))), "token-counts")
    store = Store(spark, scratch(spark, "token-rollup"))
    store.commit("1-insert", rows(counts, "words-1", "v1"))
    revised = rows(counts.where(second), "words-1", "v1", -1).unionByName(rows(counts.where(second), "words-2", "v2"))
    store.commit("2-revise", revised)
    store.compact()
    store.commit("2-revise", revised)
    gone = counts.join(labels.where("toxic = 1 and doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    store.commit("3-delete", rows(gone.where(~second), "words-1", "v1", -1).unionByName(rows(gone.where(second), "words-2", "v2", -1)))
    return store.totals()


SQL = r"""
WITH t AS (
  SELECT d.source, d.lang, CASE WHEN d.lang IN ('de', 'es') THEN 'words-2' ELSE 'words-1' END AS tokenizer, coalesce(d.text, '') AS text
  FROM documents d WHERE d.doc_id IS NULL OR d.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs,
  CAST(sum(CASE WHEN tokenizer = 'words-1' THEN len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
    ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) END) AS BIGINT) AS n_tokens,
  CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM t GROUP BY ALL
"""
