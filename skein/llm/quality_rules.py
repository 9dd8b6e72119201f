"""Quality rules: per-document word statistics and a learned decision list, in built-in functions only.

The list is learned by sequential covering: each round grows a conjunction of
threshold conditions by information gain on two thirds of the labelled rows, prunes
it on the other third, and removes the rows it covers. What comes out is an ordered
conditional expression, so that applying it is a projection: no join, no shuffle, no Python.

Learning sees the statistics (some dozen numbers) of at most ``max_labelled`` labelled
documents, the ones of the smallest hash and one row for each id, whatever the size of the corpus.

Defined results: a null or empty text has no words, fails the base rule and is not
kept; null ids are carried through; repeated rows each get their own row; an empty
table gives no rows; columns beyond the ones read are not looked at. Without labelled
rows of both classes the list is empty and only the base rule decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import let

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("n_words", "mean_word", "symbols_per_char", "exclaims_per_word", "dup_line_share", "repeat_share", "upper_share")


def words(text: Column) -> Column:
    """The words of a text: longest runs without ASCII white space."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1))


def repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of so many words that the text has twice or more.

    Equal windows are found by sorting (hash, position), so a text costs
    n log n however much of it repeats.
    """

    def covered(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"]))
        places = let(ordered, lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))), F.lit(0).cast("long"), lambda a, x: a + x))

    def count(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(window))))
        return F.when(F.size(w) < window, F.lit(0).cast("long")).otherwise(
            let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(covered(g))))

    return let(tokens, count)


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs plus the base statistics and the ones the rules may test."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = lambda inside: F.length(F.regexp_replace(text, f"[^{inside}]+", "")).cast("long")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    both = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), repeat_words(w).alias("r")))
    out = docs.withColumns({
        "_w": both, "n_symbols": count(SYMBOLS),
        "_lines": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))),
        "_exclaims": (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("long"),
        "_upper": count("A-Z"),
    })
    out = out.withColumns({
        "n_words": F.col("_w.n"), "word_chars": F.col("_w.chars"), "n_repeat_words": F.col("_w.r"),
        "n_dup_lines": F.col("_lines.n") - F.col("_lines.d"), "n_lines": F.col("_lines.n"),
    })
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    out = out.withColumns({
        "mean_word": share(F.col("word_chars"), F.col("n_words")), "symbols_per_char": share(F.col("n_symbols"), F.col("word_chars")),
        "exclaims_per_word": share(F.col("_exclaims"), F.col("n_words")), "dup_line_share": share(F.col("n_dup_lines"), F.col("n_lines")),
        "repeat_share": share(F.col("n_repeat_words"), F.col("n_words")), "upper_share": share(F.col("_upper"), F.col("word_chars")),
    })
    return out.drop("_w", "_lines", "_exclaims", "_upper")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] >= self.threshold if self.above else row[self.feature] < self.threshold

    def column(self) -> Column:
        return F.col(self.feature) >= F.lit(self.threshold) if self.above else F.col(self.feature) < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, row: dict) -> bool:
        return all(c.holds(row) for c in self.conditions)

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _cuts(rows: list[dict], feature: str, most: int) -> list[float]:
    values = sorted({r[feature] for r in rows})
    mids = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return mids if len(mids) <= most else [mids[i * len(mids) // most] for i in range(most)]


def _count(rows: list[dict], conditions) -> tuple[int, int]:
    hit = [r for r in rows if all(c.holds(r) for c in conditions)]
    bad = sum(r["bad"] for r in hit)
    return bad, len(hit) - bad


def _grow(rows: list[dict], features, most_cuts: int, most_conditions: int) -> tuple[Condition, ...]:
    chosen: tuple[Condition, ...] = ()
    while len(chosen) < most_conditions:
        bad0 = sum(r["bad"] for r in rows)
        if not bad0 or bad0 == len(rows):
            break
        before, best = math.log2(bad0 / len(rows)), (1e-9, None)
        for feature in features:
            ordered = sorted((r[feature], r["bad"]) for r in rows)
            n, below, at = len(ordered), 0, 0
            for cut in _cuts(rows, feature, most_cuts):
                while at < n and ordered[at][0] < cut:
                    below += ordered[at][1]
                    at += 1
                for above, bad, size in ((True, bad0 - below, n - at), (False, below, at)):
                    if bad and (gain := bad * (math.log2(bad / size) - before)) > best[0]:
                        best = (gain, Condition(feature, above, cut))
        if best[1] is None:
            break
        chosen += (best[1],)
        rows = [r for r in rows if best[1].holds(r)]
    return chosen


def learn(rows: list[dict], features=FEATURES, max_rules: int = 12, max_conditions: int = 4, max_cuts: int = 64, min_precision: float = 0.95) -> list[Rule]:
    """An ordered list of rules that reject. rows: dictionaries with the features, bad (0 or 1) and fold (0 to 2; 2 prunes)."""
    grow, prune, rules = [r for r in rows if r["fold"] != 2], [r for r in rows if r["fold"] == 2], []
    while len(rules) < max_rules and any(r["bad"] for r in grow):
        chosen = _grow(grow, features, max_cuts, max_conditions)
        if not chosen:
            break

        def worth(k: int) -> tuple[float, int]:
            bad, good = _count(prune, chosen[:k])
            return ((bad - good) / (bad + good) if bad + good else -1.0, -k)

        chosen = chosen[: max(range(1, len(chosen) + 1), key=worth)]
        if any(bad < 2 or bad < min_precision * (bad + good) for bad, good in (_count(grow, chosen), _count(prune, chosen))):
            break
        rules.append(Rule(chosen))
        grow, prune = ([r for r in part if not rules[-1].holds(r)] for part in (grow, prune))
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int, label: str = "quality") -> DataFrame:
    """docs that have a label, at most max_labelled of them (those of the smallest hash), with a column bad.

    The sample is drawn from the labels before the join, so the broadcast side has
    max_labelled rows of two numbers at most.
    """
    few = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), (F.col(label) == 0).cast("int").alias("bad"))
    few = few.distinct().orderBy(F.xxhash64("_id"), "_id", "bad").limit(max_labelled)
    return docs.join(F.broadcast(few), docs["doc_id"] == few["_id"]).withColumn("fold", F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(3)).cast("int")).drop("_id")


def learn_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, **how) -> list[Rule]:
    stats = with_stats(labelled_sample(docs.select("doc_id", "text"), labels, max_labelled)).select("doc_id", *FEATURES, "bad", "fold")
    # Rows that repeat an id give one, so that no more than max_labelled come to the driver.
    sample = stats.groupBy("doc_id", "bad", "fold").agg(F.min(F.struct(*FEATURES)).alias("f")).select("doc_id", "f.*", "bad", "fold")
    rows = sorted((r.asDict() for r in sample.collect()), key=lambda r: (r["doc_id"], *(r[f] for f in FEATURES)))
    return learn(rows, **how)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, from 1; 0 if none does."""
    if not rules:
        return F.lit(0)
    out = F.when(rules[0].column(), F.lit(1))
    for k, rule in enumerate(rules[1:], 2):
        out = out.when(rule.column(), F.lit(k))
    return out.otherwise(F.lit(0))


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """docs plus the statistics, base_failed, rule (0: none rejects) and kept."""
    out = with_stats(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def judged(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """Learns from the labels of docs and applies the list to all of docs."""
    return apply_rules(docs, learn_rules(docs, labels, max_labelled))


def query(spark, sf_dir: str) -> DataFrame:
    from skein.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judged(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", *STATS, "base_failed", "kept", "rule")
