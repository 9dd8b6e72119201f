"""Collocations and line dedup, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from skein.llm import collocations, line_dedup

DOC = "doc_id long, text string, lang string, n_lines string, n string, `_text` string, rank int, document string"
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    """(doc_id, text, lang) with columns of clashing names."""
    return spark.createDataFrame([(*r, "clash", "clash", "clash", 7, "clash") for r in rows], DOC)


def plain_collocations(rows, min_count=10, max_words=3, top=2000, covered=50):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, max_words + 1):
                counts[lang or "und"].update(tuple(words[k : k + m]) for k in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < min_count:
                continue
            cuts = [(1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            inside = lambda p, q: any(q[s : s + len(p)] == p for s in range(len(q) - len(p) + 1))
            if any(n >= min_count and len(q) > len(phrase) and 100 * n >= covered * a and inside(phrase, q) for q, n in f.items()):
                continue
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        out |= {(lang, rank, p.decode(), -a, left, right, totals[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}
    return out


def mined(spark, rows, **how):
    return {tuple(r) for r in collocations.collocations(docs(spark, rows), **how).collect()}


def invented(n, seed=3):
    rnd = random.Random(seed)
    words = ["the", "of", "New", "york", "CITY", "é", "Ää", "x\x0by", "tab\tbed", "\xa0", "a", "b"]
    text = lambda: "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\r\n", "? "]) for _ in range(rnd.randint(0, 80)))
    return [(k, text(), rnd.choice(["en", "de", None, "und"])) for k in range(n)]


@pytest.mark.parametrize("how", [{}, {"min_count": 3, "max_words": 4, "top": 15, "covered": 80}, {"min_count": 2, "max_words": 2}])
def test_collocations_equal_plain_ones(spark, how):
    rows = invented(60)
    want = plain_collocations(rows, **how)
    assert want and mined(spark, rows, **how) == want


def test_collocations_of_small_segments_and_parts(spark, monkeypatch):
    """Segments and parts of texts end anywhere and change nothing; a long piece isn't cut."""
    rows = invented(12) + [(99, "one two three " * 400, "en"), (100, "one two three. " * 50 + "one" + " two three" * 30, "de")]
    want = plain_collocations(rows)
    real = collocations.postings
    monkeypatch.setattr(collocations, "postings", lambda frame, *a: real(frame.coalesce(1), *a, segment=64, part=50))
    assert collocations.postings(docs(spark, rows)).count() > 15 and mined(spark, rows) == want
    stream = [w for part in collocations.words_of(b"A,b" + b" c" * 20) for w in part]
    assert stream == [b"a", b".", b"b"] + [b"c"] * 20


def test_words_of_long_texts_are_cut_between_words():
    text = b"alpha beta,gamma\tdelta " * 9 + b"z" * 50
    assert [w for part in collocations.words_of(text, 10) for w in part] == text.translate(collocations._BYTES).replace(b".", b" . ").split()
    assert list(collocations.words_of(b"")) == []


def test_collocations_edges(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(1, None, None), (2, "", "en"), (3, " \t ", "en"), (None, "...", None)]) == set()
    rows = [(1, "ab cd", None)] * 6 + [(None, "AB  cd.", "und")] * 4  # repeated rows count; null is und
    assert mined(spark, rows) == {("und", 1, "ab cd", 10, 10, 10, 20, 1_000_000)}
    assert mined(spark, rows[1:]) == set()
    same = [(k, "x x x x x x", "en") for k in range(5)]  # overlaps
    assert mined(spark, same) == plain_collocations(same)
    ties = [(k, "q1 q2; q3 q4; Q5 q6", "en") for k in range(10)]
    assert sorted((r[1], r[2]) for r in mined(spark, ties)) == [(1, "q1 q2"), (2, "q3 q4"), (3, "q5 q6")]


def test_scores_are_exact_beyond_64_bits(spark):
    a, x, y = 400_000_000_000, 999_999_999_989, 999_999_999_961
    phrases = spark.createDataFrame([("en", "u v", 2, a), ("en", "u", 1, x), ("en", "v", 1, y)], "lang string, phrase string, size int, a long")
    assert collocations.scored(phrases).collect() == [("en", "u v", a, x, y, 1_000_000 * a * a // (x * y))]


def plain_dedup(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(A_Z)
    holders = defaultdict(set)
    for doc, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    gone = {k: max((d for d in held if d is not None), default=None) for k, held in holders.items() if len(held) >= min_docs}
    out = []
    for doc, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == doc]
        out.append((doc, text, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def deduped(spark, rows, **how):
    return Counter((r.document.doc_id, r.document.text, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup(docs(spark, rows), **how).collect())


def test_line_dedup_equals_plain_one(spark):
    rnd = random.Random(8)
    shared = ["This line is shared by many documents, word for word.", "ÀÉ are not lower-cased here, but A and E are, you see", "x" * 39, "y" * 40, "", "   ", "short"]
    line = lambda: rnd.choice([rnd.choice(shared), "\t " + rnd.choice(shared).upper() + " \r\x0b", f"a line of its own number {rnd.random()} that is long"])
    rows = [(rnd.choice([k, k, k, None, 3]), "\n".join(line() for _ in range(rnd.randint(0, 12))), "en") for k in range(60)]
    want = plain_dedup(rows)
    assert deduped(spark, rows) == want and sum(n for _, _, _, n, _ in want) > 20
    assert deduped(spark, rows, min_chars=1, min_docs=2) == plain_dedup(rows, 1, 2)


def test_line_dedup_edges(spark):
    assert deduped(spark, []) == Counter()
    rows = [(1, None, None), (2, "", "en"), (3, "\n\n", "en"), (None, "z" * 100, "en")]
    assert deduped(spark, rows) == plain_dedup(rows)
    line = "l" * 40
    rows = [(1, line, "en")] * 9 + [(None, line, "en")] * 9 + [(k, f"{line}\n\n {line.upper()}\t", "en") for k in (2, 3)]
    assert deduped(spark, rows)[(1, line, 1, 0, line)] == 9  # four documents, however many rows
    rows += [(4, "a\n" + line, "en")]
    want = plain_dedup(rows)
    assert deduped(spark, rows) == want and want[(4, "a\n" + line, 2, 0, "a\n" + line)] == 1 and want[(2, f"{line}\n\n {line.upper()}\t", 3, 2, "")] == 1
    many = [(k, "\n".join([line] * 20_000 + [str(k)]), "en") for k in range(5)]
    out = deduped(spark, many)
    assert out == plain_dedup(many)


def test_line_dedup_is_native(spark):
    plan = line_dedup.dedup(docs(spark, [(1, "a", "en")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_queries_equal_their_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    for module in (collocations, line_dedup):
        got = module.query(spark, d)
        want = con.sql(module.SQL)
        assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())
    kept = line_dedup.dedup(spark.read.parquet(f"{d}/documents.parquet")).select("document.doc_id", "kept", F.sha2(F.col("kept").cast("binary"), 256).alias("h")).collect()
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.h for r in kept)
