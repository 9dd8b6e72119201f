"""Quality rules, URL filters, sharding and rollups."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from skein.llm import quality_rules as qr
from skein.llm import sharding, token_rollup, url_filter

TEXTS = ["", None, " \n\t ", "one", "a b c d e a b c d e f", "x " * 5000, "L1\nL1\n\nL2 b\nL1", "é#ñ $ ünder|x", "\xa0 nbsp stays", "a b c d e f g h i j k l", "a b c d e f g h i j k l"]
DOC = "doc_id long, text string, lang string, source string, n_chars long, n_words string"


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(k if k != 3 else None, t, "en", "s", 0, "clash") for k, t in enumerate(texts)], DOC)


def plain_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_stats_equal_plain_ones(spark):
    random.seed(5)
    texts = TEXTS + [" ".join(random.choice("abc") for _ in range(random.randint(0, 60))) + random.choice(["", "\n", "\r\nz"]) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in qr.with_stats(frame).select("doc_id", *qr.STATS).collect()}
    assert got == {k: plain_stats(t) for k, t in enumerate(texts)}


def test_rules_reject_and_keep(spark):
    good = [" ".join(f"w{random.randint(0, 999)}" for _ in range(40)) for _ in range(300)]
    bad = [" ".join(f"w{random.randint(0, 999)}###" for _ in range(40)) for _ in range(100)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(400)], "doc_id long, quality int")
    out = {r.doc_id: r.kept for r in qr.judged(frame, labels).collect()}
    assert sum(out[k] for k in range(300)) >= 297 and not any(out[k] for k in range(300, 400))


def test_rules_edges(spark):
    frame = docs(spark)
    none = qr.judged(frame, spark.createDataFrame([], "doc_id long, quality int"))
    rows = none.select("text", "kept", "base_failed").collect()
    assert len(rows) == len(TEXTS) and {r.kept for r in rows if r.text == TEXTS[-1]} == {True}
    assert all(r.base_failed and not r.kept for r in rows if not r.text or r.text.startswith("x "))
    assert qr.judged(frame.limit(0), spark.createDataFrame([(1, 0)], "doc_id long, quality int")).count() == 0
    plan = none._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_sample_is_bounded_by_ids(spark):
    frame = spark.createDataFrame([(7, f"a b c {k}") for k in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 0), (7, 0), (8, 1)], "doc_id long, quality int")
    seen = []
    real, qr.learn = qr.learn, lambda rows, **how: seen.extend(rows) or []
    try:
        qr.learn_rules(frame, labels, 5)
    finally:
        qr.learn = real
    assert len(seen) == 1


def test_verdict_equals_plain_rules(spark):
    """base_failed at its border and kept, against the statistics and Rule.holds, over a whole table."""
    d = "/root/testdata/sf0.01"
    frame, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    border = ["a b c d e f g h i", "a b c d e f g h i j", " ".join(f"w{k}" for k in range(40)) + " 1 2 3 4 5 1 2 3 4 5", " ".join(f"w{k}" for k in range(39)) + " 1 2 3 4 5 1 2 3 4 5"]
    frame = frame.select("doc_id", "text").unionByName(spark.createDataFrame([(-1 - k, t) for k, t in enumerate(border)], "doc_id long, text string"))
    rules = qr.learn_rules(frame, labels)
    assert rules
    out = qr.apply_rules(frame, rules).select("doc_id", "text", *qr.STATS, *(f for f in qr.FEATURES if f not in qr.STATS), "base_failed", "kept", "rule").collect()
    for r in out:
        n, _, _, _, repeated = stats = plain_stats(r.text)
        assert tuple(r[c] for c in qr.STATS) == stats and r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        first = next((k for k, rule in enumerate(rules, 1) if rule.holds(r.asDict())), 0)
        assert r.rule == first and r.kept == (not r.base_failed and not first)
    assert {r.doc_id: r.base_failed for r in out if r.doc_id < 0} == {-1: True, -2: False, -3: False, -4: True}


def test_learning_is_sequential_covering():
    rows = [{"a": float(i % 50), "b": float(i % 7), "bad": int(i % 50 >= 40), "fold": i % 3} for i in range(900)]
    rules = qr.learn(rows, features=("a", "b"))
    assert len(rules) == 1 and all(rules[0].holds(r) == bool(r["bad"]) for r in rows)
    assert qr.learn([r | {"bad": 0} for r in rows], features=("a", "b")) == []


URLS = [None, "", "nourl", "http://Example.COM/en/1", "https://www.example.com/en/2?x#y", "http://a.example.net/es/3", "http://net/fr/", "http://b.org", "http://c.com", "http://c.com/", "http://c.com?/en/", "x://h/p#://q/z", "http://www.example.com/en/2/"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(URLS)], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(None, 1), (2, None)], "label_key long, label int")
    got = {r.url: r for r in url_filter.judged(pages, labels).collect()}
    assert len(got) == len(URLS)
    assert (got[None].host, got[None].path, got["nourl"].host) == ("", "", "")
    assert (got["http://Example.COM/en/1"].host, got["http://Example.COM/en/1"].rule, got["http://Example.COM/en/1"].verdict) == ("example.com", "example.com/en/", "block")
    assert (got["https://www.example.com/en/2?x#y"].path, got["https://www.example.com/en/2?x#y"].rule, got["https://www.example.com/en/2?x#y"].verdict) == ("/en/2", "www.example.com/en/", "allow")
    assert got["http://a.example.net/es/3"].rule == "net/es/" and got["http://net/fr/"].rule == "net/fr/"
    assert got["http://b.org"].rule is None and got["http://b.org"].verdict == "allow"
    assert got["http://c.com"].rule is None and got["http://c.com/"].rule == "com/" and got["http://c.com?/en/"].path == ""
    assert (got["x://h/p#://q/z"].host, got["x://h/p#://q/z"].path) == ("h", "/p")
    assert url_filter.judged(pages.limit(0), labels).count() == 0


def test_url_tree_blocks_impure_templates(spark):
    rows = [(k, f"http://h.org/{'bad' if k % 2 else 'good'}/{k}") for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k % 2 == 0)) for k in range(400)], "label_key long, label int")
    got = {(r.template, r.verdict) for r in url_filter.judged(pages, labels).select("template", "verdict").collect()}
    assert got == {("/bad/{n}", "block"), ("/good/{n}", "allow")}
    alike = spark.createDataFrame([(k, int(k % 5 != 0)) for k in range(400)], "label_key long, label int")
    assert {r.template for r in url_filter.judged(pages, alike).select("template").collect()} == {"/*/{n}"}


def test_url_tree_merges_branches_that_are_alike(spark):
    names = ["bad1", "good1", "bad2", "good2", "half1", "half2"]
    rows = [(k, f"http://h.org/{names[k % 6]}/{k}") for k in range(1200)] + [(5000 + k, f"http://h.org/few{k}/x") for k in range(3)]
    labels = spark.createDataFrame([(k, int(k % 6 in (1, 3) or (k % 6 > 3 and k // 6 % 2 == 0))) for k in range(1200)], "label_key long, label int")
    out = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string"), labels).select("url", "template", "verdict", "purity").collect()
    got = {r.url.split("/")[3]: (r.template, r.verdict) for r in out}
    # What is half good doesn't differ from its siblings taken together, and unlabelled branches differ from nothing.
    assert got == {"bad1": ("/*1/{n}", "block"), "bad2": ("/*1/{n}", "block"), "good1": ("/*2/{n}", "allow"), "good2": ("/*2/{n}", "allow"), **{k: ("/*/*", "block") for k in ("half1", "half2", "few0", "few1", "few2")}}


def test_url_classes_by_plain_merging(spark):
    random.seed(11)
    rows = []
    for k in range(300):
        cells = sorted(random.sample(range(50), random.randint(1, 12)))
        rows.append((k, [(c, c, n := random.randint(1, 400), n * c // 50, random.randint(1, 3)) for c in cells]))
    frame = spark.createDataFrame(rows, "k int, cells array<struct<low:int,high:int,labelled:long,good:long,branches:long>>")
    for r in frame.select("k", url_filter.merged(F.col("cells"), 2.58).alias("m")).collect():
        want = [list(c) for c in rows[r.k][1]]
        while True:
            out = []
            for c in want:
                if out:
                    a, n, m = out[-1], out[-1][2], c[2]
                    p = (a[3] + c[3]) / (n + m)
                    if abs(a[3] / n - c[3] / m) <= 2.58 * (p * (1 - p) * (1 / n + 1 / m)) ** 0.5:
                        out[-1] = [a[0], c[1], n + m, a[3] + c[3], a[4] + c[4]]
                        continue
                out.append(list(c))
            if len(out) == len(want):
                break
            want = out
        assert [list(c) for c in r.m] == want


def test_url_tree_goes_as_deep_as_paths(spark):
    deep = lambda k: f"http://h.org/blog/2024/05/{'spam-x' if k % 4 == 0 else 'good-y'}/en/{'old' if k % 8 == 1 else 'new'}/{k}"
    rows = [(k, deep(k)) for k in range(800)] + [(900, "http://h.org/blog"), (901, "http://one.org/" + "a/" * 300 + "z"), (902, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k % 4 != 0 and k % 8 != 1)) for k in range(800)], "label_key long, label int")
    out = {r.page_id: r for r in url_filter.judged(pages, labels).collect()}
    assert len(out) == len(rows)
    assert {(r.template, r.verdict) for k, r in out.items() if k < 800} == {
        ("/blog/{n}/{n}/spam-x/en/new/{n}", "block"), ("/blog/{n}/{n}/good-y/en/new/{n}", "allow"), ("/blog/{n}/{n}/good-y/en/old/{n}", "block")}
    assert (out[900].template, out[901].template, out[902].template) == ("/blog", "/" + "a/" * 300 + "z", "/")


def test_sharding(spark):
    texts = [f"text {k} " + "y" * (k % 97) for k in range(3000)] + ["hot copy of some length"] * 1500 + [None, "", "", "one text " * 400]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    out = sharding.shard(frame, shards=8, slot_part=64).toPandas()
    assert sorted(out.doc_id) == list(range(len(texts))) and set(out.law) == {"bytes"} and out.grown_shard.isna().all()
    loads = out.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() - loads.min() < 0.02 * loads.mean()
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    by_id = out.set_index("doc_id")
    assert by_id.loc[0, "text_crc32"] == zlib.crc32(texts[0].encode()) and by_id.loc[4500, "size"] == 1 and by_id.loc[4500, "text_crc32"] == 0
    cold = [k for k in range(len(texts)) if texts[k] in (None, "")]
    assert by_id.loc[cold, "shard"].nunique() == 1
    assert sharding.shard(frame.limit(0)).count() == 0
    small = sharding.shard(frame.limit(3)).collect()
    assert len(small) == 3 and all(r.slot >= 0 for r in small)


def test_placement_prefers_residual_capacity():
    sizes = np.array([[9.0, 1, 1], [1, 9, 1], [1, 1, 9], [1, 1, 1]] * 4)
    where = sharding.place(sizes, 4, (1.0, 1.0, 1.0))
    assert len(set(np.bincount(where, sizes.sum(axis=1)))) == 1


def test_rollup_against_sql_and_replay(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a b, c", "de", "s1", 0), (2, None, None, None, 0), (3, "x", "en", "s1", 0), (3, "x", "en", "s1", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    store = token_rollup.Store(spark, f"file://{tmp_path}/r")
    assert store.totals().count() == 0
    frame = token_rollup.counted(frame, v=token_rollup.words_v1(F.col("text")))
    assert store.commit("a", token_rollup.rows(frame, "v1", "v")) and not store.commit("a", token_rollup.rows(frame, "v1", "v"))
    one = sorted(map(tuple, store.totals().collect()), key=str)
    assert one == sorted([("s1", "de", "v1", 1, 3, 6), (None, None, "v1", 1, 0, 0), ("s1", "en", "v1", 2, 2, 2)], key=str)
    store.compact()
    assert sorted(map(tuple, store.totals().collect()), key=str) == one and not store.commit("a", token_rollup.rows(frame, "v1", "v"))
    store.commit("b", token_rollup.rows(frame.where("doc_id = 3"), "v1", "v", -1))
    store.commit("c", token_rollup.rows(frame.limit(0), "v1", "v"))
    store.compact()
    assert sorted(map(tuple, store.totals().collect()), key=str) == sorted([("s1", "de", "v1", 1, 3, 6), (None, None, "v1", 1, 0, 0)], key=str)


def test_rollup_survives_attempts_that_die(spark, tmp_path, monkeypatch):
    store = token_rollup.Store(spark, f"file://{tmp_path}/r")
    batch = lambda n: spark.createDataFrame([("s", "en", "v", n, 10 * n, 100 * n)], token_rollup.SCHEMA)
    store.commit("a", batch(1))
    store.commit("b", batch(2))
    monkeypatch.setattr(store, "_publish", lambda new: 1 / 0)
    for attempt in (store.compact, lambda: store.commit("c", batch(5))):
        try:
            attempt()
        except ZeroDivisionError:
            pass
    monkeypatch.undo()
    want = [("s", "en", "v", 3, 30, 300)]
    assert [tuple(r) for r in store.totals().collect()] == want
    assert store.compact() and [tuple(r) for r in store.totals().collect()] == want
    assert store.commit("c", batch(5)) and not store.commit("c", batch(5))
    assert len(list((tmp_path / "r").iterdir())) > 3
    store.vacuum()
    assert len(list((tmp_path / "r").iterdir())) == 3 and [tuple(r) for r in store.totals().collect()] == [("s", "en", "v", 8, 80, 800)]


def test_rollup_of_two_writers(spark, tmp_path, monkeypatch):
    one, two = (token_rollup.Store(spark, f"file://{tmp_path}/r") for _ in range(2))
    batch = lambda n: spark.createDataFrame([("s", "en", "v", n, n, n)], token_rollup.SCHEMA)
    one.commit("a", batch(1))
    real, late = one._publish, []

    def publish(new):
        if not late:  # the other writer comes between reading the last version and publishing the next
            late.append(two.commit("b", batch(2)))
            late.append(two.commit("same", batch(4)))
        return real(new)

    monkeypatch.setattr(one, "_publish", publish)
    assert not one.commit("same", batch(4)) and late == [True, True]
    late.clear()
    monkeypatch.setattr(two, "commit", lambda *_: two.compact())
    assert not one.compact()
    assert [tuple(r) for r in one.totals().collect()] == [("s", "en", "v", 7, 7, 7)] and one.version() == two.version()


def test_token_counts_equal_matches(spark):
    random.seed(8)
    texts = [*TEXTS, "a,b c", "--a--", ", ,", *("".join(random.choice("ab ,.é\n\t_") for _ in range(random.randint(0, 30))) for _ in range(100))]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: (r.a, r.b) for r in frame.select("k", token_rollup.words_v1(F.col("text")).alias("a"), token_rollup.words_v2(F.col("text")).alias("b")).collect()}
    signs = r"\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E"
    assert got == {k: (len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), len(re.findall(rf"[^\x20\x09-\x0D{signs}]+|[{signs}]", t or ""))) for k, t in enumerate(texts)}


def test_rollup_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as from '{d}/{t}.parquet'")
    assert sorted(map(tuple, token_rollup.query(spark, d).collect())) == sorted(con.sql(token_rollup.SQL).fetchall())


def test_cells_are_merged_until_none_are_alike(spark):
    rnd = random.Random(17)
    cases = []
    for case in range(40):
        cells = []
        for low in sorted(rnd.sample(range(50), rnd.randint(1, 50))):
            labelled = rnd.choice([3, 20, 200, 2000])
            cells.append((low, low, labelled, round(labelled * (low + 0.5) / 50), 1))
        cases.append((case, cells))
    kind = "array<struct<low:int,high:int,labelled:bigint,good:bigint,branches:bigint>>"
    got = {r.k: [tuple(c) for c in r.m] for r in spark.createDataFrame(cases, f"k int, c {kind}").select("k", url_filter.merged(F.col("c"), 2.58).alias("m")).collect()}

    def alike(a, b):
        p = (a[3] + b[3]) / (a[2] + b[2])
        return abs(a[3] / a[2] - b[3] / b[2]) <= 2.58 * (p * (1 - p) * (1 / a[2] + 1 / b[2])) ** 0.5

    for case, cells in cases:
        while True:
            out = []
            for c in cells:
                if out and alike(out[-1], c):
                    last = out.pop()
                    c = (last[0], c[1], *(x + y for x, y in zip(last[2:], c[2:])))
                out.append(c)
            if len(out) == len(cells):
                break
            cells = out
        assert got[case] == cells


def test_line_ends_in_paths_tell_them_apart(spark):
    paths = spark.createDataFrame([(k, p) for k, p in enumerate(["/x/a\nb", "/x/c\nd", "/x/1\n2.html", "/x/"])], "k int, path string")
    got = {r.k: r.s for r in paths.select("k", url_filter.shape_of(F.col("path")).alias("s")).collect()}
    assert got == {0: ["x", "a\nb"], 1: ["x", "c\nd"], 2: ["x", "1\n2.html"], 3: ["x", ""]}
