"""Queries over whole tables, against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from skein import session
from skein.llm import bpe, chat_format, compression_classifier, html_extract, ngram_join, positional_index, quality_rules, sharding, url_filter

SMALL, D = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows(name, columns, where=D):
    return duckdb.sql(f"select {columns} from '{where}/{name}.parquet'").fetchall()


def test_html_extract(spark):
    """The pages table has its articles in article elements, whose texts can be had by taking all tags out."""
    pages = {p: (u, h) for p, u, h in rows("pages", "page_id, url, html")}
    got = html_extract.query(spark, D).collect()
    assert len(got) == len(pages)
    for r in got:
        url, page = pages[r.page_id]
        inside = re.search("(?s)<article>(.*)</article>", page)[1]
        blocks = re.split(r"<(?:/?p|/?h1|br)>", re.sub("</?b>", "", inside))
        want = "\n".join(t for b in blocks if (t := " ".join(html_extract.html.unescape(re.sub("<[^>]*>", "", b)).split())))
        assert (r.url, r.text, r.n_chars) == (url, want, len(want))


def test_compression_classifier(spark):
    out = {r.doc_id: r for r in compression_classifier.query(spark, D).collect()}
    assert len(out) == len(rows("documents", "doc_id"))
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for d, r in out.items())
    held = [(out[d].predicted, q) for d, q in rows("labels", "doc_id, quality") if d in out and out[d].held_out]
    assert len(held) > 100 and sum(p == q for p, q in held) >= 0.97 * len(held)


def test_sharding(spark):
    docs = dict(rows("documents", "doc_id, text"))
    out = sharding.query(spark, D).toPandas()
    assert set(out.doc_id) == set(docs) and len(out) == len(docs) and set(out.law) == {"bytes"} and out.grown_shard.isna().all() and set(out["shard"]) == set(range(16))
    for r in out.itertuples():
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    loads = out.groupby("shard")[["size", "n_tokens"]].sum()
    spread = (loads.max() - loads.min()) / loads.mean()
    assert spread["size"] < 0.01 and spread["n_tokens"] < 0.05
    assert out.assign(t=out.doc_id.map(docs)).groupby("t")["shard"].nunique().max() == 1  # equal texts are together


def test_placement_in_rounds_levels_all_measures():
    rng = np.random.default_rng(1)
    tokens = np.where(rng.random(3000) < 0.05, rng.integers(2000, 8000, 3000), rng.integers(1, 60, 3000))
    sizes = np.stack([tokens * rng.uniform(3, 9, 3000), tokens, np.ones(3000)], 1)
    spread = lambda where: [np.ptp(x) / x.mean() for x in (np.bincount(where, sizes[:, k], 16) for k in range(3))]
    once, leveled = spread(sharding.place(sizes, 16, rounds=0)), spread(sharding.place(sizes, 16))
    assert leveled[0] < 0.01 and leveled[1] < 0.1 and leveled[2] < 0.02 and sum(leveled) < sum(once)


def test_bpe(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    docs = rows("documents", "doc_id, coalesce(text, '')", SMALL)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for (d, text), found in zip(docs, library.encode_batch([t for _, t in docs], add_special_tokens=False)):
        want[d] = (len(found.ids), sha(",".join(map(str, found.ids))), sha(library.decode(found.ids, skip_special_tokens=False)))
    assert {r.doc_id: tuple(r)[1:4] for r in bpe.query(spark, SMALL).collect()} == want


def test_chat_format(spark):
    got = {r.conv_id: r for r in chat_format.query(spark, D).collect()}
    turns = rows("conversations", "conv_id, turn, role, text") + chat_format.PROBE
    assert {c: tuple(r)[1:5] for c, r in got.items()} == chat_format.brute_force(turns)
    assert all(r.rewrites == 0 and r.checked_turns == r.n_turns for r in got.values())
    by_id = defaultdict(list)
    for c, turn, role, text in sorted(turns, key=lambda t: (t[0], t[1])):
        by_id[c].append((role, text or ""))
    assert all(r.formatted_chars == len(chat_format.render(by_id[c])) for c, r in got.items())


def test_positional_index(spark):
    got = {r.doc_id: tuple(r)[1:6] for r in positional_index.query(spark, D).collect()}
    assert got == positional_index.brute_force(rows("documents", "doc_id, text"), rows("benchmark", "item_id, text"))
    assert sum(x[4] for x in got.values()) > 10


def test_ngram_join(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.query(spark, D).collect()}
    assert got == ngram_join.brute_force(rows("documents", "doc_id, text"))


def test_quality_rules(spark):
    """Statistics, base rule and verdict of the learned list, computed plainly."""
    rules = quality_rules.learn_rules(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{D}/labels.parquet"))
    got = {r.doc_id: r for r in quality_rules.query(spark, D).collect()}
    for d, text in rows("documents", "doc_id, text"):
        t, r = text or "", got[d]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        places, covered = defaultdict(list), set()
        for k in range(len(w) - 4):
            places[tuple(w[k : k + 5])].append(k)
        for found in places.values():
            if len(found) > 1:
                covered.update(j for k in found for j in range(k, k + 5))
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        share = lambda a, b: a / b if b else 0.0
        facts = {"n_words": base[0], "mean_word": share(base[1], base[0]), "symbols_per_char": share(base[2], base[1]), "exclaims_per_word": share(t.count("!"), base[0]), "dup_line_share": share(base[3], len(lines)), "repeat_share": share(base[4], base[0]), "upper_share": share(len(re.findall("[A-Z]", t)), base[1])}
        assert r.rule == next((k for k, rule in enumerate(rules, 1) if rule.holds(facts)), 0) and r.kept == (not r.base_failed and not r.rule)


def _plain_tree(urls, z=2.58, smoothing=10.0):
    """(host, segments) to (template, purity), one node after another. urls: (host, segments, label)."""

    def alike(a, b):
        p = (a[1] + b[1]) / (a[0] + b[0])
        return abs(a[1] / a[0] - b[1] / b[0]) <= z * (p * (1 - p) * (1 / a[0] + 1 / b[0])) ** 0.5

    counts = defaultdict(lambda: [0, 0])
    for host, segments, label in urls:
        c = counts[host, segments]
        c[0] += label is not None
        c[1] += label or 0
    template, todo = {}, {}
    for host in {h for h, _ in counts}:
        todo[host, ""] = [s for h, s in counts if h == host]
    depth = 0
    while todo:
        further = defaultdict(list)
        for (host, name), paths in todo.items():
            kids = defaultdict(list)
            for s in paths:
                kids[s[depth]].append(s)
            totals = {k: [sum(counts[host, s][i] for s in v) for i in range(2)] for k, v in kids.items()}
            n, good = (sum(t[i] for t in totals.values()) for i in range(2))
            apart = {}
            for k, (a, b) in totals.items():
                if a and n - a and 0 < good < n:
                    p = good / n
                    if abs(b / a - (good - b) / (n - a)) > z * (p * (1 - p) * (1 / a + 1 / (n - a))) ** 0.5:
                        apart[k] = min(int(b / a * url_filter.CELLS), url_filter.CELLS - 1)
            cells = defaultdict(lambda: [0, 0, []])
            for k, cell in apart.items():
                cells[cell][0] += totals[k][0]
                cells[cell][1] += totals[k][1]
                cells[cell][2].append(k)
            classes = [cells[c] for c in sorted(cells)]
            while True:
                out = []
                for c in classes:
                    if out and alike(out[-1], c):
                        out[-1] = [out[-1][0] + c[0], out[-1][1] + c[1], out[-1][2] + c[2]]
                    else:
                        out.append(c)
                if len(out) == len(classes):
                    break
                classes = out
            branch = {k: k if len(kids) == 1 else "*" for k in kids}
            for number, c in enumerate(classes, 1):
                branch |= {k: k if len(kids) == 1 or len(c[2]) == 1 else f"*{number}" for k in c[2]}
            for k, own in kids.items():
                if len(paths) == 1:
                    template[host, own[0]] = f"{name}/" + "/".join(own[0][depth:])
                    continue
                for s in own:
                    at = f"{name}/{branch[k]}"
                    if len(s) == depth + 1:
                        template[host, s] = at
                    else:
                        further[host, at].append(s)
        todo, depth = further, depth + 1
    total, by_host, by_template = [0, 0], defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (host, s), c in counts.items():
        for x in (total, by_host[host], by_template[host, template[host, s]]):
            x[0], x[1] = x[0] + c[0], x[1] + c[1]
    prior = total[1] / total[0] if total[0] else 1.0
    out = {}
    for (host, s), name in template.items():
        (hn, hg), (n, g) = by_host[host], by_template[host, name]
        out[host, s] = name, (g + smoothing * (hg + smoothing * prior) / (hn + smoothing)) / (n + smoothing)
    return out


def _segments(path):
    out = []
    for raw in path.removeprefix("/").split("/"):
        stem, ext = re.fullmatch(r"(?s)(.*?)(\.[A-Za-z0-9]{1,5})?", raw).groups()
        out.append(("{n}" if re.fullmatch("[0-9]+", stem) else "{id}" if re.search("[0-9]", stem) and re.fullmatch("[0-9A-Fa-f-]{8,}", stem) else stem) + (ext or ""))
    return tuple(out)


def _plain_verdicts(pages, labels):
    located = {}
    for page, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        number = re.search(r"([0-9]+)[^0-9/]*/?$", path)
        located[page] = host, path, labels.get(int(number[1])) if number else None
    tree = _plain_tree([(h, _segments(p), y) for h, p, y in located.values()])
    out = {}
    for page, (host, path, _) in located.items():
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        template, purity = tree[host, _segments(path)]
        verdict = max(fits)[2] if fits else "block" if purity < 0.7 else "allow"
        out[page] = host, path, max(fits)[1] if fits else None, verdict, template, pytest.approx(purity)
    return out


def test_url_filter(spark):
    labels = dict(rows("labels", "doc_id, quality"))
    got = {r.page_id: tuple(r)[1:] for r in url_filter.query(spark, D).collect()}
    assert got == _plain_verdicts(rows("pages", "page_id, url"), labels)


def test_url_tree_equals_a_plain_one(spark):
    random.seed(21)
    pages, labels = [], {}
    for k in range(3000):
        steps = [random.choice(["a", "b", "c", "2024", "x.html"]) for _ in range(random.choice([1, 2, 2, 3, 5]))]
        pages.append((k, f"http://{random.choice(['h.org', 'g.org'])}/{'/'.join(steps)}/{k}"))
        bad = 0.9 * (steps[0] == "a") + 0.5 * ("b" in steps[1:]) + 0.05
        if random.random() < 0.6:
            labels[k] = int(random.random() > bad)
    frame = spark.createDataFrame(pages, "page_id long, url string")
    known = spark.createDataFrame(list(labels.items()), "label_key long, label int")
    out = url_filter.judged(frame, known).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
    got = {r.page_id: tuple(r)[1:] for r in out.collect()}
    assert got == _plain_verdicts(pages, labels) and len({x[4] for x in got.values()}) > 10


def test_scratch_goes_with_the_driver(spark, tmp_path):
    kept = session.written(spark.range(3), "x")
    path = session._made[-1]
    assert kept.count() == 3 and path.startswith("file://")
    session.remove(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)
