"""Shingles, components, the n-gram join and the positional index, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from skein.llm import components as cc
from skein.llm import ngram_join, positional_index
from skein.llm.shingles import CHUNK, shingle_sets, words_of


def test_shingles_are_exact():
    texts = [None, "", " \n", "a", "A b\tC", "a b c d", "a b c d e  a b c d", "\x1c x\x00y z w v", "é É a b c", "w" * 10 + " " + " ".join(f"t{k}" for k in range(2000))]
    for size in (1, 4, 5):
        for text, got in zip(texts, shingle_sets(texts, size)):
            w = words_of(text)
            assert len(got) == len({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else ())
    same = shingle_sets(["x a b c d y", "a  B c\nd"], 4)
    assert set(same[1].tolist()) <= set(same[0].tolist())


def test_long_text_pieces():
    words = [f"w{k % 70001}" for k in range(CHUNK // 3)]
    whole = shingle_sets([" ".join(words)], 4)[0]
    assert len(whole) == len({tuple(words[k : k + 4]) for k in range(len(words) - 3)})


def _classes(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("percent", [50, 70, 85, 100])
def test_trie_links(percent):
    random.seed(percent)
    for _ in range(300):
        top = random.choice([8, 20, 60])
        bases = [random.sample(range(top), random.randint(1, top)) for _ in range(random.randint(1, 4))]
        sets = []
        for _ in range(random.randint(1, 14)):
            s = set(random.choice(bases))
            for _ in range(random.choice([0, 1, 1, 2, 4])):
                s ^= {random.randrange(top)}
            sets.append(s or {0})
        want = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        got = ngram_join.trie_links([np.array(sorted(s), np.uint64) for s in sets], percent)
        assert _classes(len(sets), want) == _classes(len(sets), got) and len(got) < len(sets)


def test_components(spark):
    random.seed(9)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(1000, 1000 + k) for k in range(1, 300)]
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = _classes(1300, edges)
    assert all(got[n] == want[n] for n in got) and {x for e in edges for x in e if e[0] != e[1]} == set(got)
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0


def _corpus(seed, n=120):
    random.seed(seed)
    word = lambda: random.choice("abcdefghij") + random.choice("xyz") + str(random.randrange(40))
    line = " ".join(word() for _ in range(25))
    texts = [None, "", "  ", "one", "one two", "One  two", "one two three", "x " * 4000]
    bases = [[word() for _ in range(random.randint(3, 90))] for _ in range(12)]
    for _ in range(n):
        w = list(random.choice(bases)) if random.random() < 0.7 else [word() for _ in range(random.randint(1, 60))]
        for _ in range(random.choice([0, 0, 1, 1, 2, 5])):
            w[random.randrange(len(w))] = word()
        texts.append(" ".join(w) + (" " + line if random.random() < 0.3 else ""))
    return texts


@pytest.mark.parametrize("block, group", [(4096, 1024), (40, 4), (3, 1)])
def test_ngram_join_equals_brute_force(spark, block, group):
    texts = _corpus(block)
    docs = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id long, text string, component_id string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(frame, block=block, group=group).collect()}
    assert got == ngram_join.brute_force(docs)


def test_ngram_join_edges(spark):
    frame = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (9, "A b c d e")], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.classes(frame).collect()), key=str) == sorted([(None, 2, None), (5, 2, 5), (5, 2, 5), (9, 2, 5)], key=str)
    assert ngram_join.classes(frame.limit(0)).count() == 0


def test_ngram_join_of_words_that_collide_modulo_powers_of_two(spark):
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    docs = [(1, f"x y z {one}"), (2, f"x y z {two}"), (3, f"x y z {one} x y z {two}")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == ngram_join.brute_force(docs) == {1: (1, 1), 2: (1, 2), 3: (5, 3)}


def test_near_pairs_lose_no_similar_one():
    random.seed(6)
    for percent in (50, 80, 85, 100):
        begins = ngram_join.size_classes(percent, 10_000)
        for a in range(1, 400):
            b = 100 * a // percent
            assert np.searchsorted(begins, b, "right") - np.searchsorted(begins, a, "right") <= 1
        sets = []
        for _ in range(60):
            base = random.sample(range(1 << 40), random.choice([3, 70, 200, 1500]))
            for _ in range(random.randint(1, 9)):
                s = set(base)
                for _ in range(random.randint(0, len(s) // 3)):
                    s ^= {random.choice(base), random.randrange(1 << 40)}
                sets.append(np.array(sorted(s), np.uint64))
        sets = sorted((s for s in sets if len(s)), key=len)
        rows = [(shingle, k) for shingle in range(3) for k in range(len(sets)) if shingle < 2 or k % 7 == 0]
        near = ngram_join._Near(percent)
        links = near.edges(np.array([r[0] for r in rows]), np.array([len(sets[k]) for _, k in rows]), np.array([k for _, k in rows]), [ngram_join.bitmap(sets[k]) for _, k in rows])
        roots = _classes(len(sets), links)
        assert len(links) < len(sets)
        similar = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(common := np.intersect1d(sets[a], sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - len(common))]
        assert all(roots[a] == roots[b] for a, b in similar)
        assert percent < 80 or len(set(roots)) > 20  # unlike sets aren't linked


def test_groups_of_near_copies_are_compared_in_few_steps(monkeypatch):
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(6):
        base = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
        sets += [np.unique(np.concatenate([base[rng.random(200) < 0.98], rng.integers(0, 1 << 62, 2, dtype=np.uint64)])) for _ in range(60)]
    # One group of all sets, then many of a class that is linked by then.
    rows = [(0, k) for k in sorted(range(360), key=lambda k: len(sets[k]))] + [(g, k) for g in range(1, 31) for k in sorted(range(g % 6 * 60, g % 6 * 60 + 60), key=lambda k: len(sets[k]))]
    steps, may = [], ngram_join._Near.may
    monkeypatch.setattr(ngram_join._Near, "may", lambda self, i, j: steps.append(len(i)) or may(self, i, j))
    shingle, name = (np.array([r[c] for r in rows], np.int64) for c in range(2))
    near = ngram_join._Near(80)
    links = near.edges(shingle, np.array([len(sets[k]) for k in name], np.int64), name, [ngram_join.bitmap(sets[k]) for k in name])
    assert len(links) == 6 * 59  # a spanning tree of each class
    assert [near.find(k) for k in range(360)] == [k // 60 * 60 for k in range(360)]
    assert max(steps) <= max(ngram_join.PAIRS, 360)
    assert len(steps) < 20


def test_ngram_join_stays_linear_where_unlike_texts_chain(spark, monkeypatch):
    sizes = {}
    for name in ("written",):
        real = getattr(ngram_join, name)
        monkeypatch.setattr(ngram_join, name, lambda df, label, real=real: sizes.__setitem__(label, (out := real(df, label)).count()) or out)
    for n in (200, 800):
        passage = lambda k: " ".join(f"p{k}x{i}" for i in range(30))
        chain = [(k, f"{passage(k)} {passage(k + 1)} own{k} w{k} line that all have in them") for k in range(n)]
        got = {r.component_id for r in ngram_join.classes(spark.createDataFrame(chain, "doc_id long, text string").repartition(4)).collect()}
        assert len(got) == n and sizes["candidate-sets"] <= 0.02 * n and sizes["members"] <= 14 * n


def test_overlap_bounds():
    for a in range(1, 60):
        for b in range(a, 60):
            o = ngram_join.least_overlap(a, b)
            assert 100 * o >= 85 * (a + b - o) and 100 * (o - 1) < 85 * (a + b - o + 1)
        assert ngram_join.prefix_length(a) == a - min(o for o in range(a + 1) if 100 * o >= 85 * a) + 1


def _items():
    return [(1, "aX0 " + " ".join(f"q{k}" for k in range(14))), (2, "short item Here"), (3, None), (4, ""), (5, " ".join(f"q{k}" for k in range(3, 15))), (6, "SHORT item here!"), (10, "z z z z z z z z z z z")]


def _documents():
    q = " ".join(f"q{k}" for k in range(14))
    return [(1, "x " + q.replace(" ", "--") + " y"), (2, None), (3, ""), (4, "a short, ITEM here; and short item here"), (5, "z " * 40), (6, " ".join(f"q{k}" for k in range(9))), (7, "w " * 9000 + q), (8, "q1 q2"), (9, q + " " + q)]


ITEM = "item_id long, text string"


def _digests(found):
    return {r.doc_id: tuple(r)[1:-1] for r in positional_index.digest(found).collect()}


def test_index_equals_brute_force(spark):
    docs, items = _documents(), _items()
    frame = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id long, text string, n_words string").repartition(2)
    want = positional_index.brute_force(docs, items)
    benchmark = spark.createDataFrame(items, ITEM)
    assert _digests(positional_index.hits(frame, benchmark)) == want
    for most in (4096, 1):
        windows, blocks = positional_index.stored_windows(benchmark, block_windows=2, most_items=most)
        assert blocks > 3 and {(tuple(bytes(r.window).split(b" ")), i) for r in windows.collect() for i in r["items"]} == {(w, i) for w, own in positional_index.windows_of(items).items() for i in own}
    assert _digests(positional_index.search(positional_index.stored_index(frame, segment_words=100), benchmark, block_windows=2)) == want
    random.seed(3)
    many = [(k, " ".join(random.choice("abc") for _ in range(random.randint(0, 80)))) for k in range(60)]
    few = [(k, " ".join(random.choice("abc") for _ in range(random.randint(1, 14)))) for k in range(30)]
    found = positional_index.search(positional_index.stored_index(spark.createDataFrame(many, "doc_id long, text string")), spark.createDataFrame(few, ITEM), 4)
    assert _digests(found) == positional_index.brute_force(many, few, 4)


def test_index_edges(spark):
    frame = spark.createDataFrame([(None, "short item here"), (1, "short item here"), (1, "short item here")], "doc_id long, text string")
    items = spark.createDataFrame([*_items(), (2, "short ITEM here")], ITEM)
    out = positional_index.digest(positional_index.hits(frame, items)).collect()
    assert len(out) == 3 and all(r.n_hit == 3 and r.n_items == 2 for r in out)
    out = positional_index.digest(positional_index.search(positional_index.stored_index(frame), items, block_windows=1)).collect()
    assert len(out) == 3 and all(r.n_hit == 3 and r.n_items == 2 for r in out)
    assert positional_index.hits(frame.limit(0), items).count() == 0
    none = positional_index.hits(frame, items.limit(0))
    assert {r.n_hit for r in positional_index.digest(none).collect()} == {0} and none.count() == 3


def test_items_of_null_ids_are_searched(spark):
    docs, items = [(1, "a short item here"), (2, "an other thing here"), (3, "nothing")], [(None, "short item here"), (2, "other thing"), (None, "other thing")]
    frame, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = _digests(positional_index.hits(frame, benchmark))
    assert got == positional_index.brute_force(docs, items)
    assert {d: (x[1], x[2], x[4]) for d, x in got.items()} == {1: (3, 0, True), 2: (2, 1, True), 3: (0, 0, False)}


def _plain_near(words, phrase, slack):
    """Places of the first and last word of all ways to find a phrase in order, that have at most slack other words."""
    found = {(k, k) for k, w in enumerate(words) if w == phrase[0]}
    for term in phrase[1:]:
        found = {(a, k) for a, b in found for k in range(b + 1, len(words)) if words[k] == term}
    return {(a, b) for a, b in found if b - a <= len(phrase) - 1 + slack}


def test_proximity(spark):
    frame = spark.createDataFrame([(1, "short x item y here"), (2, "short x y z item w here"), (3, "item short here"), (None, "short item here")], "doc_id long, text string")
    found = positional_index.proximity(positional_index.build_index(frame), [(2, "short item here")], 2)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(1, 2, 0, 4), (None, 2, 0, 2)], key=str)
    near = positional_index.digest(positional_index.hits(frame, spark.createDataFrame([(2, "short item here")], ITEM), slack=2)).collect()
    assert sorted((r.doc_id or 0, r.n_items, r.n_near) for r in near) == [(0, 1, 1), (1, 0, 1), (2, 0, 0), (3, 0, 0)]


def test_proximity_equals_plain_search():
    random.seed(12)
    for slack in (0, 1, 3):
        docs = [(k, [random.choice("abcd") for _ in range(random.randint(0, 30))]) for k in range(12)]
        texts = [(k, " ".join(w)) for k, w in docs]
        rows = list(positional_index._index(iter([pa.RecordBatch.from_pydict({"doc_id": [k for k, _ in texts], "text": [t for _, t in texts]})]), 60))
        phrases = [tuple(random.choice("abcd").encode() for _ in range(random.randint(1, 5))) for _ in range(20)]
        got = {}
        for batch in rows:
            seg = positional_index.Segment(batch.to_pylist()[0])
            for p, a, b in zip(*(x.tolist() for x in seg.near(phrases, slack))):
                d = int(seg.document(np.array([a]))[0])
                got.setdefault((int(seg.ids[d]), p), set()).add((a - int(seg.starts[d]), b - int(seg.starts[d])))
        for k, words in docs:
            for p, phrase in enumerate(phrases):
                want = _plain_near(words, [t.decode() for t in phrase], slack)
                least = {(a, b) for a, b in want if not any((c, d) != (a, b) and a <= c and d <= b for c, d in want)}
                assert least <= got.get((k, p), set()) <= want


def test_ngram_join_of_rows_that_repeat_an_id(spark):
    """Rows of one id are found again one by one, by their texts."""
    words = [f"w{k}" for k in range(60)]
    near = [" ".join([*words[:50], f"own{k}"]) for k in range(80)]
    other = [" ".join(f"v{k}x{j}" for j in range(20)) for k in range(30)]
    docs = [(7, t) for t in near + other + near[:3]] + [(900, near[0]), (5, " ".join(words[:52])), (950, other[0]), (None, near[1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = ngram_join.classes(frame).collect()
    roots = sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None)
    assert len(got) == len(docs) and roots == sorted([(5, 5), *[(7, 5)] * 83, *[(7, 7)] * 30, (900, 5), (950, 7)])


def test_spans_are_joined_in_order():
    rnd = random.Random(3)
    for _ in range(300):
        spans = [(a, a + rnd.randint(1, 9)) for a in (rnd.randint(0, 60) for _ in range(rnd.randint(0, 20)))]
        covered = {w for a, b in spans for w in range(a, b)}
        got = positional_index.joined(np.array(spans, np.int64).reshape(-1, 2)).tolist()
        assert {w for a, b in got for w in range(a, b)} == covered and all(x[1] < y[0] for x, y in zip(got, got[1:]))


def test_many_spans_in_several_blocks(spark):
    """One long document with a hit at every fourth word."""
    n = 20_000
    items = spark.createDataFrame([(k, f"w{k} x{k}") for k in range(40)], "item_id long, text string")
    text = " ".join(f"w{k % 40} x{k % 40} . , gap{k}" for k in range(n))
    frame = spark.createDataFrame([(1, text), (1, "w1 x1"), (2, None)], "doc_id long, text string")
    index = positional_index.stored_index(frame)
    rows = lambda df: sorted((r.doc_id, r.n_words, len(r.spans), [list(s) for s in r.spans[:5]], list(r["items"])) for r in df.collect())
    one, several = rows(positional_index.search(index, items)), rows(positional_index.search(index, items, block_windows=9))
    assert one == several and max(r[2] for r in one) == n
