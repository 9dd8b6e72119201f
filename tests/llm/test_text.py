"""HTML extraction, classifier, BPE, chat format."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skein.llm import bpe, chat_format, compression_classifier, html_extract
from skein.llm.transducer import Transducer, compile_transducer

PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body class="single-post"><header class=top><a href=/>Home</a><h2>My site</h2></header>
<div id="cookie-notice">We use cookies. Accept all of them, please, as this is a long notice text with many words in it.</div>
<nav><ul><li>a<li>b</ul></nav><main><article><header><h1>Title &amp; more</h1><p class=byline>By Ann</p></header>
<p>First paragraph with   some text &lt;here&gt;, and <a href=x>a link</a> in it.<p>Second.<ul><li>Item one<li>Item two</ul>
<blockquote>A quote.</blockquote><table><tr><td>c1<td>c2</table><pre>code  here</pre><div class="ad-slot">Buy this now! Best price ever for all of you here today.</div>
<aside><p>Related: something that is quite long and has many words too, so what is this.</p></aside><!-- no --><p>Last.</p></article>
<section class="comments"><h3>Comments</h3><p>User: I think this is a very nice article indeed, thank you for writing all this.</p></section></main>
<div class=sidebar><p>Popular posts: one two three four five six seven eight nine ten.</p></div><form><label>Email</label><input><button>Go</button></form>
<footer><p>Copyright 2020. All rights reserved by the company that made this web page.</p></footer></body></html>"""


def test_page_parts():
    assert html_extract.main_text(PAGE).split("\n") == ["Title & more", "By Ann", "First paragraph with some text <here>, and a link in it.", "Second.", "Item one", "Item two", "A quote.", "c1", "c2", "code here", "Last."]
    plain = '<body><div id=menu><a href=1>One</a> <a href=2>Two</a></div><div class=content><h2>Head</h2><p>Some paragraph of text that goes on for long enough to be content, surely.</p><p>Short one.</p><div>Bare.</div></div><div class="footer">Contact us</div>'
    assert html_extract.main_text(plain).split("\n") == ["Head", "Some paragraph of text that goes on for long enough to be content, surely.", "Short one.", "Bare."]
    assert [html_extract.main_text(x) for x in (None, "", "<p>", "a &eacute;  b", "1 < 2")] == ["", "", "", "a é b", "1 < 2"]
    assert html_extract.main_text("<article><p>x</p>" + "<p>word word word.</p>" * 3000 + "</article>").count("\n") == 3000


def test_attributes_and_references_are_read_one_by_one():
    body = "A paragraph of some length that surely is content of this page, is it not?"
    wrap = lambda x: html_extract.main_text(f"<body><nav><a href=1>One</a></nav><article><p>{body}</p>{x}<p>{body}</p></article></body>").split("\n")[1:-1]
    assert wrap('<p>See <a href="/the-hidden-valley">the valley</a> there.</p>') == ["See the valley there."]
    assert wrap('<p><span title="a hidden lake">A lake</span> is here.</p>') == ["A lake is here."]
    assert wrap("<p title='class=\"ad\" hidden' data-class=ad>Title says it.</p>") == ["Title says it."]
    assert wrap('<p hidden>No.</p><p aria-hidden=true>No.</p><p style="color:red;display: none">No.</p>') == []
    assert html_extract.main_text(f'<article><div data-hidden-label="x"><p>{body}</p></div></article>') == body
    assert wrap("<p>Salt &<b>copy</b> &amp;amp; &lt;b&gt;</p>") == ["Salt &copy &amp; <b>"]
    assert wrap('<p class="search-result">One of the results is this.</p>') == ["One of the results is this."]
    assert wrap('<div class="entry-header"><h2>The title</h2></div>') == ["The title"]
    assert wrap('<div class="ad-slot">Buy this long sentence of an advert that has far more than enough words to look like real text, as it wants to.</div>') == []
    assert wrap('<section id="comments"><article><p>A reader says that this is a very nice text, which it surely is, as all can see.</p></article></section>') == []
    assert wrap('<article class="comment"><p>A reader says that this is a very nice text, which it surely is, as all can see.</p></article>') == []
    assert wrap('<div class="relatedPosts"><p>Also read this long sentence that is about some thing else and has many words.</p><p>And this one, too, please, here.</p></div>') == []


def test_cut_decides_on_pages():
    """The pages table has all of its articles in article elements: with the cut all blocks are right, with each block by itself they aren't."""
    import duckdb

    def in_article(element):
        return element is not None and (element.tag == "article" or in_article(element.parent))

    right = alone = changed = total = 0
    for (page,) in duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall():
        blocks = html_extract.blocks_of(page)
        for b, cut, own in zip(blocks, html_extract.label(blocks), html_extract.label(blocks, 0.0, 0.0, 0.0)):
            want = in_article(b.parent)
            right, alone, changed, total = right + (cut == want), alone + (own == want), changed + (cut != own), total + 1
    assert right == total > 4000 and changed > 0.02 * total and alone < 0.98 * total


def test_cut_is_least():
    random.seed(2)
    for _ in range(200):
        n = random.randint(1, 8)
        source, sink = ([random.randint(0, 9) for _ in range(n)] for _ in range(2))
        edges = [(a, b, random.randint(0, 5)) for a in range(n) for b in range(a) if random.random() < 0.4]

        def cost(side):
            return sum(s for s, x in zip(source, side) if not x) + sum(s for s, x in zip(sink, side) if x) + sum(c for a, b, c in edges if side[a] != side[b])

        got = html_extract.minimum_cut(source, sink, edges)
        assert cost(got) == pytest.approx(min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n)))


def test_extract_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (None, None, None, "x"), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    rows = html_extract.extract(pages).collect()
    assert len(rows) == 3 and {r.n_chars for r in rows} == {len(html_extract.main_text(PAGE)), 0}
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_classifier(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("aeioutnrs") for _ in range(random.randint(2, 7)))
    texts = [" ".join(word() + ("$$$ &&&" if k % 4 == 0 else "") for _ in range(80)) for k in range(600)]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate([*texts, None, "", "z" * 300_000])], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(600)], "doc_id long, quality int")
    model = compression_classifier.train(docs, labels)
    rows = {r.doc_id: r for r in compression_classifier.scores(docs, model).withColumn("held_out", compression_classifier.held_out()).collect()}
    held = [k for k in range(600) if rows[k].held_out]
    assert sum(rows[k].predicted == int(k % 4 != 0) for k in held) >= 0.97 * len(held)
    assert rows[600].score == rows[601].score == model.prior and all(0 <= r.score <= 1 for r in rows.values())
    assert compression_classifier.scored(docs, model).columns == ["doc_id", "text", "score", "predicted"]
    none = compression_classifier.train(docs, labels.limit(0))
    assert {r.score for r in compression_classifier.scores(docs, none).collect()} == {0.5}
    assert compression_classifier.scores(docs.limit(0), model).count() == 0


def test_classifier_sample_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(0, f"text {k}") for k in range(300)] + [(k, f"{k} " + "x" * 200_000) for k in range(1, 60)] + [(k, f"short {k}") for k in range(60, 90)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(0, 1), (0, 1), *((k, 1) for k in range(1, 60)), *((k, 0) for k in range(60, 90))], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(compression_classifier, "fit", lambda rows, shares, size: seen.extend(rows))
    compression_classifier.train(docs, labels, max_class_bytes=1_000_000)
    texts = [t for label, t, _ in seen if label == 1]
    assert sum(map(len, texts)) <= 1_000_000 and sum(t.startswith("text") for t in texts) <= 1 and sum(label == 0 for label, _, _ in seen) > 10


@pytest.fixture(scope="module")
def coder():
    vocabulary = bpe.Vocabulary(bpe.default_vocabulary())
    return bpe.Encoder(vocabulary, bpe.compile_lexicon(vocabulary, ["the", "there", "their", "and", "hand", "é"]))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


PARTS = ["a", "b", "'s", " ", "  ", "\n", "\t", "\r\n", "é", "²", "Ⅷ", "٣", "\x1c", "\x85", "\xa0", "　", "日本", "😀", "'ll", "'", "!", "<|endoftext|>", "_", "Z", "the", " hand", "​", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join) | st.text(max_size=30))
def test_bpe_equals_library(coder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert coder.ids(text) == want
    assert [[int(i) for c in chunks for i in c[0].split(",")] for chunks in coder.encode_all([text, None, text + "é"])][:2] == [want, []]
    assert coder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_bpe_long_words(coder, library):
    for text in ("a" * 5000, "ab" * 3000 + "é" * 1000, " " * 1000 + "x", "thequickbrown" * 300):
        assert coder.ids(text) == library.encode(text, add_special_tokens=False).ids


def test_transducer():
    random.seed(1)
    entries = {bytes(random.choice(b"abc") for _ in range(random.randint(0, 7))): tuple(random.randint(0, 3) for _ in range(random.randint(0, 3))) for _ in range(800)}
    t = Transducer.from_bytes(compile_transducer(entries.items()))
    assert all(t.get(k) == list(v) for k, v in entries.items())
    assert all(t.get(k) is None for k in (b"zzz", b"abcabcab", b"d") if k not in entries)
    assert t.longest == max(map(len, entries)) and t.accepts([*entries, b"zzz"]).tolist() == [True] * len(entries) + [False]
    shared = Transducer.from_bytes(compile_transducer(((p + b"ending", (1,)) for p in (b"a", b"b", b"c", b"dd"))))
    assert shared.n_states == 9  # one path for the suffix, the first letters and the second d
    assert Transducer.from_bytes(compile_transducer([])).get(b"") is None


def test_bpe_frame(spark, library):
    texts = ["the cat. the  hat\nthe <|endoftext|> end", None, "", "é" * 3000, "the cat. the  hat\nthe <|endoftext|> end"]
    docs = spark.createDataFrame([(k if k else None, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    shipped = bpe.prepared(docs, bpe.default_vocabulary(), 100)
    rows = sorted(bpe.digests(docs, shipped).collect(), key=lambda r: r.doc_id or 0)
    for r, t in zip(rows, texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    encoded = bpe.encode(docs, shipped)
    assert sorted(r.text for r in bpe.decode(encoded, shipped).collect()) == sorted(t or "" for t in texts)
    assert bpe.digests(docs.limit(0), shipped).count() == 0


def test_lexicon_of_equally_frequent_words(spark):
    words = [f"w{k:02}" for k in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words) + "\nonce"), (3, "w59"), (4, None)], "doc_id long, text string")
    found = bpe.frequent_words(docs, 50)
    assert len({*found} & {*words}) == 50 and "w59" in found and bpe.frequent_words(docs, 100) == bpe.frequent_words(docs, 60) == words
    assert bpe.frequent_words(docs, 1) == ["w59"] and bpe.frequent_words(docs, 0) == []
    many = [(k, f"a{k % 20000} a{k % 20000} a{k % 20000}") for k in range(20000)] + [(-1, "top " * 5000)]
    assert len(bpe.frequent_words(spark.createDataFrame(many, "doc_id long, text string"), 700)) == 700
    assert bpe.frequent_words(docs.limit(0), 50) == []


NASTY = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "<", "[", "</s", " [/INST", "[ROLE] a [/ROLE] ", "\\\\<s>", "", " ", "[/TURN]", "é\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE] "]), st.sampled_from(NASTY) | st.text(max_size=12) | st.lists(st.sampled_from(NASTY), max_size=4).map("".join)), max_size=6))
def test_chat_round_trip(turns):
    text = chat_format.render(turns)
    assert chat_format.parse(text) == turns
    found = chat_format.located(turns)
    assert found.text == text and not found.rewrites
    assert [chat_format.parse_turn(text[a:b])[0] for a, b in found.spans] == turns


def test_chat_detects_rewriting():
    def rewriting(turns):
        last = max((k for k, t in enumerate(turns) if t[0] == "user"), default=-1)
        return "".join(("SYS " if k == last else "") + t[1] + ";" for k, t in enumerate(turns))

    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    found = chat_format.located(turns, rewriting)
    assert found.rewrites == [2] and found.text == rewriting(turns)
    far = lambda turns: ("long " if len(turns) > 4 else "") + "".join(t[1] for t in turns)
    assert chat_format.located([("user", "x")] * 6, far).rewrites == [4]


def test_chat_compares_whole_prefixes():
    late = lambda turns: ("rewritten " if len(turns) > 700 else "") + "".join(t[1] for t in turns)
    found = chat_format.located([("user", str(k)) for k in range(1000)], late)
    assert found.rewrites == [700] and found.text.startswith("rewritten ")
    rendered = []
    chat_format.located([("user", "x")] * 5000, lambda turns: rendered.append(len(turns)) or chat_format.render(turns))
    assert rendered[:17] == list(range(17)) and sum(rendered) < 10 * 5000 and 5000 in rendered


def test_chat_digests_of_a_rewriting_template(spark):
    def marked(turns):
        return chat_format.render([(r, t + ("!" if r == "user" and k == len(turns) - 1 else "")) for k, (r, t) in enumerate(turns)])

    frame = spark.createDataFrame([(1, 0, "assistant", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"), (2, 3, "user", "d")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256 is None, r.rewrites, r.checked_turns) for r in chat_format.digests(frame, marked).collect()}
    assert got == {1: (1, False, 0, 1), 2: (4, True, 2, 4)}
    assert {(r.rewrites, r.n_turns - r.checked_turns) for r in chat_format.digests(frame).collect()} == {(0, 0)}


def test_chat_long_conversation_in_bounded_memory(spark, monkeypatch):
    turns = [(1, k, "user" if k % 2 else "assistant", f"turn {k} " * 5) for k in range(3000)]
    run = chat_format.Incremental(chat_format.render, whole=20_000)
    for _, _, role, text in turns:
        assert chat_format.parse_turn(run.add((role, text)))[0] == (role, text)
    assert run.turns is None and len(run.recent) == 2 and run.checked == 256
    got = [tuple(r)[1:5] for r in chat_format.digests(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()]
    assert got == [chat_format.brute_force(turns)[1]]


def test_chat_frame(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, "z"), (2, 0, "", "y"), (2, 0, None, None), (2, 0, "", None), (2, 0, None, None), (3, 0, "assistant", "x" * 200_000), (3, 1, "assistant", NASTY[0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.digests(frame).collect()}
    assert got == chat_format.brute_force(rows)
    whole = {r.conv_id: r for r in chat_format.formatted(frame).collect()}
    assert "".join(whole[3].text[s.start : s.end] for s in whole[3].loss) == chat_format.escape("x" * 200_000) + chat_format.escape(NASTY[0])
    assert chat_format.digests(frame.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "user", "b")], "conv_id long, turn long, role string, text string")
    assert [(r.conv_id, r.n_turns) for r in chat_format.digests(nulls).collect()] == [(None, 2)]


def test_pages_with_anything_left_open_cost_their_length():
    """Each of these took the square of its length when tags were looked for anew from each bracket, or their elements climbed from each tag."""
    import time

    n = 20_000
    pages = {
        "tags": "<a " * 1_700_000, "quotes": "<a '" * n + '"', "ends": "</a '" * n, "both": "<a \"<b '" * n, "comments": "<!-" * n + "<!--x", "sections": "<div>" * n + "</section>" * n,
        "inline": "<b><div>" + "<i>" * n + "</b>" * n, "items": "<div>" * n + "<li>x" * n, "rules": "<i>" * n + "<hr>" * n + "x"}
    for name, page in pages.items():
        begun = time.process_time()
        html_extract.main_text(page)
        assert time.process_time() - begun < 5, name
    assert html_extract.main_text("<p>One tag is left <a href='open here, and the text goes on for a while, as it has to.") == "One tag is left <a href='open here, and the text goes on for a while, as it has to."


def test_tags_are_those_of_one_expression():
    import random
    import re

    whole = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
    rnd = random.Random(2)
    bits = ["<a", "</b", "<", "<!--", "-->", "<!x", "<?", ">", '"', "'", " x=", "/", "=", "t<", "y"]
    for _ in range(3000):
        page, at = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))), 0
        tags = html_extract.Tags(page)
        while m := whole.search(page, at):
            assert tags.next(at) == (m.start(), m.end(), m[1] or "", m[2], m[3] or ""), page
            at = m.end()
        assert tags.next(at) is None
