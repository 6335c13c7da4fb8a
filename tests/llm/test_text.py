"""Main text, toxicity, language model, URL verdicts."""

from __future__ import annotations

import html
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventmart.llm import html_diff, lm_score, queries, toxicity, url_filter
from eventmart.llm.common import table

SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"
AZ = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")

PAGE = """<html><body><header>Site</header><div id="sidebar">side</div><div class="cookie-notice">cookies</div><h1>T</h1>
<p>one <b>b</b><i>x</i>&amp; a &lt; b<br>two<p>three<div class="comments"><p>hi</p></div><form>f</form><ul><li>a<li>b</ul>
<script>if (a</b) "</p>"</script><style>p{}</style><!-- <p>no</p> --><p>1 < 2 &#x41;</p></body>"""


def test_blocks_of_a_page():
    assert html_diff.main_text(html_diff.lines_of(PAGE), None) == "T\n\none bx& a < b two\n\nthree\n\na\n\nb\n\n1 < 2 A"


def test_declared_article_is_whole():
    page = "<nav>m</nav><article><header><h1>T</h1></header><p>x</p><aside>s</aside></article><p>after</p>"
    lines = html_diff.lines_of(page)
    assert html_diff.main_text(lines, lines) == "T\n\nx"


def test_wrappers_do_not_hide_the_article():
    page = """<body class="has-sidebar comments-open"><div class="content with-sidebar"><main><nav>n</nav>
        <article class="post"><div class="article-header"><h1>T</h1></div><p>x<span class="ad">buy</span> y</p>
        <div class="share-buttons">s</div><div class="notice">n</div></article>
        <section id="comments"><ol><li><article class="comment-body">c</article></ol></section><p>in main</p></main></div></body>"""
    assert html_diff.main_text(html_diff.lines_of(page), None) == "T\n\nx y"
    assert html_diff.main_text(html_diff.lines_of("<p>out</p><main><p>in</p><div hidden>h</div></main>"), None) == "in"


def text_of(page):
    return html_diff.main_text(html_diff.lines_of(page), None)


ARTICLE = "<article><h1>T</h1><p>x y z</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><body>{ARTICLE}",
        f"<html><head><meta charset=utf-8><title>t</title>{ARTICLE}</html>",
        f"<head><title>t</title><a href=x></a>{ARTICLE}",
        f"<body><nav>menu{ARTICLE}</body>",
        f"<form><input name=q>{ARTICLE}",
        f"<footer>site{ARTICLE}<p>end",
        f"<div class=ad>buy{ARTICLE}</body>",
        f"<body><div class=page><div class=ad>buy{ARTICLE}</div></body>",
        f"<ul><li class=ad>buy</ul>{ARTICLE}",
    ],
)
def test_left_out_end_tags_do_not_hide_the_article(page):
    assert text_of(page) == "T\n\nx y z"


def test_left_out_end_tags_without_an_article():
    assert text_of("<head><title>t</title>Hello <b>you</b><p>x") == "Hello you\n\nx"
    assert text_of("<head><title>t</title><p>x<p>y") == "x\n\ny"
    assert text_of("<nav>menu<div><p>x</div>") == "menu\n\nx"  # where it ends is not said: no line is lost
    assert text_of("<nav>menu</nav><ul><li class=ad>buy<li>x</ul>") == "x"


def test_closed_elements_still_hide_an_article():
    for around in ("<nav>{}</nav>", "<aside>{}</aside>", "<div class=related>{}</div>", "<section id=comments>{}</section>"):
        assert text_of("<p>own</p>" + around.format(ARTICLE)) == "own"


def test_a_card_does_not_hide_the_page():
    card, story = "<article><p>card one</p></article>", "<p>a long story of</p><p>many more words</p>"
    all_lines = "a long story of\n\nmany more words\n\ncard one"
    assert text_of(f"<main>{story}{card}</main><p>out</p>") == all_lines
    assert text_of(f"{story}{card}") == all_lines
    assert text_of("<p>長い記事の本文です。</p><article>短い</article>") == "長い記事の本文です。\n\n短い"
    menu = "<div>Home</div><div>About us all</div>"
    pages = [html_diff.lines_of(menu + x) for x in (story + card, "<p>other words of the second page</p>" + card, "<article>new</article>")]
    assert html_diff.main_text(pages[0], pages[1]) == all_lines
    assert html_diff.main_text(pages[1], pages[0]) == "other words of the second page\n\ncard one"
    assert html_diff.main_text(pages[2], pages[1]) == "new"
    assert html_diff.main_text(pages[0], pages[0]) == "Home\n\nAbout us all\n\n" + all_lines


def test_shared_lines_of_unmarked_pages_go(spark):
    site = "<div>Home</div><div>About us</div>{}<div>All rights</div>"
    rows = [
        (1, "http://a.org/x/1", site.format("<p>first story</p><p>more</p>")),
        (2, "http://a.org/x/2", site.format("<p>second story</p>")),
        (3, "http://b.org/x/2", site.format("<p>alone here</p>")),
        (4, None, None),
        (5, "http://a.org/x/3", ""),
        (None, "no url", "<p>x</p>"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in html_diff.extract(frame.withColumn("text", F.lit("clash"))).collect()}
    assert got[1] == "first story\n\nmore" and got[2] == "second story"
    assert got[3] == "Home\n\nAbout us\n\nalone here\n\nAll rights"
    assert got[4] == got[5] == "" and got[None] == "x"


@pytest.mark.parametrize("one,other", [("abcbdab", "bdcaba"), ("", "abc"), ("aaaa", "aa"), ("xyz", "abc"), ("abcabcabc", "cbacba")])
def test_longest_common_subsequence(one, other):
    best = [[0] * (len(other) + 1) for _ in range(len(one) + 1)]
    for i, x in enumerate(one):
        for j, y in enumerate(other):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    places = sorted(html_diff.shared_lines(list(one), list(other)))
    assert len(places) == best[-1][-1]
    rest = iter(other)
    assert all(one[i] in rest for i in places)


def test_pages_table(spark):
    """Every page of the table declares its article: its text is the article's blocks."""
    rows = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in queries.op1(spark, SF).collect()}
    assert set(got) == set(rows)
    for page_id, source in rows.items():
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"<p>|</p>|</?h1>", article)]
        assert got[page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[page_id].n_chars == len(got[page_id].text)


@pytest.fixture(scope="module")
def model(spark):
    labels, docs = table(spark, "/root/testdata/sf0.1", "labels"), table(spark, "/root/testdata/sf0.1", "documents")
    return toxicity.train(docs, labels, learned=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0, per_label=500)


def test_toxicity_on_held_out_texts(spark, model):
    d = "/root/testdata/sf0.1"
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = toxicity.toxicity(table(spark, d, "documents"), model).where(held).join(table(spark, d, "labels"), "doc_id").collect()
    toxic, clean = [r.score for r in scored if r.toxic == 1], [r.score for r in scored if r.toxic == 0]
    assert np.mean([s >= 0.5 for s in toxic]) > 0.75
    assert np.mean([s >= 0.5 for s in clean]) < 0.04


def test_toxicity_tolerates_disguise(model):
    judge = toxicity.Judge(model)
    texts = ["the and of idiot ti", "the i d i o t and", "the i.d.i.o.t ou", "wo-rth-less onea", "the and of tion ti", "", None, "ab", " "]
    scores = model.probability(judge.texts(pa.array(texts)))
    assert (scores[:4] >= 0.5).all() and (scores[4:] < 0.5).all()
    assert len(set(scores[5:].round(12))) == 1  # no evidence at all
    gapped = judge.texts(pa.array(["patheXtic", "thereation"]))
    assert gapped[0] > gapped[1]


def test_kernel_counts_gapped_subsequences():
    words = [b"abcd", b"abxcd", b"dcba", b"abab"]
    gram = toxicity.Landmarks(words).kernel(toxicity.spelled(words)[0])
    assert np.allclose(np.diag(gram), 1, atol=1e-5)
    assert gram[0, 1] > 0.2 > gram[0, 2] and np.allclose(gram, gram.T, atol=1e-5)


def test_toxicity_edges(spark, model):
    rows = [(1, None), (None, "idiot"), (2, "x " * 50_000 + "idiot"), (2, "x " * 50_000 + "idiot")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = toxicity.toxicity(frame, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert all(r.score >= 0.5 for r in got if r.doc_id != 1)
    assert toxicity.drop_toxic(frame, model).columns == frame.columns
    assert [r.doc_id for r in toxicity.drop_toxic(frame, model).collect()] == [1]
    none = frame.limit(0)
    assert toxicity.toxicity(none, model).count() == 0
    assert toxicity.fit([]).probability(np.array([0.0]))[0] < 0.5
    assert toxicity.fit([("a b c", 0)]).probability(np.array([0.0]))[0] < 0.5


def tokens_of(text):
    return WORD.findall((text or "").translate(AZ)) + [None]


def brute_model(rows, bits=None):
    """(counts, N, V) and a scorer with given weights, straight from the definition."""
    train = [tokens_of(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    one, two = Counter(w for d in train for w in d), Counter(p for d in train for p in zip([None, *d[:-1]], d))
    return one, two


def test_language_model(spark, monkeypatch):
    """Counts and base scores by brute force; scores by brute force with the learned weights."""
    learned = {}

    def kept(cells):
        learned["weights"] = original(cells)
        return learned["weights"]

    original = lm_score.learn
    monkeypatch.setattr(lm_score, "learn", kept)
    monkeypatch.setattr(lm_score, "BUCKET_KEYS", 5_000)
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 60_000)
    got = {r.doc_id: r for r in queries.op8(spark, SMALL).collect()}
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    one, two = brute_model(rows)
    n, v = sum(one.values()), len(one)
    weights = learned["weights"]
    assert set(got) == {i for i, _ in rows}
    for i, text in rows:
        tokens, r = tokens_of(text), got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(t in one for t in tokens), n)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(sum(math.log10((one[t] + 1) / (n + v + 1)) for t in tokens))
        total = 0.0
        for before, t in zip([None, *tokens[:-1]], tokens):
            context = one[before]
            w = weights[min(math.frexp(context)[1], lm_score.LEVELS - 1)]
            total += math.log10((w[0] * two[before, t] / context if context else 0) + w[1] * one[t] / n + w[2] / (v + 1))
        assert r.score == pytest.approx(total)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_edges(spark):
    rows = [(1, None), (None, ""), (2, "a b"), (2, "a b"), (3, "x" * 300_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("train", F.lit("clash"))
    got = lm_score.lm_scores(frame, train=F.lit(True), tune=F.lit(False)).collect()
    assert len(got) == 5 and all(r.train_tokens == 1 + 1 + 3 + 3 + 2 for r in got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    unseen = lm_score.lm_scores(frame, train=F.lit(False), tune=F.lit(True)).collect()
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in unseen)
    assert lm_score.lm_scores(frame.limit(0), F.lit(True), F.lit(True)).count() == 0


def test_packed_keys_and_counts_come_back():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**48, 5000, dtype=np.uint64))
    assert (lm_score.unpack_keys(lm_score.pack_keys(keys)) == keys).all()
    counts = np.array([0, 1, 254, 255, 256, 10**9])
    assert (lm_score.unpack_counts(lm_score.pack_counts(counts)) == counts).all()
    assert (lm_score.counts_of(lm_score.planes(counts)) == counts).all()


URLS = [
    "http://a.example.org/es/1", "https://example.org/en/123", "https://badexample.org/en/123", "http://x.org", "http://x.org/",
    "http://shop.com/fr/1", "http://shop.com/de/1", "http://www.casino-win.example.com/en/1", "https://www.library.example.com/en/12",
    None, "", "no scheme", "HTTP://EXAMPLE.ORG/ES/1", "http://example.org/es", "http://h?x=/org/", "http://é.COM/fr/x?y#z", "a://b://c/d",
]


def test_url_verdicts_against_brute_force(spark):
    bias, weights = url_filter.train(spark)
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("rule", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.url_filter(frame).collect()}
    for i, url in enumerate(URLS):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(AZ)
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        framed = f"^{host}|{path}$"
        grams = {framed[k : k + n] for n in url_filter.SIZES for k in range(max(1, len(framed) - n + 1))}
        margin = bias + sum(weights[zlib.crc32(g.encode()) % url_filter.BUCKETS] for g in grams) / math.sqrt(max(1, len(grams)))
        rule, verdict = (max(fits)[1], max(fits)[2]) if fits else (None, "block" if margin >= 0 else "allow")
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), url
    assert got[7].verdict == "block" and got[8].verdict == "allow"
    assert url_filter.url_filter(frame.limit(0)).count() == 0


def test_url_model_knows_its_labels(spark):
    rows = spark.createDataFrame(list(url_filter.LABELLED), "url string, label int")
    got = url_filter.url_filter(rows, rules=()).collect()
    assert all((r.verdict == "block") == (r.label == 1) for r in got)


def test_kernel_by_definition():
    """The kernel of two words: products of the decayed counts of their common gapped subsequences, normalised."""
    from itertools import combinations

    def features(codes):
        found = {}
        for places in combinations(range(len(codes)), toxicity.LETTERS):
            span = places[-1] - places[0] + 1
            if span <= toxicity.SPAN:
                key = tuple(codes[i] for i in places)
                found[key] = found.get(key, 0.0) + toxicity.DECAY**span
        return found

    words = [b"idiot", b"idxiot", b"idiots", b"kitten", "čeština".encode(), "дурак".encode(), "日本語文字列".encode()]
    windows, of = toxicity.spelled(words)
    machine = toxicity.Landmarks(words)
    letters = [features([c for c in row if c]) for row in windows.tolist()]
    dot = lambda a, b: sum(v * b.get(k, 0.0) for k, v in a.items())
    want = [[dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5 for b in letters] for a in letters]
    assert of.tolist() == list(range(len(words)))
    assert np.allclose(machine.kernel(windows), want, atol=1e-5)


def test_letters_of_all_scripts_count():
    windows, of = toxicity.spelled(["日本語文字".encode(), "漢字日語本".encode(), "дурак".encode(), "добро".encode(), "、。😀！".encode()])
    assert of.tolist() == [0, 1, 2, 3]
    assert len({tuple(row) for row in windows.tolist()}) == 4


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ('<section id="discussion"><p>one two</p></section>', "one two"),
        ('<p id="share-prices">prices</p>', "prices"),
        ('<p class="no-ads">none</p>', "none"),
        ('<h2 id="related-work">Related work</h2>', "Related work"),
        ('<h2 id="navigation-systems">Navigation</h2>', "Navigation"),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p>", "Let x=1 be."),
        ("<p title=it's>We don't know why</p><p>more</p>", "We don't know why\n\nmore"),
        ('<p title="abc>some text</p>', "some text"),
        ("<select>x<p>after</p>", "x\n\nafter"),
        ("<svg><p>after</p>", "after"),
        ('<p>See <span class="ad"><span>buy</span> CHEAP</span> this</p>', "See this"),
        ('<div class="related-links">other</div><p>own</p>', "own"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
    ],
)
def test_no_text_of_an_article_is_lost(inner, want):
    lines = html_diff.lines_of(f"<html><body><article>{inner}</article></body></html>")
    assert html_diff.main_text(lines, None) == want


@pytest.mark.parametrize("unit", ["<b ", "<span class=ad>", "<svg>", '<b a="', "<!-- ", "<p a='", '<p title="', "<", "<a href=", "</p "])
@pytest.mark.parametrize("end", ["", ">"])
def test_tags_are_scanned_once(unit, end):
    """Broken tags by the ten thousands take a moment, not time that grows with their square."""
    started = time.time()
    html_diff.lines_of(unit * 50_000 + end)
    assert time.time() - started < 5
