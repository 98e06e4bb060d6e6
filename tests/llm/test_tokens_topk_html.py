"""Token counts against the tokenizer library, exact top-k against brute force, main text of pages."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from recengine.llm import html_text, topk
from recengine.llm.token_counts import BytePairCounter, count_tokens
from recengine.llm.topk import top_k

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "a<|endoftext|>b <|endoftext|>  x", "<|endoftext|>", "<|endo", " " * 50 + "x\n\n \t y",
         "a\x1cb \x1f \x85 ​z'll I'Ll don't", "x" * 5000, "日本語 テキスト 🎉🎉 ١٢٣ ²½ ǅ", "Ähnlich à é ê\xa0ö", "a a", "a a"]


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_counts_equal_the_library():
    own = BytePairCounter(PATH)
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abc deé\n'st 12ß!?  ñ中") for _ in range(rng.randrange(200))) for _ in range(300)]
    assert [own.count(t) for t in texts] == library(texts)


def test_remembered_pieces_are_bounded(monkeypatch):
    import recengine.llm.token_counts as T

    monkeypatch.setattr(T, "REMEMBERED", 5)
    own = BytePairCounter(PATH)
    texts = ["one two three four five six seven eight nine ten", "x" * 400 + " one", "two " * 100]
    assert [own.count(t) for t in texts] == library(texts)
    monkeypatch.setattr(T, "STREAM_CHARS", 10)
    assert [own.count(t) for t in texts] == library(texts)


def test_token_columns(spark):
    df = spark.createDataFrame([(i, t, "kept", -1) for i, t in enumerate(TEXTS)], "doc_id long, text string, extra string, n_tokens int")
    rows = {r["doc_id"]: r for r in count_tokens(df, PATH, limit=2).collect()}
    expected = library(TEXTS)
    for i, t in enumerate(TEXTS):
        assert rows[i]["n_tokens"] == expected[i]
        assert rows[i]["n_bytes"] == len((t or "").encode())
        assert rows[i]["over_limit"] == (expected[i] > 2) and rows[i]["extra"] == "kept"
    assert count_tokens(df.limit(0), PATH).count() == 0


def brute_top_k(rows, k, scale=1024.0):
    ok = []
    for at, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ok.append((at, i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    out = []
    for at, i, q in ok:
        if i % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for o, j, v in ok if o != at and len(v) == len(q))[:k]
            out += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "ties", "few", "wide"])
def test_top_k_equals_brute_force(spark, case):
    rng = np.random.default_rng(3)
    if case == "random":
        rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    elif case == "ties":  # one vector makes up most rows
        rows = [(int(i), [0.5, -0.25]) if i % 4 else (int(i), [float(x) for x in rng.normal(size=2)]) for i in range(500)]
    elif case == "few":
        rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [9.0, 9.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
                (6, [float("inf"), 0.0]), (7, []), (100, [-1.0, 0.5]), (8, [1.0, 2.0, 3.0])]
    else:
        rows = [(int(i), [float(x) for x in rng.normal(size=4) * 3e4]) for i in range(150)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(5)
    got = sorted(tuple(r) for r in top_k(df, F.col("id") % 100 == 0, k=10).collect())
    assert got == brute_top_k(rows, 10)


def test_top_k_of_huge_numbers(spark):
    rows = [(0, [1e17, 1.0]), (1, [1e17, 2.0]), (2, [-1e30, 5.0]), (3, [1e-3, 1.0]), (4, [3e38, 3e38]), (5, [2e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in top_k(df, F.col("id") % 100 == 0, k=10).collect())
    most = 2 ** 62 - 1
    exact = {j: sum(int(np.floor(1024 * float(np.float32(a)))) * int(np.floor(1024 * float(np.float32(b)))) for a, b in zip(rows[0][1], v)) for j, v in rows[1:]}
    clipped = sorted((-max(-most, min(most, x)), j) for j, x in exact.items())
    assert got == [(0, n + 1, j, -x) for n, (x, j) in enumerate(clipped)]


def test_top_k_by_slices_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 300)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(4)
    rows = [(int(i) * 20, [float(x) for x in rng.normal(size=4)]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert sorted(tuple(r) for r in top_k(df, F.col("id") % 100 == 0, k=5).collect()) == brute_top_k(rows, 5)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("id") % 100 == 0).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li></ul></nav>
<div class="cookie-notice">We use cookies <button>OK</button></div><!-- <p>gone</p> -->
<article><header><h1>Title &amp; more</h1></header><p><b>First&nbsp;para&#103;raph
 with   space.<br><p>Second <a href="#">link</a> &copy; text.<div class="share">Share this</div></p><ul><li>One<li>Two</ul>
<section id="comments"><p>Nice article!</p></section></article>
<aside><p>Read this long sidebar with many words in it please.</p></aside><form><label>Mail</label><input></form>
<div class="ad">Buy now and save.</div><footer>&copy; 2024</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "Title & more\n\nFirst paragraph with space.\n\nSecond link © text.\n\nOne\n\nTwo"


def test_main_text_without_article():
    page = ("<body><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul><h2>Heading words here</h2>"
            "<p>" + "word " * 40 + "</p><p>" + "other " * 30 + "</p><ul><li><a href=x>More</a></li><li><a href=y>Links</a></li></ul></body>")
    text = html_text.main_text(page)
    assert text.startswith("Heading words here\n\nword word") and "Home" not in text and "Links" not in text


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), ("plain  words", "plain words"), ("<p>a", "a"), ("<!-- x", ""),
                                        ("<script>x", ""), ("<article><p>x < y &lt; z</p>", "x < y < z"), ("a<br>b", "a b")])
def test_main_text_of_odd_pages(page, text):
    assert html_text.main_text(page) == text


def splits(node):
    return set() if not isinstance(node, tuple) else {html_text.FEATURES[node[0]]} | splits(node[2]) | splits(node[3])


def test_tree_splits_on_words_and_neighbours():
    used = splits(html_text.tree())
    assert {"words", "links", "aside"} <= used and used & {"links_before", "words_before"} and used & {"links_after", "words_after"}


@pytest.mark.parametrize("page", [
    '<div class="layout with-sidebar"><article><p>Words of it.</p></article></div>',
    '<div class="search-page"><main><p>Words of it.</p></main></div>',
    '<div id="page" class="has-banner"><article><p>Words of it.</p></article></div>',
    '<article><section class="social-history"><p>Words of it.</p></section></article>',
    '<form action="/"><div class="sidebar"><main><p>Words of it.</p></main></div></form>',
    '<div class="widget no-ads"><article><p>Words of it.</p></article></div>'])
def test_wrappers_do_not_hide_the_article(page):
    assert html_text.main_text(page) == "Words of it."


@pytest.mark.parametrize("page, text", [
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be.</p></article>", "Let x=2 be."),
    ("<article><p>Press <button>OK</button> now.</p></article>", "Press OK now."),
    ('<div class="comments"><article><p>Nice!</p></article></div><article><p>Text.</p></article>', "Text."),
    ('<main><p>Text.</p><div class="share-buttons">Share</div><ul class="related-posts"><li>More</ul></main>', "Text."),
    ('<section class="related"><article><p>Other</p></article></section>', "")])
def test_parts_inside_and_around_articles(page, text):
    assert html_text.main_text(page) == text


def made_page(rng):
    """(page, main text) without any telling name: what is text follows from how the page was made."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    links = lambda n: "".join(f"<li><a href='/{word()}'>{words(1, 3)}</a></li>" for _ in range(n))
    text, body = [], []

    def say(tag, t):
        text.append(t)
        body.append(f"<{tag}>{t}</{tag}>")

    say("h1", words(4, 10))
    for _ in range(rng.randint(2, 6)):
        say("p", words(30, 90))
        if rng.random() < 0.4:
            say("p", words(3, 9))
            say("p", words(30, 70))
        if rng.random() < 0.3:
            say("h2", words(2, 5))
            say("div", words(25, 60))
    top = rng.choice(["", f"<div>{words(8, 17)}</div>"])
    menu, foot = f"<ul>{links(rng.randint(3, 7))}</ul>", f"<ul>{links(rng.randint(2, 5))}</ul><div>{words(4, 12)}</div>"
    style = rng.choice(["soup", "article", "wrapped"])
    main = "".join(body)
    if style == "article":
        main = f"<article>{main}</article>"
    if style == "wrapped":
        main = f"<div class='layout with-sidebar'><main>{main}</main></div>"
    return f"<html><head><title>{word()}</title></head><body>{top}{menu}<div>{main}</div>{foot}</body></html>", "\n\n".join(text)


def test_made_pages_give_their_text_back():
    rng = random.Random(4)
    pages = [made_page(rng) for _ in range(300)]
    wrong = [p for p, t in pages if html_text.main_text(p) != t]
    assert len(wrong) <= 0.01 * len(pages), wrong[0]


def test_tree_learns_its_table():
    rows = html_text.labelled_table()
    assert all(html_text.is_main(x) == bool(y) for x, y in rows)


def test_html_columns(spark):
    rows = [(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (2, None, None, None), (3, "v", "<p>" + "w " * 100_000 + "</p>", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.extract_text(df).orderBy("page_id").collect()
    assert out[0] == out[1] and out[0]["n_chars"] == len(out[0]["text"])
    assert out[2]["text"] == "" and out[2]["n_chars"] == 0 and out[3]["n_chars"] == 199_999
    assert html_text.extract_text(df.limit(0)).count() == 0
