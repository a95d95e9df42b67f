"""Token counts, licence scans and HTML extraction against plain loops and written pages."""

import re

import pytest

from logloom.llm import article, licences, wordpiece


def greedy(pieces, word):
    word, n, at = b" " + word, 0, 0
    longest = max(map(len, pieces), default=0)
    while at < len(word):
        end = next((j for j in range(min(len(word), at + longest), at, -1) if word[at:j] in pieces), None)
        if end is None:
            return None
        n, at = n + 1, end
    return n


def test_token_counts(spark, docs, no_docs):
    pieces = set(wordpiece.word_pieces(wordpiece.read_model(wordpiece.MODEL)))
    got = sorted(map(tuple, wordpiece.token_counts(docs).collect()), key=repr)
    want = []
    for r in docs.collect():
        each = [greedy(pieces, w) for w in (r.text or "").encode().split()]
        tokens = [n or 1 for n in each]
        want.append((r.doc_id, len(each), sum(tokens), each.count(None), max(tokens, default=0)))
    assert got == sorted(want, key=repr)
    assert wordpiece.token_counts(no_docs).count() == 0


@pytest.mark.parametrize("pieces", [
    [b" a", b"b", b"abc", b"bcd", b" ab", b"cd", b"d", b"a", b"c"], [b" ", b"aa", b"aab", b"a", b"b"], [b" abcab", b" ab", b"cab", b"c", b"abd"],
    [b"a"], []])
def test_automaton_is_greedy(pieces):
    import itertools

    import numpy as np
    import pyarrow as pa

    from logloom.llm.flat import blocks
    words = [bytes(w) for n in range(1, 6) for w in itertools.product(b"abcd", repeat=n)]
    texts = next(blocks(pa.array(words, pa.binary())))[2]
    got = wordpiece.Automaton(pieces).lengths(texts, texts.offsets[:-1], texts.offsets[1:])
    assert np.array_equal(got, [greedy(set(pieces), w) or 0 for w in words])


def scan(text):
    """Base phrases by plain Python."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = licences.words_of(lower)
    at = [(i, label) for p, label in licences.BASE_PHRASES.items() for i in range(len(words))
          if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return (len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))


def test_licence_scan(spark, docs, no_docs):
    texts = [r.text for r in docs.collect()]
    texts += ["x MIT License, MIT License apache\tlicense", "GNU General Public License version 3",
              "pre " + licences.TEMPLATES["bsd"][0].upper() + " post",
              licences.TEMPLATES["bsd"][0].replace("source and binary forms", "source or binary forms"),
              licences.TEMPLATES["isc"][0].replace("modify", "change"), "mit licenses", "é mit license"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.scanned(df).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == scan(text), text
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    n = len(texts) - 7
    assert "bsd" in rows[n + 2].labels and rows[n + 2].score == 1
    assert rows[n + 3].labels == "" and rows[n + 4].labels == "isc" and 0.9 < rows[n + 4].score < 1
    assert licences.scanned(no_docs).count() == 0


PAGES = {
    "article": ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>Home, sweet, home</a></nav>"
                "<article><h1>Head &amp; line</h1><p>First, with\n  some <b>bold</b>&nbsp;text in it.<p>Second one</article>"
                "<aside><p>Side, text, that, has, many, commas, and, is, long.</p></aside><footer>&copy;</footer></body>",
                "Head & line First, with some bold text in it. Second one"),
    "div": ('<body><div id="cookie-notice">We use cookies, sorry, and more cookies.</div><div class="post-body">'
            "<h2>A</h2><p>Some long paragraph, with commas, that is the article of this page.</p><ul><li>x</li><li>y</li></ul>"
            '<div class="share-buttons">Share</div><form><p>Mail?</p></form></div><div class="comments"><p>I, for one, think, '
            "that comments, as long as this one, are not the article, whatever they say, and whoever says it.</p></div></body>",
            "A Some long paragraph, with commas, that is the article of this page. x y"),
    "scripts": ('<script>var a = "<p>no</p>";</script><p>Only a paragraph of some length here.</p><noscript>no</noscript>',
                "Only a paragraph of some length here."),
    "cut": ("<article><p>Cut in the middle of an ent&am", "Cut in the middle of an ent&am"),
    "cut tag": ("<article><p>Cut in the middle of a tag <a hre", "Cut in the middle of a tag"),
    "comment": ("<!-- <p>no</p> --><p>Yes, this is it.</p><!-- open", "Yes, this is it."),
    "comment article": ("<article><p>The article, which is long enough, and has commas.</p></article>"
                        '<article class="comment"><p>A comment, which is longer, much longer, and has, more, commas.</p></article>',
                        "The article, which is long enough, and has commas."),
    "plain": ("just text", "just text"), "empty": ("", ""), "null": (None, ""), "markup only": ("<div><br></div>", ""),
    "entities": ("<p>&lt;p&gt; &#233;&#x41; &amp;amp;</p>", "<p> éA &amp;"),
    "split": ("<div><div><p>One, two, three, four, five and more text.</p></div><div><p>Another, block, of, the, same, text.</p></div></div>",
              "One, two, three, four, five and more text. Another, block, of, the, same, text."),
    "br": ("<p>one<br>two<br/>three, and so on and on</p>", "one two three, and so on and on"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert article.main_text(page) == want


def test_pages(spark):
    rows = [(i, "u", page, "x") for i, (page, _) in enumerate(PAGES.values())] + [(None, None, None, None)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in article.extracted(df).collect()}
    assert got == {i: (want, len(want)) for i, (_, want) in enumerate(PAGES.values())} | {None: ("", 0)}
    assert article.extracted(df.limit(0)).count() == 0
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in article.extracted(given).join(given.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        import html
        plain = html.unescape(re.sub(r"</?(p|h1|br)>", " ", inner.replace("<b>", "").replace("</b>", "")))
        assert r.text == " ".join(plain.split())


PARAGRAPH = "<p>" + "One, two, three, four, and " + "more words " * 25 + "of row {}.</p>"


def test_parts_of_an_article_without_article_element():
    rows = ["".join(PARAGRAPH.format(f"{row} {k}") for k in range(5)) for row in "ab"]
    page = ('<body><div class="links"><a href="/">Home</a> <a href="/b">The archive of all the years</a></div><h4>Head</h4>'
            '<div class="content">' + "".join(f'<div class="row"><div class="col">{row}</div></div>' for row in rows)
            + "<dl><dt>Key</dt><dd>value</dd></dl><div><p>Short.</p></div>bare <em>text</em><section><h5>End</h5></section>"
            "<ul><li><a>Sign in to this wonderful site</a></li><li><a>Top</a></li></ul></div></body>")
    want = " ".join(re.sub("<.*?>", " ", "Head" + "".join(rows)).split())
    assert article.main_text(page) == want + " Key value Short. bare text End"
    # Without any wrapper, and beside a much better container.
    page = f"<body><h1>Head</h1><div><div>{rows[0]}</div></div><div><div><p>A last word, far from the rest.</p></div></div></body>"
    want = " ".join(re.sub("<.*?>", " ", "Head " + rows[0]).split())
    assert article.main_text(page) == want + " A last word, far from the rest."
    # Article elements that are not siblings.
    page = "<body>" + "".join(f"<div><article>{row}</article></div>" for row in rows) + "</body>"
    assert article.main_text(page) == " ".join(re.sub("<.*?>", " ", "".join(rows)).split())


ARTICLE = "<h1>Head</h1>" + PARAGRAPH.format(1) + PARAGRAPH.format(2)
TEASER = "<p>Some other page, with a text that is no part of this one.</p>"


@pytest.mark.parametrize("page", [
    '<body><form action="x"><input value="v"><label>Find</label>{}<button>Go</button><select><option>o</select></form></body>',
    '<body><div class="sidebar-open"><div class="ad">Buy, buy, buy all of the things, all of them.</div>{}</div></body>',
    '<body><div class="menu-right"><div class="menu-item"><p>Menu</p></div><article>{}</article></div></body>',
    f'<body><div class="legal-opinion">{{}}</div><div class="x-related">{TEASER}</div></body>',
    '<body><form class="menu-open"><div class="popular-science"><div class="text">{}</div></div></form></body>',
    '<body><article class="trending-story">{}</article><div class="cookie-notice">' + 9 * PARAGRAPH + "</div></body>",
    '<body><div class="overlay"><div class="content">{}</div></div><div class="trending">' + TEASER + "</div></body>",
    # As before: what stands beside the article, or in it, stays out.
    '<body><div class="post">{}</div><div class="related-stories">' + 9 * PARAGRAPH + "</div></body>",
    '<body><div class="post">{}<form>' + TEASER + '</form></div><div class="comments"><article>' + 9 * PARAGRAPH
    + "</article></div></body>",
    '<body><div>{}</div><div class="comments-list">' + 9 * PARAGRAPH + '</div><div class="ad-1">' + 9 * PARAGRAPH + "</div></body>",
    f'<body><article>{{}}<div class="related-posts">{TEASER}</div></article></body>',
])
def test_boilerplate_names_around_the_article(page):
    assert article.main_text(page.replace("{}", ARTICLE, 1)) == " ".join(re.sub("<.*?>", " ", ARTICLE).split())


FIVE = "".join(PARAGRAPH.format(k) for k in range(5))
NOTICE = "<p>" + "We, our partners, and others, " + "store some data " * 15 + "here.</p>"


@pytest.mark.parametrize("block", [
    '<div id="onetrust-banner-sdk">{}</div>', "<div>{}</div>", '<div class="read-next">{}</div>', '<div id="user-responses">{}</div>',
    '<div class="site-info">{}</div>', '<section class="box"><div class="inner">{}</div></section>', "<table><tr><td>{}</td></tr></table>"])
@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("frame", ["{}", '<div class="wrap">{}</div>', '<div class="page-x"><div id="outer">{}</div></div>'])
@pytest.mark.parametrize("article_text", [
    FIVE, f'<div class="col">{FIVE}</div><div class="col">{FIVE}</div>', f"<div><div>{FIVE}</div></div><div><p>Short</p></div>"])
def test_blocks_beside_the_article_go_by_score(block, before, frame, article_text):
    block, text = block.format(NOTICE), f'<div class="content"><h1>Head</h1>{article_text}</div>'
    page = "<body>" + frame.format(block + text if before else text + block) + "</body>"
    assert article.main_text(page) == " ".join(re.sub("<.*?>", " ", text).split())


@pytest.mark.parametrize("frame", ["<body>{}</body>", '<body><div class="row">{}</div></body>', "<body><div><div>{}</div></div></body>"])
def test_three_unequal_columns(frame):
    for name in ("col {}", "col-{}", ""):
        columns = [f'<div class="{name.format(i)}">' + FIVE[:n * len(PARAGRAPH.format(0))] + "</div>" for i, n in enumerate((5, 2, 1), 1)]
        columns = [c.replace(' class=""', "") for c in columns]
        want = " ".join(re.sub("<.*?>", " ", "".join(columns)).split())
        for order in (columns, columns[::-1]):
            want = " ".join(re.sub("<.*?>", " ", "".join(order)).split())
            assert article.main_text(frame.format("".join(order))) == want
            if name:
                box = f'<div class="box">{NOTICE}</div>'
                assert article.main_text(frame.format(box + "".join(order) + box)) == want


def test_lead_and_headings_beside_the_article():
    text = f'<div class="story-text">{FIVE}</div>'
    head = '<h1>Head</h1><p class="by">By one</p>'
    for lead in ('<div class="intro">{}</div>', "{}"):
        page = f'<body><div id="box">{NOTICE}</div>{head}{lead.format(PARAGRAPH)}{text}<div id="box2">{NOTICE}</div></body>'
        assert article.main_text(page) == " ".join(re.sub("<.*?>", " ", head + PARAGRAPH + text).split())
    # Paragraphs of the body itself, a quotation between them, a notice behind them.
    quote = f"<blockquote>{PARAGRAPH}</blockquote>"
    page = f'<body><div id="top">{NOTICE}</div>{head}{FIVE}{quote}<p>Short end.</p><div class="low">{NOTICE}</div></body>'
    want = " ".join(re.sub("<.*?>", " ", head + FIVE + quote).split())
    assert article.main_text(page) in (want, want + " Short end.")


@pytest.mark.parametrize("name", ["read-next", "user-responses"])
def test_named_blocks_inside_the_article_go(name):
    text = f'<article>{{}}{FIVE}</article>'
    assert article.main_text(text.format(f'<div class="{name}">{NOTICE}</div>')) == article.main_text(text.format(""))


def test_boilerplate_alone_stays_out():
    for name in ("comments", "cookie-notice", "sidebar"):
        assert article.main_text(f'<body><p>Hi.</p><div class="{name}">{TEASER}</div></body>') == "Hi."
    nested = '<div class="menu-x">' * 3000 + TEASER + "</div>" * 3000
    assert article.main_text(nested) == re.sub("<.*?>", "", TEASER)


def test_deep_nesting_and_long_pages():
    deep = "<div>" * 5000 + "<p>Deep down, there is a paragraph, with text.</p>" + "</div>" * 5000
    assert article.main_text(deep) == "Deep down, there is a paragraph, with text."
    long = "<article>" + "<p>word, word and word again.</p>" * 5000 + "</article>"
    assert article.main_text(long).count("again.") == 5000
