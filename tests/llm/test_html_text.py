"""Operator 11: cuts against brute force, pages of several shapes, malformed markup."""

import itertools
import random
import time

from pyspark.sql import functions as F

from farebox.llm import catalog, html_text
from tests.llm.helpers import save, sentence


def energy(cost, edges, label):
    return (sum(abs(c) for c, x in zip(cost, label) if x != (c > 0) and c) + sum(c for a, b, c in edges if label[a] != label[b]))


def test_min_cut_is_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randint(1, 8)
        cost = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 7)) for _ in range(rng.randint(0, 12))]
        edges = [e for e in edges if e[0] != e[1]]
        got = html_text.min_cut(cost, edges)
        least = min(energy(cost, edges, x) for x in itertools.product([False, True], repeat=n))
        assert energy(cost, edges, got) == least


def test_smoothness_carries_blocks_along():
    # an undecided block goes with its neighbours, a decided one does not
    chain = [(i, i + 1, 50) for i in range(4)]
    assert html_text.min_cut([300, -20, 300, 0, 300], chain) == [True] * 5
    assert html_text.min_cut([300, -120, 300, 0, 300], chain) == [True, False, True, True, True]


def text_of(page, model=None):
    return html_text.main_text(page, model or {})[0]


PROSE = [sentence(random.Random(i), 30) + "." for i in range(6)]
RICH = f"""<!doctype html><html><head><title>Site title</title><style>p{{}}</style><script>if (a < b) "<p>no</p>"</script></head>
<body class="has-sidebar"><div id="cookie-notice" role="alert">We use cookies. <button>OK</button></div>
<header class="site-header"><h1>The Site</h1><form action="/s"><input name=q><label>Search</label></form></header>
<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
<div class="layout"><main><article class="post"><header><h1>A &lt;fine&gt; headline</h1></header>
<p>{PROSE[0]}<p>{PROSE[1]} <a href="x">linked&nbsp;words</a> go on.
<div class="ad-slot">Buy now! {PROSE[5]}</div><ul><li>one<li>two</ul><p>Short.</p>
<blockquote>{PROSE[2]}</blockquote><noscript>Switch on scripts</noscript><p>before<script>x()</script> after<br>line</p>
<div class="share-buttons"><a href=#>Share</a></div></article></main>
<aside class="sidebar"><h3>Related</h3><p>{PROSE[3]}</p></aside></div>
<section id="comments"><h2>2 comments</h2><article class="comment"><p>{PROSE[4]}</p></article></section>
<div class="newsletter"><form><p>Sign up</p></form></div><footer>&copy; 2024</footer></body></html>"""
RICH_TEXT = "\n".join(["A <fine> headline", PROSE[0], PROSE[1] + " linked words go on.", "one", "two", "Short.", PROSE[2],
                       "before after line"])


def test_article_without_its_surroundings():
    assert text_of(RICH) == RICH_TEXT


def test_page_without_semantic_elements():
    page = ('<body><div><a href=1>Home</a> | <a href=2>About us</a></div><div><div><p>' + "</p><p>".join(PROSE[:4])
            + '</p></div></div><div><a href=3>Imprint</a> <a href=4>Contact</a></div>')
    assert text_of(page) == "\n".join(PROSE[:4])


def test_malformed_markup():
    assert text_of("") == ""
    assert text_of("<article><p>one two.<!-- open") == "one two."
    assert text_of("<article><p>a < b and c > d &amp &#x41; &am</article>") == "a < b and c > d & A &am"
    assert text_of('<article><p>x</p><script>var a = "</p>') == "x"
    assert text_of("<article><p><b>one<p>two</i></div></article><div class=menu>no") == "one\ntwo"
    assert text_of("<article><p>end <a href='x") == "end"
    assert text_of('<article><p title="a > b">quoted</p>') == "quoted"
    assert text_of("<ARTICLE><P>Upper</P></ARTICLE>") == "Upper"


def test_long_and_hostile_pages_are_linear():
    def spent(page):
        t = time.perf_counter()
        html_text.main_text(page, {})
        return time.perf_counter() - t

    for unit in ("<div>", "<a <", "</x>", "<!-", "<p>a word", "<li>x</li>", "&amp", '<a href="'):
        small, large = unit * 4000, unit * 32000
        assert spent(large) < 40 * max(spent(small), 0.01), unit


def test_training_and_query(spark, tmp_path):
    own = ["<html><body><nav><ul>" + "<li><a href=x>m</a></li>" * 4 + "</ul></nav><article><h1>T</h1><p>" + p + "</p></article></body></html>"
           for p in PROSE]
    data = [(i, f"u{i}", p, "x") for i, p in enumerate([*own, RICH, RICH, "", None])]
    data += [(None, None, own[0], "y")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    model = html_text.train(pages)
    assert model["tag=p"] > 0 > model["links=4"]
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in catalog.op11_min_cut_text(spark, save(spark, tmp_path, pages=pages)).collect()}
    assert len(got) == len(data)
    for i, p in enumerate(PROSE):
        assert got[i, f"u{i}"] == ("T\n" + p, len(p) + 2)
    assert got[6, "u6"] == got[7, "u7"] == (RICH_TEXT, len(RICH_TEXT))
    assert got[8, "u8"] == got[9, "u9"] == ("", 0) and got[None, None][0] == "T\n" + PROSE[0]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages, html_text.train(pages)).filter(F.lit(True)).count() == 0
