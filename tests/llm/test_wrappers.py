import json
import re
from html import unescape

import pytest

from voicelens.llm import wrappers as W

SCHEMA = "page_id long, url string, html string, text string, host string"
PAGE = """<!DOCTYPE html><html><head><title>Head</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy &amp; go</div>
<article><h1>Title &amp;  more</h1><p>First <b>bold<i>er</i></b>,&nbsp;text<br>line<p>Second &lt;b&gt; a<a href=x>link</a>b.
<ul><li>item</li></ul><aside>related</aside><div class="comments"><p>a comment</p></div></article>
<form><label>Mail</label><button>Go</button></form><aside class="sidebar">side</aside><footer>&copy; foot</footer></body></html>"""
MAIN = "Title & more First bolder, text line Second <b> alinkb. item"


def rows(spark, pages):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(pages)], SCHEMA)


def test_landmark_page(spark):
    got = W.extract(rows(spark, [("http://h.com/1", PAGE), ("http://h.com/2", PAGE.replace("Second", "Other")), ("http://h.com/2", PAGE[:PAGE.index("<ul><li>item")])])).collect()
    texts = {r.page_id: r for r in got}
    assert texts[0].text == MAIN and texts[0].n_chars == len(MAIN)
    assert texts[1].text == MAIN.replace("Second", "Other")
    assert texts[2].text == "Title & more First bolder, text line Second <b> alinkb."


def test_page_without_landmark_loses_template_and_menu(spark):
    page = "<body><div><ul>{}</ul></div><div>Same on all pages</div><div><p>Own text {}</p><p>and more {}</p></div></body>"
    menu = "".join(f"<li><a href=/{k}>entry {k}</a></li>" for k in range(4))
    got = W.extract(rows(spark, [(f"http://plain.org/{i}", page.format(menu, i, i * 7)) for i in range(6)])).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Own text {i} and more {i * 7}" for i in range(6)}


def test_copies_of_a_page_are_not_its_template(spark):
    page = "<body><div class='nav'>Menu</div><div><h1>Head {0}</h1><p>Own text {0}</p></div><div class='ad'>Buy {1}</div>{2}<div>Foot</div></body>"
    alone = [(f"http://copies.org/?utm={i}", page.format("one", i, "")) for i in range(3)]
    none = [(None, page.format("two", 0, "")) for _ in range(1000)]
    marked = [(f"http://marks.org/{i}", page.format("three", 0, "").replace("<h1>", f"<h1 class='c{'abcd'[i]}'>")) for i in range(4)]
    mixed = [(f"http://mixed.org/{i}", page.format(i, 0, "")) for i in range(20)] + [("http://mixed.org/x", page.format("x", 0, "<p>A note</p>"))] * 5
    got = {r.page_id: r.text for r in W.extract(rows(spark, alone + none + marked + mixed)).collect()}
    n = len(alone) + len(none)
    assert {got[i] for i in range(3)} == {"Head one Own text one Foot"}
    assert {got[i] for i in range(3, n)} == {"Head two Own text two Foot"}
    assert {got[i] for i in range(n, n + 4)} == {"Head three Own text three Foot"}
    assert [got[n + 4 + i] for i in range(20)] == [f"Head {i} Own text {i}" for i in range(20)]
    assert {got[i] for i in range(n + 24, n + 29)} == {"Head x Own text x A note"}


ARTICLE = "<article><h1>Head</h1><p>Own text</p></article>"


@pytest.mark.parametrize("wrapped", [
    "<div class='layout with-sidebar'>{}</div>", "<div class='post comments-open'>{}</div>", "<div id='search-results-main'>{}</div>", "<section class='social-story'>{}</section>",
    "<div class='hasSidebar'>{}</div>", "<div class='overflow-hidden'>{}</div>", "<div class='sidebar'><div class='widget'>{}</div></div>", "<main class='search'><div>{}</div></main>",
    "<div class='comments'><main>{}</main></div>", "<div class='share'>{}</div>", "<div class='related'>{}</div>"])
def test_side_words_do_not_hide_an_article(wrapped):
    page = "<body><nav>Menu</nav>" + wrapped.format(ARTICLE + "<aside>aside</aside>") + "<footer>foot</footer></body>"
    assert W.main_text(page, None) == "Head Own text"


@pytest.mark.parametrize("name", ["post comments-open", "social", "layout with-sidebar", "post share", "search-results-main", "no-comments", "comment", "social-story"])
def test_side_words_of_an_article_itself(name):
    assert W.main_text(f"<div>{ARTICLE.replace('article', f'article class="{name}"', 1)}<aside>x</aside></div>", None) == "Head Own text"


@pytest.mark.parametrize("other", [
    "<div class='comments'><article class='comment'>c</article></div>", "<section class='related'><article>c</article></section>", "<article class='teaser post'>c</article>",
    "<div class='sidebar'><div class='widget'><article>c</article></div></div>", "<div class='site-footer'>c</div>", "<div class='comment-list'>c</div>", "<div id='mainNav'>c</div>",
    "<aside><article>c</article></aside>", "<div class='sidebar-left'>c</div>", "<div class='related-post'>c</div>", "<div hidden>c</div>"])
def test_landmarks_beside_and_in_an_article_go(other):
    assert W.main_text(f"<body>{ARTICLE}{other}</body>", None) == "Head Own text"
    inside = ARTICLE.replace("</article>", other + "</article>")
    if "post" not in other:
        assert W.main_text(f"<body>{inside}</body>", None) == "Head Own text"


def test_comments_do_not_replace_text_without_article(spark):
    page = "<body><div id=content><p>Own {0}</p></div><div class=comments><article>note {0}</article></div><main2></main2></body>"
    got = W.extract(rows(spark, [(f"http://plain.org/{i}", page.format(i)) for i in range(4)])).collect()
    assert all(f"Own {r.page_id}" in r.text for r in got)
    site = "<div>Site</div><div class='layout with-sidebar'><article><p>Own {0}</p></article><div class='sidebar'>x</div></div>"
    got = W.extract(rows(spark, [(f"http://site.org/{i}", site.format(i)) for i in range(4)])).collect()
    assert [r.text for r in sorted(got)] == [f"Own {i}" for i in range(4)]


def test_edges(spark):
    pages = [(None, None), ("", ""), ("no url", "just text"), ("http://x.org/", "<p>open <!-- never closed"), ("http://x.org/", "a < b <notag attr='>' x>y</notag> &amp &am"),
             ("http://x.org/", "<script>lost"), ("http://x.org/", "<p>word " * 30_000)]
    got = {r.page_id: r for r in W.extract(rows(spark, pages)).collect()}
    assert [got[i].text for i in (0, 1, 3, 5)] == ["", "", "open", ""]
    assert got[2].text == "just text" and got[4].text == "a < b y & &am"
    assert got[6].text == " ".join(["word"] * 30_000)
    assert W.extract(rows(spark, pages).limit(0)).count() == 0


def test_whole_table_against_its_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in W.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p)[^>]*>|<br>", inner)]
        assert got[r.page_id] == " ".join(b for b in blocks if b)


def nodes(text):
    return [W.frozen(x) for x, _ in json.loads(text)]


def test_alignment_infers_optional_and_repeated_groups():
    one, two = W.skeleton_of("<ul><li>a</li><li>b</li><li>c</li></ul><p>x</p>")[0], W.skeleton_of("<ul><li>a</li></ul><h2>y</h2><p>x</p>")[0]
    whole = [(W.frozen(x), o) for x, o in json.loads(W.fold([one, two]))]
    assert whole == [("ul", False), (("+", "li", "#", "/li"), False), ("/ul", False), ("h2", True), ("#", True), ("/h2", True), ("p", False), ("#", False), ("/p", False)]


def test_one_wrapper_per_host(spark, monkeypatch):
    monkeypatch.setattr(W, "FOLD", 3)
    pages = [(f"http://big.com/{i}", "<div>" + "<p>t</p><h2>u</h2>" * (i % 5 + 1) + f"<x{i}>v</x{i}></div>") for i in range(25)]
    seen = W.page_skeletons(rows(spark, pages)).select("host", "skeleton").distinct()
    found = W.infer_wrappers(seen).collect()
    assert len(found) == 1 and found[0].host == "big.com" and found[0].wrapper


def test_oversized_host_has_a_wrapper_per_template(spark, monkeypatch):
    monkeypatch.setattr(W, "MAX_NODES", 40)
    monkeypatch.setattr(W, "FOLD", 5)
    layout = "<body><x{0}>Same text of layout {0}</x{0}>" + "".join(f"<y{k}x{{0}}></y{k}x{{0}}>" for k in range(8)) + "<z{1}></z{1}><h1>Own {1}</h1></body>"
    pages = [("http://big.com/", layout.format(k % 3, i)) for i, k in enumerate(range(24))]
    card = "<body>" + "".join(f"<c{k}>card {k} {{0}}</c{k}>" for k in range(100)) + "<foot>Below all</foot></body>"  # larger than the bound alone
    pages += [("http://big.com/list", card.format(i)) for i in range(3)]
    pages += [("http://small.com/", f"<div>Top</div><p>Own {i}</p>" + "<h2>u</h2>" * i) for i in range(9)]
    got = {r.page_id: r.text for r in W.extract(rows(spark, pages)).collect()}
    assert all(got[i] == f"Own {i}" for i in range(24))
    assert all(got[24 + i] == " ".join(f"card {k} {i}" for k in range(100)) for i in range(3))
    assert all(got[27 + i].startswith(f"Own {i}") for i in range(9))
    seen = W.page_skeletons(rows(spark, pages)).select("host", "skeleton").distinct()
    wrappers, members = (x.collect() for x in W.template_clusters(seen))
    assert len(members) == seen.count() and {(r.host, r.cluster) for r in members} == {(r.host, r.cluster) for r in wrappers}
