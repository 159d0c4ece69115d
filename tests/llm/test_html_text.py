"""Main text of pages: the marked article of every page, and hand-written pages with all sorts of other parts."""

import html as entities
import re

import pytest

from folioscope.llm import html_text as H
from folioscope.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
NEUTRAL = H.Model({}, {})
WORDS = "some words that make up a paragraph of the article"


def read(page, model=NEUTRAL):
    return H.extract(page, model, model.without_mark())


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain text &amp; more", "plain text & more"),
        ("<script>var x = '<p>a</p>'</script><style>p{}</style>", ""),
        ("<p>only one <!-- cut off", "only one"),
        ("a < b and <3 <b", "a < b and <3"),
        ("<article><p>cut <a href='x", "cut"),
        ("<article><p>A&nbsp;b\n\t c<br>d<b>e</b>f</p><p>g</p></article>", "A b c def\n\ng"),
        ("<nav>x y z</nav><main><header>By</header><h1>H</h1><p>One</p><div class='ad-box'>buy</div><ul><li>u<li>v</ul>"
         "<form>mail</form><div id='user-comments'><p>nice</p></div><p>End.</p></main><p>Outside", "H\n\nOne\n\nu\n\nv\n\nEnd."),
        (f"<div class=menu><a>Home</a></div><div><p>{WORDS}</p><p>{WORDS}</p></div><footer>&copy; me</footer>", f"{WORDS}\n\n{WORDS}"),
        (f"<div class='cookieNotice'>We use cookies</div><p>{WORDS}<aside>see</aside><p>{WORDS}", f"{WORDS}\n\n{WORDS}"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ],
)
def test_pages(page, text):
    assert read(page) == text


def test_region_is_the_best_of_all(monkeypatch):
    """The linear scan against all pairs of ends."""
    page = "a b<nav>c</nav><hr>d<p>e f g<ul><li>h</ul><nav></nav><nav></nav>i j k<aside>l</aside>m n o p<nav></nav><nav></nav>q"
    model = NEUTRAL.without_mark()
    walk, place, scores = H.Walk(), "out", []
    for kind, value, own in H.events(page):
        if kind == "text":
            scores.append((len(value.split()) * model.word_score(walk)[0], value))
            continue
        walk.open(value, own) if kind == "open" else walk.close(value)
        scores.append((model.tag_score(place, own or (f"tag:{value}",)), None))
    sums = [(sum(s for s, _ in scores[i:j]), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    _, i, j = max(sums)
    best = {w for _, text in scores[i:j] if text for w in text.split()} - {"c", "l"}
    assert set(read(page).split()) == best


def test_very_long_page():
    page = f"<article>{'<p>' + 'word ' * 1000}</article>" + "<div>" * 2000
    assert len(read(page).split()) == 1000
    many = "<article>" + f"<p>{WORDS}</p>" * 5000 + "</article>"
    assert read(many).count("\n\n") == 4999


@pytest.mark.parametrize(
    "start, step, end",
    [("", "<div><b>word ", ""), ("<main>", "<div class=c{}><i>word ", "</main>"), ("<b>" * 40_000, "<p>word</p><li>x</li></u>", ""),
     ("<div>" * 40_000, "<li>word</li><dd>x</dd></nav>", "")],
)
def test_many_open_elements(start, step, end):
    """An event costs the same however many elements are open; walking the open ones for each took hours here."""
    page = start + "".join(step.format(i) for i in range(40_000)) + end
    held = {}
    H.count_features(f"<article>{page}", held)
    assert held["in tag:article"][:2] == [1, 0]
    assert read(f"<article>{page}").split().count("word") == 40_000


def test_query_finds_the_marked_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = QUERIES["op2_html_text"](spark, DATA).collect()
    assert len(rows) == len(pages)
    for row in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[row.page_id].html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert row.text == "\n\n".join(b for b in blocks if b) and row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_pages_without_a_mark(spark):
    """Weights learned from marked pages also serve pages with their marks taken out."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    model = H.fit(pages)
    bare = model.without_mark()
    right = total = 0
    for row in pages.limit(100).collect():
        want = set(H.extract(row.html, model, bare).split("\n\n"))
        got = set(H.extract(re.sub("</?article>", "", row.html), model, bare).split("\n\n"))
        right += len(want & got)
        total += len(want | got)
    assert right / total > 0.95


def test_edge_tables(spark):
    pages = spark.createDataFrame([(1, None, 5), (2, "<p>x y", 6), (2, "<p>x y", 6)], "page_id long, html string, n_chars int")
    found = H.main_text(pages, H.fit(pages))
    assert found.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted((r.page_id, r.text, r.n_chars) for r in found.collect()) == [(1, "", 0), (2, "x y", 3), (2, "x y", 3)]
    assert H.main_text(pages.limit(0), H.fit(pages.limit(0))).collect() == []


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=utf-8><body><p>{WORDS}</p></body></html>",
        f"<head><title>T</title><link rel=x><style>p{{}}</style><p>{WORDS}",
        f"<head><script>x()</script>\n<article><p>{WORDS}</p></article>",
        f"<head><title>T</title>\n {WORDS}",
        f"<head><title>T</title><img src=x><span>{WORDS}</span>",
        f"<head><title>T</title></head><body><p>{WORDS}</p>",
    ],
)
def test_a_head_without_its_end_tag(page):
    assert read(page) == WORDS


def test_labelled_pages_without_the_end_of_the_head_are_learned_from():
    held = [{}, {}]
    for end, counts in zip(("</head>", ""), held, strict=True):
        H.count_features(f"<html><head><title>T</title>{end}<body><div class=x>a b</div><article><p>{WORDS}</p></article>", counts)
    assert held[1] == held[0] and held[1]["in tag:p"][2] > 0
