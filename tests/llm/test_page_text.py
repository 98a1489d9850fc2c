"""What pages keep: self-closed and unclosed elements, declared containers, text inside and outside articles, templates of many hosts."""

import random
import time

import pytest

from curata.llm import site_style


def _text(html):
    return site_style.main_text(site_style.Reader().read(html), {})


@pytest.mark.parametrize("html, text", [
    ("<p>a</p><svg class=i /><p>b</p>", "a b"), ("<p>a <math/> b</p><p>c", "a b c"), ('<object data="x" /><p>a</p><object>no</object><p>b</p>', "a b"),
    ("<div><video src='x'/></div><p>a</p><video>no</video>b", "a b"), ("<p>a</p><object data=x><p>b</p>", "a b"), ("<p>a</p><video src=x><p>b</p><video>no</video><p>c</p>", "a b c"),
    ("<select><option>no</select><p>a</p><canvas><p>b", "a b"), ("<audio src=x><p>a", "a"), ("<svg><title>no</title><g><text>no</text></g></svg>a", "a"),
    ("<p>a <video><p>no</p></video> b</p>", "a b"), ("<iframe src='x'/><p>a</p>", "a"), ("<object data=a/>no</object>a", "a"), ("<object><object>no</object>no</object>a", "a"),
    ("<script>if (a</b/>c) '<p>'</script>a", "a"),
])
def test_self_closed_and_unclosed_elements(html, text):
    assert _text(html) == text


BODY = "<p>The body of the page has the words that a reader came for, and there are enough of them.</p>"
TEXT = BODY[3:-4]


@pytest.mark.parametrize("html, text", [
    (f"<div class='layout no-sidebar'><article>{BODY}</article></div>", TEXT), (f"<div id='content' class='has-menu'>{BODY}</div><div class=menu>no</div>", TEXT),
    (f"<article class='post category-legal'>{BODY}<div class='share'>no</div></article>", TEXT), (f"<div class='has-header'>{BODY}</div>", TEXT),
    (f"<main><article>{BODY}</article><article class=comment>no</article></main>", TEXT), (f"<span class=no-sidebar>{BODY}</span><p>tail</p>", f"{TEXT} tail"),
    (f"{BODY}<p>see <a class=share href=x>no</a> more</p>", f"{TEXT} see more"), (f"{BODY}<div class=related><p>no</p></div>", TEXT),
    (f"<article>{BODY}<div class=comments><article><p>no</p></article></div></article>", TEXT),
])
def test_declared_containers_keep_the_article(html, text):
    assert _text(html) == text


def _pages(spark, rows):
    return {r.page_id: r.text for r in site_style.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}


def test_blocks_inside_and_outside_articles(spark):
    rng = random.Random(21)
    body = lambda: " ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=14)) + f" {rng.random()}"
    bodies = [[body() for _ in range(rng.randint(2, 5))] for _ in range(60)]
    marked = ["".join(f"<p>{t}</p>" for t in b) for b in bodies]
    rows = [(i, f"http://a.example/{i}", f"<main><div class=x7><p>Buy now at our shop</p></div>{marked[i]}<p>This notice stands on every page</p></main>") for i in range(30)]
    rows += [(i, f"http://b.example/{i}", f"<article><p>Read on {i}</p></article><div class=q>{marked[i]}</div>") for i in range(30, 60)]
    rows += [(100 + i, f"http://c.example/{i}", f"<main><div class=x8>Buy number {i // 40}</div>{marked[i % 60]}</main>") for i in range(120)]
    got = _pages(spark, rows)
    assert all(got[i] == " ".join(bodies[i]) for i in range(30))
    assert all(got[i] == " ".join([f"Read on {i}", *bodies[i]]) for i in range(30, 60))
    assert all(got[100 + i] == " ".join(bodies[i % 60]) for i in range(120))      # three notices in turn: none on half of the pages


def test_templates_of_small_hosts_do_not_depend_on_the_number_of_pages(spark, monkeypatch):
    monkeypatch.setattr(site_style, "COMMON", 10)
    rows = [(i, f"http://h{i}.example/", f"<div class=x7>Buy now at our shop</div><div class=q{chr(97 + i)}>body {i} of the small host</div>") for i in range(12)]
    rows += [(i, f"http://h{i}.example/", f"<div class=r{chr(97 + i % 26)}{chr(97 + i // 26)}>page {i}</div>") for i in range(12, 300)]
    few, many = _pages(spark, rows[:12]), _pages(spark, rows)
    assert few == {i: f"body {i} of the small host" for i in range(12)}
    assert all(many[i] == few[i] for i in few) and all(many[i] == f"page {i}" for i in range(12, 300))


@pytest.mark.parametrize("html", [
    "<div>" * 50_000 + "</p>" * 50_000, "<svg " * 100_000, "<a " * 100_000, "<a " * 100_000 + '">', "<svg " * 100_000 + '">', "<b><div>" + "<a>" * 50_000 + "</b>" * 50_000,
    "<li><b>" * 50_000 + "</i>" * 50_000, "<!" * 100_000, "<title>" * 100_000, "<" + "a" * 300_000, "<a '' " * 100_000 + '">', "<svg>" * 100_000,
], ids=range(12))
def test_broken_pages_are_read_in_linear_time(html):
    began = time.process_time()
    _text(html)
    assert time.process_time() - began < 5


@pytest.mark.parametrize("html, text", [
    ("<p>a <b c", "a"), ("<p>1 < 2 <b>x</b>", "1 < 2 x"), ("<p>a</p><i x='<p>b</p>", "a <i x=' b"), ("<div><a></b></a>x</div></div>y", "x y"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>d", "a b c d"), ("<p>a<table><tr><td>b</p>c<td>d</table>e", "a b c d e"),
])
def test_broken_markup(html, text):
    assert _text(html) == text
