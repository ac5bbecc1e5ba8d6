"""HTML extraction: wrappers, and the text of pages built by hand and given."""

import html
import re

import duckdb

from marketlake.llm import wrapper
from tests.conftest import SF_DIR

PAGES = "page_id long, url string, html string, host string, stream string"


def page(body, head="<title>t</title><script>var a='</p><p>x';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "host", "stream") for r in rows], PAGES)


def test_article_of_every_given_page(run):
    expected = {}
    for page_id, text in duckdb.sql(f"SELECT page_id, html FROM '{SF_DIR}/pages.parquet'").fetchall():
        inside = re.search("<article>(.*?)</article>", text, re.S)[1]
        inside = html.unescape(re.sub("</?(?:p|h1|br)>", " ", re.sub("</?b>", "", inside)))
        expected[page_id] = " ".join(inside.split())
    got = run("op2_html_extraction")
    assert dict(zip(got["page_id"], got["text"])) == expected
    assert (got["n_chars"] == got["text"].str.len()).all()


def test_groups_fold_and_align():
    a = wrapper.stream(wrapper.parse("<ul><li><a href=1>x</a></li><li><a>y</a></li></ul><p>one</p>"))
    b = wrapper.stream(wrapper.parse("<ul><li>x</li><li>y</li><li>z</li></ul><div class='ad 17'>buy</div><p>one</p>"))
    assert wrapper.expression(a) == "<ul>(<li>#</li>)+</ul><p>#</p>"
    assert wrapper.expression(wrapper.align(a, b)) == "<ul>(<li>#</li>)+</ul>(<div.0.ad>#</div>)?<p>#</p>"
    assert wrapper.align(a, a) == a


def test_everything_but_the_article_goes(spark):
    body = (
        "<header><h1>Site</h1><a href='/'>home</a></header><nav><ul><li>menu</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><div class=ad-slot-3>Buy</div>"
        "<main><article><h1>Head{n}</h1><p>One &amp; two &#233;&nbsp;x<br>three <b>bo</b>ld\n\n text{n}<p>unclosed{n}"
        "<aside>side</aside><form><label>mail</label><input></form><div id='comments'><p>a reader says</p></div></article></main>"
        "<div class='sidebar'>more</div><footer>&copy; all</footer>"
    )
    rows = [(n, f"https://A.example.com:80/{n}", page(body.replace("{n}", str(n)))) for n in range(4)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(frame(spark, rows)).collect()}
    assert got == {n: f"Head{n} One & two é x three bold text{n} unclosed{n}" for n in range(4)}


def test_without_an_article_the_varying_text_is_main(spark):
    body = "<div class=x><p>Welcome to our site</p></div><div class=y><p>Story {n} goes on for long {n}</p><p>and on {n}</p></div><div class=z><a href=1>link {n}</a></div>"
    rows = [(n, f"http://b.example.org/{n}", page(body.replace("{n}", str(n)))) for n in range(6)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(frame(spark, rows)).collect()}
    assert got == {n: f"Story {n} goes on for long {n} and on {n}" for n in range(6)}


def test_odd_pages(spark):
    long = page("<article>" + "".join(f"<p>line {i}</p>" for i in range(20_000)) + "</article>")
    rows = [
        (1, "http://c.example/1", None), (2, "http://c.example/2", ""), (3, None, page("<article><p>x</p></article>")),
        (None, "not a url", "plain text only"), (4, "http://c.example/4", "<article><p>cut off <b>he"), (5, "http://c.example/5", long),
        (6, "http://c.example/6", "<p>a < b and 3 > 2</p>"), (6, "http://c.example/6", "<p>a < b and 3 > 2</p>"),
        (7, "http://c.example/7", "<div class=\"x>y' <p>broken"),
    ]
    got = [(r["page_id"], r["text"]) for r in wrapper.extract(frame(spark, rows)).collect()]
    texts = dict(got)
    assert len(got) == len(rows) and texts[1] == texts[2] == "" and texts[3] == "x" and texts[None] == "plain text only"
    assert texts[4] == "cut off he" and texts[5] == " ".join(f"line {i}" for i in range(20_000)) and texts[6] == "a < b and 3 > 2"
    assert all(t is not None for _, t in got)
    assert wrapper.extract(frame(spark, [])).count() == 0


def test_many_streams_are_aligned_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "TOGETHER", 3)
    bodies = [page("<article><h1>a</h1>" + "".join(f"<p>{i}</p>" if i & n else f"<div>{i}</div>" for i in (1, 2, 4, 8)) + "</article>") for n in range(16)]
    pages = frame(spark, [(n, "http://d.example/", b) for n, b in enumerate(bodies)])
    made = wrapper.wrappers(pages).collect()
    assert len(made) == 1 and set(made[0]["main_chains"]) >= {f"html/body/article/{t}" for t in ("h1", "p", "div")}
    assert {r["text"] for r in wrapper.extract(pages).collect()} == {"a 1 2 4 8"}


def test_words_of_an_article_that_only_look_like_marks_stay(spark):
    body = (
        "<div class='post format-standard'><h2 id='related-work'>Related work {n}</h2><section id='social-history'><p>History {n}</p></section>"
        "<div class=footnotes>Note {n}</div><p class=formula>where <math><mi>x</mi><mo>=</mo><mn>{n}</mn></math></p>"
        "<figure><figcaption>Figure {n}</figcaption></figure><div class='share-links'>Share</div></div><div id='site-footer'>Imprint</div>"
    )
    rows = [(n, f"http://e.example/{n}", page(body.replace("{n}", str(n)))) for n in range(4)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(frame(spark, rows)).collect()}
    assert got == {n: f"Related work {n} History {n} Note {n} where x={n} Figure {n}" for n in range(4)}


def test_teasers_are_not_the_story(spark):
    body = "<main><h1>Head {n}</h1><p>" + "a long story {n} " * 20 + "</p></main><article class=card><p>teaser {n}</p></article>"
    rows = [(n, f"http://f.example/{n}", page(body.replace("{n}", str(n)))) for n in range(4)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(frame(spark, rows)).collect()}
    assert got == {n: " ".join([f"Head {n}", *[f"a long story {n}"] * 20]) for n in range(4)}
