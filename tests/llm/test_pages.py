import html
import itertools
import re

import numpy as np
import pytest
from quillon.llm import pages
from quillon.llm.dom import Page

SOME = "Lorem ipsum dolor sit amet, consectetur adipiscing elit."


@pytest.fixture(scope="module")
def model(spark):
    return pages.fit(pages.labelled_pages(spark))


@pytest.fixture(scope="module")
def given(spark, sf):
    return [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]


def article(source):
    """The text of a page of the given form, by plain patterns."""
    inner = re.search(r"<article>(.*)</article>", source or "", re.DOTALL)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def leaves(source):
    p = Page(source)
    return [(p.tags[p.parent[i]], t) for i, t in enumerate(p.texts) if t is not None]


def test_query_gives_the_articles(spark, sf, given):
    out = pages.op12_pages(spark, sf)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    want = [(i, u, article(h), len(article(h))) for i, u, h in given]
    assert sorted(map(tuple, out.collect())) == sorted(want)


CHANGES = {
    "header": lambda h: h.replace("<nav>", f'<header><a href="/">Site</a><p>{SOME}</p></header><nav>'),
    "boxes": lambda h: h.replace("<nav>", '<div id="masthead"><h1>Site</h1></div><div class="top-menu">').replace("</nav>", "</div>"),
    "sidebar": lambda h: h.replace("</article>", f'</article><aside><h3>More</h3><ul><li><a href="/x">One</a></li></ul><p>{SOME * 5}</p></aside>'),
    "cookies": lambda h: h.replace("<article>", f'<div class="cookie-notice"><p>{SOME}</p><button>Fine</button></div><article>'),
    "comments": lambda h: h.replace("</article>", '</article><section id="comments"><h3>Comments</h3>' + f"<div class='comment'><p>{SOME}</p></div>" * 12 + "</section>"),
    "comments inside": lambda h: h.replace("</article>", '<section class="comments"><h2>Comments</h2>' + f"<p>{SOME}</p>" * 7 + "</section></article>"),
    "comments as articles": lambda h: h.replace("</article>", '</article><section class="comments">' + f'<article class="comment"><p>{SOME}</p></article>' * 5 + "</section>"),
    "form": lambda h: h.replace("</article>", "<form><label>Your mail</label><select><option>a</option></select><textarea>x</textarea><p>Subscribe.</p></form></article>"),
    "advert": lambda h: h.replace("</h1>", f'</h1><div class="advert">{SOME}</div>', 1),
    "no marks": lambda h: h.replace("<article>", "<div>").replace("</article>", "</div>"),
    "main": lambda h: h.replace("<article>", "<main>").replace("</article>", "</main>"),
    "named": lambda h: h.replace("<article>", '<div class="wrap"><div class="entry-content">').replace("</article>", "</div></div>"),
    "capitals": lambda h: re.sub(r"</?\w+", lambda m: m[0].upper(), h),
    "unseen": lambda h: h.replace("<article>", "<noscript><p>Enable scripts</p></noscript><article><!-- <p>no</p> --><style>p{}</style>"),
}


@pytest.mark.parametrize("name", CHANGES)
def test_other_forms_of_the_given_pages(model, given, name):
    found = pages.main_text([Page(CHANGES[name](h)) for _, _, h in given], model)
    assert np.mean([a == article(h) for a, (_, _, h) in zip(found, given)]) >= 0.98


def test_layouts_not_learned_from(model):
    other = [Page(pages._Layout(10**6 + i).page()) for i in range(200)]
    f, y = pages.forest(other), np.concatenate([pages.labels_of(p) for p in other])
    node = pages.marginals(model, f)[0]
    right = ((node >= 0.5) == y)[f.edge == 0]
    assert right.mean() >= 0.99 and 0.2 < y[f.edge == 0].mean() < 0.8


def test_marginals_equal_sums_over_all_labels():
    rng = np.random.default_rng(2)
    parent = np.array([-1, 0, 0, 1, 1, 4, 2, 2, -1, 8])
    depth = np.array([0, 1, 1, 2, 2, 3, 2, 2, 0, 1])
    f = pages.Forest(rng.normal(size=(10, 4)), parent, rng.integers(0, pages.EDGES, 10), depth)
    m = pages.Model(rng.normal(size=4), rng.normal(size=(pages.EDGES, 2, 2)))
    weights, on, both, whole = np.exp(f.x @ m.own), np.zeros(10), np.zeros((10, 2, 2)), 0.0
    for y in itertools.product((0, 1), repeat=10):
        p = np.prod([weights[i] for i in range(10) if y[i]]) * np.exp(sum(m.pair[f.edge[i], y[parent[i]], y[i]] for i in range(10) if parent[i] >= 0))
        whole += p
        on += p * np.array(y)
        for i in range(10):
            if parent[i] >= 0:
                both[i, y[parent[i]], y[i]] += p
    node, joint, below = pages.marginals(m, f)
    assert np.allclose(node, on / whole) and np.allclose(joint, both / whole)
    assert np.isclose(np.logaddexp(below[[0, 8], 0], below[[0, 8], 1]).sum(), np.log(whole))


def test_plain_children_say_nothing(model):
    a, b = (pages.marginals(model, pages.forest([Page(f"<div class=x>{'<p>Some words here.</p>' * n}</div>")]))[2][1] for n in (3, 3))
    assert np.allclose(a, b)
    x = pages.forest([Page("<article>" + "<p>Some words.</p>" * 50 + "</article>")])
    assert not x.x[2:].any()


def test_trees_of_broken_pages():
    assert leaves("<p>one<p>two</p></div>three<br>four <b>five</p>six") == [("p", "one"), ("p", "two"), ("html", "three four five"), ("html", "six")]
    assert leaves("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d"), ("html", "e")]
    assert leaves("<table><tr><td>a<td>b</div><tr><td><div>c</table>d") == [("td", "a"), ("td", "b"), ("div", "c"), ("html", "d")]
    assert leaves("<dl><dt>x<dd>y<dt>z</dl><h1>h</h2>i") == [("dt", "x"), ("dd", "y"), ("dt", "z"), ("h1", "h"), ("html", "i")]
    assert leaves("a<!-- b --><!-->c<!x><?y?></>d < 3 & 4 &lt;e&gt; &amp;amp; &#233;&nbsp; f") == [("html", "acd < 3 & 4 <e> &amp; é f")]
    assert leaves("<p title=\"a>b\" x='<p>' y=\"open>in</p>") == [("p", "in")]
    assert leaves("a<script>if (1 < 2) '</p>'</SCRIPT >b<style>c") == [("html", "ab")]
    assert leaves("a<svg><text>x</text></svg>b<button>c") == [("html", "abc")]
    assert leaves("text <a href=x") == [("html", "text")] and leaves("") == [] and leaves("<") == [("html", "<")]


def test_long_and_deep_pages_take_linear_time():
    many = 20_000
    assert len(leaves("<div>x" * many)) == many
    assert len(leaves("<div>x" * many + "</p></li></td>" * many)) == many
    assert leaves("<a b='" * 200 + "<p>" * 10) is not None
    assert len(Page("<p class='" + "x " * 500_000 + "'>y").texts) == 3
    assert pages.main_text([Page("<article>" + "<p>some words</p>" * many + "</article>")], pages.Model(np.zeros(pages.COLUMNS), np.zeros((pages.EDGES, 2, 2)))) == ["\n".join(["some words"] * many)]


def test_odd_rows(spark, model):
    one = f"<article><h1>T</h1><p>{SOME}</p></article>"
    rows = [(1, None, "u", 5), (2, "", "u", 5), (3, "<br><p> </p>", "u", 5), (None, one, None, 5), (4, one, "u", 5), (4, one, "u", 5)]
    df = spark.createDataFrame(rows, "page_id int, html string, Text string, _row int")
    out = pages.extract_text(df, model)
    assert out.columns == ["page_id", "_row", "text"]
    assert sorted((r["page_id"] or 0, r["text"]) for r in out.collect()) == [(0, f"T\n{SOME}"), (1, ""), (2, ""), (3, ""), (4, f"T\n{SOME}"), (4, f"T\n{SOME}")]
    assert pages.extract_text(df.limit(0), model).count() == 0 and pages.extract_text(df.select("html"), model).columns == ["text"]
    assert not pages.fit(df.limit(0)).own.any()
