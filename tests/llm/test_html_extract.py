"""Main text of small pages; minimum cuts against all labellings."""

import itertools
import random
import time

import pytest

from reviewscope.llm import html_extract as hx
from reviewscope.llm.common import read_table

P = "This is a sentence of the article that says something. "


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<<<>>><p", ""), ("<html><head><title>T</title></head><body></body></html>", ""),
    (f"<body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>{P}<p>x  <b>y</b>\n z&nbsp;&lt;&#233;</article><footer>(c)</footer>",
     f"A & B\n{P.strip()}\nx y z <é"),
    (f"<main><p>{P}</p><form><label>Mail</label></form><aside><p>{P}</p></aside><div class='ad-box'><p>{P}</p></div><p>Short</p></main>",
     f"{P.strip()}\nShort"),
    (f"<div><p>{P * 3}</p><script>var a='<p>no</p>';</script><style>p{{}}</style><!-- no --><p>{P}</p></div><ul class=menu><li><a href=x>One</a><li><a href=y>Two</a></ul>",
     f"{(P * 3).strip()}\n{P.strip()}"),
    (f"<article><p>{P}</p><section id=comments><div class=comment><p>{P * 4}</p></div></section></article>", P.strip()),
    (f"<header><h1>Site</h1></header><div class=cookie-notice><p>{P}</p></div><article><header><h1>Title of it</h1></header><p>{P}<br>{P}</p></article>",
     f"Title of it\n{P.strip()} {P.strip()}"),
    (f"<html><head><title>T</title><p>{P}", P.strip()),
    ("Some text without tags", "Some text without tags"),
    ("<body><h1>Recipe</h1><ul><li>2 eggs<li>1 cup of milk</ul>", "Recipe\n2 eggs\n1 cup of milk"),
    (f"<article><noscript>Turn it on<p>{P}</p><button>Buy<p>x</p></article>", f"{P.strip()}\nx"),
    (f"<article><noscript><p>Turn it on</p></noscript><p>{P}<button>Buy</button></p></article>", P.strip()),
    (f"<article><p>One <span class=share>tell all</span> two.</p><div class=notice-board><p>{P}</p></div></article>", f"One two.\n{P.strip()}"),
    (f"<div class=notice><p>{P}</p></div><article><p>Short</p><ul><li><a href=x>One</a><li><a href=y>Two</a></ul><p><a href=z>Go</a></p></article>", "Short\nGo"),
    (f"<article><p><b>{P}<br><p>{P}</article>", f"{P.strip()}\n{P.strip()}"),
])
def test_pages(html, text):
    assert hx.main_text(html) == text


def test_minimum_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 8)
        odds = [rng.choice([-3, -1, -0.5, 0.2, 0.5, 1, 4]) for _ in range(n)]
        edges = {(a, b): rng.choice([0.3, 0.8, 2.0]) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5}

        def cost(labels):
            own = sum(max(-o, 0) if x else max(o, 0) for o, x in zip(odds, labels))
            return own + sum(w for (a, b), w in edges.items() if labels[a] != labels[b])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(hx.minimum_cut(odds, edges)) == pytest.approx(best)


def test_flow_decides_large_kernels_too():
    rng = random.Random(2)
    n = 3000
    odds = [rng.choice([-3, -1, 1, 3]) for _ in range(n)]
    edges = {(i, i + 1): 2 for i in range(n - 1)} | {(i, i + 40): 1 for i in range(n - 40)}
    kept = hx.minimum_cut(odds, edges)
    for flip in range(n):
        own = odds[flip] if kept[flip] else -odds[flip]
        assert own + sum(w if kept[a] == kept[b] else -w for (a, b), w in edges.items() if flip in (a, b)) >= 0


def test_elements_and_blocks_pull_each_other():
    page = hx.PageReader(f"<article><p>{P * 3}</p><div>Short</div></article><div class=ad><p>{P * 3}</p></div>")
    odds, edges = hx.page_graph(page)
    assert [x > 0 for x in odds[:3]] == [True, False, True]
    assert hx.minimum_cut(odds, edges)[:3] == [True, True, False]


def test_long_and_broken_pages():
    assert hx.main_text("<div>" * 3000 + f"<p>{P}") == P.strip()
    assert hx.main_text("<b>" * 20000 + "x") in ("", "x")
    many = "<article>" + "".join(f"<p>Line {i} of many.</p>" for i in range(20000))
    assert hx.main_text(many).count("\n") == 19999
    start = time.perf_counter()
    assert hx.main_text("<div>" * 20000 + P + "</section>" * 20000) == P.strip()
    assert time.perf_counter() - start < 2.0


def test_given_pages_and_odd_rows(spark, sf_dir):
    import html
    import re

    pages = read_table(spark, sf_dir, "pages")
    weights = hx.fit_weights(pages)
    assert weights == hx.fit_weights(pages.unionByName(pages).repartition(5)) and weights != hx.PRIOR
    differ = 0
    for r in hx.extract_pages(pages, weights=weights).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r["main_text"] == "\n".join(b for b in blocks if b)
        page = hx.PageReader(r["html"])
        odds, edges = hx.page_graph(page, weights)
        differ += sum((o > 0) != kept for o, kept in zip(odds, hx.minimum_cut(odds, edges)[:len(page.blocks)]))
    assert differ >= 20, differ
    odd = spark.createDataFrame([(None, None, None, "k"), (1, "u", f"<p>{P}", "k"), (1, "u", f"<p>{P}", "k")], "page_id bigint, url string, html string, text string")
    assert hx.fit_weights(odd) == hx.fit_weights(odd.limit(0)) == hx.PRIOR
    assert sorted(r["main_text"] for r in hx.extract_pages(odd).collect()) == ["", P.strip(), P.strip()]
    assert hx.extract_pages(odd.limit(0)).collect() == []
