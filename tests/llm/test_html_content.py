"""Malformed tags, deep and long pages, odd tables."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tripmill.llm import html_content as hc

PARAGRAPHS = [
    "The committee met on the second day and agreed to publish its findings in full.",
    "A river runs behind the house, and in spring it comes up to the old stone wall.",
    "Nobody had expected the letter to arrive before the end of that long winter.",
]


@pytest.fixture(scope="module")
def model():
    return hc.train(hc.labelled_pages())


@pytest.mark.parametrize(
    "tag",
    [
        '<p class=a">',
        "<p class=a'>",
        '<p class="a"">',
        "<p 'class>",
        '<p "quoted" x>',
        "<p class = 'a>b'>",
        '<p title="a > b" class=c>',
        "<p a=b=c>",
        '<p title=">">',
        "<p\n\tclass\n=\n'x'\n>",
        "<p class=>",
        "<P CLASS=A>",
        "<p/>",
        "<p class='it\"s'>",
    ],
)
def test_tags_end_where_browsers_end_them(model, tag):
    body = "".join(f"{tag}{p}</p>" for p in PARAGRAPHS) + '<p>and <a href="x">a link</a> in it, at the very end.</p>'
    text = hc.content_of(model, [f"<html><body><article>{body}</article></body></html>"])[0]
    assert text == "\n\n".join([*PARAGRAPHS, "and a link in it, at the very end."])


def test_a_quote_that_never_ends_takes_no_more_than_its_tag(model):
    page = f'<article><p>{PARAGRAPHS[0]}</p><p title="open>{PARAGRAPHS[1]}</p><p>{PARAGRAPHS[2]}</p></article>'
    assert hc.content_of(model, [page])[0] == "\n\n".join(PARAGRAPHS)


def test_deep_pages_take_time_in_proportion(model):
    def seconds(n):
        began = time.perf_counter()
        hc.content_of(model, ["<div>" * n + f"<p>{PARAGRAPHS[0]}</p>" + "</div>" * n])
        hc.content_of(model, ["<p><b>" * n + PARAGRAPHS[0]])
        return time.perf_counter() - began

    seconds(500)
    small, large = seconds(4_000), seconds(40_000)
    assert large < 30 * small + 1 and large < 60


def marginals_by_enumeration(model, nodes):
    n = len(nodes.parent)
    total = np.zeros((n, 2))
    for code in range(2**n):
        labels = [code >> k & 1 for k in range(n)]
        score = 0.0
        for k, label in enumerate(labels):
            above = nodes.parent[k]
            score += model.root[label] if above < 0 else model.edge(nodes.tag[above], nodes.tag[k])[labels[above], label]
            score += sum(model.unary[f][label] for f in hc.features(nodes, k, hc.Shape.of(nodes)) if f in model.unary)
        for k, label in enumerate(labels):
            total[k, label] += np.exp(score)
    return total[:, 1] / total.sum(axis=1)


def test_marginals_of_some_pages(model):
    for page in (
        "plain text",
        "<div class=menu><ul><li><a href=/>Home</a></ul></div><p>A sentence of text.</p>",
        "<article><p>One.</p><aside>Two</aside><div><p>Three, and more.</p></div></article>",
        "<p>a<p>b<p>c<table><tr><td>d</table>",
    ):
        nodes = hc.Nodes()
        hc.parse(page, 0, nodes)
        assert model.marginals(nodes) == pytest.approx(marginals_by_enumeration(model, nodes), abs=1e-9)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>"])
@pytest.mark.parametrize(
    "furniture",
    [
        '<div class="rhs"><p>{}</p></div>',
        '<div class="disclaimer"><p>{}</p></div>',
        '<div class="user-feedback"><div><p>{}</p></div></div>',
        '<div class="q7"><ul><li><a href="/1">One thing</a><li><a href="/2">Another thing</a></ul></div>',
        "<nav><a href=/>Home</a></nav>",
        "<footer>bye</footer>",
        '<div class="k7"><a href="/">Home</a> <a href="/b">About us</a></div>',
    ],
)
def test_furniture_of_unseen_names(model, wrap, furniture):
    beside = furniture.format(PARAGRAPHS[1])
    page = f"<html><body>{beside}{wrap.format(''.join(f'<p>{p}</p>' for p in PARAGRAPHS * 2))}{beside}</body></html>"
    assert hc.content_of(model, [page])[0] == "\n\n".join(PARAGRAPHS * 2)


@pytest.mark.parametrize("n", [1, 30, 300, 5000])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div><div>{}</div></div>", "{}"])
def test_articles_of_any_length_stay(model, wrap, n):
    paragraphs = [PARAGRAPHS[k % 3] for k in range(n)]
    assert hc.content_of(model, [wrap.format("".join(f"<p>{p}</p>" for p in paragraphs))])[0] == "\n\n".join(paragraphs)


def test_odd_tables(spark, model):
    long = "<article>" + "".join(f"<p>{k} {p}</p>" for k in range(4000) for p in PARAGRAPHS) + "</article>"
    rows = [(1, None), (2, ""), (3, "plain text, &amp; no markup."), (4, long), (5, long), (6, "<script>x</script>"), (None, "<article><p>No key.</p></article>")]
    frame = spark.createDataFrame([(k, h, "kept", 7) for k, h in rows], "page_id long, html string, Text string, url int")
    found = hc.extract(frame, model=model)
    assert [c.lower() for c in found.columns] == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: r.text for r in found.collect()}
    assert got[1] == got[2] == got[6] == "" and got[3] == "plain text, & no markup."
    assert got[4] == got[5] == "\n\n".join(f"{k} {p}" for k in range(4000) for p in PARAGRAPHS)
    assert got[None] == "No key."
    assert hc.extract(frame.limit(0)).count() == 0
