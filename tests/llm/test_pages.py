"""Main text of pages whose containers do not say what they hold, and of broken ones."""

import os
import time

import numpy as np
import pytest

from stairfare.llm import page_text

PAGES = "/root/testdata/sf0.01/pages.parquet"
PROSE = "The lounge on the second floor is open to all guests of this fare, and a light meal is served there until midnight. Bags may be left at the desk. " * 2
PARTS = ["Lounge rules"] + [f"{i} {PROSE.strip()}" for i in range(6)]
BODY = f"<h1>{PARTS[0]}</h1>" + "".join(f"<p>{p}</p>" for p in PARTS[1:])
TOP = "<div class='tp'><ul><li><a href=x>Home</a></li><li><a href=x>Flights</a></li><li><a href=x>Offers</a></li><li><a href=x>Cars</a></li></ul></div>"
END = "<div class='bt'><a href=x>Imprint</a> <a href=x>Contact</a> <a href=x>Terms</a></div>"


@pytest.fixture(scope="module")
def model(spark):
    if not os.path.exists(PAGES):
        pytest.skip("driver tables are absent")
    return page_text.train(spark.read.parquet(PAGES))


@pytest.mark.parametrize("wrap", [("<div>", "</div>"), ("<section class='text-block'>", "</section>"), ("<div class='article ad-free'>", "</div>"),
                                  ("<form><article>", "</article></form>"), ("<table><tr><td>", "</td></tr></table>")])
def test_main_text_without_telling_names_comes_back_whole(model, wrap):
    html = f"<html><body>{TOP}{wrap[0]}{BODY}{wrap[1]}{END}</body></html>"
    assert page_text.extract_pages(model, [html])[0] == "\n".join(PARTS)


def test_named_boilerplate_stays_out_even_if_it_is_prose(model):
    for name in ("sidebar", "comments", "cookie notice", "related"):
        html = f"<html><body><nav><a href=x>Home</a></nav><article>{BODY}</article><div class='{name}'><p>{PROSE}</p></div></body></html>"
        assert page_text.extract_pages(model, [html])[0] == "\n".join(PARTS)


def test_named_pages_of_the_table_follow_their_names(spark, model):
    htmls = [r.html or "" for r in spark.read.parquet(PAGES).select("html").collect()]
    want = ["\n".join(t for p, t, _ in page_text.blocks(h) if page_text.container_vote(p) > 0) for h in htmls]
    got = page_text.extract_pages(model, htmls)
    assert sum(a == b for a, b in zip(got, want)) >= 0.99 * len(htmls)


def test_votes_of_containers():
    vote = page_text.container_vote
    assert vote(("html", "body", "article", "p")) == 1 and vote(("html", "body", "div text", "p")) == 0
    assert vote(("body", "article", "div comments", "p")) == vote(("body", "aside", "article")) == -1
    assert vote(("body", "form", "article", "p")) == 1 and vote(("body", "article", "form", "p")) == -1
    assert vote(("body", "div article ad free", "p")) == 0


def test_blocks_of_odd_markup():
    texts = lambda h: [t for _, t, _ in page_text.blocks(h)]
    assert texts("a < b <p title='x>y'>c&amp;d<br>e<!-- <p>no --><script>if (a<b) {}</script> f") == ["a < b", "c&d", "e", "f"]
    assert texts("<p>one<p>two</div></p>three") == ["one", "two", "three"]
    assert texts("<a href=\"un") == ["<a href=\"un"] and texts("<![CDATA[x]]>y<!doctype html>z<?php 1?>") == ["yz"]
    assert texts("") == [] and texts("<<<>") == ["<<<>"]
    assert page_text.blocks("<div><a href=x>in</a> out</div>")[0][2] == pytest.approx(2 / 6)


@pytest.mark.parametrize("html", ["<a " * 20_000, "<a \"x\" " * 10_000, "<div>" * 15_000 + "</x>" * 15_000, "<p>a<b>" * 9_000, "<!" * 30_000, "<a '" * 9_000 + "<a \"" * 9_000,
                                  "<script>" * 8_000, "<!--" * 15_000, "<div>t" * 10_000])
def test_a_broken_page_takes_under_a_second(html):
    start = time.process_time()
    page_text.blocks(html)
    assert len(html) >= 60_000 and time.process_time() - start < 1


def test_awkward_pages(spark, model):
    long = f"<article>{BODY * 300}</article>"
    rows = [(1, "u", long, 1), (2, None, None, 2), (2, None, None, 2), (None, "u", f"<article>{BODY}</article>", 3), (3, "u", "", 4), (4, "u", "<p", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id or 0, r.url, r.text) for r in page_text.extract(df, model, carry=("url",)).collect()), key=str)
    assert [(k, len(t)) for k, _, t in got if k in (0, 1)] == [(0, len("\n".join(PARTS))), (1, len("\n".join(PARTS * 300)))]
    assert [t for k, _, t in got if k in (2, 3)] == ["", "", ""]
    assert page_text.extract(df.limit(0), model).count() == 0
    assert page_text.train(df.limit(0)).p.keys() == model.p.keys()


def test_gradients_of_the_labeller_are_right():
    rng = np.random.default_rng(1)
    m = page_text.Labeller()
    x = rng.standard_normal((5, 2, m.p["Wf"].shape[0])) * 0.3
    lengths, y, weight = np.array([5, 3]), (rng.random((5, 2)) > 0.5).astype(float), np.array([[1, 1], [0.5, 1], [1, 0], [1, 0], [1, 0]])

    def loss():
        p = m.probabilities(x, lengths)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    found = m.gradients(x, lengths, y, weight)
    for name in ("Wf", "Ub", "bf", "v", "c"):
        at = tuple(int(rng.integers(n)) for n in m.p[name].shape)
        before = m.p[name][at]
        m.p[name][at] = before + 1e-5
        up = loss()
        m.p[name][at] = before - 1e-5
        assert found[name][at] == pytest.approx((up - loss()) / 2e-5, rel=1e-3, abs=1e-7)
        m.p[name][at] = before
