"""Exact top-k against brute force; HTML extraction against known main texts."""

import math
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadledger.llm import labeller
from roadledger.llm.html_extract import CONTENT, blocks, made_up_pages, main_text, weak_labels
from roadledger.llm.topk import _possible, top_k

NAN, INF = float("nan"), float("inf")


def brute(rows, k):
    kept = [(i, n, [math.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qid, n, q in kept:
        if qid % 5 == 0:
            scores = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), i) for i, m, v in kept if m != n)[:k]
            out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, score int")
    out = top_k(df, F.col("id") % 5 == 0, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out)


def test_top_k(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(6, 12))
    rows = [(i, [float(x) for x in (centres[i % 6] + 0.05 * random.normal(size=12)) * random.lognormal(0, 1)]) for i in range(160)]
    rows += [(300 + i, [1.0] * 12) for i in range(30)] + [(400, [0.0] * 12), (401, [0.5, 0.25]), (405, [])]
    rows += [(500, None), (505, [1.0, NAN]), (510, [INF] * 12), (515, [None, 1.0]), (None, [1.0] * 12), (520, [-1.0] * 12)]
    assert found(spark, rows, bucket=16, queries=7) == brute(rows, 5)


def test_top_k_edges(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, [1.0, 2.0])]) == []
    few = [(i, [float(i), 1.0]) for i in range(4)]
    none = [(i, []) for i in range(7)]
    assert found(spark, none) == brute(none, 5)
    assert found(spark, few) == brute(few, 5)
    huge = [(i, [float(i) * 1e12, 3.0e9, -7.0e8]) for i in range(9)]
    # Scores beyond 64 bits are held at its limits, where they tie.
    assert found(spark, huge, k=3) == brute(huge, 3) and found(spark, huge, k=3)[0][3] == 2**63 - 1
    # Beyond 53 bits neighbours differ by less than a double can tell.
    large = [(i, [2.0**21, 2.0**20 + i / 256, -7.0]) for i in range(12)]
    assert found(spark, large, k=4) == brute(large, 4) and found(spark, large, k=4)[0][3] > 2**53


def test_coordinates_lose_nothing():
    random = np.random.default_rng(7)
    unit = random.normal(size=(4000, 5))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for local in (0.5, 0.8, 0.95, 0.999):
        q = random.normal(size=5)
        q = np.array([9.0, 0.1, 0, 0, 0]) if local == 0.8 else q
        norm = float(np.linalg.norm(q))
        good = set(np.nonzero(unit @ q / norm >= local)[0].tolist())
        kept = _possible(q, norm, unit, local)
        assert good <= set(kept.tolist()) and len(kept) < len(unit)


def test_gradients():
    random = np.random.default_rng(1)
    pages = [random.normal(size=(n, labeller.INPUTS)).astype(np.float32) for n in (3, 5)]
    labels = [random.integers(0, 2, n).astype(np.float32) for n in (3, 5)]
    net = {k: v.astype(np.float64) for k, v in labeller.start().items()}
    _, grads = labeller.loss_and_grads(net, pages, labels)
    for name in ("xf", "hb", "cf", "out", "bias"):
        place = tuple(random.integers(0, s) for s in net[name].shape)
        step, sides = 1e-3, []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in net.items()}
            moved[name][place] += sign * step
            sides.append(labeller.loss_and_grads(moved, pages, labels)[0])
        assert grads[name][place] == pytest.approx((sides[0] - sides[1]) / (2 * step), abs=2e-3)


def test_blocks():
    page = ("<!DOCTYPE html><title>no</title><script>var a='</p>';</script><body class=x><nav><a href=/>home</a></nav>"
            "<article><h1>A &amp; B</h1><p>one <b>two</b>\n three&nbsp;<br>four<p>five<ul><li>six<li>seven</ul><!-- <p>x -->"
            "<p title='a > b'>eight &lt;tag&gt; &copy</article><footer>end")
    assert [b.text for b in blocks(page)] == ["home", "A & B", "one two three four", "five", "six", "seven",
                                             "eight <tag> ©", "end"]
    assert blocks(page)[0].links == 1 and blocks(page)[2].path == ("body.x", "article", "p")
    assert blocks(None) == blocks("") == blocks("<p> </p><") == [] or [b.text for b in blocks("<p> </p><")] == ["<"]
    assert [b.text for b in blocks("a < b </p> c <p cl")] == ["a < b", "c"]
    assert len(blocks("<a \"" * 20000)) <= 1 and blocks("<div>" * 3000 + "x")[0].text == "x"


def test_blocks_without_end_tags():
    top = "<!DOCTYPE html><html><head><meta charset=utf-8><title>no</title><link rel=x><style>p > a {}</style>"
    for start, path in (("<body class=x>", ("html", "body.x", "p")), ("", ("html", "p")), ("</head><body>", ("html", "body", "p"))):
        page = f"{top}{start}<p>one<p>two <b>three"
        assert [b.text for b in blocks(page)] == ["one", "two three"] and blocks(page)[0].path == path
    assert [b.text for b in blocks(f"{top} \n bare text <p>one")] == ["bare text", "one"]
    assert [b.text for b in blocks(f"{top}<noscript><img src=x>no</noscript><template><p>no</template><div>one")] == ["one"]
    assert [b.text for b in blocks("<body><p>one<head><title>no</title></head><p>two")] == ["one", "two"]
    for icon in ("<svg/>", "<svg class='i' />", "<svg><path d='M0'/><title/><style/></svg>", "<svg><g><path/></svg>",
                 "<svg width=10/>no</svg>"):
        assert [b.text for b in blocks(f"<article><p>one</p>{icon}<p>two</article>")] == ["one", "two"], icon
    assert [b.text for b in blocks("<p>one<div/>two</div><iframe/>no</iframe>three")] == ["one", "two", "three"]


def test_long_quoted_attributes():
    for inner in ("<div class=ad><p>no</p></div>" * 500, "x > y " * 2000, "if (a > b && c < d) e();" * 400, "<" * 5000, "<b>"):
        for sign, other in ("\"'", "'\""):
            page = f"<div class=post data-x={sign}{inner}{other}{sign} id = {sign}main{sign}><p>one</p><a href=/ title={sign}{inner}{sign}>two</a></div><p>three"
            assert [(b.path, b.text) for b in blocks(page)] == [
                (("div.post.main", "p"), "one"), (("div.post.main",), "two"), (("p",), "three")], inner[:9]
    assert blocks("<div class='[&>svg]:w-4 post'>one")[0].path == ("div.[&>svg]:w.4.post",)
    assert [b.text for b in blocks("<p title=Bob's>it's <b x=\"1\"\">one</b> > two's")] == ["it's one > two's"]
    assert [b.text for b in blocks("<a href=\"x>one</a><p>two")] == ["one", "two"]
    for page in ("<a b='' b=", "<a b=\"", "<a b=\"<", "<a b='<a c=\"", "<a b='' c='<", "<a '", "<a =", "<a b=\"'\" c='\"' "):
        started = time.perf_counter()
        blocks(page * 40000)
        assert time.perf_counter() - started < 8, page


def test_deep_pages_take_linear_time():
    """A megabyte of open elements, of every kind that a question about the stack could walk over."""
    for unit, tail in (("<div>x", ""), ("<b>x", ""), ("<a>x", ""), ("<b>", "<hr>x"), ("<svg><g>", "<p>x"), ("<li><b>", "</i>x"),
                       ("<div>", "<p>x</p>"), ("<head><g>", "<div>")):
        page = unit * (500_000 // len(unit)) + tail * (500_000 // max(1, len(tail)))
        started = time.perf_counter()
        found = blocks(page)
        rows = labeller.vectors(found[:20_000])
        weak_labels(found, CONTENT)
        assert time.perf_counter() - started < 12, unit
        assert len(rows) == min(len(found), 20_000)
    deep = blocks("<div class=ad>x" * 40 + "<p>y")
    for block, row in zip(deep, labeller.vectors(deep)):
        want = np.zeros(labeller.PATHS, np.float32)
        for token in (t for label in block.path for t in label.split(".")):
            place, sign = labeller._slot(token, labeller.PATHS)
            want[place] = sign
        assert (row[:labeller.PATHS] == want).all()


def test_formulas():
    formula = ("<math display=block><semantics><mrow><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mspace width=1em /><mn>4</mn></mrow>"
               "<annotation encoding=tex>no</annotation><annotation-xml><ci>no</ci></annotation-xml></semantics></math>")
    found = blocks(f"<article><p>As {formula} holds, <b>so</b> does <math/>this.</p><p>two</article>")
    assert [(b.path, b.text) for b in found] == [(("article", "p"), "As x2=4 holds, so does this."), (("article", "p"), "two")]


ARTICLE = "The quiet harbour kept its lights on through the winter, and nobody asked why."


def test_main_text(spark):
    page = (f"<html><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav><article><h1>Harbour</h1>"
            f"<p>{ARTICLE}</p><p>{ARTICLE}</p></article><div class=comments><p>Nice post, thank you.</p></div>"
            f"<footer>All rights reserved</footer></body></html>")
    rows = [(1, "u", page, "t"), (2, None, None, "t"), (3, "u", "", "t"), (1, "u", page, "t"), (None, "u", "<p", None),
            (4, "u", "<nav><a href=/>x</a></nav>", None), (5, "u", page.replace("<p>", "<p>" + "many words " * 20000), None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = sorted(((r.page_id, r.text) for r in main_text(df).collect()), key=repr)
    want = f"Harbour\n\n{ARTICLE}\n\n{ARTICLE}"
    long = f"Harbour\n\n{'many words ' * 20000}{ARTICLE}\n\n{'many words ' * 20000}{ARTICLE}"
    assert out == sorted([(1, want), (1, want), (2, ""), (3, ""), (4, ""), (5, long), (None, "")], key=repr)
    assert main_text(df.limit(0)).count() == 0


def test_new_layouts():
    net = labeller.fit(*zip(*[(labeller.vectors(p), weak_labels(p, CONTENT)) for p in map(blocks, made_up_pages(160, 1))
                              if p and weak_labels(p, CONTENT) is not None]))
    held = [(p, weak_labels(p, CONTENT)) for p in map(blocks, made_up_pages(80, 2)) if p and weak_labels(p, CONTENT) is not None]
    right = [((s >= 0.5) == y).mean() for s, (_, y) in zip(labeller.label(net, [labeller.vectors(p) for p, _ in held]), held)]
    assert np.mean(right) > 0.97


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver tables are not here")
def test_pages_of_the_driver(spark):
    """The article's own mark-up says what is right here."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    for r in pages.collect():
        inside = [b.text for b in blocks(r.html) if "article" in b.path]
        assert got[r.page_id] == "\n\n".join(inside)
