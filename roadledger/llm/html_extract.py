"""Main text of web pages: a recurrent labeller classifies every block with the whole page as context.

A page is read as its sequence of leaf blocks. A bidirectional LSTM takes each block's hashed tag path and words and
says whether it is main text. It is trained here, with weak labels: on at most ``fit_pages`` pages of the table (lowest
hash of the id first, whole pages of at most ``FIT_CHARS``) whose own mark-up names the article, where blocks inside
``article`` or ``main`` but outside navigation, adverts, forms, comments and the like are main text; and on made-up
pages of other layouts. Training touches the bounded sample only; every page is then labelled, whole, in Spark tasks.

Defined results: null or empty html gives an empty text; unclosed, cut-off or stray tags end with their parents or are
passed over; a page without main text gives an empty text; repeated rows give repeated results; an empty table gives
no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, text_of
from roadledger.llm.labeller import fit, label, vectors
from roadledger.llm.pages import Block, Step, blocks
from roadledger.llm.shingles import slices

#: Pages of the table that the labeller is trained on at most, the longest that is taken, and made-up pages.
FIT_PAGES, FIT_CHARS, MADE_UP = 256, 60_000, 160
# Names of elements and marks that tell main text from the rest in the weak labels.
MAIN = {"article", "main"}
CONTENT = {"article", "main", "content", "post", "entry", "story"}
OTHER = ("nav header footer aside form menu sidebar ad ads advert advertisement banner cookie consent notice alert comment "
         "comments reply share social related promo popup modal newsletter subscribe login breadcrumb breadcrumbs button "
         "pagination widget sponsored disclaimer toolbar").split()


def _standing(step: Step | None, content: set[str], known: dict[int, tuple[bool, bool]]) -> tuple[bool, bool]:
    """Whether a step is inside content, and inside something else that the article does not own."""
    way = []
    while step and id(step) not in known:
        way.append(step)
        step = step.above
    inside, other = known[id(step)] if step else (False, False)
    for at in reversed(way):
        tokens = at.label.split(".")
        # A header inside the article holds its title; the page's own header does not.
        other = other or any(t in OTHER for t in tokens) and not (inside and tokens[0] == "header")
        inside = inside or any(t in content for t in tokens)
        known[id(at)] = inside, other
    return inside, other


def weak_labels(page: list[Block], content: set[str] = MAIN) -> np.ndarray | None:
    """1 for main text, 0 for other blocks, of a page whose mark-up names its article, else None."""
    known: dict[int, tuple[bool, bool]] = {}
    standing = [_standing(b.at, content, known) for b in page]
    if not any(inside for inside, _ in standing):
        return None
    return np.array([inside and not other for inside, other in standing], np.float32)


def made_up_pages(count: int = MADE_UP, seed: int = 11) -> list[str]:
    """Pages of many layouts, so that no one template is all the labeller has seen."""
    pick = random.Random(seed)
    syllables = "an be co de er fi ge ha in ly mo ne on pa re st th un ver wi".split()

    def words(low: int, high: int) -> str:
        text = " ".join("".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(pick.randint(low, high)))
        return text.capitalize() + pick.choice([".", ".", "!", ""])

    def paragraphs(n: int, low=8, high=60) -> str:
        return "".join(pick.choice(["<p>{}</p>", "<p>{}", "<p><b>{}</b></p>", "<p>{}<br></p>", "<h2>{}</h2>", "<blockquote>{}</blockquote>",
                                    "<ul><li>{}</li></ul>", "<pre>{}</pre>"]).format(words(low, high)) for _ in range(n))

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{words(1, 3)}</a></li>' for k in range(n))

    def extra() -> str:
        name = pick.choice(OTHER)
        body = pick.choice([lambda: f"<ul>{links(pick.randint(2, 8))}</ul>", lambda: words(3, 30), lambda: paragraphs(2, 4, 30),
                            lambda: f"<h3>{words(1, 3)}</h3><p>{words(4, 40)}</p>",
                            lambda: f"<label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>"])()
        if name in ("nav", "header", "footer", "aside", "form") and pick.random() < 0.7:
            return f"<{name}>{body}</{name}>"
        tag = pick.choice(["div", "section", "div", "ul", "p"]) if "<" not in body else pick.choice(["div", "section"])
        return f'<{tag} {pick.choice(["class", "id"])}="{name}{pick.choice(["", "", "-box", " wide"])}">{body}</{tag}>'

    out = []
    for _ in range(count):
        opening, closing = pick.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
                                        ('<div id="main-content"><article class="post">', "</article></div>"),
                                        ('<section class="entry">', "</section>"), ('<div class="story">', "</div>")])
        inner = f"<h1>{words(2, 9)}</h1>" * (pick.random() < 0.8) + paragraphs(pick.randint(1, 9))
        inner += extra() * (pick.random() < 0.3) + paragraphs(pick.randint(0, 4)) + extra() * (pick.random() < 0.2)
        before = "".join(extra() for _ in range(pick.randint(0, 3)))
        after = "".join(extra() for _ in range(pick.randint(0, 3)))
        out.append(f"<html><body>{before}{opening}{inner}{closing}{after}</body></html>")
    return out


def fit_labeller(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = FIT_PAGES) -> dict:
    """Weights of the labeller, trained on a bounded sample and made-up pages."""
    rows = addressed(pages, "pages")
    text = text_of(rows, html_col)
    # The addresses of the sample are chosen first, so that no other page travels.
    chosen = (rows.where(F.char_length(text).between(1, FIT_CHARS)).select(F.xxhash64(rows[id_col]).alias("order"), *ADDRESS)
              .orderBy("order", *ADDRESS).limit(fit_pages).select(*ADDRESS))
    sample = rows.select(*ADDRESS, text.alias("html")).join(F.broadcast(chosen), ADDRESS).orderBy(*ADDRESS).collect()
    known = [(page, weak_labels(page)) for page in (blocks(r.html) for r in sample)]
    known += [(page, weak_labels(page, CONTENT)) for page in map(blocks, made_up_pages())]
    known = [(page, y) for page, y in known if y is not None and len(page)]
    return fit([vectors(page) for page, _ in known], [y for _, y in known])


def _extracted(net: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            pages = [blocks(page) for page in part.column("html").to_pylist()]
            kept = label(net, [vectors(page) for page in pages])
            texts = ["\n\n".join(b.text for b, p in zip(page, scores) if p >= 0.5) for page, scores in zip(pages, kept)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), part.column(FILE), part.column(ROW), pa.array(texts, pa.string())],
                names=["id", "url", FILE, ROW, "text"])

    return run


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """One row per row of ``pages``: id, url, address and ``text``."""
    net = fit_labeller(pages, id_col, html_col, **options)
    rows = addressed(pages, "pages")
    ids = pages.schema[id_col].dataType.simpleString()
    return rows.select(rows[id_col].alias("id"), rows[url_col].cast("string").alias("url"), *ADDRESS,
                       text_of(rows, html_col).alias("html")).mapInArrow(
        _extracted(net), f"id {ids}, url string, {FILE} bigint, {ROW} bigint, text string"
    ).withColumnsRenamed({"id": id_col, "url": url_col})
