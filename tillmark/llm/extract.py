"""Main text of web pages by gradient-boosted trees over DOM nodes, with hierarchical decoding.

The trees give every node, block element or run of text, the odds of holding main text. The decoding picks
the most likely labels of a whole page under one rule: below a node without main text there is none. It is
one pass up the tree and one down, so an ancestor and a descendant never contradict each other.

The trees are trained on pages that are put together here from the runs of a bounded sample of the given
pages, in layouts of many kinds, so that the label of each run is known.
"""

from __future__ import annotations

import html
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.boosting import Boosted
from tillmark.llm.boosting import fit as fit_trees
from tillmark.llm.dom import FEATURES, Page
from tillmark.llm.texts import with_texts

#: About as many pages give so many of their runs for training, and so many pages are put together from them.
SAMPLED_PAGES = 150
RUNS_PER_PAGE = 40
TRAINING_PAGES = 700
SEED = 29
MARK = "\ue000"  # a private character at the start of every main run of a training page


def _wrap(rng: random.Random, choices: str, inside: str) -> str:
    """``inside`` in one of the elements of ``choices``: tag or tag.class or tag#id, by spaces."""
    tag, _, name = (choice := rng.choice(choices.split())).replace("#", ".").partition(".")
    attribute = f' {"id" if "#" in choice else "class"}="{name}"' if name else ""
    return f"<{tag}{attribute}>{inside}</{tag}>"


def training_page(rng: random.Random, long: list[str], short: list[str]) -> str:
    """A page of random layout whose main runs start with ``MARK``."""
    say = lambda texts: html.escape(rng.choice(texts))
    words = lambda: " ".join(say(short).split()[: rng.randint(1, 4)])
    paragraph = lambda: f"<p>{say(long)}</p>" if rng.random() < 0.7 else f"<p>{say(short)}</p>"

    def links(k: int) -> str:
        if rng.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{i}">{words()}</a></li>' for i in range(k)) + "</ul>"
        return " ".join(f'<a href="/{i}">{words()}</a>' for i in range(k))

    def menu() -> str:
        return _wrap(rng, "nav nav nav.main div.menu div.navbar div#navigation ul.nav div.breadcrumbs div", links(rng.randint(2, 8)))

    def header() -> str:
        return _wrap(rng, "header header.site-header div.header div#masthead div.top-bar", (f"<h1>{words()}</h1>" if rng.random() < 0.4 else "") + rng.choice([f"<p>{say(short)}</p>", f"<span>{words()}</span>", links(3)]))

    def advert() -> str:
        return _wrap(rng, "div.ad div.ad div.ads div.advert div.sponsored div.banner aside.promo section.advertisement", rng.choice([say(short), paragraph(), f"<p>{say(short)}</p>"]))

    def notice() -> str:
        return _wrap(rng, "div.notice div.cookie-notice div#consent div.alert section.gdpr-banner div.modal div.popup dialog", rng.choice([say(short), paragraph(), f"<p>{say(short)}</p><button>{words()}</button>"]))

    def form() -> str:
        return _wrap(rng, "form form.search form.newsletter div.signup div.login-form", f"<label>{words()}</label><input name=q><button>{words()}</button>" + (f"<p>{say(short)}</p>" if rng.random() < 0.5 else "") + (f"<textarea>{words()}</textarea>" if rng.random() < 0.3 else ""))

    def sidebar() -> str:
        return _wrap(rng, "aside aside.sidebar div.sidebar div#sidebar div.widget div.related section.related-posts", (f"<h2>{words()}</h2>" if rng.random() < 0.6 else "") + rng.choice([links(4), paragraph(), paragraph() + paragraph()]))

    def comments() -> str:
        one = lambda: rng.choice([paragraph(), _wrap(rng, "div.comment li.comment article.comment", f"<b>{words()}</b>{paragraph()}")])
        return _wrap(rng, "section#comments div.comments div#comments section.reader-comments div.replies ol.comment-list div#disqus", (f"<h2>{words()}</h2>" if rng.random() < 0.5 else "") + "".join(one() for _ in range(rng.randint(1, 4))))

    def footer() -> str:
        return _wrap(rng, "footer footer footer.site div.footer div#footer div.copyright", rng.choice([f"&copy; {words()} &middot; {say(short)}", say(short), f"<p>{say(short)}</p>{links(3)}"]))

    main = lambda text: f"{MARK}{text}"

    def piece() -> str:
        kind = rng.random()
        text = main(say(long) if rng.random() < 0.75 else say(short))
        if kind < 0.6:
            return f"<p>{text}" + ("</p>" if rng.random() < 0.9 else "")
        if kind < 0.7:
            return f"<p><b>{text}<br>"
        if kind < 0.78:
            return f"<h{(k := rng.randint(2, 4))}>{main(words())}</h{k}>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{main(say(rng.choice([short, long])))}</li>" for _ in range(rng.randint(2, 4))) + "</ul>"
        if kind < 0.91:
            return f"<blockquote>{text}</blockquote>"
        if kind < 0.95:
            return f'<p>{text} <a href="/x">{words()}</a> {say(short)}</p>'
        return "<table>" + "".join(f"<tr><td>{main(words())}</td><td>{main(say(short))}</td></tr>" for _ in range(2)) + "</table>"

    pieces = [piece() for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 8, 12]))]
    if rng.random() < 0.8:
        pieces.insert(0, f"<h1>{main(words() if rng.random() < 0.5 else say(short))}</h1>")
    for other in (advert, form, sidebar, notice):
        if rng.random() < 0.12:
            pieces.insert(rng.randint(1, len(pieces)), other())
    if rng.random() < 0.15:
        pieces.append(comments())
    article = _wrap(rng, "article article article.post main main#content div.content div#main div.post-body div.entry-content section.story div div", "".join(pieces))
    before = [f() for f, share in ((notice, 0.25), (header, 0.5), (menu, 0.8), (advert, 0.5), (form, 0.2), (sidebar, 0.2)) if rng.random() < share]
    after = [f() for f, share in ((comments, 0.4), (sidebar, 0.35), (advert, 0.25), (form, 0.2), (menu, 0.15), (notice, 0.15)) if rng.random() < share]
    rng.shuffle(before)
    rng.shuffle(after)
    body = "".join(before) + article + "".join(after) + (footer() if rng.random() < 0.85 else "")
    if rng.random() < 0.3:
        body = _wrap(rng, "div div.wrapper div#page div.container", body)
    return f"<html><head><title>{words()}</title></head><body>{body}</body></html>"


def train(runs: list[str]) -> Boosted:
    """Trees from ``TRAINING_PAGES`` pages put together from ``runs``."""
    runs = sorted({r for r in runs if r and MARK not in r})
    long = [r for r in runs if len(r) >= 150] or runs
    short = [r for r in runs if len(r) < 150] or runs
    rng = random.Random(SEED)
    rows, labels = [np.zeros((0, FEATURES))], [np.zeros(0)]
    for _ in range(TRAINING_PAGES if runs else 0):
        page = Page(training_page(rng, long, short))
        label = [text.startswith(MARK) for text in page.text]
        page.text = [text.removeprefix(MARK) for text in page.text]
        for i in range(len(label) - 1, 0, -1):
            label[page.parent[i]] |= label[i]
        rows.append(page.features())
        labels.append(np.array(label, dtype=float))
    return fit_trees(np.concatenate(rows), np.concatenate(labels))


def decode(parent: list[int], log_odds: list[float]) -> list[bool]:
    """The most likely labels of a page's nodes if no labelled node has an unlabelled ancestor.

    The log likelihood of a label less that of its opposite is the log odds, so a subtree without main text
    counts 0, and one with it counts its log odds and the best of its children.
    """
    best = list(log_odds)
    for i in range(len(parent) - 1, 0, -1):
        if best[i] > 0:
            best[parent[i]] += best[i]
    kept = [False] * len(parent)
    for i, up in enumerate(parent):
        kept[i] = best[i] > 0 and (up < 0 or kept[up])
    return kept


def extract(pages: list[str | None], trees: Boosted) -> list[str]:
    """Main text of each page: its kept runs, one a line."""
    read = [Page(source or "") for source in pages]
    if not read:
        return []
    odds = trees.log_odds(np.concatenate([p.features() for p in read]))
    texts, at = [], 0
    for page in read:
        kept = decode(page.parent, odds[at : at + len(page.tag)].tolist())
        at += len(page.tag)
        texts.append("\n".join(text for text, keep in zip(page.text, kept) if keep and text))
    return texts


def _some_runs(page: Page) -> list[str]:
    """At most ``RUNS_PER_PAGE`` runs of a page, from anywhere in it: those of the smallest hash."""
    return sorted((t for t in page.text if t), key=lambda t: (zlib.crc32(t.encode("utf-8", "surrogatepass")), t))[:RUNS_PER_PAGE]


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [text for source in batch.column("html").to_pylist() for text in _some_runs(Page(source or ""))]
        yield pa.RecordBatch.from_arrays([pa.array(runs, type=pa.string())], ["run"])


def fit(pages: DataFrame) -> Boosted:
    """Trees from the runs of about ``SAMPLED_PAGES`` pages, drawn by a hash of ``page_id``."""
    n = pages.select("page_id").count()
    drawn = F.pmod(F.xxhash64("page_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < SAMPLED_PAGES / max(1, n)
    runs = pages.where(drawn).select("html").mapInArrow(_run_rows, "run string").collect()
    return train([r["run"] for r in runs])


BATCH = 256


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages`` (page_id, url, html).

    ``text`` holds the kept runs in page order, a line each: character references decoded, white space made
    one space. It is empty, never null, for null, empty or textless html. A broken page is read as far as it
    goes: an unfinished tag at its end is dropped, elements left open end with the page, an open drawing with
    the next element of the page. Very long pages are read whole. Equal pages give equal texts, repeated rows
    are rows of the result, other columns, whatever their names, are not read, no rows give no rows.
    """
    trees = fit(pages)

    def texts(sources: list) -> list[list]:
        return [[text for at in range(0, len(sources), BATCH) for text in extract(sources[at : at + BATCH], trees)]]

    found = with_texts(pages, ["page_id", "url"], "html", {"text": "string"}, texts)
    return found.withColumn("n_chars", F.length("text").cast("long"))
