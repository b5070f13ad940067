"""A small tolerant reader of HTML pages: block elements, runs of text in them, and their features."""

from __future__ import annotations

import html
import re

import numpy as np

# How HTML names its elements.
RAW = frozenset("script style textarea title noscript iframe template".split())
#: Raw elements that hold the rest of a page if nothing closes them; of the others an opening without an end means nothing.
ENDLESS = frozenset("script style textarea".split())
#: Elements that break lines around themselves; whatever else a page names stands within a line, formulas and media too.
BLOCK = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup legend li listing main menu nav noframes ol optgroup p pre search section summary ul "
    "table caption colgroup thead tbody tfoot tr td th".split()
)
#: An opening element of the key closes an open one of the value that no container separates from it.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
CONTAINERS = frozenset("ul ol dl table tbody thead article section div main body".split())
# Tokens that sites use in class, id and role names.
CONTENT_NAMES = frozenset("article articlebody blog body content entry main maincontent page post story text prose".split())
OTHER_NAMES = frozenset(
    "ad ads adv advert advertisement alert aside banner bar breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disqus footer form gdpr header hidden legal links login masthead menu meta modal nav navbar navigation navi newsletter notice "
    "overlay pager pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe tags teaser toolbar top topbar tracking widget widgets".split()
)
TAG_KINDS = {
    t: k
    for k, tags in enumerate(
        ("p blockquote pre", "h1 h2 h3 h4 h5 h6", "article main", "section div center", "ul ol dl", "li dt dd", "table tbody thead tr td th",
         "nav menu", "header", "footer", "aside", "form fieldset", "figure figcaption", "body html", "#run"), 1)
    for t in tags.split()
}
OTHER_TAGS = frozenset("nav menu header footer aside form fieldset dialog".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"""\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_ENDS = re.compile(r"[.!?…](?=\s|$)")

FEATURES = 34


class Page:
    """Nodes in page order; a node is a block element or a run of text, and children follow their parent."""

    def __init__(self, source: str):
        self.tag, self.parent, self.names, self.text, self.linked = ["body"], [-1], [frozenset()], [""], [0]
        self.hidden = [False]
        self._read(source)

    def _node(self, tag: str, parent: int, names: frozenset = frozenset(), text: str = "", linked: int = 0, hidden: bool = False) -> int:
        for column, value in ((self.tag, tag), (self.parent, parent), (self.names, names), (self.text, text), (self.linked, linked), (self.hidden, hidden)):
            column.append(value)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack = [0]
        run: list[str] = []
        linked = 0
        links = 0
        drawing = False
        at = 0
        raw: str | None = None

        def end_run() -> None:
            nonlocal linked
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                self._node("#run", stack[-1], text=text, linked=min(linked, len(text)))
            run.clear()
            linked = 0

        def say(text: str) -> None:
            nonlocal linked
            if text and not drawing:
                run.append(text)
                if links:
                    linked += len(text.strip())

        while True:
            if raw is not None:
                close = re.compile(rf"</{re.escape(raw)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                rest = len(source) if raw in ENDLESS else at
                body_end, after = (close.start(), close.end()) if close else (rest, rest)
                if raw == "textarea":
                    say(source[at:body_end])
                at, raw = after, None
                continue
            token = _TOKEN.search(source, at)
            if token is None:
                say(source[at:])
                break
            if token.start() > at:
                say(source[at : token.start()])
            at = token.end()
            if token.group(2) is None:
                continue
            tag, closing, attributes = token.group(2).lower(), bool(token.group(1)), token.group(3)
            if drawing:  # a picture ends with its tag, or where an element of the page begins or ends
                if tag == "svg" and closing:
                    drawing = False
                    continue
                if tag not in BLOCK or (closing and all(self.tag[i] != tag for i in stack)):
                    if tag in ("script", "style") and not closing:
                        raw = tag
                    continue
                drawing = False
            if tag in RAW and not closing:
                raw = tag
                continue
            if tag == "svg":
                drawing = not closing and not attributes.rstrip().endswith("/")
                continue
            if tag == "a":
                links = 0 if closing else 1
                continue
            if tag == "br":
                run.append(" ")
                continue
            if tag == "hr":
                end_run()
                continue
            if tag not in BLOCK:
                continue
            end_run()
            links = 0
            if closing:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] == tag:
                        del stack[depth:]
                        break
                continue
            if self.tag[stack[-1]] == "p":
                stack.pop()
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = self.tag[stack[depth]]
                if open_tag in CLOSES.get(tag, ()):
                    del stack[depth:]
                    break
                if open_tag in CONTAINERS:
                    break
            names = frozenset(
                part.lower() for m in _NAMES.finditer(attributes) for part in _PARTS.findall(m.group(1) or m.group(2) or m.group(3) or "")
            ) if attributes else frozenset()
            stack.append(self._node(tag, stack[-1], names, hidden=bool(attributes and _HIDDEN.search(attributes))))
        end_run()

    def features(self) -> np.ndarray:
        """A row of ``FEATURES`` for every node: density of its subtree, tokens, depth, siblings and ancestors."""
        n = len(self.tag)
        chars, linked, nodes, runs, ends, words = ([0] * n for _ in range(6))
        children = [0] * n
        for i in range(n - 1, -1, -1):
            text = self.text[i]
            if text:
                chars[i] += len(text)
                linked[i] += self.linked[i]
                runs[i] += 1
                ends[i] += len(_ENDS.findall(text))
                words[i] += text.count(" ") + 1
            nodes[i] += 1
            p = self.parent[i]
            if p >= 0:
                for column in (chars, linked, nodes, runs, ends, words):
                    column[p] += column[i]
                children[p] += 1
        depth, bad_above, good_above, other_above, hidden_above, place = ([0] * n for _ in range(6))
        seen = [0] * n
        rows = []
        total = max(1, chars[0])
        largest = max((chars[i] for i in range(n) if self.tag[i] == "#run"), default=1) or 1
        before = 0
        for i in range(n):
            p = self.parent[i]
            bad, good = len(self.names[i] & OTHER_NAMES), len(self.names[i] & CONTENT_NAMES)
            other = self.tag[i] in OTHER_TAGS
            if p >= 0:
                depth[i] = depth[p] + 1
                place[i] = seen[p]
                seen[p] += 1
            bad_above[i] = (bad > 0) + (bad_above[p] if p >= 0 else 0)
            good_above[i] = (good > 0 or self.tag[i] in ("article", "main")) + (good_above[p] if p >= 0 else 0)
            other_above[i] = other + (other_above[p] if p >= 0 else 0)
            hidden_above[i] = self.hidden[i] or (p >= 0 and hidden_above[p])
            own = chars[i]
            siblings = children[p] if p >= 0 else 1
            up = chars[p] if p >= 0 else own
            parent_kind = TAG_KINDS.get(self.tag[p], 0) if p >= 0 else 0
            text = self.text[i]
            rows.append((
                TAG_KINDS.get(self.tag[i], 0), parent_kind, depth[i], bad, good, bad_above[i], good_above[i], other_above[i], float(hidden_above[i]),
                own, linked[i] / max(1, own), nodes[i], own / nodes[i], runs[i], own / max(1, runs[i]), ends[i], ends[i] / max(1, words[i]),
                words[i], own / max(1, words[i]), own / total, before / total, siblings, place[i] / max(1, siblings - 1), place[i],
                own / max(1, up), (up - own) / max(1, siblings - 1), (linked[p] if p >= 0 else 0) / max(1, up), nodes[p] if p >= 0 else 0,
                children[i], float(bool(text) and text[-1] in ".!?…"), float("©" in text or "|" in text), own / largest,
                bad_above[p] if p >= 0 else 0, other_above[p] if p >= 0 else 0,
            ))
            before += len(text)
        return np.array(rows, dtype=np.float64)
