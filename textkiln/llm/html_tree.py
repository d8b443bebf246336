"""Pages as trees of block elements (part of operator 10).

``parse`` reads one page's markup into block nodes (inline elements belong to
the block that holds them) and text segments in page order, each owned by a
node.  Scripts, styles and other elements without readable text never become
segments.  A node has a feature vector of its tag, of cue words in its class,
id and role, and of its text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

BLOCKS = frozenset("""html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table
caption thead tbody tfoot tr td th nav aside header footer form fieldset address details summary dialog hr center menu hgroup search legend""".split())
# No readable text inside; the first ones hold raw text up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = RAW | frozenset("head noscript template svg math canvas object audio video select button datalist map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag of these ends an open paragraph, as one of the second ends an open element of its own kind.
ENDS_P = BLOCKS - frozenset("html body caption thead tbody tfoot tr td th dt dd li summary figcaption legend".split())
ENDS_OWN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table article section div main nav aside header footer body html form td th blockquote".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORDS = re.compile(r"[a-z]+")

CUES = {
    "nav": r"nav\w*|menu\w*|breadcrumbs?|pagination|pager|toc|topbar|navbar|skip\w*|tabs?",
    "side": r"side\w*|aside|widgets?|related|recommend\w*|trending|popular|promo\w*|teasers?|more|rail|secondary|complementary",
    "foot": r"foot\w*|copyright|colophon|legal|contentinfo|imprint|impressum",
    "head": r"head|header|masthead|banner|logo|site|brand\w*|hero",
    "ad": r"ads?|advert\w*|sponsor\w*|adsense|adslot|commercial|affiliate|outbrain|taboola",
    "notice": r"cookies?|consent|gdpr|notice|notification|popup|modal|overlay|alert|toast|paywall|subscribe|subscription|newsletter|signup|login|disclaimer",
    "comment": r"comments?|disqus|repl(?:y|ies)|discussion|respond|thread|reviews?|feedback|reactions?",
    "share": r"share|sharing|social|follow|tags?|byline|meta|author|date|tools|print|buttons?|form|search",
    "content": r"article\w*|content|post|entry|main|story|body|text|prose|page|single|blog",
}
_CUES = [re.compile(rf"(?:{p})\Z") for p in CUES.values()]
TAGS = {
    "root": "html body", "article": "article", "main": "main", "box": "section div center", "p": "p", "h": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu", "item": "li dt dd",
    "quote": "blockquote pre figure figcaption address details summary", "table": "table caption thead tbody tfoot tr td th", "nav": "nav", "aside": "aside dialog", "header": "header",
    "footer": "footer", "form": "form fieldset search legend",
}
_TAG = {t: i for i, (_, ts) in enumerate(TAGS.items()) for t in ts.split()}
FEATURES = (*(f"tag_{t}" for t in TAGS), *(f"cue_{c}" for c in CUES), "text", "chars", "links", "stops", "long", "under", "under_links", "one")


class Node:
    __slots__ = ("chars", "cues", "label", "linked", "parent", "pieces", "stops", "tag", "words")

    def __init__(self, tag: str, parent: int, cues: tuple, label: str | None):
        self.tag, self.parent, self.cues, self.label = tag, parent, cues, label
        self.chars = self.linked = self.words = self.stops = self.pieces = 0


def _cue_words(attributes: str) -> tuple[tuple, str | None]:
    values, label = [], None
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "aria-label"):
            values.append(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))
        elif name == "data-label":
            label = value
    words = set(_WORDS.findall(" ".join(values).lower()))
    return tuple(any(c.match(w) for w in words) for c in _CUES), label


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes (parents first; the first is the document) and segments
    (node, text with references decoded and white space made single)."""
    page = page or ""
    nodes = [Node("html", -1, (False,) * len(CUES), None)]
    segments: list[tuple[int, str]] = []
    open_: list[tuple[str, int]] = [("html", 0)]  # open elements with their block node
    opened: Counter[str] = Counter()
    held: list[str] = []
    owner, skipping, links = 0, 0, 0

    def flush():
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                segments.append((owner, text))
                nodes[owner].pieces += 1

    def close(at: int):
        """End the elements from position ``at`` on."""
        nonlocal owner, skipping, links
        for tag, _ in open_[at:]:
            opened[tag] -= 1
            skipping -= tag in SKIPPED
            links -= tag == "a"
        if any(tag in BLOCKS for tag, _ in open_[at:]):
            flush()
        del open_[at:]
        owner = open_[-1][1]

    def data(text: str):
        if text and not skipping:
            text = html.unescape(text)
            held.append(text)
            n = nodes[owner]
            words = len(text.split())
            n.chars += len(text)
            n.linked += len(text) if links else 0
            n.words += words
            n.stops += sum(map(text.count, ".,;:!?"))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            data(page[at:])
            break
        data(page[at : m.start()])
        at = m.end()
        ending, tag = m[1] if m[2] else m[4], (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if ending:
            if not opened[tag]:
                continue
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] == tag:
                    close(i)
                    break
                if tag not in BLOCKS and open_[i][0] in BLOCKS:
                    break  # an inline end tag does not end a block
            continue
        if tag in ("br", "hr"):
            held.append(" ")
        if tag in VOID and tag != "hr":
            continue
        if tag in RAW:
            flush_at = _find_end(page, tag, at)
            at = end if flush_at < 0 else flush_at
            if at < end:
                at = page.find(">", at) + 1 or end
            continue
        if tag in ENDS_P:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] == "p":
                    close(i)
                    break
                if open_[i][0] in SCOPE:
                    break
        if tag in ENDS_OWN:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] in ENDS_OWN[tag]:
                    close(i)
                    break
                if open_[i][0] in SCOPE and not (tag == "tr" and open_[i][0] in ("td", "th")):
                    break
        if tag == "body" and any(t == "head" for t, _ in open_):
            close(next(i for i, (t, _) in enumerate(open_) if t == "head"))
        if tag == "html":
            continue
        if tag in BLOCKS:
            flush()
            if tag == "hr":
                continue
            cues, label = _cue_words(m[3] if m[2] else m[6] or "")
            nodes.append(Node(tag, owner, cues, label))
            owner = len(nodes) - 1
        open_.append((tag, owner))
        opened[tag] += 1
        skipping += tag in SKIPPED
        links += tag == "a"
    flush()
    return nodes, segments


def _find_end(page: str, tag: str, at: int) -> int:
    m = re.compile(f"</{tag}", re.I).search(page, at)
    return m.start() if m else -1


def features(nodes: list[Node]) -> list[list[float]]:
    """One row of ``FEATURES`` for each node."""
    under = [n.chars for n in nodes]
    under_links = [n.linked for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        under[nodes[i].parent] += under[i]
        under_links[nodes[i].parent] += under_links[i]
    rows = []
    for i, n in enumerate(nodes):
        tags = [0.0] * len(TAGS)
        tags[_TAG.get(n.tag, 3)] = 1.0
        rows.append([
            *tags, *map(float, n.cues), float(n.chars > 0), math.log1p(n.chars) / 5.0, n.linked / max(1, n.chars),
            min(1.0, 8.0 * n.stops / max(1, n.words)), float(n.words >= 12), math.log1p(under[i]) / 8.0, under_links[i] / max(1, under[i]), 1.0])
    return rows
