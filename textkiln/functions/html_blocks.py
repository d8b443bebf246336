"""Per-page block extraction, the only per-row Python on the page path.

Semantics (tree builder over the stdlib tokenizer ``html.parser``):

* a start tag opens an element; nothing is closed implicitly, so
  ``<p>one<p>two`` nests the second paragraph inside the first;
* an end tag closes the most recent open element of that name and every
  element opened after it; an end tag with no open element is ignored;
* void elements (``br``, ``img``, ...) close at once;
* subtrees under a dropped tag are removed with everything inside;
* a block's text is every text node below it, each stripped with
  ``str.strip``, empties skipped, joined by one space; a comment ends a text
  node and contributes no text; entities are decoded inside their node.

The Spark side (``operators.html_text``) explodes, filters and joins blocks.
"""

from __future__ import annotations

from html.parser import HTMLParser

# Fixed values that must equal the reference behaviour.
DROPPED_TAGS = frozenset(["script", "style", "nav", "header", "footer", "noscript"])
BLOCK_TAGS = frozenset(["p", "h1", "h2", "h3", "li"])
# Void elements closed at their start tag (tree builder default list).
VOID_TAGS = frozenset([
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta",
    "param", "source", "track", "wbr",
    "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
])
# Text inside a template is not ordinary document text.
HIDDEN_TEXT_TAGS = frozenset(["template"])


class _BlockCollector(HTMLParser):
    def __init__(self, dropped=DROPPED_TAGS, blocks=BLOCK_TAGS):
        super().__init__(convert_charrefs=True)
        self.dropped = dropped
        self.block_tags = blocks
        self.stack: list[tuple[str, int]] = []  # (tag, block index or -1)
        self.open_count: dict[str, int] = {}
        self.dropped_depth = 0
        self.hidden_depth = 0
        self.pending: list[str] = []
        self.blocks: list[tuple[str, list[str]]] = []

    # text nodes -----------------------------------------------------------
    def _flush(self) -> None:
        if not self.pending:
            return
        node = "".join(self.pending)
        self.pending = []
        if self.dropped_depth or self.hidden_depth:
            return
        node = node.strip()
        if not node:
            return
        for _, idx in self.stack:
            if idx >= 0:
                self.blocks[idx][1].append(node)

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    def handle_decl(self, decl: str) -> None:
        self._flush()

    def handle_pi(self, data: str) -> None:
        self._flush()

    def unknown_decl(self, data: str) -> None:
        self._flush()
        if data.startswith("CDATA["):  # a text node of its own
            self.pending.append(data[6:])
            self._flush()

    # elements ---------------------------------------------------------------
    def _push(self, tag: str) -> None:
        idx = -1
        if tag in self.block_tags and not self.dropped_depth:
            idx = len(self.blocks)
            self.blocks.append((tag, []))
        self.stack.append((tag, idx))
        self.open_count[tag] = self.open_count.get(tag, 0) + 1
        if tag in self.dropped:
            self.dropped_depth += 1
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden_depth += 1

    def _pop(self) -> None:
        tag, _ = self.stack.pop()
        self.open_count[tag] -= 1
        if tag in self.dropped:
            self.dropped_depth -= 1
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden_depth -= 1

    def _close(self, tag: str) -> None:
        if not self.open_count.get(tag):
            return
        while self.stack:
            top = self.stack[-1][0]
            self._pop()
            if top == tag:
                return

    def handle_starttag(self, tag, attrs) -> None:
        self._flush()
        self._push(tag)
        if tag in VOID_TAGS:
            self._pop()

    def handle_startendtag(self, tag, attrs) -> None:
        self._flush()
        self._push(tag)
        self._close(tag)

    def handle_endtag(self, tag) -> None:
        self._flush()
        if tag in VOID_TAGS:
            return
        self._close(tag)

    def finish(self) -> list[tuple[str, str]]:
        self.close()
        self._flush()
        return [(tag, " ".join(parts)) for tag, parts in self.blocks]


def extract_blocks(html: str | None) -> list[tuple[str, str]]:
    """All block elements of a page in document order as ``(tag, text)``."""
    if html is None:
        raise ValueError("page has no html")
    collector = _BlockCollector()
    collector.feed(html)
    return collector.finish()
