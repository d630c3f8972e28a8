"""A page as a tree of blocks: element nodes, and leaves that hold a block's text.

Tags are read as browsers do where that tells what belongs to what: implied ends of paragraphs, list items
and cells, ends without a beginning, comments, raw text.  Inline elements are no nodes; their text belongs to
the block around them.  Time and memory are in proportion to the page's length.
"""

from __future__ import annotations

import re
from html import unescape

# Fixed values of HTML: element names by kind.
VOID = set("area base br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
#: Their text is no text of the page; where the end is missing, it is.
UNSEEN = set("audio button canvas datalist math noscript object select svg template video".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output picture q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: A start tag ends open elements of these names, down to one of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
TABLE = set("table tbody thead tfoot tr td th caption colgroup".split())
#: Ends of other elements don't reach over these.
SCOPE = {"table", "td", "th", "caption"}

MARKUP = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*)|[!?/])")
ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|(=?[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?)""")
END_OF_COMMENT = re.compile(r"--!?>")


class Page:
    """Nodes in the order of the page.  ``texts`` has the leaves' texts, and None for elements."""

    def __init__(self, html: str):
        self.parent, self.depth, self.end = [-1], [0], [0]
        self.tags, self.attributes = ["html"], [{}]
        self.texts: list[str | None] = [None]
        self.linked = [0]
        self._read(html)

    def _node(self, parent: int, tag: str, attributes: dict[str, str], text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.end.append(len(self.parent))
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.texts.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1

    def _read(self, html: str) -> None:
        stack, open_tags = [0], {"html": 1}
        unclosed, link, chunks, linked = set(), None, [], 0
        at, size = 0, len(html)

        def flush() -> None:
            nonlocal chunks, linked
            if chunks:
                text = " ".join("".join(chunks).split())
                if text:
                    self._node(stack[-1], "#text", {}, text, min(linked, len(text)))
                chunks, linked = [], 0

        def pop(k: int) -> None:
            """Close what is above place k of the stack, and that."""
            nonlocal link
            flush()
            while len(stack) > k:
                i = stack.pop()
                self.end[i] = len(self.parent)
                open_tags[self.tags[i]] -= 1
            if link is not None and link > len(stack):
                link = None

        while at < size:
            m = MARKUP.search(html, at)
            text = html[at : m.start() if m else size]
            if text:
                text = unescape(text) if "&" in text else text
                chunks.append(text)
                if link is not None:
                    linked += len(text)
            if not m:
                break
            at = m.end()
            if m[1]:
                close = END_OF_COMMENT.search(html, at)
                brief = re.compile("-?>").match(html, at)
                at = brief.end() if brief else close.end() if close else size
                continue
            if m[3] is None:
                at = html.find(">", at - (m[0] == "</")) + 1 or size
                continue
            tag, closing, attributes = m[3].lower(), m[2], {}
            while at < size:
                a = ATTRIBUTE.match(html, at)
                at = a.end() if a.end() > at else at + 1
                if a[1]:
                    break
                if a[2]:
                    attributes.setdefault(a[2].lower(), next((x for x in a.group(3, 4, 5) if x is not None), ""))
            else:
                break  # the page ends within a tag
            if tag in ("br", "wbr") or tag in INLINE:
                if tag == "br":
                    chunks.append(" ")
                elif tag == "a":
                    link = None if closing else len(stack)
                continue
            if closing:
                if tag in ("html", "body") or not open_tags.get(tag) and not (tag in HEADINGS and self.tags[stack[-1]] in HEADINGS):
                    if tag == "p":
                        flush()
                    continue
                same = HEADINGS if tag in HEADINGS else {tag}
                for k in range(len(stack) - 1, 0, -1):
                    name = self.tags[stack[k]]
                    if name in same:
                        pop(k)
                        break
                    if name in SCOPE and tag not in TABLE or name == "table":
                        break
                continue
            if tag in RAW or tag in UNSEEN:
                close = None if tag in unclosed else re.compile(f"</{tag}(?=[\\s/>]|$)", re.IGNORECASE).search(html, at)
                if close:
                    at = close.start()
                elif tag in RAW:
                    break
                else:
                    unclosed.add(tag)
                continue
            if tag in VOID and tag != "hr":
                continue
            if tag in ("html", "body", "head"):
                if tag == "body":
                    self.attributes[0] = self.attributes[0] | attributes
                continue
            flush()
            if tag in ENDS_P and self.tags[stack[-1]] == "p":
                pop(len(stack) - 1)
            if tag in HEADINGS and self.tags[stack[-1]] in HEADINGS:
                pop(len(stack) - 1)
            if tag in ENDS:
                names, stops = ENDS[tag]
                if any(open_tags.get(x) for x in names):
                    for k in range(len(stack) - 1, 0, -1):
                        name = self.tags[stack[k]]
                        if name in names:
                            pop(k)
                            break
                        if name in stops:
                            break
            if tag == "hr":
                continue
            stack.append(self._node(stack[-1], tag, attributes))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        pop(0)
