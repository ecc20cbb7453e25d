"""Web pages as trees of elements and texts, kept as arrays."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
SILENT = frozenset("script style noscript template iframe svg math textarea select title object canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var text".split())
#: An element of the key ends open elements of the value, up to one of the limits.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
        "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",)}
LIMITS = frozenset("ul ol dl table body html".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


@dataclass
class Tree:
    """Nodes in page order; a text is a node of its own with the tag ``text``."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["page"])
    attributes: list[dict[str, str]] = field(default_factory=lambda: [{}])
    text: list[str] = field(default_factory=lambda: [""])

    def add(self, parent: int, tag: str, attributes: dict[str, str], text: str = "") -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tag.append(tag)
        self.attributes.append(attributes)
        self.text.append(text)
        return len(self.tag) - 1


def parse(page: str | None) -> Tree:
    """The tree of a page; whatever is left open or closed twice is mended as browsers do in simple cases."""
    tree, page, open_nodes, last = Tree(), page or "", [0], 0
    tags = tree.tag

    def close_to(names, limits) -> None:
        for place in range(len(open_nodes) - 1, 0, -1):
            tag = tags[open_nodes[place]]
            if tag in names:
                del open_nodes[place:]
                return
            if tag in limits:
                return

    def say(raw: str) -> None:
        if raw:
            tree.add(open_nodes[-1], "text", {}, html.unescape(raw))

    token = _TOKEN.search(page)
    while token:
        if token.start() > last:
            say(page[last:token.start()])
        last = token.end()
        name = (token[2] or "").lower()
        if not name:
            if token[0].startswith("<![CDATA["):
                say(html.escape(token[0][9:].removesuffix("]]>")))
        elif token[1]:
            close_to((name,), ())
        else:
            if name not in INLINE and name not in VOID or name == "hr":
                close_to(("p",), LIMITS | {"article", "section", "div", "td", "th", "li"})
            if name in ENDS:
                for _ in ENDS[name]:
                    close_to(ENDS[name], LIMITS)
            given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(token[3] or "")}
            node = tree.add(open_nodes[-1], name, given)
            if name in SILENT:
                if not (token[3] or "").rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, last)
                    last = end.end() if end else len(page)
            elif name not in VOID:
                open_nodes.append(node)
        token = _TOKEN.search(page, last)
    say(page[last:])
    return tree


def blocks(tree: Tree, wanted) -> list[str]:
    """Texts of the wanted nodes in page order; elements that are not inline part blocks, as do line breaks."""
    found: list[str] = []
    held: list[str] = []
    owner = None
    block_of = [0] * len(tree.tag)
    for node in range(1, len(tree.tag)):
        tag, parent = tree.tag[node], tree.parent[node]
        block_of[node] = block_of[parent] if tag in INLINE or tag == "text" else node
        if tag == "br":
            held.append(" ")
        elif tag == "text" and wanted[node]:
            if owner is not None and block_of[node] != owner:  # the rest of an outer block after an inner one
                found.append(" ".join("".join(held).split()))
                held = []
            owner = block_of[node]
            held.append(tree.text[node])
        elif tag not in INLINE and held:
            found.append(" ".join("".join(held).split()))
            held, owner = [], None
    found.append(" ".join("".join(held).split()))
    return [b for b in found if b]
