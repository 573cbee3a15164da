"""Leaf blocks of an HTML page: stretches of text that no block element interrupts, with the elements around them.

A page is read once, left to right.  Tags, comments and raw text (scripts, styles and the like) are told apart by one
pattern without backtracking; what is unclosed at the end of a page is dropped, as browsers do.  Elements that close
others by opening (paragraphs, list items, table cells) do so here; end tags that nothing opened are passed over.
Inline elements leave no trace but the share of text that is in links.  Character references are decoded in each
stretch of text by itself, white space (as Unicode has it) becomes one space, and ends are trimmed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable
from html import unescape

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr picture q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
ENDS = {  # an opening element: what it closes, and the elements beyond which it closes nothing
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_MARKUP = re.compile(
    r"""<(?:(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+)>|!--(?:-?>|.*?(?:--!?>|\Z))|(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)|/?[a-zA-Z].*+)""",
    re.S,
)
_CLOSE = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"""(?:^|(?<=[\s"'/]))(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


LEAF = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd blockquote pre td th tr tbody figcaption caption label button option".split())


class Node:
    """A block element: ``path``, features of its name and of the words of its class, id, role and itemprop, and of those
    of the elements around it, each once (``known``: those only); ``group``, the element that groups its text with its
    neighbours'; and how many characters of text, of them in links, and how many blocks it holds."""

    __slots__ = ("name", "parent", "path", "group", "chars", "links", "blocks")

    def __init__(self, name: str, parent: Node | None, words: Iterable[str] = (), known: Container[str] | None = None):
        self.name, self.parent = name, parent
        self.group = parent.group if name in LEAF and parent is not None else self
        self.chars = self.links = self.blocks = 0
        up = parent.path if parent is not None else ()
        own = dict.fromkeys([f"in:{name}", *(f"word:{w}" for w in words), *(f"stem:{w[:4]}" for w in words)])
        more = [f for f in own if (known is None or f in known) and f not in up]
        self.path = (*more, *up) if more else up


class Block:
    __slots__ = ("text", "node", "linked")

    def __init__(self, text: str, node: Node, linked: int):
        self.text, self.node, self.linked = text, node, linked


def _words(attributes: str) -> tuple[str, ...]:
    found = [w.lower() for m in _ATTRIBUTE.finditer(attributes) for w in _PART.findall(m[2] or m[3] or m[4] or "") if len(w) > 1]
    return tuple(dict.fromkeys(found))


def blocks(html: str | None, known: Container[str] | None = None) -> list[Block]:
    """The leaf blocks of a page that have text, in page order; only features in ``known`` are kept, if that is given."""
    html = html or ""
    out: list[Block] = []
    stack = [Node("body", None, (), known)]
    opened: Counter[str] = Counter()
    held: list[str] = []  # pieces of the block at hand
    linked: list[str] = []
    in_link = False

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text:
                node = stack[-1]
                many = min(len(" ".join("".join(linked).split())), len(text))
                out.append(Block(text, node, many))
                for _ in range(3):  # the element, and two around it
                    if node is not None:
                        node.chars, node.links, node.blocks, node = node.chars + len(text), node.links + many, node.blocks + 1, node.parent
            held.clear()
            linked.clear()

    def pop() -> str:
        opened[stack[-1].name] -= 1
        return stack.pop().name

    def say(raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        held.append(text)
        if in_link:
            linked.append(text)

    at, size = 0, len(html)
    while at < size:
        found = _MARKUP.search(html, at)
        if found is None:
            say(html[at:])
            break
        if found.start() > at:
            say(html[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if name in INLINE:
            if name == "br":
                held.append(" ")
            elif name == "a":
                in_link = not found[1]
            continue
        if name in RAW:
            close = None if found[1] else _CLOSE[name].search(html, at)
            at = at if found[1] else close.start() if close else size
            continue
        flush()
        if name in ("html", "head", "body"):
            if name == "body" and not found[1] and len(stack) == 1 and not out:
                stack[0] = Node("body", None, _words(found[3]), known)
            continue
        if found[1]:
            if opened[name]:
                in_link = False
                while pop() != name:
                    pass
            continue
        if name in VOID:
            continue
        if stack[-1].name == "p" or (name in HEADINGS and stack[-1].name in HEADINGS):
            pop()
        closes, beyond = ENDS.get(name, ((), ()))
        if any(opened[x] for x in closes):
            k = len(stack) - 1
            while k > 0 and stack[k].name not in closes and stack[k].name not in beyond:
                k -= 1
            if stack[k].name in closes:
                while len(stack) > k:
                    pop()
        stack.append(Node(name, stack[-1], _words(found[3]) if "=" in found[3] else (), known))
        opened[name] += 1
    flush()
    return out
