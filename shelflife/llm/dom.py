"""A small tolerant reader of HTML: elements, classes, texts; enough to align pages."""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache
from html import unescape

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>""")  # of a tag; quoted values may hold >
_DECLARED = re.compile(r"<[!?]")
_MARKS = re.compile(r"""["'>]""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe noframes xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: An element that starts closes these, if one is open inside the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_ENDS = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_P_SCOPE = frozenset({"td", "th", "table", "button", "caption", "html", "body"})
_FOREIGN = frozenset({"svg", "math"})


class Node:
    __slots__ = ("tag", "attributes", "kids", "weight")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        self.attributes = attributes  # as written; read on demand
        self.kids: list[Node | str] = []
        self.weight: tuple[int, int, int] | None = None  # see wrapper.measure

    def tokens(self) -> set[str]:
        """Whole names of class, id and role."""
        found: set[str] = set()
        if self.attributes:
            for name, *values in _ATTRIBUTE.findall(self.attributes):
                if name.lower() in ("class", "id", "role"):
                    found.update(unescape("".join(values)).lower().split())
        return found

    def roles(self) -> set[str]:
        """Roles as written."""
        found: set[str] = set()
        for name, *values in _ATTRIBUTE.findall(self.attributes):
            if name.lower() == "role":
                found.update(unescape("".join(values)).lower().split())
        return found

    def words(self) -> set[str]:
        """Words of class, id and role."""
        return {word for token in self.tokens() for word in re.findall(r"[a-z]+|\d+", token)}

    def key(self) -> str:
        """Tag and classes: what makes two nodes of two pages alike."""
        if not self.attributes:
            return self.tag
        classes = [
            "".join(values).split()
            for name, *values in _ATTRIBUTE.findall(self.attributes)
            if name.lower() == "class"
        ]
        return ".".join([self.tag, *sorted({c for cs in classes for c in cs})])


class _Ends:
    """Where tags end: at the first > outside quoted values, or else at the first >.

    A tag that never ends that way is read to the end of the page; from the first such
    tag on, the ends of all are taken from one pass over the page from its end.
    """

    def __init__(self, html: str):
        self.html = html
        self.marks: list[int] | None = None
        self.ends: list[int] = []

    def __call__(self, at: int) -> int:
        """Position of the > that ends a tag whose name ends at ``at``; -1 if there is none."""
        if self.marks is None:
            if m := _REST.match(self.html, at):
                return m.end() - 1
            self._read()
        i = bisect_left(self.marks, at)
        end = self.ends[i] if i < len(self.marks) else -1
        return end if end >= 0 else self.html.find(">", at)

    def _read(self) -> None:
        self.marks = [m.start() for m in _MARKS.finditer(self.html)]
        # The end reached from a mark on: outside of quotes, inside of " and inside of '.
        plain = double = single = -1
        for at in reversed(self.marks):
            mark = self.html[at]
            if mark == ">":
                plain = at
            elif mark == '"':
                plain, double = double, plain
            else:
                plain, single = single, plain
            self.ends.append(plain)
        self.ends.reverse()


class _Open:
    """The open elements, and where those of each tag lie among them."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.where: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.where.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def nearest(self, tags: set[str] | frozenset[str]) -> int:
        return max((self.where[tag][-1] for tag in tags if self.where.get(tag)), default=0)

    def close(self, tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        """Close the nearest open element of ``tags``, unless one of ``scope`` is nearer."""
        at = self.nearest(tags)
        if at and at > self.nearest(scope):
            while len(self.stack) > at:
                self.where[self.stack.pop().tag].pop()


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I | re.A)


def parse(html: str) -> Node:
    """The tree of a page; whatever is written, some tree comes of it, in one pass."""
    root = Node("#page")
    opened, ends = _Open(root), _Ends(html)
    at, n, tags = 0, len(html), True  # tags: whether a > is left that could end one

    def text(until: int) -> None:
        if until > at:
            opened.stack[-1].kids.append(unescape(html[at:until]))

    while at < n:
        start = found = None
        look = at
        while start is None:
            if tags:
                look = html.find("<", look)
            else:
                declared = _DECLARED.search(html, look)
                look = declared.start() if declared else -1
            if look < 0:
                break
            if html.startswith(("<!", "<?"), look):
                start = look
            elif found := _NAME.match(html, look):
                close = ends(found.end())
                if close >= 0:
                    start = look
                else:
                    tags = False
            else:
                look += 1
        if start is None:
            text(n)
            break
        text(start)
        if html.startswith("<!--", start):
            close = html.find("-->", start + 4)
            at = n if close < 0 else close + 3
            continue
        if html.startswith("<![CDATA[", start):
            close = html.find("]]>", start + 9)
            inner = html[start + 9 : n if close < 0 else close]
            if inner:
                opened.stack[-1].kids.append(inner)
            at = n if close < 0 else close + 3
            continue
        if html[start + 1] in "!?":
            close = html.find(">", start)
            at = n if close < 0 else close + 1
            continue
        name, rest = found[1].lower(), html[found.end() : close]
        at = close + 1
        if html[start + 1] == "/":
            if name not in VOID:
                opened.close({name}, _P_SCOPE if name == "p" else frozenset())
            continue
        if name in _P_ENDS:
            opened.close({"p"}, _P_SCOPE)
        if name in CLOSES:
            opened.close(*CLOSES[name])
        node = Node(name, rest)
        opened.stack[-1].kids.append(node)
        if name in RAW:
            end = _raw_end(name).search(html, at)
            node.kids.append(html[at : end.start() if end else n])
            close = html.find(">", end.start()) if end else -1
            at = n if close < 0 else close + 1
        elif name not in VOID and not (
            # Only drawings and formulas have elements that a slash closes.
            rest.endswith("/") and (name in _FOREIGN or opened.nearest(_FOREIGN))
        ):
            opened.push(node)
    return root
