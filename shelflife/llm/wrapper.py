"""Main-text extraction by wrapper induction.

Pages of a host are aligned with one page of it, the reference, by simple tree
matching: the largest set of node pairs that keeps parents and the order of siblings.
Runs of like siblings (paragraphs, list entries) are one node, so trees stay small
however long a page is.  Over all pages of the host it is counted how often a node of
the reference is matched and how often its text is the reference's; a node whose text
stays the same on nearly all pages is template, one whose text varies is a slot.

The article is the text of the page's article or main element, if a fair part of the
page's slots lies in it or the host has no template; otherwise of all slots of the page; a main element around articles is read as a whole.  Containers
that name themselves as something else (menus, footers, sidebars, adverts, forms,
comments, ...) are left out unless they hold the article, as are template nodes,
unless that would leave nothing, as on a host of copies.  A name counts as a whole: one
that has such a word among others only goes if it is template or links.  Headings and
paragraphs of an article are never taken for template.

No group of pages is gathered: a host's reference is a minimum, its counts are summed
in the tasks before they are shuffled, and both are joined to the pages as small
arrays, broadcast when measured small, else from written tables so that adaptive
execution can split the pages of a hot host.  Alignments are remembered by the shape
of a page; memory is one page and the remembered shapes of a task.

Defined cases: null and empty pages have no text; a null or odd url is a host of its
own; unclosed and crossed tags are closed as browsers do, and a slash closes no element but
those of drawings and formulas; an article without text counts as none; a tag that never ends is
text; reading a page takes time in proportion to it, aligning it at most the product of differing
siblings, in small arrays; white space includes no-break spaces; nodes deeper than ``DEPTH`` levels are not aligned but still read;
repeated rows are reported each time; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import sys
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.dom import BLOCK, RAW, Node, parse
from shelflife.llm.shared import run_folder, ship, stage

MIN_PAGES = 5  # of a host, before its constant nodes count as template
CONSTANT = 0.9  # of the pages
DEPTH = 100
REMEMBERED = 1_000_000  # nodes of the alignments that a task remembers
BROADCAST_BYTES = 16 * 1024 * 1024

#: Elements that are never part of an article.
OTHER = frozenset("nav aside footer form button select menu dialog fieldset svg".split()) | RAW
#: Words of a class, id or role that say the same; outside an article also header.
OTHER_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies disqus footer gdpr menu modal nav "
    "navbar navigation newsletter notice notices popup promo promotion related replies responses "
    "reviews search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
HEADER_NAMES = frozenset("header masthead topbar".split())
COMMENT_NAMES = frozenset("comment comments disqus".split())
#: Words that only say what a box looks like: beside one of the above they change nothing.
BOX_NAMES = frozenset(
    "area bar block bottom box button buttons container global group icons inner item items left "
    "list main mobile outer primary right secondary site thread top wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
#: Elements that may hold a whole page all the same.
LAYOUT = frozenset("form fieldset".split())
CONFIRMED = 1 / 4  # of a page's varying text, for its article element to be its article
LINKS = 2 / 3  # of the text of a box with an ambiguous name in links: not an article's


def says(tokens: set[str], words: frozenset[str]) -> str:
    """Whether a name means one of the words as a "whole", only in "part" of it, or not ("")."""
    found = ""
    for token in tokens:
        own = set(re.findall(r"[a-z]+", token))
        if own & words:
            if own <= OTHER_NAMES | HEADER_NAMES | BOX_NAMES:
                return "whole"
            found = "part"
    return found


def is_comment(node: Node) -> bool:
    return says(node.tokens(), COMMENT_NAMES) == "whole"


def is_other(node: Node, in_article: bool) -> bool:
    """Whether a node is named as something else than the article.

    A name that has such a word among others, as in "has-sidebar", is ambiguous: what is
    constant on the host goes as template, and what is nearly all links goes here.
    """
    if node.tag in OTHER or (node.tag == "header" and not in_article):
        return True
    if not node.attributes or node.tag in ("article", "main", "body", "html"):
        # An article may be named for what it is about, but not be a comment.
        return node.tag == "article" and is_comment(node)
    if in_article and node.tag in HEADINGS:
        return False
    named = says(node.tokens(), OTHER_NAMES if in_article else OTHER_NAMES | HEADER_NAMES)
    if named == "part":
        size, linked, links = measure(node)
        return links > 1 and linked >= LINKS * size
    return bool(named)


def measure(top: Node) -> tuple[int, int, int]:
    """Characters other than white space, those of them in links, and the number of links.

    Kept with every node of the subtree, so all nodes of a page cost one walk.
    """
    work = [(top, False)]
    while work:
        node, seen = work.pop()
        if node.weight is not None:
            continue
        if node.tag in RAW:
            node.weight = 0, 0, 0
        elif not seen:
            work.append((node, True))
            work.extend((kid, False) for kid in node.kids if isinstance(kid, Node))
        else:
            size = linked = links = 0
            for kid in node.kids:
                if isinstance(kid, str):
                    size += sum(map(len, kid.split()))
                else:
                    n, m, k = kid.weight
                    size, linked, links = size + n, linked + m, links + k
            node.weight = (size, size, links + 1) if node.tag == "a" else (size, linked, links)
    return top.weight


def plain(node: Node) -> int:
    """Characters outside links."""
    size, linked, _ = measure(node)
    return size - linked


def opened(page: Node) -> set[int]:
    """Ids of the nodes that are named as something else but hold the article.

    That are forms and named boxes with most of the page's text outside links; and, where no article
    or main element is left otherwise, whatever holds the main element, or the largest
    article if that is larger than all the text that is left.
    """
    ids: set[int] = set()
    closed: list[tuple[Node, tuple]] = []  # with the boxes around it: (nearest, (next, ...))
    work = [(page, False)]
    while work:
        node, inside = work.pop()
        inside = inside or node.tag == "article" or is_main(node)
        for kid in node.kids:
            if not isinstance(kid, Node) or kid.tag in RAW:
                continue
            if not is_other(kid, inside):
                work.append((kid, inside))
            elif (
                (kid.tag not in OTHER or kid.tag in LAYOUT)
                and not is_comment(kid)
                and 2 * plain(kid) > plain(page)
            ):
                ids.add(id(kid))
                work.append((kid, inside))
            else:
                closed.append((kid, (kid, None)))
    if not closed or regions(page, ids):
        return ids
    # Only what would be left out can hold an article now.
    hidden: list[tuple[bool, int, tuple]] = []
    while closed:
        node, path = closed.pop()
        if is_comment(node):
            continue
        if node.tag == "article" or is_main(node):
            hidden.append((is_main(node), measure(node)[0], path))
            continue
        for kid in node.kids:
            if isinstance(kid, Node) and kid.tag not in RAW:
                closed.append((kid, (kid, path) if is_other(kid, False) else path))
    if hidden:
        main, size, path = max(hidden, key=lambda found: found[:2])
        left = sum(len("".join(text.split())) for text in blocks(bodies(page), None, ids))
        if size > (0 if main else left):
            while path:
                ids.add(id(path[0]))
                path = path[1]
    return ids


def is_main(node: Node) -> bool:
    return node.tag == "main" or ("main" in node.attributes and "main" in node.roles())


def bodies(page: Node) -> list[Node]:
    found = [n for n in page.kids if isinstance(n, Node) and n.tag == "html"] or [page]
    return [k for n in found for k in n.kids if isinstance(k, Node) and k.tag == "body"] or [page]


def blocks(nodes: list[Node], skip=None, ids: set[int] | frozenset[int] = frozenset()) -> list[str]:
    """The text of the nodes, block by block, without markup and other containers.

    Those of ``ids`` are read although they are named as something else.
    """
    out: list[str] = []
    words: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(words).split()):
            out.append(text)
        words.clear()

    for top in nodes:
        # (what, closing?, inside an article?)
        work: list[tuple[Node | str, bool, bool]] = [(top, False, False)]
        while work:
            item, closing, inside = work.pop()
            if isinstance(item, str):
                words.append(item)
            elif closing:
                flush()
            elif item.tag == "br":
                words.append(" ")
            else:
                if item is not top and (
                    (id(item) not in ids and is_other(item, inside)) or (skip and skip(item))
                ):
                    continue
                if item.tag in RAW:
                    continue
                inside = inside or item.tag in ("article", "main")
                if item.tag in BLOCK:
                    flush()
                    work.append((item, True, inside))
                work.extend((kid, False, inside) for kid in reversed(item.kids))
        flush()
    return out


def regions(page: Node, ids: set[int] | frozenset[int] = frozenset()) -> list[Node]:
    """The outermost articles and main elements; else what is named main; else none."""
    for named in (False, True):
        found, work = [], [page]
        while work:
            node = work.pop()
            if (
                "main" in node.attributes and "main" in node.words()
                if named
                else node.tag == "article" or is_main(node)
            ):
                found.append(node)
                continue
            work.extend(
                kid
                for kid in reversed(node.kids)
                if isinstance(kid, Node) and (id(kid) in ids or not is_other(kid, False))
            )
        if found:
            return found
    return []


class Layout:
    """A page as a tree of groups: runs of sibling elements with the same tag and classes."""

    def __init__(self, keys: list[str], parents: list[int], members: list[list[Node]] | None = None):
        self.keys, self.parents, self.members = keys, parents, members
        self.spans: dict[int, tuple[int, int]] | None = None  # see text
        self.kids: list[list[int]] = [[] for _ in keys]
        for i, parent in enumerate(parents):
            if parent >= 0:
                self.kids[parent].append(i)

    @classmethod
    def of(cls, page: Node) -> Layout:
        keys, parents, members = [page.key()], [-1], [[page]]
        work = [(0, 0)]
        while work:
            i, depth = work.pop()
            if len(members[i]) > 1 or depth >= DEPTH:
                continue
            first = len(keys)
            for kid in members[i][0].kids:
                if isinstance(kid, str):
                    continue
                key = kid.key()
                if len(keys) > first and keys[-1] == key:
                    members[-1].append(kid)
                else:
                    keys.append(key)
                    parents.append(i)
                    members.append([kid])
            work.extend((j, depth + 1) for j in range(len(keys) - 1, first - 1, -1))
        return cls(keys, parents, members)

    def shape(self) -> int:
        """A hash of the tree: all that an alignment depends on."""
        return tree_hash(self.keys, self.parents)

    def text(self, i: int) -> int:
        """Hash of the whole text of a group; 0 for no text."""
        if self.spans is None:
            self._read()
        parts = (self.whole[lo:hi] for lo, hi in map(self.spans.__getitem__, map(id, self.members[i])))
        text = " ".join("".join(parts).split())
        return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 if text else 0

    def _read(self) -> None:
        """The page's text in one piece, and where in it each element lies."""
        self.spans = {}
        parts: list[str] = []
        size = 0
        work: list[tuple[Node | str, int]] = [(self.members[0][0], -1)]
        while work:
            item, start = work.pop()
            if isinstance(item, str):
                parts.append(item)
                size += len(item)
            elif start >= 0 or item.tag in RAW:
                self.spans[id(item)] = max(start, 0), size if start >= 0 else 0
            else:
                work.append((item, size))
                work.extend((kid, -1) for kid in reversed(item.kids))
        self.whole = "".join(parts)


def tree_hash(keys: list[str], parents: list[int]) -> int:
    names = "\0".join(keys).encode("utf-8", "surrogatepass")
    return xxhash.xxh128_intdigest(names + b"\0\0" + np.array(parents, np.int32).tobytes())


class Shapes:
    """Numbers of whole subtrees: equal ones have one number, and one matching."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[str, tuple[int, ...]], int] = {}
        self.keys: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self.found: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def of(self, layout: Layout) -> list[int]:
        out = [0] * len(layout.keys)
        for i in range(len(out) - 1, -1, -1):
            key = layout.keys[i], tuple(out[j] for j in layout.kids[i])
            if key not in self.numbers:
                self.numbers[key] = len(self.keys)
                self.keys.append(key[0])
                self.kids.append(key[1])
                self.sizes.append(1 + sum(self.sizes[j] for j in key[1]))
            out[i] = self.numbers[key]
        return out

    def match(self, a: int, b: int) -> int:
        """Most pairs of two subtrees that keep parents and siblings' order."""
        if a == b:
            return self.sizes[a]
        if self.keys[a] != self.keys[b]:
            return 0
        if (a, b) not in self.found:
            size, pairs = self.siblings(self.kids[a], self.kids[b])
            self.found[a, b] = 1 + size, pairs
        return self.found[a, b][0]

    def pairs(self, a: int, b: int) -> list[tuple[int, int]]:
        """The kids that are paired in that matching, by their places."""
        return [(x, x) for x in range(len(self.kids[a]))] if a == b else self.found[a, b][1]

    def siblings(self, rows: tuple[int, ...], cols: tuple[int, ...]) -> tuple[int, list[tuple[int, int]]]:
        """The heaviest pairs in order of two lists of subtrees.

        Equal ones at the beginning and the end are pairs of some best matching.  Of the
        table of the rest every so many rows are kept, and those between computed again.
        """
        n, m = len(rows), len(cols)
        lo = hi = 0
        while lo < min(n, m) and rows[lo] == cols[lo]:
            lo += 1
        while hi < min(n, m) - lo and rows[n - 1 - hi] == cols[m - 1 - hi]:
            hi += 1
        pairs = [(x, x) for x in range(lo)] + [(n - 1 - x, m - 1 - x) for x in range(hi)]
        size = sum(self.sizes[rows[x]] for x, _ in pairs)
        rows, cols = rows[lo : n - hi], cols[lo : m - hi]
        if not rows or not cols:
            return size, pairs
        kinds, places = np.unique(np.array(cols), return_inverse=True)
        gains = {a: np.array([self.match(a, int(b)) for b in kinds], np.int32) for a in set(rows)}

        def next_row(best: np.ndarray, a: int) -> np.ndarray:
            out = best.copy()
            np.maximum(best[1:], best[:-1] + gains[a][places], out=out[1:])
            return np.maximum.accumulate(out)

        step = math.isqrt(len(rows)) + 1
        best = np.zeros(len(cols) + 1, np.int32)
        kept = []
        for x, a in enumerate(rows):
            if x % step == 0:
                kept.append(best)
            best = next_row(best, a)
        size += int(best[-1])
        y = len(cols)
        for first in reversed(range(0, len(rows), step)):
            table = [kept.pop()]
            for a in rows[first : first + step]:
                table.append(next_row(table[-1], a))
            x = len(table) - 1
            while x and y:
                if table[x][y] == table[x - 1][y]:
                    x -= 1
                elif table[x][y] == table[x][y - 1]:
                    y -= 1
                else:
                    x, y = x - 1, y - 1
                    pairs.append((lo + first + x, lo + y))
        return size, pairs


def align(a: Layout, b: Layout) -> list[int]:
    """For each group of ``b`` the group of ``a`` it is matched with, or -1.

    Simple tree matching: the most pairs that keep parents, and siblings' order.
    """
    shapes = Shapes()
    of_a, of_b = shapes.of(a), shapes.of(b)
    out = [-1] * len(b.keys)
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * DEPTH))
    if shapes.match(of_a[0], of_b[0]):
        work = [(0, 0)]
        while work:
            i, j = work.pop()
            out[j] = i
            work.extend((a.kids[i][x], b.kids[j][y]) for x, y in shapes.pairs(of_a[i], of_b[j]))
    return out


class Aligner:
    """Alignments with the reference pages, remembered by the shapes of both."""

    def __init__(self) -> None:
        self.known: OrderedDict[tuple[int, int], list[int]] = OrderedDict()
        self.held = 0

    def __call__(self, keys: list[str], parents: list[int], page: Layout) -> list[int]:
        key = tree_hash(keys, parents), page.shape()
        if key not in self.known:
            self.known[key] = found = align(Layout(keys, parents), page)
            self.held += len(found)
            while self.held > REMEMBERED and len(self.known) > 1:
                self.held -= len(self.known.popitem(last=False)[1])
        else:
            self.known.move_to_end(key)
        return self.known[key]


def slots(tops: list[Node], template: set[int], ids: set[int]) -> int:
    """Characters of varying text outside links, without other containers."""
    size = 0
    work = [(top, False) for top in tops if id(top) not in template]
    while work:
        node, inside = work.pop()
        inside = inside or node.tag in ("article", "main")
        for kid in node.kids:
            if isinstance(kid, str):
                size += sum(map(len, kid.split()))
            elif kid.tag not in RAW and kid.tag != "a" and id(kid) not in template:
                if id(kid) in ids or not is_other(kid, inside):
                    work.append((kid, inside))
    return size


def article(page: Node, template: set[int]) -> str:
    """The main text; ``template`` are ids of nodes whose text belongs to the host."""
    ids = opened(page)
    found, body = regions(page, ids), bodies(page)
    if found and template:
        varying = slots(body, template, ids)
        if slots(found, template, ids) < CONFIRMED * varying:
            found = []
    kept = []
    if found:
        def skip(node: Node) -> bool:
            return id(node) in template and node.tag not in HEADINGS

        kept = blocks(found, skip, ids) or blocks(found, None, ids)
    if not kept:  # no article, or one without text
        kept = blocks(body, lambda node: id(node) in template, ids) or blocks(body, None, ids)
    return "\n".join(kept)


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for host, html in zip(batch.column("host"), batch.column("html"), strict=True):
            page = Layout.of(parse(html.as_py() or ""))
            texts = [page.text(i) for i in range(len(page.keys))]
            out.append((host.as_py(), page.keys, page.parents, texts))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["host", "keys", "parents", "texts"],
        )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(0, batch.num_rows, 100):
        yield from batch.slice(at, 100).to_pylist()


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, node, pages it was matched on, pages with the reference's text) per batch."""
    aligned = Aligner()
    for batch in batches:
        counts: dict[tuple[str, int], list[int]] = {}
        for row in _rows(batch):
            page = Layout.of(parse(row["html"] or ""))
            for j, i in enumerate(aligned(row["keys"], row["parents"], page)):
                if i >= 0:
                    pair = counts.setdefault((row["host"], i), [0, 0])
                    pair[0] += 1
                    pair[1] += row["texts"][i] != 0 and page.text(j) == row["texts"][i]
        rows = [(host, i, n, same) for (host, i), (n, same) in counts.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["host", "node", "pages", "same"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligned = Aligner()
    for batch in batches:
        texts = []
        for row in _rows(batch.select(["html", "keys", "parents", "texts", "constant"])):
            page = parse(row["html"] or "")
            template: set[int] = set()
            if row["constant"]:
                constant = set(row["constant"])
                layout = Layout.of(page)
                for j, i in enumerate(aligned(row["keys"], row["parents"], layout)):
                    if i in constant and layout.text(j) == row["texts"][i]:
                        template.update(id(n) for n in layout.members[j])
            texts.append(article(page, template))
        text = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page"), text], ["page", "text"])


def wrappers(pages: DataFrame, folder: str) -> DataFrame:
    """One row per host: its reference page's layout and the nodes that are template.

    ``pages`` has ``host`` and ``html``.
    """
    key = F.xxhash64("html")
    chosen = pages.where("html is not null").groupBy("host").agg(F.min(key).alias("key"))
    chosen = stage(chosen, f"{folder}/chosen")
    one = pages.withColumn("key", key).join(F.broadcast(chosen) if _small(chosen) else chosen, ["host", "key"])
    schema = "host string, keys array<string>, parents array<int>, texts array<bigint>"
    layouts = one.select("host", "html").mapInArrow(_layouts, schema)
    # Equal pages of a host have equal layouts: any of them serves.
    layouts = layouts.groupBy("host").agg(F.min(F.struct("keys", "parents", "texts")).alias("r"))
    layouts = stage(layouts.select("host", "r.*"), f"{folder}/layouts")
    joined = pages.join(F.broadcast(layouts) if _small(layouts) else layouts, "host")
    votes = joined.mapInArrow(_votes, "host string, node int, pages bigint, same bigint")
    votes = votes.groupBy("host", "node").agg(F.sum("pages").alias("n"), F.sum("same").alias("same"))
    constant = votes.where((F.col("n") >= MIN_PAGES) & (F.col("same") >= CONSTANT * F.col("n")))
    constant = constant.groupBy("host").agg(F.array_sort(F.collect_list("node")).alias("constant"))
    return stage(layouts.join(constant, "host", "left"), f"{folder}/wrappers")


def _small(rows: DataFrame) -> bool:
    """Whether a table may be broadcast, by its measured size."""
    size = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()["n"]
    return (size or 0) <= BROADCAST_BYTES


def main_texts(
    pages: DataFrame,
    html_col: str = "html",
    url_col: str = "url",
    columns: list[str] | None = None,
) -> DataFrame:
    """``page`` (the columns of the row, all by default, as a struct) and ``text``, row by row."""
    spark = pages.sparkSession
    ship(spark)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^\w+://([^/?#]*)", 1))
    rows = pages.select(
        F.struct(*(columns or ["*"])).alias("page"),
        host.alias("host"),
        F.col(html_col).cast("string").alias("html"),
    )
    found = wrappers(rows.select("host", "html"), run_folder(spark))
    joined = rows.join(F.broadcast(found) if _small(found) else found, "host", "left")
    schema = rows.select("page", F.lit("").alias("text")).schema
    return joined.mapInArrow(_extract, schema)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("page")["page_id"].alias("page_id"),
        F.col("page")["url"].alias("url"),
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
    )
