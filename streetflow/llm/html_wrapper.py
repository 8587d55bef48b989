"""HTML extraction by wrapper induction.

Pages become DOM trees, in which runs of siblings of one kind are folded. One
page of each host is the reference; every page of the host is aligned with it
by simple tree matching (the largest order-preserving matching of nodes of one
kind, found by dynamic programming over the children of matched nodes). Nodes
that the reference lacks are told apart by their kinds below the matched node
they are in. Texts that nearly all pages of a host show at the same node are its
template; what varies is content. Of the content, text stays that lies in the page's
article (or, on pages without one, outside everything that is marked as
boilerplate).
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.graph import staged

# fixed values: kinds of elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset(
    "head script style textarea title noscript iframe noembed noframes xmp template nav footer aside form button select "
    "option input dialog menu svg canvas object audio video map math".split())
#: Words that name boilerplate where a class, id or role is one, or begins or ends with one ("nav", "site-footer",
#: "cookie-banner"), and first words of names that tell a state or a look ("has-sidebar", "text-banner").
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner banners sponsor sponsored sponsors promo promos promotion "
    "popup modal nav navbar navigation navlinks menu menus menubar breadcrumb breadcrumbs sidebar sidebars footer "
    "masthead cookie cookies consent notice notices alert gdpr newsletter subscribe subscription comment comments "
    "respond replies share sharing social related recommended recommendations pagination pager toolbar login search "
    "searchbox searchform widget widgets complementary contentinfo".split())
MARKED_WHOLE = frozenset("site-header page-header skip-link".split())
STATES = frozenset("has with without no not is js text bg color col row theme layout page body open closed on off show hide "
                   "enabled disabled".split())
#: Elements whose id names a group, not a place in the text.
GROUPS = frozenset("div ul ol dl table td span".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"},
          "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = frozenset("table ul ol dl select body html article div section".split())

#: Elements at which an opening block's search for what it ends stops or finds something.
BORDERS = SCOPES | {"p"}.union(*CLOSES.values())

#: Pairs of children beyond which the table of their matching is made row by row with arrays.
_PAIRS = 1 << 10

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    """An element; ``parts`` are its children and texts in order."""

    __slots__ = ("tag", "kind", "marked", "parts")

    def __init__(self, tag: str, kind: str = "", marked: bool = False) -> None:
        self.tag, self.kind, self.marked = tag, kind or tag, marked
        self.parts: list[Node | str] = []


def parse(page: str) -> Node:
    """DOM tree of a page, however broken; texts are raw."""
    root = Node("")
    stack = [root]
    places: dict[str, list[int]] = {}  # of the open elements of each tag in the stack
    borders: list[int] = []
    at = 0

    def close(i: int) -> None:
        while len(stack) > i:
            places[stack.pop().tag].pop()
        while borders and borders[-1] >= i:
            borders.pop()

    while (m := _TAG.search(page, at)) is not None:
        if m.start() > at:
            stack[-1].parts.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag in BLOCK:  # a block ends an open paragraph, and items end items of their list
            ends = CLOSES.get(tag, set()) | {"p"}
            for i in reversed(borders.copy() if len(borders) < 8 else _until_scope(stack, borders)):
                if stack[i].tag in ends:
                    close(i)
                elif stack[i].tag in SCOPES:
                    break
        node = _element(tag, m[3])
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            if tag in BORDERS:
                borders.append(len(stack))
            stack.append(node)
    if at < len(page):
        stack[-1].parts.append(page[at:])
    return root


def _until_scope(stack: list[Node], borders: list[int]) -> list[int]:
    """The last of ``borders`` from the innermost scope on."""
    n = len(borders) - 1
    while n > 0 and stack[borders[n]].tag not in SCOPES:
        n -= 1
    return borders[n:]


def _marks(token: str) -> bool:
    """Whether a class, id or role names boilerplate."""
    words = re.split(r"[-_]+", token)
    if len(words) > 1 and (words[0] in STATES or words[-1] in STATES):
        return False
    return token in MARKED_WHOLE or words[0] in MARKED or words[-1] in MARKED


def _element(tag: str, attributes: str) -> Node:
    names, marked = [], False
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, tokens = name.lower(), "".join(values).lower().split()
            if name == "hidden":
                marked = True
            elif name in ("class", "id", "role"):
                marked |= (name != "id" or tag in GROUPS) and any(map(_marks, tokens))
                names += re.sub(r"\d+", "", " ".join(tokens)).split()
    return Node(tag, ".".join([tag, *sorted(set(names))]), marked and tag not in ("html", "body", "main"))


class Slot:
    """A folded node: siblings of one kind that follow each other."""

    __slots__ = ("kind", "children", "number")

    def __init__(self, kind: str) -> None:
        self.kind, self.children, self.number = kind, [], -1


def fold(nodes: list[Node], into: Slot, place: dict[int, Slot]) -> None:
    """Adds the folded children of ``nodes`` to ``into``; ``place`` gets the slot of each node by id()."""
    todo = [(nodes, into)]
    while todo:
        nodes, into = todo.pop()
        runs: list[tuple[list[Node], Slot]] = []
        for child in (p for n in nodes for p in n.parts if isinstance(p, Node) and p.tag not in RAW and p.tag not in VOID):
            if not runs or runs[-1][1].kind != child.kind:
                runs.append(([], Slot(child.kind)))
            runs[-1][0].append(child)
            place[id(child)] = runs[-1][1]
        into.children += [slot for _, slot in runs]
        todo += runs


def dump(slot: Slot) -> list:
    """[kind, number of the parent] of each slot in page order."""
    out: list[list] = []
    todo = [(slot, -1)]
    while todo:
        slot, parent = todo.pop()
        todo += [(c, len(out)) for c in reversed(slot.children)]
        out.append([slot.kind, parent])
    return out


@lru_cache(256)
def load(template: str) -> Slot:
    """A template's slots, numbered in page order."""
    slots: list[Slot] = []
    for number, (kind, parent) in enumerate(json.loads(template)):
        slot = Slot(kind)
        slot.number = number
        if parent >= 0:
            slots[parent].children.append(slot)
        slots.append(slot)
    return slots[0]


def _classes(top: Slot, known: dict[tuple, int], of: dict[int, int]) -> None:
    """Puts the class of each slot into ``of`` by id(); equal trees have equal classes."""
    order, todo = [], [top]
    while todo:
        order.append(todo.pop())
        todo += order[-1].children
    for slot in reversed(order):
        of[id(slot)] = known.setdefault((slot.kind, tuple(of[id(c)] for c in slot.children)), len(known))


def _largest(x: list[int], y: list[int], weight: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """(weight, pairs of places) of the heaviest order-preserving matching of two lists of classes."""
    n, m = len(x), len(y)
    chosen, i, j = [], n, m
    if n * m <= _PAIRS:
        table = [[0] * (m + 1) for _ in range(n + 1)]
        for a, c in enumerate(x):
            for b, d in enumerate(y):
                table[a + 1][b + 1] = max(table[a][b + 1], table[a + 1][b], table[a][b] + weight.get((c, d), 0))
        rows, low, total = table, 0, table[-1][-1]
    else:
        kinds, place = np.unique(y, return_inverse=True)
        of = {c: np.array([weight.get((c, d), 0) for d in kinds.tolist()], np.int64) for c in set(x)}

        def after(row: np.ndarray, c: int) -> np.ndarray:
            out = np.zeros(m + 1, np.int64)
            np.maximum.accumulate(np.maximum(row[1:], row[:-1] + of[c][place]), out=out[1:])
            return out

        # every step-th row is kept, the others are made again on the way back
        step = int(n ** 0.5) + 1
        row, kept = np.zeros(m + 1, np.int64), []
        for a, c in enumerate(x):
            if a % step == 0:
                kept.append(row)
            row = after(row, c)
        rows, low, total = [row], n, int(row[-1])
    while i and j:
        if i - 1 < low:
            low = (i - 1) // step * step
            rows = [kept[low // step]]
            for c in x[low:i]:
                rows.append(after(rows[-1], c))
        own, above = rows[i - low], rows[i - 1 - low]
        if own[j] == above[j]:
            i -= 1
        elif own[j] == own[j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            chosen.append((i, j))
    return total, chosen


def match(page: Slot, reference: Slot) -> dict[int, int]:
    """Simple tree matching: id() of the page's slots -> number of the matched slot of the reference."""
    known: dict[tuple, int] = {}
    of: dict[int, int] = {}
    _classes(page, known, of)
    _classes(reference, known, of)
    weight: dict[tuple[int, int], int] = {}
    chosen: dict[tuple[int, int], list[tuple[int, int]]] = {}
    work = [(page, reference)] if page.kind == reference.kind else []
    while work:
        a, b = work[-1]
        key = of[id(a)], of[id(b)]
        if key in weight:
            work.pop()
            continue
        x, y = [of[id(c)] for c in a.children], [of[id(d)] for d in b.children]
        kinds: dict[str, list[Slot]] = {}
        for d in dict(zip(y, b.children, strict=True)).values():
            kinds.setdefault(d.kind, []).append(d)
        first = [(c, d) for c in dict(zip(x, a.children, strict=True)).values() for d in kinds.get(c.kind, ())
                 if (of[id(c)], of[id(d)]) not in weight]
        if first:
            work += first
            continue
        work.pop()
        below, chosen[key] = _largest(x, y, weight)
        weight[key] = 1 + below

    out: dict[int, int] = {}
    todo = [(page, reference)] if page.kind == reference.kind else []
    while todo:
        a, b = todo.pop()
        out[id(a)] = b.number
        todo += [(a.children[i], b.children[j]) for i, j in chosen[of[id(a)], of[id(b)]]]
    return out


def blocks(root: Node, lenient: bool = False) -> list[tuple[str, Node, Node | None, bool, float]]:
    """(text, element, article, whether boilerplate by its marks, share in links)
    of each run of text between block borders, in page order. ``lenient``: what
    stands above an article does not mark it."""
    out: list[tuple[str, Node, Node | None, bool, float]] = []
    held: list[str] = []
    linked = 0
    owner: tuple[Node, Node | None, bool] | None = None

    def flush() -> None:
        nonlocal linked, owner
        text = " ".join(entities.unescape("".join(held)).split())
        if text and owner:
            out.append((text, *owner, min(1.0, linked / max(1, len(text)))))
        held.clear()
        linked, owner = 0, None

    # (part, block element, article, boilerplate, in a link, whether it ends)
    todo: list[tuple] = [(root, root, None, False, False, False)]
    while todo:
        part, block, article, bad, link, ends = todo.pop()
        if isinstance(part, str):
            held.append(part)
            if part.strip():
                owner = owner or (block, article, bad)
                linked += len(part.strip()) * link
            continue
        if ends:
            flush()
            continue
        if part.tag == "br":
            held.append(" ")
            continue
        edge = part.tag in BLOCK or part.tag == "" or part.tag in NEVER
        # a header is the page's unless it is an article's own
        bad = bad or part.tag in NEVER or part.marked or (part.tag == "header" and article is None)
        if lenient and part.tag == "article" and not part.marked and article is None:
            bad = False
        if part.tag in ("article", "main") and not bad and (article is None or article.tag == "main"):
            article = part
        if edge:
            flush()
            block = part
            todo.append((part, block, article, bad, link, True))
        inner = link or part.tag == "a"
        todo += [(p, block, article, bad, inner, False) for p in reversed(part.parts)]
    flush()
    return out


def candidates(page: str) -> tuple[list[tuple[str, Node]], Node]:
    """Content by marks alone: (text, element) of the blocks of the page's articles, or
    of all that are not boilerplate where there is no article; and the tree. Articles
    that lie only inside marked elements (a theme's "comments-enabled" box, a form
    around the page) count where there are no others."""
    root = parse(page)
    found = [b for b in blocks(root) if not b[3]]
    inside = [b for b in found if b[2] is not None]
    if not inside:
        inside = [b for b in blocks(root, lenient=True) if not b[3] and b[2] is not None]
    if any(b[2].tag == "article" for b in inside):  # not what else the page's main part holds
        inside = [b for b in inside if b[2].tag == "article"]
    if inside:
        return [(t, n) for t, n, _, _, _ in inside], root
    return [(t, n) for t, n, _, _, links in found if links <= 0.5], root


def placed(page: str, template: str) -> list[tuple[str, int]]:
    """(text, number of the template's slot) of a page's candidates; slots that
    the template lacks have negative numbers, the same on all pages of a host."""
    found, root = candidates(page)
    place: dict[int, Slot] = {}
    top = Slot("")
    fold([root], top, place)
    place[id(root)] = top
    at = match(top, load(template))
    todo = [top]
    while todo:
        slot = todo.pop()
        for c in slot.children:
            if id(c) not in at:
                at[id(c)] = -1 - (xxhash.xxh64_intdigest(f"{at[id(slot)]} {c.kind}") >> 1)
        todo += slot.children
    return [(t, at[id(place[id(n)])]) for t, n in found]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _templates(pages: DataFrame) -> DataFrame:
    """(host, template) from one page of each host, with text if it has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page in batch.column(1):
                top = Slot("")
                fold([parse(page.as_py())], top, {})
                out.append(json.dumps(dump(top)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["host", "template"])

    bare = F.regexp_replace("html", r"(?is)<(head|script|style|title)\b.*?</\1\s*>|<[^>]*>", "")
    chosen = pages.where("html is not null").groupBy("host").agg(
        F.min_by("html", F.struct(~bare.rlike(r"\S"), F.xxhash64("page_id", "url"), "page_id")).alias("html"))
    return chosen.mapInArrow(run, "host string, template string")


def _texts(pages: DataFrame) -> DataFrame:
    """(host, slot, text, page): hashes of the candidates' texts, and of the page they show."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple[str, int, int, int]] = set()
            for host, page, template in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = placed(page, template)
                # pages whose texts are all the same are copies, and count once
                whole = _hash(json.dumps(found))
                rows |= {(host, at, _hash(text), whole) for text, at in found}
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=["host", "slot", "text", "page"])

    return pages.select("host", "html", "template").mapInArrow(run, "host string, slot long, text long, page long")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
            least_pages: int = 5, share: float = 0.9, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """(page_id, url, text) of each row of ``pages``: the main text, its blocks
    joined by ``\\n``.

    A text is template if ``share`` of at least ``least_pages`` different pages
    of the host show it at the same slot. Null, empty and text-free pages give
    an empty text; pages with a null url share a host. Ids may be null or
    repeat; each row is extracted by itself. An empty table gives an empty
    result. Other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[^/?#]*//([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host.alias("host"))

    def with_host(table: DataFrame, width: str) -> DataFrame:
        """Rows with their host's columns, broadcast if these are few bytes in all."""
        size = table.agg(F.sum(F.expr(width))).first()[0] or 0
        return rows.join(F.broadcast(table) if size <= broadcast_bytes else table, "host", "left")

    templates = staged(_templates(rows), "templates")
    seen = _texts(with_host(templates, "length(template) + 64").where("html is not null"))
    seen = staged(seen.distinct(), "texts")
    shown = seen.select("host", "slot", "page").distinct().groupBy("host", "slot").agg(F.count("*").alias("pages"))
    fixed = (
        seen.groupBy("host", "slot", "text").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages * share)
        .join(shown.where(F.col("pages") >= least_pages), ["host", "slot"])
        .where(F.col("n") >= share * F.col("pages"))
        .groupBy("host").agg(F.collect_list(F.struct("slot", "text")).alias("fixed"))
    )
    wrappers = staged(templates.join(fixed, "host", "left"), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, template, known in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                if not page or not template:
                    out.append("")
                    continue
                drop = {(k["slot"], k["text"]) for k in known or ()}
                found = placed(page, template) if drop else [(t, 0) for t, _ in candidates(page)[0]]
                out.append("\n".join(t for t, at in found if (at, _hash(t)) not in drop))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return with_host(wrappers, "length(template) + 16 * coalesce(size(fixed), 0) + 64").select(
        "page_id", "url", "html", "template", "fixed").mapInArrow(run, "page_id long, url string, text string")
