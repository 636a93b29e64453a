"""Main text of web pages by composite text density over the DOM.

Names of elements, forms and hidden elements are suspects only: what they hold against the
rest of the page decides whether they go. What is left is weighed by composite text density.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
NEVER = RAW | frozenset("nav footer aside head button select option svg math canvas object audio video dialog menu".split())
FIELDS = frozenset("input select textarea button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "label small span strike strong sub sup time tt u var wbr br img td th".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag that ends an open one of these, searched no further out than the named bounds.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr"}, {"table"}),
        "body": ({"head"}, set())}
# Words of class, id and role names that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar footer masthead topbar cookie cookies consent notice notices gdpr "
    "popup modal overlay newsletter subscribe subscription signup login comment comments reply replies respond disqus "
    "share sharing social related recommended toolbar pagination pager search widget contentinfo "
    "complementary alertdialog skip copyright paywall".split())
# Words before such a word in one name that make it say how a page is laid out.
LAYOUT = frozenset("with without has no not".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.S)
LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PIECES = re.compile(r"[A-Za-z]+")
UNASKED = re.compile(r"type\s*=\s*[\"']?hidden", re.I)
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
# The words above that mark reader comments.
REMARKS = frozenset("comment comments reply replies respond disqus".split())
#: A suspect outside articles stays if it has so many times the plain text of all that is not suspect; inside one; and
#: a form if it has so many plain characters for each of its fields.
OUTSIDE, INSIDE, FIELD_CHARS = 4, 0.5, 20


class Node:
    __slots__ = ("tag", "up", "kids", "skip", "chars", "tags", "link_chars", "link_tags", "density", "suspect", "inside",
                 "bare", "plain", "links", "fields", "marks", "blocks", "inner")

    def __init__(self, tag: str, up: Node | None, skip: bool, suspect: int = 0, inside: bool = False):
        self.tag, self.up, self.skip, self.suspect, self.inside, self.kids = tag, up, skip, suspect, inside, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def suspicion(tag: str, attributes: str) -> int:
    """2 for names of reader comments, 1 for other names of boilerplate, forms and hidden elements, else 0."""
    worst = int(tag == "form")
    if not attributes or tag in ("html", "body"):
        return worst
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and UNSEEN.search(value):
            worst = max(worst, 1)
        if name not in ("class", "id", "role") or tag in HEADINGS:
            continue
        words = set()
        for one in value.split():
            pieces = [w.lower() for w in PIECES.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", one))]
            words.update(w for before, w in zip(["", *pieces], pieces) if before not in LAYOUT)
        if words & REMARKS:
            worst = 2
        elif tag not in ("article", "main") and (words & BOILERPLATE or name == "role" and words & {"banner", "form", "alert"}):
            worst = max(worst, 1)
    return worst


def parse(page: str) -> tuple[Node, list[Node]]:
    """Element tree of a page. Kids are nodes and texts in page order; skipped elements have neither."""
    root = Node("html", None, False)
    nodes, stack, at = [root], [root], 0
    depths: dict[str, list[int]] = {}

    def leave(depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        while len(stack) > depth:
            depths[stack.pop().tag].pop()

    while at < len(page):
        node = stack[-1]
        m = TOKEN.search(page, at)
        start = page.find("<", at)
        if m is None or start >= 0 and start < m.start():
            loose = LOOSE.match(page, start) if start >= 0 else None
            if loose:
                m = loose
            elif m is None:
                if not node.skip:
                    node.kids.append(html.unescape(page[at:]))
                break
        if m.start() > at and not node.skip:
            node.kids.append(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = (m.group(2) or "").lower() if m.re.groups else ""
        if not tag:
            continue
        if m.group(1):
            if depths.get(tag):
                leave(depths[tag][-1])
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P or tag in ENDS:
            ended, bounds = ENDS.get(tag, ({"p"}, {"td", "th", "li", "div", "article", "section", "body", "table"}))
            bound = max((depths[b][-1] for b in bounds if depths.get(b)), default=0)
            first = [open_[k] for open_ in (depths.get(e, []) for e in ended) if (k := bisect_right(open_, bound)) < len(open_)]
            if first:
                leave(min(first))
        node = stack[-1]
        if tag in VOID or tag in RAW:
            if tag in FIELDS and not node.skip and not UNASKED.search(m.group(3)):
                node.kids.append(Node(tag, node, False))
                nodes.append(node.kids[-1])
            elif tag == "br" and not node.skip:
                node.kids.append(" ")
            elif tag == "hr" and not node.skip:
                node.kids.append(Node("hr", node, False))
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        inside = bool(depths.get("article") or depths.get("main"))
        skip = node.skip or tag in NEVER or tag == "header" and not inside
        child = Node(tag, node, skip, 0 if skip else suspicion(tag, m.group(3)), inside)
        depths.setdefault(tag, []).append(len(stack))
        stack.append(child)
        if not skip:
            node.kids.append(child)
            nodes.append(child)
        elif not node.skip and tag in FIELDS:
            node.kids.append(Node(tag, node, False))
            nodes.append(node.kids[-1])
    return root, nodes


def cleared(nodes: list[Node]) -> list[Node]:
    """The elements left when suspects are gone that hold little plain text against the rest of the page.

    ``plain`` and ``links`` count characters outside and inside links, ``bare`` the plain ones outside inner suspects.
    Suspects are judged from the largest on; what one that stays holds counts for the rest of the page, and the
    suspects inside it are judged next.
    """
    for node in nodes:
        node.bare = node.plain = node.links = node.fields = node.marks = node.blocks = 0
        node.inner = []
    for node in reversed(nodes):
        own = sum(len("".join(k.split())) for k in node.kids if isinstance(k, str))
        node.plain, node.bare = node.plain + own, node.bare + own
        if node.tag == "a":
            node.links, node.plain, node.bare = node.links + node.plain, 0, 0
        node.fields += node.tag in FIELDS
        up = node.up
        if up is None:
            continue
        up.plain, up.links, up.fields = up.plain + node.plain, up.links + node.links, up.fields + node.fields
        if node.suspect < 2:
            up.blocks += node.blocks + ((node.tag == "p" or node.tag in HEADINGS) and node.plain > 0)
        if node.suspect:
            up.inner.append(node)
            continue
        up.bare += node.bare
        up.marks |= node.marks | (2 if node.tag == "main" and node.plain else 1 if node.tag == "article" and node.plain else 0)
        if len(node.inner) > len(up.inner):
            up.inner, node.inner = node.inner, up.inner
        up.inner.extend(node.inner)
    rest = nodes[0].bare
    waiting = [(-n.plain, k, n) for k, n in enumerate(nodes[0].inner)]
    heapq.heapify(waiting)
    order, stay = len(waiting), set()
    while waiting:
        _, _, node = heapq.heappop(waiting)
        much = node.plain >= (INSIDE if node.inside else OUTSIDE) * rest and node.links <= node.plain
        if node.tag == "form":
            much = much and node.plain >= FIELD_CHARS * node.fields
        if node.suspect == 2:
            much = bool(node.marks & 2)
        if much and (node.marks or node.blocks > (not node.inside)):
            stay.add(id(node))
            rest += node.bare
            for inner in node.inner:
                heapq.heappush(waiting, (-inner.plain, order, inner))
                order += 1
    left = []
    for node in nodes:
        gone = node.up is not None and (node.up.skip or node.suspect and id(node) not in stay or node.tag in FIELDS)
        node.skip = bool(gone)
        if not gone:
            left.append(node)
    for node in left:
        node.kids = [k for k in node.kids if isinstance(k, str) or not k.skip]
    return left


def weigh(nodes: list[Node]) -> None:
    """Link-adjusted characters per tag of every element; children come after their parents in ``nodes``."""
    for node in reversed(nodes):
        link = node.tag == "a"
        node.chars += sum(len("".join(k.split())) for k in node.kids if isinstance(k, str))
        if link:
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.up is not None:
            up = node.up
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = nodes[0]
    ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        base = math.log(c / max(1, c - node.link_chars) * node.link_chars + ratio * c + math.e)
        grown = max(c / lc * t / lt, 1.0)
        node.density = c / t * (math.log(grown) / math.log(base) if base > 1.0 else math.log(max(grown, math.e)))


def block_kids(node: Node) -> list[Node]:
    """The block elements right below, seen through inline ones."""
    out, waiting = [], list(reversed(node.kids))
    while waiting:
        kid = waiting.pop()
        if isinstance(kid, Node):
            if kid.tag in INLINE:
                waiting.extend(reversed(kid.kids))
            else:
                out.append(kid)
    return out


def dense_part(nodes: list[Node]) -> tuple[list[Node], set[int], float]:
    """The element whose children's densities sum highest, the ids of its path, and the path's threshold.

    An article round it is taken whole, with the other articles of its ``main``.
    """
    best, most = nodes[0], -1.0
    for node in nodes:
        if node.tag in INLINE:
            continue
        kids = block_kids(node)
        own = sum(len("".join(k.split())) for k in node.kids if isinstance(k, str))
        total = sum(k.density for k in kids) + (own if kids else 0)
        if kids and total > most:
            best, most = node, total
    seek, marked = best, None
    while seek is not None:
        if seek.tag == "article" or seek.tag == "main" and (marked is None or marked.tag == "main"):
            marked = seek
        seek = seek.up
    best = marked or best
    chosen = [marked or best]
    if marked and marked.tag == "article":
        main = marked.up
        while main is not None and main.tag != "main":
            main = main.up
        if main is not None:
            chosen, waiting = [], [main]
            while waiting:
                for kid in waiting.pop().kids:
                    if isinstance(kid, Node):
                        (chosen if kid.tag == "article" else waiting).append(kid)
    path, least = set(), chosen[0].density
    for seek in chosen:
        while seek is not None and id(seek) not in path:
            path.add(id(seek))
            least = min(least, seek.density)
            seek = seek.up
    return chosen, path, math.inf if marked else least


def main_text(page: str | None) -> str:
    """Text blocks of a page's article, joined by line feeds."""
    if not page:
        return ""
    root, nodes = parse(page)
    nodes = cleared(nodes)
    weigh(nodes)
    best, path, least = dense_part(nodes)
    best = {id(node) for node in best}
    blocks, line = [], []

    def flush():
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    waiting = [(root, id(root) in best)]
    while waiting:
        item, kept = waiting.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if kept:
                line.append(item)
        else:
            # beside the path: what is as dense as it, and the headings over the chosen part
            aside = item.up is not None and id(item) not in path
            kept = kept or id(item) in best or aside and (item.density >= least or item.tag in HEADINGS and id(item.up) in path
                                                      and item.up.tag not in ("html", "body"))
            block = item.tag not in INLINE
            if block:
                flush()
                waiting.append((None, False))
            elif item.tag in ("td", "th"):
                line.append(" ")
            waiting.extend((k, kept) for k in reversed(item.kids))
    flush()
    return "\n".join(blocks)


def extracted(batches):
    for batch in batches:
        ids, urls, pages = batch.columns
        texts = [main_text(p) for p in pages.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [ids, urls, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    Null, empty and text-free pages give an empty text. Repeated rows give repeated rows. Of elements whose sums tie
    the first one on the page is taken. Time grows with a page's length, however deep or unclosed its elements are.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long")
