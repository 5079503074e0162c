"""Main text of pages by wrapper induction.

One page of each host serves as its reference. Every page's DOM tree is aligned with the reference
by simple tree matching, so a block of text gets the reference node it stands at as its slot. A slot that
holds the same text on most of a host's different pages is template; what varies is content. Regions that
the markup itself declares as furniture (navigation, footers, asides, forms, adverts, comments and the like)
are never content, however much they vary; inside an article only a few class names say so.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import small_batches, stored
from marketlake.llm.url_filter import host_and_path

#: A text is template at its slot from this share of a host's different pages on, and from so many pages on.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object select title head".split())
VERBATIM = frozenset("script style textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul caption legend".split())
FURNITURE = RAW | frozenset("nav footer aside form button dialog menu input label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                  "toolbar".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|adsense|adslot|banner|promo\w*|sponsor\w*|sidebar\w*|nav|navbar|navigation|menu\w*|"
    r"breadcrumb\w*|footer|masthead|cookie\w*|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|"
    r"subscription|signup|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|repl(?:y|ies)|respond|"
    r"widget\w*|toolbar|pagination|pager|login|search|skip|hidden|teasers?)(?=$|[\s_-])", re.I)
#: The names that count inside an article too, on elements that hold others; there the slots decide about the rest.
INNER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|sponsored|comments|commentlist|disqus|newsletter|cookie\w*|gdpr)(?=$|[\s_-])", re.I)
HOLDERS = frozenset("div section ul ol table ins figure details".split())
#: Opening one of the keys ends an open element of the values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "body": {"head"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    furniture: bool
    parent: Node | None = None
    children: list[Node] = field(default_factory=list)
    #: text pieces (str) and children in order
    flow: list = field(default_factory=list)
    number: int = -1
    shape: int = 0
    size: int = 1


def _is_furniture(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not inside_article):
        return True
    values = [(m[1].lower(), (m[2] or m[3] or m[4] or "").strip()) for m in _ATTRIBUTE.finditer(attributes or "")]
    if tag == "article":
        return any(v.lower() in ("comment", "comments") for _, v in values)
    if tag in ("html", "body", "main") or (inside_article and tag not in HOLDERS):
        return False
    names = INNER_NAMES if inside_article else NAMES
    return any(v.lower() in ROLES if name == "role" else bool(names.search(v)) for name, v in values)


def parse(text: str) -> Node:
    """A DOM tree of possibly broken html; unfinished markup at the end is dropped."""
    root = Node("html", False)
    top, at, articles = root, 0, 0

    def close(until: Node) -> None:
        nonlocal top, articles
        while True:
            if top.tag == "article":
                articles -= 1
            done, top = top is until, top.parent or root
            if done:
                return

    def add(piece: str) -> None:
        if piece:
            top.flow.append(entities.unescape(piece) if "&" in piece else piece)

    while m := _TOKEN.search(text, at):
        add(text[at: m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or tag == "html":
            continue
        if m[1]:
            node = top
            while node is not root and node.tag != tag:
                # a stray end tag does not reach out of a table cell or an article
                node = root if node.tag in ("td", "th", "article") and tag not in BLOCKS else node.parent
            if node is not root:
                close(node)
            continue
        if tag in VOID:
            if tag == "hr":
                top.flow.append(Node("hr", False, top))
            elif tag in ("br", "wbr"):
                top.flow.append(" " if tag == "br" else "")
            continue
        if tag in BLOCKS or tag in ENDS:
            node = top
            while node is not root and node.tag not in SCOPES.get(tag, ()) and (node.tag not in BLOCKS or node.tag in ENDS.get(
                    tag, ()) or node.tag == "p"):
                if node.tag in ENDS.get(tag, ()) or (node.tag == "p" and tag in BLOCKS):
                    close(node)
                    break
                node = node.parent
        node = Node(tag, _is_furniture(tag, m[3], articles > 0), top)
        if tag in VERBATIM:
            end = re.compile(f"</{tag}", re.I).search(text, at)
            at = end.start() if end else len(text)
            if end and (closing := text.find(">", at)) >= 0:
                at = closing + 1
            else:
                at = len(text)
            top.children.append(node)
            top.flow.append(node)
            continue
        top.children.append(node)
        top.flow.append(node)
        if not m[3].endswith("/"):
            top = node
            articles += tag == "article"
    add(text[at:])
    _number(root)
    return root


def _number(root: Node) -> None:
    """Preorder numbers, and a hash of each subtree's tags and its number of nodes."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.number = len(order)
        order.append(node)
        stack.extend(reversed(node.children))
    for node in reversed(order):
        node.size = 1 + sum(c.size for c in node.children)
        node.shape = hash((len(node.tag), sum(ord(c) * 31 ** i for i, c in enumerate(node.tag)),
                           *(c.shape for c in node.children)))


def middle(xs: list[Node], ys: list[Node]) -> tuple[list[Node], list[Node], list[tuple[Node, Node]]]:
    """Two child lists without the equal subtrees at their ends, and the pairs of those."""
    shorter, low, high = min(len(xs), len(ys)), 0, 0
    while low < shorter and xs[low].shape == ys[low].shape:
        low += 1
    while high < shorter - low and xs[-1 - high].shape == ys[-1 - high].shape:
        high += 1
    equal = [*zip(xs[:low], ys[:low]), *(zip(xs[-high:], ys[-high:]) if high else ())]
    return xs[low: len(xs) - high], ys[low: len(ys) - high], equal


def row_ends(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best weight of an in-order pairing of all of ``a`` with each beginning of ``b``, row after row."""
    row = np.zeros(len(b) + 1, np.int64)
    for kind in a:
        row[1:] = np.maximum(row[1:], row[:-1] + table[kind, b])
        np.maximum.accumulate(row, out=row)
    return row


def paired(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Positions of a best in-order pairing, by halving ``a`` where the best pairings of its halves meet: exact for lists of
    any length, in memory for a few rows."""
    out, parts = [], [(0, len(a), 0, len(b))]
    while parts:
        first, past, low, high = parts.pop()
        if first == past or low == high:
            continue
        if past - first == 1:
            w = table[a[first], b[low:high]]
            if w.max() > 0:
                out.append((first, low + int(w.argmax())))
            continue
        half = (first + past) // 2
        left = row_ends(table, a[first:half], b[low:high])
        right = row_ends(table, a[half:past][::-1], b[low:high][::-1])[::-1]
        cut = low + int((left + right).argmax())
        parts += [(first, half, low, cut), (half, past, cut, high)]
    return out


class Aligner:
    """Simple tree matching of page trees with one reference tree."""

    def __init__(self, reference: Node):
        self.reference, self.scores = reference, {}

    def known(self, a: Node, b: Node) -> int | None:
        """Score of a pair if it is known: 0 for different tags, all nodes for equal shapes."""
        if a.tag != b.tag:
            return 0
        return a.size if a.shape == b.shape else self.scores.get((a.shape, b.shape))

    def score(self, a: Node, b: Node) -> int:
        """Most node pairs that match top-down and in order. Pairs below come first, by a stack of pairs still open."""
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self.known(x, y) is None:
                xs, ys, equal = middle(x.children, y.children)
                kinds = {c.shape: c for c in xs}.values(), {c.shape: c for c in ys}.values()
                missing = [(c, d) for c in kinds[0] for d in kinds[1] if self.known(c, d) is None]
                if missing:
                    stack.extend(missing)
                    continue
                self.scores[x.shape, y.shape] = 1 + sum(c.size for c, _ in equal) + self.best(xs, ys)
            stack.pop()
        return self.known(a, b)

    def weights(self, xs: list[Node], ys: list[Node]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores between the kinds of children (by shape), and each child's kind."""
        a, b = {c.shape: c for c in xs}, {c.shape: c for c in ys}
        table = np.array([[self.known(c, d) for d in b.values()] for c in a.values()], np.int64)
        place = [{shape: i for i, shape in enumerate(kinds)} for kinds in (a, b)]
        return table, np.array([place[0][c.shape] for c in xs]), np.array([place[1][c.shape] for c in ys])

    def best(self, xs: list[Node], ys: list[Node]) -> int:
        return int(row_ends(*self.weights(xs, ys))[-1]) if xs and ys else 0

    def pairs(self, xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
        """A best in-order pairing of two child lists. Equal subtrees at either end pair at once."""
        xs, ys, out = middle(xs, ys)
        if xs and ys:
            for c in {c.shape: c for c in xs}.values():
                for d in {d.shape: d for d in ys}.values():
                    self.score(c, d)
            out += [(xs[i], ys[j]) for i, j in paired(*self.weights(xs, ys))]
        return out

    def slots(self, page: Node) -> dict[int, int]:
        """Page node number → reference node number of every aligned node."""
        found, open_pairs = {}, [(page, self.reference)]
        while open_pairs:
            a, b = open_pairs.pop()
            found[a.number] = b.number
            open_pairs.extend(self.pairs(a.children, b.children))
        return found


def content_roots(root: Node) -> list[Node]:
    """The outermost articles outside furniture, else the main element, else the whole page."""
    for wanted in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.furniture:
                continue
            if node.tag == wanted:
                found.append(node)
            else:
                stack.extend(reversed(node.children))
        if found:
            return found
    return [root]


def blocks(root: Node) -> list[tuple[int, str]]:
    """Text blocks in page order, each with the number of the block element that holds it."""
    out: list[tuple[int, str]] = []

    def flush(held: list[str], owner: int) -> None:
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            out.append((owner, text))

    for start in content_roots(root):
        held: list[str] = []
        stack: list = [(iter(start.flow), start.number, True)]
        while stack:
            flow, owner, is_block = stack[-1]
            for piece in flow:
                if isinstance(piece, str):
                    held.append(piece)
                elif piece.furniture:
                    if piece.tag in BLOCKS or piece.tag not in RAW:
                        flush(held, owner)
                elif piece.tag in BLOCKS:
                    flush(held, owner)
                    stack.append((iter(piece.flow), piece.number, True))
                    break
                else:
                    stack.append((iter(piece.flow), owner, False))
                    break
            else:
                if is_block:
                    flush(held, owner)
                stack.pop()
    return out


#: Characters of a per-host table up to which it is broadcast; a larger one is joined by a shuffle.
BROADCAST_CHARS = 8 << 20


def if_small(per_host: DataFrame, size: Column) -> DataFrame:
    total = per_host.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(per_host) if total <= BROADCAST_CHARS else per_host


SLOTTED = "page_id long, url string, host string, blocks array<struct<slot:int,text:string>>"


def slotted_blocks(pages: DataFrame) -> DataFrame:
    """Every page's blocks, with the slot of the host's reference page each stands at (-1: none)."""
    small_batches(pages.sparkSession)
    host, _ = host_and_path(F.col("url"))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"),
                       F.coalesce("html", F.lit("")).alias("html"))
    # any page can be the reference; one per host merges map-side
    reference = own.groupBy("host").agg(F.min_by("html", F.xxhash64("html")).alias("reference"))
    reference = if_small(stored(reference, "references"), F.length("reference"))
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))

    def align(batches):
        known: dict[str, Aligner] = {}
        for batch in batches:
            out = []
            for host, page, ref in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "reference"))):
                if host not in known:
                    if len(known) >= 64:
                        known.clear()
                    known[host] = Aligner(parse(ref))
                tree = parse(page)
                slots = known[host].slots(tree)
                out.append([{"slot": slots.get(n, -1), "text": t} for n, t in blocks(tree)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), pa.array(out, kind)],
                                             ["page_id", "url", "host", "blocks"])

    return own.join(reference, "host").select("page_id", "url", "host", "html", "reference").mapInArrow(align, SLOTTED)


def templates(slotted: DataFrame) -> DataFrame:
    """``host, constant``: hashes of (slot, text) that most of a host's different pages share.

    Pages with the same blocks are one page here, so copies of an article do not make it template.
    """
    different = slotted.select("host", F.xxhash64("blocks").alias("body"), F.transform(
        "blocks", lambda b: F.xxhash64(b["slot"], b["text"])).alias("entries")).dropDuplicates(["host", "body"])
    total = different.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    shared = (different.select("host", F.explode(F.array_distinct("entries")).alias("entry"))
              .groupBy("host", "entry").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= TEMPLATE_PAGES).join(total, "host").where(F.col("n") >= TEMPLATE_SHARE * F.col("total")))
    # at most blocks of a page / TEMPLATE_SHARE entries on average
    return shared.groupBy("host").agg(F.collect_set("entry").alias("constant"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``: blocks joined by two line feeds.

    Null and empty html give an empty text; null urls are pages of one nameless host. Repeated rows each
    give their text. A page of which nothing varies keeps all: its slots tell nothing.
    """
    slotted = stored(slotted_blocks(pages), "blocks")
    rest = F.filter("blocks", lambda b: ~F.array_contains("constant", F.xxhash64(b["slot"], b["text"])))
    constant = if_small(stored(templates(slotted), "templates"), 8 * F.size("constant"))
    kept = (slotted.join(constant, "host", "left")
            .withColumn("rest", F.coalesce(rest, "blocks"))
            .withColumn("final", F.when(F.size("rest") > 0, F.col("rest")).otherwise(F.col("blocks"))))
    text = F.array_join(F.col("final.text"), "\n\n")
    return kept.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
