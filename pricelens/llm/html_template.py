"""Main text of web pages by removing site templates.

1. Each page is parsed. Every element subtree outside the article's prose gets a hash of its
   tags, classes and text, in the article and anywhere else on the page.
2. Per host, Spark counts the distinct pages each hash occurs on. A subtree on at least
   ``min_pages`` pages belongs to the template, however many pages the host has.
3. Template subtrees are deleted, on every page.
4. Tag rules refine the rest: elements whose tag, role or class says menu, header, footer,
   sidebar, notice, advert, form or reader comment are deleted as well, which is all that can
   be done on hosts with too few pages to count. Whole names in a class or id say so, or names put
   together of such words and words for boxes and places (``comment-list``, ``site-footer``), and
   never those of ``article`` or ``main``; what holds the page's main prose is spared from class,
   id, role and ``form``. Text outside the article goes if any of the article's is left.

The article is the outermost ``article`` elements, else ``main``, else the page. Paragraphs
and headings inside it (on pages without such elements: inside the element with most
paragraph text of its own) are never deleted as template, as copies and quoted passages recur
on many pages, too. Pages of a host that show the same text in the same subtrees count once.

Scale: pages are parsed twice. The first pass writes each distinct page's hashes to the shared
checkpoint folder; (page, hash) rows meet the counts, pre-aggregated, in an equi-join. The
second pass shuffles every page's compressed blocks, never the markup, to meet what was found.
Memory is linear in a page: blocks share the chains of subtrees that hold them.
A host with a third of all pages is a pre-aggregated key like any other, and the joins are
equi-joins that adaptive execution splits.

Defined cases: a null or empty html gives an empty text; a null url or one without host
counts for the host ''; repeated rows each get their row; malformed markup never fails:
unclosed elements end with their parent, stray end tags are ignored, an unfinished tag is
text. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from html import unescape

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_batches, written

MIN_PAGES = 5
FAR_MORE = 4

# Element names of the HTML standard and usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
PROSE = frozenset("blockquote dd dl dt figcaption h1 h2 h3 h4 h5 h6 li ol p pre table tbody td th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROP_TAGS = frozenset(
    "aside button canvas datalist dialog embed footer form head iframe input link menu meta nav noscript object script search "
    "select style svg template textarea title".split())
UNSEEN = frozenset("canvas datalist embed head iframe noembed noframes noscript object script style svg template title".split())
DROP_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer masthead menu modal nav navbar navigation newsletter notice notices popup promo promotion related "
    "respond share sharing sidebar social sponsor sponsored subscribe toolbar".split())
BOX_WORDS = frozenset(
    "area bar block box button buttons container content form group holder icons inner item items links list panel post posts row "
    "section signup slot thread unit widget wrap wrapper".split())
PLACE_WORDS = frozenset("article bottom global left main page post primary reader right secondary site top user".split())
UNNAMED = frozenset("article body html main".split())  # never dropped by class or id
CLOSES = {  # an opening tag ends these open elements, up to the nearest listed boundary
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set()),
}
ENDS_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


def names_page_part(words: str) -> bool:
    """Whether a class or id names a page part: a word for one, alone or with words for boxes and places."""
    for name in words.split():
        parts = set(re.split("[-_]+", name.strip("-_")))
        if not DROP_WORDS.isdisjoint(parts) and parts <= DROP_WORDS | BOX_WORDS | PLACE_WORDS:
            return True
    return False


class Node:
    __slots__ = ("tag", "parent", "kids", "drop", "words", "digest", "named", "own_p", "size", "hard", "gone")

    def __init__(self, tag: str, parent: Node | None, attrs: str):
        self.tag, self.parent, self.kids, self.words = tag, parent, [], ""
        self.digest = self.own_p = self.size = 0
        self.drop = tag in DROP_TAGS
        self.named = tag == "form"  # a page part by class, id or role alone, or a form: spared around the main prose
        self.hard = self.gone = False  # inside something dropped: for good, or in any way
        if attrs and not attrs.isspace():
            a = {}
            for m in ATTR.finditer(attrs):
                a.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            self.words = f"{a.get('id', '')} {a.get('class', '')}".strip().lower()
            style = a.get("style", "").replace(" ", "").lower()
            if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in style:
                self.drop, self.named = True, False
            elif not self.drop and (a.get("role", "").lower() in DROP_ROLES
                                    or tag not in UNNAMED and tag not in HEADINGS and names_page_part(self.words)
                                    or tag not in UNNAMED and not DROP_WORDS.isdisjoint(self.words.split())):
                self.drop = self.named = True


def parse(html: str) -> Node:
    """The element tree; text is kept as strings among the kids."""
    root = node = Node("#root", None, "")
    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            node.kids.append(unescape(html[at:]))
            break
        if m.start() > at:
            node.kids.append(unescape(html[at: m.start()]))
        at = m.end()
        if m[2]:
            tag = m[2].lower()
            node = _close_implied(node, tag)
            attrs = m[3]
            new = Node(tag, node, attrs)
            node.kids.append(new)
            if tag in VOID or attrs.endswith("/") and tag not in BLOCK and tag not in RAW:
                continue
            if tag in RAW:
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                new.kids.append(html[at: stop.start()] if stop else html[at:])
                at = stop.end() if stop else end
                continue
            node = new
        elif m[1]:
            tag, up = m[1].lower(), node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
        elif m[0].startswith("<![CDATA["):
            node.kids.append(m[0][9:].removesuffix("]]>"))
    return root


def _close_implied(node: Node, tag: str) -> Node:
    if tag in ENDS_P:
        up = node
        while up is not None and up.tag != "p" and up.tag not in ("article", "body", "button", "div", "li", "section", "td", "th"):
            up = up.parent
        if up is not None and up.tag == "p":
            node = up.parent
    if tag in CLOSES:
        ended, bound = CLOSES[tag]
        up, hit = node, None
        while up is not None and up.tag not in bound and up.parent is not None:
            if up.tag in ended:
                hit = up
            up = up.parent
        if hit is not None:
            node = hit.parent
    return node


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(k for k in n.kids if type(k) is Node)
    return order[::-1]


def _hash_subtrees(order: list[Node]) -> None:
    for n in order:  # kids come before their parents
        own = [n.tag, n.words]
        for k in n.kids:
            if type(k) is Node:
                own.append(str(k.digest))
                n.size += 0 if k.drop and not k.named else k.size
                if k.tag == "p":
                    n.own_p += k.own_p + sum(len(x) for x in k.kids if type(x) is str)
            elif not k.isspace():
                own.append(line := " ".join(k.split()))
                n.size += len(line)
        n.digest = xxhash.xxh3_64_intdigest("\x00".join(own).encode("utf-8", "replace")) - (1 << 63)


def _mark_dropped(order: list[Node]) -> None:
    for n in reversed(order):  # parents come before their kids
        up = n.parent
        n.hard = n.drop and not n.named or up is not None and up.hard
        n.gone = n.drop or up is not None and up.gone


def _spare_main_prose(order: list[Node]) -> None:
    """No class, id, role or form drops what holds the main prose.

    The main prose is the longest ``article`` or ``main`` if all of them are inside elements
    dropped by name. Else it is the element with most paragraph text of its own; one inside such
    an element only counts with ``FAR_MORE`` times as much as any outside, as comments may be long.
    """
    _mark_dropped(order)
    alive = [n for n in order if not n.hard]
    marked = [n for n in alive if n.tag in ("article", "main")]
    if marked and all(n.gone for n in marked):
        prose = max(marked, key=lambda n: n.size)
    else:
        dense = [n for n in alive if n.own_p and n.tag != "p"]
        prose = max(dense, key=lambda n: n.own_p if n.gone else FAR_MORE * n.own_p, default=None)
    while prose is not None:
        if prose.named:
            prose.drop = prose.named = False
        prose = prose.parent
    _mark_dropped(order)


def _zones(order: list[Node]) -> tuple[list[Node], list[Node]]:
    """(elements that hold the article's text, elements whose prose no template may delete)."""
    for tag in ("article", "main"):
        outer, inside = [], set()
        for n in reversed(order):
            if n.parent is not None and id(n.parent) in inside:
                inside.add(id(n))
            elif n.tag == tag and not n.gone:
                inside.add(id(n))
                outer.append(n)
        if outer:
            return outer, outer
    dense = max((n for n in order if n.own_p and n.tag != "p" and not n.gone), key=lambda n: n.own_p, default=None)
    return order[-1:], [dense] if dense is not None else []


def _above(n: Node):
    n = n.parent
    while n is not None:
        yield n
        n = n.parent


# What decides over a block that no template deletes.
KEPT, BY_TAG, OUTSIDE = 0, 1, 2


def _sound(text: str) -> str:
    """References to surrogates or beyond Unicode are replaced; all else stays."""
    return text.encode("utf-8", "replace").decode("utf-8")


Blocks = list[tuple[str, int, int]]
Chains = list[tuple[int, int]]


def page_blocks(html: str | None) -> tuple[Blocks, Chains, list[int]]:
    """(all blocks of text a page shows, chains, hashes of all countable subtrees).

    A block is (text, chain, rule): ``BY_TAG`` if its tag, role or class is that of a page part,
    ``OUTSIDE`` if it lies outside the article. Its chain (-1: none) leads through the subtrees that
    may delete it, from the innermost out: (position of the subtree's hash, next chain).
    """
    if not html:
        return [], [], []
    root = parse(html)
    order = _post_order(root)
    _hash_subtrees(order)
    _spare_main_prose(order)
    zones, guarded = _zones(order)
    guard_ids = {id(z) for z in guarded}
    holds = set(guard_ids)
    for z in guarded:
        for p in _above(z):
            if id(p) in holds:
                break
            holds.add(id(p))
    blocks: Blocks = []
    marks: dict[int, int] = {}
    text: dict[int, list[str]] = {}
    chains: Chains = []
    chain = -1

    def flush():
        for rule in sorted(text):
            if line := _sound(" ".join("".join(text[rule]).split())):
                blocks.append((line, chain, rule))
        text.clear()

    # Frames: (node, inside the article, emits text, inside the article's own header, next kid, prose is guarded)
    zone_ids = {id(z) for z in zones}
    stack = [[root, id(root) in zone_ids, True, False, 0, id(root) in guard_ids]]
    counted: list[bool] = [False]
    while stack:
        frame = stack[-1]
        n, inside, emits, header, at, guard = frame
        if at == len(n.kids):
            stack.pop()
            if n.tag in BLOCK:
                flush()
            if counted.pop():
                chain = chains[chain][1]
            continue
        frame[4] += 1
        k = n.kids[at]
        if type(k) is str:
            shown = emits and (not header or any(f[0].tag in HEADINGS for f in stack))
            text.setdefault(BY_TAG if not shown else KEPT if inside else OUTSIDE, []).append(k)
            continue
        if k.tag == "br":
            for line in text.values():
                line.append(" ")
            continue
        if k.tag in BLOCK:
            flush()
        if k.tag in UNSEEN:
            continue
        in_zone = inside or id(k) in zone_ids
        countable = k.tag not in ("html", "head", "body") and id(k) not in holds and (k.tag in BLOCK or k.drop or k.words)
        if countable and guard and not k.drop:
            countable = k.tag not in PROSE and not any(
                type(x) is Node and (x.tag in PROSE or x.tag == "div") for x in k.kids)
        if countable and k.kids:
            chains.append((marks.setdefault(k.digest, len(marks)), chain))
            chain = len(chains) - 1
        counted.append(bool(countable and k.kids))
        own_header = k.tag == "header" and (guard or id(n) in guard_ids)
        gone = k.drop or (k.tag == "header" and not own_header)
        stack.append([k, in_zone, emits and not gone, header or own_header, 0, guard or id(k) in guard_ids])
    flush()
    return blocks, chains, list(marks)


def pieces(html: str | None) -> tuple[list[tuple[str, int]], list[int]]:
    """(blocks that the tag rules leave, with their chains, hashes of all countable subtrees)."""
    blocks, _, marks = page_blocks(html)
    return [(t, c) for t, c, rule in blocks if rule == KEPT], marks


def article(blocks: Blocks, chains: Chains, found: set[int]) -> tuple[str, int, int]:
    """(text, characters deleted by templates, characters deleted by tag rules) of a page's blocks.

    The templates go first. Of what they leave, the tag rules drop the page parts, and the text
    outside the article if any of the article's is left.
    """
    deleted: list[bool] = []
    for mark, up in chains:  # a chain comes after the one it leads to
        deleted.append(mark in found or up >= 0 and deleted[up])
    left = [(t, rule) for t, c, rule in blocks if c < 0 or not deleted[c]]
    size = [sum(len(t) for t, rule in left if rule == r) for r in (KEPT, BY_TAG, OUTSIDE)]
    rules = (KEPT,) if size[KEPT] else (KEPT, OUTSIDE)
    by_rule = sum(size) - sum(size[r] for r in rules)
    by_template = sum(len(b[0]) for b in blocks) - sum(size)
    return "\n".join(t for t, rule in left if rule in rules), by_template, by_rule


def _key(host: str, blocks: Blocks, chains: Chains, marks: list[int]) -> bytes:
    """A digest of the host and all that decides the page's text."""
    packed = json.dumps([blocks, chains, marks], ensure_ascii=False, separators=(",", ":")).encode("utf-8")
    return xxhash.xxh3_128_digest(host.encode("utf-8", "replace") + b"\x00" + packed)


def _source(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")


def distinct_pages(pages: DataFrame) -> DataFrame:
    """(page, marks): each distinct page of a host with its subtree hashes, which carry the host. Written once."""

    def run(batch: pa.RecordBatch):
        keys, found = [], []
        for host, html in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
            blocks, chains, marks = page_blocks(html.as_py())
            keys.append(_key(host, blocks, chains, marks))
            seed = xxhash.xxh3_64_intdigest(host.encode("utf-8", "replace"))
            found.append([xxhash.xxh3_64_intdigest(m.to_bytes(8, "little", signed=True), seed) - (1 << 63) for m in marks])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["page", "marks"])

    parsed = map_batches(_source(pages), run, "page binary, marks array<bigint>")
    return written(parsed.groupBy("page").agg(F.first("marks").alias("marks")), "html-marks")


def packed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, page, packed): one row per page with its blocks, compressed for the shuffle."""

    def run(batch: pa.RecordBatch):
        squeeze = zstandard.ZstdCompressor(level=6, write_checksum=False)
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            keys, packs = [], []
            for host, html in zip(part.column(2).to_pylist(), part.column(3), strict=True):
                blocks, chains, marks = page_blocks(html.as_py())
                keys.append(_key(host, blocks, chains, marks))
                packs.append(squeeze.compress(json.dumps(
                    [blocks, chains], ensure_ascii=False, separators=(",", ":")).encode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(packs, pa.binary())],
                names=["page_id", "url", "page", "packed"])

    return map_batches(_source(pages), run, "page_id long, url string, page binary, packed binary")


def templates(distinct: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(mark, n_pages): the subtrees that recur on ``min_pages`` distinct pages of a host."""
    return distinct.select(F.explode("marks").alias("mark")).groupBy("mark").agg(
        F.count(F.lit(1)).alias("n_pages")).filter(F.col("n_pages") >= min_pages)


EXTRACTED = ("page_id long, url string, text string, n_chars long, n_template_subtrees int, n_template_chars long, "
             "n_rule_chars long")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_template_subtrees (recurring subtrees of the page) and the
    characters deleted by them (n_template_chars) and, of what they leave, by tag rules (n_rule_chars).
    """
    distinct = distinct_pages(pages)
    marked = distinct.select("page", F.posexplode("marks").alias("pos", "mark"))
    found = marked.join(templates(distinct, min_pages), "mark").groupBy("page").agg(F.collect_list("pos").alias("found"))

    def run(batch: pa.RecordBatch):
        swell = zstandard.ZstdDecompressor()
        hits = batch.column(3).to_pylist()
        done = [article(*json.loads(swell.decompress(p.as_py())), set(f or ())) for p, f in zip(batch.column(2), hits, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.string()),
             pa.array([len(d[0]) for d in done], pa.int64()), pa.array([len(f or ()) for f in hits], pa.int32()),
             pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
            names=[c.split()[0] for c in EXTRACTED.split(", ")])

    joined = packed_pages(pages).join(found, "page", "left").select("page_id", "url", "packed", "found")
    return map_batches(joined, run, EXTRACTED)
