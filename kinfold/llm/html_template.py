"""Main text of web pages by removing site templates.

Every block element of a page, inside its article (article, main, or what its class names
content) and outside, is hashed with all it holds; Spark counts, for each host, the pages that
hold a hash, pages of equal main text (by the markup alone) as one; subtrees on many pages of
their host are deleted. What the markup itself names as
menu, footer, advert, form, comment and so on goes as well. Within an article a bare passage
(a paragraph, heading, item and the like without attributes) stays however often it recurs,
unless a recurring box holds it: what many articles quote is text, not template.

Defined results: a null html or an empty page gives ''; a null or odd url counts as the host
''; rows are treated one by one, so repeated rows give repeated rows; other columns pass by.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import table, written

#: A box is template if at least so many different pages of its host hold it; on a host of less
#: than twice as many pages, if half of them do, and FEW_PAGES at least.
MIN_PAGES = 10
FEW_PAGES = 5
#: A bare passage outside articles may be a quotation: it must be on such a share as well.
MIN_SHARE = 0.2
#: So many recurring hashes go to every task (8 bytes each); more are joined by page.
HASHES_BROADCAST = 2_000_000

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)(?:>|\Z)|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
NAMED = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
HIDDEN = re.compile(r"""(?i)(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""")
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center details dd dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot option optgroup legend caption".split())
#: A start tag ends an open one of these, up to one of those.
SIBLINGS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Without attributes, these are passages of text rather than boxes.
PASSAGES = frozenset("p blockquote h1 h2 h3 h4 h5 h6 hgroup pre li dt dd tr td th thead tbody tfoot figcaption summary hr".split())
DROPPED = frozenset("head title script style noscript template iframe object embed svg canvas audio video nav aside footer form fieldset select option button input textarea dialog menu search".split())
NOISE = frozenset(
    "nav navbar navigation menu submenu masthead footer sidebar aside ad ads adv advert adverts advertisement adsbygoogle adslot banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription share sharing social breadcrumb breadcrumbs comment comments disqus respond replies reply related recommended widget toolbar pagination pager login signup search copyright complementary contentinfo".split()
)
CONTENT = (("article",), ("main",), ("articlebody", "post-content", "entry-content", "article-body", "article-content", "main-content", "story-body", "post-body", "content", "article", "main", "post", "story"))


class Node:
    __slots__ = ("tag", "attrs", "kids", "up", "code")

    def __init__(self, tag: str, attrs: str, up: Node | None):
        self.tag, self.attrs, self.up, self.kids, self.code = tag, attrs, up, [], 0


def tree(source: str) -> Node:
    """The elements of a page; kids are nodes and text (decoded). Never fails."""
    root = Node("html", "", None)
    at, here, end = 0, root, len(source)
    while at < end:
        m = TAG.search(source, at)
        if not m:
            here.kids.append(entities.unescape(source[at:]))
            break
        if m.start() > at:
            here.kids.append(entities.unescape(source[at : m.start()]))
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            x = here
            while x is not None and x.tag != tag:
                # a stray end tag of an inline element doesn't close the block around it
                x = None if tag not in BLOCKS and x.tag in BLOCKS else x.up
            if x is not None and x.up is not None:
                here = x.up
            continue
        tag, attrs = (m[2], m[3]) if m[2] else (m[4], m[5])
        if not tag:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            x = here
            while x is not None and x.tag != "p":
                x = None if x.tag in BLOCKS else x.up
            if x is not None:
                here = x.up
        if tag in SIBLINGS:
            ends, stops = SIBLINGS[tag]
            x = here
            while x is not None and x.tag not in ends:
                x = None if x.tag in stops else x.up
            if x is not None and x.up is not None:
                here = x.up
        node = Node(tag, attrs, here)
        here.kids.append(node)
        if tag in RAW:
            m = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = m.end() if m else end
        elif tag not in VOID and not attrs.endswith("/"):
            here = node
        elif tag not in VOID and tag in BLOCKS:
            here = node  # <div/> opens, as browsers have it
    return root


def names(attrs: str) -> set[str]:
    out: set[str] = set()
    if "=" in attrs:
        for m in NAMED.finditer(attrs):
            for word in (m[1] or m[2] or m[3] or "").split():
                out.add(word.lower())
                out.update(x.lower() for x in PIECES.findall(word))
    return out


def walk(root: Node):
    """All nodes, parents first, with no recursion: pages may nest deeply."""
    todo = [root]
    while todo:
        x = todo.pop()
        yield x
        todo.extend(k for k in reversed(x.kids) if type(k) is Node)


def noisy(x: Node) -> bool:
    return x.tag in DROPPED or bool(x.attrs) and (not NOISE.isdisjoint(names(x.attrs)) or bool(HIDDEN.search(x.attrs)))


def articles(nodes: list[Node]) -> list[Node]:
    """The outermost elements that hold the page's main text, or none."""
    under: set[Node] = set()
    for x in nodes:
        if x.up in under or noisy(x):
            under.add(x)
    for free in (True, False):
        for kind, wanted in enumerate(CONTENT):
            found: set[Node] = set()
            inside: set[Node] = set()
            for x in nodes:
                if x.up in inside:
                    inside.add(x)
                    continue
                if free and x in under or not free and noisy(x):
                    continue
                if x.tag in wanted if kind < 2 else x.tag in ("div", "section", "td") and x.attrs and not names(x.attrs).isdisjoint(wanted):
                    found.add(x)
                    inside.add(x)
                elif kind == 1 and "main" in x.attrs and "role" in x.attrs.lower() and "main" in names(x.attrs):
                    found.add(x)
                    inside.add(x)
            if found:
                return [x for x in nodes if x in found]
    return []


def passage(x: Node) -> bool:
    return x.tag in PASSAGES and not x.attrs.strip(" /")


def hashed(nodes: list[Node], tops: set[Node]) -> set[int]:
    """Hashes of the block subtrees but articles, what holds them, and passages in them; each
    node keeps its own (0: none)."""
    out: set[int] = set()
    holds = set()
    for x in tops:
        while x is not None and x not in holds:
            holds.add(x)
            x = x.up
    codes: dict[Node, int] = {}
    inside = set(tops)
    for x in nodes:
        if x.up in inside:
            inside.add(x)
    for x in reversed(nodes):
        code = zlib.crc32(f"<{x.tag} {x.attrs}>".encode("utf-8", "surrogatepass"))
        wide = code
        for k in x.kids:
            if type(k) is Node:
                part = codes.get(k, 0)
            else:
                b = " ".join(k.split()).encode("utf-8", "surrogatepass")
                part = zlib.crc32(b) << 32 | zlib.adler32(b)
            wide = (wide * 0x9E3779B97F4A7C15 + part * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & 0xFFFFFFFFFFFFFFFF
            wide ^= wide >> 29
        codes[x] = wide
        if x.tag in BLOCKS and x not in holds and x.up is not None and not (x in inside and passage(x)) and any(type(k) is Node or k.strip() for k in x.kids):
            x.code = (wide - (1 << 63) & ~1 | passage(x)) or 2  # an odd code is a passage's
            out.add(x.code)
    return out


def main_text(source: str | None, recurring: frozenset[int] | set[int] = frozenset()) -> str:
    """The main text of a page, given the hashes of its host's template subtrees."""
    if not source:
        return ""
    root = tree(source)
    nodes = list(walk(root))
    tops = articles(nodes)
    if recurring:
        hashed(nodes, set(tops))
    own = set(tops)
    out: list[str] = []
    todo: list = list(reversed(tops or [root]))
    while todo:
        x = todo.pop()
        if type(x) is str:
            out.append(x)
            continue
        if x not in own and x is not root and (noisy(x) or not tops and (x.tag == "header" or "header" in names(x.attrs)) or x.code and x.code in recurring):
            out.append(" ")
            continue
        if x.tag == "br" or x.tag in BLOCKS:
            out.append(" ")
            if x.kids:
                todo.append(" ")
        todo.extend(reversed(x.kids))
    return " ".join("".join(out).split())


def page_hashes(source: str | None) -> tuple[int, set[int]]:
    """A hash of the page's main text by the markup alone, and those of its subtrees."""
    text = main_text(source)
    page = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
    if not source:
        return page, set()
    nodes = list(walk(tree(source)))
    return page, hashed(nodes, set(articles(nodes)))


def host_of(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def subtrees(pages: DataFrame) -> DataFrame:
    """host, page, row_key (of the html), code for every row of pages; code 0 stands for the page."""

    def emit(batches):
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [])
            for host, key, source in zip(*(b.column(c).to_pylist() for c in ("host", "row_key", "html")), strict=True):
                page, found = page_hashes(source)
                for col, values in zip(cols, ([host] * (len(found) + 1), [page] * (len(found) + 1), [key] * (len(found) + 1), [0, *found]), strict=True):
                    col += values
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])], ["host", "page", "row_key", "code"])

    return pages.select(host_of().alias("host"), F.xxhash64("html").alias("row_key"), "html").mapInArrow(emit, "host string, page long, row_key long, code long")


def template_hashes(found: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, code: the subtrees recurring on the host. Counting combines map-side, by (host,
    hash), so a hot host spreads over all tasks."""
    counts = written(found.select("host", "page", "code").distinct().groupBy("host", "code").agg(F.count("*").alias("n")), "subtree-counts")
    hosts = counts.where("code = 0").select("host", F.col("n").alias("pages"))
    frequent = counts.where((F.col("code") != 0) & (F.col("n") >= min(min_pages, FEW_PAGES)))
    least = F.greatest(F.lit(min(min_pages, FEW_PAGES)), F.least(F.lit(min_pages), F.ceil(F.col("pages") / 2)))
    bare = F.pmod("code", F.lit(2)) == 1
    return frequent.join(hosts, "host").where((F.col("n") >= least) & (~bare | (F.col("n") >= min_share * F.col("pages")))).select("host", "code")


class Recurring:
    """The recurring codes of one host, among the sorted keys of all."""

    def __init__(self, keys: np.ndarray, host: int):
        self.keys, self.host = keys, host

    def __contains__(self, code: int) -> bool:
        key = self.host ^ code
        at = int(np.searchsorted(self.keys, key))
        return at < len(self.keys) and int(self.keys[at]) == key


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, broadcast: int = HASHES_BROADCAST) -> DataFrame:
    """page_id, url, text for every row of pages."""
    found = subtrees(pages)
    frequent = written(template_hashes(found, min_pages, min_share), "templates")
    rows = pages.select("page_id", "url", "html", host_of().alias("host"))
    if frequent.count() <= broadcast:
        # host_key and code in one number, sorted
        keys = np.sort(frequent.select((F.xxhash64("host").bitwiseXOR(F.col("code"))).alias("k")).toArrow().column("k").to_numpy())
        rows = rows.select("page_id", "url", "html", F.xxhash64("host").alias("host_key"), F.lit(None).cast("array<long>").alias("codes"))
    else:
        keys = np.zeros(0, np.int64)
        lists = found.join(frequent, ["host", "code"]).groupBy("host", "row_key").agg(F.collect_set("code").alias("codes"))
        rows = rows.withColumn("row_key", F.xxhash64("html")).join(lists, ["host", "row_key"], "left").select("page_id", "url", "html", F.xxhash64("host").alias("host_key"), "codes")

    def texts(batches):
        for b in batches:
            out = []
            for source, host, codes in zip(*(b.column(c).to_pylist() for c in ("html", "host_key", "codes")), strict=True):
                out.append(main_text(source, Recurring(keys, host) if len(keys) else frozenset(codes or ())))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    return rows.mapInArrow(texts, "page_id long, url string, text string")


def op3_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
