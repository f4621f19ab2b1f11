"""Main text of web pages, by the mark-up's own meaning and a site style tree.

* A page is read once into blocks of text, each with its chain of style nodes: the block-level
  elements around it, by tag, class and id. Branches that say of themselves that they are menus,
  page headers, footers, sidebars, notices, adverts, forms, scripts or comments are left out.
* The style tree of a site merges the rest of its pages: a style node is a chain of elements on a
  host. A presentation node's importance is the entropy of what it is made of (the sequence of its
  children) over the pages that have it; a content node's is one less the mean entropy with which
  its texts recur on those pages. A node with children combines its own with that of the content
  below. Text and layout that recur on nearly all pages of a site come out near 0.
* Branches of low importance are removed from each page. Where a page marks a main part, that is
  evidence: blocks in it stay unless the tree finds a node of the main part low; blocks outside
  stay if the tree knows their node from enough pages and finds it important.

Statistics are sums over (node, feature) rows, so a site with a third of all pages is spread over
all tasks. The pages are parsed twice, for the statistics and for the texts; pages aren't moved.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import Work

#: Nodes below this importance are removed, if so many different pages of the site have them.
LOW_IMPORTANCE = 0.1
MIN_PAGES = 8
#: Nodes that are sent to all tasks at once (8 bytes each); more of them are joined.
MAX_SENT = 250_000
#: What one more kind of layout of a node takes from the weight of the content below it.
DAMPING = 0.9

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
DIGITS = re.compile(r"\d+")

# Names of HTML elements, and of classes and ids by what they mark.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr label ruby rt rp nobr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg object canvas xmp noframes".split())
DROPPED = frozenset(
    "head title nav footer aside form button select textarea fieldset dialog menu audio video".split()
) | RAW
MAIN = frozenset("article main".split())
CLOSES = {
    "p": frozenset({"p"}), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"}),
}
P_CLOSERS = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
SCOPES = frozenset("article main body html section div table ul ol dl blockquote td th li aside nav footer header form".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsors sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies consent notice notices "
    "alert gdpr popup modal newsletter subscribe share sharing social comment comments commentlist respond replies "
    "disqus related widget login signup search".split()
)
# Words that say where a part stands or how it is built, and nothing about what it is.
PLACES = frozenset(
    "site page top bottom left right main primary secondary global block box area bar list item items wrapper wrap "
    "container inner outer section row col unit slot content links link form posts post".split()
)
PARTS = re.compile(r"[-_]+")

Block = tuple[tuple[int, ...], str, bool]  # the nodes that decide, text, must be known
Feature = tuple[int, int, int]  # node, kind, value
PRESENCE, LAYOUT, CONTENT, OUTSIDE = 0, 1, 2, 3


def _hash(*parts: str) -> int:
    value = xxhash.xxh3_64_intdigest("\0".join(parts))
    return value - (1 << 64) if value >> 63 else value


def marked(attributes: dict[str, str]) -> bool:
    """Whether class, id or role say that this is no content."""
    role = attributes.get("role", "").lower()
    if role in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return named_a_mark(attributes)


def named_a_mark(attributes: dict[str, str]) -> bool:
    """Whether a class or the id as a whole names such a part.

    All its words must be marks or places: ``sidebar-left`` is one, ``has-sidebar``,
    ``page-with-header`` and ``search-algorithm`` speak of something else.
    """
    for name in ("class", "id"):
        for value in attributes.get(name, "").lower().split():
            words = [w for w in PARTS.split(value) if w and not w.isdigit()]
            if any(w in MARKS for w in words) and all(w in MARKS or w in PLACES for w in words):
                return True
    return False


def read_attributes(rest: str) -> dict[str, str]:
    if not rest or rest.isspace():
        return {}
    attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
    if "hidden" in ATTRIBUTE.sub(" ", rest).lower().replace("/", " ").split():
        attributes["hidden"] = ""
    return attributes


class Reader:
    """One page, read tag by tag."""

    def __init__(self, site: str):
        self.site = site
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, node, dropped, in the main part
        self.layout: dict[int, list[str]] = {}
        self.blocks: list[tuple[tuple[int, ...], str, int]] = []  # nodes, text, how many of them outside the main part
        self.text: list[str] = []
        self.known: dict[tuple[int, str], int] = {}

    def flush(self) -> None:
        if self.text:
            words = unescape("".join(self.text)).split()
            self.text = []
            if words and not (self.open and self.open[-1][2]):
                chain = tuple(node for _, node, _, _ in self.open)
                self.blocks.append((chain, " ".join(words), sum(not inside for _, _, _, inside in self.open)))

    def start(self, tag: str, rest: str) -> None:
        attributes = read_attributes(rest)
        if tag in MAIN:  # an unclosed menu or advert ends where the article begins
            while self.open and self.open[-1][2]:
                self.open.pop()
        closes = CLOSES.get(tag, frozenset()) | (frozenset({"p"}) if tag in P_CLOSERS else frozenset())
        while self.open and self.open[-1][0] in closes:
            self.open.pop()
        inside = bool(self.open and self.open[-1][3])
        dropped = bool(self.open and self.open[-1][2])
        dropped = dropped or tag in DROPPED or (tag == "header" and not inside)
        dropped = dropped or (bool(attributes) and tag not in ("html", "body", *MAIN) and marked(attributes))
        dropped = dropped or (tag in MAIN and inside and named_a_mark(attributes))
        parent = self.open[-1][1] if self.open else 0
        style = " ".join([tag, *sorted(attributes.get("class", "").split()), attributes.get("id", "")])
        key = (parent, style)
        if key not in self.known:
            self.known[key] = _hash(self.site, str(parent), DIGITS.sub("0", style))
        node = self.known[key]
        if not dropped and parent:
            self.layout.setdefault(parent, []).append(tag)
        main = inside or tag in MAIN or attributes.get("role", "").lower() == "main"
        self.open.append((tag, node, dropped, main))

    def end(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return
            if tag not in SCOPES and self.open[at][0] in SCOPES:
                return

    def read(self, html: str) -> None:
        at, skip = 0, ""
        within, depth = "", 0  # an inline element that is no content, and how deep it is nested in itself
        for m in TOKEN.finditer(html):
            name = m[2]
            if skip:  # raw text runs to its own end tag, whatever stands in it
                if name is None or not m[1] or name.lower() != skip:
                    continue
                skip, at = "", m.end()
                continue
            if m.start() > at and not within:
                self.text.append(html[at : m.start()])
            at = m.end()
            if name is None:
                continue
            tag = name.lower()
            if tag in INLINE:
                if within:
                    depth += (tag == within) * (-1 if m[1] else 1)
                    within = within if depth else ""
                elif not m[1] and m[3] and marked(read_attributes(m[3])):
                    within, depth = tag, 1
                continue
            if tag not in VOID:  # an inline element that was left open ends with its block
                within, depth = "", 0
            if tag in RAW and not m[1]:
                if not m[3].rstrip().endswith("/"):
                    skip = tag
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    self.text.append(" ")
                continue
            self.flush()
            if m[1]:
                self.end(tag)
            else:
                self.start(tag, m[3])
        if not skip and not within and at < len(html):
            self.text.append(html[at:])
        self.flush()


def read_page(site: str, html: str) -> tuple[list[Block], list[Feature]]:
    """Blocks of the whole page, and the features of their style nodes.

    A block of the main part is decided by that part's nodes, one outside a main part by the node
    it stands in, and one of a page that marks none by all its nodes. A page without a host has no
    site and no features.
    """
    reader = Reader(site)
    reader.read(_whole(html))
    marks = any(outer < len(chain) for chain, _, outer in reader.blocks)
    blocks, features = [], {}
    for chain, text, outer in reader.blocks:
        beside = marks and outer == len(chain)
        blocks.append((chain[-1:] if beside else chain[outer:] if marks else chain, text, beside))
        for node in chain:
            features[node, PRESENCE, 0] = None
        if chain:
            features[chain[-1], CONTENT, _hash(text)] = None
            if beside:
                features[chain[-1], OUTSIDE, 0] = None
    if not site:
        return blocks, []
    for node in {n for chain, _, _ in reader.blocks for n in chain}:
        if node in reader.layout:
            features[node, LAYOUT, _hash(*reader.layout[node])] = None
    return blocks, list(features)


_RAW_END = re.compile(r"<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.DOTALL | re.IGNORECASE)


def _whole(html: str) -> str:
    """Without scripts and styles, whose quotes and angle brackets mean nothing to the page."""
    return _RAW_END.sub("", html) if "<s" in html or "<S" in html else html


def site_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


FEATURES = "page_hash long, features array<struct<node:bigint,kind:int,value:bigint>>"
_FEATURES = pa.list_(pa.struct([("node", pa.int64()), ("kind", pa.int32()), ("value", pa.int64())]))
TEXTS = "page_id long, url string, text string"
BLOCKS = "page_id long, url string, blocks array<struct<nodes:array<bigint>,text:string,beside:boolean>>"
_BLOCKS = pa.list_(pa.struct([("nodes", pa.list_(pa.int64())), ("text", pa.string()), ("beside", pa.bool_())]))


def _three_columns(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )


def _read(batch: pa.RecordBatch) -> Iterator[tuple[str, list[Block], list[Feature]]]:
    for url, cell in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
        site = site_of(url)
        yield (site, *read_page(site, cell.as_py() or ""))


def page_features(pages: DataFrame) -> DataFrame:
    """Features of each page's style nodes, and a hash that is equal for pages of a site with equal texts."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, hashes = [], []
            for site, blocks, found in _read(batch):
                features.append([{"node": n, "kind": k, "value": v} for n, k, v in found])
                hashes.append(_hash(site, *(text for _, text, _ in blocks)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(features, _FEATURES)], names=["page_hash", "features"]
            )

    return pages.mapInArrow(read, FEATURES)


def texts_without(pages: DataFrame, low: frozenset[int], high: frozenset[int]) -> DataFrame:
    """Page texts without the blocks of low nodes, and those that need a high one and have none."""
    sent = pages.sparkSession.sparkContext.broadcast((low, high))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, good = sent.value
            texts = [
                " ".join(t for nodes, t, beside in blocks if gone.isdisjoint(nodes) and not (beside and good.isdisjoint(nodes)))
                for _, blocks, _ in _read(batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return pages.mapInArrow(read, TEXTS)


def texts_by_join(pages: DataFrame, decided: DataFrame, work: Work) -> DataFrame:
    """The same where the nodes are too many to send: pages meet their nodes by joins."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [[{"nodes": nodes, "text": text, "beside": beside} for nodes, text, beside in own] for _, own, _ in _read(batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(blocks, _BLOCKS)], names=["page_id", "url", "blocks"]
            )

    rows = work.keep(pages.mapInArrow(read, BLOCKS).withColumn("row", F.monotonically_increasing_id()), "blocks")
    nodes = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["nodes"])))
    has = rows.select("row", F.explode(nodes).alias("node"))
    of = lambda low: F.collect_set(F.when(F.col("low") == low, F.col("node")))
    gone = has.join(decided, "node").groupBy("row").agg(of(True).alias("gone"), of(False).alias("good"))
    among = lambda b, name: F.coalesce(F.arrays_overlap(b["nodes"], F.col(name)), F.lit(False))
    left = F.filter("blocks", lambda b: ~among(b, "gone") & (~b["beside"] | among(b, "good")))
    text = F.concat_ws(" ", F.transform(left, lambda b: b["text"]))
    return rows.join(gone, "row", "left").select("page_id", "url", text.alias("text"))


def importance(pages: DataFrame) -> DataFrame:
    """``node``, ``pages``, ``outside`` and ``importance`` of every style node; equal pages of a site count once."""
    distinct = pages.select("page_hash", "features").dropDuplicates(["page_hash"])
    rows = distinct.select(F.explode("features").alias("f")).select("f.node", "f.kind", "f.value")
    counts = rows.groupBy("node", "kind", "value").agg(F.count("*").alias("n"))

    def of(kind: int, value) -> F.Column:
        return F.sum(F.when(F.col("kind") == kind, value))

    weighted = F.col("n") * F.log("n")
    stats = counts.groupBy("node").agg(
        of(PRESENCE, F.col("n")).alias("pages"),
        of(LAYOUT, F.col("n")).alias("laid_out"), of(LAYOUT, weighted).alias("layout_log"), of(LAYOUT, F.lit(1)).alias("layouts"),
        of(CONTENT, F.col("n")).alias("texts"), of(CONTENT, weighted).alias("text_log"),
        of(OUTSIDE, F.col("n")).alias("outside"),
    )
    log_pages = F.log("pages")
    content = F.when(F.col("texts") > 0, 1 - F.col("text_log") / (F.col("texts") * log_pages))
    layout = F.when(F.col("laid_out") > 0, 1 - F.col("layout_log") / (F.col("laid_out") * log_pages))
    damped = F.pow(F.lit(DAMPING), "layouts")
    both = F.when(layout.isNull(), content).when(content.isNull(), F.greatest(layout, F.lit(LOW_IMPORTANCE))).otherwise(
        (1 - damped) * layout + damped * content
    )
    return stats.select("node", "pages", "outside", F.when(F.col("pages") > 1, both).otherwise(1.0).alias("importance"))


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Main text of every page and its length in code points.

    Null and empty pages, and pages without content, have an empty text. Pages without a host
    belong to no site; nothing of them is compared. Repeated ids keep all their rows; no rows
    give no rows; other columns are left out. A node that holds other nodes and no text of its
    own is only removed through them.
    """
    work = Work(pages.sparkSession, "pages")
    rows = _three_columns(pages, id_col, url_col, html_col)
    low = F.col("importance") < LOW_IMPORTANCE
    known = (F.col("pages") >= MIN_PAGES) & (low | F.col("outside").isNotNull())
    decided = importance(page_features(rows)).where(known).select("node", low.alias("low"))
    decided, number = work.keep_summed(decided, "decided", F.lit(1))
    if number <= MAX_SENT:
        found = decided.collect()
        texts = texts_without(rows, *(frozenset(r["node"] for r in found if r["low"] == x) for x in (True, False)))
    else:
        texts = texts_by_join(rows, decided, work)
    return texts.withColumn("n_chars", F.length("text").cast("long"))
