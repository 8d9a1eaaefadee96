"""HTML extraction with a site style tree per host.

The pages of a host are merged into one tree: the elements at the same path
of (tag, class, id, role) are one element node.  Spark sums, per element node,

* how many distinct pages hold it,
* its presentation styles: the sequences of child elements it shows, with the
  number of pages of each, whose entropy is the node's presentation
  importance;
* its content features: the hashed text of its own text runs, with the pages
  that hold each, whose mean entropy gives the content importance: text that
  repeats on every page of a host has entropy 1 and importance 0.

A node's own importance joins both; its composite importance is the largest
own importance in its whole subtree, so a wrapper is never less important than
what any page shows in it, however deep (children are not discounted by how
rarely they are shown: an article on one page in a hundred would go with its
wrapper).  Pages with the same content count once, so copies of a page do
not make its article look like a template; hosts with fewer than ``MIN_PAGES``
distinct pages have no evidence and every importance is 1.

Extraction drops a branch if its composite importance is below ``THRESHOLD``.
Names come first, though: elements whose tag, role or class says what they are
(navigation, footer, advert, form, comments...) are dropped, and the plain text
blocks of ``article``/``main`` are kept, whatever the tree says; the tree
decides for what is left, and for all blocks of a page without an article.  A
menu or an advert that differs on every page is as varied as an article, so the
tree alone (``names=False``) keeps it; the README has figures.

Nothing is gathered per host: all sums are grouped by (host, node, feature)
with partial aggregation, and each page asks only for the nodes above its own
blocks, so a host with a third of all pages, or with very many nodes, is spread out.

Edge cases: NULL html or url is empty; a url without a host is the host '';
pages without an article fall back to the body; unclosed and crossed tags are
repaired; repeated rows and NULL ids each give their row; an empty table gives an empty
result; pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vaultline.llm.common import table, written

MIN_PAGES = 5
THRESHOLD = 0.2
CONTENT_SHARE = 0.7  # weight of a node's own content against its children

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small "
    "span strike strong sub sup time tt u var wbr".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption "
                   "figure figcaption hr address details summary".split())
CLOSES_P = BLOCKS | frozenset("div section article main aside nav header footer form fieldset".split())
DROP_TAGS = frozenset("head nav footer aside form button select option dialog menu input label".split()) | RAW
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog menu menubar alert".split())
DROP_NAME = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|"
    r"sidebar|side|aside|widget|footer|foot|header|masthead|topbar|cookies?|consent|gdpr|notices?|alert|popup|"
    r"modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|comments?|"
    r"commentlist|respond|replies|reply|disqus|pagination|pager|toolbar|skip|hidden)(?:$|[-_ \d])", re.I)
SPACE = " \t\n\r\x0b\x0c"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACES = re.compile(f"[{SPACE}]+")


class Node:
    __slots__ = ("tag", "sign", "parent", "children", "prior")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.sign, self.prior = _style_of(tag, attrs)


@lru_cache(maxsize=1 << 14)
def _style_of(tag: str, source: str) -> tuple[str, int | None]:
    """(style of an element, prior importance 0, 1 or None)."""
    attrs = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(source)}
    named = [attrs.get("class", ""), attrs.get("id", ""), attrs.get("role", "")]
    # Digits in names count things ("comment-17"); they are not the style.
    sign = "|".join([tag, *[re.sub(r"\d+", "#", _SPACES.sub(" ", x).strip()) for x in named]])
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
    low = tag in DROP_TAGS or named[2].lower() in DROP_ROLES or hidden or (
        tag not in ("html", "body", "article", "main") and any(DROP_NAME.search(x) for x in named[:2] if x))
    return sign, 0 if low else 1 if tag in ("article", "main") else None


def parse(source: str) -> Node:
    """A DOM of the page; wrong nesting is repaired as browsers roughly do."""
    root = Node("#root", "", None)
    at, here = 0, root
    n = len(source)
    while at < n:
        m = _TAG.search(source, at)
        if m is None:
            here.children.append(source[at:])
            break
        if m.start() > at:
            here.children.append(source[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group(0).startswith("<![CDATA["):
                here.children.append(html.escape(m.group(0)[9:].removesuffix("]]>")))
            continue
        tag = name.lower()
        if m.group(1):  # a closing tag ends the nearest element of its name
            node = here
            while node is not None and node.tag != tag:
                # A stray inline end tag must not close the blocks around it.
                if tag in INLINE and node.tag not in INLINE:
                    node = None
                    break
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag in CLOSES_P:  # a block ends an open paragraph (with its inline elements)
            node = here
            while node.tag in INLINE:
                node = node.parent
            if node.tag == "p" or node.tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                here = node.parent
            elif tag in BLOCKS and here.tag in INLINE and here is not node:
                here = node  # an unclosed inline element ends with its block
        node = Node(tag, m.group(3), here)
        here.children.append(node)
        if tag in VOID or m.group(0).endswith("/>") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            node.children.append(source[at : end.start() if end else n])
            at = end.end() if end else n
            continue
        here = node
    return root


def _clean(text: str) -> str:
    return _SPACES.sub(" ", html.unescape(text)).strip(SPACE)


@lru_cache(maxsize=1 << 16)
def _path(parent: int, sign: str) -> int:
    return _hash(f"{parent}/{sign}")


def _hash(text: str) -> int:
    """63 bits that are the same in every process."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1


def _inline_text(node: Node) -> str:
    """The text of a node and of its inline elements, not of its blocks."""
    out, stack = [], node.children[::-1]
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag == "br":
            out.append(" ")
        elif c.tag in INLINE:
            stack.extend(c.children[::-1])
    return "".join(out)


def _tops(root: Node) -> list[Node]:
    """The outermost articles that no prior removes, else the whole page."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.prior == 1:
            found.append(node)
        elif node.prior != 0:
            stack.extend(c for c in node.children if not isinstance(c, str))
    return found or [root]


def read_page(source: str, names: bool = True) -> tuple[list[str], list[list[int]], list[tuple[int, int, int, int]]]:
    """(texts, chains, features) of a page in one walk over its tree.

    ``texts`` are the text blocks in page order; ``chains[i]`` the element
    nodes that block i hangs on and that a site's tree may remove.  Without
    ``names`` the tree decides for every block of the page.
    ``features`` are (node, parent, kind, feature), each once per page; kind 0
    is a presentation style, 1 a content feature.
    """
    root = parse(source)
    tops = {id(n) for n in _tops(root)} if names else {id(root)}
    whole = id(root) in tops
    texts: list[str] = []
    chains: list[list[int]] = []
    features: dict[tuple, None] = {}
    run: list[str] = []

    def flush(chain):
        if run:
            text = _clean("".join(run))
            run.clear()
            if text:
                texts.append(text)
                chains.append(list(chain))

    # (node or text, its path, the path of the nearest element around it that
    # has features, chain or None outside, closing?)
    stack: list[tuple] = [(root, 0, -1, None, False)]
    while stack:
        node, path, up, chain, closing = stack.pop()
        if closing:
            flush(chain)
            continue
        if isinstance(node, str):
            run.append(node)
            continue
        tag = node.tag
        inline = tag in INLINE
        if not inline and tag not in RAW:
            style: list[str] = []
            for c in node.children:  # runs of the same style count as one
                if not isinstance(c, str) and c.tag not in INLINE and (not style or style[-1] != c.sign):
                    style.append(c.sign)
            features[path, up, 0, _hash("\n".join(style))] = None
            own = _inline_text(node).strip(SPACE)
            if own:
                features[path, up, 1, _hash(own)] = None
        if id(node) in tops:
            chain = ()
        elif chain is not None:
            if tag == "br":
                run.append(" ")
                continue
            if node.prior == 0 and (names or tag in RAW):
                chain = None  # nothing below is text, but it is in the tree
            elif not _plain(node) or whole and not inline:
                chain = (*chain, path)
        if chain is not None and not inline:
            flush(chain)
            stack.append((node, path, up, chain, True))
        for c in reversed(node.children):
            if not isinstance(c, str):
                stack.append((c, _path(path, c.sign), up if inline else path, chain, False))
            elif chain is not None:
                stack.append((c, 0, 0, chain, False))
    return texts, chains, list(features)


def _plain(node: Node) -> bool:
    """A text block or inline element without a name of its own: as important
    as what it stands in."""
    return (node.tag in BLOCKS or node.tag in INLINE) and node.sign == node.tag + "|||"


def main_text(source: str, low: frozenset | set = frozenset()) -> str:
    """The main text of one page; ``low`` has the element nodes to remove."""
    texts, chains, _ = read_page(source)
    return "\n".join(t for t, chain in zip(texts, chains, strict=True) if not low.intersection(chain))


# --- Spark -------------------------------------------------------------------


_PAGE = ("same long, texts array<string>, chains array<array<long>>, "
         "node array<long>, parent array<long>, kind array<long>, feature array<long>")


def _reader(columns: list[str], names: bool):
    """mapInArrow function: the columns, and what ``read_page`` finds."""

    def run(batches):
        for b in batches:
            pages = b.column(b.schema.get_field_index("_html")).to_pylist()
            out = [[] for _ in range(7)]
            for source in pages:
                texts, chains, features = read_page(source or "", names)
                out[0].append(_hash(source or ""))
                out[1].append(texts)
                out[2].append(chains)
                for column, values in zip(out[3:], zip(*features, strict=True), strict=True):
                    column.append(list(values))
            kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64())), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(c)) for c in columns],
                 *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]],
                names=[*columns, "same", "texts", "chains", "node", "parent", "kind", "feature"])

    return run


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.withColumn("host", host)


def importance(read: DataFrame) -> DataFrame:
    """(host, node, parent, pages, importance) of every element node of the
    pages read (host, same, node, parent, kind, feature); the importance is
    the node's own, without its children.

    Entropies use log base (number of distinct pages with the node):
    presentation = -sum p log p over styles; content = 1 - mean over features
    of the share of the node's pages that hold it, as log-count ratio.
    """
    # Copies of a page are one page: grouped by content within the host.
    one = read.groupBy("host", "same").agg(F.first(F.arrays_zip("node", "parent", "kind", "feature")).alias("f"))
    counts = one.select("host", F.inline("f")).groupBy(
        "host", "node", "parent", "kind", "feature").agg(F.count(F.lit(1)).alias("c"))
    # Every page shows a node in at least one style; the pages of a node are
    # at most the sum of its styles' pages.
    per = counts.groupBy("host", "node", "parent").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("c")).otherwise(0)).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("c") * F.log2("c")).otherwise(0.0)).alias("style_clogc"),
        F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).alias("features"),
        F.sum(F.when(F.col("kind") == 1, F.log2("c")).otherwise(0.0)).alias("feature_logc"),
    )
    m = F.greatest(F.log2("pages"), F.lit(1e-9))
    presentation = (F.log2("pages") - F.col("style_clogc") / F.col("pages")) / m
    # A feature on c of the node's m pages has entropy log c / log m.
    content = F.when(F.col("features") > 0, F.lit(1.0) - F.least(F.lit(1.0), F.col("feature_logc") / F.col("features") / m))
    own = per.select(
        "host", "node", "parent", "pages",
        F.when(F.col("pages") < MIN_PAGES, 1.0).otherwise(presentation).alias("presentation"),
        F.when(F.col("pages") < MIN_PAGES, 1.0).otherwise(content).alias("content"),
    )
    # A node is as important as its own content or presentation.
    return own.withColumn("importance", F.when(
        F.col("content").isNull(), F.col("presentation")).otherwise(
        F.greatest(F.lit(CONTENT_SHARE) * F.col("content") + F.lit(1 - CONTENT_SHARE) * F.col("presentation"),
                   F.col("content"))))


def low_nodes(read: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, node): the nodes to remove on each host.  A node goes only if
    nothing in its subtree is important, so a wrapper of the article stays.

    What stays is passed up the low nodes by pointer doubling: ``up`` is the
    ancestor 2**k levels above if all nodes between are low, and ``stays``
    covers the subtree to that depth, so a tree of depth d takes log2(d) passes.
    """
    nodes = written(importance(read), "site-style")
    low = nodes.filter(F.col("importance") < threshold).select("host", "node", "parent")
    fed = nodes.filter(F.col("importance") >= threshold).select("host", F.col("parent").alias("node")).distinct()
    state = low.join(fed.withColumn("fed", F.lit(True)), ["host", "node"], "left").join(
        low.select("host", F.col("node").alias("parent"), F.lit(True).alias("low")), ["host", "parent"], "left")
    state = written(state.select("host", "node", F.when(F.col("low"), F.col("parent")).alias("up"),
                                 F.coalesce("fed", F.lit(False)).alias("stays")), "site-style-tree")
    while not (passing := state.filter("stays AND up IS NOT NULL")).isEmpty():
        fed = passing.select("host", F.col("up").alias("node")).distinct().withColumn("fed", F.lit(True))
        above = state.select("host", F.col("node").alias("up"), F.col("up").alias("next"))
        state = written(state.join(fed, ["host", "node"], "left").join(above, ["host", "up"], "left").select(
            "host", "node", F.col("next").alias("up"), F.coalesce("fed", "stays").alias("stays")), "site-style-tree")
    return state.filter("NOT stays").select("host", "node")


def extract(pages: DataFrame, columns: list[str] | None = None, names: bool = True) -> DataFrame:
    """``columns`` of ``pages`` plus the main ``text`` of each page.

    Every page is parsed once; its blocks wait in a written table for the
    tree of their site.
    """
    columns = columns or [c for c in pages.columns if c not in ("html", "text")]
    inner = [f"c{i}" for i in range(len(columns))]
    rows = with_host(pages.select(*[F.col(c).alias(n) for n, c in zip(inner, columns, strict=True)],
                                  F.col("html").alias("_html"), "url"))
    # The row number is fixed by the write below.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    kept = [*inner, "host", "row"]
    schema = StructType([rows.schema[c] for c in kept] + StructType.fromDDL(_PAGE).fields)
    read = written(rows.select(*kept, "_html").mapInArrow(_reader(kept, names), schema), "site-pages", compression="zstd")
    low = written(low_nodes(read), "site-style-low")
    # The nodes above a page's own blocks that go: bounded by the page.  Both
    # tables are written, so that the joins are planned by their sizes.
    above = read.select("row", "host", F.explode(F.array_distinct(F.flatten("chains"))).alias("node"))
    gone = written(above.join(low, ["host", "node"]).groupBy(F.col("row").alias("_row")).agg(
        F.collect_set("node").alias("low")), "site-style-gone")
    joined = read.select(*kept, "texts", "chains").join(gone, F.col("row") == F.col("_row"), "left")
    stays = F.filter(F.arrays_zip("texts", "chains"), lambda b: ~F.coalesce(F.arrays_overlap(b["chains"], F.col("low")), F.lit(False)))
    text = F.array_join(F.when(F.col("low").isNull(), F.col("texts")).otherwise(F.transform(stays, lambda b: b["texts"])), "\n")
    return joined.select(*[F.col(n).alias(c) for n, c in zip(inner, columns, strict=True)], text.alias("text"))


def op2_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), ["page_id", "url"])
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

