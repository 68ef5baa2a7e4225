"""Main-text extraction with a site style tree (after Yi, Liu and Li, 2003).

The DOMs of a host's pages are merged: a node is a path of (tag, class, id), like siblings are one. For each node the
tree holds, over the m pages that have it, the presentation styles (sequences of child tags) and the contents of its
own text. A node of one page has importance 1. Of others it is composite:

    (1 - gamma^l) * entropy of the l styles  +  gamma^l * mean importance of the children

where entropies are to base m, and where a text among the children is worth 1 - log(pages with it) / log(m), averaged
over the pages. A branch is noise if it and all nodes below it are less important than ``threshold``, and is removed
from each page. The composite values rise from the leaves level by level, each level one aggregation over all hosts.

What a single page declares is evidence of the same kind: tags such as nav, footer and aside, and class or id names
made of nothing but role words (sidebar, comment-list), are presentation nodes of importance 0; an article, with all it
holds, has importance 1. Where a page has main or article elements, they are the content.

A part that holds most of a page's text is never removed for its name or its importance, nor is one with an article or
main inside, so pages wrapped in a form keep their text. On a host where nothing is important, as its pages are all
alike, nothing is removed. Only (host, node, style or content) counts
are shuffled, aggregated on the map side; the nodes to remove are broadcast if their counted number is small and
joined by host otherwise.

Defined results: null html is empty and gives an empty text; unclosed and stray tags are tolerated; a host with one
page has nothing to merge and cuts by declared roles alone; a page without url belongs to the host ''; repeated pages
count as pages of their host and give equal rows; an empty table gives an empty one; other columns of pages are
ignored; white space is what str.split() splits at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import sized, written

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is no markup
RAW = frozenset("script style iframe noembed noframes textarea title xmp".split())
#: elements whose content is never text
SILENT = frozenset("head noscript template svg math object canvas audio video select datalist button".split())
#: elements that stand in a line; all others begin a block
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: elements that declare their content not to be the article
NOISE_TAGS = frozenset("nav footer aside menu dialog".split())
MAIN_TAGS = frozenset(("article", "main"))
#: words of class and id names that declare a role, and words that may stand beside them
ROLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pager pagination paywall popup promo promotion "
    "recommendations recommended related replies reply respond share sharing sidebar signup skyscraper social sponsor sponsored subscribe teaser toolbar widget widgets".split()
)
PLAIN_WORDS = frozenset("1 2 3 area bar block bottom box buttons col column container content form global group hd inner item items left links list main notice outer page posts primary right row secondary section site slot sub tags text top unit web wrap wrapper".split())
_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
_TOKEN = re.compile(r"[^<]+|</?[a-zA-Z][^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>|<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: open elements that a start tag closes
_CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_SCOPE = frozenset("ul ol table div section article main body dl nav footer header aside form blockquote".split())


class Node:
    """One element of a page: tag, key of its path, declared role (0 noise, 1 main, None), children (nodes and texts).

    firm: the role is part of the markup's meaning and stands whatever the element holds. size: characters of text below.
    """

    __slots__ = ("tag", "key", "role", "firm", "children", "size")

    def __init__(self, tag: str, key: int, role: int | None, firm: bool = False):
        self.tag, self.key, self.role, self.firm, self.children, self.size = tag, key, role, firm, [], 0


def _named(value: str) -> bool:
    """Whether a class or id name is made of role words (and plain words beside them)."""
    parts = [x.lower() for x in _PART.split(value) if x]
    return any(x in ROLE_WORDS for x in parts) and all(x in ROLE_WORDS or x in PLAIN_WORDS for x in parts)


def _declared(tag: str, attrs: dict[str, str], inside: bool) -> tuple[int | None, bool]:
    """Role and firmness of an element; inside: whether it stands in an article or main."""
    role = attrs.get("role", "").lower()
    if tag in MAIN_TAGS or role == "main":
        # a comment may be marked up as an article
        return (0, False) if tag == "article" and any(_named(x) for x in attrs.get("class", "").split()) else (1, True)
    if tag in SILENT or tag in NOISE_TAGS:
        return 0, True
    if tag in ("header", "form") and not inside:
        return 0, False
    if tag == "form" or role in _ROLE:
        return 0, False
    if tag not in ("body", "html") and tag not in _HEADINGS and any(_named(x) for a in ("class", "id") for x in attrs.get(a, "").split()):
        return 0, False
    return None, False


def parse(html: str) -> Node:
    """The page's tree, with sizes. Raw elements and comments are left out; character references are decoded later."""
    root = Node("#root", 0, None)
    stack, at, size = [root], 0, len(html)
    while at < size:
        m = _TOKEN.match(html, at)
        token, at = m[0], m.end()
        if token[0] != "<" or len(token) == 1:
            stack[-1].children.append(token)
            continue
        if token[1] in "!?":
            if token.startswith("<![CDATA["):
                stack[-1].children.append(token[9:].removesuffix("]]>"))
            continue
        tag = _NAME.match(token)[1].lower()
        if token[1] == "/":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE and tag not in _SCOPE:
                    break
            else:  # a stray end tag still parts blocks
                if tag not in INLINE:
                    stack[-1].children.append(Node("br", 0, None))
            continue
        if tag in RAW:
            # its content is no markup: go on behind the end tag; without one only scripts and styles take all the rest
            if not token.endswith("/>"):
                end = re.compile(f"</{tag}\\s*>", re.I).search(html, at)
                at = end.end() if end else size if tag in ("script", "style") else at
            continue
        attrs = {a.lower(): x or y or z for a, x, y, z in _ATTR.findall(token)} if "=" in token else {}
        if tag not in VOID:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _CLOSES.get(tag, ()):
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE:
                    break
            if tag == "body":  # the head ends here at the latest
                while len(stack) > 1 and stack[-1].tag != "html":
                    stack.pop()
        inside = any(n.role == 1 for n in stack)
        node = Node(tag, 0, *_declared(tag, attrs, inside))
        mark = f"{tag}.{attrs.get('class', '')}#{attrs.get('id', '')}" if attrs else tag
        parent = stack[-1]
        node.key = crc32(mark.encode("utf-8", "surrogatepass"), parent.key & 0xFFFFFFFF) | (crc32(mark.encode("utf-8", "surrogatepass"), parent.key >> 32 & 0xFFFFFFFF ^ 0x5BD1E995) << 32)
        if node.key >= 1 << 63:
            node.key -= 1 << 64
        parent.children.append(node)
        if tag not in VOID and not token.endswith("/>"):
            stack.append(node)
    _measure(root)
    return root


def _measure(root: Node) -> None:
    """Sizes of all nodes, and the roles that their content forbids."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [c for c in n.children if not isinstance(c, str)]
    holds: set[int] = set()  # nodes with an article or main inside
    for n in reversed(order):  # children before parents
        n.size = sum(len(c) - c.count(" ") if isinstance(c, str) else 0 if c.role == 0 and c.firm else c.size for c in n.children)
        if any(not isinstance(c, str) and (c.role == 1 or id(c) in holds) for c in n.children):
            holds.add(id(n))
    for n in order:
        if n.role == 0 and not n.firm and (id(n) in holds or 2 * n.size > root.size):
            n.role = None


def blocks(node: Node, cut: frozenset | set) -> list[str]:
    """The text blocks below node in page order, without the branches in cut (articles keep theirs) and those declared noise."""
    out: list[list[str]] = [[]]
    stack = [(iter(node.children), False, frozenset() if node.tag == "article" else cut)]
    while stack:
        children, ends, low = stack[-1]
        for child in children:
            if isinstance(child, str):
                out[-1].append(child)
                continue
            block = child.tag not in INLINE
            if block:
                out.append([])
            if child.role == 0 or child.key in low and child.role != 1:
                continue
            stack.append((iter(child.children), block, frozenset() if child.role == 1 and child.tag == "article" else low))
            break
        else:
            stack.pop()
            if ends:
                out.append([])
    return [t for b in out if (t := " ".join(unescape("".join(b)).split()))]


def _outermost(root: Node, wanted) -> list[Node]:
    """The outermost nodes below root, in page order, that are wanted and not within declared noise."""
    found, queue = [], [root]
    while queue:
        n = queue.pop()
        if n is not root and wanted(n):
            found.append(n)
        else:
            queue += [c for c in reversed(n.children) if not isinstance(c, str) and c.role != 0]
    return found


def _spared(roots: list[Node], cut: set) -> set:
    """cut without the nodes that hold more than half of the text below roots: what is most of a page is its content."""
    held, total, todo = Counter(), sum(n.size for n in roots), [(n, frozenset()) for n in roots]
    while todo:
        n, above = todo.pop()
        if n.key in cut and n.key not in above:
            held[n.key] += n.size
            above = above | {n.key}
        todo += [(c, above) for c in n.children if not isinstance(c, str) and c.role != 0]
    return cut - {k for k, size in held.items() if 2 * size > total}


def page_text(html: str, cut: frozenset | set = frozenset()) -> str:
    """The article: what stands in main or article elements, or else in the whole page, without the branches in cut."""
    root = parse(html)
    # main holds the article and what belongs to it, as its title; without it the articles are the content
    mains = _outermost(root, lambda n: n.role == 1 and n.tag != "article") or _outermost(root, lambda n: n.role == 1) or [root]
    kept = _spared(mains, set(cut)) if cut else cut
    return " ".join(t for m in mains for t in blocks(m, kept)) or (" ".join(t for m in mains for t in blocks(m, frozenset())) if cut else "")


def page_nodes(html: str) -> list[tuple[int, int, int, int, int | None, float, float]]:
    """Of each merged node with text: key, parent's key, depth, hashes of its style (child tags) and of its own texts, its share of its parent's
    children and its texts' share of its own. Declared noise is left out."""
    root = parse(html)
    merged: dict[int, list] = {}
    todo: list[tuple[Node, int, int, float]] = [(root, 0, 0, 1.0)]
    while todo:
        n, parent, depth, share = todo.pop()
        kids = [c for c in n.children if not isinstance(c, str) and c.role != 0 and c.size]
        texts = [t for c in n.children if isinstance(c, str) and (t := " ".join(c.split()))]
        m = merged.setdefault(n.key, [parent, depth, [], [], 0.0, []])
        m[2].append(",".join("#" if isinstance(c, str) else c.tag for c in n.children if not isinstance(c, str) or c.strip()))
        m[3] += texts
        m[4] += share
        k = len(kids) + len(texts)
        if k:
            m[5].append(len(texts) / k)
        todo += [(c, n.key, depth + 1, 1 / k) for c in reversed(kids)]
    crc = lambda parts: crc32("\n".join(parts).encode("utf-8", "surrogatepass"))
    # like siblings are one node: what they hold of their parent adds up, their children's shares are means
    twins = {k: len(m[2]) for k, m in merged.items()}
    return [(k, m[0], m[1], crc(m[2]), crc(m[3]) if m[3] else None, m[4] / twins[m[0]] if k else 1.0, sum(m[5]) / len(m[5]) if m[5] else 0.0) for k, m in merged.items()]


def host_of(url):
    """The host of a url column, lower case; '' if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


_FEATURES = "host string, node long, parent long, depth int, kind int, feature long, n long, share double"


def merged_nodes(pages: DataFrame, gamma: float = 0.9) -> DataFrame:
    """host, node, parent, depth, pages, styles, weight (gamma^styles), entropy, share, text: the merged trees.

    share is the node's part of its parent's children, text what its own texts add to the mean of its children.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, seen, shares = [x.split()[0] for x in _FEATURES.split(", ")], Counter(), Counter()

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(*k, n, shares[k]) for k, n in seen.items()], columns=names)

        for b in batches:
            for host, html in zip(b["host"], b["html"]):
                for node, parent, depth, style, text, share, own in page_nodes(html):
                    key = (host, node, parent, depth, 0, style)
                    seen[key] += 1
                    shares[key] += share
                    if text is not None:
                        key = (host, node, parent, depth, 1, text)
                        seen[key] += 1
                        shares[key] += own
                if len(seen) > 100_000:
                    yield rows()
                    seen, shares = Counter(), Counter()
        if seen:
            yield rows()

    src = pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    counts = src.mapInPandas(count, _FEATURES).groupBy("host", "node", "parent", "depth", "kind", "feature").agg(F.sum("n").alias("n"), F.sum("share").alias("share"))
    style, content = F.col("kind") == 0, F.col("kind") == 1
    by = counts.groupBy("host", "node", "parent", "depth").agg(
        F.sum(F.when(style, F.col("n"))).alias("pages"),
        F.count_if(style).alias("styles"),
        F.sum(F.when(style, F.col("n") * F.log("n"))).alias("s0"),
        F.coalesce(F.sum(F.when(content, F.col("n"))), F.lit(0)).alias("texts"),
        F.coalesce(F.sum(F.when(content, F.col("n") * F.log("n"))), F.lit(0.0)).alias("s1"),
        F.sum(F.when(style, F.col("share"))).alias("share"),
        F.coalesce(F.sum(F.when(content, F.col("share"))), F.lit(0.0)).alias("own"),
    )
    m, log_m = F.col("pages"), F.log("pages")
    several = m > 1
    entropy = F.when(several, (log_m - F.col("s0") / m) / log_m).otherwise(1.0)
    unlike = F.when(several & (F.col("texts") > 0), 1 - F.col("s1") / F.col("texts") / log_m).otherwise(1.0)
    # shares are means over the pages of the parent, which has at least the node's
    return by.select("host", "node", "parent", "depth", "pages", "styles", F.pow(F.lit(gamma), F.col("styles")).alias("weight"), entropy.alias("entropy"), F.col("share"), (F.col("own") / m).alias("own"), (F.col("own") / m * unlike).alias("text"), F.when(F.col("own") > 0, unlike).alias("unlike"))


def style_tree(pages: DataFrame, gamma: float = 0.9) -> DataFrame:
    """host, node, pages, importance, top (the largest importance in its branch) of the nodes that several pages have."""
    nodes = written(merged_nodes(pages, gamma))
    # a node of one page is unlike any other, and so is all below it
    lone = nodes.where("pages = 1").select("host", "parent", "depth", "share", F.lit(1.0).alias("importance"), F.lit(1.0).alias("top"))
    deepest = nodes.where("pages > 1").agg(F.max("depth")).first()[0]
    levels: list[DataFrame] = []
    below = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        kids = lone.where(F.col("depth") == depth + 1).drop("depth")
        if below is not None:
            kids = kids.unionByName(below.select("host", "parent", "share", "importance", "top"))
        kids = kids.groupBy("host", "parent").agg(F.sum(F.col("share") * F.col("importance")).alias("sum"), F.max("top").alias("kids_top"))
        at = nodes.where((F.col("pages") > 1) & (F.col("depth") == depth)).join(kids.withColumnRenamed("parent", "node"), ["host", "node"], "left")
        mean = F.least(F.lit(1.0), F.coalesce(F.col("sum"), F.lit(0.0)) / F.col("pages") + F.col("text"))
        at = at.withColumn("importance", (1 - F.col("weight")) * F.col("entropy") + F.col("weight") * mean)
        top = F.greatest("importance", F.coalesce("kids_top", F.lit(0.0)), F.coalesce("unlike", F.lit(0.0)))
        below = written(at.select("host", "node", "parent", "depth", "pages", "share", "importance", top.alias("top")))
        levels.append(below)
    if not levels:
        return nodes.select("host", "node", "pages", F.lit(1.0).alias("importance"), F.lit(1.0).alias("top")).limit(0)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.select("host", "node", "pages", "importance", "top")


def low_branches(pages: DataFrame, threshold: float = 0.2, gamma: float = 0.9) -> DataFrame:
    """host, cut: the nodes to remove of each host that has any; as many as its templates have nodes."""
    tree = style_tree(pages, gamma)
    telling = tree.where((F.col("node") == 0) & (F.col("top") >= threshold)).select("host")
    low = tree.where((F.col("top") < threshold) & (F.col("node") != 0)).join(telling, "host", "left_semi")
    return written(low.groupBy("host").agg(F.collect_set("node").alias("cut")))


def extract(pages: DataFrame, threshold: float = 0.2, gamma: float = 0.9, tree: bool = True) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html); without tree by declared roles alone."""
    src = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    if tree:
        src = src.join(sized(low_branches(pages, threshold, gamma), 20_000), "host", "left")  # a list has some dozen nodes
    else:
        src = src.withColumn("cut", F.lit(None).cast("array<bigint>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [page_text(h, frozenset(c or ())) for h, c in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return src.select("page_id", "url", "html", "cut").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
