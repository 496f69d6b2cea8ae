"""Main text of web pages by consensus host paths.

Every page's containers are scored by the text they hold, less what is in links; blocks that are mostly
links count nothing.  The best one is the deepest that holds all of this text, or the article or main
element with nine tenths of it, as the author then says what the article is.  Its path of generalised
tags and classes is the page's vote.  Votes are summed by host and path in Spark, the path with most
weight wins its host, and every page is extracted again from its elements on that path.

A page whose elements on the winning path are worth less than half of its best container is of another
layout if it has a container worth more than twice as much on one of the host's LAYOUTS next paths that two
or more pages voted for: that path is taken.  It uses its own best container if that is an article or main
element, and if it has no text on the path.

Left out everywhere: scripts, styles, navigation, headers and footers, asides, forms, embedded
media and elements whose class, id or role says that they are adverts, notices, comments or the like:
a whole name, or one made of the words of PLACE, MARK and PART ("comments", "site-header", "related-posts",
but not "has-sidebar" or "related-work").  Headings, article and main elements stay whatever their names,
and so does an element with more than half of the page's text, unless it is marked as comments.

Defined results: null html counts as empty and gives an empty text, as does a page without text;
null URLs and those without "://" share the host ""; repeated rows vote and are extracted each; an empty table gives an
empty result; other columns, whatever their names, are not looked at; broken markup (unclosed or stray tags, cut-off
pages) never fails: a tag that ends without its ">" is dropped, unclosed elements end with the page.
Work and memory are linear in a page's length however deep its elements are nested: a path longer than
PATH_CHARS is held as the digest of its parent's and its last step.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, cut, join_few
from .url_filter import host_of

# Elements without end tags; elements whose content is raw; elements left out; blocks; containers.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed".split())
LEFT_OUT = frozenset("head script style noscript template nav header footer aside form iframe svg canvas audio video object button select option textarea label fieldset dialog menu math title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("body article main section div td center".split())
#: Names in class, id or role that mark what isn't the article: places, marks and parts, and marks of comments.
COMMENTS = r"comments?|commentlist|disqus|replies|respond"
MARK = rf"{COMMENTS}|ads?|adverts?|advertis\w*|banner|breadcrumbs?|captcha|consent|contentinfo|cookies?|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promo\w*|recommend\w*|related|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget"
PLACE = r"site|page|main|top|bottom|left|right|upper|lower|global|primary|secondary|mobile|sticky|inline|user|entry|post|posts|article|content|text|google|wp|js|block|section"
PART = r"area|articles?|bar|block|bottom|box|button|buttons|column|container|content|form|group|icons?|inner|items?|label|left|links?|list|main|media|overlay|panel|popup|posts?|primary|right|row|secondary|section|slot|stories|thread|title|top|unit|wrap|wrapper|N|[0-9]+"
NAME = re.compile(rf"(?:(?:{PLACE})[_-]+)*(?:{MARK})(?:[_-]+(?:{MARK}|{PART}))*", re.I)
OF_COMMENTS = re.compile(rf"(?:(?:{PLACE})[_-]+)*(?:{COMMENTS})(?:[_-]+(?:{MARK}|{PART}))*", re.I)
NEVER_MARKED = frozenset("body html article main h1 h2 h3 h4 h5 h6".split())
# A quote opens a quoted value only right after "=".
IN_TAG = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$))|=)*+"
TAG = re.compile(rf"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)({IN_TAG})(?:>|$))", re.S)
ATTRIBUTE = re.compile(r"([^\s/=>]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>]*)))?")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names of headers, which keep an article's own heading.
OF_HEADER = re.compile(rf"(?:(?:{PLACE})[_-]+)*(?:header|masthead)(?:[_-]+(?:{PART}))*", re.I)
#: Character references by number whose leading zeros or further digits would be much work.
LONG_NUMBER = re.compile(r"&#0*+([0-9]{8,})|&#0{2,}+(?=[0-9])")
CLOSES = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
CLOSES |= {x: {"p"} for x in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()}
STOPS = frozenset("article section div td th body main ul ol table blockquote".split())
#: The longest path and step; what is longer is named by its digest.
PATH_CHARS, STEP_CHARS = 1000, 200
#: Layouts of a host besides the winning one.
LAYOUTS = 16


@dataclass
class Node:
    tag: str
    path: str
    parent: Node | None
    dropped: bool
    marked: bool = False
    comments: bool = False
    header: bool = False
    chars: int = 0
    worth: int = 0
    order: int = 0
    depth: int = 0
    wide: bool = False
    container: bool = False
    inside: bool = False


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest()


def _path(above: str, tag: str, classes: set[str]) -> str:
    """The path of an element with these classes, their digits generalised, under the path above."""
    step = tag + "".join("." + c for c in sorted(classes))
    step = step if len(step) <= STEP_CHARS else "#" + _digest(step)
    path = f"{above}>{step}" if above else step
    return path if len(path) <= PATH_CHARS else f"#{_digest(above)}>{step}"


def _attributes(given: str) -> dict[str, str]:
    """class, id and role of a tag; the first of each counts."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(given) if "=" in given else ():
        if (name := name.lower()) in ("class", "id", "role"):
            out.setdefault(name, "".join(values))
    return out


def unescape(text: str) -> str:
    """text with its character references decoded."""
    if "&#0" in text or "&#" in text and LONG_NUMBER.search(text):
        text = LONG_NUMBER.sub(lambda m: "&#1114112" if m.group(1) else "&#", text)  # beyond the last code point
    return entities.unescape(text)


def _parse(page: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """All elements, the root first and parents before children, and the page's stream of (innermost element, text or None for a break) outside what is left out."""
    root = Node("", "", None, False)
    nodes, stream, at, pos = [root], [], root, 0
    open_tags: dict[str, int] = {}

    def leave(to: Node) -> Node:
        x = at
        while x is not to:
            open_tags[x.tag] -= 1
            x = x.parent
        return to

    def close(tag: str) -> Node:
        if not open_tags.get(tag):
            return at
        x = at
        while x.tag != tag:
            x = x.parent
        return leave(x.parent)

    while True:
        m = TAG.search(page, pos)
        text = page[pos : m.start()] if m else page[pos:]
        if text and not at.dropped:
            stream.append((at, unescape(text)))
        if m is None:
            break
        pos = m.end()
        slash, tag, attributes = m.group(1), m.group(2), m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if tag not in INLINE:
                stream.append((at, None))
            at = close(tag)
            continue
        if any(open_tags.get(t) for t in CLOSES.get(tag, ())):
            x, ends = at, CLOSES[tag]
            while x.parent is not None and x.tag not in ends and (x.tag in INLINE or x.tag not in STOPS):
                x = x.parent
            if x.tag in ends and x.parent is not None:
                at = leave(x.parent)
        if tag not in INLINE:
            stream.append((at, None))
        if tag in VOID or attributes.endswith("/"):
            continue
        has = _attributes(attributes)
        child = Node(tag, _path(at.path, tag, set(re.sub(r"\d+", "N", has.get("class", "")).split())), at, at.dropped or tag in LEFT_OUT, order=len(nodes), depth=at.depth + 1)
        child.wide = tag in ("article", "main") or has.get("role") == "main"
        child.container = tag in CONTAINERS
        if has and tag not in NEVER_MARKED and not child.wide:
            marks = [x for x in " ".join(has.values()).split() if NAME.fullmatch(x)]
            child.marked, child.comments, child.header = bool(marks), any(map(OF_COMMENTS.fullmatch, marks)), all(map(OF_HEADER.fullmatch, marks))
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)", re.I).search(page, pos)
            pos = over.start() if over else len(page)
            if tag in ("textarea", "title"):
                continue
            m = TAG.search(page, pos)
            pos = m.end() if m else len(page)
            continue
        nodes.append(child)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        at = child
    _drop_marked(nodes, stream)
    return nodes, [x for x in stream if x[1] is None or not x[0].dropped]


def _drop_marked(nodes: list[Node], stream: list[tuple[Node, str | None]]) -> None:
    """Drops marked elements and all in them, but for one with more than half of the text outside comments and an article's header with its heading."""
    if any(n.marked for n in nodes):
        within, wide = [False] * len(nodes), [False] * len(nodes)
        held, headed = [0] * len(nodes), [n.tag in HEADINGS for n in nodes]
        for n in nodes[1:]:
            within[n.order] = n.comments or within[n.parent.order]
            wide[n.order] = n.wide or wide[n.parent.order]
        for n in reversed(nodes[1:]):
            headed[n.parent.order] |= headed[n.order]
        for n, text in stream:
            if text is not None and not within[n.order]:
                held[n.order] += len("".join(text.split()))
        total = sum(held)
        for n in reversed(nodes[1:]):
            own = n.header and wide[n.order] and headed[n.order]
            if n.marked and not own and (n.comments or 2 * held[n.order] <= total):
                n.dropped = True
            else:
                held[n.parent.order] += held[n.order]
    for n in nodes[1:]:
        n.dropped = n.dropped or n.parent.dropped
        n.container = n.container and not n.dropped


def _score(nodes: list[Node], stream: list[tuple[Node, str | None]]) -> None:
    """Characters in each element, and what they are worth: those in links count against the others, a block with more of them nothing."""
    for node, text in stream:
        if text is not None:
            n = len("".join(text.split()))
            node.chars += n
            node.worth += n
    for node in reversed(nodes):
        if node.tag == "a":
            node.worth = -node.chars
        elif node.tag not in INLINE:
            node.worth = max(node.worth, 0)
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.worth += node.worth


def _best(nodes: list[Node]) -> Node | None:
    """The article or main with nine tenths of the most worth, else the deepest container with all of it."""
    held = [n for n in nodes if n.container]
    most = max((n.worth for n in held), default=0)
    if most <= 0:
        return max(held, key=lambda n: n.chars, default=None)
    wide = [n for n in held if n.wide and n.worth >= 0.9 * most]
    return max(wide or held, key=lambda n: (n.worth, n.depth, -n.order))


def best_path(html: str) -> tuple[str | None, int]:
    """A page's vote and its weight."""
    nodes, stream = _parse(html)
    _score(nodes, stream)
    best = _best(nodes)
    return (best.path, best.worth) if best is not None and best.chars else (None, 0)


def _key(path: str) -> int:
    return int(hashlib.md5(path.encode()).hexdigest()[:15], 16)


def extract(html: str, path: str | None, layouts: Collection[int] = ()) -> str:
    """The text of the page's elements on path or that of its own layout; layouts: keys of the host's other ones."""
    nodes, stream = _parse(html)
    _score(nodes, stream)
    best = _best(nodes)

    def take(chosen: list[Node]) -> tuple[int, int]:
        for n in nodes:
            n.inside = False
        for n in chosen:
            n.inside = True
        chars = worth = 0
        for n in nodes:
            above = n.parent is not None and n.parent.inside
            if n.inside and not above:
                chars, worth = chars + n.chars, worth + n.worth
            n.inside = n.inside or above
        return chars, worth

    chars, worth = take([n for n in nodes if n.container and n.path == path])
    if not chars or best is not None and 2 * worth < best.worth:
        fitting = {n.path for n in nodes if n.container and n.worth > 2 * worth and n.path != path}
        other = max((n for n in nodes if n.container and n.path in fitting and _key(n.path) in layouts), key=lambda n: (n.worth, n.depth, -n.order), default=None) if fitting and layouts and not (best and best.wide) else None
        if other is not None:
            take([n for n in nodes if n.container and n.path == other.path])
        elif not chars or best.wide:
            take([best or nodes[0]])  # bare text without any container: the whole page
    return " ".join("".join(" " if t is None else t for n, t in stream if t is None or n.inside).split())


def _winners(totals: DataFrame) -> DataFrame:
    """of_host, path (most weight), layouts: keys of the LAYOUTS next paths that two pages or more voted for.

    The first places are found in parts of a host's paths, so that no task sorts all of a host with many.
    """
    key = F.conv(F.substring(F.md5(F.col("path").cast("binary")), 1, 15), 16, 10).cast("long")
    rows = totals.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    for keys in (("host", "part"), ("host",)):
        place = Window.partitionBy(*keys).orderBy(F.col("weight").desc(), F.col("path").desc())
        rows = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= LAYOUTS + 1)
    first = F.col("place") == 1
    return rows.groupBy(F.col("host").alias("of_host")).agg(
        F.max(F.when(first, F.col("path"))).alias("path"), F.collect_list(F.when(~first & (F.col("pages") > 1), key)).alias("layouts")
    )


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of pages."""
    url = F.col(url_col).cast("string")
    slim = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, str], list[int]] = {}
            for i in range(0, b.num_rows, 500):
                for host, page in zip(b.column("host").slice(i, 500).to_pylist(), b.column("html").slice(i, 500).to_pylist()):
                    path, weight = best_path(page)
                    if path is not None:
                        had = sums.setdefault((host, path), [0, 0])
                        had[0] += weight
                        had[1] += 1
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in sums]), pa.array([p for _, p in sums]), *[pa.array([x[k] for x in sums.values()], pa.int64()) for k in (0, 1)]], ["host", "path", "weight", "pages"])

    votes = slim.select("host", "html").mapInArrow(vote, "host string, path string, weight bigint, pages bigint")
    totals = cut(votes.groupBy("host", "path").agg(F.sum("weight").alias("weight"), F.sum("pages").alias("pages")))
    won = cut(_winners(totals))
    spread = F.pmod(F.xxhash64("page_id", F.length("html")), F.lit(SALTS)).cast("int")
    joined = join_few(slim, won, F.col("host"), F.col("of_host"), spread).select("page_id", "url", "html", "path", "layouts")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                texts = [extract(h, p, x or ()) for h, p, x in zip(*(part.column(c).to_pylist() for c in ("html", "path", "layouts")))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(take, joined.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))
