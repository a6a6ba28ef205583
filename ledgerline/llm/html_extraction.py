"""Main text of web pages, with removal of site templates.

Each page is parsed once, in time that grows with its length. Of every element subtree that holds text, from
navigation and notices down to single paragraphs, list items and bare lines, a digest is taken: of the element's tag, what it calls itself
and its children's digests. Spark counts, per host, on how many pages of different main text a
subtree occurs, and subtrees that recur on many pages of their host
are deleted. Copies of one article count once, so an article that many pages repeat stays. A block
alone is weaker evidence than a container and must stand on most pages. What recurrence cannot know, as it differs from page to page or
the host has few pages, goes by a check after it: elements that are furniture by tag, role or class name, and what stands
outside the article where there is one.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stash, table
from ledgerline.llm.url_filters import host

#: A comment, a declaration, or the start of a tag; what follows a tag's name is found by ATTRIBUTES.
OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+))")
ATTRIBUTES = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset(
    "head title script style noscript template nav header footer aside form menu dialog iframe svg canvas object "
    "button select option textarea label fieldset audio video map math xmp noembed noframes".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub "
    "sup time tt u var wbr".split()
)
#: Words in class, id or role that name furniture.
NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside ad ads advert adverts advertisement advertising banner "
    "sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup "
    "login popup modal overlay comment comments commentlist reply replies respond disqus footer header masthead share sharing "
    "social related recommended widget toolbar pagination pager complementary contentinfo search dialog".split()
)
#: Of these, words that also name content. Beside a word that is no part of a layout they are only a hint, which links must bear out.
HINTS = frozenset("alert banner dialog header notice notices overlay related recommended search share sharing signup social subscription toolbar widget".split())
LAYOUT = frozenset(
    "area articles bar block box bottom buttons button center class col column container content default fixed group icon icons inner item items js left line link links list main media mobile "
    "outer page pages panel posts primary right row secondary section site sm small lg large md top wrap wrapper".split()
)
#: Share of a hinted element's characters that stand in links, from which on it is furniture.
LINKED = 0.5
#: Whose text is never text of the page.
MUTE = frozenset("head title script style template iframe svg canvas object select option textarea audio video map math xmp noembed noframes".split())
#: Never templates as a whole.
WHOLE = frozenset(["html", "body", "article", "main"])
#: Elements that are one block as a rule; with one block in them they count as that block.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre".split())
CLOSED_BY_BLOCK = frozenset(["p"])
#: Elements that hold others; a slash at the end of their tag does not close them.
PARTS = frozenset("div section ul ol dl table tbody blockquote figure details address center td".split())
SAME_CLOSES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
CONTENT = frozenset(["article", "main"])


class Element:
    """An open element: ``home`` is the nearest one that is not inline, ``marks`` the digests of what is in it."""

    __slots__ = ("tag", "skip", "mute", "article", "name", "first", "home", "marks", "hint")

    def __init__(self, tag: str, above: Element | None):
        self.tag, self.name, self.first, self.marks, self.hint = tag, "", -1, [], False
        self.skip, self.mute, self.article = (above.skip, above.mute, above.article) if above else (False, False, 0)
        self.home = above.home if above and tag in INLINE else self


class Page(NamedTuple):
    """The blocks of a page in order, and its subtrees.

    ``texts`` is None for blocks that tags, names or links mark as furniture; ``owns`` are digests of the block's element, odd. ``trees``
    are (digest, first block, end) of all subtrees that hold more than one block or are no leaf, even.
    """

    texts: list[str | None]
    owns: list[int]
    trees: list[tuple[int, int, int]]


def _names(attributes: str) -> tuple[int, str]:
    """(2: is furniture, 1: may be, 0: is not; what the element calls itself)."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return 0, ""
    found = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)]
    shown = " ".join(v for _, v in found)
    if HIDDEN.search(attributes):
        return 2, shown
    sign = 0
    for name in shown.split():
        words = {w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w}
        if named := words & NAMES:
            sign = max(sign, 1 if named <= HINTS and any(not w.isdigit() for w in words - NAMES - LAYOUT) else 2)
    return sign, shown


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def tokens(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, tag, whether it ends an element, attributes) of each tag; of comments and declarations with an empty tag.

    One pass: where a tag is not closed to the end of the page, it and all after it are text.
    """
    at, last = 0, html.rfind(">")
    while found := OPENING.search(html, at):
        start, at = found.start(), found.end()
        if found[1]:
            end = html.find("-->", at)
            at = len(html) if end < 0 else end + 3
            yield start, at, "", False, ""
            continue
        if at > last:
            return
        if found[2]:
            at = html.index(">", at) + 1
            yield start, at, "", False, ""
            continue
        rest = ATTRIBUTES.match(html, at)
        end = rest.end() if rest else html.index(">", at) + 1
        attributes, at, tag = html[at : end - 1], end, found[4].lower()
        if tag in RAW and not found[3]:
            stop = re.compile(rf"</{re.escape(tag)}\b", re.I).search(html, at)
            end = at = stop.start() if stop else len(html)
        yield start, end, tag, found[3] == "/", attributes


def parse(html: str) -> Page:
    """All blocks of text of a page, furniture included, and the digests of the element subtrees around them.

    A subtree's digest is made of its children's, so the work grows with the page and not with its depth. Blocks
    that tags or names mark as furniture are kept without their text. So are those of an element whose name only hints at it and whose text is
    links for the most part; and those outside the articles, or the main part, of a page where these hold at least half of its text.
    """
    page, articles_of = Page([], [], []), []
    root = Element("", None)
    stack, open_tags, buffer, linked = [root], Counter(), [], []
    position = articles = in_links = 0

    def flush() -> None:
        nonlocal in_links
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            top = stack[-1]
            own = _digest(f"{top.home.tag} {text}") | 1
            top.home.marks.append(own)
            page.texts.append(None if top.skip else text)
            page.owns.append(own)
            articles_of.append(top.article)
            linked.append(min(in_links, len(text)))
        in_links = 0

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            element = stack.pop()
            open_tags[element.tag] -= 1
            blocks = len(page.texts) - element.first
            if element.first < 0 or not blocks:
                continue
            if element.hint:
                inside = range(element.first, len(page.texts))
                if sum(linked[i] for i in inside) >= LINKED * sum(len(page.texts[i] or "") for i in inside):
                    for i in inside:
                        page.texts[i] = None
            digest = _digest(f"{element.tag} {element.name} {element.marks}") & ~1
            stack[-1].home.marks.append(digest)
            if element.tag not in WHOLE and (blocks > 1 or element.tag not in LEAVES):
                page.trees.append((digest, element.first, len(page.texts)))

    for start, end, tag, ends, attributes in tokens(html):
        top = stack[-1]
        if start > position and not top.mute:
            # What is left out inside a line still parts the words around it.
            buffer.append(" " if top.skip and not top.home.skip else html[position:start])
            if open_tags["a"]:
                in_links += start - position
        position = end
        if not tag:
            continue
        if tag == "br":
            buffer.append(" ")
        if tag not in INLINE and buffer:
            flush()
        if ends:
            if open_tags[tag]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        pop_to(depth)
                        break
                    if stack[depth].tag in CONTENT and tag in INLINE | CLOSED_BY_BLOCK:
                        break
            continue
        if tag not in INLINE and (not top.mute or tag in SAME_CLOSES):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag and tag in SAME_CLOSES or stack[depth].tag in CLOSED_BY_BLOCK:
                    pop_to(depth)
                    break
                if stack[depth].tag not in INLINE and stack[depth].tag not in SAME_CLOSES or stack[depth].tag in SAME_CLOSES.get(tag, ()):
                    break
        if tag in VOID or attributes.endswith("/") and tag not in INLINE and tag not in PARTS:
            continue
        above = stack[-1]
        element = Element(tag, above)
        if not above.mute:
            named, element.name = _names(attributes)
            if tag in MUTE:
                element.mute = element.skip = True
            elif not above.skip:
                in_article = bool(above.article)
                element.skip = tag in FURNITURE or named == 2 and (tag not in WHOLE or tag == "article" and in_article)
                element.hint = named == 1 and not element.skip and tag not in WHOLE and tag not in INLINE
                if tag == "header" and in_article and not named:
                    element.skip = False  # an article's own heading
                if tag in CONTENT and not element.skip and (not in_article or tag == "article" and above.article < 0):
                    articles += 1
                    element.article = articles if tag == "article" else -articles
            if tag not in INLINE and not element.mute:
                element.first = len(page.texts)
        stack.append(element)
        open_tags[tag] += 1
    if not stack[-1].mute:
        buffer.append(html[position:])
    flush()
    pop_to(1)
    # Main text is where most of the text is: a teaser in an article does not outweigh the part that it stands in.
    mass = [sum(len(t) for a, t in zip(articles_of, page.texts) if t and sign(a)) for sign in (lambda a: a > 0, lambda a: a < 0, lambda a: not a)]
    if mass[0] and mass[0] >= mass[1] + (mass[2] if not mass[1] else 0):
        page.texts[:] = [t if a > 0 else None for a, t in zip(articles_of, page.texts)]
    elif mass[0] + mass[1] >= mass[2] and mass[0] + mass[1]:
        page.texts[:] = [t if a else None for a, t in zip(articles_of, page.texts)]
    return page


TREES = "array<struct<digest:bigint,first:int,end:int>>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = pa.list_(pa.struct([("digest", pa.int64()), ("first", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        pages = [parse(html.as_py() or "") for html in batch.column("html")]
        main = [_digest("\n".join(t for t in p.texts if t)) for p in pages]
        made = {
            "main": pa.array(main, pa.int64()),
            "texts": pa.array([p.texts for p in pages], pa.list_(pa.string())),
            "owns": pa.array([p.owns for p in pages], pa.list_(pa.int64())),
            "trees": pa.array([[dict(zip(("digest", "first", "end"), t)) for t in p.trees] for p in pages], tree),
            "live": pa.array([live(p) for p in pages], pa.list_(pa.int64())),
        }
        kept = {n: batch.column(n) for n in ("page_id", "url", "host")}
        yield pa.RecordBatch.from_pydict(kept | made)


def live(page: Page) -> list[int]:
    """Digests of the subtrees that hold a block with a text: if none of them is a template, the page is as the check leaves it."""
    texts = [0, *accumulate(t is not None for t in page.texts)]
    return [own for own, t in zip(page.owns, page.texts) if t is not None] + [d for d, first, end in page.trees if texts[end] > texts[first]]


def kept_blocks(texts: list[str | None], owns: list[int], trees: list[dict], templates: set[int]) -> list[str]:
    """The blocks that are in no template and that no rule marks."""
    change = [0] * (len(texts) + 1)
    for tree in trees:
        if tree["digest"] in templates:
            change[tree["first"]] += 1
            change[tree["end"]] -= 1
    inside = accumulate(change)
    return [t for t, own, n in zip(texts, owns, inside) if t is not None and not n and own not in templates]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for blocks, owns, trees, drop in zip(*(batch.column(n) for n in ("texts", "owns", "trees", "drop"))):
            found = drop.as_py()
            kept = kept_blocks(blocks.as_py(), owns.as_py(), trees.as_py(), set(found)) if found else filter(None, blocks.as_py())
            texts.append("\n".join(kept))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def templates_of(parsed: DataFrame, least_pages: int, least_share: float, many_pages: int, leaf_share: float) -> DataFrame:
    """(host, digest) of the subtrees that recur on pages of different main text of their host."""
    digests = F.array_distinct(F.concat("owns", "trees.digest"))
    seen = parsed.select("host", "main", F.explode(digests).alias("digest")).distinct()
    often = seen.groupBy("host", "digest").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    sizes = parsed.select("host", "main").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    n, leaf = F.col("n"), F.col("digest").bitwiseAND(F.lit(1)) == 1
    container = ~leaf & ((n >= many_pages) | (n >= least_share * F.col("pages")))
    return often.join(sizes, "host").where(container | leaf & (n >= many_pages) & (n >= leaf_share * F.col("pages"))).select("host", "digest")


def extract(pages: DataFrame, least_pages: int = 5, least_share: float = 0.2, many_pages: int = 20, leaf_share: float = 0.5) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Every element subtree of every page is counted in its host, furniture by tag or name included. A container is a template
    if it occurs in at least ``many_pages`` pages of different main text, however many the host has, or in at least ``least_pages`` that
    are ``least_share`` of those of the host. A single paragraph, heading, item or line is one if it occurs in at least ``many_pages`` that are
    ``leaf_share`` of the host's: on a large host short paragraphs, and passages that articles quote, recur on many pages by themselves. What
    templates leave passes a check by tags and names. Null and empty html give an empty
    text; null URLs share the empty host. Repeated rows come out as often as they
    are; html of any length and depth is parsed whole, in time that grows with its length. An empty table stays empty; further columns
    are not passed on, whatever their names.
    """
    named = pages.select("page_id", "url", F.xxhash64(host(F.col("url"))).alias("host"), "html")
    parsed = stash(
        named.mapInArrow(_parsed, f"page_id long, url string, host long, main long, texts array<string>, owns array<bigint>, trees {TREES}, live array<bigint>")
    )
    templates = stash(templates_of(parsed, least_pages, least_share, many_pages, leaf_share))
    # Only pages from which a template takes a text need to know which; their texts alone may have to move.
    hit = (
        parsed.select("host", "main", F.explode(F.array_distinct("live")).alias("digest"))
        .join(templates, ["host", "digest"])
        .groupBy("host", "main")
        .agg(F.collect_set("digest").alias("drop"))  # at most the elements of one page
    )
    marked = parsed.join(stash(hit), ["host", "main"], "left").select("page_id", "url", "texts", "owns", "trees", "drop")
    return marked.mapInArrow(_joined, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """extract() of all pages."""
    return extract(table(spark, sf_dir, "pages"))
