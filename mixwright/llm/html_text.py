"""Main text of web pages by site template removal.

A lenient pass turns each page into blocks of text with the hash of the element subtree that each stands in. Spark counts on
how many pages of its host every subtree stands; subtrees on many pages are the site's template and are deleted. The innermost
subtree of a block says it all: where one around it recurs, so does the inner one. Elements whose
role is plain from their tag or class (menus, footers, adverts, comments, scripts) go too, and where a page marks its article,
that is the text, without the boxes that recur in most articles of the host.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import checkpoint, salted_join
from mixwright.llm.url_filter import host

#: A subtree is template on this many pages of a host at least, and on this share of them.
LEAST_PAGES, LEAST_SHARE = 5, 0.02
#: A box inside marked articles is template on LEAST_PAGES different articles of a host at least, and on this share of them.
ARTICLE_SHARE = 0.5
#: Elements that hold no running text, by tag; and elements without content.
SKIPPED = frozenset("script style noscript template nav header footer aside form button select textarea option label fieldset svg math iframe object embed canvas audio video map dialog menu head title figure-caption".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "xmp"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Open elements that a start tag ends.
CLOSES = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "option": frozenset(("option",))}
#: A block's start tag ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split())
#: Running text: inside an article these are no boxes, so that a paragraph that articles share (a licence) stays.
RUNNING = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption figcaption blockquote pre article main".split())
#: Words of class, id and role that say an element isn't article text.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|signup|login|comments?|commentlist|disqus|replies|respond|"
    r"sidebar|widget|related|recommended|share|sharing|social|breadcrumbs?|pagination|pager|menu|navbar|nav|navigation|toolbar|masthead|header|footer|copyright|skip-link|search)(?:$|[\s_-])",
    re.I,
)
#: Of these, what holds articles of others (comments, teasers); and tags and roles that do. Any other noise around a marked
#: article (class="has-sidebar", a form around the page) is a wrapper.
APART = re.compile(r"(?:^|\s)(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|comments?|commentlist|disqus|replies|respond|related|recommended|sidebar|widget|newsletter|popup|modal|footer)(?=$|[\s_-])(?!-(?:open|closed|enabled|disabled|layout|page)\b)", re.I)
APART_TAGS = SKIPPED - frozenset(("form", "fieldset", "header", "label"))
APART_ROLES = frozenset(("complementary", "contentinfo", "navigation", "dialog", "alert"))
NOISE_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "toolbar"))
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_SPACE = re.compile(r"\s+")


class _Element:
    """An open element, with what the elements around it say of its text.

    noise: the text is in a noise role; inside a marked article only roles in it count, and those around it of what holds
    articles of others. main: it is in a marked article; box: its innermost element in that article that isn't running text.
    """

    __slots__ = ("tag", "apart", "since", "main", "box", "parts", "digest")

    def __init__(self, tag: str, around: _Element | None = None, noise: bool = False, apart: bool = False, main: bool = False):
        self.tag = tag
        self.apart = apart or (around is not None and around.apart)
        self.since = not main and (noise or (around is not None and around.since))
        self.main = main or (around is not None and around.main)
        self.box = None if around is None or not around.main else around.box if tag in RUNNING else self
        self.parts: list[bytes] = []
        self.digest = b""

    @property
    def noise(self) -> bool:
        return self.apart or self.since


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text else {}


def _is_noise(tag: str, attributes: dict[str, str]) -> bool:
    if tag in SKIPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    return any(NOISE.search(attributes[k]) for k in ("class", "id") if attributes.get(k))


def _is_apart(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element of a noise role keeps that role for an article inside it."""
    if tag in APART_TAGS or "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in APART_ROLES:
        return True
    return any(APART.search(attributes[k]) for k in ("class", "id") if attributes.get(k))


def blocks(page: str | None) -> list[tuple[str, bool, bool, int | None]]:
    """The blocks of a page in order: text, whether it stands in an element of a noise role, whether in the marked article,
    and the hash of the innermost subtree it stands in: of any, or inside the marked article of its boxes; None without one.
    Tags may be unclosed, cut off or out of order. Time is linear in the page, however deep elements nest."""
    page = page or ""
    stack = [_Element("")]
    out: list[tuple[str, bool, bool, _Element | None]] = []
    piece: list[str] = []
    opened: Counter[str] = Counter()

    def flush() -> None:
        if piece:
            text = _SPACE.sub(" ", "".join(piece)).strip()
            piece.clear()
            if text:
                top = stack[-1]
                out.append((text, top.noise, top.main, top.box if top.main else top if len(stack) > 1 else None))
                stack[-1].parts.append(text.encode("utf-8", "surrogatepass"))

    def close(depth: int) -> None:
        while len(stack) > depth:
            e = stack.pop()
            opened[e.tag] -= 1
            h = hashlib.blake2b(e.tag.encode(), digest_size=8)
            for p in e.parts:
                h.update(b"\0" + p)
            e.digest = h.digest()
            stack[-1].parts.append(e.digest)

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            piece.append(unescape(page[at:]))
            break
        if m.start() > at:
            piece.append(unescape(page[at : m.start()]))
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                piece.append(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            depth = len(stack) - 1 if opened[tag] else 0
            while depth and stack[depth].tag != tag:
                # An inline end tag doesn't reach over the block that it stands in.
                depth = 0 if tag in INLINE and stack[depth].tag not in INLINE else depth - 1
            if depth:
                if any(e.tag not in INLINE for e in stack[depth:]):
                    flush()
                close(depth)
            continue
        if tag == "br":
            piece.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        attributes = _attributes(m[3])
        if tag not in INLINE:
            flush()
            ends = CLOSES.get(tag, ("p",) if tag in ENDS_P else ())
            if ends:
                limit = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}.get(tag, ())
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ends:
                        close(i)
                        if tag in ("p", "li", "option"):
                            break
                    elif stack[i].tag in limit or (stack[i].tag not in INLINE and stack[i].tag not in ends):
                        break
        noisy = _is_noise(tag, attributes)
        if noisy and tag in INLINE:
            flush()
        main = tag in ("article", "main") or attributes.get("role", "").lower() == "main" or attributes.get("itemprop", "") == "articleBody"
        stack.append(_Element(tag, stack[-1], noisy, noisy and _is_apart(tag, attributes), main))
        opened[tag] += 1
        if m[3].rstrip().endswith("/") and tag not in INLINE and tag in ("svg", "path"):
            close(len(stack) - 1)
        elif tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            stack[-1].parts.append(page[at : end.start() if end else size].encode("utf-8", "surrogatepass"))
            close(len(stack) - 1)
            at = end.end() if end else size
    flush()
    close(1)
    return [(text, noise, main, None if e is None else int.from_bytes(e.digest, "little", signed=True)) for text, noise, main, e in out]


_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("tree", pa.int64())]))
_SEGMENTS_SQL = "array<struct<text:string,tree:bigint>>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            pages = [blocks(h) for h in part.column("html").to_pylist()]
            wanted = [_wanted(p) for p in pages]
            outside = [sorted({tree for _, _, main, tree in p if not main and tree is not None}) for p in pages]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("page_id", "url", "host")), pa.array([w for w, _ in wanted], _SEGMENTS), pa.array([a for _, a in wanted], pa.int64()), pa.array(outside, pa.list_(pa.int64()))],
                names=["page_id", "url", "host", "blocks", "article", "outside"],
            )


def _wanted(page: list[tuple[str, bool, bool, int | None]]) -> tuple[list[dict], int | None]:
    """The blocks that can be text of the page: those in its marked article with its boxes, or, without one, all of no noise
    role; and a hash of the marked article's text, None without one."""
    marked = any(main and not noise for _, noise, main, _ in page)
    kept = [{"text": text, "tree": tree} for text, noise, main, tree in page if not noise and main == marked]
    if not marked:
        return kept, None
    digest = hashlib.blake2b("\0".join(b["text"] for b in kept).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return kept, int.from_bytes(digest, "little", signed=True)


def templates(parsed: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """(host, inside, tree): subtrees outside marked articles that stand on at least ``least_pages`` pages of a host and on
    ``least_share`` of its pages; and boxes inside them that stand in at least ``least_pages`` different articles of a host
    and in ``article_share`` of these. A tree counts once a page, copies of an article count once."""
    counted = parsed.select("host", F.explode("outside").alias("tree")).groupBy("host", "tree").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    sizes = parsed.groupBy("host").agg(F.count("*").alias("pages"))
    outside = counted.join(sizes, "host").where(F.col("n") >= least_share * F.col("pages")).select("host", F.lit(False).alias("inside"), "tree")
    articles = parsed.where("article is not null")
    boxes = articles.select("host", "article", F.explode(_trees()).alias("tree")).distinct().groupBy("host", "tree").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    different = articles.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    inside = boxes.join(different, "host").where(F.col("n") >= article_share * F.col("articles")).select("host", F.lit(True).alias("inside"), "tree")
    return outside.unionByName(inside)


def _trees() -> Column:
    return F.array_compact(F.array_distinct(F.transform("blocks", lambda b: b["tree"])))


def extract(pages: DataFrame, salts: int = 32, **settings) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, url, text, n_chars, a row for each row of ``pages``.

    Null html counts as empty; a page without main text has empty text and 0 characters. White space inside a block is one
    blank, blocks are joined by one blank in page order. Null urls share one nameless host. Repeated rows are extracted each
    and count each towards a template. Whole pages are read; extra columns are ignored; an empty table gives no rows.
    """
    base = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host(F.col("url")).alias("host"))
    schema = f"page_id {dict(pages.dtypes)['page_id']}, url string, host string, blocks {_SEGMENTS_SQL}, article long, outside array<bigint>"
    # Pages are parsed once: what they hold of text and trees is kept.
    parsed = checkpoint(base.mapInArrow(_parsed, schema).withColumn("row", F.monotonically_increasing_id()))
    # Each tree is looked up among the host's template. Hosts may be large, so a host's trees are dealt over tasks with the
    # template repeated as often. Pages whose text stands in no tree have nothing to look up.
    open_ = F.exists("blocks", lambda b: b["tree"].isNotNull())
    rest = parsed.where(open_)
    asked = rest.select("row", "host", F.col("article").isNotNull().alias("inside"), F.explode(_trees()).alias("tree"))
    hits = salted_join(asked, templates(parsed, **settings), ["host", "inside", "tree"], F.col("row"), salts).groupBy("row").agg(F.collect_set("tree").alias("gone"))
    kept = F.filter("blocks", lambda b: F.col("gone").isNull() | b["tree"].isNull() | ~F.array_contains(F.col("gone"), b["tree"]))
    text = lambda parts: F.array_join(F.transform(parts, lambda b: b["text"]), " ")
    cleared = rest.join(hits, "row", "left").select("page_id", "url", text(kept).alias("text"))
    return parsed.where(~open_).select("page_id", "url", text("blocks").alias("text")).unionByName(cleared).withColumn("n_chars", F.length("text").cast("long"))
