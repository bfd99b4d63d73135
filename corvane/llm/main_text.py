"""Main text of web pages, with boilerplate found by what the pages of a host repeat.

A page is cut into blocks: runs of text between tags that begin or end one. Tags
and the names of classes and ids tell what most blocks are: inside `article` or
`main` they belong to the article, inside `nav`, `footer`, adverts, forms,
comments and the like they do not. Undecided are blocks outside both (open ones),
and those of an article that are set apart in it: mostly links, or under a class
or id that holds less than half of the article's tokens. Headings of an article
and its other blocks stay, however often they are repeated.

The token streams of the undecided blocks of a host's pages make its suffix array,
sorted to the depth of `min_tokens`; a block shorter than that is its own suffix.
Suffixes with that prefix in common are a run of the array. As only the runs are
needed, not their order, suffixes are rows that are grouped by a 128-bit hash of
(host, prefix), not sorted; a longer repeat is a chain of such runs. A block goes
if runs of `min_pages` sources or more cover more than `covered` percent of its
tokens, and stays whole otherwise. Equal pages are one source, for blocks of an
article equal articles are. Runs are counted with sums combined inside each task,
so a host with a third of all pages, and a menu on each of them, is no hot key,
and no text is shuffled for it.

Defined results: null and empty pages have an empty text; open blocks stand where
the page has them, before, after or without an article; a page without a host is a host of its own
kind; unclosed and stray tags are taken as browsers do, roughly: a block's context
is that of the open elements around it, and a page's end closes all; a tag that
never ends is text. Cutting takes time in proportion to the page. White space
is that of Unicode. Equal rows count as one page for the repeats, each gets its
text, and other columns are not looked at.
"""

from __future__ import annotations

import bisect
import html
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import narrow
from corvane.session import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# HTML elements by their role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead "
    "title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW_TAGS = frozenset("iframe math noembed noframes noscript object script style svg template textarea xmp".split())
CHROME_TAGS = frozenset("aside button dialog footer form head header menu nav option select title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE_TAGS = frozenset("article main".split())
CHROME_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header "
    "masthead menu modal nav navbar navigation newsletter notice pagination popup promo related replies respond share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
CHROME_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# Elements that an opening tag of the named ones closes.
CLOSED_BY = {
    "p": BLOCK_TAGS - {"br", "button", "option", "body", "html", "head", "title", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"},
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "head": frozenset(["body"]),
}

SPECIAL = re.compile(r"[<>\"']")
TAG_NAME = re.compile(r"<(/?)([A-Za-z][^\s/<>]*)")
# Names begin where a run of their characters does, so that no run is read twice.
ATTRIBUTE = re.compile(r"""(?<![^\s=/"'])([^\s=/"']++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
LONG_REFERENCE = re.compile(r"&#([0-9]{9,})")

ARTICLE, OPEN, CHROME = 0, 1, 2


def _is_chrome(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in CHROME_TAGS and not (tag == "header" and in_article):
        return True
    if not attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id"):
            words = re.split(r"[^a-z]+", value)
            if not CHROME_NAMES.isdisjoint(words) and tag not in ("html", "body", "article", "main"):
                return True
        elif name == "role" and value in CHROME_ROLES or name == "aria-hidden" and value == "true":
            return True
    return re.search(r"(?:^|\s)hidden(?:[\s=/]|$)", attributes) is not None and tag not in ("html", "body")


class TagEnds:
    """Where the tag whose attributes begin at a place ends: at the next `>` outside quotes, found for all places in one pass from the end."""

    def __init__(self, page: str):
        self.places = [m.start() for m in SPECIAL.finditer(page)]
        plain = double = single = -1
        ends = [-1]
        for at in reversed(self.places):
            match page[at]:
                case ">":
                    plain = at
                case '"':
                    plain, double = double, plain
                case "'":
                    plain, single = single, plain
            ends.append(plain)
        self.ends = ends[::-1]

    def after(self, at: int) -> int:
        """The place of the `>`, or -1."""
        return self.ends[bisect.bisect_left(self.places, at)]


@dataclass(frozen=True)
class Block:
    text: str
    place: int
    heading: bool
    # The class or id around the block inside its article, and whether the block is mostly links.
    sign: str
    links: bool


def blocks(page: str) -> Iterator[tuple[str, int]]:
    """(text, place) of each block with text, in page order; place: in an article, open, or in a page's furniture."""
    return ((b.text, b.place) for b in placed_blocks(page))


def _unescaped(text: str) -> str:
    # Longer numbers than Python reads name no character.
    return html.unescape(LONG_REFERENCE.sub(lambda m: f"&#{(m[1].lstrip('0') or '0') if len(m[1].lstrip('0')) < 9 else 99999999}", text))


def _sign(attributes: str) -> str:
    return " ".join("".join(values) for name, *values in ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id"))


def placed_blocks(page: str) -> Iterator[Block]:
    """The blocks with text, in page order."""
    stack: list[tuple[str, int, str]] = []  # open elements with their places and signs
    inside_of = Counter()  # how many of each are open
    parts: list[str] = []
    at = text_from = linked = 0
    place, heading, sign = OPEN, False, ""
    end = len(page)
    tag_ends = TagEnds(page)

    def take(stop):
        nonlocal linked
        if stop > text_from:
            parts.append(page[text_from:stop])
            if inside_of["a"]:
                linked += stop - text_from

    def flush():
        nonlocal linked
        written = "".join(parts)
        found = Block(" ".join(_unescaped(written).split()), place, heading, sign, 2 * linked > len(written))
        parts.clear()
        linked = 0
        return found

    def pop():
        name = stack.pop()[0]
        inside_of[name] -= 1
        return name

    while (start := page.find("<", at)) >= 0:
        follows = page[start + 1 : start + 2]
        if follows in ("!", "?"):  # a comment or declaration, which parts no words
            take(start)
            mark = "-->" if page.startswith("<!--", start) else ">"
            stop = page.find(mark, start + 4 if mark == "-->" else start)
            at = text_from = end if stop < 0 else stop + len(mark)
            continue
        named = TAG_NAME.match(page, start)
        stop = tag_ends.after(named.end()) if named else -1
        if stop < 0:
            at = start + 1
            continue
        take(start)
        at = text_from = stop + 1
        closing, tag, attributes = named[1], named[2].lower(), page[named.end() : stop]
        if tag in BLOCK_TAGS or tag in RAW_TAGS:
            if (block := flush()).text:
                yield block
        if closing:
            if inside_of[tag]:
                while pop() != tag:
                    pass
        elif tag in RAW_TAGS:
            closed = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
            stop = page.find(">", closed.end()) if closed else -1
            at = text_from = end if stop < 0 else stop + 1
        elif tag not in VOID_TAGS:
            while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                pop()
            _, around, sign_around = stack[-1] if stack else ("", OPEN, "")
            inside, signed = around, sign_around
            if around != CHROME:
                if _is_chrome(tag, attributes, around == ARTICLE):
                    inside = CHROME
                elif tag in ARTICLE_TAGS:
                    inside = ARTICLE
                elif around == ARTICLE and tag in BLOCK_TAGS and attributes:
                    signed = _sign(attributes) or sign_around
            if not attributes.rstrip().endswith("/") or tag in BLOCK_TAGS:
                stack.append((tag, inside, signed))
                inside_of[tag] += 1
        _, place, sign = stack[-1] if stack else ("", OPEN, "")
        heading = any(inside_of[name] for name in HEADINGS)
    take(end)
    if (block := flush()).text:
        yield block


@dataclass(frozen=True)
class Repeats:
    min_tokens: int = 6
    min_pages: int = 3
    covered: int = 50


BLOCKS = "array<struct<text: string, open: boolean, apart: boolean>>"
_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("open", pa.bool_()), ("apart", pa.bool_())]))


def kept_blocks(page: str) -> list[dict]:
    """The blocks outside the page's furniture; `apart`: set apart in an article."""
    found = [b for b in placed_blocks(page) if b.place != CHROME]
    tokens = Counter()
    for b in found:
        if b.place == ARTICLE:
            tokens[b.sign] += b.text.count(" ") + 1
    few = {sign for sign, n in tokens.items() if sign and 2 * n < tokens.total()}
    return [{"text": b.text, "open": b.place == OPEN, "apart": b.place == ARTICLE and not b.heading and (b.links or b.sign in few)} for b in found]


def page_blocks(page: Column) -> Column:
    """A page's blocks, without those of its furniture, in order."""

    @F.arrow_udf(BLOCKS)
    def cut(column: pa.Array) -> pa.Array:
        return pa.array([kept_blocks(value.as_py()) if value.is_valid else [] for value in column], _BLOCKS)

    return cut(page)


def host_of(url: Column) -> Column:
    """The host of an address, without `www.` and `m.`; empty if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.|m\.)?([^/?#:]*)", 1)
    return host


def boilerplate_blocks(undecided: DataFrame, rule: Repeats) -> DataFrame:
    """page, block: the undecided blocks (page, host, source, block, text) that substrings of several sources of the host cover."""
    k = rule.min_tokens
    # Blocks shorter than a substring are compared whole: their suffix is the block itself.
    starts = F.sequence(F.lit(0), F.greatest(F.size("tokens") - k, F.lit(0)))

    def suffix(i: Column) -> Column:
        prefix = F.slice("tokens", i + 1, k)
        return F.struct(i.alias("at"), F.xxhash64("host", prefix).alias("k1"), F.xxhash64(prefix, "host").alias("k2"))

    suffixes = undecided.withColumn("tokens", F.split("text", " ")).select(
        "page", "source", "block", F.size("tokens").alias("n"), F.explode(F.transform(starts, suffix)).alias("s")
    )
    suffixes = suffixes.select("page", "source", "block", "n", "s.at", "s.k1", "s.k2")
    runs = suffixes.groupBy("k1", "k2", "source").agg(F.lit(1).alias("one")).groupBy("k1", "k2").agg(F.count("*").alias("sources"))
    repeated = suffixes.join(runs.where(F.col("sources") >= rule.min_pages), ["k1", "k2"], "left_semi")
    places = F.explode(F.sequence("at", F.least(F.col("at") + (k - 1), F.col("n") - 1)))
    covered = repeated.select("page", "block", "n", places.alias("token")).distinct().groupBy("page", "block").agg(F.count("*").alias("hit"), F.first("n").alias("n"))
    return covered.where(100 * F.col("hit") > rule.covered * F.col("n")).select("page", "block")


def main_text(pages: DataFrame, rule: Repeats = Repeats(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text of every page."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "pages")
    cut = narrow(pages, page_id=id_col, url=url_col, page=html_col).select("page_id", "url", page_blocks(F.col("page")).alias("blocks"))
    cut.write.parquet(f"{folder}/blocks")
    stored = spark.read.parquet(f"{folder}/blocks").withColumn("page", F.struct("page_id", F.xxhash64("url", "blocks").alias("hash")))
    is_open = lambda b: b["open"]
    is_undecided = lambda b: b["open"] | b["apart"]
    numbered = F.filter(F.transform("blocks", lambda b, i: F.struct(i.alias("block"), b["text"].alias("text"), b["open"].alias("open"), b["apart"].alias("apart"))), is_undecided)
    # An article is the same source whatever stands around it.
    article = F.xxhash64(F.filter("blocks", lambda b: ~is_open(b)))
    undecided = stored.where(F.exists("blocks", is_undecided)).select(
        "page", host_of(F.col("url")).alias("host"), article.alias("article"), F.xxhash64("blocks").alias("whole"), F.inline(numbered)
    )
    undecided = undecided.withColumn("source", F.when(F.col("open"), F.col("whole")).otherwise(F.col("article")))
    gone = boilerplate_blocks(undecided, rule).groupBy("page").agg(F.collect_list("block").alias("gone"))
    gone.write.parquet(f"{folder}/gone")
    rest = F.filter("blocks", lambda b, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    decided = stored.join(spark.read.parquet(f"{folder}/gone"), "page", "left").withColumn("rest", rest)
    return decided.select("page_id", "url", F.array_join("rest.text", " ").alias("text"))
