"""Main-text extraction by template deduction over the pages of a host.

Tokens are the markup tags of a page, told apart by the path of open elements, and the blocks of text
between them, told apart by path and wording.  The occurrence
vector of a token lists how often it occurs on each page of the host; tokens
with one vector form an equivalence class.  Classes that are large and occur on many
pages belong to the template that the pages were made from.  Vectors are
compared through an exclusive-or of (page, count) hashes, so a class is a grouped
aggregate and no host's pages ever meet in one task.  Copies of a page count once.

Classes are nested by their paths: the tags of a class open and close in order, and the
class whose tags lie inside another's slot is its child.  A block of text whose vector is that of a valid class is
part of the template; what varies fills the slots.  The main slot of a host is the article
element if its template has one, else the innermost region, once on each page, that holds half of the varying text and of the main
headings; a region named as content goes before others that hold as much.  The
text of a page is what fills the main slot, without template text and without the regions that are navigation, advert, comment or
the like by element or by name: adverts and comments vary from page to page as articles do, so no vector tells them apart.

Text in an article element is never dropped for being repeated, so copies of
pages and shared passages stay whole; elsewhere a block goes if it is once on every page that has the class's tags, on
at least ``MIN_PAGES`` different pages.  A host whose pages are all near copies of one page without an article
element loses what they share.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, named, slices, written

#: a token is in the template when it occurs on at least this share of its host's pages
SUPPORT = 0.5
#: text is in the template when its class has at least this many tags and it occurs on at least this many different pages
MIN_CLASS, MIN_PAGES = 2, 4
#: longer paths and labels are written as a digest, so that deep nesting takes linear space
PATH_CHARS, LABEL_CHARS = 512, 160
#: fixed values: elements whose content is not text, or not part of the article
SILENT = {"script", "style", "noscript", "template", "svg", "head", "title", "iframe", "object", "canvas", "math", "select", "textarea"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
#: fixed values: elements without content
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: fixed values: elements that do not break a line of text
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr", "img"}
#: fixed values: words of class, id and role that name a region outside the article
REGION_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
                "comments", "complementary", "contentinfo", "cookie", "cookies", "consent", "disqus", "footer", "gdpr", "header", "menu",
                "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "promoted", "promotion",
                "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
                "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget"}
#: fixed values: last words of a name that say nothing of their own; the word before them decides ("ad-slot", "related-posts")
HOLDER_WORDS = {"area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container", "content",
                "form", "frame", "group", "icon", "icons", "inner", "item", "items", "left", "link", "links", "list", "message", "module",
                "outer", "overlay", "panel", "posts", "primary", "region", "results", "right", "row", "secondary", "section", "slot", "stories",
                "text", "title", "top", "unit", "wrap", "wrapper", "zone"}
#: fixed values: elements that hold one block of text; they are no slots of a template
TEXT_BLOCKS = {"blockquote", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "p", "pre", "td", "th"}
#: fixed values: words of class, id and role that name the article where no article element does
MAIN_WORDS = {"article", "content", "entry", "main", "post", "story"}

_TOKEN = re.compile(r"<(?:/?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z))", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_HIDDEN = re.compile(r"\shidden(?=[\s/>=])")
_RAW = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for n in ("script", "style", "textarea", "title")}
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z]+")
#: fixed values: an opening tag of the key closes an open element of the value (end tags that may be left out)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tbody", "tr", "td"}, "tbody": {"thead", "tbody", "tr", "td"}}
#: fixed values: elements that end an open paragraph
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4",
          "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def outside(name: str) -> bool:
    """Whether a class, id or role names a region outside the article.  The last word decides, as in any compound:
    a "cookie-notice" is a notice, a "notice-period" is not; words such as "slot" or "list" are passed over."""
    parts = _PART.findall(name)
    while parts and parts[-1] in HOLDER_WORDS:
        parts.pop()
    return bool(parts) and parts[-1] in REGION_WORDS


class Region:
    """An open element: its path of labels (names with class, id and role), its nearest block element and
    how many of these are around it, whether its text is
    outside the article by element or name, and whether it is in an article element."""

    __slots__ = ("article", "block", "depth", "name", "out", "path")

    def __init__(self, parent: Region | None, name: str, attributes: str):
        keyed = []
        hidden = named_out = False
        for key, value in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key in ("class", "id", "role"):
                value = value.strip("\"'").lower()
                keyed.append(f"{key}={_SPACE.sub(' ', re.sub(r'[0-9]+', '#', value))}")
                named_out = named_out or any(map(outside, value.split()))
            hidden = hidden or (key == "aria-hidden" and "true" in value.lower())
        hidden = hidden or bool(_HIDDEN.search(attributes))
        around = parent.path if parent else ""
        label = "[".join([name, *sorted(keyed)]).replace("/", "|")
        if len(label) > LABEL_CHARS:
            label = f"{label[:LABEL_CHARS - 33]}~{_digest(label)}"
        inline = name in INLINE
        self.name = name
        self.path = around if inline else f"{around}/{label}" if around else label
        if len(self.path) > PATH_CHARS:
            self.path = f"~{_digest(around)}/{label}"
        self.block = parent.block if inline and parent else self
        self.depth = (parent.depth if parent else 0) + (not inline)
        self.article = name == "article" or bool(parent and parent.article)
        self.out = bool(parent and parent.out) or hidden or name in SILENT or name in BOILERPLATE or (
            named_out and name not in ("html", "body", "article", "main"))


#: regions repeat from page to page; the table is bounded
region = lru_cache(maxsize=1 << 15)(Region)


class Open:
    """The open elements of a page, with the places of each name and of the blocks, so that no tag looks through the whole stack."""

    def __init__(self):
        self.stack: list[Region] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def top(self) -> Region | None:
        return self.stack[-1] if self.stack else None

    def push(self, place: Region) -> None:
        at = len(self.stack)
        self.stack.append(place)
        self.places.setdefault(place.name, []).append(at)
        if place.name not in INLINE:
            self.blocks.append(at)

    def pop(self) -> Region:
        place = self.stack.pop()
        self.places[place.name].pop()
        if place.name not in INLINE:
            self.blocks.pop()
        return place

    def last(self, name: str) -> int:
        """Place of the innermost element of a name, -1 if none is open; an inline one counts only inside the innermost block."""
        found = self.places.get(name)
        at = found[-1] if found else -1
        return at if name not in INLINE or not self.blocks or at > self.blocks[-1] else -1


def walk(page: str | None) -> Iterator[tuple[str, str, Region | None]]:
    """("text", string, region around), ("open", name, the new region), ("close", name, the region that ends)
    and ("break", name, region around) in page order."""
    page = page or ""
    opened = Open()
    pos = 0
    while True:
        top = opened.top()
        if top and top.name in _RAW:  # everything up to the element's own end tag is content
            end = _RAW[top.name].search(page, pos)
            yield "close", top.name, opened.pop()
            if not end:
                return
            pos = end.end()
            continue
        at = page.find("<", pos)
        m = _TOKEN.match(page, at) if at >= 0 else None
        while at >= 0 and not m:  # a lone < is text
            at = page.find("<", at + 1)
            m = _TOKEN.match(page, at) if at >= 0 else None
        text = page[pos:at] if m else page[pos:]
        if text:
            yield "text", text, top
        if not m:
            return
        pos = m.end()
        tag = m.group()
        if tag[1] in "!?":
            continue
        named_at = _NAME.match(tag)
        name = named_at.group(1).lower()
        close_from = len(opened.stack)
        if tag[1] == "/":
            at = opened.last(name)  # an inline end tag does not close the block around it
            if at >= 0:
                close_from = at
            elif name not in INLINE:
                yield "break", name, top
        elif name in ENDS_P:
            if opened.blocks and opened.stack[opened.blocks[-1]].name == "p":
                close_from = opened.blocks[-1]
        elif name in CLOSES:
            while close_from and opened.stack[close_from - 1].name in CLOSES[name]:
                close_from -= 1
        while len(opened.stack) > close_from:
            yield "close", opened.stack[-1].name, opened.pop()
        if tag[1] == "/":
            continue
        if name in VOID or (tag.endswith("/>") and name in SILENT):
            yield "break", name, opened.top()
            continue
        opened.push(region(opened.top(), name, tag[named_at.end():]))
        yield "open", name, opened.top()


def blocks(page: str | None) -> Iterator[tuple[str, str, Region | None]]:
    """("open", "", region) and ("close", "", region) of block elements, ("block", text, region) of blocks of
    text that are not outside the article; references decoded, white space as one space."""
    line: list[str] = []
    where: Region | None = None

    def ended() -> str:
        text = _SPACE.sub(" ", entities.unescape("".join(line))).strip() if line else ""
        line.clear()
        return text

    for kind, value, place in walk(page):
        if kind == "text":
            if place is None or not place.out:
                if not line:
                    where = place
                line.append(value)
        elif value not in INLINE or value == "br":
            if text := ended():
                yield "block", text, where
            if kind != "break" and value not in INLINE:
                yield kind, "", place
    if text := ended():
        yield "block", text, where


def text_token(text: str, place: Region | None) -> str:
    """A block of text as a token: a digest of path and wording."""
    return "\t" + _digest(f"{place.path if place else ''}\t{text}")


def page_tokens(page: str | None, template: frozenset = frozenset()) -> list[tuple[str, bool, int, int, int, int]]:
    """(token, whether a tag, times, depth, characters of text inside, characters of main headings inside) of a page.
    Text of the ``template`` is not counted; text in article elements is no token."""
    times: Counter = Counter()
    inside: dict[str, list[int]] = {}
    texts: Counter = Counter()
    held: list[list] = []

    def leave() -> None:
        place, n, heads = held.pop()
        sums = inside.setdefault(place.path, [place.depth, 0, 0])
        sums[1] += n
        sums[2] += heads
        if held:
            held[-1][1] += n
            held[-1][2] += heads

    for kind, value, place in blocks(page):
        if kind == "open":
            times[place.path] += 1
            held.append([place, 0, 0])
        elif kind == "close":
            leave()
        else:
            token = None if place and place.article else text_token(value, place)
            if token:
                texts[token] += 1
            if held and token not in template:
                held[-1][1] += len(value)
                held[-1][2] += len(value) * (place.block.name == "h1")
    while held:
        leave()
    return [(p, True, n, *inside[p]) for p, n in times.items()] + [(t, False, n, 0, 0, 0) for t, n in texts.items()]


_FIELDS = ("token string", "tag boolean", "times long", "depth int", "chars long", "heads long")


def _tokens(page: Column, template: Column) -> Column:
    @F.pandas_udf(f"array<struct<{','.join(f.replace(' ', ':') for f in _FIELDS)}>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        names = [f.split()[0] for f in _FIELDS]
        for pages, templates in slices(batches):
            yield pd.Series([[dict(zip(names, t, strict=True)) for t in page_tokens(p, frozenset(() if k is None else k))]
                             for p, k in zip(pages, templates, strict=True)], dtype=object)
    return run(page, template)


def host(url: Column) -> Column:
    """Host of an address in lower case; null and odd addresses share the empty host."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def _page_rows(pages: DataFrame, template: Column) -> DataFrame:
    """One row per (host, different page, token)."""
    rows = pages.select("host", F.xxhash64("html").alias("page"), F.explode(_tokens(F.col("html"), template)).alias("t"))
    return rows.select("host", "page", "t.*").distinct()  # copies of a page are one page


def equivalence_classes(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(host, token, tag, vector, class_size, pages, host_pages, once, depth, chars, heads) of the template:
    tokens on at least ``support`` of the host's different pages, with the number of tags that share their vector.  ``chars`` and ``heads``
    count the text and the main headings inside a tag that are not of the template."""
    none = F.array().cast("array<string>")
    per = _page_rows(pages, none).groupBy("host", "token", "tag").agg(
        F.bit_xor(F.xxhash64("page", "times")).alias("vector"), F.count("*").alias("pages"), (F.max("times") == 1).alias("once"),
        F.max("depth").alias("depth"), F.sum("chars").alias("chars"), F.sum("heads").alias("heads"))
    total = pages.select("host", F.xxhash64("html").alias("page")).distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    frequent = written(per.join(total, "host").where(F.col("pages") >= support * F.col("host_pages")), "template-tokens")
    size = frequent.where("tag").groupBy("host", "vector").agg(F.count("*").alias("class_size"))
    classes = frequent.join(size, ["host", "vector"], "left").na.fill(0, ["class_size"])
    # on hosts with template text the characters inside the tags are counted again without it
    varying = _page_rows(pages.join(template_texts(classes), "host"), F.col("texts")).where("tag").groupBy("host", "token").agg(
        F.sum("chars").alias("varying"), F.sum("heads").alias("varying_heads"))
    out = written(classes.join(varying, ["host", "token"], "left").select(
        "host", "token", "tag", "vector", "class_size", "pages", "host_pages", "once", "depth",
        F.coalesce("varying", "chars").alias("chars"), F.coalesce("varying_heads", "heads").alias("heads")), "template-classes")
    discard(pages.sparkSession, frequent)
    return out


def template_texts(classes: DataFrame) -> DataFrame:
    """(host, texts): blocks of text that are in a valid class.  What is on most pages of a host is bounded by the size of a page."""
    valid = ~F.col("tag") & F.col("once") & (F.col("class_size") >= MIN_CLASS) & (F.col("pages") >= MIN_PAGES)
    return classes.where(valid).groupBy("host").agg(F.sort_array(F.collect_set("token")).alias("texts"))


def main_slots(classes: DataFrame) -> DataFrame:
    """(host, slot): the path of each host's main slot.

    Article elements win; else, of the regions that are once on each page and hold at least half of the host's varying text and
    main headings, the outermost one named as content, else the innermost."""
    t = classes.where("tag").select("host", "token", "once", "depth", "chars", "heads")
    total = t.groupBy("host").agg(F.max("chars").alias("all_chars"), F.max("heads").alias("all_heads"))
    own = t.join(total, "host")
    last = F.element_at(F.split("token", "/"), -1)
    name = F.split(last, r"\[")[0]
    named_main = F.lower(last).rlike(r"(=|[^a-z0-9])(" + "|".join(sorted(MAIN_WORDS)) + r")([^a-z0-9]|$)")
    holds = (F.col("once") & ~name.isin(*sorted(TEXT_BLOCKS)) & (2 * F.col("chars") >= F.col("all_chars"))
             & (2 * F.col("heads") >= F.col("all_heads")))
    rank = F.when(name == "article", 3).when(holds & ((name == "main") | named_main), 2).when(holds, 1).otherwise(0)
    order = F.struct(rank.alias("rank"), F.when(rank >= 2, -F.col("depth")).otherwise(F.col("depth")).alias("depth"), "chars", "token")
    best = own.where((rank > 0) & (F.col("chars") > 0)).groupBy("host").agg(F.max(order).alias("best"))
    return best.select("host", F.col("best.token").alias("slot"))


def main_text(page: str | None, slot: str | None, template: frozenset = frozenset()) -> str:
    """Text that fills the main slot of the host's template; of a page that does not have it, the
    text of its article elements; of a page without either, the text of its body.  Text of the ``template`` is left out."""
    found: tuple[list[str], list[str], list[str]] = ([], [], [])
    inside = 0  # open blocks from the slot inwards
    for kind, value, place in blocks(page):
        if kind == "open":
            inside += bool(inside) or place.path == slot
        elif kind == "close":
            inside -= bool(inside)
        elif not template or (place and place.article) or text_token(value, place) not in template:
            for wanted, texts in zip((inside > 0, bool(place and place.article), True), found, strict=True):
                if wanted:
                    texts.append(value)
    return "\n".join(next((texts for texts in found if texts), []))


@F.pandas_udf(T.StringType())
def _main_text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for part in slices(batches):
        yield pd.Series([main_text(p, s, frozenset(() if k is None else k)) for p, s, k in zip(*part, strict=True)], dtype=object)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``pages``: id, url, text (empty if none).

    Null and empty pages give an empty text; pages without a host form the group of
    the empty host; a host with one page has that page as its template; rows that repeat are pages of their own;
    texts of any length and nesting of any depth are read whole, in
    linear time; an empty table gives no rows; further columns are not read."""
    rows = pages.select(named(pages, id_col).alias("id"), named(pages, url_col).alias("url"), named(pages, html_col).alias("html"))
    rows = rows.withColumn("host", host(F.col("url")))
    classes = equivalence_classes(rows, support)
    slots = written(main_slots(classes).join(template_texts(classes), "host", "full"), "main-slots")
    discard(pages.sparkSession, classes)
    j = rows.join(slots, "host", "left")
    (out_text,) = fresh(rows, "text")
    return j.select(F.col("id").alias(id_col), F.col("url").alias(url_col), _main_text("html", "slot", "texts").alias(out_text))
