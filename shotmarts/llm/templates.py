"""Main text of web pages, with site templates removed.

Pages are parsed into elements. Each element subtree that could be part of a template is hashed,
and Spark counts in how many different pages of its host it occurs. Subtrees that recur are deleted
from the pages of that host. What HTML itself marks as no article (navigation, headers, footers,
asides, forms, scripts, and elements named as adverts, notices or comments) goes as well, so that
hosts with few pages come out clean too. If a page has articles, its text is theirs.

An element that its tag, role or name marks is judged once the page is read: it stays if it holds the
page's articles (a ``main``, or articles with no unmarked one elsewhere or most of the articles' text)
or most of its running text. Articles inside an article, such as comments, do not make it stay.

Within an article a paragraph, heading, list or quotation is content even if other pages have it,
so only neutral boxes (``div``, ``section``, ``table``) count there, and an element that holds the
article is never a template. Pages with equal articles count once: copies are no template.

Defined cases: a NULL html is empty and gives an empty text; a NULL or odd url has the host ``""``;
repeated rows are extracted each; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option "
    "p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body head html option tbody td tfoot th thead tr".split())
#: An opening tag ends an open element of these, if nothing in the second set lies between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that are no part of an article.
OUTSIDE = frozenset(
    "head nav footer aside form script style noscript iframe template svg math button select textarea "
    "object audio video canvas dialog menu search title xmp noembed noframes datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Those of them that can lie around an article, and are judged by what they hold.
AROUND = frozenset("head nav header footer aside form dialog menu search".split())
#: Blocks whose own text is no running text.
SHORT = AROUND | frozenset("h1 h2 h3 h4 h5 h6 hgroup li dt dd th option legend summary figcaption".split())
#: Words of a class or id that name something other than an article.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion"
    r"|banner|cookie|cookies|consent|gdpr|notice|notices|popup|modal|overlay|newsletter|subscribe"
    r"|subscription|signup|paywall|aside|widget|nav|navbar|navigation|menu|breadcrumb"
    r"|breadcrumbs|pagination|pager|footer|share|sharing|social|related|recommended"
    r"|comment|comments|commentlist|disqus|respond|replies|reactions)(?=$|[\s_-])"
    # These are whole tokens only: layouts are named has-sidebar or side-by-side.
    r"|(?:^|\s)(?:sidebar|side)(?=$|\s)"
)
#: The like for what stands before an article; inside one it may hold the title.
TOPS = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?=$|[\s_-])")
#: Boxes that may be a template inside an article; outside one any block may.
BOXES = frozenset("div section table fieldset details figure".split())
HOLDERS = frozenset("html body article main".split())

TAG = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACE = re.compile(r"\s+")
PAGE_SCHEMA = (
    "host string, content long, subtrees array<long>, "
    "blocks array<struct<text: string, within: array<int>>>"
)


def host_of(url: str | None) -> str:
    found = re.match(r"[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def not_article(tag: str, attributes: str, in_article: bool) -> str:
    """``"never"`` for what is no text at all, ``"marked"`` for what tag, role or name call no
    article, else ``""``."""
    marked = ""
    if tag in OUTSIDE or (tag == "header" and not in_article):
        if tag not in AROUND:
            return "never"
        marked = "marked"
    if not attributes or tag in HOLDERS:
        return marked
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "never"
        if name == "style" and HIDDEN.search(value):
            return "never"
        if name == "role" and value in ROLES:
            marked = "marked"
        if name in ("class", "id") and (NAMES.search(value) or not in_article and TOPS.search(value)):
            marked = "marked"
    return marked


class Mark:
    """A marked element: whether it is inside an article, and what it holds."""

    def __init__(self, inside: bool) -> None:
        self.inside = inside
        self.main = self.article = False
        self.article_text = self.running_text = 0


class Block(NamedTuple):
    text: str
    #: Subtrees that it lies in.
    within: list[int]
    in_article: bool
    marks: tuple[Mark, ...]


class Element(NamedTuple):
    tag: str
    start: int
    dropped: bool
    in_article: bool
    #: Number of the subtree, or -1.
    number: int
    #: Marked elements around, and itself if marked.
    marks: tuple[Mark, ...]


class Page:
    """Blocks of text of a page, and the hashed subtrees that each lies in."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.stack: list[Element] = []
        #: Start and end, and the marks around.
        self.places: list[tuple[int, int, tuple[Mark, ...]]] = []
        self.subtrees: list[int] = []
        self.blocks: list[Block] = []
        self.marks: list[Mark] = []
        #: Whether an article or main element is in no marked element.
        self.free_article = False
        self.article_text = self.running_text = 0
        self.text: list[str] = []
        self.parse()

    def parse(self) -> None:
        source, at = self.source, 0
        while found := TAG.search(source, at):
            self.add(source[at : found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                self.close(tag, found.start(), found.end())
                continue
            self.open(tag, found[3], found.start())
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|$)", re.I).search(source, at)
                at = end.start() if end else len(source)
        self.add(source[at:])
        while self.stack:
            self.pop(len(source))
        self.judge()

    def judge(self) -> None:
        """Drops the blocks in marked elements that do not stay, and hashes the other subtrees."""
        gone = {id(m) for m in self.marks if not self.stays(m)}
        self.blocks = [b for b in self.blocks if not any(id(m) in gone for m in b.marks)]
        numbers = {}
        for k, (start, end, marks) in enumerate(self.places):
            if not any(id(m) in gone for m in marks):
                numbers[k] = len(self.subtrees)
                inside = SPACE.sub(" ", self.source[start:end])
                self.subtrees.append(xxhash.xxh3_64_intdigest(inside) - (1 << 63))
        self.blocks = [b._replace(within=[numbers[k] for k in b.within]) for b in self.blocks]

    def stays(self, mark: Mark) -> bool:
        if mark.main or mark.article:
            if mark.inside:
                return False
            return mark.main or not self.free_article or 2 * mark.article_text > self.article_text
        return 2 * mark.running_text > self.running_text

    def add(self, text: str) -> None:
        if text and not (self.stack and self.stack[-1].dropped):
            self.text.append(text)

    def flush(self) -> None:
        if self.text:
            text = SPACE.sub(" ", entities.unescape("".join(self.text))).strip()
            self.text = []
            if text:
                top = self.stack[-1] if self.stack else Element("", 0, False, False, -1, ())
                within = [s.number for s in self.stack if s.number >= 0]
                self.blocks.append(Block(text, within, top.in_article, top.marks))
                nearest = next((s.tag for s in reversed(self.stack) if s.tag in BLOCK), "")
                running = 0 if nearest in SHORT else len(text)
                for held in (self, *top.marks):
                    held.running_text += running
                    held.article_text += len(text) if top.in_article else 0

    def open(self, tag: str, attributes: str, start: int) -> None:
        if tag in CLOSES_P:
            self.end_implied({"p"}, {"button", "td", "th", "table", "div", "article", "section", "li"}, start)
        if tag in IMPLIED:
            self.end_implied(*IMPLIED[tag], start)
        if tag == "br":
            self.add(" ")
        if tag in BLOCK:
            self.flush()
        if tag in VOID:
            return
        above = self.stack[-1] if self.stack else Element("", 0, False, False, -1, ())
        in_article = above.in_article or tag in ("article", "main")
        verdict = "never" if above.dropped else not_article(tag, attributes, above.in_article)
        dropped, marks = verdict == "never", above.marks
        if tag in ("article", "main") and not dropped:
            self.free_article |= not marks
            for mark in marks:
                mark.article |= tag == "article"
                mark.main |= tag == "main"
        if verdict and not above.dropped and tag not in BLOCK:
            self.add(" ")
        if verdict == "marked":
            marks = (*marks, Mark(any(s.tag == "article" for s in self.stack)))
            self.marks.append(marks[-1])
        number = -1
        if not dropped and tag not in HOLDERS and (tag in BOXES or tag in BLOCK and not above.in_article):
            number = len(self.places)
            self.places.append((start, start, marks))
        self.stack.append(Element(tag, start, dropped, in_article, number, marks))

    def end_implied(self, ends: set[str], borders: set[str], at: int) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].tag in ends:
                while len(self.stack) > k:
                    self.pop(at)
                return
            if self.stack[k].tag in borders:
                return

    def close(self, tag: str, start: int, end: int) -> None:
        if all(s.tag != tag for s in self.stack):
            return
        while self.stack[-1].tag != tag:
            self.pop(start)
        self.pop(end)

    def pop(self, end: int) -> None:
        top = self.stack[-1]
        if top.tag in BLOCK:
            self.flush()
        self.stack.pop()
        if top.number >= 0:
            self.places[top.number] = (top.start, end, top.marks)

    def main_blocks(self) -> list[Block]:
        if any(block.in_article for block in self.blocks):
            return [block for block in self.blocks if block.in_article]
        return self.blocks


def parse_pages(rows: list[dict]) -> Iterator[tuple]:
    for row in rows:
        page = Page(row["html"] or "")
        blocks = page.main_blocks()
        content = xxhash.xxh3_64_intdigest("\n".join(b.text for b in blocks)) - (1 << 63)
        yield (
            row["id"], row["page_id"], row["url"], host_of(row["url"]), content, page.subtrees,
            [(b.text, b.within) for b in blocks],
        )


def extract(pages: DataFrame, min_pages: int = 5) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` and ``n_removed`` blocks of every page.

    A subtree is a template when at least ``min_pages`` different pages of its host have it, and one
    more for each doubling of the host's different pages from ``5 * min_pages`` on.
    """
    ws = common.Workspace(pages.sparkSession, "templates")
    types = dict(pages.dtypes)
    schema = f"id long, page_id {types['page_id']}, url {types['url']}, {PAGE_SCHEMA}"
    numbered = pages.select(F.monotonically_increasing_id().alias("id"), "page_id", "url", "html")
    parsed = ws.store(common.map_rows(numbered, schema, parse_pages, rows=500), "parsed")

    different = parsed.groupBy("host", "content").agg(F.min("id").alias("id"))
    per_host = different.groupBy("host").agg(F.count("*").alias("n_pages"))
    subtrees = parsed.select("id", "host", "content", F.explode(F.array_distinct("subtrees")).alias("subtree"))
    # Equal articles count once: each (host, subtree, content) before the count.
    counted = subtrees.groupBy("host", "subtree", "content").agg(F.lit(1).alias("one"))
    counted = counted.groupBy("host", "subtree").agg(F.count("*").alias("n"))
    recurring = counted.where(F.col("n") >= min_pages).join(per_host, "host")
    more = F.greatest(F.lit(0.0), F.log2(F.col("n_pages") / (5 * min_pages)))
    recurring = recurring.where(F.col("n") >= min_pages + more).select("host", "subtree")
    of_page = subtrees.join(recurring, ["host", "subtree"]).groupBy("id").agg(
        F.collect_set("subtree").alias("templates")
    )
    kept = F.filter(
        "blocks",
        lambda b: ~F.exists(
            b["within"],
            lambda k: F.coalesce(F.array_contains("templates", F.get("subtrees", k)), F.lit(False)),
        ),
    )
    # Pages without a block in any such subtree have nothing to lose, and need not meet the templates.
    concerned = F.exists("blocks", lambda b: F.size(b["within"]) > 0)
    pages_left = parsed.where(~concerned).select("page_id", "url", "blocks", F.col("blocks").alias("kept"))
    cleaned = parsed.where(concerned).join(of_page, "id", "left").select(
        "page_id", "url", "blocks", kept.alias("kept")
    )
    text = F.array_join(F.transform("kept", lambda b: b["text"]), "\n")
    return (
        pages_left.unionByName(cleaned)
        .select("page_id", "url", text.alias("text"), (F.size("blocks") - F.size("kept")).alias("n_removed"))
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_removed")
    )
