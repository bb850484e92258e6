"""Main text of web pages with site-template removal.

Method: every page's element subtrees are hashed; Spark counts with how many different contents
(article text, or all kept text where a page has no article) each hash occurs on a host; subtrees
that recur with several are templates and are deleted. Copies of a page or an article count once.
What is a menu, header, footer, sidebar, notice, advert, form, script, style or reader comment by
its element is left out too, recurring or not, and so are containers whose role, id or one of whose class
names says so as a whole: every word of the name is a mark or goes with one (``ad-slot``, ``comment-list``),
so ``share-price`` and ``related-work`` are no marks. Headings, paragraphs, list items, cells and quotes are
judged by class names alone, and only by one that is a single mark. Of the rest, the
article (or main) elements are the text, or the body where a page has none. Paragraph-like
blocks inside an article are never templates: two pages may carry the same article.

Text: character references decoded, white space in a block as one space, trimmed, blocks in page
order joined by one newline; nothing else is dropped or cut.

Scale: only (page, host, hash, content) rows and counts move; the recurring hashes are sent to the
tasks when they were counted to be few, else each page's own hashes are joined to it. A host with
a third of all pages is counted with map-side sums, no host is gathered anywhere.

Defined results: null or empty html: empty text, 0 characters; null or odd urls share the host
""; a page whose article would be empty only because of deleted templates keeps them; repeated
rows each get the same result; null ids are kept; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, order_hash, require

#: A subtree is a template of its host from this many pages of different content on.
MIN_PAGES = 3

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg annotation annotation-xml xmp noembed noframes".split())
BLOCK = frozenset(("html body p div section article main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
                   "caption blockquote pre figure figcaption address hr header footer nav aside form fieldset details summary "
                   "menu dialog center hgroup search").split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody thead caption figcaption".split())
LEFT_OUT = frozenset(("head nav footer aside form menu dialog button select option object canvas audio video map "
                      "datalist search fieldset").split()) | RAW
#: Words in class, id or role names that mark a part that is not the article.
MARKS = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
                   "gdpr notice notification alert nav navbar navigation menu sidebar footer breadcrumb breadcrumbs comment comments "
                   "disqus replies share sharing social related recommended newsletter subscribe subscription popup modal overlay "
                   "widget masthead toolbar pager pagination complementary contentinfo dialog skip login signup").split())
#: Words that go with a mark in one name without changing what it says.
PARTNERS = frozenset(("area article articles bar block body bottom box button buttons close column container content copy footer form global group "
                      "header icon icons inline inner item items js layer layout left link links list main message mobile module outer "
                      "page panel placeholder policy post posts primary reading right row secondary section site slot small sticky stories text thread "
                      "title toggle top unit widgets wrap wrapper zone").split())
#: Left out only outside an article, where an article's own header holds its heading.
OUTER_MARKS = frozenset(["header"])
#: Start tags that end an open element of the same row of names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                 r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>", re.S)
#: Attributes one after the other, so that a quoted value is never searched for names.
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?|[\"'/=]")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORDS = re.compile(r"[^\W\d_]+")


def _says_so(name: str, marks: frozenset) -> bool:
    """Whether a class, id or role name as a whole marks a part that is not the article."""
    found = WORDS.findall(CAMEL.sub("-", name).lower())
    return any(w in marks for w in found) and all(w in marks or w in PARTNERS for w in found)


def _marked(attrs: str, in_article: bool, flow: bool = False) -> bool:
    """Whether class, id, role or visibility say that this element is not part of the article.

    ``flow``: the element is a paragraph, heading, list item, cell or quote.
    """
    marks = MARKS if in_article else MARKS | OUTER_MARKS
    for m in ATTRIBUTE.finditer(attrs):
        if not m[1]:
            continue
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and "display:none" in value.lower().replace(" ", ""):
            return True
        if flow:
            if name == "class" and any(x in marks for x in value.lower().split()):
                return True
        elif name in ("class", "id", "role") and any(_says_so(x, marks) for x in value.split()):
            return True
    return False


class Page:
    """One pass over a page: text blocks with the hashes of the subtrees they stand in."""

    def __init__(self, html: str) -> None:
        #: (text, inside an article, subtree numbers) of every kept block, in page order.
        self.blocks: list[tuple[str, bool, tuple[int, ...]]] = []
        self.hashes: list[int] = []
        self._run(html)

    def _run(self, html: str) -> None:
        stack: list[tuple[str, int, int, bool, bool]] = []  # name, start, subtree number or -1, left out, article
        text: list[str] = []
        out = article = 0  # open elements that are left out, and that are articles
        at = 0

        def flush() -> None:
            if text:
                block = " ".join(unescape("".join(text)).split())
                text.clear()
                if block:
                    self.blocks.append((block, article > 0, tuple(e[2] for e in stack if e[2] >= 0)))

        def close(n: int, end: int) -> None:
            """Close the open elements from number n on."""
            nonlocal out, article
            while len(stack) > n:
                name, start, number, left_out, is_article = stack.pop()
                if number >= 0:
                    self.hashes[number] = xxhash.xxh3_64_intdigest(f"{name}>{html[start:end]}") >> 1
                out -= left_out
                article -= is_article

        def last(names, stop) -> int:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in names:
                    return i
                if stack[i][0] in stop:
                    break
            return -1

        pos = 0
        while True:
            m = TAG.search(html, pos)
            piece = html[at:m.start() if m else len(html)]
            if piece and not out:
                text.append(piece)
            if not m:
                break
            at = pos = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA[") and not out:
                    text.append(m[0][9:].removesuffix("]]>"))
                continue
            if m[1] or m[4]:  # an end tag
                i = last({name}, ())
                if name in BLOCK and not out:
                    flush()
                if i >= 0:
                    if any(e[0] in BLOCK for e in stack[i:]) and not out:
                        flush()
                    close(i, m.start())
                continue
            attrs = m[3] if m[2] else m[6]
            if name == "br" or name == "wbr":
                if name == "br" and not out:
                    text.append(" ")
                continue
            if name in ("article", "main") and out:  # a part left out that was never closed
                close(next(i for i, e in enumerate(stack) if e[3]), m.start())
            if name in BLOCK:
                if not out:
                    flush()
                if name in CLOSES:
                    i = last(CLOSES[name], ("ul", "ol", "dl", "table", "article", "main", "section"))
                else:
                    i = last({"p"}, ("article", "main", "section", "div", "td", "li", "blockquote", "body"))
                if i >= 0:
                    close(i, m.start())
            if name in VOID or attrs.endswith("/"):
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, pos)
                at = pos = end.end() if end else len(html)
                continue
            is_article = name in ("article", "main") or (name in BLOCK and "main" in attrs and bool(
                re.search(r"\brole\s*=\s*[\"']?main\b", attrs, re.I)))
            left_out = name in LEFT_OUT or (name == "header" and not article) or (
                name not in ("html", "body") and bool(attrs) and _marked(attrs, article > 0, name in FLOW))
            number = -1
            if name in BLOCK and name not in ("html", "body") and not is_article and not (article and name in FLOW) and not out:
                number = len(self.hashes)
                self.hashes.append(0)
            is_article = is_article and not left_out
            stack.append((name, m.end(), number, left_out, is_article))
            out += left_out
            article += is_article
        flush()
        close(0, len(html))

    def content(self) -> int:
        """Hash of the main text with nothing deleted."""
        return xxhash.xxh3_64_intdigest(self.text(set()).encode("utf-8", "surrogatepass")) >> 1

    def text(self, templates: set[int]) -> str:
        scope = [b for b in self.blocks if b[1]] or self.blocks
        kept = [t for t, _, inside in scope if not any(self.hashes[i] in templates for i in inside)]
        return "\n".join(kept or [t for t, _, _ in scope])


def subtrees(pages: DataFrame) -> DataFrame:
    """(key, host, content, h): each distinct subtree hash of every page. ``pages``: key, host, html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(2)
            parsed = [Page(html[i].as_py() or "") for i in range(batch.num_rows)]
            found = pa.array([sorted(set(p.hashes)) for p in parsed], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p.content() for p in parsed], pa.int64()), found],
                names=["key", "host", "content", "h"])

    found = pages.select("key", "host", "html").mapInArrow(run, "key long, host long, content long, h array<long>")
    return found.select("key", "host", "content", F.explode("h").alias("h"))


def templates(found: DataFrame, min_pages: int) -> DataFrame:
    """(host, h) of the subtrees that recur with many contents of their host."""
    counts = found.select("host", "h", "content").distinct().groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_pages).select("host", "h")


def main_text(pages: DataFrame, html: str = "html", url: str = "url", page_id: str = "page_id", min_pages: int = MIN_PAGES,
              send_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    require(pages, html, url, page_id)
    body, link = F.col(f"`{html}`").cast("string"), F.col(f"`{url}`").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(link, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), link.alias("url"), order_hash(host).alias("host"),
                        order_hash(F.col(f"`{page_id}`"), link, body).alias("key"), body.alias("html"))
    found = materialize(subtrees(rows), "html-subtrees")
    recurring = materialize(templates(found, min_pages), "html-templates")
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def extract(batch: pa.RecordBatch, sets) -> pa.RecordBatch:
        source = batch.column(2)
        text = [Page(source[i].as_py() or "").text(sets(i)) for i in range(batch.num_rows)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()),
                                           pa.array([len(t) for t in text], pa.int64())],
                                          names=["page_id", "url", "text", "n_chars"])

    few = recurring.limit(send_rows + 1).collect() if send_rows else []
    if send_rows and len(few) <= send_rows:
        by_host: dict[int, set[int]] = {}
        for r in few:
            by_host.setdefault(r["host"], set()).add(r["h"])
        shared = pages.sparkSession.sparkContext.broadcast(by_host)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hosts = batch.column(3).to_pylist()
                yield extract(batch, lambda i: shared.value.get(hosts[i], set()))

        return rows.select("page_id", "url", "html", "host").mapInArrow(run, schema)
    own = materialize(found.join(recurring, ["host", "h"]).groupBy("key").agg(F.collect_set("h").alias("own")), "html-own")

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column(3).to_pylist()
            yield extract(batch, lambda i: set(sets[i] or ()))

    return rows.join(own, "key", "left").select("page_id", "url", "html", "own").mapInArrow(run_joined, schema)
