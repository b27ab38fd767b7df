"""Main text of web pages by nearest-URL page differencing, with the page's own landmarks.

A page becomes blocks of text (lines) in page order. Pages of a host are put in order of their URL path, and each is paired with
the neighbour whose path has the longer common beginning. The two pages' lines are aligned by their longest common
subsequence, and shared lines are deleted as boilerplate.

Differencing alone is wrong in two ways: a passage that two articles quote is shared but content, and a page's own advert or
menu is not shared but boilerplate. So every page is paired and aligned, and then the markup guards the result where it speaks: lines inside the article (or, without one, main)
element are kept even if they are shared, and those in navigation, footers, asides, forms, scripts, notices, adverts and comments go even if
they are not. Shared lines are deleted among all others. Copies show no boilerplate: pages of a host with the same lines are one (at the first
of their URLs), and a neighbour that holds nearly all of a page's own text (its article, or else its plain lines), or whose own text the page
nearly holds (`NEARLY`, by characters), is passed over for the next one. Plain text of which nearly all is on every other page of the host is kept whole.

Null html is empty. A page without lines has an empty text. Rows may repeat and ids and urls may be null; pages without a url
are neighbours of one another. Ties of neighbours go to the earlier one in order.
"""

from __future__ import annotations

import html as markup
import itertools
import os.path
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.base import read
from tidewire.session import cut_lineage

# Fixed values of the markup language.
RAW = {"script", "style", "template", "noscript", "iframe", "textarea", "title", "svg", "select", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
# What surrounds an article, by element, role and words of a class or id.
CHROME = {"nav", "aside", "footer", "form", "button", "dialog", "menu", "head"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu"}
CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal",
    "newsletter", "subscribe", "signup", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "comment",
    "comments", "disqus", "replies", "related", "recommended", "share", "sharing", "social", "pagination", "widget",
}
PLAIN, ARTICLE, AROUND = 0, 1, 2

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


def is_chrome(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in CHROME or tag == "header" and not in_article:
        return True
    if not attributes.strip():
        return False
    if tag in ("html", "body", "article", "main"):
        return False
    values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    labels = values.get("class", "") + " " + values.get("id", "")
    names = set(labels.split() if in_article else re.split(r"[^a-z0-9]+", labels))  # inside an article only a whole name speaks
    hidden = values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")) or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes)
    return bool(values.get("role") in CHROME_ROLES or names & CHROME_WORDS or hidden)


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """(text, PLAIN, ARTICLE or AROUND) of each block with text, in order; lines of main count as article where no article is."""
    html = html or ""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    skipped: list[str] = []  # an open element around the article, and open ones of its name in it
    article = main = 0
    opened: set[str] = set()  # of article and main

    def close() -> None:
        text = " ".join(markup.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((text, AROUND if skipped else ARTICLE if article else PLAIN, main > 0))

    at = 0
    while at < len(html):
        found = _TAG.search(html, at)
        parts.append(html[at : found.start() if found else len(html)])
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag, ending = found[2].lower(), bool(found[1])
        if tag in RAW:
            if not ending and not found[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in INLINE and not (not ending and is_chrome(tag, found[3], article > 0)) and not (skipped and tag == skipped[0]):
            continue
        if tag == "br" or tag in VOID:
            parts.append(" ")
            continue
        close()
        if tag in ("article", "main") and not ending:
            # what is still open before the first article was left open; later ones in it are comments or teasers
            if tag not in opened and "article" not in opened and not _inside_comments(skipped):
                skipped.clear()
            if not skipped:
                opened.add(tag)
        if skipped:
            if tag == skipped[0]:
                skipped.pop() if ending else skipped.append(tag)
        elif not ending and is_chrome(tag, found[3], article > 0) and not found[3].endswith("/"):
            skipped.append(tag)
        elif tag == "article":
            article = max(0, article + (-1 if ending else 1))
        elif tag == "main":
            main = max(0, main + (-1 if ending else 1))
    close()
    if any(kind == ARTICLE for _, kind, _ in lines):
        return [(text, kind) for text, kind, _ in lines]
    return [(text, ARTICLE if kind == PLAIN and in_main else kind) for text, kind, in_main in lines]


def _inside_comments(skipped: list[str]) -> bool:
    """Whether an article that starts here belongs to what is skipped: sections and lists hold comments and teasers, others were left open."""
    return bool(skipped) and skipped[0] in ("section", "aside", "ul", "ol", "footer")


def line_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [page_lines(x) for x in batch["html"]]
        yield pd.DataFrame(
            {
                "page_id": batch["page_id"].astype("Int64"),
                "url": batch["url"],
                "texts": [[t for t, _ in x] for x in found],
                "kinds": [[k for _, k in x] for x in found],
            }
        )


def shared_lines(one: list[int], two: list[int]) -> list[int]:
    """Places in one of a longest common subsequence with two, by bits: a row's zero bits are where the length grows."""
    where: dict[int, int] = {}
    for j, line in enumerate(two):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(two)) - 1
    row, table = full, [full]
    for line in one:
        hit = row & where.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        table.append(row)
    length = lambda i, j: j - (table[i] & (1 << j) - 1).bit_count()
    i, j, found = len(one), len(two), []
    while i and j:
        if table[i] >> (j - 1) & 1:
            j -= 1
        elif length(i - 1, j) == length(i, j):
            i -= 1
        else:
            found.append(i - 1)
            i, j = i - 1, j - 1
    return found[::-1]


#: Pages of a part at about most: a task holds one part's lists.
PART = 20_000
#: Pages are taken for copies if one holds at least so many of 100 characters of the other.
NEARLY = 80


def own_text(page: dict) -> list[tuple[int, int]]:
    """The lines by which copies are told, with their sizes: those of the article, else the plain ones, else all."""
    kind = next((k for k in (ARTICLE, PLAIN) if k in page["kinds"]), None)
    return [(line, n) for line, k, n in zip(page["lines"], page["kinds"], page["sizes"]) if kind in (k, None)]


class Stretch:
    """Consecutive pages of one host, in order. Walks back from a place over the copies of a page.

    For each line of a page it is known how long all pages before have had it too, so a walk leaps over all pages that hold
    what the one before them holds, and a run of copies costs a step or two.
    """

    def __init__(self, pages: list[dict]):
        self.pages, self.since = pages, []
        last: dict[int, int] = {}
        for page in pages:
            last = {line: last.get(line, len(self.since)) for line in page["lines"]}
            self.since.append(last)

    def before(self, page: dict, at: int) -> int:
        """The greatest place up to at of a page that is no copy of the given one, or -1."""
        own = own_text(page)
        total = sum(n for _, n in own)
        lines = set(page["lines"])
        while at >= 0:
            other, since = self.pages[at], self.since[at]
            held = sum(n for line, n in own if line in since)
            if 100 * held < NEARLY * total:
                theirs = own_text(other)
                within = sum(n for line, n in theirs if line in lines)
                if 100 * within < NEARLY * sum(n for _, n in theirs):
                    return at
                at -= 1
                continue
            at = max(since[line] for line, _ in own if line in since) - 1
        return -1


def found_row(page: dict, other: dict) -> dict:
    """The places of the plain lines that a page shares with a neighbour, and how long the beginning of their paths is; its lists are done with.

    Shared lines in an article stay and lines around it go anyway, so only plain places are listed.
    """
    gone = [i for i in shared_lines(page["lines"], other["lines"]) if page["kinds"][i] == PLAIN]
    return {"common": len(os.path.commonprefix([page["path"], other["path"]])), "gone": gone, "lines": [], "kinds": [], "sizes": []}


#: What a page meets on a side (-1: before it, 1: after it): a neighbour's shared lines, or copies up to the end of the part (gone is null).
PAGE = "row long, host string, path string, lines array<long>, kinds array<int>, sizes array<int>, part int"
MET = f"{PAGE}, side int, away int, common int, gone array<int>"


def as_pages(table: pd.DataFrame) -> list[dict]:
    lists = ("lines", "kinds", "sizes")
    return [{**x, **{n: list(map(int, x[n])) for n in lists}} for x in table.to_dict("records")]


def as_table(rows: list[dict]) -> pd.DataFrame:
    names = [x.split()[0] for x in MET.split(", ")]
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype="int64" if n in ("row", "part", "side", "away", "common") else object) for n in names})


def stretches(pages: list[dict]) -> list[list[dict]]:
    return [list(x) for _, x in itertools.groupby(pages, key=lambda p: p["host"])]


def met_in_part(table: pd.DataFrame) -> pd.DataFrame:
    """What the pages meet on both sides in their own part."""
    out = []
    for pages in stretches(as_pages(table.sort_values(["host", "path", "row"]))):
        for side, ordered in ((-1, pages), (1, pages[::-1])):
            stretch = Stretch(ordered)
            for i, page in enumerate(ordered):
                at = stretch.before(page, i - 1)
                met = {"common": 0, "gone": None} if at < 0 else found_row(page, ordered[at])
                out.append({**page, "side": side, "away": 0, **met})
    return as_table(out)


def met_elsewhere(visitors: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
    """What pages of other parts meet in this one, on the side they come from."""
    here = {pages[0]["host"]: pages for pages in stretches(as_pages(table.sort_values(["host", "path", "row"])))}
    out = []
    for (host, side), some in visitors.groupby(["host", "side"]):
        ordered = here[host][:: -int(side)]
        stretch = Stretch(ordered)
        for page in as_pages(some):
            at = stretch.before(page, len(ordered) - 1)
            met = {"common": 0, "gone": None} if at < 0 else found_row(page, ordered[at])
            out.append({**page, "part": page["home"], **met})
    return as_table(out)


def neighbours(pages: DataFrame) -> DataFrame:
    """row and gone of pages (row, host, path, lines, kinds, sizes), each line list once in a host.

    The pages are dealt in order into parts. A page that meets only copies up to the end of its part visits the next
    parts of its host, twice as many each time.
    """
    spark = pages.sparkSession
    order = ("host", "path", "row")
    number = -(-pages.count() // PART)
    dealt = pages.repartitionByRange(number, *order) if number > 1 else pages.repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    ends = dealt.groupBy("part").agg(F.min("host").alias("low"), F.max("host").alias("high")).orderBy("part").collect()
    if not ends:
        return spark.createDataFrame([], "row long, gone array<int>")
    spans = spark.createDataFrame([(r.part, n, r.low, r.high) for n, r in enumerate(ends)], "target int, place int, low string, high string")
    met = cut_lineage(dealt.groupBy("part").applyInPandas(met_in_part, MET))
    done = met.filter("gone is not null")
    waiting, reach = met.filter("gone is null"), 1
    while True:
        home = spans.select(F.col("target").alias("part"), F.col("place").alias("home_place"))
        next_places = F.sequence(F.col("home_place") + reach * F.col("side"), F.col("home_place") + (2 * reach - 1) * F.col("side"), F.col("side"))
        visits = waiting.join(F.broadcast(home), "part").withColumn("place", F.explode(next_places))
        visits = visits.join(F.broadcast(spans), "place").filter(F.col("host").between(F.col("low"), F.col("high")))
        visits = cut_lineage(
            visits.select(*[c for c in waiting.columns if c not in ("part", "away")], F.col("part").alias("home"), F.col("target").alias("part"), F.abs(F.col("place") - F.col("home_place")).alias("away"))
        )
        if visits.isEmpty():
            break
        parts = dealt.join(F.broadcast(visits.select("part", "host").distinct()), ["part", "host"], "left_semi")
        met = cut_lineage(visits.groupBy("part").cogroup(parts.groupBy("part")).applyInPandas(met_elsewhere, MET))
        done = done.unionByName(met.filter("gone is not null"))
        still = met.groupBy("row", "side").agg(F.max(F.col("gone").isNotNull()).alias("over")).filter("not over").select("row", "side")
        last = met.withColumn("n", F.row_number().over(Window.partitionBy("row", "side").orderBy("away"))).filter("n = 1").drop("n")
        waiting, reach = cut_lineage(last.join(still, ["row", "side"], "left_semi")), 2 * reach
    # the nearest on each side, then the one with the longer common beginning, the earlier one in ties
    first = Window.partitionBy("row").orderBy(F.desc("common"), "side", "away")
    return done.withColumn("n", F.row_number().over(first)).filter("n = 1").select("row", "gone")


def shared_with_neighbour(lines: DataFrame) -> DataFrame:
    """row and gone (places of the lines to delete) of each page that loses any; lines has row, url, texts and kinds."""
    url = F.coalesce("url", F.lit(""))
    rest = F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    narrow = lines.select(
        "row",
        F.lower(F.regexp_extract(rest, "^[^/?#]*", 0)).alias("host"),
        F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1).alias("path"),
        F.transform("texts", lambda t: F.xxhash64(t)).alias("lines"),
        "kinds",
        F.transform("texts", lambda t: F.length(t)).alias("sizes"),
    )
    keyed = cut_lineage(narrow.filter(F.size("lines") > 0).withColumn("list", F.sha2(F.to_json(F.struct("lines", "kinds")), 256)))
    firsts = keyed.groupBy("host", "list").agg(F.min(F.struct("path", "row")).alias("first")).select("list", F.col("first.row").alias("row"))
    gone = cut_lineage(neighbours(keyed.join(firsts.select("row"), "row", "left_semi").drop("list")).filter(F.size("gone") > 0))
    of_list = firsts.join(gone, "row").join(keyed.select("row", "host"), "row").select("host", "list", "gone")
    return keyed.select("row", "host", "list").join(of_list, ["host", "list"]).select("row", "gone")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    parsed = rows.mapInPandas(line_rows, "page_id long, url string, texts array<string>, kinds array<int>")
    lines = cut_lineage(parsed.withColumn("row", F.monotonically_increasing_id()))
    gone = cut_lineage(shared_with_neighbour(lines))
    landmark = F.array_contains("kinds", ARTICLE)
    each = F.arrays_zip("texts", "kinds", F.sequence(F.lit(0), F.size("texts")).alias("i"))
    lost = F.coalesce("gone", F.array().cast("array<int>"))

    def kept(x):
        return F.when(landmark, x["kinds"] == ARTICLE).otherwise((x["kinds"] == PLAIN) & ~F.array_contains(lost, x["i"]))

    out = lines.join(gone, "row", "left").withColumn("text", F.array_join(F.transform(F.filter(each, kept), lambda x: x["texts"]), "\n\n"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(read(spark, folder, "pages"))
