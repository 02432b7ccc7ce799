"""HTML: columns where patterns do, Arrow functions over the standard library's parser where a tree is needed."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Opening one of these closes the open element of the second set that is nearest, within the third.
IMPLIED = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "p": ({"p"}, {"div", "td", "th", "li", "body", "section", "article"}), "option": ({"option"}, {"select"})}
FRAME_TAGS = ("script", "style", "header", "footer", "nav", "aside")


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self):
        """Nodes and texts in document order, without recursion."""
        stack = [self]
        while stack:
            x = stack.pop()
            yield x
            if isinstance(x, Node):
                stack.extend(reversed(x.children))

    def all(self, *tags: str) -> list[Node]:
        return [x for x in self.walk() if isinstance(x, Node) and x.tag in tags]

    def text(self, by: str = " ") -> str:
        return by.join(t for x in self.walk() if isinstance(x, str) and (t := x.strip()))

    def without(self, drop: Callable[[Node], bool]) -> Node:
        """The tree without the branches that `drop` names; they are taken off in place."""
        for x in list(self.walk()):
            if isinstance(x, Node):
                x.children = [c for c in x.children if not (isinstance(c, Node) and drop(c))]
        return self


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in IMPLIED:
            closes, within = IMPLIED[tag]
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in within:
                    break
                if self.open[k].tag in closes:
                    del self.open[k:]
                    break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _dropped(ids, tags, classes) -> Callable[[Node], bool]:
    ids, tags, classes = set(ids), set(tags), set(classes)
    return lambda n: n.tag in tags or n.attrs.get("id") in ids or bool(classes & set(n.attrs.get("class", "").split()))


def html_to_text(html: Column, remove_code: bool = False, ids: tuple = (), tags: tuple = (), classes: tuple = ()) -> Column:
    """Texts of the tree joined by a space; scripts, styles and whatever is named are taken out first."""
    drop = _dropped(ids, ("script", "style", *tags, *(("code",) if remove_code else ())), classes)

    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda h: None if h is None else parse(h).without(drop).text().replace("\n", " "))

    return run(html)


PAGE = StructType(
    [
        StructField("title", StringType()),
        StructField("text", StringType()),
        StructField("links", ArrayType(StringType())),
        StructField("images", ArrayType(StructType([StructField("src", StringType()), StructField("alt", StringType())]))),
        StructField("n_tables", IntegerType()),
    ]
)


def extract_page(html: Column, url: Column, target_tag: str | None = None, target_class: str | None = None, remove_title: bool = False, least_image: int = 10) -> Column:
    """Title, body text, absolute distinct links, pictures that aren't tiny, number of tables."""

    def page(h: str, base: str) -> dict:
        tree = parse(h)
        title = next((t.text() for t in tree.all("title")), "")
        images = [
            {"src": urljoin(base or "", n.attrs["src"]), "alt": n.attrs.get("alt", "")}
            for n in tree.all("img")
            if n.attrs.get("src") and all(not n.attrs.get(k, "").isdigit() or int(n.attrs[k]) >= least_image for k in ("width", "height"))
        ]
        n_tables = len(tree.all("table"))
        tree.without(lambda n: n.tag in (*FRAME_TAGS, "code", "pre", "title"))
        if target_tag:
            tree = next((n for n in tree.all(target_tag) if not target_class or target_class in n.attrs.get("class", "").split()), tree)
        if remove_title:
            tree.without(lambda n: n.tag == "h1" and n.text() == title)
        links = list(dict.fromkeys(urljoin(base or "", n.attrs["href"]) for n in tree.all("a") if n.attrs.get("href")))
        return {"title": title, "text": " ".join(tree.text().split()), "links": links, "images": images, "n_tables": n_tables}

    @F.pandas_udf(PAGE)
    def run(htmls: pd.Series, urls: pd.Series) -> pd.DataFrame:
        rows = [page(h or "", u) for h, u in zip(htmls, urls, strict=True)]
        return pd.DataFrame(rows, columns=PAGE.fieldNames())

    return run(html, url)


TABLE = StructType([StructField("header", ArrayType(StringType())), StructField("rows", ArrayType(ArrayType(StringType())))])


def expand_table(table: Node, duplicate_rows: bool = False) -> list[list[str]]:
    """Cells by place. A column span repeats the text; a row span leaves blanks below, or repeats it too on request. Short rows are padded."""
    placed: dict[tuple[int, int], str] = {}
    rows = table.all("tr")
    for r, tr in enumerate(rows):
        c = 0
        for cell in (x for x in tr.children if isinstance(x, Node) and x.tag in ("td", "th")):
            while (r, c) in placed:
                c += 1
            down, across = (int(v) if (v := cell.attrs.get(k, "1")).isdigit() and int(v) else 1 for k in ("rowspan", "colspan"))
            text = cell.text("")
            for i in range(down):
                for j in range(across):
                    placed[(r + i, c + j)] = text if i == 0 or duplicate_rows else ""
            c += across
    height, width = max((r for r, _ in placed), default=-1) + 1, max((c for _, c in placed), default=-1) + 1
    return [[placed.get((r, c), "") for c in range(width)] for r in range(max(height, len(rows)))] if placed else []


def html_table(html: Column, duplicate_rows: bool = False) -> Column:
    """Header and rows of the first table; empty where there is none."""

    @F.pandas_udf(TABLE)
    def run(values: pd.Series) -> pd.DataFrame:
        out = []
        for h in values:
            first = next(iter(parse(h or "").all("table")), None)
            cells = expand_table(first, duplicate_rows) if first else []
            out.append({"header": cells[0] if cells else [], "rows": cells[1:]})
        return pd.DataFrame(out, columns=TABLE.fieldNames())

    return run(html)


MODIFIED = StructType([StructField("method", StringType()), StructField("utc_us", LongType()), StructField("content_hash", StringType())])


def _instant(value: str, *parsers) -> int | None:
    for p in parsers:
        try:
            at = p(value.strip())
        except (ValueError, TypeError, IndexError):
            continue
        at = at if at.tzinfo else at.replace(tzinfo=UTC)
        return int((at - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds()) * 1_000_000 + at.microsecond
    return None


_LONG_DATE = re.compile(r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4}\b")


def last_modified(html: Column) -> Column:
    """When a page changed: its meta tag, else the latest <time>, else the latest written-out date, else only the hash.

    Plain ISO dates in the text don't count, as in the behaviour this follows.
    """

    def find(h: str) -> dict:
        tree, out = parse(h), {"content_hash": hashlib.md5(h.encode("utf-8", "replace")).hexdigest()}
        for attr in ("http-equiv", "name"):
            tag = next((n for n in tree.all("meta") if n.attrs.get(attr, "").lower() == "last-modified"), None)
            if tag and (at := _instant(tag.attrs.get("content", ""), parsedate_to_datetime)) is not None:
                return out | {"method": "meta", "utc_us": at}
        times = [at for n in tree.all("time") if n.attrs.get("datetime") and (at := _instant(n.attrs["datetime"], parsedate_to_datetime, datetime.fromisoformat)) is not None]
        if times:
            return out | {"method": "time", "utc_us": max(times)}
        dates = [at for d in _LONG_DATE.findall(tree.text()) if (at := _instant(" ".join(d.split()), lambda v: datetime.strptime(v, "%B %d, %Y"))) is not None]
        return out | ({"method": "regex", "utc_us": max(dates)} if dates else {"method": "hash", "utc_us": None})

    @F.pandas_udf(MODIFIED)
    def run(values: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([find(h or "") for h in values], columns=MODIFIED.fieldNames())
        out["utc_us"] = out["utc_us"].astype("Int64")
        return out

    return run(html)


def longer_text(a: Column, b: Column) -> Column:
    """Of two extractors' texts the longer; of equal ones the second."""
    return F.when(F.length(F.coalesce(a, F.lit(""))) > F.length(F.coalesce(b, F.lit(""))), a).otherwise(b)


def dense_text(html: Column, least_words: int = 8) -> Column:
    """Texts of blocks with enough words, by patterns: what stands between two tags is a block."""
    blocks = F.split(F.regexp_replace(html, r"(?is)<(script|style|nav|footer|aside|header)\b.*?</\1>", " "), r"<[^>]+>")
    kept = F.filter(F.transform(blocks, lambda b: F.trim(F.regexp_replace(b, r"\s+", " "))), lambda b: F.size(F.split(b, " ")) >= least_words)
    return F.array_join(kept, "\n")


def hrefs(html: Column) -> Column:
    """Link targets in order, by a pattern."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\b[^>]*\bhref="([^"]*)"'), 1)


def meta_refresh(html: Column) -> Column:
    """Where a page sends its reader at once, '' if nowhere."""
    return F.regexp_extract(html, r'(?i)<meta[^>]+http-equiv="?refresh"?[^>]+content="[^"]*url=([^"]+)"', 1)


def sitemap_entries(xml: Column) -> Column:
    """(loc, lastmod) of a sitemap or of an index of sitemaps."""
    entries = F.regexp_extract_all(xml, F.lit(r"(?is)<(?:url|sitemap)>(.*?)</(?:url|sitemap)>"), 1)
    return F.transform(entries, lambda e: F.struct(F.trim(F.regexp_extract(e, r"(?is)<loc>(.*?)</loc>", 1)).alias("loc"), F.nullif(F.trim(F.regexp_extract(e, r"(?is)<lastmod>(.*?)</lastmod>", 1)), F.lit("")).alias("lastmod")))


def robots_sitemaps(robots: Column) -> Column:
    return F.regexp_extract_all(robots, F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1)


def with_markdown_links(html: Column, base: Column) -> Column:
    """The text of a page with its links as [text](absolute URL); a link without text shows its URL, one without target only its text."""

    @F.pandas_udf(StringType())
    def run(htmls: pd.Series, bases: pd.Series) -> pd.Series:
        def page(h: str | None, at: str | None) -> str | None:
            if h is None:
                return None
            tree = parse(h)
            for x in list(tree.walk()):
                if isinstance(x, Node):
                    x.children = [_linked(c, at or "") if isinstance(c, Node) and c.tag == "a" else c for c in x.children]
            return " ".join(tree.without(lambda n: n.tag in FRAME_TAGS).text().split())

        return pd.Series([page(h, b) for h, b in zip(htmls, bases, strict=True)], dtype=object)

    return run(html, base)


def _linked(a: Node, base: str) -> str:
    said, href = a.text(""), a.attrs.get("href") or ""
    if not href:
        return said
    whole = urljoin(base, href)
    return f"[{said or whole}]({whole})"
