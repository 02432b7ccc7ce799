"""The main body of web pages, by a style tree of each site.

Pages of a site are merged into one tree.  Its content nodes are lines (numbers
and the site's name masked, decoration taken off) and, below a line with
separators, its parts; its presentation nodes are the styles in which the branch
below a line goes on: with an entry (a title, or a title that leads into a
sentence), with prose, with something else, or not at all.

*Content importance.*  A content node stands on a site's m pages with some
distribution; H is the entropy of that.  Its importance is 1 - H / log m: 0 for
what is spread evenly over all pages, 1 for what is on one page only.
*Presentation importance.*  A node whose branch goes on in l styles with shares
p_i has the node importance -sum p_i log p_i / log m: 0 where the branch always
looks the same.
*Composite importance.*  Both are put together from the bottom up: the content
importance, raised towards 1 by (1 - `GAMMA`^l) of the node importance.  Nodes
whose composite importance is at most `LEAST` are pruned, and with a pruned line
the branch of entries below it, if that style has itself at most `LEAST`
importance (-log p / log m) there; below other pruned lines only a run of two
entries or more goes, a list of links.  Sites of few pages lean on the same node in
all other sites, with the weight of `PRIOR` pages.

Pruning goes up the tree as well: a line whose parts but the last are pruned goes
(menus with the current entry marked, breadcrumbs), nodes without any word have
no features and so no importance (counters), and lines that only name the site
go.  Ties between a branch and what follows it are broken thus: the headline,
known by the page's URL or by standing before the text, and recurring
subheadings stay.

One shuffle brings the elements of a page together; from then on only codes and
styles of lines are kept, at most `PAGE_LINES` lines of a page at a time.  Node
counts are added up before they are shuffled, so a hot site is spread over all
tasks; a site's pruned nodes are few (their shares add up to less than a page has
lines), and they come to its pages in a join by site, which AQE may split or
broadcast by size.

Defined results: null and blank contents give no rows; elements without a page
are a page of their own; a null site is a site of its own; elements stored
twice are judged alike, each under its own id; ties of position keep the order
of ids; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut_lineage

#: Nodes of at most this composite importance are pruned.
LEAST = 0.18
#: What each further style leaves of a branch's likeness.
GAMMA = 0.9
#: Weight, in pages, of what other sites say about a node.
PRIOR = 4.0
#: A node on this share of the pages of at least three sites that have it is a recurring subheading, if it isn't pruned.
RECURRING = 0.05
#: Lines of a page that are held at a time.
PAGE_LINES = 50_000
PAGE_NODE = 0

TITLE, HEADLINE, EMPTY, IMAGE, LOGO = 1, 2, 4, 8, 16
#: Styles in which the branch below a node goes on.
NONE, ENTRY, PROSE, OTHER = 0, 1, 2, 3

_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_DECORATION = re.compile(r"^[\s\[\]›»▾▸•·*>←→]+|[\s\[\]›»▾▸•·*>←→]+$")
_PARTS = re.compile(r"\s+[/|·»>›•–]\s+|\s{2,}")
#: A word, or a shell's prompt: without one a line has no features.
_FEATURE = re.compile(r"[^\W\d_]{3,}|^\s*\$\s")
_SLUG = re.compile(r"[^a-z0-9]+")
_LEAD = re.compile(r"(?: — | – |: )")


def node(text: str, brand: re.Pattern | None) -> int:
    """The code of a content node."""
    text = _DECORATION.sub("", text)
    if brand:
        text = brand.sub("\x01", text)
    return xxhash.xxh3_64_intdigest(_NUMBER.sub("9", text).casefold()) - (1 << 63) or 1


def title_like(line: str) -> bool:
    words = line.split()
    return 3 <= len(words) <= 16 and line[-1] not in ".!?…:;,。" and (line[0].isupper() or line[0].isdigit() or line[0] in "¿¡«\"'") and " | " not in line


def entry_like(line: str) -> bool:
    """A title, or a title that leads into a sentence."""
    if title_like(line):
        return True
    for m in _LEAD.finditer(line):
        left = line[: m.start()]
        if title_like(left) and len(line) - m.end() > 12:
            return True
        if len(left.split()) > 16:
            break
    return False


def _brand(site: str | None) -> str:
    labels = [x for x in re.split(r"[.:/]", site or "") if x]
    return labels[-2] if len(labels) > 1 else labels[0] if labels else ""


def page_nodes(site: str | None, url: str | None, elements: list[tuple]) -> tuple[list, list, list, list, list, list]:
    """Codes and styles of a page's lines in order. elements: (elem_id, position, element_type, content), sorted."""
    brand_name = _brand(site)
    brand = re.compile(re.escape(brand_name), re.IGNORECASE) if len(brand_name) > 2 else None
    folded_brand = brand_name.casefold()
    slug = _SLUG.sub("-", (url or "").split("?")[0].split("#")[0].rstrip("/").rpartition("/")[2].lower()).strip("-") + "-"
    ids, numbers, copies, codes, shapes, parts = [], [], [], [], [], []
    seen: dict[tuple, int] = {}
    for elem, position, kind, content in elements:
        if not content or not content.strip():
            continue
        again = seen.setdefault((position, kind, content), len(ids)) if position is not None else len(ids)
        place = again
        for n, line in enumerate(content.split("\n")):
            line = line.strip()
            if not line:
                continue
            ids.append(elem)
            numbers.append(n)
            copies.append(place)
            place += 1
            shape = 0
            if kind != "table" and not _FEATURE.search(line):
                shape |= EMPTY
            if kind == "image":
                shape |= IMAGE
            folded = line.casefold()
            if brand_name and folded_brand in folded and folded_brand in (words := re.findall(r"\w+", folded)) and len(words) <= 2:
                shape |= LOGO
            elif kind != "image" and entry_like(line):
                shape |= TITLE
                own = _SLUG.sub("-", line.lower()).strip("-")
                if len(own) >= 6 and slug.startswith(own + "-"):
                    shape |= HEADLINE
            codes.append(node(line, brand))
            shapes.append(shape)
            pieces = _PARTS.split(line) if kind != "image" else ()
            parts.append([node(p, brand) for p in pieces if p.strip()] if len(pieces) > 1 else [])
    return ids, numbers, copies, codes, shapes, parts


def tree_nodes(copies: list[int], codes: list[int], shapes: list[int], parts: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """The content nodes of a page, how often each stands on it, and the style of the branch below its first place."""
    times: dict[int, int] = {}
    styles: dict[int, int] = {}
    below = NONE
    for i in range(len(codes) - 1, -1, -1):
        if copies[i] != i:
            continue
        code = codes[i]
        times[code] = times.get(code, 0) + 1
        styles[code] = below
        for p in parts[i]:
            times[p] = times.get(p, 0) + 1
            styles.setdefault(p, NONE)
        shape = shapes[i]
        below = OTHER if shape & (EMPTY | LOGO | IMAGE) else ENTRY if shape & TITLE else PROSE
    return list(times), list(times.values()), [styles[c] for c in times]


def body_lines(copies: list[int], codes: list[int], shapes: list[int], parts: list[list[int]], frame: set, branching: set, recurring: set) -> list[bool]:
    """Which lines are body, given the site's pruned nodes, those of them with a pruned branch of entries, and its recurring subheadings."""
    n = len(codes)
    pruned = [False] * n
    for i in range(n):
        shape, own = shapes[i], parts[i]
        pruned[i] = bool(shape & (EMPTY | LOGO)) or (codes[i] in frame and not shape & HEADLINE) or (len(own) > 1 and all(p in frame for p in own[:-1]))
    order = [i for i in range(n) if copies[i] == i and not shapes[i] & IMAGE]
    headline = any(shapes[i] & HEADLINE and not pruned[i] for i in order)
    k = 0
    while k < len(order):
        if not pruned[order[k]] or shapes[order[k]] & EMPTY:
            k += 1
            continue
        run = []
        j = k + 1
        while j < len(order) and (i := order[j]) is not None and not pruned[i] and shapes[i] & TITLE and not shapes[i] & HEADLINE and codes[i] not in recurring:
            run.append(i)
            j += 1
        if run and not headline and j < len(order) and not pruned[order[j]]:
            run.pop()
            headline = True
        if len(run) < 2 and codes[order[k]] not in branching:
            run = []
        for i in run:
            pruned[i] = True
        k = max(j, k + 1)
    return [not pruned[copies[i]] for i in range(n)]


def pages(elements: DataFrame, urls: DataFrame) -> DataFrame:
    """One row a page with the codes and shapes of its lines. urls: doc_id, url."""
    page = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("\x00"), F.col("elem_id").cast("string")))
    rows = elements.select(page.alias("doc"), F.coalesce(F.col("site"), F.lit("")).alias("site"), F.col("elem_id").cast("long").alias("elem"), F.col("position").cast("double").alias("position"), F.col("element_type").alias("kind"), F.col("content").alias("content")).where("content is not null and trim(content) <> ''")
    links = urls.where("doc_id is not null and url is not null").select(F.col("doc_id").cast("string").alias("doc"), F.lit(None).cast("string").alias("site"), F.lit(None).cast("long").alias("elem"), F.lit(None).cast("double").alias("position"), F.lit("url").alias("kind"), F.col("url").alias("content"))
    together = rows.unionByName(links).repartition("doc").sortWithinPartitions("doc", F.col("site").asc_nulls_first(), F.col("position").asc_nulls_last(), "elem")

    kinds = {
        "site": pa.string(), "ids": pa.list_(pa.int64()), "numbers": pa.list_(pa.int32()), "copies": pa.list_(pa.int32()), "codes": pa.list_(pa.int64()), "shapes": pa.list_(pa.int8()), "widths": pa.list_(pa.int32()), "parts": pa.list_(pa.int64()),
        "nodes": pa.list_(pa.int64()), "times": pa.list_(pa.int32()), "styles": pa.list_(pa.int8()),
    }

    def run(batches):
        doc, url, held = None, None, []
        out: list[list] = [[] for _ in kinds]

        def close():
            if held:
                site, found = held[0][0], page_nodes(held[0][0], url or doc, [h[1:] for h in held])
                if found[0]:
                    ids, numbers, copies, codes, shapes, parts = found
                    for c, x in zip(out, (site, ids, numbers, copies, codes, shapes, [len(p) for p in parts], [y for p in parts for y in p], *tree_nodes(copies, codes, shapes, parts)), strict=True):
                        c.append(x)

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds.values(), strict=True)], names=list(kinds))
            for c in out:
                c.clear()
            return batch

        for rb in batches:
            for d, s, e, p, k, c in zip(*(rb.column(x).to_pylist() for x in ("doc", "site", "elem", "position", "kind", "content")), strict=True):
                if d != doc or (held and s != held[0][0]) or len(held) >= PAGE_LINES:
                    close()
                    if d != doc:
                        url = None
                    doc, held = d, []
                if k == "url" and e is None:
                    url = min(url, c) if url else c
                else:
                    held.append((s, e, p, k, c))
            if len(out[0]) > 2000:
                yield flush()
        close()
        yield flush()

    return together.mapInArrow(run, "site string, ids array<long>, numbers array<int>, copies array<int>, codes array<long>, shapes array<tinyint>, widths array<int>, parts array<long>, nodes array<long>, times array<int>, styles array<tinyint>")


def importances(counts: DataFrame) -> DataFrame:
    """counts with `composite`, the composite importance of each node in its site, and `entry`, that of the style of entries below it.

    counts: site, node, m (pages of the site), n (pages with the node), total (its places), spread (the sum of c log c over its c places on
    each page), entries, prose, others (pages on which the branch below it goes on in that style), and of all other sites' pages the shares
    that have the node (share) and each of the styles (share_entries, share_prose, share_others).
    """
    pages_, on = F.col("m") + PRIOR, F.col("n") + PRIOR * F.col("share")
    size = F.ln(pages_)
    # the entropy over the site's own pages, carried on to the pages that other sites lend
    entropy = F.ln("total") - F.col("spread") / F.col("total") + F.ln(on / F.col("n"))
    content = F.lit(1.0) - F.least(entropy / size, F.lit(1.0))
    shares = [(F.col(c) + PRIOR * F.col(f"share_{c}")) / on for c in ("entries", "prose", "others")]
    shares.append(F.greatest(F.lit(1.0) - shares[0] - shares[1] - shares[2], F.lit(0.0)))
    information = [F.when(p > 0, -p * F.ln(p)).otherwise(0.0) for p in shares]
    styles = sum((p > 0).cast("int") for p in shares)
    presentation = sum(information[1:], information[0]) / size
    composite = content + (F.lit(1.0) - content) * (F.lit(1.0) - F.pow(F.lit(GAMMA), styles)) * presentation
    return counts.select("*", composite.alias("composite"), F.when(shares[0] > 0, -F.ln(F.least(shares[0], F.lit(1.0))) / size).alias("entry"))


def site_nodes(pages_: DataFrame) -> DataFrame:
    """(site, frame, branching, recurring): the codes of each site's pruned nodes, of those with a pruned branch, and of its recurring subheadings."""
    # a page counts as the node PAGE_NODE of its site
    places = pages_.select("site", F.explode(F.concat(F.arrays_zip("nodes", "times", "styles"), F.array(F.struct(F.lit(PAGE_NODE).cast("long").alias("nodes"), F.lit(1).alias("times"), F.lit(NONE).cast("tinyint").alias("styles"))))).alias("e")).select("site", F.col("e.nodes").alias("node"), "e.times", "e.styles")
    counts = places.groupBy("site", "node").agg(
        F.count("*").alias("n"),
        F.sum("times").alias("total"),
        F.sum(F.when(F.col("times") > 1, F.col("times") * F.ln("times")).otherwise(0.0)).alias("spread"),
        *[F.count_if(F.col("styles") == style).alias(name) for name, style in (("entries", ENTRY), ("prose", PROSE), ("others", OTHER))],
    )
    sizes = counts.where(F.col("node") == PAGE_NODE).select("site", F.col("n").alias("m"))
    counts = counts.where(F.col("node") != PAGE_NODE).join(sizes, "site")
    # a node of one page of a large site can't be pruned, whatever other sites say
    able = (F.col("n") + PRIOR) / (F.col("m") + PRIOR) >= RECURRING
    names = ("n", "entries", "prose", "others")
    everywhere = counts.groupBy("node").agg(*[F.sum(c).alias(f"all_{c}") for c in (*names, "m")], F.count("*").alias("sites")).where("sites > 1")
    joined = counts.where(able).join(everywhere, "node", "left")
    elsewhere = F.nullif(F.col("all_m") - F.col("m"), F.lit(0))
    shared = {("share" if c == "n" else f"share_{c}"): F.coalesce((F.col(f"all_{c}") - F.col(c)) / elsewhere, F.lit(0.0)) for c in names}
    known = importances(joined.withColumns(shared))
    whole = F.coalesce(F.col("all_n") / F.col("all_m"), F.col("n") / F.col("m"))
    many = (F.coalesce(F.col("sites"), F.lit(1)) >= 3) | (F.col("n") >= 3)
    pruned = F.col("composite") <= LEAST
    judged = known.select("site", "node", pruned.alias("is_frame"), (pruned & (F.col("entry") <= LEAST)).alias("is_branching"), (~pruned & many & (whole >= RECURRING)).alias("is_recurring"))
    return judged.where("is_frame or is_recurring").groupBy("site").agg(*[F.collect_list(F.when(F.col(f"is_{c}"), F.col("node"))).alias(c) for c in ("frame", "branching", "recurring")])


def main_lines(elements: DataFrame, urls: DataFrame) -> DataFrame:
    """(elem_id, line_no) of the lines of the pages' own bodies."""
    kept = cut_lineage(pages(elements, urls))
    both = kept.drop("nodes", "times", "styles").join(site_nodes(kept), "site", "left")

    def run(batches):
        known: dict[str, tuple[set, ...]] = {}
        for rb in batches:
            ids, numbers = [], []
            cols = [rb.column(x).to_pylist() for x in ("site", "ids", "numbers", "copies", "codes", "shapes", "widths", "parts")]
            sets = [rb.column(x) for x in ("frame", "branching", "recurring")]
            for row, (site, e, n, copies, codes, shapes, widths, flat) in enumerate(zip(*cols, strict=True)):
                if site not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[site] = tuple(set(c[row].as_py() or ()) for c in sets)
                parts, at = [], 0
                for w in widths:
                    parts.append(flat[at : at + w])
                    at += w
                for i, own in enumerate(body_lines(copies, codes, shapes, parts, *known[site])):
                    if own:
                        ids.append(e[i])
                        numbers.append(n[i])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())], names=["elem_id", "line_no"])

    return both.mapInArrow(run, "elem_id long, line_no int")
