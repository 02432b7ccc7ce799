"""Further queries: routing and listing, tables, pictures, traversals with their own rules, repeated synchronisation; each with the same in SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import files, html, text, urls
from corpusloom.operators import assemble, graph, incremental, split, stages, tabular
from corpusloom.plans.maintenance import _FP, _fingerprinted
from corpusloom.plans.scalars import _EXT, _PATH, _SLUG
from corpusloom.session import shared_dir
from corpusloom.sources.files import read_bulk_json, read_folder, read_separated
from corpusloom.sources.tables import table
from corpusloom.streaming import incremental as streams

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def take(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return take


def _staged(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# texts and URLs

@query("SELECT doc_id, nfc_normalize(title) AS title, nfc_normalize(lang) AS lang, nfc_normalize(source) AS source, n_chars FROM documents")
def normalised_values(spark, folder):
    """Every string of a row in one normal form, decomposed and composed again; numbers stay."""
    rows = text.normalised(table(spark, folder, "documents").select("doc_id", "title", "lang", "source", "n_chars"))
    return rows.withColumns({c: text.nfc(c) for c in ("title", "lang", "source")})


@query("SELECT sec_id, coalesce(length(text) >= 3, false) AS long_enough FROM doc_sections")
def long_enough_texts(spark, folder):
    return table(spark, folder, "doc_sections").select("sec_id", text.long_enough(F.col("text")).alias("long_enough"))


@query("SELECT entry_id, coalesce(regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#\\s]+'), false) AS valid FROM manifest")
def valid_urls(spark, folder):
    return table(spark, folder, "manifest").select("entry_id", urls.is_valid(F.col("url")).alias("valid"))


@query("SELECT DISTINCT site, CASE WHEN coalesce(site, '') = '' THEN 'https://api.example' ELSE 'https://' || site END AS endpoint FROM documents")
def endpoints(spark, folder):
    return table(spark, folder, "documents").select("site").distinct().select("site", urls.endpoint(F.col("site"), "api.example").alias("endpoint"))


_LAST = f"regexp_extract({_PATH}, '([^/]*)$', 1)"
_LAST_EXT = f"regexp_extract({_LAST}, '^\\.*[^.].*(\\.[^.]*)$', 1)"


@query(f"SELECT entry_id, {_SLUG.format(f'left({_LAST}, length({_LAST}) - length({_LAST_EXT}))')} || {_LAST_EXT} AS file FROM manifest WHERE url IS NOT NULL")
def file_names(spark, folder):
    return table(spark, folder, "manifest").where("url is not null").select("entry_id", urls.file_name(F.col("url")).alias("file"))


_STEM = "regexp_replace(regexp_replace(regexp_extract(doc_key, '([^/]+)/*$', 1), '(.)\\.[^.]*$', '\\1'), '[_-]', ' ', 'g')"


@query(
    f"SELECT doc_id, coalesce(nullif(trim(title), ''), array_to_string(list_transform(regexp_extract_all(lower({_STEM}), '\\p{{L}}+|\\P{{L}}+'), lambda x: upper(x[1]) || x[2:]), '')) AS title FROM documents WHERE doc_key IS NOT NULL"
)
def file_titles(spark, folder):
    """The title in the metadata, else the file's stem in title case."""
    title = text.document_title(F.col("title"), F.lit(None).cast("string"), F.col("doc_key"))
    return table(spark, folder, "documents").where("doc_key is not null").select("doc_id", title.alias("title"))


@query("SELECT doc_id, '{\"k\":' || CASE WHEN title IS NULL THEN 'null' ELSE '\"' || array_to_string(list_transform(string_split(replace(replace(replace(replace(title, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't'), ''), lambda c: CASE WHEN unicode(c) BETWEEN 32 AND 126 THEN c WHEN unicode(c) > 65535 THEN printf('%su%04x%su%04x', chr(92), 55296 + (unicode(c) - 65536) // 1024, chr(92), 56320 + (unicode(c) - 65536) % 1024) ELSE printf('%su%04x', chr(92), unicode(c)) END), '') || '\"' END || '}' AS json FROM documents")
def canonical_metadata(spark, folder):
    """Metadata as it is hashed: JSON in ASCII."""
    return table(spark, folder, "documents").select("doc_id", text.canonical_map(F.create_map(F.lit("k"), "title")).alias("json"))


_CLEAN = "replace(replace(coalesce(title, 'Untitled'), '<', ' '), '&', ' ')"


@query(f"SELECT doc_id, trim(regexp_replace('See [' || trim({_CLEAN}) || '](https://x.example/x/' || doc_id || ') and [https://o.example/y](https://o.example/y) and plain .', '\\s+', ' ', 'g')) AS said FROM documents")
def linked_pages(spark, folder):
    """Links of a page kept in its text."""
    title = F.replace(F.replace(F.coalesce("title", F.lit("Untitled")), F.lit("<"), F.lit(" ")), F.lit("&"), F.lit(" "))
    page = F.concat(F.lit("<html><nav><a href='/n'>Nav</a></nav><p>See <a href=\"/x/"), F.col("doc_id"), F.lit('"> '), title, F.lit(" </a> and <a href='https://o.example/y'></a> and <a>plain</a> .</p></html>"))
    return table(spark, folder, "documents").select("doc_id", html.with_markdown_links(page, F.lit("https://x.example/dir/page")).alias("said"))


# routing

_MIMES = "CASE WHEN entry_id % 5 = 0 THEN NULL WHEN entry_id % 5 = 1 THEN 'Text/HTML; charset=utf-8' WHEN entry_id % 5 = 2 THEN 'application/pdf' ELSE 'application/octet-stream' END"
_FILE_EXT = "'^\\.(pdf|doc|docx|ppt|pptx|rtf|odt|epub|md|txt|csv|tsv|psv|pipe|xls|xlsx|zip|gz|tar|bz2|7z|rar|gif|jpeg|jpg|mng|bmp|tiff|tif|png|svg|ico|webp|mp3|wav|flac|aac|ogg|m4a|mp4|avi|mov|wmv|webm|mkv)$'"


@query(
    f"SELECT entry_id, CASE WHEN entry_id % 5 = 1 THEN 'html' WHEN entry_id % 5 = 2 THEN 'pdf' WHEN entry_id % 7 = 0 OR (entry_id % 5 = 0 AND regexp_matches({_EXT.format('url')}, {_FILE_EXT})) THEN 'download' ELSE 'html' END AS route, "
    f"NOT regexp_matches(lower({_PATH}), '\\.(pdf|doc|docx|ppt|pptx|rtf|odt|epub|md|txt|zip|gz|tar|bz2|7z|rar|gif|jpeg|jpg|mng|bmp|tiff|tif|png|svg|ico|webp)$') AS followed FROM manifest WHERE url IS NOT NULL"
)
def content_routes(spark, folder):
    """How each URL goes on by what it was answered with, and whether a redirect to it is followed."""
    route = urls.fetched_as(F.expr(_MIMES), F.col("url"), F.col("entry_id") % 7 == 0)
    return table(spark, folder, "manifest").where("url is not null").select("entry_id", route.alias("route"), urls.redirect_followed(F.col("url")).alias("followed"))


@query(
    """WITH r AS (SELECT DISTINCT site FROM documents WHERE site IS NOT NULL), c AS (SELECT site, unnest([(0, 'https://' || site || '/own.xml'), (1, 'https://' || site || '/sitemap.xml'), (3, 'https://' || site || '/sitemap_index.xml'), (4, 'https://' || site || '/sitemap.xml.gz'), (5, 'https://' || site || '/wp-sitemap.xml'), (6, 'https://' || site || '/sitemap_index.xml.gz')]) AS e FROM r)
SELECT site, string_agg(e[2], ' ' ORDER BY e[1]) AS maps FROM c GROUP BY 1"""
)
def sitemap_candidates(spark, folder):
    """What robots.txt declares and the usual names, in order, once each, only sitemaps."""
    robots = F.concat(F.lit("User-agent: *\nSitemap: https://"), "site", F.lit("/own.xml\nsitemap: https://"), "site", F.lit("/list.txt\nSITEMAP: https://"), "site", F.lit("/sitemap.xml"))
    sites = table(spark, folder, "documents").where("site is not null").select("site").distinct()
    return sites.select("site", F.array_join(urls.sitemap_candidates(F.concat(F.lit("https://"), "site"), html.robots_sitemaps(robots)), " ").alias("maps"))


@query("SELECT 'https://' || site || '/' || doc_id AS loc FROM documents WHERE site IS NOT NULL")
def sitemap_indexes(spark, folder):
    """Each site has an index of indexes of its maps; an index that names itself ends."""
    docs = table(spark, folder, "documents").where("site is not null").withColumns({"map": F.concat(F.lit("https://"), "site", F.lit("/m"), F.pmod("doc_id", F.lit(16)), F.lit(".xml")), "top": F.concat(F.lit("https://"), "site", F.lit("/i.xml"))})
    page = F.concat(F.lit("<url><loc>https://"), "site", F.lit("/"), F.col("doc_id"), F.lit("</loc></url>"))
    maps = docs.groupBy(F.col("map").alias("url"), "top").agg(F.array_join(F.collect_list(page), "").alias("xml"))
    entry = lambda c: F.concat(F.lit("<sitemap><loc>"), c, F.lit("</loc></sitemap>"))
    mid = maps.groupBy("top").agg(F.array_join(F.collect_list(entry(F.col("url"))), "").alias("xml")).withColumn("url", F.concat("top", F.lit("?2")))
    tops = mid.select(F.col("top").alias("url"), F.concat(entry(F.col("url")), entry(F.col("top"))).alias("xml"))
    all_ = maps.select("url", "xml", F.lit(False).alias("is_index")).unionByName(mid.select("url", "xml", F.lit(True).alias("is_index"))).unionByName(tops.select("url", "xml", F.lit(True).alias("is_index")))
    return graph.sitemap_tree(all_, tops, html.sitemap_entries).select("loc")


@query("WITH p AS (SELECT source, entry_id // 1000 AS page, entry_id, doc_id FROM manifest), b AS (SELECT DISTINCT source FROM p WHERE page % 11 = 3 AND source LIKE 'w%') SELECT source, entry_id, doc_id FROM p WHERE source NOT IN (SELECT source FROM b)")
def corpus_listings(spark, folder):
    """Listings in pages; a corpus of which a page failed lists nothing."""
    rows = table(spark, folder, "manifest").select("source", F.floor(F.col("entry_id") / 1000).alias("page"), F.struct("entry_id", "doc_id").alias("d"))
    pages = rows.groupBy("source", "page").agg(F.collect_list("d").alias("docs"))
    pages = pages.withColumn("status", F.when((F.col("page") % 11 == 3) & F.col("source").startswith("w"), 500).otherwise(200))
    return incremental.listing(pages, "source", "status", "docs")


@query(
    """WITH p AS (SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 20 AS page FROM events), b AS (SELECT user_id, min(page) AS first FROM p WHERE (user_id + page) % 9 = 4 GROUP BY 1)
SELECT user_id, p.event_id FROM p LEFT JOIN b USING (user_id) WHERE first IS NULL OR page < first"""
)
def messages_until_failure(spark, folder):
    """Messages read page by page: a page that fails ends its channel, what was read before stays."""
    at = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, folder, "events").select("user_id", "event_id", F.floor((F.row_number().over(at) - 1) / 20).alias("page"))
    return incremental.pages_until_failure(rows, "user_id", "page", (F.col("user_id") + F.col("page")) % 9 == 4).select("user_id", "event_id")


@query("SELECT DISTINCT doc_id, any_value(parent_doc_id) OVER (PARTITION BY doc_id) AS parent_doc_id, 'tag' AS source FROM (SELECT doc_id, max_by(parent_doc_id, entry_id) AS parent_doc_id FROM manifest WHERE parent_doc_id IS NOT NULL GROUP BY 1)")
def stamped_parts(spark, folder):
    """Parts of documents carry their parent and the run's source."""
    parts = table(spark, folder, "manifest").where("parent_doc_id is not null").groupBy("doc_id").agg(F.max_by("parent_doc_id", "entry_id").alias("p"))
    return incremental.stamped(parts, F.col("p"), F.lit("tag"), True).select("doc_id", "parent_doc_id", "source")


# traversals

_PAGES = "SELECT 'https://' || site || '/?p=' || k AS id, k, site FROM (SELECT site, row_number() OVER (PARTITION BY site ORDER BY doc_id) AS k FROM documents WHERE site IS NOT NULL)"


def _links(spark, folder):
    """Pages of a site that link to the ones at twice their number and at one more."""
    at = Window.partitionBy("site").orderBy("doc_id")
    pages = table(spark, folder, "documents").where("site is not null").select("site", F.row_number().over(at).alias("k"))
    name = lambda k: F.concat(F.lit("https://"), "site", F.lit("/?p="), k)
    links = pages.select("site", "k", F.explode(F.array(F.col("k") * 2, F.col("k") * 2 + 1)).alias("to"))
    return pages.select(name(F.col("k")).alias("id"), "k", "site"), links.select(name(F.col("k")).alias("src"), name(F.col("to")).alias("dst"))


@query(
    f"""WITH RECURSIVE p AS MATERIALIZED ({_PAGES}), e AS MATERIALIZED (SELECT id AS src, 'https://' || site || '/?p=' || unnest([2 * k, 2 * k + 1]) AS dst FROM p),
r(id, depth) AS (SELECT id, 0 FROM p WHERE k = 1 UNION SELECT dst, depth + 1 FROM r JOIN e ON src = id WHERE depth < 4 AND regexp_matches(dst, '(?:docs|wiki|help)') AND NOT regexp_matches(dst, 'p=.*7$')) SELECT id, min(depth) AS depth FROM r GROUP BY 1"""
)
def docs_walk(spark, folder):
    """Links of which a pattern is found anywhere, four steps from each site's first page."""
    pages, links = _links(spark, folder)
    return graph.reach(pages.where("k = 1"), links, 4, urls.docs_link(F.col("dst"), ["docs|wiki|help"], ["p=.*7$"], (".png",)))


@query(f"SELECT id, 0 AS depth FROM ({_PAGES}) WHERE k = 1")
def docs_walk_without_patterns(spark, folder):
    """Without an including pattern nothing but the seeds is reached."""
    pages, links = _links(spark, folder)
    return graph.reach(pages.where("k = 1"), links, 4, urls.docs_link(F.col("dst"), [], []))


@query(
    f"""WITH RECURSIVE p AS MATERIALIZED ({_PAGES}), l AS (SELECT id FROM p WHERE k % 5 <> 0), e AS MATERIALIZED (SELECT id AS src, 'https://' || site || '/?p=' || unnest([2 * k, 2 * k + 1]) AS dst FROM p),
r(id, depth) AS (SELECT id, 0 FROM p WHERE k = 1 UNION SELECT dst, depth + 1 FROM r JOIN e ON src = id WHERE depth < 3 AND dst IN (SELECT id FROM l)) SELECT id, min(depth) AS depth FROM r GROUP BY 1 ORDER BY 2, 1 LIMIT 100"""
)
def wiki_pages(spark, folder):
    """At most 100 pages, three steps deep, only those whose extract is long enough (here: of four in five)."""
    pages, links = _links(spark, folder)
    worth = pages.where("k % 5 <> 0").select(F.col("id").alias("dst"))
    return graph.limited(graph.reach(pages.where("k = 1"), links.join(worth, "dst", "left_semi"), 3), 100)


# tables

_SIZES = "2 + 4 * 16 + 2 * 3 + 4 * 2 + length(l_shipdate::DATE::VARCHAR || l_returnflag || l_linestatus || l_partkey::VARCHAR)"
_HEADERS = '[["date", "flag", "status", "part"]]'


@query(
    f"""WITH t AS (SELECT l_orderkey, list(({_SIZES})::BIGINT ORDER BY l_linenumber, l_shipdate::DATE::VARCHAR, l_returnflag, l_linestatus, l_partkey::VARCHAR) AS sizes FROM lineitem GROUP BY 1), w AS (SELECT *, {len(_HEADERS) + 25} + list_sum(sizes) + 2 * (len(sizes) - 1) AS whole FROM t),
g AS (SELECT l_orderkey, whole, list_reduce(list_prepend({{'out': []::INTEGER[], 'n': 0, 's': {len(_HEADERS)}::BIGINT, 'a': false}}, list_transform(sizes, lambda x: {{'out': []::INTEGER[], 'n': 0, 's': x, 'a': false}})), lambda s, x: CASE WHEN s.a AND s.s + x.s > 320 THEN {{'out': list_append(s.out, s.n + 1), 'n': s.n + 1, 's': {len(_HEADERS)} + x.s, 'a': true}} ELSE {{'out': list_append(s.out, s.n), 'n': s.n, 's': s.s + x.s, 'a': true}} END).out AS g, len(sizes) AS n FROM w)
SELECT l_orderkey, 't' || l_orderkey || CASE WHEN x = 0 THEN '' ELSE '_part' || x END AS id, 'lines' AS description, count(*)::BIGINT AS n_rows FROM (SELECT l_orderkey, unnest(CASE WHEN whole <= 400 THEN list_transform(g, lambda y: 0) ELSE g END) AS x FROM g) GROUP BY ALL"""
)
def split_tables(spark, folder):
    """Each order's table under a limit of 400 characters as JSON: numbered parts, the description on each."""
    cells = F.array(F.col("l_shipdate").cast("date").cast("string"), "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string"))
    orders = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", cells.alias("c")))), lambda x: x["c"]).alias("rows"))
    parts = split.split_table(F.concat(F.lit("t"), "l_orderkey"), F.lit("lines"), F.lit(len(_HEADERS)), F.col("rows"), 400)
    return orders.select("l_orderkey", F.explode(parts).alias("t")).select("l_orderkey", "t.id", "t.description", F.size("t.rows").cast("long").alias("n_rows"))


_CELLS = "list_transform(string_split(trim(content), chr(10)), lambda l: list_filter(list_transform(string_split(l, '|'), lambda c: trim(c)), lambda c: c <> ''))"


@query(
    f"""WITH t AS (SELECT elem_id, {_CELLS} AS c FROM page_elements WHERE element_type = 'table' AND content IS NOT NULL), w AS (SELECT *, list_max(list_transform(c, lambda r: len(r))) AS w FROM t)
SELECT elem_id, array_to_string(c[1] || list_transform(range(len(c[1]) + 1, w + 1), lambda k: 'Column_' || k), ',') AS header, (len(c) - 1)::BIGINT AS n_rows, md5(array_to_string(list_transform(c[2:], lambda r: array_to_string(r || list_transform(range(w - len(r)), lambda k: ''), ',')), ';')) AS cells FROM w"""
)
def table_frames(spark, folder):
    """Tables of pages as header and rows of one width."""
    t = tabular.markdown_frame(F.col("content"))
    rows = table(spark, folder, "page_elements").where("element_type = 'table' and content is not null").select("elem_id", t.alias("t"))
    joined = F.array_join(F.transform("t.rows", lambda r: F.array_join(r, ",")), ";")
    return rows.select("elem_id", F.array_join("t.header", ",").alias("header"), F.size("t.rows").cast("long").alias("n_rows"), F.md5(joined).alias("cells"))


@query(
    """WITH c AS (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE left(c_mktsegment, 1) END AS l FROM customer), g AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - row_number() OVER (PARTITION BY c_nationkey, l ORDER BY c_custkey) AS island FROM c),
s AS (SELECT c_nationkey, l, min(c_custkey) AS f, count(*) AS n FROM g GROUP BY c_nationkey, l, island) SELECT c_nationkey, string_agg(l || ':' || n, ' ' ORDER BY f) AS spans FROM s GROUP BY 1"""
)
def header_spans(spark, folder):
    """A level of column labels with neighbours of one label joined; missing labels are empty."""
    label = F.when(F.col("c_custkey") % 3 != 0, F.left("c_mktsegment", F.lit(1)))
    rows = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", label.alias("l")))), lambda x: x["l"]).alias("l"))
    spans = F.transform(tabular.header_spans(F.col("l")), lambda s: F.concat(s["label"], F.lit(":"), s["span"]))
    return rows.select("c_nationkey", F.array_join(spans, " ").alias("spans"))


@query(
    """WITH r AS (SELECT n_nationkey, n_name, list([c_name, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END] ORDER BY c_custkey) FILTER (c_custkey IS NOT NULL) AS l FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT n_nationkey, 'Customers of ' || n_name AS summary, len(l)::BIGINT AS n_rows, md5(array_to_string(list_transform(l, lambda x: array_to_string(x, ',')), ';')) AS cells FROM r WHERE n_nationkey % 4 <> 0 AND len(l) > 0"""
)
def table_payloads(spark, folder):
    """Tables as they are sent; those without a summary or rows are not."""
    row = F.struct("c_custkey", F.array("c_name", F.when(F.col("c_acctbal") < 0, "NaN").otherwise(F.col("c_mktsegment"))).alias("r"))
    joined = table(spark, folder, "nation").join(table(spark, folder, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    grouped = joined.groupBy("n_nationkey", "n_name").agg(F.transform(F.sort_array(F.collect_list(F.when(F.col("c_custkey").isNotNull(), row))), lambda x: x["r"]).alias("rows"))
    summary = F.when(F.col("n_nationkey") % 4 != 0, F.concat(F.lit("Customers of "), "n_name")).otherwise("  ")
    sent = grouped.select("n_nationkey", assemble.table_payload(F.array(F.lit("name"), F.lit("segment")), F.col("rows"), summary).alias("p")).where("p is not null")
    return sent.select("n_nationkey", "p.summary", F.size("p.rows").cast("long").alias("n_rows"), F.md5(F.array_join(F.transform("p.rows", lambda r: F.array_join(r, ",")), ";")).alias("cells"))


@query(
    """WITH s AS (SELECT * FROM supplier ORDER BY s_suppkey LIMIT 500) SELECT 'suppliers' AS doc_id, 'Suppliers: ' || (SELECT count(*) FROM supplier) || ' rows with columns s_suppkey, s_name, s_nationkey' AS text, count(*)::BIGINT AS n_rows, md5(string_agg(s_suppkey || ',' || s_name || ',' || s_nationkey, ';' ORDER BY s_suppkey)) AS cells FROM s HAVING count(*) > 0"""
)
def whole_table_document(spark, folder):
    """Table mode: a table as one document with a summary and its first rows (the cap is the feature)."""
    doc = tabular.whole_table(table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "suppliers", "Suppliers", ["s_suppkey"])
    return doc.select("doc_id", "text", F.size("rows").cast("long").alias("n_rows"), F.md5(F.array_join(F.transform("rows", lambda r: F.array_join(r, ",")), ";")).alias("cells"))


# pictures

@query(
    f"""WITH i AS (SELECT doc_id, elem_id, content, image_id, row_number() OVER (PARTITION BY doc_id ORDER BY position, elem_id) - 1 AS k FROM page_elements WHERE element_type = 'image' AND doc_id IS NOT NULL)
SELECT {_SLUG.format("doc_id")} || '_image_' || k AS id, coalesce(content, '') AS text, coalesce(image_id, '-') AS image, doc_id AS url, 'extra' AS kind FROM i"""
)
def image_documents(spark, folder):
    """Pictures of a page as documents: numbered ids, the summary as text, the page's URL and extra metadata over their own."""
    own = F.create_map(F.lit("image"), F.coalesce("image_id", F.lit("-")), F.lit("kind"), F.lit("own"))
    rows = table(spark, folder, "page_elements").where("element_type = 'image' and doc_id is not null")
    pages = rows.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "elem_id", F.coalesce("content", F.lit("")).alias("summary"), F.map_entries(own).alias("m")))), lambda x: F.struct(x["summary"].alias("summary"), F.map_from_entries(x["m"]).alias("metadata"))).alias("s"))
    docs = pages.select(F.explode(assemble.image_documents(F.col("s"), F.col("doc_id"), F.create_map(F.lit("kind"), F.lit("extra")))).alias("d"))
    return docs.select(F.col("d.doc_id").alias("id"), "d.text", F.col("d.metadata")["image"].alias("image"), F.col("d.metadata")["url"].alias("url"), F.col("d.metadata")["kind"].alias("kind"))


@query("SELECT p_partkey, 'picture ' || p_name AS summary FROM part WHERE NOT (least(p_size, p_partkey) < 10) AND p_partkey % 13 <> 0")
def picture_summaries(spark, folder):
    """Pictures that are tiny in markup, or of which the model says nothing, go."""

    def make():
        return lambda name: "" if int(name.split("|")[1]) % 13 == 0 else "picture " + name.split("|")[0]

    rows = table(spark, folder, "part").select("p_partkey", F.concat_ws("|", "p_name", "p_partkey").alias("name"), F.col("p_size").alias("width"), F.col("p_partkey").alias("height"))
    return stages.picture_summaries(rows, ["p_partkey"], make)


@query("SELECT p_partkey, p_partkey % 4 = 1 OR p_partkey % 4 = 0 OR least(p_size * 5, 150) >= 100 AS kept FROM part")
def pictures_by_size(spark, folder):
    """Pictures of a side under 100 go; drawings stay, and so do those of unknown size."""
    name = F.when(F.col("p_partkey") % 4 == 1, "x.SVG").otherwise("x.png")
    width = F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") * 5)
    return table(spark, folder, "part").select("p_partkey", files.picture_kept(name, width, F.when(width.isNotNull(), F.lit(150))).alias("kept"))


# stages

@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE length(text)::VARCHAR END AS size, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS n FROM documents WHERE text IS NOT NULL AND text <> ''")
def attribute_answers(spark, folder):
    """Questions about texts: fenced JSON replies are read, others give no answers, unasked ones go."""

    def make():
        return lambda said, questions: said[:0] + ("no JSON" if said.startswith("\x01") else '```json\n{"size": "' + str(len(said) - 1) + '", "other": "x"}\n```')

    rows = table(spark, folder, "documents").where("text is not null and text <> ''").select("doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "\x01").otherwise("\x02"), "text").alias("said"))
    out = stages.attributes(rows, ["doc_id"], "said", {"size": "How long is it?"}, make)
    return out.select("doc_id", F.col("attributes")["size"].alias("size"), F.coalesce(F.size(F.map_keys("attributes")), F.lit(0)).alias("n"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE title END AS title, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE 1 END AS n FROM documents WHERE title IS NOT NULL")
def user_metadata(spark, folder):
    """Metadata by a function of the user's; a failure gives none."""

    def extract(page: str) -> dict:
        if page.startswith("!"):
            raise ValueError("this stand-in fails")
        return {"title": page[1:]}

    page = F.concat(F.when(F.col("doc_id") % 4 == 0, "!").otherwise("."), "title")
    rows = table(spark, folder, "documents").where("title is not null").select("doc_id", stages.extracted_metadata(page, extract).alias("m"))
    return rows.select("doc_id", F.col("m")["title"].alias("title"), F.size(F.map_keys("m")).alias("n"))


@query("SELECT doc_id, CASE WHEN regexp_replace(text, '\\s', '', 'g') = '' OR text IS NULL THEN 'again' ELSE 'read' END AS how FROM documents")
def parsed_documents(spark, folder):
    """Files read by a parser, and again by another where the first found nothing."""
    rows = table(spark, folder, "documents").select("doc_id", stages.parsed(F.lit("a.txt"), F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("e"))
    again = stages.parsed(F.lit("b.txt"), F.lit("again").cast("binary"))
    out = stages.with_fallback(rows, "e", again, F.lit(True))
    return out.select("doc_id", F.when(F.col("e")[0]["content"] == "again", "again").otherwise("read").alias("how"))


@query("SELECT user_id, ts AS begun, strftime(ts, '%H:%M:%S') AS title, event_type AS text FROM events WHERE event_type <> 'view'")
def spoken_sections(spark, folder):
    """Segments of speech as sections, silent ones go."""
    said = F.when(F.col("event_type") == "view", "  ").otherwise(F.concat(F.lit(" "), "event_type"))
    rows = table(spark, folder, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("start"), "ts", said.alias("said"))
    out = stages.segment_sections(rows.withColumn("user_id", F.struct("user_id", "ts")), "user_id", "start", "said")
    return out.select("user_id.user_id", F.col("user_id.ts").alias("begun"), "title", "text")


# sources and sinks

@query("SELECT s_suppkey, s_name || '|\"x\"' AS s_name, s_acctbal FROM supplier")
def separated_files(spark, folder):
    """A table written with pipes and quotes, read by its extension."""
    at = _staged(spark, "table") + ".psv"
    rows = table(spark, folder, "supplier").select("s_suppkey", F.concat("s_name", F.lit('|"x"')).alias("s_name"), "s_acctbal")
    rows.write.option("sep", "|").option("header", True).option("quote", '"').option("escape", '"').csv(at)
    return read_separated(spark, at, schema="s_suppkey long, s_name string, s_acctbal double")


@query("SELECT c_custkey::VARCHAR AS id, 1::BIGINT AS n FROM customer WHERE c_acctbal > 0")
def bulk_files(spark, folder):
    """Files whose root is an array of documents; those without sections are passed over."""
    at = _staged(spark, "bulk")
    doc = F.struct(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_acctbal") > 0, F.array(F.struct(F.col("c_name").alias("text")))).alias("sections"))
    arrays = table(spark, folder, "customer").groupBy("c_nationkey", F.pmod("c_custkey", F.lit(8))).agg(F.to_json(F.collect_list(doc)).alias("value"))
    arrays.select("value").repartition(16).write.option("maxRecordsPerFile", 1).text(at)
    return read_bulk_json(spark, at, "id string, sections array<struct<text:string>>").select("id", F.size("sections").cast("long").alias("n"))


@query("SELECT source, true AS has_size, source <> 'x' AS has_time FROM sources")
def listed_objects(spark, folder):
    """A folder of objects listed with key, size and time, by extension; no object is opened."""
    at = _staged(spark, "objects")
    table(spark, folder, "sources").write.partitionBy("source").json(at)
    listed = read_folder(spark, at, (".JSON",)).withColumn("source", F.regexp_extract("path", r"source=([^/]+)", 1))
    return listed.groupBy("source").agg(F.bool_and(F.col("n_bytes") > 0).alias("has_size"), F.bool_and(F.col("modified_at").isNotNull()).alias("has_time"))


@query("SELECT doc_id, lang FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 200 OFFSET 10")
def hub_rows(spark, folder):
    """A hub scan: one equality, then start row and number of rows (these are the feature)."""
    return table(spark, folder, "documents").where(tabular.equality("lang = 'en'")).orderBy("doc_id").offset(10).limit(200).select("doc_id", "lang")


# repeated synchronisation

@query(
    f"""WITH d AS (SELECT doc_key AS key, (batch_no - 1) // 4 AS g, {_FP} AS fingerprint, doc_id FROM documents WHERE doc_key IS NOT NULL AND batch_no IS NOT NULL), i AS (SELECT key, g, max_by(fingerprint, doc_id) AS f FROM d GROUP BY ALL),
a AS (SELECT g, key, f, lag(f) OVER (PARTITION BY key ORDER BY g) AS held FROM i) SELECT g::BIGINT AS batch, CASE WHEN held IS NULL THEN 'new' WHEN held = f THEN 'unchanged' ELSE 'changed' END AS action, count(*) AS n FROM a GROUP BY ALL"""
)
def streamed_sync(spark, folder):
    """Three listings as micro-batches of a stream that runs over what is available; each is compared with what is held after those before."""
    at = _staged(spark, "listings")
    docs = _fingerprinted(spark, folder).where("batch_no is not null").select(F.col("doc_key").alias("key"), "fingerprint", F.col("doc_id").alias("order"), F.floor((F.col("batch_no") - 1) / 4).alias("g"))
    for g in range(3):
        docs.where(F.col("g") == g).coalesce(1).write.mode("append").parquet(at)
    target = f"{at}-out"
    streams.run_available(streams.stream_of(spark, at, 1), target, each=streams.sync_each(target))
    done = spark.read.option("recursiveFileLookup", False).parquet(*[f"{target}/actions-{g}" for g in range(3)])
    return done.groupBy(F.col("number").cast("long").alias("batch"), "action").agg(F.count("*").alias("n"))


@query("SELECT crawler_type, status, count(*)::BIGINT AS n FROM (SELECT doc_id, crawler_type, max_by({'s': status}, seq).s AS status FROM tracker_log WHERE doc_id IS NOT NULL AND seq IS NOT NULL GROUP BY ALL) WHERE status IS NOT NULL GROUP BY ALL")
def streamed_status_changes(spark, folder):
    """Counters of a stream as sums of changes; what a document's state was stands in the state store."""
    at = _staged(spark, "log")
    table(spark, folder, "tracker_log").select("seq", "doc_id", "crawler_type", "status").repartition(3).write.parquet(at)
    target = f"{at}-out"

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{target}/changes/batch={number}")

    streams.run_available(streams.status_changes(streams.stream_of(spark, at, 1)), target, "update", keep)
    changes = spark.read.parquet(f"{target}/changes")
    return changes.groupBy("crawler_type", "status").agg(F.sum("delta").alias("n")).where("n <> 0")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
