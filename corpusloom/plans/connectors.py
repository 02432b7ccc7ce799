"""Queries of connectors, HTML, stages and streams, each with the same in SQL where SQL can say it.

The connectors' own services aren't there; their shapes are laid over the project's tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import html, text, urls
from corpusloom.operators import relational, stages
from corpusloom.operators.split import fixed_cuts
from corpusloom.session import shared_dir
from corpusloom.sources.files import table_kind
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


def inline(spark, values: str, names: str):
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


@query("SELECT * FROM (VALUES ('a.CSV','csv'), ('b.tsv','csv'), ('c.xlsx','xls'), ('d.pdf',NULL), ('e',NULL)) t(name, kind)")
def table_file_kinds(spark, folder):
    return inline(spark, "('a.CSV'), ('b.tsv'), ('c.xlsx'), ('d.pdf'), ('e')", "name").select("name", table_kind(F.col("name")).alias("kind"))


@query("SELECT c_custkey, c_custkey::VARCHAR AS id, c_name FROM customer WHERE c_acctbal > 1000 AND c_mktsegment = 'MACHINERY'")
def database_scan(spark, folder):
    """Columns and condition reach the scan."""
    return table(spark, folder, "customer").where("c_acctbal > 1000 AND c_mktsegment = 'MACHINERY'").select("c_custkey", F.col("c_custkey").cast("string").alias("id"), "c_name")


@query("SELECT rec_id, json_extract_string(payload, '$.id') AS id FROM (SELECT rec_id, ltrim(payload, chr(65279)) AS payload FROM raw_records) WHERE json_valid(payload) AND json_extract_string(payload, '$.id') IS NOT NULL AND json_extract_string(payload, '$.sections') IS NOT NULL")
def bulk_documents(spark, folder):
    """Valid records have an id and sections."""
    p = F.ltrim("payload", F.lit("﻿"))
    rows = table(spark, folder, "raw_records").select("rec_id", p.alias("payload")).where(F.try_parse_json("payload").isNotNull())
    return rows.select("rec_id", F.get_json_object("payload", "$.id").alias("id"), F.get_json_object("payload", "$.sections").alias("s")).where("id is not null and s is not null").select("rec_id", "id")


_ROBOTS = "'User-agent: *\nSitemap: https://a.com/s1.xml\nsitemap: https://a.com/s2.xml.gz\nSITEMAP: https://a.com/s1.xml'"


@query("SELECT * FROM (VALUES ('https://a.com/s1.xml'), ('https://a.com/s2.xml.gz')) t(url)")
def discovered_sitemaps(spark, folder):
    return spark.sql(f"SELECT {_ROBOTS} AS r").select(F.explode(F.array_distinct(html.robots_sitemaps(F.col("r")))).alias("url"))


@query("SELECT 'https://' || site || '/' || doc_id AS loc, nullif(trim(updated_at), '') AS lastmod FROM documents WHERE site IS NOT NULL")
def sitemap_walk(spark, folder):
    """Sitemaps of each site, made of its documents, read back as (loc, lastmod)."""
    return _walked(table(spark, folder, "documents").where(F.col("site").isNotNull()))


def _walked(docs):
    lastmod = F.coalesce(F.concat(F.lit("<lastmod>"), "updated_at", F.lit("</lastmod>")), F.lit(""))
    entry = F.concat(F.lit("<url><loc> https://"), "site", F.lit("/"), F.col("doc_id").cast("string"), F.lit("</loc>\n"), lastmod, F.lit("</url>"))
    maps = docs.groupBy("site", F.pmod("doc_id", F.lit(64))).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))
    return maps.select(F.explode(html.sitemap_entries(F.col("xml"))).alias("e")).groupBy("e.loc").agg(F.min("e.lastmod").alias("lastmod"))


@query("SELECT url, entry_id FROM manifest WHERE url IS NOT NULL AND (pub_date IS NULL OR NOT regexp_matches(pub_date, '^\\d{4}-\\d{2}-\\d{2}$') OR TRY_CAST(pub_date AS DATE) BETWEEN DATE '2020-01-01' AND DATE '2022-12-31') QUALIFY row_number() OVER (PARTITION BY url ORDER BY entry_id) = 1")
def feed_window(spark, folder):
    """Entries of the window, undated ones kept, the first of each URL."""
    day = F.when(F.col("pub_date").rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.col("pub_date").try_cast("date"))
    unreadable = F.col("pub_date").isNull() | ~F.col("pub_date").rlike(r"^\d{4}-\d{2}-\d{2}\z")
    kept = table(spark, folder, "manifest").where(F.col("url").isNotNull() & (unreadable | day.between("2020-01-01", "2022-12-31")))
    return relational.first_of(kept.select("url", "entry_id"), ["url"], "entry_id")


@query("SELECT l_orderkey AS story, count(*) AS n_comments, max(l_shipdate) AS newest FROM lineitem WHERE l_linestatus <> 'F' OR l_linenumber = 1 GROUP BY 1 HAVING max(l_shipdate) >= TIMESTAMP '1997-01-01'")
def recent_stories(spark, folder):
    """Stories with a recent comment; dead comments don't count."""
    rows = table(spark, folder, "lineitem").where("l_linestatus <> 'F' or l_linenumber = 1").groupBy(F.col("l_orderkey").alias("story")).agg(F.count("*").alias("n_comments"), F.max("l_shipdate").alias("newest"))
    return rows.where(F.col("newest") >= F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00'"))


@query("SELECT user_id AS thread, string_agg(event_type || ':' || event_id, ' | ' ORDER BY ts, event_id) AS posts FROM events GROUP BY 1")
def threads(spark, folder):
    """Posts of a topic in order, one section each."""
    rows = table(spark, folder, "events").groupBy(F.col("user_id").alias("thread")).agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")).alias("p")))).alias("l"))
    return rows.select("thread", F.array_join(F.transform("l", lambda x: x["p"]), " | ").alias("posts"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events WHERE event_type <> 'error' GROUP BY 1")
def bot_attachments(spark, folder):
    """A bot's attachments, each text once."""
    rows = table(spark, folder, "events").where("event_type <> 'error'").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("k"))
    return rows.select("user_id", F.array_join("k", ",").alias("kinds"))


@query("SELECT doc_id, count(*) AS n FROM doc_sections WHERE coalesce(text, '') <> '' GROUP BY 1")
def nonempty_sections(spark, folder):
    """Empty sections go, inside the nested document."""
    docs = table(spark, folder, "doc_sections").groupBy("doc_id").agg(F.collect_list(F.coalesce("text", F.lit(""))).alias("s"))
    return docs.select("doc_id", F.size(F.filter("s", lambda x: x != "")).cast("long").alias("n")).where("n > 0")


@query("SELECT sec_id, string_agg(CASE WHEN n = 'description' THEN title ELSE t END, ' / ' ORDER BY n) AS article FROM (SELECT sec_id, 'text' AS n, text AS t, title, text AS tt FROM doc_sections WHERE coalesce(text, '') <> '' UNION ALL SELECT sec_id, 'description', text, title, text FROM doc_sections WHERE coalesce(text, '') = '' AND coalesce(title, '') <> '') GROUP BY 1")
def article_fallback(spark, folder):
    """A section for each field that holds something; the description only where no other field does."""
    own = F.filter(F.array(F.coalesce("text", F.lit(""))), lambda x: x != "")
    fallback = F.filter(F.array(F.coalesce("title", F.lit(""))), lambda x: x != "")
    parts = F.when(F.size(own) > 0, own).otherwise(fallback)
    return table(spark, folder, "doc_sections").select("sec_id", parts.alias("p")).where(F.size("p") > 0).select("sec_id", F.array_join("p", " / ").alias("article"))


@query("SELECT p_brand, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 3")
def most_cited(spark, folder):
    """The n most cited of each topic: the limit is pushed below the shuffle, so a task sends n rows of a topic at most."""
    at = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    rows = table(spark, folder, "part").select("p_brand", "p_partkey", "p_retailprice", F.row_number().over(at).alias("n"))
    return rows.where("n <= 3").drop("n")


@query("SELECT p_partkey FROM part WHERE regexp_split_to_array(lower(p_type), '\\s+') && ['steel', 'tin', 'copper']")
def topics_with_synonyms(spark, folder):
    words = F.split(F.lower("p_type"), r"\s+")
    return table(spark, folder, "part").where(F.arrays_overlap(words, F.array(*[F.lit(x) for x in ("steel", "tin", "copper")]))).select("p_partkey")


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'F'")
def deals_with_companies(spark, folder):
    rows = table(spark, folder, "orders").where("o_orderstatus = 'F'").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT c_custkey, 'Customer: ' || c_name || '. ' || CASE WHEN c_acctbal > 0 THEN 'Balance: ' || round(c_acctbal)::BIGINT || '. ' ELSE '' END || 'Segment: ' || c_mktsegment || left(c_name, 500) || '...' AS overview FROM customer")
def templated_text(spark, folder):
    """A template whose empty parts leave no trace; a description always ends in dots."""
    balance = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("Balance: "), F.round("c_acctbal").cast("long"), F.lit(". "))).otherwise("")
    return table(spark, folder, "customer").select("c_custkey", F.concat(F.lit("Customer: "), "c_name", F.lit(". "), balance, F.lit("Segment: "), "c_mktsegment", F.substring("c_name", 1, 500), F.lit("...")).alias("overview"))


_EMPTY = "CASE WHEN event_type = 'view' THEN NOT contains(props, 'k') OR length(props) < 10 WHEN event_type = 'click' THEN length(props) < 9 WHEN event_type = 'purchase' THEN NOT contains(props, 'Notes') OR (contains(props, 'Meeting') AND length(props) < 50) WHEN event_type = 'signup' THEN NOT contains(props, 'Notes') AND length(props) < 30 ELSE NOT contains(props, 'Details') AND length(props) < 40 END"


@query(f"SELECT event_type, count(*) FILTER ({_EMPTY}) AS n_empty, count(*) AS n FROM events GROUP BY 1")
def empty_engagements(spark, folder):
    """Each kind has its own sign of emptiness."""
    p, n, kind = F.col("props"), F.length("props"), F.col("event_type")
    has = lambda w: F.contains(p, F.lit(w))
    empty = (
        F.when(kind == "view", ~has("k") | (n < 10)).when(kind == "click", n < 9).when(kind == "purchase", ~has("Notes") | (has("Meeting") & (n < 50))).when(kind == "signup", ~has("Notes") & (n < 30)).otherwise(~has("Details") & (n < 40))
    )
    return table(spark, folder, "events").groupBy("event_type").agg(F.count_if(empty).alias("n_empty"), F.count("*").alias("n"))


@query("SELECT entry_id, trim(m) AS part FROM manifest, LATERAL (SELECT unnest(string_split(doc_id, '-')) AS m) WHERE doc_id IS NOT NULL")
def fanned_out(spark, folder):
    """One row for each part of a separated list."""
    return table(spark, folder, "manifest").where("doc_id is not null").select("entry_id", F.explode(F.split("doc_id", "-")).alias("m")).select("entry_id", F.trim("m").alias("part"))


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(doc_id), '\\.(pdf|docx|pptx|html)$') THEN 'attachment' ELSE 'other' END AS kind FROM (SELECT DISTINCT doc_id FROM manifest WHERE parent_doc_id IS NOT NULL)")
def attachments(spark, folder):
    """Children of documents by whether they can be parsed."""
    rows = table(spark, folder, "manifest").where("parent_doc_id is not null").select("doc_id").distinct()
    return rows.select("doc_id", F.when(F.lower("doc_id").rlike(r"\.(pdf|docx|pptx|html)$"), "attachment").otherwise("other").alias("kind"))


# HTML

def _page_html():
    body = F.replace(F.replace(F.col("text"), F.lit("<"), F.lit(" ")), F.lit("&"), F.lit(" "))
    title = F.coalesce("title", F.lit("Untitled"))
    return F.concat(F.lit("<html><head><title>"), title, F.lit("</title><style>p {color: red}</style></head><body><script>var a = '<p>no</p>';</script><nav><a href=\"/home\">Home</a></nav><div id=ad>Buy</div><p class='x note'>note</p><code>run()</code><p>"), body, F.lit("</p><a href=\"/a b\">more</a></body></html>"))


_BODY = "replace(regexp_replace(replace(replace(text, '<', ' '), '&', ' '), '^[\\t-\\r \\x1c-\\x1f\\x{85}\\x{A0}]+|[\\t-\\r \\x1c-\\x1f\\x{85}\\x{A0}]+$', '', 'g'), chr(10), ' ')"


@query(f"SELECT doc_id, md5(coalesce(trim(title), 'Untitled') || ' ' || {_BODY} || ' more') AS plain FROM documents WHERE text IS NOT NULL ")
def html_texts(spark, folder):
    out = html.html_to_text(_page_html(), remove_code=True, ids=("ad",), tags=("nav",), classes=("note",))
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.md5(out).alias("plain"))


@query("SELECT doc_id, coalesce(trim(title), 'Untitled') AS title, 'https://x.example/a b' AS links, 0 AS n_tables FROM documents WHERE text IS NOT NULL")
def extracted_pages(spark, folder):
    page = html.extract_page(_page_html(), F.lit("https://x.example/dir/page"))
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", page.alias("p"))
    return rows.select("doc_id", "p.title", F.array_join("p.links", " ").alias("links"), "p.n_tables")


@query("SELECT doc_id, '/home' AS first, 2::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def page_links(spark, folder):
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", html.hrefs(_page_html()).alias("l"))
    return rows.select("doc_id", F.col("l")[0].alias("first"), F.size("l").cast("long").alias("n"))


_TABLES = "('<table><tr><th colspan=2>Name</th></tr><tr><td>A</td><td>B</td></tr></table>'), ('<p>none</p>'), ('<table><tr><td rowspan=2>x</td><td>1<tr><td>2</table>')"


@query("SELECT * FROM (VALUES ('Name,Name', 'A,B'), ('', ''), ('x,1', ',2')) t(header, rows)")
def html_tables(spark, folder):
    t = html.html_table(F.col("h"))
    rows = inline(spark, _TABLES, "h").select(t.alias("t"))
    return rows.select(F.array_join("t.header", ",").alias("header"), F.array_join(F.transform("t.rows", lambda r: F.array_join(r, ",")), ";").alias("rows"))


_PAGES = """('<meta http-equiv="Last-Modified" content="Mon, 01 Jan 2024 00:00:00 GMT">'), ('<time datetime="2024-02-01T00:00:00Z">x</time><time datetime="2024-01-01T00:00:00+00:00">'), ('<p>Updated May 3, 2023 and March 1, 2022</p>'), ('<p>2024-01-02</p>')"""


@query("SELECT * FROM (VALUES ('meta', 1704067200000000), ('time', 1706745600000000), ('regex', 1683072000000000), ('hash', NULL)) t(method, utc_us)")
def pages_last_modified(spark, folder):
    m = html.last_modified(F.col("h"))
    return inline(spark, _PAGES, "h").select(m.alias("m")).select("m.method", "m.utc_us")


@query("SELECT doc_id, md5(CASE WHEN length(coalesce(title, '')) > length(coalesce(text, '')) THEN title ELSE text END) AS best FROM documents")
def longer_extraction(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(html.longer_text(F.col("title"), F.col("text"))).alias("best"))


@query("SELECT entry_id, regexp_replace(regexp_extract(url, '([^/]+)/?$', 1), '[-_]', ' ', 'g') AS stem_title FROM manifest WHERE url IS NOT NULL")
def titles_of_files(spark, folder):
    """The title where a document has none: the file's stem with spaces."""
    stem = F.regexp_extract("url", r"([^/]+)/?$", 1)
    return table(spark, folder, "manifest").where("url is not null").select("entry_id", F.regexp_replace(stem, "[-_]", " ").alias("stem_title"))


_REFRESH = """('<meta http-equiv="refresh" content="0; url=https://a.com/new">'), ('<p>x</p>')"""


@query("SELECT * FROM (VALUES ('https://a.com/new'), ('')) t(target)")
def meta_refreshes(spark, folder):
    return inline(spark, _REFRESH, "h").select(html.meta_refresh(F.col("h")).alias("target"))


# stages and streams

_LEAD = "concat_ws(': ', nullif(coalesce(title, ''), ''), nullif(regexp_extract(text, '^\\s*([^.!?\\n]+[.!?]?)', 1), ''))"


@query(f"SELECT sec_id, (k // 512)::BIGINT AS chunk_no, md5(substring(text, k + 1, 512) || CASE WHEN {_LEAD} <> '' THEN chr(10) || {_LEAD} ELSE '' END) AS chunk FROM doc_sections, LATERAL (SELECT unnest(range(0, length(text), 512)) AS k) WHERE text IS NOT NULL")
def contextual_chunks(spark, folder):
    """Chunks of every section, each with a line of context."""
    rows = table(spark, folder, "doc_sections").where("text is not null").select("sec_id", "title", "text", F.posexplode(fixed_cuts(F.col("text"))).alias("chunk_no", "c"))
    return rows.select("sec_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.md5(stages.contextual_chunk(F.col("c"), F.col("title"), F.col("text"))).alias("chunk"))


@query("SELECT elem_id, CASE WHEN length(content) < 40 THEN upper(content) ELSE '' END AS summary FROM page_elements WHERE element_type = 'table'")
def model_stage(spark, folder):
    """A stage whose calls fail for some rows: those get the default, order and keys stay."""

    def make():
        def call(content: str) -> str:
            if len(content) >= 40:
                raise ValueError("too long for this stand-in")
            return content.upper()

        return call

    return stages.mapped(table(spark, folder, "page_elements").where("element_type = 'table'"), ["elem_id"], ["content"], make, "summary")


@query("SELECT elem_id, 'Table of ' || len(r) - 1 || ' rows with columns ' || replace(r[1], ' | ', ', ') AS summary FROM (SELECT elem_id, string_split(content, chr(10)) AS r FROM page_elements WHERE element_type = 'table') WHERE len(r) > 1")
def table_summaries(spark, folder):
    r = F.split("content", "\n")
    rows = table(spark, folder, "page_elements").where("element_type = 'table'").select("elem_id", F.split(r[0], r" \| ").alias("h"), (F.size(r) - 1).alias("n"))
    return rows.select("elem_id", stages.table_summary(F.col("h"), F.col("n")).alias("summary")).where("summary <> ''")


@query("SELECT doc_id, count(*) > 0 AS has_chunks FROM documents WHERE trim(text) <> '' GROUP BY 1")
def heading_chunks(spark, folder):
    rows = table(spark, folder, "documents").where("trim(text) <> ''").select("doc_id", stages.heading_chunks(F.col("text"), 4_000).alias("c"))
    return rows.select("doc_id", (F.size("c") > 0).alias("has_chunks"))


def _staged(spark, folder, name, files, columns):
    """A table in files, each the size of a batch, for the streams below."""
    at = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    table(spark, folder, name).selectExpr(*columns).repartition(files).write.parquet(at)
    return at


@query("SELECT crawler_type, count(*) AS total, count(*) FILTER (status = 'indexed') AS indexed FROM (SELECT doc_id, crawler_type, max_by({'s': status}, seq).s AS status FROM tracker_log WHERE doc_id IS NOT NULL GROUP BY ALL) GROUP BY 1")
def streamed_counters(spark, folder):
    """The tracker's log in three micro-batches: sums of the changes of states, which are kept in the state store."""
    at = _staged(spark, folder, "tracker_log", 3, ["seq", "doc_id", "crawler_type", "status"])
    target = f"{at}-out"

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{target}/changes/batch={number}")

    streams.run_available(streams.status_changes(streams.stream_of(spark, at, 1)), target, "update", keep)
    changes = spark.read.parquet(f"{target}/changes")
    return changes.groupBy("crawler_type").agg(F.sum("delta").alias("total"), F.sum(F.when(F.col("status") == "indexed", F.col("delta")).otherwise(0)).alias("indexed"))


_DAYS = "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL"


@query(_DAYS)
def streamed_windows(spark, folder):
    """Daily counts of a stream of events in complete mode; nothing is late enough to be dropped."""
    at = _staged(spark, folder, "events", 4, ["event_id", "cast(ts as timestamp) ts", "event_type", "value"])
    target = f"{at}-out"

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{target}/result")

    counts = streams.windowed_counts(streams.stream_of(spark, at, 2), "ts", "event_type", "1 day", "3650 days")
    streams.run_available(counts, target, "complete", keep)
    return spark.read.parquet(f"{target}/result").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("SELECT count(DISTINCT user_id) AS n FROM events")
def streamed_first_seen(spark, folder):
    at = _staged(spark, folder, "events", 4, ["event_id", "cast(ts as timestamp) ts", "user_id"])
    first = streams.first_seen(streams.stream_of(spark, at, 4), "user_id", "ts", "3650 days").select("user_id")
    return spark.read.parquet(streams.run_available(first)).agg(F.count("*").alias("n"))


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 DAY OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), n AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS began, count(*) AS n FROM n GROUP BY user_id, k")
def event_sessions(spark, folder):
    """Sessions of users, the pure-gap form of merging."""
    events = table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    out = streams.sessions(events, "ts", "user_id", "30 days", "0 days")
    return out.select("user_id", F.col("began").cast("timestamp_ntz").alias("began"), "n")


@query("SELECT source, count(DISTINCT doc_id) AS n FROM documents GROUP BY 1")
def written_corpus(spark, folder):
    """The corpus written by source and read back."""
    from corpusloom.sources.sinks import write_corpus

    at = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    write_corpus(table(spark, folder, "documents").select("doc_id", "source", text.content_hash(F.col("text")).alias("h")), at)
    return spark.read.parquet(at).groupBy("source").agg(F.count_distinct("doc_id").alias("n"))


@query("SELECT entry_id, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS host FROM manifest WHERE url LIKE 'http%'")
def hosts(spark, folder):
    return table(spark, folder, "manifest").where("url like 'http%'").select("entry_id", F.lower(urls.host(F.col("url"))).alias("host"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
