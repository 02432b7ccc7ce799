"""Queries of trees, threads and records of connectors over the project's tables, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import graph, threads
from corpusloom.sources.tables import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def take(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return take


_ITEMS = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey >= 4 THEN o_orderkey // 3 END AS parent, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey < 4 THEN 'story' WHEN o_orderkey % 11 = 0 THEN 'job' ELSE 'comment' END AS type, o_orderstatus = 'P' AS dead, o_orderdate AS time FROM orders"


def _items(spark, folder):
    """Orders as items of a forum: every seventh is a story, the others hang on the one at a third of their number."""
    k = F.col("o_orderkey")
    story = (k % 7 == 0) | (k < 4)
    kind = F.when(story, "story").when(k % 11 == 0, "job").otherwise("comment")
    return table(spark, folder, "orders").select(k.alias("id"), F.when(~story, F.floor(k / 3)).alias("parent"), kind.alias("type"), (F.col("o_orderstatus") == "P").alias("dead"), F.col("o_orderdate").alias("time"))


@query(
    f"""WITH RECURSIVE i AS MATERIALIZED ({_ITEMS}), c AS MATERIALIZED (SELECT * FROM i WHERE type = 'comment' AND NOT dead), s AS (SELECT id FROM i WHERE time >= TIMESTAMP '1996-01-01' UNION SELECT id FROM i WHERE id % 5 = 0),
r(story, id, level) AS (SELECT id, id, 0 FROM i WHERE type = 'story' AND id IN (SELECT id FROM s) UNION ALL SELECT r.story, c.id, level + 1 FROM r JOIN c ON c.parent = r.id),
n AS (SELECT story, max(time) AS newest FROM r JOIN i USING (id) GROUP BY 1 HAVING max(time) >= TIMESTAMP '1998-01-01') SELECT story, count(*) AS n, max(level) AS depth FROM r WHERE story IN (SELECT story FROM n) GROUP BY 1"""
)
def story_documents(spark, folder):
    """Stories of two listings with all their live comments, if any item of them is recent."""
    items = _items(spark, folder)
    listed = threads.union_of_lists(items.where("time >= timestamp_ntz'1996-01-01 00:00:00'"), items.where("id % 5 = 0"))
    tree = threads.story_items(items, listed)
    recent = threads.recent_trees(tree, items.select("id", "time"), F.expr("timestamp_ntz'1998-01-01 00:00:00'"))
    return recent.groupBy("story").agg(F.count("*").alias("n"), F.max("level").alias("depth"))


@query(f"WITH i AS ({_ITEMS}) SELECT id FROM i WHERE type = 'story' AND time >= TIMESTAMP '1994-01-01' AND id > (SELECT coalesce(max(id), -1) FROM i WHERE type = 'story' AND time < TIMESTAMP '1994-01-01')")
def stories_backwards(spark, folder):
    """Stories from the newest id back to the first that is too old."""
    return threads.stories_back_to(_items(spark, folder), F.expr("timestamp_ntz'1994-01-01 00:00:00'")).select("id")


_THREAD = "user_id % 50"


@query(
    f"""WITH m AS (SELECT event_id, event_type, {_THREAD} AS thread, user_id % 5 AS channel, ts, CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type || ' by ' || coalesce('@' || c_name, '<@' || user_id || '>') || ' and <@none>' END AS t, CASE WHEN event_id % 3 = 0 THEN event_type END AS a FROM events LEFT JOIN customer ON c_custkey = user_id),
s AS (SELECT *, concat_ws(chr(10), nullif(t, ''), a) AS said FROM m) SELECT channel, thread, count(*) AS n, md5(string_agg(said, '|' ORDER BY ts, event_id)) AS sections FROM s WHERE said <> '' GROUP BY ALL"""
)
def chat_documents(spark, folder):
    """Threads with their replies: names for ids, attachments once below the text, empty ones gone."""
    said = F.expr("CASE WHEN event_id % 4 = 0 THEN '' ELSE concat(event_type, ' by <@', user_id, '> and <@none>') END")
    again = F.when(F.col("event_id") % 3 == 0, F.array("event_type", "event_type"))
    messages = table(spark, folder, "events").select((F.col("user_id") % 5).alias("channel"), (F.col("user_id") % 50).alias("thread"), F.col("ts").alias("at"), F.col("event_id").alias("id"), said.alias("text"), again.alias("attachments"))
    users = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    docs = threads.chat_documents(messages, users)
    return docs.select("channel", "thread", F.size("sections").cast("long").alias("n"), F.md5(F.array_join("sections", "|")).alias("sections"))


@query(
    """WITH c AS (SELECT o_custkey AS k, list(CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE o_orderpriority END ORDER BY o_orderkey) AS l FROM orders GROUP BY 1),
s AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN [c_name || ': ' || c_mktsegment] ELSE [] END || coalesce(list_filter(list_transform(l, lambda x, i: 'Comment ' || i || ': ' || x), lambda x: NOT regexp_matches(x, ':\\s+$')), []) || ['Status: open'] AS l FROM customer LEFT JOIN c ON k = c_custkey)
SELECT c_custkey, md5(array_to_string(l, '|')) AS sections FROM s"""
)
def issue_sections(spark, folder):
    """Issues as sections: description, comments, status; those without text go, numbers stay."""
    comments = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderpriority")).alias("c")))), lambda x: x["c"]).alias("l"))
    rows = table(spark, folder, "customer").join(comments, "c_custkey", "left")
    sections = threads.issue_sections(F.col("c_name"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), F.lit("open"), F.col("l"))
    return rows.select("c_custkey", F.md5(F.array_join(F.transform(sections, lambda s: F.concat(s["title"], F.lit(": "), s["text"])), "|")).alias("sections"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 4 = 1 THEN p_brand WHEN p_partkey % 4 = 2 THEN p_type ELSE '' END AS title FROM part")
def property_titles(spark, folder):
    """Titles out of properties, by three rules in turn."""
    p = lambda name, kind, text: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.col(text).alias("text"))
    k = F.col("p_partkey") % 4
    properties = F.when(k == 0, F.array(p("Other", "title", "p_type"), p("Name", "title", "p_brand"), p("title", "title", "p_name"))).when(k == 1, F.array(p("Other", "title", "p_type"), p("title", "text", "p_name"), p("Name", "title", "p_brand"))).when(k == 2, F.array(p("Name", "text", "p_name"), p("Other", "title", "p_type"))).otherwise(F.array(p("title", "text", "p_name")))
    return table(spark, folder, "part").select("p_partkey", threads.property_title(properties).alias("title"))


@query(
    """WITH RECURSIVE b AS MATERIALIZED (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber < 3 THEN l_orderkey * 10 ELSE l_orderkey * 10 + l_linenumber - 2 END AS parent, max(l_returnflag) AS f, max(CASE WHEN l_linestatus = 'F' THEN '' ELSE l_shipdate::DATE::VARCHAR END) AS t FROM lineitem GROUP BY ALL),
o AS (SELECT * FROM b WHERE f <> 'R'), r(page, id, path, t) AS (SELECT parent // 10, id, [id], t FROM o WHERE parent % 10 = 0 UNION ALL SELECT page, o.id, list_append(path, o.id), o.t FROM r JOIN o ON o.parent = r.id)
SELECT page, string_agg(t, ' ' ORDER BY path) AS text FROM r WHERE t <> '' GROUP BY 1"""
)
def block_pages(spark, folder):
    """Pages of nested blocks read depth first; sub-pages and what is below them are left out."""
    rows = table(spark, folder, "lineitem")
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    parent = F.when(F.col("l_linenumber") < 3, F.col("l_orderkey") * 10).otherwise(F.col("l_orderkey") * 10 + F.col("l_linenumber") - 2).alias("parent")
    text = F.max(F.when(F.col("l_linestatus") == "F", "").otherwise(F.col("l_shipdate").cast("date").cast("string")))
    blocks = rows.groupBy(key, parent).agg(F.max("l_returnflag").alias("f"), text.alias("text"))
    blocks = blocks.select("id", "parent", F.col("id").alias("ord"), F.when(F.col("f") == "R", "child_page").otherwise("paragraph").alias("type"), "text")
    pages = rows.select((F.col("l_orderkey") * 10).alias("id")).distinct()
    return threads.block_texts(blocks, pages).select((F.col("page") / 10).cast("long").alias("page"), "text")


@query(
    f"""WITH RECURSIVE i AS MATERIALIZED ({_ITEMS}), r(id, depth) AS (SELECT id, 0 FROM i WHERE id IN (1, 2, 7) UNION SELECT i.id, depth + 1 FROM r JOIN i ON i.parent = r.id WHERE depth < 50), d AS (SELECT id, min(depth) AS depth FROM r GROUP BY 1),
u AS (SELECT id, depth, unnest(['b', 'a']) AS seen FROM d) SELECT id, min(depth) AS depth, min(seen) AS seen FROM u GROUP BY 1"""
)
def shared_subtree(spark, folder):
    """All below three folders, as the first of two users sees it."""
    items = _items(spark, folder)
    below = graph.reach(items.where("id in (1, 2, 7)"), items.select(F.col("parent").alias("src"), F.col("id").alias("dst")), 50)
    seen = below.withColumn("seen", F.explode(F.array(F.lit("b"), F.lit("a"))))
    return threads.first_shared(seen, "seen").select("id", "depth", "seen")


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name WHEN p_size > 10 THEN p_brand END AS said FROM part")
def transcripts(spark, folder):
    """A video's own transcript, else the recognised one."""
    part = lambda when, c: F.when(when, F.array(c))
    said = threads.transcript(part(F.col("p_size") > 25, F.col("p_name")), part(F.col("p_size") > 10, F.col("p_brand")))
    return table(spark, folder, "part").select("p_partkey", F.array_join(said, " ").alias("said"))


@query("SELECT p_partkey, coalesce(n, -1) AS citations FROM part LEFT JOIN (SELECT l_partkey, count(*)::BIGINT AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_partkey = p_partkey WHERE p_size BETWEEN 10 AND 30 ORDER BY 2 DESC, 1 LIMIT 40")
def cited_papers(spark, folder):
    """Papers of some years by citations; an unknown count is -1. The number asked for is the feature."""
    found = table(spark, folder, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    rows = table(spark, folder, "part").where(F.col("p_size").between(10, 30)).join(found, "p_partkey", "left").select("p_partkey", F.coalesce("n", F.lit(-1)).cast("long").alias("citations"))
    return rows.orderBy(F.desc("citations"), "p_partkey").limit(40)


@query("SELECT o_orderkey, n_name AS company FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-09-30 23:59:59' AND n_name IN ('FRANCE', 'NATION_3', 'CHINA', 'NATION_7')")
def filings_of_tickers(spark, folder):
    """Filings reported within a range, of the companies that were asked for."""
    wanted = table(spark, folder, "nation").where(F.col("n_name").isin("FRANCE", "NATION_3", "CHINA", "NATION_7"))
    companies = table(spark, folder, "customer").join(wanted, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("company"))
    reported = table(spark, folder, "orders").where(F.col("o_orderdate").between(F.expr("TIMESTAMP_NTZ'1995-03-01 00:00:00'"), F.expr("TIMESTAMP_NTZ'1995-09-30 23:59:59'")))
    return reported.join(companies, "o_custkey").select("o_orderkey", "company")


@query("SELECT event_id, ts AS created, regexp_replace(trim(regexp_replace(regexp_replace('Hi @' || event_type || ' see ' || user_id, '@[A-Za-z0-9_]+', '', 'g'), '\\s+', ' ', 'g')), '^\\s+', '') AS text, round(value) AS likes FROM events")
def renamed_records(spark, folder):
    """A table's columns renamed, texts cleaned, nested metrics taken out."""
    from corpusloom.functions.text import clean_tweet

    rows = table(spark, folder, "events").select("event_id", "ts", F.concat(F.lit("Hi @"), "event_type", F.lit(" see "), "user_id").alias("said"), F.struct(F.round("value").alias("like_count")).alias("metrics"))
    return rows.withColumnsRenamed({"ts": "created"}).select("event_id", "created", clean_tweet(F.col("said")).alias("text"), F.col("metrics.like_count").alias("likes"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
