"""Further queries of connector records, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.richtext import rich_text
from corpusloom.operators import graph, relational
from corpusloom.sources.tables import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def take(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return take


@query("SELECT p_partkey, p_name || chr(10) || p_brand || ' @x' || chr(10) || p_type AS plain FROM part")
def rich_texts(spark, folder):
    """Trees of paragraphs and lists, made of the parts' names, back to plain text."""
    text = lambda c: F.concat(F.lit('{"type": "text", "text": "'), c, F.lit('"}'))
    tree = F.concat(
        F.lit('{"type": "doc", "content": [{"type": "heading", "content": ['), text(F.col("p_name")), F.lit(']}, {"type": "bulletList", "content": [{"type": "listItem", "content": [{"type": "paragraph", "content": ['), text(F.concat("p_brand", F.lit(" "))),
        F.lit(', {"type": "mention", "attrs": {"text": "@x"}}, {"type": "hardBreak"}, '), text(F.col("p_type")), F.lit("]}]}]}]}"),
    )
    return table(spark, folder, "part").select("p_partkey", rich_text(tree).alias("plain"))


@query(
    """WITH RECURSIVE n AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber > 1 THEN l_orderkey * 10 + l_linenumber // 2 END AS parent, l_returnflag <> 'R' OR l_linenumber = 1 AS live FROM lineitem),
r AS (SELECT id, id AS story, 0 AS level FROM n WHERE parent IS NULL UNION ALL SELECT n.id, r.story, level + 1 FROM n JOIN r ON n.parent = r.id WHERE n.live) SELECT story, count(*) - 1 AS n_comments, max(level) AS depth FROM r GROUP BY 1"""
)
def comment_trees(spark, folder):
    """Comments below each story at any depth; below a dead comment nothing counts."""
    rows = table(spark, folder, "lineitem").where("l_returnflag <> 'R' or l_linenumber = 1")
    nodes = rows.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_linenumber") > 1, F.col("l_orderkey") * 10 + F.floor(F.col("l_linenumber") / 2)).alias("parent"))
    # an orphan is a comment whose parent is dead: it becomes a root and is taken out by its level
    tree = graph.inherited(nodes, "id", "parent", "id")
    root = F.split("path", "/")[0].cast("long")
    return tree.where(root % 10 == 1).groupBy(root.alias("story")).agg((F.count("*") - 1).alias("n_comments"), F.max("level").alias("depth"))


@query("SELECT doc_id, string_agg(DISTINCT p || ':' || s, ',' ORDER BY p || ':' || s) AS labels FROM (SELECT doc_id, coalesce(parent_doc_id, '-') AS p, source AS s FROM manifest WHERE doc_id IS NOT NULL AND source IS NOT NULL) GROUP BY 1")
def parallel_labels(spark, folder):
    """Names and origins of labels as one sorted list."""
    rows = table(spark, folder, "manifest").where("doc_id is not null and source is not null").groupBy("doc_id").agg(F.collect_set(F.struct(F.coalesce("parent_doc_id", F.lit("-")).alias("p"), F.col("source").alias("s"))).alias("l"))
    return rows.select("doc_id", F.array_join(F.array_sort(F.transform("l", lambda x: F.concat(x["p"], F.lit(":"), x["s"]))), ",").alias("labels"))


@query("SELECT * FROM (VALUES ('https://drive.example/drive/folders/a_B-1?x=2', 'a_B-1'), ('plain', 'plain')) t(v, id)")
def folder_ids(spark, folder):
    v = F.col("v")
    found = F.regexp_extract(v, r"/folders/([A-Za-z0-9_-]+)", 1)
    return spark.sql("SELECT * FROM VALUES ('https://drive.example/drive/folders/a_B-1?x=2'), ('plain') AS t(v)").select("v", F.when(found != "", found).otherwise(v).alias("id"))


@query("SELECT seq, CASE WHEN created_at IS NULL THEN 0 ELSE epoch(date_trunc('second', created_at))::BIGINT END AS created_int, CASE WHEN created_at IS NULL THEN 'unknown' ELSE strftime(created_at, '%Y-%m-%d') END AS created FROM tracker_log")
def feed_metadata(spark, folder):
    """Dates as day and whole seconds; a missing one is 'unknown' and 0."""
    at = F.col("created_at").cast("timestamp")
    return table(spark, folder, "tracker_log").select("seq", F.coalesce(F.unix_timestamp(at), F.lit(0)).cast("long").alias("created_int"), F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit("unknown")).alias("created"))


@query("SELECT DISTINCT doc_id, url FROM manifest WHERE url IN (SELECT url FROM tracker_log WHERE status = 'failed' AND url IS NOT NULL)")
def ids_by_url(spark, folder):
    failed = table(spark, folder, "tracker_log").where("status = 'failed' and url is not null").select("url").distinct()
    return table(spark, folder, "manifest").join(failed, "url", "left_semi").select("doc_id", "url").distinct()


@query("SELECT entry_id FROM manifest WHERE source IN ('drive-legal', 'drive-sales') OR (source LIKE 'site-%' AND source <> 'site-handbook')")
def allowed_sources(spark, folder):
    """An allow-list and a pattern with an exclusion."""
    s = F.col("source")
    return table(spark, folder, "manifest").where(s.isin("drive-legal", "drive-sales") | (s.startswith("site-") & (s != "site-handbook"))).select("entry_id")


@query("SELECT doc_id, count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM doc_sections WHERE length(text) > 100 AND ord >= 0 GROUP BY 1 HAVING sum(length(text)) >= 1000")
def filed_sections(spark, folder):
    """Sections and documents long enough to be worth filing."""
    rows = table(spark, folder, "doc_sections").where("length(text) > 100 and ord >= 0").groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))
    return rows.where("n_chars >= 1000")


@query("SELECT c_custkey, n_orders, first_order, total FROM customer JOIN (SELECT o_custkey, count(*) AS n_orders, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY 1) ON c_custkey = o_custkey")
def companies_of_deals(spark, folder):
    """Dimension rows referenced by facts, with the facts added up before the join."""
    facts = table(spark, folder, "orders").where(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ'1995-01-01 00:00:00'")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return table(spark, folder, "customer").join(facts, "c_custkey").select("c_custkey", "n_orders", "first_order", "total")


@query("SELECT doc_key, max_by(doc_id, (batch_no, doc_id)) AS doc_id, max(batch_no) AS batch_no FROM documents WHERE doc_key IS NOT NULL GROUP BY 1")
def newest_versions(spark, folder):
    rows = table(spark, folder, "documents").where("doc_key is not null")
    return rows.groupBy("doc_key").agg(F.max_by("doc_id", F.struct("batch_no", "doc_id")).alias("doc_id"), F.max("batch_no").alias("batch_no"))


@query("SELECT source, min_by(entry_id, (listed_at, entry_id)) AS entry_id FROM manifest GROUP BY 1")
def first_listed(spark, folder):
    rows = table(spark, folder, "manifest").select("source", "entry_id", F.struct("listed_at", "entry_id").alias("at"))
    return relational.first_of(rows, ["source"], "at").select("source", "entry_id")


@query("SELECT elem_id, doc_id, position FROM page_elements WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, position, coalesce(content, '') ORDER BY elem_id) > 1")
def repeated_elements(spark, folder):
    """Elements stored again: all but the first of equal ones on a page, by an aggregate and a join instead of a window over long texts."""
    rows = table(spark, folder, "page_elements").where("doc_id is not null").select("elem_id", "doc_id", "position", F.md5(F.coalesce("content", F.lit(""))).alias("h"))
    first = rows.groupBy("doc_id", "position", "h").agg(F.min("elem_id").alias("elem_id"))
    return rows.join(first, "elem_id", "left_anti").select("elem_id", "doc_id", "position")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
