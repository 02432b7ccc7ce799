"""Queries of splitting, assembling and tabular operators, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import assemble, split, tabular
from corpusloom.sources.tables import table

QUERIES, SQL = {}, {}
_WS = r"[\t-\r \x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def query(sql: str | None = None):
    def take(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return take


def _pack_sql(parts: str, joiner: str, limit: int) -> str:
    """The greedy fold in SQL: `parts` is a list of structs (t, alone)."""
    lifted = f"list_transform({parts}, lambda p: {{'done': []::VARCHAR[], 'cur': p.t, 'alone': p.alone}})"
    joined = f"(CASE WHEN s.cur = '' THEN x.cur ELSE regexp_replace(s.cur || {joiner} || x.cur, '^{_WS}+|{_WS}+$', '', 'g') END)"
    flushed = "(CASE WHEN s.cur <> '' THEN list_append(s.done, s.cur) ELSE s.done END)"
    fold = (
        f"list_reduce({lifted}, lambda s, x: CASE WHEN x.alone THEN {{'done': list_append({flushed}, x.cur), 'cur': '', 'alone': false}} "
        f"WHEN length({joined}) <= {limit} THEN {{'done': s.done, 'cur': {joined}, 'alone': false}} ELSE {{'done': {flushed}, 'cur': x.cur, 'alone': false}} END, {{'done': []::VARCHAR[], 'cur': '', 'alone': false}})"
    )
    return f"(SELECT CASE WHEN r.cur <> '' THEN list_append(r.done, r.cur) ELSE r.done END FROM (SELECT {fold} AS r))"


def _cuts_sql(c: str, limit: int) -> str:
    return f"list_transform(range(0, length({c}), {limit}), lambda i: substring({c}, i + 1, {limit}))"


def _sentences_sql(c: str, limit: int) -> str:
    parts = f"flatten(list_transform(string_split(regexp_replace({c}, '([.!?]){_WS}+', '\\1' || chr(31), 'g'), chr(31)), lambda q: CASE WHEN length(q) <= {limit} THEN [{{'t': q, 'alone': false}}] ELSE list_transform({_cuts_sql('q', limit)}, lambda z: {{'t': z, 'alone': true}}) END))"
    return _pack_sql(parts, "' '", limit)


@query(f"SELECT doc_id, (i - 1)::BIGINT AS part_no, md5(p) AS part, length(p)::BIGINT AS n_chars FROM (SELECT doc_id, {_cuts_sql('text', 512)} AS ps FROM documents), LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS i), LATERAL (SELECT ps[i] AS p)")
def fixed_size_chunks(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", F.posexplode(split.fixed_cuts(F.col("text"))).alias("part_no", "p"))
    return rows.select("doc_id", F.col("part_no").cast("long").alias("part_no"), F.md5("p").alias("part"), F.length("p").cast("long").alias("n_chars"))


# Long texts only, so that SQL's fold has paragraphs over the limit as well: paragraphs, then sentences, then cuts.
def _core_sql(limit: int) -> str:
    blank = f"regexp_split_to_array(text, '\\n{_WS}*\\n')"
    return f"""WITH d AS (SELECT doc_id, text, {blank} AS b, len({blank}) = 1 AND contains(text, chr(10)) AS by_line FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT doc_id, text, by_line, unnest(CASE WHEN by_line THEN regexp_split_to_array(text, '\\n+') ELSE b END) AS p, generate_subscripts(CASE WHEN by_line THEN regexp_split_to_array(text, '\\n+') ELSE b END, 1) AS i FROM d WHERE length(text) > {limit}),
made AS (SELECT doc_id, by_line, i, CASE WHEN length(p) <= {limit} THEN [{{'t': p, 'alone': false}}] ELSE list_transform({_sentences_sql('p', limit)}, lambda z: {{'t': z, 'alone': true}}) END AS m FROM pieces),
parts AS (SELECT doc_id, any_value(by_line) AS by_line, flatten(list(m ORDER BY i)) AS ps FROM made GROUP BY doc_id),
packed AS (SELECT doc_id, {_pack_sql('ps', "(CASE WHEN by_line THEN chr(10) ELSE chr(10) || chr(10) END)", limit)} AS out FROM parts UNION ALL SELECT doc_id, [text] FROM d WHERE length(text) <= {limit})
SELECT doc_id, (i - 1)::BIGINT AS part_no, md5(out[i]) AS part, length(out[i])::BIGINT AS n_chars FROM packed, LATERAL (SELECT unnest(range(1, len(out) + 1)) AS i)"""


def _core_parts(spark, folder, limit):
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", F.posexplode(split.split_text(F.col("text"), limit)).alias("part_no", "p"))
    return rows.select("doc_id", F.col("part_no").cast("long").alias("part_no"), F.md5("p").alias("part"), F.length("p").cast("long").alias("n_chars"))


@query(_core_sql(split.CORE_LIMIT))
def split_core_parts(spark, folder):
    return _core_parts(spark, folder, split.CORE_LIMIT)


@query(_core_sql(300))
def split_small_parts(spark, folder):
    """The same fold with a limit that sends many paragraphs through sentences and cuts."""
    return _core_parts(spark, folder, 300)


@query(f"SELECT doc_id, count(*)::BIGINT AS n_parts, max(n_chars)::BIGINT AS longest, sum(n_chars)::BIGINT AS n_chars FROM ({_core_sql(split.CORE_LIMIT)}) GROUP BY doc_id")
def parts_per_document(spark, folder):
    """Explode and count without a shuffle: the parts of a document are counted where they are made."""
    parts = split.split_text(F.col("text"), split.CORE_LIMIT)
    lengths = F.transform(parts, lambda p: F.length(p))
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", lengths.alias("n"))
    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select("doc_id", F.size("n").cast("long").alias("n_parts"), F.array_max("n").cast("long").alias("longest"), total.alias("n_chars"))


@query("SELECT sec_id, length(text) > CASE WHEN doc_type = 'structured' THEN 16000 ELSE 8192 END AS must_split FROM doc_sections WHERE text IS NOT NULL")
def oversized_sections(spark, folder):
    limit = F.when(F.col("doc_type") == "structured", split.SECTION_LIMIT).otherwise(split.CORE_LIMIT)
    return table(spark, folder, "doc_sections").where("text is not null").select("sec_id", (F.length("text") > limit).alias("must_split"))


@query("SELECT doc_id FROM doc_sections GROUP BY doc_id HAVING bool_or(length(text) > 16000)")
def documents_to_retry(spark, folder):
    """Documents that are sent again with their oversized sections split."""
    return table(spark, folder, "doc_sections").where(F.length("text") > split.SECTION_LIMIT).select("doc_id").distinct()


@query(
    """WITH t AS (SELECT l_orderkey, list(length(l_shipdate::DATE::VARCHAR || l_returnflag || l_linestatus || l_partkey::VARCHAR)::BIGINT + 30 ORDER BY l_linenumber) AS sizes FROM lineitem GROUP BY l_orderkey),
r AS (SELECT l_orderkey, list_reduce(list_transform(sizes, lambda x: {'out': []::INTEGER[], 'n': 0, 's': x, 'a': false}), lambda s, x: CASE WHEN s.a AND s.s + x.s > 120 THEN {'out': list_append(s.out, s.n + 1), 'n': s.n + 1, 's': 20 + x.s, 'a': true} ELSE {'out': list_append(s.out, s.n), 'n': s.n, 's': s.s + x.s, 'a': true} END, {'out': []::INTEGER[], 'n': 0, 's': 20::BIGINT, 'a': false}).out AS g FROM t)
SELECT l_orderkey, x::BIGINT AS chunk, count(*)::BIGINT AS n_rows FROM r, LATERAL (SELECT unnest(g) AS x) GROUP BY ALL"""
)
def table_rows_in_chunks(spark, folder):
    """Rows of each order's table in chunks under a budget of characters, headers counted each time."""
    size = F.length(F.concat(F.col("l_shipdate").cast("date").cast("string"), "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string"))).cast("long") + 30
    rows = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", size.alias("s")))), lambda x: x["s"]).alias("sizes"))
    chunks = rows.select("l_orderkey", F.explode(split.greedy_groups(F.col("sizes"), 20, 120)).alias("chunk"))
    return chunks.groupBy("l_orderkey", F.col("chunk").cast("long").alias("chunk")).agg(F.count("*").alias("n_rows"))


@query(
    """WITH d AS (SELECT doc_id, coalesce(title, '') AS a, text AS b FROM documents WHERE length(text) > length(coalesce(title, '')))
SELECT doc_id, k::BIGINT AS row_no, CASE WHEN k = 0 THEN a ELSE '' END AS first_cell, md5(substring(b, k * s + 1, s)) AS second_cell FROM (SELECT *, greatest(100, 2000 - length(a)) AS s FROM d), LATERAL (SELECT unnest(range(0, ((length(b) + s - 1) // s)::BIGINT)) AS k)"""
)
def oversized_rows(spark, folder):
    rows = table(spark, folder, "documents").where("length(text) > length(coalesce(title, ''))")
    cells = F.array(F.coalesce("title", F.lit("")), F.col("text"))
    out = rows.select("doc_id", F.posexplode(split.split_row(cells, 2000)).alias("row_no", "r"))
    return out.select("doc_id", F.col("row_no").cast("long").alias("row_no"), F.col("r")[0].alias("first_cell"), F.md5(F.col("r")[1]).alias("second_cell"))


@query(
    f"""SELECT doc_id, count(*)::BIGINT AS n_sections, md5(string_agg(coalesce(text, ''), chr(10) ORDER BY ord, coalesce(text, ''), coalesce(title, ''))) AS full_text FROM doc_sections GROUP BY doc_id
HAVING regexp_replace(string_agg(coalesce(text, ''), ''), '^{_WS}+|{_WS}+$', '', 'g') <> ''"""
)
def assembled_documents(spark, folder):
    docs = assemble.assemble(table(spark, folder, "doc_sections"), "doc_id", "ord")
    return docs.select("doc_id", F.size("sections").cast("long").alias("n_sections"), F.md5("full_text").alias("full_text"))


@query(
    """WITH m AS (SELECT sec_id, CASE WHEN metadata IS NULL THEN 'none' ELSE coalesce(metadata['page'], '-') END AS page FROM doc_sections)
SELECT sec_id, CASE WHEN page IN ('none', '-') THEN '0' ELSE page END AS page, 'en' AS lang FROM m"""
)
def overridden_metadata(spark, folder):
    """Static metadata fills only what the section doesn't say."""
    static = F.create_map(F.lit("page"), F.lit("0"), F.lit("lang"), F.lit("en"))
    m = assemble.merged_metadata(static, F.map_filter("metadata", lambda k, v: v.isNotNull()))
    return table(spark, folder, "doc_sections").select("sec_id", m["page"].alias("page"), m["lang"].alias("lang"))


@query("SELECT doc_id, 'table_' || (row_number() OVER (PARTITION BY doc_id ORDER BY position, elem_id) - 1) AS id, content AS description FROM page_elements WHERE element_type = 'table' QUALIFY trim(coalesce(content, '')) <> ''")
def numbered_tables(spark, folder):
    """A table without a summary goes, its number isn't given again."""
    rows = table(spark, folder, "page_elements").where("element_type = 'table'").groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "elem_id", F.coalesce("content", F.lit("")).alias("c")))), lambda x: x["c"]).alias("c"))
    return rows.select("doc_id", F.explode(assemble.numbered_tables(F.col("c"))).alias("t")).select("doc_id", "t.id", "t.description")


_CONTEXT = """WITH e AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY position, elem_id) AS rn, element_type = 'text' AND trim(content) <> '' AS is_text FROM page_elements WHERE doc_id IS NOT NULL),
n AS (SELECT *, count(*) FILTER (is_text) OVER (PARTITION BY doc_id ORDER BY rn) AS k FROM e),
t AS (SELECT doc_id, k, content FROM n WHERE is_text), p AS (SELECT doc_id, position, elem_id, k FROM n WHERE element_type = 'image'),
s AS (SELECT p.doc_id, p.elem_id, (SELECT string_agg(content, ' ' ORDER BY t.k) FROM t WHERE t.doc_id = p.doc_id AND t.k BETWEEN p.k - {b} + 1 AND p.k) AS a, (SELECT string_agg(content, ' ' ORDER BY t.k) FROM t WHERE t.doc_id = p.doc_id AND t.k BETWEEN p.k + 1 AND p.k + {b}) AS z FROM p)
SELECT elem_id, CASE WHEN length(a) > 1500 THEN left(a, 1500) || '...' ELSE a END AS previous_text, CASE WHEN length(z) > 1500 THEN left(z, 1500) || '...' ELSE z END AS next_text FROM s"""


@query(_CONTEXT.format(b=1))
def picture_context(spark, folder):
    rows = table(spark, folder, "page_elements").where("doc_id is not null")
    return assemble.picture_context(rows, "doc_id", ["position", "elem_id"], "element_type", "content").select("elem_id", "previous_text", "next_text")


@query(_CONTEXT.format(b=2))
def picture_context_two(spark, folder):
    rows = table(spark, folder, "page_elements").where("doc_id is not null")
    return assemble.picture_context(rows, "doc_id", ["position", "elem_id"], "element_type", "content", 2, 2).select("elem_id", "previous_text", "next_text")


@query(
    """WITH e AS (SELECT user_id, list({'done': []::STRUCT(s DOUBLE, e DOUBLE, t VARCHAR)[], 's': epoch(ts), 'e': epoch(ts) + value, 't': event_type} ORDER BY ts, event_id) AS l FROM events GROUP BY user_id),
r AS (SELECT user_id, list_reduce(l, lambda a, x: CASE WHEN x.s - a.e <= 86400 AND x.e - a.s <= 604800 THEN {'done': a.done, 's': a.s, 'e': x.e, 't': a.t || ' ' || x.t}
 WHEN a.e - a.s > 604800 THEN {'done': list_append(a.done, {'s': a.s, 'e': a.s + 604800, 't': left(a.t, length(a.t) // 2)}), 's': a.s + 604800, 'e': a.e, 't': substring(a.t, length(a.t) // 2 + 1)}
 ELSE {'done': list_append(a.done, {'s': a.s, 'e': a.e, 't': a.t}), 's': x.s, 'e': x.e, 't': x.t} END) AS f FROM e),
o AS (SELECT user_id, unnest(CASE WHEN f.e - f.s > 604800 THEN f.done || [{'s': f.s, 'e': f.s + 604800, 't': left(f.t, length(f.t) // 2)}, {'s': f.s + 604800, 'e': f.e, 't': substring(f.t, length(f.t) // 2 + 1)}] ELSE list_append(f.done, {'s': f.s, 'e': f.e, 't': f.t}) END) AS g FROM r)
SELECT user_id, round(g.s, 3) AS start, round(g.e, 3) AS finish, g.t AS text FROM o"""
)
def merged_segments(spark, folder):
    """Events of a user as timed segments, merged while the gap is a day at most and the whole a week."""
    at = (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double")
    seg = F.struct(at.alias("start"), (at + F.col("value")).alias("end"), F.col("event_type").alias("text"))
    rows = table(spark, folder, "events").groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", seg.alias("s")))), lambda x: x["s"]).alias("l"))
    out = rows.select("user_id", F.explode(assemble.merge_gaps(F.col("l"), 86_400.0, 604_800.0)).alias("g"))
    return out.select("user_id", F.round("g.start", 3).alias("start"), F.round("g.end", 3).alias("finish"), F.col("g.text").alias("text"))


@query(
    """SELECT array_to_string(list_filter([n_name, c_mktsegment], lambda x: x <> ''), ' - ') AS doc_id, count(*)::BIGINT AS n_rows, md5(string_agg(concat_ws(' - ', c_name, round(c_acctbal)::BIGINT::VARCHAR), chr(10) ORDER BY c_custkey)) AS texts, min_by(c_name, c_custkey) AS title,
CASE WHEN count(DISTINCT r_name) = 1 THEN min(r_name) END AS r_name, CASE WHEN count(DISTINCT c_custkey % 7) = 1 THEN min(c_custkey % 7) END AS wheel FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, c_mktsegment"""
)
def grouped_documents(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    rows = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.withColumns({"wheel": F.col("c_custkey") % 7, "balance": F.round("c_acctbal").cast("long")})
    docs = tabular.group_documents(rows, ["n_name", "c_mktsegment"], "c_custkey", ["c_name", "balance"], ["r_name", "wheel"], "c_name")
    return docs.select("doc_id", "n_rows", F.md5(F.array_join(F.transform("rows", lambda r: r["text"]), "\n")).alias("texts"), "title", "r_name", "wheel")


@query("WITH n AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part) SELECT 'rows ' || (i - i % 50) || '-' || (i - i % 50 + 49) AS chunk_label, (i // 50)::BIGINT AS chunk_no, count(*)::BIGINT AS n_rows, sum(p_size)::BIGINT AS sizes FROM n GROUP BY ALL")
def chunked_rows(spark, folder):
    rows = tabular.row_chunks(table(spark, folder, "part").select("p_partkey", "p_size"), 50, "p_partkey")
    return rows.groupBy("chunk_label", "chunk_no").agg(F.count("*").alias("n_rows"), F.sum("p_size").alias("sizes"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 100 AND (c_nationkey IS NULL OR c_nationkey <> 3)")
def select_condition(spark, folder):
    return table(spark, folder, "customer").where(tabular.condition("c_mktsegment == 'BUILDING' and c_acctbal > 100 and c_nationkey != 3")).select("c_custkey", "c_name")


@query(
    """SELECT elem_id FROM page_elements WHERE (content IS NULL OR content <> 'R&D | a == b') AND (coalesce(element_type IN ('image', 'a|b'), false) OR NOT coalesce(page >= 2, false)) AND coalesce(content <> '' OR content IS NULL, true) AND NOT coalesce(content = 'it''s "so"', false)"""
)
def quoted_condition(spark, folder):
    """Operators inside texts are text; comparisons with null are false, so their negation holds."""
    said = """content != 'R&D | a == b' & (element_type in ['image', 'a|b'] | not page >= 2) and content != "" and ~(content == 'it\\'s "so"')"""
    return table(spark, folder, "page_elements").where(tabular.condition(said)).select("elem_id")


@query("SELECT entry_id, source, batch_no::VARCHAR AS batch_no, last_updated FROM manifest")
def cast_columns(spark, folder):
    """A column is cast only if all its values can be: last_updated stays text."""
    return tabular.cast_columns(table(spark, folder, "manifest"), {"batch_no": "string", "last_updated": "bigint"}).select("entry_id", "source", "batch_no", "last_updated")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 500")
def truncated_table(spark, folder):
    """The feature is the cap: a table shown as a whole ends at 500 rows and so many columns."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return tabular.truncated(rows, ["l_orderkey", "l_linenumber"], 500, 3)


_MD = "('| A | B |\n|---|---|\n| 1 | 2 |\n| 3 |  |'), ('no table'), ('')"


@query("SELECT * FROM (VALUES (0, 'A,B'), (1, '1,2'), (2, '3'), (0, 'no table')) t(row_no, cells)")
def markdown_tables(spark, folder):
    rows = spark.sql(f"SELECT * FROM VALUES {_MD} AS t(md)").select(F.posexplode(tabular.markdown_table(F.col("md"))).alias("row_no", "c"))
    return rows.select("row_no", F.array_join("c", ",").alias("cells"))


@query("SELECT doc_id, element_type, count(*)::BIGINT AS n FROM page_elements GROUP BY ALL")
def element_histogram(spark, folder):
    """How many elements of each kind a page has, whatever kinds there are."""
    return table(spark, folder, "page_elements").groupBy("doc_id", "element_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, concat_ws(' - ', nullif((o_orderkey % 5)::VARCHAR, '0'), nullif((o_custkey % 3)::VARCHAR, '0'), nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END, '')) AS id FROM orders")
def joined_ids(spark, folder):
    """Ids out of key parts: zeros and empty texts count for nothing."""
    status = F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(F.col("o_orderstatus"))
    return table(spark, folder, "orders").select("o_orderkey", tabular.group_id(F.col("o_orderkey") % 5, F.col("o_custkey") % 3, status).alias("id"))


@query("SELECT doc_id, page, elem_id, (row_number() OVER (PARTITION BY doc_id, page ORDER BY position, elem_id) * 10)::BIGINT AS step FROM page_elements")
def chunk_steps(spark, folder):
    """Places of chunks on their page, ten apart."""
    at = Window.partitionBy("doc_id", "page").orderBy("position", "elem_id")
    return table(spark, folder, "page_elements").select("doc_id", "page", "elem_id", (F.row_number().over(at) * 10).cast("long").alias("step"))


@query("SELECT doc_id, md5(left(string_agg(coalesce(content, ''), chr(10) ORDER BY position, elem_id), 128000)) AS full_text FROM page_elements GROUP BY doc_id")
def page_texts(spark, folder):
    """All contents of a page in the order of position, up to the size that a summary takes."""
    at = Window.partitionBy("doc_id").orderBy(F.col("position").asc_nulls_last(), "elem_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = table(spark, folder, "page_elements").select("doc_id", "position", "elem_id", F.coalesce("content", F.lit("")).alias("c"))
    # only what begins within the size is collected
    begun = rows.withColumn("before", F.coalesce(F.sum(F.length("c") + 1).over(at), F.lit(0))).where("before < 128000")
    listed = begun.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("before", F.col("position").isNull().alias("last"), "position", "elem_id", "c"))).alias("l"))
    return listed.select("doc_id", F.md5(F.substring(F.array_join(F.transform("l", lambda x: x["c"]), "\n"), 1, 128_000)).alias("full_text"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
