"""Queries of incremental maintenance, tracking, joins and traversals, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import dates, text, urls
from corpusloom.operators import graph, incremental, relational, tracking
from corpusloom.plans.scalars import instant_sql
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


_FP = (
    f"md5(md5(trim(regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g'))) || '|' || "
    "'{\"lang\":' || coalesce('\"' || lang || '\"', 'null') || ',\"site\":' || coalesce('\"' || site || '\"', 'null') || '}' || '|' || 'sig1')"
)


def _fingerprinted(spark, folder):
    """Documents with their fingerprint; bookkeeping keys in the metadata don't count."""
    metadata = F.create_map(F.lit("lang"), "lang", F.lit("site"), "site", F.lit("source"), "source")
    docs = table(spark, folder, "documents").where("doc_key is not null")
    return docs.select("doc_id", "doc_key", "batch_no", incremental.fingerprint(text.content_hash(F.col("text")), metadata, "sig1").alias("fingerprint"))


@query(f"SELECT doc_id, {_FP} AS fingerprint FROM documents WHERE doc_key IS NOT NULL")
def fingerprints(spark, folder):
    return _fingerprinted(spark, folder).select("doc_id", "fingerprint")


@query("SELECT source, doc_id AS key, max(entry_id) AS entry_id, max_by(coalesce(content_hash, ''), entry_id) AS content_hash FROM manifest WHERE coalesce(doc_id, '') <> '' GROUP BY ALL")
def manifest_by_id(spark, folder):
    """The last entry of each id in each source."""
    rows = table(spark, folder, "manifest").where("doc_id is not null and doc_id <> ''")
    last = rows.groupBy("source", F.col("doc_id").alias("key")).agg(F.max_by(F.struct("entry_id", "content_hash"), "entry_id").alias("e"))
    return last.select("source", "key", "e.entry_id", F.coalesce("e.content_hash", F.lit("")).alias("content_hash"))


@query("SELECT url_decode(replace(url, '+', '%2B')) AS key, max_by(doc_id, entry_id) AS doc_id FROM manifest WHERE coalesce(url, '') <> '' GROUP BY 1")
def manifest_by_url(spark, folder):
    return incremental.manifest(table(spark, folder, "manifest"), "entry_id", "url").select("key", "doc_id")


@query(
    f"""WITH d AS (SELECT doc_id, doc_key, batch_no, {_FP} AS fingerprint FROM documents WHERE doc_key IS NOT NULL),
items AS (SELECT doc_key AS key, max_by(fingerprint, doc_id) AS f FROM d WHERE batch_no > 3 GROUP BY 1),
held AS (SELECT doc_key AS key, max_by(fingerprint, doc_id) AS fingerprint, NULL::VARCHAR AS parent FROM d WHERE batch_no <= 9 GROUP BY 1
 UNION ALL SELECT doc_id, max_by(fingerprint, entry_id), max_by(parent_doc_id, entry_id) FROM manifest WHERE parent_doc_id IS NOT NULL GROUP BY 1),
b AS (SELECT coalesce(i.key, h.key) AS key, f, fingerprint, parent FROM items i FULL JOIN held h ON i.key = h.key)
SELECT key, CASE WHEN f IS NOT NULL AND fingerprint IS NULL THEN 'new' WHEN f IS NOT NULL THEN CASE WHEN f = fingerprint THEN 'unchanged' ELSE 'changed' END
 WHEN parent IS NOT NULL AND (parent IN (SELECT key FROM items) OR parent NOT IN (SELECT key FROM held)) THEN 'keep' ELSE 'delete' END AS action FROM b"""
)
def sync_actions(spark, folder):
    items, held = _snapshots(spark, folder)
    return incremental.sync_actions(items, held)


def _snapshots(spark, folder):
    """What the source lists now and what the corpus holds, parts of documents included."""
    docs = _fingerprinted(spark, folder)
    items = docs.where("batch_no > 3").groupBy(F.col("doc_key").alias("key")).agg(F.max_by("fingerprint", "doc_id").alias("fingerprint"))
    held = docs.where("batch_no <= 9").groupBy(F.col("doc_key").alias("key")).agg(F.max_by("fingerprint", "doc_id").alias("fingerprint")).select("key", F.col("key").alias("doc_id"), "fingerprint", F.lit(None).cast("string").alias("parent_doc_id"))
    parts = table(spark, folder, "manifest").where("parent_doc_id is not null").groupBy(F.col("doc_id").alias("key")).agg(F.max_by("fingerprint", "entry_id").alias("fingerprint"), F.max_by("parent_doc_id", "entry_id").alias("parent_doc_id"))
    return items, held.unionByName(parts.select("key", F.col("key").alias("doc_id"), "fingerprint", "parent_doc_id"))


_DELETE = """WITH present AS (SELECT DISTINCT doc_key AS key FROM documents WHERE batch_no {b} AND doc_key IS NOT NULL),
held AS (SELECT doc_id AS key, max_by(parent_doc_id, entry_id) AS parent FROM manifest GROUP BY 1),
ids AS (SELECT h.key FROM held h JOIN present p ON p.key = h.key WHERE h.parent IS NULL)
SELECT key AS doc_id, {r} AS refused FROM held h WHERE NOT CASE WHEN parent IS NULL THEN key IN (SELECT key FROM present) ELSE parent IN (SELECT key FROM ids) OR parent IN (SELECT key FROM present) OR parent NOT IN (SELECT key FROM held) END"""


def _deletions(spark, folder, keep, ratio):
    listed = table(spark, folder, "manifest")
    held = listed.groupBy(F.col("doc_id").alias("key")).agg(F.max_by(F.struct("parent_doc_id"), "entry_id")["parent_doc_id"].alias("parent_doc_id")).withColumn("doc_id", F.col("key"))
    present = table(spark, folder, "documents").where(keep).where("doc_key is not null").select(F.col("doc_key").alias("key"))
    return incremental.plan_deletions(held, present, True, ratio)


@query(_DELETE.format(b="<= 10", r="false").replace("max_by(parent_doc_id, entry_id)", "max_by({'p': parent_doc_id}, entry_id).p"))
def planned_deletions(spark, folder):
    return _deletions(spark, folder, "batch_no <= 10", 0.0)


@query(_DELETE.format(b="= 1", r="true").replace("max_by(parent_doc_id, entry_id)", "max_by({'p': parent_doc_id}, entry_id).p"))
def refused_deletions(spark, folder):
    """A listing that holds far less than the corpus: every deletion is refused."""
    return _deletions(spark, folder, "batch_no = 1", 0.5)


@query(f"SELECT entry_id, coalesce(config_sig = '8871c275b1e6b365' AND sitemap_lastmod <> '' AND NOT coalesce(1590969600000000 > {instant_sql('sitemap_lastmod')}, true), false) AS skipped FROM manifest")
def skipped_before_fetch(spark, folder):
    """A listing dated 2020-06-01 against what was stored: older and unreadable stored signals and other settings are fetched."""
    skipped = incremental.unchanged_before_fetch(F.col("config_sig"), "8871c275b1e6b365", F.col("sitemap_lastmod"), F.lit("2020-06-01"))
    return table(spark, folder, "manifest").select("entry_id", skipped.alias("skipped"))


@query("SELECT doc_id, title FROM documents WHERE batch_no = 12 UNION ALL SELECT doc_id, title FROM documents WHERE batch_no < 12 AND doc_id NOT IN (SELECT doc_id FROM documents WHERE batch_no = 12)")
def upserted_documents(spark, folder):
    docs = table(spark, folder, "documents")
    return incremental.upsert(docs.where("batch_no < 12").select("doc_id", "title"), docs.where("batch_no = 12").select("doc_id", "title"), "doc_id")


@query(
    """WITH a AS (SELECT doc_key, max(n_chars) AS v FROM documents WHERE batch_no <= 8 AND doc_key IS NOT NULL GROUP BY 1), b AS (SELECT doc_key, max(n_chars) AS v FROM documents WHERE batch_no >= 5 AND doc_key IS NOT NULL GROUP BY 1)
SELECT coalesce(a.doc_key, b.doc_key) AS doc_key, CASE WHEN b.doc_key IS NULL THEN 'only_left' WHEN a.doc_key IS NULL THEN 'only_right' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'same' ELSE 'differs' END AS status FROM a FULL JOIN b ON a.doc_key = b.doc_key"""
)
def corpus_difference(spark, folder):
    docs = table(spark, folder, "documents").where("doc_key is not null")
    side = lambda c: docs.where(c).groupBy("doc_key").agg(F.max("n_chars").alias("v"))
    return incremental.corpus_diff(side("batch_no <= 8"), side("batch_no >= 5"), "doc_key", "v")


@query("SELECT DISTINCT doc_id FROM manifest WHERE doc_id NOT IN (SELECT doc_id FROM tracker_log WHERE status = 'indexed' AND doc_id IS NOT NULL) AND doc_id IS NOT NULL")
def unfinished_documents(spark, folder):
    return incremental.unfinished(table(spark, folder, "manifest").where("doc_id is not null").select("doc_id").distinct(), table(spark, folder, "tracker_log"))


@query(
    f"""SELECT DISTINCT m.doc_id, CASE WHEN m.doc_id IN (SELECT doc_id FROM tracker_log WHERE status = 'indexed' AND doc_id IS NOT NULL) THEN 'updated' ELSE 'new' END AS change FROM manifest m
WHERE {instant_sql('last_updated')} > 1609459200000000 AND doc_id IS NOT NULL"""
)
def modified_documents(spark, folder):
    """Whatever is dated after 2021-01-01, in any spelling that can be read."""
    rows = table(spark, folder, "manifest").where(F.col("doc_id").isNotNull())
    indexed = table(spark, folder, "tracker_log").where("status = 'indexed' and doc_id is not null")
    return incremental.modified_within(rows, indexed, "last_updated", "2021-01-01 00:00:00").distinct()


_LISTED = "SELECT DISTINCT doc_key FROM documents WHERE batch_no > 3 AND doc_key IS NOT NULL"


@query(
    f"""WITH m AS (SELECT DISTINCT doc_id FROM manifest WHERE {instant_sql('last_updated')} > 1609459200000000 AND doc_id IS NOT NULL), i AS (SELECT DISTINCT doc_id FROM tracker_log WHERE status = 'indexed' AND doc_id IS NOT NULL)
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM i) THEN 'updated' ELSE 'new' END AS change FROM m UNION ALL SELECT doc_id, 'removed' FROM i WHERE doc_id NOT IN ({_LISTED})"""
)
def windowed_changes(spark, folder):
    """The changes of a window, and what is indexed but not listed any more; the latter only if the listing is complete."""
    indexed = table(spark, folder, "tracker_log").where("status = 'indexed' and doc_id is not null").select("doc_id").distinct()
    listed = table(spark, folder, "documents").where("batch_no > 3 and doc_key is not null").select(F.col("doc_key").alias("doc_id")).distinct()
    return modified_documents(spark, folder).unionByName(incremental.removed(indexed, listed, "doc_id", listing_complete=True))


@query("SELECT crawler_type, source, CASE WHEN crawler_type = 'docs' THEN 'portal' WHEN crawler_type = 's3' THEN 'S3' ELSE crawler_type END AS tag FROM sources")
def source_tags(spark, folder):
    tag = incremental.source_tag(F.lit(""), F.col("crawler_type"), F.lit("portal"))
    return table(spark, folder, "sources").select("crawler_type", "source", tag.alias("tag"))


_SIGNALS = "('application/vnd.google-apps.document','2024-01-01','h1'), ('application/pdf','2024-01-01','h2')"


@query("SELECT * FROM (VALUES ('h1','gdrive-native:2024-01-01'), ('h2','h2')) t(h, signal)")
def content_signals(spark, folder):
    rows = spark.sql(f"SELECT * FROM VALUES {_SIGNALS} AS t(mime, modified, h)")
    return rows.select("h", incremental.content_signal(F.col("mime"), F.col("modified"), F.col("h")).alias("signal"))


# tracking

_LATEST = "SELECT doc_id, crawler_type, max_by({'s': status}, seq).s AS status FROM tracker_log WHERE doc_id IS NOT NULL GROUP BY ALL"


def _latest(spark, folder):
    return tracking.latest(table(spark, folder, "tracker_log").where("doc_id is not null"), "doc_id", "crawler_type")


@query(_LATEST)
def latest_states(spark, folder):
    return _latest(spark, folder).select("doc_id", "crawler_type", "status")


@query(f"WITH l AS ({_LATEST}) SELECT crawler_type, count(*) AS total, count(*) FILTER (status = 'indexed') AS indexed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'auth_required') AS auth_required FROM l GROUP BY 1")
def status_counters(spark, folder):
    return tracking.counters(_latest(spark, folder), "crawler_type")


@query(f"WITH l AS ({_LATEST}) SELECT doc_id FROM l WHERE status = 'failed'")
def failed_documents(spark, folder):
    return _latest(spark, folder).where("status = 'failed'").select("doc_id")


@query("SELECT CASE WHEN doc_id IS NULL THEN 'no_id' WHEN url IS NULL THEN 'no_url' WHEN url NOT LIKE 'http%' THEN 'no_http' WHEN parent_doc_id IS NOT NULL THEN 'part' WHEN content_hash IS NULL THEN 'no_hash' ELSE 'kept' END AS stage, count(*) AS n FROM manifest GROUP BY 1")
def filter_funnel(spark, folder):
    stages = [("no_id", F.col("doc_id").isNull()), ("no_url", F.col("url").isNull()), ("no_http", ~F.col("url").startswith("http")), ("part", F.col("parent_doc_id").isNotNull()), ("no_hash", F.col("content_hash").isNull())]
    return tracking.funnel(table(spark, folder, "manifest"), stages)


@query(f"WITH l AS ({_LATEST}), u AS (SELECT DISTINCT l.doc_id, t.url FROM l JOIN tracker_log t ON t.doc_id = l.doc_id WHERE l.status = 'indexed' AND t.url IS NOT NULL) SELECT url FROM (SELECT DISTINCT url FROM u)")
def indexed_urls_report(spark, folder):
    done = _latest(spark, folder).where("status = 'indexed'").select("doc_id").distinct()
    return table(spark, folder, "tracker_log").where("url is not null").join(done, "doc_id", "left_semi").select("url").distinct()


# joins

@query("SELECT i.doc_id, m.config_sig, m.fingerprint FROM (SELECT doc_id, doc_key FROM documents) i LEFT JOIN (SELECT doc_id AS k, max_by({'s': config_sig, 'f': fingerprint}, entry_id).s AS config_sig, max_by({'s': config_sig, 'f': fingerprint}, entry_id).f AS fingerprint FROM manifest GROUP BY 1) m ON i.doc_key = m.k")
def documents_with_manifest(spark, folder):
    """Prior state by id: the manifest is reduced to one entry a key first; which side is broadcast is the planner's choice by size."""
    held = incremental.manifest(table(spark, folder, "manifest"), "entry_id").select(F.col("key").alias("doc_key"), "config_sig", "fingerprint")
    return table(spark, folder, "documents").select("doc_id", "doc_key").join(held, "doc_key", "left").select("doc_id", "config_sig", "fingerprint")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def referenced_customers(spark, folder):
    return table(spark, folder, "customer").join(table(spark, folder, "orders").where("o_totalprice > 200000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    """WITH l AS (SELECT l_orderkey, list({'p': l_linenumber, 's': l_suppkey} ORDER BY l_linenumber, l_suppkey) AS l FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1)
SELECT o_orderkey, l.l[1].s AS primary_supplier, array_to_string(list_transform(l.l[1:3], lambda x: x.s), ',') AS suppliers FROM orders LEFT JOIN l ON o_orderkey = l_orderkey"""
)
def associated_suppliers(spark, folder):
    """Each order with its first supplier of good standing and at most three in order; missing ones are passed over."""
    links = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"), F.col("l_linenumber").alias("pos"))
    out = relational.associated(table(spark, folder, "orders").select("o_orderkey"), links, table(spark, folder, "supplier").where("s_acctbal > 0"), "o_orderkey", "s_suppkey", "pos", 3)
    return out.select("o_orderkey", F.col("primary").alias("primary_supplier"), F.array_join("children", ",").alias("suppliers"))


@query("SELECT entry_id, coalesce(d.title, m.source) AS title FROM (SELECT entry_id, doc_id, source FROM manifest) m LEFT JOIN (SELECT doc_key, min_by(title, doc_id) AS title FROM documents WHERE title IS NOT NULL GROUP BY 1) d ON m.doc_id = d.doc_key")
def overridden_by_sidecar(spark, folder):
    sidecar = table(spark, folder, "documents").where("title is not null").groupBy(F.col("doc_key").alias("doc_id")).agg(F.min_by("title", "doc_id").alias("title"))
    base = table(spark, folder, "manifest").select("entry_id", "doc_id", F.col("source").alias("title"))
    return relational.override(base, sidecar, "doc_id", ["title"]).select("entry_id", "title")


_IMAGES = "SELECT doc_id, image_id AS a, elem_id FROM page_elements WHERE image_id IS NOT NULL"


@query(
    f"""WITH l AS (SELECT doc_id, a, min(elem_id) AS p FROM ({_IMAGES}) GROUP BY ALL), r AS (SELECT doc_id, left(a, length(a) - 1) AS b, p FROM l UNION SELECT doc_id, a, p FROM l WHERE length(a) % 2 = 0)
SELECT l.doc_id, a, min_by(b, CASE WHEN a = b THEN (0, 0, '') ELSE (1, r.p, b) END) AS b FROM l JOIN r ON l.doc_id = r.doc_id WHERE a = b OR contains(a, b) OR contains(b, a) GROUP BY ALL"""
)
def matched_pictures(spark, folder):
    """Picture ids against names that are cut short or equal, within each page: an equal one, else the first stored."""
    left = table(spark, folder, "page_elements").where("image_id is not null").groupBy("doc_id", F.col("image_id").alias("a")).agg(F.min("elem_id").alias("p"))
    right = left.selectExpr("doc_id", "left(a, length(a) - 1) AS b", "p").union(left.where("length(a) % 2 = 0").selectExpr("doc_id", "a", "p"))
    return relational.matched_by_containment(left, right, "doc_id", "a", "b", "p").select("doc_id", "a", "b")


_PERMISSIONS = """SELECT rec_id, unnest(l) AS p, generate_subscripts(l, 1) AS pos FROM (SELECT rec_id, from_json(json_extract_string(payload, '$.metadata.permissions')::JSON, '[{"id":"VARCHAR","type":"VARCHAR","role":"VARCHAR","emailAddress":"VARCHAR","domain":"VARCHAR","deleted":"BOOLEAN"}]') AS l FROM (SELECT rec_id, ltrim(payload, chr(65279)) AS payload FROM raw_records) WHERE json_valid(payload) AND json_extract_string(payload, '$.metadata.permissions') LIKE '[%')"""


def _permissions(spark, folder):
    # element by element, so that one odd element doesn't lose the others
    kind = "struct<id:string,type:string,role:string,emailAddress:string,domain:string,deleted:boolean>"
    raw = F.get_json_object("payload", "$.metadata.permissions")
    rows = table(spark, folder, "raw_records").select("rec_id", F.ltrim("payload", F.lit("\ufeff")).alias("payload")).where(F.try_parse_json("payload").isNotNull() & raw.startswith("["))
    return rows.select("rec_id", F.posexplode(F.from_json(raw, "array<string>")).alias("pos", "e")).where("e like '{%'").select("rec_id", "pos", F.from_json("e", kind).alias("p")).select("rec_id", "pos", "p.id", "p.type", "p.role", F.col("p.emailAddress").alias("email"), "p.domain", "p.deleted")


@query(
    f"""WITH q AS ({_PERMISSIONS}), k AS (SELECT * FROM q WHERE p IS NOT NULL QUALIFY p.id IS NULL OR p.id = '' OR row_number() OVER (PARTITION BY rec_id, p.id ORDER BY pos) = 1),
f AS (SELECT rec_id, p.type AS type, p.role AS role, nullif(lower(p.emailAddress), '') AS mail, nullif(lower(p.domain), '') AS dom FROM k WHERE NOT coalesce(p.deleted, false))
SELECT rec_id, coalesce(string_agg(DISTINCT mail, ',' ORDER BY mail) FILTER (type = 'user' AND role = 'owner'), '') AS owners, coalesce(string_agg(DISTINCT mail, ',' ORDER BY mail) FILTER (type = 'user' AND role IN ('reader', 'commenter', 'writer', 'fileOrganizer', 'organizer')), '') AS readers,
coalesce(string_agg(DISTINCT mail, ',' ORDER BY mail) FILTER (type = 'group'), '') AS groups, coalesce(string_agg(DISTINCT dom, ',' ORDER BY dom) FILTER (type = 'domain'), '') AS domains, coalesce(bool_or(type = 'anyone'), false) AS is_public, coalesce(bool_or(type = 'domain' AND dom IS NOT NULL), false) AS is_org_wide FROM f GROUP BY 1"""
)
def access_lists(spark, folder):
    return relational.access_lists(_permissions(spark, folder), "rec_id", "pos")


@query(
    f"""WITH q AS ({_PERMISSIONS}), o AS (SELECT rec_id, p.type AS type, p.id AS id, p.role AS role, pos FROM q WHERE p IS NOT NULL AND p.id IS NOT NULL), i AS (SELECT DISTINCT rec_id, 'domain' AS type, id, 'inherited' AS role, 0 AS pos FROM o WHERE type = 'domain')
SELECT rec_id, type, id, min_by({{'x': role}}, (r, pos)).x AS role FROM (SELECT *, 0 AS r FROM i UNION ALL SELECT *, 1 AS r FROM o) GROUP BY 1, 2, 3"""
)
def merged_permissions(spark, folder):
    own = _permissions(spark, folder).where("id is not null").select("rec_id", "type", "id", "role", "pos")
    inherited = own.where("type = 'domain'").select("rec_id", "type", "id", F.lit("inherited").alias("role"), F.lit(0).alias("pos")).distinct()
    return relational.merged_permissions(own, inherited, ["rec_id", "type", "id"], "pos").drop("pos")


@query(
    """WITH s AS (SELECT s_suppkey, s_name FROM supplier), t AS (SELECT o_orderkey, 'from <@' || (o_orderkey % 150) || '> to <@' || (o_orderkey % 7) || '>' AS m FROM orders)
SELECT o_orderkey, 'from ' || coalesce('@' || a.s_name, '<@' || (o_orderkey % 150) || '>') || ' to ' || coalesce('@' || b.s_name, '<@' || (o_orderkey % 7) || '>') AS m FROM t LEFT JOIN s a ON a.s_suppkey = o_orderkey % 150 LEFT JOIN s b ON b.s_suppkey = o_orderkey % 7"""
)
def substituted_names(spark, folder):
    message = F.concat(F.lit("from <@"), F.col("o_orderkey") % 150, F.lit("> to <@"), F.col("o_orderkey") % 7, F.lit(">"))
    rows = table(spark, folder, "orders").select("o_orderkey", message.alias("m"))
    names = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    return relational.substituted(rows, "o_orderkey", "m", names, r"<@(\d+)>")


@query("SELECT doc_id, title, crawler_type, locale FROM documents LEFT JOIN sources USING (source)")
def decorated_documents(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "source", "title")
    return rows.join(table(spark, folder, "sources").select("source", "crawler_type", "locale"), "source", "left").select("doc_id", "title", "crawler_type", "locale")


# order, limits, sets

@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_orders(spark, folder):
    """A top-k report: ties keep the input's order."""
    return table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' ORDER BY l_orderkey, l_linenumber LIMIT 40 OFFSET 100")
def skipped_and_taken(spark, folder):
    """Start row and number of rows are what the hub scan is asked for."""
    return table(spark, folder, "lineitem").where("l_returnflag = 'R'").orderBy("l_orderkey", "l_linenumber").offset(100).limit(40).select("l_orderkey", "l_linenumber")


@query("SELECT url, entry_id FROM manifest WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY entry_id) = 1")
def first_of_each_url(spark, folder):
    return relational.first_of(table(spark, folder, "manifest").where("url is not null").select("url", "entry_id"), ["url"], "entry_id")


@query("SELECT c_custkey AS id FROM customer WHERE c_acctbal > 5000 UNION SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def united_ids(spark, folder):
    return table(spark, folder, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("id")).union(table(spark, folder, "orders").where("o_totalprice > 300000").select("o_custkey")).distinct()


@query("SELECT doc_id FROM manifest WHERE batch_no <= 6 INTERSECT SELECT doc_id FROM manifest WHERE batch_no > 6")
def listed_again(spark, folder):
    m = table(spark, folder, "manifest")
    return m.where("batch_no <= 6").select("doc_id").intersect(m.where("batch_no > 6").select("doc_id"))


@query("SELECT doc_id, greatest(max(created_at), max(updated_at)) AS last_seen FROM tracker_log WHERE doc_id IS NOT NULL GROUP BY 1")
def last_seen(spark, folder):
    return table(spark, folder, "tracker_log").where("doc_id is not null").groupBy("doc_id").agg(F.greatest(F.max("created_at"), F.max("updated_at")).alias("last_seen"))


# traversals

_EDGES = "SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem UNION SELECT DISTINCT 's' || l_suppkey, 'p' || l_partkey FROM lineitem"


@query(f"WITH RECURSIVE e AS MATERIALIZED ({_EDGES}), r(id, depth) AS (SELECT 'p1', 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.id WHERE r.depth < 3) SELECT id, min(depth) AS depth FROM r GROUP BY id")
def reached_pages(spark, folder):
    """Breadth first over links, three steps deep."""
    l = table(spark, folder, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("p"), F.concat(F.lit("s"), "l_suppkey").alias("s")).distinct()
    edges = l.select(F.col("p").alias("src"), F.col("s").alias("dst")).union(l.select("s", "p"))
    return graph.reach(spark.sql("SELECT 'p1' AS id"), edges, 3)


@query(f"WITH RECURSIVE e AS MATERIALIZED (SELECT * FROM ({_EDGES}) WHERE NOT regexp_matches(dst, '^(?:p.*[05])$')), r(id, depth) AS (SELECT 'p1', 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.id WHERE r.depth < 2) SELECT id, min(depth) AS depth FROM r GROUP BY id")
def reached_allowed_pages(spark, folder):
    """The same with a negative pattern on where links lead."""
    l = table(spark, folder, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("p"), F.concat(F.lit("s"), "l_suppkey").alias("s")).distinct()
    edges = l.select(F.col("p").alias("src"), F.col("s").alias("dst")).union(l.select("s", "p"))
    return graph.reach(spark.sql("SELECT 'p1' AS id"), edges, 2, urls.matches(F.col("dst"), [], [r"p.*[05]$"]))


@query(
    """WITH RECURSIVE n AS (SELECT doc_id, max_by({'p': parent_doc_id, 's': source}, entry_id) AS e FROM manifest WHERE doc_id IS NOT NULL GROUP BY 1), t AS (SELECT doc_id, e.p AS parent, e.s AS source FROM n),
r AS (SELECT doc_id, doc_id AS path, coalesce(source, '') AS vals, 0 AS level FROM t WHERE parent IS NULL OR parent NOT IN (SELECT doc_id FROM t) UNION ALL SELECT t.doc_id, r.path || '/' || t.doc_id, r.vals || '/' || coalesce(t.source, ''), level + 1 FROM t JOIN r ON t.parent = r.doc_id)
SELECT doc_id, path, vals AS "values", level FROM r"""
)
def inherited_paths(spark, folder):
    """Paths and inherited sources down the tree of parts."""
    nodes = table(spark, folder, "manifest").where("doc_id is not null").groupBy("doc_id").agg(F.max_by(F.struct("parent_doc_id", "source"), "entry_id").alias("e")).select("doc_id", "e.parent_doc_id", "e.source")
    return graph.inherited(nodes, "doc_id", "parent_doc_id", "source")


@query(f"SELECT entry_id, coalesce({instant_sql('last_updated')} BETWEEN 1546300800000000 AND 1640995199000000, true) AS kept FROM manifest")
def kept_by_date(spark, folder):
    """Null and unreadable dates are kept."""
    return table(spark, folder, "manifest").select("entry_id", dates.in_range(F.col("last_updated"), "2019-01-01", "2021-12-31").alias("kept"))


@query("SELECT doc_id, seq, (row_number() OVER (PARTITION BY doc_id ORDER BY seq))::BIGINT AS n FROM (SELECT DISTINCT doc_id, seq FROM tracker_log WHERE doc_id IS NOT NULL)")
def numbered_states(spark, folder):
    rows = table(spark, folder, "tracker_log").where("doc_id is not null").select("doc_id", "seq").distinct()
    return rows.select("doc_id", "seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("seq")).cast("long").alias("n"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
