"""Queries of the scalar functions, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import dates, files, pii, text, urls
from corpusloom.sources.tables import table

QUERIES, SQL = {}, {}
_WS = r"[\t-\r \x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _collapsed(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_WS}+', ' ', 'g'))"


def query(sql: str | None = None):
    def take(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return take


def instant_sql(c: str) -> str:
    """parse_instant in DuckDB's SQL."""
    v = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    zone = f"upper(regexp_extract({v}, '([A-Za-z]+)$', 1))"
    offsets = " ".join(f"WHEN '{name}' THEN '{offset}'" for name, offset in dates.ZONES.items())
    bare = f"regexp_replace({v}, '^[A-Za-z]{{3}},\\s*', '')"
    text = f"CASE WHEN {zone} = '' THEN {bare} ELSE regexp_replace({bare}, '\\s*[A-Za-z]+$', '') || ' ' || CASE {zone} {offsets} END END"
    iso = f"regexp_replace(regexp_replace(upper({v}), '\\s*(Z|[+-]\\d{{2}}:?\\d{{2}})$', '\\1'), '([+-]\\d{{2}}):?(\\d{{2}})$', '\\1:\\2')"
    return (
        f"CASE WHEN regexp_matches({v}, '^\\d{{5,}}(\\.\\d+)?$') THEN TRY_CAST(round(TRY_CAST({v} AS DOUBLE) * 1000000) AS BIGINT) "
        f"WHEN regexp_matches({v}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN epoch_us(TRY_CAST({v} AS TIMESTAMP)) "
        f"WHEN regexp_matches({v}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]\\d{{2}}:\\d{{2}}(:\\d{{2}}([.]\\d{{1,9}})?)?\\s*(Z|z|[+-]\\d{{2}}:?\\d{{2}})?$') THEN epoch_us(TRY_CAST({iso} AS TIMESTAMPTZ)) "
        f"WHEN regexp_matches({v}, '^([A-Za-z]{{3}},\\s*)?\\d{{1,2}} [A-Z][a-z]{{2}} \\d{{4}} \\d{{2}}:\\d{{2}}:\\d{{2}} ([+-]\\d{{4}}|[A-Za-z]{{1,4}})$') THEN epoch_us(try_strptime({text}, '%d %b %Y %H:%M:%S %z')) END"
    )


def inline(spark: SparkSession, values: str, names: str) -> DataFrame:
    """A small fixture, written as VALUES in both engines."""
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


@query(f"SELECT doc_id, md5({_collapsed('text')}) AS content_hash FROM documents")
def content_hash(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query("SELECT entry_id, CASE WHEN length(doc_id) < 40 THEN doc_id ELSE left(doc_id, 40) || '-' || left(sha256(doc_id), 16) END AS id FROM manifest")
def generated_document_id(spark, folder):
    return table(spark, folder, "manifest").select("entry_id", text.document_id(F.col("doc_id"), 40).alias("id"))


_SLUG = "regexp_replace(regexp_replace(replace(translate(lower({0}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), 'ß', 'ss'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"SELECT doc_id, {_SLUG.format('title')} AS slug, {_SLUG.format('title')} || '-' || left(sha256(title), 12) AS slug_id FROM documents WHERE title IS NOT NULL")
def slug_ids(spark, folder):
    return table(spark, folder, "documents").where("title is not null").select("doc_id", text.slug(F.col("title")).alias("slug"), text.slug_id(F.col("title")).alias("slug_id"))


@query(f"SELECT elem_id, trim(regexp_replace(regexp_replace(coalesce(content, ''), '<[^>]+>', ' ', 'g'), '{_WS}+', ' ', 'g')) AS plain FROM page_elements")
def html_stripped(spark, folder):
    return table(spark, folder, "page_elements").select("elem_id", text.strip_tags(F.col("content")).alias("plain"))


@query(f"SELECT doc_id, regexp_replace(trim(text), '[<>]+', '', 'g') AS email_text, trim(regexp_replace(regexp_replace(text, '@[A-Za-z0-9_]+', '', 'g'), '{_WS}+', ' ', 'g')) AS tweet_text FROM documents")
def cleaned_messages(spark, folder):
    c = F.col("text")
    return table(spark, folder, "documents").select("doc_id", text.clean_email(c).alias("email_text"), text.clean_tweet(c).alias("tweet_text"))


@query("SELECT doc_id, concat_ws(' - ', title, lang, source) AS joined FROM documents")
def joined_text_columns(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.join_texts(F.col("title"), F.col("lang"), F.col("source")).alias("joined"))


@query("SELECT doc_id, md5(nfc_normalize(text)) AS composed FROM documents")
def normalised_text(spark, folder):
    """Decomposed and composed again, which equals composing once."""
    return table(spark, folder, "documents").select("doc_id", F.md5(text.nfc(text.nfd("text"))).alias("composed"))


_W = "(CASE WHEN contains(url, '://') THEN url ELSE 'http://' || url END)"
_PATH = f"regexp_replace(regexp_extract({_W}, '^[^:]+://[^/?#]*([^?#]*)', 1), ';[^/;]*$', '')"
_NORM = f"lower(regexp_extract({_W}, '^([^:]+)://', 1)) || '://' || regexp_replace(regexp_extract({_W}, '^[^:]+://([^/?#]*)', 1), '^www\\.', '') || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END"


@query(f"SELECT entry_id, {_NORM} AS url_key FROM manifest WHERE url IS NOT NULL")
def normalised_urls(spark, folder):
    return table(spark, folder, "manifest").where("url is not null").select("entry_id", urls.normalize_url(F.col("url")).alias("url_key"))


@query(f"SELECT DISTINCT {_NORM} AS url_key FROM manifest WHERE url IS NOT NULL")
def clean_urls(spark, folder):
    return table(spark, folder, "manifest").where("url is not null").select(urls.normalize_url(F.col("url")).alias("url_key")).distinct()


_URLS = """('HTTPS://www.Example.com/Path;v=1?a=b#c'), ('example.com/path'), ('https://example.com'), ('https://example.com/a b.PDF?x=1'), ('https://sites.google.com/u/0/d/abc%20d/p/xyz/edit'), ('https://other.com/u/0/x'), ('https://example.com/a+b%2Bc'), ('https://example.com/.profile'), ('https://example.com/dir/file.tar.GZ/')"""
_NORMQ = f"{_NORM} || CASE WHEN regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) <> '' THEN '?' || regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) ELSE '' END"
_DECODED = "url_decode(replace(url, '+', '%2B'))"
_EXT = "lower(regexp_extract(regexp_extract({0}, '^(?:[^:/?#]+://[^/?#]*)?([^?#]*)', 1), '[^/.][^/]*?(\\.[^./]+)/*$', 1))"


@query(
    f"WITH t(url) AS (VALUES {_URLS}) SELECT url, {_NORM} AS normal, {_NORMQ} AS normal_with_query, "
    f"CASE WHEN regexp_matches(lower(regexp_extract({_DECODED}, '^[^:]+://([^/?#]*)', 1)), '(^|\\.)google\\.com$') THEN regexp_replace({_DECODED}, '^([^:]+://[^/]+)/u/\\d+/', '\\1/') ELSE {_DECODED} END AS metadata_url, "
    f"{_EXT.format('url')} AS extension FROM t"
)
def url_functions(spark, folder):
    u = F.col("url")
    return inline(spark, _URLS, "url").select(
        "url", urls.normalize_url(u).alias("normal"), urls.normalize_url(u, keep_query=True).alias("normal_with_query"), urls.metadata_url(u).alias("metadata_url"), urls.extension(u).alias("extension")
    )


@query(
    """WITH m AS (SELECT entry_id, """
    + _EXT.format("url")
    + """ AS ext FROM manifest WHERE url IS NOT NULL)
SELECT ext, CASE WHEN ltrim(ext, '.') IN ('gif','jpeg','jpg','mng','bmp','tiff','tif','png','svg','ico','webp') THEN 'image' WHEN ltrim(ext, '.') IN ('pdf','doc','docx','ppt','pptx','rtf','odt','epub','md','txt','html','htm') THEN 'document'
WHEN ltrim(ext, '.') IN ('csv','tsv','psv','pipe','xls','xlsx') THEN 'dataframe' WHEN ltrim(ext, '.') IN ('zip','gz','tar','bz2','7z','rar') THEN 'archive' WHEN ltrim(ext, '.') IN ('mp3','wav','flac','aac','ogg','m4a') THEN 'audio'
WHEN ltrim(ext, '.') IN ('mp4','avi','mov','wmv','webm','mkv') THEN 'video' ELSE 'other' END AS class, count(*) AS n FROM m GROUP BY ALL"""
)
def extension_classes(spark, folder):
    ext = urls.extension(F.col("url"))
    return table(spark, folder, "manifest").where("url is not null").select(ext.alias("ext")).groupBy("ext").agg(F.count("*").alias("n")).select("ext", urls.extension_class(F.col("ext")).alias("class"), "n")


@query("SELECT entry_id, url FROM manifest WHERE regexp_matches(url, '^(?:https?://(docs|wiki)\\.)') AND NOT regexp_matches(url, '^(?:.*/(a|x)/)')")
def urls_matching_patterns(spark, folder):
    return table(spark, folder, "manifest").where(urls.matches(F.col("url"), [r"https?://(docs|wiki)\."], [".*/(a|x)/"])).select("entry_id", "url")


@query(
    f"""WITH u AS (SELECT entry_id, url, {_NORM} AS url_key FROM manifest WHERE url LIKE 'http%' AND NOT regexp_matches({_EXT.format("url")}, '^\\.(zip|gz|tar|bz2|7z|rar|gif|jpeg|jpg|mng|bmp|tiff|tif|png|svg|ico|webp)$'))
SELECT entry_id, url_key FROM u QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY entry_id) = 1"""
)
def url_gate(spark, folder):
    """Crawlable URLs, the first of each normalised form: an aggregate keeps the first, no window sort."""
    u = F.col("url")
    kept = table(spark, folder, "manifest").where(u.startswith("http") & ~urls.extension_class(urls.extension(u)).isin("archive", "image"))
    return kept.groupBy(urls.normalize_url(u).alias("url_key")).agg(F.min("entry_id").alias("entry_id"))


_REDIRECTS = "('https://docs.site.com/a','https://login.microsoftonline.com/x'), ('https://docs.site.com/a','https://tenant.okta.com/y'), ('https://docs.site.com/a','https://docs.site.com/b'), ('https://login.microsoftonline.com/a','https://login.microsoftonline.com/b'), ('https://docs.site.com/a','https://notokta.com/'), ('https://docs.site.com/a', CAST(NULL AS STRING))"


@query(
    "WITH t(asked, got) AS (VALUES "
    + _REDIRECTS
    + "), h AS (SELECT *, lower(regexp_extract(asked, '^[^:]+://([^/?#]*)', 1)) AS a, lower(regexp_extract(got, '^[^:]+://([^/?#]*)', 1)) AS g FROM t) "
    + "SELECT asked, got, coalesce(a <> g AND regexp_matches(g, '(^|\\.)(login\\.microsoftonline\\.com|accounts\\.google\\.com|okta\\.com|auth0\\.com|onelogin\\.com|login\\.example)$'), false) AS is_sign_in FROM h"
)
def sign_in_redirects(spark, folder):
    return inline(spark, _REDIRECTS, "asked, got").select("asked", "got", urls.sign_in_redirect(F.col("asked"), F.col("got")).alias("is_sign_in"))


_HOURS = "('48h'), ('2d'), ('48'), ('x'), (' 7D ')"


@query(f"WITH t(v) AS (VALUES {_HOURS}) SELECT v, TRY_CAST(regexp_extract(trim(v), '^(\\d+)\\s*[hdHD]?$', 1) AS BIGINT) * CASE WHEN lower(trim(v)) LIKE '%d' THEN 86400 ELSE 3600 END AS seconds FROM t")
def hours_back(spark, folder):
    return inline(spark, _HOURS, "v").select("v", dates.hours_back(F.col("v")).alias("seconds"))


_CLOCK = "('00:01:02.500'), ('1:00:00'), ('x')"


@query(
    f"WITH t(v) AS (VALUES {_CLOCK}), p AS (SELECT v, regexp_extract(v, '^(\\d+):(\\d+):(\\d+)(?:[.,](\\d+))?$', ['h','m','s','f']) AS q FROM t) SELECT v, TRY_CAST(q.h AS DOUBLE) * 3600 + TRY_CAST(q.m AS DOUBLE) * 60 + TRY_CAST(q.s AS DOUBLE) + coalesce(TRY_CAST(q.f AS DOUBLE), 0) / 1000 AS seconds FROM p"
)
def clock_seconds(spark, folder):
    return inline(spark, _CLOCK, "v").select("v", dates.clock_seconds(F.col("v")).alias("seconds"))


@query(f"SELECT entry_id, {instant_sql('sitemap_lastmod')} AS us FROM manifest WHERE sitemap_lastmod IS NOT NULL")
def parsed_instants(spark, folder):
    """Every entry with a date, null where it can't be read."""
    return table(spark, folder, "manifest").where("sitemap_lastmod is not null").select("entry_id", dates.parse_instant(F.col("sitemap_lastmod")).alias("us"))


_NEWER = "('2024-02-01','2024-01-01'), ('2024-01-01','2024-01-01'), ('2023-01-01','2024-01-01'), ('Thu, 01 Feb 2024 00:00:00 GMT','Mon, 01 Jan 2024 00:00:00 GMT'), ('2000000000','1000000000'), ('1000000000','2000000000'), (CAST(NULL AS STRING),'2024-01-01'), ('garbage','2024-01-01'), ('2024-01-02T00:00:00Z','2024-01-01')"


@query(
    "SELECT * FROM (VALUES ('2024-02-01','2024-01-01',true), ('2024-01-01','2024-01-01',false), ('2023-01-01','2024-01-01',false), ('Thu, 01 Feb 2024 00:00:00 GMT','Mon, 01 Jan 2024 00:00:00 GMT',true), ('2000000000','1000000000',true), ('1000000000','2000000000',false), (NULL,'2024-01-01',true), ('garbage','2024-01-01',true), ('2024-01-02T00:00:00Z','2024-01-01',true)) t(current, stored, newer)"
)
def source_is_newer(spark, folder):
    return inline(spark, _NEWER, "current, stored").select("current", "stored", dates.is_newer(F.col("current"), F.col("stored")).alias("newer"))


@query(
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-06-30 23:59:59'"
)
def date_range_window(spark, folder):
    rows = table(spark, folder, "orders")
    return rows.where(F.col("o_orderdate").between(F.expr("TIMESTAMP_NTZ'1996-01-01 00:00:00'"), F.expr("TIMESTAMP_NTZ'1996-06-30 23:59:59'"))).select("o_orderkey", "o_orderpriority")


def _masked_sql(c: str) -> str:
    for name, pattern in pii.MASKS:
        c = f"regexp_replace({c}, '{pattern}', '<{name}>', 'g')"
    return c


@query(f"SELECT sec_id, md5({_masked_sql('text')}) AS masked FROM doc_sections WHERE text IS NOT NULL UNION ALL SELECT rec_id, md5({_masked_sql('payload')}) FROM raw_records")
def masked_pii(spark, folder):
    sections = table(spark, folder, "doc_sections").where("text is not null").select("sec_id", F.md5(pii.mask(F.col("text"))).alias("masked"))
    return sections.unionAll(table(spark, folder, "raw_records").select("rec_id", F.md5(pii.mask(F.col("payload")))))


def _language_sql() -> str:
    n = {k: f"len(list_filter(w, lambda x: x IN ({', '.join(repr(v) for v in vs)})))" for k, vs in sorted(pii.STOP_WORDS.items())}
    best = f"greatest({', '.join(n.values())})"
    return "CASE " + f"WHEN {best} = 0 THEN 'en' " + " ".join(f"WHEN {x} = {best} THEN '{k}'" for k, x in n.items()) + " END"


@query(f"WITH d AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\\p{{L}}]+') AS w FROM documents) SELECT doc_id, {_language_sql()} AS language FROM d")
def guessed_language(spark, folder):
    return table(spark, folder, "documents").select("doc_id", pii.language(F.col("text")).alias("language"))


_FILES = "('a.JPG','ffd8ffe000104a46'), ('b','89504e470d0a1a0a'), ('c.gif','474946383961aabb'), ('d.ico','00000100aabbccdd'), ('e.gif','00'), ('f','11')"


@query("SELECT * FROM (VALUES ('a.JPG','image/jpeg'), ('b','image/png'), ('c.gif','image/gif'), ('d.ico','image/x-icon'), ('e.gif','image/gif'), ('f','image/png')) t(name, mime)")
def sniffed_mime(spark, folder):
    return inline(spark, _FILES, "name, bytes").select("name", files.image_mime(F.unhex("bytes"), F.col("name")).alias("mime"))


@query(
    """SELECT rec_id, CASE WHEN left(lower(ltrim(left(payload, 1000))), 5) = '<?xml' THEN 'xml' WHEN contains(lower(ltrim(left(payload, 1000))), '<html') THEN 'html' WHEN left(ltrim(left(payload, 1000)), 1) = '<' THEN 'xml' ELSE 'text' END AS kind FROM raw_records
UNION ALL SELECT * FROM (VALUES (-1, 'xml'), (-2, 'html'), (-3, 'xml'), (-4, 'text')) t(rec_id, kind)"""
)
def markup_types(spark, folder):
    extra = inline(spark, "(-1L, '<?xml version=\"1.0\"?><a/>'), (-2L, ' <!doctype html><HTML>'), (-3L, '<feed/>'), (-4L, 'plain')", "rec_id, payload")
    return table(spark, folder, "raw_records").select("rec_id", "payload").unionByName(extra).select("rec_id", files.markup_type(F.col("payload")).alias("kind"))


_GDRIVE = "application/vnd.google-apps."
_MIMES = f"('a.','{_GDRIVE}document'), ('b','{_GDRIVE}spreadsheet'), ('c.PPTX','{_GDRIVE}presentation'), ('d','video/mp4'), ('e','image/png'), ('f','{_GDRIVE}form'), ('g.pdf','application/pdf'), ('h', CAST(NULL AS STRING))"


@query("SELECT * FROM (VALUES ('a.', true, 'a.docx'), ('b', true, 'b.xlsx'), ('c.PPTX', true, 'c.PPTX'), ('d', false, 'd'), ('e', false, 'e'), ('f', false, 'f'), ('g.pdf', true, 'g.pdf'), ('h', true, 'h')) t(name, kept, exported)")
def mime_gate(spark, folder):
    n, m = F.col("name"), F.col("mime")
    return inline(spark, _MIMES, "name, mime").select("name", files.mime_kept(m).alias("kept"), files.exported_name(n, m).alias("exported"))


_SKIP = "('Thumbs.db','/a'), ('.hidden','/a'), ('~x.docx','/a'), ('page.aspx','/a'), ('ok.docx','/a/Forms/b'), ('ok.docx','/a/b')"


@query("SELECT * FROM (VALUES ('Thumbs.db','/a',true), ('.hidden','/a',true), ('~x.docx','/a',true), ('page.aspx','/a',true), ('ok.docx','/a/Forms/b',true), ('ok.docx','/a/b',false)) t(name, path, skipped)")
def skipped_files(spark, folder):
    return inline(spark, _SKIP, "name, path").select("name", "path", files.skipped_file(F.col("name"), F.col("path")).alias("skipped"))


_ROUTES = "('.csv',10L), ('.pdf',99999999L), ('.pdf',10L), ('.html',5L), ('.bin',1L)"


@query("SELECT * FROM (VALUES ('.csv',10,'dataframe'), ('.pdf',99999999,'split'), ('.pdf',10,'local'), ('.html',5,'local'), ('.bin',1,'raw')) t(ext, n_bytes, route)")
def processing_paths(spark, folder):
    return inline(spark, _ROUTES, "ext, n_bytes").select("ext", "n_bytes", files.processing_path(F.col("ext"), F.col("n_bytes"), True, 20).alias("route"))


@query("SELECT p_partkey, (s - s % 10)::BIGINT AS first, least(s - s % 10 + 10, p_size)::BIGINT AS last FROM part, LATERAL (SELECT unnest(range(0, p_size, 10)) AS s)")
def page_batches(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", F.explode(files.page_batches(F.col("p_size"), 10)).alias("b"))
    return rows.select("p_partkey", F.col("b.first").cast("long").alias("first"), F.col("b.end").cast("long").alias("last"))


_SECRETS = "('api_key','abc'), ('user','bob'), ('Password','x'), ('auth_token','y')"


@query("SELECT * FROM (VALUES ('api_key','***'), ('user','bob'), ('Password','***'), ('auth_token','***')) t(name, value)")
def masked_secrets(spark, folder):
    return inline(spark, _SECRETS, "name, value").select("name", files.mask_secrets(F.col("name"), F.col("value")).alias("value"))


_REPLIES = r"""('```json\n{"a": 1}\n```'), ('{"b": "x"}'), ('no json')"""


@query("""SELECT * FROM (VALUES ('{"a":1}'), ('{"b":"x"}'), ('{}')) t(parsed)""")
def model_replies(spark, folder):
    return inline(spark, _REPLIES, "reply").select(text.strip_fences(F.col("reply")).alias("parsed"))


_CHAT = "('see <https://a.com/x|label> and https://b.com/y?a=1&amp;b=2 again https://a.com/x'), ('no url')"


@query("SELECT * FROM (VALUES ('https://a.com/x https://b.com/y?a=1&b=2', true), ('', false)) t(found, has_url)")
def message_urls(spark, folder):
    u = text.distinct_urls(F.col("t"))
    return inline(spark, _CHAT, "t").select(u.alias("found"), (u != "").alias("has_url"))


_MAX = "('20MB'), ('5'), (' 7 mb '), ('big')"


@query("SELECT * FROM (VALUES ('20MB', 20), ('5', 5), (' 7 mb ', 7), ('big', NULL)) t(v, megabytes)")
def size_limits(spark, folder):
    return inline(spark, _MAX, "v").select("v", dates.size_megabytes(F.col("v")).alias("megabytes"))


@query("SELECT entry_id, regexp_extract('A document with id ''' || doc_id || ''' exists', 'document with id ''([^'']+)''', 1) AS conflicting FROM manifest")
def conflict_ids(spark, folder):
    """The id that a store's conflict message names."""
    message = F.concat(F.lit("A document with id '"), F.col("doc_id"), F.lit("' exists"))
    return table(spark, folder, "manifest").select("entry_id", F.regexp_extract(message, "document with id '([^']+)'", 1).alias("conflicting"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
