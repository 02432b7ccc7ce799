"""URL functions as columns. Patterns rather than parse_url, which fails on spaces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Classes of file extensions.
EXTENSIONS = {
    "image": ("gif", "jpeg", "jpg", "mng", "bmp", "tiff", "tif", "png", "svg", "ico", "webp"),
    "audio": ("mp3", "wav", "flac", "aac", "ogg", "m4a"),
    "video": ("mp4", "avi", "mov", "wmv", "webm", "mkv"),
    "document": ("pdf", "doc", "docx", "ppt", "pptx", "rtf", "odt", "epub", "md", "txt", "html", "htm"),
    "dataframe": ("csv", "tsv", "psv", "pipe", "xls", "xlsx"),
    "archive": ("zip", "gz", "tar", "bz2", "7z", "rar"),
}

#: Hosts of identity providers, by which a redirect to a sign-in page is known.
SIGN_IN_HOSTS = ("login.microsoftonline.com", "accounts.google.com", "okta.com", "auth0.com", "onelogin.com", "login.example")


def _absolute(u: Column) -> Column:
    return F.when(F.instr(u, "://") > 0, u).otherwise(F.concat(F.lit("http://"), u))


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(_absolute(u), r"^([^:]+)://", 1))


def host(u: Column) -> Column:
    return F.regexp_extract(_absolute(u), r"^[^:]+://([^/?#]*)", 1)


def path(u: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(_absolute(u), r"^[^:]+://[^/?#]*([^?#]*)", 1), r";[^/;]*$", "")


def query(u: Column) -> Column:
    return F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)


def normalize_url(u: Column, keep_query: bool = False) -> Column:
    """Scheme added, 'www.' off, empty path to '/', fragment, parameters and (unless kept) query off."""
    where = path(u)
    out = F.concat(scheme(u), F.lit("://"), F.regexp_replace(host(u), r"^www\.", ""), F.when(where == "", "/").otherwise(where))
    return F.concat(out, F.when(query(u) != "", F.concat(F.lit("?"), query(u))).otherwise("")) if keep_query else out


def metadata_url(u: Column) -> Column:
    """Percent-decoded as a whole where it decodes; on Google hosts without the account part /u/<n>/."""
    decoded = F.coalesce(F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B"))), u)
    google = F.lower(host(decoded)).rlike(r"(^|\.)google\.com$")
    return F.when(google, F.regexp_replace(decoded, r"^([^:]+://[^/]+)/u/\d+/", "$1/")).otherwise(decoded)


def extension(u: Column) -> Column:
    """The lower-case suffix of the path with its dot, '' where there is none."""
    where = F.regexp_extract(u, r"^(?:[^:/?#]+://[^/?#]*)?([^?#]*)", 1)
    return F.lower(F.regexp_extract(where, r"[^/.][^/]*?(\.[^./]+)/*$", 1))


def extension_class(ext: Column) -> Column:
    bare = F.regexp_replace(ext, r"^\.", "")
    out = F.lit("other")
    for name, own in EXTENSIONS.items():
        out = F.when(bare.isin(*own), name).otherwise(out)
    return out


def file_name(u: Column) -> Column:
    """A file name out of the last part of a URL: slug of the stem, extension as it is."""
    from corpusloom.functions.text import slug

    last = F.regexp_extract(path(u), r"([^/]*)$", 1)
    ext = F.regexp_extract(last, r"^\.*[^.].*(\.[^.]*)$", 1)
    return F.concat(slug(F.substring(last, F.lit(1), F.length(last) - F.length(ext))), ext)


def matches(u: Column, include: list[str], exclude: list[str]) -> Column:
    """Patterns hold from the start; no include pattern means no constraint."""
    ok = F.lit(True)
    if include:
        ok = F.coalesce(u.rlike("|".join(f"^(?:{p})" for p in include)), F.lit(False))
    if exclude:
        ok = ok & ~F.coalesce(u.rlike("|".join(f"^(?:{p})" for p in exclude)), F.lit(False))
    return ok


def is_sign_in_host(h: Column, hosts: tuple[str, ...] = SIGN_IN_HOSTS) -> Column:
    """A listed host or a subdomain of one; look-alikes are not."""
    low = F.lower(F.regexp_replace(h, r":\d+$", ""))
    out = F.lit(False)
    for x in hosts:
        out = out | (low == x) | low.endswith("." + x)
    return F.coalesce(out, F.lit(False))


def sign_in_redirect(asked: Column, got: Column, hosts: tuple[str, ...] = SIGN_IN_HOSTS) -> Column:
    """Whether a fetch ended on another host that is an identity provider's."""
    return F.coalesce((F.lower(host(asked)) != F.lower(host(got))) & is_sign_in_host(host(got), hosts), F.lit(False))


def is_valid(u: Column) -> Column:
    """Whether a URL has a scheme and a host."""
    return F.coalesce(u.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\s]+"), F.lit(False))


def endpoint(c: Column, default: str) -> Column:
    """A service's address: URLs as they are, a bare host with https, nothing means the default; what is neither is null."""
    given = F.coalesce(F.nullif(c, F.lit("")), F.lit(default))
    web = given.rlike("^https?://")
    return F.when(web & is_valid(given), given).when(~web & given.rlike(r"^[^/?#\s]+\z"), F.concat(F.lit("https://"), given))


def redirect_followed(target: Column) -> Column:
    """Whether a redirect is followed: not to documents, archives and pictures."""
    endings = "|".join(x for kind in ("document", "archive", "image") for x in EXTENSIONS[kind] if x not in ("html", "htm"))
    return ~F.coalesce(F.lower(path(target)).rlike(rf"\.({endings})\z"), F.lit(False))


def fetched_as(content_type: Column, u: Column, attachment: Column) -> Column:
    """How a fetched URL goes on: html or pdf by its content type, else download where it came as an attachment or names a file."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    names_file = extension_class(extension(u)).isin("document", "archive", "dataframe", "image", "audio", "video") & ~extension(u).isin(".html", ".htm")
    return F.when(kind.contains("text/html"), "html").when(kind.contains("application/pdf"), "pdf").when(F.coalesce(attachment, F.lit(False)) | ((kind == "") & names_file), "download").otherwise("html")


def docs_link(u: Column, include: list[str], exclude: list[str], ignored: tuple[str, ...] = ()) -> Column:
    """Whether a docs crawl takes a link: patterns hold anywhere in it, and without an including pattern none is taken."""
    if not include:
        return F.lit(False)
    ok = u.rlike("^https?://") & ~u.contains("#") & u.rlike("|".join(f"(?:{p})" for p in include))
    for p in exclude:
        ok = ok & ~u.rlike(p)
    for e in ignored:
        ok = ok & ~F.lower(u).endswith(e)
    return F.coalesce(ok, F.lit(False))


#: Names under which sites keep their sitemaps.
SITEMAP_NAMES = ("sitemap.xml", "sitemap_index.xml", "sitemap.xml.gz", "wp-sitemap.xml", "sitemap_index.xml.gz")


def sitemap_candidates(root: Column, declared: Column) -> Column:
    """A site's sitemaps in the order they are tried: what robots.txt declares, then the usual names; the first of equal ones, only .xml and .gz."""
    base = F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"))
    all_ = F.concat(declared, F.array(*[F.concat(base, F.lit(n)) for n in SITEMAP_NAMES]))
    return F.filter(F.array_distinct(all_), lambda u: path(u).rlike(r"[^/.][^/]*\.(xml|gz)\z"))
