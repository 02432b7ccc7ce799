"""Text functions as columns: white space, identifiers, hashes, cleaning, joining."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed value: what counts as white space, Unicode's included.
SPACE = r"[\t-\r \x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

#: Metadata keys that are bookkeeping, not content.
RESERVED_KEYS = ("fingerprint", "content_hash", "config_sig", "source", "parent_doc_id", "last_updated", "file_name", "sitemap_lastmod", "crawl_date", "crawl_date_int")


def collapse_space(c: Column) -> Column:
    """Runs of white space to one space, ends trimmed, null to ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE + "+", " "))


def content_hash(c: Column) -> Column:
    """md5 of a text that doesn't see differences of white space."""
    return F.md5(collapse_space(c))


def document_id(c: Column, keep: int = 128) -> Column:
    """Short ids as they are; long ones as their beginning and 16 digits of their sha-256."""
    return F.when(F.length(c) < keep, c).otherwise(F.concat(F.substring(c, 1, keep), F.lit("-"), F.substring(F.sha2(c, 256), 1, 16)))


def slug(c: Column) -> Column:
    """Lower-case letters and digits with single hyphens; Latin letters lose their accents."""
    plain = F.translate(F.lower(c), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    return F.regexp_replace(F.regexp_replace(F.replace(plain, F.lit("ß"), F.lit("ss")), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_id(c: Column) -> Column:
    """A slug made unique by 12 digits of the original's sha-256."""
    return F.concat_ws("-", slug(c), F.substring(F.sha2(c, 256), 1, 12))


def clean_email(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "[<>]+", "")


def clean_tweet(c: Column) -> Column:
    """Without mentions, with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "@[A-Za-z0-9_]+", ""), SPACE + "+", " "))


def strip_tags(c: Column) -> Column:
    """Tags to spaces, then collapsed; null to ''."""
    return collapse_space(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "))


def join_texts(*columns: Column, by: str = " - ") -> Column:
    """Non-null texts joined; empty ones stay."""
    return F.concat_ws(by, *columns)


def with_ampersands(c: Column) -> Column:
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def distinct_urls(c: Column) -> Column:
    """The distinct URLs of a text in their order, joined by a space; chat markup and labels off."""
    found = F.regexp_extract_all(F.replace(c, F.lit("&amp;"), F.lit("&")), F.lit(r"(https?://[^\s>|)\]]+)"), 1)
    return F.array_join(F.array_distinct(found), " ")


def canonical_map(m: Column) -> Column:
    """A map as one JSON text in ASCII with sorted keys and no spaces, to be hashed."""
    pairs = F.array_sort(F.map_entries(m))
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda e: F.concat(quoted(e["key"]), F.lit(":"), F.coalesce(quoted(e["value"]), F.lit("null")))), ","), F.lit("}"))


#: Characters that JSON escapes by a letter.
_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"))


def quoted(c: Column) -> Column:
    """A JSON string in ASCII: other characters as their UTF-16 units. Plain strings don't take that way."""
    out = c
    for plain, escaped in _ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    units = F.transform(F.regexp_extract_all(out, F.lit("(?s)(.)"), F.lit(1)), lambda x: F.when(x.rlike(r"^[ -~]\z"), x).otherwise(F.regexp_replace(F.lower(F.hex(F.encode(x, "UTF-16BE"))), "(.{4})", r"\\u$1")))
    return F.concat(F.lit('"'), F.when(out.rlike(r"^[ -~]*\z"), out).otherwise(F.array_join(units, "")), F.lit('"'))


def strip_fences(c: Column) -> Column:
    """A model's reply without code fences, as JSON text; '{}' where it doesn't parse."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)^\s*```[a-zA-Z]*\s*", ""), r"(?s)\s*```\s*$", ""))
    return F.coalesce(F.to_json(F.try_parse_json(bare)), F.lit("{}"))


@F.pandas_udf(StringType())
def nfd(values: pd.Series) -> pd.Series:
    """Unicode canonical decomposition; there is no built-in for it."""
    return values.map(lambda x: x if x is None else unicodedata.normalize("NFD", x))


@F.pandas_udf(StringType())
def nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda x: x if x is None else unicodedata.normalize("NFC", x))


def normalised(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strings in canonical decomposition, all of them or the named ones; columns of other types stay as they are."""
    strings = [c for c, kind in df.dtypes if kind == "string" and (columns is None or c in columns)]
    return df.withColumns({c: nfd(F.col(f"`{c}`")) for c in strings})


def long_enough(c: Column, least: int = 3) -> Column:
    """Whether a text is worth a document: null never is."""
    return F.coalesce(F.length(c) >= least, F.lit(False))


def title_case(c: Column) -> Column:
    """Every run of letters with a capital at its head, whatever stands before it."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, F.lit(2), F.length(r)))), "")


def document_title(metadata: Column, element: Column, path: Column) -> Column:
    """The title that the metadata has, else that of the first title element, else the file's stem in words."""
    stem = F.regexp_replace(F.regexp_replace(F.regexp_extract(path, r"([^/]+)/*$", 1), r"(.)\.[^.]*$", "$1"), "[_-]", " ")
    blank = lambda x: F.nullif(F.trim(x), F.lit(""))
    return F.coalesce(blank(metadata), blank(element), title_case(stem))


def markdown_html(c: Column) -> Column:
    """Markdown's headings, paragraphs, emphasis, code and links as HTML, by patterns: enough for the text extractors."""
    out = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    for n in range(6, 0, -1):
        out = F.regexp_replace(out, rf"(?m)^{'#' * n}[ \t]+(.*)$", f"<h{n}>$1</h{n}>")
    out = F.regexp_replace(out, r"\[([^\]\n]+)\]\(([^)\s]+)\)", '<a href="$2">$1</a>')
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(out, r"\*\*([^*\n]+)\*\*", "<b>$1</b>"), r"`([^`\n]+)`", "<code>$1</code>"), r"(?m)^[-*] (.*)$", "<li>$1</li>")
    return F.array_join(F.transform(F.split(out, r"\n\s*\n"), lambda p: F.when(p.rlike("^<(h[1-6]|li)>"), p).otherwise(F.concat(F.lit("<p>"), p, F.lit("</p>")))), "\n")
