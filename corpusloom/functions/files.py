"""File classes: type by leading bytes, routing, MIME gates, names, skip rules."""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

#: Leading bytes in hexadecimal.
MAGIC = (("FFD8FF", "image/jpeg"), ("89504E470D0A1A0A", "image/png"), ("474946383761", "image/gif"), ("474946383961", "image/gif"), ("00000100", "image/x-icon"))
BLOCKED_MIME = ("image/", "video/", "audio/", "application/vnd.google-apps.shortcut", "application/vnd.google-apps.folder")
UNEXPORTABLE_MIME = ("application/vnd.google-apps.form", "application/vnd.google-apps.map", "application/vnd.google-apps.site")
EXPORTED = {
    "application/vnd.google-apps.document": ".docx",
    "application/vnd.google-apps.spreadsheet": ".xlsx",
    "application/vnd.google-apps.presentation": ".pptx",
}
SYSTEM_NAMES = ("thumbs.db", "desktop.ini", ".ds_store")
SYSTEM_EXTENSIONS = (".tmp", ".bak", ".lock", ".aspx", ".master")


def image_mime(data: Column, name: Column) -> Column:
    """By leading bytes, else by name, else png."""
    lead = F.hex(F.substring(data, 1, 8))
    out = F.when(F.lower(name).rlike(r"\.jpe?g$"), "image/jpeg").when(F.lower(name).endswith(".gif"), "image/gif").when(F.lower(name).endswith(".ico"), "image/x-icon").otherwise("image/png")
    for magic, mime in reversed(MAGIC):
        out = F.when(lead.startswith(magic), mime).otherwise(out)
    return out


def markup_type(c: Column) -> Column:
    """xml, html or text by how the text begins and what it holds."""
    lead = F.lower(F.ltrim(F.substring(c, 1, 1000)))
    return F.when(lead.startswith("<?xml"), "xml").when(lead.contains("<html"), "html").when(lead.startswith("<"), "xml").otherwise("text")


def mime_kept(mime: Column, with_images: bool = False) -> Column:
    blocked = F.lit(False)
    for p in BLOCKED_MIME:
        if not (with_images and p == "image/"):
            blocked = blocked | mime.startswith(p)
    return F.coalesce(~(blocked | mime.isin(*UNEXPORTABLE_MIME)), F.lit(True))


def exported_name(name: Column, mime: Column) -> Column:
    """Name with the extension of the exported form; trailing dots off."""
    bare = F.regexp_replace(name, r"\.+$", "")
    out = bare
    for m, ext in EXPORTED.items():
        out = F.when((mime == m) & ~F.lower(bare).endswith(ext), F.concat(bare, F.lit(ext))).otherwise(out)
    return out


def skipped_file(name: Column, path: Column) -> Column:
    """System and hidden files."""
    low = F.lower(name)
    return F.coalesce(low.isin(*SYSTEM_NAMES) | low.rlike(r"^[.~]") | F.lit(False) | low.rlike("(" + "|".join("\\" + x for x in SYSTEM_EXTENSIONS) + ")$") | F.lower(path).rlike(r"(^|/)(_catalogs|_private|forms)(/|$)"), F.lit(False))


def processing_path(ext: Column, n_bytes: Column, parse_tables: bool, max_megabytes: int) -> Column:
    """Where a file goes: tables to the table parser, large PDFs split, parsed files locally, all else uploaded raw."""
    return (
        F.when(ext.isin(".csv", ".tsv", ".psv", ".pipe", ".xls", ".xlsx"), "dataframe")
        .when((ext == ".pdf") & (n_bytes > max_megabytes * 1024 * 1024), "split")
        .when(ext.isin(".pdf", ".html", ".htm", ".pptx", ".docx", ".md") & F.lit(parse_tables), "local")
        .otherwise("raw")
    )


def page_batches(pages: Column, size: int) -> Column:
    """[first, end) of the batches of a file of so many pages."""
    starts = F.when(pages > 0, F.sequence(F.lit(0), pages - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("first"), F.least(i + size, pages).alias("end")))


def mask_secrets(key: Column, value: Column) -> Column:
    return F.when(F.lower(key).rlike("key|secret|token|password|credential"), "***").otherwise(value)


@F.pandas_udf(BinaryType())
def _gunzipped(data: pd.Series) -> pd.Series:
    def one(x):
        try:
            return x if x is None else gzip.decompress(x)
        except (OSError, EOFError, zlib.error):
            return b""

    return data.map(one)


def unpacked(url: Column, data: Column) -> Column:
    """A download's bytes: what is named .gz is unpacked, unreadable packs are empty."""
    return F.when(url.endswith(".gz"), _gunzipped(data)).otherwise(data)


#: Least side of a picture in pixels: in markup, and of a file.
LEAST_IN_MARKUP, LEAST_OF_FILE = 10, 100


def picture_kept(name: Column, width: Column, height: Column) -> Column:
    """Whether a picture is large enough; drawings have no pixels and always are, and so is one of unknown size."""
    drawing = F.coalesce(F.lower(name).endswith(".svg"), F.lit(False))
    return drawing | F.coalesce(F.least(width, height) >= LEAST_OF_FILE, F.lit(True))
