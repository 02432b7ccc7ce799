"""Date functions as columns. Naive times are UTC; what can't be read is null, and callers say which side null falls on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Zones that RFC 822 names.
ZONES = {"GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}


def _with_seconds(v: Column) -> Column:
    return F.regexp_replace(v, r"^(.{10}[T ]\d{2}:\d{2})(?!:|\d)", "$1:00")


def parse_instant(c: Column) -> Column:
    """Epoch seconds, ISO 8601 or RFC 822 to microseconds since 1970; a bare year is null, and so are numbers out of range."""
    v = F.regexp_replace(c, r"^\s+|\s+$", "")
    epoch = F.when(v.rlike(r"^\d{5,}(\.\d+)?\z"), F.round(v.try_cast("double") * 1_000_000).try_cast("long"))
    iso = F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?\s*(Z|z|[+-]\d{2}:?\d{2})?)?\z"), F.unix_micros(_with_seconds(F.regexp_replace(F.upper(v), r"([+-]\d{2})(\d{2})$", "$1:$2")).try_cast("timestamp")))
    zone = F.regexp_extract(v, r"([A-Za-z]+)$", 1)
    numeric = F.lit(None).cast("string")
    for name, offset in ZONES.items():
        numeric = F.when(F.upper(zone) == name, offset).otherwise(numeric)
    rest = F.regexp_replace(F.regexp_replace(v, r"^[A-Za-z]{3},\s*", ""), r"\s*[A-Za-z]+$", "")
    text = F.when(zone == "", F.regexp_replace(v, r"^[A-Za-z]{3},\s*", "")).otherwise(F.concat_ws(" ", rest, numeric))
    rfc = F.when(v.rlike(r"^([A-Za-z]{3},\s*)?\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} ([+-]\d{4}|[A-Za-z]{1,4})\z"), F.unix_micros(F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss Z"))))
    return F.coalesce(epoch, iso, rfc)


def is_newer(current: Column, stored: Column) -> Column:
    """Strictly later; unknown on either side counts as newer."""
    return F.coalesce(parse_instant(current) > parse_instant(stored), F.lit(True))


def in_range(c: Column, first_day: str, last_day: str) -> Column:
    """Within two days, both whole; null or unreadable values are kept."""
    at = parse_instant(c)
    low = F.unix_micros(F.lit(f"{first_day} 00:00:00").cast("timestamp"))
    high = F.unix_micros(F.lit(f"{last_day} 23:59:59").cast("timestamp"))
    return F.coalesce(at.between(low, high), F.lit(True))


def hours_back(c: Column) -> Column:
    """'48h', '2d' or '48' in seconds."""
    n = F.regexp_extract(F.trim(c), r"^(\d+)\s*[hdHD]?$", 1).try_cast("long")
    return n * F.when(F.lower(F.trim(c)).endswith("d"), 86_400).otherwise(3_600)


def clock_seconds(c: Column) -> Column:
    """'hh:mm:ss.mmm' in seconds; the digits after the point are thousandths."""
    part = lambda i: F.regexp_extract(c, r"^(\d+):(\d+):(\d+)(?:[.,](\d+))?$", i)
    return part(1).try_cast("double") * 3600 + part(2).try_cast("double") * 60 + part(3).try_cast("double") + F.coalesce(part(4).try_cast("double"), F.lit(0.0)) / 1000


def size_megabytes(c: Column) -> Column:
    """'20MB' or '20' as a number."""
    return F.regexp_extract(F.upper(F.trim(c)), r"^(\d+)\s*(?:MB)?$", 1).try_cast("long")
