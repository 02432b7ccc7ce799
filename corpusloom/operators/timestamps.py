"""Mixed timestamp spellings to UTC instants, inside Catalyst.

Every spelling is one alternative of a single regular expression with named
groups.  The expression runs once per value: a replacement writes the groups
out in a fixed order, `split` makes them fields.  Ranges are checked on the
fields, and the instant is put together by integer day arithmetic (days since
1970-01-01 from year, month and day, then microseconds).  Only the step from
local time to UTC uses Spark's zone rules, which read a local time that occurs
twice as the earlier instant and one that does not occur with the offset in
force before the change.

Defined results: null, blank, placeholder, relative and impossible values give
null; a row whose source has no zone is read as UTC; a row without a locale is
read day first; a zone name the JVM doesn't know makes the value unreadable;
repeated rows give repeated results; extra columns are carried along untouched.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month names of the languages that sources use, without accents.
MONTHS = {
    1: ("jan", "january", "januar", "jaenner", "janner", "janv", "janvier", "ene", "enero"),
    2: ("feb", "february", "februar", "fev", "fevr", "fevrier", "febrero"),
    3: ("mar", "march", "marz", "maerz", "mrz", "mars", "marzo"),
    4: ("apr", "april", "avr", "avril", "abr", "abril"),
    5: ("may", "mai", "mayo"),
    6: ("jun", "june", "juni", "juin", "junio"),
    7: ("jul", "july", "juli", "juil", "juillet", "julio"),
    8: ("aug", "august", "aout", "ago", "agosto"),
    9: ("sep", "sept", "september", "septembre", "septiembre", "setiembre"),
    10: ("oct", "october", "okt", "oktober", "octobre", "octubre"),
    11: ("nov", "november", "novembre", "noviembre"),
    12: ("dec", "december", "dez", "dezember", "decembre", "dic", "diciembre"),
}

# Offsets of zone abbreviations in minutes.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "ist": 330, "cet": 60, "mez": 60,
    "cest": 120, "mesz": 120, "eet": 120, "eest": 180, "msk": 180, "npt": 345, "jst": 540, "acst": 570,
    "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780, "est": -300, "edt": -240, "cst": -360,
    "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
}

_NAME = r"[\p{L}]{3,12}"
_FIELDS = ("y", "m", "mon", "d", "wk", "wd", "doy", "a", "b", "h", "mi", "s", "f", "ap", "off", "abbr", "zone", "secs", "frac", "milli", "micro")
_SEP = "\u001f"


def _alternatives() -> list[str]:
    """The spellings. `#` in a group name stands for the alternative's number."""
    clock = r"(?<h#>\d{1,2})[:h](?<mi#>\d{2})(?::(?<s#>\d{2})(?:[.,](?<f#>\d+))?)?(?:\s*(?<ap#>[ap]\.?\s?m\b\.?))?(?:\s*(?:uhr|h)\b)?"
    where = (
        r"(?:\s*(?:(?<off#>[+\-−]\d{2}(?::?\d{2})?)|(?:gmt|utc)(?<off#x>[+\-−]\d{1,2}(?::?\d{2})?)|(?<abbr#>"
        + "|".join(sorted(ABBREVIATIONS, key=lambda x: (-len(x), x)))
        + r"))(?![\w/])(?:\s*\([\w\s]+\))?)?(?:\s*\[?(?<zone#>\p{L}[\p{L}_]+(?:/[\p{L}_+\-0-9]+){1,2})\]?|\s*\[(?<zone#x>utc|gmt|z)\])?"
    )
    rest = rf"(?:{clock}{where})"
    day_name = rf"(?:{_NAME}\.?,?\s+)?"
    return [
        # 2024-05-31, 2024/5/31, 2024-05-31T10:20:30.5+02:00[Europe/Berlin]
        rf"(?<y#>\d{{4}})(?<sep#>[\-/.])(?<m#>\d{{1,2}})\k<sep#>(?<d#>\d{{1,2}})(?:(?:t|\s+|,\s*){rest}|{where})",
        # 20240531, 20240531102030, 20240531T102030Z
        rf"(?<y#>\d{{4}})(?<m#>\d{{2}})(?<d#>\d{{2}})(?:t?(?<h#>\d{{2}})(?<mi#>\d{{2}})(?:(?<s#>\d{{2}})(?:[.,](?<f#>\d+))?)?{where}|t{rest})?",
        # 2024-W34-6
        rf"(?<y#>\d{{4}})-?w(?<wk#>\d{{2}})-?(?<wd#>\d)(?:(?:t|\s+){rest})?",
        # 2024-177
        rf"(?<y#>\d{{4}})-(?<doy#>\d{{3}})(?:(?:t|\s+){rest})?",
        # 31/05/2024 10:20, 5/31/24 10:20 pm: which comes first depends on the locale
        rf"(?<a#>\d{{1,2}})(?<sep#>[\-/.])(?<b#>\d{{1,2}})\k<sep#>(?<y#>\d{{4}}|\d{{2}})(?:(?:t|,?\s+){rest}|{where})",
        # Wed, 31 May 2024 10:20:30 +0200; 31-May-24; 27. Oktober 2024, 03:08 Uhr; 1er avril 2022 à 10h08; 18 de mayo de 2022, 08:14
        rf"{day_name}(?<d#>\d{{1,2}})(?:er|st|nd|rd|th|\.)?(?:\s+de\s+|[\s\-/]+)(?<mon#>{_NAME})\.?(?:,?\s+(?:de\s+)?|[\-/])(?<y#>\d{{4}}|\d{{2}})(?:(?:,?\s+(?:at|um|à|a|a\s+las)\s+|,?\s+|t){rest})?",
        # May 31, 2024 10:20 PM
        rf"{day_name}(?<mon#>{_NAME})\.?\s+(?<d#>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?<y#>\d{{4}})(?:(?:,?\s+(?:at\s+)?|t){rest})?",
        # Fri May 31 10:20:30 2024
        rf"{day_name}(?<mon#>{_NAME})\s+(?<d#>\d{{1,2}})\s+{clock}{where}\s+(?<y#>\d{{4}})",
        # seconds, milliseconds, microseconds since 1970
        r"(?<secs#>\d{10})(?:\.(?<frac#>\d*))?",
        r"(?<milli#>\d{13})",
        r"(?<micro#>\d{16})",
    ]


def pattern() -> tuple[str, str]:
    """The one regular expression of all spellings, and the replacement that writes its fields out."""
    alts, names = [], set()
    for k, alt in enumerate(_alternatives()):
        # a group that stands in an alternative twice gets two names
        seen: dict[str, int] = {}
        out, rest = "", alt
        while "(?<" in rest:
            head, _, rest = rest.partition("(?<")
            name, gt, rest = rest.partition(">")
            if name in ("!", "=") or not name[:1].isalpha():
                out += head + "(?<" + name + gt
                continue
            base = name.replace("#", "n") + str(k)
            seen[base] = seen.get(base, 0) + 1
            full = base + ("" if seen[base] == 1 else "r" * (seen[base] - 1))
            names.add(full)
            out += head + "(?<" + full + gt
        alts.append((out + rest).replace("\\k<sep#>", f"\\k<sepn{k}>"))
    regex = r"(?iu)^[\s\p{Z}\"'“”‘’«»`]*(?:" + "|".join(alts) + r")[\s\p{Z}\"'“”‘’«»`]*$"
    parts = []
    for field in _FIELDS:
        own = sorted(n for n in names if n.split("n")[0] == field or n.startswith(field + "n"))
        parts.append("".join("${" + n + "}" for n in own if _base(n) == field))
    return regex, _SEP.join(parts) + _SEP


def _base(name: str) -> str:
    for field in sorted(_FIELDS, key=len, reverse=True):
        rest = name[len(field) :]
        if name.startswith(field + "n") and rest.lstrip("n").lstrip("x").rstrip("r").lstrip("x").isdigit():
            return field
    return ""


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, by integers only."""
    y2 = y - F.when(m <= 2, 1).otherwise(0)
    era = F.expr("0") + F.floor(y2 / F.lit(400))
    yoe = y2 - era * 400
    mp = F.pmod(m + 9, F.lit(12))
    doy = F.floor((mp * 153 + 2) / F.lit(5)) + d - 1
    doe = yoe * 365 + F.floor(yoe / F.lit(4)) - F.floor(yoe / F.lit(100)) + doy
    return (era * 146097 + doe - 719468).cast("long")


def known_zones(spark: SparkSession) -> list[str]:
    """The JVM's zone names, or Python's where the JVM can't be asked."""
    try:
        return sorted(str(z) for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds())
    except Exception:  # a remote session has no gateway
        return sorted(available_timezones())


def _lookup(pairs: dict[str, int], key: Column) -> Column:
    flat = [F.lit(x) for kv in pairs.items() for x in kv]
    return F.try_element_at(F.create_map(*flat), key)


def with_instant(df: DataFrame, value: str, tz: str, locale: str, out: str = "utc_us") -> DataFrame:
    """df and a long column `out`: microseconds since 1970 in UTC, or null where `value` names no instant.

    `tz` and `locale` name columns with the zone and locale of the row's source.
    """
    regex, replacement = pattern()
    names = {c.lower() for c in df.columns}
    pre = "_ts"
    while any(c.startswith(pre) for c in names):
        pre += "_"
    col = lambda n: F.col(f"{pre}_{n}")
    zones = known_zones(df.sparkSession)
    step = df.withColumn(f"{pre}_p", F.split(F.regexp_replace(F.col(f"`{value}`").cast("string"), F.lit(regex), F.lit(replacement)), _SEP))
    hit = F.size(col("p")) == len(_FIELDS) + 1
    text = {f: F.when(hit, F.nullif(F.try_element_at(col("p"), F.lit(i + 1)), F.lit(""))) for i, f in enumerate(_FIELDS)}
    number = lambda f: text[f].try_cast("long")
    plain = lambda c: F.translate(F.lower(c), "äáàâéèêëíîïóôöúùûüñç.", "aaaaeeeeiiiooouuuunc")
    months = {n: m for m, ns in MONTHS.items() for n in ns}
    month_first = F.coalesce(F.col(f"`{locale}`"), F.lit("")).rlike("(?i)^en[-_]us")
    ampm = F.lower(F.substring(text["ap"], 1, 1))
    off = F.regexp_replace(text["off"], "[:−]", "")
    sign = F.when(text["off"].rlike("^[-−]"), -1).otherwise(1)
    digits = F.regexp_replace(off, r"\D", "")
    off_min = F.when(
        text["off"].isNotNull(),
        sign * (F.when(F.length(digits) <= 2, digits.try_cast("long") * 60).otherwise(F.expr("0") + (F.substring(digits, 1, 10).try_cast("long") / 100).cast("long") * 60 + digits.try_cast("long") % 100)),
    )
    zone_map = {z.lower(): z for z in zones}
    zone_flat = F.create_map(*[F.lit(x) for kv in zone_map.items() for x in kv])
    # a zone as it is spelt is found in a hash set; only other spellings go through the list of all
    zone_of = lambda c: F.when(c.isin(*zones), c).otherwise(F.try_element_at(zone_flat, F.lower(c)))
    step = step.select(
        "*",
        hit.alias(f"{pre}_hit"),
        number("y").alias(f"{pre}_y0"),
        F.coalesce(F.when(text["a"].isNotNull(), F.when(month_first, number("a")).otherwise(number("b"))), number("m"), _lookup(months, plain(text["mon"])).cast("long")).alias(f"{pre}_m"),
        F.coalesce(F.when(text["a"].isNotNull(), F.when(month_first, number("b")).otherwise(number("a"))), number("d")).alias(f"{pre}_d"),
        F.length(text["y"]).alias(f"{pre}_yl"),
        number("wk").alias(f"{pre}_wk"), number("wd").alias(f"{pre}_wd"), number("doy").alias(f"{pre}_doy"),
        F.coalesce(number("h"), F.lit(0)).alias(f"{pre}_h0"), ampm.alias(f"{pre}_ap"),
        F.coalesce(number("mi"), F.lit(0)).alias(f"{pre}_mi"), F.coalesce(number("s"), F.lit(0)).alias(f"{pre}_s"),
        F.coalesce(F.rpad(F.substring(text["f"], 1, 6), 6, "0").try_cast("long"), F.lit(0)).alias(f"{pre}_f"),
        F.coalesce(off_min, _lookup(ABBREVIATIONS, F.lower(text["abbr"])).cast("long")).alias(f"{pre}_off"),
        text["zone"].alias(f"{pre}_zt"),
        F.when(text["zone"].isNotNull(), zone_of(text["zone"])).alias(f"{pre}_zone"),
        F.coalesce(
            number("secs") * 1_000_000 + F.coalesce(F.rpad(F.substring(text["frac"], 1, 6), 6, "0").try_cast("long"), F.lit(0)),
            number("milli") * 1000, number("micro"),
        ).alias(f"{pre}_epoch"),
    )
    y = F.when(col("yl") == 2, col("y0") + 2000).otherwise(col("y0"))
    h = F.when(col("ap") == "p", F.pmod(col("h0"), F.lit(12)) + 12).when(col("ap") == "a", F.pmod(col("h0"), F.lit(12))).otherwise(col("h0"))
    step = step.select("*", y.alias(f"{pre}_y"), h.alias(f"{pre}_h"))
    leap = ((col("y") % 4 == 0) & (col("y") % 100 != 0)) | (col("y") % 400 == 0)
    long_month = F.when(col("m") == 2, F.when(leap, 29).otherwise(28)).when(col("m").isin(4, 6, 9, 11), 30).otherwise(31)
    jan1 = days_from_civil(col("y"), F.lit(1), F.lit(1))
    jan4_monday = days_from_civil(col("y"), F.lit(1), F.lit(4)) - F.pmod(days_from_civil(col("y"), F.lit(1), F.lit(4)) + 3, F.lit(7))
    next_monday = days_from_civil(col("y") + 1, F.lit(1), F.lit(4)) - F.pmod(days_from_civil(col("y") + 1, F.lit(1), F.lit(4)) + 3, F.lit(7))
    week_day = jan4_monday + (col("wk") - 1) * 7 + col("wd") - 1
    day = (
        F.when(col("wk").isNotNull(), F.when((col("wk") >= 1) & col("wd").between(1, 7) & (week_day < next_monday), week_day))
        .when(col("doy").isNotNull(), F.when((col("doy") >= 1) & (col("doy") <= F.when(leap, 366).otherwise(365)), jan1 + col("doy") - 1))
        .when(col("m").between(1, 12) & (col("d") >= 1) & (col("d") <= long_month), days_from_civil(col("y"), col("m"), col("d")))
    )
    clock_ok = (
        F.when(col("ap").isNotNull(), col("h0").between(1, 12)).otherwise(col("h0").between(0, 23) | ((col("h0") == 24) & (col("mi") == 0) & (col("s") == 0) & (col("f") == 0)))
        & col("mi").between(0, 59)
        & col("s").between(0, 60)
    )
    local = F.when((col("y") >= 1) & clock_ok, day * 86_400_000_000 + (col("h") * 3600 + col("mi") * 60 + col("s")) * 1_000_000 + col("f"))
    step = step.select("*", local.alias(f"{pre}_local"))
    row_zone = zone_of(F.col(f"`{tz}`"))
    zone = F.coalesce(col("zone"), row_zone, F.lit("UTC"))
    by_zone = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(col("local")), zone))
    utc = F.coalesce(
        col("epoch"),
        F.when(col("off").isNotNull(), F.when(col("off").between(-1080, 1080), col("local") - col("off") * 60_000_000)).when(col("zt").isNotNull() & col("zone").isNull(), F.lit(None).cast("long")).otherwise(by_zone),
    )
    # one generated row per row: later filters on the result stay above it and the parsing is done once
    return step.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.array(F.when(col("hit"), utc))).alias(out))
