"""Masking of personal data by patterns, and a language guess by function words.

Names and places need a model; `mask` takes a further column function for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: In the order of application; patterns that Java and RE2 read alike.
MASKS = (
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9.\-]{1,253}\.[A-Za-z]{2,24}"),
    ("IBAN_CODE", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}\b"),
    ("CREDIT_CARD", r"\b(?:[0-9]{4}[ \-]?){3}[0-9]{4}\b"),
    ("US_SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("PHONE_NUMBER", r"(?:\+[0-9]{1,3}[ .\-]?)?\(?\b[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}\b"),
    ("US_PASSPORT", r"\b[A-Z][0-9]{8}\b"),
    ("IP_ADDRESS", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"),
)

#: Function words that tell the languages apart.
STOP_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "wurde", "ein", "eine", "mit", "im", "weil", "den"),
    "en": ("the", "and", "of", "is", "was", "were", "to", "in", "that", "for", "with", "because"),
    "es": ("el", "la", "los", "las", "y", "es", "fue", "en", "que", "por", "porque", "con", "una"),
    "fr": ("le", "la", "les", "et", "est", "des", "dans", "que", "pour", "parce", "une", "du", "sur"),
}


def mask(c: Column, more: Callable[[Column], Column] | None = None) -> Column:
    for name, pattern in MASKS:
        c = F.regexp_replace(c, pattern, f"<{name}>")
    return more(c) if more else c


def language(c: Column, fallback: str = "en") -> Column:
    """The language most of whose function words stand in the text; ties go to the first by name, nothing to the fallback."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")

    def among(own: tuple[str, ...]) -> Callable[[Column], Column]:
        return lambda w: w.isin(*own)

    scores = [F.struct(F.size(F.filter(words, among(own))).alias("n"), F.lit(name).alias("name")) for name, own in sorted(STOP_WORDS.items())]
    best = F.reduce(F.array(*scores), F.struct(F.lit(0).alias("n"), F.lit(fallback).alias("name")), lambda a, b: F.when(b["n"] > a["n"], b).otherwise(a))
    return best["name"]
