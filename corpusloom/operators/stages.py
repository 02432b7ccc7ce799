"""Stages with a model or another outside service behind them, and deterministic stand-ins.

A stage takes a function that is made once a partition (a client, a loaded
model) and is called for each row in order; a call that fails gives its default,
not an error.  Results carry the row's keys, so order is data, not arrival.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from corpusloom.functions.files import LEAST_IN_MARKUP


class RateLimiter:
    """At most `calls` calls in any `seconds`, by a sliding window; one a Python worker, whose share of the whole rate is its own affair."""

    def __init__(self, calls: int, seconds: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if calls < 1:
            raise ValueError("at least one call must be allowed")
        self.calls, self.seconds, self.clock, self.sleep, self.at = calls, seconds, clock, sleep, deque()

    def wait(self) -> None:
        """Returns when the next call may be made."""
        now = self.clock()
        while self.at and now - self.at[0] >= self.seconds:
            self.at.popleft()
        if len(self.at) >= self.calls:
            self.sleep(self.at[0] + self.seconds - now)
            return self.wait()
        self.at.append(now)
        return None


def mapped(df: DataFrame, keys: list[str], inputs: list[str], make: Callable[[], Callable[..., str]], out: str, default: str | None = "", calls_a_second: int | None = None) -> DataFrame:
    """df's keys and a string column: make()'s function over the input columns, row by row, at most so many calls a second in each worker."""
    kept = df.select(*keys, *inputs)

    def run(batches: Iterable[pa.RecordBatch]):
        call = make()
        limiter = RateLimiter(calls_a_second) if calls_a_second else None
        for rb in batches:
            values = []
            for row in zip(*(rb.column(c).to_pylist() for c in inputs), strict=True):
                if limiter:
                    limiter.wait()
                try:
                    values.append(call(*row))
                except Exception:
                    values.append(default)
            yield pa.RecordBatch.from_arrays([*(rb.column(k) for k in keys), pa.array(values, pa.string())], names=[*keys, out])

    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return kept.mapInArrow(run, f"{schema}, `{out}` string")


def first_sentence(c: Column) -> Column:
    return F.regexp_extract(c, r"^\s*([^.!?\n]+[.!?]?)", 1)


def contextual_chunk(chunk: Column, title: Column, text: Column) -> Column:
    """A chunk with a line of context behind it; the stand-in for a model is the title and the document's first sentence."""
    context = F.concat_ws(": ", F.nullif(F.coalesce(title, F.lit("")), F.lit("")), F.nullif(first_sentence(text), F.lit("")))
    return F.when(context != "", F.concat(chunk, F.lit("\n"), context)).otherwise(chunk)


def table_summary(header: Column, n_rows: Column) -> Column:
    """The stand-in summary of a table; '' for one without columns or rows, which drops it."""
    return F.when((F.size(header) > 0) & (n_rows > 0), F.concat(F.lit("Table of "), n_rows, F.lit(" rows with columns "), F.array_join(header, ", "))).otherwise("")


def heading_chunks(text: Column, limit: int) -> Column:
    """Chunks that begin at headings: a line without a full stop of up to eight words opens one; long chunks are cut by size."""
    from corpusloom.operators.split import split_text

    marked = F.regexp_replace(text, r"(?m)^((?:[^\s.!?:|*\-][^\s]*)(?: [^\s]+){0,7})(?<![.!?,;:])$", "\u001e$1")
    blocks = F.filter(F.split(marked, "\u001e"), lambda b: F.trim(b) != "")
    return F.flatten(F.transform(blocks, lambda b: split_text(F.trim(b), limit)))


def extracted_metadata(html: Column, extract: Callable[[str], dict]) -> Column:
    """A page's metadata by a function of the user's; where that fails, or gives no mapping, there is none."""

    @F.pandas_udf(MapType(StringType(), StringType()))
    def run(values: pd.Series) -> pd.Series:
        def one(h):
            try:
                return {str(k): None if v is None else str(v) for k, v in extract(h or "").items()}
            except Exception:
                return {}

        return values.map(one)

    return run(html)


def picture_summaries(pictures: DataFrame, keys: list[str], make: Callable[[], Callable[..., str]]) -> DataFrame:
    """keys and summary of the pictures that are large enough in markup and of which the model says anything. pictures: keys, name, width, height."""
    small = F.coalesce(F.least("width", "height") < LEAST_IN_MARKUP, F.lit(False))
    return mapped(pictures.where(~small), keys, ["name"], make, "summary").where(F.trim("summary") != "")


def attributes(df: DataFrame, keys: list[str], text: str, questions: dict[str, str], make: Callable[[], Callable[[str, dict], str]]) -> DataFrame:
    """keys and a map of answers to named questions about a text: the model's reply is JSON, perhaps fenced; one that isn't gives no answers."""
    from corpusloom.functions.text import strip_fences

    def with_questions():
        ask = make()
        return lambda t: ask(t, questions)

    replies = mapped(df, keys, [text], with_questions, "reply")
    answers = F.from_json(strip_fences(F.col("reply")), MapType(StringType(), StringType()))
    return replies.select(*keys, F.map_filter(answers, lambda k, v: k.isin(*questions)).alias("attributes"))


ELEMENTS = ArrayType(StructType([StructField("kind", StringType()), StructField("content", StringType())]))


def parsed(name: Column, data: Column, parse: Callable[[str, bytes], list[tuple[str, str]]] | None = None) -> Column:
    """A file's elements (kind, content) by a parser; one that fails gives none. Without a parser: plain text, Markdown and HTML."""
    parse = parse or parse_plain

    @F.pandas_udf(ELEMENTS)
    def run(names: pd.Series, contents: pd.Series) -> pd.Series:
        def one(n, c):
            try:
                return [{"kind": k, "content": x} for k, x in parse(n or "", bytes(c or b""))]
            except Exception:
                return []

        return pd.Series([one(n, c) for n, c in zip(names, contents, strict=True)], dtype=object)

    return run(name, data)


def parse_plain(name: str, data: bytes) -> list[tuple[str, str]]:
    """Blank-line blocks of a text, headings of Markdown as titles; titles, texts and tables of HTML."""
    from corpusloom.functions.html import FRAME_TAGS, expand_table, parse

    text = data.decode("utf-8", "replace")
    if name.lower().endswith((".html", ".htm")):
        tree = parse(text).without(lambda n: n.tag in FRAME_TAGS)
        out = []
        for n in tree.all("title", "h1", "h2", "h3", "p", "li", "pre", "table"):
            said = "\n".join(" | ".join(r) for r in expand_table(n)) if n.tag == "table" else n.text()
            if said:
                out.append(("table" if n.tag == "table" else "title" if n.tag[0] == "h" or n.tag == "title" else "text", said))
        return out
    if name.lower().endswith(".ipynb"):
        cells = [(c.get("cell_type"), "".join(c.get("source", []))) for c in json.loads(text).get("cells", [])]
        return [("code" if kind == "code" else "text", x) for kind, x in cells if x.strip()]
    blocks = [b.strip() for b in text.replace("\r\n", "\n").split("\n\n")]
    return [("title", b.lstrip("# ")) if b.startswith("#") and "\n" not in b else ("text", b) for b in blocks if b]


def with_fallback(df: DataFrame, elements: str, again: Column, wanted: Column) -> DataFrame:
    """Files of which a parser found nothing are read again by another (text recognition, say), where that is wanted."""
    empty = F.coalesce(F.size(elements) < 1, F.lit(True))
    return df.withColumn(elements, F.when(empty & wanted, again).otherwise(F.col(elements)))


def segment_sections(segments: DataFrame, key: str, start: str, text: str) -> DataFrame:
    """Recognised speech as sections: one a segment with words, in order, with its time as title."""
    clock = F.date_format(F.timestamp_seconds(F.floor(start)), "HH:mm:ss")
    kept = segments.where(F.trim(text) != "")
    return kept.select(key, F.col(start).alias("ord"), clock.alias("title"), F.trim(text).alias("text"))
