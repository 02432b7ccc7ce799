"""Greedy splitting of texts and tables, as folds over arrays inside the JVM.

A text over its limit is taken apart at blank lines (at line ends if there are
none), the parts are packed greedily, and a part that is itself too long goes
through the same fold by sentences, then through plain cuts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import SPACE, quoted

CORE_LIMIT, SECTION_LIMIT, FIXED_SIZE = 8_192, 16_000, 512
#: Fixed value: the characters of SPACE.
_SPACES = "".join(map(chr, [*range(9, 14), 32, *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def stripped(c: Column) -> Column:
    """Without white space at either end; the characters are listed, because a pattern would scan the whole text at every step of a fold."""
    return F.btrim(c, F.lit(_SPACES))


def fixed_cuts(c: Column, size: int = FIXED_SIZE) -> Column:
    """Pieces of `size` characters; an empty text has none."""
    starts = F.when(F.length(c) > 0, F.sequence(F.lit(1), F.length(c), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(c, i, F.lit(size)))


def greedy_pack(parts: Column, joiner: Column | str, limit: int) -> Column:
    """Parts (t, alone) joined while they fit; those marked alone stand alone."""
    joiner = F.lit(joiner) if isinstance(joiner, str) else joiner
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def flushed(s: Column) -> Column:
        return F.when(s["cur"] != "", F.array_append(s["done"], s["cur"])).otherwise(s["done"])

    def step(s: Column, p: Column) -> Column:
        joined = F.when(s["cur"] == "", p["t"]).otherwise(stripped(F.concat(s["cur"], joiner, p["t"])))
        alone = F.struct(F.array_append(flushed(s), p["t"]).alias("done"), F.lit("").alias("cur"))
        return F.when(p["alone"], alone).when(F.length(joined) <= limit, F.struct(s["done"].alias("done"), joined.alias("cur"))).otherwise(F.struct(flushed(s).alias("done"), p["t"].alias("cur")))

    return F.aggregate(parts, start, step, flushed)


def _parts(pieces: Column, limit: int, smaller) -> Column:
    """Each piece as a part, too long ones as what `smaller` makes of them, marked alone."""
    return F.flatten(
        F.transform(
            pieces,
            lambda p: F.when(F.length(p) <= limit, F.array(F.struct(p.alias("t"), F.lit(False).alias("alone")))).otherwise(F.transform(smaller(p), lambda q: F.struct(q.alias("t"), F.lit(True).alias("alone")))),
        )
    )


def split_sentences(c: Column, limit: int) -> Column:
    """Sentences packed greedily; one over the limit is cut plainly."""
    sentences = F.split(F.regexp_replace(c, f"([.!?]){SPACE}+", "$1\u001f"), "\u001f")
    return greedy_pack(_parts(sentences, limit, lambda s: fixed_cuts(s, limit)), " ", limit)


def split_text(c: Column, limit: int = CORE_LIMIT) -> Column:
    """The pieces of a text; a fitting text is its only piece."""
    blank = F.split(c, f"\n{SPACE}*\n")
    by_line = (F.size(blank) == 1) & F.contains(c, F.lit("\n"))
    pieces = F.when(by_line, F.split(c, "\n+")).otherwise(blank)
    packed = greedy_pack(_parts(pieces, limit, lambda p: split_sentences(p, limit)), F.when(by_line, "\n").otherwise("\n\n"), limit)
    return F.when(F.length(c) <= limit, F.array(c)).otherwise(packed)


def greedy_groups(sizes: Column, base: Column | int, budget: int) -> Column:
    """For each size the number of the group it falls in: a group begins with `base` and closes before it passes the budget."""
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("n"), F.lit(base).cast("long").alias("sum"), F.lit(False).alias("any"))

    def step(s: Column, x: Column) -> Column:
        close = s["any"] & (s["sum"] + x > budget)
        n = F.when(close, s["n"] + 1).otherwise(s["n"])
        return F.struct(F.array_append(s["out"], n).alias("out"), n.alias("n"), F.when(close, F.lit(base).cast("long") + x).otherwise(s["sum"] + x).alias("sum"), F.lit(True).alias("any"))

    return F.aggregate(sizes, start, step, lambda s: s["out"])


def split_row(cells: Column, limit: int) -> Column:
    """An oversized row of cells as rows: the largest cell (the first of equal ones) in pieces, the others in the first row only."""
    sizes = F.transform(cells, lambda c: F.length(c))
    big = F.array_position(sizes, F.array_max(sizes)) - 1
    others = F.aggregate(sizes, F.lit(0), lambda a, b: a + b) - F.array_max(sizes)
    size = F.greatest(F.lit(100), F.lit(limit) - others)
    text = F.get(cells, big)
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text), size)).otherwise(F.array(F.lit(1)))
    return F.transform(starts, lambda at: F.transform(cells, lambda c, i: F.when(i == big, F.substring(c, at, size)).when(at == 1, c).otherwise(F.lit(""))))


def json_size(cells: Column) -> Column:
    """How many characters a row of cells has as JSON in ASCII, each cell an object with one text, with a space after commas and colons."""
    each = F.transform(cells, lambda c: F.length(quoted(c)) + len('{"text_value": }'))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) + 2 + 2 * F.greatest(F.size(cells) - 1, F.lit(0))


def split_table(table_id: Column, description: Column, headers_size: Column, rows: Column, limit: int = SECTION_LIMIT) -> Column:
    """A table as tables of at most about four fifths of the limit: array of (id, description, rows).

    A table that fits as JSON, or has no rows, stays. Else rows over the budget are cut at their largest cell, rows are packed in order, and
    the tables after the first are numbered `_part1` and on; all keep the description, cut at the limit.
    """
    budget = int(limit * 0.8)
    sizes = F.transform(rows, json_size)
    whole = headers_size + len('{"headers": , "rows": []}') + F.aggregate(sizes, F.lit(0), lambda a, b: a + b) + 2 * F.greatest(F.size(rows) - 1, F.lit(0))
    room = F.lit(budget) - headers_size

    def cut(row: Column) -> Column:
        lengths = F.transform(row, lambda c: F.length(quoted(c)))
        big = F.get(row, F.array_position(lengths, F.array_max(lengths)) - 1)
        return F.when(json_size(row) > room, split_row_by(row, F.greatest(F.lit(100), room - (json_size(row) - F.length(quoted(big)))), lengths)).otherwise(F.array(row))

    parts = F.flatten(F.transform(rows, cut))
    groups = greedy_groups(F.transform(parts, lambda r: json_size(r).cast("long")), headers_size, budget)
    said = F.substring(F.coalesce(description, F.lit("")), 1, limit)
    numbered = F.transform(
        F.sequence(F.lit(0), F.array_max(groups)),
        lambda k: F.struct(F.concat(table_id, F.when(k == 0, "").otherwise(F.concat(F.lit("_part"), k))).alias("id"), said.alias("description"), F.transform(F.filter(F.arrays_zip(groups.alias("g"), parts.alias("r")), lambda x: x["g"] == k), lambda x: x["r"]).alias("rows")),
    )
    return F.when((whole <= limit) | (F.size(rows) == 0), F.array(F.struct(table_id.alias("id"), description.alias("description"), rows.alias("rows")))).otherwise(numbered)


def split_row_by(cells: Column, size: Column, lengths: Column) -> Column:
    """A row as rows: its largest cell (the first of equal ones) in pieces of `size`, the others in the first row only."""
    big = F.array_position(lengths, F.array_max(lengths)) - 1
    text = F.get(cells, big)
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text), size)).otherwise(F.array(F.lit(1)))
    return F.transform(starts, lambda at: F.transform(cells, lambda c, i: F.when(i == big, F.substring(c, at, size)).when(at == 1, c).otherwise(F.lit(""))))
