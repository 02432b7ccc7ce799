"""Tables to documents: conditions, casts, grouping by keys, row chunks, promotion of constant columns."""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import cut_lineage


_TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<name>`[^`]+`|[^\W\d]\w*)|(?P<number>\d+(?:\.\d*)?(?:[eE][+-]?\d+)?)|(?P<op>==|!=|<=|>=|//|\*\*|[-+*/%<>&|~()\[\],]))""")
_COMPARE = ("==", "!=", "<", "<=", ">", ">=")


class _Condition:
    """Reads a data-frame condition: or, and, not (also | & ~, which bind alike there), comparisons, membership, arithmetic."""

    def __init__(self, text: str):
        self.tokens, self.at, end = [], 0, 0
        while text[end:].strip():
            m = _TOKEN.match(text, end)
            if m is None:
                raise ValueError(f"can't read {text[end:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            end = m.end()

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and self.tokens[self.at][0] != "text":
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> str:
        out = self.any_of()
        if self.peek() is not None:
            raise ValueError(f"can't read from {self.peek()!r} on")
        return out

    def any_of(self) -> str:
        parts = [self.all_of()]
        while self.take("or", "|"):
            parts.append(self.all_of())
        return parts[0] if len(parts) == 1 else "(" + " OR ".join(parts) + ")"

    def all_of(self) -> str:
        parts = [self.negated()]
        while self.take("and", "&"):
            parts.append(self.negated())
        return parts[0] if len(parts) == 1 else "(" + " AND ".join(parts) + ")"

    def negated(self) -> str:
        if self.take("not", "~"):
            return f"NOT {self.negated()}"
        return self.compared()

    def compared(self) -> str:
        left, parts = self.sum(), []
        while True:
            if self.take("not"):
                if not self.take("in"):
                    raise ValueError("'not' without 'in'")
                right = self.listed()
                parts.append(f"NOT coalesce({left} IN ({right}), false)")
            elif self.take("in"):
                right = self.listed()
                parts.append(f"coalesce({left} IN ({right}), false)")
            elif op := self.take(*_COMPARE):
                if op in ("==", "!=") and self.peek() == "[":
                    right = self.listed()
                    parts.append(f"{'NOT ' if op == '!=' else ''}coalesce({left} IN ({right}), false)")
                else:
                    right = self.sum()
                    # a null is unequal to anything, and else no comparison with it holds
                    parts.append(f"coalesce({left} <> {right}, true)" if op == "!=" else f"coalesce({left} {'=' if op == '==' else op} {right}, false)")
            else:
                return left if not parts else parts[0] if len(parts) == 1 else "(" + " AND ".join(parts) + ")"
            left = right

    def listed(self) -> str:
        if not self.take("["):
            raise ValueError("a list was expected")
        out = []
        while not self.take("]"):
            out.append(self.sum())
            self.take(",")
        return ", ".join(out) or "NULL"

    def sum(self) -> str:
        out = self.atom()
        while op := self.take("+", "-", "*", "/", "%"):
            out = f"{out} {op} {self.atom()}"
        return out

    def atom(self) -> str:
        if self.take("-"):
            return f"-{self.atom()}"
        if self.take("("):
            inner = self.any_of()
            if not self.take(")"):
                raise ValueError("a bracket isn't closed")
            return f"({inner})"
        if self.at >= len(self.tokens):
            raise ValueError("the condition ends too early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            value = ast.literal_eval(text)
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if kind == "op":
            raise ValueError(f"{text!r} isn't a value")
        return {"True": "true", "False": "false", "None": "NULL"}.get(text, text)


def condition(text: str) -> str:
    """A data-frame condition as SQL. Texts stay as they are; a null is unequal to anything, and any other comparison with it is false."""
    return _Condition(text).whole()


def equality(text: str) -> Column:
    """The one condition a hub scan takes: `column = 'value'`; anything else is an error."""
    m = re.fullmatch(r"\s*(\w+)\s*=\s*'([^']*)'\s*", text)
    if m is None:
        raise ValueError(f"not of the form column = 'value': {text!r}")
    return F.col(m[1]).cast("string") == m[2]


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast; one of which any value can't be cast stays as it is. One aggregate decides for all columns."""
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()]).first()
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if not bad[c]})


def group_id(*columns: Column) -> Column:
    """Key parts joined by ' - ', without those that count as nothing: empty texts, zeros, false."""
    kept = [F.when(~c.cast("string").isin("", "0", "0.0", "false"), c.cast("string")) for c in columns]
    return F.concat_ws(" - ", *kept)


def group_documents(df: DataFrame, keys: list[str], order: str, texts: list[str], metadata: list[str], title: str | None = None) -> DataFrame:
    """One row a key without null parts: doc_id, texts of the rows in order, metadata columns with one value promoted (else null), first title."""
    constant = [F.when((F.count_distinct(m) == 1) & (F.count(m) == F.count("*")), F.min(m)).alias(m) for m in metadata]
    rows = df.dropna(subset=keys)
    out = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("ord"), F.concat_ws(" - ", *[F.col(t).cast("string") for t in texts]).alias("text")))).alias("rows"),
        F.count("*").alias("n_rows"),
        *constant,
        *([F.min_by(title, order).alias("title")] if title else []),
    )
    return out.withColumn("doc_id", group_id(*[F.col(k) for k in keys]))


def row_numbers(df: DataFrame, *order: str, name: str = "row_no") -> DataFrame:
    """Rows numbered from 0 in order, without bringing all into one task: numbers within ranges, plus the sizes of the ranges before."""
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    # as many rows as ranges
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_local", local).join(F.broadcast(before), "_range").withColumn(name, F.col("_local") + F.col("_before")).drop("_range", "_local", "_before")


def row_chunks(df: DataFrame, size: int, *order: str) -> DataFrame:
    """Rows with the number and label of their chunk of `size` rows."""
    if size <= 0:
        raise ValueError("a chunk has at least one row")
    first = F.floor(F.col("row_no") / size) * size
    label = F.concat(F.lit("row "), first) if size == 1 else F.concat(F.lit("rows "), first, F.lit("-"), first + size - 1)
    return row_numbers(df, *order).withColumns({"chunk_no": F.floor(F.col("row_no") / size).cast("long"), "chunk_label": label})


def truncated(df: DataFrame, order: list[str], rows: int = 500, columns: int = 20) -> DataFrame:
    """The first rows and columns of a table that is to be shown as a whole."""
    return df.orderBy(*order).limit(rows).select(*df.columns[:columns])


def markdown_table(lines: Column) -> Column:
    """Rows of cells of a markdown table; empty cells and the separator row go."""
    rows = F.filter(F.split(lines, "\n"), lambda r: F.trim(r) != "")
    cells = F.transform(rows, lambda r: F.filter(F.transform(F.split(r, r"\|"), lambda c: F.trim(c)), lambda c: c != ""))
    return F.filter(cells, lambda r: ~F.forall(r, lambda c: c.rlike(r"^:?-+:?\z")))


def markdown_frame(lines: Column) -> Column:
    """A markdown table as header and rows. Empty cells go, so rows may be shifted; the header gets Column_k for what rows have more, short rows are filled up."""
    kept = F.filter(F.split(F.trim(lines), "\n"), lambda r: F.lit(True))
    cells = F.transform(kept, lambda r: F.filter(F.transform(F.split(r, r"\|"), lambda c: F.trim(c)), lambda c: c != ""))
    separator = (F.size(kept) > 1) & F.get(kept, F.lit(1)).rlike(r"^[\s|\-]*\z") & F.get(kept, F.lit(1)).contains("-")
    rows = F.slice(cells, F.when(separator, 3).otherwise(2), F.greatest(F.size(cells), F.lit(1)))
    header = F.get(cells, F.lit(0))
    width = F.greatest(F.size(header), F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0)))
    more = F.when(width > F.size(header), F.transform(F.sequence(F.size(header) + 1, F.greatest(width, F.size(header) + 1)), lambda k: F.concat(F.lit("Column_"), k))).otherwise(F.array().cast("array<string>"))
    filled = F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), F.greatest(width - F.size(r), F.lit(0)))))
    return F.struct(F.concat(header, more).alias("header"), filled.alias("rows"))


def header_spans(labels: Column) -> Column:
    """A row of column labels as (label, span): neighbours of one label become one; null counts as ''."""
    kind = "array<struct<label:string,span:int>>"

    def step(out: Column, x: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        grown = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(last["label"].alias("label"), (last["span"] + 1).alias("span"))))
        return F.when(last["label"] == x, grown).otherwise(F.concat(out, F.array(F.struct(x.alias("label"), F.lit(1).alias("span"))))).cast(kind)

    return F.aggregate(F.transform(labels, lambda x: F.coalesce(x, F.lit(""))), F.array().cast(kind), step)


def whole_table(df: DataFrame, doc_id: str, title: str, order: list[str], rows: int = 500, columns: int = 20) -> DataFrame:
    """Table mode: one document of a whole table, with its summary as text, and of what is shown the first rows and columns."""
    n = df.count()
    if not n:
        rows = 0
    shown = truncated(df, order, rows, columns)
    cells = F.struct(*[F.col(c) for c in order], F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in shown.columns]).alias("_cells"))
    table = shown.agg(F.transform(F.array_sort(F.collect_list(cells)), lambda r: r["_cells"]).alias("rows"))
    said = F.concat(F.lit(title), F.lit(f": {n} rows with columns "), F.lit(", ".join(df.columns[:columns])))
    return table.where(F.size("rows") > 0).select(F.lit(doc_id).alias("doc_id"), said.alias("text"), F.array(*[F.lit(c) for c in shown.columns]).alias("headers"), "rows")
