"""Rich-text trees (documents of nodes with content) to plain text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Nodes after which a line ends.
BLOCKS = frozenset("paragraph heading listItem bulletList orderedList codeBlock blockquote rule tableRow panel".split())


def plain_tree(tree) -> str:
    """Texts of a tree in order, block nodes on lines of their own; mentions, emoji and links by their text. No recursion."""
    out: list[str] = []
    stack = [tree]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            kind, attrs = x.get("type"), x.get("attrs") or {}
            if kind == "text":
                out.append(x.get("text") or "")
            elif kind == "hardBreak":
                out.append("\n")
            elif kind in ("mention", "emoji", "inlineCard"):
                out.append(str(attrs.get("text") or attrs.get("shortName") or attrs.get("url") or ""))
            if kind in BLOCKS:
                stack.append("\n")
            stack.append(x.get("content") or [])
    lines = [" ".join(line.split()) for line in "".join(out).split("\n")]
    return "\n".join(x for x in lines if x)


def rich_text(c: Column) -> Column:
    """Plain text of a JSON tree; a value that isn't JSON stands for itself."""

    def one(v):
        if v is None:
            return None
        try:
            return plain_tree(json.loads(v))
        except ValueError:
            return v

    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(one)

    return run(c)
