"""Deeply nested JSON records to flat tables, by columnar shredding.

A batch of records is stored column by column.  Each path keeps one entry per
place where its value stands, with two small numbers: the repetition level (the
innermost repeated ancestor at which the entry starts anew) and the definition
level (how many steps of the path are there).  Absences are not written one by
one: an entry says at which entry of its parent it stands, and what lies between
two of them is filled in from the parent's levels when the column is read.  So a
record costs what it holds, not what other records hold.  The tables are rebuilt
from the level sequences: one table per repeated ancestor, array positions by
counting entries per level, parents by cutting the path at the next level that
is an object.

Which keys are repeated is learnt: a key that is an array anywhere in the data
is one everywhere, so a lone object or a string with an array counts as that
array there.  That is one aggregate pass over the payloads (`array_keys`); what
reaches the driver is the distinct names of such keys, a part of the schema.

Records are handled one by one, so nothing is shuffled and a hot source is no
hot group.  Column pruning: without `leaves` only array slots keep columns.
Nothing here recurses: payloads may be nested to any depth.

Defined results: a null, empty, unreadable or non-object payload gives no rows;
a repeated delivery gives its rows again under its own id; null elements and
other non-objects take a position but give no row; an empty object gives a row;
of a key that an object has twice the last counts.  Extra columns of the input
are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from json.decoder import scanstring

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What lies under this key of an object at that place stays one opaque leaf.
OPAQUE = {"tables": "data"}
ENVELOPES = ("document",)
#: More names of repeated keys than this aren't a schema; that is an error, nothing is left out.
MOST_KEYS = 1_000_000

_BITS = 32
_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(\.\d+)?([eE][-+]?\d+)?")
_NAMES = {"true": True, "false": False, "null": None, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}


def parsed(text: str):
    """json.loads, also for texts that are nested deeper than recursion goes."""
    try:
        return json.loads(text)
    except RecursionError:
        return _parsed_by_loop(text)


def _parsed_by_loop(text: str):
    at, n = 0, len(text)
    root: list = []
    open_: list = [root]
    keys: list = [None]
    # what may come next: a value, a key, a comma or an end
    state = "value"
    while True:
        at = _SPACE.match(text, at).end()
        top = open_[-1]
        if top is root and state == "next":
            if at != n:
                raise ValueError("more than one value")
            return root[0]
        c = text[at : at + 1]
        if state in ("key", "key or end"):
            if c == "}" and state == "key or end":
                open_.pop(), keys.pop()
                at, state = at + 1, "next"
                continue
            if c != '"':
                raise ValueError("a key was expected")
            keys[-1], at = scanstring(text, at + 1, True)
            at = _SPACE.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError("a colon was expected")
            at, state = at + 1, "value"
            continue
        if state == "next":
            if c == ",":
                at, state = at + 1, "key" if type(top) is dict else "value"
            elif c == ("}" if type(top) is dict else "]"):
                open_.pop(), keys.pop()
                at += 1
            else:
                raise ValueError("a comma or an end was expected")
            continue
        if c == "]" and state == "value or end":
            open_.pop(), keys.pop()
            at, state = at + 1, "next"
            continue
        inside = None
        if c == "{" or c == "[":
            value = inside = {} if c == "{" else []
            at += 1
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := _NUMBER.match(text, at):
            value, at = (float(m[0]) if m[1] or m[2] else int(m[0])), m.end()
        else:
            name = next((x for x in _NAMES if text.startswith(x, at)), None)
            if name is None:
                raise ValueError("a value was expected")
            value, at = _NAMES[name], at + len(name)
        if type(top) is dict:
            top[keys[-1]] = value
        else:
            top.append(value)
        if inside is not None:
            open_.append(inside), keys.append(None)
        state = "next" if inside is None else "key or end" if c == "{" else "value or end"


def dumped(value) -> str:
    """json.dumps of a value that may be nested deeper than recursion goes."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        pass
    out: list[str] = []
    todo: list = [value]
    while todo:
        x = todo.pop()
        if type(x) is tuple:
            out.append(x[0])
        elif type(x) is dict or type(x) is list:
            parts: list = [("{" if type(x) is dict else "[",)]
            for i, y in enumerate(x.items() if type(x) is dict else x):
                if i:
                    parts.append((", ",))
                if type(x) is dict:
                    parts.append((json.dumps(y[0], ensure_ascii=False) + ": ",))
                parts.append(y[1] if type(x) is dict else y)
            todo += reversed([*parts, ("}" if type(x) is dict else "]",)])
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


class _Slot:
    """A place for a value: the levels of its entries, and at which entries of the parent they stand."""

    __slots__ = ("at", "depth", "item", "key", "keys", "level", "levels", "opaque", "parent", "scalar_at", "scalars", "sizes")

    def __init__(self, parent: _Slot | None, key: str | None, opaque: str | None = None):
        self.parent, self.key, self.keys, self.item, self.opaque = parent, key, {}, None, opaque
        self.level = 0 if parent is None else parent.level + (key is None)
        self.depth = 0 if parent is None else parent.depth + 1
        self.levels: list[int] = []
        self.at: list[int] = []
        self.sizes: list[int] = []
        self.scalar_at: list[int] = []
        self.scalars: list = []


def readable(payload: str | None, envelopes: Iterable[str] = ENVELOPES) -> dict | None:
    """The document of a payload, without byte-order mark and envelope; None where it can't be read."""
    if not payload:
        return None
    try:
        doc = parsed(payload.lstrip("﻿"))
    except ValueError:
        return None
    while isinstance(doc, dict) and len(doc) == 1 and (inner := next(iter(doc))) in envelopes and isinstance(doc[inner], dict):
        doc = doc[inner]
    return doc if isinstance(doc, dict) else None


def keys_of_arrays(doc: dict, found: set[str]) -> None:
    """Adds the keys whose value is an array in the document; what is opaque isn't looked into."""
    todo: list = [(doc, None)]
    while todo:
        value, opaque = todo.pop()
        if type(value) is dict:
            for key, x in value.items():
                if key != opaque:
                    if type(x) is list:
                        found.add(key)
                    if type(x) is list or type(x) is dict:
                        todo.append((x, OPAQUE.get(key)))
        else:
            todo += [(x, opaque) for x in value if type(x) is dict or type(x) is list]


def array_keys(df: DataFrame, payload: str = "payload") -> frozenset[str]:
    """The keys that are an array anywhere in the readable payloads: one pass, distinct names only."""

    def run(batches):
        told: set[str] = set()
        for batch in batches:
            found: set[str] = set()
            for text in batch.column(0).to_pylist():
                if (doc := readable(text)) is not None:
                    keys_of_arrays(doc, found)
            new = sorted(_text(k) for k in found - told)
            told |= found
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string())], names=["key"])

    names = df.select(F.col(f"`{payload}`").cast("string").alias("p")).where(F.contains("p", F.lit("["))).mapInArrow(run, "key string").distinct().limit(MOST_KEYS + 1).toArrow().column(0).to_pylist()
    if len(names) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} names of repeated keys: the payloads' keys are data")
    return frozenset(names)


def _as_array(value, key: str, repeated: frozenset):
    """The array that a lone object or a string stands for under a repeated key; anything else as it is."""
    if key in repeated:
        if type(value) is dict:
            return [value]
        if type(value) is str and value.lstrip()[:1] == "[":
            try:
                inner = parsed(value)
            except ValueError:
                return value
            return inner if type(inner) is list else value
    return value


def _store(root: _Slot, doc: dict, leaves: bool, repeated: frozenset) -> None:
    """Appends the entries of a document.

    A level is repetition level and definition level in one number. A value that is there adds two to the definition level of
    what encloses it, an object one more, so that an absent child, which takes its parent's level, has a smaller one.
    """
    todo = [(root, doc, len(root.levels), 0)]
    root.levels.append(1)
    while todo:
        slot, value, entry, level = todo.pop()
        # entry: the number of the value's entry in the slot's whole sequence; level: that of the entry
        if type(value) is dict:
            opaque = slot.opaque
            for key, x in value.items():
                kind = type(x)
                if key == opaque:
                    if not leaves or x is None:
                        continue
                    x = x if kind is str else dumped(x)
                    kind = str
                elif kind is dict or kind is str:
                    x = _as_array(x, key, repeated)
                    kind = type(x)
                if kind is dict or kind is list or (leaves and x is not None):
                    child = slot.keys.get(key)
                    if child is None:
                        child = slot.keys[key] = _Slot(slot, key, OPAQUE.get(key))
                    own = (level >> _BITS << _BITS) | (2 * child.depth + (kind is dict))
                    child.at.append(entry)
                    child.levels.append(own)
                    if kind is dict or kind is list:
                        todo.append((child, x, entry, own))
                    else:
                        child.scalar_at.append(entry)
                        child.scalars.append(x)
        elif value:
            item = slot.item
            if item is None:
                item = slot.item = _Slot(slot, None, slot.opaque)
            first = len(item.levels) + entry - len(item.at)
            item.at.append(entry)
            item.sizes.append(len(value))
            there, again = 2 * item.depth, item.level << _BITS
            below = []
            for i, x in enumerate(value):
                kind = type(x)
                own = (again if i else level >> _BITS << _BITS) | (there + (kind is dict) if x is not None else there - 1)
                item.levels.append(own)
                if kind is dict or kind is list:
                    below.append((item, x, first + i, own))
                elif leaves and x is not None:
                    item.scalar_at.append(first + i)
                    item.scalars.append(x)
            todo += reversed(below)


def _expanded(parent: np.ndarray, slot: _Slot) -> np.ndarray:
    """The slot's whole sequence of levels up to its last entry: its own entries, the parent's levels where it is absent."""
    end = slot.at[-1] + 1
    at = np.asarray(slot.at)
    times = np.ones(end, np.int64)
    own = np.zeros(end, bool)
    own[at] = True
    if slot.key is None:
        times[at] = slot.sizes
    out = np.repeat(parent[:end], times)
    out[np.repeat(own, times)] = slot.levels
    return out


def _positions(rep: np.ndarray, levels: int) -> list[np.ndarray]:
    """For each repetition level the array position of every entry, by counting entries since the level began."""
    out = []
    for k in range(1, levels + 1):
        count = np.cumsum(rep == k)
        out.append(count - np.maximum.accumulate(np.where(rep < k, count, -1)))
    return out


def _path(slot: _Slot) -> list[tuple[str | None, _Slot]]:
    steps = []
    while slot.parent is not None:
        steps.append((slot.key, slot))
        slot = slot.parent
    return steps[::-1]


def _template(steps: list[tuple[str | None, _Slot]]) -> str:
    """The path with {} for each array position, as a format string."""
    text = ""
    for key, _ in steps:
        text += "[{}]" if key is None else ("." if text else "") + key.replace("{", "{{").replace("}", "}}")
    return text


def _leaf_columns(slot: _Slot) -> Iterator[tuple[str, _Slot]]:
    """(path, slot) of the scalars that stand once in each value of the slot. Their entries are numbered like its own."""
    todo = [("", slot)]
    while todo:
        path, s = todo.pop()
        if s.scalars:
            yield path or "value", s
        todo += [((path + "." if path else "") + k, c) for k, c in reversed(s.keys.items())]


def _fields(slot: _Slot, entries: np.ndarray) -> list[list[tuple[str, object]]]:
    """The leaves of each of the slot's values, whose entries are given in order."""
    fields: list[list] = [[] for _ in range(len(entries))]
    for path, s in _leaf_columns(slot):
        for i, x in zip(np.searchsorted(entries, s.scalar_at).tolist(), s.scalars, strict=True):
            fields[i].append((path, x))
    return fields


def shred_batch(docs: list[dict], leaves: bool, repeated: frozenset):
    """(record index, path, parent path, table name, fields or None) of all rows of a batch of documents."""
    root = _Slot(None, None)
    for doc in docs:
        _store(root, doc, leaves, repeated)
    todo = [(root, np.asarray(root.levels, np.int64))]
    while todo:
        slot, levels = todo.pop()
        for child in (*slot.keys.values(), slot.item):
            if child is not None and (child.item is not None or child.keys or child.key is None):
                todo.append((child, _expanded(levels, child)))
        if slot.key is not None or slot is root:
            continue
        rep = levels >> _BITS
        there = (levels & ((1 << _BITS) - 1)) == 2 * slot.depth + 1
        if leaves and slot.scalars:
            there[slot.scalar_at] = True
        at = np.flatnonzero(there)
        if not at.size:
            continue
        record = (np.cumsum(rep == 0) - 1)[at].tolist()
        places = [p[at].tolist() for p in _positions(rep, slot.level)]
        steps = _path(slot)
        # the parent is the innermost enclosing array slot from which the path goes on by a key
        cut = next((i for i in range(len(steps) - 1, 0, -1) if steps[i - 1][0] is None and steps[i][0] is not None), 0)
        n_above = sum(k is None for k, _ in steps[:cut])
        name = ".".join(k for k, _ in steps if k is not None)
        paths = list(map(_template(steps).format, *places))
        parents = list(map(_template(steps[:cut]).format, *places[:n_above])) if n_above else [""] * len(paths)
        yield record, paths, parents, name, _fields(slot, at) if leaves else None
    if leaves:
        yield list(range(len(docs))), [""] * len(docs), [None] * len(docs), "document", _fields(root, np.arange(len(docs)))


def _text(value) -> str:
    if isinstance(value, bool) or value is None:
        return json.dumps(value)
    return str(value).encode("utf-8", "replace").decode("utf-8")


def shred(df: DataFrame, key: str = "rec_id", payload: str = "payload", leaves: bool = False, repeated: frozenset | None = None) -> DataFrame:
    """Rows of all objects in arrays: the record's key as `rec_id`, node_path, parent_path.

    With `leaves` also `table_name`, the document itself (path '', parent null), arrays of scalars, and `fields`,
    a map from the leaf's path inside the object to its value as text. repeated: the keys of arrays, if they are known;
    else they are learnt from all of df.
    """
    if repeated is None:
        repeated = array_keys(df, payload)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            docs, index = [], []
            for i, text in enumerate(texts):
                doc = readable(text)
                if doc is not None:
                    docs.append(doc)
                    index.append(i)
            if not docs:
                continue
            at = np.asarray(index)
            for record, paths, parents, name, fields in shred_batch(docs, leaves, repeated):
                cols = [ids.take(pa.array(at[record])), pa.array([_text(x) for x in paths]), pa.array([x if x is None else _text(x) for x in parents], pa.string())]
                if leaves:
                    cols += [pa.array([_text(name)] * len(paths)), pa.array([[(_text(k), _text(v)) for k, v in row] for row in fields], pa.map_(pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=["rec_id", "node_path", "parent_path", "table_name", "fields"][: len(cols)])

    kind = df.schema[key].dataType.simpleString()
    schema = f"rec_id {kind}, node_path string, parent_path string" + (", table_name string, fields map<string,string>" if leaves else "")
    return df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{payload}`").cast("string").alias("p")).mapInArrow(run, schema)


def flat_table(shredded: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One related table out of shred(..., leaves=True), with the named leaves as columns and the link to its parent."""
    return shredded.where(F.col("table_name") == name).select("rec_id", "node_path", "parent_path", *[F.col("fields")[c].alias(c.replace(".", "_")) for c in columns])
