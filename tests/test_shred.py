"""Shredded tables against a plain walk, on the project's payloads and on made ones."""

import json
import time
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators.shred import array_keys, flat_table, keys_of_arrays, parsed, readable, shred, shred_batch


def walk(doc, repeated):
    """(node_path, parent_path) of every object in an array."""
    out = []

    def as_array(x, k):
        if k in repeated and isinstance(x, dict):
            return [x]
        if k in repeated and isinstance(x, str):
            try:
                y = json.loads(x)
            except ValueError:
                return x
            return y if isinstance(y, list) else x
        return x

    def go(v, path, parent, key):
        if isinstance(v, dict):
            for k, x in v.items():
                if not (key == "tables" and k == "data"):
                    go(as_array(x, k), (path + "." if path else "") + k, parent, k)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                p = f"{path}[{i}]"
                if isinstance(x, dict):
                    out.append((p, parent))
                go(x, p, p if isinstance(x, dict) else parent, key)

    go(doc, "", "", None)
    return out


def test_project_payloads(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/raw_records.parquet")
    repeated = array_keys(df)
    assert {"sections", "tables", "spans"} <= repeated and not {"metadata", "text", "by"} & repeated
    want = Counter((r.rec_id, *x) for r in df.collect() if (d := readable(r.payload)) is not None for x in walk(d, repeated))
    assert Counter(tuple(r) for r in shred(df).collect()) == want
    assert sum(want.values()) > 1000


leaf = st.none() | st.booleans() | st.integers(-5, 5) | st.text("ab[{", max_size=3)
keys = st.sampled_from(["sections", "tables", "data", "labels", "a", "b", "metadata"])
tree = st.recursive(leaf, lambda x: st.lists(x, max_size=3) | st.dictionaries(keys, x, max_size=3), max_leaves=25)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.dictionaries(keys, tree, max_size=4), min_size=1, max_size=4))
def test_any_documents(docs):
    found = set()
    for d in docs:
        keys_of_arrays(d, found)
    repeated = frozenset(found)
    want = Counter((i, *x) for i, d in enumerate(docs) for x in walk(json.loads(json.dumps(d)), repeated))
    for leaves in (False, True):
        got = Counter()
        for record, paths, parents, name, fields in shred_batch(json.loads(json.dumps(docs)), leaves, repeated):
            for j, (r, p, q) in enumerate(zip(record, paths, parents, strict=True)):
                if p and not (leaves and fields[j] and fields[j][0][0] == "value"):
                    got[(r, p, q)] += 1
        assert got == want


def test_links_lead_to_rows(spark, folder):
    rows = shred(spark.read.parquet(f"{folder}/raw_records.parquet"), leaves=True).collect()
    places = {(r.rec_id, r.node_path) for r in rows}
    assert all(r.parent_path is None or (r.rec_id, r.parent_path) in places for r in rows)
    assert all(set(r.fields) for r in rows if r.table_name == "document")


def test_odd_payloads(spark):
    deep = "[" * 3000 + "]" * 3000
    rows = [
        (1, None), (2, ""), (3, "no"), (4, "[1]"), (5, '"x"'), (6, "﻿" + '{"document": {"sections": [{}]}}'), (7, '{"sections": {"title": 1}}'), (8, '{"sections": "[{}, null, 3, {}]"}'),
        (9, '{"a": [[{"b": [{}]}], {}]}'), (10, '{"x": ' + deep + "}"), (11, '{"sections": [{"text": "\\ud800"}]}'), (12, '{"sections": [{"text": "' + "long " * 200_000 + '"}]}'), (12, '{"sections": [{}]}'), (14, json.dumps({"sections": "[" * 900 + "]" * 900})), (15, json.dumps({"sections": "[{}, \"]"})), (13, '{"tables": [{"data": {"rows": [{}]}, "cells": [{}]}]}'),
    ]
    df = spark.createDataFrame([(a, b, "clash") for a, b in rows], "rec_id int, payload string, node_path string")
    got = sorted((r.rec_id, r.node_path, r.parent_path) for r in shred(df).collect())
    assert got == [
        (6, "sections[0]", ""), (7, "sections[0]", ""), (8, "sections[0]", ""), (8, "sections[3]", ""), (9, "a[0][0]", ""), (9, "a[0][0].b[0]", "a[0][0]"), (9, "a[1]", ""), (11, "sections[0]", ""), (12, "sections[0]", ""), (12, "sections[0]", ""),
        (13, "tables[0]", ""), (13, "tables[0].cells[0]", "tables[0]"),
    ]
    assert shred(df, leaves=True).where("table_name = 'sections'").count() == 8  # an array's scalar is a row of its own here
    assert flat_table(shred(df, leaves=True), "sections", ["title"]).where("title = '1'").count() == 1
    assert shred(df.limit(0)).count() == 0


def test_any_depth(spark):
    """Payloads nested deeper than recursion goes, also inside a string."""
    n = 60_000
    deep = '{"sections": [' * 500 + '{"sections": ' + '"[{}]"' + "}" + "]}" * 500
    lists = '{"x": ' + "[" * n + '{"y": "\\u00e9", "z": [1.5, -2, true, null]}' + "]" * n + "}"
    inside = json.dumps({"sections": '[{"sections": ' * 300 + "[]" + "}]" * 300})
    df = spark.createDataFrame([(1, deep), (2, lists), (3, inside), (4, lists[:-1])], "rec_id int, payload string")
    got = {}
    for r in shred(df).collect():
        got.setdefault(r.rec_id, []).append((r.node_path, r.parent_path))
    assert sorted(len(p) for p, _ in got[1]) == [11 + 12 * i for i in range(501)]
    assert all(p.rpartition(".")[0] == q for p, q in got[1])
    assert got[2] == [("x" + "[0]" * n, "")] and len(got[3]) == 300 and 4 not in got
    assert parsed(lists)["x"][0][0] is not None
    rows = shred(spark.createDataFrame([(1, '{"tables": [{"data": ' + "[" * n + "]" * n + "}]}")], "rec_id int, payload string"), leaves=True)
    assert len(rows.where("table_name = 'tables'").first().fields["data"]) == 2 * n


def test_loop_parser_equals_the_library(monkeypatch):
    from corpusloom.operators import shred as module

    texts = ['{"a": [1, -2.5e3, "x\\u00e9\\n", {}, [], null, true, false], "b": {"c": {"d": ""}}, "a": 3}', "[]", "3", ' "x" ', "{", "[1,]", '{"a" 1}', '{"a":1,}', "[1 2]", "tru", "[1]]", "", '{1: 2}']
    for t in texts:
        try:
            want = json.loads(t)
        except ValueError:
            want = "error"
        try:
            got = module._parsed_by_loop(t)
        except ValueError:
            got = "error"
        assert got == want, t


def test_records_with_keys_of_their_own():
    """A record costs what it holds, not what others hold; also items of one array with keys of their own."""
    docs = [{f"k{i}_{j}": {"n": [{"v": i}]} if j == 3 else i for j in range(4)} for i in range(10_000)]
    began = time.perf_counter()
    rows = sum(len(r) for i in range(0, 10_000, 1_000) for r, *_ in shred_batch(docs[i : i + 1_000], True, frozenset()))
    assert rows == 20_000 and time.perf_counter() - began < 5
