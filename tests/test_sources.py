"""Readers, sinks and registries on small files."""

import json

import pytest

from corpusloom.operators import graph, incremental, tabular
from corpusloom.sources import files, sinks


@pytest.mark.parametrize(("name", "sep"), [("t.csv", ","), ("t.tsv", "\t"), ("t.psv", "|"), ("T.PIPE", "|"), ("t.custom", "~~~")])
def test_separated(spark, tmp_path, name, sep):
    rows = [("first_name", "last_name", "description"), ("example", "user", "this is an example user"), ("admin", "user", 'with "quotes", é')]
    quoted = [[f'"{c.replace(chr(34), chr(34) * 2)}"' if '"' in c else c for c in r] for r in rows]
    (tmp_path / name).write_text("\n".join(sep.join(r) for r in quoted), "utf-8")
    df = files.read_separated(spark, str(tmp_path / name), sep if sep == "~~~" else None)
    assert [tuple(r) for r in df.collect()] == rows[1:]


def test_latin1_fallback(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("a,b\n1,é\n".encode("latin-1"))
    assert [tuple(r) for r in files.read_separated(spark, str(tmp_path / "t.csv")).collect()] == [(1, "é")]


def test_bulk_json(spark, tmp_path):
    docs = [{"id": "a", "sections": [{"text": "x"}]}, {"id": "b"}, {"sections": [{"text": "y"}]}]
    (tmp_path / "d.json").write_text(json.dumps(docs))
    assert [r.id for r in files.read_bulk_json(spark, str(tmp_path)).collect()] == ["a"]


def test_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.PDF", "sub/b.txt", "c.bin"):
        (tmp_path / name).write_text(name)
    sidecar = spark.createDataFrame([("b.txt", "B")], "filename string, title string")
    got = files.read_folder(spark, str(tmp_path), (".pdf", ".txt"), sidecar)
    assert sorted((r.filename, r.title) for r in got.collect()) == [("a.PDF", None), ("b.txt", "B")]
    assert "content" not in got.columns


def test_registry(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\n1\n")
    assert files.open_source(spark, "CSV", path=str(tmp_path / "t.csv")).count() == 1
    with pytest.raises(ValueError, match="no source"):
        files.open_source(spark, "nothing")


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "doc_id long, source string, t string")
    sinks.write_corpus(docs, str(tmp_path / "c"))
    sinks.upsert_corpus(spark.createDataFrame([(2, "b", "z"), (3, "b", "w")], docs.schema), str(tmp_path / "c"), str(tmp_path / "c2"))
    assert sorted((r.doc_id, r.t) for r in spark.read.parquet(str(tmp_path / "c2")).collect()) == [(1, "x"), (2, "z"), (3, "w")]
    sinks.write_copies(docs, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.write_report(spark.createDataFrame([("b",), ("a",), ("b",)], "url string"), str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == ["a", "b"]


DELETIONS = [
    ({"a", "b", "c"}, True, 0.5, {"d"}, False), ({"b", "c", "d"}, True, 0.0, {"a", "a_img_0"}, False), ({"a"}, True, 0.5, None, True), ({"a", "b", "c"}, False, 0.5, None, True), ({"a"}, True, 0.0, {"b", "c", "d"}, False),
]


@pytest.mark.parametrize(("present", "complete", "ratio", "deleted", "refused"), DELETIONS)
def test_deletion_guard(spark, present, complete, ratio, deleted, refused):
    held = spark.createDataFrame([(x, x, p) for x, p in [("a", None), ("b", None), ("c", None), ("d", None), ("a_img_0", "a"), ("part", "unknown")]], "key string, doc_id string, parent_doc_id string")
    got = incremental.plan_deletions(held, spark.createDataFrame([(x,) for x in present], "key string"), complete, ratio).collect()
    assert all(r.refused == refused for r in got)
    assert refused or {r.doc_id for r in got} == deleted


def test_row_numbers_and_chunks(spark):
    df = spark.range(571).withColumnRenamed("id", "n")
    rows = tabular.row_chunks(df, 50, "n").collect()
    assert sorted(r.row_no for r in rows) == list(range(571)) and all(r.row_no == r.n for r in rows)
    assert len({r.chunk_label for r in rows}) == 12 and sum(r.chunk_no == 11 for r in rows) == 21
    with pytest.raises(ValueError):
        tabular.row_chunks(df, 0, "n")


def test_cast_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")], "a string, b string")
    assert dict(tabular.cast_columns(df, {"a": "int", "b": "int"}).dtypes) == {"a": "int", "b": "string"}


def test_reach_and_trees(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), (None, "x")], "src string, dst string")
    got = graph.reach(spark.createDataFrame([("a",)], "id string"), edges, 9)
    assert {(r.id, r.depth) for r in got.collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    nodes = spark.createDataFrame([("r", None, "1"), ("s", "r", "2"), ("t", "s", None), ("x", "y", "3"), ("y", "x", "4")], "k string, p string, v string")
    assert {(r.k, r.path, r["values"]) for r in graph.inherited(nodes, "k", "p", "v").collect()} == {("r", "r", "1"), ("s", "r/s", "1/2"), ("t", "r/s/t", "1/2/")}
