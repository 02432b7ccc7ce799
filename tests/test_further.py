"""Small cases of the further operators that the tables don't hold."""

import gzip
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.__main__ import main
from corpusloom.config import Settings
from corpusloom.functions import files, text, urls
from corpusloom.operators import assemble, graph, incremental, relational, split, stages, tabular
from corpusloom.sources.files import open_source, read_jdbc
from corpusloom.streaming import incremental as streams


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_conditions_as_a_data_frame_reads_them(spark):
    rows = [(1, "R&D", 3.0), (2, "x|y", None), (3, "a == b", 5.0), (4, None, 7.0), (5, "it's", -1.0), (6, 'say "so"', 2.0)]
    df = spark.createDataFrame(rows, "id int, name string, n double")
    frame = pd.DataFrame(rows, columns=["id", "name", "n"])
    for said in (
        "name == 'R&D'", 'name == "x|y" or n > 4', "name != 'a == b' and n < 6", "name == \"it's\"", "n > 2 & n < 6 | id == 1", "~(n > 2)", "not n > 2 and id != 6",
        "name in ['R&D', 'x|y']", "id not in [1, 2]", "2 < n <= 5", "n + 1 > 4 * 1", "(id == 1 or id == 2) and n != 3", "`name` != 'R&D'",
    ):
        assert sorted(r.id for r in df.where(tabular.condition(said)).collect()) == sorted(frame.query(said, engine="python")["id"]), said
    for said in ("name ==", "name.str.len() > 2", "(id == 1", "id = 1"):
        with pytest.raises(ValueError):
            tabular.condition(said)


def test_permissions_count_first_by_id(spark):
    kind = "k int, pos int, id string, type string, role string, email string, domain string, deleted boolean"
    rows = [
        (1, 0, "a", "user", "owner", "A@x.y", None, False), (1, 1, "a", "user", "reader", "a@x.y", None, False), (1, 2, "b", "user", "reader", "b@x.y", None, True), (1, 3, "b", "user", "reader", "b@x.y", None, False),
        (1, 4, None, "group", "reader", "g@x.y", None, None), (1, 5, "d", "domain", "reader", None, "X.Y", None), (1, 6, "e", "user", "published", "e@x.y", None, None), (1, 7, "f", "anyone", "reader", None, None, None), (2, 0, "c", "user", "writer", None, None, None),
    ]
    got = {r.k: r for r in relational.access_lists(spark.createDataFrame(rows, kind), "k", "pos").collect()}
    assert (got[1].owners, got[1].readers, got[1].groups, got[1].domains, got[1].is_public, got[1].is_org_wide) == ("a@x.y", "", "g@x.y", "x.y", True, True)
    assert (got[2].readers, got[2].is_public, got[2].is_org_wide) == ("", False, False)


def test_pictures_equal_first_then_first_stored(spark):
    left = spark.createDataFrame([(1, "abc"), (1, "zz"), (1, "")], "d int, a string")
    right = spark.createDataFrame([(1, "ab", 0), (1, "abc", 5), (1, "zzz", 9), (1, "z", 3), (1, "", 1)], "d int, b string, p int")
    assert {(r.a, r.b) for r in relational.matched_by_containment(left, right, "d", "a", "b", "p").collect()} == {("abc", "abc"), ("zz", "z")}


def test_tables_are_split_as_json(spark):
    """Against the same in plain Python, with long rows, accents and quotes."""

    def size(row):
        return len(json.dumps([{"text_value": c} for c in row]))

    def brute(table_id, said, headers, rows, limit):
        if len(json.dumps({"headers": json.loads(headers), "rows": [[{"text_value": c} for c in r] for r in rows]})) <= limit or not rows:
            return [(table_id, said, rows)]
        budget, cut = int(limit * 0.8), []
        for row in rows:
            if size(row) <= budget - len(headers):
                cut.append(row)
                continue
            lengths = [len(json.dumps(c)) for c in row]
            big = lengths.index(max(lengths))
            n = max(100, budget - len(headers) - (size(row) - lengths[big]))
            cut += [[row[big][i : i + n] if j == big else c if i == 0 else "" for j, c in enumerate(row)] for i in range(0, len(row[big]), n)]
        out, held, total = [], [], len(headers)
        for row in cut:
            if held and total + size(row) > budget:
                out.append(held)
                held, total = [], len(headers)
            held.append(row)
            total += size(row)
        out.append(held)
        return [(table_id + (f"_part{i}" if i else ""), said[:limit], r) for i, r in enumerate(out)]

    headers = '[["a", "b"]]'
    tables = [("t1", "d", [["x", "y"]] * 3), ("t2", "d", [["é\"\n" * 40, "y" * 30]] * 9), ("t3", "d" * 900, [["x" * 1700, "short"], ["a", "b" * 300]]), ("t4", "d", []), ("t5", "d", [["😀" * 20, ""]] * 20)]
    df = spark.createDataFrame(tables, "id string, said string, rows array<array<string>>")
    got = df.select("id", split.split_table(F.col("id"), F.col("said"), F.lit(len(headers)), F.col("rows"), 700).alias("t")).collect()
    for r, (i, said, rows) in zip(got, tables, strict=True):
        assert [(x.id, x.description, x.rows) for x in r.t] == brute(i, said, headers, rows, 700)


def test_text_and_url_functions(spark):
    assert one(spark, text.title_case(F.lit("o'neill's big-data 2nd été")))[0] == "O'Neill'S Big-Data 2Nd Été"
    assert one(spark, text.document_title(F.lit(" "), F.lit(None).cast("string"), F.lit("/a/my_file-name.v2.pdf")))[0] == "My File Name.V2"
    m = F.create_map(F.lit("k"), F.lit('é\n"\\\U0001f600\x01'))
    assert one(spark, text.canonical_map(m))[0] == json.dumps({"k": 'é\n"\\\U0001f600\x01'}, separators=(",", ":"))
    names = {"https://a.b/x/My File.PDF?q": "my-file.PDF", "https://a.b/dir/": "", "https://a.b/.profile": "profile", "https://a.b/a.tar.gz": "a-tar.gz"}
    assert [one(spark, urls.file_name(F.lit(u)))[0] for u in names] == list(names.values())
    ends = {"": "https://d.x", "h.x": "https://h.x", "http://h.x/y": "http://h.x/y", "h.x/y": None, "https://": None}
    assert [one(spark, urls.endpoint(F.lit(u), "d.x"))[0] for u in ends] == list(ends.values())
    assert one(spark, text.markdown_html(F.lit("# Head\n\nA **b** [c](http://d) `e`\n\n- f")))[0] == '<h1>Head</h1>\n<p>A <b>b</b> <a href="http://d">c</a> <code>e</code></p>\n<li>f</li>'


def test_packed_downloads(spark):
    rows = [("a.xml.gz", gzip.compress(b"<x/>")), ("b.gz", b"no pack"), ("c.xml", b"plain"), ("d.gz", None)]
    df = spark.createDataFrame(rows, "u string, d binary")
    assert [None if r.x is None else bytes(r.x) for r in df.select(files.unpacked(F.col("u"), F.col("d")).alias("x")).collect()] == [b"<x/>", b"", b"plain", None]


def test_table_shapes(spark):
    got = one(spark, tabular.markdown_frame(F.lit("| A | B |\n|---|---|\n| 1 | 2 | 3 |\n| 4 | |")), tabular.markdown_frame(F.lit("x|y")), tabular.header_spans(F.array(F.lit("a"), F.lit("a"), F.lit(None).cast("string"), F.lit("a"))))
    assert (got.c0.header, got.c0.rows) == (["A", "B", "Column_3"], [["1", "2", "3"], ["4", "", ""]])
    assert (got.c1.header, got.c1.rows) == (["x", "y"], [])
    assert [tuple(x) for x in got.c2] == [("a", 2), ("", 1), ("a", 1)]


def test_injected_functions(spark):
    sections = spark.createDataFrame([(1, 0, "Éa", "T", None), (1, 1, None, None, None)], "d int, o int, text string, title string, metadata map<string,string>")
    assert assemble.assemble(sections, "d", "o", normalise=F.upper).first().full_text == "ÉA\n"
    elements = spark.createDataFrame([(1, 0, "text", "abc"), (1, 1, "image", "p")], "d int, o int, kind string, content string")
    assert assemble.picture_context(elements, "d", ["o"], "kind", "content", text=F.upper).first().previous_text == "ABC"
    assert one(spark, stages.extracted_metadata(F.lit("x"), lambda h: {"a": 1, "b": None}), stages.extracted_metadata(F.lit("x"), lambda h: 1 / 0)) == ({"a": "1", "b": None}, {})


def test_parsers(spark):
    page = b"<html><title>T</title><nav>n</nav><h1>H</h1><p>a <b>b</b></p><table><tr><td>1</td><td>2</td></tr></table></html>"
    book = json.dumps({"cells": [{"cell_type": "markdown", "source": ["# x"]}, {"cell_type": "code", "source": "y = 1"}, {"cell_type": "code", "source": ""}]}).encode()
    rows = [("a.html", page), ("b.md", b"# Head\n\nbody\nmore"), ("c.ipynb", book), ("d.ipynb", b"{"), ("e.txt", None)]
    df = spark.createDataFrame(rows, "n string, d binary").withColumn("e", stages.parsed(F.col("n"), F.col("d")))
    got = {r.n: [tuple(x) for x in r.e] for r in df.collect()}
    assert got["a.html"] == [("title", "T"), ("title", "H"), ("text", "a b"), ("table", "1 | 2")]
    assert got["b.md"] == [("title", "Head"), ("text", "body\nmore")] and got["c.ipynb"] == [("text", "# x"), ("code", "y = 1")] and got["d.ipynb"] == [] == got["e.txt"]
    again = stages.with_fallback(df, "e", stages.parsed(F.lit("x.txt"), F.lit("seen").cast("binary")), F.col("n") != "e.txt")
    assert {r.n: len(r.e) for r in again.collect()} == {"a.html": 4, "b.md": 2, "c.ipynb": 2, "d.ipynb": 1, "e.txt": 0}


def test_rate_limit_is_a_sliding_window():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = stages.RateLimiter(3, 1.0, lambda: now[0], sleep)
    at = []
    for _ in range(8):
        limiter.wait()
        at.append(now[0])
        now[0] += 0.1
    assert all(b - a >= 1.0 - 1e-9 for a, b in zip(at, at[3:])) and slept
    with pytest.raises(ValueError):
        stages.RateLimiter(0)


def test_streams_go_on_after_a_restart(spark, tmp_path):
    """A stream that ended is started again over more files: only those are read, and states are kept."""
    at, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    kind = "seq long, doc_id string, crawler_type string, status string"
    took = []

    def run():
        def keep(batch, number):
            took.append((number, sorted((r.status, r.delta) for r in batch.collect())))

        streams.run_available(streams.status_changes(streams.stream_of(spark, at, 10)), target, "update", keep)

    spark.createDataFrame([(1, "a", "w", "failed"), (2, "b", "w", "indexed"), (None, "c", "w", "x"), (3, None, "w", "x")], kind).coalesce(1).write.parquet(at)
    run()
    run()
    # a later state, one that comes late, a repeated one
    spark.createDataFrame([(5, "a", "w", "indexed"), (1, "b", "w", "failed"), (5, "a", "w", "indexed")], kind).coalesce(1).write.mode("append").parquet(at)
    run()
    changes = [x for x in took if x[1]]
    assert [c for _, c in changes] == [[("failed", 1), ("indexed", 1)], [("failed", -1), ("indexed", 1)]]


def test_listings(spark):
    pages = spark.createDataFrame([("a", 200, [(1,)]), ("a", 200, [(2,)]), ("b", 200, [(3,)]), ("b", 500, []), ("c", None, [(4,)])], "c string, s int, d array<struct<x:int>>")
    assert sorted(tuple(r) for r in incremental.listing(pages, "c", "s", "d").collect()) == [("a", 1), ("a", 2)]
    ids = spark.createDataFrame([("x",)], "id string")
    assert incremental.removed(ids, ids.limit(0), "id", listing_complete=False).count() == 0 and incremental.removed(ids, ids.limit(0), "id", listing_complete=True).count() == 1


def test_an_index_that_names_itself_ends(spark):
    from corpusloom.functions.html import sitemap_entries

    entry = lambda u: f"<sitemap><loc>{u}</loc></sitemap>"
    df = spark.createDataFrame([("i", entry("i") + entry("m") + entry("gone"), True), ("m", "<url><loc>p</loc><lastmod>2</lastmod></url><url><loc>p</loc><lastmod>1</lastmod></url>", False), ("n", "<url><loc>q</loc></url>", False)], "url string, xml string, is_index boolean")
    assert [tuple(r) for r in graph.sitemap_tree(df, df.where("url = 'i'").select("url"), sitemap_entries).collect()] == [("p", "1")]


def test_database(spark):
    """Columns and condition reach a database, here the one that comes with Spark."""
    url = "jdbc:derby:memory:scan;create=true"
    spark.range(20).select(F.col("id").alias("ID"), (F.col("id") * 2).alias("V"), F.lit("x").alias("UNREAD")).write.format("jdbc").option("url", url).option("dbtable", "T").save()
    df = read_jdbc(spark, url, "T", ["ID", "V"], "V > 30", "ID", (0, 20), 2)
    assert sorted(r.ID for r in df.collect()) == [16, 17, 18, 19]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "UNREAD" not in plan and "PushedFilters: [*IsNotNull(V), *GreaterThan(V,30)]" in plan
    assert open_source(spark, "database", url=url, table="T", columns=["ID"]).count() == 20


def test_settings(spark):
    s = Settings.read({"select_condition": "n > 1", "column_types": {"n": "string"}, "html_processing": {"ids_to_remove": ["ad"], "remove_code": True}, "url_patterns": {"exclude": [".*x"]}})
    assert [(r.n, type(r.n)) for r in s.rows(spark.createDataFrame([(1,), (2,)], "n int")).collect()] == [("2", str)]
    got = one(spark, s.page_text(F.lit("<p>a<code>c</code></p><div id=ad>b</div>")), s.url_taken(F.lit("http://x")), s.url_taken(F.lit("http://y")))
    assert tuple(got) == ("a", False, True)
    with pytest.raises(ValueError):
        Settings.read({"typo": 1})


def test_command_line(spark, folder, tmp_path, capsys):
    assert main(["list"]) == 0 and "sync_actions" in capsys.readouterr().out.split()
    assert main(["run", "nothing", folder]) == 2
    assert main(["run", "long_enough_texts", folder, "--out", f"file://{tmp_path}/out"]) == 0
    assert spark.read.parquet(f"file://{tmp_path}/out").count() > 10


def test_trees_and_threads(spark):
    from corpusloom.operators import threads

    items = [(1, None, "story", False, 5), (2, 1, "comment", False, 9), (3, 2, "comment", True, 99), (4, 3, "comment", False, 99), (5, 1, "job", False, 99), (6, None, "story", None, 1), (7, 6, "comment", None, 2), (8, 8, "comment", False, 9)]
    df = spark.createDataFrame(items, "id long, parent long, type string, dead boolean, time long")
    tree = threads.story_items(df, threads.union_of_lists(df.select("id"), df.select("id")))
    assert {tuple(r) for r in tree.collect()} == {(1, 1, 0), (1, 2, 1), (6, 6, 0), (6, 7, 1)}
    assert {r.story for r in threads.recent_trees(tree, df.select("id", "time"), F.lit(9)).collect()} == {1}
    assert [r.id for r in threads.stories_back_to(df, F.lit(3)).collect()] == [] and {r.id for r in threads.stories_back_to(df, F.lit(0)).collect()} == {1, 6}
    assert threads.story_items(df, df.limit(0).select("id")).count() == 0
    # forty levels: the plan doesn't grow with them
    deep = spark.createDataFrame([(i, i - 1 if i else None, "comment" if i else "story", False) for i in range(40)], "id long, parent long, type string, dead boolean").coalesce(1)
    assert threads.story_items(deep, deep.select("id")).agg(F.max("level")).first()[0] == 39
    says = [("c", 1, 1, 10, "hi <@U1> <@U9>", ["a", "a", " "]), ("c", 1, 2, 11, None, None), ("c", 1, 3, 12, "bye", None), ("c", 2, 1, 13, " ", [])]
    messages = spark.createDataFrame(says, "channel string, thread int, at int, id int, text string, attachments array<string>")
    docs = threads.chat_documents(messages, spark.createDataFrame([("U1", "ann")], "id string, name string")).collect()
    assert [(r.thread, r.sections) for r in docs] == [(1, ["hi @ann <@U9>\na", "bye"])]


def test_blocks_and_archives(spark):
    import io
    import zipfile

    from corpusloom.operators import threads

    blocks = spark.createDataFrame([(1, 100, 2, "p", "two"), (2, 100, 1, "p", "one"), (3, 2, 10, "p", "b"), (4, 2, 9, "p", "a"), (5, 100, 0, "child_page", "no"), (6, 5, 0, "p", "no"), (7, 200, 0, "p", " ")], "id int, parent int, ord int, type string, text string")
    assert [tuple(r) for r in threads.block_texts(blocks, spark.createDataFrame([(100,), (200,)], "id int")).collect()] == [(100, "one a b two")]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("d/", b"")
        z.writestr("d/a.txt", b"A")
    df = spark.createDataFrame([(held.getvalue(),), (b"none",), (None,)], "z binary")
    assert [[(m.name, bytes(m.data)) for m in r.m] for r in df.select(threads.archive_members(F.col("z")).alias("m")).collect()] == [[("d/a.txt", b"A")], [], []]
