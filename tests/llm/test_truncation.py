import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import truncation
from corpusloom.llm.truncation import artificial, features, length_counts, limits, rates, scored


def test_held_out_cuts_are_told_from_whole_texts(spark):
    """Texts that weren't trained on: cut ones are found, whole ones with every kind of ending are not."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text rlike '[.!?]$' and length(text) > 200")
    texts = [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]
    half = len(texts) // 2
    endings = ["", "\n\n- folder\n- splitter", "\n— Flopark", "\n\nKind regards,\nTeam Crevux", "\n\nhttps://a.example/b/12", "\n#queue #replica"]
    train = spark.createDataFrame([(i, t + endings[i % 6], "s") for i, t in texts[:half]], "id long, text string, source string")
    rows = truncation._prepared(train, "id", "text", "source")
    model = truncation.train(rows, *truncation.prepared(rows))
    cut = [model.score(c, 0) > 0 for i, t in texts[half:] for c, _ in artificial(t, i, [], 1)]
    whole = [model.score(t + endings[i % 6], 0) > 0 for i, t in texts[half:]]
    assert np.mean(cut) > 0.9 and np.mean(whole) < 0.05


def test_limits(spark):
    rng = np.random.default_rng(0)
    n = [int(x) for x in rng.integers(300, 4000, 3000)] + [1024] * 60 + [int(x) for x in rng.integers(1992, 2001, 50)]
    df = spark.createDataFrame([("a", x, x) for x in n], "source string, n_chars int, n_bytes int").withColumn("n_chars", F.col("n_chars").cast("int"))
    assert {(r.kind, r["at"]) for r in limits(length_counts(df)).collect()} == {("chars", 1024), ("bytes", 1024), ("chars", 2000), ("bytes", 2000)}
    assert limits(length_counts(df.limit(0))).count() == 0


def test_odd_tables(spark):
    rows = [(1, None, "s"), (2, "  \n", "s"), (3, "One whole sentence that ends well.", None), (4, "x" * 500_000, "s"), (5, "A row. Again", "s"), (5, "A row. Again", "s"), (None, "No id here.", "s")]
    df = spark.createDataFrame([(*r, True) for r in rows], "id long, text string, source string, is_cut boolean")
    got = scored(df, "id", "text", "source")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 3), (False, 4), (False, 5), (False, 5), (True, 0)]
    assert rates(got).agg(F.sum("n")).first()[0] == 5
    assert scored(df.limit(0), "id", "text", "source").count() == 0


def test_model_is_the_same_each_time(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    one, two = ({(r.doc_id, round(r.score, 9)) for r in scored(d, "doc_id", "text", "source").collect()} for d in (df, df.repartition(5)))
    assert one == two
    assert truncation.TRAIN_ROWS > 0


def test_vocabulary_is_that_of_all_records(spark):
    """Words of three records are known whether or not those are among the training records."""
    texts = [(i, f"A sentence about a thing that is called wort{i // 3}x here. Another sentence ends well with word number {i}.", "s") for i in range(600)]
    rows = truncation._prepared(spark.createDataFrame([*texts, (600, "Only one record names the einmalig word here.", "s")], "id long, text string, source string"), "id", "text", "source")
    known = truncation.train(rows, *truncation.prepared(rows), 20).known
    assert all(known[truncation.word_slot(f"wort{k}x")] for k in range(200)) and not known[truncation.word_slot("einmalig")]


def test_a_longer_window_changes_nothing_but_what_it_shows():
    """Features of an end don't hang on how much of the text before the last two lines is there, or on the order of a set."""
    line = "A last line without an end that is longer than eighty characters, because features of training and of scoring must agree on it and on"
    f = features(("x" * 2000 + ".\n\nOne line before.\n" + line)[-truncation.WINDOW :], 0)
    assert f == features("Some other text.\n\nOne line before.\n" + line, 0)
    sign = "The body ends.\n\nKind regards,\nSomeone Else"
    assert features(sign, 0) == features(("y" * 900 + ".\n" + sign)[-truncation.WINDOW :], 0)


def test_limits_come_by_broadcast(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    plan = scored(df, "doc_id", "text", "source")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(source" not in plan
