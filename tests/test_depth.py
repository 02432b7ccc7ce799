"""Trees deeper than any fixed number of levels."""

from corpusloom.operators import graph


def test_inherited_at_any_depth(spark):
    df = spark.createDataFrame([(i, i - 1 if i else None, "v") for i in range(106)], "id long, parent long, v string").coalesce(1)
    got = {r["id"]: r["level"] for r in graph.inherited(df, "id", "parent", "v").collect()}
    assert got == {i: i for i in range(106)}
