"""What the plans look like: pruning, pushdown, join and limit forms."""

from corpusloom.plans import registry

Q = registry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, folder):
    text = plan(Q["database_scan"](spark, folder))
    assert "PushedFilters: [IsNotNull(c_acctbal)" in text and "c_nationkey" not in text


def test_top_k_is_one_operator(spark, folder):
    assert "TakeOrderedAndProject" in plan(Q["top_orders"](spark, folder))


def test_limit_per_group_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in plan(Q["most_cited"](spark, folder))


def test_semi_and_anti_joins(spark, folder):
    assert "LeftSemi" in plan(Q["referenced_customers"](spark, folder))
    assert "LeftAnti" in plan(Q["unfinished_documents"](spark, folder))


def test_small_tables_are_broadcast_by_size(spark, folder):
    assert "BroadcastHashJoin" in plan(Q["decorated_documents"](spark, folder))


def test_splitting_doesnt_shuffle(spark, folder):
    for name in ("split_core_parts", "parts_per_document", "fixed_size_chunks", "p5_found"):
        assert "Exchange" not in plan(Q[name](spark, folder)), name
