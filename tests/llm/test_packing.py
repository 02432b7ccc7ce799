import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import packing
from corpusloom.llm.packing import CAPACITY, _Bins, containers, encoder, pack, packed, search_effect


def test_bins_hold_all_and_no_more():
    rng = random.Random(5)
    for _ in range(300):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(0, 80))]
        bins = pack(sizes, 50)
        fill = {}
        for size, b in zip(sizes, bins, strict=True):
            fill[b] = fill.get(b, 0) + size
        assert all(x <= 50 for x in fill.values()) and sorted(fill) == list(range(len(fill)))


def test_local_search_grows_squared_fill_and_empties_bins():
    rng = random.Random(1)
    sizes = [rng.randint(400, 1100) for _ in range(3000)]
    b = _Bins(sizes, CAPACITY)
    b.best_fit()
    squares = lambda: sum((CAPACITY - r) ** 2 for r, i in zip(b.room, b.items, strict=True) if i)
    first, used = squares(), sum(bool(i) for i in b.items)
    assert b.search() > 0
    assert squares() > first and sum(bool(i) for i in b.items) < used
    assert sorted(i for x in b.items for i in x) == list(range(3000))
    assert all(sum(sizes[i] for i in x) == CAPACITY - r for x, r in zip(b.items, b.room, strict=True))


def test_layout(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    rows = containers(df, "doc_id", "text").collect()
    count = encoder().encode_ordinary
    want = {r.doc_id: len(count(r.text)) for r in df.collect() if r.text}
    got, fill = {}, {}
    for r in rows:
        got[r.item_id] = got.get(r.item_id, 0) + r.n_tokens
        fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
    assert got == want and max(fill.values()) <= CAPACITY
    assert all((r.n_pieces > 1) == (want[r.item_id] > CAPACITY) for r in rows)
    assert len(fill) <= -(-sum(want.values()) // CAPACITY) * 1.05 + 1


def test_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "x y " * 40_000), (5, "é😀" * 50), (None, "b")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "id long, text string, container_id int")
    got = containers(df, "id", "text", shard_rows=3).collect()
    assert sorted({r.item_id for r in got if r.item_id}) == [3, 4, 5]
    assert sum(r.item_id == 3 for r in got) == 2 and any(r.item_id is None for r in got)
    assert sum(r.n_tokens == CAPACITY for r in got if r.item_id == 4) == [r for r in got if r.item_id == 4][0].n_pieces - 1
    assert containers(df.limit(0), "id", "text").count() == 0
    with pytest.raises(FileNotFoundError):
        packing.encoder("/nowhere")


def test_layout_does_not_hang_on_arrival(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    one, two = ({tuple(r) for r in containers(d, "doc_id", "text", shard_rows=40).collect()} for d in (df, df.orderBy(F.rand(3)).repartition(7)))
    assert one == two and len(one) > 50


def test_small_items_meet_every_step():
    """Bins of many items: pairs beyond any fixed number of items of a bin are tried."""
    rng = random.Random(3)
    sizes = [rng.choice([3, 5, 7, 11, 13]) * 9 + rng.randint(0, 4) for _ in range(4000)]
    bins, before, after, _ = packed(sizes, CAPACITY)
    assert after <= before and after <= -(-sum(sizes) // CAPACITY) + 1
    assert sorted(set(bins)) == list(range(after))


def test_search_report(spark, folder):
    r = search_effect(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text").collect()
    assert len(r) == 1 and r[0].n_least <= r[0].n_containers <= r[0].n_best_fit
