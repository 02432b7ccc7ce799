import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.splitting import cuts, split_oversized


def restored(text, pieces, overlap):
    return text[pieces[0][0] : pieces[0][1]] + "".join(text[a:b][overlap:] for a, b, _ in pieces[1:])


@settings(max_examples=600, deadline=None)
@given(st.text("ab .,\ńé", max_size=300), st.integers(1, 60), st.integers(0, 59))
def test_round_trip_within_the_limit(text, limit, overlap):
    overlap %= limit
    pieces = cuts(text, limit, overlap)
    assert all(b - a <= limit for a, b, _ in pieces)
    assert restored(text, pieces, overlap) == text


def test_strongest_boundary_near_the_target():
    half = "word " * 100
    text = half + "End of it.\n\n" + half
    assert cuts(text, 800, 50) == [(0, 512, "blank_line"), (462, len(text), "end")]
    assert [x[2] for x in cuts("x" * 1000, 400, 0)] == ["none", "none", "end"]
    lengths = [b - a for a, b, _ in cuts("one two three. " * 400, 1000, 100)]
    assert max(lengths) - min(lengths) < 300  # balanced
    e = "e\u0301" * 400
    assert all(e[b : b + 1] != "\u0301" for _, b, _ in cuts(e, 101, 0))


def test_tables(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "abcde", 5), (4, "abcdefgh ij", 5), (4, "abcdefgh ij", 5), (5, "w " * 300_000, 8192)]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "id long, text string, m int, piece_text string, item_id int")
    from pyspark.sql import functions as F

    got = split_oversized(df, "id", "text", F.col("m"), 2)
    n = {r.item_id: r["count"] for r in got.groupBy("item_id").count().collect()}
    assert set(n) == {4, 5} and n[4] % 2 == 0
    assert got.where("length(piece_text) > 8192 or piece_text <> substring(piece_text, 1, end - start)").count() == 0
    assert split_oversized(df.limit(0), "id", "text", 5, 2).count() == 0
    with pytest.raises(ValueError):
        cuts("abc", 2, 2)


def test_linear_time_and_few_pieces():
    """Pieces at most a twentieth over the least number, in time that grows with the length."""
    rng = random.Random(2)
    words = ["w" * rng.randint(1, 12) + rng.choice(["", "", "", ",", ".", ".\n", ".\n\n"]) for _ in range(200_000)]
    text, took = " ".join(words), []
    for times in (1, 4, 16):
        whole = text[: 1 << 20] * times
        began = time.perf_counter()
        pieces = cuts(whole, 8_192, 200)
        took.append(time.perf_counter() - began)
        least = -(-(len(whole) - 200) // (8_192 - 200))
        assert len(pieces) <= least * 1.05 + 1 and restored(whole, pieces, 200) == whole
        assert sum(x[2] in ("blank_line", "line") for x in pieces) > 0.8 * len(pieces)
    assert took[2] < 16 * 3 * max(took[0], 0.02)
    # no slack at all: the least number of pieces and one more at most
    exact = (text * 3)[: 501 * (8_192 - 200) + 200]
    assert 501 <= len(cuts(exact, 8_192, 200)) <= 526


def test_failing_stretch_is_mended_in_place():
    """A stretch without boundaries gets plain cuts, the others keep theirs."""
    para = ("word " * 15 + "end.\n\n") * 200
    text = para + "x" * 30_000 + para
    names = [x[2] for x in cuts(text, 2_000, 100)]
    assert names[0] == "blank_line" and names[-2] == "blank_line" and "none" in names
