import itertools
import random

import numpy as np
import pytest

from corpusloom.llm import history
from corpusloom.llm.history import repeats
from corpusloom.llm.words import plain


def brute(rows):
    """Pairs of newcomers with the accepted records they repeat, in order of arrival."""
    accepted, pairs = [], set()
    for batch, doc, text in sorted(((-1 if b is None else b), d, t) for d, b, t in rows if t):
        w = plain(text).split()
        s = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
        if not s:
            continue
        hits = [d for d, a in accepted if 3 * len(s & a) >= 2 * len(s | a)]
        pairs |= {(doc, d) for d in hits}
        if not hits:
            accepted.append((doc, s))
    return pairs


def got(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, batch int, text string, other int")
    return {(r.doc_id, r.other) for r in repeats(df, "id", "text", "batch", **more).collect()}


def edited(rng, words, vocabulary, share):
    return [rng.choice(vocabulary) if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows, bases = [], []
    for i in range(1, 700):
        kind = rng.random()
        if bases and kind < 0.45:
            base = rng.choice(bases[-60:])
            words = edited(rng, base, vocabulary, rng.choice([0, 0.01, 0.04, 0.07, 0.1]))
            if rng.random() < 0.3:
                words = words[: max(3, int(len(words) * rng.uniform(0.6, 1)))]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 9, 14, 20, 28, 40, 60, 90, 200, 600]))]
        bases.append(words)
        rows.append((i, rng.randint(1, 6), rng.choice([" ", ", "]).join(words)))
    return rows


def test_against_brute_force(spark, rows):
    want, found = brute(rows), got(spark, rows)
    assert found <= want
    assert len(want - found) <= 0.003 * len(want)
    # a few links may be missed only where a text shares no long run of words; none of these is likely to
    assert len(want) > 150


def test_hot_group_of_near_copies(spark):
    """Hundreds of distinct near-copies and copies, more than a range holds: all are found, by rounds."""
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(2000)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = [(i, i % 3, " ".join(edited(rng, base, vocabulary, 0.03))) for i in range(1, 250)] + [(1000 + i, 5, " ".join(base)) for i in range(40)] + [(2000 + i, 4, " ".join(rng.choice(vocabulary) for _ in range(50))) for i in range(50)]
    assert got(spark, rows, limit=8) == brute(rows)


@pytest.mark.parametrize("limit", [2, 8])
def test_hot_beginnings_are_parted_and_salted(spark, monkeypatch, limit):
    """The same with bounds so low that beginnings and tails are hot: the result doesn't change."""
    for name, value in (("HOT_FACTOR", 2), ("SAMPLED", 1), ("SALTS", 3)):
        monkeypatch.setattr(history, name, value)
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(2000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = [(i, i % 4, " ".join(edited(rng, base, vocabulary, rng.choice([0.005, 0.03])))) for i in range(1, 120)] + [(500 + i, 2, " ".join(base[:40])) for i in range(3)]
    assert got(spark, rows, limit=limit) == brute(rows)


def test_boilerplate_shared_by_unlike_texts(spark):
    rng = random.Random(4)
    common = " ".join(f"c{i}" for i in range(80))
    rows = [(i, 1, common + " " + " ".join(f"u{i}x{k}" for k in range(60))) for i in range(1, 60)] + [(100, 2, common + " " + " ".join(f"u5x{k}" for k in range(60)) + " end"), (101, 2, common)]
    assert got(spark, rows, limit=4) == brute(rows) and rng


def test_odd_tables(spark):
    rows = [(1, 1, None), (2, 1, ""), (3, 1, "a b"), (4, 2, "a b"), (5, 1, "a b c"), (6, 1, "A, B; c!"), (7, None, "a b c"), (8, 3, "word " * 100_000), (9, 3, "word " * 99_000), (10, 4, "é è ê ü"), (11, 4, "e e e u")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:2]) == set()


def test_anchors_are_shared_by_what_texts_share():
    codes = history._codes([f"w{i}" for i in range(1000)])
    a, n = history.anchors(np.concatenate([codes, codes[100:]]), np.array([1000, 1900]))
    assert n.sum() == len(a) and n[0] > 8
    first, second = set(map(tuple, a[: n[0]].tolist())), set(map(tuple, a[n[0] :].tolist()))
    assert len(first & second) > 0.7 * len(second)


def test_loads_against_a_kept_history(spark, rows, tmp_path):
    """Batches taken in one by one, the history kept as sorted segments between them, give the pairs of a single load."""
    kept, pairs, sizes = history.History(spark, f"file://{tmp_path}/history"), set(), []
    # copies and near-copies of records of earlier loads
    rng = random.Random(5)
    more = [(3000 + i, b, t if i % 2 else " ".join(edited(rng, t.split(), ["new", "words"], 0.03))) for i, (_, _, t) in enumerate(rows[:60]) for b in [rng.randint(1, 6)]]
    rows = rows + more
    for b in range(1, 7):
        new = kept.add(spark.createDataFrame([r for r in rows if r[1] == b], "id long, batch int, text string"), "id", "text", "batch")
        pairs |= {(r.doc_id, r.other) for r in new.collect()}
        sizes.append(kept.live())
    assert pairs == brute(rows)
    assert all(len(s) <= 3 for s in sizes) and all(x > 2 * y for s in sizes for x, y in zip(s, s[1:]))
    assert kept.vacuum() > 0 and kept.add(spark.createDataFrame([(9000, 7, rows[5][2])], "id long, batch int, text string"), "id", "text", "batch").count() > 0


def test_a_load_reads_and_shuffles_what_it_needs(spark, tmp_path):
    """The same load against a history and one four times as large reads about as much of it."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(20_000)]
    text = lambda: " ".join(rng.choice(vocabulary) for _ in range(120))
    old = [(i, 1, text()) for i in range(12_000)]
    load = [(100_000 + i, 2, old[i * 30][2] if i < 1 else text()) for i in range(2)]
    took = []
    for n in (3_000, 12_000):
        kept = history.History(spark, f"file://{tmp_path}/history-{n}")
        kept.add(spark.createDataFrame(old[:n], "id long, batch int, text string"), "id", "text", "batch")
        state, (fs, at) = kept.state(), history.filesystem(kept.path)
        codes = np.unique(np.concatenate([history._codes_of(r.anchors) for r in history.indexed(spark.createDataFrame(load, "id long, batch int, text string"), "id", "text", "batch", kept._order(None, None)).collect()]))
        size = read = 0
        for part, name in state["segments"][0]["suffixes"].items():
            reader = history.Reader(fs, f"{at}/{name}", history._SUFFIX)
            list(reader.found(np.sort(codes[codes % np.uint64(state["parts"]) == int(part)].view(np.int64))))
            size, read = size + reader.n * history._SUFFIX.itemsize, read + reader.read
        took.append((size, read))
        pairs = {(r.doc_id, r.other) for r in kept.add(spark.createDataFrame(load, "id long, batch int, text string"), "id", "text", "batch").collect()}
        assert pairs == {(100_000, 0)}
    assert took[1][0] > 3.9 * took[0][0] and took[1][1] < 2 * took[0][1]


def test_coverage_bound_holds():
    """Similar texts share at least as many anchors as the bound says."""
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randint(3, 80)
        a = [f"w{rng.randint(0, 400)}" for _ in range(n)]
        b = edited(rng, a, [f"x{i}" for i in range(50)], rng.choice([0.0, 0.02, 0.05]))
        b = b[: rng.randint(max(3, n - 6), n)]
        codes, ends = history._codes(a + b), np.array([len(a), len(a) + len(b)])
        own, k = history.anchors(codes, ends)
        _, _, size = history.ordered(codes, ends)
        if history.similar(history.shingles(" ".join(a)), history.shingles(" ".join(b))):
            both = len(set(own[: k[0], 0].tolist()) & set(own[k[0] :, 0].tolist()))
            x, y = int(size[0]), int(size[1])
            c = -(-2 * (x + y) // 5)
            assert both >= min(p - -(-2 * p // 3) + 1 - (p - c) for p in (x, y))


def evenly_cut(n, gaps):
    """Pairs of texts of n distinct words, the second one without single words spread as evenly as similarity at two thirds allows."""
    rows = []
    for k, gap in enumerate(gaps):
        words = [f"e{k}x{i}" for i in range(n)]
        rows += [(10 * k + 1, 1, " ".join(words)), (10 * k + 2, 2, " ".join(w for i, w in enumerate(words) if i % gap != gap // 2))]
    return rows


def test_evenly_edited_pairs_at_the_threshold(spark):
    """Whatever the length: no similar pair shares too few anchors."""
    rows = [(1000 * k + i, b, t) for k, n in enumerate((3, 12, 21, 31, 41, 60, 75, 90, 120, 200, 400, 900, 2500)) for i, b, t in evenly_cut(n, (10, 11, 12, 13, 14, 15, 16))]
    words = [f"d{i}" for i in range(31)]
    rows += [(90_001, 1, " ".join(words)), (90_002, 2, " ".join(w for i, w in enumerate(words) if i not in (10, 20)))]
    words = [f"f{i}" for i in range(41)]
    rows += [(90_011, 1, " ".join(words)), (90_012, 2, " ".join(w for i, w in enumerate(words) if i not in (10, 20, 30)))]
    want = brute(rows)
    assert got(spark, rows) == want and {(90_002, 90_001), (90_012, 90_011)} <= want and len(want) > 35


def test_few_hidden_matches_are_searched_again(spark):
    """A newcomer that shares only anchors that very many have, at few of its anchors, isn't taken for new."""
    blocks = [" ".join(f"k0b{b}x{i}" for i in range(14)) for b in range(9)]
    groups = list(itertools.combinations(range(9), 3))
    rows = [(i, 1, " ".join(blocks[b] for b in g)) for i, g in enumerate(groups, 1)]
    # every block stands in as many texts
    rows += [(800 + k, 2, " ".join(blocks[b] for b in range(k, k + 3)) + " " + " ".join(f"o{k}x{i}" for i in range(60))) for k in (0, 3)]
    rows += [(900, 2, " ".join(blocks[b] for b in groups[-1][::-1]) + " " + " ".join(f"n{k}" for k in range(9)))]
    codes = [history._codes(t.split()) for _, _, t in rows]
    counts = np.bincount(history._slot(history.ordered(np.concatenate(codes), np.cumsum([len(c) for c in codes]))[1]), minlength=1 << history.SLOT_BITS)
    df = spark.createDataFrame(rows, "id long, batch int, text string")
    found = history.take_load(df, "id", "text", "batch", limit=1, counts=np.where(counts > 1, counts, 0))[0]
    assert {(r.doc_id, r.other) for r in found.collect()} == brute(rows) == {(900, len(groups))}


def test_copies_of_a_rejected_record_find_what_was_hidden(spark):
    """Of a rejected record with a later exact copy, the pairs of unsure records are still looked for: the copy's pairs come from them."""
    base = [f"w{i}" for i in range(60)]
    change = lambda words, **at: " ".join(at.get(w, w) for w in words)
    common = {"w8": "p", "w28": "q"}
    rows = [(1, 1, " ".join(base))] + [(1 + k, 2, change(base, **common, **{f"w{k + 10 if k < 17 else k + 13}": f"s{k}"})) for k in range(1, 25)]
    rows += [(50, 3, change(base, **common, w2="t", w56="u")), (60, 4, rows[-1][2])]
    want = brute(rows)
    assert got(spark, rows, limit=1) == want and {(60, 50), (60, 1)} <= want


def slots(texts):
    """How many distinct shingles of each text fall into each slot."""
    found = [history._slot(history.shingles(t)) for t in texts]
    return np.bincount(np.concatenate(found), minlength=1 << history.SLOT_BITS)


def test_all_records_are_counted(spark):
    """The order of shingles comes from every record of a table of any size, rare shingles too; repeated ones of a record count once."""
    texts = [f"a{i} b{i % 7} c{i % 3} " + ("x y z x y z" if i % 5 else "") for i in range(40_000)] + ["one two", "", "w " * 9]
    df = spark.createDataFrame([(i, 1, t) for i, t in enumerate([*texts, None])], "id long, batch int, text string")
    counts = history.shingle_counts(df.repartition(5), "text")
    assert np.array_equal(counts, slots(texts))
    assert counts.sum() > 2 * len(texts) and (counts == 1).sum() > 1000
    assert not history.shingle_counts(df.limit(0), "text").any()


def test_hot_slots_are_those_of_the_whole_load(spark, tmp_path, monkeypatch):
    """What is hot is counted on the anchors of the load at hand, not on the load that gave the order."""
    seen, search = [], history.candidates
    monkeypatch.setattr(history, "candidates", lambda index, counts, *a, **more: seen.append(counts) or search(index, counts, *a, **more))
    kept = history.History(spark, f"file://{tmp_path}/history")
    kept.add(spark.createDataFrame([(1, 1, "one two three")], "id long, batch int, text string"), "id", "text", "batch")
    # of four shingles, three of which are in all texts, two are anchors
    rows = [(10 + i, 2, f"h1 h2 h3 h4 h5 u{i}") for i in range(300)]
    assert not kept.add(spark.createDataFrame(rows, "id long, batch int, text string"), "id", "text", "batch").count()
    codes = [history._codes(t.split()) for _, _, t in rows]
    own, _ = history.anchors(np.concatenate(codes), np.cumsum([len(c) for c in codes]), kept._order(None, None))
    assert seen[0].sum() == 1 and seen[1].sum() == 600 and seen[1].max() >= 300
    assert np.array_equal(seen[1], np.bincount(history._slot(own[:, 0]), minlength=1 << history.SLOT_BITS))
