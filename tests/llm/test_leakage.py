import random
import tracemalloc

import numpy as np

from corpusloom.llm.leakage import Index, leaks, scan
from corpusloom.llm.words import plain


def test_words():
    assert plain("Ça VA, n'est-ce pas? 12.5_x ÉTÉ") == "ca va n est ce pas 12 5 x ete"
    assert plain("ASCII only: A-b_c 1") == "ascii only a b c 1"


def brute(items, text, n=12):
    w = plain(text).split()
    grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return {k for k, t in items if (v := plain(t).split()) and any(tuple(v[i : i + n]) in grams for i in range(len(v) - n + 1))}


def test_against_brute_force():
    rng = random.Random(3)
    vocabulary = [f"wo{i}rd{'é' * (i % 3)}" for i in range(400)]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    items = [(i, sentence(rng.randint(8, 60))) for i in range(60)]
    texts = []
    for _ in range(400):
        w = sentence(rng.randint(0, 120)).split()
        for _, t in rng.sample(items, 2):
            v = t.split()
            a = rng.randint(0, max(0, len(v) - 5))
            part = v[a : a + rng.randint(5, 20)]
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() if rng.random() < 0.3 else x for x in part]
        texts.append(rng.choice([" ", ", ", "\n"]).join(w))
    index = Index(items)
    found = scan(texts, index)
    got = {(r, index.ids[i]) for (r, i), (n, _, _) in found.items() if n >= 12}
    assert got == {(r, k) for r, t in enumerate(texts) for k in brute(items, t)} and len(got) > 50


def test_long_texts_and_edges(spark):
    passage = " ".join(f"token{i}" for i in range(14))
    filler = "lorem ipsum dolor " * 150_000
    rows = [(1, None), (2, ""), (3, filler + passage + " " + filler), (4, passage.upper().replace(" ", "--")), (5, passage.rsplit(" ", 3)[0]), (6, passage), (6, passage), (7, filler[: (1 << 20) - 60].rsplit(" ", 1)[0] + " " + passage + " " + filler)]
    corpus = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, passage), (2, None), (3, "too short"), (4, passage + " more")], "item_id int, item_text string")
    got = sorted((r.item_id, r.doc_id, r.n_words) for r in leaks(corpus, "doc_id", "text", items, "item_id", "item_text").where("n_words > 0").collect())
    assert got == sorted([(i, d, 14) for i in (1, 4) for d in (3, 4, 6, 6, 7)])
    blocks = leaks(corpus, "doc_id", "text", items, "item_id", "item_text", block_chars=50)
    assert sorted((r.item_id, r.doc_id, r.n_words) for r in blocks.where("n_words > 0").collect()) == got
    assert leaks(corpus.limit(0), "doc_id", "text", items, "item_id", "item_text").count() == 0
    assert leaks(corpus, "doc_id", "text", items.limit(0), "item_id", "item_text").count() == 0


def test_passages_with_edits_are_reported_with_their_edits():
    words = [f"distinct{i}word" for i in range(20)]
    index = Index([(7, " ".join(words))])
    near = words[2:14]
    near[6] = near[6].replace("word", "wurd")
    texts = ["zzz " * 30 + " ".join(near) + " zzz" * 30, "zzz " * 30 + " ".join(words[:10]), " ".join(words)]
    found = scan(texts, index)
    assert set(found) == {(0, 0), (2, 0)}
    n, score, edits = found[0, 0]
    assert n == 0 and edits == 1 and score == len(" ".join(near)) + 2 - 1 - 8  # with the spaces around it
    assert found[2, 0] == (20, len(" ".join(words)), 0)


def test_hot_openings_stay_within_memory():
    """A text that repeats an opening of a thousand items: the same regions as with all hits at once, in bounded memory."""
    opening = "please read the following passage with care and answer the ques"
    rng = random.Random(1)
    items = [(i, opening + "tion " + " ".join(rng.choice("abcdefghijklmnop") * 6 + str(rng.randint(0, 999)) for _ in range(12))) for i in range(1_000)]
    index = Index(items)
    small = ((opening + "! ") * 40 + items[5][1] + " ").encode()
    few, all_ = ({tuple(r) for r in index.regions(small, np.array([0]), most).tolist()} for most in (5_000, 1 << 40))
    assert few == all_ and any(r[1] == 5 for r in few)
    hot = plain((opening + "! ") * 300 + items[5][1])
    tracemalloc.start()
    found = scan([hot], index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0, 5][0] >= 22 and peak < 300_000_000


def test_index_size():
    rng = random.Random(4)
    items = [(i, " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400))) for i in range(400)]
    index = Index(items)
    assert (index.nbytes - index.filter.nbytes) / len(index.data) < 40
