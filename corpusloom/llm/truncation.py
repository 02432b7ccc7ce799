"""Texts whose end was lost, by a classifier trained on artificially cut texts.

Texts, up to their last full stop, are cut at chosen places, at their source's usual
limit or anywhere else, now and then with a mark of elision or of broken markup
behind; these are the positives.  The other class is the records as they are:
few of them are cut, so what only finished texts end in (lists, signatures,
links, rows, commands, tags) is common there and rare among the cut ones.  A
logistic regression on hashed features separates the two.  Its features are the
closing characters and punctuation, the last words with numbers and names
masked, the beginning of the last sentence with its end, the form of the last
line and of the one before, whether the last word is a known one, and how near
the length is to a limit of the source.

Limits are found in all records: a length (in characters or bytes) around which
a source has many more texts than its other lengths would give.  Known words are
those of at least `LEAST_RECORDS` of all records, counted by slots of their hash;
the last word of a text, which may be cut, doesn't count.

The model is fitted on the driver on a bounded sample: about `TRAIN_ROWS`
records (a parameter), chosen by a hash of the key; executors send only
feature numbers, and one count a slot of the vocabulary.  Every record is scored.  Of a text only the last `WINDOW`
characters leave the JVM, because no feature looks further back; its length is
that of the whole text.  Training and scoring see the same window.

Defined results: null and blank texts aren't cut; texts are scored alike
whatever their language; repeated rows are scored each; a source of few
records, or none, has no limit; with no training text (an empty table) nothing
is found; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import cut_lineage

TRAIN_ROWS = 12_000
CUTS = 2
WINDOW = 1_000
BITS = 18
#: Lengths up to so many characters below a limit, and up to three above, are near it.
NEAR = 12
#: Limits of so many sources are broadcast at most; of more they are joined by a shuffle.
BROADCAST_SOURCES = 100_000
EPOCHS, RATE, L2 = 8, 0.15, 1e-6
VOCABULARY_BITS, LEAST_RECORDS = 20, 3

_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile(r"(?:[\s<\[({*_~`|\\�]|\.{3,}|…|\[\.{3}\]|\[…\]|--+$|&\w*$)+$")
_FINISHED = re.compile(r"[.!?。！？][\"'”’»)\]]*$")
_SENTENCE = re.compile(r"(?<=[.!?。！？])[\"'”’»)\]]*\s+|\n+")
_SENTENCE_END = re.compile(r"[.!?](?=\s|$)")
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_LEAD = re.compile(r"^\s*(?:[-*•→]\s+|\[\d+:\d+\]\s*|[\w.]{3,24}:\s+|#+\s+)")
_FORMS = (
    ("url", re.compile(r"^\S*https?://\S+$")),
    ("command", re.compile(r"^\s*(?:\$|run|>)\s.*--?\w+")),
    ("tags", re.compile(r"^(?:#\w+\s*)+$")),
    ("row", re.compile(r"^.*\S\s\|\s\S.*$")),
    ("dash_name", re.compile(r"^[—–-]{1,2}\s*\w+$")),
    ("bullet", re.compile(r"^\s*[-*•→]\s")),
    ("speaker", re.compile(r"^\w{3,24}:\s")),
    ("time", re.compile(r"^\[\d+:\d+\]")),
)
#: Lines of these forms say by their form whether they are whole; their words count for nothing.
STRUCTURED = ("url", "command", "tags", "row", "dash_name", "sign")
_SIGN = re.compile(r"\n\s*\n\w+(?: \w+){0,2},?\n[^\W\d_a-z]\w+(?: [^\W\d_a-z]\w+){0,2}$")


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) & ((1 << BITS) - 1)


_KNOWN = _hash("known")


def word_slot(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - VOCABULARY_BITS)


class _Slots(dict):
    """Slots of words; those of a worker's recent words are kept."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        slot = self[word] = word_slot(word.casefold())
        return slot


_slots = _Slots()


def _masked(token: str, first: bool) -> str:
    if token[0].isdigit():
        return "9"
    if token[0].isupper() and not first:
        return "Xx"
    return token.casefold()


def _form(line: str, core: str = "") -> str:
    if core and _SIGN.search(core):
        return "sign"
    for name, pattern in _FORMS:
        if pattern.search(line):
            return name
    return "plain"


def _bucket(n: int) -> int:
    return n if n < 4 else 4 + min(6, (n - 4) // 4)


def features(tail: str, near: int) -> tuple[list[int], int, list[int]]:
    """Feature numbers of a text's end, the slot of its last word (-1 where its words count for nothing), and what is added if that is unknown.

    near: 0 far from any limit of the source, 1 near one of its character limits, 2 on it, 3 near one of its byte limits.
    """
    bare = tail.rstrip()
    core = _MARKS.sub("", bare)
    marks = bare[len(core) :].strip()
    ended = bool(_FINISHED.search(core))
    dots = "dots" if "..." in marks or "…" in marks else "none" if not marks else "other"
    lines = [x for x in core.split("\n") if x.strip()]
    last = lines[-1] if lines else ""
    before = lines[-2] if len(lines) > 1 else ""
    blank = "\n\n" in core[-len(last) - 3 :] if last else False
    rest = _LEAD.sub("", last)
    sentence = [s for s in _SENTENCE.split(rest) if s][-1:] or [""]
    tokens = _TOKEN.findall(sentence[0])
    if core.endswith((".", "!", "?")) and tokens and len(tokens) < 2:
        tokens = _TOKEN.findall(rest)
    words = [_masked(t, i == 0) for i, t in enumerate(tokens)]
    closing = [w for w in words if w[0].isalnum()]
    raw_last = next((t for t in reversed(tokens) if t[0].isalnum()), "")
    form, n = _form(last, core), _bucket(len(closing))
    kind = "end" if ended else core[-1:] if core and not core[-1].isalnum() else "alnum"
    one, two, three = (" ".join(closing[-k:]) for k in (1, 2, 3))
    head, head2 = " ".join(closing[:1]), " ".join(closing[:2])
    commas = min(3, sum(t in ",;" for t in tokens))
    f = [
        "bias", f"kind {kind}", f"marks {dots} {ended}", f"marks {marks[:4]} {kind}", f"near {near} {ended}", f"near {near} {dots}",
        f"form {form} {ended}", f"form {form} {n} {ended}", f"forms {form} {_form(before)} {ended}", f"blank {blank} {form} {n} {ended}", f"blank {blank} {ended}",
        f"before {_bucket(len(before.split()))} {_form(before)} {before[-1:] if before and not before[-1].isalnum() else 'a'} {form} {n} {ended}",
        f"capitals {all(t[:1].isupper() for t in tokens if t[0].isalnum())} {n} {ended} {before[-1:] == ','} {len(before.split()) < 4}", f"n {n} {ended}", f"space {tail[-1:].isspace()} {ended}", f"upper {raw_last[:1].isupper()} {raw_last.isdigit()} {n} {ended}",
    ]
    if not ended and form not in STRUCTURED:
        f += [
            f"1 {one}", f"2 {two}", f"3 {three}", f"1d {one} {dots}", f"2d {two} {dots}", f"h1 {head} {one}", f"h2 {head2} {one}", f"h22 {head2} {two}", f"hn {head2} {n}",
            f"hc {head2} {commas}", f"h1c {head} {commas} {one}", f"h2c {head2} {commas} {two}", f"end3 {raw_last[-3:].casefold()}", f"len {len(raw_last)}", f"h {head2}", f"1n {one} {n}", f"last2 {words[-1] if words else ''} {kind}",
        ]
        f += [f"has {w} {one}" for w in sorted(set(closing[:-1])) if len(w) < 6]
    slot = word_slot(raw_last.casefold()) if raw_last and form not in STRUCTURED else -1
    word = f"unknown {raw_last[:1].isupper()} {raw_last[:1].isdigit()}"
    return [_hash(x) for x in f], slot, [_hash(x) for x in (word, f"{word} {ended}", f"{word} {form}")]


def told(slot: int, unknown: list[int], known: np.ndarray) -> list[int]:
    """What the vocabulary says about the last word of a text."""
    return [_KNOWN] if slot < 0 or known[slot] else unknown


def artificial(text: str, seed: int, limits: list[int], times: int = CUTS) -> list[tuple[str, int]]:
    """(cut text, near) positives out of a text up to the end of its last finished sentence."""
    rng = np.random.default_rng(seed & 0x7FFFFFFF)
    out = []
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < 60:
        return out
    text = text[: ends[-1]]
    possible = [x for x in limits if 40 < x < len(text) - 1]
    for _ in range(times):
        at_limit = bool(possible) and rng.random() < 0.5
        at = int(rng.choice(possible)) if at_limit else int(rng.integers(max(30, len(text) // 6), len(text) - 1))
        style, tail = rng.random(), ""
        cut = text[:at]
        if style < 0.35 and text[at : at + 1].isalnum() and " " in cut:
            cut = cut[: cut.rindex(" ")]
        if at_limit and rng.random() < 0.5:
            # a shortener's elision stands at a limit, after a word
            cut, tail = cut.rsplit(" ", 1)[0], str(rng.choice(["...", "…", " ..."]))
        elif not at_limit and rng.random() < 0.2:
            tail = str(rng.choice([" [", "<", " **", "\n", "�", " "]))
        core = cut.rstrip()
        if not core or _FINISHED.search(core) or text[len(core) : len(core) + 1] in ".!?":
            continue
        near = 0
        if at_limit:
            near = 2 if len(cut + tail) == at else 1
        out.append((cut + tail, near))
    return out


def trailing_dots(text: str, seed: int) -> list[str]:
    """A negative out of a finished text: it ends after one of its sentences, with dots for the full stop."""
    ends = [m.start() for m in _SENTENCE_END.finditer(text)]
    return [text[: ends[seed % len(ends)]] + "..."] if ends else []


@dataclass
class Model:
    weights: np.ndarray
    known: np.ndarray

    def score(self, tail: str, near: int) -> float:
        f, slot, unknown = features(tail, near)
        return float(self.weights[f + told(slot, unknown, self.known)].sum())


def fit(examples: list[tuple[list[int], int]], seed: int = 7) -> np.ndarray:
    """Weights of a logistic regression on (feature numbers, label), by Adagrad over shuffled blocks."""
    weights, square = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    if not examples:
        weights[_hash("bias")] = -1.0
        return weights
    lengths = np.array([len(f) for f, _ in examples])
    flat = np.concatenate([np.asarray(f, np.int64) for f, _ in examples])
    starts = np.cumsum(lengths) - lengths
    label = np.array([y for _, y in examples], float)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for block in np.array_split(order, max(1, len(order) // 256)):
            row = np.repeat(np.arange(len(block)), lengths[block])
            at = flat[np.repeat(starts[block] - np.cumsum(lengths[block]) + lengths[block], lengths[block]) + np.arange(lengths[block].sum())]
            z = np.bincount(row, weights[at], len(block))
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[block]
            slots, inverse = np.unique(at, return_inverse=True)
            step = np.bincount(inverse, error[row], len(slots)) / len(block) + L2 * weights[slots]
            square[slots] += step * step
            weights[slots] -= RATE * step / np.sqrt(square[slots])
    return weights


#: Kinds of training rows: a record as it is, an artificial cut, an artificial ending with trailing dots.
REAL, CUT, DOTS = 0, 1, 2


def fit_cleaned(rows: list[tuple[list[int], int]], rounds: int = 3) -> tuple[np.ndarray, int]:
    """Weights fitted without the records that are likely cut themselves, and how many those are.

    rows: (feature numbers, kind). Each half of the records is judged by a model of the other half.
    """
    out: set[int] = set()
    for _ in range(rounds):
        found = set()
        for half in (0, 1):
            weights = fit([(f, int(kind == CUT)) for i, (f, kind) in enumerate(rows) if i % 4 // 2 != half and i not in out])
            found |= {i for i, (f, kind) in enumerate(rows) if kind == REAL and i % 4 // 2 == half and weights[f].sum() > 0}
        if found == out:
            break
        out = found
    return fit([(f, int(kind == CUT)) for i, (f, kind) in enumerate(rows) if i not in out]), len(out)


def length_counts(texts: DataFrame) -> DataFrame:
    """(source, kind, n, c): how many texts of a source have which length, in characters and in bytes. texts: source, n_chars, n_bytes."""
    lengths = texts.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("kind"), F.col("n_chars").alias("n")), F.struct(F.lit("bytes").alias("kind"), F.col("n_bytes").alias("n")))).alias("e"))
    return lengths.groupBy("source", "e.kind", "e.n").agg(F.count("*").alias("c"))


def limits(counts: DataFrame, least: int = 5) -> DataFrame:
    """(source, kind, at): lengths, in characters or bytes, near which a source has many more texts than around.

    counts: see length_counts. The windows run over those.
    """
    by = Window.partitionBy("source", "kind").orderBy("n")
    here, around = F.sum("c").over(by.rangeBetween(-NEAR, 0)), F.sum("c").over(by.rangeBetween(-200, 200))
    seen = counts.select("source", "kind", "n", "c", here.alias("here"), around.alias("around"))
    usual = (F.col("around") - F.col("here")) * (NEAR + 1) / (400 - NEAR)
    high = seen.where((F.col("here") >= least) & (F.col("here") > 5 * usual + 3))
    # of lengths close together the one with the most texts on it and just before it, then the largest
    best = Window.partitionBy("source", "kind").orderBy("n").rangeBetween(-40, 40)
    peak = F.struct((F.col("here") + F.col("c")).alias("weight"), F.col("n"))
    return high.select("source", "kind", "n", peak.alias("p"), F.max(peak).over(best).alias("top")).where("p = top").select("source", "kind", F.col("n").alias("at"))


def _near(n_chars: int, n_bytes: int, chars: list[int], bytes_: list[int]) -> int:
    if n_chars in chars:
        return 2
    if any(x - NEAR <= n_chars <= x + 3 for x in chars):
        return 1
    return 3 if any(x - NEAR <= n_bytes <= x + 3 for x in bytes_) else 0


def _prepared(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(k, t, source, n_chars, n_bytes) of the records with a text."""
    t = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias("k"), t.alias("t"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"))
    return rows.where(F.col("t").rlike(r"\S")).select("k", "t", "source", F.length("t").alias("n_chars"), F.octet_length("t").alias("n_bytes"))


def vocabulary(rows: DataFrame) -> np.ndarray:
    """Which slots of words stand in at least `LEAST_RECORDS` of all records (column t)."""

    def run(batches):
        counts = np.zeros(1 << VOCABULARY_BITS, np.int64)
        for rb in batches:
            own = [{_slots[w] for w in set(_WORD.findall(t)[:-1])} for t in rb.column(0).to_pylist()]
            counts += np.bincount(np.fromiter((x for o in own for x in o), np.int64), minlength=1 << VOCABULARY_BITS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])

    # at most as many rows as there are slots
    found = rows.select("t").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_RECORDS).select("slot").toArrow()
    known = np.zeros(1 << VOCABULARY_BITS, bool)
    known[found.column("slot").to_numpy()] = True
    return known


def train(rows: DataFrame, listed: DataFrame, n_rows: int, train_rows: int = TRAIN_ROWS) -> Model:
    """The model, fitted on about `train_rows` of the n_rows records, chosen by a hash of the key; the vocabulary is that of all records."""
    every = max(1, round(n_rows / train_rows))
    sample = rows.where(F.pmod(F.xxhash64("k"), F.lit(every)) == 0).join(listed, "source", "left")

    def run(batches):
        for rb in batches:
            out: list[list] = [[], [], [], [], [], []]
            for t, n, m, chars, bytes_ in zip(*(rb.column(c).to_pylist() for c in ("t", "n_chars", "n_bytes", "chars", "bytes")), strict=True):
                seed = xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace"))
                own = [(t, _near(n, m, chars or (), bytes_ or ()), REAL), *((c, near, CUT) for c, near in artificial(t, seed, list(chars or ()))), *((c, 0, DOTS) for c in trailing_dots(t, seed))]
                for no, (c, near, kind) in enumerate(own):
                    for column, x in zip(out, (seed - (1 << 63), no, kind, *features(c[-WINDOW:], near)), strict=True):
                        column.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["seed", "no", "kind", "f", "slot", "unknown"])

    # about train_rows records, a handful of rows each: bounded by the parameter
    found = sample.mapInArrow(run, "seed long, no int, kind int, f array<int>, slot int, unknown array<int>").toArrow()
    order = sorted(zip(*(found.column(c).to_pylist() for c in ("seed", "no")), range(found.num_rows), strict=True))
    kinds, f, slots, unknown = (found.column(c).to_pylist() for c in ("kind", "f", "slot", "unknown"))
    known = vocabulary(rows)
    examples = [(f[i] + told(slots[i], unknown[i], known), kinds[i]) for _, _, i in order]
    return Model(fit_cleaned(examples)[0], known)


def _listed(limit_of: DataFrame) -> DataFrame:
    """One row a source with its character and byte limits; a source has few, because each needs many of its texts."""
    pick = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("at").cast("int")))
    return limit_of.groupBy("source").agg(pick("chars").alias("chars"), pick("bytes").alias("bytes"))


def prepared(rows: DataFrame) -> tuple[DataFrame, int]:
    """One row a source with its limits, to be broadcast where they are counted to be few, and the number of all rows."""
    counts = cut_lineage(length_counts(rows))
    listed = cut_lineage(_listed(limits(counts)))
    n_rows = counts.where("kind = 'chars'").agg(F.sum("c")).first()[0] or 0
    return (F.broadcast(listed) if listed.count() <= BROADCAST_SOURCES else listed), n_rows


def scored(docs: DataFrame, key: str, text: str, source: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, source, score, is_cut) of every record with a text."""
    rows = _prepared(docs, key, text, source)
    listed, n_rows = prepared(rows)
    shared = docs.sparkSession.sparkContext.broadcast(train(rows, listed, n_rows, train_rows))
    kind = docs.schema[key].dataType.simpleString()
    tails = rows.withColumn("t", F.right("t", F.lit(WINDOW))).join(listed, "source", "left")

    def run(batches):
        model = shared.value
        for rb in batches:
            columns = (rb.column(c).to_pylist() for c in ("t", "n_chars", "n_bytes", "chars", "bytes"))
            scores = [model.score(t, _near(n, m, chars or (), bytes_ or ())) for t, n, m, chars, bytes_ in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([rb.column("k"), rb.column("source"), pa.array(scores, pa.float64()), pa.array([x > 0 for x in scores], pa.bool_())], names=["doc_id", "source", "score", "is_cut"])

    return tails.mapInArrow(run, f"doc_id {kind}, source string, score double, is_cut boolean")


def rates(scored_: DataFrame) -> DataFrame:
    """(source, n, n_cut, share) of each source."""
    return scored_.groupBy("source").agg(F.count("*").alias("n"), F.count_if("is_cut").alias("n_cut"), F.round(F.count_if("is_cut") / F.count("*"), 6).alias("share"))
