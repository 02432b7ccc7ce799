"""Evaluation passages inside corpus texts, by q-gram lemma filtering.

Items and texts are brought to folded words with single spaces.  The character
q-grams of the items make a sorted index.  A text's q-grams are looked up in
it, each hit lies on a diagonal (its place in the text less its place in the
item), and hits are counted in overlapping bands of diagonals.  A passage of
`words` words with at most `edits` edits shares at least
`length + 1 - q * (edits + 1)` q-grams with the text, all in one band, so bands
with fewer hits are dropped without loss.  Kept regions are verified by a
banded local alignment over all of a chunk's regions at once, and the longest
run of consecutive shared words is read off each verified region.

A q-gram that many items share isn't expanded for all of a text at once: hits are
counted in parts of bounded size, and bands that the text has passed leave the
counts, so a hot q-gram costs time but no memory.

The items are a stated query set: they are read in blocks of a bounded number
of characters (`BLOCK_CHARS`, counted while they are read), each block's index
goes to the executors once, and the corpus is scanned once per block.  Nothing is
shuffled, every text is read whole, and a text of any length is handled in
chunks of `CHUNK` bytes.

Defined results: null and empty texts and items give nothing; items shorter
than `words` words can't leak; repeated rows are reported each; an item that
stands in a text more than once is reported once with its longest run; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.words import plain

Q, WORDS, EDITS = 16, 12, 2
PENALTY = 8
CHUNK = 1 << 20
#: Characters of items whose index is held at a time: about 160 MB.
BLOCK_CHARS = 8_000_000
#: Hits expanded, and cells aligned, at a time in a task.
MOST_HITS, MOST_CELLS = 1_000_000, 4_000_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BITS = 22
#: Added to diagonals, so that none is negative.
_MIDDLE = 1 << 23


def grams(data: bytes) -> np.ndarray:
    """A 64-bit code of the Q bytes at each place (Q is 16: two words of 8 bytes, mixed)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    first = eight[:n] * _A
    return (first ^ (first >> np.uint64(29))) + eight[8 : 8 + n] * _B


def run_codes(tokens: list[str], words: int) -> np.ndarray:
    """A 64-bit code of the words from each place on."""
    return np.array([xxhash.xxh3_64_intdigest(" ".join(tokens[i : i + words])) for i in range(len(tokens) - words + 1)], np.uint64)


class Index:
    """The items' q-grams with their places, and what is needed to verify a region.

    About 20 bytes a character: the sorted distinct q-grams with the number of their first entry, one entry a place (its place in the
    items' texts one after the other), these texts, and the codes of the items' runs of `words` words.
    """

    def __init__(self, items: list[tuple], words: int = WORDS, edits: int = EDITS):
        self.words, self.edits, self.ids = words, edits, []
        data: list[bytes] = []
        runs: list[np.ndarray] = []
        need: list[tuple[int, int]] = []
        for item, text in items:
            tokens = plain(text or "").split(" ")
            if len(tokens) < words:
                continue
            own = " ".join(tokens).encode("utf-8", "replace")
            places = np.cumsum([0] + [len(t.encode("utf-8", "replace")) + 1 for t in tokens])
            shortest = int((places[words:] - places[:-words]).min()) - 1
            self.ids.append(item)
            data.append(own)
            runs.append(np.unique(run_codes(tokens, words)))
            need.append((max(1, shortest + 1 - Q * (edits + 1)), max(1, shortest - edits * (1 + PENALTY)), max(1, shortest + 1 - Q)))
        #: least q-grams of a region, least score of a passage, least q-grams of a region with a passage without an edit
        self.need = np.array(need, np.int64).reshape(-1, 3)
        self.sizes = np.array([len(d) for d in data], np.int64)
        # a byte that isn't in any text stands between items
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.data = b"\x00".join(data)
        self.runs = np.concatenate(runs) if runs else np.empty(0, np.uint64)
        self.run_ends = np.cumsum([len(r) for r in runs]).astype(np.int64)
        codes = grams(self.data)
        inside = np.ones(len(codes), bool)
        for k in range(1, Q + 1):
            # no q-gram reaches over the end of its item
            at = self.starts + self.sizes + 1 - k
            inside[at[(at >= 0) & (at < len(codes))]] = False
        place = np.flatnonzero(inside).astype(np.uint32)
        codes = codes[place]
        order = np.argsort(codes, kind="stable")
        codes, self.place = codes[order], place[order]
        del order, place, inside
        new = np.ones(len(codes), bool)
        new[1:] = codes[1:] != codes[:-1]
        self.codes = codes[new]
        self.first = np.append(np.flatnonzero(new), len(codes)).astype(np.uint32)
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * _B) >> np.uint64(64 - _BITS)).astype(np.int64)

    @property
    def nbytes(self) -> int:
        return len(self.data) + sum(x.nbytes for x in (self.codes, self.first, self.place, self.runs, self.run_ends, self.sizes, self.starts, self.need, self.filter))

    def shared(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(places in data, numbers of q-grams) of all shared q-grams, without their places in the items."""
        codes = grams(data)
        at = np.flatnonzero(self.filter[self._slot(codes)])
        if not at.size or not self.codes.size:
            return at[:0], at[:0]
        found = np.searchsorted(self.codes, codes[at])
        found[found == len(self.codes)] = 0
        same = self.codes[found] == codes[at]
        return at[same], found[same]

    def regions(self, data: bytes, starts: np.ndarray, most: int = MOST_HITS) -> np.ndarray:
        """(text, item, first diagonal in the text, shared q-grams) of the bands that hold enough of them, as rows. starts: where the texts begin.

        A q-gram that many items share has as many places, so hits are expanded for at most about `most` at a time (one q-gram's places at
        least) and only the counts of bands are kept; bands that the text has passed are judged and leave the counts.
        """
        at, found = self.shared(data)
        if not at.size:
            return np.empty((0, 4), np.int64)
        step, first = self.edits + 1, self.first.astype(np.int64)
        text = np.searchsorted(starts, at, "right") - 1
        times = first[found + 1] - first[found]
        total = np.cumsum(times)
        # a key is a text (a chunk has fewer than 2^17), an item (a block has fewer than 2^20) and a band
        keys, counts, kept = np.empty(0, np.int64), np.empty(0, np.int64), []
        begin = 0
        while begin < len(at):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + most, "right")))
            n = times[begin:end]
            entry = np.repeat(first[found[begin:end]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            place = self.place[entry].astype(np.int64)
            item = np.searchsorted(self.starts, place, "right") - 1
            own = text[begin:end]
            diagonal = np.repeat(at[begin:end] - starts[own], n) - place + self.starts[item]
            bands, c = np.unique(np.repeat(own, n) << 44 | item << 24 | (diagonal + _MIDDLE) // step, return_counts=True)
            # overlapping bands of twice the width
            own, inverse = np.unique(np.concatenate([keys, bands, bands - 1]), return_inverse=True)
            c = np.bincount(inverse, np.concatenate([counts, c, c])).astype(np.int64)
            # a band whose item has ended before the next place gets no more hits
            t, item, band = own >> 44, own >> 24 & 0xFFFFF, own & 0xFFFFFF
            over = starts[t] + (band + 2) * step - _MIDDLE + self.sizes[item] < (at[end] if end < len(at) else 1 << 40)
            enough = over & (c >= self.need[item, 0])
            kept.append(np.stack([own[enough], c[enough]]))
            keys, counts = own[~over], c[~over]
            begin = end
        keys, counts = np.concatenate(kept, axis=1)
        return np.stack([keys >> 44, keys >> 24 & 0xFFFFF, (keys & 0xFFFFFF) * step - _MIDDLE, counts], axis=1)

    def verified(self, data: bytes, regions: np.ndarray, most: int = MOST_CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which regions' banded local alignments score enough, their scores and edits. regions: item, first diagonal, begin and end of the text.

        Regions of like length advance together, as many as `most` cells hold, so that a long item costs its own length only.
        """
        order = np.argsort(self.sizes[regions[:, 0]], kind="stable")
        sizes = self.sizes[regions[order, 0]]
        score, edits, begin = np.zeros(len(regions), np.int64), np.zeros(len(regions), np.int64), 0
        while begin < len(regions):
            fits = np.arange(1, len(regions) - begin + 1) * sizes[begin:] <= most
            end = begin + max(1, int(fits.argmin()) if not fits.all() else len(fits))
            own = order[begin:end]
            score[own], edits[own] = self._aligned(data, regions[own])
            begin = end
        at = np.flatnonzero(score >= self.need[regions[:, 0], 1])
        return at, score[at], edits[at]

    def _aligned(self, data: bytes, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = 2 * (self.edits + 1)
        sizes = self.sizes[regions[:, 0]]
        longest = int(sizes.max())
        text, source = np.frombuffer(data, np.uint8), np.frombuffer(self.data, np.uint8)
        column = np.arange(longest)
        items = np.where(column < sizes[:, None], source[np.minimum(self.starts[regions[:, 0]][:, None] + column, len(source) - 1)], 0).astype(np.uint8)
        # score and number of edits in one number: of equal scores the one with fewer edits is the larger; an edit costs `PENALTY` matches,
        # so there are fewer edits than `unit`
        kind, unit = (np.int32, 1 << 10) if longest < 1 << 13 else (np.int64, 1 << 20)
        score = np.zeros((len(regions), width + 1), kind)
        best = np.zeros((len(regions), width), kind)
        places = regions[:, 1][:, None] + np.arange(width)[None, :]
        low, high = regions[:, 2:3], regions[:, 3:4]
        gain, loss = kind(unit), kind(PENALTY * unit + 1)
        for i in range(longest):
            j = places + i
            inside = (j >= low) & (j < high)
            equal = inside & (text[np.clip(j, 0, len(text) - 1)] == items[:, i : i + 1]) & (items[:, i : i + 1] != 0)
            new = np.maximum(np.maximum(score[:, :width] + np.where(equal, gain, -loss), score[:, 1:] - loss), 0)
            for k in range(1, width):
                new[:, k] = np.maximum(new[:, k], new[:, k - 1] - loss)
            new[~inside] = 0
            score[:, :width] = new
            np.maximum(best, new, out=best)
        best = best.max(axis=1).astype(np.int64)
        value = -(-best // unit)
        return value, value * unit - best

    def run(self, item: int, data: bytes, diagonal: int) -> int:
        """The most consecutive words of the item that stand consecutively in the region of a text."""
        a = max(0, diagonal)
        b = min(len(data), diagonal + 2 * (self.edits + 1) + int(self.sizes[item]))
        if a:
            a = data.rfind(b" ", 0, a + 1) + 1
        end = data.find(b" ", b)
        codes = run_codes(data[a : len(data) if end < 0 else end].decode("utf-8", "replace").split(" "), self.words)
        own = self.runs[self.run_ends[item - 1] if item else 0 : self.run_ends[item]]
        at = np.searchsorted(own, codes)
        at[at == len(own)] = 0
        both = np.concatenate([[False], own[at] == codes, [False]]) if len(codes) else np.zeros(1, bool)
        change = np.flatnonzero(both[1:] != both[:-1])
        longest = int((change[1::2] - change[::2]).max(initial=0))
        return longest + self.words - 1 if longest else 0


def _chunks(texts: list[str], index: Index):
    """(row, data): runs of texts as one piece of data each, with the row where each text begins; long texts in overlapping pieces."""
    held: list[bytes] = []
    rows: list[int] = []
    size = 0
    lap = 2 * int(index.sizes.max(initial=0)) + 4 * Q
    for row, text in enumerate(texts):
        data = plain(text).encode("utf-8", "replace")
        if len(data) < Q:
            continue
        if size and size + len(data) > CHUNK:
            yield rows, held
            held, rows, size = [], [], 0
        if len(data) > 2 * CHUNK:
            for a in range(0, len(data), CHUNK):
                # a piece begins and ends between words and laps over the next by more than an item
                begin = data.rfind(b" ", 0, a) + 1 if a else 0
                end = data.find(b" ", min(len(data), a + CHUNK + lap))
                yield [row], [data[begin : len(data) if end < 0 else end]]
            continue
        held.append(data)
        rows.append(row)
        size += len(data) + 1
    if held:
        yield rows, held


def scan(texts: list[str], index: Index) -> dict[tuple[int, int], tuple[int, int, int]]:
    """{(row, item): (longest run of shared words, score, edits)} of a batch of texts; the run is 0 where a passage is only similar."""
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for rows, held in _chunks(texts, index):
        data = b"\n".join(held)
        sizes = np.array([len(d) for d in held], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        regions = index.regions(data, starts)
        of, count = regions[:, 0], regions[:, 3]
        regions = np.column_stack([regions[:, 1], regions[:, 2] + starts[of], starts[of], starts[of] + sizes[of]])
        # passages without an edit have more q-grams: all those regions are read; of the others each text and item needs one that holds,
        # so they are tried by their number of q-grams until there is one
        whole = count >= index.need[regions[:, 0], 2]
        pair = of << 40 | regions[:, 0]
        order = np.lexsort((-count, ~whole, pair))
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(np.diff(pair[order], prepend=-1) != 0, np.arange(len(order)), 0))
        now, left, tries = order[whole[order] | (rank == 0)], order[~whole[order] & (rank > 0)], 1
        while now.size:
            at, scores, edits = index.verified(data, regions[now])
            now = now[at]
            left = left[~np.isin(pair[left], pair[now])]
            for t, (item, diagonal), exact, score, edit in zip(of[now].tolist(), regions[now, :2].tolist(), whole[now].tolist(), scores.tolist(), edits.tolist(), strict=True):
                words = index.run(item, held[t], diagonal - int(starts[t])) if exact else 0
                key = (rows[t], item)
                old = found.get(key, (0, 0, 0))
                better = (score, edit) if (score, -edit) > (old[1], -old[2]) else old[1:]
                found[key] = (max(words, old[0]), *better)
            # of each pair that is left the next regions, twice as many each time
            tries *= 2
            new = np.ones(len(left), bool)
            new[1:] = pair[left[1:]] != pair[left[:-1]]
            own = np.arange(len(left)) - np.maximum.accumulate(np.where(new, np.arange(len(left)), 0)) < tries
            now, left = left[own], left[~own]
    return found


def blocks_of(source: DataFrame, block_chars: int):
    """The items (k, t) in blocks of at most `block_chars` characters and one item; they come to the driver block by block."""
    block, size = [], 0
    for k, t in source.toLocalIterator():
        block.append((k, t))
        size += len(t)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, words: int = WORDS, edits: int = EDITS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, doc_id, n_words, score, edits) of every text and item with a passage of `words` words within `edits` edits.

    n_words: the longest run of at least `words` consecutive words that they share, 0 where none is without an edit. score, edits: of the
    best aligned passage, a character each less `PENALTY` an edit (a missing or added word counts its characters); where a passage is
    longer than the edit budget allows, that of its best part.
    """
    spark = corpus.sparkSession
    source = items.select(F.col(f"`{item_key}`").alias("k"), F.col(f"`{item_text}`").alias("t")).where("t is not null")
    kind, item_kind = corpus.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    rows = corpus.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null and t <> ''")
    out = None
    for part in blocks_of(source, block_chars):
        shared = spark.sparkContext.broadcast(Index(part, words, edits))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                found = scan(batch.column(1).to_pylist(), index)
                pairs = [(row, index.ids[item], *x) for (row, item), x in found.items()]
                cols = [pa.array([p[1] for p in pairs], _arrow(item_kind)), batch.column(0).take(pa.array([p[0] for p in pairs], pa.int64())), *(pa.array([p[k] for p in pairs], pa.int32()) for k in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays(cols, names=["item_id", "doc_id", "n_words", "score", "edits"])

        each = rows.mapInArrow(run, f"item_id {item_kind}, doc_id {kind}, n_words int, score int, edits int")
        out = each if out is None else out.unionByName(each)
    if out is None:
        return rows.where("false").select(F.lit(None).cast(item_kind).alias("item_id"), F.col("k").alias("doc_id"), *[F.lit(0).alias(c) for c in ("n_words", "score", "edits")])
    return out


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
