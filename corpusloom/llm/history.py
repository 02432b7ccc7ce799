"""New batches checked for copies and near-copies against everything accepted before.

A text is the set of its shingles, in one order for all texts: rare ones first,
by counts of hash slots over all records of the load (of a history: its first
load), then by code (any order is right, a rare-first one is cheap).  Of n shingles the first n - ceil(2n/3) + 1
are indexed ("anchors"): the suffixes of the text that begin with them.  Two
texts of which two thirds of the shingles are in both share at least one anchor,
whatever their length and wherever they differ.  No similar pair is lost (but for
two words or shingles with one 64-bit code).

*The history* (`History`) keeps, a load a segment, sorted arrays of these suffixes
and the accepted records' shingles; segments are never changed, and those of like
size are merged into new ones, logarithmically often.  A load's own suffixes are
brought to the parts of the code space (the only shuffle), found in the segments'
files by binary search, with reads of the blocks in which they stand, and what is
shared is added up for each pair: the coverage.  Pairs with less coverage than
similarity requires (`least_coverage`) go, the rest is verified exactly on whole
texts, with the history's shingles read at their places.  So a load reads,
shuffles and writes in step with its own size; the history's texts aren't read.

Suffixes are ordered by the code of their first shingle only, not by their whole
content, because a similarity of two thirds guarantees no longer match than a
shingle: an array in content's order with long matches would lose pairs.

*Within a load* anchors are partitioned by code, and each partition is sorted once
by code and arrival, so that a newcomer's earlier matches stand just before it.  A
match is left out only where similarity is impossible: by the two sizes, by the
places of the shared anchor (what comes after it bounds what can be shared), or by
the parity of hash classes (each class that differs holds a shingle that only one
text has; a text has about as many classes as shingles).

Hot groups: exact copies are folded to their first record before anything is
exploded.  Where more than a range of earlier anchors are alike, only the
earliest are looked at.  Records for which that happens at any of their anchors
are unsure (a similar text may share no more than one of them): they are
searched again, in rounds, with a range four times as large each time, but only
among records that aren't rejected or have exact copies, until none is unsure.  So a hot group costs
its size times its accepted records, which are also what its result lists.

Accepting: a record that repeats an accepted one isn't accepted; all others
are, in order of arrival.  That is settled on the verified pairs by rounds of
joins, each decided record leaving the table.

Defined results: null and empty texts and texts of fewer words than a shingle
are accepted and repeat nothing; ties in the arrival order (a repeated id in
one batch) are one record; a null batch arrives first; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.segments import Reader, Writer, filesystem, merged, new_name
from corpusloom.llm.words import plain
from corpusloom.session import cut_lineage

SHINGLE, SHARE = 3, (2, 3)
RANGE = 32
#: The range of shingles is so many times as large.
NO_TAIL = 16
#: So many ids of records in pairs are broadcast at most (8 bytes each); beyond that their texts are found by a shuffled join.
BROADCAST_IDS = 1_000_000
ROWS_A_PARTITION = 2_000_000
#: Counts of shingles and anchors stand in 2^SLOT_BITS slots; SLOTS_A_ROW of them travel together. Every record is counted: SAMPLED is read nowhere, but set by a test.
SLOT_BITS, SLOTS_A_ROW, SAMPLED = 20, 1_024, 1
#: Words of 64 classes whose parity stands beside a record's anchors, at most.
PARITY_WORDS = 64
#: Slots of more than RANGE times HOT_FACTOR anchors of a load are hot; new records there are salted so many ways.
HOT_FACTOR, SALTS = 4_096, 64
CHUNK_WORDS, CHUNK_TEXTS, CHUNK_MATCHES = 500_000, 4_000, 2_000_000
#: What stands packed in the rows of a part: records, and for each of their anchors 40 bits of its code, its place (up to 65,535) and these flags.
_RECORD = np.dtype([("id", "i8"), ("batch", "i8"), ("n", "i4"), ("words", "i2"), ("own", "i4")])
_NEW, _TARGET, _HOT = 1, 2, 4

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Known(dict):
    """Codes of words; those of a worker's recent words are kept."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_words = _Known()


def _codes(words: list[str]) -> np.ndarray:
    """A 64-bit code of each word."""
    return np.array([_words[w] for w in words], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _windows(codes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """The code of the n words from each place on."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    total = np.full(m, salt, np.uint64)
    for j in range(n):
        total = total * _MIX + codes[j : j + m]
    return _mixed(total)


def shingles(text: str) -> np.ndarray:
    """The sorted codes of the distinct shingles of a text."""
    tokens = plain(text).split()
    return np.unique(_windows(_codes(tokens), SHINGLE, 1))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    num, den = SHARE
    return both > 0 and den * both >= num * (len(a) + len(b) - both)


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _inside(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of texts whose word codes stand one after the other, repeated ones too: their texts and their codes."""
    n = np.diff(ends, prepend=0)
    own = _windows(codes, SHINGLE, 1)
    text = np.repeat(np.arange(len(n)), n)[: len(own)]
    inside = np.arange(len(own)) + SHINGLE <= ends[text]
    return text[inside], own[inside]


def ordered(codes: np.ndarray, ends: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of texts whose word codes stand one after the other, in the order of anchors: their texts, their codes, and how many each text has."""
    t, c = _inside(codes, ends)
    order = np.lexsort((c, t) if counts is None else (c, counts[_slot(c)], t))
    t, c = t[order], c[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
    t, c = t[new], c[new]
    return t, c, np.bincount(t, minlength=len(ends))


def _first(size: np.ndarray) -> np.ndarray:
    """How many shingles of a text must be indexed: of a similar text it can't miss more than the others."""
    num, den = SHARE
    return np.where(size > 0, size - -(-num * size // den) + 1, 0)


def _places(n: np.ndarray) -> np.ndarray:
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def anchors(codes: np.ndarray, ends: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of texts whose word codes stand one after the other: a column of codes, and how many each text has."""
    _, c, size = ordered(codes, ends, counts)
    n = _first(size)
    return c[_places(size) < np.repeat(n, size)][:, None], n


def _chunks(batches, column: int):
    """(batch, rows, class names, words' codes) of parts of bounded size, for the texts with at least a shingle."""
    for rb in batches:
        keep, names, codes, size = [], [], [], 0
        for i, t in enumerate(rb.column(column).to_pylist()):
            folded = plain(t)
            tokens = folded.split(" ")
            if len(tokens) >= SHINGLE:
                keep.append(i)
                names.append(hashlib.blake2b(folded.encode("utf-8", "replace"), digest_size=16).digest())
                codes.append(_codes(tokens))
                size += len(tokens)
            if size >= CHUNK_WORDS or len(keep) >= CHUNK_TEXTS:
                yield rb, keep, names, codes
                keep, names, codes, size = [], [], [], 0
        if keep:
            yield rb, keep, names, codes


def _slot_counts(rows: DataFrame, codes) -> np.ndarray:
    """How many of all the codes that `codes` yields for batches of rows fall into each slot. What a task shuffles and what the driver gets is bounded by the number of slots."""

    def count(batches):
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for found in codes(batches):
            total += np.bincount(_slot(found), minlength=1 << SLOT_BITS)
        at = np.flatnonzero(total.reshape(-1, SLOTS_A_ROW).any(axis=1))
        # the first bytes of all counts, then the second ones: mostly zeros, which compress
        packed = total.view(np.uint8).reshape(-1, SLOTS_A_ROW, 8).swapaxes(1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([packed[i].tobytes() for i in at], pa.binary())], names=["at", "n"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for rb in batches:
            for at, n in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                own = np.ascontiguousarray(np.frombuffer(n, np.uint8).reshape(8, -1).T).view(np.int64)[:, 0]
                total[at] = total.get(at, 0) + own
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([n.tobytes() for n in total.values()], pa.binary())], names=["at", "n"])

    kinds, counts = "at long, n binary", np.zeros((1 << SLOT_BITS) // SLOTS_A_ROW * SLOTS_A_ROW, np.int64).reshape(-1, SLOTS_A_ROW)
    found = rows.mapInArrow(count, kinds).repartition("at").mapInArrow(add, kinds).toArrow()
    for at, n in zip(found.column("at").to_pylist(), found.column("n").to_pylist(), strict=True):
        counts[at] = np.frombuffer(n, np.int64)
    return counts.ravel()


def shingle_counts(docs: DataFrame, text: str) -> np.ndarray:
    """How many distinct shingles of each record, over all records, fall into each slot: the order of anchors."""

    def codes(batches):
        for _, _, _, found in _chunks(batches, 0):
            t, c = _inside(np.concatenate(found), np.cumsum([len(x) for x in found]))
            # below the bits of the slot a code is mixed with its text, so that one sort of numbers tells what is distinct in a text
            low = np.uint64((1 << (64 - SLOT_BITS)) - 1)
            c = np.sort((c & ~low) | ((c ^ (t.astype(np.uint64) * _MIX)) & low))
            yield c[np.diff(c, prepend=~c[:1]) != 0]

    return _slot_counts(docs.select(F.col(f"`{text}`").alias("t")).where("t is not null and t <> ''"), codes)


def anchor_counts(index: DataFrame) -> np.ndarray:
    """How many anchors of all index rows fall into each slot: which are hot."""

    def codes(batches):
        for rb in batches:
            if rb.num_rows:
                yield np.concatenate([_codes_of(a) for a in rb.column(0).to_pylist()])

    return _slot_counts(index.select("anchors"), codes)


def indexed(docs: DataFrame, key: str, text: str, batch: str, counts: np.ndarray) -> DataFrame:
    """(doc_id, batch, class, anchors) of every record with at least a shingle of words; anchors: how many shingles it has, how many words of parities, these, the codes."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.coalesce(F.col(f"`{batch}`").cast("long"), F.lit(-(1 << 62))).alias("b"), F.col(f"`{text}`").alias("t")).where("k is not null and t is not null and t <> ''")
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        for rb, keep, names, codes in _chunks(batches, 2):
            t, c, size = ordered(np.concatenate(codes), np.cumsum([len(x) for x in codes]), shared.value)
            words = _parity_words(size)
            first = (np.cumsum(words) - words) * 64
            odd = np.bincount(first[t] + (c & (words[t] * 64 - 1).astype(np.uint64)).astype(np.int64), minlength=int(words.sum()) * 64) & 1
            bits = np.packbits(odd.astype(np.uint8)).view(np.uint64)
            n, start = _first(size), np.cumsum(size) - size
            packed = [np.concatenate([np.array([size[i], words[i]], np.uint64), bits[first[i] // 64 :][: words[i]], c[start[i] :][: n[i]]]).tobytes() for i in range(len(size))]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([rb.column(0).take(at), rb.column(1).take(at), pa.array(names, pa.binary()), pa.array(packed, pa.binary())], names=["doc_id", "batch", "class", "anchors"])

    return rows.mapInArrow(run, "doc_id long, batch long, class binary, anchors binary")


def _parity_words(size: np.ndarray) -> np.ndarray:
    """Words of 64 classes for texts of so many shingles: a power of two, so that longer rows can be folded to shorter ones."""
    return np.clip(1 << np.ceil(np.log2(np.maximum(1, size * 1.25 / 64))).astype(np.int64), 1, PARITY_WORDS)


def _codes_of(anchors_: bytes) -> np.ndarray:
    a = np.frombuffer(anchors_, np.uint64)
    return a[2 + int(a[1]) :]


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, each with the number of its range."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def matches(code, arrival, size, place, new, target, limit):
    """Yields (arrivals of newcomers, arrivals of earlier targets) with a shared anchor that allows similarity, and at last
    (entries of newcomers for which some weren't looked at, None). All arguments but the last: one value an entry."""
    num, den = SHARE
    order = np.lexsort((arrival, code))
    code, arrival, size, room, new, target = code[order], arrival[order], size[order], (size - place)[order], new[order], target[order]
    start = np.ones(len(code), bool)
    start[1:] = code[1:] != code[:-1]
    before = np.cumsum(target) - target  # targets before each entry
    lo = before[np.flatnonzero(start)][np.cumsum(start) - 1]
    ask = np.flatnonzero(new & (before > lo))
    lo, hi = lo[ask], before[ask]
    t_arrival, t_size, t_room = arrival[target], size[target], room[target]
    short = ask[hi - lo > limit]
    hi = np.minimum(hi, lo + limit)
    part = np.cumsum(hi - lo) // CHUNK_MATCHES
    for own in np.split(np.arange(len(ask)), np.flatnonzero(np.diff(part)) + 1):
        q, m = _ranges(lo[own], hi[own])
        q = ask[own][q]
        a, b = size[q], t_size[m]
        # of a pair's shared anchors the first one passes: all that is shared stands at or after it in both
        ok = (num + den) * np.minimum(room[q], t_room[m]) >= num * (a + b)
        q, m, a, b = q[ok], m[ok], a[ok], b[ok]
        ok = (den * np.minimum(a, b) >= num * np.maximum(a, b)) & (t_arrival[m] < arrival[q])
        yield arrival[q[ok]], t_arrival[m[ok]]
    yield order[short], None


def _parities(words: np.ndarray, bits: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of rows: the row number of every record that has as many, and the rows, longer ones folded."""
    out, start = {}, np.cumsum(words) - words
    width = PARITY_WORDS
    above, rows = np.empty(0, np.int64), np.empty((0, 2 * width), np.uint64)
    while width:
        own = np.flatnonzero(words == width)
        rows = np.concatenate([rows[:, :width] ^ rows[:, width:], bits[start[own][:, None] + np.arange(width)]])
        above = np.concatenate([above, own])
        number = np.zeros(len(words), np.int64)
        number[above] = np.arange(len(above))
        out[width] = (number, rows)
        width //= 2
    return out


def _parities_allow(a: np.ndarray, b: np.ndarray, size: np.ndarray, words: np.ndarray, parities: dict) -> np.ndarray:
    num, den = SHARE
    apart, width = np.zeros(len(a), np.int64), np.minimum(words[a], words[b])
    for w, (number, rows) in parities.items():
        for own in np.array_split(at := np.flatnonzero(width == w), 1 + len(at) * w // CHUNK_MATCHES):
            apart[own] = np.bitwise_count(rows[number[a[own]]] ^ rows[number[b[own]]]).sum(axis=1, dtype=np.int64)
    return (num + den) * apart <= (den - num) * (size[a] + size[b])


def _parted(rb: pa.RecordBatch, parts: int, hot_slots: np.ndarray, wanted: np.ndarray | None, limit: int) -> pa.RecordBatch:
    """A batch of the index as one row a part: the records and their anchors, packed.

    At hot slots no part gets an unbounded group: new records are salted over up to `SALTS` parts, and only the earliest targets go to
    each of them. The records count as not all looked at, so a later round, with larger bounds, settles them: results don't depend on
    what is hot.
    """
    found = [np.frombuffer(a, np.uint64) for a in rb.column("anchors").to_pylist()]
    id_, batch, new, target = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "batch", "is_new", "is_target"))
    size, words = (np.array([a[k] for a in found], np.int64) for k in (0, 1))
    bits = [a[2 : 2 + int(a[1])] for a in found]
    n = np.array([len(a) for a in found], np.int64) - words - 2
    code, record, place = np.concatenate([a[2 + int(a[1]) :] for a in found]), np.repeat(np.arange(len(n)), n), _places(n)
    if wanted is not None:
        keep = wanted[_slot(code)]
        code, record, place = code[keep], record[keep], place[keep]
    flags = new[record] * _NEW + target[record] * _TARGET
    salt = np.zeros(len(code), np.int64)
    hot = hot_slots[_slot(code)]
    if hot.any():
        salts = min(SALTS, parts)
        asked, held = np.flatnonzero(hot & new[record]), np.flatnonzero(hot & target[record])
        held = held[np.lexsort((id_[record[held]], batch[record[held]], code[held]))]
        held = held[_places(np.unique(code[held], return_counts=True)[1]) <= limit]
        cool = np.flatnonzero(~hot)
        at = np.concatenate([cool, asked, np.repeat(held, salts)])
        flags = np.concatenate([flags[cool], np.full(len(asked), _NEW + _HOT), np.full(len(held) * salts, _TARGET)])
        own = _mixed(id_[record[asked]].view(np.uint64)) % np.uint64(salts)
        salt = np.concatenate([salt[cool], own.astype(np.int64), np.tile(np.arange(salts), len(held))])
        code, record, place = code[at], record[at], place[at]
    part = ((code % np.uint64(parts)).astype(np.int64) + salt) % parts
    order = np.lexsort((record, part))
    part, record, code = part[order], record[order], code[order] >> np.uint64(24)
    place, flags = np.minimum(place[order], 65_535).astype(np.uint16), flags[order].astype(np.uint8)
    low, high = (code & np.uint64(0xFFFFFFFF)).astype(np.uint32), (code >> np.uint64(32)).astype(np.uint8)
    rows: tuple[list, ...] = tuple([] for _ in range(7))
    for own in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
        if own.size:
            at, times = np.unique(record[own], return_counts=True)
            r = np.zeros(len(at), _RECORD)
            for name, x in (("id", id_[at]), ("batch", batch[at]), ("n", size[at]), ("words", words[at]), ("own", times)):
                r[name] = x
            for column, x in zip(rows, (int(part[own[0]]), r.tobytes(), np.concatenate([bits[i] for i in at]).tobytes(), low[own].tobytes(), high[own].tobytes(), place[own].tobytes(), flags[own].tobytes()), strict=True):
                column.append(x)
    return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(x, pa.binary()) for x in rows[1:])], names=["part", *_PACKED])


_PACKED = {"records": _RECORD, "bits": np.uint64, "low": np.uint32, "high": np.uint8, "place": np.uint16, "flags": np.uint8}


def candidates(index: DataFrame, counts: np.ndarray, limit: int, partitions: int, again: bool = False) -> DataFrame:
    """(doc_id, other): pairs of a newcomer and an earlier target that may be similar; `other` null: some matches of the newcomer weren't looked at.

    index: doc_id, batch, anchors, is_new, is_target; one row a class of copies. counts: of the load's anchors (`anchor_counts`). again: few records are new, so of the others only anchors
    in slots of theirs are shuffled.
    """
    limit *= NO_TAIL
    hot_slots, wanted = counts > limit * HOT_FACTOR, None
    if again:

        def slots(batches):
            for rb in batches:
                found = [_codes_of(a) for a in rb.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slot(np.concatenate(found))) if found else [], pa.int64())], names=["slot"])

        wanted = np.zeros(1 << SLOT_BITS, bool)
        # at most as many as there are slots
        wanted[index.where("is_new").select("anchors").mapInArrow(slots, "slot long").distinct().toArrow().column(0).to_numpy()] = True
    shared = index.sparkSession.sparkContext.broadcast((hot_slots, wanted))

    def part(batches):
        for rb in batches:
            if rb.num_rows:
                yield _parted(rb, partitions, *shared.value, limit)

    def search(batches):
        packed = {name: [] for name in _PACKED}
        for rb in batches:
            for name, kind in _PACKED.items():
                packed[name] += [np.frombuffer(x, kind) for x in rb.column(name).to_pylist()]
        if not packed["records"]:
            return
        record, bits, low, high, place, flags = (np.concatenate(packed.pop(name)) for name in _PACKED)
        code = (high.astype(np.uint64) << np.uint64(32)) | low
        # records numbered by arrival
        order = np.lexsort((record["id"], record["batch"]))
        change = np.ones(len(order), bool)
        change[1:] = (record["id"][order][1:] != record["id"][order][:-1]) | (record["batch"][order][1:] != record["batch"][order][:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(change) - 1
        arrival = np.repeat(number, record["own"])
        first = order[change]
        ids, size, words = (record[c][first].astype(np.int64) for c in ("id", "n", "words"))
        at = np.cumsum(record["words"], dtype=np.int64) - record["words"]
        parities = _parities(words, bits[np.repeat(at[first], words) + _places(words)])
        new, target = flags & _NEW > 0, flags & _TARGET > 0
        pairs, cut = [], [arrival[flags & _HOT > 0]]
        for a, b in matches(code, arrival, size[arrival], place.astype(np.int64), new, target, limit):
            if b is None:
                cut.append(arrival[a])
            else:
                both = np.unique(a * len(ids) + b)
                pairs.append(both[_parities_allow(both // len(ids), both % len(ids), size, words, parities)])
        both = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        a, b = both // len(ids), both % len(ids)
        c = np.unique(np.concatenate(cut))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids[a], ids[c]])), pa.concat_arrays([pa.array(ids[b]), pa.nulls(len(c), pa.int64())])], names=["doc_id", "other"])

    kinds = ", ".join(f"{name} binary" for name in _PACKED)
    parted = index.select("doc_id", "batch", "anchors", "is_new", "is_target").mapInArrow(part, f"part int, {kinds}").repartitionById(partitions, "part")
    return parted.mapInArrow(search, "doc_id long, other long").distinct()


def shingled(texts: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(k, s): the sorted shingles of the records whose ids stand in `wanted` (column k); only their texts are read into Python."""
    rows = texts.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null").join(_sized(cut_lineage(wanted)), "k", "left_semi")

    def run(batches):
        for rb in batches:
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([shingles(t).tobytes() for t in rb.column(1).to_pylist()], pa.binary())], names=["k", "s"])

    return rows.mapInArrow(run, "k long, s binary").groupBy("k").agg(F.first("s").alias("s"))


def verified(pairs: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (doc_id, other) whose shingle sets are similar; only the texts of records in pairs are read into Python."""
    sets = shingled(texts, key, text, pairs.select(F.col("doc_id").alias("k")).unionByName(pairs.select(F.col("other").alias("k"))).distinct())

    def compare(batches):
        for rb in batches:
            ok = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(rb.column("s").to_pylist(), rb.column("s2").to_pylist(), strict=True)]
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([rb.column("doc_id").take(at), rb.column("other").take(at)], names=["doc_id", "other"])

    both = pairs.select("doc_id", "other").join(sets.withColumnRenamed("k", "doc_id"), "doc_id").join(sets.select(F.col("k").alias("other"), F.col("s").alias("s2")), "other")
    return both.mapInArrow(compare, "doc_id long, other long")


def _sized(df: DataFrame) -> DataFrame:
    """A checkpointed table of ids, to be broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def settle(edges: DataFrame, unsure: DataFrame) -> DataFrame:
    """The records that are rejected for certain: later ones of (doc_id, other) pairs whose other is accepted for certain. Rounds of joins.

    A record is accepted for certain when it isn't the later one of any open pair and isn't unsure, that is, when no pair of it can be missing.
    """
    waiting = unsure.select(F.col("doc_id").alias("other"))
    open_ = edges
    rejected = None
    while True:
        later = open_.select(F.col("doc_id").alias("other")).distinct()
        now = cut_lineage(open_.join(later, "other", "left_anti").join(waiting, "other", "left_anti").select("doc_id").distinct())
        if now.isEmpty():
            return rejected if rejected is not None else now
        rejected = now if rejected is None else rejected.unionByName(now)
        open_ = cut_lineage(open_.join(now, "doc_id", "left_anti").join(now.select(F.col("doc_id").alias("other")), "other", "left_anti").select("doc_id", "other"))


def repeats(docs: DataFrame, key: str, text: str, batch: str, limit: int = RANGE) -> DataFrame:
    """(doc_id, other): every newcomer with the accepted earlier records that it repeats. All batches of docs are one load."""
    return take_load(docs, key, text, batch, limit=limit)[0]


def take_load(docs: DataFrame, key: str, text: str, batch: str, against=None, limit: int = RANGE, counts: np.ndarray | None = None) -> tuple[DataFrame, DataFrame]:
    """The pairs of a load's newcomers, and the index rows of what it adds to the accepted records.

    against: gives the pairs (doc_id, other) of index rows with similar records that were accepted in earlier loads. Ids are unique over
    all loads. counts: the order of anchors (`shingle_counts`).
    """
    if counts is None:
        counts = shingle_counts(docs, text)
    index = cut_lineage(indexed(docs, key, text, batch, counts))
    docs = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"))
    arrival = F.struct("batch", "doc_id")
    # exact copies are folded to the first of them; only (class, arrival) is shuffled for that
    first = index.groupBy("class").agg(F.min(arrival).alias("first"), F.count("*").alias("n"))
    copied = cut_lineage(first.where("n > 1"))
    copies = index.select("doc_id", "batch", "class").join(copied, "class").where(F.struct("batch", "doc_id") > F.col("first")).select("doc_id", "batch", F.col("first.doc_id").alias("rep")).distinct()
    copies = cut_lineage(copies)
    everyone = index.join(_sized(copies.select("doc_id", "batch")), ["doc_id", "batch"], "left_anti")
    reps = everyone.select("doc_id", "batch", "anchors", F.lit(True).alias("is_new"), F.lit(True).alias("is_target"))
    held = anchor_counts(index)
    partitions = max(1, int(held.sum()) // ROWS_A_PARTITION, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    with_copies = copies.select(F.col("rep").alias("doc_id"))
    edges, again = None, False
    if against is not None:
        edges = cut_lineage(against(everyone))
        out = edges.select("doc_id").distinct().join(with_copies, "doc_id", "left_anti")
        reps = reps.drop("is_target").join(_sized(cut_lineage(out.withColumn("is_target", F.lit(False)))), "doc_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(True)))
    while True:
        found = cut_lineage(candidates(reps, held, limit, partitions, again=again))
        pairs = found.where("other is not null")
        more = cut_lineage(verified(pairs, docs, key, text))
        edges = more if edges is None else cut_lineage(edges.unionByName(more).distinct())
        unsure = found.where("other is null").select("doc_id").distinct()
        rejected = settle(edges, unsure)
        if unsure.isEmpty():
            break
        # those are searched again, with a larger range, against all that are or may still be accepted, and those whose copies take their pairs from them
        out = rejected.join(with_copies, "doc_id", "left_anti").select("doc_id", F.lit(False).alias("is_target"))
        asked = cut_lineage(unsure).withColumn("is_new", F.lit(True))
        marked = everyone.select("doc_id", "batch", "anchors").join(_sized(out), "doc_id", "left").join(_sized(asked), "doc_id", "left")
        marked = marked.withColumns({"is_new": F.coalesce("is_new", F.lit(False)), "is_target": F.coalesce("is_target", F.lit(True))})
        reps, again = marked.where("is_new or is_target"), True
        limit *= 4
    accepted_edges = edges.join(rejected.select(F.col("doc_id").alias("other")), "other", "left_anti").select("doc_id", "other")
    pairs = accepted_edges.unionByName(_of_copies(copies, edges, rejected, index)).distinct()
    return pairs, everyone.join(rejected, "doc_id", "left_anti").select("doc_id", "batch", "class", "anchors")


#: An indexed suffix of an accepted record: the code of its first shingle, the record, and how many shingles that has.
_SUFFIX = np.dtype([("code", "<i8"), ("doc", "<i8"), ("n", "<i4")])
#: Where the shingles of an accepted record stand: number of the file, how many, and the first byte.
_SET = np.dtype([("doc", "<i8"), ("file", "<u4"), ("n", "<u4"), ("at", "<u8")])


def _suffixes(index: DataFrame, parts: int) -> DataFrame:
    """(part, code, doc, n) of the anchors of index rows, each part together and in order."""

    def run(batches):
        for rb in batches:
            found = [np.frombuffer(a, np.uint64) for a in rb.column("anchors").to_pylist()]
            if not found:
                continue
            words = [int(a[1]) for a in found]
            n = np.array([len(a) - 2 - w for a, w in zip(found, words, strict=True)])
            code, record = np.concatenate([a[2 + w :] for a, w in zip(found, words, strict=True)]), np.repeat(np.arange(len(n)), n)
            columns = [(code % np.uint64(parts)).astype(np.int32), code.view(np.int64), rb.column("doc_id").to_numpy(zero_copy_only=False)[record], np.array([int(a[0]) for a in found], np.int32)[record]]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["part", "code", "doc", "n"])

    rows = index.select("doc_id", "anchors").mapInArrow(run, "part int, code long, doc long, n int")
    return rows.repartitionById(parts, "part").sortWithinPartitions("part", "code")


def _entries(rb: pa.RecordBatch, kind: np.dtype) -> np.ndarray:
    out = np.empty(rb.num_rows, kind)
    for name in kind.names:
        column = rb.column(name).to_numpy(zero_copy_only=False)
        out[name] = column.view(kind[name]) if column.dtype.itemsize == kind[name].itemsize else column
    return out


def _runs(x: np.ndarray):
    """(value, begin, end) of the runs of equal values."""
    at = np.flatnonzero(np.diff(x)) + 1
    for a, b in zip([0, *at.tolist()], [*at.tolist(), len(x)], strict=True):
        if b > a:
            yield int(x[a]), a, b


def shared_suffixes(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    """(number in new, number in old) of the entries with one code of pairs that may be similar; both in order of codes, new in parts of bounded size."""
    num, den = SHARE
    low, high = np.searchsorted(new["code"], old["code"], "left"), np.searchsorted(new["code"], old["code"], "right")
    out = [np.empty((0, 2), np.int64)]
    for own in np.split(np.arange(len(old)), np.flatnonzero(np.diff(np.cumsum(high - low) // CHUNK_MATCHES)) + 1):
        which, q = _ranges(low[own], high[own])
        m = own[which]
        a, b = new["n"][q].astype(np.int64), old["n"][m].astype(np.int64)
        ok = den * np.minimum(a, b) >= num * np.maximum(a, b)
        out.append(np.stack([q[ok], m[ok]], axis=1))
    return np.concatenate(out)


def least_coverage(a: Column, b: Column) -> Column:
    """How many anchors similar texts of a and b shingles share at least.

    With c shingles in both, of the first p of a text at least p - (its size - c) are shared; shared ones come in one order in both texts,
    so the first min of these two numbers are among the anchors of both.
    """
    num, den = SHARE
    both = F.ceil((a + b) * num / (num + den))
    own = lambda n: n - F.ceil(n * num / den) + 1 - (n - both)
    return F.greatest(F.lit(1), F.least(own(a), own(b)))


class History:
    """The accepted records as immutable sorted arrays of their suffixes in a folder, a segment a load, merged logarithmically.

    A segment has, for each part of the codes, one sorted file of indexed suffixes, and for each part of the ids one sorted file that says
    where the records' shingles stand. A load's suffixes are brought to their parts (that is all that is shuffled), and of the segments'
    files only the blocks in which they may stand are read; so are the shingles of the records found. The state, which files make up the
    history, is one small file a version, written after a load is done; a load that fails leaves the history as it was. One load at a
    time: a second writer of the same version is an error.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[int]:
        fs, at = filesystem(self.path)
        found = fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        return sorted(int(f.base_name[6:-5]) for f in found if f.base_name.startswith("state-"))

    def state(self) -> dict:
        """The newest state: version, parts, and the segments from old to new."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "parts": 0, "segments": []}
        fs, at = filesystem(self.path)
        with fs.open_input_stream(f"{at}/state-{versions[-1]}.json") as f:
            return json.loads(f.read())

    def live(self) -> list[int]:
        """The numbers of records of the live segments, old to new."""
        return [s["n"] for s in self.state()["segments"]]

    def add(self, docs: DataFrame, key: str, text: str, batch: str, limit: int = RANGE) -> DataFrame:
        """Takes a load in and returns its pairs (doc_id, other). Its records arrive after all that were taken in before."""
        state = self.state()
        counts = self._order(docs, text)
        searched = (lambda index: self._against(index, docs, key, text, state)) if state["segments"] else None
        pairs, new = take_load(docs, key, text, batch, searched, limit, counts)
        pairs = cut_lineage(pairs)
        self._append(cut_lineage(new), docs, key, text, state)
        return pairs

    def _order(self, docs: DataFrame, text: str) -> np.ndarray:
        """The order of anchors: that of the first load, for all that follow."""
        fs, at = filesystem(self.path)
        if fs.get_file_info(f"{at}/order").type == pafs.FileType.NotFound:
            fs.create_dir(at, recursive=True)
            counts = shingle_counts(docs, text)
            with fs.open_output_stream(f"{at}/order") as f:
                f.write(counts.tobytes())
            return counts
        with fs.open_input_stream(f"{at}/order") as f:
            return np.frombuffer(f.read(), np.int64)

    def _against(self, index: DataFrame, docs: DataFrame, key: str, text: str, state: dict) -> DataFrame:
        """The pairs (doc_id, other) of index rows with the history's records that they are similar to."""
        path, segments, parts = self.path, state["segments"], state["parts"]

        def search(batches):
            fs, at = filesystem(path)
            for part, new in _by_part(batches, _SUFFIX):
                keys = np.unique(new["code"])
                for s in segments:
                    if (name := s["suffixes"].get(str(part))) is None:
                        continue
                    for old in Reader(fs, f"{at}/{name}", _SUFFIX).found(keys):
                        q, m = shared_suffixes(new, old).T
                        ids, times = np.unique(np.stack([new["doc"][q], old["doc"][m], new["n"][q], old["n"][m]], axis=1), axis=0, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (*ids.T.astype(np.int64), times.astype(np.int64))], names=["doc_id", "other", "a", "b", "shared"])

        hits = _suffixes(index, parts).mapInArrow(search, "doc_id long, other long, a long, b long, shared long")
        covered = hits.groupBy("doc_id", "other", "a", "b").agg(F.sum("shared").alias("shared")).where(F.col("shared") >= least_coverage(F.col("a"), F.col("b")))
        pairs = cut_lineage(covered.select("doc_id", "other", F.pmod(F.xxhash64("other"), F.lit(parts)).cast("int").alias("part")))
        own = shingled(docs, key, text, pairs.select(F.col("doc_id").alias("k")).distinct())

        def compare(batches):
            fs, at = filesystem(path)
            for rb in batches:
                part, doc, other = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("part", "doc_id", "other"))
                sets, ok = rb.column("s").to_pylist(), np.zeros(rb.num_rows, bool)
                for p, a, b in _runs(part):
                    kept = _sets_of(fs, at, segments, p, np.unique(other[a:b]))
                    for i in range(a, b):
                        ok[i] = similar(np.frombuffer(sets[i], np.uint64), kept[other[i]])
                yield pa.RecordBatch.from_arrays([pa.array(doc[ok]), pa.array(other[ok])], names=["doc_id", "other"])

        both = pairs.join(own.withColumnRenamed("k", "doc_id"), "doc_id").repartitionById(parts, "part").sortWithinPartitions("part", "other")
        return both.mapInArrow(compare, "doc_id long, other long")

    def _append(self, new: DataFrame, docs: DataFrame, key: str, text: str, state: dict) -> None:
        n = new.count()
        if not n:
            return
        path = self.path
        n_anchors = new.agg(F.sum(F.octet_length("anchors") / 8)).first()[0]
        parts = state["parts"] or max(1, int(n_anchors / ROWS_A_PARTITION), int(self.spark.conf.get("spark.sql.shuffle.partitions")))

        def write_suffixes(batches):
            fs, at = filesystem(path)
            part, writer = None, None
            for rb in batches:
                entries = _entries(rb, _SUFFIX)
                for p, a, b in _runs(rb.column("part").to_numpy(zero_copy_only=False)):
                    if p != part:
                        if writer is not None:
                            writer.close()
                        part, name = p, new_name("suffixes", p)
                        writer = Writer(fs, f"{at}/{name}", _SUFFIX)
                        yield _named(("suffixes", p, name))
                    writer.add(entries[a:b])
            if writer is not None:
                writer.close()

        def write_sets(batches):
            fs, at = filesystem(path)
            part, writer, blob, end = None, None, None, 0
            for rb in batches:
                docs_, sets = rb.column("k").to_numpy(zero_copy_only=False), rb.column("s").to_pylist()
                for p, a, b in _runs(rb.column("part").to_numpy(zero_copy_only=False)):
                    if p != part:
                        if writer is not None:
                            writer.close(), blob.close()
                        part, end, names = p, 0, (new_name("records", p), new_name("shingles", p))
                        writer, blob = Writer(fs, f"{at}/{names[0]}", _SET), fs.open_output_stream(f"{at}/{names[1]}")
                        yield _named(("records", p, names[0]), ("shingles", p, names[1]))
                    entries = np.zeros(b - a, _SET)
                    size = np.array([len(s) for s in sets[a:b]], np.int64)
                    entries["doc"], entries["n"], entries["at"] = docs_[a:b], size // 8, end + np.cumsum(size) - size
                    writer.add(entries)
                    blob.write(b"".join(sets[a:b]))
                    end += int(size.sum())
            if writer is not None:
                writer.close(), blob.close()

        sets = shingled(docs, key, text, new.select(F.col("doc_id").alias("k")).distinct()).withColumn("part", F.pmod(F.xxhash64("k"), F.lit(parts)).cast("int"))
        # as many rows as parts
        files = _suffixes(new, parts).mapInArrow(write_suffixes, _NAMES).collect() + sets.repartitionById(parts, "part").sortWithinPartitions("part", "k").mapInArrow(write_sets, _NAMES).collect()
        segment = {"n": n, "suffixes": {}, "records": {}, "shingles": {}}
        for f in files:
            segment[f.kind][str(f.part)] = [f.name] if f.kind == "shingles" else f.name
        segments = [*state["segments"], segment]
        while len(segments) > 1 and segments[-2]["n"] <= 2 * segments[-1]["n"]:
            # arrays of like size become one
            segments[-2:] = [self._merged(*segments[-2:], parts)]
        self._save({"version": state["version"] + 1, "parts": parts, "segments": segments})

    def _merged(self, a: dict, b: dict, parts: int) -> dict:
        """One segment of two: sorted files are merged part by part; files of shingles stay as they are."""
        path = self.path

        def merge(batches):
            fs, at = filesystem(path)

            def shifted(reader, by):
                for entries in reader.all():
                    entries = entries.copy()
                    entries["file"] += np.uint32(by)
                    yield entries

            for rb in batches:
                for p in map(str, rb.column(0).to_pylist()):
                    for kind, dtype in (("suffixes", _SUFFIX), ("records", _SET)):
                        names = [s[kind].get(p) for s in (a, b)]
                        if not all(names):
                            continue
                        readers = [Reader(fs, f"{at}/{name}", dtype) for name in names]
                        name = new_name(kind, int(p))
                        merged([readers[0].all(), readers[1].all() if kind == "suffixes" else shifted(readers[1], len(a["shingles"][p]))], Writer(fs, f"{at}/{name}", dtype))
                        yield _named((kind, int(p), name))

        files = self.spark.range(parts).repartition(parts).mapInArrow(merge, _NAMES).collect()
        out = {"n": a["n"] + b["n"], "suffixes": a["suffixes"] | b["suffixes"], "records": a["records"] | b["records"], "shingles": {p: a["shingles"].get(p, []) + b["shingles"].get(p, []) for p in {**a["shingles"], **b["shingles"]}}}
        for f in files:
            out[f.kind][str(f.part)] = f.name
        return out

    def _save(self, state: dict) -> None:
        fs, at = filesystem(self.path)
        target = f"{at}/state-{state['version']}.json"
        if fs.get_file_info(target).type != pafs.FileType.NotFound:
            raise RuntimeError("another load has been taken in meanwhile")
        with fs.open_output_stream(f"{target}.part") as f:
            f.write(json.dumps(state).encode())
        fs.move(f"{target}.part", target)

    def drop(self) -> None:
        """Deletes the history."""
        fs, at = filesystem(self.path)
        if fs.get_file_info(at).type == pafs.FileType.Directory:
            fs.delete_dir(at)

    def vacuum(self) -> int:
        """Deletes what the newest state doesn't name: merged and unfinished files, and older states. How many files that were."""
        fs, at = filesystem(self.path)
        state = self.state()
        named = {"order", f"state-{state['version']}.json"}
        for s in state["segments"]:
            named |= {*s["suffixes"].values(), *s["records"].values(), *(n for names in s["shingles"].values() for n in names)}
        gone = [f.path for f in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)) if f.base_name not in named]
        for f in gone:
            fs.delete_file(f)
        return len(gone)


_NAMES = "kind string, part int, name string"


def _named(*rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int32(), pa.string()))], names=["kind", "part", "name"])


def _by_part(batches, kind: np.dtype, most: int = ROWS_A_PARTITION):
    """(part, entries) of rows that come in order of parts, at most about `most` entries at a time."""
    part, held, n = None, [], 0
    for rb in batches:
        entries = _entries(rb, kind)
        for p, a, b in _runs(rb.column("part").to_numpy(zero_copy_only=False)):
            if held and (p != part or n >= most):
                yield part, np.concatenate(held)
                held, n = [], 0
            part = p
            held.append(entries[a:b])
            n += b - a
    if held:
        yield part, np.concatenate(held)


def _sets_of(fs, at: str, segments: list[dict], part: int, docs: np.ndarray) -> dict[int, np.ndarray]:
    """The shingles of records of one part of the ids."""
    out, p = {}, str(part)
    for s in segments:
        if p not in s["records"]:
            continue
        files: dict[int, object] = {}
        for entries in Reader(fs, f"{at}/{s['records'][p]}", _SET).found(docs):
            for e in entries:
                file = files.setdefault(int(e["file"]), None) or fs.open_input_file(f"{at}/{s['shingles'][p][int(e['file'])]}")
                files[int(e["file"])] = file
                out[int(e["doc"])] = np.frombuffer(file.read_at(int(e["n"]) * 8, int(e["at"])), np.uint64)
    return out


def _of_copies(copies: DataFrame, edges: DataFrame, rejected: DataFrame, index: DataFrame) -> DataFrame:
    """The pairs of exact copies: with their first record where that is accepted, and with every earlier accepted record similar to it."""
    with_first = copies.join(rejected.select(F.col("doc_id").alias("rep")), "rep", "left_anti").select("doc_id", F.col("rep").alias("other"))
    both = edges.unionByName(edges.select(F.col("other").alias("doc_id"), F.col("doc_id").alias("other"))).withColumnsRenamed({"doc_id": "rep"})
    near = both.join(rejected.select(F.col("doc_id").alias("other")), "other", "left_anti")
    when = index.select(F.col("doc_id").alias("other"), F.col("batch").alias("other_batch"))
    # what isn't in this load's index was accepted before
    with_near = copies.join(near, "rep").join(when, "other", "left").where(F.col("other_batch").isNull() | (F.struct("other_batch", "other") < F.struct("batch", "doc_id"))).select("doc_id", "other")
    return with_first.unionByName(with_near)
