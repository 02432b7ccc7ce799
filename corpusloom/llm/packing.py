"""Texts laid into containers of a fixed number of tokens.

Sizes are counted with a public byte-level tokenizer whose rank file is a
parameter; worker processes load it once.  Only (key, size) is shuffled, into
shards of about `SHARD_ROWS` rows by a hash of key and size; a shard is sorted by
another hash and its rows stream through in chunks of that many, so neither a
hot key nor a large shard is ever held as a whole, and the layout is the same
however rows arrive (a task that runs again gives the same containers).  Each
chunk is packed on its own: a best-fit pass gives a first layout, then a
swap-based local search moves items, exchanges one for one and two for one
between underfull bins, over all pairs of sizes and all bins.  A step is taken
only when the sum of squared fills grows, and the search goes on until there is
none; bins that are emptied by it are gone.

A text larger than a container is the only one that is divided: into full
containers and a rest that is packed like any other.

Defined results: null and empty texts have no tokens and give no rows; repeated
rows are packed each; a size equal to the capacity fills a container; an empty
table gives an empty layout; other columns are not read.
"""

from __future__ import annotations

import base64
import math
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2_048
SHARD_ROWS = 50_000
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the word pattern that belongs to the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoder(ranks: str = RANKS):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(ranks).read_bytes().splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def token_counts(df: DataFrame, key: str, text: str, ranks: str = RANKS) -> DataFrame:
    """(item_id, n_tokens) of every row with a text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        encode = encoder(ranks).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t.encode("utf-8", "replace").decode())) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["item_id", "n_tokens"])

    return df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null and t <> ''").mapInArrow(run, f"item_id {kind}, n_tokens long")


class _Bins:
    """Bins of a chunk with the slots of the underfull ones: a slot is the room there would be if an item were taken out."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []

    def best_fit(self) -> None:
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for i in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            size = self.sizes[i]
            fits = mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    mask &= ~(1 << room)
                self.items[b].append(i)
            else:
                b, room = len(self.items), self.capacity
                self.items.append([i])
            left = room - size
            if b == len(self.room):
                self.room.append(left)
            self.room[b] = left
            if left:
                by_room[left].append(b)
                mask |= 1 << left

    def search(self) -> int:
        """Moves and exchanges between underfull bins until none makes the sum of squared fills grow; the number of steps."""
        steps, before = 0, -1
        while steps != before:
            before = steps
            self._index([b for b, room in enumerate(self.room) if room and self.items[b]])
            for b in sorted((b for b, room in enumerate(self.room) if room and self.items[b]), key=lambda b: (-self.room[b], b)):
                while self.items[b] and self._improve(b):
                    steps += 1
        return steps

    def _index(self, bins: list[int]) -> None:
        self.slots: list[dict[tuple[int, int], None]] = [{} for _ in range(self.capacity + 1)]
        self.mask = 0
        for b in bins:
            self._offer(b)

    def _slots_of(self, b: int):
        """The bin's room itself (item -1) and its room without one of its items of each size, as slots."""
        room = self.room[b]
        yield room, -1
        for size, i in {self.sizes[i]: i for i in self.items[b]}.items():
            yield room + size, i

    def _offer(self, b: int) -> None:
        if self.room[b] and self.items[b]:
            for slot, i in self._slots_of(b):
                self.slots[slot][b, i] = None
                self.mask |= 1 << slot

    def _withdraw(self, b: int) -> None:
        for slot, i in self._slots_of(b):
            if self.slots[slot].pop((b, i), 0) is None and not self.slots[slot]:
                self.mask &= ~(1 << slot)

    def _improve(self, a: int) -> bool:
        """One step that takes load out of bin a into a bin that becomes fuller than a was: items of a against an item there, or none.

        Items of one size are alike, so one or two of each size are offered: no bin has more than sqrt(2 x capacity) sizes.
        """
        sizes, room = self.sizes, self.room
        own = self.items[a]
        by_size: dict[int, list[int]] = {}
        for i in own:
            by_size.setdefault(sizes[i], []).append(i)
        offers = [(x, (i[0],)) for x, i in by_size.items()]
        offers += [(2 * x, (i[0], i[1])) for x, i in by_size.items() if len(i) > 1]
        distinct = list(by_size)
        offers += [(x + y, (by_size[x][0], by_size[y][0])) for k, x in enumerate(distinct) for y in distinct[k + 1 :]]
        for load, moved in sorted(offers, key=lambda o: -o[0]):
            # bin b, its item i gone, has `slot` room; the squares grow exactly if it ends up fuller than a was: slot - load < room of a
            rest = self.mask >> load & ((1 << room[a]) - 1)
            while rest:
                slot = load + (rest & -rest).bit_length() - 1
                rest &= rest - 1
                for b, i in self.slots[slot]:
                    gain = load - (sizes[i] if i >= 0 else 0)
                    if b != a and gain > 0:
                        self._withdraw(a)
                        self._withdraw(b)
                        self.items[a] = [x for x in own if x not in moved] + ([i] if i >= 0 else [])
                        self.items[b] = [x for x in self.items[b] if x != i] + list(moved)
                        room[a] += gain
                        room[b] -= gain
                        self._offer(b)
                        self._offer(a)
                        return True
        return False


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[int]:
    """The bin of each item; sizes between 1 and the capacity. Bins are numbered from 0 without gaps."""
    return packed(sizes, capacity)[0]


def packed(sizes: list[int], capacity: int = CAPACITY) -> tuple[list[int], int, int, int]:
    """The bin of each item, how many bins there were before and after the search, and its steps."""
    bins = _Bins(sizes, capacity)
    bins.best_fit()
    before = len(bins.items)
    steps = bins.search()
    out = [0] * len(sizes)
    used = [x for x in bins.items if x]
    for b, items in enumerate(used):
        for i in items:
            out[i] = b
    return out, before, len(used), steps


def _shards(df: DataFrame, key: str, text: str, ranks: str, shard_rows: int) -> DataFrame:
    """(item_id, n_tokens) in shards by a hash of both, each sorted by another: what stands where doesn't hang on how rows arrive."""
    shards = max(1, math.ceil(df.select(F.lit(1)).count() / shard_rows))
    sized = token_counts(df, key, text, ranks).where("n_tokens > 0").repartition(shards, "item_id", "n_tokens")
    return sized.sortWithinPartitions(F.xxhash64("item_id", "n_tokens", F.lit("order")), "item_id", "n_tokens")


def _chunked(batches, rows: int):
    """(ids, sizes) of every `rows` rows of a shard, in its order."""
    held: list[pa.RecordBatch] = []
    n = 0

    def columns():
        whole = pa.Table.from_batches(held).combine_chunks()
        return whole.column(0).combine_chunks(), whole.column(1).to_numpy()

    for batch in batches:
        while batch.num_rows:
            own = batch.slice(0, rows - n)
            held.append(own)
            n += own.num_rows
            batch = batch.slice(own.num_rows)
            if n == rows:
                yield columns()
                held, n = [], 0
    if n:
        yield columns()


def _pieces(tokens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece number, number of pieces, size) of what is packed: a row too large gives full containers and a rest."""
    full, rest = np.divmod(tokens, capacity)
    pieces = full + (rest > 0)
    row = np.repeat(np.arange(len(tokens)), pieces)
    no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return row, no, pieces[row], np.minimum(capacity, tokens[row] - no * capacity)


def containers(df: DataFrame, key: str, text: str, capacity: int = CAPACITY, ranks: str = RANKS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The layout: container_id, item_id, piece_no, n_pieces, token_start and n_tokens; each row stands in one container as a whole."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        ctx = TaskContext.get()
        first = (ctx.partitionId() if ctx else 0) << 40
        for ids, tokens in _chunked(batches, shard_rows):
            row, no, pieces, size = _pieces(tokens, capacity)
            bins = np.asarray(pack(size.tolist(), capacity), dtype=np.int64)
            cols = [pa.array(bins + first), ids.take(pa.array(row)), pa.array(no.astype(np.int32)), pa.array(pieces.astype(np.int32)), pa.array(no * capacity), pa.array(size)]
            yield pa.RecordBatch.from_arrays(cols, names=["container_id", "item_id", "piece_no", "n_pieces", "token_start", "n_tokens"])
            first += int(bins.max(initial=-1)) + 1

    return _shards(df, key, text, ranks, shard_rows).mapInArrow(run, f"container_id long, item_id {kind}, piece_no int, n_pieces int, token_start long, n_tokens long")


def search_effect(df: DataFrame, key: str, text: str, capacity: int = CAPACITY, ranks: str = RANKS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each chunk: items, tokens, containers by best fit, after the search, and the least number there can be; and the search's steps."""

    def run(batches):
        for _, tokens in _chunked(batches, shard_rows):
            size = _pieces(tokens, capacity)[3]
            _, before, after, steps = packed(size.tolist(), capacity)
            row = (len(size), int(size.sum()), before, after, -(-int(size.sum()) // capacity), steps)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names=["n_items", "n_tokens", "n_best_fit", "n_containers", "n_least", "n_steps"])

    return _shards(df, key, text, ranks, shard_rows).mapInArrow(run, "n_items long, n_tokens long, n_best_fit long, n_containers long, n_least long, n_steps long")
