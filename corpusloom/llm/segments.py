"""Sorted files of fixed-width entries in the shared folder, searched by a few reads at places.

A file holds entries in the order of their first field, in blocks, then the first
key of every block, then two numbers (entries, blocks).  A lookup of sorted keys
finds its blocks by binary search on those keys and reads these blocks only, so
what is read grows with the keys and not with the file.  Files are written once,
under a name of their own, and never changed: a task that runs again writes
another file, and only the names that finished tasks hand back count.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.fs as pafs

#: Entries a block, and blocks read at once at most.
BLOCK, READ_BLOCKS = 256, 2_048


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder named as Spark names it, and its path there."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def new_name(kind: str, part: int) -> str:
    return f"{kind}-{part}-{uuid.uuid4().hex}"


class Writer:
    """Takes entries in order and writes them as a sorted file."""

    def __init__(self, fs: pafs.FileSystem, path: str, kind: np.dtype):
        self.out, self.kind, self.n, self.held, self.first = fs.open_output_stream(path), kind, 0, np.empty(0, kind), []

    def add(self, entries: np.ndarray) -> None:
        self.held = np.concatenate([self.held, entries])
        whole = len(self.held) // BLOCK * BLOCK
        self._put(self.held[:whole])
        self.held = self.held[whole:]

    def _put(self, entries: np.ndarray) -> None:
        if len(entries):
            self.first.append(entries[self.kind.names[0]][::BLOCK].copy())
            self.out.write(entries.tobytes())
            self.n += len(entries)

    def close(self) -> int:
        self._put(self.held)
        first = np.concatenate(self.first) if self.first else np.empty(0, self.kind[0])
        self.out.write(first.tobytes() + np.array([self.n, len(first)], "<u8").tobytes())
        self.out.close()
        return self.n


class Reader:
    """A sorted file. `read`: how many bytes have been read from it so far."""

    def __init__(self, fs: pafs.FileSystem, path: str, kind: np.dtype):
        self.file, self.kind, self.read = fs.open_input_file(path), kind, 0
        size = self.file.size()
        self.n, blocks = (int(x) for x in np.frombuffer(self._at(16, size - 16), "<u8"))
        self.first = np.frombuffer(self._at(blocks * 8, size - 16 - blocks * 8), kind[0])

    def _at(self, n: int, offset: int) -> bytes:
        self.read += n
        return self.file.read_at(n, offset) if n else b""

    def blocks(self, a: int, b: int) -> np.ndarray:
        """The entries of blocks a to b - 1."""
        begin, end = min(self.n, a * BLOCK), min(self.n, b * BLOCK)
        return np.frombuffer(self._at((end - begin) * self.kind.itemsize, begin * self.kind.itemsize), self.kind)

    def found(self, keys: np.ndarray):
        """Yields the entries of sorted keys, in order, as many blocks at a time as are read at once."""
        if not len(keys) or not self.n:
            return
        low = np.maximum(np.searchsorted(self.first, keys, "left") - 1, 0)
        high = np.searchsorted(self.first, keys, "right")
        change = np.zeros(len(self.first) + 1, np.int64)
        np.add.at(change, low[high > low], 1)
        np.add.at(change, high[high > low], -1)
        wanted = np.flatnonzero(np.cumsum(change) > 0)
        for run in np.split(wanted, np.flatnonzero(np.diff(wanted) > 1) + 1):
            for a in range(0, len(run), READ_BLOCKS):
                own = run[a : a + READ_BLOCKS]
                entries = self.blocks(int(own[0]), int(own[-1]) + 1) if len(own) else np.empty(0, self.kind)
                at = np.searchsorted(keys, entries[self.kind.names[0]])
                at[at == len(keys)] = 0
                hit = entries[keys[at] == entries[self.kind.names[0]]]
                if len(hit):
                    yield hit

    def all(self):
        """Yields all entries, as many blocks at a time as are read at once."""
        for a in range(0, len(self.first), READ_BLOCKS):
            yield self.blocks(a, a + READ_BLOCKS)

    def bytes_at(self, n: int, offset: int) -> bytes:
        return self._at(n, offset)


def merged(sources: list, writer: Writer) -> int:
    """Merges iterators of entries, each in order, into one file; of each a bounded part is held."""
    key = writer.kind.names[0]
    held = [np.empty(0, writer.kind) for _ in sources]
    open_ = [True] * len(sources)
    while True:
        for i, s in enumerate(sources):
            while open_[i] and not len(held[i]):
                entries = next(s, None)
                if entries is None:
                    open_[i] = False
                else:
                    held[i] = entries
        ends = [h[key][-1] for h, o in zip(held, open_, strict=True) if o]
        if not ends and not any(map(len, held)):
            return writer.close()
        # what is at most the least of the last keys held can't be preceded by anything that isn't held yet
        bound = min(ends) if ends else None
        cut = [len(h) if bound is None else int(np.searchsorted(h[key], bound, "right")) for h in held]
        own = np.concatenate([h[:c] for h, c in zip(held, cut, strict=True)])
        writer.add(own[np.argsort(own[key], kind="stable")])
        held = [h[c:] for h, c in zip(held, cut, strict=True)]
