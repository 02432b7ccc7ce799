"""Oversized texts cut into balanced pieces at natural boundaries.

The smallest number of pieces is computed from the limit and the overlap, that
many equal targets are placed, and each is moved to the strongest boundary
nearby: a blank line, else a line end, a sentence end, a clause end, a space,
else any place that doesn't part a character from its marks.  A cut is sought
only where its piece keeps the limit and the rest still fits into the pieces
left.  Where that leaves no good boundary, one piece is added and the targets of
the rest are placed anew; what is cut already stays, so the time is linear in the
length.  At most a twentieth of the least number of pieces is added (one at any
rate).

A piece begins exactly `overlap` characters before the previous one ends, so
the text is restored by dropping that many from every piece but the first.
Only rows over the limit leave the JVM; a text is scanned near its targets, not
as a whole; nothing is shuffled.

Defined results: null, empty and fitting texts give no rows; repeated rows give
repeated rows; a limit that isn't larger than the overlap is an error; other
columns of the input, whatever their names, are not read.  Characters are code
points.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From strong to weak. A cut is made at the end of the match.
BOUNDARIES = (
    ("blank_line", re.compile(r"\n[^\S\n]*\n\s*")),
    ("line", re.compile(r"\r?\n| | ")),
    ("sentence", re.compile(r"[.!?…。！？][\"'”’»)\]]*\s+")),
    ("clause", re.compile(r"[,;:–—|]\s+")),
    ("space", re.compile(r"\s+")),
)
#: How far from its target a cut may be, as a share of the piece.
REACH = 0.15
#: So large a share of the least number of pieces may be added, and one at any rate, so that cuts find boundaries.
SURPLUS = 0.05
#: Boundaries for which a better one is sought with one piece more.
WEAK = ("clause", "space", "none")
#: So many characters before its target are searched as long as there is slack, when no piece may be added any more.
FINE = 200


def _joined(before: str, after: str) -> bool:
    """Whether a cut between the two characters would part what belongs together."""
    return bool(unicodedata.combining(after)) or after in "‍︎️" or before == "‍" or (before == "\r" and after == "\n") or "\U0001f3fb" <= after <= "\U0001f3ff"


def snap(text: str, target: int, low: int, high: int) -> tuple[int, str]:
    """The strongest boundary from `low` to `high`, of equal ones the nearest to the target (the earlier of two)."""
    base = max(0, low - 2)
    window = text[base : high + 2]
    for name, pattern in BOUNDARIES:
        best = None
        for m in pattern.finditer(window):
            at = base + m.end()
            if low <= at <= high and at < len(text) and (best is None or abs(at - target) < abs(best - target)):
                best = at
        if best is not None:
            return best, name
    at = min(max(target, low), high)
    while at > low and _joined(text[at - 1], text[at]):
        at -= 1
    return at, "none"


def _least(n: int, limit: int, overlap: int) -> int:
    """How many pieces a stretch of n characters needs at least."""
    return max(1, -(-(n - overlap) // (limit - overlap)))


def cuts(text: str, limit: int, overlap: int, reach: float = REACH) -> list[tuple[int, int, str]]:
    """(start, end, boundary at the end) of the pieces of a text that is longer than the limit."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    n = len(text)
    if n <= limit:
        return [(0, n, "end")]
    gain = limit - overlap
    left = _least(n, limit, overlap)
    spare = max(1, int(left * SURPLUS))
    pieces, start, end = [], 0, 0
    while n - start > limit:
        # the rest in equal targets; `slack` characters may be lost by cuts before their targets
        rest = n - start - overlap
        left = max(left, _least(n - start, limit, overlap))
        while True:
            target = start + overlap + -(-rest // left)
            slack = left * gain - rest
            room = int(min(reach * (target - start), (target - start - overlap) / 3))
            low = max(target - room, n - (left - 1) * gain)
            if not spare:
                # no piece may be added any more: a cut takes about its share of the slack
                low = max(low, target - max(2 * slack // left, min(slack, FINE)))
            low = max(min(low, target), end + 1, start + overlap + 1)
            high = min(target + room, start + limit)
            at, name = snap(text, min(target, high), low, max(low, high))
            if spare and name in WEAK and low > target - room:
                # the limit of the rest stands in the way of a better boundary: one piece more, and the targets of the rest anew
                spare, left = spare - 1, left + 1
                continue
            break
        pieces.append((start, at, name))
        start, end, left = at - overlap, at, left - 1
    pieces.append((start, n, "end"))
    return pieces


def split_oversized(df: DataFrame, key: str, text: str, limit: Column | int, overlap: int = 200, with_text: bool = True) -> DataFrame:
    """One row a piece of every text over its limit: item_id, piece_no, n_pieces, start, end, boundary and piece_text."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), limit.cast("int").alias("l")).where(F.length("t") > F.col("l"))

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for i, (t, m) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                pieces = cuts(t, m, overlap)
                for no, (a, b, name) in enumerate(pieces):
                    for c, x in zip(out, (i, no, len(pieces), a, b, name, t[a:b] if with_text else None), strict=True):
                        c.append(x)
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
            cols = [batch.column(0).take(pa.array(out[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(out[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=["item_id", "piece_no", "n_pieces", "start", "end", "boundary", "piece_text"])

    return rows.mapInArrow(run, f"item_id {kind}, piece_no int, n_pieces int, start int, end int, boundary string, piece_text string")
