"""Anchor search by edit distance over batches of reads.

Every start of every read is followed at once. Alignments jump from one error to the next: a table tells how far the anchor,
from each of its characters on, agrees with the read from each position on, so an alignment with k errors takes k + 1
lookups. At an error there are three ways on, in this order: a substitution, an insertion (a character of the read is
skipped), a deletion (one of the anchor is skipped). Alignments are visited depth first in that order, and of equally good
ones the first counts, which are the rules of the pattern search that this mode is defined by:

* An alignment uses an error only where anchor and read differ, or an insertion after the anchor's last character.
* The first character that is searched at all is not skipped, as a later start finds the same match without that.
* The joint search of both inner anchors takes the fewest errors in all, then the leftmost start, then the first alignment.
* The outer searches take the leftmost start that has an alignment at all, and there the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_FAR = 1 << 20
#: Reads times positions of one step.
CELLS = 200_000


class Follower:
    """Alignments of an anchor with the rows of a matrix of characters, of which row i begins at begin[i] and ends at end[i]."""

    def __init__(self, chars: np.ndarray, anchor: str, begin: np.ndarray, end: np.ndarray):
        rows, width = chars.shape
        self.begin = begin[:, None].astype(np.int32)
        self.m, self.end, self.rows = len(anchor), end[:, None].astype(np.int32), np.arange(rows)[:, None]
        # same[a, r, t]: how many characters from anchor[a] on agree with row r from t on.
        self.same = np.zeros((self.m + 1, rows, width + 1), np.int16)
        for a in range(self.m - 1, -1, -1):
            self.same[a, :, :width] = np.where(chars == ord(anchor[a]), self.same[a + 1, :, 1:] + 1, 0)

    def alignments(self, start: np.ndarray, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(errors, end position, whether there is one) of the alignments from start, in order; start is a matrix of
        positions, a row of it for each row."""
        start = start.astype(np.int32)

        def visit(errors: int, a: np.ndarray, t: np.ndarray, ok: np.ndarray):
            run = np.minimum(self.same[a, self.rows, t], np.maximum(self.end - t, 0))
            a, t = a + run, t + run
            done = a == self.m
            yield errors, t, ok & done
            if errors == limit:
                return
            more = t < self.end
            change, insert, delete = ok & ~done & more, ok & more & (t > self.begin), ok & ~done
            for on, da, dt in ((change, 1, 1), (insert, 0, 1), (delete, 1, 0)):
                if on.any():
                    yield from visit(errors + 1, np.where(on, a + da, 0), np.where(on, t + dt, 0), on)

        yield from visit(0, np.zeros_like(start), start, (start >= self.begin) & (start <= self.end))


def find_core(chars: np.ndarray, inner5: str, inner3: str, gap: int, limit: int) -> np.ndarray:
    """Rows (start, gap's start, end) of the best [inner5][gap][inner3] of each row, -1 where there is none. The gap holds
    no line feed."""
    n, width = chars.shape
    begin, end = np.zeros(n, np.int32), np.full(n, width, np.int32)
    at = np.broadcast_to(np.arange(width + 1, dtype=np.int32), (n, width + 1))
    # The fewest errors of inner3 from each position, and where the first alignment with so many ends.
    least, stop = np.full((n, width + 1), _FAR, np.int32), np.zeros((n, width + 1), np.int32)
    for errors, t, ok in Follower(chars, inner3, begin, end).alignments(at, limit):
        better = ok & (errors < least)
        least[better], stop[better] = errors, t[better]
    feeds = np.concatenate([np.zeros((n, 1), np.int32), np.cumsum(chars == 10, axis=1, dtype=np.int32)], axis=1)
    rows = np.arange(n)[:, None]
    best, middle, last = np.full((n, width + 1), _FAR, np.int32), np.zeros((n, width + 1), np.int32), np.zeros((n, width + 1), np.int32)
    for errors, t, ok in Follower(chars, inner5, begin, end).alignments(at, limit):
        q = np.minimum(t + gap, width)
        ok = ok & (t + gap <= width) & (feeds[rows, q] == feeds[rows, t])
        total = np.where(ok, errors + least[rows, q], _FAR)
        better = total < best
        best, middle, last = np.where(better, total, best), np.where(better, t, middle), np.where(better, stop[rows, q], last)
    p = best.argmin(axis=1)
    r = np.arange(n)
    found = np.stack([p, middle[r, p], last[r, p]], axis=1).astype(np.int64)
    return np.where((best[r, p] < _FAR)[:, None], found, -1)


def find_first(chars: np.ndarray, anchor: str, limit: int, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the first acceptable match of anchor within [begin, end) of each row, -1 where there is none."""
    n, width = chars.shape
    at = np.broadcast_to(np.arange(width + 1, dtype=np.int32), (n, width + 1))
    stop = np.full((n, width + 1), -1, np.int32)
    for _, t, ok in Follower(chars, anchor, begin, end).alignments(at, limit):
        new = ok & (stop < 0)
        stop[new] = t[new]
    p = (stop >= 0).argmax(axis=1)
    r = np.arange(n)
    hit = stop[r, p] >= 0
    return np.where(hit, p, -1), np.where(hit, stop[r, p], -1)
