"""Approximate anchor search over batches of reads.

Hamming searches take all reads of one length as a matrix and compare the anchor at every position at once; the first
minimum is the leftmost best place. Edit-distance searches follow the alignments of all reads at once (see edits); anchors
that are patterns go through the regex package read by read.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from umitally.functions import edits
from umitally.plans.layout import ReadLayout

#: More than any count of mismatches that a search allows.
_FAR = np.int32(1 << 20)
#: Cells of one comparison matrix; longer batches are cut.
_CELLS = 4_000_000


def by_length(seqs: Iterable[str]) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of characters) for each length; ASCII reads as bytes, others as code points."""
    rows: dict[tuple[int, bool], list[int]] = {}
    seqs = list(seqs)
    for i, s in enumerate(seqs):
        rows.setdefault((len(s), s.isascii()), []).append(i)
    for (n, plain), all_rows in rows.items():
        step = max(1, _CELLS // max(1, n))
        for at in range(0, len(all_rows), step):
            part = all_rows[at : at + step]
            text = "".join([seqs[i] for i in part])
            data = np.frombuffer(text.encode("ascii"), np.uint8) if plain else np.frombuffer(text.encode("utf-32-le"), np.uint32)
            yield np.array(part), data.reshape(len(part), n)


def mismatches(chars: np.ndarray, anchor: str) -> np.ndarray:
    """Substitutions of anchor at every position of every row; no columns where the anchor is longer than the rows."""
    span = chars.shape[1] - len(anchor) + 1
    if span <= 0:
        return np.zeros((len(chars), 0), np.uint16)
    out = np.zeros((len(chars), span), np.uint16)
    for j, c in enumerate(anchor):
        out += chars[:, j : j + span] != ord(c)
    return out


def bounded_hamming(seqs: list[str], pattern: str, limit: int) -> np.ndarray:
    """Mismatches of the pattern at the start of each text, limit + 1 where they are more; null (-1) for shorter texts."""
    out = np.full(len(seqs), -1, np.int64)
    for rows, chars in by_length(seqs):
        m = mismatches(chars, pattern)
        if m.shape[1]:
            out[rows] = np.minimum(m[:, 0], limit + 1)
    return out


def find_core(chars: np.ndarray, inner5: str, inner3: str, gap: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, and errors of both anchors, of the best [inner5][gap][inner3]: least sum, then leftmost; -1 if there is none."""
    none = np.full(len(chars), -1, np.int64)
    span = chars.shape[1] - len(inner5) - gap - len(inner3) + 1
    if span <= 0:
        return none, none.copy(), none.copy()
    e5 = mismatches(chars, inner5)[:, :span].astype(np.int32)
    e3 = mismatches(chars, inner3)[:, len(inner5) + gap :][:, :span].astype(np.int32)
    total = np.where((e5 <= limit) & (e3 <= limit), e5 + e3, _FAR)
    at = total.argmin(axis=1)
    rows = np.arange(len(chars))
    hit = total[rows, at] < _FAR
    return np.where(hit, at, -1), np.where(hit, e5[rows, at], -1), np.where(hit, e3[rows, at], -1)


def find_anchor(chars: np.ndarray, anchor: str, limit: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Start of the best place of anchor within [begin, end) of each row: fewest errors, then leftmost; -1 if none fits."""
    m = mismatches(chars, anchor).astype(np.int32)
    if not m.shape[1] or not anchor:
        return np.full(len(chars), -1, np.int64)
    at = np.arange(m.shape[1])
    inside = (at >= begin[:, None]) & (at + len(anchor) <= end[:, None])
    m = np.where(inside & (m <= limit), m, _FAR)
    best = m.argmin(axis=1)
    return np.where(m[np.arange(len(chars)), best] < _FAR, best, -1)


def parse_hamming(seqs: list[str], layout: ReadLayout) -> np.ndarray:
    """Rows (umi5 start, inner5 start, barcode start, umi3 start, umi3 end); umi5 start is -1 for rejected reads."""
    out = np.full((len(seqs), 5), -1, np.int64)
    a, b, gap = len(layout.inner5), len(layout.inner3), layout.barcode_length
    for rows, chars in by_length(seqs):
        start, _, _ = find_core(chars, layout.inner5, layout.inner3, gap, layout.max_errors)
        core_end = start + a + gap + b
        ok = start >= 0
        begin, end = np.zeros(len(rows), np.int64), np.full(len(rows), chars.shape[1], np.int64)
        if layout.outer5:
            o = find_anchor(chars, layout.outer5, layout.max_errors, begin, np.where(ok, start, 0))
            ok &= o >= 0
            begin = o + len(layout.outer5)
        if layout.outer3:
            o = find_anchor(chars, layout.outer3, layout.max_errors, np.where(ok, core_end, chars.shape[1]), end)
            ok &= o >= 0
            end = o
        out[rows] = np.where(ok[:, None], np.stack([begin, start, start + a, core_end, end], axis=1), -1)
    return out


def parse_edit(seqs: list[str], layout: ReadLayout) -> np.ndarray:
    """Places as parse_hamming gives them, in the edit-distance model: both inner anchors in one best match, outer anchors by
    their first acceptable match. The leftmost match without errors is the best, so only reads without one are followed."""
    out = np.full((len(seqs), 5), -1, np.int64)
    a, b, gap, limit = len(layout.inner5), len(layout.inner3), layout.barcode_length, layout.max_errors
    for all_rows, all_chars in by_length(seqs):
        step = max(1, edits.CELLS // (all_chars.shape[1] + 1))
        for k in range(0, len(all_rows), step):
            rows, chars = all_rows[k : k + step], all_chars[k : k + step]
            at, _, _ = find_core(chars, layout.inner5, layout.inner3, gap, 0)
            exact = (at >= 0) & ~(chars == 10).any(axis=1)  # a barcode holds no line feed
            core = np.where(exact[:, None], at[:, None] + [0, a, a + gap + b], -1)
            core[~exact] = edits.find_core(chars[~exact], layout.inner5, layout.inner3, gap, limit)
            start, barcode, core_end = core.T
            n, ok = len(rows), start >= 0
            begin, end = np.zeros(n, np.int64), np.full(n, chars.shape[1], np.int64)
            if layout.outer5 and ok.any():
                first, last = edits.find_first(chars[ok], layout.outer5, limit, begin[ok], start[ok])
                begin[ok] = last
                ok[ok] = first >= 0
            if layout.outer3 and ok.any():
                first, _ = edits.find_first(chars[ok], layout.outer3, limit, core_end[ok], end[ok])
                end[ok] = first
                ok[ok] = first >= 0
            out[rows] = np.where(ok[:, None], np.stack([begin, start, barcode, core_end, end], axis=1), -1)
    return out


def parse_patterns(seqs: list[str], layout: ReadLayout) -> np.ndarray:
    """parse_edit for anchors that are pattern source, read by read through the regex package."""
    import regex

    fuzzy = lambda anchor: f"(?:{anchor}){{e<={layout.max_errors}}}"
    core = regex.compile(f"(?b){fuzzy(layout.inner5)}(?P<barcode>.{{{layout.barcode_length}}}){fuzzy(layout.inner3)}")
    outer5, outer3 = (regex.compile(fuzzy(x)) if x else None for x in (layout.outer5, layout.outer3))
    out = np.full((len(seqs), 5), -1, np.int64)
    for i, seq in enumerate(seqs):
        m = core.search(seq)
        before = m and outer5 and outer5.search(seq[: m.start()])
        after = m and outer3 and outer3.search(seq[m.end() :])
        if m and (before or not outer5) and (after or not outer3):
            out[i] = before.end() if before else 0, m.start(), m.start("barcode"), m.end(), m.end() + after.start() if after else len(seq)
    return out


def parse(seqs: list[str], layout: ReadLayout) -> np.ndarray:
    """Places as parse_hamming gives them, by the layout's mode and with its bounds on both UMIs applied."""
    if layout.mode == "hamming":
        out = parse_hamming(seqs, layout)
    else:
        out = parse_patterns(seqs, layout) if layout.regex_anchors else parse_edit(seqs, layout)
    most = layout.most_umi
    first, last = out[:, 1] - out[:, 0], out[:, 4] - out[:, 3]
    bad = (first < layout.min_umi) | (first > most) | (last < layout.min_umi) | (last > most)
    out[bad] = -1
    return out
