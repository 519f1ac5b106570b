"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is prefixed with the dummy space, spaces become U+2581, and it is cut before every U+2581 that follows another
character. No piece of such a vocabulary holds U+2581 after another character (checked when a model is loaded), so no
merge crosses a cut and every segment can be encoded alone, once for all its occurrences.

All segments of a batch that are not known yet are merged together: one flat array of symbols, and in each round

* the rank of every adjacent pair (its merged piece's score) is looked up,
* the minimum rank of each segment is found by a segmented reduction,
* pairs at that minimum merge from left to right without overlap, in all segments at once, and
* the arrays are compacted, until no segment has a pair left.

The library merges one pair at a time, the leftmost of the best. Merging several at once gives the same result unless a
merge makes a pair at least as good as the one just used; such a merge ends its segment's round, so results are exact.

Defined cases: null text is empty; an empty text has only the begin and end ids; characters that are no piece become byte
pieces; control pieces written out in a text are ordinary text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umitally.llm.common import remember, slices, small_batches

SPACE = "▁"
#: Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Segments remembered by a Python worker before it starts afresh; about 130 MB.
CACHE = 600_000
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NONE = np.iinfo(np.int64).max


class PieceModel:
    """Tables of a SentencePiece BPE model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation are supported")
        kinds = [p.type for p in proto.pieces]
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("user-defined and unused pieces are not supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = kinds
        self.bos, self.eos, self.unk = (next(i for i, p in enumerate(self.pieces) if p == x) for x in (trainer.bos_piece, trainer.eos_piece, trainer.unk_piece))
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space after another character; segments would not be independent")
        self.byte_ids = np.full(256, -1, np.int64)
        for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)):
            if k == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
        scores = np.array([p.score for p in proto.pieces])
        order = np.unique(-scores)  # equal scores share a rank; then the leftmost pair goes first
        self.rank = np.searchsorted(order, -scores)
        # Symbols that are no piece (rare characters) get ids from here on; they never merge.
        self.size = len(self.pieces)
        left, right, to = [], [], []
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), to.append(i)
        key = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        by = np.argsort(key)
        self._build(key[by], np.array(to, np.int64)[by])
        self.surface = [p.replace(SPACE, " ").encode() if k == NORMAL else b"" for p, k in zip(self.pieces, kinds, strict=True)]
        self.surface[self.unk] = trainer.unk_surface.encode()
        self.byte_of = {int(self.byte_ids[b]): b for b in range(256)}
        self.known: dict[str, bytes] = {}

    def _build(self, keys: np.ndarray, to: np.ndarray) -> None:
        """An open-addressed table from pair to merged piece; a fixed number of vectorised probes finds any pair."""
        bits = max(4, int(np.ceil(np.log2(len(keys) * 4 + 1))))
        self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int64)
        at, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            free = self.slots[at] < 0
            where, who = at[free], left[free]
            where, first = np.unique(where, return_index=True)
            who = who[first]
            self.slots[where], self.values[where] = keys[who], to[who]
            rest = np.setdiff1d(np.arange(len(left)), np.flatnonzero(free)[first])
            at, left = (at[rest] + 1) & mask, left[rest]
            self.probes += 1
        self.mask = mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        keys = np.where((a < self.size) & (b < self.size), a * self.size + b, -2)
        at = self._slot(keys)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            slot = self.slots[at]
            hit = slot == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            go = ~hit & (slot >= 0)
            open_, at = open_[go], (at[go] + 1) & self.mask
            if not len(open_):
                break
        return out

    def _ranks(self, to: np.ndarray) -> np.ndarray:
        return np.where(to >= 0, self.rank[to], _NONE)

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat symbols once nothing merges, and each segment's bounds among them.

        A symbol is a piece id, or size + code point for a character that is no piece. Segments are not empty.
        """
        text = "".join(segments)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        chars, back = np.unique(points, return_inverse=True)
        sym = np.array([self.ids.get(chr(c), self.size + int(c)) for c in chars], np.int64)[back]
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        seg = np.repeat(np.arange(len(segments)), lengths)
        done_sym, done_seg = [], []
        to = np.append(self.merged(sym[:-1], sym[1:]), -1)
        to[np.append(seg[1:] != seg[:-1], True)] = -1
        while len(sym):
            rank = self._ranks(to)
            first = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            live = np.repeat(best < _NONE, size)
            if not live.all():  # finished segments leave
                done_sym.append(sym[~live]), done_seg.append(seg[~live])
                sym, seg, to, rank = sym[live], seg[live], to[live], rank[live]
                size, best = size[best < _NONE], best[best < _NONE]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = self._apart(at)
            new = to[at]
            # A merge whose new pairs are at least as good as its own rank is the last of its segment in this round.
            same = seg[at]
            before = np.append(-1, at[:-1])
            left_merged = np.append(False, (at[1:] - at[:-1] == 2) & (same[1:] == same[:-1]))
            left = np.where(left_merged, to[before], sym[np.maximum(at - 1, 0)])
            has_left = (at > 0) & (seg[np.maximum(at - 1, 0)] == same)
            nxt = np.minimum(at + 2, len(sym) - 1)
            has_right = (at + 2 < len(sym)) & (seg[nxt] == same)
            limit = rank[at]
            bad = np.zeros(len(at), bool)
            bad[has_left] = self._ranks(self.merged(left[has_left], new[has_left])) <= limit[has_left]
            bad[has_right] |= self._ranks(self.merged(new[has_right], sym[nxt[has_right]])) <= limit[has_right]
            if bad.any():
                runs = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
                earlier = np.cumsum(bad) - bad
                earlier -= np.repeat(earlier[runs], np.diff(np.append(runs, len(at))))
                at, new = at[earlier == 0], new[earlier == 0]
            sym[at] = new
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[at] = True
            sym, seg, to, touched = sym[keep], seg[keep], to[keep], touched[keep]
            again = touched.copy()
            again[:-1] |= touched[1:]
            again = np.flatnonzero(again)
            again = again[again < len(sym) - 1]
            to[again] = np.where(seg[again] == seg[again + 1], self.merged(sym[again], sym[again + 1]), -1)
            to[-1] = -1
        sym, seg = np.concatenate(done_sym), np.concatenate(done_seg)
        by = np.argsort(seg, kind="stable")
        return sym[by], np.append(0, np.cumsum(np.bincount(seg, minlength=len(segments))))

    @staticmethod
    def _apart(at: np.ndarray) -> np.ndarray:
        """Of ascending positions, those that a scan from the left takes if neighbours overlap: every second of each run."""
        start = np.append(True, np.diff(at) != 1)
        first = np.flatnonzero(start)
        index = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        return at[index % 2 == 0]

    def _with_bytes(self, symbols: np.ndarray) -> bytes:
        out: list[int] = []
        for s in symbols.tolist():
            out += [s] if s < self.size else [int(self.byte_ids[b]) for b in chr(s - self.size).encode()]
        return np.array(out, "<u4").tobytes()

    def learn(self, segments: set[str]) -> None:
        new = list(segments.difference(self.known))
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(segments)
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            sym, bounds = self.merge(part)
            flat, at = sym.astype("<u4").tobytes(), (bounds * 4).tolist()
            self.known |= zip(part, [flat[x:y] for x, y in zip(at, at[1:], strict=False)], strict=True)
            rare = np.flatnonzero(sym >= self.size)
            for k in np.unique(np.searchsorted(bounds, rare, "right") - 1).tolist():
                self.known[part[k]] = self._with_bytes(sym[bounds[k] : bounds[k + 1]])

    def encode_bytes(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids with begin and end, as little-endian unsigned 32-bit integers."""
        begin, end = np.array([self.bos], "<u4").tobytes(), np.array([self.eos], "<u4").tobytes()
        cut = [_SEGMENT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn(set().union(*cut))
        get = self.known.__getitem__
        for parts in cut:
            yield begin + b"".join(map(get, parts)) + end

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """As the library: control ids vanish, the dummy prefix's space goes, bytes that are no UTF-8 become U+FFFD."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        out, run, start = [], bytearray(), True
        byte_of, surface, kinds = self.byte_of, self.surface, self.kinds
        if not byte_of.keys() & set(ids):
            ids = [i for i in ids if kinds[i] != CONTROL]
            text = b"".join([surface[i] for i in ids]).decode()
            return text[1:] if text[:1] == " " and ids and ids[0] != self.unk else text
        for i in ids:
            if (b := byte_of.get(i)) is not None:
                run.append(b)
                continue
            if run:
                out.append(_bytes_text(bytes(run)))
                run.clear()
                start = False
            if kinds[i] == CONTROL:
                continue
            piece = surface[i].decode()
            out.append(piece[1:] if start and piece[:1] == " " and kinds[i] == NORMAL else piece)
            start = False
        if run:
            out.append(_bytes_text(bytes(run)))
        return "".join(out)


def _bytes_text(run: bytes) -> str:
    """UTF-8 text of a run of byte pieces; every byte that starts no valid character is one U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                i += 1
        return "".join(out)


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a path, once for each Python worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    remember("pieces", _models[path].known.clear)
    return _models[path]


def encode_decode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Ids and the decoded text of every row, as digests, or (with_ids) as the arrays and texts themselves.

    A narrow map: no shuffle, and a batch holds about 1 MB of text. Other columns are neither read nor carried.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.col(text_col))
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in slices(batches, text_col, 1 << 20, owner="pieces"):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, a, b, every, decoded = [], [], [], [], []
            for ids in m.encode_bytes(texts):
                numbers = np.frombuffer(ids, "<u4")
                text = m.decode(numbers)
                n.append(len(numbers))
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(text.encode()).hexdigest())
                if with_ids:
                    every.append(numbers.astype(np.int32)), decoded.append(text)
            out = {id_col: batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}
            if with_ids:
                out |= {"ids": pa.array(every, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(run, schema)
