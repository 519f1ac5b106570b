"""Packing of tokenised documents into fixed-length sequences: bounded-space online packing.

Each partition keeps OPEN windows. A document longer than a window gives whole windows first; what is left goes to the
open window that it fits best. When it fits none, the fullest window is emitted and a new one opened. At the end of a
partition the open windows are merged with one another (cutting pieces where they meet), so that at most one is not full,
and those single windows of many partitions are merged best-fit in groups of MERGE partitions.

Memory is OPEN windows a task, whatever the partition's size; what the merge groups by is bounded by MERGE windows.

Defined cases: null text is empty, and an empty text has the end id alone; an empty table gives no rows; rows that repeat
an id are packed each on its own; columns beside doc_id and text are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import compress
from operator import not_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umitally.llm.common import release, remember, slices, small_batches, write_table

WINDOW = 4096
#: Open windows of a partition.
OPEN = 64
#: Partitions whose last windows are merged together.
MERGE = 256
#: Pieces of text between white space that a Python worker remembers before it starts afresh, and words out of which new pieces
#: are put together.
CACHE, WORD_CACHE = 800_000, 100_000


class WordTokenizer:
    """Ids of a `tokenizers` file whose pre-tokenizer keeps matches of a pattern and whose words are encoded alone.

    Texts of Latin letters and common signs, where the pattern and the lower-casing mean the same here as in the library,
    are cut at white space, which no word spans; each different piece is cut into words once, and each different word is
    encoded by the library once. Any other text is encoded by the library as a whole.

    With added_tokens, the file's added tokens (as <|endoftext|>) get their own ids where a text holds them, as the library
    does by default; such texts are encoded as a whole. Else special ones are taken for ordinary signs.
    """

    #: Below U+0250 without U+0130, whose lower case is two characters, and without separators that the library takes for
    #: ordinary signs; general punctuation and currency signs.
    _PLAIN = re.compile("[\x00-\x1b\x20-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
    #: What the pattern below means for such texts; Python's \\w counts the fractions and raised digits as letters.
    _PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _WORD = re.compile(r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|'s|'t|'re|'ve|'m|'ll|'d|[\d\xb2\xb3\xb9\xbc-\xbe]|(?:[^\w\s]|_)+")

    def __init__(self, path: str, *, added_tokens: bool = False):
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added_tokens
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        self.by_word = splits[0]["pattern"].get("Regex") == self._PATTERN and steps == ["NFC", "Replace", "Lowercase"] and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and [x["type"] for x in splits] == ["Split", "ByteLevel"] and not splits[1]["add_prefix_space"]
        # Some are sought in the text as it is, others in its lower case; either is looked for without regard to case.
        self.added = {x.content.lower() for x in self.tok.get_added_tokens_decoder().values()} if added_tokens else set()
        self.by_word = self.by_word and not any(re.search(r"\s", x) for x in self.added)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.last = np.zeros(1 + max(self.tok.get_vocab().values()), bool)  # ids that end a word
        self.last[[i for x, i in self.tok.get_vocab().items() if suffix and x.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}  # by word
        self.pieces: dict[str, bytes] = {}  # by piece between white space

    def clear(self) -> None:
        self.known.clear()
        self.pieces.clear()

    def _learn(self, pieces: list[str]) -> None:
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        words = list(map(self._WORD.findall, pieces))
        new = list(set().union(*words).difference(self.known))
        for i in range(0, len(new), 1000):  # words apart by spaces stay apart; a call for each word would take twice as long
            part = new[i : i + 1000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):  # not a file whose words all end in the suffix
                e = self.tok.encode_batch([" ".join(part)], add_special_tokens=False)[0]
                ends = np.searchsorted(np.array(e.word_ids), np.arange(1, len(part) + 1))
            flat, at = ids.tobytes(), [0, *(ends * 4).tolist()]
            self.known |= zip(part, [flat[x:y] for x, y in zip(at, at[1:], strict=False)], strict=True)
        get = self.known.__getitem__
        self.pieces |= zip(pieces, [get(w[0]) if len(w) == 1 else b"".join(map(get, w)) for w in words], strict=True)

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, without special tokens."""
        cut: list[list[str] | None] = []
        for t in texts:
            raw, t = t, unicodedata.normalize("NFC", t)
            low = t.lower()
            plain = self.by_word and self._PLAIN.fullmatch(t) and not any(x in low for x in self.added)
            if plain and self.added and raw != t:  # a sign that joins the one before may hide a token
                low_raw = raw.lower()
                plain = not any(x in low_raw for x in self.added)
            cut.append(low if plain else None)
        rest = [t for t, c in zip(texts, cut, strict=True) if c is None]
        whole = iter(self.tok.encode_batch_fast(rest, add_special_tokens=False)) if rest else iter(())
        by_piece = iter(self._encode_plain([c for c in cut if c is not None]))
        return [np.array(next(whole).ids, "<u4").tobytes() if c is None else next(by_piece) for c in cut]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Each different piece of these texts is looked up once; the ids are gathered by piece numbers."""
        lists = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        pieces, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        found = list(map(self.pieces.get, pieces))
        new = list(compress(range(len(pieces)), map(not_, found)))
        if len(self.pieces) + len(new) > CACHE:
            self.clear()
            new = range(len(pieces))
        if len(new):
            self._learn([pieces[i] for i in new])
            for i in new:
                found[i] = self.pieces[pieces[i]]
        table, size = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        start, count = np.cumsum(size) - size, size[at]
        ends = np.cumsum(count)
        ids = table[np.repeat(start[at] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.append(0, ends)[lists.offsets.to_numpy()]
        return [ids[x:y].tobytes() for x, y in zip(bounds, bounds[1:], strict=False)]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path, added_tokens=True)
    remember("packing", _tokenizers[path].clear)
    return _tokenizers[path]


class Packer:
    """Windows of one partition. A piece is (id, start, ids as bytes, the document's tokens)."""

    def __init__(self, serial: int, window: int = WINDOW, keep: int = OPEN):
        self.window, self.keep, self.serial = window, keep, serial
        self.free: list[tuple[int, int]] = []  # (free places, window), ascending
        self.open: dict[int, list[tuple]] = {}
        self.opened = 0

    def _emit(self, pieces: list[tuple], full: bool = True) -> list[tuple]:
        out, offset = [], 0
        for id_, start, ids, total in pieces:
            n = len(ids) // 4
            out.append((id_, start, n, zlib.crc32(ids), total, self.serial, offset, full))
            offset += n
        self.serial += 1
        return out

    def add(self, id_, ids: bytes) -> Iterator[tuple]:
        total, start = len(ids) // 4, 0
        while total - start >= self.window:
            yield from self._emit([(id_, start, ids[start * 4 : (start + self.window) * 4], total)])
            start += self.window
        need = total - start
        if not need:
            return
        piece = (id_, start, ids[start * 4 :], total)
        at = bisect_left(self.free, (need, -1))
        if at < len(self.free):
            room, w = self.free.pop(at)
        else:
            if len(self.free) >= self.keep:
                yield from self._emit(self.open.pop(self.free.pop(0)[1]))
            room, w = self.window, self.opened
            self.opened += 1
            self.open[w] = []
        self.open[w].append(piece)
        if room > need:
            insort(self.free, (room - need, w))
        else:
            yield from self._emit(self.open.pop(w))

    def close(self) -> Iterator[tuple]:
        """Merge the open windows: pieces of the emptiest fill the fullest, cut where they meet; one may stay short."""
        queue = [piece for _, w in self.free for piece in self.open[w]]
        self.free.clear()
        self.open.clear()
        held, room = [], self.window
        for id_, start, ids, total in queue:
            while ids:
                part = ids[: room * 4]
                held.append((id_, start, part, total))
                room -= len(part) // 4
                start += len(part) // 4
                ids = ids[len(part) :]
                if not room:
                    yield from self._emit(held)
                    held, room = [], self.window
        if held:
            yield from self._emit(held, full=False)


_COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, encode: Callable[[], Callable[[list[str]], list[bytes]]], end_id: int, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep: int = OPEN) -> DataFrame:
    """Pieces of all documents: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    encode is called once in each task and gives a function from texts to their ids. The result of the one scan is written
    once (a few dozen bytes a piece), as full windows and last windows are treated differently.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.col(text_col))
    kind = rows.schema[id_col].dataType.simpleString()
    numbers = ", ".join(f"{c} bigint" for c in _COLUMNS)
    arrow = [*([pa.int64()] * len(_COLUMNS)), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids_of, end = TaskContext.get().partitionId(), encode(), np.array([end_id], "<u4").tobytes()
        packer, id_type = Packer(part << 36, window, keep), None

        def batch_of(out):
            cols = list(zip(*out, strict=True))
            data = {id_col: pa.array(cols[0], id_type)} | {n: pa.array(c, t) for n, c, t in zip([*_COLUMNS, "full"], cols[1:], arrow, strict=True)}
            return pa.RecordBatch.from_pydict(data | {"part": pa.array([part] * len(out), pa.int64())})

        release()  # what operators before have left in this worker
        for batch in slices(batches, text_col, 4 << 20, owner="packing"):
            id_type = batch.schema.field(0).type
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = []
            for id_, ids in zip(batch.column(0).to_pylist(), ids_of(texts), strict=True):
                out += packer.add(id_, ids + end)
            if out:
                yield batch_of(out)
        if out := list(packer.close()):
            yield batch_of(out)

    placed = write_table(rows.mapInArrow(run, f"`{id_col}` {kind}, {numbers}, full boolean, part bigint"))
    columns = [id_col, *_COLUMNS]
    full = placed.where("full").select(*columns)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """Whole windows of a group of partitions, largest first, each into the sequence that it fits best."""
        used = pdf.groupby("sequence_id")["length"].sum().reset_index().sort_values(["length", "sequence_id"], ascending=[False, True])
        free: list[tuple[int, int]] = []
        to, shift = {}, {}
        for seq, n in used.itertuples(index=False):
            at = bisect_left(free, (n, -1))
            room, target = free.pop(at) if at < len(free) else (window, seq)
            to[seq], shift[seq] = target, window - room
            insort(free, (room - n, target))
        pdf["offset"] += pdf["sequence_id"].map(shift)
        pdf["sequence_id"] = pdf["sequence_id"].map(to)
        return pdf[columns]

    last = placed.where("NOT full").withColumn("part", F.floor(F.col("part") / MERGE)).groupBy("part").applyInPandas(lambda pdf: merge(pdf), placed.select(*columns).schema)
    return full.unionByName(last)


def pack_words(docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep: int = OPEN) -> DataFrame:
    """pack() with a word tokenizer file."""
    return pack(docs, lambda: tokenizer(tokenizer_path).encode_bytes, end_id, id_col=id_col, text_col=text_col, window=window, keep=keep)
