"""Document quality by a factorisation machine.

A document is a sparse vector of three kinds of features: hashed words (each distinct word once, the vector scaled to unit
length), structure statistics of the text (shares of signs, capitals, digits, short and repeated lines, repeated words,
lengths) in coarse steps, and metadata (whether the stored length agrees with the text's). The score is

    sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

whose pairs are summed in linear time as half of |sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2.

Training data: at most SAMPLE labelled documents (see labelled_sample). Scoring covers every whole text.

Defined cases: null text is empty, and an empty text is scored by its structure alone; without labelled rows every score
is 0.5; a null or repeated doc_id is scored like any other; n_chars may be absent or null; lang, source and doc_id are
not inputs; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umitally.llm.common import held_out, labelled_sample, slices, small_batches, stable_hash, unused

SAMPLE, BITS, RANK = 4000, 17, 6
THRESHOLD = 0.7
CACHE = 150_000
#: Steps of each structure statistic; a value's feature is the number of steps that it reaches.
SHARES = (0.005, 0.01, 0.02, 0.04, 0.07, 0.11, 0.16, 0.22, 0.3, 0.4, 0.55, 0.75)
LENGTHS = (1, 5, 10, 20, 40, 80, 160, 320, 640, 1280, 2560, 5120, 10240)
_WORD = re.compile(r"[^\W_]+")
#: Classes of ASCII characters; anything else counts as a small letter (as most other letters of Latin scripts do).
_KIND = np.full(256, 0, np.uint8)
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 4
_KIND[[ord(c) for c in ".,"]] = 5
_KIND[[ord(c) for c in "|"]] = 6
_KIND[[ord(c) for c in "!?"]] = 7
_KIND[[ord(c) for c in "#$%&*@<>{}=\\^~"]] = 8


def statistics(text: str, words: list[str], n_chars: int | None) -> list[tuple[float, tuple]]:
    """Structure statistics and metadata of a text with the steps that they are told in."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n, k = max(1, len(raw)), max(1, len(words))
    share = np.bincount(_KIND[raw], minlength=9) / n
    lines = [x for x in text.split("\n") if x.strip()]
    last = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        *((s, SHARES) for s in share[1:]),
        (len(words), LENGTHS),
        (len(raw) / k, (2, 4, 5, 6, 7, 8, 10, 13, 20)),
        (len(set(words)) / k, (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)),
        (last / k, SHARES),
        (1 - len(set(lines)) / max(1, len(lines)), SHARES),
        (k / max(1, len(lines)), LENGTHS),
        (0 if n_chars is None else 1 + (n_chars != len(text)), (1, 2)),
    ]


N_STATISTICS = 15
STRIDE = 16  # features of a statistic


class _Cached(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = int(stable_hash([word])[0] & np.uint64((1 << BITS) - 1))
        return value


SIZE = (1 << BITS) + N_STATISTICS * STRIDE


def vectors(texts: list[str | None], lengths: list[int | None], cached: _Cached) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, their values and the first entry of each document; every document has N_STATISTICS or more."""
    ids, values, first, at = [], [], [], 0
    for text, n in zip(texts, lengths, strict=True):
        text = text or ""
        words = _WORD.findall(text.lower())
        own = np.fromiter({cached[w] for w in set(words)}, np.int64)
        own.sort()
        stats = [(1 << BITS) + j * STRIDE + int(np.searchsorted(steps, v, "right")) for j, (v, steps) in enumerate(statistics(text, words, n))]
        ids += [own, np.array(stats)]
        values += [np.full(len(own), 1 / np.sqrt(max(1, len(own)))), np.full(len(stats), 0.5)]
        first.append(at)
        at += len(own) + len(stats)
    return np.concatenate(ids), np.concatenate(values), np.array(first)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, ids: np.ndarray, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        vx = self.factors[ids] * x[:, None]
        total = np.add.reduceat(vx, first)
        squares = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), first)
        return self.bias + np.add.reduceat(self.linear[ids] * x, first) + 0.5 * ((total * total).sum(axis=1) - squares)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(ids: np.ndarray, x: np.ndarray, first: np.ndarray, y: np.ndarray, *, epochs: int = 12, batch: int = 64, rate: float = 0.08, decay: float = 0.02, seed: int = 5) -> FactorisationMachine:
    """AdaGrad on the logistic loss over shuffled batches; decay pulls words towards 0 and statistics a tenth as much."""
    rng = np.random.default_rng(seed)
    fm = FactorisationMachine(0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, RANK)))
    gl, gf, gb = np.full(SIZE, 1e-2), np.full((SIZE, RANK), 1e-2), 1e-2
    ends = np.append(first[1:], len(ids))
    size = ends - first
    pull = np.where(np.arange(SIZE) < 1 << BITS, decay, decay / 10)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            take = order[k : k + batch]
            n = size[take]
            start = np.append(0, np.cumsum(n)[:-1])
            pick = np.repeat(first[take] - start, n) + np.arange(n.sum())
            i, v = ids[pick], x[pick]
            vx = fm.factors[i] * v[:, None]
            total = np.add.reduceat(vx, start)
            z = fm.bias + np.add.reduceat(fm.linear[i] * v, start) + 0.5 * ((total * total).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), start))
            g = (_sigmoid(z) - y[take]) / np.sqrt(len(take))
            gx = np.repeat(g, n) * v
            used, back = np.unique(i, return_inverse=True)
            dl = np.bincount(back, gx) + pull[used] * fm.linear[used] / np.sqrt(len(take))
            per = gx[:, None] * (np.repeat(total, n, axis=0) - vx)
            df = np.stack([np.bincount(back, per[:, r]) for r in range(RANK)], axis=1) + pull[used, None] * fm.factors[used] / np.sqrt(len(take))
            gl[used] += dl * dl
            gf[used] += df * df
            gb += g.sum() ** 2
            fm.linear[used] -= rate * dl / np.sqrt(gl[used])
            fm.factors[used] -= 0.3 * rate * df / np.sqrt(gf[used])
            fm.bias -= rate * g.sum() / np.sqrt(gb)
    return FactorisationMachine(fm.bias, fm.linear.astype(np.float32), fm.factors.astype(np.float32))


def _with_length(docs: DataFrame) -> F.Column:
    return (F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")).alias("n_chars")


def fit(docs: DataFrame, labels: DataFrame, *, modulus: int = 4, remainder: int = 2, limit: int = SAMPLE) -> FactorisationMachine | None:
    rows = labelled_sample(docs.select("doc_id", "text", _with_length(docs)), labels, "quality", modulus=modulus, remainder=remainder, limit=limit, columns=["text", "n_chars"])
    if not rows.num_rows:
        return None
    return train(*vectors(rows["text"].to_pylist(), rows["n_chars"].to_pylist(), _Cached()), rows["_label"].to_numpy().astype(float))


def score(docs: DataFrame, model: FactorisationMachine | None, *, columns: list[str] | None = None, name: str = "score") -> DataFrame:
    """docs' columns (or those named) with the score, which replaces a column of its name: a narrow map.

    The model is 4 MB whatever the corpus.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in columns or docs.columns if c != name]
    at = kept.index("text") if "text" in kept else len(kept)
    own_text, own_length = unused(docs, "_text", "_n_chars")
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), *([F.col("text").alias(own_text)] if at == len(kept) else []), _with_length(docs).alias(own_length))
    text_col, shared = rows.columns[at], docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm, cached = shared.value, _Cached()
        for batch in slices(batches, text_col, 2 << 20):
            texts, lengths = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            s = _sigmoid(fm.logits(*vectors(texts, lengths, cached))) if fm else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(s.astype(np.float64))], [*kept, name])

    return rows.mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.DoubleType())]))


def predict(docs: DataFrame, labels: DataFrame, *, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, by a model trained on rows not held out."""
    scored = score(docs, fit(docs, labels, modulus=modulus, remainder=remainder), columns=["doc_id"])
    return scored.select("doc_id", held_out(modulus, remainder).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
