"""Language identification by a byte convolutional network.

Lower-cased UTF-8 bytes are cut into fixed-length windows that cover the whole text and overlap by the widest filter less
one. Filters of several widths slide over a window; each keeps its maximum, and a softmax layer maps the maxima to
languages. The network is trained here in numpy, on windows of labelled documents. As its input is one-hot, a filter is a
sum of table rows; for scoring, the rows of two adjacent bytes are added up beforehand.

Training data: of every value of lang about PER_LANGUAGE documents at most (fewer where so many languages would come to
more than ALL_LANGUAGES documents, but LEAST at least), chosen by a hash of the id, one row an id, and WINDOWS_EACH windows
of each. Everything else covers all rows and whole texts.

Defined cases: null text and text without letters are `und` with score 0; a null or repeated doc_id is scored like any
other; rows with a null lang or id are not learnt from; with nothing to learn from all rows are `und`; other columns are
not read by the scorer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umitally.llm.common import fold, held_out, slices, small_batches

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
PER_LANGUAGE, WINDOWS_EACH, ALL_LANGUAGES, LEAST = 1500, 3, 300_000, 20
UNKNOWN = "und"
_SIGN = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a sign is a letter; the pattern also finds raised digits, fractions and letter-like numbers."""
    return any(m[0].isalpha() for m in _SIGN.finditer(text or ""))


def _classes() -> np.ndarray:
    """Byte classes: padding 0, ASCII letters, one class each for digits, white space and signs, all bytes from 0x80."""
    to = np.full(256, 3, np.uint8)
    to[ord("0") : ord("9") + 1] = 1
    to[list(b" \t\n\r\x0b\x0c")] = 2
    to[ord("a") : ord("z") + 1] = np.arange(4, 30)
    to[ord("A") : ord("Z") + 1] = np.arange(4, 30)
    to[0x80:] = np.arange(30, 158)
    return to


CLASS_OF = _classes()
CLASSES = 158
STEP = WINDOW - max(WIDTHS) + 1


def windows(text: str) -> np.ndarray:
    """Classes of the text's bytes as rows of WINDOW, padded with 0; every run of the widest filter lies in a row."""
    data = CLASS_OF[np.frombuffer(text.lower().encode(), np.uint8)]
    n = max(1, -(-(len(data) - WINDOW + STEP) // STEP))
    flat = np.zeros((n - 1) * STEP + WINDOW, np.uint8)
    flat[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[::STEP]


@dataclass
class Network:
    languages: list[str]
    tables: dict[int, np.ndarray]  # width -> (width, classes, filters)
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def prepared(self) -> list[tuple[np.ndarray, ...]]:
        """For each width the summed rows of adjacent pairs, and the single rows of an odd width's last byte."""
        out = []
        for w, t in self.tables.items():
            pairs = [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(-1, t.shape[2]).astype(np.float32) for j in range(0, w - 1, 2)]
            out.append((w, pairs, t[w - 1].astype(np.float32) if w % 2 else None))
        return out

    def pooled(self, x: np.ndarray, tables=None) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * CLASSES + x[:, 1:]
        out = []
        for w, pairs, single in tables or self.prepared():
            span = x.shape[1] - w + 1
            total = np.take(pairs[0], pair[:, :span], axis=0)
            for k, p in enumerate(pairs[1:], 1):
                total += np.take(p, pair[:, 2 * k : 2 * k + span], axis=0)
            if single is not None:
                total += np.take(single, x[:, w - 1 : w - 1 + span], axis=0)
            out.append(total.max(axis=1))
        return np.concatenate(out, axis=1)

    def probabilities(self, x: np.ndarray, tables=None) -> np.ndarray:
        z = np.maximum(self.pooled(x, tables) + self.bias, 0) @ self.weights + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], *, epochs: int = 5, batch: int = 128, rate: float = 0.01, seed: int = 7) -> Network:
    """Minimise cross entropy by Adam. Only the place of each maximum has a gradient, so updates touch few table rows."""
    rng = np.random.default_rng(seed)
    k, n = len(languages), FILTERS
    net = Network(languages, {w: rng.normal(0, 0.3, (w, CLASSES, n)).astype(np.float32) for w in WIDTHS}, np.zeros(n * len(WIDTHS), np.float32), rng.normal(0, 0.1, (n * len(WIDTHS), k)).astype(np.float32), np.zeros(k, np.float32))
    params = [net.weights, net.offset, net.bias, *net.tables.values()]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    share = np.bincount(y, minlength=k)
    cost = (len(y) / np.maximum(share, 1) / k).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            take = order[at : at + batch]
            xb, yb = x[take], y[take]
            rows = np.arange(len(take))
            hs, places = [], []
            for w, table in net.tables.items():
                span = xb.shape[1] - w + 1
                total = table[0][xb[:, :span]]
                for j in range(1, w):
                    total = total + table[j][xb[:, j : j + span]]
                place = total.argmax(axis=1)
                places.append(place)
                hs.append(np.take_along_axis(total, place[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(hs, axis=1) + net.bias
            h = np.maximum(raw, 0)
            z = h @ net.weights + net.offset
            z = np.exp(z - z.max(axis=1, keepdims=True))
            p = z / z.sum(axis=1, keepdims=True)
            g = p.copy()
            g[rows, yb] -= 1
            g *= cost[yb][:, None] / len(take)
            gh = (g @ net.weights.T) * (raw > 0)
            grads = [h.T @ g, g.sum(axis=0), gh.sum(axis=0)]
            for i, (w, table) in enumerate(net.tables.items()):
                part, place = gh[:, i * n : (i + 1) * n], places[i]
                gt = np.zeros_like(table)
                for j in range(w):
                    at_class = xb[rows[:, None], place + j].astype(np.int64)
                    gt[j] = np.bincount((at_class * n + np.arange(n)).ravel(), part.ravel(), CLASSES * n).reshape(CLASSES, n)
                gt[:, 0] = 0
                grads.append(gt)
            t += 1
            for q, gq, mq, vq in zip(params, grads, m, v, strict=True):
                mq *= 0.9
                mq += 0.1 * gq
                vq *= 0.99
                vq += 0.01 * gq * gq
                q -= rate * (mq / (1 - 0.9**t)) / (np.sqrt(vq / (1 - 0.99**t)) + 1e-6)
    return net


def fit(docs: DataFrame, *, modulus: int = 4, remainder: int = 2, per_language: int = PER_LANGUAGE) -> Network | None:
    """Train on text and lang of rows whose fold is not `remainder`; None if there are none."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", modulus) != remainder))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language, as the model has
    if not counts:
        return None
    per_language = min(per_language, max(LEAST, ALL_LANGUAGES // len(counts)))
    share = docs.sparkSession.createDataFrame([(lang, min(1.0, per_language / n)) for lang, n in counts.items()], "lang string, share double")
    chosen = known.join(F.broadcast(share), "lang").where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1).cast("double") < F.col("share") * 2.0**63)
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        def some(t: str) -> list[bytes]:
            if not has_letter(t):
                return []
            w = windows(t)
            return [w[i].tobytes() for i in sorted({len(w) * i // WINDOWS_EACH for i in range(WINDOWS_EACH)})]

        return texts.map(some)

    got = chosen.select("lang", cut("text").alias("cut")).select("lang", F.explode("cut").alias("w")).toArrow()
    if not got.num_rows:
        return None
    languages = sorted(set(got["lang"].to_pylist()))
    rows = sorted(zip(got["lang"].to_pylist(), got["w"].to_pylist(), strict=True))  # task order must not change the result
    index = {lang: i for i, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([index[lang] for lang, _ in rows]), languages)


def score_texts(net: Network | None, texts: list[str | None], tables=None) -> list[tuple[str, float]]:
    """Language and its probability for each text: the mean over its windows, by the bytes they add."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    held = [i for i, t in enumerate(texts) if has_letter(t)] if net else []
    if not held:
        return out
    cut = [windows(texts[i]) for i in held]
    tables = tables or net.prepared()
    flat = np.concatenate(cut)
    p = np.concatenate([net.probabilities(flat[k : k + 128], tables) for k in range(0, len(flat), 128)])
    share = np.maximum((flat[:, :STEP] > 0).sum(axis=1), 1).astype(np.float64)
    first = np.cumsum([0, *map(len, cut)])[:-1]
    mean = np.add.reduceat(p * share[:, None], first) / np.add.reduceat(share, first)[:, None]
    for i, j, q in zip(held, mean.argmax(axis=1), mean.max(axis=1), strict=True):
        out[i] = (net.languages[j], float(min(1.0, q)))
    return out


def identify(docs: DataFrame, net: Network | None, *, columns: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs' columns (or those named) with lang_pred and score, which replace columns of those names: a narrow map.

    The network, some hundred KB whatever the corpus, goes to the tasks with the function.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*(F.col(f"`{c}`") for c in columns or docs.columns if c not in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.prepared() if net else None
        for batch in slices(batches, "text", 2 << 20):
            found = score_texts(net, batch.column(batch.schema.get_field_index("text")).to_pylist(), tables)
            lang, score = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, *names])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]))


def predict(docs: DataFrame, *, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, by a network trained on the rows that are not held out."""
    net = fit(docs, modulus=modulus, remainder=remainder)
    return identify(docs, net, columns=["doc_id", "text"]).select("doc_id", held_out(modulus, remainder).alias("held_out"), "lang_pred", "score")
