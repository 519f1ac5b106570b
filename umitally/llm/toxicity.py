"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its hashed words and word beginnings (so that
an inflected stem is known by its stem), and a document's is the noisy-or of its sentences: 1 - product(1 - p). Only
documents have labels; the gradient of the noisy-or tells sentences apart, so the trained weights also locate the sentences
that make a document toxic.

Training data: at most SAMPLE labelled documents (see labelled_sample); hash buckets that occur in fewer than LEAST of
them get no weight. Scoring covers every whole text.

Defined cases: null and empty texts have no sentence and score 0, as has every text if nothing was labelled; a null or
repeated doc_id is scored like any other; other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umitally.llm.common import held_out, labelled_sample, slices, small_batches, stable_hash

SAMPLE, BITS, LEAST = 6000, 18, 5
#: Lengths of the beginnings that are features beside the word.
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.7
#: Words and sentence ends; an apostrophe joins.
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)*|[.!?\n]+")
_ENDS = frozenset(".!?\n")
#: Words remembered by a Python worker before it starts afresh.
CACHE = 250_000
#: Sentences that begin within one block of so many words are one instance, so that a text of one-word exclamations has
#: no more chances to look toxic than prose of its length.
BLOCK = 8
#: The logit of a sentence without evidence. It is held: noisy-or adds up sentences, and a long clean text has hundreds.
PRIOR = -7.0


def buckets(words: list[str]) -> np.ndarray:
    return (stable_hash(words) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def features(word: str) -> list[str]:
    """The word and its beginnings, which are told from words by a mark."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


class _Cached(dict):
    """Weight of each word; infinity ends a sentence."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = np.inf if word[0] in _ENDS else float(self.weights[buckets(features(word))].sum())
        if len(self) >= CACHE:
            self.clear()
        self[word] = value
        return value


@dataclass
class SentenceModel:
    weights: np.ndarray
    bias: float

    def cache(self) -> _Cached:
        return _Cached(self.weights)

    def _instances(self, tokens: list[str], cached: _Cached) -> tuple[np.ndarray, np.ndarray]:
        """The token that each instance begins with, and the instance's probability."""
        w = np.fromiter(map(cached.__getitem__, tokens), np.float64, len(tokens))
        ends = np.isinf(w)
        words = np.flatnonzero(~ends)
        if not len(words):
            return words, np.zeros(0)
        at = np.cumsum(ends)[words]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        first = first[np.append(True, first[1:] // BLOCK != first[:-1] // BLOCK)]
        return words[first], _sigmoid(np.add.reduceat(w[words], first) + self.bias)

    def sentences(self, text: str, cached: _Cached) -> np.ndarray:
        """The probability of each instance: a sentence that has a word, with short ones that follow in its block."""
        return self._instances(_TOKEN.findall(text.lower()), cached)[1]

    def score(self, text: str, cached: _Cached) -> float:
        p = self.sentences(text, cached)
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0

    def locate(self, text: str, cached: _Cached, threshold: float = 0.5) -> list[tuple[int, int, float]]:
        """Begin, end and probability of the instances at or over threshold, in code points of the text.

        They are the instances that the score combines. If several make a text toxic but none reaches the threshold alone,
        the likeliest is given. Lower-casing keeps lengths but for the letter \u0130, which is taken for i here.
        """
        found = list(_TOKEN.finditer(text.replace("\u0130", "i").lower()))
        first, p = self._instances([m[0] for m in found], cached)
        last = [*(first[1:] - 1), len(found) - 1]
        spans = [(found[a].start(), found[b].end(), float(q)) for a, b, q in zip(first, last, p, strict=True)] if len(p) else []
        return [x for x in spans if x[2] >= threshold] or sorted(spans, key=lambda x: -x[2])[:1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[str], labels: np.ndarray, *, steps: int = 120, rate: float = 0.15, l1: float = 1.0) -> SentenceModel:
    """Full-batch Adam on the noisy-or likelihood with an L1 step in its metric.

    l1 is in documents: a word keeps weight 0 unless the documents that speak for it outweigh about so many.
    """
    flat, sentence_of, doc_of_sentence, words = array("i"), array("i"), array("i"), {}
    bounds, n_sentences = [0], 0
    for d, text in enumerate(texts):
        fresh, block, k = True, -1, 0
        for tok in _TOKEN.findall(text.lower()):
            if tok[0] in _ENDS:
                fresh = True
                continue
            if fresh and k // BLOCK != block:
                doc_of_sentence.append(d)
                n_sentences += 1
            if fresh:
                fresh, block = False, k // BLOCK
            k += 1
            flat.append(words.setdefault(tok, len(words)))
            sentence_of.append(n_sentences - 1)
        bounds.append(len(flat))
    weights = np.zeros(1 << BITS)
    if not n_sentences:
        return SentenceModel(weights, PRIOR)
    flat, sent, doc_of = (np.frombuffer(x, np.int32) for x in (flat, sentence_of, doc_of_sentence))
    starts, feature = array("i", [0]), []
    known, n_words = list(words), len(words)
    del words
    for at in range(0, n_words, 10_000):
        named = [features(x) for x in known[at : at + 10_000]]
        feature.append(buckets([f for fs in named for f in fs]).astype(np.int32))
        for fs in named:
            starts.append(starts[-1] + len(fs))
    del known
    feature, starts = np.concatenate(feature), np.frombuffer(starts, np.int32)
    documents = np.zeros(1 << BITS, np.int32)
    for x, y in zip(bounds, bounds[1:], strict=False):
        own = np.unique(flat[x:y])
        n = starts[own + 1] - starts[own]
        documents[np.unique(feature[np.repeat(starts[own] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())] if len(own) else own)] += 1
    often = documents >= LEAST
    used = np.flatnonzero(often)
    column = np.full(1 << BITS, -1, np.int32)
    column[used] = np.arange(len(used))
    # Words without a frequent feature have no part in the sums.
    word_of = np.repeat(np.arange(n_words, dtype=np.int32), np.diff(starts))[often[feature]]
    feature = column[feature[often[feature]]]
    live = np.bincount(word_of, minlength=n_words) > 0
    sent, flat = sent[live[flat]], flat[live[flat]]
    w, b = np.zeros(len(used)), PRIOR
    y = labels.astype(float)
    cost = np.where(y == 1, min(30.0, 3 * len(y) / max(1.0, 2 * y.sum())), 1.0) / len(y)
    m, v = np.zeros(len(used)), np.zeros(len(used))
    for t in range(1, steps + 1):
        z = np.bincount(sent, np.bincount(word_of, w[feature], n_words)[flat], n_sentences) + b
        p = _sigmoid(z)
        clean = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), len(texts))  # log of the chance that no sentence is toxic
        doc = -np.expm1(clean)
        # d loss / d z_s: (p_s) for clean documents, -p_s * (1 - doc) / doc for toxic ones
        factor = np.where(y == 1, -np.exp(clean) / np.maximum(doc, 1e-9), 1.0) * cost
        g = factor[doc_of] * p
        gw = np.bincount(feature, np.bincount(flat, g[sent], n_words)[word_of], len(used))
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        step = rate / (np.sqrt(v / (1 - 0.99**t)) + 1e-5)
        w = w - step * m / (1 - 0.9**t)
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1 / len(y), 0)
    weights[used] = w
    return SentenceModel(weights.astype(np.float32), float(b))


def fit(docs: DataFrame, labels: DataFrame, *, modulus: int = 3, remainder: int = 1, limit: int = SAMPLE) -> SentenceModel | None:
    rows = labelled_sample(docs, labels, "toxic", modulus=modulus, remainder=remainder, limit=limit, columns=["text"])
    return train(rows["text"].to_pylist(), rows["_label"].to_numpy()) if rows.num_rows else None


def score(docs: DataFrame, model: SentenceModel | None, *, locate: bool = False, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every row, and (locate) the offending sentences of rows at or over threshold.

    A narrow map; the model is 1 MB whatever the corpus.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double, predicted int" + (", offending array<struct<start:int,end:int,p:double,sentence:string>>" if locate else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = model.cache() if model else None
        for batch in slices(batches, "text"):
            texts = batch.column(1).to_pylist()
            s = np.array([model.score(t, cached) if t and model else 0.0 for t in texts])
            out = {"doc_id": batch.column(0), "score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}
            if locate:
                spans = [[{"start": a, "end": b, "p": p, "sentence": t[a:b]} for a, b, p in model.locate(t, cached)] if x >= threshold else [] for t, x in zip(texts, s, strict=True)]
                out["offending"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64()), ("sentence", pa.string())])))
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame, *, modulus: int = 3, remainder: int = 1, locate: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted (and offending) of every row, by a model trained on rows not held out."""
    scored = score(docs, fit(docs, labels, modulus=modulus, remainder=remainder), locate=locate)
    return scored.select("doc_id", held_out(modulus, remainder).alias("held_out"), *scored.columns[1:])
