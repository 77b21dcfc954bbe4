"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j).  The pairwise sum is computed in
linear time as half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features: the words (hashed; weight 1 / words of the text each), one bucket for each structure
statistic, and the text's length class as metadata.  Training is numpy (Adam) on a bounded sample
(`max_docs` documents of at most `max_chars` code points); scoring covers whole texts in Arrow
batches with fixed-size tables.  An empty or null text scores by its statistics alone.  Repeated rows are scored each alike,
other columns are ignored; an empty table gives an empty result, and without labels each score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, NON_WORD, map_texts, slices, sums, text_bytes
from .labelled import distinct_texts, held_out, training_rows
from .text_stats import structure, word_buckets

BITS, BUCKETS = 14, 12
UPPER, DIGIT = np.zeros(256, bool), np.zeros(256, bool)
UPPER[65:91] = True
DIGIT[48:58] = True
PUNCT = NON_WORD & ~np.array([chr(b).isspace() for b in range(256)])
STATS = ("chars a word", "symbols a word", "duplicate lines", "repeated words", "upper case", "digits", "punctuation", "length")
SIZE = (1 << BITS) + BUCKETS * len(STATS)


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray):
    """Word buckets, rows' first words, and a (rows, statistics) array of feature indices."""
    buckets, _, first = word_buckets(data, offsets, NON_WORD, BITS, LOWER)
    st = structure(data, offsets)
    size = np.maximum(offsets[1:] - offsets[:-1], 1)
    n = np.maximum(st["n_words"], 1)
    share = lambda mask: sums(mask[data].astype(np.int8), offsets) / size
    level = lambda x: np.ceil(np.log2(1 + 255 * np.clip(x, 0, 1)))  # noqa: E731  0 to 8
    values = [
        np.minimum(st["word_chars"] / n, 11), level(st["n_symbols"] / n), level(st["n_dup_lines"] / n * 4), np.round(10 * st["n_repeat_words"] / n),
        level(share(UPPER)), level(share(DIGIT)), level(share(PUNCT)), np.minimum(np.log2(1 + st["n_words"]), 11),
    ]
    own = np.stack(values, 1).astype(np.int64) if len(n) else np.zeros((0, len(STATS)), np.int64)
    return buckets, first, np.clip(own, 0, BUCKETS - 1) + (1 << BITS) + BUCKETS * np.arange(len(STATS))


def _forward(model: Model, buckets, first, own):
    n = np.maximum(np.diff(first), 1)
    y = model.bias + sums(model.linear[buckets], first) / n + model.linear[own].sum(1)
    factors = []
    for v in model.factors.T:
        s = sums(v[buckets], first) / n + v[own].sum(1)
        squares = sums(v[buckets] ** 2, first) / n**2 + (v[own] ** 2).sum(1)
        y = y + (s * s - squares) / 2
        factors.append(s)
    return y, factors


def _rows(buckets, first, rows):
    """Word buckets of some rows, and the first word of each."""
    n = np.diff(first)[rows]
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) + np.repeat(first[rows] - begin[:-1], n)
    return buckets[at], begin


def train(buckets, first, own, labels, rank: int = 4, epochs: int = 8, batch: int = 256, rate: float = 0.05, l2: float = 1e-4, seed: int = 5) -> Model:
    """Adam on batches of documents."""
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, rank)))
    moments = [[np.zeros(SIZE), np.zeros(SIZE)] for _ in range(rank + 1)] + [[0.0, 0.0]]
    t = 0

    def adam(i, g):
        m = moments[i]
        m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.99 * m[1] + 0.01 * g * g
        return rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-8)

    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(labels)), -(-len(labels) // batch)):
            t += 1
            word, begin = _rows(buckets, first, rows)
            stats, n = own[rows], np.maximum(np.diff(begin), 1)
            row = np.repeat(np.arange(len(rows)), np.diff(begin))
            y, s = _forward(model, word, begin, stats)
            d = (1 / (1 + np.exp(-np.clip(y, -40, 40))) - labels[rows]) / len(rows)
            share = (d / n)[row]
            pull = lambda per_word, per_row: np.bincount(word, per_word, SIZE) + np.bincount(stats.ravel(), per_row.ravel(), SIZE)  # noqa: E731, B023
            full = np.repeat(d[:, None], stats.shape[1], 1)
            model.bias -= adam(rank + 1, d.sum())
            model.linear -= adam(rank, pull(share, full) + l2 * model.linear)
            for f in range(rank):
                v = model.factors[:, f]
                g = pull(share * (s[f][row] - v[word] / n[row]), full * (s[f][:, None] - v[stats]))
                model.factors[:, f] = v - adam(f, g + l2 * v)
    return model


def sample_features(texts: pa.Array):
    """features() of many texts, extracted a few megabytes at a time."""
    parts = [features(*text_bytes(part.column("text"))) for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", 1 << 20)]
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])
    return np.concatenate([p[0].astype(np.int32) for p in parts]), first, np.concatenate([p[2] for p in parts])


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, max_chars: int = 20_000, n: int = 3, fold: int = 1) -> Model:
    """Train on a bounded sample of labelled documents outside the held-out fold."""
    rows = training_rows(docs, labels, "quality", n, fold, max_docs, max_chars).toArrow()
    if not rows.num_rows:
        return Model(0.0, np.zeros(SIZE), np.zeros((SIZE, 1)))
    texts, label = distinct_texts(rows)
    return train(*sample_features(texts), label.astype(float))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **bounds) -> DataFrame:
    """Per row of docs: doc_id, held_out, score (0 to 1) and predicted (score >= threshold)."""
    model = fit(docs, labels, **bounds)

    def fn(data, offsets):
        y, _ = _forward(model, *features(data, offsets))
        return (1 / (1 + np.exp(-np.clip(y, -40, 40))),)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_texts(docs, ["doc_id"], fn, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
