"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence scores log-odds z = b + sum of its words' weights; a
document is toxic if any sentence is (leaky noisy-or): p = 1 - (1 - leak) * prod(1 - sigmoid(z)).  The leak takes
up labels that no sentence explains, and sentences without a word that has a weight count as clean, so that
long clean texts don't gather score.  Weights are trained
from document labels alone, so the sentence scores, which locate what offends, come for free.

Features are words and their prefixes.  Words are case-folded runs of letters, digits and non-ASCII bytes; sentences end at . ! ? or a new
line.  Training is numpy gradient descent on a bounded sample (`max_docs` documents of at most
`max_chars` code points); scoring runs over whole texts in Arrow batches, with a fixed-size weight
table.  Null and empty texts have no sentence and score the leak alone.  Repeated rows are scored each alike; other columns
are ignored (scores) or carried along (filter).  An empty table gives an empty result; without labels nothing is toxic.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, NON_WORD, U, hash_spans, map_texts, rows_of, slices, text_bytes, word_spans
from .labelled import distinct_texts, held_out, training_rows

BITS = 18
#: Where a sentence's bias starts; chosen on a split inside the training rows (README).
START_BIAS = -5.0
PREFIXES = (6, 7, 8, 9)
#: Bytes that end a sentence.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    leak: float  # log-odds
    bias: float
    weights: np.ndarray


def sentences(data: np.ndarray, offsets: np.ndarray):
    """Feature buckets, the sentence of each, the row of each sentence, each sentence's first byte.

    A word gives itself and its prefixes of PREFIXES bytes, so inflected forms share what is learnt.
    """
    folded = LOWER[data]
    s, t, first = word_spans(folded, offsets, NON_WORD)
    if not len(s):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    ended = np.cumsum(ENDS[data], dtype=np.int64)[s]
    row = rows_of(first)
    new = np.ones(len(s), bool)
    new[1:] = (ended[1:] != ended[:-1]) | (row[1:] != row[:-1])
    number = np.cumsum(new) - 1
    buckets, sentence = [hash_spans(folded, s, t, 3)], [number]
    for k in PREFIXES:
        longer = t - s > k
        buckets.append(hash_spans(folded, s[longer], s[longer] + k, 100 + k))
        sentence.append(number[longer])
    return (np.concatenate(buckets) >> U(64 - BITS)).astype(np.int64), np.concatenate(sentence), row[new], s[new]


def _softplus(z):
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def train(buckets, sentence, doc, labels, rounds: int = 250, rate: float = 0.3, l1: float = 2e-4, least_z: float = 5.0, bias: float = START_BIAS) -> Model:
    """Fit the weights of words that toxic documents hold more often than chance (by `least_z` deviations)."""
    n_s, n_d = len(doc), len(labels)
    pairs = np.sort(doc[sentence].astype(np.int64) << BITS | buckets)
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    word, marks = pairs & ((1 << BITS) - 1), labels[pairs >> BITS] > 0
    seen, base = np.bincount(word, minlength=1 << BITS), max(labels.mean(), 1e-6)
    z = (np.bincount(word[marks], minlength=1 << BITS) - seen * base) / np.sqrt(np.maximum(seen, 1) * base * (1 - base) + 1e-9)
    del pairs, word, marks
    use = ((z >= least_z) & (seen >= 4))[buckets]
    buckets, sentence = buckets[use], sentence[use]
    ids, local = np.unique(buckets, return_inverse=True)
    # only sentences with a weighted word matter from here on
    known, sentence = np.unique(sentence, return_inverse=True)
    own, n_s = doc[known], len(known)
    w, b, c, y = np.zeros(len(ids)), bias, -3.5, labels.astype(float)
    gw, gb, gc = np.full(len(ids), 1e-10), 1e-10, 1e-10
    for _ in range(rounds):
        z = b + np.bincount(sentence, w[local], n_s)
        total = _softplus(c) + np.bincount(own, _softplus(z), n_d)
        clean = np.exp(-np.minimum(total, 50))
        # d loss / d total: 1 for a clean document, -clean / (1 - clean) for a toxic one
        slope = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-6), 1.0) / n_d
        dz = slope[own] / (1 + np.exp(-np.clip(z, -40, 40)))
        g, h, k = np.bincount(local, dz[sentence], len(ids)), dz.sum(), slope.sum() / (1 + np.exp(-c))
        gw += g * g
        gb += h * h
        gc += k * k
        step = rate / np.sqrt(gw)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - l1 * step, 0)
        b -= rate * h / np.sqrt(gb)
        c -= rate * k / np.sqrt(gc)
    weights = np.zeros(1 << BITS, np.float32)
    weights[ids] = w
    return Model(float(c), float(b), weights)


def bags(texts: pa.Array):
    """sentences() of many texts, extracted a few megabytes at a time: buckets, sentence of each, row of each sentence."""
    parts, n_s, n_d = [], 0, 0
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", 1 << 20):
        b, s, d, _ = sentences(*text_bytes(part.column("text")))
        parts.append((b.astype(np.int32), (s + n_s).astype(np.int32), (d + n_d).astype(np.int32)))
        n_s, n_d = n_s + len(d), n_d + part.num_rows
    return [np.concatenate([p[i] for p in parts]) for i in range(3)]


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 5000, max_chars: int = 20_000, n: int = 4, fold: int = 2) -> Model:
    """Train on a bounded sample of labelled documents outside the held-out fold."""
    rows = training_rows(docs, labels, "toxic", n, fold, max_docs, max_chars).toArrow()
    if not rows.num_rows:
        return Model(-6.0, -10.0, np.zeros(1 << BITS, np.float32))
    texts, label = distinct_texts(rows)
    return train(*bags(texts), label)


def score_rows(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Score, number of sentences, and start byte and score of the worst sentence of each row."""
    rows = len(offsets) - 1
    buckets, sentence, doc, at = sentences(data, offsets)
    known = np.zeros(len(doc), bool)
    known[sentence[model.weights[buckets] != 0]] = True
    z = np.where(known, model.bias + np.bincount(sentence, model.weights[buckets], len(doc)), -np.inf)
    total = _softplus(model.leak) + np.bincount(doc, _softplus(z), rows)
    count = np.bincount(doc, minlength=rows)
    order = np.lexsort((at, -z, doc))
    top = order[np.r_[True, np.diff(doc[order]) != 0]] if len(order) else order
    start, worst = np.full(rows, -1, np.int64), np.zeros(rows)
    start[doc[top]] = at[top] - offsets[doc[top]]
    worst[doc[top]] = 1 / (1 + np.exp(-z[top]))
    return 1 - np.exp(-total), count.astype(np.int64), start, worst


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns `keep`, score, n_sentences, and worst_start and worst_score: byte offset and score of the worst sentence."""
    kept = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return map_texts(docs, keep, partial(score_rows, model), f"{kept}, score double, n_sentences bigint, worst_start bigint, worst_score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of docs whose score is under the threshold, all columns kept."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                clean = score_rows(model, *text_bytes(part.column("text")))[0] < threshold
                if clean.any():
                    yield part.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted and where the worst sentence starts.

    Only text is scored; labels, lang, source and doc_id never enter a score.
    """
    scored = score(docs, fit(docs, labels, **bounds), ["doc_id"])
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_sentences", "worst_start", "worst_score")
