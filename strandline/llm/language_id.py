"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its byte bigrams and trigrams (within words, with a mark at
word ends, case-folded); a linear softmax over that mean gives the languages.  Embeddings and
softmax are trained by stochastic gradient descent in numpy on a bounded sample (at most `per_lang`
documents a language, `max_docs` in all, of at most `max_chars` code points each).  A temperature is fitted on a tenth of the sample kept aside.

Rejection is calibrated on texts that are none of the languages: those of languages left out of
training, a group at a time, and shuffled ones.  Two numbers tell them: the share of a text's grams that
training has seen, and the softmax's margin.  A logistic function of both gives the probability
that a text is in a known language; under 0.5 it is rejected.  The score is the softmax's best
probability times that one.

As mean and softmax are linear, scoring uses one folded table (embeddings times softmax), so a whole
text costs a few table reads a byte.  Null texts and texts without a letter are `und`, score 0, rejected.  Repeated rows are
scored each alike, other columns are ignored; an empty table gives an empty result, one without a lang `und` everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import map_texts, sums, text_bytes
from .labelled import distinct_texts, held_out, remainder

BITS, DIM = 15, 12
#: Least number of steps of gradient descent.
STEPS = 210
#: Parts of a language, by hash of doc_id, that a sample is taken from alike.
PARTS = 16
#: Letters stay (ASCII case-folded), bytes over 127 stay, all else becomes the word-end mark 0.
FOLD = np.array([b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 0 for b in range(256)], np.uint8)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (buckets, languages): embeddings times softmax
    bias: np.ndarray
    temperature: float
    seen: np.ndarray  # buckets that training met
    known: np.ndarray  # bias and weights of (share of grams seen, margin) in the log-odds of a known language


def grams(data: np.ndarray, offsets: np.ndarray):
    """Gram buckets and each row's first one."""
    rows = len(offsets) - 1
    x = np.zeros(len(data) + rows + 4, np.uint8)  # a mark after each row
    at = np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))
    x[at] = FOLD[data]
    begin = offsets + np.arange(rows + 1)
    m = int(begin[-1])
    w = x.astype(np.uint32)
    codes = w[:m] | (w[1 : m + 1] << 8)
    three = codes | (w[2 : m + 2] << 16)
    k, shift = np.uint32(0x9E3779B1), np.uint32(32 - BITS)
    two, three = (codes * k) >> shift, ((three + np.uint32(0x1000000)) * k) >> shift
    letter = x[:m] != 0
    return np.stack([two, three], 1)[letter].ravel().astype(np.int32), 2 * np.concatenate([[0], np.cumsum(letter)])[begin]


def _softmax(z):
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _train(buckets, first, labels, count: int, learn: np.ndarray, epochs: int, rate: float, batch: int, seed: int):
    """(table, bias) learnt from the rows `learn`."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    out, bias = np.zeros((DIM, count)), np.zeros(count)
    n = np.diff(first)
    epochs = max(epochs, -(-STEPS * batch // max(len(learn), 1)))  # small samples are gone through more often
    bags = {i: np.unique(buckets[first[i] : first[i + 1]], return_counts=True) for i in learn.tolist()}
    for epoch in range(epochs):
        learn = rng.permutation(learn)
        step = rate * (1 - epoch / epochs)
        for a in range(0, len(learn), batch):
            ids = learn[a : a + batch].tolist()
            h = np.array([(bags[i][1] / n[i]) @ emb[bags[i][0]] for i in ids])
            d = _softmax(h @ out + bias)
            d[np.arange(len(ids)), labels[ids]] -= 1
            back = d @ out.T
            out -= step / len(ids) * h.T @ d
            bias -= step / len(ids) * d.sum(0)
            for i, g in zip(ids, back):  # each document's own gradient
                emb[bags[i][0]] -= step * (bags[i][1] / n[i])[:, None] * g
    return (emb @ out).astype(np.float32), bias


def _logits(table, bias, buckets, first):
    n = np.maximum(np.diff(first), 1)
    return np.stack([sums(np.ascontiguousarray(c)[buckets], first) / n for c in table.T], 1) + bias


def _signs(z: np.ndarray, seen: np.ndarray, buckets, first):
    """What tells a known language: the share of grams seen, in log-odds, and the margin of the best language."""
    n = np.diff(first)
    share = (sums(seen[buckets].astype(np.int8), first) + 0.5) / (n + 1)
    top = np.sort(z, 1)
    margin = top[:, -1] - top[:, -2] if z.shape[1] > 1 else np.zeros(len(z))
    return np.stack([np.ones(len(z)), np.log(share / (1 - share)), margin], 1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression with classes of equal total weight, by Newton's method with a ridge."""
    weight = np.where(y, 0.5 / max(y.sum(), 1), 0.5 / max((~y).sum(), 1)) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (weight * (y - p)) - 0.1 * w)
    return w


def _salad(data: np.ndarray, offsets: np.ndarray, seed: int = 9):
    """The rows with their letters shuffled among each other, separators left in place."""
    rng = np.random.default_rng(seed)
    out = data.copy()
    for a, b in zip(offsets, offsets[1:]):
        at = a + np.flatnonzero(FOLD[data[a:b]])
        out[at] = data[rng.permutation(at)]
    return out, offsets


def _foreign(data: np.ndarray, offsets: np.ndarray, seed: int = 10):
    """The rows with their bytes of letters replaced by random ones over 127, as in a script never met."""
    rng = np.random.default_rng(seed)
    out = data.copy()
    at = np.flatnonzero(FOLD[data])
    out[at] = rng.integers(128, 256, len(at))
    return out, offsets


def train(data, offsets, labels, langs, epochs: int = 6, rate: float = 2.0, batch: int = 64, seed: int = 3, groups: int = 4) -> Model:
    buckets, first = grams(data, offsets)
    n = np.diff(first)
    order = np.random.default_rng(seed).permutation(np.flatnonzero(n > 0))
    kept, learn = np.sort(order[: len(order) // 10]), np.sort(order[len(order) // 10 :])
    args = (epochs, rate, batch, seed)

    def met(rows):
        seen = np.zeros(1 << BITS, bool)
        for i in rows.tolist():
            seen[buckets[first[i] : first[i + 1]]] = True
        return seen

    def part(rows):
        lengths = np.diff(offsets)[rows]
        o = np.concatenate([[0], np.cumsum(lengths)])
        return data[np.arange(o[-1]) + np.repeat(offsets[rows] - o[:-1], lengths)], o

    table, bias = _train(buckets, first, labels, len(langs), learn, *args)
    seen = met(learn)
    z = _logits(table, bias, *grams(*part(kept)))
    temperature = 1.0
    if len(kept):
        choices = np.geomspace(0.02, 4, 30)
        loss = [-np.log(_softmax(z / t)[np.arange(len(kept)), labels[kept]] + 1e-12).mean() for t in choices]
        temperature = float(choices[int(np.argmin(loss))])
    # texts of known languages: those kept aside; of none: shuffled ones, another script, and languages left out, with models of the others
    yes = [_signs(z, seen, *grams(*part(kept)))]
    no = []
    for negative in (_salad, _foreign):
        g = grams(*negative(*part(kept)))
        no.append(_signs(_logits(table, bias, *g), seen, *g))
    if len(langs) > 2:
        for group in np.array_split(np.arange(len(langs)), min(groups, len(langs))):
            away = np.isin(labels, group)
            others = learn[~away[learn]]
            if len(group) > len(langs) - 2 or not len(others):
                continue
            left = np.setdiff1d(np.arange(len(langs)), group)
            own = np.zeros(len(langs), np.int64)
            own[left] = np.arange(len(left))
            less, less_bias = _train(buckets, first, own[labels], len(left), others, *args)
            seen_less = met(others)
            for rows, to in ((kept[away[kept]], no), (kept[~away[kept]], yes)):
                g = grams(*part(rows))
                to.append(_signs(_logits(less, less_bias, *g), seen_less, *g))
    x, y = np.concatenate(yes + no), np.repeat([True, False], [sum(map(len, yes)), sum(map(len, no))])
    known = _logistic(x, y) if y.any() else np.array([10.0, 0.0, 0.0])
    return Model(langs, table, bias, temperature, seen, known)


def fit(docs: DataFrame, per_lang: int = 600, max_docs: int = 2500, max_chars: int = 20_000, n: int = 4, fold: int = 2) -> Model:
    """Train on at most per_lang documents of each language and max_docs in all, outside the fold; equal texts count once.

    Within a language documents are chosen by hash of doc_id; where languages are so many that
    max_docs doesn't hold per_lang of each, each loses its last ones first.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= max_chars) & (remainder(n) != fold))
    ranked = usable.select("doc_id", "lang").withColumn("h", F.xxhash64("doc_id"))
    # the least hashes of each of PARTS parts of a language, so that no task sorts a whole language
    least = lambda df, n, *by: df.withColumn("i", F.row_number().over(Window.partitionBy("lang", *by).orderBy("h", "doc_id"))).where(F.col("i") <= n)
    few = least(ranked.withColumn("part", F.pmod("h", F.lit(PARTS))), -(-per_lang // PARTS), "part").dropDuplicates(["doc_id", "lang"])
    chosen = least(few, per_lang).orderBy("i", "h").limit(max_docs).select("doc_id", "lang")
    rows = usable.select("doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).orderBy("doc_id").toArrow()
    if not rows.num_rows:
        return Model(["und"], np.zeros((1 << BITS, 1), np.float32), np.zeros(1), 1.0, np.zeros(1 << BITS, bool), np.array([-10.0, 0.0, 0.0]))
    texts, names = distinct_texts(rows.append_column("label", rows.column("lang")))
    langs, labels = np.unique(names.astype(str), return_inverse=True)
    return train(*text_bytes(texts), labels, langs.tolist())


def language(docs: DataFrame, **bounds) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score, and rejected (likelier in none of the languages)."""
    model = fit(docs, **bounds)

    def fn(data, offsets):
        buckets, first = grams(data, offsets)
        z = _logits(model.table, model.bias, buckets, first)
        p = _softmax(z / model.temperature)
        known = 1 / (1 + np.exp(-np.clip(_signs(z, model.seen, buckets, first) @ model.known, -30, 30)))
        return pa.array(np.array(model.langs, object)[p.argmax(1)], pa.string()), p.max(1) * known, known < 0.5

    kind = docs.schema["doc_id"].dataType.simpleString()
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    df = docs.select("doc_id", "text", letter.alias("has_letter"))
    scored = map_texts(df, ["doc_id", "has_letter"], fn, f"doc_id {kind}, has_letter boolean, lang string, p double, away boolean")
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"),
        F.when(F.col("has_letter"), F.col("lang")).otherwise("und").alias("lang_pred"),
        F.when(F.col("has_letter"), F.col("p")).otherwise(0.0).alias("score"),
        (~F.col("has_letter") | F.col("away")).alias("rejected"),
    )
