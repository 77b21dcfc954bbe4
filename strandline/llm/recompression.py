"""Substring dedup by recompression.

A window is `WINDOW` consecutive words of one document; each word covered by a window whose word
sequence also starts anywhere else (same document included) is removed.  Windows are judged on the
input, not on what is left.

Recompression parses each text alike wherever it occurs.  In each of `ROUNDS` rounds, maximal runs of
one symbol become one symbol, then each pair whose first symbol is a left one and whose second is a
right one becomes one.  A new symbol's name, and whether it is left or right, is a hash of what it
stands for, so every task names equal runs and pairs alike without a dictionary.  With each symbol goes its
context: the words that decide its boundaries.  A window that holds a symbol's whole context holds
that symbol in each of its occurrences.

Each window takes, among the top-level symbols that it decides, the one of least priority as its
anchor, with the fingerprint of the words around it.  Equal windows have equal anchors, so only windows
whose fingerprint occurs twice, or that decide no symbol (long runs), are candidates.  Candidates are
verified on hashes of all their words (96 bits), counted over the whole corpus.

Spark groups and joins by fingerprint, by window and by document; counts are pre-aggregated and
joins are split where a key is hot, so copies that make up a third of all rows do no harm.  Null and
empty texts have no words.  Rows that repeat another one's text count as elsewhere.  Other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrays import U, constants, hash_spans, mix, rows_of, slices, text_bytes, word_spans
from .storage import stored

WINDOW, ROUNDS = 35, 3
#: Words before and after an anchor's start that its fingerprint covers.
BEFORE, AFTER = 8, 16
_C = constants(8, 2024)
_BASE = [int(constants(2, 4711)[i]) for i in range(2)]


def parse(words: np.ndarray, first: np.ndarray, rounds: int = ROUNDS):
    """Top-level symbols of all rows: names, start and end words, and context [left, right).

    A symbol at a row's edge, whose boundary there isn't decided by words, gets a context past the edge.
    """
    n = len(words)
    names, start = words.copy(), np.arange(n)
    end, left, right = start + 1, start.copy(), start + 1
    row = rows_of(first)
    for level in range(rounds):
        if not len(names):
            break
        # runs of one symbol
        edge = np.ones(len(names), bool)
        edge[1:] = row[1:] != row[:-1]
        head = edge.copy()
        head[1:] |= names[1:] != names[:-1]
        a = np.flatnonzero(head)
        b = np.append(a[1:], len(names)) - 1
        size = (b - a + 1).astype(U)
        named = names[a]
        run = size > U(1)
        named[run] = mix(named[run] * _C[0] + size[run] * _C[1] + U(level))
        before, after = np.maximum(a - 1, 0), np.minimum(b + 1, len(names) - 1)
        lone_left = edge[a]
        lone_right = np.append(edge[1:], True)[b]
        new_left = np.where(lone_left, start[a] - 1, left[before])
        new_right = np.where(lone_right, end[b] + 1, right[after])
        names, start, end, left, right, row = named, start[a], end[b], np.minimum(new_left, left[a]), np.maximum(new_right, right[b]), row[a]
        # pairs of a left symbol and a right one
        edge = np.ones(len(names), bool)
        edge[1:] = row[1:] != row[:-1]
        is_right = (mix(names ^ _C[2 + level]) & U(1)).astype(bool)
        second = np.zeros(len(names), bool)
        second[1:] = is_right[1:] & ~is_right[:-1] & ~edge[1:]
        a = np.flatnonzero(~second)
        paired = np.append(second[1:], False)[a]
        b = a + paired
        named = names[a]
        named[paired] = mix(names[a[paired]] * _C[5] + names[b[paired]] * _C[6] + U(level))
        # an unpaired right symbol looks at its predecessor, an unpaired left one at its successor
        look_left, look_right = ~paired & is_right[a], ~paired & ~is_right[a]
        lone_left, lone_right = edge[a], np.append(edge[1:], True)[b]
        new_left = np.where(look_left, np.where(lone_left, start[a] - 1, left[np.maximum(a - 1, 0)]), left[a])
        new_right = np.where(look_right, np.where(lone_right, end[b] + 1, right[np.minimum(b + 1, len(names) - 1)]), right[b])
        names, start, end, left, right, row = named, start[a], end[b], np.minimum(new_left, left[a]), np.maximum(new_right, right[b]), row[a]
    return names, start, end, left, right


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=U)


def range_hashes(words: np.ndarray, starts: np.ndarray, length: int, which: int) -> np.ndarray:
    """Polynomial hashes of `length` words from each start."""
    base = _BASE[which]
    total = np.zeros(len(words) + 1, U)
    np.cumsum((words if which == 0 else mix(words)) * _powers(len(words), base), dtype=U, out=total[1:])
    inverse = _powers(int(starts.max()) + 1 if len(starts) else 0, pow(base, -1, 1 << 64))
    return mix((total[starts + length] - total[starts]) * inverse[starts])


def anchors(words: np.ndarray, first: np.ndarray):
    """(fingerprint or None mask, row, first and last window) of the anchors and of the runs of windows without one.

    Windows are numbered from their row's first word.
    """
    row = rows_of(first)
    n = len(words)
    windows = np.arange(max(n - WINDOW + 1, 0))
    windows = windows[row[windows] == row[windows + WINDOW - 1]]
    none = np.zeros(0, np.int64)
    if not len(windows):
        return np.zeros(0, U), np.zeros(0, bool), none, none, none
    names, start, end, left, right = parse(words, first)
    left, right = np.minimum(left, start - BEFORE), np.maximum(right, np.maximum(end, start + AFTER))
    left, right = np.minimum.accumulate(left[::-1])[::-1], np.maximum.accumulate(right)
    priority = mix(names ^ _C[7])
    # sparse table of the positions of least priority
    table, k = [np.arange(len(names))], 1
    while k < WINDOW:
        t = table[-1]
        other = np.concatenate([t[k:], np.full(min(k, len(t)), len(names) - 1)])
        table.append(np.where(priority[other] < priority[t], other, t))
        k *= 2
    lo = np.searchsorted(left, windows)
    hi = np.searchsorted(right, windows + WINDOW, "right")
    has = lo < hi
    width = np.where(has, hi - lo, 1)
    level = np.frexp(width.astype(float))[1] - 1
    chosen = np.full(len(windows), -1)
    for j in range(len(table)):
        at = np.flatnonzero(has & (level == j))
        if len(at):
            x, y = table[j][lo[at]], table[j][hi[at] - (1 << j)]
            chosen[at] = np.where(priority[y] < priority[x], y, x)
    # windows in a row that share an anchor, or have none
    new = np.ones(len(windows), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (windows[1:] != windows[:-1] + 1) | (row[windows[1:]] != row[windows[:-1]])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(windows)) - 1
    known = chosen[a] >= 0
    prints = np.zeros(len(a), U)
    prints[known] = range_hashes(words, start[chosen[a[known]]] - BEFORE, BEFORE + AFTER, 0)
    r = row[windows[a]]
    return prints, known, r, windows[a] - first[r], windows[b] - first[r]


def _hashed(part: pa.RecordBatch):
    data, offsets = text_bytes(part.column("text"))
    s, t, first = word_spans(data, offsets)
    return hash_spans(data, s, t, 31), first


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))


def _pack(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return lo << 31 | hi


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, k, text, starts): documents with repeated windows, and where those start, in words."""
    keyed = _keyed(docs)

    def find(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                prints, known, row, lo, hi = anchors(*_hashed(part))
                yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64), mask=~known), part.column("k").take(pa.array(row)), pa.array(_pack(lo, hi))], names=["print", "k", "span"])

    found = keyed.select("text", "k").mapInArrow(find, "print bigint, k bigint, span bigint")
    shared = found.where("print is not null").groupBy("print").count().where("count > 1").select("print")
    shared = stored(shared, "shared-prints")
    spans = found.join(shared, "print").select("k", "span").unionByName(found.where("print is null").select("k", "span"))
    spans = spans.groupBy("k").agg(F.collect_set("span").alias("spans"))
    candidates = stored(keyed.join(spans, "k"), "candidates")

    def windows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words, first = _hashed(part)
                spans = part.column("spans")
                flat = spans.flatten().to_numpy()
                lo, hi = flat >> 31, flat & ((1 << 31) - 1)
                row = np.repeat(np.arange(part.num_rows), np.diff(spans.offsets.to_numpy()))
                n = hi - lo + 1
                at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                row = np.repeat(row, n)
                fits = at + WINDOW <= np.diff(first)[row]
                at, row = at[fits], row[fits]
                where = first[row] + at
                one, two = range_hashes(words, where, WINDOW, 0).view(np.int64), range_hashes(words, where, WINDOW, 1)
                both = ((two >> U(32)) << U(32) | at.astype(U)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(both), part.column("k").take(pa.array(row))], names=["w", "v", "k"])

    rows = candidates.select("text", "k", "spans").mapInArrow(windows, "w bigint, v bigint, k bigint").select("w", F.shiftright("v", 32).cast("int").alias("w2"), F.col("v").bitwiseAND(0xFFFFFFFF).cast("int").alias("at"), "k")
    again = stored(rows.groupBy("w", "w2").count().where("count > 1").select("w", "w2"), "repeated-windows")
    starts = rows.join(again, ["w", "w2"]).groupBy("k").agg(F.collect_set("at").alias("starts"))
    return candidates.drop("spans").join(starts, "k")


def dedup(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256 of the words left, joined by one space."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    names = StructType.fromDDL(schema).fieldNames()

    def digest(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                lists = part.column("starts").to_pylist() if "starts" in part.schema.names else [()] * part.num_rows
                out = []
                for i, starts in enumerate(lists):
                    words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    if len(starts):
                        step = np.zeros(len(words) + 1, np.int64)
                        starts = np.asarray(starts)
                        np.add.at(step, starts, 1)
                        np.add.at(step, starts + WINDOW, -1)
                        keep = np.cumsum(step[:-1]) == 0
                        left = [words[j] for j in np.flatnonzero(keep)]
                    else:
                        left = words
                    out.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("k"), *map(pa.array, zip(*out))], names=names)

    keyed = _keyed(docs)
    whole = keyed.mapInArrow(digest, schema)
    less = repeated_words(docs).select("doc_id", "text", "k", "starts").mapInArrow(digest, schema).dropDuplicates(["doc_id", "k"])
    less = stored(less, "deduped")
    r = less.select(F.col("doc_id").alias("d"), F.col("k").alias("k2"), F.col("n_removed").alias("removed"), F.col("kept_sha256").alias("sha"))
    rows = whole.join(r, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("k2")), "left")
    return rows.select("doc_id", "n_words", F.coalesce("removed", "n_removed").alias("n_removed"), F.coalesce("sha", "kept_sha256").alias("kept_sha256"))
