"""Benchmark decontamination by size-partitioned MinHash containment search.

An item leaks into a document that holds at least `threshold` of the item's distinct n-word shingles
(words: case-folded runs of letters, digits and non-ASCII bytes).  Items are partitioned by size
(shingle count, in powers of two).  An item's sketch is its k smallest shingle hashes, with
k = q - ceil(threshold * q) + 1 for the largest q of its class: a document with the asked
containment lacks fewer than k of them, so it holds at least one, and the search loses nothing.
Documents probe the sketches of those classes that they are long enough to contain; candidates are
verified by exact containment of all the item's shingles in the whole document.

Documents stream once through Arrow batches for each block of items; nothing is shuffled.  A block
holds about `block_words` words of benchmark text (a longer item is a block of its own or with others), is built on the driver and sent to the tasks; so what the driver and a task
hold at a time is bounded however many items there are.  Items with fewer than n words count as one shingle, their whole sequence; items
without words match nothing.  Null and empty documents hold nothing.  Repeated rows each match; other columns are ignored
(leaks) or carried along (without_leaks).  An empty table of documents or items gives no leak.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.types import DoubleType, LongType

from .arrays import LOWER, NON_WORD, U, hash_spans, rows_of, shingle_hashes, slices, text_bytes, word_spans
from .storage import stored

MASK_BITS = 20


@dataclass
class Block:
    """Sketches by (shingle words, size class), and all shingles of the items."""

    ids: pa.Array
    sizes: np.ndarray  # distinct shingles of each item
    sketches: list  # (words a shingle, least document size, mask, sorted hashes, item of each)
    shingles: np.ndarray  # sorted hashes of all items
    owners: np.ndarray  # item of each


def _words(data, offsets):
    folded = LOWER[data]
    s, t, first = word_spans(folded, offsets, NON_WORD)
    return hash_spans(folded, s, t, 17), first


def _shingles(words, first, k):
    """k-word shingles; hashes of different k never mix by chance."""
    return shingle_hashes(words, first, k, 1000 + k)


def build_block(ids: pa.Array, texts: pa.Array, n: int, threshold: float) -> Block:
    words, first = _words(*text_bytes(texts))
    sets, length = [], []
    for i in range(len(ids)):
        own = words[first[i] : first[i + 1]]
        k = min(n, len(own))
        sets.append(np.unique(_shingles(own, np.array([0, len(own)]), k)[0]) if k else np.zeros(0, U))
        length.append(k)
    sizes = np.array([len(x) for x in sets], np.int64)
    length = np.array(length, np.int64)
    sketches = []
    for k in sorted(set(length[length > 0].tolist())):
        for c in sorted({int(q).bit_length() for q in sizes[length == k]}):
            members = [i for i in range(len(ids)) if length[i] == k and int(sizes[i]).bit_length() == c]
            most = (1 << c) - 1
            take = most - math.ceil(threshold * most - 1e-9) + 1
            hashes = np.concatenate([sets[i][:take] for i in members])
            owner = np.concatenate([np.full(len(sets[i][:take]), i) for i in members])
            order = np.argsort(hashes, kind="stable")
            mask = np.zeros(1 << MASK_BITS, bool)
            mask[hashes >> U(64 - MASK_BITS)] = True
            sketches.append((k, math.ceil(threshold * (1 << (c - 1)) - 1e-9), mask, hashes[order], owner[order]))
    every = np.concatenate(sets) if len(sets) else np.zeros(0, U)
    owners = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(every, kind="stable")
    return Block(ids, sizes, sketches, every[order], owners[order])


def _expand(keys: np.ndarray, sorted_keys: np.ndarray):
    """All positions of each key in a sorted array: (index into keys, position)."""
    lo, hi = np.searchsorted(sorted_keys, keys), np.searchsorted(sorted_keys, keys, "right")
    n = hi - lo
    at = np.repeat(np.arange(len(keys)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def search(block: Block, data: np.ndarray, offsets: np.ndarray, threshold: float):
    """(row, item, shared shingles) of the pairs with the asked containment."""
    words, first = _words(data, offsets)
    candidates: list[np.ndarray] = []
    items = len(block.ids)
    grams: dict[int, tuple] = {}
    for k, least, mask, hashes, owner in block.sketches:
        if k not in grams:
            grams[k] = _shingles(words, first, k)
        h, begin = grams[k]
        at = np.flatnonzero(mask[h >> U(64 - MASK_BITS)])
        at = at[np.isin(h[at], hashes)]
        row = np.searchsorted(begin, at, "right") - 1
        enough = np.diff(begin)[row] >= least
        i, pos = _expand(h[at[enough]], hashes)
        candidates.append(np.unique(row[enough][i] * items + owner[pos]))
    if not candidates or not (pairs := np.unique(np.concatenate(candidates))).size:
        return (np.zeros(0, np.int64),) * 3
    rows, found = pairs // items, np.zeros(len(pairs), np.int64)
    for h, begin in grams.values():
        for row in np.unique(rows):
            own = np.unique(h[begin[row] : begin[row + 1]])
            _, pos = _expand(own, block.shingles)
            mine = slice(*np.searchsorted(rows, [row, row + 1]))
            wanted, owners = pairs[mine] % items, block.owners[pos]  # wanted is sorted
            at = np.minimum(np.searchsorted(wanted, owners), len(wanted) - 1)
            found[mine] += np.bincount(at[wanted[at] == owners], minlength=len(wanted))
    item = pairs % items
    hit = found >= np.ceil(threshold * block.sizes[item] - 1e-9)
    return rows[hit], item[hit], found[hit]


def blocks(items: DataFrame, n: int, threshold: float, block_words: int):
    """The benchmark in blocks of about block_words words, built one at a time on the driver."""
    items = items.where("text is not null").select("item_id", "text")
    words = items.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    parts = math.ceil(words / block_words)
    for i in range(parts):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == i).orderBy("item_id", "text").toArrow()
        if rows.num_rows:
            yield build_block(pa.concat_arrays(rows.column("item_id").chunks), pa.concat_arrays(rows.column("text").chunks), n, threshold)


def leaks(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, block_words: int = 1_000_000) -> DataFrame:
    """One row for each leak: doc_id, item_id, n_shingles of the item, n_shared, containment.

    A benchmark of more than one block is searched a block at a time, its hits stored before the next is built.
    """
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("item_id", items.schema["item_id"].dataType),
        StructField("n_shingles", LongType()), StructField("n_shared", LongType()), StructField("containment", DoubleType()),
    ])
    return _hits(docs.select("doc_id", "text"), items, n, threshold, block_words, schema, ["doc_id"])


def _hits(docs: DataFrame, items: DataFrame, n: int, threshold: float, block_words: int, schema: StructType, keep: list[str]) -> DataFrame:
    """Columns `keep` of docs, then item_id, n_shingles, n_shared and containment, one row for each leak."""
    names = schema.fieldNames()

    def against(block: Block) -> DataFrame:
        def run(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    row, item, shared = search(block, *text_bytes(part.column("text")), threshold)
                    if len(row):
                        size = block.sizes[item]
                        yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(row)) for c in keep), block.ids.take(pa.array(item)), pa.array(size), pa.array(shared), pa.array(shared / size)], names=names)

        return docs.mapInArrow(run, schema)

    out = before = None
    for block in blocks(items, n, threshold, block_words):
        if before is not None:
            done = stored(against(before), "leaks")
            out = done if out is None else out.unionByName(done)
        before = block
    if before is None:
        return docs.sparkSession.createDataFrame([], schema)
    last = against(before)
    return last if out is None else out.unionByName(stored(last, "leaks"))


def without_leaks(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, block_words: int = 1_000_000) -> DataFrame:
    """The rows of docs that hold no item, all columns kept, in one pass and without a shuffle.

    With more than one block of items hits are searched a block at a time, and an anti join on doc_id and text hash takes them away.
    """
    found = list(islice(blocks(items, n, threshold, block_words), 2))
    if not found:
        return docs
    if len(found) == 1:
        block = found[0]

        def run(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    clean = np.ones(part.num_rows, bool)
                    clean[search(block, *text_bytes(part.column("text")), threshold)[0]] = False
                    if clean.any():
                        yield part.filter(pa.array(clean))

        return docs.mapInArrow(run, docs.schema)
    del found
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("k", LongType()), StructField("item_id", items.schema["item_id"].dataType),
        StructField("n_shingles", LongType()), StructField("n_shared", LongType()), StructField("containment", DoubleType()),
    ])
    hits = _hits(docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k")), items, n, threshold, block_words, schema, ["doc_id", "k"])
    hits = stored(hits.select("doc_id", "k").distinct(), "leaking-rows")
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["doc_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == hits["k"]), "left_anti")
