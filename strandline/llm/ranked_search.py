"""Ranked lexical search by branch and bound over a hierarchical max tree of document ranges.

Terms are runs of letters, digits and non-ASCII characters, only A-Z lower-cased.  With N documents that hold a term, L
their terms in all, n a document's terms, df the documents holding a term and tf its occurrences in one, all repeats
counted: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 75 + (25 n N) div L, and a document's score for an item is the sum of
w * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms.  Each item gets its `top` best documents with a score above 0, equal
scores by ascending doc_id.

One scan of the documents keeps what the items can ask for: a bit table of bounded size of the items' terms thins the words of whole texts,
and ranges of LEAF documents are stored with the postings of each term in them.  SHARD consecutive documents make a tree.  A range's entry for
a term is the greatest impact that the term has in a document of the range; ranges are joined ARITY at a time up to the shard, each entry the greatest
below it.  An item's bound for a range is the sum of its terms' weights times entries, which no document of the range can exceed.

Per block of items (BLOCK_TERMS terms at most, or one longer item) the search goes over the stored ranges, shards in parallel.  First the shard of
the highest bound is taken for each item and searched, which gives a score that the item's worst result has at least.  Then all
other shards are searched with it.  In a shard, ranges are opened from the highest bound down while the bound
isn't below what the result needs: ranges of an equal bound are opened too, since a tie may go to a smaller
doc_id.  Leaves are scored exactly.  At most `top` rows a shard and item go on to the ranking, nothing else moves.

Terms are told apart by 64-bit hashes.  An item row is a query of its own: rows that repeat item_id and text count once, rows
of one item_id with different texts give a result each.  Each row of the documents is a document, repeated or not; a null doc_id comes last among ties.  Null and
empty texts have no terms: such documents aren't counted, such items find nothing.  Other columns are ignored.  An empty table on
either side gives an empty result.  A very long text is one document of a range; a range is closed early when it holds LEAF_POSTINGS.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import LOWER, NON_WORD, hash_spans, rows_of, slices, text_bytes, word_spans
from .components import BitTable, bit_table
from .storage import Workspace, stored

LEAF, SHARD, ARITY, LEAF_POSTINGS, BLOCK_TERMS = 32, 2048, 8, 1 << 16, 50_000
POSTINGS = "shard bigint, doc_ids array<bigint>, lengths array<bigint>, terms array<bigint>, at array<int>, tf array<bigint>, n_docs bigint, n_terms bigint"
_NAMES = ["shard", "doc_ids", "lengths", "terms", "at", "tf", "n_docs", "n_terms"]


def terms_of(data: np.ndarray, offsets: np.ndarray):
    """Hashes of the terms (signed) and each row's first term."""
    folded = LOWER[data]
    s, t, first = word_spans(folded, offsets, NON_WORD)
    return hash_spans(folded, s, t, 61).view(np.int64), first


def counted(terms: np.ndarray, row: np.ndarray):
    """Distinct (row, term) in that order, and how often each occurs."""
    order = np.lexsort((terms, row))
    terms, row = terms[order], row[order]
    new = np.r_[True, (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])][: len(terms)]
    at = np.flatnonzero(new)
    return row[at], terms[at], np.diff(np.append(at, len(terms)))


def _lists(values: np.ndarray, begin: np.ndarray, kind=np.int64) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.astype(kind, copy=False)))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms, counts) of the distinct rows (item_id, text) with terms; item numbers them, so the result has to be stored."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                terms, first = terms_of(*text_bytes(part.column("text")))
                row, term, n = counted(terms, rows_of(first))
                begin = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([part.column("item_id"), _lists(term, begin), _lists(n, begin)], names=["item_id", "terms", "counts"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").distinct().mapInArrow(run, f"item_id {kind}, terms array<bigint>, counts array<bigint>")
    return found.where(F.size("terms") > 0).select(F.monotonically_increasing_id().alias("item"), "item_id", "terms", "counts")


def postings(docs: DataFrame, vocabulary: BitTable) -> DataFrame:
    """Rows of ranges of documents: their ids and lengths, the terms that the vocabulary may hold with document (its place in the range) and tf,
    sorted by term, and the documents and terms that the range stands for.  Documents without such a term are in n_docs and n_terms only.

    Ranges are numbered as partitions are read, so the result has to be stored.
    """

    def ranges(terms, tf, row, lengths, ids, shard) -> Iterator[pa.RecordBatch]:
        """Cut the documents of a shard, in order of length, which brings like impacts together."""
        order = np.argsort(lengths, kind="stable")
        size = np.bincount(row, minlength=len(lengths))[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by = np.argsort(place[row], kind="stable")
        terms, tf, at, begin = terms[by], tf[by], place[row][by], np.concatenate([[0], np.cumsum(size)])
        lo = 0
        while lo < len(order):
            hi = int(np.searchsorted(begin, begin[lo] + LEAF_POSTINGS, "right")) - 1
            hi = min(len(order), lo + LEAF, max(hi, lo + 1))
            a, b = begin[lo], begin[hi]
            own = np.argsort(terms[a:b], kind="stable")
            yield _leaf(shard, ids.take(pa.array(order[lo:hi])), lengths[order[lo:hi]], terms[a:b][own], at[a:b][own] - lo, tf[a:b][own], hi - lo, int(lengths[order[lo:hi]].sum()))
            lo = hi

    def run(batches):
        shard, waiting, held, docs_seen, terms_seen = -1, [], 0, 0, 0
        none = np.zeros(0, np.int64)

        def close():
            parts = list(zip(*waiting))
            base = np.cumsum([0, *(len(x) for x in parts[3])])
            row = np.concatenate([r + b for r, b in zip(parts[2], base)])
            yield from ranges(np.concatenate(parts[0]), np.concatenate(parts[1]), row, np.concatenate(parts[3]), pa.concat_arrays(parts[4]), shard)

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            for part in slices(batch, "text"):
                terms, first = terms_of(*text_bytes(part.column("text")))
                n = np.diff(first)
                hit = np.flatnonzero(vocabulary.may_hold(terms)) if len(terms) else none
                row, term, tf = counted(terms[hit], rows_of(first)[hit])
                keep = np.unique(row)
                docs_seen, terms_seen = docs_seen + int((n > 0).sum()) - len(keep), terms_seen + int(n.sum()) - int(n[keep].sum())
                if not len(keep):
                    continue
                if shard < 0:
                    shard = int(shards[0])
                waiting.append((term, tf, np.searchsorted(keep, row), n[keep].astype(np.int64), part.column("doc_id").take(pa.array(keep))))
                held += len(keep)
                if held >= SHARD:
                    yield from close()
                    shard, waiting, held = shard + 1, [], 0
        if waiting:
            yield from close()
        if docs_seen:
            yield _leaf(-1, pa.array([], pa.int64()), none, none, none, none, docs_seen, terms_seen)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.monotonically_increasing_id().alias("shard"))
    return rows.mapInArrow(run, POSTINGS)


def _leaf(shard, ids, lengths, terms, at, tf, n_docs, n_terms) -> pa.RecordBatch:
    one = lambda x, kind=np.int64: _lists(x, np.array([0, len(x)]), kind)
    doc_ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), doc_ids, one(lengths), one(terms), one(at, np.int32), one(tf), pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())], names=_NAMES)


@dataclass
class Items:
    """A block of items: numbers, and the terms of each with weight times occurrences in it."""

    numbers: np.ndarray
    begin: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def blocks(items: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers, begin, terms, counts) of blocks of stored items, one block on the driver at a time."""
    numbers, terms, counts, held = [], [], [], 0

    def block():
        return np.array(numbers, np.int64), np.cumsum([0, *map(len, terms)]), np.concatenate(terms), np.concatenate(counts)

    for row in items.select("item", "terms", "counts").toLocalIterator():
        if held and held + len(row["terms"]) > BLOCK_TERMS:
            yield block()
            numbers, terms, counts, held = [], [], [], 0
        numbers.append(row["item"])
        terms.append(np.array(row["terms"], np.int64))
        counts.append(np.array(row["counts"], np.int64))
        held += len(row["terms"])
    if held:
        yield block()


def frequencies(ranges: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """Documents that hold each of the wanted terms (sorted, at most a block of them): counted within a task, then summed."""

    def run(batches):
        df = np.zeros(len(wanted), np.int64)
        for batch in batches:
            terms = batch.column("terms").flatten().to_numpy()
            at = np.searchsorted(wanted, terms)
            at[at == len(wanted)] = 0
            df += np.bincount(at[wanted[at] == terms], minlength=len(wanted))
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[own]), pa.array(df[own])], names=["term", "df"])

    found = ranges.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    return dict(zip(found.column("term").to_pylist(), found.column("df").to_pylist()))


class Tree:
    """The max tree of one shard over a block's terms: level 0 holds a row of greatest impacts for each leaf, each level above one for ARITY rows."""

    def __init__(self, leaves: list[dict], wanted: np.ndarray, n_docs: int, n_terms: int):
        self.leaves = []
        for leaf in leaves:
            at = np.searchsorted(wanted, leaf["terms"])
            at[at == len(wanted)] = 0
            own = wanted[at] == leaf["terms"]
            tf, place = leaf["tf"][own], leaf["at"][own]
            m = 75 + 25 * leaf["lengths"] * n_docs // n_terms
            self.leaves.append((at[own], place, 1_000_000_000 * tf // (1000 * tf + 12 * m[place]), leaf["doc_ids"]))
        self.local = np.unique(np.concatenate([x[0] for x in self.leaves]))  # places in wanted
        level = np.zeros((len(self.leaves), len(self.local)), np.int64)
        for i, (term, _, impact, _) in enumerate(self.leaves):
            if len(term):
                first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
                level[i, np.searchsorted(self.local, term[first])] = np.maximum.reduceat(impact, first)
        self.levels = [level]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), ARITY), axis=0))

    def columns(self, terms: np.ndarray, weights: np.ndarray):
        """Those of an item's terms (sorted places in wanted) that the shard has, as columns, with their weights."""
        if not len(self.local):
            return terms[:0], weights[:0]
        at = np.searchsorted(self.local, terms)
        at[at == len(self.local)] = 0
        own = self.local[at] == terms
        return at[own], weights[own]

    def bound(self, columns: np.ndarray, weights: np.ndarray) -> int:
        return int(self.levels[-1][0, columns] @ weights)

    def scores(self, leaf: int, columns: np.ndarray, weights: np.ndarray):
        """Document numbers within the leaf and exact scores."""
        term, place, impact, ids = self.leaves[leaf]
        wanted = self.local[columns]
        lo, hi = np.searchsorted(term, wanted), np.searchsorted(term, wanted, "right")
        n = hi - lo
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        score = np.zeros(len(ids), np.int64)
        np.add.at(score, place[at], np.repeat(weights, n) * impact[at])
        return score

    def search(self, columns: np.ndarray, weights: np.ndarray, least: int, top: int) -> list[tuple]:
        """The best `top` documents with a score of `least` or more, as (score, doc_id or None): highest bounds are opened first."""
        best: list[tuple] = []  # a heap of (score, has an id, -doc_id), worst first
        queue = [(-self.bound(columns, weights), len(self.levels) - 1, 0)]
        while queue:
            bound, level, node = heapq.heappop(queue)
            if -bound < max(least, best[0][0] if len(best) == top else 1):
                break  # an equal bound is opened: the tie may go to a smaller doc_id
            if level:
                children = np.arange(node * ARITY, min((node + 1) * ARITY, len(self.levels[level - 1])))
                for child, b in zip(children.tolist(), (self.levels[level - 1][children][:, columns] @ weights).tolist()):
                    heapq.heappush(queue, (-b, level - 1, child))
                continue
            score, ids = self.scores(node, columns, weights), self.leaves[node][3]
            floor = max(least, best[0][0] if len(best) == top else 1)
            for i in np.flatnonzero(score >= floor).tolist():
                doc = ids[i].as_py()
                entry = (int(score[i]), doc is not None, 0 if doc is None else -doc)
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -d if known else None) for s, known, d in best]


def trees(batches, wanted: np.ndarray, n_docs: int, n_terms: int) -> Iterator[tuple[int, Tree]]:
    """The trees of consecutive leaves of one shard; a shard that two tasks read gives a tree in each."""
    shard, leaves = None, []
    for batch in batches:
        lists = {c: batch.column(c) for c in ("terms", "at", "tf", "lengths", "doc_ids")}
        for i, s in enumerate(batch.column("shard").to_pylist()):
            if s != shard and leaves:
                yield shard, Tree(leaves, wanted, n_docs, n_terms)
                leaves = []
            shard = s
            leaves.append({c: x[i].values if c == "doc_ids" else x[i].values.to_numpy() for c, x in lists.items()})
    if leaves:
        yield shard, Tree(leaves, wanted, n_docs, n_terms)


def _searched(ranges: DataFrame, items: Items, wanted: np.ndarray, n_docs: int, n_terms: int, step) -> DataFrame:
    """(item, shard, doc_id, score) that step(shard, tree, item's place, columns, weights) gives for each shard and item; rows of no score are left out."""
    places = np.searchsorted(wanted, items.terms)

    def run(batches):
        for shard, tree in trees(batches, wanted, n_docs, n_terms):
            out = []
            for i, number in enumerate(items.numbers.tolist()):
                a, b = items.begin[i], items.begin[i + 1]
                columns, weights = tree.columns(places[a:b], items.weights[a:b])
                if len(columns):
                    out += [(number, shard, doc, score) for score, doc in step(shard, tree, i, columns, weights)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["item", "shard", "doc_id", "score"])

    return ranges.where("shard >= 0").select("shard", "terms", "at", "tf", "lengths", "doc_ids").mapInArrow(run, "item bigint, shard bigint, doc_id bigint, score bigint")


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id")]


def best_of(found: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each item with their rank."""
    w = Window.partitionBy("item").orderBy(*_order())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def _block_results(ranges: DataFrame, block, n_docs: int, n_terms: int, top: int, ws: Workspace) -> DataFrame:
    numbers, begin, terms, counts = block
    wanted = np.unique(terms)
    df = frequencies(ranges, wanted)
    w = np.array([np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in terms.tolist()]).astype(np.int64)
    items = Items(numbers, begin, terms, w * counts)
    args = (ranges, items, wanted, n_docs, n_terms)
    bounds = _searched(*args, lambda shard, tree, i, c, v: [(tree.bound(c, v), None)])
    # each item's shard of the highest bound; a row an item, and items are a block
    first = bounds.groupBy("item").agg(F.max(F.struct("score", "shard")).alias("m")).select("item", "m.shard").toArrow()
    chosen = dict(zip(first.column("item").to_pylist(), first.column("shard").to_pylist()))
    if not chosen:
        return ranges.sparkSession.createDataFrame([], "item bigint, doc_id bigint, score bigint, rank int")
    opened = np.array([chosen.get(n, -1) for n in numbers.tolist()])
    some = ranges.where(F.col("shard").isin(sorted(set(chosen.values()))))
    near = ws.stored(_searched(some, *args[1:], lambda shard, tree, i, c, v: tree.search(c, v, 1, top) if opened[i] == shard else []).drop("shard"), "best-shards")
    worst = best_of(near, top).where(F.col("rank") == top).select("item", "score").toArrow()
    known = dict(zip(worst.column("item").to_pylist(), worst.column("score").to_pylist()))
    least = [known.get(n, 1) for n in numbers.tolist()]
    rest = _searched(*args, lambda shard, tree, i, c, v: tree.search(c, v, least[i], top) if opened[i] != shard else []).drop("shard")
    return ws.stored(best_of(rest.unionByName(near), top), "ranked")


def ranked(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """Per item and result: item_id, rank (from 1), doc_id, score."""
    with Workspace(docs.sparkSession) as ws:
        asked = ws.stored(item_terms(items), "item-terms")
        ranges = ws.stored(postings(docs, bit_table(ws.stored(asked.select(F.explode("terms").alias("term")).distinct(), "vocabulary"), "term")), "postings")
        total = ranges.agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t")).first()
        found = [_block_results(ranges, block, total["d"], total["t"], top, ws) for block in blocks(asked)] if total["d"] else []
        kind = items.schema["item_id"].dataType.simpleString()
        if not found:
            return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
        every = reduce(DataFrame.unionByName, found)
        return stored(every.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score"), "search-results")
