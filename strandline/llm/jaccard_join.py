"""N-gram Jaccard join by parity sketches.

A document's set: its distinct n-word shingles, by default three (A-Z lower-cased; with fewer words the whole
sequence as one; without words empty and linked with nothing).  Two sets link when
100 * |A & B| >= percent * |A | B|, which bounds their symmetric difference: by (|A| + |B|) / 19 at 90.

Each shingle hash flips one bit of a sketch, so the Hamming distance of two sketches is at most the
symmetric difference of the sets.  For each band of sizes the sketch is cut into more segments than
the band's largest difference, so linked sets agree on some segments (pigeonhole): `SPARE` + 1 at least.  Sets
meet on (band, segment, its parity bits); the bits of a segment travel as the XOR of 64-bit hashes.
Empty segments say little: a band has so many spare segments that linked sets as a rule agree on more than
either has empty, and only a set that has as many empty ones sends these too, so nothing is lost.  A set goes to its own band and to those of the larger sets that it can link.
Pairs that meet are thinned by sizes and by the Hamming distance of whole sketches, whose length follows the sets' sizes, and verified on
the words.  What travels before that is short: of keys four bytes each, until it is known which several sets have, and texts only of pairs that are left.  Equal sets are one node from the start; components come from a distributed union-find.

Repeated rows are copies of each other; rows that repeat a doc_id with another text are nodes of their own.  A null doc_id
belongs to no component (null component_id) but counts its shingles; other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, U, constants, hash_spans, mix, shingle_hashes, slices, text_bytes, word_spans
from .components import bit_table, linked_components, shared_of_lists
from .storage import Workspace, stored

SPARE, SKETCH_WORDS = 2, 16
_SEG = constants(4, 99)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 3) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    folded = LOWER[data]
    s, t, first = word_spans(folded, offsets)
    words = hash_spans(folded, s, t, 21)
    grams, begin = shingle_hashes(words, first, n, 300 + n)
    out = []
    for i in range(len(offsets) - 1):
        k = first[i + 1] - first[i]
        if 0 < k < n:
            out.append(shingle_hashes(words[first[i] : first[i + 1]], np.array([0, k]), int(k), 300 + int(k))[0])
        else:
            out.append(np.unique(grams[begin[i] : begin[i + 1]]))
    return out


def band_edges(most: int, ratio: float = 1.3) -> np.ndarray:
    """Lowest sizes of the bands, past `most`."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
    return np.array(edges, np.int64)


@lru_cache(maxsize=4096)
def segments(band: int, percent: int) -> tuple[int, int]:
    """(segments of a band, largest symmetric difference of linked sets in it).

    Linked sets agree on segments - difference of them at least.  Where a few more segments make that more than
    the empty ones which a set of the band is likely to have, linked sets agree on one that isn't empty.
    """
    most = 1
    while len(edges := band_edges(most)) < band + 2:
        most = int(edges[-1])
    difference = (100 - percent) * 2 * (int(edges[band + 1]) - 1) // (100 + percent)
    least = -(-percent * int(edges[band]) // 100)
    n = difference + 1 + SPARE
    for more in range(n, n + n // 3 + 1):
        empty = more * math.exp(-least / more)
        if more - difference - 1 >= empty + 3 * math.sqrt(empty):
            return more, difference
    return n, difference


def segment_keys(grams: np.ndarray, percent: int) -> np.ndarray:
    """The join keys of one set."""
    a = len(grams)
    most = 100 * a // percent
    edges = band_edges(most)
    lo, hi = np.searchsorted(edges, [a, most], "right") - 1
    out = []
    for band in range(lo, hi + 1):
        n, difference = segments(band, percent)
        seg = ((grams >> U(32)) % U(n)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        at = np.searchsorted(seg[order], np.arange(n))
        filled = np.bincount(seg, minlength=n) > 0
        parity = np.zeros(n, U)
        parity[filled] = np.bitwise_xor.reduceat(mix(grams[order] ^ _SEG[0]), at[filled])
        keys = mix((parity ^ mix(np.arange(n, dtype=U) * _SEG[1] + np.array([band], U) * _SEG[2])) * _SEG[3])
        out.append(keys if n - filled.sum() >= n - difference else keys[filled])
    return np.concatenate(out)


def sketch_words(n: int) -> int:
    """Longs in the sketch of a set of n shingles: SKETCH_WORDS up to 2048, then twice as many with each doubling of n.

    A sketch has half a bit a shingle at least: with fewer, the distance of large sets that have nothing in common is
    within what may_link allows, and all that share a key would be verified.
    """
    return SKETCH_WORDS << max(0, (n - 1).bit_length() - 11)


def sketch_bits(grams: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """The bit of a sketch that each shingle flips; the two halves of a sketch, XORed, are the sketch of half its length."""
    h = mix(grams ^ _SEG[3])
    at = h >> U(54)  # 1024 bits
    if words > SKETCH_WORDS:
        at |= (h & U(words // SKETCH_WORDS - 1)) << U(10)
    return at.astype(np.int64)


def sketch(grams: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """The parity sketch: 64 * `words` bits as longs; words are SKETCH_WORDS times a power of two."""
    odd = (np.bincount(sketch_bits(grams, words), minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    off = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.view(np.int64)))


def sketches(docs: DataFrame, percent: int, words: int = 3) -> DataFrame:
    """doc_id, k (hash of the row's doc_id and text), row (a number of its own), n_shingles, set hashes s1 and s2, sketch and keys of each row.

    Rows are numbered as partitions are read, so the result has to be stored before it is used twice.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*text_bytes(part.column("text")), words)
                none = np.zeros(0, U)
                s1 = np.array([x.sum(dtype=U) for x in sets], U).view(np.int64)
                s2 = np.array([np.bitwise_xor.reduce(mix(x)) if len(x) else U(0) for x in sets], U).view(np.int64)
                keys = _lists([segment_keys(x, percent) if len(x) else none for x in sets])
                bits = _lists([sketch(x, sketch_words(len(x))) for x in sets])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "k", "row")), pa.array(np.array([len(x) for x in sets], np.int64)), pa.array(s1), pa.array(s2), bits, keys], names=["doc_id", "k", "row", "n_shingles", "s1", "s2", "sketch", "keys"])

    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"), F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, f"doc_id {kind}, k bigint, row bigint, n_shingles bigint, s1 bigint, s2 bigint, sketch array<bigint>, keys array<bigint>")


def _as_long_as(s: Column, other: Column) -> Column:
    """A sketch s, or the XOR of its halves if the other sketch has fewer longs."""
    half = F.shiftright(F.size(s), 1)
    folded = F.zip_with(F.slice(s, F.lit(1), half), F.slice(s, half + 1, half), lambda v, w: v.bitwiseXOR(w))
    return F.when(F.size(s) > F.size(other), folded).otherwise(s)


def may_link(percent: int, folds: bool = False):
    """What sizes and whole sketches allow: 100 * |A & B| >= percent * |A | B| bounds the symmetric difference.

    `folds` says that sketches may differ in length, from 50 percent on by one doubling at most; below, those that differ by more may link.
    """

    def condition(x: str, y: str) -> Column:
        n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        s, t = F.col(f"{x}.sketch"), F.col(f"{y}.sketch")
        if folds:
            s, t = _as_long_as(s, t), _as_long_as(t, s)
        bits = F.zip_with(s, t, lambda v, w: F.bit_count(v.bitwiseXOR(w)))
        distance = F.aggregate(bits, F.lit(0), lambda s, v: s + v)
        if folds:
            distance = F.coalesce(distance, F.lit(0))
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (distance * (100 + percent) <= (100 - percent) * (n + m))

    return condition


class Verifier:
    """Exact Jaccard on the words of candidates, whose whole texts a scan of the documents gathers.

    Only texts of pairs that sizes and sketches let through are gathered: ids that share a key with some other set are most of a large corpus.
    """

    def __init__(self, docs: DataFrame, nodes: DataFrame, percent: int, words: int, ws: Workspace):
        self.docs, self.nodes, self.percent, self.words, self.ws = docs, nodes, percent, words, ws
        self.texts = None

    def marks(self, ids: DataFrame) -> DataFrame:
        """n_shingles and sketch of the nodes in ids; stored."""
        return self.ws.stored(self.nodes.join(ids, "id", "left_semi").select("id", "n_shingles", "sketch"), "near-nodes")

    def gather(self, ids: DataFrame) -> None:
        """Keep the text of each node in ids, in place of those kept before.

        A bit table of bounded size thins the scan; a join then decides.
        """
        if self.texts is not None:
            self.ws.drop(self.texts)
        near = self.ws.stored(self.nodes.join(ids, "id", "left_semi").select("id", "doc_id", "k"), "pair-nodes")
        table = bit_table(near, "k")

        def run(batches):
            for batch in batches:
                hit = table.may_hold(batch.column("k").to_numpy())
                if hit.any():
                    yield batch.filter(pa.array(hit))

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        found = self.docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k")).where("doc_id is not null").mapInArrow(run, f"doc_id {kind}, text string, k bigint")
        self.texts = self.ws.stored(found.dropDuplicates(["doc_id", "k"]).join(near, ["doc_id", "k"]).select("id", "text"), "pair-texts")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        if not pairs.take(1):
            return pairs
        self.gather(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
        side = lambda c: self.texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}"))
        full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
        percent, words = self.percent, self.words

        def run(batches):
            for batch in batches:
                for part in slices(batch, "tb", 1 << 20):
                    left, right = shingle_sets(*text_bytes(part.column("ta")), words), shingle_sets(*text_bytes(part.column("tb")), words)
                    both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)]
                    linked = [100 * i >= percent * (len(x) + len(y) - i) for x, y, i in zip(left, right, both)]
                    yield part.select(["a", "b"]).filter(pa.array(linked))

        return full.mapInArrow(run, "a bigint, b bigint")


def _first_of_each(marks: DataFrame, sets: DataFrame, ws: Workspace) -> DataFrame:
    """(id, keys) of the sets: the rows of marks less those that repeat another one's set.

    A bit table tells most rows that repeat nothing, so only the others are shuffled.
    """
    same = [F.col(f"m.{c}") == F.col(f"s.{c}") for c in ("s1", "s2", "n_shingles")]
    small = marks.where("n_shingles > 0 and doc_id is not null")
    copies = small.alias("m").join(sets.alias("s"), same).where("m.row <> s.id").select(F.col("m.row").alias("id"))
    copies = ws.stored(copies.withColumn("h", F.xxhash64("id")), "copies")
    rows = small.select(F.col("row").alias("id"), "keys", F.xxhash64("row").alias("h"))
    if not copies.take(1):
        return rows.drop("h")
    table = bit_table(copies, "h")

    def those(hit: bool) -> DataFrame:
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(table.may_hold(batch.column("h").to_numpy()) == hit)).select(["id", "keys"])

        return rows.mapInArrow(run, "id bigint, keys array<bigint>")

    return those(False).unionByName(those(True).join(copies.select("id"), "id", "left_anti"))


def _components(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Per row of docs: doc_id, k, n_shingles, component (a number; null without shingles or doc_id) and component_id; stored."""
    with Workspace(docs.sparkSession) as ws:
        marks = ws.stored(sketches(docs, percent, words), "sketches")
        known = marks.where("n_shingles > 0 and doc_id is not null")
        sets = ws.stored(known.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("least"), F.min("row").alias("id")), "sets")
        shared = ws.stored(shared_of_lists(_first_of_each(marks, sets, ws), ws), "shared-keys")
        rows = ws.stored(marks.drop("keys"), "rows")
        ws.drop(marks)  # the keys are by far the most of it
        nodes = rows.where("n_shingles > 0 and doc_id is not null").select(F.col("row").alias("id"), "doc_id", "k", "n_shingles", "sketch")
        verify = Verifier(docs, nodes, percent, words, ws)
        found = linked_components(shared, verify, verify.marks, may_link(percent, folds=True), ws)
        grown = ws.stored(sets.join(found, "id").select("s1", "s2", "n_shingles", "least", "component"), "grown")
        named = grown.join(grown.groupBy("component").agg(F.min("least").alias("label")), "component").select("s1", "s2", "n_shingles", "component", "label")
        own = ["s1", "s2", "n_shingles"]
        all_sets = sets.join(named, own, "left").select(*own, F.coalesce("component", "id").alias("component"), F.coalesce("label", "least").alias("label"))
        out = rows.join(all_sets, own, "left")
        has = F.col("doc_id").isNotNull()
        out = out.select("doc_id", "k", "n_shingles", F.when(has, F.col("component")).alias("component"), F.when(has, F.coalesce("label", "doc_id")).alias("component_id"))
        return stored(out, "jaccard-components")


def jaccard_components(docs: DataFrame, percent: int = 90, words: int = 3) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    return _components(docs, percent, words).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, percent: int = 90, words: int = 3) -> DataFrame:
    """The rows of docs less all but one of each component, the one of the smallest doc_id (and of those that repeat it, of the least text hash).

    Rows of one doc_id and text become one.  Rows without a word or a doc_id are linked with nothing and stay.
    """
    found = _components(docs, percent, words)
    linked = found.where("component is not null")
    winner = linked.where("doc_id = component_id").groupBy("component").agg(F.min("k").alias("best"))
    lost = linked.join(winner, "component").where("doc_id <> component_id or k <> best").select("doc_id", "k").distinct()
    lost = stored(lost, "lost-rows")  # where it is small, the join below then needs no shuffle
    again = stored(linked.groupBy("doc_id", "k").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "k"), "repeated-rows")
    same = lambda other: (docs["doc_id"] == other["doc_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == other["k"])
    kept = docs.join(lost, same(lost), "left_anti")
    if again.take(1):
        some = kept.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(again, (kept["doc_id"] == again["doc_id"]) & (F.xxhash64(kept["doc_id"], kept["text"]) == again["k"]), "left_anti").unionByName(some)
    return kept
