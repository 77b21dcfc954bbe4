"""Line dedup: of each group of equal or nearly equal lines, the first one stays.

Lines end at \\n; lines without a word are left alone.  A line's set is its distinct character
shingles: every eight consecutive characters (a shorter line is its own one shingle); two lines link at a Jaccard similarity of 0.8.
MinHash signatures of BANDS bands of ROWS values give candidates: a pair at 0.8 shares a band with
probability 1 - (1 - 0.8^ROWS)^BANDS = 0.985, one at 0.9 with 0.9999.  Signatures use one-permutation hashing: lines of
LONG and more take one value from each of 32 parts of their shingles, lines of SHORT and more four values from each of eight parts; shorter lines,
whose parts may be empty, take all values from all shingles.  Lengths a quarter past a border use both families, length being the number of distinct shingles.  Candidates are thinned by
parity sketches, whose distance no link can exceed, and verified by exact Jaccard on the lines' texts; a distributed union-find gives the components.  Of each component the
line with the least (doc_id, text hash, line number) stays.

Equal lines are one node from the start.  Repeated rows (same doc_id and text) are one document.  Null
and empty texts have no line; a null doc_id sorts first; other columns are carried along untouched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import SEPARATORS, U, constants, eight_bytes, hash_spans, mix, slices, text_bytes
from .components import bit_table, linked_components, packed_pairs, shared_pairs
from .jaccard_join import SKETCH_WORDS, may_link, sketch_bits
from .storage import Workspace, stored

WIDTH, BANDS, ROWS = 8, 8, 4
#: From so many distinct shingles on signatures use eight bins, and one for each value.
SHORT, LONG = 64, 160
MOST = LONG * 5 // 4
SLICE = 1 << 18
_SEEDS = constants(BANDS * ROWS, 77)
_BEYOND_ASCII = U(0x8080808080808080)


def line_spans(data: np.ndarray, offsets: np.ndarray):
    """Start, end, row and number (in its row, from 0) of each line that has a word, in bytes."""
    newline = data == 10
    cut = np.flatnonzero(newline)
    starts = np.union1d(offsets[:-1], cut + 1)
    starts = starts[starts < len(data)]
    row = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(np.append(cut, len(data))[np.searchsorted(cut, starts)], offsets[row + 1])
    number = np.arange(len(starts)) - np.searchsorted(starts, offsets[row])
    letters = np.flatnonzero(~SEPARATORS[data])
    full = np.searchsorted(letters, ends) > np.searchsorted(letters, starts)
    return starts[full], ends[full], row[full], number[full]


def line_shingles(data: np.ndarray, s: np.ndarray, t: np.ndarray, eight: np.ndarray | None = None):
    """Shingle hashes of the lines, and the line of each."""
    eight = eight_bytes(data) if eight is None else eight
    lead = (data & 0xC0) != 0x80
    lead[s[s < t]] = True  # whatever the bytes are, each belongs to a character
    chars = np.append(np.flatnonzero(lead), len(data))
    first, last = np.searchsorted(chars, s), np.searchsorted(chars, t)
    # +1 where a line's whole shingles begin, -1 after the last of them
    step = np.zeros(len(data) + 1, np.int8)
    long = last - first >= WIDTH
    np.add.at(step, s[long], 1)
    np.add.at(step, chars[last[long] - WIDTH] + 1, -1)
    at = np.flatnonzero((np.cumsum(step[:-1], dtype=np.int8) > 0) & lead)
    count = np.where(long, last - first - WIDTH + 1, 0)
    line = np.repeat(np.arange(len(s)), count)
    h = eight[at]
    wide = np.flatnonzero((h & _BEYOND_ASCII) != 0)
    h = mix(h)
    if len(wide):
        begin = at[wide]
        end = chars[wide + (first - np.cumsum(count) + count)[line[wide]] + WIDTH]
        # up to 16 bytes are the first eight and the last eight
        own = mix((h[wide] + (end - begin).astype(U)) * _SEEDS[2] ^ eight[end - 8])
        more = np.flatnonzero(end - begin > 16)
        own[more] = hash_spans(data, begin[more], end[more], 43, eight)
        h[wide] = own
    if not long.all():
        few = np.flatnonzero(~long)
        left = (t - s)[few]
        own = mix((eight[s[few]] & ((U(1) << (np.minimum(left, 7).astype(U) * U(8))) - U(1))) + left.astype(U) * _SEEDS[1])
        wide = left >= 8
        own[wide] = hash_spans(data, s[few[wide]], t[few[wide]], 44, eight)
        line, h = np.concatenate([line, few]), np.concatenate([h, own])
        order = np.argsort(line, kind="stable")
        line, h = line[order], h[order]
    return h, line


def distinct_counts(shingles: np.ndarray, line: np.ndarray, lines: int) -> np.ndarray:
    """How many distinct shingles each line has, as far as the borders of the signature families go.

    Lines with fewer than SHORT shingles keep their number, others that surely have MOST
    distinct ones get this; the rest are counted.
    """
    n = np.bincount(line, minlength=lines)
    begin = np.cumsum(n) - n
    size = MOST * 4 // 3
    many = np.flatnonzero(n >= size)
    n[(n >= SHORT) & (n < size)] = -1
    if len(many):
        # distinct marks of a line's first shingles are at most its distinct shingles
        firsts = np.lib.stride_tricks.sliding_window_view((shingles >> U(54)).astype(np.uint16), size)
        for part in np.array_split(many, len(many) // 512 + 1):
            seen = np.zeros((len(part), 1024), bool)
            seen.ravel()[(firsts[begin[part]] + (np.arange(len(part)) * 1024)[:, None]).ravel()] = True
            n[part] = np.where(np.count_nonzero(seen, axis=1) >= MOST, MOST, -1)
    few = np.flatnonzero(n < 0)
    if len(few):
        place = np.zeros(lines, U)
        place[few] = np.arange(len(few), dtype=U)
        use = (n < 0)[line]
        pairs = np.sort((place[line[use]] << U(40)) | (shingles[use] >> U(24)))
        first = np.r_[True, pairs[1:] != pairs[:-1]]
        n[few] = np.bincount((pairs[first] >> U(40)).astype(np.int64), minlength=len(few))
    return n


def _binned(g: np.ndarray, own: np.ndarray, lines: int, bins: int) -> np.ndarray:
    """Band keys by one-permutation hashing: BANDS * ROWS values, the least hashes in `bins` bins for each of several seeds."""
    values = np.empty((BANDS * ROWS // bins, lines * bins), U)
    shift, at = U(64 - (bins.bit_length() - 1)), own * bins
    for j in range(len(values)):
        h = g * _SEEDS[j]
        values[j] = ~U(0)
        np.minimum.at(values[j], at + (h >> shift).astype(np.int64), h)
    values = values.reshape(len(values), lines, -1, BANDS).transpose(1, 3, 0, 2).reshape(lines, BANDS, ROWS)
    key = np.full((lines, BANDS), U(bins), U)
    for j in range(ROWS):
        key = mix(key + values[:, :, j])
    return mix(key ^ _SEEDS[:BANDS])


def _blobs(keys: pa.ListArray, ids: np.ndarray, rows: int) -> pa.Array:
    """The pairs (key, id) of lines as bytes, for shared_pairs: a blob of 65,536 pairs in each of the first of so many rows, null in the others."""
    pairs = packed_pairs(keys, ids)
    blobs = [pairs[i : i + (1 << 16)].tobytes() for i in range(0, len(pairs), 1 << 16)]
    return pa.array(blobs + [None] * (rows - len(blobs)), pa.binary())


def band_keys(shingles: np.ndarray, line: np.ndarray, lines: int) -> pa.ListArray:
    """Band keys of each line, by the families that its number of distinct shingles puts it in."""
    n = distinct_counts(shingles, line, lines)
    count = np.bincount(line, minlength=lines)
    out = []
    for bins, member in ((BANDS * ROWS, n >= LONG), (BANDS, (n >= SHORT) & (n < LONG * 5 // 4)), (0, n < SHORT * 5 // 4)):
        ids = np.flatnonzero(member)
        if not len(ids):
            continue
        if len(ids) == lines:
            g, own = shingles, line
        else:
            g, own = shingles[np.repeat(member, count)], np.repeat(np.arange(len(ids)), count[ids])
        if bins:
            out.append((ids, _binned(g, own, len(ids), bins)))
            continue
        begin = np.cumsum(count[ids]) - count[ids]
        keys = np.zeros((len(ids), BANDS), U)
        for i in range(BANDS):
            key = np.zeros(len(ids), U)
            for j in range(ROWS):
                key = mix(key + np.minimum.reduceat(g * _SEEDS[i * ROWS + j], begin))
            keys[:, i] = mix(key ^ _SEEDS[BANDS + i])
        out.append((ids, keys))
    ids = np.concatenate([x[0] for x in out]) if out else np.zeros(0, np.int64)
    keys = np.concatenate([x[1] for x in out]) if out else np.zeros((0, BANDS), U)
    order = np.argsort(ids, kind="stable")
    off = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=lines) * BANDS)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(keys[order].ravel().view(np.int64)))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, k, line number, h1 and h2 (the line's content) of each line with a word; n_lines, their number, with a document's first.

    pairs, in some rows, are the band keys of many lines, each with its line's h1: a column of bytes costs far less on its way than an array a line.
    Of equal lines that a task meets together only one has keys, as they are one node.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = text_bytes(part.column("text"))
                s, t, row, number = line_spans(data, offsets)
                eight = eight_bytes(data)
                h1, h2 = (hash_spans(data, s, t, seed, eight).view(np.int64) for seed in (41, 42))
                once = np.sort(np.unique(h1, return_index=True)[1])
                g, line = line_shingles(data, s[once], t[once], eight)
                pairs = _blobs(band_keys(g, line, len(once)), h1[once], len(s))
                leads = np.r_[True, row[1:] != row[:-1]][: len(row)]
                n_lines = pa.array(np.bincount(row, minlength=len(part))[row], mask=~leads)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(take), part.column("k").take(take), pa.array(number.astype(np.int32)), pa.array(h1), pa.array(h2), pairs, n_lines], names=["doc_id", "k", "line", "h1", "h2", "pairs", "n_lines"])

    return _keyed(docs).mapInArrow(run, f"doc_id {kind}, k bigint, line int, h1 bigint, h2 bigint, pairs binary, n_lines bigint")


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The shingle sets of a column of lines."""
    data, offsets = text_bytes(column)
    g, line = line_shingles(data, offsets[:-1], offsets[1:])
    bounds = np.searchsorted(line, np.arange(len(column) + 1))
    return [np.unique(g[a:b]) for a, b in zip(bounds, bounds[1:])]


def line_marks(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of distinct shingles, and the parity sketch (jaccard_join.sketch), of each line in a column."""
    data, offsets = text_bytes(column)
    g, line = line_shingles(data, offsets[:-1], offsets[1:])
    order = np.argsort(g)
    few = line[order].astype(np.uint16 if len(column) < 1 << 16 else np.int64)  # 16 bits are sorted by radix
    order = order[np.argsort(few, kind="stable")]
    g, line = g[order], line[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (line[1:] != line[:-1])
    g, line = g[first], line[first]
    n, wide = len(column), 64 * SKETCH_WORDS
    odd = np.bincount(line * wide + sketch_bits(g), minlength=n * wide).astype(np.uint8) & 1
    return np.bincount(line, minlength=n).astype(np.int64), np.packbits(odd.reshape(n, wide), axis=1, bitorder="little").view(np.int64)


class Verifier:
    """Exact Jaccard on the texts of candidate lines, which one scan of the documents gathers; sketches thin the candidates, as they are no longer than lines."""

    def __init__(self, docs: DataFrame, percent: int, ws: Workspace):
        self.docs, self.percent, self.ws, self.texts = docs, percent, ws, None

    def gather(self, ids: DataFrame) -> DataFrame:
        """Keep the text of each line in ids, and return n_shingles and a parity sketch of each.

        A bit table of bounded size thins the scan; a join then decides.  Where two lines meet in all 64 bits
        of id, one of them is kept, with its other hash h2.
        """
        table = bit_table(ids, "id")

        def run(batches):
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    data, offsets = text_bytes(part.column("text"))
                    s, t, _, _ = line_spans(data, offsets)
                    eight = eight_bytes(data)
                    h = hash_spans(data, s, t, 41, eight)
                    hit = np.flatnonzero(table.may_hold(h))
                    hit = hit[np.sort(np.unique(h[hit], return_index=True)[1])]
                    texts = [data[s[i] : t[i]].tobytes().decode("utf-8", "replace") for i in hit]
                    yield pa.RecordBatch.from_arrays([pa.array(h[hit].view(np.int64)), pa.array(hash_spans(data, s[hit], t[hit], 42, eight).view(np.int64)), pa.array(texts, pa.string())], names=["id", "h2", "text"])

        found = self.docs.select("text").mapInArrow(run, "id bigint, h2 bigint, text string").dropDuplicates(["id"])
        found = found.join(ids, "id", "left_semi")

        def marked(batches):
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    n, sketches = line_marks(part.column("text"))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * SKETCH_WORDS), pa.array(sketches.ravel()))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n), lists], names=["id", "h2", "text", "n_shingles", "sketch"])

        self.texts = self.ws.stored(found.mapInArrow(marked, "id bigint, h2 bigint, text string, n_shingles bigint, sketch array<bigint>"), "line-texts")
        return self.texts.select("id", "n_shingles", "sketch")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        x, y = self.texts.alias("x"), self.texts.alias("y")
        full = pairs.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id")).where(may_link(self.percent)("x", "y"))
        full = full.select("a", "b", F.col("x.text").alias("ta"), F.col("y.text").alias("tb"))
        percent = self.percent

        def run(batches):
            for batch in batches:
                for part in slices(batch, "tb", 1 << 20):
                    linked = []
                    for x, y in zip(_sets(part.column("ta")), _sets(part.column("tb"))):
                        i = len(np.intersect1d(x, y, assume_unique=True))
                        linked.append(100 * i >= percent * (len(x) + len(y) - i))
                    yield part.select(["a", "b"]).filter(pa.array(linked))

        return full.mapInArrow(run, "a bigint, b bigint")


def repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, k, n_lines, gone): each document with lines, and the numbers of those that an earlier line stands for; stored.

    A line is told by 128 bits (h1, h2); the search for links goes by h1, and its findings hold for the h2 that was verified.
    """
    with Workspace(docs.sparkSession) as ws:
        found = ws.stored(lines(docs), "lines")
        verify = Verifier(docs, percent, ws)
        keyed = found.where("pairs is not null").select("pairs")
        components = linked_components(ws.stored(shared_pairs(keyed), "shared-keys"), verify, verify.gather, may_link(percent), ws, thin=False)
        near = components.join(verify.texts.select("id", "h2"), "id").select(F.col("id").alias("h1"), "h2", F.col("component").alias("g1"), F.lit(0).cast("long").alias("g2"))
        equal = found.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
        equal = equal.join(near, ["h1", "h2"], "left_anti").select("h1", "h2", F.col("h1").alias("g1"), F.col("h2").alias("g2"))
        groups = ws.stored(near.unionByName(equal), "line-groups")
        # both sides of these joins are plain tables, so that adaptive execution can split a hot group
        members = ws.stored(found.drop("pairs", "n_lines").join(groups, ["h1", "h2"]).select("doc_id", "k", "line", "g1", "g2"), "members")
        own = F.struct("doc_id", "k", "line")
        first = ws.stored(members.groupBy("g1", "g2").agg(F.min(own).alias("first")), "first-lines")
        gone = members.join(first, ["g1", "g2"]).where(~own.eqNullSafe(F.col("first"))).select(F.col("doc_id").alias("d"), F.col("k").alias("k2"), "line")
        gone = gone.groupBy("d", "k2").agg(F.collect_set("line").alias("gone"))
        per_doc = found.where("n_lines is not null").select("doc_id", "k", "n_lines").distinct()
        out = per_doc.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("k2")), "left")
        return stored(out.select("doc_id", "k", "n_lines", F.coalesce("gone", F.array().cast("array<int>")).alias("gone")), "repeated-lines")


def line_report(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of docs: doc_id, n_lines (with a word), n_removed and removed (their numbers from 0, joined by commas)."""
    r = repeated_lines(docs, percent).select(F.col("doc_id").alias("d"), F.col("k").alias("k2"), "n_lines", "gone")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"))
    rows = rows.join(r, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("k2")), "left")
    return rows.select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join(F.array_sort("gone"), ","), F.lit("")).alias("removed"))


def _without(text: Column, gone: Column) -> Column:
    """A text less the lines of these numbers, at a cost linear in both; a null text, of a row that loses nothing, stays null."""

    def cut(text: str, numbers: np.ndarray) -> str:
        lost = set(numbers.tolist())
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lost)

    @F.pandas_udf("string")
    def each(texts: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else cut(t, g) for t, g in zip(texts, gone)], dtype=object)

    return each(text, gone)


def without_repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """docs with repeated lines cut from text (and n_chars, where there is one, counted anew).

    Documents that lose every line with a word go; those that never had one stay.
    """
    r = repeated_lines(docs, percent).where(F.size("gone") > 0)
    rows = docs.join(r, docs["doc_id"].eqNullSafe(r["doc_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == r["k"]), "left")
    rows = rows.where(r["gone"].isNull() | (r["n_lines"] > F.size(r["gone"])))
    left = _without(F.when(r["gone"].isNotNull(), docs["text"]), r["gone"])
    text = F.when(r["gone"].isNull(), docs["text"]).otherwise(left)
    columns = [docs[c] for c in docs.columns]
    columns[docs.columns.index("text")] = text.alias("text")
    if "n_chars" in docs.columns:
        n = F.when(r["gone"].isNull(), docs["n_chars"]).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
        columns[docs.columns.index("n_chars")] = n.alias("n_chars")
    return rows.select(*columns)
