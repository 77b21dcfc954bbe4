"""SentencePiece encoding and decoding by a max-plus parallel scan.

The best segmentation of a text into vocabulary pieces maximises the sum of piece scores (Viterbi).
Scores are integers, so sums are exact in any order.  A unigram model's own log-probabilities serve
as scores; a BPE model stores merge ranks instead, so its piece of rank r gets Zipf's -log(r + 1), less
PIECE_COST for each piece: short segmentations win, frequent pieces decide among them.  Such ids are of the
model's vocabulary and decode exactly, but aren't always those of its own merges (README).
As in SentencePiece, a space is put before a text, spaces are part of pieces, and a code point that
no piece covers falls back to its UTF-8 bytes; U+2581 in a text counts as such, so that decoding
gives every text back exactly.

Texts of up to `chunk_chars` code points are encoded by themselves.  Longer ones are split into
chunks, one row each, spread over the cluster.  A piece may straddle a chunk's end by s < L code
points: that is the boundary state.  Each chunk yields a transfer matrix: best score from each entry
state to each exit state.  Max-plus products, which are associative, combine matrices in groups of
`FAN` (up-sweep), level by level; from each group's entry and exit state the states between follow
(down-sweep), and each chunk backtraces by itself.  Spaces force a cut before a word (no piece has a
space after another character), which keeps matrices cheap; texts without spaces work as well.

Null and empty texts have no piece and decode to the empty string.  Equal texts, so also repeated rows, are encoded alike;
other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, constants, hash_spans, mix, slices, text_bytes
from .text_stats import code_points

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SCALE, FAN = 10_000, 256
PIECE_COST = 10.0
LOW, LOW32 = -(1 << 60), -(1 << 30)
#: Units up to so many code points are segmented together, column by column; longer ones one by one.
WIDE = 64
_STEP = constants(2, 808)
#: A unit: what lies between two forced cuts.
UNIT = re.compile(r" *[^ ]+| +")


@dataclass
class Vocabulary:
    pieces: list[bytes]  # what each id decodes to
    ids: dict[str, int]
    scores: dict[str, int]
    bytes_at: int  # id of byte 0
    unknown: int  # score of a code point that falls back to bytes
    longest: int
    reach: dict[str, int]  # longest piece that begins with this code point
    mask: np.ndarray  # by hash slot: 1 a prefix of a piece, 2 a piece
    keys: np.ndarray  # sorted hashes of the pieces
    key_ids: np.ndarray
    key_scores: np.ndarray


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> U(31))) * _STEP[1]) >> U(44)


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a SentencePiece model file (on the driver)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    usual = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    scores = {i: sp.get_score(i) for i in usual}
    ranks = all(float(s).is_integer() for s in scores.values())
    value = {i: round(SCALE * (-math.log(r + 1) - PIECE_COST if ranks else scores[i])) for r, i in enumerate(usual, 1)}
    text = {i: sp.id_to_piece(i).replace("▁", " ") for i in usual}
    pieces = [text[i].encode() if i in text else b"" for i in range(n)]
    zero = sp.piece_to_id("<0x00>")
    for b in range(256):
        pieces[zero + b] = bytes([b])
    reach: dict[str, int] = {}
    for x in text.values():
        reach[x[0]] = max(reach.get(x[0], 0), len(x))
    mask, keys = np.zeros(1 << 20, np.uint8), {}
    for i, x in text.items():
        h = np.zeros(1, U)
        for c in x:
            h = (h + U(ord(c) + 1)) * _STEP[0]
            mask[_slot(h)] |= 1
        mask[_slot(h)] |= 2
        keys[int(h[0])] = i
    order = np.array(sorted(keys), U)
    key_ids = np.array([keys[int(k)] for k in order], np.int32)
    key_scores = np.array([value[int(i)] for i in key_ids], np.int32)
    return Vocabulary(pieces, {x: i for i, x in text.items()}, {x: value[i] for i, x in text.items()}, zero, min(value.values()) - 10 * SCALE, max(map(len, text.values())), reach, mask, order, key_ids, key_scores)


def forward(v: Vocabulary, text: str, lo: int, hi: int, entry: int) -> tuple[list[int], list[int]]:
    """Best scores and last piece lengths at positions lo..hi + L - 1, for pieces that begin in [entry, hi) from `entry`.

    Pieces may end past hi (into what follows) but not past the text.
    """
    size = min(len(text), hi + v.longest - 1) - lo + 1
    best, back = [LOW] * size, [0] * size
    best[entry - lo] = 0
    get, reach, n = v.scores.get, v.reach, len(text)
    for i in range(entry, hi):
        b = best[i - lo]
        if b <= LOW:
            continue
        k = i + 1 - lo
        if b + v.unknown > best[k]:
            best[k], back[k] = b + v.unknown, 1
        for j in range(i + 1, min(i + reach.get(text[i], 0), n) + 1):
            s = get(text[i:j])
            if s is not None and b + s > best[j - lo]:
                best[j - lo], back[j - lo] = b + s, j - i
    return best, back


def _ids(v: Vocabulary, piece: str) -> list[int]:
    i = v.ids.get(piece)
    return [i] if i is not None else [v.bytes_at + b for b in piece.encode()]


def trace(v: Vocabulary, text: str, lo: int, back: list[int], entry: int, exit: int) -> list[int]:
    """The ids of the best path from entry to exit."""
    cuts, at = [], exit
    while at > entry:
        cuts.append(at)
        at -= back[at - lo]
    out: list[int] = []
    for b in reversed(cuts):
        out += _ids(v, text[b - back[b - lo] : b])
    return out


def encode_unit(v: Vocabulary, unit: str) -> tuple[list[int], int]:
    """Ids and score of one unit."""
    best, back = forward(v, unit, 0, len(unit), 0)
    return trace(v, unit, 0, back, 0, len(unit)), best[len(unit)]


def _matches(v: Vocabulary, points: np.ndarray, at: np.ndarray, left: np.ndarray):
    """Score and id of the piece of each length that begins at each position; code points without one fall back."""
    scores = np.full((v.longest + 1, len(at)), LOW32, np.int32)
    ids = np.full((v.longest + 1, len(at)), -1, np.int32)
    live, h = np.arange(len(at)), np.zeros(len(at), U)
    for k in range(1, v.longest + 1):
        fits = left[live] >= k
        live, h = live[fits], h[fits]
        h = (h + points[at[live] + (k - 1)].astype(U) + U(1)) * _STEP[0]
        kind = v.mask[_slot(h)]
        hit = np.flatnonzero(kind & 2)
        place = np.minimum(np.searchsorted(v.keys, h[hit]), len(v.keys) - 1)
        same = v.keys[place] == h[hit]
        hit, place = live[hit[same]], place[same]
        scores[k, hit], ids[k, hit] = v.key_scores[place], v.key_ids[place]
        more = (kind & 1).astype(bool)
        live, h = live[more], h[more]
    scores[1, ids[1] < 0] = v.unknown
    return scores, ids


def _utf8(points: np.ndarray):
    """Lengths of code points in UTF-8, and a (points, 4) array of their bytes."""
    p = points.astype(np.int64)
    n = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
    tail = lambda shift: 0x80 | (p >> shift) & 0x3F
    rows = [np.stack(x, 1) for x in ([p, p, p, p], [0xC0 | p >> 6, tail(0), p, p], [0xE0 | p >> 12, tail(6), tail(0), p], [0xF0 | p >> 18, tail(12), tail(6), tail(0)])]
    return n, np.choose((n - 1)[:, None], rows)


def segment(v: Vocabulary, points: np.ndarray, s: np.ndarray, t: np.ndarray):
    """Best segmentations of spans of code points, each a unit: (ids, bounds of each span's ids, scores)."""
    m = len(s)
    order = np.argsort(s - t, kind="stable")  # longest first
    s, t = s[order], t[order]
    n = t - s
    start = np.cumsum(n) - n
    span = np.repeat(np.arange(m), n)
    inner = np.arange(len(span)) - start[span]
    scores, ids = _matches(v, points, s[span] + inner, n[span] - inner)
    base = start + np.arange(m)
    best, back = np.full(len(span) + m, LOW, np.int64), np.zeros(len(span) + m, np.int8)
    best[base] = 0
    for j in range(1, int(n[0]) + 1 if m else 0):
        c = int(np.searchsorted(-n, -j, "right"))
        top, last = np.full(c, LOW, np.int64), np.zeros(c, np.int8)
        for k in range(min(j, v.longest), 0, -1):
            x = best[base[:c] + j - k] + scores[k, start[:c] + j - k]
            better = x > top
            top[better], last[better] = x[better], k
        best[base[:c] + j], back[base[:c] + j] = top, last
    who, when, what, at, step = [], [], [], n.copy(), 0
    live = np.arange(m)
    while len(live):
        k = back[base[live] + at[live]].astype(np.int64)
        at[live] -= k
        place = start[live] + at[live]
        found = ids[k, place].astype(np.int64)
        lost = found < 0
        found[lost] = -1 - points[s[live[lost]] + at[live[lost]]].astype(np.int64)
        who.append(live)
        when.append(np.full(len(live), -step))
        what.append(found)
        live, step = live[at[live] > 0], step + 1
    who, when, what = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, when, what))
    who = order[who]
    sort = np.lexsort((when, who))
    who, what = who[sort], what[sort]
    lost = np.flatnonzero(what < 0)
    if len(lost):
        size, raw = _utf8(-1 - what[lost])
        times = np.ones(len(what), np.int64)
        times[lost] = size
        first = np.cumsum(times) - times
        who, what = np.repeat(who, times), np.repeat(what, times)
        for b in range(4):
            has = size > b
            what[first[lost[has]] + b] = v.bytes_at + raw[has, b]
    total = np.empty(m, np.int64)
    total[order] = best[base + n]
    return what.astype(np.int32), np.searchsorted(who, np.arange(m + 1)), total


class Memo:
    """Encodings of the distinct units that a task has met, by hash; emptied when it holds more than `most` units or 16 times as many ids."""

    def __init__(self, most: int = 1 << 17):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.flat = np.zeros(0, U), np.zeros(0, np.int32)
        self.begin, self.size, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys) > self.most or len(self.flat) > 16 * self.most:
            self.clear()
        if not len(self.keys):
            return np.ones(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys

    def add(self, keys: np.ndarray, flat: np.ndarray, size: np.ndarray, score: np.ndarray) -> None:
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, flat])
        order = np.argsort(both := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = both[order]
        self.begin, self.size, self.score = (np.concatenate(c)[order] for c in ((self.begin, begin), (self.size, size), (self.score, score)))


def _encode_distinct(v: Vocabulary, points: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Ids of distinct units end to end, their numbers of ids, and scores."""
    short = b - a <= WIDE
    flat, bounds, total = segment(v, points, a[short], b[short])
    size, score = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    size[short], score[short] = np.diff(bounds), total
    long = {}
    for i in np.flatnonzero(~short):
        long[i], score[i] = encode_unit(v, points[a[i] : b[i]].tobytes().decode("utf-32-le"))
        size[i] = len(long[i])
    begin = np.cumsum(size) - size
    ids = np.empty(int(size.sum()), np.int32)
    ids[np.repeat(short, size)] = flat
    for i, x in long.items():
        ids[begin[i] : begin[i] + size[i]] = x
    return ids, size, score


def encode_points(v: Vocabulary, points: np.ndarray, s: np.ndarray, t: np.ndarray, memo: Memo | None = None):
    """Ids of many units in order, bounds of each unit's ids, and scores; equal units are segmented once, also across calls with one memo."""
    memo = memo or Memo()
    h = hash_spans(np.ascontiguousarray(points).view(np.uint8), 4 * s, 4 * t, 5)
    keys, first, number = np.unique(h, return_index=True, return_inverse=True)
    new = memo.missing(keys)
    if new.any():
        memo.add(keys[new], *_encode_distinct(v, points, s[first[new]], t[first[new]]))
    place = np.searchsorted(memo.keys, keys)[number]
    n = memo.size[place]
    ends = np.cumsum(n)
    take = np.arange(int(ends[-1]) if len(n) else 0) + np.repeat(memo.begin[place] - (ends - n), n)
    return memo.flat[take], np.concatenate([[0], ends]), memo.score[place]


def units(points: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the units of texts: a unit begins at a text's start and at each space after another character."""
    space = points == 32
    head = np.zeros(len(points), bool)
    head[1:] = space[1:] & ~space[:-1]
    full = offsets[1:] > offsets[:-1]
    head[offsets[:-1][full]] = True
    s = np.flatnonzero(head)
    return s, np.append(s[1:], len(points))


def encode_texts(v: Vocabulary, data: np.ndarray, offsets: np.ndarray, memo: Memo | None = None):
    """Ids of whole texts, and bounds of each text's ids."""
    points, offsets = code_points(data, offsets)
    full = np.diff(offsets) > 0
    shift = np.cumsum(full)  # a space before each text that isn't empty
    spaced = np.full(len(points) + int(full.sum()), 32, np.uint32)
    spaced[np.arange(len(points)) + np.repeat(shift, np.diff(offsets))] = points
    offsets = offsets + np.concatenate([[0], shift])
    s, t = units(spaced, offsets)
    ids, bounds, _ = encode_points(v, spaced, s, t, memo)
    return ids, bounds[np.searchsorted(s, offsets)]


def encode_text(v: Vocabulary, text: str) -> list[int]:
    """Ids of a whole text, one forced unit after another: the plain form of encode_texts."""
    out: list[int] = []
    for unit in UNIT.findall(" " + text) if text else ():
        out += encode_unit(v, unit)[0]
    return out


def _encode_units(v: Vocabulary, text: str, memo: Memo | None = None):
    """Ids and score of a string that begins and ends at forced cuts."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    s, t = units(points, np.array([0, len(points)]))
    ids, _, score = encode_points(v, points, s, t, memo)
    return ids.tolist(), int(score.sum())


def score_of(v: Vocabulary, text: str, ids: list[int]) -> int:
    """The score of an encoding; a run of bytes scores by its code points."""
    total, n_bytes = 0, []
    for i in ids:
        if v.bytes_at <= i < v.bytes_at + 256:
            n_bytes.append(v.pieces[i])
        else:
            total += v.scores[v.pieces[i].decode()]
    return total + v.unknown * len(b"".join(n_bytes).decode())


def _cuts(text: str, lo: int, hi: int) -> tuple[int, int]:
    """First and last forced cut in (lo, hi], or (-1, -1)."""
    first = last = -1
    for m in re.compile(r"(?<=[^ ]) ").finditer(text, lo, min(hi + 1, len(text))):
        if m.start() > lo:
            first = m.start() if first < 0 else first
            last = m.start()
    return first, last


def transfer(v: Vocabulary, text: str, lo: int, hi: int, memo: Memo | None = None) -> np.ndarray:
    """The transfer matrix of chunk [lo, hi) of a text given with one code point before and L - 1 after."""
    m = np.full((v.longest, v.longest), LOW, np.int64)
    first, last = _cuts(text, lo, hi)
    exits = min(v.longest, len(text) - hi + 1)
    if first < 0:
        for s in range(min(v.longest, hi - lo + 1)):
            if lo + s <= hi:
                m[s, :exits] = forward(v, text, lo, hi, lo + s)[0][hi - lo : hi - lo + exits]
        return m
    middle = _encode_units(v, text[first:last], memo)[1]
    head = np.array([forward(v, text[:first], lo, first, lo + s)[0][first - lo] if lo + s <= first else LOW for s in range(v.longest)], np.int64)
    tail = np.full(v.longest, LOW, np.int64)
    stop = _next_cut(text, hi)
    t = forward(v, text[:stop], last, hi, last)[0]
    for s in range(min(exits, stop - hi + 1)):
        tail[s] = t[hi - last + s]
    total = head[:, None] + middle + tail[None, :]
    return np.where((head[:, None] > LOW // 2) & (tail[None, :] > LOW // 2), total, LOW)


def _next_cut(text: str, at: int) -> int:
    m = re.compile(r"(?<=[^ ]) ").search(text, at)
    return m.start() if m else len(text)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus matrix product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), LOW)


def states(matrices: list[np.ndarray], entry: int, exit: int) -> list[int]:
    """The boundary states before each matrix on a best path from entry to exit."""
    ahead = [np.full(len(matrices[0]), LOW, np.int64)]
    ahead[0][entry] = 0
    for m in matrices[:-1]:
        ahead.append(np.maximum((ahead[-1][:, None] + m).max(0), LOW))
    out = [exit]
    for a, m in zip(reversed(ahead), reversed(matrices)):
        out.append(int((a + m[:, out[-1]]).argmax()))
    return out[:0:-1]


def backtrace(v: Vocabulary, text: str, lo: int, hi: int, entry: int, exit: int, memo: Memo | None = None) -> list[int]:
    """Ids of the pieces that begin in the chunk, from entry state to exit state."""
    a, b = lo + entry, hi + exit
    first, last = _cuts(text, lo, hi)
    if first < 0 or a >= hi:
        return trace(v, text, lo, forward(v, text, lo, hi, a)[1], a, b) if a < hi else []
    out = trace(v, text, lo, forward(v, text[:first], lo, first, a)[1], a, first)
    out += _encode_units(v, text[first:last], memo)[0]
    return out + (trace(v, text, last, forward(v, text[:b], last, hi, last)[1], last, b) if last < hi else [])


def _chunks(giants: DataFrame, v_longest: int, size: int) -> DataFrame:
    """(blob, chunk, piece, lo, hi): each chunk's text with one code point before and longest - 1 after it."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = " " + text
                starts = list(range(0, len(text), size))
                for a in range(0, len(starts), 64):
                    rows = [(key, i, text[max(0, i * size - 1) : (i + 1) * size + v_longest], min(1, i), min(1, i) + min(size, len(text) - i * size)) for i in range(a, min(a + 64, len(starts)))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["blob", "chunk", "piece", "lo", "hi"])

    return giants.mapInArrow(run, "blob string, chunk bigint, piece string, lo bigint, hi bigint")


def _scan(matrices: DataFrame, depth: int) -> DataFrame:
    """(blob, at, entry, exit) for each matrix (blob, at, m), by `depth` levels of products in groups of FAN."""
    side = lambda raw: np.frombuffer(raw, np.int64).reshape(math.isqrt(len(raw) // 8), -1)

    def up(pdf):
        ms = [side(x) for x in pdf.sort_values("at")["m"]]
        total = ms[0]
        for m in ms[1:]:
            total = product(total, m)
        return pdf.head(1)[["blob"]].assign(at=int(pdf["at"].min()) // FAN, m=total.tobytes())

    def down(pdf):
        pdf = pdf.sort_values("at")
        ms = [side(x) for x in pdf["m"]]
        inner = states(ms, int(pdf["entry"].iloc[0]), int(pdf["exit"].iloc[0]))
        return pdf[["blob", "at"]].assign(entry=inner, exit=[*inner[1:], int(pdf["exit"].iloc[0])])

    if depth == 0:  # one matrix a text: from state 0 to state 0
        return matrices.select("blob", "at", F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("exit"))
    group = (F.col("at") / FAN).cast("long").alias("group")
    above = _scan(matrices.groupBy("blob", group).applyInPandas(up, "blob string, at bigint, m binary"), depth - 1)
    return matrices.withColumn("group", group).join(above.withColumnRenamed("at", "group"), ["blob", "group"]).groupBy("blob", "group").applyInPandas(down, "blob string, at bigint, entry bigint, exit bigint")


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: list[str], chunk_chars: int = 1 << 15) -> DataFrame:
    """Columns `keep` and ids (array of int) of each row's whole text."""
    v = vocabulary
    spark = docs.sparkSession
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    schema = StructType([docs.schema[k] for k in keep] + [StructField("ids", ArrayType(IntegerType()))])

    def short(batches):
        memo = Memo()
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                ids, bounds = encode_texts(v, *text_bytes(part.column("__text")), memo)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], lists], names=schema.fieldNames())

    giant = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    direct = docs.where(~giant).select(*keep, F.col("text").alias("__text")).mapInArrow(short, schema)
    longest = docs.agg(F.max(F.length("text"))).first()[0] or 0
    if longest <= chunk_chars:
        return direct
    depth, n = 0, math.ceil((longest + 1) / chunk_chars)
    while n > 1:
        depth, n = depth + 1, math.ceil(n / FAN)

    giants = docs.where(giant).select("text").withColumn("blob", F.sha2("text", 256))
    from .storage import Workspace, stored

    parts = spark.sparkContext.defaultParallelism * 2
    chunks = stored(_chunks(giants.dropDuplicates(["blob"]).select("blob", "text"), v.longest, chunk_chars).repartition(parts, "blob", "chunk"), "chunks")

    def matrix(batches):
        memo = Memo()
        for batch in batches:
            d = batch.to_pydict()
            ms = [transfer(v, t, lo, hi, memo).tobytes() for t, lo, hi in zip(d["piece"], d["lo"], d["hi"])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ms, pa.binary())], names=["blob", "at", "m"])

    with Workspace(spark) as ws:
        matrices = ws.stored(chunks.mapInArrow(matrix, "blob string, at bigint, m binary"), "matrices")
        bounds = stored(_scan(matrices, depth).withColumnRenamed("at", "chunk"), "bounds")

    def traced(batches):
        memo = Memo()
        for batch in batches:
            d = batch.to_pydict()
            ids = [np.array(backtrace(v, t, lo, hi, a, b, memo), "<i4").tobytes() for t, lo, hi, a, b in zip(*(d[k] for k in ("piece", "lo", "hi", "entry", "exit")))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["blob", "chunk", "ids"])

    pieces = chunks.join(bounds, ["blob", "chunk"]).select("blob", "chunk", "piece", "lo", "hi", "entry", "exit").mapInArrow(traced, "blob string, chunk bigint, ids binary")

    def whole(pdf):
        import pandas as pd

        return pd.DataFrame({"blob": [pdf["blob"].iloc[0]], "ids": [np.frombuffer(b"".join(pdf.sort_values("chunk")["ids"]), "<i4")]})

    joined = pieces.groupBy("blob").applyInPandas(whole, "blob string, ids array<int>")
    rows = docs.where(giant).select(*(F.col(k).alias(f"__{k}") for k in keep), F.sha2("text", 256).alias("blob"))
    long = rows.join(joined, "blob").select(*(F.col(f"__{k}").alias(k) for k in keep), "ids")
    return direct.unionByName(long)


def decode_ids(v: Vocabulary, ids) -> str:
    return b"".join([v.pieces[i] for i in ids]).decode("utf-8", "replace")[1:]


def decode_lists(v: Vocabulary, pieces: pa.Array, lists: pa.ListArray) -> pa.Array:
    """The texts of a column of id lists; pieces: those of the vocabulary, as Arrow bytes.

    Taking the pieces of all ids lays the texts' bytes end to end.  Texts that don't start with a space
    or aren't valid UTF-8, which no encoding gives, are decoded one by one.
    """
    joined = pieces.take(lists.flatten())
    _, off, data = joined.buffers()
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()], np.int64)
    bounds = np.frombuffer(off, np.int32)[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int64)
    full = bounds[1:] > bounds[:-1]
    data = data[bounds[0] : bounds[-1]]
    heads = bounds[:-1][full] - bounds[0]
    if (data[heads] == 32).all():
        try:
            text = np.delete(data, heads).tobytes()
            text.decode()
            ends = (bounds - bounds[0] - np.concatenate([[0], np.cumsum(full)])).astype(np.int32)
            return pa.StringArray.from_buffers(len(lists), pa.py_buffer(ends), pa.py_buffer(text))
        except UnicodeDecodeError:
            pass
    return pa.array([decode_ids(v, x or ()) for x in lists.to_pylist()], pa.string())


def decode(tokens: DataFrame, vocabulary: Vocabulary, keep: list[str]) -> DataFrame:
    """Columns `keep` and text: the pieces of `ids` joined, without the space put first."""
    v = vocabulary
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([tokens.schema[k] for k in keep] + [StructField("text", StringType())])

    def run(batches):
        pieces = pa.array(v.pieces, pa.binary())
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], decode_lists(v, pieces, part.column(len(keep)))], names=schema.fieldNames())

    return tokens.select(*keep, "ids").mapInArrow(run, schema)
