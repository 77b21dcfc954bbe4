"""Vectorised word, shingle and line arithmetic over Arrow text columns.

Everything here works on one slice of a batch inside a Spark task: a flat byte array with row
offsets.  Slices hold a few megabytes of text, so memory stays bounded however large a batch is; a
single text longer than that forms a slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
SLICE_BYTES = 4 << 20

#: The word separators 0x20 and 0x09-0x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Word separators of the classifiers and of decontamination, all ASCII that is neither letter nor digit.
NON_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2 = U(0xD6E8FEB86659FD93), U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = x ^ (x >> U(32))
    x *= _M1
    x ^= x >> U(29)
    x *= _M2
    x ^= x >> U(32)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers made from a seed."""
    return mix(np.arange(1, n + 1, dtype=U) * _M2 + U(seed)) | U(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets (from 0); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    _, off, data = column.buffers()
    o = np.frombuffer(off, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[o[0] : o[-1]], o - o[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES):
    """Cut a batch into row ranges of about `limit` text bytes."""
    _, off = text_bytes(batch.column(text))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + 4096)
        yield batch.slice(lo, hi - lo)
        lo = hi


def map_texts(df: DataFrame, keep: list[str], fn, schema: str, text: str = "text") -> DataFrame:
    """Apply fn(data, offsets) -> list of arrays, one value a row, to a text column.

    Returns the columns `keep` and then fn's, typed by `schema` (DDL for all of them).
    """

    def run(batches):
        names = None
        for batch in batches:
            for part in slices(batch, text):
                out = fn(*text_bytes(part.column(text)))
                cols = [part.column(k) for k in keep] + [x if isinstance(x, pa.Array) else pa.array(x) for x in out]
                names = names or [f"c{i}" for i in range(len(cols))]
                yield pa.RecordBatch.from_arrays(cols, names=fields)

    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).fieldNames()
    return df.select(*keep, text).mapInArrow(run, schema)


def word_spans(data: np.ndarray, offsets: np.ndarray, seps: np.ndarray = SEPARATORS):
    """Starts and ends of words in bytes, and each row's first word (length rows + 1)."""
    inside = ~seps[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    a, b = offsets[:-1][full], offsets[1:][full] - 1
    first[a], last[b] = inside[a], inside[b]
    s, t = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, t, np.searchsorted(s, offsets)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one integer; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ascontiguousarray(np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,)))


def hash_spans(data: np.ndarray, s: np.ndarray, t: np.ndarray, seed: int = 1, eight: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of byte ranges: the first 32 bytes in steps of eight, the rest as a sum over its steps."""
    eight = eight_bytes(data) if eight is None else eight
    length = t - s
    h = mix(length.astype(U) * _M2 + U(seed))
    todo, done = np.arange(len(s)), 0
    while len(todo) and done < 32:
        left = length[todo] - done
        x = eight[s[todo] + done]
        short = left < 8
        x[short] &= (U(1) << (left[short].astype(U) * U(8))) - U(1)
        h[todo] = mix(h[todo] ^ x)
        done += 8
        todo = todo[left > 8]
    if len(todo):
        n = (length[todo] - 25) // 8
        first = np.cumsum(n) - n
        own = np.repeat(np.arange(len(todo)), n)
        k = np.arange(len(own)) - first[own]
        x = eight[s[todo][own] + 32 + 8 * k]
        last = first + n - 1
        left = length[todo] - 24 - 8 * n
        x[last] &= np.where(left < 8, (U(1) << (left.astype(U) & U(7)) * U(8)) - U(1), ~U(0))
        h[todo] = mix(h[todo] + np.add.reduceat(mix(x + (k + 1).astype(U) * _M2), first))
    return h


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word, from the rows' first words."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int, seed: int = 7):
    """Hashes of k consecutive words within a row, and each row's first shingle."""
    n = len(words)
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    if n < k:
        return np.zeros(0, U), begin
    c = constants(k, seed)
    h = words[: n - k + 1] * c[0]
    for j in range(1, k):
        h += words[j : n - k + 1 + j] * c[j]
    row = rows_of(first)
    return mix(h[row[: n - k + 1] == row[k - 1 :]]), begin


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values within consecutive bounds; each depends on its own values alone."""
    out = np.zeros(len(bounds) - 1, np.float64 if values.dtype.kind == "f" else np.int64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(values[: bounds[-1]], bounds[:-1][full], dtype=out.dtype)
    return out
