"""Structure statistics of whole texts, shared by the quality rules and the quality classifier."""

from __future__ import annotations

import numpy as np

from .arrays import SEPARATORS, U, hash_spans, rows_of, shingle_hashes, sums, word_spans

#: The symbols that the statistics count.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
#: UTF-8 bytes that begin a code point.
LEADS = (np.arange(256) & 0xC0) != 0x80


def _repeats(keys: np.ndarray, begin: np.ndarray, rows: np.ndarray, later: bool) -> np.ndarray:
    """Marks keys that another position of the same row holds too; `later`: not the first of them."""
    order = np.lexsort((np.arange(len(keys)), keys, rows)) if later else np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    hit = np.zeros(len(keys), bool)
    if later:
        hit[order[1:]] = same
    else:
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
    return hit


def structure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row (longs)."""
    s, t, first = word_spans(data, offsets)
    in_word = ~SEPARATORS[data]
    chars = sums((LEADS[data] & in_word).astype(np.int8), offsets)
    symbols = sums(SYMBOLS[data].astype(np.int8), offsets)

    # words covered by three-word windows that the row holds twice or more
    words = hash_spans(data, s, t)
    grams, begin = shingle_hashes(words, first, 3)
    hit = _repeats(grams, begin, rows_of(begin), later=False)
    at = np.flatnonzero(hit)
    # a row's gram i covers words i, i+1 and i+2 of that row
    row = rows_of(begin)[at]
    at = at - begin[row] + first[row]
    covered = np.zeros(len(words), bool)
    for j in range(3):
        covered[at + j] = True
    repeat = sums(covered.astype(np.int8), first)

    # lines: a line ends at \n or at the row's end
    cut = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], cut + 1)
    starts = starts[starts < len(data)]
    ends = np.searchsorted(cut, starts)
    row = np.searchsorted(offsets, starts, "right") - 1
    stop = np.minimum(np.append(cut, len(data))[ends], offsets[row + 1])
    has_word = np.searchsorted(s, stop) > np.searchsorted(s, starts)
    starts, stop, row = starts[has_word], stop[has_word], row[has_word]
    dup = _repeats(hash_spans(data, starts, stop), None, row, later=True)
    n = len(offsets) - 1
    return {
        "n_words": np.diff(first).astype(np.int64),
        "word_chars": chars.astype(np.int64),
        "n_symbols": symbols.astype(np.int64),
        "n_dup_lines": np.bincount(row[dup], minlength=n).astype(np.int64),
        "n_repeat_words": repeat.astype(np.int64),
    }


def word_buckets(data, offsets, seps, bits: int, lower: np.ndarray):
    """Hash buckets of the words of a case-folded text under given separators."""
    folded = lower[data]
    s, t, first = word_spans(folded, offsets, seps)
    return (hash_spans(folded, s, t, 3) >> U(64 - bits)).astype(np.int64), s, first


def code_points(data: np.ndarray, offsets: np.ndarray):
    """The rows' code points and their offsets; malformed bytes are replaced first."""
    try:
        text = data.tobytes().decode()
    except UnicodeDecodeError:
        rows = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets, offsets[1:])]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        data = np.frombuffer(b"".join(rows), np.uint8)
        text = data.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return points, np.concatenate([[0], np.cumsum(LEADS[data])])[offsets]
