"""SimHash near-duplicates by tiled exact comparison.

A text is lower-cased (A-Z) and cut into words; its n-word shingles, repeats included, are joined by one space (with
fewer words: the whole sequence) and hashed by XXH64 with seed 42 over UTF-8.  A bit of the fingerprint is 1 if
over half of the hashes have it.  Texts without words, nulls too, have fingerprint zero.  Two fingerprints link at a
Hamming distance of `radius` or less.

Distinct fingerprints are grouped into tiles by their population counts: of the whole, or of each of 2, 4, 8 or 16 equal parts
of the 64 bits, the more the more fingerprints there are.  Counts of two fingerprints differ, summed over the parts, by no more than the fingerprints
do; so a tile meets only tiles whose counts differ by `radius` or less, all others are skipped, and no link is lost.  Any number of parts gives the same links; it
keeps the work for each fingerprint about even as the input grows.  A tile with many members is cut into chunks by hash, so that
a group of near copies is dealt over many tasks.  A task compares two chunks with numpy's exclusive-or and bit counts, block by block, and
returns a spanning forest of the links within them, at most one link a member, never all pairs.  Components come from a distributed union-find.

Copies, and rows that share a fingerprint, are one node from the start.  A null doc_id gets a fingerprint but
belongs to no component (null component_id) and links nothing; repeated rows each give a row; other columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U, map_texts
from .components import connected_components
from .storage import Workspace, stored

SEED = 42
#: About how many different population counts the fingerprints of unlike texts have, by the number of parts.
SPREAD = {1: 10, 2: 140, 4: 4_000, 8: 1_000_000, 16: 50_000_000}
#: Fingerprints a tile has on average at most, members of a chunk, and of a block compared at once.
TILE, CHUNK, BLOCK = 2048, 8192, 256


def hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle of a text; none without words."""
    found = text.lower().split()  # bytes: A-Z alone are lower-cased, words end at 0x20 and 0x09-0x0D
    if not found:
        return np.zeros(0, U)
    joined = b" ".join(found)
    length = np.fromiter(map(len, found), np.int64, len(found))
    end = np.cumsum(length + 1) - 1
    start, n = end - length, min(words, len(found))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(start[: len(found) - n + 1].tolist(), end[n - 1 :].tolist())], U)


def fingerprint(h: np.ndarray) -> int:
    """The majority of each bit of the hashes."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[lo : lo + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fingerprint, as the signed long of its 64 bits, of each row."""

    def run(data: np.ndarray, offsets: np.ndarray):
        whole = data.tobytes()
        return [np.array([fingerprint(hashes(whole[a:b], words)) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], U).view(np.int64)]

    return map_texts(docs, ["doc_id"], run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def parts_for(count: int) -> int:
    """The least number of parts whose tiles hold TILE fingerprints or fewer on average."""
    return next((p for p, spread in SPREAD.items() if count <= spread * TILE), 16)


def counts_key(fp: str, parts: int) -> Column:
    """The population counts of the parts of a fingerprint, a field of 64 / parts bits each."""
    bits = 64 // parts
    mask = (1 << bits) - 1 if parts > 1 else -1
    fields = [F.shiftleft(F.bit_count(F.shiftrightunsigned(fp, bits * i).bitwiseAND(F.lit(mask).cast("bigint"))).cast("bigint"), bits * i) for i in range(parts)]
    return sum(fields[1:], fields[0])


def steps(parts: int, radius: int) -> list[int]:
    """What to add to a key to get those whose counts differ by the radius or less: of each such difference and its opposite one, with zero.

    A count that falls under zero borrows from the next field and leaves a value there that no count reaches.
    """
    bits, found = 64 // parts, {0}
    unit = [1 << (bits * i) for i in range(parts)]
    for n in range(1, radius + 1):
        for at in combinations([s * u for u in unit for s in (1, -1)] * n, n):
            found.add(sum(at))
    return sorted(x for x in found if x >= 0)


def links_within(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what links of the radius connect between two chunks (`same`: within one), at most one a member."""
    left, right = [], []
    x, y = a.view(U), b.view(U)  # of signed integers numpy counts the magnitude's bits
    for lo in range(0, len(a), BLOCK):
        i, j = np.nonzero(np.bitwise_count(x[lo : lo + BLOCK, None] ^ y[None, :]) <= radius)
        if same:
            i, j = i[i + lo < j], j[i + lo < j]
        if len(i):
            i, j = forest(i + lo, j + (0 if same else len(a)))
            left.append(i)
            right.append(j)
    if not left:
        return a[:0], a[:0]
    i, j = forest(np.concatenate(left), np.concatenate(right))
    every = a if same else np.concatenate([a, b])
    return every[i], every[j]


def forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (i, j) with the least node of its component, itself left out."""
    nodes, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    x, y = at[: len(i)], at[len(i) :]
    label = np.arange(len(nodes))
    while True:
        least, before = np.minimum(label[x], label[y]), label
        label = label.copy()
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        label = label[label]
        if (label == before).all():
            break
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def tiles(prints: DataFrame, parts: int) -> DataFrame:
    """(key, chunk, fps): distinct fingerprints (fp) by the counts of their parts, in chunks of about CHUNK members."""
    keyed = prints.select("fp", counts_key("fp", parts).alias("key"))
    chunks = keyed.groupBy("key").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = keyed.join(chunks, "key").select("key", F.pmod(F.xxhash64("fp"), "chunks").alias("chunk"), "fp")
    return dealt.groupBy("key", "chunk").agg(F.collect_list("fp").alias("fps"))


def links(prints: DataFrame, radius: int, ws: Workspace, parts: int | None = None) -> DataFrame:
    """(a, b): links that connect the components of distinct fingerprints (fp)."""
    parts = parts or parts_for(prints.count())
    tiled = ws.stored(tiles(prints, parts), "tiles")
    left = tiled.select("key", F.col("chunk").alias("other"), F.col("fps").alias("other_fps"), F.explode(F.array(*(F.lit(s).cast("bigint") for s in steps(parts, radius)))).alias("step"))
    left = left.select((F.col("key") + F.col("step")).alias("key"), "other", "other_fps", (F.col("step") == 0).alias("own"))
    met = left.join(tiled, "key").where(~F.col("own") | (F.col("other") <= F.col("chunk")))
    met = met.select("other_fps", "fps", (F.col("own") & (F.col("other") == F.col("chunk"))).alias("same"))

    def compare(batches):
        for batch in batches:
            one, two = batch.column("other_fps"), batch.column("fps")
            for i, same in enumerate(batch.column("same").to_pylist()):
                a, b = links_within(one[i].values.to_numpy(), two[i].values.to_numpy(), radius, same)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return met.mapInArrow(compare, "a bigint, b bigint")


def simhash_components(docs: DataFrame, radius: int = 2, words: int = 3) -> DataFrame:
    """Per row of docs: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable by links."""
    rows = stored(fingerprints(docs, words), "fingerprints")
    with Workspace(docs.sparkSession) as ws:
        least = ws.stored(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
        found = connected_components(links(least.select("fp"), radius, ws), ws)
        grown = least.join(found.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
        label = grown.groupBy("component").agg(F.min("least").alias("component_id"))
        named = stored(grown.join(label, "component").select("fp", "component_id"), "simhash-components")
    out = rows.join(named, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
