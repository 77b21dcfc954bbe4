"""Distributed union-find and the search for links among rows that share keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Workspace, stored

#: Bits a listed id gets in a bit table, and the most bits a table has (8 MB).
BITS_AN_ID, MOST_BITS = 16, 26
#: Edges that a task makes stars of at once.
MOST_EDGES = 1 << 21


@dataclass
class BitTable:
    """Whether a 64-bit hash may be one of those listed."""

    words: np.ndarray
    shift: int

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(np.uint64) >> np.uint64(self.shift)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_table(hashes: DataFrame, column: str) -> BitTable:
    """A table with a bit set at h >>> shift for each 64-bit hash h in a column.

    It holds up to 2^MOST_BITS bits, so its size on the driver and in each task is bounded.  It only thins a
    scan before a join, which decides; with far more than 2^(MOST_BITS - 4) hashes it thins less and the join does more.
    """
    count = hashes.count()
    bits = min(MOST_BITS, max(16, (BITS_AN_ID * max(count, 1)).bit_length()))
    place = F.shiftrightunsigned(column, 64 - bits)
    words = hashes.groupBy(F.shiftrightunsigned(place, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")).alias("b")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return BitTable(table.view(np.uint64), 64 - bits)


def _inner(edges: DataFrame) -> DataFrame:
    """(id, m): the ids of edges (a, b) that keep them from being stars, being a b as well as an a or an a of several b; m is their least b."""
    ends = edges.select(F.col("a").alias("id"), "b").unionByName(edges.select(F.col("b").alias("id"), F.lit(None).cast("long").alias("b")))
    ends = ends.groupBy("id").agg(F.min("b").alias("m"), F.max("b").alias("most"), F.max(F.col("b").isNull()).alias("centre"))
    return ends.where("m is not null and (centre or m < most)").select("id", "m")


def _own_stars(batches):
    """A task's edges (a, b) as stars around the smallest id of what they join, some MOST_EDGES at a time."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            n += batch.num_rows
        if n >= MOST_EDGES:
            yield from _stars_of(held)
            held, n = [], 0
    if held:
        yield from _stars_of(held)


def _stars_of(held: list[tuple[np.ndarray, np.ndarray]]):
    """Stars of edges (a, b): each root joins its least neighbour, until none has one."""
    ids, place = np.unique(np.concatenate([x for pair in zip(*held) for x in pair]), return_inverse=True)
    x, y = np.split(place, 2)
    root = np.arange(len(ids))
    while (root[x] != root[y]).any():
        u, v = root[x], root[y]
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root != root[root]).any():
            root = root[root]
    far = np.flatnonzero(root != np.arange(len(ids)))
    for i in range(0, len(far), 1 << 16):
        at = far[i : i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[root[at]])], names=["a", "b"])


def connected_components(edges: DataFrame, keep: Workspace | None = None) -> DataFrame:
    """(id, component) of every id in edges (a, b), component being its smallest reachable id; stored, in the workspace `keep` if one is given.

    Ids are integers.  Each task makes stars of the edges that it holds.  Rounds end when in all of them no a is a b too or has
    several b; until then those that are go to a table with their least b, m, which is joined to both ends.  An a keeps one
    edge, to the m of its least b; its other edges (a, b) become edges of b's m and a's least b.  Each b stays joined to its m by its own
    edges, so nothing comes apart; edges never grow in number, and pointers jump, so that a component's width takes
    logarithmically many rounds.  Tables are plain, so that adaptive execution can broadcast the small one or split a
    hub's join; results go to shared storage.  An empty table of edges gives no rows.
    """
    with Workspace(edges.sparkSession) as ws:
        now = ws.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).mapInArrow(_own_stars, "a bigint, b bigint"), "edges")
        while True:
            inner = ws.stored(_inner(now), "inner")
            if not inner.take(1):
                break
            up = lambda c: inner.select(F.col("id").alias(c), F.col("m").alias(f"m{c}"))
            both = now.join(up("a"), "a", "left").join(up("b"), "b", "left").select("a", "b", F.coalesce("ma", "b").alias("ma"), F.coalesce("mb", "b").alias("mb"))
            least = F.col("b") == F.col("ma")
            both = both.select(F.when(least, F.col("a")).otherwise(F.greatest("ma", "mb")).alias("a"), F.when(least, F.col("mb")).otherwise(F.least("ma", "mb")).alias("b"))
            before, now = now, ws.stored(both.where("a <> b").mapInArrow(_own_stars, "a bigint, b bigint"), "edges")
            ws.drop(before, inner)
        ends = now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")))
        return (keep.stored if keep else stored)(ends.distinct(), "components")


def shared_rows(rows: DataFrame, once: bool = False) -> DataFrame:
    """The rows (key, id) whose key another id has too; rows are read twice.  `once` says that no row repeats; then size, the key's number of ids, follows."""
    if once:
        return rows.join(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")
    return rows.join(rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key"), "key").distinct()


def repeated_heads(lists: DataFrame) -> DataFrame:
    """(h): what keys that several rows of lists (id, keys) hold begin with, h's other bits being zero; keys are 64-bit hashes, nearly all of which one row holds.

    Tasks send four bytes a key, in a row for each of the ranges that the leading bits make: the next 32 bits.  A range's
    are sorted as an array; there are several ranges for each of the session's shuffle partitions.  Of a key that a task meets often it sends two.
    """
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = (8 * parts - 1).bit_length()

    def pack(batches):
        for keys in _key_blocks(batches):
            keys = np.sort(keys)
            keys = keys[np.r_[True, True, keys[2:] != keys[:-2]][: len(keys)]]
            place = (keys >> np.uint64(64 - bits)).astype(np.int32)
            cut = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            blobs = [x.tobytes() for x in np.split((keys >> np.uint64(32 - bits)).astype(np.uint32), cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(place[cut]), pa.array(blobs, pa.binary())], names=["place", "nexts"])

    def repeated(batches):
        own = {}
        for batch in batches:
            for k, x in zip(batch.column("place").to_pylist(), batch.column("nexts")):
                own.setdefault(k, []).append(np.frombuffer(x.as_buffer(), np.uint32))
        for k, blobs in own.items():
            nexts = np.sort(np.concatenate(blobs))
            twice = np.unique(nexts[1:][nexts[1:] == nexts[:-1]]).astype(np.uint64)
            heads = np.uint64(k) << np.uint64(64 - bits) | twice << np.uint64(32 - bits)
            yield pa.RecordBatch.from_arrays([pa.array(heads.view(np.int64))], names=["h"])

    packed = lists.select("keys").mapInArrow(pack, "place int, nexts binary")
    return packed.repartition(parts, "place").mapInArrow(repeated, "h bigint")


def shared_of_lists(lists: DataFrame, ws: Workspace) -> DataFrame:
    """shared_rows, with sizes, of the rows (key, id) of lists (id, keys), where nearly every key has one id and an id's keys differ; lists are read twice.

    Only rows whose key begins like a repeated one are made and shuffled, and a bit table tells these.
    """
    heads = ws.stored(repeated_heads(lists), "heads-of-keys")
    table = bit_table(heads, "h")

    def near(batches):
        for batch in batches:
            keys = batch.column("keys")
            flat, ends = keys.flatten().to_numpy(), np.cumsum(keys.value_lengths().to_numpy())
            hit = np.flatnonzero(table.may_hold(flat))
            ids = batch.column("id").to_numpy()[np.searchsorted(ends, hit, "right")]
            yield pa.RecordBatch.from_arrays([pa.array(flat[hit]), pa.array(ids)], names=["key", "id"])

    return shared_rows(ws.stored(lists.mapInArrow(near, "key bigint, id bigint"), "near-keys"), once=True)


def _key_blocks(batches, most: int = 1 << 20):
    """The keys of batches (keys) as unsigned numbers, some `most` at a time."""
    held, n = [], 0
    for batch in batches:
        flat = batch.column("keys").flatten().to_numpy().view(np.uint64)
        for i in range(0, len(flat), most):
            held.append(flat[i : i + most])
            n += len(held[-1])
            if n >= most:
                yield np.concatenate(held)
                held, n = [], 0
    if n:
        yield np.concatenate(held)


def shared_pairs(rows: DataFrame) -> DataFrame:
    """shared_rows, with sizes, for integer keys and ids, where nearly every key has one id: tasks send packed pairs, a row for each bucket of keys, and sort a bucket as arrays.

    A task holds its buckets' pairs, 16 bytes each, and the buckets are several for each of the session's shuffle partitions.  rows: (keys, id), keys being an array, or (pairs), bytes of packed_pairs.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 8 * parts

    def pack(batches):
        for pairs in _gathered(batches):
            bucket = (pairs["key"].view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(bucket)
            pairs, bucket = pairs[order], bucket[order]
            cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            blobs = [x.tobytes() for x in np.split(pairs, cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "pairs"])

    def shared(batches):
        blobs = [x for b in batches for x in b.column("pairs").to_pylist()]
        if not blobs:
            return
        pairs = np.frombuffer(b"".join(blobs), _PAIR)
        key = np.sort(pairs["key"])
        twice = key[1:][key[1:] == key[:-1]]
        if not len(twice):
            return
        # the few that share a key; of these, distinct pairs, and then again the keys that more than one of them has
        at = np.minimum(np.searchsorted(twice, pairs["key"]), len(twice) - 1)
        few = np.unique(pairs[twice[at] == pairs["key"]])
        key = few["key"]
        same = key[1:] == key[:-1]
        few = few[np.r_[False, same] | np.r_[same, False]]
        _, place, count = np.unique(few["key"], return_inverse=True, return_counts=True)
        out = few["key"].copy(), few["id"].copy(), count[place]
        for i in range(0, len(few), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in out], names=["key", "id", "size"])

    packed = rows.mapInArrow(pack, "bucket int, pairs binary")
    return packed.repartition(parts, "bucket").select("pairs").mapInArrow(shared, "key bigint, id bigint, size bigint")


_PAIR = np.dtype([("key", np.int64), ("id", np.int64)])


def packed_pairs(keys: pa.ListArray, ids: np.ndarray) -> np.ndarray:
    """Pairs (key, id) of lists of keys, each list's with its id."""
    pairs = np.empty(len(keys.flatten()), _PAIR)
    pairs["key"], pairs["id"] = keys.flatten().to_numpy(), np.repeat(ids, keys.value_lengths().to_numpy())
    return pairs


def _gathered(batches, most: int = 1 << 20):
    """Pairs (key, id) of batches (keys, id) or (pairs), some `most` at a time."""
    held, n = [], 0
    for batch in batches:
        if "pairs" in batch.schema.names:
            found = [np.frombuffer(x.as_buffer(), _PAIR) for x in batch.column("pairs")]
        else:
            found = [packed_pairs(batch.column("keys"), batch.column("id").to_numpy())]
        for pairs in found:
            held.append(pairs)
            n += len(pairs)
            if n >= most:
                yield np.concatenate(held)
                held, n = [], 0
    if n:
        yield np.concatenate(held)


def linked_components(first: DataFrame, verify: Callable[[DataFrame], DataFrame], marks: Callable[[DataFrame], DataFrame], may_link: Callable[[str, str], Column], ws: Workspace, stars: int = 2, thin: bool = True) -> DataFrame:
    """Components (id, component) of the links among ids that share a key; ids without a link may lack.

    first: the stored rows (key, id, size) of ids that share a key with others, none twice.  marks gets these ids (id) and gives stored columns of
    them, for may_link(x, y), a condition on the rows named x and y that every link meets.  verify gives
    the linked ones of distinct pairs (a, b).  Tables in between, and first, go with the caller's workspace.
    `stars` rounds test each key's members against one centre outside whose component they still
    are: at first the member that shares most keys with others, later another one each round.  Near
    copies thereby melt into one component at a cost linear in a key's members; as these pairs are few,
    marks are joined to the distinct ones, and none is verified again later.  Where `thin` is false, verify tests may_link itself, at less than
    these joins cost.  Then all pairs that share a key, are still in different
    components and may link are tested, so no link between components is lost; there the condition is
    part of the join, so pairs that can't link are never sent on.
    """
    degree = ws.stored(first.groupBy("id").agg(F.sum("size").alias("degree")), "degree")
    info = marks(degree.select("id"))
    components = tested = None
    for i in range(stars + 1):
        if components is None:
            named = first.withColumn("component", F.col("id"))
            # the least rank is the greatest degree
            own = named.join(degree, "id").withColumn("rank", -F.col("degree"))
        else:
            own = named = ws.stored(first.join(components, "id", "left").withColumn("component", F.coalesce("component", "id")), "named")
        own = own.withColumn("chance", F.xxhash64("id", F.lit(i)))
        # keys that are still open, and their members, are plain tables, so that adaptive execution can split a hot key's join
        rank = [F.col(c) for c in ("rank", "chance", "component", "id") if c in own.columns]
        head = own.groupBy("key").agg(F.min(F.struct(*rank)).alias("head"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        head = ws.stored(head.select("key", F.col("head.id").alias("centre"), F.col("head.component").alias("other")), "heads")
        if i and not head.take(1):
            break
        if i < stars:
            pairs = named.join(head, "key").where("component <> other")
            if thin:
                pairs = pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
            else:  # an id has few keys, so the rows of an a can lie together for both distinct and verify's first join
                pairs = pairs.select(F.col("id").alias("a"), F.col("centre").alias("b")).repartition("a").distinct()
        else:
            marked = ws.stored(named.join(head, "key", "left_semi").join(info, "id"), "marked")
            x, y = marked.alias("x"), marked.alias("y")
            pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & may_link("x", "y"))
            pairs = pairs.select(F.expr("least(x.id, y.id)").alias("a"), F.expr("greatest(x.id, y.id)").alias("b")).distinct()
        if thin:
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            if i < stars:
                pairs = pairs.join(info.alias("x"), F.col("a") == F.col("x.id")).join(info.alias("y"), F.col("b") == F.col("y.id")).where(may_link("x", "y")).select("a", "b")
            pairs = ws.stored(pairs, "pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
        good = ws.stored(verify(pairs), "links")
        if components is not None and not good.take(1):
            continue  # components are as before
        components = connected_components(good, ws) if components is None else _joined(components, good, ws)
    return components


def _joined(components: DataFrame, links: DataFrame, ws: Workspace) -> DataFrame:
    """Components with further links (a, b): only the components that these join take part in the rounds of a union-find."""
    own = lambda c: components.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    named = links.join(own("a"), "a", "left").join(own("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    grown = connected_components(named, ws)
    again = components.join(grown.select(F.col("id").alias("component"), F.col("component").alias("least")), "component", "left").select("id", F.coalesce("least", "component").alias("component"))
    return ws.stored(again.unionByName(grown.join(components.select("id"), "id", "left_anti")), "components")
