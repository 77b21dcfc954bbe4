"""Ordered scans that deal one key over many tasks.

Rows are dealt by ranges of (keys, order), so a hot key's rows lie in consecutive chunks, a chunk being what a key has in one
partition.  Each chunk is worked on alone and says what it does to any state that comes in; only that meets in order, a few rows a chunk, and what
comes in goes back to the chunk.  In a range only its first key can have begun before, so at most one row a partition is sent back to all tasks.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from ..sources.shared import stored
from .folds import ordered_fold


def ranged(df: DataFrame, keys: list[str], order: list[str], chunks: int | None = None) -> DataFrame:
    """df by ranges of (keys, order), in order within each."""
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)


def _arrow(out: StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(out)


def _same(a: DataFrame, b: DataFrame, columns: list[str]):
    on = a["__chunk"] == b["__chunk"]
    for c in columns:
        on = on & a[c].eqNullSafe(b[c])
    return on


def moving_average(df: DataFrame, keys: list[str], order: list[str], value: str, keep: list[str], span: int = 5, chunks: int | None = None) -> DataFrame:
    """Causal exponential average with alpha 2 / (span + 1); a null resets it and the next value seeds it anew.

    A chunk turns an average v that comes in into a v + b up to its first null, and into what its own values alone give after that, so chunks
    compose in any number.  The result has the keys, `keep` and ema.
    """
    alpha = 2.0 / (span + 1)
    columns = list(dict.fromkeys([*keys, *order, value, *keep]))
    own = [df.schema[c] for c in columns]
    out = StructType([*own, StructField("__chunk", IntegerType()), StructField("__a", DoubleType()), StructField("__b", DoubleType()), StructField("__seed", DoubleType()), StructField("__reset", BooleanType())])

    def run(batches):
        chunk = TaskContext.get().partitionId()
        schema, key = _arrow(out), ()
        a = b = seed = reset = None
        for batch in batches:
            found = []
            ks = list(zip(*(batch.column(columns.index(k)).to_pylist() for k in keys))) if keys else [None] * batch.num_rows
            for k, x in zip(ks, batch.column(columns.index(value)).to_pylist()):
                if k != key:
                    key, a, b, seed, reset = k, 1.0, 0.0, None, False
                if x is None:
                    seed, reset = None, True
                else:
                    seed = x if seed is None else alpha * x + (1 - alpha) * seed
                    a, b = a * (1 - alpha), alpha * x + (1 - alpha) * b
                found.append((chunk, a, b, seed, reset))
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(zip(*found), schema.types[len(columns) :]))], names=out.fieldNames())

    done = stored(ranged(df.select(*columns), keys, order, chunks).mapInArrow(run, out), "averages")
    last = done.groupBy(*keys, "__chunk").agg(F.max_by(F.struct("__a", "__b", "__seed", "__reset"), F.struct(*order)).alias("__m")).select(*keys, "__chunk", "__m.*")

    def step(v, row):
        after = row["__seed"] if row["__reset"] or v is None else row["__a"] * v + row["__b"]
        return after, ((row["__chunk"], v),) if v is not None else ()

    came = ordered_fold(last, keys, ["__chunk"], lambda: None, step, "__chunk int, __v double")
    found = done.join(F.broadcast(came), _same(done, came, keys), "left")  # a row a partition at most
    v = F.col("__v")
    ema = F.when(done["__reset"] | v.isNull(), done["__seed"]).otherwise(done["__a"] * v + done["__b"])
    return found.select(*(done[c] for c in dict.fromkeys([*keys, *keep])), ema.alias("ema"))


def greedy_spacing(df: DataFrame, keys: list[str], at: str, least: int, chunks: int | None = None) -> DataFrame:
    """Points at least `least` (above 0) after the last accepted one, a key's first point being accepted; null points are left out.

    A chunk can only be entered at its points up to the first one that lies `least` after its first, and says for each of those which point it accepts last: a
    backward pass over successors gives that.  These entries, not the points, are followed in order of the chunks.
    """
    points = stored(ranged(df.select(*keys, F.col(at).cast("long").alias(at)).where(F.col(at).isNotNull()).distinct(), keys, [at], chunks).withColumn("__chunk", F.spark_partition_id()), "points")
    kinds = [df.schema[k] for k in keys]
    summary = StructType([*kinds, StructField("__chunk", IntegerType()), StructField("__in", LongType()), StructField("__last", LongType())])

    def exits(own: list[int]) -> list[tuple[int, int]]:
        """For the points at which a chunk can be entered: the point that it accepts last."""
        last = [0] * len(own)
        for i in range(len(own) - 1, -1, -1):
            j = bisect.bisect_left(own, own[i] + least, i + 1)
            last[i] = last[j] if j < len(own) else own[i]
        return [(p, last[i]) for i, p in enumerate(own[: bisect.bisect_left(own, own[0] + least) + 1])]

    def ends(batches):
        schema, key, own = _arrow(summary), None, []

        def rows():
            return [(*key, *x) for x in exits(own)]

        ready = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                mine, p = (*row[: len(keys)], row[-1]), row[len(keys)]
                if mine != key:
                    ready += rows() if key is not None else []
                    key, own = mine, []
                own.append(p)
            if len(ready) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), schema.types)], names=summary.fieldNames())
                ready = []
        ready += rows() if key is not None else []
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), schema.types)], names=summary.fieldNames())

    chunked = points.repartition(*keys, "__chunk").sortWithinPartitions(*keys, "__chunk", at)
    entries = chunked.mapInArrow(ends, summary)

    def follow(state, row):
        """state: the last accepted point, the chunk that was entered last."""
        last, chunk = state
        if row["__chunk"] == chunk or last is not None and row["__in"] - last < least:
            return state, ()
        return (row["__last"], row["__chunk"]), ((row["__chunk"], row["__in"]),)

    first = ordered_fold(entries, keys, ["__chunk", "__in"], lambda: (None, None), follow, "__chunk int, __in bigint")
    begin = first.select(*keys, "__chunk", F.col("__in").alias(at), F.lit(0).alias("__kind"))
    both = begin.unionByName(points.select(*keys, "__chunk", at, F.lit(1).alias("__kind")))

    def take(last, row):
        if not row["__kind"]:
            return row[at] - least, ()
        if last is None or row[at] - last < least:
            return last, ()  # without an entry nothing of the chunk is accepted
        return row[at], ((row[at],),)

    return ordered_fold(both, [*keys, "__chunk"], ["__kind", at], lambda: None, take, f"{at} bigint").drop("__chunk")
