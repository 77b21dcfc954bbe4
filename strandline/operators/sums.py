"""Exact sums of doubles and Gram sums of vectors: aggregates that merge in any order.

A double is cut into three integer limbs by its binary exponent; limbs of one exponent range are added as longs, which is exact, so the
result is the exact sum rounded once, bit for bit the same however rows are dealt.  A range spans 16 binary exponents, a key has at most 133 of them.
A limb is under 2^26, so 2^37 rows of a key fit; more are an error, not a wrong sum.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ..functions.vectors import TINY

BITS, LIMB = 16, 26
#: Values under 2^-512 are taken 2^512 times as large, so that no step meets a subnormal number.
LIFT = 512
#: Columns of a sum in progress.
LIMBS = ("__q", "__a", "__b", "__c", "__odd")


def limbs(x: Column) -> Column:
    """(__q, __a, __b, __c, __odd) of a double: a + b 2^-26 + c 2^-52 times 2^(16 q); odd is a NaN or an infinity, which has no limbs."""
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    small = F.abs(x) < 2.0**-LIFT
    y = F.when(small, F.abs(x) * 2.0**LIFT).otherwise(F.abs(x))
    guess = F.floor(F.log2(y) / BITS).cast("int")
    power = lambda q: F.pow(F.lit(2.0), (q * BITS).cast("double"))
    q = F.when(y < power(guess), guess - 1).when(y >= power(guess) * 2.0**BITS, guess + 1).otherwise(guess)
    z = y / power(q)
    a = F.floor(z)
    rest = (z - a) * 2.0**LIMB
    b = F.floor(rest)
    c = F.floor((rest - b) * 2.0**LIMB)
    sign = F.signum(x).cast("long")
    part = lambda v: F.when(odd | (x == 0), 0).otherwise(sign * v.cast("long")).cast("long")
    return F.struct(
        F.when(odd | (x == 0), 0).otherwise(q - F.when(small, LIFT // BITS).otherwise(0)).cast("int").alias("__q"),
        part(a).alias("__a"), part(b).alias("__b"), part(c).alias("__c"), F.when(odd, x).alias("__odd"),
    )


def rounded(parts: list[tuple[int, int, int, int]]) -> float:
    """The double nearest to the sum of limbs (q, a, b, c); ties go to the even one."""
    low = min(p[0] for p in parts)
    whole = sum((((a << LIMB) + b << LIMB) + c) << BITS * (q - low) for q, a, b, c in parts)
    shift = BITS * low - 2 * LIMB
    try:
        return float(whole << shift) if shift >= 0 else whole / (1 << -shift)  # Python rounds both once
    except OverflowError:
        return math.copysign(math.inf, whole)


def _limb_rows(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """keys and the added limbs of each exponent range; nulls are left out."""
    each = df.select(*keys, limbs(value).alias("__l"), value.alias("__x")).where("__x is not null")
    total = lambda c: F.sum(f"__l.{c}").alias(c)
    return each.groupBy(*keys, F.col("__l.__q").alias("__q")).agg(*map(total, LIMBS[1:]))


def _values(rows: pd.Series) -> pd.Series:
    def one(parts):
        odd = [p["__odd"] for p in parts if p["__odd"] is not None]
        return sum(odd) if odd else rounded([tuple(p[c] for c in LIMBS[:4]) for p in parts])

    return pd.Series([None if p is None else one(p) for p in rows], dtype="float64")


def _or_nan(x: Column) -> Column:
    """pandas hands a NaN back as null; no sum is null."""
    return F.coalesce(x, F.lit(math.nan))


def exact_sum(df: DataFrame, keys: list[str], value: Column, name: str = "total") -> DataFrame:
    """keys and the correctly rounded sum of value; a key with nulls alone gives no row.  Infinities of both signs and NaN give NaN."""
    parts = _limb_rows(df, keys, value).groupBy(*keys).agg(F.collect_list(F.struct(*LIMBS)).alias("__p"))  # 133 entries at most

    @F.pandas_udf("double")
    def fold(parts: pd.Series) -> pd.Series:
        return _values(parts)

    return parts.select(*keys, _or_nan(fold("__p")).alias(name))


def exact_vector_sum(df: DataFrame, keys: list[str], vector: str, weight: Column, name: str = "total") -> DataFrame:
    """keys, n, the correctly rounded sum of weights (weight_total) and the vector of correctly rounded sums of weight times component.

    A product is rounded as a double first.  Nulls among vectors are left out.
    """
    w = weight.cast("double")
    # place -1 holds the weight itself
    places = F.concat(F.array(F.lit(-1)), F.sequence(F.lit(0), F.size(vector) - 1))
    each = df.where(F.col(vector).isNotNull()).select(*keys, w.alias("__w"), F.explode(F.arrays_zip(places.alias("i"), F.concat(F.array(F.lit(1.0)), F.col(vector)).alias("x"))).alias("__e"))
    rows = _limb_rows(each.select(*keys, F.col("__e.i").alias("__i"), F.col("__w"), F.col("__e.x").alias("__v")), [*keys, "__i"], F.col("__w") * F.col("__v"))
    gathered = rows.groupBy(*keys).agg(F.collect_list(F.struct("__i", *LIMBS)).alias("__p"))  # ranges times dimensions

    @F.pandas_udf(ArrayType(DoubleType()))
    def fold(parts: pd.Series) -> pd.Series:
        def one(entries):
            by = {}
            for e in entries:
                by.setdefault(e["__i"], []).append(e)
            return _values(pd.Series([by[i] for i in sorted(by)])).tolist()

        return pd.Series([one(p) for p in parts])

    return gathered.select(*keys, F.transform(fold("__p"), _or_nan).alias("__s")).select(*keys, F.get("__s", F.lit(0)).alias("weight_total"), F.slice("__s", F.lit(2), F.greatest(F.size("__s") - 1, F.lit(0))).alias(name))


#: Keys whose matrices a task holds at once; more are sent on in parts, which merge.
HELD = 128


def gram_sums(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Per key and place __p: __x, the sum of unit vectors by dimension and after it the upper triangle of the sum of their outer products, row by row; beside it __n vectors, __live of a norm above TINY, and __d places.

    A task multiplies a key's vectors as one matrix, so it sends d + d (d + 1) / 2 numbers a key, whatever the number of vectors.  Null vectors are left out; a key's vectors have one length.
    """
    kinds = [StructField(k, df.schema[k].dataType) for k in keys]
    out = StructType([*kinds, StructField("__n", LongType()), StructField("__live", LongType()), StructField("__all", ArrayType(DoubleType()))])
    names = out.fieldNames()

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        held: dict = {}

        def flush():
            columns = [list(c) for c in zip(*((*k, n, live, np.concatenate([s, g[np.triu_indices(len(s))]]).tolist()) for k, (n, live, s, g) in held.items()))]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], names=names)

        for batch in batches:
            vectors = batch.column(len(keys))
            own = [tuple(x) for x in zip(*(batch.column(i).to_pylist() for i in range(len(keys))))] if keys else [()] * batch.num_rows
            rows: dict = {}
            for i, k in enumerate(own):
                rows.setdefault(k, []).append(i)
            for k, at in rows.items():
                x = np.array(vectors.take(pa.array(at)).to_pylist(), np.float64)
                norm = np.sqrt(np.einsum("ij,ij->i", x, x))
                unit = np.where((norm > TINY)[:, None], x / np.where(norm > TINY, norm, 1)[:, None], 0.0)
                n, live, s, g = held.get(k, (0, 0, 0.0, 0.0))
                held[k] = (n + len(at), live + int((norm > TINY).sum()), s + unit.sum(0), g + unit.T @ unit)
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    parts = df.where(F.col(vector).isNotNull()).select(*keys, vector).mapInArrow(run, out)
    each = parts.select(*keys, "__n", "__live", F.size("__all").alias("__d"), F.posexplode("__all").alias("__p", "__x"))
    return each.groupBy(*keys, "__p").agg(F.sum("__n").alias("__n"), F.sum("__live").alias("__live"), F.max("__d").alias("__d"), F.sum("__x").alias("__x"))


def gram_variance(merged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, variance): population variance of the cosines of all pairs, from gram_sums' numbers.

    With unit vectors u: sum of pair cosines = (|S|^2 - m) / 2 for S = sum u and m = sum |u|^2, and sum of squared pair
    cosines = (|M|_F^2 - m) / 2 for M = sum u u^T, so no pair is formed.  Vectors of zero norm have cosine 0 to all; fewer than two give 0.
    """
    # of d sums and d (d + 1) / 2 products: row i of the triangle begins at d + i d - i (i - 1) / 2
    e = merged.withColumn("__dim", F.expr("cast(round((sqrt(9 + 8 * __d) - 3) / 2) as int)")).withColumn("__t", F.expr("__p - __dim"))
    row = F.expr("cast(floor((2 * __dim + 1 - sqrt((2 * __dim + 1) * (2 * __dim + 1) - 8 * cast(__t as double))) / 2 + 1e-9) as int)")
    e = e.withColumn("__row", F.when(F.col("__t") >= 0, row))
    diagonal = F.expr("__t = __row * __dim - __row * (__row - 1) div 2")
    square = F.col("__x") * F.col("__x")
    sums = e.groupBy(*keys).agg(
        F.max("__n").alias("n"), F.max("__live").alias("__m"), F.sum(F.when(F.col("__t") < 0, square)).alias("__ss"),
        F.sum(F.when(F.col("__t") >= 0, F.when(diagonal, square).otherwise(2 * square))).alias("__mm"),
    )
    pairs = F.col("n") * (F.col("n") - 1) / 2
    mean = (F.col("__ss") - F.col("__m")) / 2 / pairs
    variance = (F.col("__mm") - F.col("__m")) / 2 / pairs - mean * mean
    return sums.select(*keys, "n", F.when(F.col("n") < 2, 0.0).otherwise(F.greatest(variance, F.lit(0.0))).alias("variance"))
