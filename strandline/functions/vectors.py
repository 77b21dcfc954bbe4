"""Vector arithmetic on array<double> columns, in built-in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a norm up to this counts as zero.
TINY = 1e-12


def dot(a: Column, b: Column) -> Column:
    """Inner product over the shorter length."""
    n = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def normalize(v: Column) -> Column:
    """Unit vector; a zero vector for a norm up to TINY."""
    n = norm(v)
    return F.transform(v, lambda x: F.when(n > TINY, x / n).otherwise(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either norm is up to TINY."""
    na, nb = norm(a), norm(b)
    return F.when((na <= TINY) | (nb <= TINY), 0.0).otherwise(dot(a, b) / (na * nb))
