"""Vector pools: weighted means, leave-one-out scores, variance, matching, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import TierParams
from ..functions.vectors import cosine, normalize
from .sums import exact_vector_sum, gram_sums, gram_variance


def weighted_mean(df: DataFrame, keys: list[str], vector: str, weight: Column) -> DataFrame:
    """Weighted mean vector of each key: exact sums, rounded once, so the bits don't depend on how rows are dealt."""
    sums = exact_vector_sum(df, keys, vector, weight)
    return sums.select(*keys, F.transform("total", lambda x: x / F.col("weight_total")).alias("mean"))


def window_vectors(chunks: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """keys, n_chunks, duration_ms and vector of each window, from the vectors of its chunks (start_ms, end_ms).

    Chunks are weighed by their durations and the mean is normalised; the vector of a window of one chunk stays as it is.
    A window lasts from its first chunk's start to its last one's end.  A window of several chunks that all last 0 ms fails.
    """
    each = chunks.select(*keys, "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).cast("double").alias("__w"), F.posexplode(vector).alias("__i", "__x"))
    total = F.when(F.sum("__w") > 0, F.sum("__w")).otherwise(F.raise_error(F.lit("a window's total duration must be positive")).cast("double"))
    mean = F.when(F.count("*") == 1, F.min("__x")).otherwise(F.sum(F.col("__w") * F.col("__x")) / total)
    dims = each.groupBy(*keys, "__i").agg(mean.alias("__m"), F.count("*").alias("n_chunks"), (F.max("end_ms") - F.min("start_ms")).alias("duration_ms"))
    mean = F.transform(F.array_sort(F.collect_list(F.struct("__i", "__m"))), lambda s: s["__m"])
    windows = dims.groupBy(*keys, "n_chunks", "duration_ms").agg(mean.alias("vector"))
    return windows.withColumn("vector", F.when(F.col("n_chunks") == 1, F.col("vector")).otherwise(normalize(F.col("vector"))))


def leave_one_out(df: DataFrame, keys: list[str], vector: str, weight: str) -> DataFrame:
    """df with loo: cosine of each vector to the weighted mean of the others; keys with one vector give no row.

    The others' sum is the (exact) total less the own share, so the cost is linear.
    """
    w = F.col(weight).cast("double")
    n = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n >= 2")
    totals = exact_vector_sum(df, keys, vector, w, "__t").drop("weight_total").join(n, keys)
    rest = F.zip_with("__t", vector, lambda t, x: t - w * x)
    return df.join(totals, keys).withColumn("loo", cosine(F.col(vector), rest)).drop("__t", "__n")


def pair_variance(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Population variance of the cosines of all pairs of a key; 0 with fewer than two vectors.  No pair is formed: see sums.gram_variance."""
    return gram_variance(gram_sums(df, keys, vector), keys)


def consensus(df: DataFrame, vector: str, weight: Column, anchor: DataFrame, near: float, outlier: float, digits: int = 6) -> DataFrame:
    """Vectors near an anchor (one row, column mean), with similarity to their own weighted mean and whether one is an outlier of it."""
    close = df.join(F.broadcast(anchor.select(F.col("mean").alias("__anchor")))).where(F.round(cosine(F.col(vector), F.col("__anchor")), digits) >= near).drop("__anchor")
    s = F.round(cosine(F.col(vector), F.col("mean")), digits) + 0.0
    return close.join(F.broadcast(weighted_mean(close, [], vector, weight))).withColumn("similarity", s).withColumn("outlier", F.col("similarity") < outlier).drop("mean")


def best_match(df: DataFrame, vector: str, candidates: DataFrame, name: str, candidate_vector: str, threshold: float = -2.0, digits: int = 6, most: int = 10_000) -> DataFrame:
    """df with the candidate of the highest cosine (of equal ones the least name) if it reaches the threshold.

    candidates is a small table, such as class centroids, that goes to all tasks as one array; more than `most` fail.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), F.col(candidate_vector).alias("v"))))
    # one candidate more than allowed is enough to tell, so no task gathers more
    bag = candidates.limit(most + 1).agg(entries.alias("__bag"), F.count("*").alias("__n"))
    bag = bag.where(F.assert_true(F.col("__n") <= most, F.lit(f"more than {most} candidates")).isNull())
    scored = df.join(F.broadcast(bag)).withColumn("__s", F.transform("__bag", lambda c: F.struct((-F.round(cosine(F.col(vector), c["v"]), digits)).alias("s"), c["name"].alias("name"))))
    best = F.array_min("__s")
    hit = -best["s"] >= threshold
    return scored.withColumn("match", F.when(hit, best["name"])).withColumn("similarity", F.when(hit, -best["s"] + 0.0)).drop("__bag", "__s", "__n")


def calibrate(genuine: DataFrame, impostor: DataFrame, p: TierParams = TierParams(), anti: bool = True) -> DataFrame:
    """One row: theta_high, theta_med, calibration and overlap flag from score columns s."""
    g = genuine.agg(F.count("s").alias("n"), F.percentile("s", F.lit(p.quantile)).alias("q"))
    i = impostor.agg(F.max("s").alias("worst"))
    both = g.join(F.broadcast(i))
    derived = F.col("n") >= p.min_scores
    known = F.lit(anti) & F.col("worst").isNotNull()
    raw = F.when(known, F.greatest("q", F.col("worst") + p.impostor_margin)).otherwise(F.greatest("q", F.lit(p.no_anti_floor)))
    high = F.when(derived, F.least(F.greatest(raw, F.lit(p.clamp_low)), F.lit(p.clamp_high))).otherwise(p.fallback_high)
    med = F.when(derived, F.greatest(high - p.med_step, F.lit(p.med_floor))).otherwise(p.fallback_med)
    kind = F.when(~derived, "FALLBACK_DEFAULTS").when(known, "DERIVED").otherwise("DERIVED_NO_ANTI")
    return both.select(F.col("n").alias("n_enrollment"), high.alias("theta_high"), med.alias("theta_med"), kind.alias("calibration"), F.coalesce(derived & (raw > p.clamp_high), F.lit(False)).alias("calibration_overlap"))
