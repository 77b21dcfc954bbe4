"""Scalar rules: clocks, geometry, tiers, gates.  Comparison strictness is part of each rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def ms_from_samples(n: Column, rate: int = 16_000) -> Column:
    return F.floor(n * 1000 / rate)


def half_even_ms(seconds: Column) -> Column:
    """Decimal seconds to milliseconds, half to even."""
    return F.bround(seconds.cast("decimal(28,9)") * 1000, 0).cast("long")


def mouth_ratio(p: Column, top: list[int], bottom: list[int], left: int, right: int) -> Column:
    """Mean vertical gap of point pairs by the width between two points; null for a width up to 1e-6.

    p: array of (x, y) structs.
    """
    at = lambda i: F.get(p, F.lit(i))
    gap = lambda i, j: F.hypot(at(i)["x"] - at(j)["x"], at(i)["y"] - at(j)["y"])
    width = gap(left, right)
    total = sum((gap(i, j) for i, j in zip(top[1:], bottom[1:])), gap(top[0], bottom[0]))
    return F.when(width > 1e-6, total / len(top) / width)


def yaw_suspends(yaw: Column, limit: float = 35.0) -> Column:
    return F.coalesce(F.abs(yaw) > limit, F.lit(False))


@dataclass(frozen=True)
class TierParams:
    """Tiers and calibration."""

    quantile: float = 0.10
    impostor_margin: float = 0.05
    clamp_low: float = 0.45
    clamp_high: float = 0.75
    med_step: float = 0.15
    med_floor: float = 0.30
    min_scores: int = 10
    fallback_high: float = 0.60
    fallback_med: float = 0.40
    no_anti_floor: float = 0.55
    evidence_floor: float = 0.20
    margin: float = 0.15


def tier(target: Column, other: Column, high: Column, med: Column, p: TierParams = TierParams(), anti: bool = True) -> Column:
    """(tier, margin_failed) of a block; SKIPPED where there is no score."""
    wide = F.coalesce(target - other > p.margin, F.lit(False)) if anti else F.lit(True)
    name = (
        F.when(target.isNull(), "SKIPPED").when((target > high) & wide, "HIGH").when(target > med, "MEDIUM").when(target > high, "MEDIUM")
        .when(target >= p.evidence_floor, "SUB").otherwise("REJECT")
    )
    return F.struct(name.alias("tier"), F.coalesce((target > high) & ~wide, F.lit(False)).alias("margin_failed"))


def activity_level(ratio: Column) -> Column:
    return F.when(ratio.isNull(), "NO_SPEECH").when(ratio > 0.25, "NORMAL").when(ratio >= 0.10, "LOW_ADVISORY").otherwise("NEAR_ZERO_ALERT")


def contamination_level(similarity: Column) -> Column:
    return F.when(similarity > 0.60, "HALT").when(similarity > 0.45, "WARNING").otherwise("OK")


def quality_state(verified_ms: Column, variance: Column, anti: Column) -> Column:
    strong = verified_ms >= F.when(anti, 45_000).otherwise(60_000)
    return F.when(strong & (variance <= 0.05), "STRONG").when(verified_ms >= 20_000, "MARGINAL").otherwise("INSUFFICIENT")


def triple_gate(coverage: Column, present: Column, closed: Column, seed: Column, anti_sim: Column, anti: Column, coverage_min=0.50, closed_min=0.80, seed_min=0.70, anti_max=0.50, margin=0.15) -> Column:
    """(accepted, gate, reason): gates A, B and C in order, the first failure decides; equality passes."""
    reason = (
        F.when(coverage < coverage_min, "vad_coverage_low")
        .when((present > 0) & (closed / present < closed_min), "interviewer_lips_open")
        .when(seed < seed_min, "low_sim_to_seed")
        .when(anti & anti_sim.isNull(), "sim_anti_missing")
        .when(anti & (anti_sim > anti_max), "high_sim_to_anti")
        .when(anti & (seed - anti_sim < margin), "margin_too_small")
    )
    gate = F.when(reason.isin("vad_coverage_low", "interviewer_lips_open"), "A").when(reason == "low_sim_to_seed", "B").when(reason.isNotNull(), "C")
    return F.struct(reason.isNull().alias("accepted"), gate.alias("gate"), reason.alias("reason"))


def utc_stamp(at: Column) -> Column:
    """A time as UTC text with milliseconds, cut off, and a Z; the session's zone has to be UTC for a timestamp with zone."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
