"""Rules that accept or refuse enrollment spans and operator clicks; the first failure names the reason, null accepts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def audio_gate(seed_overlap: Column, anchor_sim: Column, anti_sim: Column, accept_min: float = 0.78, anti_max: float = 0.50, margin: float = 0.15) -> Column:
    """Voice-only gate of a solo span; a null anti_sim means that there is no anti profile."""
    refused = (anti_sim > anti_max) | (anchor_sim - anti_sim < margin)
    return F.when(seed_overlap, "seed_overlap").when(anchor_sim < accept_min, "low_sim_to_anchor").when(refused, "anti_reject")


def anti_center(other_present: Column, other_mar: Column, voiced: Column, mar_off: float = 0.10) -> Column:
    """Whether a frame is the centre of an anti-profile window: another face, its lips closed, while there is speech."""
    return F.coalesce(other_present & (other_mar < mar_off) & voiced, F.lit(False))


def speaking_click(window_ms: Column, other_present: Column, other_closed: Column, seed_min_ms: int = 3000, open_max: float = 0.20) -> Column:
    """Guardrails of a click on the speaking target; a null window_ms means that no window holds the click."""
    talked_over = (other_present > 0) & (1 - other_closed / other_present > open_max)
    return F.when(window_ms.isNull(), "click_outside_speaking_window").when(window_ms < seed_min_ms, "seed_too_short").when(talked_over, "overlap_at_speaking_click")


def anti_click(target_sim: Column, target_mar: Column, voiced: Column, same_min: float = 0.40, mar_on: float = 0.15) -> Column:
    """Guardrails of a click on another speaker; a null target_mar means that the target isn't seen."""
    return F.when(target_sim >= same_min, "anti_click_matches_target").when(target_mar >= mar_on, "target_lips_open_at_anti_click").when(~voiced, "no_audio_energy_at_anti_click")


def mixed_trap(sim: Column, limit: float = 0.60) -> Column:
    """Whether an anti-profile window is to be discarded: it sounds too much like the target."""
    return F.coalesce(sim > limit, F.lit(False))


def batch_end(verified_ms: Column, state: Column, variance: Column, marginal_ms: int = 20_000, variance_high: float = 0.05) -> Column:
    """What the end of a batch says of an enrollment: a halt, a warning, or null."""
    failed = (verified_ms < marginal_ms) | (state == "INSUFFICIENT")
    return F.when(failed, "critical_enrollment_failure").when(variance > variance_high, "high_pool_variance_operator_review")


def clamp_local(pts: Column, start: Column, duration: Column) -> Column:
    """A local time held within its recording."""
    return F.least(F.greatest(pts, start), start + duration)


def activity_review(ratio_level: Column) -> Column:
    """The warning that a file with next to no target speech gets."""
    return F.when(ratio_level == "NEAR_ZERO_ALERT", "near_zero_activity_manual_review")
