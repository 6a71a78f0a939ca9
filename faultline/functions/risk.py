"""Risk flags, tiers, status bands and machine labels as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from faultline.functions.numeric import column, nan_to_null

# Tier edges (left-closed) and names, default alert threshold.
TIER_EDGES = [0.0, 0.30, 0.55, 1.01]
TIERS = ["Low", "Medium", "High"]
DEFAULT_THRESHOLD = 0.45

# Lower cuts of the green/amber (or red/amber) status bands.
SCORE_CUTS = (0.75, 0.45)
ACCURACY_CUTS = (0.90, 0.75)
RECALL_CUTS = (0.80, 0.60)
METRIC_CUTS = (0.80, 0.60)
AT_RISK_CUTS = (20, 5)

GOOD_HIGH = ("green", "amber", "red")
BAD_HIGH = ("red", "amber", "green")


def risk_tier(prob) -> Column:
    """Tier of a probability; null outside [0, 1.01)."""
    prob = nan_to_null(prob)
    tier = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(TIER_EDGES, TIER_EDGES[1:], TIERS))):
        tier = F.when((prob >= F.lit(low)) & (prob < F.lit(high)), F.lit(name)).otherwise(tier)
    return tier


def tier_order(tier) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name in TIERS]), column(tier))


def at_risk(prob, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """True at or above the threshold; a missing score is not at risk."""
    return F.coalesce(nan_to_null(prob) >= F.lit(threshold), F.lit(False))


def is_correct(prediction, label) -> Column:
    return column(prediction).cast("int") == column(label).cast("int")


def band(value, cuts: Sequence[float], labels: Sequence[str], strict: bool = False) -> Column:
    """First label whose cut the value reaches (or exceeds, when strict)."""
    value = column(value)
    status = F.lit(labels[-1])
    for cut, label in reversed(list(zip(cuts, labels))):
        reached = value > F.lit(cut) if strict else value >= F.lit(cut)
        status = F.when(reached, F.lit(label)).otherwise(status)
    return status


def score_band(prob) -> Column:
    return band(nan_to_null(prob), SCORE_CUTS, BAD_HIGH)


def machine_label(unit) -> Column:
    return F.concat(F.lit("M-"), column(unit).cast("string"))


def machine_number(label) -> Column:
    """Number behind 'M-<n>', else null; text without the prefix has none."""
    label = column(label)
    digits = F.regexp_replace(label, "M-", "")
    return F.when(label.startswith("M-"), F.trim(digits).try_cast("bigint"))


def outcome_text(label, yes: str = "FAILED", no: str = "—") -> Column:
    return F.when(column(label) == 1, F.lit(yes)).otherwise(F.lit(no))
