"""Business labels: discount bands, lifetime-value tiers, RFM segments."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band edges (both ends included) and names.
DISCOUNT_BANDS = [
    ("0.01", "0.1", "1-10%"),
    ("0.11", "0.2", "11-20%"),
    ("0.21", "0.3", "21-30%"),
    ("0.31", "0.5", "31-50%"),
]
NO_DISCOUNT = "0% — No Discount"
TOP_DISCOUNT = "50%+"

# Lower bounds of the lifetime-value tiers and their names.
CLV_TIERS = [
    (5000, "Platinum (≥ $5K)"),
    (2000, "Gold ($2K-$5K)"),
    (1000, "Silver ($1K-$2K)"),
    (500, "Bronze ($500-$1K)"),
]
LOWEST_TIER = "Standard (< $500)"


def discount_band(rate: Column, bands: str = "as_written") -> Column:
    """Band of a discount rate.

    ``as_written`` keeps the gaps between the bands: 0.105 or 0.005 fall through to the last
    band. ``contiguous`` closes them: each band reaches down to the one below.
    """
    if bands not in ("as_written", "contiguous"):
        raise ValueError(f"unknown bands: {bands}")
    label = F.when(rate == 0, NO_DISCOUNT)
    for low, high, name in DISCOUNT_BANDS:
        inside = rate <= F.lit(Decimal(high))
        if bands == "as_written":
            inside = inside & (rate >= F.lit(Decimal(low)))
        label = label.when(inside, name)
    return label.otherwise(TOP_DISCOUNT)


def clv_tier(value: Column, tiers: list[tuple[float, str]] = CLV_TIERS, lowest: str = LOWEST_TIER) -> Column:
    """Tier of a lifetime value; ``tiers`` is (lower bound, name), highest first."""
    label = F.when(F.lit(False), lowest)
    for bound, name in tiers:
        label = label.when(value >= bound, name)
    return label.otherwise(lowest)


# The rules and names of the segments.
def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment of three scores; the first rule that holds names it."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "Recent Customers")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Lost")
        .when(m >= 4, "Big Spenders")
        .otherwise("Potential Loyalists")
    )
