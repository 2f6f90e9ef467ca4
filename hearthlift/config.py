"""The facts of one campaign and the settings of its analysis."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class CampaignConfig:
    """One campaign: who ran it, when, and how its effect is to be measured.

    The baseline and recent windows end on the day before the flight starts, so a
    campaign is fixed by its flight dates; both ends of every window are inclusive.
    """

    campaign_id: int
    flight_start: date
    flight_end: date
    baseline_days: int = 365
    recent_days: int = 60

    # Propensity matching.
    caliper: float = 0.01
    score_floor: float = 0.05
    score_ceiling: float = 0.95
    control_ratio: int = 2

    # Cross-fitting. Folds and samples come from a hash of the household and this seed.
    folds: int = 5
    seed: int = 42

    # 'xxhash64' is the fast default; 'md5' gives an order other SQL engines can repeat.
    order_hash: str = "xxhash64"

    # Labels of households without any purchase row: 'derived' computes them from the
    # zero-filled counts, 'missing' writes the text 'missing'.
    no_history_labels: str = "derived"

    def __post_init__(self) -> None:
        if self.flight_end < self.flight_start:
            raise ValueError("flight_end is before flight_start")
        if not 0 < self.recent_days <= self.baseline_days:
            raise ValueError("recent_days must lie within 1..baseline_days")
        if self.order_hash not in ("xxhash64", "md5"):
            raise ValueError(f"unknown order_hash: {self.order_hash}")
        if self.no_history_labels not in ("derived", "missing"):
            raise ValueError(f"unknown no_history_labels: {self.no_history_labels}")

    @property
    def baseline_start(self) -> date:
        return self.flight_start - timedelta(days=self.baseline_days)

    @property
    def recent_start(self) -> date:
        return self.flight_start - timedelta(days=self.recent_days)

    @property
    def baseline_end(self) -> date:
        return self.flight_start - timedelta(days=1)

    @property
    def never_purchased_days(self) -> int:
        """Recency given to households that bought nothing in the baseline."""
        return self.baseline_days + 1


# The campaign id and flight that the published lift numbers are for.
GROCERY_CAMPAIGN = CampaignConfig(
    campaign_id=120234240297670307,
    flight_start=date(2025, 11, 12),
    flight_end=date(2026, 1, 6),
)
