"""What is learned from history: profiles, known numbers and the global row."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .profiles import HistoryProfile, history_profile
from .scale import broadcast_if_small, materialise


@dataclass
class Baseline:
    """Lookup tables of one history. The global profile is one row, so it is held as values."""

    profile: HistoryProfile
    vendors: DataFrame
    amount_mean: float | None
    amount_std: float | None
    latest_date: datetime.date | None
    invoice_count: int

    @property
    def invoice_numbers(self) -> DataFrame:
        return self.profile.numbers

    def vendor_lookup(self) -> DataFrame:
        return broadcast_if_small(self.vendors)

    def merge(self, other: "Baseline") -> "Baseline":
        """The baseline of both histories, without reading either again."""
        return from_profile(self.profile.merge(other.profile))


def from_profile(profile: HistoryProfile) -> Baseline:
    """The lookups that follow from a profile, written so that every later job reuses them."""
    return Baseline(profile, materialise(profile.vendors()), **profile.overall().asDict())


def fit_baseline(history: DataFrame) -> Baseline:
    """Scan ``history`` once."""
    return from_profile(history_profile(history))
