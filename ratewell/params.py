"""Settings of a pipeline; plain arguments, nothing is read from the environment."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # The provider's base code, the six required codes, the two holidays and every limit.
    base: str = "EUR"
    required: tuple[str, ...] = ("USD", "GBP", "JPY", "CHF", "CAD", "AUD")
    bases: tuple[str, ...] = ("EUR", "USD", "GBP")
    start_date: str = "2026-01-01"
    holidays: tuple[str, ...] = ("2026-04-03", "2026-04-06")
    large_change: float = 0.01
    row_drift: float = 0.2
    series_drift: float = 0.1
    rate_jump: float = 0.04
    late_enabled: bool = True
    lookback_days: int = 7
    eps: int | str = 0
    max_archive_bytes: int = 10 * 1024 * 1024
    # Storage grain of the core table: "day" for large days, "month" where a day is only a few rows.
    core_grain: str = "day"

    @property
    def listed(self) -> tuple[str, ...]:
        """Base code and required codes: the columns of the wide tables."""
        return (self.base, *(c for c in self.required if c != self.base))

    @property
    def expected_series(self) -> int:
        return len([c for c in self.listed if c != self.base])
