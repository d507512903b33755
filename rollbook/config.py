"""Domain values of the integration, kept apart from the operators that use them.

Everything in this file may be replaced by a caller: pass another ``Settings`` to the
functions that take one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

# Source names, id prefixes, rates, multipliers and allowed categories.
IDENTITY_SOURCES = ("globaltech_hris", "acquiredco_hris")
ENRICHMENT_SOURCES = ("payroll", "benefits")

ID_PREFIXES = {"GlobalTech": "GT", "AcquiredCo": "AC"}

USD_RATES = {"USD": "1.00", "EUR": "1.08", "GBP": "1.27"}

PAY_PERIODS = {
    "annual": 1,
    "monthly": 12,
    "bi-weekly": 26,
    "biweekly": 26,
    "bi weekly": 26,
}

EMPLOYMENT_TYPES = {
    "full-time": "Full-Time",
    "full time": "Full-Time",
    "ft": "Full-Time",
    "part-time": "Part-Time",
    "part time": "Part-Time",
    "pt": "Part-Time",
    "contractor": "Contractor",
    "contract": "Contractor",
    "ct": "Contractor",
}

# Date layouts tried in this order after ISO 8601, as Spark patterns. Month comes before day;
# day-first is tried only where month-first cannot be parsed. The shape of a text, which a
# layout follows from its letters, tells which of them can fit it.
DATE_LAYOUTS = (
    "yyyyMMdd",
    "yyyy/M/d",
    "M/d/yyyy",
    "d/M/yyyy",
    "M-d-yyyy",
    "d-M-yyyy",
    "M/d/yyyy H:mm:ss",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
)


@dataclass(frozen=True)
class Settings:
    """Domain values plus the one notion of "today" shared by all operators."""

    as_of: dt.date | None = None  # None: the date on which the query runs
    id_prefixes: dict[str, str] = field(default_factory=lambda: dict(ID_PREFIXES))
    usd_rates: dict[str, str] = field(default_factory=lambda: dict(USD_RATES))
    pay_periods: dict[str, int] = field(default_factory=lambda: dict(PAY_PERIODS))
    employment_types: dict[str, str] = field(default_factory=lambda: dict(EMPLOYMENT_TYPES))
    date_layouts: tuple[str, ...] = DATE_LAYOUTS
    similarity_threshold: float = 88
    max_hire_date_gap_days: int = 30
    max_failed_checks: int = 2

    def usd_factors(self) -> dict[str, Decimal]:
        """``CURRENCY|frequency`` to the factor that makes an amount annual USD."""
        return {
            f"{currency}|{period}": Decimal(rate) * times
            for currency, rate in self.usd_rates.items()
            for period, times in self.pay_periods.items()
        }


DEFAULT_SETTINGS = Settings()
