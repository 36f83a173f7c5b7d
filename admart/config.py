"""Run parameters that the models read instead of globals or ``current_date()``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Period:
    """A named reporting period with inclusive month bounds (first days of months)."""

    label: str
    first_month: dt.date
    last_month: dt.date


# The named quarters both period reports list, in report order.
DEFAULT_PERIODS: tuple[Period, ...] = (
    Period("Q1 2023", dt.date(2023, 1, 1), dt.date(2023, 3, 1)),
    Period("Q2 2023", dt.date(2023, 4, 1), dt.date(2023, 6, 1)),
    Period("Q1 2024", dt.date(2024, 1, 1), dt.date(2024, 3, 1)),
    Period("Q2 2024", dt.date(2024, 4, 1), dt.date(2024, 6, 1)),
)


@dataclass(frozen=True)
class MetaSegments:
    """Meta campaign ids and dates that mark experiments (defaults are the fixed values)."""

    # Experiment campaign ids and the experiment window.
    window_campaign_ids: tuple[str, ...] = ("120210388163900589", "120210389141230589")
    window_start: dt.date = dt.date(2024, 5, 21)
    window_end: dt.date = dt.date(2024, 6, 4)
    excluded_campaign_ids: tuple[str, ...] = (
        "120210388163900589",
        "120210389141230589",
        "120210387288060589",
    )


@dataclass(frozen=True)
class Config:
    """Naming and time parameters of one run.

    ``prospect`` and ``customer_id`` name the physical source tables; ``as_of`` replaces
    ``current_date()`` in the trailing-spend columns so runs are reproducible.
    """

    prospect: str = "demo"
    customer_id: str = "0000000000"
    as_of: dt.date = field(default_factory=dt.date.today)
    periods: tuple[Period, ...] = DEFAULT_PERIODS
    meta: MetaSegments = MetaSegments()
    # GA4 revenue attributed to Meta is scaled by this uplift (fixed value).
    meta_revenue_uplift: float = 1.75
    # Meta AOV above this multiple of the region-month median is replaced by the median.
    aov_outlier_factor: float = 3.0

    @property
    def database(self) -> str:
        return f"{self.prospect}_extracts"


# The as-of date the test fixtures are built around (see sources/fixtures.py).
FIXTURE_AS_OF = dt.date(2024, 6, 20)
