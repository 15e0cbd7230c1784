"""Engine settings. Every date boundary derives from ``as_of_date``, so a run is reproducible."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")


@dataclass(frozen=True)
class EngineConfig:
    as_of_date: date
    week_start_day: str = "MONDAY"
    lookback_days: int = 3
    max_null_user_pct: float = 1.0
    max_missing_engagement_pct: float = 60.0
    min_volume_vs_median_pct: float = 5.0
    # versions that whole-table snapshots keep, the newest included
    keep_snapshots: int = 3
    # buckets of the session index and of first visits: about their bytes over 128 MB; fixed once a warehouse is built
    session_buckets: int = 16
    user_buckets: int = 32
    # list-page report ignores events from this date on; None keeps all of them
    plp_until_date: date | None = None

    def __post_init__(self) -> None:
        if self.week_start_day not in WEEKDAYS:
            raise ValueError(f"week_start_day must be one of {WEEKDAYS}, got {self.week_start_day!r}")
        if self.keep_snapshots < 2:
            raise ValueError("keep_snapshots must be at least 2: a merge reads the version before its own")
        if self.lookback_days < 0:
            raise ValueError("lookback_days must not be negative")

    @classmethod
    def today(cls, **settings) -> EngineConfig:
        return cls(as_of_date=date.today(), **settings)

    # -- boundaries, as plain dates: a literal on the partition column prunes at planning time

    def days_ago(self, days: int) -> date:
        return self.as_of_date - timedelta(days=days)

    def week_floor(self, day: date) -> date:
        return day - timedelta(days=(day.weekday() - WEEKDAYS.index(self.week_start_day)) % 7)

    @staticmethod
    def month_floor(day: date) -> date:
        return day.replace(day=1)

    @property
    def lookback_date(self) -> date:
        return self.days_ago(self.lookback_days)

    @property
    def lookback_suffix(self) -> str:
        return self.lookback_date.strftime("%Y%m%d")

    @property
    def week_boundary(self) -> date:
        """First day of the first week the trailing window touches."""
        return self.week_floor(self.lookback_date)

    @property
    def month_boundary(self) -> date:
        return self.month_floor(self.lookback_date)

    def product_boundary(self, last_closed_month: date | None = None) -> date:
        """First period start the product report recomputes.

        ``last_closed_month`` is the newest month row already stored. Passing it makes a
        late run reach back to the first month that never got its row; without it only
        the month the trailing window lies in is recomputed.
        """
        month = self.month_boundary
        if last_closed_month is not None:
            next_month = self.month_floor(self.month_floor(last_closed_month) + timedelta(days=31))
            month = min(month, next_month)
        return self.week_floor(month)
