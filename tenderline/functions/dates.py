"""Report periods and day arithmetic. Bounds are literals, so scans can prune on them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """Closed range of days; ``last=None`` leaves the end open."""

    first: date
    last: date | None = None

    @staticmethod
    def previous_month(as_of: date) -> Period:
        last = as_of.replace(day=1) - timedelta(days=1)
        return Period(last.replace(day=1), last)

    def covers(self, at: Column) -> Column:
        """Day-granular test as a half-open range on the raw timestamp."""
        test = at >= F.lit(self.first)
        if self.last is not None:
            test = test & (at < F.lit(self.last + timedelta(days=1)))
        return test


def in_previous_month(df: DataFrame, at: str, as_of: date) -> DataFrame:
    return df.where(Period.previous_month(as_of).covers(F.col(at)))


def trailing_weeks(as_of: date, weeks: int = 4) -> list[tuple[date, date]]:
    """Consecutive 7-day windows ending at ``as_of``, oldest first; neighbours share a boundary."""
    ends = [as_of - timedelta(days=7 * back) for back in reversed(range(weeks))]
    return [(end - timedelta(days=7), end) for end in ends]


def moment(as_of: date | datetime, zone: str = "UTC") -> Column:
    """A day (its midnight) or an instant, on the clock of ``zone``, to compare with zone-less times and days."""
    if not isinstance(as_of, datetime):
        return F.lit(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    return F.to_timestamp_ntz(F.lit(as_of.isoformat(" ", "microseconds")))


def age_in_days(at: Column, as_of: date | datetime) -> Column:
    return F.datediff(moment(as_of), at)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(1e6)
