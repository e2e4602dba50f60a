"""Date window of an archive backfill."""

from __future__ import annotations

from datetime import date, timedelta

# The archive trails by six days and is loaded for two years.
ARCHIVE_LAG_DAYS = 6
HISTORY_YEARS = 2


def years_before(day: date, years: int) -> date:
    """Same day of an earlier year; 29 February becomes 28 February."""
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return day.replace(year=day.year - years, day=28)


def resolve_window(anchor: date, start: date | None = None, end: date | None = None) -> tuple[date, date]:
    """Inclusive (start, end); a missing bound is derived from the run's anchor day."""
    newest = anchor - timedelta(days=ARCHIVE_LAG_DAYS)
    end = end or newest
    start = start or years_before(newest, HISTORY_YEARS)
    if start > end:
        raise ValueError(f"window starts after it ends: {start} > {end}")
    return start, end
