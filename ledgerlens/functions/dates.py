"""Load windows: the initial (historical) load versus the daily increment.

"now" is always an argument, never read from the clock inside a job, so a
rerun of the same day selects the same rows.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HISTORY_START_YEAR
from .text import col_of


@dataclass(frozen=True)
class Window:
    label: str
    start: _dt.datetime
    end: _dt.datetime
    year_source: int


def daily_window(now: _dt.datetime) -> Window:
    """Yesterday, 00:00:00 to 23:59:59, labelled with yesterday's year."""
    day = (now - _dt.timedelta(days=1)).date()
    start = _dt.datetime.combine(day, _dt.time(0, 0, 0))
    end = _dt.datetime.combine(day, _dt.time(23, 59, 59))
    return Window(f"Day {day.isoformat()}", start, end, day.year)


def year_windows(start_year: int, end_year: int) -> list[Window]:
    """One window per calendar year, 01-01 00:00:00 to 12-31 23:59:59."""
    return [Window(f"Year {y}", _dt.datetime(y, 1, 1), _dt.datetime(y, 12, 31, 23, 59, 59), y)
            for y in range(start_year, end_year + 1)]


def initial_window(now: _dt.datetime, start_year: int = HISTORY_START_YEAR) -> Window:
    """Everything since January 1st of ``start_year`` up to ``now``."""
    return Window("Initial", _dt.datetime(start_year, 1, 1), now, now.year)


def midnight_window(now: _dt.datetime) -> Window:
    """Yesterday midnight to today midnight (the item loader's daily run)."""
    today = _dt.datetime.combine(now.date(), _dt.time(0, 0, 0))
    y = today - _dt.timedelta(days=1)
    return Window(f"Day {y.date().isoformat()}", y, today, y.year)


def load_windows(mode: str, now: _dt.datetime, start_year: int | None = None,
                 end_year: int | None = None) -> list[Window]:
    """``daily`` -> [yesterday]; ``range`` -> one per year; ``initial`` -> since 2019."""
    if mode == "daily":
        return [daily_window(now)]
    if mode == "range":
        return year_windows(start_year if start_year is not None else now.year - 1,
                            end_year if end_year is not None else now.year)
    if mode == "initial":
        return [initial_window(now, start_year or HISTORY_START_YEAR)]
    raise ValueError(f"unknown load mode {mode!r}")


def ts_literal(value: _dt.datetime, ntz: bool = True) -> Column:
    """A timestamp literal that does not depend on the driver's time zone.

    Event times without zone (``timestamp_ntz``) compare against an NTZ
    literal; the cast of a constant string is folded, so the predicate still
    reaches the scan as a pushed filter.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz" if ntz else "timestamp")


def in_window(c: str | Column, lo, hi, closed: str = "neither") -> Column:
    """Range predicate; the default keeps both bounds out, as the search does.

    ``closed`` is one of ``neither``, ``left`` (``[lo, hi)``), ``right``, ``both``.
    Written as plain comparisons so the scan receives it as pushed filters.
    """
    x = col_of(c)
    lo_ok = x >= F.lit(lo) if closed in ("left", "both") else x > F.lit(lo)
    hi_ok = x <= F.lit(hi) if closed in ("right", "both") else x < F.lit(hi)
    return lo_ok & hi_ok
