"""Month and week labels, and the trailing windows that features look back over.

Window bounds are worked out in Python and reach Spark as literals, so they fold into
``PushedFilters`` and prune month partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label formats of the two recurrences.
LABEL_FORMATS = {"month": "%Y%m", "week": "%Y-%m-%d"}
SPARK_FORMATS = {"month": "yyyyMM", "week": "yyyy-MM-dd"}


def _check_unit(unit: str) -> None:
    if unit not in LABEL_FORMATS:
        raise ValueError(f"unit must be one of {sorted(LABEL_FORMATS)}, got {unit!r}")


def _shift(day: date, delta: int, unit: str) -> date:
    if unit == "week":
        return day + timedelta(weeks=delta)
    months = day.year * 12 + day.month - 1 + delta
    return date(months // 12, months % 12 + 1, 1)


def period_start(label: str, unit: str = "month") -> date:
    """First day of the period a label names."""
    _check_unit(unit)
    return datetime.strptime(label, LABEL_FORMATS[unit]).date()


def period_end(label: str, unit: str = "month") -> date:
    """Last day of the period a label names."""
    return _shift(period_start(label, unit), 1, unit) - timedelta(days=1)


def shift_label(label: str, delta: int, unit: str = "month") -> str:
    """Move a period label by ``delta`` periods (driver side)."""
    return _shift(period_start(label, unit), delta, unit).strftime(LABEL_FORMATS[unit])


def period_shift(label: Column, delta: int, unit: str = "month") -> Column:
    """Move a column of period labels by ``delta`` periods."""
    _check_unit(unit)
    day = F.to_date(label, SPARK_FORMATS[unit])
    moved = F.add_months(day, delta) if unit == "month" else F.date_add(day, 7 * delta)
    return F.date_format(moved, SPARK_FORMATS[unit])


@dataclass(frozen=True)
class TrailingWindow:
    """A calendar period before the run period, ``[start, stop)``; all history if start is None."""

    suffix: str
    start: date | None
    stop: date

    @property
    def month_id(self) -> int:
        if self.start is None:
            raise ValueError("a window without a start is not a month")
        return self.start.year * 100 + self.start.month

    def holds(self, day: Column) -> Column:
        """True for rows inside the window; a bare range, so it is pushed to the scan."""
        before = day < F.lit(self.stop)
        return before if self.start is None else (day >= F.lit(self.start)) & before

    def holds_month_id(self, month: Column) -> Column:
        """The same window over an integer ``yyyyMM`` column."""
        return month == F.lit(self.month_id)


def trailing_windows(
    label: str,
    lags: Sequence[int] = (1, 2, 3),
    unit: str = "month",
    suffixes: Sequence[str] = ("30", "60", "90"),
    inclusive: bool = True,
) -> list[TrailingWindow]:
    """Windows ``lags`` periods before ``label``.

    ``inclusive=False`` leaves out the last day of each window.
    """
    if len(suffixes) != len(lags):
        raise ValueError("one suffix per lag")
    run = period_start(label, unit)
    if unit == "month":
        run = run.replace(day=1)
    cut = timedelta(days=0 if inclusive else 1)
    return [
        TrailingWindow(suffix, _shift(run, -lag, unit), _shift(run, 1 - lag, unit) - cut)
        for lag, suffix in zip(lags, suffixes)
    ]
