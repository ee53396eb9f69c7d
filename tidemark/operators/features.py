"""Per-key feature tables: trailing windows, history, latest rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.periods import TrailingWindow
from tidemark.functions.scalars import as_int64, measure_family


def _same(c: Column) -> Column:
    return c


@dataclass(frozen=True)
class Measure:
    """A value per row, how to aggregate it, and the cast of the result."""

    value: Column
    agg: Callable[[Column], Column]
    finish: Callable[[Column], Column] = _same


def event_count(condition: Column) -> Measure:
    """Number of rows that meet a condition: 0, not NULL, where rows exist but none meets it."""
    return Measure(F.when(condition, 1).otherwise(0), F.sum)


def first_when(condition: Column, value: Column) -> Measure:
    """Smallest value (say, first date) among rows that meet a condition."""
    return Measure(F.when(condition, value), F.min)


def highest(value: Column) -> Measure:
    return Measure(value, F.max)


def amount_total(columns: Sequence[Column]) -> Measure:
    """Sum over rows of a family of measures, as a double."""
    return Measure(measure_family(columns), F.sum, lambda c: c.cast("double"))


def count_total(columns: Sequence[Column]) -> Measure:
    """Sum over rows of a family of counts, as a BIGINT."""
    return Measure(measure_family(columns), F.sum, as_int64)


def trailing_features(
    df: DataFrame,
    key: str,
    period: str,
    windows: Sequence[TrailingWindow],
    measures: Mapping[str, Measure],
    predicates: Mapping[str, Column] | None = None,
    month_ids: bool = False,
) -> DataFrame:
    """Every measure in every window, one row per key, from one scan and one shuffle.

    ``period`` is a date or timestamp column, or an integer ``yyyyMM`` one with ``month_ids``.
    ``predicates`` adds a condition to single windows, by suffix. A measure is NULL in a window
    where the key has no rows; column names are the measure's with the window's suffix.
    """
    extra = predicates or {}
    col = F.col(period)
    if month_ids:
        inside = {w.suffix: w.holds_month_id(col) for w in windows}
        span = col.isin([w.month_id for w in windows])
    else:
        inside = {w.suffix: w.holds(col) for w in windows}
        # The plain range reaches the scan; the exact windows are tested again per measure.
        starts = [w.start for w in windows]
        first = None if None in starts else min(starts)
        span = TrailingWindow("", first, max(w.stop for w in windows)).holds(col)
    for suffix, condition in extra.items():
        inside[suffix] = inside[suffix] & condition
    aggs = [
        m.finish(m.agg(F.when(inside[w.suffix], m.value))).alias(f"{name}{w.suffix}")
        for w in windows
        for name, m in measures.items()
    ]
    return df.where(span).where(reduce(or_, inside.values())).groupBy(key).agg(*aggs)


def history_to_date(
    df: DataFrame,
    key: str,
    date: str,
    cutoff: Column,
    measures: Mapping[str, Measure],
    inclusive: bool = False,
) -> DataFrame:
    """Measures over all rows before a cut-off."""
    before = F.col(date) <= cutoff if inclusive else F.col(date) < cutoff
    aggs = [m.finish(m.agg(m.value)).alias(name) for name, m in measures.items()]
    return df.where(before).groupBy(key).agg(*aggs)


def latest_per_key(df: DataFrame, key: str, order: str, tiebreak: str | Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key, NULL order last, ties by ``tiebreak`` ascending.

    Spark keeps one candidate per key and task before the shuffle, so a key that holds much of the
    table does not travel.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    w = Window.partitionBy(key).orderBy(F.col(order).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")
