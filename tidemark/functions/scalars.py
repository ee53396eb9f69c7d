"""Scalar expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two states of a flag column.
YES, NO = "S", "N"

# Hex digits of the md5 that order rows at random: 13 digits are 52 bits, exact as a double.
HASH_DIGITS = 13
HASH_TOP = 16**HASH_DIGITS


def as_int64(x: Column) -> Column:
    """Cast to BIGINT rounding half away from zero (a plain Spark cast truncates)."""
    return F.round(x).cast("bigint")


def round_even(x: Column, places: int) -> Column:
    """Round half to even at ``places`` decimals."""
    scale = float(10**places)
    return F.rint(x * scale) / scale


def scaled_int(x: Column, factor: int = 10000) -> Column:
    """``x * factor`` truncated to BIGINT."""
    return (x * F.lit(factor)).cast("bigint")


def significant(x: Column, digits: int = 7) -> Column:
    """Keep ``digits`` significant digits, as a decimal."""
    return F.format_string(f"%.{digits - 1}e", x).cast("decimal(38,18)")


def month_id(day: Column) -> Column:
    """Integer ``yyyyMM`` of a date or timestamp."""
    return F.year(day) * 100 + F.month(day)


def month_flag(ts: Column, first_day: date, last_day: date) -> Column:
    """'S' if the timestamp falls between two days, both included, else 'N'."""
    inside = (ts >= F.lit(first_day)) & (ts < F.lit(last_day + timedelta(days=1)))
    return F.when(inside, YES).otherwise(NO)


def measure_family(columns: Sequence[Column]) -> Column:
    """Row-wise sum of several measures; NULL as soon as one of them is NULL."""
    return reduce(add, columns)


def matches_any(col: Column, patterns: Iterable[str]) -> Column:
    """True where ``col`` is LIKE at least one pattern."""
    return reduce(or_, [col.like(p) for p in patterns])


def exclude_patterns(col: Column, patterns: Iterable[str]) -> Column:
    """True where ``col`` is NOT LIKE every pattern (NULL, hence dropped, for a NULL value)."""
    return ~matches_any(col, patterns)


def edge_bin(x: Column, edges: Sequence[float], base: int = 0) -> Column:
    """Number of the right-closed bin ``(edges[i], edges[i+1]]``, NULL outside all of them."""
    if list(edges) != sorted(set(edges)) or len(edges) < 2:
        raise ValueError("edges must increase strictly and number at least two")
    chain = F.when(x.isNull() | F.isnan(x.cast("double")) | (x <= F.lit(edges[0])), None)
    for i, upper in enumerate(edges[1:]):
        chain = chain.when(x <= F.lit(upper), F.lit(i + base))
    return chain.otherwise(None).cast("bigint")


def hash_order(key: Column, seed: int | str) -> Column:
    """Seeded pseudo-random number of a key: 52 bits of md5, the same wherever it is computed.

    Sorting by it is a shuffle that does not depend on partitioning.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")
