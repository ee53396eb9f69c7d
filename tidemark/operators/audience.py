"""Selecting the audience: predicates, membership joins, star joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import NO, YES


def audience(df: DataFrame, key: str, predicates: Iterable[Column]) -> DataFrame:
    """Distinct keys of the rows that meet every predicate."""
    return df.where(reduce(and_, predicates)).select(key).distinct()


def not_blank(col: Column) -> Column:
    """Present, and more than spaces."""
    return col.isNotNull() & (F.trim(col) != "")


def flag_unset_or_yes(col: Column) -> Column:
    """True where a flag is NULL or 'S'."""
    return col.isNull() | (col == YES)


def distinct_members(df: DataFrame, key: str, predicate: Column | None = None) -> DataFrame:
    """Distinct non-NULL keys, of the rows that meet ``predicate`` if one is given."""
    rows = df.where(F.col(key).isNotNull())
    if predicate is not None:
        rows = rows.where(predicate)
    return rows.select(key).distinct()


def presence_flag(df: DataFrame, other: DataFrame, key: str, out: str) -> DataFrame:
    """Add 'S' where the key occurs in ``other``, else 'N'; ``df`` keeps its rows."""
    members = other.select(key).distinct().withColumn("__hit", F.lit(True))
    return (
        df.join(members, key, "left")
        .withColumn(out, F.when(F.col("__hit"), YES).otherwise(NO))
        .drop("__hit")
    )


def exclude_members(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(key), key, "left_anti")


def require_activity(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    return df.join(other.select(key), key, "left_semi")


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` unchanged, failing at run time if a key repeats.

    The check sits in the values it returns, so it cannot be pruned away. A table already grouped
    by the key needs no further exchange for it. Of a single row the maximum is the value itself, and
    numbers and dates have a maximum that is aggregated by hash.
    """
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    repeats = F.concat(F.lit(f"{key} repeats: "), F.col(f"`{key}`").cast("string"))
    single = F.count(F.lit(1)) == 1

    def checked(c: str) -> Column:
        value = F.max(f"`{c}`") if isinstance(df.schema[c].dataType, fixed) else F.first(f"`{c}`")
        return F.when(single, value).otherwise(F.raise_error(repeats)).alias(c)

    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*[checked(c) for c in rest]) if rest else df.groupBy(key).agg(single.alias("__one")).select(key)


def star_join(
    base: DataFrame, tables: Sequence[DataFrame], key: str, check_unique: bool = True
) -> DataFrame:
    """Left join of per-key tables to ``base``.

    All joins share the key, so tables that were grouped by it join without another exchange, and
    AQE broadcasts those that turn out small. ``check_unique=False`` skips the run-time check for
    tables known to hold one row per key.
    """
    return reduce(
        lambda left, right: left.join(one_row_per_key(right, key) if check_unique else right, key, "left"),
        tables,
        base,
    )


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; an unknown name is an error, not a no-op."""
    unknown = sorted(set(names) - set(df.columns))
    if unknown:
        raise KeyError(f"no such columns: {unknown}")
    return df.drop(*names)


def with_run_columns(df: DataFrame, **constants: Any) -> DataFrame:
    """Add constant columns (model name, month, run stamps)."""
    values: Mapping[str, Column] = {n: v if isinstance(v, Column) else F.lit(v) for n, v in constants.items()}
    return df.withColumns(dict(values))
