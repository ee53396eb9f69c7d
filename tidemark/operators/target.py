"""The capped-count target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: str) -> DataFrame:
    """One row per element of an array of structs; rows without elements vanish."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.inline(array))


def capped_count_target(
    df: DataFrame, key: str, entity: str, cap: int = 10, out: str = "target", value: str | None = None
) -> DataFrame:
    """Distinct entities per key, at most ``cap``; rows without an entity do not count.

    With ``value`` the result also has the largest value over the key's entities (``max_<value>``).
    """
    rows = df.where(F.col(entity).isNotNull())
    inner = [F.max(value).alias("__v")] if value else [F.lit(1).alias("__v")]
    per_entity = rows.groupBy(key, entity).agg(*inner)
    target = F.least(F.count(F.lit(1)), F.lit(cap)).cast("bigint").alias(out)
    top = [F.max("__v").alias(f"max_{value}")] if value else []
    return per_entity.groupBy(key).agg(target, *top)
