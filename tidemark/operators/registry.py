"""The model registry: best model, latest model, champion against challenger."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Columns of the champion table.
REGISTRY_COLUMNS = ("MODEL_NAME", "DT_TRAIN", "METRIC", "SAFRA")

DIRECTIONS = ("maximize", "minimize")


def metric_percent(value: Column) -> Column:
    """A share such as an AUC as whole percent, truncated."""
    return (value * 100).cast("int")


def _known(registry: DataFrame, model: str, month: Any) -> DataFrame:
    return registry.where((F.col("SAFRA") <= F.lit(month)) & (F.col("MODEL_NAME") == F.lit(model)))


def best_model(registry: DataFrame, model: str, month: Any, direction: str = "maximize") -> DataFrame:
    """The run with the best metric up to a month; among equals the latest month, then run."""
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    order = F.desc("METRIC") if direction == "maximize" else F.asc("METRIC")
    top = _known(registry, model, month).where(F.col("METRIC").isNotNull())
    best = top.orderBy(order, F.desc("SAFRA"), F.desc("DT_TRAIN")).limit(1)
    return best.select("SAFRA", "DT_TRAIN", F.col("METRIC").alias("BEST_METRIC"))


def latest_trained(registry: DataFrame, model: str, month: Any) -> DataFrame:
    """The last run of the latest month trained up to a month."""
    pair = F.struct("SAFRA", "DT_TRAIN")
    last = _known(registry, model, month).agg(F.max(pair).alias("last"))
    return last.where(F.col("last").isNotNull()).select("last.*")


def select_model(
    registry: DataFrame, champions: DataFrame | None, model: str, month: Any, direction: str = "maximize"
) -> DataFrame:
    """The champion if there is one (and a champion table is in use), else the latest run."""
    latest = latest_trained(registry, model, month).withColumn("source", F.lit("latest"))
    if champions is None:
        return latest
    best = best_model(champions, model, month, direction).select("SAFRA", "DT_TRAIN", F.lit("champion").alias("source"))
    # One row each at most; "champion" sorts before "latest".
    return best.unionByName(latest).orderBy("source").limit(1)


def champion_decision(
    registry: DataFrame, candidate: DataFrame, tolerance: float = 0, direction: str = "maximize"
) -> DataFrame:
    """Decide for each candidate run whether it joins the champion table.

    It does if the table has no run of the model up to the candidate's month, or if its metric comes
    within ``tolerance`` of the best of those. ``accepted`` rows are the ones to append.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    up = direction == "maximize"
    best_of = F.max if up else F.min
    # Months of the table and candidates in one line per model; the running best at a candidate is the
    # best of the table's months up to its own. No candidate is paired with every earlier run.
    months = registry.groupBy("MODEL_NAME", "SAFRA").agg(best_of("METRIC").alias("__v"))
    line = months.unionByName(
        candidate.select("MODEL_NAME", "SAFRA", F.struct(*REGISTRY_COLUMNS).alias("__run")), allowMissingColumns=True
    )
    so_far = Window.partitionBy("MODEL_NAME").orderBy("SAFRA").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    known = line.withColumn("BEST_METRIC", best_of("__v").over(so_far)).where(F.col("__run").isNotNull())
    best = known.select("__run.*", "BEST_METRIC")
    gap = F.col("METRIC") + F.lit(tolerance) >= F.col("BEST_METRIC")
    if not up:
        gap = F.col("METRIC") - F.lit(tolerance) <= F.col("BEST_METRIC")
    return best.withColumn("accepted", F.col("BEST_METRIC").isNull() | gap)
