"""Score tables, binned calibration, batch scoring, the latest run."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import edge_bin, scaled_int
from tidemark.operators.audience import with_run_columns
from tidemark.operators.ranking import bin_by_cuts, bin_edges, quantile_bin, rank_cuts, rank_edge_bin

SCORE_FACTOR = 10000  # fixed value: stored scores are ten-thousandths


def class_score_columns(key: str) -> list[str]:
    """Column order of the stored classification scores."""
    return ["MODEL_NAME", key, "DECIL", "SCORES_0", "SCORES_1", "SAFRA", "DT_EXEC", "DT_TRAIN"]


def regr_score_columns(key: str) -> list[str]:
    """Column order of the stored regression scores."""
    return ["MODEL_NAME", key, "DECIL", "SCORES", "SAFRA", "DT_EXEC", "DT_TRAIN"]


def score_table_class(
    df: DataFrame, key: str, p0: str, p1: str, model: str, month: Any, run: str, train_run: Any, q: int = 10
) -> DataFrame:
    """Deciles of the probability of class 0 (1 = likeliest positive) and truncated scores."""
    binned = quantile_bin(df.select(key, p0, p1), p0, key, q, "DECIL")
    scored = binned.withColumns(
        {"SCORES_0": scaled_int(F.col(p0), SCORE_FACTOR), "SCORES_1": scaled_int(F.col(p1), SCORE_FACTOR)}
    )
    stamped = with_run_columns(scored, MODEL_NAME=model, SAFRA=month, DT_EXEC=run, DT_TRAIN=train_run)
    return stamped.select(*class_score_columns(key))


def score_table_regr(
    df: DataFrame,
    key: str,
    pred: str,
    edges: Sequence[float],
    model: str,
    month: Any,
    run: str,
    train_run: Any,
    on: str = "value",
) -> DataFrame:
    """Fixed-edge bins of the prediction, or of its rank with ``on='rank'``, and two decimals."""
    slim = df.select(key, pred)
    if on == "rank":
        binned = rank_edge_bin(slim, pred, key, edges, "DECIL", base=1)
    elif on == "value":
        binned = slim.withColumn("DECIL", edge_bin(F.col(pred), edges, base=1))
    else:
        raise ValueError("on must be 'value' or 'rank'")
    scored = binned.withColumn("SCORES", F.col(pred).cast("decimal(18,2)"))
    stamped = with_run_columns(scored, MODEL_NAME=model, SAFRA=month, DT_EXEC=run, DT_TRAIN=train_run)
    return stamped.select(*regr_score_columns(key))


def fit_binned_calibration(df: DataFrame, score: str, label: str, n_bins: int, key: str) -> DataFrame:
    """Mean label per equal-frequency bin of the score: ``(bin, prob)``, bins from 0."""
    return _bin_means(quantile_bin(df.select(key, score, label), score, key, n_bins, "__b"), label)


def _bin_means(binned: DataFrame, label: str) -> DataFrame:
    return (
        binned.where(F.col("__b").isNotNull())
        .groupBy((F.col("__b") - 1).alias("bin"))
        .agg((F.sum(F.col(label).cast("double")) / F.count(label)).alias("prob"))
    )


def binned_calibration(
    df: DataFrame,
    score: str,
    label: str,
    n_bins: int,
    key: str,
    apply_to: DataFrame | None = None,
    edges: str = "own",
) -> DataFrame:
    """Calibrated probability and class of each row of ``apply_to`` (of ``df`` if not given).

    New rows are binned by their own ranks, as the fit was, or with ``edges="training"`` by where the
    fit's bins ended. The fit's ranks are found once. A bin unknown to the fit gives 0.
    """
    if edges not in ("own", "training"):
        raise ValueError("edges must be 'own' or 'training'")
    cuts = rank_cuts(df, score, key, lambda n: bin_edges(n, n_bins))
    table = _bin_means(bin_by_cuts(df, cuts, n_bins, "__b"), label)
    if apply_to is None or edges == "training":
        binned = bin_by_cuts(df if apply_to is None else apply_to, cuts, n_bins, "__b")
    else:
        binned = quantile_bin(apply_to, score, key, n_bins, "__b")
    binned = binned.withColumn("bin", F.col("__b") - 1).drop("__b")
    # n_bins rows: bounded by the argument.
    return (
        binned.join(F.broadcast(table), "bin", "left")
        .withColumn("calibrated", F.coalesce("prob", F.lit(0.0)))
        .withColumn("prediction", F.when(F.col("calibrated") >= 0.5, 1).otherwise(0).cast("bigint"))
        .drop("prob")
    )


def batch_score(model: PipelineModel, df: DataFrame, key: str, kind: str = "classification") -> DataFrame:
    """Score a set with a fitted pipeline; the key goes through untouched."""
    out = model.transform(df)
    if kind == "regression":
        return out.select(key, F.col("prediction").cast("double").alias("pred"))
    p = vector_to_array("probability")
    return out.select(key, p[0].alias("p0"), p[1].alias("p1"))


def latest_scores(df: DataFrame, model: str, month: Any) -> DataFrame:
    """Rows of the last run of a model and month."""
    mine = df.where((F.col("MODEL_NAME") == F.lit(model)) & (F.col("SAFRA") == F.lit(month)))
    last = mine.agg(F.max("DT_EXEC").alias("DT_EXEC"))
    return mine.join(F.broadcast(last), "DT_EXEC", "left_semi")  # one row
