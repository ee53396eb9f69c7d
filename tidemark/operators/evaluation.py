"""Lift and the two evaluation tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import round_even, significant
from tidemark.operators.audience import with_run_columns
from tidemark.operators.ranking import quantile_bin

# Column order of the stored evaluation tables.
CLASS_EVAL_COLUMNS = (
    "MODEL_NAME", "DECIL", "PUBLICO", "CONVERSAO", "RESP_RATE", "LIFT",
    "CONVERSAO_ACC", "CONVERSAO_PERC", "KS", "SAFRA", "DT_EXEC", "DT_TRAIN",
)
REGR_EVAL_COLUMNS = ("MODEL_NAME", "PRED_BIN", "TARGET_BIN", "QTDE", "SAFRA", "DT_EXEC", "DT_TRAIN")


def _rate(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def lift_table(df: DataFrame, score0: str, label: str, q: int = 10, key: str = "customer_id") -> DataFrame:
    """Response, lift and cumulative shares per score group; group 1 is likeliest positive.

    ``score0`` is the probability of class 0, so groups rise with it. Lift comes from the rounded
    response rate. ``KS`` is the cumulative share of positives minus that of a random order;
    ``ks_distance`` is the distance between the cumulative shares of the two classes.

    Rows reach the shuffle as one partial count per task and group; all windows run on q rows.
    """
    grouped = quantile_bin(df.select(key, score0, label), score0, key, q, "scr_grp")
    counts = (
        grouped.where(F.col("scr_grp").isNotNull())
        .groupBy("scr_grp")
        .agg(F.count_if(F.col(label) == 0).alias("Negatives"), F.count_if(F.col(label) == 1).alias("Positives"))
    )
    running = Window.orderBy("scr_grp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(1))
    p, n = F.col("Positives"), F.col("Negatives")
    sums = counts.select(
        "*",
        F.sum(p).over(running).alias("__cp"),
        F.sum(n).over(running).alias("__cn"),
        F.sum(p).over(whole).alias("__g"),
        F.sum(n).over(whole).alias("__b"),
    )
    average = _rate(F.col("__g"), F.col("__g") + F.col("__b"))
    resp = round_even(_rate(p, p + n), 2)
    cum_resp = round_even(_rate(F.col("__cp"), F.col("__cp") + F.col("__cn")), 2)
    return (
        sums.withColumn("resp_rate", resp)
        .withColumn("lift", round_even(F.try_divide(F.col("resp_rate"), average), 2))
        .withColumn("cmltv_p_perc", round_even(_rate(F.col("__cp"), F.col("__g")) * 100, 1))
        .withColumn("cmltv_n_perc", round_even(_rate(F.col("__cn"), F.col("__b")) * 100, 1))
        .withColumn("cmltv_rand_p_perc", F.col("scr_grp") / F.lit(float(q)) * 100)
        .withColumn("cmltv_resp_rate", cum_resp)
        .withColumn("cmltv_lift", round_even(F.try_divide(F.col("cmltv_resp_rate"), average), 2))
        .withColumn("KS", round_even(F.col("cmltv_p_perc") - F.col("cmltv_rand_p_perc"), 2))
        .withColumn("ks_distance", round_even(F.col("cmltv_p_perc") - F.col("cmltv_n_perc"), 1))
        .drop("__cp", "__cn", "__g", "__b")
    )


def eval_table_class(lift: DataFrame, model: str, month: Any, run: str, train_run: Any) -> DataFrame:
    """The stored classification evaluation: :func:`lift_table` renamed, 7 digits, run columns."""
    share = F.col("Positives") / F.sum("Positives").over(Window.partitionBy(F.lit(1))) * 100
    table = lift.select(
        F.col("scr_grp").alias("DECIL"),
        (F.col("Negatives") + F.col("Positives")).alias("PUBLICO"),
        F.col("Positives").alias("CONVERSAO"),
        significant(F.col("resp_rate")).alias("RESP_RATE"),
        significant(F.col("lift")).alias("LIFT"),
        significant(F.col("cmltv_p_perc")).alias("CONVERSAO_ACC"),
        significant(share).alias("CONVERSAO_PERC"),
        significant(F.col("KS")).alias("KS"),
    )
    stamped = with_run_columns(table, MODEL_NAME=model, SAFRA=month, DT_EXEC=run, DT_TRAIN=train_run)
    return stamped.select(*CLASS_EVAL_COLUMNS)


def eval_table_regr(confusion: DataFrame, model: str, month: Any, run: str, train_run: Any) -> DataFrame:
    """The stored regression evaluation: :func:`confusion_bins` with run columns."""
    table = confusion.select(
        F.col("pred_grp").alias("PRED_BIN"), F.col("target_grp").alias("TARGET_BIN"), F.col("cnt").alias("QTDE")
    )
    stamped = with_run_columns(table, MODEL_NAME=model, SAFRA=month, DT_EXEC=run, DT_TRAIN=train_run)
    return stamped.select(*REGR_EVAL_COLUMNS)


__all__: Sequence[str] = ("CLASS_EVAL_COLUMNS", "REGR_EVAL_COLUMNS", "eval_table_class", "eval_table_regr", "lift_table")
