"""Classification and regression metrics as aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import edge_bin
from tidemark.operators.ranking import RangeBuckets, average_rank, present, running_sums

LOG_SHIFT = 1e-5  # fixed value: keeps logarithms of zero finite


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient as a double, 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    The rows are counted once by (label, prediction); everything after works on that small table.
    """
    cells = df.groupBy(F.col(y).cast("bigint").alias("y"), F.col(pred).cast("bigint").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("real"), none.alias("said"), hit.alias("tp")),
        F.struct(F.col("p").alias("c"), none.alias("real"), F.col("n").alias("said"), none.alias("tp")),
    )
    per = (
        cells.select(F.inline(sides))
        .groupBy("c")
        .agg(F.sum("real").alias("support"), F.sum("said").alias("said"), F.sum("tp").alias("tp"))
        .withColumn("precision", _ratio(F.col("tp"), F.col("said")))
        .withColumn("recall", _ratio(F.col("tp"), F.col("support")))
        .withColumn("f1_score", _ratio(2 * F.col("tp"), F.col("said") + F.col("support")))
    )
    names = ("precision", "recall", "f1_score")
    total = F.sum("support")
    means = per.agg(
        (F.sum("tp") / total).alias("acc"),
        *[F.avg(m).alias(f"macro_{m}") for m in names],
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(f"weighted_{m}") for m in names],
        total.alias("support"),
    )

    def line(name: str, values: Sequence[str]) -> Column:
        return F.struct(
            F.lit(name).alias("label"), *[F.col(v).alias(m) for v, m in zip(values, names)], F.col("support")
        )

    summary = means.select(
        F.inline(
            F.array(
                line("accuracy", ["acc"] * 3),
                line("macro avg", [f"macro_{m}" for m in names]),
                line("weighted avg", [f"weighted_{m}" for m in names]),
            )
        )
    )
    return per.select(F.col("c").cast("string").alias("label"), *names, "support").unionByName(summary)


def _score_rows(df: DataFrame, score: str, label: str) -> tuple[DataFrame, DataFrame, RangeBuckets]:
    """Rows with a score and 0/1 columns p and n; their sums per distinct score; splits of the scores."""
    positive = F.col(label) == 1
    rows = df.select(
        present(df, score).alias(score),
        F.when(positive, 1).otherwise(0).alias("p"),
        F.when(positive, 0).when(F.col(label).isNotNull(), 1).otherwise(0).alias("n"),
    ).where(F.col(score).isNotNull())
    groups = rows.groupBy(score).agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    return rows, groups, RangeBuckets.fit(rows, score)


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve, exact: tied scores count half."""
    rows, groups, b = _score_rows(df, score, label)
    sums = running_sums(groups, b, ["n"], rows)
    # Twice the pairs won, as integers: no rounding in the sum.
    won = F.sum(F.col("p").cast("decimal(18,0)") * (2 * F.col("n_before") + F.col("n")).cast("decimal(19,0)"))
    pairs = 2 * F.sum("p").cast("double") * F.sum("n").cast("double")
    return sums.agg(F.try_divide(won.cast("double"), pairs).alias("roc_auc"))


def roc_points(df: DataFrame, score: str, label: str, drop_collinear: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) by falling threshold, from (inf, 0, 0).

    ``drop_collinear`` keeps the ends and the points where the step in either count changes. The
    step after a bucket's last point is the first group of the bucket below it.
    """
    _, groups, b = _score_rows(df, score, label)
    sums = running_sums(groups, b, ["p", "n"])
    down = Window.partitionBy("__bucket").orderBy(F.col(score).desc())
    seen = sums.withColumn("__next", F.lead(F.struct("p", "n")).over(down)).withColumn(
        "__first", F.col("__top") & (F.row_number().over(down) == 1)
    )
    seen = seen.withColumn("__next", F.coalesce("__next", "__head"))
    if drop_collinear:
        bend = (F.col("__next.p") != F.col("p")) | (F.col("__next.n") != F.col("n"))
        seen = seen.where(F.col("__first") | F.col("__next").isNull() | bend)

    def share(at_or_above: Column, total: Column) -> Column:
        return F.try_divide(at_or_above.cast("double"), total.cast("double"))

    def point(threshold: Column, n: Column, p: Column) -> Column:
        return F.struct(
            threshold.cast("double").alias("threshold"),
            share(n, F.col("n_total")).alias("fpr"),
            share(p, F.col("p_total")).alias("tpr"),
        )

    # Counts at or above a threshold = all minus those below it.
    here = point(F.col(score), F.col("n_total") - F.col("n_before"), F.col("p_total") - F.col("p_before"))
    origin = point(F.lit(math.inf), F.lit(0), F.lit(0))
    return seen.select(F.inline(F.when(F.col("__first"), F.array(origin, here)).otherwise(F.array(here))))


def optimal_threshold(df: DataFrame, score: str, label: str, drop_collinear: bool = True) -> DataFrame:
    """The ROC point with the largest sqrt(TPR * (1 - FPR)); among equals the highest threshold."""
    points = roc_points(df, score, label, drop_collinear)
    g = F.sqrt(F.col("tpr") * (1 - F.col("fpr"))).alias("gmean")
    return points.select("threshold", "fpr", "tpr", g).orderBy(F.desc_nulls_last("gmean"), F.desc("threshold")).limit(1)


def apply_threshold(df: DataFrame, score: str, t: float, out: str = "prediction") -> DataFrame:
    """1 where the score reaches the threshold, else 0."""
    return df.withColumn(out, F.when(F.col(score) >= F.lit(t), 1).otherwise(0).cast("bigint"))


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10, closed: str = "right") -> DataFrame:
    """Mean score and share of positives in equal bins of [0, 1]; empty bins are left out."""
    edges = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    s = F.col(score)
    number = F.when(s.isNull() | F.isnan(s.cast("double")), None)
    for i, upper in enumerate(edges[1:-1]):
        number = number.when(s <= F.lit(upper) if closed == "right" else s < F.lit(upper), F.lit(i))
    number = number.otherwise(F.lit(bins - 1)).cast("bigint")
    return (
        df.select(number.alias("bin"), s.cast("double").alias("__s"), F.col(label).cast("double").alias("__y"))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.avg("__s").alias("prob_pred"), F.avg("__y").alias("prob_true"), F.count(F.lit(1)).alias("rows"))
    )


def _cuts(low: float, high: float, n: int, log_scale: bool) -> list[float]:
    if log_scale:
        if low + LOG_SHIFT <= 0:
            raise ValueError("logarithmic cuts need scores above -1e-5")
        a, z = math.log10(low + LOG_SHIFT), math.log10(high + LOG_SHIFT)
        return [10.0 ** (a + i * ((z - a) / (n - 1))) if i < n - 1 else 10.0**z for i in range(n)]
    return [low + i * ((high - low) / n) for i in range(n)]


def best_f1(df: DataFrame, score: str, label: str, n_cuts: int = 100, log_scale: bool = True) -> DataFrame:
    """Largest F1 over ``n_cuts`` cuts between the smallest and the largest score.

    Each row falls between two cuts once; the counts at a cut are sums over the bins above it.
    """
    s = present(df, score).cast("double")
    low, high = df.agg(F.min(s), F.max(s)).first()
    cuts = sorted(set(_cuts(low, high, n_cuts, log_scale))) if low is not None else [0.0]
    splits = [-math.inf, *cuts, math.inf]
    rows = df.select(s.alias("__s"), (F.col(label) == 1).alias("__y")).where(F.col("__s").isNotNull())
    binned = Bucketizer(splits=splits, inputCol="__s", outputCol="__b").transform(rows)
    per_bin = binned.groupBy("__b").agg(
        F.count_if("__y").alias("p"), F.count(F.lit(1)).alias("rows")
    )  # n_cuts + 1 rows at most
    above = Window.orderBy(F.desc("__b"))
    sums = per_bin.select(
        "__b",
        F.sum("p").over(above).alias("tp"),
        F.sum("rows").over(above).alias("said"),
        F.sum("p").over(Window.partitionBy(F.lit(1))).alias("real"),
    )
    # A cut with an empty bin below it repeats the counts of the next bin that has rows.
    f1 = F.when(F.col("__b") > 0, _ratio(2 * F.col("tp"), F.col("said") + F.col("real"))).otherwise(F.lit(0.0))
    return sums.agg(F.max(f1).alias("best_f1"))


def regression_metrics(df: DataFrame, y: str, pred: str, swapped: bool = False) -> DataFrame:
    """R2, MAE, MSE and Pearson correlation from one aggregate.

    ``swapped`` measures R2 against the spread of the predictions instead of the actual values.
    """
    a, p = F.col(y).cast("double"), F.col(pred).cast("double")
    base = p if swapped else a
    both = df.where(a.isNotNull() & p.isNotNull())
    spread = F.var_pop(base) * F.count(base)
    return both.agg(
        (1 - F.try_divide(F.sum((a - p) * (a - p)), spread)).alias("r2"),
        F.avg(F.abs(a - p)).alias("mae"),
        F.avg((a - p) * (a - p)).alias("mse"),
        F.corr(a, p).alias("pearson"),
    )


def spearman(df: DataFrame, y: str, pred: str, key: str) -> DataFrame:
    """Correlation of the ranks, ties given their mean rank."""
    both = df.select(key, y, pred).where(present(df, y).isNotNull() & present(df, pred).isNotNull())
    ranked = average_rank(average_rank(both, y, key, "__ry"), pred, key, "__rp")
    return ranked.agg(F.corr("__ry", "__rp").alias("spearman"))


def score_histogram(df: DataFrame, score: str, label: str, bins: int = 20) -> DataFrame:
    """Rows and density per class and equal-width bin; the densities of a class integrate to 1."""
    s = present(df, score).cast("double")
    low, high = df.agg(F.min(s), F.max(s)).first()
    low, high = (low, high) if low is not None else (0.0, 1.0)
    width = (high - low) / bins if high > low else 1.0
    number = F.least(F.floor((s - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = (
        df.where(s.isNotNull())
        .groupBy(F.col(label).cast("bigint").alias("label"), number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    in_class = F.sum("rows").over(Window.partitionBy("label"))
    return counts.select(
        "label",
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
        "rows",
        (F.col("rows") / in_class / F.lit(width)).alias("density"),
    )


def confusion_bins(
    df: DataFrame, y: str, pred: str, edges: Sequence[float], on: str = "value", key: str | None = None
) -> DataFrame:
    """Rows per (predicted bin, actual bin); rows outside the edges are left out.

    ``on='rank'`` bins the ranks of the two columns instead of their values and needs ``key``.
    """
    if on == "rank":
        from tidemark.operators.ranking import rank_edge_bin

        if key is None:
            raise ValueError("on='rank' needs a unique key")
        slim = df.select(key, y, pred)
        binned = rank_edge_bin(rank_edge_bin(slim, pred, key, edges, "pred_grp"), y, key, edges, "target_grp")
    elif on == "value":
        binned = df.select(edge_bin(F.col(pred), edges).alias("pred_grp"), edge_bin(F.col(y), edges).alias("target_grp"))
    else:
        raise ValueError("on must be 'value' or 'rank'")
    both = F.col("pred_grp").isNotNull() & F.col("target_grp").isNotNull()
    return binned.where(both).groupBy("pred_grp", "target_grp").agg(F.count(F.lit(1)).alias("cnt"))


def confusion_pivot(bins: DataFrame, edges: Sequence[float]) -> DataFrame:
    """:func:`confusion_bins` as a matrix, one column per actual bin."""
    actual = list(range(len(edges) - 1))
    wide = bins.groupBy("pred_grp").pivot("target_grp", actual).agg(F.sum("cnt"))
    return wide.select("pred_grp", *[F.col(str(i)).alias(f"target_{i}") for i in actual])


def sorted_series(df: DataFrame, y: str, pred: str, key: str) -> DataFrame:
    """Logarithms of actual and predicted values, numbered by the actual value."""
    from tidemark.operators.ranking import global_rank

    ranked = global_rank(df.select(key, y, pred), y, key, "position")
    shift = F.lit(LOG_SHIFT)
    return ranked.select(
        "position",
        F.ln(F.col(y).cast("double") + shift).alias("log_actual"),
        F.ln(F.col(pred).cast("double") + shift).alias("log_predicted"),
    )
