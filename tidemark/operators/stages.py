"""Pipeline stages of our own: a category encoder and a score calibration, both saved with the pipeline.

What grows with the data (categories, steps of a calibration) is a parquet table beside the stage, written
and read by Spark; the driver holds parameters only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored


class _TableWriter(MLWriter):
    """Parameters as usual, and the stage's table beside them."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        if self.stage.table is not None:
            self.stage.table.write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        if stage.has_table():
            stage.table = self.sparkSession.read.parquet(f"{path}/table")
        return stage


class _WithTable(MLReadable, MLWritable):
    table: DataFrame | None = None

    def has_table(self) -> bool:
        return True

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class _EncoderParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "category columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "their encoded values", TypeConverters.toListString)


class CategoryEncoder(_EncoderParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Mean label per category, blended with the overall mean: n rows weigh n / (n + smoothing).

    All columns are counted in one pass with partial sums; the encoding stays a table.
    """

    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "rows the overall mean counts for", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol=None, smoothing=1.0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "CategoryEncoderModel":
        from tidemark.operators.prep import fit_target_encoder

        cols = self.getOrDefault("inputCols")
        fitted = fit_target_encoder(df, cols, self.getOrDefault("labelCol"), "additive", self.getOrDefault("smoothing"))
        model = CategoryEncoderModel()
        model._set(inputCols=cols, outputCols=self.getOrDefault("outputCols"), prior=float(fitted.prior or 0.0))
        model.table = fitted.table
        return model


class CategoryEncoderModel(_EncoderParams, Model, _WithTable):
    """Adds the encoded columns; a category that the fit has not seen gets the overall mean."""

    prior = Param(Params._dummy(), "prior", "overall mean", TypeConverters.toFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        from tidemark.operators.prep import TargetEncoding

        cols, outs = self.getOrDefault("inputCols"), self.getOrDefault("outputCols")
        encoded = TargetEncoding(self.table, self.getOrDefault("prior"), tuple(cols)).transform(df, "__encoded")
        return encoded.withColumnsRenamed({f"{c}__encoded": o for c, o in zip(cols, outs)})


# -- Isotonic fit ---------------------------------------------------------------------------------

_BLOCK = "low double, high double, y double, w double"
MERGED = 16  # ranges that one task merges


def _pooled(rows: Sequence[tuple]) -> list[list[float]]:
    """Adjacent violators pooled: blocks (low, high, sum of y, weight) with strictly rising means."""
    out: list[list[float]] = []
    for low, high, y, w in rows:
        out.append([low, high, y, w])
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            _, high, y, w = out.pop()
            out[-1][1] = high
            out[-1][2] += y
            out[-1][3] += w
    return out


def isotonic_blocks(df: DataFrame, score: str, y: Column, w: Column | None = None) -> DataFrame:
    """Least-squares fit of a non-decreasing function of the score: blocks (low, high, value, weight).

    Scores are cut into ranges and the violators of each range pooled by itself; blocks of neighbouring
    ranges are then pooled with each other, sixteen ranges at a time, up a tree. Pooling pooled blocks
    gives what pooling all rows would. Scores of one value are one block from the start. Rows without a
    score, a label or a positive weight do not count.
    """
    import pandas as pd

    from tidemark.operators.ranking import RangeBuckets, present

    weight = F.lit(1.0) if w is None else w.cast("double")
    rows = df.select(present(df, score).cast("double").alias("s"), y.cast("double").alias("y"), weight.alias("w"))
    groups = rows.where("s is not null and y is not null and w > 0").groupBy("s").agg(F.sum(F.col("y") * F.col("w")).alias("y"), F.sum("w").alias("w"))
    groups = stored(groups, "scores")
    ranges = RangeBuckets.fit(groups, "s")
    blocks = ranges.assign(groups, "part").select("part", F.col("s").alias("low"), F.col("s").alias("high"), "y", "w")
    left = len(ranges.points) + 1

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("low")
        return pd.DataFrame(_pooled(part[["low", "high", "y", "w"]].itertuples(index=False, name=None)), columns=["low", "high", "y", "w"]).assign(part=key[0])

    while True:
        blocks = stored(blocks.groupBy("part").applyInPandas(merge, _BLOCK + ", part long"), "blocks")
        if left <= 1:
            break
        left = -(-left // MERGED)
        blocks = blocks.withColumn("part", F.floor(F.col("part") / MERGED))
    return blocks.select("low", "high", (F.col("y") / F.col("w")).alias("value"), F.col("w").alias("weight"))


class ScoreCalibration(Transformer, _WithTable):
    """Turns P(class 1) of the column ``probability`` into a calibrated one and sets ``prediction``.

    ``sigmoid``: 1 / (1 + exp(-(slope * p + intercept))). ``isotonic``: the value of the block that holds
    the score, between two blocks the straight line. ``none`` leaves it. Class 1 from the threshold on,
    the threshold itself included (compared with the probability that goes out).
    """

    method = Param(Params._dummy(), "method", "sigmoid, isotonic or none", TypeConverters.toString)
    slope = Param(Params._dummy(), "slope", "of the sigmoid", TypeConverters.toFloat)
    intercept = Param(Params._dummy(), "intercept", "of the sigmoid", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "least probability of class 1", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, method="none", slope=1.0, intercept=0.0, threshold=0.5):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(method="none", slope=1.0, intercept=0.0, threshold=0.5)

    def has_table(self) -> bool:
        return self.getOrDefault("method") == "isotonic"

    def _transform(self, df: DataFrame) -> DataFrame:
        p = vector_to_array("probability")[1]
        method = self.getOrDefault("method")
        if method == "sigmoid":
            p = 1 / (1 + F.exp(-(p * self.getOrDefault("slope") + self.getOrDefault("intercept"))))
        elif method == "isotonic":
            df, p = self.stepped(df.withColumn("__p", p))
        out = df.withColumn("__p", p)
        out = out.withColumn("probability", array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))))
        return out.withColumn("prediction", (F.col("__p") >= self.getOrDefault("threshold")).cast("double")).drop("__p")

    def stepped(self, df: DataFrame) -> tuple[DataFrame, Column]:
        """``df`` with what the value needs, and the fitted value of its column ``__p``."""
        from tidemark.operators.ranking import MOST_BUCKETS, count_reached

        # A fit over probabilities of n rows has at most some n ** (2/3) blocks and hardly ever over a thousand.
        steps = self.table.orderBy("low").limit(MOST_BUCKETS + 1).collect()
        if len(steps) > MOST_BUCKETS:
            raise RuntimeError(f"an isotonic calibration of over {MOST_BUCKETS} steps; use sigmoid")
        if not steps:
            return df, F.col("__p")
        lows, highs, values = ([float(r[c]) for r in steps] for c in ("low", "high", "value"))
        at = lambda values, i: F.get(F.from_json(F.lit(repr(values)), "array<double>"), i)
        df = count_reached(df, ["__p"], [(x,) for x in lows], "__at")
        i = F.col("__at")
        left, right = at(highs, i - 1), at(lows, i)
        here, there = at(values, i - 1), at(values, i)
        line = here + (there - here) * (F.col("__p") - left) / (right - left)
        p = F.when(i == 0, values[0]).when((F.col("__p") <= left) | (i == len(steps)), here).otherwise(line)
        return df.withColumn("__c", p).drop("__at").withColumn("__p", F.col("__c")).drop("__c"), F.col("__p")


def fit_score_calibration(df: DataFrame, label: str, method: str = "none", threshold: bool = False) -> ScoreCalibration:
    """Calibration and threshold of a frozen classifier, from rows held out of its fit that have its ``probability``.

    With ``threshold`` class 1 begins at the score with the best sqrt(TPR * (1 - FPR)) among these rows.
    """
    from tidemark.operators.metrics import optimal_threshold
    from tidemark.operators.training import fit_calibration

    held = stored(df.select(F.col(label).alias("y"), vector_to_array("probability")[1].alias("p1")), "held-out")
    if method == "sigmoid":
        model = fit_calibration(held, "p1", "y", "sigmoid").model
        stage = ScoreCalibration(method=method, slope=float(model.coefficients[0]), intercept=float(model.intercept))
    elif method == "isotonic":
        stage = ScoreCalibration(method=method)
        stage.table = isotonic_blocks(held, "p1", (F.col("y") == 1).cast("double"))
    elif method == "none":
        stage = ScoreCalibration()
    else:
        raise ValueError("method must be 'sigmoid', 'isotonic' or 'none'")
    if threshold:
        out = stage.transform(df).select(F.col(label).alias("y"), vector_to_array("probability")[1].alias("p1"))
        best = optimal_threshold(stored(out, "calibrated"), "p1", "y").first()
        if best is not None and 0 < best["threshold"] <= 1:
            stage._set(threshold=float(best["threshold"]))
    return stage
