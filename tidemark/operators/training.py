"""Fitting, tuning and calibrating models with Spark ML; permutation importance."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.scalars import HASH_TOP, hash_order
from tidemark.operators.datasets import train_test
from tidemark.operators.ranking import BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS, RangeBuckets, rank_within
from tidemark.operators.stages import ScoreCalibration, isotonic_blocks
from tidemark.session import stored

KINDS = ("classification", "regression")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight class 1 by negatives / positives, class 0 by one."""
    row = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    ratio = row["n"] / row["p"] if row["p"] else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(1.0))


def estimator(kind: str, params: Mapping[str, Any] | None = None, **columns: Any) -> Estimator:
    """A boosted-tree estimator of the kind."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    make = GBTClassifier if kind == "classification" else GBTRegressor
    return make(**columns, **dict(params or {}))


def fit_model(
    df: DataFrame,
    kind: str,
    params: Mapping[str, Any] | None = None,
    label: str = "target",
    features: str = "features",
    unbalanced: bool = False,
    make: Callable[..., Estimator] | None = None,
) -> Model:
    """Fit boosted trees, or whatever ``make(labelCol=, featuresCol=, **params)`` returns."""
    columns: dict[str, Any] = {"labelCol": label, "featuresCol": features}
    data = df.withColumn(label, F.col(label).cast("double"))
    if unbalanced and kind == "classification":
        data = class_weights(data, label)
        columns["weightCol"] = "weight"
    learner = make(**columns, **dict(params or {})) if make else estimator(kind, params, **columns)
    return learner.fit(data)


def prediction_column(kind: str) -> Column:
    """What a metric compares with the label: P(class 1), or the predicted value."""
    if kind == "classification":
        return vector_to_array("probability")[1]
    return F.col("prediction").cast("double")


Metric = Callable[[Column, Column], Column]


def mean_absolute_error(y: Column, pred: Column) -> Column:
    return F.avg(F.abs(y - pred))


def mean_squared_error(y: Column, pred: Column) -> Column:
    return F.avg((y - pred) * (y - pred))


def draw_params(space: Mapping[str, tuple], rng: random.Random) -> dict[str, Any]:
    """One point of a search space.

    Entries are ``("loguniform", low, high)``, ``("uniform", low, high)``, ``("int", low, high)``
    or ``("categorical", [values])``.
    """
    point: dict[str, Any] = {}
    for name, (kind, *bounds) in sorted(space.items()):
        if kind == "loguniform":
            point[name] = math.exp(rng.uniform(math.log(bounds[0]), math.log(bounds[1])))
        elif kind == "uniform":
            point[name] = rng.uniform(*bounds)
        elif kind == "int":
            point[name] = rng.randint(*bounds)
        elif kind == "categorical":
            point[name] = rng.choice(list(bounds[0]))
        else:
            raise ValueError(f"unknown distribution {kind!r}")
    return point


@dataclass(frozen=True)
class SearchResult:
    trials: DataFrame
    best_params: dict[str, Any]
    best_metric: float


def search(
    df: DataFrame,
    key: str,
    kind: str,
    space: Mapping[str, tuple],
    metric: Metric = mean_absolute_error,
    direction: str = "minimize",
    n_trials: int = 50,
    seed: int = 42,
    label: str = "target",
    features: str = "features",
    holdout: float = 0.2,
    params: Mapping[str, Any] | None = None,
    make: Callable[..., Estimator] | None = None,
    rungs: Sequence[float] = (1.0,),
    keep: float = 1 / 3,
    parallel: int = 1,
    early_stop: bool = False,
) -> SearchResult:
    """Seeded random search; every trial is fitted and measured by Spark on one cached split.

    ``rungs`` are the shares of the training rows that trials are fitted on, one after another: from each
    rung the best ``keep`` of the trials go on to the next, and only trials of the last can be best.
    ``parallel`` trials run at a time; on a session with ``spark.scheduler.mode=FAIR`` they share the
    executors evenly. Which trials go on, and the result, do not depend on when they end: points are drawn
    beforehand, a rung is over when all its trials are, and equal metrics go by number of trial.
    ``early_stop`` also shows the held-out rows to learners that stop by them (``validationIndicatorCol``).
    """
    if direction not in ("minimize", "maximize"):
        raise ValueError("direction must be 'minimize' or 'maximize'")
    if not rungs or list(rungs) != sorted(rungs) or not 0 < rungs[0] or rungs[-1] != 1.0:
        raise ValueError("rungs must rise to 1.0")
    slim = df.select(key, label, features)
    train, test = (side.persist(StorageLevel.MEMORY_AND_DISK) for side in train_test(slim, key, holdout, seed))
    rng = random.Random(seed)
    drawn = [draw_params(space, rng) for _ in range(n_trials)]
    sign = 1 if direction == "minimize" else -1
    measured: dict[int, tuple[int, float]] = {}

    def fitted_on(share: float, trial: int) -> float:
        rows = train if share == 1.0 else train.where(hash_order(F.col(key), f"rung-{seed}") < int(share * HASH_TOP))
        point = {**(params or {}), **drawn[trial]}
        if early_stop:
            rows = rows.withColumn("__held", F.lit(False)).unionByName(test.withColumn("__held", F.lit(True)))
            point["validationIndicatorCol"] = "__held"
        model = fit_model(rows, kind, point, label, features, make=make)
        value = model.transform(test).agg(metric(F.col(label).cast("double"), prediction_column(kind)).alias("m")).first()["m"]
        return float(value) if value is not None else math.nan

    place = lambda t: (math.isnan(measured[t][1]), sign * measured[t][1], t)
    running = list(range(n_trials))
    session = df.sparkSession
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            for rung, share in enumerate(rungs):
                run = inheritable_thread_target(session)(lambda t, share=share: fitted_on(share, t))
                for t, value in zip(running, pool.map(run, running)):
                    measured[t] = (rung, value)
                running.sort(key=place)
                if rung + 1 < len(rungs):
                    running = sorted(running[: max(1, math.ceil(len(running) * keep))])
    finally:
        train.unpersist()
        test.unpersist()
    best = running[0]
    names = sorted(space)
    table = [(t, measured[t][0], measured[t][1], t == best, *[str(drawn[t][n]) for n in names]) for t in range(n_trials)]
    schema = "trial int, rung int, metric double, is_best boolean" + "".join(f", `{n}` string" for n in names)
    return SearchResult(session.createDataFrame(table, schema), drawn[best], measured[best][1])


@dataclass(frozen=True)
class Calibration:
    """A fitted map from a score to a probability."""

    method: str
    model: LogisticRegressionModel | ScoreCalibration
    score: str

    def transform(self, df: DataFrame, out: str = "calibrated") -> DataFrame:
        if self.method == "sigmoid":
            a, c = float(self.model.coefficients[0]), float(self.model.intercept)
            z = F.col(self.score).cast("double") * F.lit(a) + F.lit(c)
            return df.withColumn(out, 1 / (1 + F.exp(-z)))
        ready, value = self.model.stepped(df.withColumn("__p", F.col(self.score).cast("double")))
        return ready.withColumn(out, value).drop("__p")


def fit_calibration(df: DataFrame, score: str, label: str, method: str = "sigmoid") -> Calibration:
    """Calibrate a frozen model's score on held-out rows.

    ``sigmoid`` is Platt's method with its smoothed targets (N1+1)/(N1+2) and 1/(N0+2): each row
    counts for class 1 with its target as weight, and for class 0 with the rest.
    ``isotonic`` fits a non-decreasing function, range by range and up a tree: nothing ends on the driver
    but the steps it takes in the end.
    Both start from counts per distinct score.
    """
    s = F.col(score).cast("double")
    groups = df.groupBy(s.alias("__f")).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("p"),
        F.count_if(F.col(label) != 1).cast("double").alias("n"),
    )
    if method == "isotonic":
        stage = ScoreCalibration(method=method)
        all_ = F.col("p") + F.col("n")
        stage.table = isotonic_blocks(groups, "__f", F.col("p") / all_, all_)
        return Calibration(method, stage, score)
    if method != "sigmoid":
        raise ValueError("method must be 'sigmoid' or 'isotonic'")
    ones, zeros = groups.agg(F.sum("p"), F.sum("n")).first()
    high, low = (ones + 1) / (ones + 2), 1 / (zeros + 2)
    for_one = F.col("p") * F.lit(high) + F.col("n") * F.lit(low)
    for_zero = F.col("p") * F.lit(1 - high) + F.col("n") * F.lit(1 - low)
    sides = F.array(
        F.struct(F.lit(1.0).alias("y"), for_one.alias("w")), F.struct(F.lit(0.0).alias("y"), for_zero.alias("w"))
    )
    rows = VectorAssembler(inputCols=["__f"], outputCol="x").transform(groups.select("__f", F.inline(sides)))
    fitted = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=0.0, maxIter=200, tol=1e-10).fit(rows)
    return Calibration(method, fitted, score)


def permuted_columns(df: DataFrame, key: str, cols: Sequence[str], seed: int, prefix: str = "perm_", groups: int = 4) -> DataFrame:
    """Add to each row, per column, the value of another row: a seeded permutation of each column.

    Rows are numbered in a random order, and columns dealt to ``groups`` in turn. A row takes all values of
    group g (from 1) from the row that stands ``n * g div (groups + 1)`` places on, the last place being
    followed by the first. So a row sends one array a group and not one row a column, and every value is
    sent once.
    """
    tagged = df.withColumn("__h", hash_order(F.col(key), seed))
    parts = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-df.count() // BUCKET_ROWS)))
    b = RangeBuckets.uniform("__h", key, HASH_TOP, parts)
    # Read by both sides of the joins below; its file footers hold the number of rows.
    ranked = stored(rank_within(tagged, b, "__r").drop("__h"), "ranked")
    n = ranked.count()
    groups = max(1, min(groups, len(cols)))
    out = ranked
    for g in range(1, groups + 1):
        mine = list(cols[g - 1 :: groups])
        to = F.pmod(F.col("__r") - 1 - F.lit(n * g // (groups + 1)), F.lit(max(1, n))) + 1
        sent = ranked.select(to.alias("__to"), F.array(*[F.col(c).cast("double") for c in mine]).alias("__sent"))
        out = out.join(sent, F.col("__r") == F.col("__to")).drop("__to")
        out = out.withColumns({f"{prefix}{c}": F.col("__sent")[i] for i, c in enumerate(mine)}).drop("__sent")
    return out.drop("__r")


def feature_importance(
    model: Model,
    df: DataFrame,
    key: str,
    cols: Sequence[str],
    kind: str,
    metric: Metric = mean_squared_error,
    seed: int = 42,
    label: str = "target",
    features: str = "features",
) -> DataFrame:
    """How much the metric changes when one feature is permuted, and the model's own importance.

    ``cols`` are the numeric columns of the feature vector in its order. Every row is scored once
    as it is and once per feature, all in one job.
    """
    y = F.col(label).cast("double")
    wide = permuted_columns(df.select(key, label, *cols), key, cols, seed)
    plain = [F.col(c).cast("double") for c in cols]
    versions = [F.struct(F.lit("").alias("feature"), F.array(*plain).alias("__x"))] + [
        F.struct(
            F.lit(c).alias("feature"),
            F.array(*plain[:i], F.col(f"perm_{c}"), *plain[i + 1 :]).alias("__x"),
        )
        for i, c in enumerate(cols)
    ]
    scored = model.transform(
        wide.select(label, F.inline(F.array(*versions))).withColumn(features, array_to_vector("__x"))
    )
    measured = scored.groupBy("feature").agg(metric(y, prediction_column(kind)).alias("metric"))
    every = Window.partitionBy(F.lit(1))  # one row per feature
    measured = measured.withColumn("base", F.max(F.when(F.col("feature") == "", F.col("metric"))).over(every))
    own = getattr(model, "featureImportances", None)
    own_values = [float(v) for v in own.toArray()] if own is not None else [None] * len(cols)
    own_value = F.lit(None).cast("double")
    for c, v in zip(cols, own_values):
        own_value = F.when(F.col("feature") == c, F.lit(v)).otherwise(own_value)
    return measured.where(F.col("feature") != "").select(
        "feature",
        F.col("base").alias("metric_before"),
        F.col("metric").alias("metric_permuted"),
        (F.col("metric") - F.col("base")).alias("metric_change"),
        own_value.cast("double").alias("model_importance"),
    )
