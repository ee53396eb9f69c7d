"""All-relevant feature selection: features against shuffled copies of themselves."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.operators.training import permuted_columns


def _tail(hits: int, rounds: int, upper: bool) -> float:
    """P(X >= hits), or P(X <= hits), for X ~ Binomial(rounds, 1/2)."""
    span = range(hits, rounds + 1) if upper else range(hits + 1)
    return sum(math.comb(rounds, k) for k in span) / 2**rounds


def _step_up(ps: Sequence[float], alpha: float) -> list[bool]:
    """Benjamini-Hochberg: which p-values pass at false-discovery rate alpha."""
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    last = max((r for r, i in enumerate(order, 1) if ps[i] <= alpha * r / len(ps)), default=0)
    passed = set(order[:last])
    return [i in passed for i in range(len(ps))]


def shadow_selection(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    perc: float = 100,
    alpha: float = 0.05,
    rounds: int = 100,
    seed: int = 42,
    trees: int = 100,
    max_depth: int = 5,
) -> DataFrame:
    """``(feature, hits, rounds, decision)`` with decision confirmed, rejected or tentative.

    Each round shuffles a copy of every remaining feature, fits a forest on features and copies, and
    gives a hit to the features whose importance exceeds the ``perc`` percentile of the copies'.
    A binomial test on the hits, corrected across features and across rounds, decides. Only the
    importances, one number per column, come to the driver.
    """
    hits = dict.fromkeys(features, 0)
    seen = dict.fromkeys(features, 0)
    decision = dict.fromkeys(features, "tentative")
    base = df.select(key, F.col(label).cast("double").alias(label), *[F.col(c).cast("double").alias(c) for c in features])
    for i in range(1, rounds + 1):
        live = [f for f in features if decision[f] != "rejected"]
        if not any(decision[f] == "tentative" for f in live):
            break
        both = permuted_columns(base.select(key, label, *live), key, live, seed * 1000 + i, "shadow_")
        inputs = live + [f"shadow_{f}" for f in live]
        data = VectorAssembler(inputCols=inputs, outputCol="__x").transform(both).select(label, "__x")
        data = data.persist(StorageLevel.MEMORY_AND_DISK)  # the forest reads its input several times
        try:
            forest = RandomForestClassifier(
                featuresCol="__x", labelCol=label, numTrees=trees, maxDepth=max_depth, seed=seed + i
            ).fit(data)
        finally:
            data.unpersist()
        importance = forest.featureImportances.toArray()
        bar = float(np.percentile(importance[len(live) :], perc))
        for f, value in zip(live, importance):
            seen[f] = i
            hits[f] += int(value > bar)
        open_ = [f for f in live if decision[f] == "tentative"]
        up = [_tail(hits[f], i, True) for f in open_]
        down = [_tail(hits[f], i, False) for f in open_]
        up_ok, down_ok = _step_up(up, alpha), _step_up(down, alpha)
        for f, p_up, p_down, ok_up, ok_down in zip(open_, up, down, up_ok, down_ok):
            if ok_up and p_up <= alpha / i:
                decision[f] = "confirmed"
            elif ok_down and p_down <= alpha / i:
                decision[f] = "rejected"
    rows = [(f, hits[f], seen[f], decision[f]) for f in features]
    return df.sparkSession.createDataFrame(rows, "feature string, hits int, rounds int, decision string")
