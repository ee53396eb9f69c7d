"""Training, scoring and evaluation sets; samples, splits and profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import HASH_TOP, hash_order
from tidemark.operators.audience import drop_columns
from tidemark.operators.ranking import RangeBuckets, first_rows, rank_cuts

_HASH = "__hash"


def _even(key: str) -> RangeBuckets:
    """Buckets of a hash: it spreads evenly, so no sketch is needed."""
    return RangeBuckets.uniform(_HASH, key, HASH_TOP)


def _zero_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, F.coalesce(target, F.lit(0)))


def training_set(
    pub: DataFrame, feats: DataFrame, target: DataFrame, key: str, label: str = "target", drop: Sequence[str] = ()
) -> DataFrame:
    """Audience with features and target; a customer without a target has 0."""
    kept = drop_columns(feats, drop)
    return _zero_target(pub.join(kept, key, "left").join(target.select(key, label), key, "left"), label)


def scoring_set(pub: DataFrame, feats: DataFrame, key: str, drop: Sequence[str] = ()) -> DataFrame:
    """Audience with features."""
    return pub.join(drop_columns(feats, drop), key, "left")


def evaluation_set(pub: DataFrame, target: DataFrame, key: str, label: str = "target") -> DataFrame:
    """Audience with the target that came true."""
    return _zero_target(pub.join(target.select(key, label), key, "left"), label)


def join_scores_labels(labels: DataFrame, scores: DataFrame, key: str, label: str = "target") -> DataFrame:
    """Customers that have both a label and a score."""
    return _zero_target(labels.join(scores, key, "inner"), label)


def sample_n(df: DataFrame, key: str, n: int | None, seed: int) -> DataFrame:
    """``n`` rows at random, the same ones for the same seed; all rows for ``None``."""
    if n is None:
        return df
    tagged = df.withColumn(_HASH, hash_order(F.col(key), seed))
    return first_rows(tagged, _HASH, key, n, _even(key)).drop(_HASH)


def split(df: DataFrame, key: str, p: float, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Mark exactly ``ceil(n * p)`` random rows as test rows."""
    tagged = df.withColumn(_HASH, hash_order(F.col(key), seed))
    size = 0

    def test_size(n: int) -> list[int]:
        nonlocal size
        size = math.ceil(n * p)
        return [size]

    cuts = rank_cuts(tagged, _HASH, key, test_size, _even(key))
    return tagged.withColumn(out, cuts.upto(tagged, size)).drop(_HASH)


def train_test(df: DataFrame, key: str, p: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The two sides of :func:`split`."""
    marked = split(df, key, p, seed, "__test")
    return (marked.where(~F.col("__test")).drop("__test"), marked.where("__test").drop("__test"))


def undersample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """As many random rows of every class as the smallest class has."""
    tagged = df.withColumn(_HASH, hash_order(F.col(key), seed))
    sizes = {r[label]: r["count"] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    keep: Column = F.lit(False)
    smallest = min(sizes.values(), default=0)
    for value, size in sorted(sizes.items()):
        member = F.col(label) == F.lit(value)
        if size > smallest:
            cuts = rank_cuts(tagged.where(member), _HASH, key, lambda n: [smallest], _even(key))
            member = member & cuts.upto(tagged, smallest)
        keep = keep | member
    return tagged.where(keep).drop(_HASH)


def profile(df: DataFrame, label: str, stage: str) -> DataFrame:
    """Rows, columns, share of class 1 and column names, as ``(stage, key, value)`` rows."""
    features = [c for c in df.columns if c != label]
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.when(F.col(label) == 1, 1.0).otherwise(0.0)).alias("share"),
    )
    pairs = [
        ("rows", F.col("rows").cast("string")),
        ("columns", F.lit(str(len(features)))),
        ("class_proportion", F.format_string("%.6f", "share")),
        ("var_names", F.lit(",".join(features))),
    ]
    cells = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])
    return facts.select(F.lit(stage).alias("stage"), F.inline(cells))


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column, one row per column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "nulls")
