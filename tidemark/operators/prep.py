"""Feature preparation: imputing, target encoding, scaling, variance filter, ML pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator, Transformer
from pyspark.ml.feature import (
    MinMaxScaler,
    SQLTransformer,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.stages import CategoryEncoder
from tidemark.session import stored

# Constants that stand for a missing value.
MISSING_CATEGORY = "missing"
MISSING_NUMBER = 0


def _filled_number(df: DataFrame, col: str, value: float) -> Column:
    c = F.col(col)
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = F.nanvl(c, F.lit(None))
    return F.coalesce(c, F.lit(value).cast(dtype))


def impute_constant(
    df: DataFrame,
    cats: Sequence[str] = (),
    nums: Sequence[str] = (),
    category: str = MISSING_CATEGORY,
    number: float = MISSING_NUMBER,
) -> DataFrame:
    """Fill missing categories and numbers with constants; NaN is missing too."""
    filled = {c: F.coalesce(F.col(c), F.lit(category)) for c in cats}
    filled |= {c: _filled_number(df, c, number) for c in nums}
    return df.withColumns(filled)


@dataclass(frozen=True)
class TargetEncoding:
    """Encoded value per (column, category), and the overall mean for unseen categories."""

    table: DataFrame  # col_name, category, encoded
    prior: float
    cols: tuple[str, ...]

    def transform(self, df: DataFrame, suffix: str = "_enc") -> DataFrame:
        """Add the encoded columns. Spark broadcasts each table if its size allows."""
        out = df
        for c in self.cols:
            side = self.table.where(F.col("col_name") == c).select(
                F.col("category").alias("__cat"), F.col("encoded").alias("__enc")
            )
            out = (
                out.join(side, out[c].cast("string").eqNullSafe(F.col("__cat")), "left")
                .withColumn(f"{c}{suffix}", F.coalesce("__enc", F.lit(self.prior)))
                .drop("__cat", "__enc")
            )
        return out


def fit_target_encoder(
    df: DataFrame,
    cols: Sequence[str],
    label: str,
    blend: str = "additive",
    smoothing: float = 1.0,
    min_samples: float = 1.0,
) -> TargetEncoding:
    """Mean label per category, blended with the overall mean by the category's row count n.

    ``additive`` weights the category n / (n + smoothing); ``sigmoid`` weights it
    1 / (1 + exp(-(n - min_samples) / smoothing)), and a category of one row gets the overall mean.

    All columns are counted in one pass. The table is written and read again, so Spark knows its size:
    a small one is broadcast and the rows stay where they are, a large one joins by shuffle.
    """
    prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("category")) for c in cols])
    stats = (
        df.select(F.col(label).cast("double").alias("__y"), F.inline(pairs))
        .groupBy("col_name", "category")
        .agg(F.count("__y").alias("n"), F.avg("__y").alias("mean"))
    )
    n = F.col("n")
    if blend == "additive":
        weight = n / (n + F.lit(float(smoothing)))
    elif blend == "sigmoid":
        logistic = 1 / (1 + F.exp(-(n - F.lit(float(min_samples))) / F.lit(float(smoothing))))
        weight = F.when(n == 1, 0.0).otherwise(logistic)
    else:
        raise ValueError("blend must be 'additive' or 'sigmoid'")
    encoded = stats.select(
        "col_name", "category", (weight * F.col("mean") + (1 - weight) * F.lit(prior)).alias("encoded")
    )
    return TargetEncoding(stored(encoded, "encoding"), prior, tuple(cols))


@dataclass(frozen=True)
class MinMaxScaling:
    bounds: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Map each column to [0, 1]; a constant column becomes 0."""
        scaled = {
            c: F.when(F.col(c).isNotNull(), F.lit(0.0))
            if low is None or low == high
            else (F.col(c).cast("double") - F.lit(low)) / F.lit(high - low)
            for c, (low, high) in self.bounds.items()
        }
        return df.withColumns(scaled)


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> MinMaxScaling:
    """Smallest and largest value of each column, in one pass; impute NaN first."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"l{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(c).cast("double")).alias(f"h{i}") for i, c in enumerate(cols)],
    ).first()
    return MinMaxScaling({c: (row[f"l{i}"], row[f"h{i}"]) for i, c in enumerate(cols)})


def column_variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population variance per column, one row per column."""
    row = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in cols])
    return row.unpivot([], list(cols), "column_name", "variance")


def fit_variance_filter(df: DataFrame, cols: Sequence[str], t: float = 0.0) -> list[str]:
    """Columns whose population variance exceeds ``t``."""
    kept = column_variances(df, cols).where(F.col("variance") > t).collect()
    names = {r["column_name"] for r in kept}
    return [c for c in cols if c in names]


def prep_stages(
    cats: Sequence[str],
    nums: Sequence[str],
    label: str,
    smoothing: float = 1.0,
    scale: bool = False,
    sample_variance: float | None = None,
    features: str = "features",
    extra: Sequence[Estimator | Transformer] = (),
) -> Pipeline:
    """Impute, encode and assemble columns in a fixed order, as a Spark ML pipeline.

    Categories are target-encoded with additive smoothing by a stage that keeps them in a table, everything else is cast to double.
    ``extra`` takes further Spark ML stages over ``features``.
    """
    # Inner columns are numbered: the given names may hold any characters.
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    fill = [f"coalesce(cast({quoted(c)} as string), '{MISSING_CATEGORY}') AS __c_{i}" for i, c in enumerate(cats)]
    fill += [f"coalesce(nanvl(cast({quoted(c)} as double), null), cast({MISSING_NUMBER} as double)) AS __n_{i}" for i, c in enumerate(nums)]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(fill)} FROM __THIS__")]
    if cats:
        stages.append(
            CategoryEncoder(
                inputCols=[f"__c_{i}" for i in range(len(cats))],
                outputCols=[f"__x_{i}" for i in range(len(cats))],
                labelCol=label,
                smoothing=smoothing,
            )
        )
    assembled = features if not scale and sample_variance is None and not extra else "__assembled"
    stages.append(
        VectorAssembler(inputCols=[f"__x_{i}" for i in range(len(cats))] + [f"__n_{i}" for i in range(len(nums))], outputCol=assembled)
    )
    last = assembled
    if scale:
        last = features if sample_variance is None and not extra else "__scaled"
        stages.append(MinMaxScaler(inputCol=assembled, outputCol=last))
    if sample_variance is not None:
        picked = features if not extra else "__picked"
        stages.append(VarianceThresholdSelector(featuresCol=last, outputCol=picked, varianceThreshold=sample_variance))
    stages.extend(extra)
    return Pipeline(stages=stages)


def fit_prep(
    df: DataFrame, cats: Sequence[str], nums: Sequence[str], label: str, t: float | None = None, **options
):
    """Fit :func:`prep_stages`. ``t`` is a population-variance threshold.

    Spark's selector uses sample variance, n/(n-1) times the population's, so the threshold is
    scaled by the same factor.
    """
    sample_t = None
    if t is not None:
        n = df.count()
        sample_t = t * n / max(n - 1, 1)
    return prep_stages(cats, nums, label, sample_variance=sample_t, **options).fit(df)
