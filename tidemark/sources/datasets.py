"""Reading and writing stage datasets: parquet snapshots, SQL text, positional appends."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from tidemark.session import kept

MONTH_COLUMN = "run_month"
RUN_COLUMN = "append_run"
POLICIES = ("always", "while_execution", "never")


def read_dataset(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """Parquet scan; with ``month`` only that partition of a snapshot is listed and read."""
    df = spark.read.parquet(path)
    if month is None:
        return df
    return df.where(F.col(MONTH_COLUMN) == month).drop(MONTH_COLUMN)


def run_query(
    spark: SparkSession,
    sql: str,
    args: Mapping[str, Any] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """SQL text with named parameters (``:name``) bound as literals.

    ``tables`` are referred to in the text as ``{name}``, without registering views.
    """
    return spark.sql(sql, args=dict(args or {}), **dict(tables or {}))


def write_snapshot(df: DataFrame, path: str, month: str) -> None:
    """Overwrite one month of a stage dataset and leave the other months alone."""
    (
        df.withColumn(MONTH_COLUMN, F.lit(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH_COLUMN)
        .parquet(path)
    )


def _has_month(spark: SparkSession, path: str, month: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MONTH_COLUMN}={month}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Dynamic overwrite moves a finished partition into place, so a folder is a whole month.
    return fs.exists(folder)


def materialize(
    build: Callable[[], DataFrame],
    spark: SparkSession,
    path: str,
    month: str,
    policy: str = "always",
) -> DataFrame:
    """Build a stage dataset, or reuse the one stored for the month.

    ``always``: read the month if it is stored, else build, write and read it back.
    ``while_execution``: keep it until the work scope ends (without one, the caller unpersists it).
    ``never``: build only.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if policy == "never":
        return build()
    if policy == "while_execution":
        return kept(build().persist(StorageLevel.MEMORY_AND_DISK))
    if not _has_month(spark, path, month):
        built = build()
        write_snapshot(built, path, month)
        # An empty result writes no partition folder; there is nothing to read back.
        if not _has_month(spark, path, month):
            return built
    return read_dataset(spark, path, month)


def append_rows(df: DataFrame, target: str, columns: Sequence[str], fmt: str = "parquet") -> None:
    """Append ``columns``, in this order, to a dataset; the order is the load contract.

    ``csv`` writes no header: the reader must pass the same order back to :func:`read_rows`.
    ``table`` appends by position to a catalog table.
    """
    rows = df.select(*columns)
    if fmt == "table":
        rows.write.insertInto(target)
    elif fmt == "csv":
        rows.write.mode("append").option("header", False).csv(target)
    else:
        rows.write.mode("append").format(fmt).save(target)


def append_run(df: DataFrame, target: str, columns: Sequence[str], run: str) -> None:
    """Append ``columns`` as the rows of ``run``, in a partition of its own.

    A run that is appended again replaces its rows, so a job that is tried again does not double them;
    rows of other runs are not touched.
    """
    rows = df.select(*columns).withColumn(RUN_COLUMN, F.lit(run))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_COLUMN).parquet(target)


def read_rows(spark: SparkSession, target: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Read appended rows back with a declared schema."""
    if fmt == "table":
        return spark.table(target).select(*schema.fieldNames())
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", False).option("mode", "FAILFAST")
    return reader.format(fmt).load(target)
