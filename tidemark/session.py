"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Of the open work scopes, the innermost last: paths written and tables kept since it began.
_scopes: list[tuple[list[str], list[DataFrame]]] = []


def local_session(cores: int | str = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Saves a stack walk per column expression in long feature lists.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Only a local session without one gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; the innermost work scope removes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1][0].append(path)
    return path


def kept(df: DataFrame) -> DataFrame:
    """A persisted table, released by the innermost work scope."""
    if _scopes:
        _scopes[-1][1].append(df)
    return df


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end and also after an error, all that :func:`stored` has written inside and releases
    what was :func:`kept`. Results that are read after the scope must have been written elsewhere before.
    """
    scope: tuple[list[str], list[DataFrame]] = ([], [])
    _scopes.append(scope)
    try:
        yield
    finally:
        _scopes.remove(scope)
        paths, tables = scope
        for df in tables:
            df.unpersist()
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: what follows neither computes ``df`` again nor depends on the executors that
    did, and Spark knows its size.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
