"""Synthetic minority rows between nearest neighbours, with an exact distributed neighbour search.

The search partitions the rows into cells around pivots (rows drawn at random). Each row first looks
for neighbours in its own cell; the distance found bounds how far its true neighbours can lie, and
the triangle inequality rules out the cells that are farther away. The cells that are left are compared
with the row block by block: blocks of a cell's rows are written once and read against one another (a cartesian
product), so no row is copied from cell to cell, and a task holds some blocks of rows while the
candidates stream by. No cell, row or candidate is capped: at home, large cells are cut into chunks that are compared
chunk by chunk, each in a task of its own, and only the k best per row leave a task, as numbers. Vectors
of neighbours are joined at the end. What is shuffled and written grows with the rows; the comparisons
themselves grow with their square where the triangle inequality rules out little (many dimensions).

Of rows that are exact copies, k + 1 are enough as candidates (a row needs k others), so a vector
that fills a third of the table is kept k + 1 times on the candidate side.
"""

from __future__ import annotations

import math
import sys
from bisect import insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.functions.scalars import HASH_TOP, hash_order
from tidemark.operators.ranking import RangeBuckets, first_rows, rank_cuts
from tidemark.session import stored

CHUNK_ROWS = 2000
BLOCK_ROWS = 512
PARTS = 8  # of the candidates in the search beyond the own cell: each returns k rows at most for a row
SLACK = 1e-9  # keeps rounding from ruling out a cell at the very bound

# The small functions below travel to the Python workers whole, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy()).astype(float) if len(vectors) else np.empty((0, 0))


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt((gap * gap).sum(axis=1))


def _own_cell(pivots: np.ndarray):
    @pandas_udf("cell int, dist double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        x = _matrix(vectors)
        best = np.full(len(x), np.inf)
        cell = np.zeros(len(x), dtype=np.int32)
        for i, p in enumerate(pivots):
            d = _distances(x, p)
            closer = d < best
            best[closer], cell[closer] = d[closer], i
        return pd.DataFrame({"cell": cell, "dist": best})

    return nearest


def _blocks(pivots: np.ndarray) -> Callable:
    """Rows in order of their cell to blocks of one cell. ``far`` and ``reach`` are the largest distance from the pivot and bound."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        vectors, cell = rows["__vec"].combine_chunks(), rows["cell"][0].as_py()
        if len(pc.unique(pc.list_value_length(vectors))) > 1:
            raise ValueError("vectors differ in length")
        flat = vectors.flatten()
        kind = np.float32 if flat.type == pa.float32() else np.float64
        whole = lambda c: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows[c].combine_chunks())
        columns = {
            "cell": pa.array([cell], pa.int32()),
            "ids": whole("__id"),
            "refs": whole("__ref"),
            "vecs": pa.array([flat.to_numpy(zero_copy_only=False).astype(kind).tobytes()], pa.binary()),
            "single": pa.array([kind == np.float32]),
            "bounds": whole("__bound"),
            "far": pa.array([pc.max(rows["dist"]).as_py()], pa.float64()),
            "reach": pa.array([pc.max(rows["__bound"]).as_py()], pa.float64()),
            "centre": pa.array([pivots[cell].tolist()], pa.list_(pa.float64())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows]).combine_chunks()
            cells, at = rows["cell"].to_numpy(), 0
            for end in [*(np.flatnonzero(np.diff(cells)) + 1), len(cells)]:
                while end - at >= BLOCK_ROWS or at < end < len(cells):
                    size = min(BLOCK_ROWS, end - at)
                    yield block(rows.slice(at, size))
                    at += size
            held = rows.slice(at)
        if held is not None and len(held):
            yield block(held)

    return run


def _search(k: int, pivots: np.ndarray) -> Callable:
    """Pairs of blocks to the k best candidates of each row, of those within its bound."""

    def matrix(vecs: bytes, single: bool, n: int) -> np.ndarray:
        flat = np.frombuffer(vecs, np.float32 if single else np.float64).astype(float)
        return flat.reshape(n, len(flat) // n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, tuple] = {}
        read = kind = None
        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kind = c["ids"].type.value_type
            for at in range(batch.num_rows):
                number, cell = c["block"][at].as_py(), c["cell"][at].as_py()
                if number not in rows:
                    ids = c["ids"][at].as_py()
                    x = matrix(c["vecs"][at].as_py(), c["single"][at].as_py(), len(ids))
                    bounds = c["bounds"][at].values.to_numpy(zero_copy_only=False)
                    rows[number] = ids, x, (x * x).sum(axis=1), _distances(x, pivots[cell]), bounds.copy(), [[] for _ in ids]
                if read != c["c_block"][at].as_py():
                    read = c["c_block"][at].as_py()
                    others, refs, c_cell, far = c["c_ids"][at].as_py(), c["c_refs"][at].as_py(), c["c_cell"][at].as_py(), c["c_far"][at].as_py()
                    s = matrix(c["c_vecs"][at].as_py(), c["c_single"][at].as_py(), len(others))
                    ss = (s * s).sum(axis=1)
                    most = ss[np.isfinite(ss)].max(initial=0)
                ids, x, xx, d_own, bounds, best = rows[number]
                limit = bounds * (1 + SLACK) + SLACK
                d, between = _distances(x, pivots[c_cell]), _distances(pivots[cell][None], pivots[c_cell])[0]
                lower = d - far
                if between > 0:
                    lower = np.maximum(lower, (d * d - d_own * d_own) / (2 * between))
                near = np.flatnonzero(lower <= limit)
                if not len(near):
                    continue
                # Squared distances by one matrix product; those within the bound are computed exactly.
                rough = xx[near, None] + ss[None, :] - 2 * (x[near] @ s.T)
                i, j = np.nonzero((rough <= (limit[near] ** 2 + SLACK * (1 + xx[near] + most))[:, None]) & np.isfinite(rough))
                i = near[i]
                gap = s[j] - x[i]
                exact = np.sqrt((gap * gap).sum(axis=1))
                for row, other, dist in zip(i.tolist(), j.tolist(), exact.tolist()):
                    found, id = best[row], others[other]
                    if (id is not None and id == ids[row]) or dist > limit[row] or (len(found) == k and dist > found[-1][0]):
                        continue
                    insort(found, (dist, id is None, id, refs[other]), key=lambda f: f[:2] if f[1] else f[:3])
                    if len(found) > k:
                        found.pop()
                    if len(found) == k and found[-1][0] < bounds[row]:
                        bounds[row] = found[-1][0]
        for ids, *_, best in rows.values():
            out = [(ids[row], id, ref, dist) for row, found in enumerate(best) for dist, _, id, ref in found]
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], kind), pa.array(columns[1], kind), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.float64())],
                    names=["__id", "__nb", "__ref", "__d"],
                )

    return run


def _beyond(rows: DataFrame, candidates: DataFrame, pivots: np.ndarray, k: int, id_type: str) -> DataFrame:
    """The k best candidates of each row, part by part of the candidates, in the other cells that may hold one within its bound."""

    def blocks(of: DataFrame, name: str) -> DataFrame:
        ordered = of.select("cell", "__id", "__ref", "__vec", "dist", "__bound").repartitionByRange("cell", F.xxhash64("__ref")).sortWithinPartitions("cell")
        kinds = f"cell int, ids array<{id_type}>, refs array<bigint>, vecs binary, single boolean, bounds array<double>, far double, reach double, centre array<double>"
        return stored(ordered.mapInArrow(_blocks(pivots), kinds).withColumn("block", F.monotonically_increasing_id()), name)

    left = blocks(rows, "row-blocks").drop("refs")
    right = blocks(candidates.withColumn("__bound", F.lit(0.0)), "candidate-blocks").drop("bounds", "reach")
    right = right.select(*[F.col(c).alias(f"c_{c}") for c in right.columns])
    squares = F.zip_with("centre", "c_centre", lambda a, b: (a - b) * (a - b))
    between = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))
    reach = between - F.col("far") - F.col("c_far") <= F.col("reach") * (1 + SLACK) + SLACK
    pairs = right.coalesce(PARTS).join(left.hint("shuffle_replicate_nl"), (F.col("cell") != F.col("c_cell")) & reach)
    pairs = pairs.drop("centre", "c_centre", "far", "reach")
    return pairs.mapInArrow(_search(k, pivots), f"__id {id_type}, __nb {id_type}, __ref bigint, __d double")


def _best_in_chunk(k: int):
    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["__id", "__nb", "__ref", "__d"]
        if left.empty or right.empty:
            return pd.DataFrame({n: [] for n in names})
        x, s = _matrix(left["__vec"]), _matrix(right["__cvec"])
        ids, others, refs = left["__id"].to_numpy(), right["__cid"].to_numpy(), right["__cref"].to_numpy()
        found: list[tuple] = []
        xx, ss, kth = (x * x).sum(axis=1), (s * s).sum(axis=1), min(k, len(s)) - 1
        for at in range(0, len(x), BLOCK_ROWS):
            block, own = x[at : at + BLOCK_ROWS], ids[at : at + BLOCK_ROWS]
            # Squared distances of a block by one matrix product; those near the k-th are computed exactly.
            rough = xx[at : at + BLOCK_ROWS, None] + ss[None, :] - 2 * (block @ s.T)
            rough[own[:, None] == others[None, :]] = np.inf
            limit = np.partition(rough, kth, axis=1)[:, kth] + SLACK * (1 + xx[at : at + BLOCK_ROWS] + ss.max())
            for i, id in enumerate(own):
                near = np.flatnonzero((rough[i] <= limit[i]) & np.isfinite(rough[i]))
                d = _distances(s[near], block[i])
                for j in np.lexsort((others[near], d))[:k]:
                    found.append((id, others[near[j]], refs[near[j]], d[j]))
        return pd.DataFrame(found, columns=names)

    return best


def _visit(rows: DataFrame, candidates: DataFrame, k: int, id_type: str) -> DataFrame:
    """The k best candidates of each row within the row's cell, chunk by chunk."""
    visits = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("__rp"))
    stored = candidates.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("__sp"))
    # One row per cell: bounded by the number of pivots.
    parts = F.broadcast(visits.join(stored, "cell"))

    def chunk(n: Column) -> Column:
        return F.pmod(F.xxhash64("__id"), n)

    def copies(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))

    left = rows.join(parts, "cell").select("cell", "__id", "__vec", chunk(F.col("__rp")).alias("r"), copies(F.col("__sp")).alias("s"))
    # Both sides come from the same rows: new names keep their columns apart.
    right = candidates.join(parts, "cell").select(
        F.col("cell").alias("c_cell"),
        F.col("__id").alias("__cid"),
        F.col("__ref").alias("__cref"),
        F.col("__vec").alias("__cvec"),
        chunk(F.col("__sp")).alias("c_s"),
        copies(F.col("__rp")).alias("c_r"),
    )
    return left.groupBy("cell", "r", "s").cogroup(right.groupBy("c_cell", "c_r", "c_s")).applyInPandas(
        _best_in_chunk(k), f"__id {id_type}, __nb {id_type}, __ref bigint, __d double"
    )


def _closest(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("__id").orderBy("__d", "__nb")
    return found.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k)


def nearest_neighbours(df: DataFrame, key: str, features: str, k: int, seed: int = 42) -> DataFrame:
    """The ``k`` nearest other rows of every row by Euclidean distance, ties by key.

    Returns key, ``neighbour``, ``neighbour_features``, ``distance`` and ``n`` (1 = nearest).
    ``features`` is an array of numbers; the key must be unique. Rows without features have no
    neighbours and are none. Cells are as many as the square root of the rows, so finding a row's
    cell and searching it cost about the same at every size.
    """
    near, vectors = _near(df, key, features, k, seed)
    return near.join(vectors, "__ref").select(key, "neighbour", "neighbour_features", "distance", "n")


def _near(df: DataFrame, key: str, features: str, k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The neighbours with a number ``__ref`` in place of their features, and the features by that number."""
    id_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("__id"), F.col(features).cast(_kind(df, features)).alias("__vec")).where("__vec is not null")
    wanted = max(1, math.ceil(math.sqrt(rows.count())))

    def candidates_of(placed: DataFrame) -> DataFrame:
        copies = Window.partitionBy("__vec").orderBy("__id")
        ranked = placed.withColumn("__copy", F.row_number().over(copies))
        return ranked.where(F.col("__copy") <= k + 1).drop("__copy")

    tagged = rows.withColumn("__h", hash_order(F.col("__id"), seed))
    even = RangeBuckets.uniform("__h", "__id", HASH_TOP)
    drawn = first_rows(tagged, "__h", "__id", wanted, even).select("__vec").collect()
    pivots = np.unique(np.array([r[0] for r in drawn], dtype=float), axis=0)

    located = rows.withColumn("__c", _own_cell(pivots)("__vec")).select("__id", "__vec", "__c.cell", "__c.dist", F.monotonically_increasing_id().alias("__ref"))
    placed = stored(located, "cells")  # read by every step below
    candidates = candidates_of(placed)
    at_home = stored(_closest(_visit(placed, candidates, k, id_type), k).drop("__n"), "near")
    bound = at_home.groupBy("__id").agg(
        F.when(F.count(F.lit(1)) == k, F.max("__d")).otherwise(F.lit(math.inf)).alias("__bound")
    )
    bounded = placed.join(bound, "__id", "left").withColumn("__bound", F.coalesce("__bound", F.lit(math.inf)))
    found = at_home.unionByName(_beyond(bounded, candidates, pivots, k, id_type))
    near = _closest(found, k).select(F.col("__id").alias(key), F.col("__nb").alias("neighbour"), "__ref", F.col("__d").alias("distance"), F.col("__n").alias("n"))
    return near, placed.select("__ref", F.col("__vec").cast("array<double>").alias("neighbour_features"))


def _kind(df: DataFrame, features: str) -> str:
    """Vectors stay single where they are: half the bytes, and the same numbers as doubles."""
    return "array<float>" if df.schema[features].dataType.simpleString() == "array<float>" else "array<double>"


def smote_rows(df: DataFrame, key: str, features: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows that bring the smaller of two classes to the size of the larger.

    Each lies between a minority row (``base``) and one of its k nearest minority rows
    (``neighbour``), at the share ``gap`` of the way. Every minority row is a base equally often, up
    to one; neighbour and gap are drawn by a seeded hash of the base and the row's number.
    """
    sizes = {r[label]: r["count"] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if len(sizes) != 2:
        raise ValueError(f"{label} must have two classes, found {sorted(sizes)}")
    minority = min(sorted(sizes), key=lambda v: sizes[v])
    small, large = sizes[minority], max(sizes.values())
    if small < 2:
        raise ValueError("the smaller class needs at least two rows")
    each, rest = divmod(large - small, small)
    rows = df.where(F.col(label) == F.lit(minority)).select(key, features)
    near, vectors = _near(rows, key, features, min(k, small - 1), seed)
    tagged = rows.withColumn("__h", hash_order(F.col(key), f"{seed}:base"))
    extra = F.lit(0)
    if rest:
        cuts = rank_cuts(tagged, "__h", key, lambda n: [rest], RangeBuckets.uniform("__h", key, HASH_TOP))
        extra = cuts.upto(tagged, rest).cast("int")
    bases = (
        tagged.withColumn("__copies", F.lit(each) + extra)
        .where(F.col("__copies") > 0)
        .select(key, F.col(features).cast("array<double>").alias("__base"), F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__i"))
    )
    draw = F.concat_ws(":", F.col(key).cast("string"), F.col("__i").cast("string"))
    bases = bases.withColumns(
        {
            "n": (F.pmod(hash_order(draw, f"{seed}:neighbour"), F.lit(min(k, small - 1))) + 1).cast("int"),
            "gap": hash_order(draw, f"{seed}:gap") / F.lit(float(HASH_TOP)),
        }
    )
    joined = bases.join(near.select(key, "n", "neighbour", "__ref"), [key, "n"]).join(vectors, "__ref")
    gap = F.col("gap")
    point = F.zip_with("__base", "neighbour_features", lambda a, b: a + gap * (b - a))
    return joined.select(
        F.col(key).alias("base"), "neighbour", "gap", point.alias(features), F.lit(minority).alias(label)
    )


def smote(df: DataFrame, key: str, features: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """The rows of ``df`` and the synthetic ones; those have no key."""
    real = df.select(key, F.col(features).cast("array<double>").alias(features), label, F.lit(False).alias("synthetic"))
    made = smote_rows(df, key, features, label, k, seed)
    kind = df.schema[key].dataType
    return real.unionByName(
        made.select(F.lit(None).cast(kind).alias(key), features, label, F.lit(True).alias("synthetic"))
    )


__all__: Sequence[str] = ("nearest_neighbours", "smote", "smote_rows")
