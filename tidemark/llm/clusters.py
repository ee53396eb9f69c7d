"""Centroid clustering in exact integers; nearest centroids by the threshold algorithm.

Components become integers, floor(256 * x). Centroids start as the vectors whose ids hash least. Each
round assigns every vector to its nearest centroid (squared Euclidean distance, ties to the smaller
number) and moves each centroid to the floor of its vectors' mean; a centroid without vectors stays.
Then all vectors are assigned once more.

Nearest centroids: in every dimension the centroids are listed in the order of their value. From a
vector's own value each list is walked outward, on all lists one step at a time, to the side that is
nearer. A centroid that a walk meets for the first time gets its exact distance. Centroids not met so
far differ from the vector, in every dimension, by at least that list's last gap; once the sum of the
squared gaps is strictly above the best exact distance, none of them can be nearer or as near, and the
vector is done.

Tasks send sums by centroid and dimension, summed up again before the shuffle; the driver gets k rows of
them, never vectors. The integers are written once and read in each round.

Only vectors of exactly ``dims`` components, none null, NaN or infinite, are kept; others are not in
the result. Each row is a vector of its own, with repeated ids too (equal hashes are ordered by vector);
a null id counts as the text ``null``. With fewer than k vectors there are as many centroids as vectors. A
component beyond 2 ** 27 after scaling is an error, since distances would not fit 64 bits. Other columns
are ignored, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
LARGEST = 1 << 27
FAR = 1 << 62
VECTORS = 512  # that are walked at a time


class Lists:
    """The centroids, and for every dimension their values in order with their numbers."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.numbers = np.argsort(centroids, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(centroids.T, self.numbers, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row of ``x`` the number of the nearest centroid and the squared distance; and how
        many exact distances that took."""
        (size, dims), k = x.shape, len(self.centroids)
        best, who = np.full(size, FAR), np.full(size, k)
        met, counted = np.zeros((size, k), bool), 0
        right = np.stack([np.searchsorted(self.values[d], x[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        every, at = np.arange(dims), np.arange(size)
        while len(at):
            # One step outward on every list, to the nearer side.
            l, r, v = left[at], right[at], x[at]
            below = np.where(l >= 0, v - self.values[every, np.maximum(l, 0)], FAR)
            above = np.where(r < k, self.values[every, np.minimum(r, k - 1)] - v, FAR)
            down = below <= above
            step = self.numbers[every, np.where(down, l, r)]
            gap = np.where(down, below, above)
            left[at], right[at] = l - down, r + ~down
            # Exact distances of centroids met for the first time.
            new = np.zeros((len(at), k), bool)
            new[np.arange(len(at))[:, None], step] = True
            new &= ~met[at]
            met[at] |= new
            row, number = np.nonzero(new)
            counted += len(row)
            exact = np.full((len(at), k), FAR)
            exact[row, number] = np.square(v[row] - self.centroids[number]).sum(axis=1)
            first = exact.argmin(axis=1)
            least = exact[np.arange(len(at)), first]
            closer = (least < best[at]) | ((least == best[at]) & (first < who[at]))
            best[at], who[at] = np.where(closer, least, best[at]), np.where(closer, first, who[at])
            at = at[~((np.square(gap).sum(axis=1) > best[at]) | met[at].all(axis=1))]
        return who, best, counted


def _blocks(lists: Lists, batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple]:
    for batch in batches:
        flat = batch.column(column).flatten().to_numpy().astype(np.int64)
        x = flat.reshape(batch.num_rows, -1)
        for low in range(0, len(x), VECTORS):
            part = x[low : low + VECTORS]
            who, best, _ = lists.nearest(part)
            yield batch, low, part, who, best


def _sums(lists: Lists) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = lists.centroids.shape
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, _, x, who, _ in _blocks(lists, batches, 0):
            np.add.at(total, who, x)
            n += np.bincount(who, minlength=k)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(n[held], pa.int64()), pa.array(list(total[held]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    return run


def _assigned(lists: Lists) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, low, x, who, best in _blocks(lists, batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(x)), pa.array(who, pa.int32()), pa.array(best, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def whole_numbers(rows: DataFrame, id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): the kept vectors in integers."""
    x = F.col(f"`{vector}`")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = lambda c: c.cast("double") * scale
    far = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("int")
    ints = F.transform(x, lambda c: F.when(F.abs(scaled(c)) <= LARGEST, F.floor(scaled(c)).cast("int")).otherwise(far))
    return rows.filter((F.size(x) == dims) & usable).select(F.col(f"`{id}`").cast("long").alias("vec_id"), ints.alias("v"))


def clusters(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256 (of the centroid's components, comma-joined)."""
    spark = rows.sparkSession
    kept = stored(whole_numbers(rows, id, vector, dims, scale), "vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = kept.select(hashed.alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["v"] for r in first], np.int64)
    for _ in range(rounds):
        sums = kept.select("v").mapInArrow(_sums(Lists(centroids)), "cluster int, n long, total array<long>")
        sums = sums.select("cluster", "n", F.posexplode("total").alias("dim", "total"))
        # Exact beyond 64 bits; k * dims rows.
        sums = sums.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        for r in sums.collect():
            centroids[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    found = stored(kept.mapInArrow(_assigned(Lists(centroids)), "vec_id long, cluster int, distance long"), "assigned")
    of = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by_number = lambda values: F.get(F.array(*(F.lit(v) for v in values)), F.col("cluster"))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        by_number([of.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(of.values())).cast("long").alias("inertia"),
        by_number(digests).alias("centroid_sha256"),
    )


def op13_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return clusters(spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = {"op13_centroids": op13_centroids}


def _round(k: int) -> str:
    square = "(kept.v[i] - c.v[i]) * (kept.v[i] - c.v[i])"
    return f"""
a{k} as materialized (
  select vec_id, arg_min(c, struct_pack(d := d, c := c)) as c, min(d) as d
  from (select kept.vec_id, c.c, cast(list_sum(list_transform(range(1, {DIMS + 1}), lambda i: {square})) as bigint) as d from kept, c{k} c) group by vec_id
), c{k + 1} as materialized (
  select c.c, coalesce(m.v, c.v) as v from c{k} c left join (
    select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by dim) as v from (
      select c, dim, sum(kept.v[dim]) as s, count(*) as n from a{k} a join kept on kept.vec_id = a.vec_id, range(1, {DIMS + 1}) r(dim) group by c, dim
    ) group by c
  ) m on m.c = c.c
)"""


ORACLE_SQL = {
    "op13_centroids": f"""
with kept as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings
  where len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMS}
), c0 as materialized (
  select row_number() over (order by h) - 1 as c, v from (select sha256('{SEED}:' || vec_id) as h, v from kept) order by h limit {CENTROIDS}
),{",".join(_round(k) for k in range(ROUNDS + 1))}
select a.vec_id, cast(a.c as integer) as cluster, a.d as distance, cast(sum(a.d) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(a.d) over () as bigint) as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} c on c.c = a.c
"""
}
