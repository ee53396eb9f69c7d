"""Exact global order without a global sort.

Deciles, seeded samples, splits and ROC sums all need a row's place in the order of the whole
dataset. A window without PARTITION BY would send every row to one task. Here the rows are counted,
a seeded sample of (score, key) rows gives range splits in the columns' own types, and a search among the
splits turns each row into a bucket number that grows with the order; exact per-bucket counts do
the rest. The splits only balance the work: any splits give the same ranks.

* :func:`rank_cuts` finds the rows at given ranks. Only the few buckets that hold those ranks
  are sorted; nothing else is shuffled. Bins, samples and splits are then plain comparisons
  with those rows, inside the scan stage.
* :func:`global_rank` numbers all rows: one shuffle on the bucket.

There are as many buckets as the rows need, and a bucket that came out too full is split again. Ties are
broken by a unique key. Splits are rows and not scores, so one score may hold any share of the rows, of
whatever type score and key are. Rows whose score is NULL or NaN have no rank.

Two rows with the same score and key have no order: numbering raises where it meets them, bins and cuts
where any of the sorted buckets holds them, which is always so where they would change the result.

The input must give the same rows each time it is computed; write it out first if it does not.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUT_BUCKETS = 512  # buckets of one pass when only a few ranks are asked for
CUT_ROWS = 1_000_000  # a bucket with more rows is cut again before it is sorted
BUCKET_ROWS = 250_000  # rows of a bucket that are aimed at when all rows are numbered
LEAST_BUCKETS = 16
MOST_BUCKETS = 16_384  # splits are literals of the plan; beyond this, buckets grow
SAMPLE = 32  # sampled rows per split: a bucket is within a fifth of its size, two times out of three
SPREAD = 64  # parts for rows that have no place, or need none


def _type(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def present(df: DataFrame, col: str) -> Column:
    """The column with NaN read as NULL."""
    c = F.col(col)
    return F.nanvl(c, F.lit(None)) if isinstance(_type(df, col), (T.FloatType, T.DoubleType)) else c


def _portable(df: DataFrame, col: str) -> Column:
    """The column in a form that the driver hands back unchanged, whatever its time zone."""
    dtype = _type(df, col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    return F.col(col).cast("string") if isinstance(dtype, T.TimestampNTZType) else F.col(col)


def _literal(value: Any, dtype: T.DataType) -> str:
    """A value read from a :func:`_portable` column, as SQL of the column's type."""
    if isinstance(dtype, T.TimestampType):
        return f"timestamp_micros({value})"
    if isinstance(value, str):
        text = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    elif isinstance(value, float):
        text = f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
    elif isinstance(value, (int, Decimal)):
        text = str(value)
    else:
        text = f"'{value}'"
    return f"CAST({text} AS {dtype.simpleString()})"


def _plain(df: DataFrame, col: str) -> Column:
    """The column as a number, text or truth value that compares as the column does, in any time zone."""
    dtype, c = _type(df, col), F.col(col)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        # Micros of the wall clock itself: no time zone has a say in the order.
        clock = F.hour(c) * F.lit(3600) + F.minute(c) * F.lit(60) + F.extract(F.lit("SECOND"), c)
        return F.unix_date(c.cast("date")).cast("bigint") * F.lit(86_400_000_000) + (clock * 1_000_000).cast("bigint")
    return F.hex(c) if isinstance(dtype, T.BinaryType) else c


def _row(df: DataFrame, cols: Sequence[str]) -> Column:
    """The columns as one value that compares as the rows are ordered; the first one's NaN is NULL."""
    held = lambda i, c: F.when((F.col(c) if i else present(df, c)).isNotNull(), _plain(df, c))
    return F.struct(*[held(i, c).alias(f"c{i}") for i, c in enumerate(cols)])


def _constant(values: Sequence, kind: T.DataType) -> Column:
    """A constant array; as one piece of text, which is planned faster than thousands of literals."""
    text = json.dumps(values, default=str)
    return F.from_json(F.lit(text), T.ArrayType(kind), {"mode": "FAILFAST"})


def _rows_of(points: Sequence[tuple]) -> list[dict]:
    return [{f"c{i}": v for i, v in enumerate(p)} for p in points]


def count_reached(df: DataFrame, cols: Sequence[str], points: Sequence[tuple], out: str, strict: bool = False) -> DataFrame:
    """Add the number of ``points`` at or below each row (with ``strict``: below it).

    The points, in order and in the form of :func:`_plain`, are one constant array; a chain of columns
    halves the range that is left, so a row takes as many comparisons as the count has bits.
    """
    work = df.withColumn("__row", _row(df, cols)).withColumn(out, F.lit(0))
    array = _constant(_rows_of(points), work.schema["__row"].dataType)
    for bit in reversed(range(len(points).bit_length())):
        at = F.get(array, F.col(out) + (2**bit - 1))
        reached = at < F.col("__row") if strict else at <= F.col("__row")
        work = work.withColumn(out, F.col(out) + F.when(reached, 2**bit).otherwise(0))
    # A filter on the number must not be moved below the chain, where each link would be written out
    # twice for every one above it: the term that adds nothing keeps it here.
    return work.withColumn(out, F.col(out) + F.spark_partition_id() * 0).drop("__row")


def _sampled(df: DataFrame, cols: Sequence[str], share: float, most: int) -> list[tuple]:
    """About ``share`` of the rows, in order and in the form of :func:`_plain`, chosen by their hash."""
    inside = df.select(*dict.fromkeys(cols))
    if share < 1:
        inside = inside.where(F.pmod(F.xxhash64(*dict.fromkeys(cols)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    found = inside.select(_row(df, cols).alias("at")).distinct().limit(most + 1).agg(F.sort_array(F.collect_list("at")).alias("rows")).first()["rows"]
    if len(found) > most:
        raise RuntimeError(f"a sample of {cols} holds more than {most} rows")
    return [tuple(r) for r in found]


@dataclass(frozen=True)
class RangeBuckets:
    """Range splits of a dataset, held as literals: rows from one point on and before the next are a bucket."""

    n: int  # rows that have a score
    score: str
    key: str | None
    points: tuple[tuple[Any, ...], ...]  # of (score, key) or (score,), ascending
    sizes: tuple[int, ...] = ()  # rows of the buckets, once counted

    @staticmethod
    def fit(df: DataFrame, score: str, key: str | None = None, buckets: int | None = None) -> "RangeBuckets":
        """Two passes over the columns: the number of rows, and a sample of them.

        Without a key the splits balance the distinct scores. The driver gets some SAMPLE rows a bucket.
        """
        cols = [score] if key is None else [score, key]
        slim = df.select(*dict.fromkeys(cols)).where(present(df, score).isNotNull())
        rows, values = slim.agg(F.count(F.lit(1)), F.approx_count_distinct(present(df, score)) if key is None else F.lit(0)).first()
        spread = values if key is None else rows
        parts = buckets or min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-spread // BUCKET_ROWS)))
        wanted = SAMPLE * parts
        found = _sampled(slim, cols, wanted / max(1, spread), 4 * wanted + 100)
        return RangeBuckets(rows, score, key, _even(found, parts))

    @staticmethod
    def uniform(score: str, key: str, top: int, parts: int = CUT_BUCKETS) -> "RangeBuckets":
        """Splits of a whole-numbered score known to be spread evenly over 0..top, such as a hash: no pass needed."""
        return RangeBuckets(0, score, key, tuple((top * i // parts, None) for i in range(1, parts)))

    def counted(self, df: DataFrame) -> "RangeBuckets":
        """With the sizes of the buckets; a bucket of over four times BUCKET_ROWS is split again first."""
        slim = df.select(*dict.fromkeys((self.score, self.key)))
        now, most = self, 4 * BUCKET_ROWS
        while True:
            found = {r["__bucket"]: r["count"] for r in now.assign(slim).groupBy("__bucket").count().collect()}
            sizes = tuple(found.get(i, 0) for i in range(len(now.points) + 1))
            full = [i for i, size in enumerate(sizes) if size > most]
            room = MOST_BUCKETS - len(sizes)
            now = replace(now, n=sum(sizes), sizes=sizes)
            if not full or room <= 0:
                return now
            rows = sum(sizes[i] for i in full)
            parts = min(room, -(-rows // BUCKET_ROWS))
            inside = now.assign(slim).where(F.col("__bucket").isin(full)).drop("__bucket")
            more = _sampled(inside, [self.score, self.key], SAMPLE * parts / rows, 4 * SAMPLE * parts + 100)
            points = now.merged(inside, _even(more, parts))
            if len(points) == len(now.points):
                return now  # nothing but equal rows: numbering them will say so
            now = replace(now, points=points)

    def merged(self, df: DataFrame, more: Sequence[tuple]) -> tuple[tuple, ...]:
        """The points and more of them, in order (which only Spark knows for every type)."""
        every = list(dict.fromkeys([*self.points, *more]))
        kind = df.select(_row(df, [self.score, self.key]).alias("at")).schema["at"].dataType
        pairs = _constant([{"at": a, "i": i} for i, a in enumerate(_rows_of(every))], T.StructType([T.StructField("at", kind), T.StructField("i", T.IntegerType())]))
        order = df.sparkSession.range(1).select(F.sort_array(pairs)["i"].alias("i")).first()["i"]
        return tuple(every[i] for i in order)

    @property
    def heavy(self) -> tuple[Any, ...]:
        """Scores that fill a bucket, or share it with the next."""
        scores = [p[0] for p in self.points]
        return tuple(dict.fromkeys(a for a, b in zip(scores, scores[1:]) if a == b))

    def assign(self, df: DataFrame, out: str = "__bucket") -> DataFrame:
        """Add the bucket number; it is negative, and spread, where there is no score."""
        cols = [self.score] if self.key is None else [self.score, self.key]
        spread = F.pmod(F.xxhash64(cols[-1]), F.lit(SPREAD)).cast("int")
        placed = count_reached(df, cols, self.points, out)
        return placed.withColumn(out, F.when(present(df, self.score).isNull(), -1 - spread).otherwise(F.col(out)).cast("bigint"))

    def before(self) -> list[int]:
        """Rows before each bucket."""
        return [0, *_running(self.sizes)][: len(self.sizes)]


def _running(sizes: Sequence[int]) -> list[int]:
    out, total = [], 0
    for size in sizes:
        total += size
        out.append(total)
    return out


def _even(found: Sequence[tuple], parts: int) -> tuple[tuple, ...]:
    """``parts`` - 1 of the rows found, at even distances."""
    at = sorted({i * len(found) // parts for i in range(1, parts)}) if found else []
    return tuple(dict.fromkeys(found[i] for i in at))


def _looked_up(values: Sequence[int], at: Column) -> Column:
    """The value at a bucket's number, from a constant array; NULL for negative numbers."""
    return F.get(_constant(list(values), T.LongType()), at.cast("int"))


@dataclass(frozen=True)
class RankCuts:
    """Rows found at given ranks: ``rows[rank] = (score, key)``, in :func:`_portable` form; ``plain`` has them in :func:`_plain` form.

    Comparisons are built as SQL text: a chain of them is one expression to hand over, not hundreds.
    """

    n: int
    score: str
    key: str
    rows: dict[int, tuple[Any, Any]]
    plain: dict[int, tuple[Any, Any]]

    def above_sql(self, df: DataFrame, rank: int) -> str:
        """SQL that holds for rows with a score that are ranked after ``rank``.

        The key decides which comparison applies, so each row computes its score once.
        """
        if rank <= 0:
            return "TRUE"
        if rank >= self.n:
            return "FALSE"
        s, k = f"`{self.score}`", f"`{self.key}`"
        at_s = _literal(self.rows[rank][0], _type(df, self.score))
        at_k = _literal(self.rows[rank][1], _type(df, self.key))
        return f"(CASE WHEN {k} > {at_k} THEN {s} >= {at_s} ELSE {s} > {at_s} END)"

    def scored_sql(self, df: DataFrame) -> str:
        """SQL that holds for rows that have a rank."""
        nan = isinstance(_type(df, self.score), (T.FloatType, T.DoubleType))
        return f"(`{self.score}` IS NOT NULL" + (f" AND NOT isnan(`{self.score}`))" if nan else ")")

    def _ranked(self, df: DataFrame, rank: int, sql: str) -> Column:
        inner = 0 < rank < self.n
        compares_null = inner and not isinstance(_type(df, self.score), (T.FloatType, T.DoubleType))
        return F.expr(sql if compares_null else f"CASE WHEN {self.scored_sql(df)} THEN {sql} END")

    def above(self, df: DataFrame, rank: int) -> Column:
        """True for rows ranked after ``rank`` (NULL for rows without a rank)."""
        return self._ranked(df, rank, self.above_sql(df, rank))

    def upto(self, df: DataFrame, rank: int) -> Column:
        """True for rows ranked at or before ``rank`` (NULL for rows without a rank)."""
        return self._ranked(df, rank, f"(NOT {self.above_sql(df, rank)})")


def rank_cuts(
    df: DataFrame,
    score: str,
    key: str,
    ranks: Callable[[int], Sequence[int]],
    buckets: int | RangeBuckets | None = None,
    last: bool = False,
) -> RankCuts:
    """Exact rows at ``ranks(n)`` in the ascending order of (score, key).

    Narrow passes: count, sample, bucket counts, and a sort of the buckets that hold a rank. A bucket with
    more than CUT_ROWS rows is split and counted again by itself, so what one task sorts does not
    grow with the input. The row of the highest rank is only looked for with ``last``. Each pass returns a bounded number of rows to the driver.
    """
    slim = df.select(*dict.fromkeys((score, key)))
    known = isinstance(buckets, RangeBuckets)
    b = buckets if known else RangeBuckets.fit(slim, score, key, buckets or CUT_BUCKETS)
    tagged = b.assign(slim)
    # Rows without a score fall away here, not in a filter that would compute the bucket twice.
    counts = [(r["__bucket"], r["count"]) for r in tagged.groupBy("__bucket").count().collect() if r["__bucket"] >= 0]
    sizes = dict(counts)
    n = sum(sizes.values())
    wanted = sorted({r for r in ranks(n) if 0 < r < n + last})
    if not wanted:
        return RankCuts(n, score, key, {}, {})
    if not known and not b.points and n > CUT_ROWS:
        raise ValueError(f"{key} must be unique to break ties of {score}: {n} rows are the same")
    place: list[tuple[int, int, int]] = []
    done, todo = 0, iter(wanted)
    rank = next(todo, None)
    for bucket, size in sorted(counts):
        while rank is not None and rank <= done + size:
            place.append((rank, bucket, rank - done))
            rank = next(todo, None)
        done += size
    found = {}
    for bucket in sorted({p[1] for p in place if sizes[p[1]] > CUT_ROWS}):
        positions = [pos for _, at, pos in place if at == bucket]
        inside = tagged.where(F.col("__bucket") == bucket).select(*slim.columns)
        again = rank_cuts(inside, score, key, lambda _, p=positions: p, last=True)
        found |= {(bucket, pos): (again.rows[pos], again.plain[pos]) for pos in positions}
    by_bucket: dict[int, list[int]] = {}
    for _, bucket, pos in place:
        if (bucket, pos) not in found:
            by_bucket.setdefault(bucket, []).append(pos)
    if by_bucket:
        inside = tagged.where(F.col("__bucket").isin(sorted(by_bucket)))
        w = Window.partitionBy("__bucket").orderBy(score, key)
        hit = F.expr(
            " OR ".join(f"(__bucket = {b} AND __pos IN ({', '.join(map(str, ps))}))" for b, ps in by_bucket.items())
        )
        # The row after a cut is checked with it, and so are all others of the sorted buckets.
        placed = inside.withColumns({"__pos": F.row_number().over(w), "__twin": _twin(inside, score, key, w)})
        placed = placed.where(hit | F.col("__twin")).select(
            "__bucket", "__pos", "__twin", _portable(df, score).alias("__at_s"), _portable(df, key).alias("__at_k"), _row(df, [score, key]).alias("__at")
        )
        first = placed.limit(len(place) + 1) if len(place) < CUT_ROWS else placed
        for r in first.collect():
            if r["__twin"]:
                raise ValueError(f"{key} must be unique to break ties of {score}: {r['__at_k']!r} repeats")
            found[r["__bucket"], r["__pos"]] = ((r["__at_s"], r["__at_k"]), tuple(r["__at"]))
    at = {r: found[(bucket, pos)] for r, bucket, pos in place}
    return RankCuts(n, score, key, {r: x for r, (x, _) in at.items()}, {r: x for r, (_, x) in at.items()})


def _twin(df: DataFrame, score: str, key: str, w: Any) -> Column:
    """Whether the next row has the same score and key."""
    row = F.struct(score, key)
    return F.coalesce(F.lead(row).over(w) == row, F.lit(False))


def global_rank(
    df: DataFrame, score: str, key: str, out: str = "rank", buckets: int | None = None
) -> DataFrame:
    """Rank 1..n in the ascending order of (score, key), over the whole dataset.

    Two rows with the same score and key raise an error as the ranks are computed.
    """
    return rank_within(df, RangeBuckets.fit(df, score, key, buckets), out)


def rank_within(df: DataFrame, b: RangeBuckets, out: str) -> DataFrame:
    """:func:`global_rank` with splits already found."""
    b = b if b.sizes else b.counted(df)
    w = Window.partitionBy("__bucket").orderBy(b.score, b.key)
    tagged = b.assign(df)
    same = F.raise_error(F.concat(F.lit(f"{b.key} must be unique to break ties of {b.score}: "), F.col(b.key).cast("string"), F.lit(" repeats")))
    place = tagged.withColumns({"__pos": F.row_number().over(w), "__twin": _twin(tagged, b.score, b.key, w)})
    rank = _looked_up(b.before(), F.col("__bucket")) + F.col("__pos")
    checked = F.when((F.col("__bucket") >= 0) & F.col("__twin"), same.cast("bigint")).otherwise(rank)
    return place.withColumn(out, checked).drop("__bucket", "__pos", "__twin")


def bin_edges(n: int, q: int) -> list[int]:
    """Last rank of each of the first q-1 equal-frequency bins of n ranks."""
    return [1 + k * (n - 1) // q for k in range(1, q)]


def bin_of_rank(rank: Column, n: int, q: int) -> Column:
    """Equal-frequency bin 1..q of a rank, as quantile edges of the ranks would cut it."""
    if n <= 1:
        return F.when(rank.isNotNull(), F.lit(1)).cast("bigint")
    r = rank.cast("bigint")
    moved = (r - 1) * F.lit(q) + F.lit(n - 2)
    whole = (moved - F.pmod(moved, F.lit(n - 1))) / F.lit(n - 1)  # exact: the division has no rest
    return F.when(rank.isNotNull(), F.greatest(F.lit(1), whole.cast("bigint")))  # greatest skips NULL


def bin_by_cuts(df: DataFrame, cuts: RankCuts, q: int, out: str = "bin") -> DataFrame:
    """Bin 1..q of each row by the last rows of the bins, found on these rows or on others."""
    ends = [cuts.plain[r] for r in bin_edges(cuts.n, q) if r < cuts.n]
    placed = count_reached(df, [cuts.score, cuts.key], ends, "__ends", strict=True)
    return placed.withColumn(out, F.when(F.expr(cuts.scored_sql(df)), F.col("__ends") + F.lit(1).cast("bigint"))).drop("__ends")


def quantile_bin(
    df: DataFrame, score: str, key: str, q: int, out: str = "bin", buckets: int | None = None
) -> DataFrame:
    """Equal-frequency bin 1..q of each row's rank; NULL where there is no score."""
    return bin_by_cuts(df, rank_cuts(df, score, key, lambda n: bin_edges(n, q), buckets), q, out)


def rank_edge_bin(
    df: DataFrame,
    score: str,
    key: str,
    edges: Sequence[float],
    out: str = "bin",
    base: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Fixed-edge bin of each row's *rank*, as opposed to its value; NULL outside the edges."""
    last = [math.floor(e) for e in edges]  # a rank is <= e exactly when it is <= floor(e)
    cuts = rank_cuts(df, score, key, lambda n: last, buckets)
    cases = [f"WHEN NOT {cuts.scored_sql(df)} THEN NULL"]
    for i, r in enumerate(last):
        value = f"{i - 1 + base}L" if i else "NULL"
        cases.append(f"WHEN NOT {cuts.above_sql(df, r)} THEN {value}")
    return df.withColumn(out, F.expr(f"CAST(CASE {' '.join(cases)} END AS BIGINT)"))


def first_rows(
    df: DataFrame, score: str, key: str, n: int, buckets: int | RangeBuckets | None = None
) -> DataFrame:
    """The first n rows in the order of (score, key), as a filter: no row moves."""
    cuts = rank_cuts(df, score, key, lambda total: [n], buckets)
    return df.where(cuts.upto(df, n))


def average_rank(df: DataFrame, value: str, key: str, out: str, buckets: int | None = None) -> DataFrame:
    """Rank of each value with ties given their mean rank; the key spreads the work and need not be unique.

    Values among the splits are counted by themselves: their mean rank follows from the counts alone,
    however many rows they hold, and their rows are spread. All other values lie between two splits.
    """
    b = RangeBuckets.fit(df, value, key, buckets)
    values = list(dict.fromkeys(p[:1] for p in b.points))

    def classed(rows: DataFrame) -> DataFrame:
        """Odd class: equal to a split's value. Even class: between two of them."""
        most = count_reached(count_reached(rows, [value], values, "__most"), [value], values, "__least", strict=True)
        return most.withColumn("__class", F.when(present(df, value).isNotNull(), F.col("__most") + F.col("__least"))).drop("__most", "__least")

    found = {r["__class"]: r["count"] for r in classed(df.select(value)).groupBy("__class").count().collect()}
    sizes = [found.get(i, 0) for i in range(2 * len(values) + 1)]
    before = [0, *_running(sizes)][: len(sizes)]
    own = F.col("__class") % 2 == 0
    spread = -1 - F.pmod(F.xxhash64(key), F.lit(SPREAD)).cast("int")
    tagged = classed(df).withColumn("__bucket", F.when(own, F.col("__class")).otherwise(spread))
    ties = Window.partitionBy("__bucket", value)
    light = F.rank().over(Window.partitionBy("__bucket").orderBy(value)) + (F.count(F.lit(1)).over(ties) - 1) / F.lit(2.0)
    heavy = (_looked_up(sizes, F.col("__class")) + 1) / F.lit(2.0)
    rank = _looked_up(before, F.col("__class")) + F.when(own, F.col("__light")).otherwise(heavy)
    return tagged.withColumn("__light", light).withColumn(out, rank).drop("__bucket", "__class", "__light")


def running_sums(
    groups: DataFrame, b: RangeBuckets, values: Sequence[str], rows: DataFrame | None = None
) -> DataFrame:
    """Running totals over distinct scores, ascending.

    Adds ``<v>_before`` (sum over smaller scores) and ``<v>_total`` for each value, and the bucket.
    Bucket totals come from ``rows``, the ungrouped input with the same columns, if it is given: one
    more scan but no second shuffle of the groups. Without it they come from the groups, and the result
    also has ``__head`` (values of the largest score of the next lower bucket, NULL for the lowest) and
    ``__top`` (whether the bucket is the highest). The single-task windows run on one row per bucket.
    """
    tagged = b.assign(groups)
    largest = F.lit(None) if rows is not None else F.max_by(F.struct(*values), b.score)
    per_bucket = (tagged if rows is None else b.assign(rows)).groupBy("__bucket").agg(
        largest.alias("__largest"),
        *[F.sum(v).alias(f"__t_{v}") for v in values],
    )
    up = Window.orderBy("__bucket")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = per_bucket.select(
        F.col("__bucket").alias("__ob"),
        F.lag("__largest").over(up).alias("__head"),
        F.lead("__bucket").over(up).isNull().alias("__top"),
        *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in values],
        *[F.sum(f"__t_{v}").over(whole).alias(f"{v}_total") for v in values],
    )
    w = Window.partitionBy("__bucket").orderBy(b.score).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"__l_{v}") for v in values])
    return local.join(F.broadcast(summary), F.col("__bucket") == F.col("__ob")).select(
        *groups.columns,
        "__bucket",
        "__head",
        "__top",
        *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).cast("bigint").alias(f"{v}_before") for v in values],
        *[f"{v}_total" for v in values],
    )
