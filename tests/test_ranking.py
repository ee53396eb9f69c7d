"""Global order: ranks, bins and cuts against pandas and a plain window, under ties and skew."""

import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ranking as R


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score and another tenth has none; keys as text with a prefix."""
    i = F.col("id")
    score = F.when(i % 3 == 0, 0.5).when(i % 10 == 1, F.lit(None)).when(i % 50 == 2, F.lit(float("nan"))).otherwise(F.rint(F.rand(3) * 400) / 100)
    df = spark.range(0, 6000, numPartitions=7).select(
        F.concat(F.lit("customer-"), F.lpad((i * 7919 % 6000).cast("string"), 5, "0")).alias("key"), score.alias("score"), i.alias("num")
    )
    return df.persist()


def ranked_plainly(df):
    clean = F.nanvl("score", F.lit(None))
    w = Window.orderBy(clean.isNull(), clean, "key")
    return df.withColumn("want", F.when(clean.isNotNull(), F.row_number().over(w)))


@pytest.mark.parametrize("buckets", [None, 2, 16, 64])
def test_global_rank_equals_plain_window(skewed, buckets):
    got = R.global_rank(ranked_plainly(skewed), "score", "key", buckets=buckets)
    assert got.where(~F.col("rank").eqNullSafe(F.col("want"))).count() == 0
    assert got.count() == skewed.count()


@pytest.mark.parametrize("q", [1, 3, 10, 100])
def test_quantile_bin_equals_bin_of_rank(skewed, q):
    plain = ranked_plainly(skewed)
    n = plain.where("want is not null").count()
    want = F.greatest(F.lit(1), F.call_function("div", (F.col("want") - 1) * q + n - 2, F.lit(n - 1)))
    got = R.quantile_bin(plain, "score", "key", q, buckets=32)
    assert got.where(~F.col("bin").eqNullSafe(F.when(F.col("want").isNotNull(), want))).count() == 0


def test_hot_score_is_split_by_key(skewed):
    b = R.RangeBuckets.fit(skewed, "score", "key", 32)
    assert b.heavy
    largest = b.assign(skewed).groupBy("__bucket").count().agg(F.max("count")).first()[0]
    assert largest <= 3 * 6000 / 32


def test_cuts_hold_under_any_partitioning(skewed):
    a = R.first_rows(skewed, "score", "key", 2500, buckets=16)
    b = R.first_rows(skewed.repartition(3), "score", "key", 2500, buckets=50)
    assert a.count() == 2500
    assert sorted(r.key for r in a.collect()) == sorted(r.key for r in b.collect())


def test_repeated_key_is_an_error(spark):
    df = spark.createDataFrame([(0.5, 1)] * 10, "score double, key bigint")
    with pytest.raises(ValueError, match="unique"):
        R.first_rows(df, "score", "key", 5)


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 12, 57])
@pytest.mark.parametrize("q", [2, 10])
def test_bins_equal_pandas_qcut(spark, n, q):
    df = spark.createDataFrame([(i, float(i * 37 % 61)) for i in range(n)], "key bigint, score double")
    got = {r["key"]: r["bin"] for r in R.quantile_bin(df, "score", "key", q).collect()}
    if n < 2:
        assert got == {i: 1 for i in range(n)}
        return
    ranks = pd.Series([float(i * 37 % 61) for i in range(n)]).rank(method="first")
    want = pd.qcut(ranks, q, labels=False) + 1
    assert got == dict(enumerate(int(v) for v in want))


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 5000), st.integers(2, 60))
def test_bin_edges_invert_the_bin_formula(n, q):
    def bin_of(r):
        return max(1, ((r - 1) * q + n - 2) // (n - 1))

    for k, last in enumerate(R.bin_edges(n, q), 1):
        assert bin_of(last) <= k < bin_of(last + 1) or last >= n


def test_bin_of_rank_is_exact(spark):
    n, q = 10**12 + 7, 1000
    ranks = [1, 2, n // 2, n // 2 + 1, n - 1, n]
    df = spark.createDataFrame([(r,) for r in ranks], "r bigint")
    got = [x[0] for x in df.select(R.bin_of_rank(F.col("r"), n, q)).collect()]
    assert got == [max(1, ((r - 1) * q + n - 2) // (n - 1)) for r in ranks]


def test_average_rank_equals_pandas(skewed):
    got = R.average_rank(skewed, "score", "key", "r", buckets=16).select("key", "score", "r").toPandas()
    assert (got.r.fillna(-1) == got.score.rank(method="average").fillna(-1)).all()


def test_rank_edge_bin_on_more_rows_than_edges(spark):
    """Fifteen scores and edges 0..10: ten bins, then none."""
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 16)], "key bigint, score double")
    got = [r["bin"] for r in R.rank_edge_bin(df, "score", "key", list(range(11))).orderBy("key").collect()]
    assert got == list(range(10)) + [None] * 5


@pytest.mark.parametrize("kind", ["date", "decimal(10,2)", "int", "float"])
def test_other_score_types(spark, kind):
    base = spark.range(500).select(F.col("id").alias("key"), (F.col("id") * 31 % 97).alias("v"))
    score = F.date_add(F.lit("2020-01-01").cast("date"), F.col("v").cast("int")) if kind == "date" else F.col("v").cast(kind)
    df = base.withColumn("score", score).withColumn("want", F.row_number().over(Window.orderBy("v", "key")))
    assert R.global_rank(df, "score", "key", buckets=20).where("rank <> want").count() == 0
    assert R.first_rows(df, "score", "key", 123, buckets=20).where("want > 123").count() == 0


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_times_across_a_clock_change(spark, zone, kind):
    """Ten seconds a row over the night of 10 March 2024."""
    micros = (F.col("id") * 7919 % 2000) * 10_000_001
    if kind == "timestamp_ntz":
        score = F.expr("timestamp_ntz'2024-03-10 00:30:00'") + F.make_dt_interval(secs=(micros / 1e6).cast("decimal(18,6)"))
    else:
        score = F.timestamp_micros(F.lit(1710030600000000) + micros)
        score = F.date_add(F.lit("2024-01-01").cast("date"), (micros / 86_400e4).cast("int")) if kind == "date" else score
    df = spark.range(2000).select(F.col("id").alias("key"), score.alias("score"))
    df = df.withColumn("want", F.row_number().over(Window.orderBy("score", "key")))
    assert R.global_rank(df, "score", "key", buckets=20).where("rank <> want").count() == 0
    assert R.first_rows(df, "score", "key", 777, buckets=20).where("want > 777").count() == 0
    assert sorted(r["count"] for r in R.quantile_bin(df, "score", "key", 4).groupBy("bin").count().collect()) == [500] * 4


@pytest.mark.parametrize("hot", ["CAST(0.5 AS DECIMAL(12,2))", "double('infinity')", "double('-infinity')", "timestamp_ntz'2024-01-01 00:00:00'"])
def test_hot_scores_of_all_kinds_are_split(spark, hot):
    other = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)" if "ntz" in hot else "CAST(id / 10 AS DECIMAL(12,2))" if "DECIMAL" in hot else "CAST(id AS DOUBLE)"
    df = spark.range(9000).select(F.col("id").alias("key"), F.expr(f"CASE WHEN id % 3 < 2 THEN {hot} ELSE {other} END").alias("score"))
    b = R.RangeBuckets.fit(df, "score", "key", 32)
    assert b.assign(df).groupBy("__bucket").count().agg(F.max("count")).first()[0] <= 4 * 9000 / 32
    want = df.withColumn("want", F.row_number().over(Window.orderBy("score", "key")))
    assert R.global_rank(want, "score", "key", buckets=32).where("rank <> want").count() == 0


def test_full_buckets_are_cut_again(skewed, monkeypatch):
    plain = ranked_plainly(skewed).persist()
    monkeypatch.setattr(R, "CUT_ROWS", 150)
    for n in (1, 999, 2500, 4000):
        got = R.first_rows(plain, "score", "key", n, buckets=4)
        assert got.count() == n and got.where(F.col("want") > n).count() == 0


def test_running_sums_before_and_total(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000 / 10).alias("s"), (F.col("id") % 5).alias("v"))
    b = R.RangeBuckets.fit(df, "s", buckets=16)
    got = R.running_sums(df, b, ["v"])
    w = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    want = got.withColumn("w", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert want.where("v_before <> w or v_total <> 2000").count() == 0
    assert math.isclose(df.count(), 1000)


def _fullest(df, b):
    return b.assign(df).where("__bucket >= 0").groupBy("__bucket").count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize(
    "score,key",
    [
        ("IF(id % 3 < 2, 'hot', concat('s', id % 977))", "id"),
        ("CAST(IF(id % 3 < 2, 0.77, id / 7) AS DECIMAL(18,2))", "id"),
        ("CAST(IF(id % 3 < 2, 12345678901234567890123, id) AS DECIMAL(38,2))", "concat('k-', id)"),
        ("id % 3 < 2", "concat('same-long-prefix-', lpad(id, 9, '0'))"),
        ("1", "IF(id = 77, 'outlier', concat('zz-', lpad(id, 9, '0')))"),
        ("binary(IF(id % 3 < 2, 'hot', concat('s', id % 977)))", "id"),
    ],
)
def test_hot_scores_and_uneven_keys_of_any_type(spark, score, key):
    """Two thirds of the rows or all of them with one score: no bucket holds three times its share."""
    df = spark.range(0, 20000, numPartitions=6).select(F.expr(score).alias("score"), F.expr(key).alias("key"))
    assert _fullest(df, R.RangeBuckets.fit(df, "score", "key", 40)) <= 3 * 20000 / 40
    want = df.withColumn("want", F.row_number().over(Window.orderBy("score", "key")))
    assert R.global_rank(want, "score", "key", buckets=40).where("rank <> want").count() == 0
    n, q = 20000, 7
    bins = R.quantile_bin(want, "score", "key", q, buckets=40)
    assert bins.where(F.col("bin") != F.greatest(F.lit(1), F.call_function("div", (F.col("want") - 1) * q + n - 2, F.lit(n - 1)))).count() == 0
    mean = df.withColumn("want", F.rank().over(Window.orderBy("score")) + (F.count("*").over(Window.partitionBy("score")) - 1) / 2)
    assert R.average_rank(mean, "score", "key", "mean", buckets=40).where("mean <> want").count() == 0


@pytest.mark.parametrize("use", ["rank", "bin 10", "bin 65", "cut", "sample"])
def test_repeated_keys_are_an_error_everywhere(spark, use):
    """A hundred keys ten times each, all with one score."""
    df = spark.range(1000).select(F.lit(0.5).alias("score"), (F.col("id") % 100).alias("key"))
    with pytest.raises(Exception, match="must be unique"):
        if use == "rank":
            R.global_rank(df, "score", "key").collect()
        elif use == "sample":
            R.rank_cuts(df, "score", "key", lambda n: [n // 3])
        elif use == "cut":
            R.first_rows(df, "score", "key", 500).collect()
        else:
            R.quantile_bin(df, "score", "key", int(use.split()[1])).collect()


def test_buckets_follow_the_rows_and_full_ones_are_split(spark, monkeypatch):
    df = spark.range(30000).select(F.when(F.col("id") < 25000, 1.0).otherwise(F.col("id").cast("double")).alias("score"), F.col("id").alias("key"))
    monkeypatch.setattr(R, "BUCKET_ROWS", 300)
    b = R.RangeBuckets.fit(df, "score", "key")
    assert 90 <= len(b.points) <= 100
    # Splits that balance nothing: all rows are in two buckets, which are split until none is too full.
    poor = R.RangeBuckets(30000, "score", "key", ((2.0, None),)).counted(df)
    assert max(poor.sizes) <= 1200 and sum(poor.sizes) == 30000
    want = df.withColumn("want", F.row_number().over(Window.orderBy("score", "key")))
    assert R.rank_within(want, R.RangeBuckets(30000, "score", "key", ((2.0, None),)), "rank").where("rank <> want").count() == 0
    sums = R.running_sums(want.select("score", (F.col("key") % 5).alias("v")).groupBy("score").agg(F.sum("v").alias("v")), R.RangeBuckets.fit(df, "score"), ["v"])
    assert sums.agg(F.max("v_before") + F.max_by("v", "score"), F.max("v_total")).first() == (60000, 60000)
