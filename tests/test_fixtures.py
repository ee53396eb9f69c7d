"""One small hand-made table per trap of the semantics."""

import math
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_plans import plan

from tidemark.functions import (
    as_int64,
    edge_bin,
    exclude_patterns,
    period_shift,
    round_even,
    scaled_int,
    shift_label,
    significant,
    trailing_windows,
)
from tidemark.operators import audience, datasets, evaluation, features, metrics, prep, registry, scoring, target


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_windows_null_against_zero(spark):
    rows = [
        ("A", date(2024, 3, 31), "shown", 1.0),
        ("A", date(2024, 1, 5), "open", None),
        ("B", date(2024, 2, 29), "open", 2.0),
        ("D", date(2023, 12, 31), "shown", 9.0),
    ]
    df = spark.createDataFrame(rows, "k string, d date, e string, x double")
    measures = {"n": features.event_count(F.col("e") == "shown"), "x": features.amount_total([F.col("x"), F.lit(1.0)])}
    got = features.trailing_features(df, "k", "d", trailing_windows("202404"), measures)
    by = {r["k"]: r.asDict() for r in got.collect()}
    assert set(by) == {"A", "B"}
    assert (by["A"]["n30"], by["A"]["n60"], by["A"]["n90"]) == (1, None, 0)
    assert (by["A"]["x30"], by["A"]["x90"]) == (2.0, None)
    assert (by["B"]["n30"], by["B"]["n60"]) == (None, 0)


def test_windows_without_their_last_day(spark):
    df = spark.createDataFrame([("A", date(2024, 3, 30)), ("B", date(2024, 3, 31))], "k string, d date")
    windows = trailing_windows("202404", lags=(1,), suffixes=("30",), inclusive=False)
    got = features.trailing_features(df, "k", "d", windows, {"top": features.highest(F.col("d"))})
    assert [r["k"] for r in got.collect()] == ["A"]


def test_window_of_timestamps_includes_the_whole_last_day(spark):
    df = spark.createDataFrame([("A", datetime(2024, 3, 31, 23, 59)), ("B", datetime(2024, 4, 1))], "k string, t timestamp_ntz")
    windows = trailing_windows("202404", lags=(1,), suffixes=("30",))
    assert [r["k"] for r in features.trailing_features(df, "k", "t", windows, {"n": features.event_count(F.lit(True))}).collect()] == ["A"]


def test_per_window_predicate(spark):
    df = spark.createDataFrame([("A", date(2024, 3, 1), "CG"), ("A", date(2024, 1, 1), "CG")], "k string, d date, b string")
    got = features.trailing_features(
        df, "k", "d", trailing_windows("202404"), {"n": features.event_count(F.lit(True))}, {"90": ~F.col("b").like("%CG")}
    ).first()
    assert (got["n30"], got["n90"]) == (1, None)


def test_one_scan_equals_a_table_per_window(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    measures = {"top": features.highest(F.col("o_totalprice")), "n": features.event_count(F.col("o_orderstatus") == "F")}
    windows = trailing_windows("199808")
    once = features.trailing_features(orders, "o_custkey", "o_orderdate", windows, measures)
    apart = None
    for w in windows:
        t = features.trailing_features(orders, "o_custkey", "o_orderdate", [w], measures)
        apart = t if apart is None else apart.join(t, "o_custkey", "full")
    assert once.exceptAll(apart.select(*once.columns)).count() == 0
    assert once.count() == apart.count()


def test_latest_row_ties_and_nulls(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, None, "z"), (2, None, "q")]
    df = spark.createDataFrame(rows, "k int, o int, t string")
    got = {r["k"]: r["t"] for r in features.latest_per_key(df, "k", "o", "t").collect()}
    assert got == {1: "a", 2: "q"}


def test_edges_are_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 3.0, 10.0, 11.0, math.nan, None)], "x double")
    assert column(df, edge_bin(F.col("x"), list(range(11)))) == [None, 0, 0, 2, 9, None, None, None]
    with pytest.raises(ValueError):
        edge_bin(F.col("x"), [1, 1, 2])


def test_rounding(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (-2.5,)], "x double")
    assert column(df, round_even(F.col("x"), 2)) == [0.12, 0.38, 2.5, -2.5]
    assert column(df, as_int64(F.col("x"))) == [0, 0, 3, -3]
    assert column(df, scaled_int(F.col("x"), 10)) == [1, 3, 25, -25]
    assert column(df, significant(F.lit(12.345678912))) == [Decimal("12.345680000000000000")] * 4


def test_periods(spark):
    df = spark.createDataFrame([("202401", "2024-02-26")], "m string, w string")
    assert column(df, period_shift(F.col("m"), -1)) == ["202312"]
    assert column(df, period_shift(F.col("w"), 1, "week")) == ["2024-03-04"]
    assert shift_label("202412", 2) == "202502" and shift_label("2024-12-30", 1, "week") == "2025-01-06"
    with pytest.raises(ValueError):
        shift_label("202401", 1, "day")


def test_null_pattern_value_is_dropped(spark):
    df = spark.createDataFrame([("x",), ("aBLOCKEDb",), (None,)], "b string")
    assert column(df.where(exclude_patterns(F.col("b"), ["%BLOCKED%", "%Q"])), "b") == ["x"]


def test_presence_and_exclusion(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert sorted((r["k"], r["f"]) for r in audience.presence_flag(df, other, "k", "f").collect()) == [(1, "N"), (2, "S")]
    assert column(audience.exclude_members(df, other, "k"), "k") == [1]
    assert column(audience.require_activity(df, other, "k"), "k") == [2]


def test_star_join_rejects_repeated_keys(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    once = spark.createDataFrame([(1, "x", None)], "k int, v string, w int")
    assert audience.star_join(base, [once], "k").orderBy("k").collect()[0].asDict() == {"k": 1, "v": "x", "w": None}
    twice = spark.createDataFrame([(1, 1), (1, 1)], "k int, u int")
    with pytest.raises(PySparkException):
        audience.star_join(base, [twice], "k").collect()


def test_drop_columns_names_the_unknown(spark):
    with pytest.raises(KeyError):
        audience.drop_columns(spark.range(1), ["nope"])


def test_arrays_and_capped_count(spark):
    rows = [(1, "a", [(5.0,), (7.0,)]), (1, "b", []), (1, "c", None), (1, None, [(1.0,)]), (2, "a", [(1.0,)])]
    rows += [(3, str(i), [(1.0,)]) for i in range(12)]
    df = spark.createDataFrame(rows, "k int, card string, limits array<struct<amount:double>>")
    flat = target.unnest(df, "limits")
    got = {r["k"]: r.asDict() for r in target.capped_count_target(flat, "k", "card", 10, value="amount").collect()}
    assert {k: v["target"] for k, v in got.items()} == {1: 1, 2: 1, 3: 10}
    assert got[1]["max_amount"] == 7.0


def test_training_set_fills_missing_targets_and_keeps_big_ids(spark):
    big = 9007199254740993
    pub = spark.createDataFrame([(big,), (big - 1,)], "k bigint")
    feats = spark.createDataFrame([(big, 1.0)], "k bigint, x double")
    goal = spark.createDataFrame([(big - 1, 3)], "k bigint, target int")
    got = {r["k"]: (r["x"], r["target"]) for r in datasets.training_set(pub, feats, goal, "k").collect()}
    assert got == {big: (1.0, 0), big - 1: (None, 3)}
    scores = spark.createDataFrame([(big, 0.25, 0.75), (big - 1, 0.5, 0.5)], "k bigint, p0 double, p1 double")
    table = scoring.score_table_class(scores, "k", "p0", "p1", "m", date(2024, 1, 1), "r", "t", q=2)
    assert {(r["k"], r["DECIL"], r["SCORES_1"]) for r in table.collect()} == {(big, 1, 7500), (big - 1, 2, 5000)}


def test_encoding_unseen_null_and_single_row(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("a", 1), (None, 0), ("s", 1)], "c string, y int")
    prior = 0.6
    test = spark.createDataFrame([("a",), (None,), ("new",), ("s",)], "c string")
    additive = prep.fit_target_encoder(train, ["c"], "y", "additive", smoothing=1.0).transform(test)
    got = {r["c"]: r["c_enc"] for r in additive.collect()}
    want_a = 0.75 * (2 / 3) + 0.25 * prior
    assert got["a"] == pytest.approx(want_a) and got[None] == pytest.approx(prior / 2) and got["new"] == prior
    sigmoid = prep.fit_target_encoder(train, ["c"], "y", "sigmoid", smoothing=0.5, min_samples=1).transform(test)
    got = {r["c"]: r["c_enc"] for r in sigmoid.collect()}
    w = 1 / (1 + math.exp(-(3 - 1) / 0.5))
    assert got["s"] == pytest.approx(prior) and got["a"] == pytest.approx(w * 2 / 3 + (1 - w) * prior)


def test_encoding_with_many_categories(spark):
    train = spark.range(120_000).select(F.concat(F.lit("c"), "id").alias("c"), (F.col("id") % 2).alias("y"))
    got = prep.fit_target_encoder(train, ["c"], "y", smoothing=1.0).transform(train)
    assert got.where("c_enc <> 0.25 + y * 0.5").count() == 0 and got.count() == 120_000


def test_small_encoding_table_leaves_the_rows_where_they_are(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 5).cast("string").alias("c"), (F.col("id") % 2).alias("y")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    coded = prep.fit_target_encoder(rows, ["c"], "y").transform(rows)
    assert "BroadcastHashJoin" in plan(coded) and "Exchange hashpartitioning" not in plan(coded)


def test_prepared_columns_may_have_any_name(spark):
    rows = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 0)], "`my cat` string, `n.x` double, y int")
    assert prep.fit_prep(rows, ["my cat"], ["n.x"], "y").transform(rows).first()["features"].size == 2


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(math.nan, None), (None, "x"), (2.0, None)], "x double, c string")
    got = [tuple(r) for r in prep.impute_constant(df, ["c"], ["x"]).collect()]
    assert got == [(0.0, "missing"), (0.0, "x"), (2.0, "missing")]


def test_variance_is_the_populations(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, flat double")
    assert prep.fit_variance_filter(df, ["x", "flat"], 0.8) == []
    assert prep.fit_variance_filter(df, ["x", "flat"], 0.6) == ["x"]
    kept = prep.fit_prep(df, [], ["x", "flat"], "x", t=0.6).transform(df).first()["features"]
    assert kept.size == 1
    assert prep.fit_prep(df, [], ["x", "flat"], "x", t=0.6, scale=True).transform(df).first()["features"].size == 0


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(1, 4.0), (3, 4.0)], "x int, flat double")
    got = [tuple(r) for r in prep.fit_minmax(df, ["x", "flat"]).transform(df).collect()]
    assert got == [(0.0, 0.0), (1.0, 0.0)]


def scored(spark, rows):
    return spark.createDataFrame([(i, s, y) for i, (s, y) in enumerate(rows)], "id bigint, s double, y int")


def test_lift_with_groups_and_sets_without_positives(spark):
    some = scored(spark, [(0.1, 1), (0.2, 1), (0.3, 0), (0.4, 0)])
    rows = evaluation.lift_table(some, "s", "y", 2, "id").orderBy("scr_grp").collect()
    assert [r["Positives"] for r in rows] == [2, 0]
    assert [r["resp_rate"] for r in rows] == [1.0, 0.0] and rows[0]["lift"] == 2.0 and rows[0]["KS"] == 50.0
    none = scored(spark, [(0.1, 0), (0.2, 0)])
    rows = evaluation.lift_table(none, "s", "y", 2, "id").collect()
    assert all(r["lift"] is None and r["cmltv_p_perc"] is None for r in rows)
    assert evaluation.eval_table_class(evaluation.lift_table(none, "s", "y", 2, "id"), "m", date(2024, 1, 1), "r", "t").count() == 2


def test_roc_with_all_scores_equal_and_two_scores(spark):
    same = scored(spark, [(0.5, 1), (0.5, 0), (0.5, 0)])
    assert metrics.roc_auc(same, "s", "y").first()[0] == 0.5
    points = [tuple(r) for r in metrics.roc_points(same, "s", "y").orderBy(F.desc("threshold")).collect()]
    assert points == [(math.inf, 0.0, 0.0), (0.5, 1.0, 1.0)]
    best = metrics.optimal_threshold(same, "s", "y").first()
    assert best["threshold"] == math.inf and best["gmean"] == 0.0
    two = scored(spark, [(0.9, 1), (0.1, 0)])
    assert metrics.roc_auc(two, "s", "y").first()[0] == 1.0
    assert metrics.optimal_threshold(two, "s", "y").first()["threshold"] == 0.9


def test_roc_with_one_class_only(spark):
    ones = scored(spark, [(0.9, 1), (0.1, 1)])
    assert metrics.roc_auc(ones, "s", "y").first()[0] is None
    assert all(r["fpr"] is None for r in metrics.roc_points(ones, "s", "y").collect())


def test_auc_is_the_area_under_the_points(spark, sf):
    from catalog import inputs

    rows = inputs.scored_orders(spark, sf)
    exact = metrics.roc_auc(rows, "p1", "target").first()[0]
    for drop in (True, False):
        pts = [(r["fpr"], r["tpr"]) for r in metrics.roc_points(rows, "p1", "target", drop).orderBy("fpr", "tpr").collect()]
        area = sum((b[0] - a[0]) * (b[1] + a[1]) / 2 for a, b in zip(pts, pts[1:]))
        assert area == pytest.approx(exact, abs=1e-12)


def test_best_f1_by_brute_force(spark):
    rows = [((i * 37 % 101) / 101, int(i * 53 % 7 < 2)) for i in range(200)]
    df = scored(spark, rows)
    for log_scale in (True, False):
        cuts = metrics._cuts(min(s for s, _ in rows), max(s for s, _ in rows), 20, log_scale)
        want = 0.0
        for c in cuts:
            tp = sum(1 for s, y in rows if s >= c and y)
            said, real = sum(1 for s, _ in rows if s >= c), sum(y for _, y in rows)
            want = max(want, 2 * tp / (said + real))
        assert metrics.best_f1(df, "s", "y", 20, log_scale).first()[0] == pytest.approx(want)


def test_calibration_curve_side(spark):
    df = scored(spark, [(0.1, 1), (0.05, 0), (1.0, 1), (0.0, 0)])
    right = {r["bin"]: r["rows"] for r in metrics.calibration_curve(df, "s", "y").collect()}
    left = {r["bin"]: r["rows"] for r in metrics.calibration_curve(df, "s", "y", closed="left").collect()}
    assert right == {0: 3, 9: 1} and left == {0: 2, 1: 1, 9: 1}


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    rows = {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rows["1"]["precision"] == 0.0 and rows["1"]["support"] == 1
    assert rows["accuracy"]["f1_score"] == 0.5 and rows["0"]["f1_score"] == pytest.approx(2 / 3)


def test_regression_metrics_swapped(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    sse = 0.25 + 0 + 1
    a = metrics.regression_metrics(df, "y", "p").first()
    b = metrics.regression_metrics(df, "y", "p", swapped=True).first()
    assert a["r2"] == pytest.approx(1 - sse / (14 / 3)) and a["mae"] == pytest.approx(0.5)
    mean = 6.5 / 3
    assert b["r2"] == pytest.approx(1 - sse / sum((v - mean) ** 2 for v in (1.5, 2, 3)))


REG = "MODEL_NAME string, DT_TRAIN string, METRIC int, SAFRA date"


@pytest.mark.parametrize(
    "known, metric, tolerance, accepted",
    [
        ([], 10, 0, True),
        ([("m", "1", 70, date(2024, 1, 1))], 71, 0, True),
        ([("m", "1", 70, date(2024, 1, 1))], 70, 0, True),
        ([("m", "1", 70, date(2024, 1, 1))], 68, 2, True),
        ([("m", "1", 70, date(2024, 1, 1))], 67, 2, False),
        ([("m", "1", 70, date(2025, 1, 1))], 10, 0, True),
        ([("other", "1", 70, date(2024, 1, 1))], 10, 0, True),
    ],
)
def test_champion_decision(spark, known, metric, tolerance, accepted):
    champions = spark.createDataFrame(known, REG)
    candidate = spark.createDataFrame([("m", "2", metric, date(2024, 6, 1))], REG)
    assert registry.champion_decision(champions, candidate, tolerance).first()["accepted"] is accepted


def test_champion_with_a_metric_to_minimize(spark):
    champions = spark.createDataFrame([("m", "1", 70, date(2024, 1, 1))], REG)
    worse = spark.createDataFrame([("m", "2", 75, date(2024, 6, 1))], REG)
    assert not registry.champion_decision(champions, worse, 2, "minimize").first()["accepted"]
    assert registry.best_model(champions.union(worse), "m", date(2024, 6, 1), "minimize").first()["BEST_METRIC"] == 70


def test_metric_is_truncated_to_percent(spark):
    df = spark.createDataFrame([(0.7999,)], "x double")
    assert column(df, registry.metric_percent(F.col("x"))) == [79]


def test_latest_scores_takes_one_run(spark):
    rows = [("m", 1, "a"), ("m", 2, "b"), ("m", 3, "b"), ("n", 4, "c")]
    df = spark.createDataFrame(rows, "MODEL_NAME string, id int, DT_EXEC string").withColumn("SAFRA", F.lit(date(2024, 1, 1)))
    assert sorted(column(scoring.latest_scores(df, "m", date(2024, 1, 1)), "id")) == [2, 3]
    assert scoring.latest_scores(df, "m", date(2024, 2, 1)).count() == 0
