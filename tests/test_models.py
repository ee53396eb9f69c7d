"""Invariants of what SQL cannot state: splits, resampling, models, calibration, flows."""

import math
import random
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import inputs as I
from tidemark import sources
from tidemark.operators import datasets, prep, resampling, scoring, selection, training
from tidemark.plans import campaign, flows
from tidemark.session import work_path

TREES = {"maxIter": 3, "maxDepth": 3, "seed": 1}


@pytest.fixture(scope="module")
def rows(spark, sf):
    return I.model_rows(spark, sf).persist()


@pytest.fixture(scope="module")
def prepared(rows):
    model = prep.fit_prep(rows, ["priority", "status"], ["price", "month", "weekday"], "target")
    return model, model.transform(rows).select("id", "target", "price", "features").persist()


def ids(df, key="id"):
    return sorted(r[0] for r in df.select(key).collect())


def test_split_is_exact_disjoint_and_independent_of_partitioning(rows):
    n = rows.count()
    train, test = datasets.train_test(rows, "id", 0.3, 5)
    assert test.count() == math.ceil(n * 0.3) and train.count() == n - test.count()
    assert not set(ids(train)) & set(ids(test))
    assert ids(test) == ids(datasets.train_test(rows.repartition(1), "id", 0.3, 5)[1])
    assert ids(test) == ids(datasets.train_test(rows.repartition(8), "id", 0.3, 5)[1])
    assert ids(test) != ids(datasets.train_test(rows, "id", 0.3, 6)[1])


def test_sample_sizes(rows):
    assert datasets.sample_n(rows, "id", 17, 1).count() == 17
    assert datasets.sample_n(rows, "id", 10**9, 1).count() == rows.count()
    assert datasets.sample_n(rows, "id", None, 1) is rows
    assert datasets.sample_n(rows, "id", 0, 1).count() == 0


def test_undersample_balances(rows):
    counts = {r["target"]: r["count"] for r in datasets.undersample(rows, "target", "id").groupBy("target").count().collect()}
    smallest = rows.groupBy("target").count().agg(F.min("count")).first()[0]
    assert set(counts.values()) == {smallest}


def neighbours_by_brute_force(points, keys, k):
    out = {}
    for i in range(len(points)):
        d = np.sqrt(((points - points[i]) ** 2).sum(1))
        d[i] = np.inf
        out[keys[i]] = [int(keys[j]) for j in np.lexsort((keys, d))[:k]]
    return out


def test_nearest_neighbours_with_copies_equal_brute_force(spark, monkeypatch):
    """A third of the rows are one point; chunks are small enough to need many of them."""
    monkeypatch.setattr(resampling, "BLOCK_ROWS", 7)
    monkeypatch.setattr(resampling, "CHUNK_ROWS", 40)
    rng = random.Random(1)
    data = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [rng.random() * 9 + (i % 4) * 20 for _ in range(3)]) for i in range(240)]
    df = spark.createDataFrame(data, "id bigint, x array<double>")
    got: dict[int, list[int]] = {}
    for r in resampling.nearest_neighbours(df, "id", "x", 4, seed=3).orderBy("id", "n").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == neighbours_by_brute_force(np.array([v for _, v in data]), np.array([i for i, _ in data]), 4)


def test_rows_are_not_copied_from_cell_to_cell(spark, monkeypatch):
    """In 16 dimensions nearly all cells are in reach of all rows; text keys, single-precision vectors, some copies."""
    monkeypatch.setattr(resampling, "BLOCK_ROWS", 7)
    visited, visit = [], resampling._visit

    def counted(rows, *rest):
        visited.append(rows.count())
        return visit(rows, *rest)

    monkeypatch.setattr(resampling, "_visit", counted)
    points = np.random.default_rng(3).normal(size=(200, 16)).astype(np.float32)
    points[150:] = points[100]
    keys = [f"k{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(k, [float(v) for v in x]) for k, x in zip(keys, points)], "id string, x array<float>")
    got: dict[str, list[str]] = {}
    for r in resampling.nearest_neighbours(df, "id", "x", 3, seed=3).orderBy("id", "n").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
        assert r["neighbour_features"] == points[int(r["neighbour"][1:])].astype(float).tolist()
    near = neighbours_by_brute_force(points.astype(float), list(range(200)), 3)
    assert got == {keys[i]: [keys[j] for j in found] for i, found in near.items()}
    assert sum(visited) == 200


def test_smote_rows_lie_between_minority_neighbours(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", (F.col("label") == 1).cast("int").alias("y"))
    minority = rows.where("y = 1").orderBy("vec_id").collect()
    keys, points = np.array([r["vec_id"] for r in minority]), np.array([r["embedding"] for r in minority], dtype=float)
    near = neighbours_by_brute_force(points, keys, 5)
    made = resampling.smote_rows(rows, "vec_id", "embedding", "y", 5, 42).collect()
    assert len(made) == rows.where("y = 0").count() - len(minority)
    at = {int(k): p for k, p in zip(keys, points)}
    for r in made:
        assert r["neighbour"] in near[r["base"]] and 0 <= r["gap"] < 1
        want = at[r["base"]] + r["gap"] * (at[r["neighbour"]] - at[r["base"]])
        assert np.allclose(r["embedding"], want)
    per_base = [sum(r["base"] == k for r in made) for k in keys]
    assert max(per_base) - min(per_base) <= 1
    again = resampling.smote_rows(rows.repartition(3), "vec_id", "embedding", "y", 5, 42).collect()
    assert sorted((r["base"], r["neighbour"], r["gap"]) for r in made) == sorted((r["base"], r["neighbour"], r["gap"]) for r in again)


def test_permuted_columns_keep_their_values(rows):
    got = training.permuted_columns(rows.select("id", "price", "month"), "id", ["price", "month"], 9)
    pdf = got.toPandas()
    assert len(pdf) == rows.count()
    for c in ("price", "month"):
        assert sorted(pdf[c]) == sorted(pdf[f"perm_{c}"])
    assert (pdf["price"] != pdf["perm_price"]).mean() > 0.9


def test_scored_rows_equal_input_and_models_survive_saving(spark, prepared, rows):
    model, data = prepared
    fitted = training.fit_model(data, "classification", TREES, unbalanced=True)
    direct = scoring.batch_score(fitted, data, "id")
    assert ids(direct) == ids(rows)
    assert direct.where("abs(p0 + p1 - 1) > 1e-9").count() == 0
    from pyspark.ml import PipelineModel

    uri = work_path(spark, "models")
    sources.save_model(PipelineModel(stages=[*model.stages, fitted]), uri, "m", "202401", "r")
    loaded = sources.load_model(uri, "m", "202401", "r")
    again = scoring.batch_score(loaded, rows, "id").withColumnRenamed("p1", "q1")
    assert direct.join(again, "id").where("abs(p1 - q1) > 1e-12").count() == 0


def test_any_estimator_can_be_plugged_in(prepared):
    from pyspark.ml.regression import LinearRegression

    model = training.fit_model(prepared[1], "regression", {"regParam": 0.1}, label="price", make=LinearRegression)
    assert model.transform(prepared[1]).count() == prepared[1].count()


def test_encoded_categories_are_numbers_to_the_trees(prepared):
    attrs = prepared[1].schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    assert "nominal" not in attrs


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert sorted(r["weight"] for r in training.class_weights(df, "y").collect()) == [1.0, 1.0, 1.0, 3.0]


def test_search_is_seeded_and_finds_its_best(prepared):
    space = {"maxDepth": ("categorical", [2, 3]), "stepSize": ("loguniform", 0.05, 0.3)}
    runs = [
        training.search(prepared[1], "id", "regression", space, training.mean_absolute_error, "minimize", 2, 7, label="price", params={"maxIter": 2})
        for _ in range(2)
    ]
    assert runs[0].best_params == runs[1].best_params
    trials = runs[0].trials.collect()
    assert min(t["metric"] for t in trials) == runs[0].best_metric and len(trials) == 2


def test_trials_at_a_time_and_rungs_do_not_depend_on_timing(prepared):
    space = {"maxDepth": ("categorical", [1, 2, 3]), "stepSize": ("loguniform", 0.05, 0.3)}
    fixed = {"maxIter": 2, "seed": 3}
    runs = [
        training.search(prepared[1], "id", "regression", space, training.mean_absolute_error, "minimize", 6, 7, label="price", params=fixed, rungs=(0.3, 1.0), keep=0.5, parallel=n)
        for n in (1, 3)
    ]
    one, three = ([tuple(r) for r in run.trials.collect()] for run in runs)
    assert one == three and runs[0].best_params == runs[1].best_params
    last = [r for r in one if r[1] == 1]
    assert len(last) == 3 and [r[0] for r in last if r[3]] == [min(last, key=lambda r: (r[2], r[0]))[0]]
    first = [r[2] for r in one if r[1] == 0]
    assert len(first) == 3
    stopped = training.search(prepared[1], "id", "regression", space, training.mean_absolute_error, "minimize", 1, 7, label="price", params=fixed, early_stop=True)
    assert stopped.best_metric > 0
    with pytest.raises(ValueError):
        training.search(prepared[1], "id", "regression", space, rungs=(0.5,))


def test_draws_stay_in_their_spaces():
    rng = random.Random(0)
    space = {"a": ("loguniform", 0.01, 5), "b": ("uniform", 0.4, 1), "c": ("int", 8, 80), "d": ("categorical", [2, 3])}
    for _ in range(200):
        p = training.draw_params(space, rng)
        assert 0.01 <= p["a"] <= 5 and 0.4 <= p["b"] <= 1 and 8 <= p["c"] <= 80 and p["d"] in (2, 3)
    with pytest.raises(ValueError):
        training.draw_params({"a": ("normal", 0, 1)}, rng)


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibration_is_monotone_and_a_probability(spark, method):
    df = spark.createDataFrame([(i / 100, int((i * 7919 % 100) / 100 < i / 100)) for i in range(100)], "s double, y int")
    fitted = training.fit_calibration(df, "s", "y", method)
    out = [r["calibrated"] for r in fitted.transform(df).orderBy("s").collect()]
    assert all(0 <= v <= 1 for v in out) and out == sorted(out)
    assert abs(sum(out) / 100 - sum(r["y"] for r in df.collect()) / 100) < 0.02


def test_calibrating_counts_equals_calibrating_rows(spark):
    """Platt's fit on repeated scores is the fit on the rows themselves."""
    df = spark.createDataFrame([(i % 5 / 5, int(i % 7 < i % 5)) for i in range(200)], "s double, y int")
    m = training.fit_calibration(df, "s", "y", "sigmoid").model
    x = np.array([i % 5 / 5 for i in range(200)])
    y = np.array([int(i % 7 < i % 5) for i in range(200)])
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    p = 1 / (1 + np.exp(-(m.coefficients[0] * x + m.intercept)))
    assert abs((p - t).sum()) < 1e-4 and abs(((p - t) * x).sum()) < 1e-4  # gradient of the loss


def test_binned_calibration_on_other_rows(spark):
    fit = spark.createDataFrame([(i, i / 10, int(i >= 5)) for i in range(10)], "id bigint, s double, y int")
    new = spark.createDataFrame([(1, 100.0), (2, 200.0)], "id bigint, s double")
    got = {r["id"]: (r["calibrated"], r["prediction"]) for r in scoring.binned_calibration(fit, "s", "y", 2, "id", new).collect()}
    assert got == {1: (0.0, 0), 2: (1.0, 1)}


def test_feature_importance_finds_the_feature(spark):
    df = spark.range(400).select("id", (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 97).cast("double").alias("noise"))
    df = df.withColumn("target", (F.col("x") > 50).cast("int"))
    model = training.fit_model(prep.prep_stages([], ["x", "noise"], "target").fit(df).transform(df), "classification", TREES)
    got = {r["feature"]: r for r in training.feature_importance(model, df, "id", ["x", "noise"], "classification").collect()}
    assert got["x"]["metric_change"] > 0.1 > abs(got["noise"]["metric_change"])
    assert got["x"]["model_importance"] > 0.9


def test_binomial_tails_and_step_up():
    assert selection._tail(3, 3, True) == 1 / 8 and selection._tail(0, 3, False) == 1 / 8
    assert selection._tail(0, 5, True) == 1.0
    assert selection._step_up([0.01, 0.04, 0.03, 0.9], 0.05) == [True, False, False, False]
    assert selection._step_up([0.01, 0.02, 0.03, 0.9], 0.05) == [True, True, True, False]


def test_shadow_selection_keeps_the_relevant(spark):
    df = spark.range(300).select("id", (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 97).cast("double").alias("noise"))
    df = df.withColumn("target", (F.col("x") > 50).cast("int"))
    got = {r["feature"]: r for r in selection.shadow_selection(df, "id", ["x", "noise"], "target", perc=100, alpha=0.3, rounds=4, trees=5, max_depth=3).collect()}
    assert got["x"]["hits"] >= got["noise"]["hits"] and got["x"]["decision"] != "rejected"


def project(sf, kind):
    def source(spark):
        return I.sources(spark, sf)

    def goal(spark, month):
        cards = I.external_cards(spark, sf)
        t = campaign.customer_target(cards)
        return t if kind == "regression" else t.withColumn("target", (F.col("target") >= 10).cast("int"))

    return flows.Project(
        model_name=f"demo-{kind}",
        kind=kind,
        key=campaign.KEY,
        audience=lambda spark, m: campaign.active_customers(source(spark), I.RULES),
        features=lambda spark, m: campaign.customer_scoring_base(source(spark), I.RULES, m),
        target=goal,
        categories=campaign.CATEGORIES,
        numbers=["LOYALTY_LVL", "SALDO_EM_CONTA30", "TPN_SELLER30", "TPV_FUNDER60", "SHOWNS_OPF"],
        scoring_base=(lambda spark, m: campaign.customer_scoring_base(source(spark), I.RULES, m)) if kind == "regression" else None,
        model_params=TREES,
    )


@pytest.mark.parametrize("kind", ["classification", "regression"])
def test_the_three_flows(spark, sf, kind):
    p = project(sf, kind)
    base, models = work_path(spark, "stages"), work_path(spark, "models")
    trained = flows.train(spark, p, "199807", "r1", base, models)
    assert trained.report.count() >= 1 and 0 <= abs(trained.metric.first()[0]) <= 1
    facts = {(r["stage"], r["key"]): r["value"] for r in trained.metadata.collect()}
    assert int(facts["train", "rows"]) < int(facts["dataset", "rows"])
    scores = flows.score(spark, p, trained.model, "199807", "r2", "r1", base)
    first = scores.first()
    assert first["SAFRA"] == date(1998, 8, 1) and first["DT_TRAIN"] == "r1"
    stored_at = work_path(spark, "evaluations")
    for _ in range(2):
        table = flows.evaluate(spark, p, scores, "199807", "r3", base, target=stored_at)
    result = table.collect()
    assert spark.read.parquet(stored_at).drop("append_run").exceptAll(table).isEmpty() and spark.read.parquet(stored_at).count() == len(result)
    assert result and all(r["DT_TRAIN"] == "r1" and r["SAFRA"] == date(1998, 8, 1) for r in result)
    if kind == "classification":
        assert len(result) == 10 and sum(r["PUBLICO"] for r in result) == scores.count()
        champions = spark.createDataFrame([], "MODEL_NAME string, DT_TRAIN string, METRIC int, SAFRA date")
        named = work_path(spark, "champions")
        assert flows.challenge(p, champions, trained.metric, "199807", "r1", target=named).first()["accepted"]
        assert [r["DT_TRAIN"] for r in spark.read.parquet(named).collect()] == ["r1"]


def test_a_tuned_and_thresholded_model_is_chosen_loaded_and_its_scores_appended(spark, sf):
    p = replace(project(sf, "classification"), space={"maxDepth": ("categorical", [1, 2])}, trials=2, threshold=True, unbalanced=True, scale=True)
    base, models, target = (work_path(spark, x) for x in ("stages", "models", "scores"))
    trained = flows.train(spark, p, "199807", "r1", base, models)
    assert trained.trials.count() == 2
    low = trained.model.stages[-1].getOrDefault("threshold")
    rows = trained.model.transform(flows.build_training_set(spark, p, "199807")).select("prediction", vector_to_array("probability")[1].alias("p1"))
    assert 0 < low < 1 and rows.where((F.col("p1") >= low) != (F.col("prediction") == 1)).count() == 0
    registry = spark.createDataFrame([(p.model_name, "r1", 60, date(1998, 7, 1))], "MODEL_NAME string, DT_TRAIN string, METRIC int, SAFRA date")
    table = flows.score_selected(spark, p, registry, None, models, "199807", "r2", base, target)
    assert spark.read.parquet(target).count() == table.count() > 0 and table.first()["DT_TRAIN"] == "r1"
    with pytest.raises(LookupError):
        flows.score_selected(spark, p, registry.limit(0), None, models, "199807", "r2", base)


def test_regression_bins_of_ranks_in_the_flows(spark, sf):
    p = replace(project(sf, "regression"), bin_on="rank", edges=(0, 5, 10, 20))
    base, models = work_path(spark, "stages"), work_path(spark, "models")
    trained = flows.train(spark, p, "199807", "r1", base, models)
    scores = flows.score(spark, p, trained.model, "199807", "r2", "r1", base)
    assert {r["DECIL"]: r["count"] for r in scores.groupBy("DECIL").count().collect() if r["DECIL"]} == {1: 5, 2: 5, 3: 10}
    assert flows.evaluate(spark, p, scores, "199807", "r3", base).count() > 0


def test_worker_functions_need_no_package(tmp_path):
    """Python workers may not have this package on their path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = tmp_path / "f.pkl"
    blob.write_bytes(cloudpickle.dumps(resampling._best_in_chunk(1)))
    code = (
        f"import pickle, pandas as pd; f = pickle.load(open({str(blob)!r}, 'rb'));"
        "l = pd.DataFrame({'__id': [1], '__vec': [[0.0]]}); r = pd.DataFrame({'__cid': [2], '__cvec': [[3.0]]});"
        "print(f(l, r)['__d'].iloc[0])"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd="/", env={"PATH": "/usr/bin:/bin"})
    assert out.stdout.strip() == "3.0", out.stderr


def pooled(rows):
    """Adjacent violators of (score, y, w), one row at a time."""
    blocks = []
    for s, y, w in sorted(rows):
        blocks.append([s, s, y * w, w])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            _, high, y_, w_ = blocks.pop()
            blocks[-1][1:] = [high, blocks[-1][2] + y_, blocks[-1][3] + w_]
    return [(low, high, y / w, w) for low, high, y, w in blocks]


@pytest.mark.parametrize("levels", [3, 400])
def test_isotonic_blocks_equal_pooling_row_by_row(spark, monkeypatch, levels):
    """Ranges of a few scores each, merged two at a time."""
    from tidemark.operators import ranking, stages

    monkeypatch.setattr(ranking, "BUCKET_ROWS", 5)
    monkeypatch.setattr(stages, "MERGED", 2)
    df = spark.range(3000).select((F.hash("id") % levels).cast("double").alias("s"), (F.rand(5) < 0.5 + (F.hash("id") % levels) / (3 * levels)).cast("int").alias("y")).persist()
    got = sorted(tuple(r) for r in stages.isotonic_blocks(df, "s", F.col("y")).collect())
    means = [(r.s, r.m, float(r.n)) for r in df.groupBy("s").agg(F.avg("y").alias("m"), F.count("*").alias("n")).collect()]
    want = pooled(means)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-9 and g[3] == w[3] for g, w in zip(got, want))


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibrated_model_is_saved_with_its_threshold(spark, sf, method):
    p = replace(project(sf, "classification"), calibration=method, threshold=True)
    base, models = work_path(spark, "stages"), work_path(spark, "models")
    trained = flows.train(spark, p, "199807", "r1", base, models)
    rows = flows.build_training_set(spark, p, "199807")
    read = flows.PipelineModel.load(trained.path)
    low = read.stages[-1].getOrDefault("threshold")
    cols = (p.key, "prediction", vector_to_array("probability")[1].alias("p1"))
    before, after = (sorted(tuple(r) for r in m.transform(rows).select(*cols).collect()) for m in (trained.model, read))
    assert before == after and all((q >= low) == (c == 1.0) and 0 <= q <= 1 for _, c, q in after)
    # The calibrated probability never falls as the model's own rises.
    own = PipelineModel(stages=read.stages[:-1]).transform(rows).select(p.key, vector_to_array("probability")[1]).collect()
    at = {k: q for k, _, q in after}
    ordered = [at[k] for k, _ in sorted(map(tuple, own), key=lambda r: r[1])]
    assert all(x <= y + 1e-12 for x, y in zip(ordered, ordered[1:]))


def test_many_categories_are_encoded_and_saved_as_a_table(spark):
    from tidemark.operators import prep

    df = spark.range(60000).select(F.concat(F.lit("c'`"), (F.col("id") % 20000).cast("string")).alias("cat"), (F.col("id") % 7 == 0).cast("int").alias("target"), F.col("id").cast("double").alias("x"), F.col("id"))
    model = prep.fit_prep(df, ["cat"], ["x"], "target", smoothing=2.0)
    path = work_path(spark, "prep")
    model.write().overwrite().save(path)
    new = df.union(spark.createDataFrame([("new", 0, 1.0, -1), (None, 0, 2.0, -2)], df.schema))
    got = {r.id: r.features for r in PipelineModel.load(path).transform(new).select("id", "features").collect()}
    prior = df.agg(F.avg("target")).first()[0]
    want = {r.c: r.e for r in df.groupBy("cat").agg(F.max(F.col("id") % 20000).alias("c"), ((F.sum("target") + 2.0 * prior) / (F.count("*") + 2.0)).alias("e")).collect()}
    assert len(got) == 60002 and all(abs(got[i][0] - want[i % 20000]) < 1e-12 and got[i][1] == i for i in range(60000))
    assert got[-1][0] == got[-2][0] == prior


def test_work_scopes_remove_what_was_stored_also_after_an_error(spark, sf):
    import os

    from tidemark import session
    from tidemark.sources.datasets import materialize

    folder = f"{session.checkpoint_dir(spark)}/tidemark"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(ZeroDivisionError), session.work_scope(spark):
        held = materialize(lambda: spark.range(50).toDF("id"), spark, "", "199807", "while_execution")
        assert session.stored(held, "inner").count() == 50 and spark.sparkContext._jsc.getPersistentRDDs().size() == cached + 1
        with session.work_scope(spark):
            training.fit_calibration(spark.range(40).select((F.col("id") % 7).cast("double").alias("s"), (F.col("id") % 2).alias("y")), "s", "y", "isotonic")
            assert len(set(os.listdir(folder)) - before) > 1
        assert len(set(os.listdir(folder)) - before) == 1
        raise ZeroDivisionError
    assert set(os.listdir(folder)) == before and spark.sparkContext._jsc.getPersistentRDDs().size() == cached
