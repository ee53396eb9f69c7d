import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as M


def test_rates_meet_the_targets(spark, sf):
    rows = M.op6_mixing(spark, sf).toPandas()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and rows.rate.between(0, M.MOST).all()
    p = rows[[f"p_{d}" for d in M.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1, atol=1e-9)
    share = (p * (rows.n_tokens * rows.rate).to_numpy()[:, None]).sum(axis=0) / rows.n_tokens.sum()
    assert np.allclose(share, M.WEIGHTS, atol=1e-5)
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(rows, on="doc_id")
    own = np.where(labels.toxic > 0, 2, np.where(labels.quality <= 0, 1, 0))
    assert (labels[[f"p_{d}" for d in M.DOMAINS]].to_numpy().argmax(axis=1) == own).mean() > 0.9


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = M.with_posteriors(docs, labels.filter("doc_id % 3 <> 0")).select("doc_id", "mix.p").toPandas()
    rest = labels.filter("doc_id % 3 = 0").toPandas().merge(out, on="doc_id")
    own = np.where(rest.toxic > 0, 2, np.where(rest.quality <= 0, 1, 0))
    assert (np.stack(rest.p).argmax(axis=1) == own).mean() > 0.75


def problem(spark, concentration, seed=3, size=400):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet(concentration, size)
    parts = np.round(1000 * p[:, :2]).astype(int)
    parts[:, 1] = np.minimum(parts[:, 1], 1000 - parts[:, 0])
    parts = np.column_stack([parts, 1000 - parts.sum(axis=1)])
    tokens = rng.integers(0, 500, size)
    tokens[0] = 60_000  # one text with half of all tokens
    df = spark.createDataFrame([(i, {"tokens": int(t), "p": [int(x) for x in q]}) for i, (t, q) in enumerate(zip(tokens, parts))], "id int, mix struct<tokens:long,p:array<int>>")
    return df, tokens.astype(float), parts / 1000


def missing(tokens, p, target, most, rounds=20_000):
    """By how much the totals miss the targets after very many plain steps, one rate a document."""
    inverse = M.metric((p * tokens[:, None]).T @ p)
    r = np.ones(len(tokens))
    for _ in range(rounds):
        new = np.clip(r - p @ (inverse @ ((p * (tokens * r)[:, None]).sum(axis=0) - target)), 0, most)
        if np.abs(new - r).max() < 1e-12:
            break
        r = new
    return ((p * (tokens * r)[:, None]).sum(axis=0) - target) / target.sum()


@pytest.mark.parametrize(
    "concentration,weights,most",
    [((0.3, 0.2, 0.2), (0.93, 0.02, 0.05), 4.0), ((0.3, 0.2, 0.2), (0.2, 0.2, 0.6), 4.0), ((0.3, 0.2, 0.2), (1.0, 0.0, 0.0), 1.5), ((5, 0.05, 0.5), (0.2, 0.2, 0.6), 4.0)],
)
def test_steps_end_where_plain_projected_gradient_ends(spark, concentration, weights, most):
    df, tokens, p = problem(spark, concentration)
    got = M.fitted_rates(df, weights=weights, most=most)
    rate = np.array([r.rate for r in got.joined(df, "mix", "rate").orderBy("id").collect()])
    assert rate.min() >= 0 and rate.max() <= most and got.steps < M.STEPS
    target = np.array(weights) * tokens.sum()
    here = ((p * (tokens * rate)[:, None]).sum(axis=0) - target) / tokens.sum()
    assert np.allclose(here, got.missing, atol=1e-6)
    # The distance that is made least, in its own metric, is as small as the plain steps get it.
    inverse = M.metric((p * tokens[:, None]).T @ p) * tokens.sum()
    far = missing(tokens, p, target, most)
    assert here @ inverse @ here <= (1 + 2.1 * M.SETTLED) * (far @ inverse @ far) + 1e-6


def test_layout_does_not_show(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    first, *others = (sorted((r.doc_id, r.text) for r in M.mixed(d, labels).select("doc_id", "text").collect()) for d in (docs, docs.repartition(7, "lang", "n_chars"), docs.orderBy(F.desc("n_chars")).coalesce(1)))
    assert all(o == first for o in others)
    drawn = M.mixed(docs, labels).groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert drawn <= M.MOST


def test_a_kept_domain_keeps_its_tokens(spark):
    df, tokens, p = problem(spark, (2, 0.2, 0.4))
    got = M.fitted_rates(df, weights=(0.9, 0.05, 0.05), keep=0).joined(df, "mix", "rate").orderBy("id").toPandas()
    total = (p * (tokens * got.rate.to_numpy())[:, None]).sum(axis=0)
    assert np.allclose(total, (p[:, 0] * tokens).sum() * np.array([1, 0.05 / 0.9, 0.05 / 0.9]), rtol=1e-3)


def test_edge_cases(spark):
    rows = [(1, None, "a", "x"), (2, "", "b", "x"), (3, "w " * 300_000, "c", "x"), (4, "some plain words here", "d", "x"), (4, "some plain words here", "d", "x"), (None, "no id at all", "e", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mix string, __words string")
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1), (99, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    two = spark.createDataFrame([(4, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (nothing, odd, two):
        out = M.mixed(docs, labels)
        assert out.columns == docs.columns and {r[3] for r in out.collect()} <= {"x"}
        found = M.with_posteriors(docs, labels, into="m").collect()
        assert len(found) == len(rows) and all(sum(r.m.p) == 1000 for r in found)
        assert {r.doc_id: r.m.tokens for r in found} == {1: 0, 2: 0, 3: 300_000, 4: 4, None: 4}
    assert M.mixed(docs.limit(0), odd).count() == 0
    assert M.fitted_rates(spark.createDataFrame([({"tokens": 0, "p": [1000, 0, 0]},)], "mix struct<tokens:long,p:array<int>>")).cells.first().rate == 1.0


def test_a_domain_that_hardly_occurs_does_not_blow_up_the_others(spark):
    rows = [({"tokens": 100, "p": [990, 1, 9] if i % 10 else [40, 1, 959]},) for i in range(2000)]
    df = spark.createDataFrame(rows, "mix struct<tokens:long,p:array<int>>")
    got = M.fitted_rates(df, weights=(0.93, 0.02, 0.05), keep=0)
    total, at_most = got.joined(df, "mix", "rate").agg(F.sum("rate"), F.max("rate")).first()
    assert 1700 < total < 2100 and at_most < 1.2
    assert abs(got.missing[0]) < 0.01 and got.missing[1] < -0.015 and abs(got.missing[2]) < 0.01
