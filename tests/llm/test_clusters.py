import hashlib

import numpy as np
import pytest

from compare import connect, differences
from tidemark.llm import clusters as C


def plain(rows, dims, k, rounds):
    """Every vector against every centroid."""
    kept = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    x = np.stack([v for _, v in kept])
    order = sorted(range(len(kept)), key=lambda j: (hashlib.sha256(f"2:{'null' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest(), kept[j][1].tolist()))
    c = x[order[:k]].copy()
    for n in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        who = d.argmin(axis=1)
        if n < rounds:
            for j in set(who.tolist()):
                c[j] = [sum(map(int, x[who == j, m])) // int((who == j).sum()) for m in range(dims)]
    best = d.min(axis=1)
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c.tolist()]
    return sorted(
        ((i, int(w), int(b), int(best[who == w].sum()), int(best.sum()), digest[w]) for (i, _), w, b in zip(kept, who, best)), key=lambda r: (r[0] is None, r[0] or 0, r[1:])
    )


def found(df, **how):
    return sorted((tuple(r) for r in C.clusters(df, **how).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("dims,k,spread", [(1, 5, 3), (3, 7, 2), (8, 40, 100), (64, 40, 2000)])
def test_nearest_equals_all_distances(dims, k, spread):
    rng = np.random.default_rng(dims)
    c = rng.integers(-spread, spread, (k, dims))
    c[-1] = c[0]  # a tie everywhere
    x = np.concatenate([rng.integers(-2 * spread, 2 * spread, (300, dims)), c])
    who, best, counted = C.Lists(c).nearest(x)
    d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (who == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert counted <= d.size


def test_walks_stop_early():
    rng = np.random.default_rng(1)
    c = rng.integers(-10_000, 10_000, (200, 2))
    x = c[rng.integers(0, 200, 500)] + rng.integers(-20, 20, (500, 2))
    _, best, counted = C.Lists(c).nearest(x)
    assert counted < 0.1 * len(x) * len(c)
    assert (best == ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1)).all()


def test_against_plain_rounds(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(0, 1, 6)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[3][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 5 + [None]), (2004, [float("nan")] * 6), (2005, [float("inf")] * 6), (2006, [-0.001] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for k, rounds in ((9, 4), (1, 1), (400, 2)):
        assert found(df, dims=6, k=k, rounds=rounds) == plain(rows, 6, k, rounds)


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0], 3, "v"), (2, [0.5, 1.0], 3, "w")], "vec_id long, embedding array<double>, cluster int, v string")
    assert [r[:5] for r in found(df, dims=2)] == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0)]
    assert found(df, dims=3) == [] and found(df.limit(0), dims=2) == []
    with pytest.raises(Exception, match="after scaling"):
        found(spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>"), dims=1)


def test_query(spark, sf):
    assert not differences(C.op13_centroids(spark, sf), connect(sf), C.ORACLE_SQL["op13_centroids"])
