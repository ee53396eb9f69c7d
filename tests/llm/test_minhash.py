import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import minhash as M
from tidemark.llm.graph import components


def sets_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", lower) if x]
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent=85):
    """Components over all pairs that share a shingle."""
    sets = {i: sets_of(t) for i, t in rows}
    where, up = defaultdict(list), {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        for j in {j for x in s for j in where[x] if j > i}:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def agree(rows, got):
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_query_matches_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    agree(docs, M.op9_minhash(spark, sf).collect())


def test_groups_chains_and_edges(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(0, None), (1, ""), (2, "one two"), (3, "ONE\ttwo"), (4, "one two three"), (5, " \n ")]
    base = [word() for _ in range(150)]
    n = 10
    for edits in [0, 1, 1, 1, 2, 2, 2, 3, 3, 4, 5, 9] * 6:  # one base and copies at many distances
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = word()
        rows.append((n, " ".join(copy)))
        n += 1
    chain = [word() for _ in range(200)]
    for _ in range(25):  # each a little further from the one before
        chain = chain[3:] + [word() for _ in range(3)]
        rows.append((1000 - n, " ".join(chain)))
        n += 1
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, n int, key string")
    agree(rows, M.near_duplicates(docs).collect())
    left = M.keep_first(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {c for _, c in brute(rows).values()}


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.near_duplicates(empty).count() == 0
    text = "a b c d e f g"
    docs = spark.createDataFrame([(None, text), (7, text), (7, text), (9, text.upper())], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs).collect())
    assert got == [("7", 3, 7, True), ("7", 3, 7, True), ("9", 3, 7, False), ("None", 3, None, True)]


def test_one_id_with_several_texts(spark):
    """Links of all texts of an id count, in any order of the rows; one id may have most of the rows."""
    rng = random.Random(8)
    base = lambda: [f"w{rng.random()}" for _ in range(60)]
    near = lambda words: [*words[:-1], f"w{rng.random()}"]
    a, b, c, d = base(), base(), base(), base()
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (5, c), (4, c), (4, d), (6, near(d)), (9, base())]
    rows += [(20, base()) for _ in range(30)] + [(20, near(a))]
    rows += [(21, rows[-2][1])]
    rows = [(i, " ".join(t)) for i, t in rows]
    want = {1: 1, 2: 1, 3: 1, 20: 1, 21: 1, 4: 4, 5: 4, 6: 4, 9: 9}
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, __gone int")
        got = M.near_duplicates(docs).collect()
        assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == want
        assert all(r.n_shingles == 56 and r.kept == (r.doc_id in (1, 4, 9)) for r in got)
        left = M.keep_first(docs)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 1, 4, 4, 9]


def test_signature_estimates_similarity():
    a = M.shingles(" ".join(f"w{i}" for i in range(800)), 5)
    b = M.shingles(" ".join(f"w{i}" for i in range(200, 1000)), 5)
    common = len(np.intersect1d(a, b))
    share = (M.signature(a, 2000) == M.signature(b, 2000)).mean()
    assert abs(share - common / (len(a) + len(b) - common)) < 0.06


@pytest.mark.parametrize("n", [2, 50])
def test_components_of_a_chain(spark, n):
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(500, 501), (501, 500)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 500: 500, 501: 500}
