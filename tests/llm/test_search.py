import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import connect, differences
from tidemark.llm import search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    """Every document scored for every item, in Python integers."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    N, L = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = set()
    for i, wanted in asked.items():
        scored = []
        for d, c in counts:
            m = 50 + 50 * c.total() * N // L if L else 0
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out |= {(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(docs, items, **limits):
    return [(r.item_id, r.rank, r.doc_id, r.score) for r in S.search(docs, items, **limits).collect()]


@pytest.mark.parametrize("block_terms,postings", [(200_000, 2_000_000), (12, 300)])
def test_against_plain_scores(spark, monkeypatch, block_terms, postings):
    monkeypatch.setattr(S, "BLOCK_POSTINGS", postings)
    rng = random.Random(3)
    words = [rng.choice("abcdXYZéñ字0") + str(k) for k in range(300)]
    pick = lambda n: " ".join(words[min(299, int(rng.expovariate(0.03)))] for _ in range(n))
    docs = [(k, pick(rng.choice([0, 3, 20, 200]))) for k in range(600)]
    docs += [(1000 + k, docs[9][1]) for k in range(80)] + [(2000, None), (2001, "!? \x00"), (None, pick(30)), (None, docs[9][1])]
    items = [(k, pick(rng.choice([1, 8, 40]))) for k in range(25)] + [(30, None), (31, ""), (32, "nowhere-found"), (33, docs[9][1]), (3, "more a1 terms")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = found(d, i, k=7, block_terms=block_terms)
    assert len(got) == len(set(got)) and set(got) == plain(docs, items, 7)


def test_creation_stops_and_stays_exact():
    """Random postings: the best k equal those of a full scoring, and most documents never get an accumulator."""
    rng = np.random.default_rng(4)
    stopped = 0
    for trial in range(200):
        size, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        n = rng.integers(1, 60, size)
        df = [int(rng.integers(1, size + 1)) for _ in range(int(rng.integers(1, 12)))]
        doc = np.concatenate([rng.choice(size, x, replace=False) for x in df])
        term = np.repeat(np.arange(len(df)), df)
        order = np.argsort(doc, kind="stable")
        doc, term = doc[order], term[order]
        tf = rng.integers(1, 4, len(doc))
        weights = np.array([math.floor(1000 * math.log((2 * size + 2) / (2 * x + 1))) for x in df], np.int64)
        index = S.Index(n, doc, term, tf, weights, size, int(n.sum()))
        whole = np.bincount(doc, S.contributions(tf, n[doc], weights[term], size, int(n.sum())), size).astype(np.int64)
        got, scores = index.best(sorted(range(len(df)), key=lambda t: df[t]), k, 0)
        assert (whole[got] == scores).all()
        best = np.lexsort((np.arange(size), -whole))[:k]
        best = best[whole[best] > 0]
        assert set(best) <= set(got)
        stopped += (index.score > 0).sum() < (whole > 0).sum()
    assert stopped > 50


def test_terms_of_texts(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 7)
    texts = ["", "A-b_C", "Éa É a b", "x" * 100 + " " + "y " * 50, "\x00\x1f1\x7f2", "ÀB İ 𝄞", "字字 字"]
    for text in texts:
        assert {t.decode(): c for t, c in S.term_counts(text).items()} == Counter(terms(text))


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "Alpha beta", "z", 1), (1, "Alpha beta", "z", 1), (2, "beta " * 300_000, "z", 1), (3, None, "z", 1)], "doc_id long, text string, term string, score int")
    items = spark.createDataFrame([(1, "alpha", 5), (None, "BETA", 5)], "item_id long, text string, rank int")
    got = found(docs, items)
    assert set(got) == plain([tuple(r)[:2] for r in docs.collect()], [tuple(r)[:2] for r in items.collect()], 50) and len(got) == 5
    assert found(docs.limit(0), items) == [] and found(docs, items.limit(0)) == []
    assert S.contributions(np.array([2]), np.array([10**7]), np.array([5]), 10**13, 10**19).tolist() == [5 * (2 * 10**9 // (2000 + 20 * (50 + 50 * 10**7 * 10**13 // 10**19)))]


def test_query(spark, sf):
    assert not differences(S.op12_search(spark, sf), connect(sf), S.ORACLE_SQL["op12_search"])
