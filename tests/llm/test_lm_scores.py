import math
import random
from collections import Counter

import pytest

from tidemark.llm import lm_scores as L


def brute(rows, order=L.ORDER, backoff=L.BACKOFF, least=L.LEAST):
    counts = Counter(t[i : i + n] for _, t in rows for n in range(1, order + 1) for i in range(len(t or "") - n + 1))
    total = sum(c for g, c in counts.items() if len(g) == 1)
    out = []
    for id, t in rows:
        score = 0.0
        for i in range(len(t or "")):
            n = min(order, i + 1)
            while n > 1 and counts[t[i - n + 1 : i + 1]] < least:
                score += math.log(backoff)
                n -= 1
            gram = t[i - n + 1 : i + 1]
            score += math.log(counts[gram] / (counts[gram[:-1]] if n > 1 else total))
        out.append((str(id), len(t or ""), score))
    return sorted(out)


def agree(got, rows):
    got = sorted((str(r[0]), r[1], r[2]) for r in got)
    want = brute(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(g[2] == pytest.approx(w[2], abs=1e-3) for g, w in zip(got, want))


def test_scores(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("aabbc é🙂") for _ in range(rng.randrange(80)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x"), (103, "aab" * 5000), (103, "aab" * 5000), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, h int, block int")
    monkeypatch.setattr(L, "HELD_CHARS", 300)
    for block_chars in (500, 10**7):
        agree(L.scores(docs, block_chars=block_chars).collect(), rows)
    assert L.scores(docs.limit(0)).count() == 0


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    agree(L.op7_lm_scores(spark, sf).collect(), rows)


def test_sql(spark, sf):
    from compare import connect, differences

    con = connect(sf)
    assert differences(L.op7_lm_scores(spark, sf), con, L.ORACLE_SQL["op7_lm_scores"]) == []
