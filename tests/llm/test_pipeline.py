import hashlib
import random

import corpus_pipeline as C
from tidemark.llm import bpe


def test_stages_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    seen = [before]
    for name, stage in C.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen[0] > seen[1] >= seen[2] > seen[3] > 0
    out = C.STAGES[-1][1](spark, docs, sf).collect()
    assert len(out) == seen[-1]
    coder = bpe.Coder.of(bpe.vocabulary())
    texts = sorted(r.text for r in docs.collect())
    digest = lambda items: hashlib.sha256("\0".join(items).encode()).hexdigest()
    assert digest(sorted(coder.decode(r.ids) for r in out)) == digest(texts)
    assert all(r.n_tokens == len(r.ids) for r in out)
    # All of it once more, in one call.
    assert sorted((r.doc_id, tuple(r.ids)) for r in C.run(spark, sf).collect()) == sorted((r.doc_id, tuple(r.ids)) for r in out)


def test_near_dedup_takes_pairs_from_80_hundredths_on(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    sets = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    rows, near = [], 0
    for i in range(60):
        base = [word() for _ in range(240)]
        new = 18 + i % 12
        copy = base[:-new] + [word() for _ in range(new)]
        a, b = sets(base), sets(copy)
        near += 0.80 <= len(a & b) / len(a | b) < 0.85
        rows += [(2 * i, " ".join(base), len(a & b) / len(a | b)), (2 * i + 1, " ".join(copy), len(a & b) / len(a | b))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, likeness double")
    assert 20 < near < 60
    assert {r.doc_id for r in C.near_dedup(spark, docs, "").collect()} == {i for i, _, s in rows if i % 2 == 0 or s < 0.80}
