import hashlib
import random
from collections import Counter

import numpy as np

from tidemark.llm import order_minhash as O

S = O.Sketcher(O.K, O.COORDINATES, O.TUPLE)


def slow_sketch(text, k=O.K, size=O.TUPLE):
    """The method by the letter: number the k-mers, sort by each hash, restore the order."""
    if not text:
        return None
    parts = [text[i : i + k] for i in range(len(text) - k + 1)] or [text]
    seen, items = Counter(), []
    mix = lambda x: int(O._mixed(np.array([x & (1 << 64) - 1], np.uint64))[0])
    for place, part in enumerate(parts):
        kmer = int(O.kmers(part, len(part))[0])
        items.append((kmer, seen[kmer], place, mix(kmer + seen[kmer] * 0xA0761D6478BD642F)))
        seen[kmer] += 1
    items.sort()
    out = []
    for odd in S.odd[:, 0]:
        least = sorted(range(len(items)), key=lambda i: ((items[i][3] >> 32) * int(odd) & 0xFFFFFFFF, i))[:size]
        total = 0
        for i in sorted(least, key=lambda i: items[i][2]):
            total = mix(total * 0x9E3779B97F4A7C15 + items[i][3])
        out.append(total >> 16 & 0xFFFFFFFF)
    return out


def test_sketch_follows_the_method():
    rng = random.Random(4)
    texts = ["a", "abcdefg", "abcdefgh", "aaaaaaaaaaaaaaaa", "é🙂" * 30, "".join(rng.choice("ab") for _ in range(300))]
    texts.append("".join(rng.choice("abcdefghij ") for _ in range(O.BLOCK + 500)))
    for t in texts:
        assert list(S.sketch(t)) == slow_sketch(t)
    assert S.sketch("") is None


def test_long_texts_number_alike():
    rng = np.random.Generator(np.random.PCG64(1))
    hashes = rng.integers(0, 50, 5000, np.uint64)
    big = np.concatenate([hashes, rng.integers(1000, 1 << 43, 1 << O.PLACE_BITS, np.uint64)])
    a, b = O.numbered(hashes), O.numbered(big)
    assert (a[0] == b[0][:5000]).all() and (a[1] == b[1][:5000]).all()


def test_order_matters_and_edits_lower_likeness():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(5))
    words = [word() for _ in range(400)]
    base = S.sketch(" ".join(words))
    few = words[:100] + [word()] + words[101:]
    swapped = words[200:] + words[:200]
    near, moved, other = (O.likeness(base, S.sketch(" ".join(w))) for w in (few, swapped, [word() for _ in range(400)]))
    assert near > 0.8 and moved < near and other < 0.1


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    want = []
    for i, (id, text, _) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        new = O.edited(text, following)
        assert len(new) == len(text) - len(text) // 2 + min(len(text) // 2, len(following))
        a, b, c = S.sketch(text), S.sketch(new), S.sketch(following)
        want.append((str(id), len(text), hashlib.sha256(new.encode()).hexdigest(), O._hex(a), O._hex(b), O.likeness(a, b), O.likeness(a, c)))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def hashed(spark, rows):
    docs = spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, h int, body string")
    from pyspark.sql import functions as F

    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    return docs, [tuple(r) for r in keyed]


def test_next_rows(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(10**9), "".join(rng.choice("abc é") for _ in range(rng.randrange(60)))) for _ in range(300)]
    rows += [(None, "no id"), (5, None), (6, ""), (7, "twice"), (7, "twice"), (7, "other"), (8, "z" * 40_000)]
    docs, keyed = hashed(spark, rows)
    check(keyed, O.edit_fingerprints(docs).collect())
    assert O.edit_fingerprints(docs.limit(0)).count() == 0
    one = docs.filter("doc_id = 8")
    check([k for k in keyed if k[0] == 8], O.edit_fingerprints(one).collect())
    assert {r.fingerprint for r in O.fingerprints(docs).filter("doc_id = 7").collect()} == {O._hex(S.sketch("twice")), O._hex(S.sketch("other"))}


def test_query(spark, sf):
    rows = [(r.doc_id, r.text, 0) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, O.op10_order_minhash(spark, sf).collect())
