import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe

VOCAB = bpe.vocabulary()
CODER = bpe.Coder(VOCAB)
PIECES = ["a", "aaaa", "the", " the", "  ", "\n", "\n\n", "'", "''", "'s", "'ll", "l", "é", "東京", "🙂", "1", "234", "!!", "<|endoftext|>", "<|end", "x" * 40, "　", "\t "]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(VOCAB)


def expected(library, text):
    return library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40), st.integers(1, 13))
def test_tree_gives_the_encoding_of_the_whole(parts, size):
    from tokenizers import Tokenizer

    library = test_tree_gives_the_encoding_of_the_whole.__dict__.setdefault("library", Tokenizer.from_str(VOCAB))
    text = "".join(parts)
    leaves = [CODER.leaf(x) for x in CODER.cut(text, size)]
    assert CODER.tree(leaves) == expected(library, text)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3001, "'" * 999 + "s", "ab" * 3000, "é" * 2000, "ha" * 999 + "\n" * 501, "0" * 4097])
def test_long_unsplit_runs(library, text):
    for size in (100, 777):
        assert CODER.tree([CODER.leaf(x) for x in CODER.cut(text, size)]) == expected(library, text)


def test_random_letters_without_spaces(library):
    rng = random.Random(5)
    text = "".join(rng.choice("etaoinshrdlu'") for _ in range(20_000))
    assert CODER.tree([CODER.leaf(x) for x in CODER.cut(text, 512)]) == expected(library, text)


ROWS = [(1, "plain text, isn't it?"), (2, None), (3, ""), (4, "z" * 900 + " end<|endoftext|>" + "q" * 700), (4, "z" * 900 + " end<|endoftext|>" + "q" * 700), (None, "é" * 500)]


def test_encode_digests_and_decode(spark, library):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted(map(str, bpe.encode_digests(docs, leaf_chars=200).collect()))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for key, text in ROWS:
        ids = expected(library, text or "")
        want.append((key, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(f"Row(doc_id={k}, n_tokens={n}, ids_sha256='{a}', decoded_sha256='{b}')" for k, n, a, b in want)
    back = bpe.decode(bpe.encode(docs, leaf_chars=200))
    assert sorted(map(str, back.collect())) == sorted(f"Row(doc_id={k}, text={(t or '')!r})" for k, t in ROWS)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_digests(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b", "x", 7, "k")], "doc_id long, text string, key string, ids int, body string")
    row = bpe.encode(docs).first()
    assert (row["key"], row["body"], row["ids"]) == ("x", "k", CODER.leaf("a b"))


def test_query_matches_the_library(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = bpe.op1_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = expected(library, texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
