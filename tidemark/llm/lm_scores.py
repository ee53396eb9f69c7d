"""Language-model scores of documents by stupid backoff, as joins of n-gram tables.

The model counts all n-grams of code points, of every order up to ORDER, over all documents. A
position scores count(n-gram) / count(its first n - 1) for the longest n-gram ending there that occurs at
least LEAST times; every order given up costs a factor BACKOFF; a single character scores its share of
all characters, however rare. A document's score is the sum of the logarithms over its positions.

Documents are dealt into blocks of bounded size. A block counts its n-grams before anything is
shuffled, so an n-gram that every document has is one row per block. These rows are partitioned by
hash, summed into the count table, joined to it, and meet their block's texts again, where they are
summed per document. What is gathered grows with the number of blocks, that is with the input, and no
task sees more than one block or one hash partition.

N-grams are told apart by 64-bit hashes. Null and empty texts have no positions and score 0.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4
BACKOFF = 0.4
LEAST = 5
BLOCK_CHARS = 12_000_000
HELD_CHARS = 1_000_000


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n from 1 to ``order``, the hashes of the n-grams that start at each place."""
    out = []
    total = np.zeros(len(codes), np.uint64)
    for n in range(1, order + 1):
        if n > len(codes):
            break
        total = total[: len(codes) - n + 1]
        total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        out.append(total)
    return out


def _final(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, and the sums of their counts."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.empty(0, np.int64)
    return hashes[starts], np.add.reduceat(counts[order], starts) if len(hashes) else counts


def _counted(texts: list[str], order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, distinct hashes, counts) of some texts' n-grams."""
    parts: list[list[np.ndarray]] = [[] for _ in range(order)]
    for text in texts:
        for n, hashes in enumerate(gram_hashes(_codes(text), order)):
            parts[n].append(hashes)
    for n in range(order):
        if parts[n]:
            joined = np.sort(_final(np.concatenate(parts[n])))
            parts[n] = []
            starts = np.flatnonzero(np.r_[True, joined[1:] != joined[:-1]])
            yield n + 1, joined[starts], np.diff(np.r_[starts, len(joined)])


def _some(texts: pa.ChunkedArray, chars: int) -> Iterator[list[str]]:
    """The texts, about ``chars`` characters at a time."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counter(order: int) -> Callable:
    """A block's texts (block, body) to its n-gram counts (block, n, h, c).

    The n-grams of some texts are held at a time, and the counts of all.
    """

    def run(texts: pa.Table) -> pa.Table:
        block = texts.column("block")[0].as_py()
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order)]
        for some in _some(texts.column("body"), HELD_CHARS):
            for n, hashes, counts in _counted(some, order):
                found[n - 1].append((hashes, counts))
        rows = [(n + 1, *_summed(*map(np.concatenate, zip(*parts)))) for n, parts in enumerate(found) if parts]
        size = sum(len(h) for _, h, _ in rows)
        return pa.table(
            {
                "block": pa.array(np.full(size, block), pa.int64()),
                "n": pa.array(np.concatenate([np.full(len(h), n) for n, h, _ in rows]) if rows else [], pa.int32()),
                "h": pa.array(np.concatenate([h for _, h, _ in rows]) if rows else [], pa.int64()),
                "c": pa.array(np.concatenate([c for _, _, c in rows]) if rows else [], pa.int64()),
            }
        )

    return run


def _scorer(order: int, backoff: float, least: int, total: int) -> Callable:
    def run(texts: pa.Table, grams: pa.Table) -> pa.Table:
        table = []
        n_of, h_of, c_of = (grams.column(c).to_numpy() for c in ("n", "h", "total"))
        for n in range(1, order + 1):
            mine = n_of == n
            sort = np.argsort(h_of[mine])
            table.append((h_of[mine][sort], c_of[mine][sort]))
        positions, scores = [], []
        for text in texts.column("body").to_pylist():
            codes = _codes(text)
            size = len(codes)
            # counts[n][i]: occurrences of the n-gram that starts at i.
            counts = [c[np.searchsorted(h, _final(x))] for (h, c), x in zip(table, gram_hashes(codes, order))]
            log = np.log(counts[0]) - math.log(total) if size else np.zeros(0)
            longest = np.zeros(size, np.int64)
            for n in range(2, min(order, size) + 1):
                seen = np.flatnonzero(counts[n - 1] >= least)
                log[seen + n - 1] = np.log(counts[n - 1][seen]) - np.log(counts[n - 2][seen])
                longest[seen + n - 1] = n - 1
            given_up = np.minimum(np.arange(size), order - 1) - longest
            positions.append(size)
            scores.append(float(log.sum() + given_up.sum() * math.log(backoff)))
        ids = texts.column("id").combine_chunks() if texts.num_rows else pa.array([], pa.int64())
        return pa.table({"id": ids, "n_positions": pa.array(positions, pa.int64()), "log_score": pa.array(scores, pa.float64())})

    return run


def scores(
    docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF, least: int = LEAST, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The id, the number of positions and the log score of every row; rows stay as they are."""
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    chars = source.agg(F.sum(F.char_length("body")).alias("n")).first()["n"] or 0
    blocks = chars // block_chars + 1
    dealt = source.withColumn("block", F.pmod(F.xxhash64("id", "body"), F.lit(blocks)))
    own = dealt.groupBy("block").applyInArrow(_counter(order), "block long, n int, h long, c long")
    own = stored(own, "block-grams")
    counts = stored(own.groupBy("n", "h").agg(F.sum("c").alias("total")), "grams")
    joined = own.select("block", "n", "h").join(counts, ["n", "h"])
    out = dealt.groupBy("block").cogroup(joined.groupBy("block")).applyInArrow(_scorer(order, backoff, least, chars), "id long, n_positions long, log_score double")
    return out.withColumnRenamed("id", id)


def op7_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    out = scores(spark.read.parquet(f"{sf}/documents.parquet"))
    return out.select("doc_id", "n_positions", F.round("log_score", 3).alias("log_score"))


QUERIES = {"op7_lm_scores": op7_lm_scores}

ORACLE_SQL = {
    "op7_lm_scores": """
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
place AS (SELECT doc_id, t, unnest(range(1, length(t) + 1)) AS i FROM doc),
gram AS (
  SELECT doc_id, i, n, substring(t, (i - n + 1)::BIGINT, n::BIGINT) AS g
  FROM place, (SELECT unnest(range(1, 5)) AS n) WHERE i >= n),
counted AS (SELECT g, length(g) AS n, count(*) AS c FROM gram GROUP BY g),
total AS (SELECT sum(c) AS c FROM counted WHERE n = 1),
best AS (
  SELECT x.doc_id, x.i, max(x.n) AS n
  FROM gram x JOIN counted k ON k.g = x.g WHERE x.n = 1 OR k.c >= 5 GROUP BY x.doc_id, x.i),
scored AS (
  SELECT b.doc_id,
    CASE WHEN b.n = 1 THEN ln(k.c::DOUBLE) - ln(total.c::DOUBLE) ELSE ln(k.c::DOUBLE) - ln(p.c::DOUBLE) END
      + (least(b.i - 1, 3) - (b.n - 1)) * ln(0.4::DOUBLE) AS s
  FROM best b JOIN gram x ON x.doc_id = b.doc_id AND x.i = b.i AND x.n = b.n
  JOIN counted k ON k.g = x.g LEFT JOIN counted p ON p.g = left(x.g, b.n - 1), total)
SELECT doc.doc_id, length(doc.t)::BIGINT AS n_positions, round(coalesce(sum(s), 0), 3) AS log_score
FROM doc LEFT JOIN scored USING (doc_id) GROUP BY doc.doc_id, doc.t
"""
}
