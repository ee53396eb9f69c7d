"""Ranked lexical search: accumulator-limited, term at a time.

Documents are cut into blocks that lie side by side in a task; each block is a small inverted index of
the searched terms. An item's terms are taken rarest first (by the number of documents in the whole
corpus). A document gets an accumulator the first time one of them occurs in it. As soon as the bounds of
the terms still to come add up to less than the kth best partial score, no document without an
accumulator can be among the best k: from then on only accumulators are updated, exactly, and those that
cannot reach the kth score any more are let go. Term bounds are the largest contributions in the block.
The k best of a task's blocks so far carry over, so later blocks stop creating accumulators earlier.
Each task gives k rows an item, and these are ranked in two steps, the first dealt out by document.

Counts over the corpus (documents, terms, documents with a term) come from all whole texts. Items are
a query set: they are taken in blocks of at most ``block_terms`` different terms (or one item), which is
what goes to every task; any number of items is searched, in as many passes as there are blocks.

Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII; A-Z are lower-cased.
Null and empty texts have no terms: such documents do not count and are not found, such items find
nothing. Every row of ``docs`` is a document: repeated rows are found as often as they occur. Equal
scores rank by ascending id, a null id first. Rows of one item id are one item with the terms of all.
Other columns are ignored, whatever their names. An empty table on either side gives no rows.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 50
BLOCK_TERMS = 200_000
BLOCK_POSTINGS = 2_000_000
PIECE = 1 << 20  # bytes of a text that are split at a time
NO_ID = -(1 << 63)

# Letters and digits stay (capitals as small letters), as does all beyond ASCII; the rest parts terms.
_FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def term_counts(text: str) -> Counter:
    """How often each term occurs in a text."""
    raw, found, at = text.encode("utf-8").translate(_FOLD), Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        found.update(raw[at:end].split())
        at = end
    return found


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(*(c.to_pylist() for c in batch.columns)):
            terms = list(term_counts(text))
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(terms), pa.int64()), pa.array(terms, pa.binary())], names=["item", "term"])


def _forward(vocabulary) -> Callable:
    """Of each document: its number of terms, and number and count of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                found = term_counts(text)
                n.append(found.total())
                shared = found.keys() & known.keys()
                terms.append([known[t] for t in shared])
                counts.append([found[t] for t in shared])
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "terms", "counts"])

    return run


def contributions(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """The exact integer scores of single terms in documents of ``n`` terms."""
    if len(n) and 50 * int(n.max()) * docs >= 1 << 63:
        m = np.array([50 + 50 * int(x) * docs // terms for x in n], np.int64)
    else:
        m = 50 + 50 * n * docs // terms
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


class Index:
    """The inverted index of a block of documents: postings by term, each in the order of documents."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, docs: int, terms: int):
        order = np.argsort(term, kind="stable")
        term, self.doc = term[order], doc[order]
        self.value = contributions(tf[order], n[self.doc], weights[term], docs, terms)
        held, starts = np.unique(term, return_index=True)
        self.at = dict(zip(held.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(term)])))
        self.bound = dict(zip(held.tolist(), np.maximum.reduceat(self.value, starts).tolist())) if len(held) else {}
        self.score = np.zeros(len(n), np.int64)

    def best(self, terms: list[int], k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the best ``k`` of all, and their exact scores.

        ``terms`` come rarest first; ``reach`` is the kth score known so far (0 if there is none).
        """
        terms = [t for t in terms if t in self.at]
        rest = sum(self.bound[t] for t in terms)
        score, passed, alive = self.score, 0, None
        score[:] = 0
        for t in terms:
            if alive is None and rest <= max(reach, passed):
                # A partial score reaches ``passed`` at most: below that there is nothing to look up.
                made = score[score > 0]
                if len(made) >= k:
                    reach = max(reach, int(np.partition(made, -k)[-k]))
                if rest < reach:
                    alive = np.flatnonzero((score > 0) & (score + rest >= reach))
            low, high = self.at[t]
            doc, value = self.doc[low:high], self.value[low:high]
            if alive is None:
                score[doc] += value
            elif len(alive):
                place = np.searchsorted(doc, alive)
                there = doc[np.minimum(place, len(doc) - 1)] == alive
                score[alive[there]] += value[place[there]]
            rest -= self.bound[t]
            passed += self.bound[t]
            if alive is not None and len(alive) > 4 * k:
                alive = alive[score[alive] + rest >= reach]
        found = np.flatnonzero(score > 0) if alive is None else alive
        found = found[score[found] >= max(1, reach)]
        if len(found) > k:
            found = found[score[found] >= np.partition(score[found], -k)[-k]]
        return found, score[found]


def _searcher(query, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, docs, terms = query.value
        none = np.empty(0, np.int64)
        best = [(none, none) for _ in items]  # scores and ids, best first

        def search(parts: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(parts).combine_chunks()
            ids = table["doc"].fill_null(NO_ID).to_numpy()
            lists = table["terms"].combine_chunks()
            doc = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            index = Index(table["n"].to_numpy(), doc, lists.flatten().to_numpy(), table["counts"].combine_chunks().flatten().to_numpy(), weights, docs, terms)
            for i, (_, order) in enumerate(items):
                scores, of = best[i]
                found, new = index.best(order, k, int(scores[k - 1]) if len(scores) == k else 0)
                if len(found):
                    scores, of = np.concatenate([scores, new]), np.concatenate([of, ids[found]])
                    first = np.lexsort((of, -scores))[:k]
                    best[i] = scores[first], of[first]

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten()) + batch.num_rows
            if size >= BLOCK_POSTINGS:
                search(held)
                held, size = [], 0
        if held:
            search(held)
        for (item, _), (scores, of) in zip(items, best):
            ids = pa.array(of, pa.int64(), mask=of == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(of), pa.int64()), ids, pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])

    return run


def _query_blocks(items: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with their terms, in blocks of at most ``most`` different terms or one item."""
    source = items.select(F.col(f"`{item}`").cast("long").alias("item"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sets = source.mapInArrow(_split, "item long, term binary").groupBy("item").agg(F.collect_set("term").alias("terms"))
    block, known = [], set()
    for row in stored(sets, "items").orderBy("item").toLocalIterator():
        terms = {bytes(t) for t in row["terms"]}
        if block and len(known | terms) > most:
            yield block
            block, known = [], set()
        block.append((row["item"], sorted(terms)))
        known |= terms
    if block:
        yield block


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first()))
    dealt = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    first = dealt.withColumn("rank", place("item_id", "part")).filter(F.col("rank") <= k).drop("rank", "part")
    return first.withColumn("rank", place("item_id")).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    results = []
    for block in _query_blocks(items, item, item_text, block_terms):
        names = sorted({t for _, terms in block for t in terms})
        vocabulary = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})
        forward = stored(source.mapInArrow(_forward(vocabulary), "doc long, n long, terms array<int>, counts array<long>"), "forward")
        whole = forward.filter("n > 0").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not whole["docs"]:
            break
        # One row a term of this block of items: bounded by block_terms.
        held = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        df = dict.fromkeys(range(len(names)), 0) | {r["term"]: r["df"] for r in held.collect()}
        weights = np.array([math.floor(1000 * math.log((2 * whole["docs"] + 2) / (2 * df[t] + 1))) for t in range(len(names))], np.int64)
        number = vocabulary.value
        ordered = [(i, sorted((number[t] for t in terms), key=lambda t: (df[t], t))) for i, terms in block]
        query = spark.sparkContext.broadcast((ordered, weights, whole["docs"], whole["terms"]))
        best = forward.mapInArrow(_searcher(query, k), "item_id long, doc_id long, score long")
        results.append(stored(_ranked(best, k), "ranked"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in results:
        out = out.union(part)
    return out


def op12_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text"))


QUERIES = {"op12_search": op12_search}

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) as term"
ORACLE_SQL = {
    "op12_search": f"""
with words as (
  select doc_id, {_TERMS} from documents
), docs as (
  select doc_id, count(*) as n from words group by doc_id
), whole as (
  select count(*) as docs, cast(sum(n) as bigint) as terms from docs
), asked as (
  select distinct item_id, term from (select item_id, {_TERMS} from benchmark)
), held as (
  select doc_id, term, count(*) as tf from words where term in (select term from asked) group by doc_id, term
), weighed as (
  select term, cast(floor(1000 * ln((2 * any_value(whole.docs) + 2) / cast(2 * count(*) + 1 as double))) as bigint) as w from held, whole group by term
), scored as (
  select a.item_id, h.doc_id, cast(sum(w.w * ((1000000000 * h.tf) // (1000 * h.tf + 20 * (50 + (50 * d.n * whole.docs) // whole.terms)))) as bigint) as score
  from asked a join held h on h.term = a.term join weighed w on w.term = a.term join docs d on d.doc_id = h.doc_id, whole group by a.item_id, h.doc_id
)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0) where rank <= {TOP}
"""
}
