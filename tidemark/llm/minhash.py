"""Near-duplicate groups by circulant MinHash and exact Jaccard verification.

Two permutations serve all signature coordinates: the first scatters a text's shingles over a circle
of 2 ** 32 places, the second is read from each of them at a start that moves on by one place from
coordinate to coordinate. Coordinates are banded; texts that agree in a band are candidates. With 28
bands of 5 a pair at similarity 0.85 is missed with a chance below 1e-7; lower thresholds need more
bands (40 at 0.80, for 1.3e-7).

No group is ever expanded into pairs:

1. Texts with one shingle set form a class; its least id stands for it from then on. A set is
   known by that id and its digest, so an id may stand for several sets.
2. In every bucket each member is compared with the bucket's member of the least digest, exactly and
   on whole sets. Components of these links, over ids, are labels.
3. Buckets that still hold several labels may hide links between members of different labels. Only
   pairs that the bitmaps below allow are joined, and then compared exactly.

Pairs are held against parity bitmaps before they are compared: each shingle of a set flips one of 1024
bits, so two sets differ in at least as many shingles as their bitmaps in bits. This rules out pairs
for certain, never a link.

Sizes, shingles and links: words are runs without ASCII white space, A-Z lower-cased; shingles are
five words, or the whole text if it has fewer; sets are compared by 64-bit hashes. Null and empty
texts have no shingles and are linked with nothing. Rows without an id get no component and stay.
Rows that share an id are one document, whatever their texts: the links of all its texts count, each
row has the size of its own set, and the document stays or goes with all its rows.
Texts of any length are hashed in one task each. An empty table gives an empty result. Other columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
PERCENT = 85
BANDS = 28
ROWS = 5
PARITY_WORDS = 16
CHUNK = 4096  # shingles that are hashed at a time


def shingles(text: str, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = max(1, len(one) - words + 1)
    total = np.full(n, len(one) if n == 1 and len(one) < words else words, np.uint64)
    for k in range(min(words, len(one))):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + one[k : k + n]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique(total ^ (total >> np.uint64(32)))


def _scatter(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit integers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, length: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least of the second permutation, shifted by k places."""
    shifts = np.arange(length, dtype=np.uint32)[:, None]
    # The upper half of a mixed hash is the place the first permutation gives.
    places = (hashes >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995)
    places *= np.uint32(0x2C1B3C6D)
    least = np.full(length, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), CHUNK):
        least = np.minimum(least, _scatter(places[None, at : at + CHUNK] + shifts).min(axis=1))
    return least


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    for column in least.reshape(bands, rows).astype(np.uint64).T:
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0xE7037ED1A0B428DB) + column
    return (key ^ (key >> np.uint64(29))).view(np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bit for each of 1024 classes of shingles: whether the set has an odd number of them."""
    odd = np.bincount((hashes >> np.uint64(3)) & np.uint64(64 * PARITY_WORDS - 1), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _may_link(percent: int, a: str, b: str) -> Column:
    """Whether two sets of sizes n_``a``, n_``b`` and bitmaps bits_``a``, bits_``b`` can be linked."""
    sizes = F.col(f"n_{a}") + F.col(f"n_{b}")
    apart = sum(F.bit_count(F.col(f"bits_{a}")[k].bitwiseXOR(F.col(f"bits_{b}")[k])) for k in range(PARITY_WORDS))
    return (100 + percent) * (sizes - apart) >= 2 * percent * sizes


def _sketches(words: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, keys, bits = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                found = shingles(text, words)
                digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                sizes.append(len(found))
                first.append(int(digest[0]))
                second.append(int(digest[1]))
                bits.append(parity(found))
                keys.append(band_keys(signature(found, bands * rows), bands, rows) if len(found) else [])
            lists = pa.list_(pa.int64())
            columns = [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (sizes, first, second)), pa.array(bits, lists), pa.array(keys, lists)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "t", "n", "h", "h2", "bits", "bands"])

    return run


def _verifier(words: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], np.ndarray] = {}

        def of(key: tuple[int, int], text: str) -> np.ndarray:
            if key not in known:
                if len(known) >= 64:
                    known.pop(next(iter(known)))
                known[key] = shingles(text, words)
            return known[key]

        for batch in batches:
            a, ta, left, right = (batch.column(k).to_pylist() for k in (0, 2, 3, 4))
            linked = []
            for key, s, t in zip(zip(a, ta), left, right):
                one, two = of(key, s), shingles(t, words)
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return run


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of ids (a, b) of ``pairs`` (a, ta, b, tb) whose texts ta, tb are linked, compared on whole sets.

    Texts are as large as the corpus, so they are joined by a shuffle at every size.
    """
    left = texts.select(F.col("id").alias("a"), F.col("t").alias("ta"), F.col("body").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("t").alias("tb"), F.col("body").alias("right"))
    both = pairs.join(right.hint("merge"), ["b", "tb"]).join(left.hint("merge"), ["a", "ta"]).select("a", "b", "ta", "left", "right")
    return stored(both.mapInArrow(_verifier(words, percent), "a long, b long").distinct(), "links")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles``, ``component_id`` (the least id reachable over
    links of at least ``percent`` hundredths) and ``kept`` (whether it is that document)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.xxhash64(body).alias("t"), body.alias("body"))
    schema = "id long, t long, n long, h long, h2 long, bits array<long>, bands array<long>"
    sketches = stored(source.mapInArrow(_sketches(words, bands, rows), schema), "sketches")
    able = sketches.filter((F.col("n") > 0) & F.col("id").isNotNull())

    # 1. Classes of equal sets.
    copies = able.groupBy("h", "h2").agg(F.min("id").alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c")
    copies = stored(copies, "classes")
    members = able.join(copies, ["h", "h2"], "left").withColumn("first", F.coalesce("first", "id"))
    repeated = stored(members.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "copies")
    alone = members.filter("id = first")

    # 2. Every bucket's members against its least one.
    sets = stored(alone.select("id", "h", "t", "n", "bits").dropDuplicates(["id", "h"]), "sets")
    buckets = alone.select("id", "h", "n", F.explode("bands").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("h").alias("leader"), F.max("h").alias("last"), F.count("*").alias("size"))
    leaders = stored(leaders.filter("leader <> last").select("key", "leader", "size"), "leaders")
    shared = stored(buckets.join(leaders, "key"), "buckets")
    wanted = shared.filter("h <> leader").select(F.col("leader").alias("h_a"), F.col("h").alias("h_b")).distinct()
    marks = lambda side: sets.select(
        F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("h", "n", "bits")), F.col("t").alias(f"t{side}")
    )
    wanted = wanted.join(marks("a"), "h_a").join(marks("b"), "h_b").filter((F.col("a") != F.col("b")) & _may_link(percent, "a", "b"))
    wanted = stored(wanted.select("a", "ta", "b", "tb"), "pairs")
    near = sets.join(shared.select("h").distinct(), "h", "left_semi").select("id", "t").hint("merge")
    texts = stored(source.join(near, ["id", "t"], "left_semi").dropDuplicates(["id", "t"]), "texts")
    links = _verified(wanted, texts, words, percent)
    labels = components(links)

    # 3. What buckets with several labels may still hide.
    labelled = shared.filter("size > 2").join(labels, shared["id"] == labels["node"], "left")
    labelled = stored(labelled.select("key", "id", "h", F.coalesce("label", "id").alias("label")), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    mixed = stored(mixed, "mixed")
    open_ = stored(labelled.join(mixed, "key", "left_semi"), "open")
    possible = stored(open_.join(sets, ["id", "h"]), "possible")
    x, y = (possible.select("key", *(F.col(c).alias(f"{c}_{side}") for c in ("id", "t", "n", "label", "bits"))) for side in "xy")
    pairs = x.join(y, "key").filter((F.col("id_x") < F.col("id_y")) & (F.col("label_x") != F.col("label_y")) & _may_link(percent, "x", "y"))
    pairs = pairs.select(F.col("id_x").alias("a"), F.col("t_x").alias("ta"), F.col("id_y").alias("b"), F.col("t_y").alias("tb")).distinct()
    more = _verified(stored(pairs, "pairs"), texts, words, percent)

    found = links.union(more).union(repeated)
    labels = components(found)
    out = sketches.select("id", "n").join(labels, F.col("id") == F.col("node"), "left")
    component = F.coalesce("label", "id")
    return out.select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT, bands: int = BANDS) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, and rows without an id."""
    found = near_duplicates(docs, id, text, percent=percent, bands=bands)
    gone = found.filter(~F.col("kept")).select(F.col(id).alias("__gone")).distinct()
    return docs.join(gone, docs[f"`{id}`"].cast("long") == gone["__gone"], "left_anti")


def op9_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))


QUERIES = {"op9_minhash": op9_minhash}
