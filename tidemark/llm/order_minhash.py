"""Document fingerprints by Order MinHash.

A text's k-mers (k code points in a row; a shorter text is one k-mer) are numbered by occurrence, so
repeats count. Each coordinate has a hash of its own; the few numbered k-mers with the least hashes are
taken, put back in text order, and their tuple hashed. Two texts agree in a coordinate with a chance
that falls with their edit distance: moved passages change the order and so the fingerprint.

A fingerprint is the coordinates in hexadecimal, eight digits each. The likeness of two fingerprints is
the share of coordinates in which they agree. An empty text has an empty fingerprint, which is like
other empty ones (1) and unlike the rest (0). Memory per text is a small multiple of its length.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 8
COORDINATES = 32
TUPLE = 2
BLOCK = 1 << 13
PLACE_BITS = 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def kmers(text: str, k: int = K) -> np.ndarray:
    """A 44-bit hash of every k-mer, in text order."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(code) - k + 1
    if n < 1:
        k, n = len(code), min(1, len(code))
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += code[i : i + n]
    return _mixed(total) >> np.uint64(PLACE_BITS)


def numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of k-mer and occurrence number, place in the text), by k-mer and then place."""
    n = len(hashes)
    if n < 1 << PLACE_BITS:
        packed = np.sort((hashes << np.uint64(PLACE_BITS)) | np.arange(n, dtype=np.uint64))
        places = packed & np.uint64((1 << PLACE_BITS) - 1)
        hashes = packed >> np.uint64(PLACE_BITS)
    else:
        places = np.argsort(hashes, kind="stable")
        hashes = hashes[places]
    index = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = hashes[1:] != hashes[:-1]
    occurrence = index - np.maximum.accumulate(np.where(new, index, 0))
    items = _mixed(hashes + occurrence.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return items, places.astype(np.int64)


class Sketcher:
    def __init__(self, k: int, coordinates: int, size: int):
        self.k, self.size = k, size
        self.odd = (np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, coordinates, np.uint32) | np.uint32(1))[:, None]

    def sketch(self, text: str) -> np.ndarray | None:
        """The coordinates, or None for an empty text."""
        if not text:
            return None
        items, places = numbered(kmers(text, self.k))
        short = (items >> np.uint64(32)).astype(np.uint32)
        rows = np.arange(len(self.odd))[:, None]
        best = np.empty((len(self.odd), 0), np.int64)
        for at in range(0, len(items), BLOCK):
            # Of the block's items and the best so far, the least stay.
            hashed = short[None, at : at + BLOCK] * self.odd
            here = []
            for _ in range(min(self.size, hashed.shape[1])):
                least = hashed.argmin(axis=1)[:, None]
                here.append(least + at)
                hashed[rows, least] = 0xFFFFFFFF
            best = np.hstack([best, *here])
            if best.shape[1] > self.size:
                order = np.argsort(short[best] * self.odd, axis=1, kind="stable")[:, : self.size]
                best = best[rows, order]
        in_order = best[rows, np.argsort(places[best], axis=1)]
        total = np.zeros(len(self.odd), np.uint64)
        for column in items[in_order].T:
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + column)
        return (total >> np.uint64(16)).astype(np.uint32)


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return float(a is None and b is None)
    return float((a == b).mean())


def _hex(sketch: np.ndarray | None) -> str:
    return "" if sketch is None else sketch.astype(">u4").tobytes().hex()


def _fingerprints(k: int, coordinates: int, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(k, coordinates, size)
        for batch in batches:
            last = batch.num_columns - 1
            prints = [_hex(sketcher.sketch(t)) for t in batch.column(last).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(prints, pa.string())], names=[*batch.schema.names[:last], "fingerprint"])

    return run


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, coordinates: int = COORDINATES, size: int = TUPLE) -> DataFrame:
    """The id and fingerprint of every row; a null text counts as empty."""
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    return rows.mapInArrow(_fingerprints(k, coordinates, size), f"id {kind}, fingerprint string").withColumnRenamed("id", id)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_SQL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(sketcher: Sketcher, text: str, own, following: str, following_sketch) -> tuple:
    new = edited(text, following)
    changed = sketcher.sketch(new)
    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), sha, _hex(own), _hex(changed), likeness(own, changed), likeness(own, following_sketch)


def _batch(rows: list[tuple], first: list[tuple[str, pa.DataType]], last: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    fields = [*first, *_FIELDS, *last]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _neighbours(k: int, coordinates: int, size: int) -> Callable:
    """Over sorted rows (id, h, body): results of all rows that have their successor in this partition;
    the partition's first and last text as they are, since their neighbours are in others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(k, coordinates, size)
        make = lambda rows: _batch(rows, [("id", pa.int64()), ("h", pa.int64())], [("kind", pa.int32()), ("body", pa.string())])
        before = None
        blank = (None,) * len(_FIELDS)
        for batch in batches:
            out = []
            for id, h, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = sketcher.sketch(text)
                if before is None:
                    out.append((id, h, *blank, 1, text))
                else:
                    out.append((*before[:2], *_row(sketcher, *before[2:], text, own), 0, None))
                before = (id, h, text, own)
            yield make(out)
        if before is not None:
            yield make([(*before[:2], *blank, 2, before[2])])

    return run


def _pairs(k: int, coordinates: int, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(k, coordinates, size)
        for batch in batches:
            rows = [
                (id, *_row(sketcher, text, sketcher.sketch(text), following, sketcher.sketch(following)))
                for id, text, following in zip(*(c.to_pylist() for c in batch.columns))
            ]
            yield _batch(rows, [("id", pa.int64())], [])

    return run


def edit_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, coordinates: int = COORDINATES, size: int = TUPLE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likenesses to the edited and the next text.

    The next row is the next in order of id and hash of the text; the first follows the last. Rows
    without an id come first; a null text counts as empty. The order comes from a range partitioning:
    texts move once and each task walks its sorted rows. Only each partition's first and last text
    are put in order by themselves, two per partition.
    """
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    rows = rows.select("id", F.xxhash64("body").alias("h"), "body").repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    walked = stored(rows.mapInArrow(_neighbours(k, coordinates, size), f"id long, h long, {_SQL}, kind int, body string"), "fingerprints")
    ends = walked.filter("kind > 0").select("id", "h", "kind", "body")
    order = Window.orderBy(F.col("id").asc_nulls_first(), "h", "kind")
    first = F.first("body").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = ends.select("id", "kind", "body", F.coalesce(F.lead("body").over(order), first).alias("following"))
    last = last.filter("kind = 2").select("id", "body", "following")
    rest = last.mapInArrow(_pairs(k, coordinates, size), f"id long, {_SQL}")
    names = ["id", *(n for n, _ in _FIELDS)]
    return walked.filter("kind = 0").select(names).union(rest.select(names)).withColumnRenamed("id", id)


def op10_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return edit_fingerprints(spark.read.parquet(f"{sf}/documents.parquet"))


QUERIES = {"op10_order_minhash": op10_order_minhash}
