"""Substring dedup by hashing normalised units.

Texts are split into lines, and lines after sentence marks, so that a passage is found wherever it
stands in a paragraph; sentences of few words are taken together. Marks of scripts that set no space after
them count as well. Sentences of over LONG_WORDS words are cut after words that their hash with the word
before chooses, so that a passage in a line without marks is cut alike wherever it stands. In scripts
without spaces between words, two characters count as a word. A unit is normalised (lower case, white space folded) and hashed. Digests are
grouped over all documents; the occurrence with the least id, then the first in the text, is kept, and
all others are marked. Marked units that follow each other form a passage, and passages of at least
MIN_WORDS words are removed. Common short phrases alone are not.

Offsets count code points of the original text, ends are exclusive; a passage begins with its first unit
and ends with the last, the white space after it included. Null and empty texts have no units. Rows that
share an id are one document: they do not remove each other's units. Rows without an id come last.
Digests have 128 bits; a hot unit is summed before the shuffle and its rows are split where joined.
Columns of the input pass through whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.names import free_names
from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS = 25
UNIT_WORDS = 4
LONG_WORDS = 30
CUT = 4
MARKS = re.compile(r"[.!?؟۔।॥።]+[\"')\]»”’]*[^\S\n]+|[。！？．｡]+[\"')\]」』”’）》】]*[^\S\n]*|\n+|$")
WORD = re.compile(r"\S+\s*")
# Thai, Lao, Burmese, Khmer, kana and Chinese characters.
UNSPACED = re.compile(r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]")
NO_ID = (1 << 63) - 1


def size(unit: str) -> int:
    """The words of a normalised unit."""
    return unit.count(" ") + 1 + (0 if unit.isascii() else len(UNSPACED.findall(unit)) // 2)


def _ends(text: str) -> Iterator[int]:
    """Where sentences, lines and the pieces of long sentences end."""
    at = 0
    for m in MARKS.finditer(text):
        end = m.end()
        if end - at > 2 * LONG_WORDS:
            found = list(WORD.finditer(text, at, end))
            if len(found) > LONG_WORDS:
                since, before = 0, ""
                for w in found[:-1]:
                    word = w.group().rstrip().lower()
                    since += 1
                    if since >= UNIT_WORDS and xxhash.xxh3_64_intdigest(f"{before} {word}".encode("utf-8", "surrogatepass")) % CUT == 0:
                        yield w.end()
                        since = 0
                    before = word
        yield end
        at = end


def units(text: str, least: int = UNIT_WORDS) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised text) of the units: sentences of a line, the next ones taken along while
    there are fewer than ``least`` words. Lines end a unit whatever its length; blank ones have none."""
    start = at = 0
    words: list[str] = []
    for end in _ends(text):
        words += text[at:end].split()
        at = end
        unit = " ".join(words).lower()
        if words and (size(unit) >= least or at == len(text) or text[at - 1] == "\n"):
            yield start, at, unit
        elif words:
            continue
        start, words = at, []


def _rows(text: str) -> list[tuple]:
    """(number, start, end, words, whether the text had it before, both halves of the digest)."""
    seen: set[bytes] = set()
    out = []
    for no, (start, end, unit) in enumerate(units(text)):
        digest = xxhash.xxh3_128_digest(unit.encode("utf-8", "surrogatepass"))
        out.append((no, start, end, size(unit), digest in seen, int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
        seen.add(digest)
    return out


def _digests() -> Callable:
    """(id, body) to the distinct digests of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [(id, *r[5:]) for id, text in zip(*(c.to_pylist() for c in part.columns)) for r in _rows(text) if not r[4]]
                columns = list(zip(*rows)) if rows else [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "d1", "d2"])

    return run


_UNIT = [("id", pa.int64()), ("h", pa.int64()), ("no", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("again", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64())]


def _places() -> Callable:
    """(id, h, body) to the units of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [(id, h, *r) for id, h, text in zip(*(c.to_pylist() for c in part.columns)) for r in _rows(text)]
                columns = list(zip(*rows)) if rows else [()] * len(_UNIT)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _UNIT)], names=[n for n, _ in _UNIT])

    return run


def _runs(min_words: int) -> Callable:
    """(id, h, marked units) to passages: neighbouring units of at least ``min_words`` words together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id, h, marked in zip(*(c.to_pylist() for c in batch.columns)):
                current: list[dict] = []
                for unit in [*marked, None]:
                    if current and (unit is None or unit["no"] != current[-1]["no"] + 1):
                        words = sum(u["words"] for u in current)
                        if words >= min_words:
                            rows.append((id, h, current[0]["start"], current[-1]["end"], words, min(u["first"] for u in current)))
                        current = []
                    if unit is not None:
                        current.append(unit)
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "h", "start", "end", "words", "first"])

    return run


def repeated_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, h, start, end, words, first): what is to be removed, with the hash of its text and the least
    id among the documents that keep one of its units."""
    key = F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(NO_ID))
    rows = docs.select(key.alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("body")).filter("body is not null")
    digests = rows.select("id", "body").mapInArrow(_digests(), "id long, d1 long, d2 long")
    shared = digests.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first <> last").drop("last")
    shared = stored(shared, "shared")
    schema = "id long, h long, no int, start int, end int, words int, again boolean, d1 long, d2 long"
    marked = rows.mapInArrow(_places(), schema).join(shared, ["d1", "d2"], "left").filter(F.col("again") | (F.col("first") < F.col("id")))
    marked = stored(marked.select("id", "h", "no", "start", "end", "words", F.coalesce("first", "id").alias("first")).distinct(), "marked")
    lists = marked.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("no", "start", "end", "words", "first"))).alias("marked"))
    return lists.mapInArrow(_runs(min_words), "id long, h long, start long, end long, words long, first long")


def without_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated passages cut from ``text``; all rows and other columns stay."""
    i, h, spans = free_names(docs, "__id", "__h", "__cuts")
    gone = repeated_passages(docs, id, text, min_words).groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(spans))
    gone = gone.select(F.col("id").alias(i), F.col("h").alias(h), spans)
    body, cuts = F.col(f"`{text}`"), F.col(spans)
    key = F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(NO_ID))
    joined = docs.join(gone, (key == F.col(i)) & (F.xxhash64(body) == F.col(h)), "left")
    last = lambda k: F.coalesce(F.get(cuts, k - 1)["end"], F.lit(0)).cast("int")
    before = F.transform(cuts, lambda cut, k: F.substring(body, last(k) + 1, cut["start"].cast("int") - last(k)))
    rest = F.substring(body, F.element_at(cuts, -1)["end"].cast("int") + 1, F.char_length(body))
    left = F.when(cuts.isNull(), body).otherwise(F.concat(F.array_join(before, ""), rest))
    return joined.select(*(left.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))


def op2_passages(spark: SparkSession, sf: str) -> DataFrame:
    """One row per removed passage; documents without one do not occur as ``doc_id``."""
    gone = repeated_passages(spark.read.parquet(f"{sf}/documents.parquet"))
    return gone.select(F.col("id").alias("doc_id"), F.col("start").alias("span_start"), F.col("end").alias("span_end"), F.col("words").alias("n_words"), F.col("first").alias("kept_doc_id"))


QUERIES = {"op2_passages": op2_passages}
