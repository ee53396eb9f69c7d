"""Line dedup by content-defined chunks of lines, extended by neighbouring lines where asked for.

A text is split at line feeds. A rolling hash over the hashes of the last lines (``op4_line_chunks``: of the
last one) decides whether a chunk may end there, so a passage is
cut in the same places wherever it stands, but for its first lines. No chunk has fewer than two lines,
unless the text has one: a cut right after a cut waits for the next line that qualifies, and a last line
by itself joins the chunk before it. Chunks of several lines that occur more than once among all
documents lose all occurrences but the earliest (by id, then place in the text), provided their bytes
are the same: digests only propose.

Chunks leave the ends of a repeated passage, and passages that no cut falls into. ``dedup_documents`` removes
repeated chunks, cut by a rolling hash over two lines, and then extends: of the lines that they leave it proposes every
two neighbours, a line beside a removed chunk with the chunk's own last or first, so that a repeated passage of two or
more lines goes from its first line to its last wherever it stands. There, lines of white space lie between lines and
are none themselves, the line feed after the last line is not compared, and two lines that overlap their
earliest occurrence stay. A line that goes is always held by an earlier place: two lines within a removed chunk
stand in that chunk's earliest occurrence too, and so are never their own earliest.

Results: offsets count code points, ends are exclusive, and a chunk includes the line feeds that end
its lines. A null text has no chunks and stays null. Single lines are never removed. Rows that share id
and text count as one document: they keep or lose the same chunks. Rows without an id come last.
Texts of any length are cut in one pass; a removed piece is as long as its chunk. Columns of the input pass
through whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.names import free_names
from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIVISOR = 2
LEAST = 2
WINDOW = 2  # lines that the rolling hash of the pipeline's chunks covers
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def line_chunks(text: str, divisor: int = DIVISOR, window: int = 1, blank: bool = True) -> Iterator[tuple[int, int, int]]:
    """(start, end, number of lines) of the chunks of ``text``, in order; they cover all of it. A rolling hash over
    the hashes of ``window`` lines says where one may end. Without ``blank`` lines of white space are no lines, and are left
    out between chunks."""
    start = end = count = rolled = at = 0
    held = None
    recent: deque[int] = deque([0] * window)
    leaving = pow(BASE, window, MASK + 1)
    for line in text.split("\n"):
        begin, at = at, min(at + len(line) + 1, len(text))
        if not blank and (not line or line.isspace()):
            continue
        own = xxhash.xxh3_64_intdigest(line.encode("utf-8"))
        recent.append(own)
        rolled = (rolled * BASE + own - recent.popleft() * leaving) & MASK
        if not count:
            start = begin
        end = at
        count += 1
        if count >= LEAST and (((rolled * 0xD6E8FEB86659FD93) & MASK) >> 32) % divisor == 0:
            if held:
                yield held
            held = start, end, count
            count = 0
    if held and 0 < count < LEAST:
        held, count = (held[0], end, held[2] + count), 0
    if held:
        yield held
    if count:
        yield start, end, count


def line_pairs(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, 2) of every two lines that follow each other, but for white space, in order."""
    at = 0
    before = None
    for line in text.split("\n"):
        end = min(at + len(line) + 1, len(text))
        if line and not line.isspace():
            if before is not None:
                yield before, end, 2
            before = at
        at = end


def _proposals(divisor: int, pairs: bool) -> Callable:
    """Places of the chunks (``of`` is null) and, with ``pairs``, of every two neighbouring lines; there ``of`` is the start of
    the chunk that has both, or -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id, h, text in zip(*(c.to_pylist() for c in batch.columns)):

                def add(start, end, of):
                    piece = text[start:end].removesuffix("\n") if pairs else text[start:end]
                    digest = xxhash.xxh3_128_digest(piece.encode("utf-8"))
                    halves = (int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True))
                    rows.append((id, h, start, end, *halves, of))

                chunks = [c for c in line_chunks(text, divisor, WINDOW if pairs else 1, not pairs) if c[2] > 1]
                for start, end, _ in chunks:
                    add(start, end, None)
                k = 0
                for start, end, _ in line_pairs(text) if pairs else ():
                    while k < len(chunks) and chunks[k][1] <= start:
                        k += 1
                    inside = k < len(chunks) and chunks[k][0] <= start and end <= chunks[k][1]
                    add(start, end, chunks[k][0] if inside else -1)
            columns = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "h", "start", "end", "d1", "d2", "of"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, sorted spans) to the spans without overlaps; those that touch become one."""
    for batch in batches:
        rows = []
        for id, h, spans in zip(*(c.to_pylist() for c in batch.columns)):
            start, last = spans[0]["start"], spans[0]["end"]
            for span in spans[1:]:
                if span["start"] > last:
                    rows.append((id, h, start, last))
                    start = span["start"]
                last = max(last, span["end"])
            rows.append((id, h, start, last))
        columns = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "h", "start", "end"])


def _hits(places: DataFrame, pairs: bool) -> DataFrame:
    """The places of digests that occur more than once, and whether they are the earliest of theirs; with ``pairs`` those
    that overlap the earliest are left out."""
    # The earliest place of each digest, level by level, so that every step is a plain minimum.
    order = F.coalesce("id", F.lit((1 << 63) - 1))
    proposed = places.groupBy("d1", "d2").agg(F.count("*").alias("c"), F.min(order).alias("least")).filter("c > 1").drop("c")
    proposed = stored(proposed, "proposed")
    hits = stored(places.join(proposed, ["d1", "d2"]).withColumn("same", order == F.col("least")), "hits")
    first = hits.filter("same").groupBy("d1", "d2").agg(F.min(F.struct("start", "h", "end")).alias("place"))
    first = stored(first.select("d1", "d2", F.col("place.start").alias("at"), F.col("place.h").alias("by"), F.col("place.end").alias("to")), "first")
    here = F.col("same") & (F.col("h") == F.col("by"))
    hits = hits.join(first, ["d1", "d2"]).withColumn("earliest", here & (F.col("start") == F.col("at")))
    if pairs:
        hits = hits.filter(F.col("earliest") | ~(here & (F.col("start") < F.col("to"))))
    return hits.select("id", "h", "start", "end", "d1", "d2", "earliest")


def repeated_chunks(docs: DataFrame, id: str = "doc_id", text: str = "text", divisor: int = DIVISOR, pairs: bool = False) -> DataFrame:
    """The chunks that go: (id, h, start, end), h being the hash of the text. With ``pairs``, chunks are extended by every
    two neighbouring lines that repeat and do not both lie in a chunk that goes; what goes of a text is merged."""
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("body")).filter("body is not null")
    kinds = "id long, h long, start long, end long, d1 long, d2 long, of long"
    places = stored(rows.mapInArrow(_proposals(divisor, pairs), kinds).distinct(), "chunks")
    hits = _hits(places.filter("of is null"), False)
    if pairs:
        hits = stored(hits, "chunk-hits")
        cut = hits.filter("not earliest").select(F.col("id").alias("i"), F.col("h").alias("g"), F.col("start").alias("s"))
        inside = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")) & (F.col("of") == F.col("s"))
        left = stored(places.filter("of is not null").join(cut, inside, "left_anti"), "left-lines")
        hits = hits.unionByName(_hits(left, True))
    spans = hits.groupBy("id", "h").agg(F.collect_list(F.struct("start", "end", "d1", "d2", "earliest")).alias("spans"))
    # Bytes of the proposed chunks. Texts are as large as the corpus, so they are joined by a shuffle at every size.
    texts = rows.select(F.col("id").alias("i"), F.col("h").alias("g"), "body").join(spans.hint("merge"), F.col("i").eqNullSafe(F.col("id")) & (F.col("g") == F.col("h")))
    pieces = texts.select("id", "h", "body", F.explode("spans").alias("s")).select("id", "h", "s.*", F.expr("substring(body, cast(s.start as int) + 1, cast(s.end - s.start as int))").alias("bytes"))
    if pairs:
        pieces = pieces.withColumn("bytes", F.regexp_replace("bytes", r"\n\z", ""))
    pieces = stored(pieces, "pieces")
    kept = pieces.filter("earliest").select("d1", "d2", F.col("bytes").alias("original")).dropDuplicates(["d1", "d2"])
    gone = pieces.filter("not earliest").join(stored(kept, "originals"), ["d1", "d2"]).filter("bytes = original").select("id", "h", "start", "end").distinct()
    if not pairs:
        return gone
    lists = gone.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    return lists.mapInArrow(_merged, "id long, h long, start long, end long")


def without_repeated_chunks(
    docs: DataFrame, id: str = "doc_id", text: str = "text", into: str = "removed", divisor: int = DIVISOR, pairs: bool = False
) -> DataFrame:
    """``docs`` with the repeated chunks cut from ``text``; the array ``into`` has their (start, end) in
    the original text, null where nothing was removed. A column already called ``into`` is replaced."""
    gone = repeated_chunks(docs, id, text, divisor, pairs)
    i, h, spans = free_names(docs, "__id", "__h", "__cuts")
    cuts = stored(gone.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(spans)), "cuts")
    cuts = cuts.select(F.col("id").alias(i), F.col("h").alias(h), spans)
    body, c = F.col(f"`{text}`"), F.col(spans)
    joined = docs.join(cuts.hint("merge"), F.col(f"`{id}`").cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(body) == F.col(h)), "left")
    before = F.transform(
        c,
        lambda cut, i: F.substring(body, F.coalesce(F.get(c, i - 1)["end"], F.lit(0)).cast("int") + 1, (cut["start"] - F.coalesce(F.get(c, i - 1)["end"], F.lit(0))).cast("int")),
    )
    rest = F.substring(body, F.element_at(c, -1)["end"].cast("int") + 1, F.char_length(body))
    cut = F.when(c.isNull(), body).otherwise(F.concat(F.array_join(before, ""), rest))
    names = [n for n in docs.columns if n != into]
    return joined.select(*(cut.alias(n) if n == text else F.col(f"`{n}`") for n in names), c.alias(into))


def dedup_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """``docs`` after the removal of repeated chunks and of the lines that extend them, with its columns. ``chars``, where there is such a column, is counted
    anew. Documents of which no word is left are dropped; those without words before stay."""
    (removed,) = free_names(docs, "__removed")
    out = without_repeated_chunks(docs, id, text, removed, pairs=True)
    out = out.filter(F.col(removed).isNull() | F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"))
    if chars in docs.columns:
        kind = docs.schema[chars].dataType
        out = out.withColumn(chars, F.when(F.col(removed).isNull(), F.col(f"`{chars}`")).otherwise(F.char_length(F.col(f"`{text}`")).cast(kind)))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op4_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    out = without_repeated_chunks(docs)
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return out.select("doc_id", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"), F.coalesce(spans, F.lit("")).alias("removed"), "text")


QUERIES = {"op4_line_chunks": op4_line_chunks}
