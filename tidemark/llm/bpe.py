"""Byte-level BPE encoding and decoding, with tree concatenation for long texts.

A long text is cut into leaves at any character. Leaves are encoded in parallel, on any executor, and
neighbouring halves are joined pairwise up a tree. At a join, a window of tokens on both sides is
encoded again; it grows until its first token is the one the left half has there and its last token
the one the right half has, and then replaces both. A token sequence is the encoding of its text if
every two neighbours are, so the result is exact. A half may be taken over whole by the window, as
in a run of one letter, where a shift changes every token.

Texts, ids and digests: a null text counts as empty (no tokens). The vocabulary file is read once by
the driver and travels with the tasks; its size does not depend on the data.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF_CHARS = 32_768
BATCH_TEXTS = 256

DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def vocabulary(path: str | None = None) -> str:
    """The text of a tokenizer file; without a path, that of the installed 50k vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, and the bytes they stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coder:
    """Encodes and decodes with one vocabulary; made once per Python worker and vocabulary."""

    made: dict[int, Coder] = {}

    def __init__(self, text: str):
        import tiktoken

        spec = json.loads(text)
        vocab, to_byte = spec["model"]["vocab"], _byte_of()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        first = len(vocab) - len(pairs) - sum(t["content"] in vocab for t in spec["added_tokens"])
        if [vocab[a + b] for a, b in pairs] != list(range(first, first + len(pairs))) or spec["normalizer"]:
            raise ValueError("ids must follow the order of the merges, and texts must not be normalised")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        self.bytes = [b""] * (1 + max([*ranks.values(), *self.special.values()]))
        for b, i in [*ranks.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.bytes[i] = b
        self.decimal = [str(i) for i in range(len(self.bytes))]
        # Fixed value: how byte-level BPE splits text before merging.
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._bpe = tiktoken.Encoding("bpe", pat_str=split, mergeable_ranks=ranks, special_tokens=self.special)

    @classmethod
    def of(cls, text: str) -> Coder:
        key = hash(text)
        if key not in cls.made:
            cls.made[key] = cls(text)
        return cls.made[key]

    def leaf(self, text: str) -> list[int]:
        return self._bpe.encode(text, allowed_special="all")

    def decode(self, ids) -> str:
        table = self.bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")

    def cut(self, text: str, size: int) -> Iterator[str]:
        """Leaves of about ``size`` characters; none begins or ends inside a special token."""
        start = 0
        while start < len(text):
            end = start + size
            for token in self.special:
                at = text.find(token, max(start, end - len(token) + 1), end + len(token) - 1)
                if 0 <= at < end < at + len(token):
                    end = at + len(token)
            yield text[start:end]
            start = end

    def _starts_character(self, token: int) -> bool:
        # A quote may take the letters after it along, but only where it begins a split of its own.
        b = self.bytes[token][0]
        return b & 0xC0 != 0x80 and b != 0x27

    def joined(self, left: list[int], right: list[int], window: int = 8) -> list[int]:
        """The encoding of two neighbouring texts from their encodings."""
        if not left or not right:
            return left + right
        while True:
            i, j = max(0, len(left) - window), min(len(right), window)
            while i > 0 and not self._starts_character(left[i]):
                i -= 1
            while j < len(right) and not self._starts_character(right[j]):
                j += 1
            between = self.leaf(self.decode(left[i:] + right[:j]))
            if (i == 0 or between[0] == left[i]) and (j == len(right) or between[-1] == right[j - 1]):
                return left[:i] + between + right[j:]
            window *= 2

    def tree(self, leaves: list[list[int]]) -> list[int]:
        """Joins neighbouring leaves, then neighbouring pairs, until one sequence is left."""
        while len(leaves) > 1:
            leaves = [self.joined(*leaves[i : i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        decimal = self.decimal
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        return len(ids), sha(",".join([decimal[i] for i in ids])), sha(self.decode(ids))


def _names(digests: bool) -> list[str]:
    return ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids"]


def _results(coder: Coder, ids: list[list[int]], digests: bool) -> list[pa.Array]:
    if not digests:
        return [pa.array(ids, pa.list_(pa.int32()))]
    n, a, b = zip(*map(coder.digest, ids)) if ids else ((), (), ())
    return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]


def _whole(vocab: str, digests: bool) -> Callable:
    """Adds results to every row; the text is the last column and is not returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(vocab.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                ids = [coder.leaf(t) for t in part.column(part.num_columns - 1).to_pylist()]
                columns = [*part.columns[:-1], *_results(coder, ids, digests)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], *_names(digests)])

    return run


def _leaves(vocab: str, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(vocab.value)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for seq, leaf in enumerate(coder.cut(text, size)):
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([seq], pa.int32()), pa.array([leaf])], names=["key", "seq", "leaf"])

    return run


def _joins(vocab: str, digests: bool) -> Callable:
    def run(leaves: pa.Table) -> pa.Table:
        coder = Coder.of(vocab.value)
        rows = leaves.sort_by("seq")
        ids = coder.tree([x.as_py() for x in rows.column("ids").combine_chunks()])
        columns = [rows.column("key").combine_chunks().slice(0, 1), *_results(coder, [ids], digests)]
        return pa.Table.from_arrays(columns, names=["key", *_names(digests)])

    return run


def _coded(docs: DataFrame, text: str, keep: list[str], vocab: str, leaf_chars: int, digests: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    adds = DIGESTS if digests else "ids array<int>"
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    renamed = [f"k{i} {kinds[c]}" for i, c in enumerate(keep)]
    rows = docs.select(*kept, body.alias("body"))
    is_long = F.char_length("body") > leaf_chars
    short = rows.filter(~is_long).mapInArrow(_whole(shared, digests), ", ".join([*renamed, adds]))

    # Each different long text is encoded once. Its leaves go wherever there is room.
    long = rows.filter(is_long).withColumn("key", F.sha2("body", 256))
    texts = long.groupBy("key").agg(F.first("body").alias("body"))
    leaves = texts.mapInArrow(_leaves(shared, leaf_chars), "key string, seq int, leaf string").repartition("key", "seq")
    encoded = leaves.mapInArrow(_whole(shared, False), "key string, seq int, ids array<int>")
    joined = encoded.groupBy("key").applyInArrow(_joins(shared, digests), "key string, " + adds)
    long = long.drop("body").join(joined, "key").drop("key")
    out = short.unionByName(long)
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), *(c for c in out.columns if c not in {f"k{i}" for i in range(len(keep))}))


def encode(docs: DataFrame, text: str = "text", keep: list[str] | None = None, vocab: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """The columns ``keep`` (default: all but the text) and ``ids`` array<int>, the tokens of ``text``.

    Rows stay as they are, repeated ones too. ``keep`` must not contain ``ids``. ``vocab`` is the text
    of a tokenizer file (:func:`vocabulary`).
    """
    keep = [c for c in docs.columns if c not in (text, "ids")] if keep is None else keep
    return _coded(docs, text, keep, vocab or vocabulary(), leaf_chars, False)


def encode_digests(docs: DataFrame, text: str = "text", keep: list[str] | None = None, vocab: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """As :func:`encode`, but with the number of tokens and SHA-256 digests of the ids and of the
    decoded text in place of the ids. ``keep`` must not contain names of these."""
    keep = [c for c in docs.columns if c not in (text, "n_tokens", "ids_sha256", "decoded_sha256")] if keep is None else keep
    return _coded(docs, text, keep, vocab or vocabulary(), leaf_chars, True)


def decode(tokens: DataFrame, ids: str = "ids", into: str = "text", vocab: str | None = None) -> DataFrame:
    """Replaces the column ``ids`` by the text it stands for, ``into``. Null ids give a null text."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocab or vocabulary())

    @F.pandas_udf("string")
    def text(column):
        coder = Coder.of(shared.value)
        return column.map(lambda x: None if x is None else coder.decode(x))

    return tokens.select(*(F.col(f"`{c}`") for c in tokens.columns if c not in (ids, into)), text(F.col(f"`{ids}`")).alias(into))


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encode_digests(spark.read.parquet(f"{sf}/documents.parquet"), "text", ["doc_id"])


QUERIES = {"op1_bpe": op1_bpe}
