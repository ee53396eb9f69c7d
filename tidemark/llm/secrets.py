"""Secret scan: fixed patterns, and windows of high entropy that no pattern names.

Candidate strings are runs of characters that keys are made of. Within a candidate, runs of each
character class (hexadecimal; lower-case letters and digits; capitals and digits; letters, digits and
the marks of base64) are read with a window of fixed width. A = ends a run, but for padding. The window's Shannon entropy follows from its character counts; one step takes one
character out and one in, so it costs the same for any width. Windows over the class's limit, with
the class's least number of digits, are merged into spans. An allow-list pattern that begins with ^ is
held against the whole span; of any other only the parts between marks that it occurs in are taken
out, and the rest is read again. Spans inside a pattern's span are left out. Texts are read whole, row by row; nothing is shuffled.

Offsets count code points, ends are exclusive. A null text counts as empty. Rows stay as they are.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("assign", "access", "hex", "entropy")
# The patterns, and the least length of what they match.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ("passw", "secret", "token", "key")
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")


@dataclass(frozen=True)
class Limit:
    """Runs of ``pattern`` are read in windows of ``width``; more than ``bits`` a character is suspect
    where the window has ``digits`` digits at least."""

    pattern: str
    width: int
    bits: float
    digits: int = 0


LIMITS = (
    Limit(r"[0-9a-f]{20,}", 20, 3.0),
    Limit(r"[0-9A-F]{20,}", 20, 3.0),
    Limit(r"[a-z0-9]{20,}", 20, 3.4, 2),
    Limit(r"[A-Z0-9]{20,}", 20, 3.4, 2),
    Limit(r"[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/=_-]))?", 20, 3.85),
)
MARKS = re.compile(r"[=_/+-]")
# What one of these matches is no secret.
ALLOWED = (
    r"^[0-9]+$",
    r"^[a-z]+$",
    r"^[A-Z]+$",
    r"^[A-Za-z]?[a-z]+([-_/][A-Za-z]?[a-z]*)+$",
    r"(?i)example|sample|placeholder|dummy",
    r"(?i)abcdefghij|0123456789",
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    found = []
    folded = text.lower()
    if any(w in folded for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return found


def suspect(run: str, width: int, bits: float, digits: int = 0) -> Iterator[tuple[int, int]]:
    """Merged spans of the windows of ``run`` with more than ``bits`` of entropy a character and
    ``digits`` digits at least."""
    counts: dict[str, int] = {}
    # Entropy is log2(width) - total / width, where total sums c * log2(c) over the counts.
    weight = [c * math.log2(c) if c else 0.0 for c in range(width + 1)]
    most = (math.log2(width) - bits) * width
    total, start, end, numeric = 0.0, -1, -1, 0
    for i, char in enumerate(run):
        numeric += "0" <= char <= "9"
        c = counts.get(char, 0)
        total += weight[c + 1] - weight[c] if c < width else 0.0
        counts[char] = c + 1
        if i >= width:
            gone = run[i - width]
            numeric -= "0" <= gone <= "9"
            c = counts[gone]
            total += weight[c - 1] - (weight[c] if c <= width else weight[width])
            counts[gone] = c - 1
        if i >= width - 1 and total < most - 1e-9 and numeric >= digits:
            if i - width + 1 > end:
                if end > 0:
                    yield start, end
                start = i - width + 1
            end = i + 1
    if end > 0:
        yield start, end


def unallowed(text: str, start: int, end: int, limit: tuple[int, float, int], allowed) -> Iterator[tuple[int, int]]:
    """What the allow-list leaves of a suspect span."""
    whole = [p for p in allowed if p.pattern.startswith("^")]
    words = [p for p in allowed if not p.pattern.startswith("^")]
    if any(p.search(text[start:end]) for p in whole):
        return
    if not any(p.search(text[start:end]) for p in words):
        yield start, end
        return
    at = left = start
    for stop in [*(m.start() for m in MARKS.finditer(text, start, end)), end]:
        if any(p.search(text[at:stop]) for p in words):
            yield from ((left + a, left + b) for a, b in suspect(text[left:at], *limit) if not any(p.search(text[left + a : left + b]) for p in allowed))
            left = min(stop + 1, end)
        at = min(stop + 1, end)
    yield from ((left + a, left + b) for a, b in suspect(text[left:end], *limit) if not any(p.search(text[left + a : left + b]) for p in allowed))


def scan(text: str, limits, allowed) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then by kind in the order of KINDS; limits and patterns compiled."""
    found = base_spans(text)
    candidates = list(CANDIDATE.finditer(text))
    if candidates:
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        base = list(found)
        for m in candidates:
            spans: set[tuple[int, int]] = set()
            for pattern, *limit in limits:
                for run in pattern.finditer(text, m.start(), m.end()):
                    for a, b in suspect(run.group(), *limit):
                        spans.update(unallowed(text, run.start() + a, run.start() + b, limit, allowed))
            joined: list[list[int]] = []
            for a, b in sorted(spans):
                if any(s <= a and b <= e for s, e, _ in base):
                    continue
                if joined and a < joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            found += [(a, b, "entropy") for a, b in joined]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _scanner(limits: tuple[Limit, ...], allowed: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(re.compile(x.pattern), x.width, x.bits, x.digits) for x in limits]
        allow = [re.compile(x) for x in allowed]
        for batch in batches:
            spans = [scan(t, compiled, allow) for t in batch.column(batch.num_columns - 1).to_pylist()]
            counts = [pa.array([sum(s[2] == k for s in row) for row in spans], pa.int64()) for k in KINDS]
            base = [_joined(s for s in row if s[2] != "entropy") for row in spans]
            columns = [
                *batch.columns[:-1],
                *counts[:3],
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                pa.array([_joined(row) for row in spans], pa.string()),
                counts[3],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *(c.split()[0] for c in RESULT.split(", "))])

    return run


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"


def secret_spans(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limits: tuple[Limit, ...] = LIMITS, allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """The columns ``keep`` with counts by kind, a digest of the pattern spans, and all spans.

    ``keep`` must not contain names of the result.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    schema = ", ".join([*(f"k{i} {kinds[c]}" for i, c in enumerate(keep)), RESULT])
    return rows.mapInArrow(_scanner(limits, allowed), schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_spans(spark.read.parquet(f"{sf}/documents.parquet"))


QUERIES = {"op5_secrets": op5_secrets}
