"""Mixing to target weights with soft membership.

A classifier trained on the labelled table gives every document the posterior probabilities of the
domains good, poor and toxic, in thousandths. Document rates between 0 and ``most`` are then fitted so
that the expected tokens of each domain, sum(rate * tokens * posterior), come as near to the targets as
such rates can: least squares by projected gradient, with momentum. A rate depends on a document's
posteriors only, so documents with equal posteriors are one cell, and there are at most 501,501 cells
whatever the number of documents. A step is one aggregate over the cells, by Spark; three numbers of
it pass through the driver. It goes on until the targets are met or no rate moves any more, and what is
missing then is returned and logged.

Everything summed over documents or cells is a whole number (tokens, thousandths, rates in millionths), and
the classifier is trained on its rows in one fixed order, so results do not depend on how rows lie.

The gradient is taken in the metric in which rates of documents weigh by their tokens, and the distance
from the targets is measured by the inverse of the domains' Gram matrix (see :func:`metric`); steps of 1
are then safe.

Tokens are runs without ASCII white space. Null and empty texts have none; they get posteriors and a rate
like others. Labels that are null or belong to no document do not count; of several labels of one
document the worst counts. Without labels of two domains, all documents get the labels' smoothed shares.
Repeated rows are drawn alike. Columns of ``docs`` pass through whatever their names, but one called
``into`` is replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import logging
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOMAINS = ("good", "poor", "toxic")
WEIGHTS = (0.93, 0.02, 0.05)
#: At most about so many labelled documents, chosen by a hash of the id, train the classifier.
TRAINING_DOCUMENTS = 10_000
#: No document is drawn more often than this.
MOST = 4.0
FEATURES = 1 << 13
DENSE = 5
PARTS = 1000  # of a posterior
UNIT = 1_000_000  # of a rate
SETTLED = 0.02  # of the squared distance from the targets: what any other rates in the box could still gain
STEPS = 500  # beyond this, the fit says that it has not settled
KEPT_STEPS = 16  # steps between two writings of the cells
PIECE = 1 << 20  # bytes of a text whose words are taken at a time
MARKS = b".,;:!?\"'()"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())

log = logging.getLogger(__name__)


def features(text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of tokens, numbers of the hashed words, and the measures of a text."""
    raw = text.encode("utf-8")
    plain = text.lower().encode("utf-8").translate(None, MARKS)
    n, words = 0, set()
    for source, take in ((raw, None), (plain, words)):
        at = 0
        while at < len(source):
            end = source.find(b" ", at + PIECE)
            end = len(source) if end < 0 else end
            found = source[at:end].split()
            if take is None:
                n += len(found)
            else:
                take.update(found)
            at = end
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    size = len(text) + 1.0
    dense = np.array([np.log1p(n), (len(text) - without(NO_LETTERS)) / size, len(words) / (n + 1.0), without(CAPITALS) / size, without(SYMBOLS) / (n + 1.0)])
    hashed = np.unique(np.fromiter((zlib.crc32(w) % FEATURES for w in words), np.int64, len(words)))
    return n, hashed, dense


@F.udf(VectorUDT())
def _vector(text):
    _, hashed, dense = features(text)
    return SparseVector(FEATURES + DENSE, [*hashed.tolist(), *range(FEATURES, FEATURES + DENSE)], [1.0] * len(hashed) + dense.tolist())


def _scorer(weights: np.ndarray, intercepts: np.ndarray):
    def score(texts: pa.Array) -> pa.Array:
        tokens, parts = [], []
        for text in texts.to_pylist():
            n, hashed, dense = features(text)
            z = weights[hashed].sum(axis=0) + dense @ weights[FEATURES:] + intercepts
            p = np.exp(z - z.max())
            p /= p.sum()
            first = int(round(PARTS * float(p[0])))
            second = min(PARTS - first, int(round(PARTS * float(p[1]))))
            tokens.append(n)
            parts.append([first, second, PARTS - first - second])
        return pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.array(parts, pa.list_(pa.int32()))], names=["tokens", "p"])

    return F.arrow_udf(score, "struct<tokens:long,p:array<int>>")


def with_posteriors(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", into: str = "mix", training: int = TRAINING_DOCUMENTS) -> DataFrame:
    """``docs`` with a struct column ``into``: ``tokens`` and ``p``, the posteriors in the order of DOMAINS
    and in thousandths that add up to 1000."""
    domain = F.when(F.col("toxic") > 0, 2).when(F.col("quality") <= 0, 1).otherwise(0)
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    known = known.groupBy(F.col("doc_id").alias("of")).agg(F.max(domain).alias("label"))
    share = min(1.0, training / max(1, known.count()))
    # Bounded by ``training`` (about), so small enough to go to every executor.
    known = known.filter(F.pmod(F.xxhash64("of"), F.lit(1_000_000)) < F.lit(share * 1_000_000))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id}`").alias("id"), body.alias("body")).join(F.broadcast(known), F.col("id") == F.col("of"))
    rows = stored(rows.select("body", F.col("label").cast("double")), "labelled")
    seen = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weights, intercepts = np.zeros((FEATURES + DENSE, len(DOMAINS))), np.zeros(len(DOMAINS))
    if len(seen) < 2:
        intercepts = np.log([(seen.get(k, 0) + 1) / (sum(seen.values()) + len(DOMAINS)) for k in range(len(DOMAINS))])
    else:
        # One partition in one order: sums of doubles come out the same every time. Bounded by ``training``.
        train = rows.select("label", "body", _vector("body").alias("features")).coalesce(1).sortWithinPartitions("label", "body")
        train = stored(train.select("label", "features"), "training")
        model = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", regParam=0.01, maxIter=60).fit(train.coalesce(1))
        held = model.coefficientMatrix.toArray().T
        weights[:, : held.shape[1]] = held
        intercepts[:] = -np.inf
        intercepts[: held.shape[1]] = model.interceptVector.toArray()
        intercepts[[k for k in range(len(DOMAINS)) if k not in seen]] = -np.inf
    others = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*others, _scorer(weights, intercepts)(body).alias(into))


def metric(gram: np.ndarray) -> np.ndarray:
    """How misses of the targets weigh: by the inverse of the Gram matrix and a hundredth of its largest
    value. Without that part, a domain that hardly occurs would outweigh all others where its target is out
    of reach, and all documents would be repeated for the little they have of it."""
    return np.linalg.inv(gram + 0.01 * np.linalg.eigvalsh(gram)[-1] * np.eye(len(gram)))


@dataclass(frozen=True)
class Rates:
    """The fitted rate of each cell (``p``, ``rate``), and by how much each domain's expected tokens miss
    their target, as a share of all tokens wanted."""

    cells: DataFrame
    missing: tuple[float, ...]
    steps: int

    def joined(self, rows: DataFrame, column: str, out: str) -> DataFrame:
        """``rows`` with their rate. There are 501,501 cells at most, of a few bytes each."""
        p = [F.col(f"`{column}`.p")[k] for k in range(2)]
        cells = self.cells.select(F.col("p")[0].alias("__p0"), F.col("p")[1].alias("__p1"), F.col("rate").alias(out))
        return rows.join(F.broadcast(cells), (p[0] == F.col("__p0")) & (p[1] == F.col("__p1"))).drop("__p0", "__p1")


def fitted_rates(rows: DataFrame, column: str = "mix", weights=WEIGHTS, budget: float | None = None, keep: int | None = None, most: float = MOST, within: float = 1e-6) -> Rates:
    """Projected gradient for token totals ``weights`` times ``budget`` (default: all tokens).

    ``keep`` names a domain that is to keep its own tokens: the budget is then what makes them its share.
    Ends when every total is within ``within`` of the budget of its target, or nothing more is to be
    gained. A table without tokens leaves all rates at 1.
    """
    n, p = len(DOMAINS), F.col("p")
    cells = rows.groupBy(F.col(f"`{column}`.p").alias("p")).agg(F.sum(F.col(f"`{column}`.tokens")).alias("t"))
    cells = stored(cells.withColumns({"r": F.lit(UNIT).cast("long"), "y": F.lit(UNIT).cast("long")}).coalesce(4), "cells")
    rated = lambda df: df.select("p", (F.col("r") / UNIT).alias("rate"))
    whole = lambda c: c.cast("decimal(20,0)")
    pairs = [(a, b) for a in range(n) for b in range(a, n)]
    sums = cells.agg(*(F.sum(F.col("t") * p[k]).alias(f"t{k}") for k in range(n)), *(F.sum(whole(F.col("t") * p[a]) * p[b]).alias(f"g{a}{b}") for a, b in pairs)).first()
    total = sum(sums[f"t{k}"] or 0 for k in range(n)) / PARTS
    if not total:
        return Rates(rated(cells), (0.0,) * n, 0)
    gram = np.zeros((n, n))
    for a, b in pairs:
        gram[a, b] = gram[b, a] = float(sums[f"g{a}{b}"]) / PARTS**2
    inverse = metric(gram)
    shares = np.array(weights, float) / sum(weights)
    wanted = float(budget) if budget else sums[f"t{keep}"] / PARTS / shares[keep] if keep is not None and sums[f"t{keep}"] else total
    target = shares * wanted

    def off(df: DataFrame, at: str) -> np.ndarray:
        found = df.agg(*(F.sum(whole(F.col("t") * p[k]) * whole(F.col(at))).alias(f"e{k}") for k in range(n))).first()
        return np.array([float(found[f"e{k}"]) for k in range(n)]) / (PARTS * UNIT) - target

    limit = F.lit(round(most * UNIT)).cast("long")
    state = F.struct(*(F.col(c).alias(n_) for c, n_ in (("r", "old"), ("y", "from"), ("r", "r"), ("y", "y"))))

    def walk(now: Column, move: Column) -> Column:
        """One step of a cell, from where momentum took it."""
        begin = F.when(move["anew"], now["r"]).otherwise(now["y"])
        moved = F.round(begin - sum(p[k] * move["step"][k] for k in range(n))).cast("long")
        new = F.least(F.greatest(moved, F.lit(0).cast("long")), limit)
        further = F.round((new - now["r"]) * move["beta"]).cast("long")
        return F.struct(now["r"].alias("old"), begin.alias("from"), new.alias("r"), (new + further).alias("y"))

    def walked(moves: list[tuple]) -> DataFrame:
        steps = F.array(*(F.struct(F.array(*map(F.lit, step)).alias("step"), F.lit(beta).alias("beta"), F.lit(anew).alias("anew")) for step, beta, anew in moves))
        return cells.select("p", "t", F.aggregate(steps, state, walk).alias("s")).select("p", "t", "s.*")

    momentum, at, anew, moves = 1.0, 0, False, []
    gap = miss = off(cells, "r")
    for at in range(1, STEPS + 1):
        if np.abs(miss).max() <= within * wanted:
            break
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        moves.append(([float(x) for x in inverse @ gap * UNIT / PARTS], float((momentum - 1) / after), anew))
        momentum, anew, now = after, False, walked(moves)
        slope = sum(p[k] * float(x) for k, x in enumerate(inverse @ miss / PARTS))  # at the rates before
        found = now.agg(
            *(F.sum(whole(F.col("t") * p[k]) * whole(F.col(c))).alias(f"{c}{k}") for c in "ry" for k in range(n)),
            F.sum(F.col("t") * (slope * F.col("old") / UNIT - F.least(F.lit(0.0), slope * most))).alias("gain"),
            F.max(F.abs(F.col("r") - F.col("from"))).alias("moved"),
            F.sum((F.col("from") - F.col("r")).cast("double") * (F.col("r") - F.col("old")) * F.col("t")).alias("uphill"),
        ).first()
        left = miss @ inverse @ miss
        miss, gap = (np.array([float(found[f"{c}{k}"]) for k in range(n)]) / (PARTS * UNIT) - target for c in "ry")
        # Where rates cannot be told apart in millionths, the gain may stay above its limit.
        if found["gain"] <= SETTLED * left or found["moved"] <= 1:
            break
        if found["uphill"] > 0:  # momentum leads away from the targets: start it anew
            momentum, gap, anew = 1.0, miss, True
        if len(moves) == KEPT_STEPS:
            cells, moves = stored(now.select("p", "t", "r", "y"), "cells"), []
    else:
        log.warning("rates have not settled after %d steps", STEPS)
    cells = walked(moves) if moves else cells
    missing = tuple(float(x) for x in np.round(miss / wanted, 9))
    if max(map(abs, missing)) > within:
        log.warning("targets are out of reach with rates up to %s: off by %s of the tokens", most, dict(zip(DOMAINS, missing)))
    return Rates(rated(stored(cells, "cells")), missing, at)


def copies(rate: Column, *keys: Column) -> Column:
    """floor(rate), and once more with a chance of the rest, drawn by a hash of the keys."""
    chance = F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + chance).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", weights=WEIGHTS, keep: int | None = 0, most: float = MOST) -> DataFrame:
    """``docs`` drawn at the fitted rates: a row occurs floor(rate) times, and once more with a chance of
    the rest. By default good documents keep their tokens and the others are fitted to them. Rows that
    are the same are drawn alike."""
    rows = stored(with_posteriors(docs, labels, id, text, "__mix"), "posteriors")
    drawn = fitted_rates(rows, "__mix", weights, keep=keep, most=most).joined(rows, "__mix", "__rate")
    times = copies(F.col("__rate"), F.col(f"`{id}`"), F.col(f"`{text}`"))
    return drawn.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).select(*(F.col(f"`{c}`") for c in docs.columns))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = stored(with_posteriors(docs, labels).select("doc_id", "mix"), "posteriors")
    p = F.col("mix.p")
    out = fitted_rates(rows).joined(rows, "mix", "rate")
    return out.select("doc_id", F.col("mix.tokens").alias("n_tokens"), *((p[k] / PARTS).alias(f"p_{d}") for k, d in enumerate(DOMAINS)), "rate")


QUERIES = {"op6_mixing": op6_mixing}
