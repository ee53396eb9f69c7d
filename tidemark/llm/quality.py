"""Quality rules by weak supervision: rules vote or abstain, and the votes are weighed.

Each rule looks at one measure of a text and votes for it, against it, or not at all. How far a rule
can be trusted is not given: expectation-maximisation estimates, over all documents, how often each
rule is right on good and on poor texts, and the share of good texts. A text's verdict is the
posterior probability of being good under these estimates. Everything is built from Spark's own
column functions. The estimates are fitted on the table of distinct vote patterns, which has at most
3 ** len(RULES) rows whatever the number of documents, so the texts are measured once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

# White space, symbols, and the limits of the base verdict.
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
MARKS = SYMBOLS + "0123456789@^~=+_{}[]()\\/\"!?"
FUNCTION_WORDS = (
    "the of and to in is it that der die das und den ist nicht mit ein le la les de des et un une que el los las en del y por"
).split()
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _pairs(values: Column, by: int) -> Column:
    """Hash of each element with the one ``by`` places on; the last ``by`` are of no use."""
    return F.zip_with(values, _shifted(values, by), lambda a, b: F.xxhash64(a, b))


def measured(docs: DataFrame, text: str, into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into`` of the measures of ``text``; row for row, no shuffle.

    A null text counts as empty: all measures are 0. A column that is already called ``into`` is
    replaced; no other column is touched. Windows of eight words are compared by 64-bit hashes.
    Time grows with the length of a text (times its logarithm for texts with repeats).
    """
    work = "__" + into
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(F.translate(body, SPACES[:-1], " " * 5), " "), "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(*docs.drop(into).columns, body.alias(work), words.alias(work + "_words"), lines.alias(work + "_lines"))
    # Eight-word windows from hashes of pairs, of fours, and of eights.
    for name, value in (
        ("_one", F.transform(F.col(work + "_words"), lambda w: F.xxhash64(w))),
        ("_two", _pairs(F.col(work + "_one"), 1)),
        ("_four", _pairs(F.col(work + "_two"), 2)),
        ("_eight", F.slice(_pairs(F.col(work + "_four"), 4), 1, F.greatest(F.size(work + "_words") - (WINDOW - 1), F.lit(0)))),
    ):
        out = out.withColumn(work + name, value)
    eight, repeats = F.col(work + "_eight"), F.col(work + "_repeats")
    # Only texts with a repeated window sort theirs; equal windows are then neighbours.
    out = out.withColumn(
        work + "_repeats",
        F.when(
            F.size(F.array_distinct(eight)) < F.size(eight),
            F.sort_array(F.transform(eight, lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
        ),
    )
    out = out.withColumn(
        work + "_at",
        F.sort_array(
            F.transform(
                F.filter(repeats, lambda x, i: (x["h"] == F.get(repeats, i - 1)["h"]) | F.coalesce(x["h"] == F.get(repeats, i + 1)["h"], F.lit(False))),
                lambda x: x["at"],
            )
        ),
    )
    at = F.col(work + "_at")
    covered = F.aggregate(F.zip_with(at, _shifted(at, 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda s, x: s + x)
    lines = F.col(work + "_lines")
    long = lambda c: c.cast("long")
    text_ = F.col(work)
    upper = F.char_length(text_) - _without(text_, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    ended = F.size(F.filter(lines, lambda line: line.rlike(r"[.!?:;][\"')\]]*[\x20\x09-\x0D]*$")))
    struct = F.struct(
        long(F.size(work + "_words")).alias("n_words"),
        long(_without(text_, SPACES)).alias("word_chars"),
        long(F.char_length(text_) - _without(text_, SYMBOLS)).alias("n_symbols"),
        long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        long(F.size(lines)).alias("n_lines"),
        long(ended).alias("n_ended_lines"),
        long(upper).alias("n_upper"),
        long(F.char_length(text_) - _without(text_, MARKS)).alias("n_marks"),
        long(F.size(F.filter(F.col(work + "_words"), lambda w: F.lower(w).isin(*FUNCTION_WORDS)))).alias("n_function_words"),
        long(F.size(F.array_distinct(work + "_one"))).alias("n_distinct_words"),
    )
    return out.select(*docs.drop(into).columns, struct.alias(into))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules(q: Column) -> dict[str, Column]:
    """The vote of every rule: 1 for, -1 against, 0 where it abstains."""
    words, chars, lines = q["n_words"], q["word_chars"], q["n_lines"]
    enough = words >= MIN_WORDS
    return {
        "length": _vote(words >= 40, ~enough),
        "word_length": _vote((chars >= 3 * words) & (chars <= 9 * words), (chars < 2 * words) | (chars > 14 * words)),
        "symbols": _vote(50 * q["n_symbols"] <= words, 10 * q["n_symbols"] > words),
        "marks": _vote(50 * q["n_marks"] <= chars, 12 * q["n_marks"] > chars),
        "duplicate_lines": _vote((lines >= 4) & (q["n_dup_lines"] == 0), 4 * q["n_dup_lines"] > lines),
        "repeats": _vote((words >= 40) & (20 * q["n_repeat_words"] <= words), 4 * q["n_repeat_words"] > words),
        "variety": _vote(enough & (3 * q["n_distinct_words"] >= words), enough & (5 * q["n_distinct_words"] < words)),
        "function_words": _vote(enough & (20 * q["n_function_words"] >= words), enough & (50 * q["n_function_words"] < words)),
        "line_ends": _vote(2 * q["n_ended_lines"] >= lines, (lines > 0) & (5 * q["n_ended_lines"] < lines)),
        "capitals": _vote(10 * q["n_upper"] <= chars, 4 * q["n_upper"] > chars),
    }


RULES = ("length word_length symbols marks duplicate_lines repeats variety function_words line_ends capitals").split()


@dataclass(frozen=True)
class Weights:
    """What expectation-maximisation found: the share of good texts and, for each rule, the chance that
    its vote is right on a good (``on_good``) and on a poor text (``on_poor``), where it votes at all."""

    prior: float
    on_good: dict[str, float]
    on_poor: dict[str, float]

    def numbers(self) -> list[float]:
        return [self.prior, *self.on_good.values(), *self.on_poor.values()]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """Probability that a text with these votes is good; a rule that abstains has no say.

        The log odds are looked up by the vote in constant arrays, so the code that Spark compiles is
        the same in every round and for all weights.
        """
        odds, prior = F.lit(0.0), math.log(self.prior / (1 - self.prior))
        for name, vote in votes.items():
            good, poor = self.on_good[name], self.on_poor[name]
            table = (math.log((1 - good) / poor), 0.0, math.log(good / (1 - poor)))
            odds = odds + F.get(F.array(*(F.lit(x + prior) for x in table)), vote + 1)
            prior = 0.0
        return F.round(1 / (1 + F.exp(-odds)), 9)


# What is believed before any text is seen, and how many texts that belief counts for.
BELIEF = Weights(0.8, dict.fromkeys(RULES, 0.98), dict.fromkeys(RULES, 0.4))
BELIEF_TEXTS = 20.0


def fitted(measures: DataFrame, column: str = "quality", rounds: int = 12) -> Weights:
    """The weights of the rules, by expectation-maximisation over all rows.

    The belief above counts as BELIEF_TEXTS votes on texts of each kind, so a rule that hardly votes
    keeps cautious weights. No rule is turned around: a vote against stays likelier on poor texts than
    on good ones. Ends when nothing moves by 0.0001, or after ``rounds``. An empty table gives the belief.
    """
    patterns = measures.groupBy(*(v.cast("byte").alias(n) for n, v in rules(F.col(column)).items())).agg(F.count("*").alias("n"))
    patterns = stored(patterns.coalesce(1), "vote-patterns")
    weights = BELIEF
    for _ in range(rounds):
        p = weights.posterior({n: F.col(n) for n in RULES})
        sums = []
        for kind, share, right in (("good", F.col("n") * p, 1), ("poor", F.col("n") * (1 - p), -1)):
            sums.append(F.sum(share).alias(kind))
            for n in RULES:
                sums += [F.sum(F.when(F.col(n) == right, share)).alias(f"{kind}_{n}_right"), F.sum(F.when(F.col(n) != 0, share)).alias(f"{kind}_{n}")]
        found = {k: v or 0.0 for k, v in patterns.agg(*sums).first().asDict().items()}
        rate = lambda kind, n, before: (found[f"{kind}_{n}_right"] + BELIEF_TEXTS * before[n]) / (found[f"{kind}_{n}"] + BELIEF_TEXTS)
        good = {n: round(min(0.999, max(0.5, rate("good", n, BELIEF.on_good))), 6) for n in RULES}
        poor = {n: round(min(0.999, max(1.001 - good[n], rate("poor", n, BELIEF.on_poor))), 6) for n in RULES}
        prior = (found["good"] + BELIEF_TEXTS * BELIEF.prior) / (found["good"] + found["poor"] + BELIEF_TEXTS)
        before, weights = weights, Weights(round(min(0.999, max(0.05, prior)), 6), good, poor)
        if all(abs(x - y) < 1e-4 for x, y in zip(weights.numbers(), before.numbers())):
            break
    return weights


def judged(measures: DataFrame, weights: Weights, column: str = "quality", threshold: float = 0.2) -> DataFrame:
    """Adds ``posterior``, ``base_failed`` and ``kept`` to the struct ``column``.

    A text is rejected where poor is at least four times as likely as good, so doubtful texts stay.
    """
    q = F.col(column)
    p = weights.posterior(rules(q))
    return measures.withColumn(
        column,
        q.withField("posterior", p).withField("base_failed", base_failed(q)).withField("kept", ~base_failed(q) & (p >= threshold)),
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is judged good, with the columns of ``docs``.

    Null and empty texts fail the base rules. Repeated rows get the same verdict.
    """
    rows = stored(measured(docs, text, "__verdict"), "measured")
    good = judged(rows, fitted(rows, "__verdict"), "__verdict")
    return good.filter(F.col("__verdict.kept")).select(docs.columns)


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = stored(measured(docs, "text").select("doc_id", "quality"), "measured")
    out = judged(rows, fitted(rows)).select("doc_id", "quality.*")
    return out.select("doc_id", *MEASURES, "base_failed", "kept", "posterior")


QUERIES = {"op8_quality_rules": op8_quality_rules}
