"""From raw documents to token ids: quality rules, line dedup, near-dedup, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, what the stage before it
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_chunks, minhash, mixing, quality
from tidemark.session import stored

NEAR_PERCENT = 80
NEAR_BANDS = 40  # of 5: a pair at 0.80 is missed with a chance of 1.3e-7


def quality_rules(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents that the weighed rules do not reject."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Texts without chunks of lines that an earlier document has; documents left without words go."""
    return line_chunks.dedup_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """One document of each near-duplicate group, linked from a similarity of 0.80 on."""
    return minhash.keep_first(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents drawn at the rates that give the target weights; a rate above 1 repeats a document."""
    return mixing.mixed(docs, spark.read.parquet(f"{sf}/labels.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Token ids of every text, with the document's id, language and source."""
    out = bpe.encode(docs, "text", ["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing", mixing_weights),
    ("BPE encoding", encoding),
]

# Expectation-maximisation, rolling hashes, projected gradient and BPE are beyond one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
