"""The registered queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, chat, clusters, line_chunks, lm_scores, minhash, mixing, order_minhash, passages, quality, search, secrets, urls

_MODULES = (bpe, passages, urls, line_chunks, secrets, mixing, quality, minhash, order_minhash, lm_scores, chat, search, clusters)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLE_SQL", {}).items()}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
