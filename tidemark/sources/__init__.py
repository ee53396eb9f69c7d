"""Datasets, tables and models outside the session."""

from tidemark.sources.datasets import (
    append_rows,
    append_run,
    materialize,
    read_dataset,
    read_rows,
    run_query,
    write_snapshot,
)
from tidemark.sources.models import load_model, model_path, save_model

__all__ = [
    "append_rows",
    "append_run",
    "load_model",
    "materialize",
    "model_path",
    "read_dataset",
    "read_rows",
    "run_query",
    "save_model",
    "write_snapshot",
]
