"""Fitted models stored by month and run, on any file system Spark can reach."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def model_path(uri: str, model_name: str, month: str, run: str) -> str:
    return f"{uri.rstrip('/')}/{model_name}/month={month}/run={run}"


def save_model(model: PipelineModel, uri: str, model_name: str, month: str, run: str) -> str:
    """Save a fitted pipeline; saving the same run again replaces it."""
    path = model_path(uri, model_name, month, run)
    model.write().overwrite().save(path)
    return path


def load_model(uri: str, model_name: str, month: str, run: str) -> PipelineModel:
    return PipelineModel.load(model_path(uri, model_name, month, run))
