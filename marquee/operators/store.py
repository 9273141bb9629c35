"""Saved models with metadata, and the run log. Both are append-only tables next to the model folders."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from typing import Any

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.sources.frames import path_exists

INFO_SCHEMA = "name string, path string, saved_at timestamp_ntz, model_class string, metadata map<string,string>"
RUN_SCHEMA = (
    "experiment string, run_id string, run_name string, started_at timestamp_ntz, params map<string,string>, "
    "metrics map<string,double>, datasets map<string,string>")


def _text(value: Any) -> str:
    return value if isinstance(value, str) else json.dumps(value, default=str)


def save_model(spark: SparkSession, model: Model, name: str, root: str, at: dt.datetime,
               metadata: Mapping[str, Any] | None = None) -> str:
    """Save a fitted model under ``root/models`` and append its metadata row."""
    path = f"{root}/models/{name}"
    model.write().overwrite().save(path)
    row = (name, path, at, type(model).__name__, {k: _text(v) for k, v in (metadata or {}).items()})
    spark.createDataFrame([row], INFO_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/model_info")
    return path


def list_models(spark: SparkSession, root: str) -> DataFrame:
    """The latest metadata row of every saved model, by name."""
    if not path_exists(spark, f"{root}/model_info"):
        return spark.createDataFrame([], INFO_SCHEMA)
    rows = spark.read.schema(INFO_SCHEMA).parquet(f"{root}/model_info")
    newest = F.max_by(F.struct("path", "saved_at", "model_class", "metadata"), "saved_at").alias("r")
    return rows.groupBy("name").agg(newest).select("name", "r.*").orderBy("name")


def model_info(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Metadata of one model without loading it."""
    info = list_models(spark, root).where(F.col("name") == name)
    if info.isEmpty():
        raise FileNotFoundError(f"{root}/models/{name}")
    return info


def load_model(spark: SparkSession, name: str, root: str, with_metadata: bool = False):
    """The model, or (model, metadata)."""
    path = f"{root}/models/{name}"
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    model = DefaultParamsReader.loadParamsInstance(path, spark)
    if not with_metadata:
        return model
    return model, dict(model_info(spark, name, root).first()["metadata"])


def log_run(spark: SparkSession, root: str, experiment: str, run_id: str, run_name: str, at: dt.datetime,
            params: Mapping[str, Any], metrics: Mapping[str, float], datasets: Mapping[str, str]) -> None:
    """Append one run."""
    row = (experiment, run_id, run_name, at, {k: _text(v) for k, v in params.items()},
           {k: float(v) for k, v in metrics.items()}, dict(datasets))
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/runs")


def runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(f"{root}/runs")
