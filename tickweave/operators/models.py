"""Boosted-tree training and scoring over dataset tables, with the metadata that scoring needs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from . import boosting
from .boosting import Boosted
from .datasets import feature_columns


def train_regressor(rows: DataFrame, features: list[str] | None = None, target: str = "target", depth: int = 6, rate: float = 0.05, rounds: int = 50, **more) -> tuple[Boosted, dict]:
    """Squared loss. Missing values go to the side that they fit better (see ``boosting``, also for ``more``)."""
    features = features or feature_columns(rows)
    return boosting.fit(rows, features, target, depth=depth, rate=rate, rounds=rounds, **more), {"featureColumns": features, "target": target}


def train_classifier(rows: DataFrame, features: list[str] | None = None, target: str = "target", depth: int = 6, rate: float = 0.05, rounds: int = 30, **more) -> tuple[Boosted, dict]:
    """Any number of classes in one model (softmax)."""
    features = features or feature_columns(rows)
    return boosting.fit(rows, features, target, classes=True, depth=depth, rate=rate, rounds=rounds, **more), {"featureColumns": features, "target": target}


def predict(model: Boosted, meta: dict, rows: DataFrame) -> DataFrame:
    """Rows with ``prediction``; their own columns are unchanged."""
    return boosting.predict(model, rows)


def save(model: Boosted, meta: dict, path: str) -> None:
    """Writes the model, and its metadata, as JSON texts."""
    spark = SparkSession.getActiveSession()
    for name, text in (("model", model.to_json()), ("meta", json.dumps(meta))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> tuple[Boosted, dict]:
    model, meta = (spark.read.text(f"{path}/{name}").first()[0] for name in ("model", "meta"))
    return Boosted.from_json(model), json.loads(meta)
