"""Fitted forests on a shared path, as a Parquet table of one row per tree."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession

from ..operators.forest import Forest

SCHEMA = """tree int, features array<string>, importance array<double>,
    feature array<int>, cut array<double>, late array<double>"""


def save_model(model: Forest, path: str) -> None:
    """Replace the model at ``path``."""
    rows = [
        (t, model.features, model.importance.tolist(), feature.tolist(), cut.tolist(), late.tolist())
        for t, (feature, cut, late) in enumerate(zip(model.feature, model.cut, model.late))
    ]
    spark = SparkSession.active()
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(path: str) -> Forest:
    rows = SparkSession.active().read.schema(SCHEMA).parquet(path).orderBy("tree").collect()
    return Forest(
        list(rows[0]["features"]),
        np.array([r["feature"] for r in rows], np.int32),
        np.array([r["cut"] for r in rows]),
        np.array([r["late"] for r in rows]),
        np.array(rows[0]["importance"]),
    )
