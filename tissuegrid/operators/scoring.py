"""Slot for a user's tile classifier."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def classify(tiles: DataFrame, make_predict: Callable, features: str, width: int, batch: int = 1024) -> DataFrame:
    """Add ``logits`` and ``predicted`` (their argmax). ``make_predict`` loads the model once per worker.

    The returned function maps an (n, width) array to (n, classes) logits.
    """
    score = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch, input_tensor_shapes=[[width]])
    scored = tiles.withColumn("logits", score(F.col(features)))
    return scored.withColumn("predicted", (F.array_position("logits", F.array_max("logits")) - 1).cast("int"))


def linear_model(weights: np.ndarray) -> Callable:
    """Ready-made ``make_predict`` for a weight matrix (width, classes)."""
    def make():
        return lambda x: np.asarray(x, dtype=float).reshape(-1, weights.shape[0]) @ weights

    return make
