"""Weighted mean of model scores."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights in training and in serving.
TRAINING_WEIGHTS = {"boost_score": 0.7, "forest_score": 0.3}
SERVING_WEIGHTS = {"boost_score": 0.5, "forest_score": 0.5}


def ensemble(weights: Mapping[str, float]) -> Column:
    """Sum of weight * score column, in the given order."""
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(c) for c, w in weights.items()])
