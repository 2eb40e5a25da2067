"""Scoring and evaluation of a caller's classifier."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.model_cache import ModelCache
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.functions.scores import (
    cross_entropy, in_top_k, is_best, predicted_class, probabilities,
)


def score(
    examples: DataFrame,
    make_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
    shape: Sequence[int],
    batch: int = 32,
    image: str = "image",
) -> DataFrame:
    """Adds ``logits``. ``make_model`` is called once per Python worker and
    returns a function from float32 [n, *shape] to logits [n, classes].

    ``image`` holds float32 bytes. They go to the model as they are: turning a
    megabyte image into a Spark array first takes most of the time.
    """
    shape = tuple(shape)
    key = uuid.uuid4()

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def model(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = ModelCache.get(key)
        if run is None:
            run = make_model()
            ModelCache.add(key, run)
        for images in batches:
            logits = []
            for start in range(0, len(images), batch):
                part = images.iloc[start:start + batch]
                pixels = np.stack([np.frombuffer(raw, "<f4").reshape(shape) for raw in part])
                logits.extend(np.asarray(run(pixels), np.float32))
            yield pd.Series(logits, dtype=object)

    return examples.withColumn("logits", model(F.col(image)))


def predict(scored: DataFrame, logits: str = "logits") -> DataFrame:
    """Predicted class and class probabilities."""
    return scored.withColumns({
        "class": predicted_class(F.col(logits)),
        "probabilities": probabilities(F.col(logits)),
    })


def evaluate(
    scored: DataFrame, logits: str = "logits", label: str = "label", k: int = 5
) -> DataFrame:
    """Accuracy over the ``n`` rows with a label: best class right, and right
    class in the best k. Rows without one are counted as ``n_unlabelled``."""
    hits = {"top_1_accuracy": is_best(F.col(logits), F.col(label))}
    if k != 1:
        hits[f"top_{k}_accuracy"] = in_top_k(F.col(logits), F.col(label), k)
    return scored.agg(
        F.count(label).alias("n"),
        F.count(F.when(F.col(label).isNull(), 1)).alias("n_unlabelled"),
        *[F.avg(hit.cast("double")).alias(name) for name, hit in hits.items()],
    )


def mean_cross_entropy(
    scored: DataFrame, logits: str = "logits", label: str = "label"
) -> DataFrame:
    """Mean loss over the ``n`` rows with a label."""
    return scored.agg(
        F.count(label).alias("n"),
        F.avg(cross_entropy(F.col(logits), F.col(label))).alias("loss"),
    )
