"""Counts of the 256 pixel values, per channel and whatever else: they add up,
and mean, deviation and exact percentiles follow from them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.operators.pixels import usable
from platelake.sources.plates import ARROW_TYPES

LEVELS = 256
PERCENTILES = (1, 50, 99)


def _sum_levels(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds arrays of counts place by place. Sums are combined before the
    shuffle, and a row of the result is 2 KB whatever it stands for."""
    spread = rows.select(*keys, F.posexplode("counts").alias("level", "n"))
    sums = spread.groupBy(*keys, "level").agg(F.sum("n").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("level", "n")))
    return sums.groupBy(*keys).agg(F.transform(ordered, lambda c: c["n"]).alias("counts"))


def pixel_histograms(images: DataFrame, groups: Sequence[str] = ("experiment",)) -> DataFrame:
    """``groups``, ``channel`` and ``counts``, how often each value 0 to 255
    occurs. Planes that pixel_stats would leave out are left out here too.

    A task adds planes up as it reads them, so one pass over the pixels sends
    256 numbers per task, group and channel.
    """
    keys = [*groups, "channel"]
    fields = [images.schema[k] for k in keys]
    schema = pa.schema([(f.name, ARROW_TYPES[type(f.dataType)]) for f in fields]
                       + [("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, np.ndarray] = {}
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in keys]
            for key, data in zip(zip(*columns, strict=True), batch.column("data"), strict=True):
                counts = np.bincount(np.frombuffer(data.as_buffer(), np.uint8), minlength=LEVELS)
                found[key] = found[key] + counts if key in found else counts
        rows = [dict(zip(keys, key, strict=True), counts=c.tolist()) for key, c in found.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    counted = images.where(usable(images)).select(*keys, "data").mapInArrow(
        run, f"{ddl}, counts array<long>")
    return _sum_levels(counted, keys)


def merge_histograms(histograms: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The histograms of coarser groups, without another look at pixels."""
    return _sum_levels(histograms, [*groups, "channel"])


def _total(counts: Column, weight) -> Column:
    """Sum over the levels of count times a weight, in whole numbers."""
    return F.aggregate(
        F.transform(counts, lambda n, level: n * weight(level.cast("long"))),
        F.lit(0).cast("long"), lambda a, b: a + b)


def percentile(counts: Column, n: Column, percent: float) -> Column:
    """The smallest value that at least ``percent`` of 100 of the ``n`` pixels
    do not exceed."""
    running = F.aggregate(
        F.transform(counts, lambda c, level: F.struct(level.alias("level"), c.alias("c"))),
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).alias("at")),
        lambda state, x: F.struct(
            (state["seen"] + x["c"]).alias("seen"),
            F.when((state["at"] < 0) & (x["c"] > 0)
                   & ((state["seen"] + x["c"]) * 100 >= n * percent), x["level"])
            .otherwise(state["at"]).alias("at")))
    return running["at"]


def histogram_stats(
    histograms: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> DataFrame:
    """``n``, ``mean``, population ``std`` and a column ``p<percent>`` each."""
    counts = F.col("counts")
    sums = histograms.withColumns({
        "n": _total(counts, lambda level: F.lit(1)),
        "_t": _total(counts, lambda level: level),
        "_s": _total(counts, lambda level: level * level),
    })
    n = F.col("n").cast("double")
    mean = F.col("_t") / n
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("_s") / n - mean * mean))
    return sums.withColumns({
        "mean": mean, "std": spread,
        **{f"p{p:g}": percentile(counts, F.col("n"), p) for p in percentiles},
    }).drop("counts", "_t", "_s")
