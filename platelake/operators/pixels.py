"""Pixel work on tables of one row per pixel (site, channel, px, val)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.schemas import CHANNELS, COLOUR_MAP, PIXEL_STATS


def _inline(spark: SparkSession, rows, columns: str) -> DataFrame:
    values = ", ".join("(" + ", ".join(f"{v!r}D" if isinstance(v, float) else repr(v) for v in r) + ")"
                       for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def colour_table(spark: SparkSession, colour_map=COLOUR_MAP, channels=CHANNELS) -> DataFrame:
    rows = [r for r in colour_map if r[0] in set(channels)]
    return _inline(spark, rows, "channel, red, green, blue, low, high")


def stats_table(spark: SparkSession, stats=PIXEL_STATS) -> DataFrame:
    rows = [(int(c), float(m), float(s)) for c, m, s in stats]
    return _inline(spark, rows, "channel, mean, std")


def _looked_up(pixels: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """Pixels with the values of their channel; an unknown channel is an error."""
    joined = pixels.join(F.broadcast(table), "channel", "left")
    error = F.raise_error(F.concat(F.lit("unknown channel "), F.col("channel").cast("string")))
    return joined.withColumn(value, F.coalesce(F.col(value), error.cast(table.schema[value].dataType)))


def to_rgb_rows(
    pixels: DataFrame,
    keys: Sequence[str],
    channels: Sequence[int] | None = None,
    vmax: float = 255,
    colour_map=COLOUR_MAP,
) -> DataFrame:
    """False colour per pixel: each channel's share of its colour is cut to a
    whole number, the channels are added and the sum is clipped at 255.
    Without ``channels`` all pixels are coloured; a channel without a colour
    is an error."""
    known = [r[0] for r in colour_map]
    if channels is not None:
        if set(channels) - set(known):
            raise ValueError(f"no colour for channels {sorted(set(channels) - set(known))}")
        pixels = pixels.where(F.col("channel").isin(list(channels)))
    colours = colour_table(pixels.sparkSession, colour_map, known)
    level = F.col("val") / F.lit(float(vmax))
    span = (F.col("high") - F.col("low")) / F.lit(255.0)
    share = F.least(F.lit(1.0), level / span + F.col("low") / F.lit(255.0))

    def total(name: str):
        return F.least(F.lit(255).cast("long"), F.sum((F.col("_share") * F.col(name)).cast("long")))

    return (
        _looked_up(pixels, colours, "low")
        .withColumn("_share", share)
        .groupBy(*keys, "px")
        .agg(total("red").alias("r"), total("green").alias("g"), total("blue").alias("b"))
    )


def normalise_rows(pixels: DataFrame, stats=PIXEL_STATS) -> DataFrame:
    return (
        _looked_up(pixels, stats_table(pixels.sparkSession, stats), "std")
        .withColumn("normalised", (F.col("val").cast("double") - F.col("mean")) / F.col("std"))
        .drop("mean", "std")
    )


def unit_scale_rows(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("scaled", F.col("val") / F.lit(255.0))


def index_rows(pixels: DataFrame, n_channels: int, plane_size: int) -> DataFrame:
    """Offset of each pixel in the channel-last and channel-first layouts."""
    px, c = F.col("px").cast("long"), F.col("channel") - 1
    return pixels.withColumns({
        "hwc_index": px * n_channels + c,
        "chw_index": c * F.lit(plane_size).cast("long") + px,
    })


def stack_rows(
    pixels: DataFrame, keys: Sequence[str], channels: Sequence[int] = CHANNELS
) -> DataFrame:
    """One row per pixel with a column per channel; incomplete pixels go."""
    pick = [F.max(F.when(F.col("channel") == c, F.col("val"))).alias(f"c{c}") for c in channels]
    stacked = pixels.where(F.col("channel").isin(list(channels))).groupBy(*keys, "px").agg(*pick)
    return stacked.dropna(subset=[f"c{c}" for c in channels])


def _stats(sums: DataFrame) -> DataFrame:
    """Mean and population deviation from whole-number sums per channel."""
    n = F.col("n").cast("double")
    mean = F.col("total") / n
    return sums.select(
        "channel", "n", mean.alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / n - mean * mean)).alias("std"),
    )


def pixel_stats_rows(pixels: DataFrame) -> DataFrame:
    value = F.col("val").cast("long")
    return _stats(pixels.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.sum(value * value).alias("squares"),
    ))


def usable(images: DataFrame):
    """Readable planes of one byte per pixel, as far as the table tells."""
    known = F.col("data").isNotNull()
    if "readable" in images.columns:
        known = known & F.coalesce("readable", F.lit(False))
    if {"height", "width"} <= set(images.columns):
        known = known & (F.octet_length("data") == F.col("height") * F.col("width"))
    return F.coalesce(known, F.lit(False))


def unusable_planes(images: DataFrame) -> DataFrame:
    """What pixel_stats leaves out, without the bytes."""
    return images.where(~usable(images)).drop("data")


def pixel_stats(images: DataFrame) -> DataFrame:
    """The same from plane bytes (channel, data): each plane becomes three
    whole numbers, and only those are shuffled. Planes that are null, not
    readable or not of one byte per pixel are left out; ``unusable_planes``
    lists them."""

    values = np.arange(256, dtype=np.int64)

    def summarise(batches):
        for batch in batches:
            counts = [
                np.bincount(np.frombuffer(d, np.uint8), minlength=256) for d in batch["data"]
            ]
            yield pd.DataFrame({
                "channel": batch["channel"],
                "n": [int(c.sum()) for c in counts],
                "total": [int(c @ values) for c in counts],
                "squares": [int(c @ (values * values)) for c in counts],
            })

    sums = (
        images.where(usable(images)).select("channel", "data")
        .mapInPandas(summarise, "channel int, n long, total long, squares long")
        .groupBy("channel")
        .agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    )
    return _stats(sums)
