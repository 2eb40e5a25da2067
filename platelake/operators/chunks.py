"""Site images to chunked arrays, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.functions.paths import array_path
from platelake.functions.tensors import cut_image, cut_planes, put_together
from platelake.operators.stack import plane_column
from platelake.schemas import SITE_KEY


def _rows(sites: DataFrame, channels: Column, dtype: str, pieces: Column) -> DataFrame:
    return sites.select(
        array_path().alias("array_path"), *SITE_KEY, "height", "width",
        channels.alias("channels"), F.lit(dtype).alias("dtype"), F.inline(pieces),
    )


def to_chunks(stacked: DataFrame, chunk: int = 512, dtype: str = "<u2") -> DataFrame:
    """One row per (chunk, chunk, all channels) piece of every HWC image, its
    values widened to ``dtype``."""
    if chunk < 1:
        raise ValueError("chunk must be positive")
    channels = F.col("channels")
    pieces = cut_image(F.col("image"), F.col("height"), F.col("width"), channels, chunk, dtype)
    return _rows(stacked, channels, dtype, pieces)


def planes_to_chunks(
    grouped: DataFrame, channels: Sequence[int], chunk: int = 512, dtype: str = "<u2"
) -> DataFrame:
    """The same from the result of group_planes."""
    if chunk < 1:
        raise ValueError("chunk must be positive")
    planes = [plane_column(c) for c in channels]
    pieces = cut_planes(planes, F.col("height"), F.col("width"), chunk, dtype)
    return _rows(grouped, F.lit(len(channels)), dtype, pieces)


_ARRAY = ("array_path", *SITE_KEY, "height", "width", "channels", "dtype")
_PIECE = ("y0", "x0", "rows", "cols", "data")


def _window(chunks: DataFrame, strict: bool, top, bottom, left, right) -> DataFrame:
    """The part of each array inside a window that is given by columns of it.

    Arrays whose part lies in one piece take no part in the exchange; of the
    others only pieces that meet the window are shuffled.
    """
    inside = chunks.where(
        (F.col("y0") < bottom) & (F.col("y1") > top) & (F.col("x0") < right) & (F.col("x1") > left))
    alone = ((F.col("y0") <= top) & (F.col("y1") >= bottom)
             & (F.col("x0") <= left) & (F.col("x1") >= right))
    piece = F.struct(*_PIECE)
    single = inside.where(alone).select(*_ARRAY, F.array(piece).alias("pieces"))
    several = inside.where(~alone).groupBy(*_ARRAY).agg(F.collect_list(piece).alias("pieces"))
    found = single.unionByName(several)
    covered = F.aggregate("pieces", F.lit(0).cast("long"), lambda total, p: total + (
        (F.least(p["y0"] + p["rows"], bottom) - F.greatest(p["y0"], top))
        * (F.least(p["x0"] + p["cols"], right) - F.greatest(p["x0"], left))))
    whole = covered == (bottom - top).cast("long") * (right - left)
    if strict:
        whole = F.when(whole, True).otherwise(F.raise_error(F.concat(
            F.lit("pieces are missing or there twice: "), "array_path")).cast("boolean"))
    image = put_together(
        F.col("pieces"), F.col("dtype"), F.col("channels"), top, bottom, left, right)
    return found.where(whole).select(
        *[c for c in _ARRAY if c not in ("height", "width")],
        (bottom - top).alias("height"), (right - left).alias("width"), image.alias("image"))


def assemble_arrays(chunks: DataFrame, strict: bool = True) -> DataFrame:
    """One HWC image per array, its values as wide as its ``dtype``. Strict: an
    array that lacks pieces, or has one twice, is an error; otherwise it is left
    out. Arrays of one piece are not shuffled."""
    zero = F.lit(0)
    return _window(chunks, strict, zero, F.col("height"), zero, F.col("width"))


def read_window(
    chunks: DataFrame, top: int, left: int, height: int, width: int, strict: bool = True
) -> DataFrame:
    """The same window of every array, cut to its image; images that do not
    reach the window have no row. The bounds are compared with plain numbers,
    so the scan skips files and row groups whose pieces lie elsewhere."""
    if top < 0 or left < 0 or height < 1 or width < 1:
        raise ValueError("a window starts at 0 or later and holds a pixel at least")
    near = chunks.where(
        (F.col("y0") < top + height) & (F.col("y1") > top)
        & (F.col("x0") < left + width) & (F.col("x1") > left))
    bottom = F.least(F.col("height"), F.lit(top + height))
    right = F.least(F.col("width"), F.lit(left + width))
    return _window(near, strict, F.lit(top), bottom, F.lit(left), right)
