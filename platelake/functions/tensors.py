"""Arrow functions on pixel bytes: one call per batch, numpy inside.

A site image is stored as height*width*channels bytes, channel fastest
("HWC"), or as its planes one after the other ("CHW").
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.schemas import CHANNELS, COLOUR_MAP, PIXEL_STATS


def _per_row(function: Callable, return_type) -> Callable:
    """A pandas UDF that applies ``function`` to each row of its columns.
    Rows with a null input stay null."""

    @F.pandas_udf(return_type)
    def wrapped(*columns: pd.Series) -> pd.Series:
        rows = zip(*columns)
        return pd.Series([
            None if any(v is None for v in row) else function(*row) for row in rows
        ], dtype=object)

    return wrapped


def interleave_planes(planes: Sequence[Column]) -> Column:
    """Channel planes to HWC bytes, channel i being planes[i]."""

    def merge(*data):
        return np.stack([np.frombuffer(p, np.uint8) for p in data], axis=-1).tobytes()

    return _per_row(merge, T.BinaryType())(*planes)


def join_planes(planes: Sequence[Column]) -> Column:
    """Channel planes to CHW bytes; needs no Python."""
    return F.concat(*planes)


def decode_bytes(data: Column, dtype: str = "uint8") -> Column:
    """Bytes to an array of whole numbers."""

    def decode(raw):
        return np.frombuffer(raw, dtype).astype(np.int32)

    return _per_row(decode, T.ArrayType(T.IntegerType()))(data)


def decode_floats(data: Column) -> Column:
    def decode(raw):
        return np.frombuffer(raw, "<f4")

    return _per_row(decode, T.ArrayType(T.FloatType()))(data)


CHUNKS = T.ArrayType(T.StructType([
    T.StructField("cy", T.IntegerType()),
    T.StructField("cx", T.IntegerType()),
    T.StructField("rows", T.IntegerType()),
    T.StructField("cols", T.IntegerType()),
    T.StructField("y0", T.IntegerType()),
    T.StructField("y1", T.IntegerType()),
    T.StructField("x0", T.IntegerType()),
    T.StructField("x1", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
]))


def _pieces(pixels: np.ndarray, chunk: int) -> list[dict]:
    found = []
    for y in range(0, pixels.shape[0], chunk):
        for x in range(0, pixels.shape[1], chunk):
            piece = pixels[y:y + chunk, x:x + chunk]
            found.append({
                "cy": y // chunk, "cx": x // chunk, "rows": piece.shape[0],
                "cols": piece.shape[1], "y0": y, "y1": y + piece.shape[0],
                "x0": x, "x1": x + piece.shape[1], "data": piece.tobytes(),
            })
    return found


def cut_image(
    data: Column, height: Column, width: Column, channels: Column, chunk: int, dtype: str
) -> Column:
    """HWC bytes to a list of (chunk, chunk, all channels) pieces, row by row.
    Pieces at the edge are smaller, not padded."""

    def cut(raw, h, w, c):
        pixels = np.frombuffer(raw, np.uint8).reshape(int(h), int(w), int(c))
        return _pieces(pixels.astype(dtype), chunk)

    return _per_row(cut, CHUNKS)(data, height, width, channels)


def cut_planes(
    planes: Sequence[Column], height: Column, width: Column, chunk: int, dtype: str
) -> Column:
    """The same straight from channel planes: one trip through Python."""

    def cut(h, w, *data):
        merged = np.stack([np.frombuffer(p, np.uint8) for p in data], axis=-1)
        return _pieces(merged.reshape(int(h), int(w), len(data)).astype(dtype), chunk)

    return _per_row(cut, CHUNKS)(height, width, *planes)


def put_together(
    pieces: Column, dtype: Column, channels: Column,
    top: Column, bottom: Column, left: Column, right: Column,
) -> Column:
    """Rows [top, bottom) and columns [left, right) of an image from a list of
    its pieces (y0, x0, rows, cols, data), each cut to what lies inside."""

    def put(found, kind, c, y0, y1, x0, x1):
        out = np.zeros((int(y1 - y0), int(x1 - x0), int(c)), kind)
        for p in found:
            pixels = np.frombuffer(p["data"], kind).reshape(p["rows"], p["cols"], int(c))
            a, b = max(p["y0"], y0), min(p["y0"] + p["rows"], y1)
            s, t = max(p["x0"], x0), min(p["x0"] + p["cols"], x1)
            out[a - y0:b - y0, s - x0:t - x0] = pixels[
                a - p["y0"]:b - p["y0"], s - p["x0"]:t - p["x0"]]
        return out.tobytes()

    return _per_row(put, T.BinaryType())(pieces, dtype, channels, top, bottom, left, right)


def to_channel_first(data: Column, channels: Column) -> Column:
    """HWC bytes to CHW bytes."""

    def transpose(raw, n):
        return np.frombuffer(raw, np.uint8).reshape(-1, int(n)).T.tobytes()

    return _per_row(transpose, T.BinaryType())(data, channels)


def false_colour(
    data: Column,
    channels: Sequence[int] = CHANNELS,
    vmax: float = 255,
    colour_map=COLOUR_MAP,
) -> Column:
    """HWC bytes of ``channels`` to RGB bytes.

    A pixel value depends on nothing but its channel and the value, so each
    channel becomes a table of 256 colours and the picture a sum of look-ups.
    """
    by_channel = {row[0]: row[1:] for row in colour_map}
    level = np.arange(256, dtype=np.float64) / vmax
    tables = []
    for channel in channels:
        red, green, blue, low, high = by_channel[channel]
        share = np.minimum(1.0, level / ((high - low) / 255.0) + low / 255.0)
        tables.append(np.trunc(np.outer(share, (red, green, blue))).astype(np.int32))
    n = len(tables)

    def paint(raw):
        pixels = np.frombuffer(raw, np.uint8).reshape(-1, n)
        total = np.zeros((len(pixels), 3), np.int32)
        for i, table in enumerate(tables):
            total += np.take(table, pixels[:, i], axis=0)
        return np.minimum(total, 255).astype(np.uint8).tobytes()

    return _per_row(paint, T.BinaryType())(data)


def normalised(
    data: Column,
    channels: Sequence[int] = CHANNELS,
    stats=PIXEL_STATS,
    layout: str = "HWC",
) -> Column:
    """HWC bytes to little-endian float32 bytes, (v - mean) / std per channel."""
    if layout not in ("HWC", "CHW"):
        raise ValueError(f"layout must be HWC or CHW, not {layout!r}")
    by_channel = {row[0]: row[1:] for row in stats}
    mean = np.array([by_channel[c][0] for c in channels], np.float32)
    std = np.array([by_channel[c][1] for c in channels], np.float32)

    def scale(raw):
        pixels = np.frombuffer(raw, np.uint8).reshape(-1, len(mean))
        out = (pixels.astype(np.float32) - mean) / std
        if layout == "CHW":
            out = out.T
        return out.astype("<f4").tobytes()

    return _per_row(scale, T.BinaryType())(data)


def unit_scaled(data: Column) -> Column:
    """Bytes to little-endian float32 bytes between 0 and 1."""

    def scale(raw):
        return (np.frombuffer(raw, np.uint8) / np.float32(255)).astype("<f4").tobytes()

    return _per_row(scale, T.BinaryType())(data)
