"""Grey PNG files to pixels and back, exact at 8 and 16 bits."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the file format: signature, grey colour type, filter types.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
GREY = 0
NONE, SUB, UP, AVERAGE, PAETH = range(5)


def _chunks(raw: bytes):
    at = len(SIGNATURE)
    while at + 8 <= len(raw):
        (size,), kind = struct.unpack_from(">I", raw, at), raw[at + 4:at + 8]
        yield kind, raw[at + 8:at + 8 + size]
        at += size + 12


def _plain_rows(rows: np.ndarray, kinds: np.ndarray) -> None:
    """Undoes filters that look along one axis only, in place."""
    for y, kind in enumerate(kinds):
        if kind == SUB:
            np.cumsum(rows[y], axis=0, dtype=np.uint8, out=rows[y])
        elif kind == UP and y:
            rows[y] += rows[y - 1]


def _diagonals(rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Undoes any mix of filters. A byte depends on its left, upper and upper
    left neighbour, which lie on the two diagonals before its own, so whole
    diagonals are computed at once. Diagonals are rows of a skewed array;
    places left of the image hold zeros, as the format wants."""
    height, width, lanes = rows.shape
    skewed = np.zeros((height + width + 1, height + 1, lanes), np.int16)
    ys = np.arange(height)
    at = ys[:, None] + np.arange(width)[None, :] + 2
    skewed[at, ys[:, None] + 1] = rows
    sub, up, mean, paeth = ((kinds == k).astype(np.int16)[:, None] for k in (SUB, UP, AVERAGE, PAETH))
    for d in range(2, height + width + 1):
        a, b, c = skewed[d - 1, 1:], skewed[d - 1, :-1], skewed[d - 2, :-1]
        near_a, near_b, near_c = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
        best = np.where((near_a <= near_b) & (near_a <= near_c), a, np.where(near_b <= near_c, b, c))
        line = skewed[d, 1:]
        line += sub * a + up * b + mean * ((a + b) >> 1) + paeth * best
        line &= 255
    return skewed[at, ys[:, None] + 1].astype(np.uint8)


def decode_png(raw: bytes) -> tuple[int, int, int, bytes]:
    """Height, width, depth and pixels row by row; 16-bit ones little-endian.
    ValueError for anything but a whole grey image of 8 or 16 bits, not interlaced."""
    if not raw.startswith(SIGNATURE):
        raise ValueError("no PNG file")
    header, packed = None, []
    for kind, data in _chunks(raw):
        if kind == b"IHDR":
            header = data
        elif kind == b"IDAT":
            packed.append(data)
    if header is None or len(header) != 13:
        raise ValueError("no header")
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", header)
    if colour != GREY or depth not in (8, 16) or interlaced or not height or not width:
        raise ValueError(f"colour type {colour}, {depth} bits, interlace {interlaced}")
    lanes = depth // 8
    try:
        inflated = zlib.decompress(b"".join(packed))
    except zlib.error as e:
        raise ValueError(f"broken pixels: {e}") from None
    if len(inflated) != height * (width * lanes + 1):
        raise ValueError("pixels do not fill the image")
    lines = np.frombuffer(inflated, np.uint8).reshape(height, width * lanes + 1)
    kinds = lines[:, 0]
    if kinds.max() > PAETH:
        raise ValueError("unknown filter")
    rows = lines[:, 1:].reshape(height, width, lanes).copy()
    if (kinds <= UP).all():
        _plain_rows(rows, kinds)
    else:
        rows = _diagonals(rows, kinds)
    # Samples of two bytes come high byte first.
    return height, width, depth, np.ascontiguousarray(rows[:, :, ::-1]).tobytes()


def encode_png(height: int, width: int, depth: int, pixels: bytes) -> bytes:
    """Inverse of decode_png: each row as its difference from the row above."""
    lanes = depth // 8
    rows = np.frombuffer(pixels, np.uint8).reshape(height, width, lanes)[:, :, ::-1]
    rows = rows.reshape(height, width * lanes)
    lines = np.empty((height, width * lanes + 1), np.uint8)
    lines[:, 0] = UP
    lines[:1, 1:] = rows[:1]
    lines[1:, 1:] = rows[1:] - rows[:-1]

    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    header = struct.pack(">IIBBBBB", width, height, depth, GREY, 0, 0, 0)
    return (SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines.tobytes()))
            + chunk(b"IEND", b""))
