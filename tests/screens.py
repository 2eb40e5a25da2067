"""Small plate screens on disk: metadata rows and 8-bit grey PNG files."""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np

SITE_SCHEMA = ("id_code string, dataset string, experiment string, cell_type string, plate int, "
               "well string, well_type string, sirna long, site int")


def write_png(path: str, pixels: np.ndarray) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    height, width = pixels.shape[:2]
    colour = 2 if pixels.ndim == 3 else 0
    depth = 16 if pixels.dtype == np.uint16 else 8
    raw = b"".join(b"\0" + row.astype(">u2" if depth == 16 else np.uint8).tobytes()
                   for row in pixels)

    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    header = struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)
    with open(path, "wb") as file:
        file.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header)
                   + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def site_rows(datasets=("train", "test"), experiments=1, plates=1, wells=6, sites=1, label=1):
    rows = []
    for dataset in datasets:
        for e in range(experiments):
            experiment = f"{'RPE' if dataset == 'train' else 'HUVEC'}-{e + 1:02d}"
            for plate in range(1, plates + 1):
                for w in range(wells):
                    well = f"{chr(ord('B') + w % 14)}{w % 22 + 2:02d}"
                    for site in range(1, sites + 1):
                        rows.append((
                            f"{experiment}_{plate}_{well}", dataset, experiment,
                            experiment.split("-")[0], plate, well, "treatment",
                            label if dataset == "train" else None, site))
    return rows


def site_frame(spark, rows):
    return spark.createDataFrame(rows, SITE_SCHEMA)


def image_file(root, dataset, experiment, plate, well, site, channel) -> str:
    return f"{root}/{dataset}/{experiment}/Plate{plate}/{well}_s{site}_w{channel}.png"


def write_images(root, rows, channels, size=16, seed=0):
    """Random planes for every row; {(dataset, experiment, plate, well, site): HWC}."""
    rng = np.random.default_rng(seed)
    images = {}
    for _, dataset, experiment, _, plate, well, _, _, site in rows:
        planes = rng.integers(0, 256, (len(channels), size, size), dtype=np.uint8)
        for plane, channel in zip(planes, channels):
            write_png(image_file(root, dataset, experiment, plate, well, site, channel), plane)
        images[dataset, experiment, plate, well, site] = np.moveaxis(planes, 0, -1)
    return images
