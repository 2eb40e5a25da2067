"""Image trees read by plate folder, and site images opened by their key.

Spark's own image source lists every file on the driver and reduces 16-bit
grey to 8 bits. Here the driver lists folders only, executors list and open
files, and pixels come as the file holds them.
"""

from __future__ import annotations

import json
import operator
import re
import zlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, LessThan, LessThanOrEqual,
)

from platelake.functions.png import decode_png, encode_png
from platelake.schemas import CHANNELS, IMAGE_KEY, PLANES, SITE_KEY, SPLITS
from platelake.sources import stores

# Fixed value: <well>_s<site>_w<channel>.png in a folder Plate<p>
FILE_NAME = re.compile(r"([A-Z][0-9]{2})_s([0-9]+)_w([0-9]+)[.]png")
PLATE_NAME = re.compile(r"Plate([0-9]+)")

# A plate folder is read by so many tasks.
SPLITS_PER_PLATE = 4
# Files a task has open at once, and pixels it hands to Spark at once.
OPEN_FILES = 8
BATCH_BYTES = 16 << 20

# Sites that one task opens by key.
SITES_PER_TASK = 64
MAX_TASKS = 100_000

NAMES = T.StructType([T.StructField("path", T.StringType())] + [
    T.StructField(c, PLANES[c].dataType) for c in IMAGE_KEY])
PIXELS = T.StructType(
    [T.StructField("path", T.StringType()), *PLANES.fields, T.StructField("depth", T.IntegerType())])

ARROW_TYPES = {T.StringType: pa.string(), T.IntegerType: pa.int32(), T.BooleanType: pa.bool_(),
          T.BinaryType: pa.binary()}


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, ARROW_TYPES[type(f.dataType)]) for f in schema.fields])


# Comparisons the source takes over, by the name of the filter's class.
_COMPARE = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt",
            LessThanOrEqual: "le", In: "in"}


def _holds(wanted: list, column: str, value) -> bool:
    """Whether the value passes all conditions on that column."""
    return all(
        value in other if how == "in" else getattr(operator, how)(value, other)
        for name, how, other in wanted if name == column)


@dataclass
class PlateFolder(InputPartition):
    """A part of the files of one plate folder, those whose name falls to it."""
    dataset: str
    experiment: str
    plate: int
    name: str
    part: int


class PlateReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.root = options["path"]
        self.content = options.get("content", "pixels")
        self.splits = int(options.get("splits", SPLITS_PER_PLATE))
        # (column, comparison, value): all must hold.
        self.wanted = [tuple(w) for w in json.loads(options.get("wanted", "[]"))]
        self.columns = schema

    def partitions(self) -> Sequence[InputPartition]:
        """Folders of three levels; no image file is listed here."""
        system, root = stores.open_store(self.root)
        found = []
        for dataset in stores.folders(system, root):
            if dataset not in SPLITS or not _holds(self.wanted, "dataset", dataset):
                continue
            for experiment in stores.folders(system, f"{root}/{dataset}"):
                if not _holds(self.wanted, "experiment", experiment):
                    continue
                for name in stores.folders(system, f"{root}/{dataset}/{experiment}"):
                    plate = PLATE_NAME.fullmatch(name)
                    if plate and _holds(self.wanted, "plate", int(plate[1])):
                        found += [PlateFolder(dataset, experiment, int(plate[1]), name, part)
                                  for part in range(self.splits)]
        return found or [PlateFolder("", "", 0, "", 0)]

    def read(self, partition: PlateFolder) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(self.columns)
        if not partition.name:
            return
        system, root = stores.open_store(self.root)
        folder = f"{root}/{partition.dataset}/{partition.experiment}/{partition.name}"
        chosen = []
        for name in stores.files(system, folder):
            match = FILE_NAME.fullmatch(name)
            if not match or zlib.crc32(name.encode()) % self.splits != partition.part:
                continue
            key = {"well": match[1], "site": int(match[2]), "channel": int(match[3])}
            if all(_holds(self.wanted, c, v) for c, v in key.items()):
                chosen.append((f"{folder}/{name}", key))
        address = {"dataset": partition.dataset, "experiment": partition.experiment,
                   "plate": partition.plate}

        def row(path: str, key: dict) -> dict:
            out = {"path": path, **address, **key}
            if self.content == "pixels":
                out.update(decode_plane(stores.read_file(system, path)))
            return out

        rows, held = [], 0
        with ThreadPoolExecutor(OPEN_FILES) as pool:
            for i in range(0, len(chosen), OPEN_FILES):
                for one in pool.map(lambda c: row(*c), chosen[i:i + OPEN_FILES]):
                    rows.append(one)
                    held += len(one.get("data") or b"") + 200
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class PushedPlateReader(PlateReader):
    """The same where the session lets sources take filters over."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            how = _COMPARE.get(type(f))
            if how and f.attribute[0] in IMAGE_KEY:
                self.wanted.append((f.attribute[0], how, f.value))
            else:
                yield f


class PlateImages(DataSource):
    """Source ``plate_images``: options ``path``, ``content`` (pixels or names),
    ``splits``, ``wanted`` (conditions as JSON) and ``pushdown``."""

    @classmethod
    def name(cls) -> str:
        return "plate_images"

    def schema(self) -> T.StructType:
        return NAMES if self.options.get("content") == "names" else PIXELS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = PushedPlateReader if self.options.get("pushdown") == "true" else PlateReader
        return kind(dict(self.options), schema)


def decode_plane(raw: bytes | None) -> dict:
    """What a file holds; an unreadable one has size -1 and no pixels."""
    try:
        height, width, depth, data = decode_png(raw or b"")
    except ValueError:
        return {"height": -1, "width": -1, "depth": None, "readable": False, "data": None}
    return {"height": height, "width": width, "depth": depth, "readable": True, "data": data}


def _scan(spark: SparkSession, root: str, content: str, splits: int, chosen: dict) -> DataFrame:
    spark.dataSource.register(PlateImages)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    wanted = [(c, "in", list(v)) for c, v in chosen.items() if v is not None]
    return (
        spark.read.format("plate_images").option("content", content).option("splits", splits)
        .option("wanted", json.dumps(wanted)).option("pushdown", pushed).load(root)
    )


def scan_plates(
    spark: SparkSession,
    root: str,
    datasets: Sequence[str] | None = None,
    experiments: Sequence[str] | None = None,
    plates: Sequence[int] | None = None,
    wells: Sequence[str] | None = None,
    sites: Sequence[int] | None = None,
    channels: Sequence[int] | None = None,
    splits: int = SPLITS_PER_PLATE,
) -> DataFrame:
    """Decoded planes as scan_images gives them, with their ``depth``: 8 or 16
    bits, pixels of 16 as two bytes, low one first. Unreadable files, among
    them those with colour, stay in and are marked.

    Only what is chosen is opened, by the arguments or, where the session has
    ``spark.sql.python.filterPushdown.enabled``, by filters on key columns. The
    driver lists folders down to the plates; a few tasks per plate list and
    open its files.
    """
    return _scan(spark, root, "pixels", splits, {
        "dataset": datasets, "experiment": experiments, "plate": plates, "well": wells,
        "site": sites, "channel": channels})


def list_plates(
    spark: SparkSession,
    root: str,
    datasets: Sequence[str] | None = None,
    experiments: Sequence[str] | None = None,
) -> DataFrame:
    """Addresses of the image files: names are read on executors, no file is opened."""
    return _scan(spark, root, "names", 1, {"dataset": datasets, "experiment": experiments})


# --- by key ------------------------------------------------------------------

_OPENED = T.StructType([
    *[T.StructField(c, PLANES[c].dataType) for c in SITE_KEY],
    T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
    T.StructField("channels", T.IntegerType()), T.StructField("image", T.BinaryType()),
    T.StructField("problem", T.StringType()),
])


def file_name(root: str, key: Sequence, channel: int) -> str:
    dataset, experiment, plate, well, site = key
    return f"{root}/{dataset}/{experiment}/Plate{plate}/{well}_s{site}_w{channel}.png"


def _stack(planes: list[dict], channels: Sequence[int], depth: int) -> tuple[dict, str | None]:
    """The planes of a site as one HWC image, or what is wrong with them."""
    if any(not p["readable"] for p in planes):
        return {}, "missing, unreadable or odd-sized plane"
    if len({(p["height"], p["width"]) for p in planes}) > 1:
        return {}, "missing, unreadable or odd-sized plane"
    if any(p["depth"] > depth for p in planes):
        return {}, "16-bit plane where 8 bits are asked for"
    kinds = {8: np.uint8, 16: np.dtype("<u2")}
    merged = np.stack([np.frombuffer(p["data"], kinds[p["depth"]]) for p in planes], axis=-1)
    image = merged.astype(kinds[depth]).tobytes()
    return {"height": planes[0]["height"], "width": planes[0]["width"],
            "channels": len(channels), "image": image}, None


def open_sites(
    spark: SparkSession, root: str, keys: DataFrame, channels: Sequence[int] = CHANNELS, depth: int = 8
) -> DataFrame:
    """One row per address of ``keys``: its image, or the ``problem`` with it.

    Exactly the files of the keys are opened, by name and on executors; no
    directory is listed. All planes of a site are opened by one task, so pixels
    are not shuffled. ``depth`` 16 gives two bytes per value, low one first,
    and takes 8-bit files as they are; 8 refuses 16-bit files.
    """
    if depth not in (8, 16):
        raise ValueError("depth must be 8 or 16")
    order = list(channels)
    distinct = list(dict.fromkeys(order))
    wanted = keys.select(*[F.col(c).cast(PLANES[c].dataType) for c in SITE_KEY]).distinct()
    tasks = min(max(1, -(-wanted.count() // SITES_PER_TASK)), MAX_TASKS)
    schema = arrow_schema(_OPENED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = stores.open_store(root)

        def site(key: dict) -> dict:
            name = "/".join("" if key[c] is None else str(key[c]) for c in SITE_KEY)
            found = {}
            if None not in key.values():
                found = {c: stores.read_file(system, file_name(folder, list(key.values()), c))
                         for c in distinct}
            if all(raw is None for raw in found.values()):
                return {**key, "problem": f"no image file for {name}"}
            planes = {c: decode_plane(raw) for c, raw in found.items()}
            image, problem = _stack([planes[c] for c in order], order, depth)
            return {**key, **image, "problem": problem and f"{problem}: {name}"}

        rows, held = [], 0
        with ThreadPoolExecutor(OPEN_FILES) as pool:
            for batch in batches:
                keys_ = batch.to_pylist()
                for i in range(0, len(keys_), OPEN_FILES):
                    for one in pool.map(site, keys_[i:i + OPEN_FILES]):
                        rows.append(one)
                        held += len(one.get("image") or b"") + 200
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return wanted.repartition(tasks, *SITE_KEY).mapInArrow(run, _OPENED)


# --- writing -----------------------------------------------------------------

def write_plates(planes: DataFrame, root: str) -> int:
    """Writes each plane as a grey PNG file at the path of its address and
    returns how many. ``depth`` may be a column; without it pixels are 8 bits.
    Rows that repeat an address write the same file, one over the other."""
    if "depth" not in planes.columns:
        planes = planes.withColumn("depth", F.lit(8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = stores.open_store(root)
        for batch in batches:
            for row in batch.to_pylist():
                path = file_name(folder, [row[c] for c in SITE_KEY], row["channel"])
                stores.write_file(system, path, encode_png(
                    row["height"], row["width"], row["depth"], row["data"]))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    needed = [*IMAGE_KEY, "height", "width", "depth", "data"]
    written = planes.select(*needed).mapInArrow(run, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
