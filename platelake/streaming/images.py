"""New image files to a table of planes, as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from platelake.functions.paths import key_columns, with_path_parts
from platelake.schemas import IMAGE_KEY
from platelake.session import image_parquet
from platelake.sources.plates import BATCH_BYTES, PIXELS, SPLITS_PER_PLATE, arrow_schema, decode_plane

# Fixed value: the columns of Spark's binary file source.
_FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
_SCHEMA = arrow_schema(PIXELS)

# Tasks that open the files of a batch, at most. Spark counts megabytes for
# opening a file, so one task of its own would hold only a few small images.
OPENING_TASKS = 2048
# Files of one batch, whose names and sizes the driver holds.
BATCH_FILES = 100_000
# Fixed value: names Spark keeps from one batch to the next unless told otherwise.
KEPT_NAMES = 10_000


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, held = [], 0
        keys = batch.select(["path", *IMAGE_KEY]).to_pylist()
        for key, content in zip(keys, batch.column("content"), strict=True):
            rows.append({**key, **decode_plane(content.as_py())})
            held += len(rows[-1]["data"] or b"") + 200
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


def _with_keys(files: DataFrame) -> DataFrame:
    keyed = with_path_parts(files, F.col("path"), "_parts").where(F.size("_parts") == 6)
    keys = [c.alias(name) for name, c in key_columns(F.col("_parts")).items()]
    return keyed.select("path", *keys, "content")


def decode_files(files: DataFrame) -> DataFrame:
    """Planes of binary files (path, content), batch or stream: as scan_plates
    gives them. Files whose path is no image path are left out."""
    return _with_keys(files).mapInArrow(_decode, PIXELS)


def stream_images(
    spark: SparkSession, root: str, files_per_trigger: int | None = BATCH_FILES
) -> DataFrame:
    """Planes of the image files under a root as a stream. A file is read once:
    one that is changed later under the same name is not read again.

    The bytes of a plate come together in a few tasks before they are decoded:
    decoding tasks and the files written from them follow the plates, not the
    number of images. A batch has at most ``files_per_trigger`` files; None
    takes all that are there, and the driver holds their names at once.
    """
    reader = (
        spark.readStream.format("binaryFile").schema(_FILES)
        .option("pathGlobFilter", "*.png").option("recursiveFileLookup", "true")
    )
    if files_per_trigger is not None:
        reader = (
            reader.option("maxFilesPerTrigger", files_per_trigger)
            # With fewer names than a batch takes every other one would be small.
            .option("maxCachedFiles", max(files_per_trigger, KEPT_NAMES))
        )
    files = _with_keys(reader.load(root).select("path", "content").coalesce(OPENING_TASKS))
    part = F.crc32(F.col("path").cast("binary")) % SPLITS_PER_PLATE
    dealt = files.repartition("dataset", "experiment", "plate", part)
    return dealt.mapInArrow(_decode, PIXELS)


def ingest_stream(planes: DataFrame, dest: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Writes planes as they come, under the directories of ingest_planes, so
    that read_planes reads them. The sink's log and the checkpoint make every
    file count once, also if the query is stopped and started again. ``drain``
    ends it when all present files are read."""
    writer = (
        planes.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", dest)
        .option("compression", "zstd").options(**image_parquet("data", 512 * 512))
        .partitionBy("dataset", "experiment")
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()
