"""Packed files as an unbounded feed of normalised examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from platelake.operators.feed import normalise_examples
from platelake.schemas import CHANNELS, PACKED
from platelake.session import image_parquet
from platelake.sources.runs import unit_paths


def stream_packed(
    spark: SparkSession,
    root: str,
    layout: str | None = None,
    dataset: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Packed records as they arrive; every file is read once. Of a folder with
    commits the units of the latest one are read; a query that is started anew
    after a further commit reads the files of the new run as new ones."""
    paths = unit_paths(spark, root)
    reader = spark.readStream.schema(PACKED)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if paths is None:
        records = reader.parquet(root)
    else:
        base = root.rstrip("/")
        inner = ",".join(p.removeprefix(base + "/") for p in paths)
        records = reader.option("basePath", base).parquet(f"{base}/{{{inner}}}")
    if layout is not None:
        records = records.where(F.col("layout") == layout)
    if dataset is not None:
        records = records.where(F.col("dataset") == dataset)
    return records


def feed_examples(
    records: DataFrame,
    dest: str,
    checkpoint: str,
    stats=None,
    channels: Sequence[int] = CHANNELS,
    drain: bool = False,
    only_labelled: bool = True,
) -> StreamingQuery:
    """Writes normalised examples as Parquet. The query is stateless, and the
    file sink with its checkpoint writes each example once even if it
    restarts. ``drain`` stops when all present files are read. Unlabelled
    records are left out unless ``only_labelled`` is off; the progress reports
    of the query count them as ``n_unlabelled`` of the metrics ``feed``."""
    writer = (
        normalise_examples(
            records, stats, channels, only_labelled=only_labelled, dropped="feed")
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", dest)
        .options(**image_parquet("image", 512 * 512 * 6 * 4))
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()
