"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for megabyte image rows. They are recommendations for
# whoever builds the session; nothing here changes a running one.
IMAGE_CONF = {
    # Many small image files: with the default 4 MB open cost a task would
    # get 32 files at most.
    "spark.sql.files.openCostInBytes": str(64 * 1024),
    # Shuffled pixels take about half the bytes of the default codec.
    "spark.io.compression.codec": "zstd",
    # Bounds an Arrow batch at 32 rows of about 1.5 MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "32",
    # A 1.5 MB image row is large for the columnar page buffers.
    "spark.sql.parquet.columnarReaderBatchSize": "64",
    # Files of bucketed planes are sorted, one per bucket: a join by address
    # then need not sort pixels.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Uncompressed bytes a Parquet row group of images may hold at most.
ROW_GROUP_BYTES = 192 * 1024 * 1024


def image_parquet(column: str, row_bytes: int = 512 * 512 * 6) -> dict[str, str]:
    """Parquet write options for rows of about ``row_bytes`` pixels in ``column``.

    Pixels do not repeat, so no dictionary is tried. Row groups are limited by
    rows: by compressed size alone a group of dark images could hold gigabytes,
    and readers take up to 4,096 rows of a group at once.
    """
    return {
        f"parquet.enable.dictionary#{column}": "false",
        "parquet.block.row.count.limit": str(max(1, ROW_GROUP_BYTES // row_bytes)),
        "parquet.page.size.row.check.min": "1",
    }


def is_local(spark: SparkSession) -> bool:
    """One JVM on this machine; local-cluster has executors of their own."""
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session may fall back to a temporary folder of its own; a
    cluster without ``spark.checkpoint.dir`` is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _local_folder()
    return folder


@functools.cache
def _local_folder() -> str:
    """A folder for this process, gone with it. The caller's checkpoint folder
    is not touched."""
    folder = tempfile.mkdtemp(prefix="platelake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "cut", with_path: bool = False):
    """The same rows read back from a table in the shared folder. It survives
    lost executors, and later steps read just the columns they need. With
    ``with_path`` also its folder, for drop_scratch."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return (table, path) if with_path else table


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing reads any more, in whatever store
    the shared folder is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
