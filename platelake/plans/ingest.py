"""Image files to a table of planes, one experiment directory at a time."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from platelake.schemas import PLANES
from platelake.session import image_parquet
from platelake.sources.images import list_experiments, list_files, modified, scan_images


def is_current(spark: SparkSession, root: str, dataset: str, experiment: str, target: str) -> bool:
    """Whether a finished experiment still has the files it was made of: as
    many as the table has rows, none changed since. Looks at names and footers."""
    finished = modified(spark, target + "/_SUCCESS")
    if finished is None:
        return False
    files = list_files(spark, root, [dataset], [experiment])
    n, newest = files.agg(F.count(F.lit(1)), F.max("modified")).first()
    return n == spark.read.parquet(target).count() and (newest or 0) <= finished


def ingest_planes(
    spark: SparkSession,
    root: str,
    dest: str,
    datasets: Sequence[str] | None = None,
    experiments: Sequence[tuple[str, str]] | None = None,
    jobs_at_once: int = 8,
    redo: bool = False,
) -> list[tuple[str, str]]:
    """Decodes every channel file once and writes Parquet without a shuffle.

    A scan keeps the names of its files on the driver. Here that is one
    experiment per job rather than hundreds of millions of files at once, and
    a job that was cut off is repeated alone: finished experiments are skipped
    unless files came, went or changed since, or ``redo``. Returns the
    experiments written.
    """
    if experiments is None:
        experiments = list_experiments(spark, root, datasets)

    def target(dataset: str, experiment: str) -> str:
        return f"{dest.rstrip('/')}/dataset={dataset}/experiment={experiment}"

    def skipped(pair: tuple[str, str]) -> bool:
        return not redo and is_current(spark, root, *pair, target(*pair))

    columns = [f.name for f in PLANES if f.name not in ("dataset", "experiment")]

    def write(pair: tuple[str, str]) -> None:
        dataset, experiment = pair
        planes = scan_images(spark, root, [dataset], [experiment]).select(*columns)
        (
            planes.write.mode("overwrite").option("compression", "zstd")
            .options(**image_parquet("data", 512 * 512))
            .parquet(target(dataset, experiment))
        )

    with ThreadPoolExecutor(jobs_at_once) as pool:
        done = list(pool.map(skipped, experiments))
        todo = [e for e, skip in zip(experiments, done, strict=True) if not skip]
        list(pool.map(write, todo))
    return todo
