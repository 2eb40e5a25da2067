"""The write jobs: packed files and chunked arrays."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.operators.chunks import planes_to_chunks
from platelake.operators.numbering import number_by_key, order_key
from platelake.operators.metadata import select_sites
from platelake.operators.stack import complete_sites, drop_plane_copies, missing_images
from platelake.plans.packing import SPLIT_DIGITS, manifest, mixed_files, plan_all
from platelake.plans.placing import place_images, place_planes
from platelake.schemas import (
    ARRAY_DIRS, CHANNELS, PACK_DIRS, RECORD_COLUMNS, ROWS_PER_FILE, SEED, SITE_KEY, STRATEGIES,
)
from platelake.session import cut_lineage, image_parquet
from platelake.sources.images import list_images, list_splits, scan_images
from platelake.sources.plates import list_plates, scan_plates
from platelake.sources.metadata_csv import site_table
from platelake.sources.packed import read_packed
from platelake.sources.runs import commit, new_run


class MissingImages(ValueError):
    pass


def check_images(sites: DataFrame, inventory: DataFrame, channels: Sequence[int]) -> None:
    """Fails on the first few missing files; looks at names only."""
    gaps = missing_images(sites, inventory, channels).take(5)
    if gaps:
        raise MissingImages(f"image files are missing, such as {[g.asDict() for g in gaps]}")


def write_packed(
    plan: DataFrame,
    images: DataFrame,
    dest: str,
    channels: Sequence[int] = CHANNELS,
    strict: bool = True,
    compression: str = "zstd",
    **placing,
) -> None:
    """One compressed Parquet file per planned file, records in plan order.

    The run has a folder of its own, and one commit makes it seen as a whole:
    each split of each layout that the plan names is replaced, so no file of an
    earlier run with other file sizes is read any more. Other layouts and
    splits stay. Readers of the run before keep what they have opened.
    """
    needed = dict.fromkeys([*PACK_DIRS, "pos", *SITE_KEY, *RECORD_COLUMNS])
    placed = place_images(
        plan.select(*needed), images, PACK_DIRS, channels, strict, **placing)
    records = placed.select(
        "pos", "image", "height", "width", "channels", *RECORD_COLUMNS, *PACK_DIRS
    )
    spark, root = plan.sparkSession, dest.rstrip("/")
    run, folder = new_run(root)
    (
        records.write.option("compression", compression)
        .options(**image_parquet("image"))
        .partitionBy(*PACK_DIRS).parquet(folder)
    )
    # A layout per strategy and seed, and two splits at most.
    splits = plan.select("layout", "dataset").distinct().collect()
    commit(spark, root, run, [f"layout={s['layout']}/dataset={s['dataset']}" for s in splits])


def written_manifest(spark: SparkSession, plan: DataFrame, dest: str) -> DataFrame:
    """One row per file of the plan that has records, counted in the files."""
    found = read_packed(spark, dest).groupBy(*PACK_DIRS).agg(
        F.count(F.lit(1)).alias("n_sites"), F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"))
    files = plan.select("strategy", "seed", "dest_path", *PACK_DIRS).distinct()
    return files.join(found, list(PACK_DIRS)).select(
        "strategy", "seed", "dataset", "dest_path", "n_sites", "first_pos", "last_pos")


def _whole_sites(sites: DataFrame, listed: DataFrame, channels: Sequence[int]) -> DataFrame:
    """The sites with a readable plane in every channel."""
    if "readable" in listed.columns:
        listed = listed.where("readable")
    whole = complete_sites(sites, listed, channels)
    return sites.join(whole.select(*SITE_KEY), list(SITE_KEY), "left_semi")


def pack_images(
    sites: DataFrame,
    images: DataFrame,
    dest: str,
    strategies: Iterable[str] = STRATEGIES,
    channels: Sequence[int] = CHANNELS,
    per_file: int = ROWS_PER_FILE,
    seeds: Sequence[int] = (SEED,),
    datasets: Sequence[str] | None = None,
    strict: bool = True,
    inventory: DataFrame | None = None,
    unique: bool = False,
    **placing,
) -> DataFrame:
    """Packs treatment sites from a table of planes; returns the manifest of
    what was written. Not strict: sites without a readable plane in every
    channel are left out before files are planned, so places have no gaps;
    only odd-sized or conflicting planes, known from their bytes, leave one.

    Every strategy and seed is written by one job, so an image is decoded once.
    ``unique`` promises that no plane is there twice.
    """
    listed = images if inventory is None else inventory
    if not strict:
        sites = _whole_sites(select_sites(sites, datasets), listed, channels)
    plan = cut_lineage(plan_all(sites, strategies, per_file, seeds, datasets))
    mixed = mixed_files(plan).take(5)
    if mixed:
        raise ValueError(f"files with rows of two splits: {[r.dest_path for r in mixed]}")
    if strict:
        check_images(plan, listed, channels)
    if not unique:
        images = drop_plane_copies(images)
    write_packed(plan, images, dest, channels, strict, **placing)
    return manifest(plan) if strict else written_manifest(plan.sparkSession, plan, dest)


def _tree(
    spark: SparkSession, root: str, datasets: Sequence[str] | None, by_plate: bool
) -> tuple[DataFrame, DataFrame]:
    """Planes and addresses of an image tree."""
    if by_plate:
        return scan_plates(spark, root, datasets), list_plates(spark, root, datasets)
    return scan_images(spark, root, datasets), list_images(spark, root, datasets)


def pack(
    spark: SparkSession,
    sites: DataFrame,
    image_root: str,
    dest: str,
    strategies: Iterable[str] = STRATEGIES,
    channels: Sequence[int] = CHANNELS,
    per_file: int = ROWS_PER_FILE,
    seeds: Sequence[int] = (SEED,),
    datasets: Sequence[str] | None = None,
    strict: bool = True,
    by_plate: bool = False,
) -> DataFrame:
    """Packs treatment sites from image files; returns the manifest. Without
    ``datasets`` the splits found under the image root are packed. ``by_plate``
    lists files on executors, plate by plate, where Spark's image source would
    keep all their names on the driver; planes of 16 bits are then refused."""
    if datasets is None:
        datasets = list_splits(spark, image_root)
        if not datasets:
            raise ValueError(f"no split directory under {image_root}")
    images, inventory = _tree(spark, image_root, datasets, by_plate)
    return pack_images(
        sites, images, dest, strategies, channels, per_file, seeds, datasets, strict, inventory,
        unique=True)


# Sites per array file: about 1 GB of widened pixels.
ARRAY_PART_ROWS = 308


def plan_arrays(sites: DataFrame) -> DataFrame:
    """Distinct addresses numbered inside their experiment, so that a large
    experiment is written as several files."""
    keyed = sites.select(*SITE_KEY).distinct().withColumn(
        "key", order_key(F.lit(SEED), SITE_KEY)
    )
    numbered = number_by_key(keyed, list(ARRAY_DIRS), "key", SITE_KEY, SPLIT_DIGITS)
    return numbered.select(*SITE_KEY, "pos")


def write_chunks(
    plan: DataFrame,
    images: DataFrame,
    dest: str,
    channels: Sequence[int] = CHANNELS,
    chunk: int = 512,
    dtype: str = "<u2",
    strict: bool = True,
    level: int = 3,
    part_rows: int = ARRAY_PART_ROWS,
    by_window: bool = False,
    **placing,
) -> None:
    """Chunk table as zstd Parquet, one commit for the whole job. The
    experiments of the plan are replaced, others stay.

    ``by_window`` sorts the pieces of a file by their place in the image, so
    that reading a window of many arrays skips row groups; it needs memory or
    disk for the pixels of a file. Array paths have a Bloom filter.
    """
    spark, root = plan.sparkSession, dest.rstrip("/")
    placed = place_planes(plan, images, ARRAY_DIRS, channels, strict, part_rows, **placing)
    pieces = planes_to_chunks(placed, channels, chunk, dtype)
    if by_window:
        pieces = pieces.sortWithinPartitions(*ARRAY_DIRS, "cy", "cx", "array_path")
    run, folder = new_run(root)
    (
        pieces.write.option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(level))
        .option("parquet.bloom.filter.enabled#array_path", "true")
        .options(**image_parquet("data", chunk * chunk * len(channels) * np.dtype(dtype).itemsize))
        .partitionBy(*ARRAY_DIRS).parquet(folder)
    )
    written = plan.select(*ARRAY_DIRS).distinct().collect()
    commit(spark, root, run, [f"dataset={w['dataset']}/experiment={w['experiment']}" for w in written])


def convert_images(
    sites: DataFrame,
    images: DataFrame,
    dest: str,
    channels: Sequence[int] = CHANNELS,
    datasets: Sequence[str] | None = None,
    strict: bool = True,
    inventory: DataFrame | None = None,
    unique: bool = False,
    **writing,
) -> None:
    """Treatment sites from a table of planes as chunked arrays. Not strict:
    sites without a readable plane in every channel are left out before files
    are planned. ``unique`` promises that no plane is there twice."""
    sites = select_sites(sites, datasets)
    listed = images if inventory is None else inventory
    if not strict:
        sites = _whole_sites(sites, listed, channels)
    plan = cut_lineage(plan_arrays(sites))
    if strict:
        check_images(plan, listed, channels)
    if not unique:
        images = drop_plane_copies(images)
    write_chunks(plan, images, dest, channels, strict=strict, **writing)


def convert_all(
    spark: SparkSession,
    metadata: str,
    image_root: str,
    dest: str,
    strict: bool = True,
    datasets: Sequence[str] | None = None,
    by_plate: bool = False,
) -> None:
    """Every treatment site of the metadata, or of some splits, as a chunked
    array. ``by_plate`` as in ``pack``."""
    images, inventory = _tree(spark, image_root, datasets, by_plate)
    convert_images(
        site_table(spark, metadata, include_controls=False), images, dest, datasets=datasets,
        strict=strict, inventory=inventory, unique=True)
