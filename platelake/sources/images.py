"""Image files <root>/<dataset>/<experiment>/Plate<p>/<well>_s<site>_w<c>.png"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions.paths import key_columns, with_path_parts
from platelake.schemas import IMAGE_KEY, PLANES, SITE_KEY, SPLITS


def _globs(
    root: str, datasets: Sequence[str] | None, experiments: Sequence[str] | None
) -> list[str]:
    """Patterns of fixed depth: they list only the wanted directories, and
    make an address unique under one root."""

    def choice(names):
        return "{" + ",".join(sorted(names)) + "}" if names else "*"

    return [f"{root.rstrip('/')}/{choice(datasets)}/{choice(experiments)}/Plate*"]


def _folder(spark: SparkSession, path: str):
    """Hadoop path and file system, for look-ups of single directories."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


def list_splits(spark: SparkSession, root: str) -> list[str]:
    """Names of the split directories under an image root: one look-up each,
    however many files there are."""
    return [d for d in SPLITS if exists(spark, f"{root.rstrip('/')}/{d}")]


def list_experiments(
    spark: SparkSession, root: str, datasets: Sequence[str] | None = None
) -> list[tuple[str, str]]:
    """(dataset, experiment) directories under an image root."""
    found = []
    for dataset in list_splits(spark, root) if datasets is None else datasets:
        folder, system = _folder(spark, f"{root.rstrip('/')}/{dataset}")
        found += [(dataset, status.getPath().getName())
                  for status in system.listStatus(folder) if status.isDirectory()]
    return sorted(found)


def plate_folders(
    spark: SparkSession, root: str, plates: Iterable[tuple[str, str, int]]
) -> list[str]:
    """Directories of the (dataset, experiment, plate) that are there: one
    listing of plate names per experiment, no image is listed."""
    wanted = defaultdict(set)
    for dataset, experiment, plate in plates:
        wanted[dataset, experiment].add(f"Plate{plate}")
    found = []
    for (dataset, experiment), names in sorted(wanted.items()):
        folder, system = _folder(spark, f"{root.rstrip('/')}/{dataset}/{experiment}")
        if system.exists(folder):
            found += [status.getPath().toString() for status in system.listStatus(folder)
                      if status.getPath().getName() in names]
    return sorted(found)


def splits_in(paths: DataFrame, root: str, path: str = "path") -> DataFrame:
    """The same from a table of paths: first directory under the root."""
    prefix = root.rstrip("/") + "/"
    first = F.split_part(F.substring(F.col(path), len(prefix) + 1, 1 << 30), F.lit("/"), F.lit(1))
    return (
        paths.where(F.col(path).startswith(prefix))
        .select(first.alias("dataset"))
        .where(F.col("dataset").isin(list(SPLITS)))
        .distinct()
    )


def parse_paths(paths: DataFrame, path: str = "path") -> DataFrame:
    """Adds the address columns and ``parsed``; other files stay, with nulls."""
    return (
        with_path_parts(paths, F.col(path), "_parts")
        .withColumns(key_columns(F.col("_parts")))
        .withColumn("parsed", F.size("_parts") == 6)
        .drop("_parts")
    )


def list_images(
    spark: SparkSession,
    root: str,
    datasets: Sequence[str] | None = None,
    experiments: Sequence[str] | None = None,
) -> DataFrame:
    """Addresses of the image files, without reading their content."""
    return list_files(spark, root, datasets, experiments).drop("modified")


def list_files(
    spark: SparkSession,
    root: str,
    datasets: Sequence[str] | None = None,
    experiments: Sequence[str] | None = None,
) -> DataFrame:
    """The same with the time of the last change, in milliseconds."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.png")
        .load(_globs(root, datasets, experiments))
        .select("path", F.unix_millis("modificationTime").alias("modified"))
    )
    return parse_paths(files).where("parsed").drop("parsed")


def modified(spark: SparkSession, path: str) -> int | None:
    """When a single file was last changed, in milliseconds; None if it is not there."""
    folder, system = _folder(spark, path)
    return system.getFileStatus(folder).getModificationTime() if system.exists(folder) else None


def _planes(images: DataFrame) -> DataFrame:
    keys = key_columns(F.col("_parts"))
    return (
        with_path_parts(images, F.col("image.origin"), "_parts")
        .where(F.size("_parts") == 6)
        .select(
            F.col("image.origin").alias("path"),
            *[keys[c].alias(c) for c in IMAGE_KEY],
            F.col("image.height").alias("height"),
            F.col("image.width").alias("width"),
            F.col("image.data").alias("data"),
            readable().alias("readable"),
        )
    )


def readable() -> Column:
    """True for an 8-bit grey image; broken files decode with height -1."""
    image = F.col("image")
    return (image["height"] > 0) & (image["nChannels"] == 1) & (image["mode"] == 0)


def scan_images(
    spark: SparkSession,
    root: str,
    datasets: Sequence[str] | None = None,
    experiments: Sequence[str] | None = None,
) -> DataFrame:
    """Decoded channel planes. Unreadable files stay in, marked as such."""
    images = (
        spark.read.format("image").option("pathGlobFilter", "*.png")
        .load(_globs(root, datasets, experiments))
    )
    return _planes(images)


def scan_keys(
    spark: SparkSession, root: str, keys: DataFrame, channels: Sequence[int]
) -> DataFrame:
    """Planes of the plates that ``keys`` names, of its wells and sites and
    the channels only; the rest of the tree is not listed or opened. A superset
    of the keys: wells and sites are chosen over all plates together.

    What comes to the driver is less than the names of the files read, which
    Spark lists there. Plates that are not there are left out.
    """
    named = keys.select(*SITE_KEY).dropna().where(F.col("well").rlike("^[A-Z][0-9]{2}$"))
    plates = named.select("dataset", "experiment", "plate").distinct().collect()
    folders = plate_folders(spark, root, map(tuple, plates))
    if not folders:
        return spark.createDataFrame([], PLANES)
    wells, sites = (sorted(r[0] for r in named.select(c).distinct().collect())
                    for c in ("well", "site"))

    def choice(names):
        return "{" + ",".join(map(str, names)) + "}"

    names = f"{choice(wells)}_s{choice(sites)}_w{choice(dict.fromkeys(channels))}.png"
    images = spark.read.format("image").option("pathGlobFilter", names).load(folders)
    return _planes(images)


def scan_site(
    spark: SparkSession,
    root: str,
    dataset: str,
    experiment: str,
    plate: int,
    well: str,
    site: int,
    channels: Sequence[int],
) -> DataFrame:
    """Planes of one site, opened by name: no directory is listed and a
    missing file is an error."""
    folder = f"{root.rstrip('/')}/{dataset}/{experiment}/Plate{plate}"
    files = [f"{folder}/{well}_s{site}_w{c}.png" for c in dict.fromkeys(channels)]
    return _planes(spark.read.format("image").load(files))


def read_planes(spark: SparkSession, root: str) -> DataFrame:
    """Planes that ingest_planes wrote."""
    return spark.read.schema(PLANES).parquet(root)
