"""Plate, pixel and file views derived from the general test tables, which
hold no plates or images themselves. All follow from the row values alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions.paths import image_path
from platelake.operators.metadata import expand_sites
from platelake.functions.labels import cell_type
from platelake.schemas import CHANNELS, SITE_COLUMNS, SITE_KEY, TREATMENT

IMAGE_ROOT = "images"
SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plate_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per well, from orders."""
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    two_digits = lambda n: F.lpad(n.cast("string"), 2, "0")
    control = order % 10 <= 1
    return table(spark, sf_dir, "orders").select(
        order.alias("id_code"),
        F.when(cust % 4 == 0, "test").otherwise("train").alias("dataset"),
        F.concat(
            F.when(cust % 4 == 0, "HUVEC").when(cust % 4 == 1, "U2OS")
            .when(cust % 4 == 2, "RPE").otherwise("HEPG2"),
            F.lit("-"), two_digits(cust % 9 + 1),
        ).alias("experiment"),
        (order % 4 + 1).cast("int").alias("plate"),
        F.concat(F.chr(order % 14 + 66), two_digits(order % 22 + 2)).alias("well"),
        F.when(order % 10 == 0, "negative_control").when(order % 10 == 1, "positive_control")
        .otherwise(TREATMENT).alias("well_type"),
        F.when((cust % 4 == 0) & ~control, None).otherwise(order % 1108).alias("sirna"),
    )


def well_files(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """The plate map as the four metadata files: treatments and controls of
    each split. Test treatments have no label column."""
    wells = plate_map(spark, sf_dir)
    common = ["id_code", "experiment", "plate", "well"]
    parts = {}
    for dataset in ("test", "train"):
        split = wells.where(F.col("dataset") == dataset)
        label = ["sirna"] if dataset == "train" else []
        parts[dataset] = (
            split.where(F.col("well_type") == TREATMENT).select(*common, *label),
            split.where(F.col("well_type") != TREATMENT).select(*common, "well_type", "sirna"),
        )
    return parts


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    wells = plate_map(spark, sf_dir).withColumn("cell_type", cell_type(F.col("experiment")))
    return expand_sites(wells).select(*SITE_COLUMNS)


def image_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the image files that exist: some are missing, one is no image.
    Addresses repeat, so they are made distinct before channels multiply them."""
    addresses = (
        sites(spark, sf_dir).where(F.col("well_type") == TREATMENT)
        .select(*SITE_KEY).distinct()
    )
    paths = addresses.withColumn(
        "channel", F.explode(F.array(*[F.lit(c) for c in CHANNELS]))
    ).select(image_path(IMAGE_ROOT).alias("path"))
    kept = paths.where(F.substring(F.md5(F.col("path").cast("binary")), 1, 2) != "00")
    return kept.unionByName(spark.sql(f"SELECT '{IMAGE_ROOT}/train/notes.txt' AS path"))


def _pixel(value):
    scaled = F.floor(F.abs(value.cast("double")) * 1000).cast("int")
    return scaled % 256


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per pixel: 8x8 planes, six vectors in a row being one site."""
    return (
        table(spark, sf_dir, "embeddings")
        .select(
            F.expr("vec_id div 6").alias("site_id"),
            (F.col("vec_id") % 6 + 1).cast("int").alias("channel"),
            F.posexplode("embedding").alias("px", "v"),
        )
        .select("site_id", "channel", "px", _pixel(F.col("v")).alias("val"))
    )


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same planes as image bytes with the address of their site."""
    site = F.expr("vec_id div 6")
    byte = F.transform("embedding", lambda v: F.lpad(F.hex(_pixel(v)), 2, "0"))
    return table(spark, sf_dir, "embeddings").select(
        *plane_address(site),
        (F.col("vec_id") % 6 + 1).cast("int").alias("channel"),
        F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"),
        F.unhex(F.array_join(byte, "")).alias("data"),
    )


def plane_address(site):
    """Address columns of a site number, the same for planes and metadata."""
    return [
        F.when(site % 4 == 0, "test").otherwise("train").alias("dataset"),
        F.concat(
            F.when(site % 4 == 0, "HUVEC-").otherwise("RPE-"),
            F.lpad((site % 3 + 1).cast("string"), 2, "0"),
        ).alias("experiment"),
        (site % 2 + 1).cast("int").alias("plate"),
        F.concat(F.lit("W"), site.cast("string")).alias("well"),
        F.lit(1).alias("site"),
    ]


def file_address(site):
    """An address that can be a file's, its own for every site number."""
    number = lambda n: F.lpad((n + 1).cast("string"), 2, "0")
    tree = F.expr("site_id div 4") % 3
    place = F.expr("site_id div 12")
    return {
        "dataset": F.when(tree == 0, "test").otherwise("train"),
        "experiment": F.concat(F.when(tree == 0, "HUVEC-").otherwise("RPE-"),
                               number(F.expr("site_id div 7392") * 3 + tree)),
        "plate": (site % 4 + 1).cast("int"),
        "well": F.concat(F.chr(place % 14 + 66), number(F.expr("site_id div 168") % 22 + 1)),
        "site": (F.expr("site_id div 3696") % 2 + 1).cast("int"),
    }


def file_planes(spark: SparkSession, sf_dir: str, deep: bool = False) -> DataFrame:
    """The planes at addresses that files can have. ``deep``: every fifth plane
    has 16 bits, most of its values beyond 255. Rows that repeat a vector id
    are one plane."""
    value = lambda v, top, scale: F.floor(F.abs(v.cast("double")) * scale).cast("int") % top
    two = lambda v: F.concat(F.lpad(F.hex(v % 256), 2, "0"), F.lpad(F.hex(F.floor(v / 256)), 2, "0"))
    shallow = F.transform("embedding", lambda v: F.lpad(F.hex(_pixel(v)), 2, "0"))
    deeper = F.transform("embedding", lambda v: two(value(v, 65536, 100_000)))
    is_deep = (F.col("vec_id") % 5 == 0) if deep else F.lit(False)
    return (
        table(spark, sf_dir, "embeddings").dropDuplicates(["vec_id"])
        .withColumn("site_id", F.expr("vec_id div 6"))
        .select(
            *[c.alias(name) for name, c in file_address(F.col("site_id")).items()],
            (F.col("vec_id") % 6 + 1).cast("int").alias("channel"),
            F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"),
            F.when(is_deep, 16).otherwise(8).alias("depth"),
            F.unhex(F.array_join(F.when(is_deep, deeper).otherwise(shallow), "")).alias("data"),
        )
    )


def plane_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site table that goes with ``planes``."""
    site = F.col("site_id")
    return (
        table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 6").alias("site_id"))
        .distinct()
        .select(
            site.alias("id_code"), *plane_address(site),
            F.lit(TREATMENT).alias("well_type"),
            F.when(site % 4 != 0, site % 1108).alias("sirna"),
        )
        .withColumn("cell_type", cell_type(F.col("experiment")))
        .select(*SITE_COLUMNS)
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("logits"), F.col("label").cast("long").alias("label")
    )
