"""Readers for the four metadata CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.operators.metadata import merge_wells
from platelake.schemas import SPLITS

# Column types are fixed here, not inferred; columns are found by name
# because the files differ in which they have and in what order.
CSV_TYPES = {
    "id_code": "string",
    "experiment": "string",
    "plate": "int",
    "well": "string",
    "well_type": "string",
    "sirna": "string",
}


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    known = [c for c in CSV_TYPES if c in raw.columns]
    return raw.select(*[F.col(c).cast(CSV_TYPES[c]) for c in known])


def read_wells(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    return read_metadata_csv(spark, f"{base}/{dataset}.csv")


def read_controls(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    return read_metadata_csv(spark, f"{base}/{dataset}_controls.csv")


def site_table(
    spark: SparkSession,
    base: str,
    include_controls: bool = True,
    datasets: Sequence[str] = SPLITS,
) -> DataFrame:
    """All metadata files as one site table; controls are not even opened
    when they are not wanted."""
    return merge_wells({
        d: (read_wells(spark, base, d),
            read_controls(spark, base, d) if include_controls else None)
        for d in datasets
    })
