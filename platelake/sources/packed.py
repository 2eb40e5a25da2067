"""Readers for packed trees and chunked arrays. They take what the latest commit
of a folder names; a folder without commits is read as it is."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.functions.paths import file_experiment
from platelake.schemas import CHUNK_TABLE, PACKED
from platelake.sources.runs import RUN, unit_paths

GROUPED = "by_exp_plate_site-"


def _committed(
    spark: SparkSession, root: str, schema: T.StructType, wanted: Callable[[str], bool]
) -> DataFrame:
    """Units of the latest commit as one table. The schema is given, so
    directory names such as "001" stay text."""
    paths = unit_paths(spark, root, wanted)
    if paths is None:
        return spark.read.schema(schema).parquet(root)
    if not paths:
        return spark.createDataFrame([], schema)
    with_run = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    return spark.read.schema(with_run).option("basePath", root).parquet(*paths).drop(RUN)


def directories(unit: str) -> dict[str, str]:
    """The directory columns of a unit such as layout=random-42/dataset=train."""
    return dict(part.split("=", 1) for part in unit.split("/"))


def _unit_of(layout: str | None, dataset: str | None) -> Callable[[str], bool]:
    chosen = {"layout": layout, "dataset": dataset}

    def wanted(unit: str) -> bool:
        found = directories(unit)
        return all(v is None or found[k] == v for k, v in chosen.items())

    return wanted


def read_packed(
    spark: SparkSession,
    root: str,
    layout: str | None = None,
    dataset: str | None = None,
    files: Sequence[str] | None = None,
    experiments: Sequence[str] | None = None,
) -> DataFrame:
    """Packed records; the selections prune directories. Of the grouped layouts
    only the files of ``experiments`` are opened, by their names; files of the
    random ones hold all experiments, so there rows are chosen."""
    records = _committed(spark, root, PACKED, _unit_of(layout, dataset))
    if layout is not None:
        records = records.where(F.col("layout") == layout)
    if dataset is not None:
        records = records.where(F.col("dataset") == dataset)
    if files is not None:
        records = records.where(F.col("file").isin(list(files)))
    if experiments is not None:
        names = list(experiments)
        # On directory columns alone, so that it chooses directories.
        records = records.where(
            ~F.col("layout").startswith(GROUPED) | file_experiment(F.col("file")).isin(names)
        ).where(F.col("experiment").isin(names))
    return records


def read_chunks(
    spark: SparkSession,
    root: str,
    datasets: Sequence[str] | None = None,
    experiments: Sequence[str] | None = None,
) -> DataFrame:
    """Pieces of chunked arrays; the selections choose directories."""

    def wanted(unit: str) -> bool:
        found = directories(unit)
        return ((datasets is None or found["dataset"] in datasets)
                and (experiments is None or found["experiment"] in experiments))

    chunks = _committed(spark, root, CHUNK_TABLE, wanted)
    if datasets is not None:
        chunks = chunks.where(F.col("dataset").isin(list(datasets)))
    if experiments is not None:
        chunks = chunks.where(F.col("experiment").isin(list(experiments)))
    return chunks
