"""Well tables to one site table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.functions.labels import cell_type, label_id
from platelake.schemas import SITE_COLUMNS, SITE_KEY, SITES, TREATMENT


def expand_sites(wells: DataFrame, sites: Sequence[int] = SITES) -> DataFrame:
    """Each well once per imaged site."""
    return wells.withColumn("site", F.explode(F.array(*[F.lit(s) for s in sites])))


def with_label(df: DataFrame) -> DataFrame:
    """The label as a nullable long, also where the input has none."""
    value = label_id(F.col("sirna")) if "sirna" in df.columns else F.lit(None).cast("long")
    return df.withColumn("sirna", value)


def merge_split(dataset: str, wells: DataFrame, controls: DataFrame | None = None) -> DataFrame:
    """Treatment wells of a split, and its control wells if given."""
    merged = with_label(wells).withColumn("well_type", F.lit(TREATMENT))
    if controls is not None:
        merged = with_label(controls).unionByName(merged, allowMissingColumns=True)
    return merged.select(
        "id_code",
        F.lit(dataset).alias("dataset"),
        "experiment",
        cell_type(F.col("experiment")).alias("cell_type"),
        "plate", "well", "well_type", "sirna",
    )


def merge_wells(parts: Mapping[str, tuple[DataFrame, DataFrame | None]]) -> DataFrame:
    """Site table from {split: (treatment wells, control wells or None)}."""
    merged = None
    for dataset in sorted(parts):
        split = merge_split(dataset, *parts[dataset])
        merged = split if merged is None else merged.unionByName(split)
    if merged is None:
        raise ValueError("no splits given")
    return expand_sites(merged).select(*SITE_COLUMNS)


def ordered(sites: DataFrame) -> DataFrame:
    """Reporting order: test before train, then wells and their sites."""
    return sites.orderBy("dataset", "id_code", "site")


def head(sites: DataFrame, n: int = 5) -> DataFrame:
    return ordered(sites).limit(n)


def select_sites(
    sites: DataFrame,
    datasets: Sequence[str] | None = None,
    well_type: str | None = TREATMENT,
    experiments: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the given splits, well type and experiments; None keeps all."""
    if datasets is not None:
        sites = sites.where(F.col("dataset").isin(list(datasets)))
    if well_type is not None:
        sites = sites.where(F.col("well_type") == well_type)
    if experiments is not None:
        sites = sites.where(F.col("experiment").isin(list(experiments)))
    return sites


def site_keys(sites: DataFrame) -> DataFrame:
    return sites.select(*SITE_KEY)
