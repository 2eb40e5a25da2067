"""Which site goes into which packed file, and at which place.

Plans hold keys and metadata only; image bytes join them later, once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.functions.paths import group_file, layout_name, padded_number
from platelake.operators.metadata import select_sites
from platelake.operators.numbering import distinct_copies, number_by_key, order_key
from platelake.schemas import ROW_KEY, ROWS_PER_FILE, SEED, SITE_COLUMNS, SPLITS, STRATEGIES

# Leading hex digits of the order key that cut a split, and a group, into
# buckets. 100 TB of images are some 70 million sites: a split that holds them
# all has buckets of 17,000 rows, a group that holds a third of them buckets
# of 1.5 million.
SPLIT_DIGITS = 3
GROUP_DIGITS = 1

PLAN_COLUMNS = ("strategy", "seed", "layout", "dataset", "file", "dest_path", "pos")


def check_strategies(strategies: Iterable[str]) -> list[str]:
    wanted = set(strategies)
    unknown = wanted - set(STRATEGIES)
    if unknown:
        raise ValueError(
            f"unknown strategies {sorted(unknown)}; choose from {list(STRATEGIES)}"
        )
    return [s for s in STRATEGIES if s in wanted]


def _check_splits(sites: DataFrame) -> None:
    """A site of an unknown split is an error. Looked for ahead, by one column:
    a check among the rows' own columns would keep Spark from computing them
    once for all strategies."""
    known = F.coalesce(F.col("dataset").isin(list(SPLITS)), F.lit(False))
    for row in sites.where(~known).select("dataset").take(1):
        raise ValueError(f"unknown split {row['dataset']}; choose from {list(SPLITS)}")


def _seeded(sites: DataFrame, seeds: Sequence[int]) -> tuple[DataFrame, list[str]]:
    """Each site once per seed, with its shuffle key, and the columns that
    break ties. The same for every strategy, so that Spark runs it once for all
    of them."""
    _check_splits(sites)
    columns = [c for c in SITE_COLUMNS if c in sites.columns]
    keys = [c for c in ROW_KEY if c in columns] + ["copy"]
    seeds = dict.fromkeys(seeds)
    rows = (
        distinct_copies(sites.select(*columns).where(F.col("dataset").isin(list(SPLITS))))
        .withColumn("seed", F.explode(F.array(*[F.lit(s).cast("long") for s in seeds])))
    )
    rest = [c for c in columns if c not in keys]
    return rows.withColumn("key", order_key(F.col("seed"), keys)), keys + rest


def _finish(numbered: DataFrame, strategy: str, dest: Column) -> DataFrame:
    columns = [c for c in SITE_COLUMNS if c in numbered.columns and c != "dataset"]
    return (
        numbered
        .withColumn("strategy", F.lit(strategy))
        .withColumn("layout", layout_name(strategy, F.col("seed")))
        .withColumn("dest_path", F.concat_ws("/", F.col("layout"), dest))
        .select(*PLAN_COLUMNS, *columns)
    )


def _random_files(rows: DataFrame, ties: list[str], per_file: int, n_seeds: int) -> DataFrame:
    if per_file < 1:
        raise ValueError("per_file must be positive")
    # A text that is never null, as in _group_files.
    numbered = number_by_key(
        rows.withColumn("split", F.concat_ws("", "dataset")), ["seed", "split"], "key", ties,
        SPLIT_DIGITS, out="rn", group_limit=n_seeds * len(SPLITS),
    )
    files = numbered.withColumns({
        "file": padded_number(F.expr(f"(rn - 1) div {per_file} + 1")),
        "pos": F.expr(f"(rn - 1) % {per_file} + 1"),
    })
    return _finish(files, "random", F.concat_ws("/", "dataset", "file"))


def _group_files(rows: DataFrame, ties: list[str]) -> DataFrame:
    # One text that is never null: nothing is filtered for the grouping, so
    # that the rows stay those of the random plan and are computed once.
    group = F.concat_ws("/", "dataset", group_file())
    numbered = number_by_key(
        rows.withColumn("group", group), ["seed", "group"], "key", ties, GROUP_DIGITS
    )
    return _finish(
        numbered.withColumn("file", group_file()), "by_exp_plate_site", F.col("file")
    )


def plan_random(
    sites: DataFrame, per_file: int = ROWS_PER_FILE, seeds: Sequence[int] = (SEED,)
) -> DataFrame:
    """Seeded shuffle of each split, cut into files of ``per_file`` rows."""
    return _random_files(*_seeded(sites, seeds), per_file, len(seeds))


def plan_grouped(sites: DataFrame, seeds: Sequence[int] = (SEED,)) -> DataFrame:
    """One file per experiment, plate and site, each in shuffled well order."""
    return _group_files(*_seeded(sites, seeds))


def plan_all(
    sites: DataFrame,
    strategies: Iterable[str] = STRATEGIES,
    per_file: int = ROWS_PER_FILE,
    seeds: Sequence[int] = (SEED,),
    datasets: Sequence[str] | None = None,
) -> DataFrame:
    """Plans of every strategy and seed; treatment wells only."""
    chosen = check_strategies(strategies)
    if not chosen or not seeds:
        raise ValueError("give at least one strategy and one seed")
    if datasets is not None and set(datasets) - set(SPLITS):
        raise ValueError(f"unknown datasets in {list(datasets)}; choose from {list(SPLITS)}")
    rows, ties = _seeded(select_sites(sites, datasets), seeds)
    plans = []
    if "random" in chosen:
        plans.append(_random_files(rows, ties, per_file, len(seeds)))
    if "by_exp_plate_site" in chosen:
        plans.append(_group_files(rows, ties))
    return reduce(DataFrame.unionByName, plans)


def manifest(plan: DataFrame) -> DataFrame:
    """One row per packed file."""
    return plan.groupBy("strategy", "seed", "dataset", "dest_path").agg(
        F.count(F.lit(1)).alias("n_sites"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
    )


def mixed_files(plan: DataFrame) -> DataFrame:
    """Files that would take rows of more than one split."""
    return (
        plan.groupBy("dest_path")
        .agg(F.min("dataset").alias("one"), F.max("dataset").alias("other"))
        .where(F.col("one") != F.col("other"))
    )
