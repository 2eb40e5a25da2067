"""Image planes to the packed files a plan names."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.operators.numbering import dense_ids
from platelake.operators.stack import group_planes, merge_planes
from platelake.schemas import CHANNELS, SEED, SITE_KEY

# A plan up to this many bytes is broadcast to the image scan; a longer one is
# shuffle-joined.
BROADCAST_PLAN_BYTES = 192 << 20
# What a row takes besides its texts, and a text besides its bytes.
ROW_BYTES = 64
TEXT_BYTES = 16

# Pixels that one address may bring to a task before it counts as hot.
HOT_ADDRESS_BYTES = 512 << 20

# At most this many addresses can be hot (some 30 MB): beyond 70 million plan
# rows the limit is raised with the plan.
MAX_HOT_ADDRESSES = 200_000

# Pixels of a site, unless the caller knows better.
IMAGE_BYTES = 512 * 512 * 6

# Rows of one file that a single task writes (about 2.4 GB of pixels). A file
# with more becomes several part files in its directory.
PART_ROWS = 1500

MAX_TASKS = 100_000


def _row_bytes(plan: DataFrame) -> Column:
    """What a plan row takes in a broadcast table."""
    total = F.lit(ROW_BYTES + 8 * len(plan.columns))
    for field in plan.schema.fields:
        if isinstance(field.dataType, T.StringType):
            total = total + TEXT_BYTES + F.coalesce(F.octet_length(field.name), F.lit(0))
    return total


def _salted(
    plan: DataFrame, images: DataFrame, hot: DataFrame, dirs: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Splits the rows of hot addresses over ``salts`` keys, and repeats just
    the images of those addresses."""
    small = F.broadcast(hot)
    salted = (
        plan.join(small, list(SITE_KEY), "left")
        .withColumn("salt", F.coalesce(
            F.pmod(F.xxhash64(*dirs, "pos"), F.col("salts")), F.lit(0).cast("long")))
        .drop("salts")
    )
    copies = (
        images.join(small, list(SITE_KEY), "left")
        .withColumn("salt", F.explode(F.sequence(
            F.lit(0).cast("long"), F.coalesce(F.col("salts"), F.lit(1).cast("long")) - 1)))
        .drop("salts")
    )
    return salted, copies


def _colocated(
    plan: DataFrame, images: DataFrame, hot: DataFrame, dirs: Sequence[str], any_hot: bool
) -> DataFrame:
    """Planes that are bucketed by their address stay where they are: the plan,
    which holds keys only, is shuffled to them. Only planes of hot addresses are
    taken out, shuffled and repeated."""
    if not any_hot:
        return images.join(plan, list(SITE_KEY))
    few = F.broadcast(hot.select(*SITE_KEY))
    main = images.join(plan.join(few, list(SITE_KEY), "left_anti"), list(SITE_KEY))
    salted, copies = _salted(
        plan.join(few, list(SITE_KEY), "left_semi"),
        images.join(few, list(SITE_KEY), "left_semi"), hot, dirs)
    return main.unionByName(copies.join(salted, [*SITE_KEY, "salt"]).drop("salt"))


def place_planes(
    plan: DataFrame,
    images: DataFrame,
    dirs: Sequence[str],
    channels: Sequence[int] = CHANNELS,
    strict: bool = True,
    part_rows: int = PART_ROWS,
    broadcast_bytes: int = BROADCAST_PLAN_BYTES,
    image_bytes: int = IMAGE_BYTES,
    bucketed: bool = False,
) -> DataFrame:
    """Each plan row with its planes, partitioned by file and in file order.

    ``plan`` must be materialised: its size is measured to choose the join.
    Broadcast plan: planes move once, straight to the task that writes their
    file. Shuffled plan: they move once too if they are ``bucketed`` by address
    (read_bucketed), otherwise twice; hot addresses are split.
    """
    parts = plan.withColumn("part", F.expr(f"(pos - 1) div {part_rows}"))
    size = parts.agg(
        F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(parts)).alias("bytes"),
        F.count_distinct(*dirs, "part").alias("parts"),
    ).first()
    images = images.where(F.col("channel").isin(list(channels)))

    hot_limit = max(HOT_ADDRESS_BYTES // image_bytes, size["n"] // MAX_HOT_ADDRESSES, 1)
    hot = (
        parts.groupBy(*SITE_KEY).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_limit)
        .select(*SITE_KEY, F.expr(f"(_n - 1) div {hot_limit} + 1").alias("salts"))
    )
    # One part per task. Hashing the parts instead would give the unluckiest of
    # many tasks several of them.
    tasks = min(max(size["parts"], 1), MAX_TASKS)
    ids = dense_ids(parts, [*dirs, "part"], SEED, "task")
    tasked = (
        parts.join(ids, [*dirs, "part"])
        .withColumn("task", (F.col("task") % tasks).cast("int")).drop("part")
    )

    any_hot = not hot.isEmpty()
    if (size["bytes"] or 0) <= broadcast_bytes and not any_hot:
        placed = images.join(F.broadcast(tasked), list(SITE_KEY))
    elif bucketed:
        placed = _colocated(tasked, images, hot, dirs, any_hot)
    else:
        salted, copies = _salted(tasked, images, hot, dirs)
        placed = copies.join(salted, [*SITE_KEY, "salt"]).drop("salt")

    placed = placed.repartitionById(tasks, F.col("task"))
    grouped = group_planes(placed, _row_columns(plan, dirs) + ["task"], channels, strict)
    # Grouping sorts by the same columns, so this adds no second sort, and it
    # tells the writer that none is needed.
    return grouped.sortWithinPartitions(*dirs, "pos")


def _row_columns(plan: DataFrame, dirs: Sequence[str]) -> list[str]:
    first = [*dirs, "pos"]
    return first + [c for c in plan.columns if c not in first]


def place_images(
    plan: DataFrame,
    images: DataFrame,
    dirs: Sequence[str],
    channels: Sequence[int] = CHANNELS,
    strict: bool = True,
    layout: str = "HWC",
    **placing,
) -> DataFrame:
    """Each plan row with its site image, partitioned by file and in file order."""
    grouped = place_planes(plan, images, dirs, channels, strict, **placing)
    return merge_planes(grouped, _row_columns(plan, dirs), channels, layout)


def map_files(
    placed: DataFrame,
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Runs ``function`` once per task of place_images, that is per file part
    (more than one only past MAX_TASKS parts), over batches of its records in
    file order: a file is a stream, never one data frame."""
    return placed.mapInPandas(function, schema)
