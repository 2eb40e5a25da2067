"""Seeded shuffles and row numbers that no single task has to produce.

A window over a whole split would run in one task. Here rows are cut into
buckets that follow the wanted order; small per-bucket sums give each bucket
its start, and rows are numbered inside their bucket only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Copies of one row that a single task may write out.
COPIES_PER_TASK = 4096

# Offsets tables up to this many rows are broadcast, if the caller proves
# that there cannot be more.
BROADCAST_ROWS = 100_000


def order_key(seed: Column, columns: Sequence[str]) -> Column:
    """Sort key of the seeded shuffle: depends on the values of a row only,
    so other rows being there or not does not change the order. Nulls are
    left out of the hashed text."""
    values = [F.col(c).cast("string") for c in columns]
    return F.md5(F.concat_ws("|", seed.cast("string"), *values).cast("binary"))


def count_copies(df: DataFrame, out: str = "copies") -> DataFrame:
    """One row per distinct row. Copies are summed before the shuffle, so a
    row that makes up a third of the table costs one row per input task."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(out))


def expand_copies(df: DataFrame, copies: str = "copies", out: str = "copy") -> DataFrame:
    """Inverse of count_copies, numbering the copies of a row from 0.

    Rows with few copies are written out in place. Rows with many are first
    cut into slabs which are spread over the tasks.
    """
    keep = [c for c in df.columns if c != copies]
    n = F.col(copies)
    few = df.where(n <= COPIES_PER_TASK).select(
        *keep, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias(out)
    )
    slabs = df.where(n > COPIES_PER_TASK).select(
        *keep, n.alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) div {COPIES_PER_TASK}")))
        .alias("_slab"),
    )
    first = F.col("_slab") * COPIES_PER_TASK
    last = F.least(first + COPIES_PER_TASK, F.col("_n")) - 1
    many = slabs.repartition(*keep, "_slab").select(
        *keep, F.explode(F.sequence(first, last)).alias(out)
    )
    return few.unionByName(many)


def distinct_copies(df: DataFrame) -> DataFrame:
    """The same rows with a ``copy`` column that tells equal rows apart: null
    for the first, then 1, 2, ..."""
    spread = expand_copies(count_copies(df))
    return spread.withColumn("copy", F.when(F.col("copy") > 0, F.col("copy")))


def prefix_sum(
    df: DataFrame,
    groups: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    weight: Column | None = None,
    before: str = "before",
    total: str | None = None,
    bucket_limit: int | None = None,
) -> DataFrame:
    """Adds to each row the summed weight of the rows ahead of it in its group.

    ``bucket`` must not decrease along ``order``. A null group or bucket is an
    error: a join on it would lose the row. ``bucket_limit`` is the number of (group, bucket) pairs the
    caller can prove; with it small the offsets are broadcast, without it
    Spark picks the join from the measured size.
    """
    groups = list(groups)
    weight = F.lit(1).cast("long") if weight is None else weight
    rows = df.withColumn("_bucket", bucket).withColumn("_weight", weight)
    # In the columns themselves: the join below filters on them first of all.
    rows = rows.withColumns({c: F.coalesce(c, F.raise_error(F.lit(
        f"null in {c}: the row has no place")).cast(rows.schema[c].dataType))
        for c in [*groups, "_bucket"]})

    sums = rows.groupBy(*groups, "_bucket").agg(F.sum("_weight").alias("_sum"))
    per_group = Window.partitionBy(*groups)
    ahead = per_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *groups, "_bucket",
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"),
        F.sum("_sum").over(per_group).alias("_in_group"),
    )
    if bucket_limit is not None and bucket_limit <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)

    inside = (
        Window.partitionBy(*groups, "_bucket").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Running sum up to the row itself: unlike a frame that ends one row
    # earlier it is never null.
    counted = rows.withColumn("_upto", F.sum("_weight").over(inside))
    joined = counted.join(offsets, [*groups, "_bucket"])
    out = joined.withColumn(
        before, (F.col("_start") + F.col("_upto") - F.col("_weight")).cast("long")
    )
    if total:
        out = out.withColumn(total, F.col("_in_group").cast("long"))
    return out.drop("_bucket", "_weight", "_start", "_upto", "_in_group")


def number_by_key(
    df: DataFrame,
    groups: Sequence[str],
    key: str,
    ties: Sequence[str],
    digits: int,
    out: str = "pos",
    total: str | None = None,
    group_limit: int | None = None,
) -> DataFrame:
    """Position 1, 2, ... of each row of a group by an order_key column.

    Buckets are the leading hex digits of the key: 16**digits of them, even in
    size because the key is a hash.
    """
    limit = None if group_limit is None else group_limit * 16 ** digits
    numbered = prefix_sum(
        df, groups, F.substring(key, 1, digits), [key, *ties],
        before=out, total=total, bucket_limit=limit,
    )
    return numbered.withColumn(out, F.col(out) + 1)


def dense_ids(df: DataFrame, columns: Sequence[str], seed: int, out: str) -> DataFrame:
    """Distinct values of ``columns`` with an id 0, 1, ... in a seeded order."""
    columns = list(columns)
    keyed = (
        df.select(*columns).distinct()
        .withColumn("_all", F.lit(0)).withColumn("_key", order_key(F.lit(seed), columns))
    )
    numbered = number_by_key(keyed, ["_all"], "_key", columns, 2, out, group_limit=1)
    return numbered.select(*columns, (F.col(out) - 1).alias(out))
