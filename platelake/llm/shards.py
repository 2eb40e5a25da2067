"""Uniform shuffle of a table into shards of exact sizes.

How many rows of each input partition go to each shard is drawn from the
hypergeometric law first. Rows are permuted in their partition and cut by
those counts, exchanged, and permuted again in their shard.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from platelake.session import cut_lineage

SHARDS = 8
SEED = 42

# Input partitions are merged beyond this many, so the matrix of counts has
# 65,536 x shards entries at most.
MAX_PARTS = 1 << 16

# Rows of a shard that one task sorts. With more than MAX_BLOCKS of them all
# blocks grow alike: 20 billion rows make blocks of 76,000.
BLOCK_ROWS = 1 << 11
MAX_BLOCKS = 1 << 18

# How far from its mode a count is looked for, in standard deviations. What
# lies beyond has less weight than the last bit of a double.
REACH = 40

_ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` balls out of ``good + bad`` are good ones.

    By inversion over the weights around the mode, each from its neighbour by
    their ratio; populations may exceed what 32 bits count.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    share = good / total
    spread = (draws * share * (1 - share) * (total - draws) / max(total - 1, 1)) ** 0.5
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    reach = int(REACH * spread) + REACH
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    # Weight of k + 1 over weight of k.
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    upto = np.cumsum(weights)
    return low + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def communication_matrix(counts: Sequence[int], sizes: Sequence[int], seed: int) -> np.ndarray:
    """Rows of partition i for shard j: row sums are ``counts``, column sums are
    ``sizes``, and the draw is that of a uniform permutation of all rows."""
    left = [int(s) for s in sizes]
    if sum(left) != sum(counts):
        raise ValueError("partitions and shards hold different numbers of rows")
    rng = np.random.default_rng([seed, len(counts), len(left)])
    out = np.zeros((len(counts), len(left)), np.int64)
    total = sum(left)
    for i, count in enumerate(counts):
        draws, others = int(count), total
        for j, good in enumerate(left):
            others -= good
            out[i, j] = taken = hypergeometric(rng, good, others, draws)
            draws -= taken
        left = [a - int(b) for a, b in zip(left, out[i], strict=True)]
        total -= int(count)
    return out


def _small(spark: SparkSession, rows: pa.Table) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows))


def _hashable(data_type: T.DataType) -> bool:
    """Spark hashes no maps."""
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def shuffle_into_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, row: str = "row"
) -> DataFrame:
    """The input row as a struct, its ``shard`` and its ``slot`` there.

    Shard sizes differ by one row at most, the first ones being larger; slots
    of a shard run from 0 without a gap; an empty table gives no rows. Nulls,
    empty texts and repeated rows are rows like others: only numbers of rows
    are drawn, and no value of a row decides where it can go. Rows travel in
    a struct, so no column name clashes. Partitions, shards and seed being
    the same, so is the result.

    The permuted rows of each partition are a written table with the place of
    every row, so later steps and repeated tasks see the same partitions.
    Rows are exchanged once. A shard is sorted in blocks, by a second hash;
    two broadcast tables, of the counts and of where blocks begin, are bounded
    by MAX_PARTS and MAX_BLOCKS.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = docs.sparkSession
    known = [F.col(f"`{f.name}`") for f in docs.schema.fields if _hashable(f.dataType)]
    keyed = docs.select(F.struct("*").alias(row), F.xxhash64(F.lit(seed), *known).alias("key"))
    permuted = keyed.coalesce(MAX_PARTS).sortWithinPartitions("key").withColumns({
        "part": F.spark_partition_id(),
        "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })
    table = cut_lineage(permuted, "permuted")

    counted = sorted(map(tuple, table.groupBy("part").agg(F.count(F.lit(1))).collect()))
    sizes = shard_sizes(sum(n for _, n in counted), shards)
    matrix = communication_matrix([n for _, n in counted], sizes, seed)
    bounds = _small(spark, pa.table({
        "part": pa.array([p for p, _ in counted], pa.int32()),
        "bounds": pa.array(list(np.cumsum(matrix, axis=1)), pa.list_(pa.int64())),
    }))
    blocks = min(max(1, -(-max(sizes) // BLOCK_ROWS)), max(1, MAX_BLOCKS // shards))
    # The upper half of a hash, so that blocks follow the order of the hashes.
    second = F.xxhash64(F.lit(seed), F.lit("second"), "key", "part", "place")
    half = F.shiftrightunsigned(second, 32)
    dealt = (
        table.join(bounds, "part")
        .withColumn("shard", F.size(F.filter("bounds", lambda b: b <= F.col("place"))))
        .withColumn("second", second)
        .withColumn("block", F.shiftright(half * blocks, 32).cast("int"))
        .drop("bounds", "key", "part", "place")
    )
    ahead = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy("second")
    return (
        dealt.join(F.broadcast(starts), ["shard", "block"])
        .withColumn("slot", F.col("start") + F.row_number().over(inside) - 1)
        .select(row, "shard", "slot")
    )


def write_shards(placed: DataFrame, path: str, row: str = "row") -> None:
    """A folder ``shard=<j>`` per shard; rows of a file ascend by slot, and the
    files of a shard hold disjoint ranges of slots or interleave by blocks."""
    flat = placed.select(F.col(f"{row}.*"), "slot", "shard")
    flat.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
