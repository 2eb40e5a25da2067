"""Planes bucketed and sorted by their address, as a table without a catalogue
of its own: the folder says how many buckets there are."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from platelake.schemas import SITE_KEY
from platelake.session import image_parquet
from platelake.sources.packed import directories
from platelake.sources.runs import commit, new_run, units

PLANE_BYTES = 512 * 512
# Pixels of a bucket, and what Spark allows by default.
BUCKET_BYTES = 512 << 20
MAX_BUCKETS = 100_000


def _name() -> str:
    return "platelake_planes_" + uuid.uuid4().hex


def write_bucketed(
    planes: DataFrame, dest: str, buckets: int | None = None, plane_bytes: int = PLANE_BYTES
) -> int:
    """Writes planes so that all of an address lie in one file, sorted by
    address; returns the number of buckets. Pixels are shuffled here, once, and
    no more when plans of any size are joined to them. The folder's planes are
    replaced by one commit.

    Without ``buckets`` their number follows from the number of planes. Rows
    that repeat an address all stay. A third of all planes having one address
    would be one bucket: drop such copies first (drop_plane_copies).
    """
    spark, root = planes.sparkSession, dest.rstrip("/")
    if buckets is None:
        buckets = min(max(1, -(-planes.count() * plane_bytes // BUCKET_BYTES)), MAX_BUCKETS)
    run, folder = new_run(root)
    unit = f"buckets={buckets}"
    path = f"{folder}/{unit}"
    order = [*SITE_KEY, *(["channel"] if "channel" in planes.columns else [])]
    name = _name()
    (
        planes.repartition(buckets, *SITE_KEY).sortWithinPartitions(*order)
        .write.bucketBy(buckets, *SITE_KEY).sortBy(*SITE_KEY).format("parquet")
        .option("compression", "zstd").options(**image_parquet("data", plane_bytes))
        .option("path", path).saveAsTable(name)
    )
    # The files stay: the table is one of a path.
    spark.sql(f"DROP TABLE {name}")
    gone = [u for u in units(spark, root) or {} if u != unit]
    commit(spark, root, run, [unit, *gone])
    return buckets


def read_bucketed(spark: SparkSession, root: str) -> DataFrame:
    """The planes of write_bucketed. Joins and groupings by address find them
    partitioned. The catalogue holds the table only while it is looked up."""
    held = units(spark, root)
    if not held:
        raise ValueError(f"no bucketed planes in {root}")
    ((unit, run),) = held.items()
    path = f"{root.rstrip('/')}/run={run}/{unit}"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    key, name = ", ".join(SITE_KEY), _name()
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {directories(unit)['buckets']} BUCKETS "
        f"LOCATION '{path}'")
    planes = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return planes
