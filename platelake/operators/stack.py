"""Channel planes to site images, and the reports on what is missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions.tensors import false_colour, interleave_planes, join_planes
from platelake.schemas import CHANNELS, COLOUR_MAP, SITE_KEY
from platelake.session import cut_lineage
from platelake.sources.images import scan_keys, scan_site
from platelake.sources.plates import open_sites
from platelake.sources.stores import can_open


def channel_mask(channels: Sequence[int]) -> Column:
    """A bit per wanted channel, set if any row of the group has it."""
    if len(channels) > 62:
        raise ValueError("at most 62 channels")
    bit = F.lit(0).cast("long")
    for i, channel in enumerate(channels):
        bit = F.when(F.col("channel") == channel, F.lit(1 << i).cast("long")).otherwise(bit)
    return F.bit_or(bit)


def _full(channels: Sequence[int]) -> int:
    return (1 << len(channels)) - 1


def channel_presence(
    sites: DataFrame, inventory: DataFrame, channels: Sequence[int] = CHANNELS
) -> DataFrame:
    """Per wanted address: how many sites use it, and which channels exist.

    Both sides shrink to one row per address before they meet, so neither a
    repeated address nor six rows per site are shuffled.
    """
    channels = list(dict.fromkeys(channels))
    wanted = sites.groupBy(*SITE_KEY).agg(F.count(F.lit(1)).alias("n_sites"))
    present = (
        inventory.where(F.col("channel").isin(channels))
        .groupBy(*SITE_KEY).agg(channel_mask(channels).alias("mask"))
    )
    return wanted.join(present, list(SITE_KEY), "left").withColumn(
        "mask", F.coalesce("mask", F.lit(0).cast("long"))
    )


def missing_images(
    sites: DataFrame, inventory: DataFrame, channels: Sequence[int] = CHANNELS
) -> DataFrame:
    """Channel files that are wanted but not there, and the sites they affect."""
    channels = list(dict.fromkeys(channels))
    absent = F.filter(
        F.array(*[
            F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) == 0, F.lit(c))
            for i, c in enumerate(channels)
        ]),
        lambda c: c.isNotNull(),
    )
    return (
        channel_presence(sites, inventory, channels)
        .where(F.col("mask") != _full(channels))
        .select(*SITE_KEY, F.explode(absent).alias("channel"), "n_sites")
    )


def complete_sites(
    sites: DataFrame, inventory: DataFrame, channels: Sequence[int] = CHANNELS
) -> DataFrame:
    """Addresses with every wanted channel, and the sites that use them."""
    full = _full(list(dict.fromkeys(channels)))
    return (
        channel_presence(sites, inventory, channels)
        .where(F.col("mask") == full).drop("mask")
    )


def plane_column(channel: int) -> Column:
    """Where group_planes puts the plane of a channel."""
    return F.col(f"_plane{channel}")


def _plane(channel: int) -> Column:
    """The plane of a channel. Copies must be equal (see _copies_agree), so the
    largest is any of them; no list of planes is built."""
    return F.max(F.when((F.col("channel") == channel) & F.col("readable"), F.col("data")))


def _copies_agree(channel: int) -> Column:
    """Whether the copies of a plane are one and the same, by their hashes."""
    mark = F.when((F.col("channel") == channel) & F.col("readable"), F.xxhash64("data"))
    return F.min(mark) == F.max(mark)


def _same(name: str) -> Column:
    return F.min(name) == F.max(name)


# Words of 64 bits in the bitmap of repeated addresses: some 40 MB as a
# broadcast table, however many addresses there are.
COPY_WORD_BITS = 20


def _copy_bit(address: Sequence[str]) -> tuple[Column, Column]:
    """Word and bit of an address in the bitmap."""
    mark = F.xxhash64(*address)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), mark.bitwiseAND(F.lit(63)).cast("int"))
    return F.shiftrightunsigned(mark, 64 - COPY_WORD_BITS), bit


def drop_plane_copies(images: DataFrame) -> DataFrame:
    """Copies of a plane become one before they are shuffled. Needed for tables
    of planes only: under one image root a path, and so a plane, is unique.

    A first job looks at addresses alone. Without copies the planes are given
    back as they are. Otherwise the repeated addresses become a bitmap of
    bounded size that the scan of the planes is held against: what has no bit
    passes by, in whatever number, and the rest is grouped. An address that
    shares a bit by chance is grouped too, which leaves it as it is.
    """
    rest = [c for c in images.columns if c != "data"]
    address = [c for c in (*SITE_KEY, "channel") if c in rest]
    word, bit = _copy_bit(address)
    # Rows without a whole address are no copies of each other.
    whole = reduce(and_, [F.col(c).isNotNull() for c in address])
    repeated = images.where(whole).groupBy(*address).agg(
        F.count(F.lit(1)).alias("_n")).where("_n > 1")
    bitmap = cut_lineage(
        repeated.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits")), "plane-copies")
    if bitmap.isEmpty():
        return images
    held = images.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left")
    marked = whole & (F.coalesce(F.col("_bits"), F.lit(0).cast("long")).bitwiseAND(bit) != 0)
    # Different planes of one address both stay: group_planes refuses them.
    copies = held.where(marked).withColumn("_mark", F.xxhash64("data"))
    merged = copies.groupBy(*rest, "_mark").agg(F.max("data").alias("data"))
    return held.where(~marked).select(*images.columns).unionByName(merged.drop("_mark"))


def group_planes(
    images: DataFrame,
    keys: Sequence[str] = SITE_KEY,
    channels: Sequence[int] = CHANNELS,
    strict: bool = True,
) -> DataFrame:
    """One row per key with a column per plane, sorted by key in each task.

    Strict: a missing, unreadable or odd-sized plane is an error, and so are
    two planes of one address that differ. Otherwise such sites are left out.
    """
    if "readable" not in images.columns:
        images = images.withColumn("readable", F.lit(True))
    distinct = list(dict.fromkeys(channels))
    usable = F.col("readable")
    grouped = (
        images.where(F.col("channel").isin(distinct))
        .groupBy(*keys)
        .agg(
            *[_plane(c).alias(f"_plane{c}") for c in distinct],
            F.min(F.when(usable, F.col("height"))).alias("height"),
            F.min(F.when(usable, F.col("width"))).alias("width"),
            (_same("height") & _same("width")).alias("_even"),
            *[_copies_agree(c).alias(f"_one{c}") for c in distinct],
        )
    )
    ok, agree = F.col("_even"), F.lit(True)
    for c in distinct:
        plane = plane_column(c)
        ok = ok & plane.isNotNull() & (F.octet_length(plane) == F.col("height") * F.col("width"))
        agree = agree & F.coalesce(F.col(f"_one{c}"), F.lit(True))
    ok = F.coalesce(ok, F.lit(False))
    if not strict:
        return grouped.where(ok & agree)
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    said = F.when(agree, F.lit("missing, unreadable or odd-sized plane: ")).otherwise(
        F.lit("planes of one address that differ: "))
    error = F.raise_error(F.concat(said, name))
    # On a plane, so that the check runs before the planes are merged.
    first = f"_plane{distinct[0]}"
    return grouped.withColumn(first, F.when(ok & agree, F.col(first)).otherwise(error.cast("binary")))


def merge_planes(
    grouped: DataFrame, keys: Sequence[str], channels: Sequence[int], layout: str = "HWC"
) -> DataFrame:
    """The planes of group_planes as one image, plane i being channels[i]."""
    if layout not in ("HWC", "CHW"):
        raise ValueError(f"layout must be HWC or CHW, not {layout!r}")
    planes = [plane_column(c) for c in channels]
    merged = interleave_planes(planes) if layout == "HWC" else join_planes(planes)
    return grouped.select(
        *keys, "height", "width", F.lit(len(channels)).alias("channels"),
        merged.alias("image"),
    )


def stack_channels(
    images: DataFrame,
    keys: Sequence[str] = SITE_KEY,
    channels: Sequence[int] = CHANNELS,
    strict: bool = True,
    layout: str = "HWC",
) -> DataFrame:
    """One image per key from its channel planes."""
    return merge_planes(group_planes(images, keys, channels, strict), keys, channels, layout)


def load_sites(
    spark: SparkSession,
    keys: DataFrame,
    root: str,
    channels: Sequence[int] = CHANNELS,
    strict: bool = True,
    depth: int = 8,
) -> DataFrame:
    """Site images of many addresses. Exactly their files are opened, each site
    by one task, and pixels are not shuffled. No keys, no images. Strict: an
    address without files and a missing, broken or odd-sized plane are errors;
    otherwise such sites are left out. ``depth`` 16 gives two bytes per value,
    low one first; 8 refuses files of 16 bits as if they were broken.

    Where tasks cannot open files by name (a store only Spark reads), the
    plates of the keys are listed and read by Spark's image source instead,
    which knows 8 bits only.
    """
    if not can_open(root):
        if depth != 8:
            raise ValueError(f"files of {root} can be read at 8 bits only")
        return load_from(scan_keys(spark, root, keys, channels), keys, channels, strict, unique=True)
    opened, problem = open_sites(spark, root, keys, channels, depth), F.col("problem")
    # A filter is kept whatever columns are read.
    if strict:
        opened = opened.where(
            F.when(problem.isNull(), True).otherwise(F.raise_error(problem).cast("boolean")))
    else:
        opened = opened.where(problem.isNull())
    return opened.drop("problem")


def load_from(
    images: DataFrame,
    keys: DataFrame,
    channels: Sequence[int] = CHANNELS,
    strict: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Site images of the addresses in ``keys``. The joins and the stacking use
    the same partitioning, so planes are shuffled once whichever join Spark
    picks; copies of planes, if there are any, are shuffled once more. Strict:
    an address without a single file is an error too. ``unique`` promises that
    no plane is there twice, which saves looking for copies."""
    if not unique:
        images = drop_plane_copies(images)
    wanted = keys.select(*SITE_KEY).distinct()
    found = images.join(wanted, list(SITE_KEY), "left_semi")
    stacked = stack_channels(found, SITE_KEY, channels, strict)
    if not strict:
        return stacked
    # An address with no file at all is not among the stacked ones.
    error = F.raise_error(F.concat(
        F.lit("no image file for "),
        F.concat_ws("/", *[F.col(k).cast("string") for k in SITE_KEY]),
    ))
    return stacked.join(wanted, list(SITE_KEY), "right").withColumn(
        "height", F.coalesce(F.col("height"), error.cast("int"))
    )


def load_site(
    spark: SparkSession,
    dataset: str,
    experiment: str,
    plate: int,
    well: str,
    site: int,
    root: str,
    channels: Sequence[int] = CHANNELS,
) -> DataFrame:
    """The image of one site."""
    planes = scan_site(spark, root, dataset, experiment, plate, well, site, channels)
    return stack_channels(planes, SITE_KEY, channels)


def to_rgb(
    stacked: DataFrame,
    channels: Sequence[int] = CHANNELS,
    vmax: float = 255,
    colour_map=COLOUR_MAP,
) -> DataFrame:
    """HWC site images to false-colour RGB images."""
    return stacked.withColumns({
        "image": false_colour(F.col("image"), channels, vmax, colour_map),
        "channels": F.lit(3),
    })


def load_sites_rgb(
    spark: SparkSession,
    keys: DataFrame,
    root: str,
    channels: Sequence[int] = CHANNELS,
    colour_map=COLOUR_MAP,
) -> DataFrame:
    return to_rgb(load_sites(spark, keys, root, channels), channels, colour_map=colour_map)


def load_site_rgb(
    spark: SparkSession,
    dataset: str,
    experiment: str,
    plate: int,
    well: str,
    site: int,
    root: str,
    channels: Sequence[int] = CHANNELS,
    colour_map=COLOUR_MAP,
) -> DataFrame:
    one = load_site(spark, dataset, experiment, plate, well, site, root, channels)
    return to_rgb(one, channels, colour_map=colour_map)
