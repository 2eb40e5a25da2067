"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake import fixtures
from platelake.functions.labels import label_id
from platelake.functions.paths import image_path
from platelake.functions.scores import cross_entropy, predicted_class, probabilities
from platelake.functions.tensors import decode_bytes, decode_floats
from platelake.operators import feed, histograms, metadata, pixels, scoring, stack
from platelake.operators.chunks import assemble_arrays as put_arrays_together
from platelake.operators.chunks import read_window as window_of
from platelake.operators.chunks import to_chunks
from platelake.plans import packing
from platelake.operators.stack import drop_plane_copies
from platelake.plans.jobs import convert_images
from platelake.plans.jobs import pack_images as pack_job
from platelake.plans.jobs import plan_arrays, write_chunks
from platelake.plans.placing import map_files, place_images
from platelake.schemas import (
    CHANNELS, PACK_DIRS, PIXEL_STATS, RECORD_COLUMNS, SITE_COLUMNS, SITE_KEY, SPLITS, STRATEGIES,
)
from platelake.session import cut_lineage, scratch_path
from platelake.sources.bucketed import read_bucketed, write_bucketed
from platelake.sources.images import parse_paths, read_planes, splits_in
from platelake.sources.plates import scan_plates, write_plates
from platelake.sources.metadata_csv import site_table
from platelake.sources.packed import read_chunks, read_packed
from platelake.streaming.feed import feed_examples, stream_packed
from platelake.streaming.images import ingest_stream, stream_images

EXPERIMENTS = ["RPE-05", "U2OS-03"]
PLAN = ["seed", "dataset", "dest_path", "pos", "id_code", "site"]


def _treatments(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.select_sites(fixtures.sites(spark, sf))


# --- metadata ---------------------------------------------------------------

def combine_metadata(spark, sf):
    return metadata.merge_wells(fixtures.well_files(spark, sf))


def metadata_csv(spark, sf):
    """The four files, written by Spark and read back as one site table."""
    base = scratch_path(spark, "metadata")
    for dataset, (wells, controls) in fixtures.well_files(spark, sf).items():
        wells.write.option("header", True).csv(f"{base}/{dataset}.csv")
        controls.write.option("header", True).csv(f"{base}/{dataset}_controls.csv")
    return site_table(spark, base)


def expand_sites(spark, sf):
    wells = fixtures.plate_map(spark, sf).select("id_code", "experiment", "plate", "well")
    return metadata.expand_sites(wells)


def metadata_head(spark, sf):
    return metadata.head(fixtures.sites(spark, sf))


def fix_labels(spark, sf):
    floats = F.coalesce(F.col("sirna").cast("double"), F.lit(float("nan")))
    wells = fixtures.plate_map(spark, sf).select("id_code", floats.alias("sirna"))
    return wells.select("id_code", label_id(F.col("sirna")).alias("sirna"))


def filter_sites(spark, sf):
    return metadata.select_sites(fixtures.sites(spark, sf), ["train"])


def select_experiments(spark, sf):
    return metadata.select_sites(fixtures.sites(spark, sf), experiments=EXPERIMENTS)


def site_keys(spark, sf):
    return metadata.site_keys(fixtures.sites(spark, sf))


def packed_columns(spark, sf):
    return _treatments(spark, sf).select(*RECORD_COLUMNS)


def labelled_examples(spark, sf):
    return feed.labelled(_treatments(spark, sf)).select("id_code", "dataset", "site", "sirna")


# --- files ------------------------------------------------------------------

def image_paths(spark, sf):
    channels = F.array(*[F.lit(c) for c in CHANNELS])
    return (
        _treatments(spark, sf)
        .select("id_code", *SITE_KEY, F.posexplode(channels).alias("channel_pos", "channel"))
        .select("id_code", "site", "channel", "channel_pos",
                image_path(fixtures.IMAGE_ROOT).alias("path"))
    )


def parse_image_path(spark, sf):
    return parse_paths(fixtures.image_inventory(spark, sf))


def discover_splits(spark, sf):
    return splits_in(fixtures.image_inventory(spark, sf), fixtures.IMAGE_ROOT)


def _inventory(spark, sf):
    return parse_paths(fixtures.image_inventory(spark, sf)).where("parsed")


def missing_images(spark, sf):
    return stack.missing_images(_treatments(spark, sf), _inventory(spark, sf))


def complete_sites(spark, sf):
    return stack.complete_sites(_treatments(spark, sf), _inventory(spark, sf))


# --- pack plans -------------------------------------------------------------

def pack_random(spark, sf):
    return packing.plan_random(_treatments(spark, sf)).select(*PLAN)


def pack_by_group(spark, sf):
    return packing.plan_grouped(_treatments(spark, sf)).select(*PLAN)


def pack_multi_seed(spark, sf):
    return packing.plan_all(fixtures.sites(spark, sf), seeds=(42, 7)).select("strategy", *PLAN)


def pack_manifest(spark, sf):
    return packing.manifest(packing.plan_all(fixtures.sites(spark, sf)))


# --- pixel tables -----------------------------------------------------------

def stack_complete_sites(spark, sf):
    return pixels.stack_rows(fixtures.pixels(spark, sf), ["site_id"])


def pixel_index(spark, sf):
    rows = pixels.index_rows(
        fixtures.pixels(spark, sf), len(CHANNELS), fixtures.SIDE ** 2)
    return rows.select("site_id", "channel", "px", "hwc_index", "chw_index")


def rgb_compose(spark, sf):
    return pixels.to_rgb_rows(fixtures.pixels(spark, sf), ["site_id"])


def normalize_pixels(spark, sf):
    rows = pixels.normalise_rows(fixtures.pixels(spark, sf))
    return rows.select("site_id", "channel", "px", F.round("normalised", 6).alias("normalised"))


def unit_scale(spark, sf):
    rows = pixels.unit_scale_rows(fixtures.pixels(spark, sf))
    return rows.select("site_id", "channel", "px", F.round("scaled", 6).alias("scaled"))


def _rounded_stats(stats):
    return stats.select(
        "channel", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def pixel_stats(spark, sf):
    return _rounded_stats(pixels.pixel_stats_rows(fixtures.pixels(spark, sf)))


# --- image bytes ------------------------------------------------------------

def _stacked(spark, sf, layout="HWC"):
    return stack.stack_channels(fixtures.planes(spark, sf), strict=False, layout=layout)


def load_sites(spark, sf):
    keys = fixtures.plane_sites(spark, sf)
    loaded = stack.load_from(fixtures.planes(spark, sf), keys, strict=False)
    return loaded.select("well", F.posexplode(decode_bytes(F.col("image"))).alias("idx", "val"))


def _png_tree(spark, sf, deep):
    """The planes as PNG files, and the addresses they have."""
    root = scratch_path(spark, "png")
    planes = fixtures.file_planes(spark, sf, deep)
    write_plates(planes, root)
    return root, planes.select(*SITE_KEY).distinct()


def load_png_sites(spark, sf):
    """Files of both depths, written and opened again by their key."""
    root, keys = _png_tree(spark, sf, deep=True)
    loaded = stack.load_sites(spark, keys, root, strict=False, depth=16)
    values = decode_bytes(F.col("image"), "<u2")
    return loaded.select(*SITE_KEY, F.posexplode(values).alias("idx", "val"))


def load_png_rgb(spark, sf):
    root, keys = _png_tree(spark, sf, deep=False)
    rgb = stack.to_rgb(stack.load_sites(spark, keys, root, strict=False))
    return rgb.select(*SITE_KEY, F.posexplode(decode_bytes(F.col("image"))).alias("idx", "val"))


def scan_png_plates(spark, sf):
    """Every file of one split, plate folder by plate folder."""
    root, _ = _png_tree(spark, sf, deep=True)
    planes = scan_plates(spark, root, datasets=["train"])
    eight, sixteen = (decode_bytes(F.col("data"), kind) for kind in ("uint8", "<u2"))
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)
    return planes.select(
        *SITE_KEY, "channel", "height", "width", "readable", "depth",
        F.when(F.col("depth") == 16, total(sixteen)).otherwise(total(eight)).alias("total"))


def stream_planes(spark, sf):
    """Files of one split and, in a second run that goes on where the first
    stopped, those of the other."""
    root, dest, state = (scratch_path(spark, n) for n in ("arriving", "ingested", "ingest-state"))
    planes = fixtures.file_planes(spark, sf)
    for dataset in SPLITS:
        write_plates(planes.where(F.col("dataset") == dataset), root)
        ingest_stream(stream_images(spark, root), dest, state, drain=True).awaitTermination()
    total = F.aggregate(decode_bytes(F.col("data")), F.lit(0).cast("long"), lambda a, v: a + v)
    return read_planes(spark, dest).select(
        *SITE_KEY, "channel", "height", "width", "readable", total.alias("total"))


def pixel_percentiles(spark, sf):
    """Statistics per experiment and channel from histograms."""
    stats = histograms.histogram_stats(histograms.pixel_histograms(fixtures.planes(spark, sf)))
    return stats.select(
        "experiment", "channel", "n", F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"), "p1", "p50", "p99")


def channel_first_images(spark, sf):
    loaded = _stacked(spark, sf, "CHW")
    return loaded.select("well", F.posexplode(decode_bytes(F.col("image"))).alias("idx", "val"))


def rgb_images(spark, sf):
    rgb = stack.to_rgb(_stacked(spark, sf))
    return rgb.select("well", F.posexplode(decode_bytes(F.col("image"))).alias("idx", "val"))


def normalize_images(spark, sf):
    out = feed.normalise_examples(_stacked(spark, sf), PIXEL_STATS)
    return out.select("well", F.posexplode(decode_floats(F.col("image"))).alias("idx", "v")).select(
        "well", "idx", F.round(F.col("v").cast("double"), 5).alias("normalised"))


def pixel_stats_images(spark, sf):
    return _rounded_stats(pixels.pixel_stats(fixtures.planes(spark, sf)))


def chunk_sites(spark, sf):
    return _chunk_totals(to_chunks(_stacked(spark, sf), chunk=4))


def _chunk_totals(chunks):
    values = decode_bytes(F.col("data"), "<u2")
    return chunks.select(
        "array_path", "cy", "cx", "rows", "cols",
        F.octet_length("data").cast("long").alias("n_bytes"),
        F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v).alias("total"),
    )


def strict_sites(spark, sf):
    """Sites with all planes, stacked in strict mode."""
    planes = fixtures.planes(spark, sf)
    whole = planes.groupBy(*SITE_KEY).agg(F.count_distinct("channel").alias("n"))
    planes = planes.join(whole.where(F.col("n") == len(CHANNELS)), list(SITE_KEY), "left_semi")
    stacked = stack.stack_channels(planes, strict=True)
    return stacked.select("well", F.posexplode(decode_bytes(F.col("image"))).alias("idx", "val"))


def write_arrays(spark, sf):
    """Arrays of one split after another, written to one folder and read back."""
    dest = scratch_path(spark, "arrays")
    planes, sites = fixtures.planes(spark, sf), fixtures.plane_sites(spark, sf)
    for dataset in SPLITS:
        plan = cut_lineage(plan_arrays(sites.where(F.col("dataset") == dataset)))
        write_chunks(plan, drop_plane_copies(planes), dest, chunk=4, strict=False)
    return _chunk_totals(read_chunks(spark, dest))


def convert_sites(spark, sf):
    """The conversion job from a table of planes; incomplete sites are left out."""
    dest = scratch_path(spark, "converted")
    convert_images(fixtures.plane_sites(spark, sf), fixtures.planes(spark, sf), dest,
                   strict=False, chunk=4)
    return _chunk_totals(read_chunks(spark, dest))


def _ragged_arrays(spark, sf):
    """Arrays in pieces of 3x3, smaller ones at the edges."""
    dest = scratch_path(spark, "ragged")
    convert_images(fixtures.plane_sites(spark, sf), fixtures.planes(spark, sf), dest,
                   strict=False, chunk=3, by_window=True)
    return read_chunks(spark, dest)


def assemble_arrays(spark, sf):
    images = put_arrays_together(_ragged_arrays(spark, sf))
    values = decode_bytes(F.col("image"), "<u2")
    return images.select("array_path", "height", "width", F.posexplode(values).alias("idx", "val"))


def read_window(spark, sf):
    """Rows 2 to 6 and columns 4 on, cut at the edge of the images."""
    images = window_of(_ragged_arrays(spark, sf), top=2, left=4, height=5, width=9)
    values = decode_bytes(F.col("image"), "<u2")
    return images.select("array_path", "height", "width", F.posexplode(values).alias("idx", "val"))


def _file_totals(batches):
    """Records and pixel sum of each file of a task's stream."""
    found = {}
    for batch in batches:
        for layout, dataset, file, image in zip(
                batch["layout"], batch["dataset"], batch["file"], batch["image"], strict=True):
            n, total = found.get((layout, dataset, file), (0, 0))
            found[layout, dataset, file] = (
                n + 1, total + int(np.frombuffer(image, np.uint8).sum(dtype=np.int64)))
    yield pd.DataFrame(
        [(*k, *v) for k, v in found.items()], columns=["layout", "dataset", "file", "n", "total"])


def file_summaries(spark, sf):
    """A function over the stream of each planned file."""
    sites = fixtures.plane_sites(spark, sf)
    planes = drop_plane_copies(fixtures.planes(spark, sf))
    whole = stack.complete_sites(sites, planes)
    plan = cut_lineage(packing.plan_all(
        sites.join(whole.select(*SITE_KEY), list(SITE_KEY), "left_semi"), ["random"], per_file=50))
    placed = place_images(plan.select(*dict.fromkeys(
        [*PACK_DIRS, "pos", *SITE_KEY, *RECORD_COLUMNS])), planes, PACK_DIRS)
    return map_files(
        placed, _file_totals, "layout string, dataset string, file string, n long, total long")


def _packed_tree(spark, sf, strategies=STRATEGIES):
    """Packs the planes of the vectors; incomplete sites are left out."""
    dest = scratch_path(spark, "packed")
    pack_job(
        fixtures.plane_sites(spark, sf), fixtures.planes(spark, sf), dest,
        strategies, per_file=50, strict=False,
    )
    return dest


def pack_images(spark, sf):
    return _record_sums(read_packed(spark, _packed_tree(spark, sf)))


def pack_bucketed(spark, sf):
    """The same from planes bucketed by address, with plans that are shuffled."""
    planes, dest = scratch_path(spark, "bucketed"), scratch_path(spark, "packed")
    write_bucketed(drop_plane_copies(fixtures.planes(spark, sf)), planes, buckets=4)
    pack_job(
        fixtures.plane_sites(spark, sf), read_bucketed(spark, planes), dest, per_file=50,
        strict=False, unique=True, bucketed=True, broadcast_bytes=0)
    return _record_sums(read_packed(spark, dest))


def _record_sums(records):
    values = decode_bytes(F.col("image"))
    total = F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)
    # Weighted by place, so that a pixel in the wrong place shows.
    weighted = F.aggregate(
        F.transform(values, lambda v, i: v.cast("long") * (i + 1)),
        F.lit(0).cast("long"), lambda a, v: a + v)
    return records.select(
        "layout", "dataset", "file", "pos", "well", "well_type", "experiment", "plate",
        "site", "cell_type", "sirna", "height", "width", "channels",
        total.alias("total"), weighted.alias("weighted"),
    )


def read_experiments(spark, sf):
    """Records of one experiment out of both layouts."""
    records = read_packed(spark, _packed_tree(spark, sf), experiments=["RPE-02"])
    values = decode_bytes(F.col("image"))
    return records.select(
        "layout", "dataset", "file", "pos", "experiment", "well",
        F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))


def stream_examples(spark, sf):
    records = stream_packed(spark, _packed_tree(spark, sf, ["random"]), layout="random-42")
    dest = scratch_path(spark, "examples")
    query = feed_examples(
        records, dest, scratch_path(spark, "feed-state"), PIXEL_STATS, drain=True)
    query.awaitTermination()
    out = spark.read.parquet(dest)
    values = F.transform(decode_floats(F.col("image")), lambda v: v.cast("double"))
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return out.select("well", "label", F.round(total, 4).alias("total"))


# --- feeding ----------------------------------------------------------------

def epoch_batches(spark, sf):
    keys = fixtures.logits(spark, sf).select("vec_id", "label")
    return feed.plan_batches(keys, batch=64, epochs=3, key_columns=["vec_id"])


def step_plan(spark, sf):
    return feed.step_plan(fixtures.logits(spark, sf), "label", batch=64, epochs=3)


def feed_batches(spark, sf):
    """Two epochs of the packed training records in batches of eight."""
    records = read_packed(
        spark, _packed_tree(spark, sf, ["random"]), layout="random-42", dataset="train")
    plan = feed.plan_batches(records.select("file", "pos"), batch=8, epochs=2)
    fed = feed.batch_examples(records, plan, stats=PIXEL_STATS, only_labelled=True)
    values = F.transform(decode_floats(F.col("image")), lambda v: v.cast("double"))
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return fed.select(
        "epoch", "batch_id", "batch_pos", "well", "label", F.round(total, 4).alias("total"))


def written_manifest(spark, sf):
    """What two packings of one folder with other file sizes leave there."""
    dest = scratch_path(spark, "packed")
    sites, planes = fixtures.plane_sites(spark, sf), fixtures.planes(spark, sf)
    pack_job(sites, planes, dest, per_file=7, strict=False)
    return pack_job(sites, planes, dest, per_file=50, strict=False)


# --- scoring ----------------------------------------------------------------

def predict_classes(spark, sf):
    scored = fixtures.logits(spark, sf)
    return scored.select("vec_id", predicted_class(F.col("logits")).alias("class"))


def softmax(spark, sf):
    scored = fixtures.logits(spark, sf)
    rows = scored.select("vec_id", F.posexplode(probabilities(F.col("logits"))).alias("class", "p"))
    return rows.select("vec_id", "class", F.round("p", 6).alias("p"))


def eval_metrics(spark, sf):
    out = scoring.evaluate(fixtures.logits(spark, sf))
    return out.select("n", *[
        F.round(c, 6).alias(c) for c in ("top_1_accuracy", "top_5_accuracy")])


def row_losses(spark, sf):
    loss = cross_entropy(F.col("logits"), F.col("label"))
    return fixtures.logits(spark, sf).select("vec_id", F.round(loss, 6).alias("loss"))


def mean_loss(spark, sf):
    out = scoring.mean_cross_entropy(fixtures.logits(spark, sf))
    return out.select("n", F.round("loss", 6).alias("loss"))


def _channel_means():
    def model(images):
        return np.asarray(images, np.float64).mean(axis=(1, 2)).astype(np.float32)

    return model


def score_sites(spark, sf):
    """Scoring with a model whose logits are the mean normalised pixels."""
    return _scored(_stacked(spark, sf))


def _scored(records):
    side = fixtures.SIDE
    scored = scoring.score(
        feed.normalise_examples(records, PIXEL_STATS), _channel_means,
        [side, side, len(CHANNELS)])
    best = F.array_max("logits").cast("double")
    return scoring.predict(scored).select("well", "class", F.round(best, 3).alias("best"))


def score_unlabelled(spark, sf):
    """The test split, whose sites have no label, from packed files."""
    records = read_packed(spark, _packed_tree(spark, sf, ["random"]), dataset="test")
    return _scored(records.where(F.col("sirna").isNull()))


QUERIES = {f.__name__: f for f in (
    combine_metadata, expand_sites, metadata_head, fix_labels, filter_sites,
    select_experiments, site_keys, packed_columns, labelled_examples,
    image_paths, parse_image_path, discover_splits, missing_images, complete_sites,
    pack_random, pack_by_group, pack_multi_seed, pack_manifest,
    stack_complete_sites, pixel_index, rgb_compose, normalize_pixels, unit_scale,
    pixel_stats,
    metadata_csv, strict_sites, write_arrays, convert_sites, assemble_arrays, read_window,
    read_experiments, file_summaries,
    load_sites, load_png_sites, load_png_rgb, scan_png_plates, stream_planes,
    pixel_percentiles, channel_first_images, rgb_images, normalize_images,
    pixel_stats_images, chunk_sites, pack_images, pack_bucketed, stream_examples,
    epoch_batches, step_plan, feed_batches, written_manifest,
    predict_classes, softmax, eval_metrics, row_losses, score_sites, score_unlabelled,
)}
QUERIES["cross_entropy"] = mean_loss
