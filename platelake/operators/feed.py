"""Order in which examples are fed: epochs and batches.

Orders are planned on keys; pixels are joined to the plan by key, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from platelake.functions.tensors import normalised, unit_scaled
from platelake.operators.numbering import distinct_copies, number_by_key, order_key
from platelake.schemas import BATCH_SIZE, CHANNELS, SEED
from platelake.session import cut_lineage

EPOCH_DIGITS = 3
# Batches of pixels one task holds.
BATCHES_PER_TASK = 4


def labelled(examples: DataFrame, dropped: Observation | str | None = None) -> DataFrame:
    """Examples with a label. ``dropped`` receives the count of the others
    (``n_unlabelled``) while the query runs, without another pass; give a
    name rather than an Observation for a stream."""
    if dropped is not None:
        examples = examples.observe(
            dropped, F.count(F.when(F.col("sirna").isNull(), 1)).alias("n_unlabelled")
        )
    return examples.where(F.col("sirna").isNotNull())


def normalise_examples(
    packed: DataFrame, stats=None, channels: Sequence[int] = CHANNELS, layout: str = "HWC",
    unit: bool = True, only_labelled: bool = False, dropped: Observation | str | None = None,
) -> DataFrame:
    """Records with float32 pixels: standardised if ``stats`` are given, else
    scaled to 0..1, or left as they are if ``unit`` is off.

    All records stay, those to be predicted with a null ``label`` or none at
    all; ``only_labelled`` leaves the unlabelled out and ``dropped`` counts them.
    """
    pixels = image = F.col("image")
    if stats is not None:
        pixels = normalised(image, channels, stats, layout)
    elif unit:
        pixels = unit_scaled(image)
    if only_labelled:
        packed = labelled(packed, dropped)
    return packed.withColumn("image", pixels).withColumnRenamed("sirna", "label")


def batch_examples(
    packed: DataFrame, plan: DataFrame, keys: Sequence[str] = ("file", "pos"),
    batches_per_task: int = BATCHES_PER_TASK, **normalising,
) -> DataFrame:
    """Normalised examples in the order of a plan_batches plan.

    A task holds ``batches_per_task`` batches one after another, sorted by
    ``batch_id`` and ``batch_pos``. The plan, keys only, is written once; Spark
    broadcasts it if it is small, and then pixels move once per epoch, straight
    to the task of their batch. ``keys`` must name one record each.
    """
    plan = cut_lineage(plan, "batches")
    last = plan.agg(F.max("batch_id")).first()[0]
    tasks = (last or 0) // batches_per_task + 1
    placed = packed.join(plan, list(keys)).withColumn(
        "_task", F.expr(f"cast(batch_id div {batches_per_task} as int)"))
    ordered = placed.repartitionById(tasks, F.col("_task")).sortWithinPartitions(
        "batch_id", "batch_pos")
    return normalise_examples(ordered, **normalising).drop("_task")


def plan_batches(
    keys: DataFrame,
    batch: int = BATCH_SIZE,
    epochs: int = 1,
    seed: int = SEED,
    key_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffled epochs cut into full batches.

    Batches run across epoch ends. The feed stops after N div batch * epochs
    of them. Rows carry the batch they belong to; batches are not gathered.
    """
    if batch < 1 or epochs < 1:
        raise ValueError("batch and epochs must be positive")
    key_columns = list(key_columns or keys.columns)
    ties = [*key_columns, "copy", *[c for c in keys.columns if c not in key_columns]]
    rows = (
        distinct_copies(keys)
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
        .withColumn("_key", order_key(
            F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string")),
            [*key_columns, "copy"],
        ))
    )
    numbered = number_by_key(
        rows, ["epoch"], "_key", ties, EPOCH_DIGITS, "_pos", "_total", group_limit=epochs
    )
    return (
        numbered
        .withColumn("rn", (F.col("epoch") - 1) * F.col("_total") + F.col("_pos"))
        .withColumn("batch_id", F.expr(f"(rn - 1) div {batch}"))
        .where(F.col("batch_id") < F.expr(f"(_total div {batch}) * {epochs}"))
        .withColumn("batch_pos", F.expr(f"(rn - 1) % {batch}"))
        .drop("_key", "_pos", "_total", "copy")
    )


def step_plan(
    examples: DataFrame, label: str, batch: int = BATCH_SIZE, epochs: int = 1
) -> DataFrame:
    """Training steps that follow from the number of examples."""
    counted = examples.agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.count_distinct(label).alias("n_classes"),
    )
    steps = F.expr(f"n_examples div {batch}")
    return counted.select(
        "n_examples", "n_classes", steps.alias("steps_per_epoch"),
        (steps * epochs).alias("train_steps"),
    )
