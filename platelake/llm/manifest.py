"""Merkle manifest of a table: a hash per row, runs of hashes hashed together
up to one root, and for every row the proof that leads there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.session import cut_lineage

# Nodes of a run that share a parent.
FANOUT = 8
DIGIT_BITS = 3

# Levels that one row nests: a block holds at most 512 nodes.
LEVELS = 3

NONE = "-"


def encoded(column: Column) -> Column:
    """``-`` for null, else the bytes of the value's text, a colon, the text."""
    text = column.cast("string")
    return F.when(text.isNull(), NONE).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Hash of a row, its values in the order given."""
    return _hash(F.concat(*[encoded(c) for c in columns]))


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _group_key(group: Column) -> Column:
    """A text that sorts as the group does, null first, and is never null."""
    text = group.cast("string")
    return F.when(text.isNull(), NONE).otherwise(F.concat(F.lit("="), text))


def rank_nodes(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``rank`` (from 0) and ``n`` of each node in its group ``g``.

    Nodes are range-partitioned and sorted where they are; the few (partition,
    group) pairs get their start from a running sum. No task sees a whole group.
    Nodes that are alike in every column are spread by the task they came from.
    """
    wide = nodes.withColumn("_from", F.spark_partition_id())
    placed = wide.repartitionByRange("g", *order, "hash", "_from").sortWithinPartitions(
        "g", *order, "hash")
    # As a table, so that ranges and places stay what they are in later steps.
    table = cut_lineage(placed.drop("_from").withColumns({
        "_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranked")
    runs = table.groupBy("g", "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    per_group = Window.partitionBy("g")
    ahead = per_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "g", "_part", "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"),
        F.sum("_n").over(per_group).alias("n"))
    return table.join(starts, ["g", "_part"]).withColumn(
        "rank", F.col("_start") + F.col("_at") - F.col("_first")
    ).drop("_part", "_at", "_first", "_start")


def _above(n: Column, levels: int) -> Column:
    """Nodes that remain of ``n`` after so many levels."""
    return F.shiftright(n + F.lit((1 << DIGIT_BITS * levels) - 1), DIGIT_BITS * levels)


def nest(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per block of ``FANOUT ** levels`` consecutive nodes.

    The digits of the rank are grouped away one after another, lowest first:
    each step turns a run into a struct of its hash and its children. Blocks
    are dealt out once; the steps find their rows together. A level at which
    a single node remains in its group passes it on unhashed.
    """
    digits = [f"d{level}" for level in range(levels)]
    body = F.struct(*[c for c in nodes.columns if c not in ("g", "rank", "n")])
    rows = nodes.select(
        "g", "n", F.shiftright("rank", DIGIT_BITS * levels).alias("block"), body.alias("node"),
        *[F.shiftright("rank", DIGIT_BITS * level).bitwiseAND(F.lit(FANOUT - 1)).cast("int").alias(d)
          for level, d in enumerate(digits)],
    ).repartition("g", "block")
    for level, digit in enumerate(digits):
        run = F.array_sort(F.collect_list(F.struct(digit, "node")))
        rows = (
            rows.groupBy("g", "block", "n", *digits[level + 1:])
            .agg(F.transform(run, lambda c: c["node"]).alias("children"))
            .withColumn("hashed", _above(F.col("n"), level) > 1)
        )
        joined = _hash(F.array_join(F.transform("children", lambda c: c["hash"]), ""))
        node = F.struct(
            F.when(F.col("hashed"), joined).otherwise(F.col("children")[0]["hash"]).alias("hash"),
            "hashed", "children")
        rows = rows.withColumn("node", node).drop("children", "hashed")
    return rows


def open_blocks(blocks: DataFrame, keep: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """The nodes of the blocks again, each with ``rank`` and its ``proof`` put
    ahead of that of its block: what stood left and right of it at each level."""
    rows = blocks.select(*keep, "proof", "node", F.col("block").alias("rank"))
    for _ in range(levels):
        rows = rows.select(
            *keep, "proof", "rank", F.col("node.hashed").alias("hashed"),
            F.transform("node.children", lambda c: c["hash"]).alias("run"),
            F.posexplode("node.children").alias("pos", "node"))
        step = F.struct(
            F.slice("run", F.lit(1), F.col("pos")).alias("left"),
            F.slice("run", F.col("pos") + 2, F.lit(FANOUT)).alias("right"))
        proof = F.when(F.col("hashed"), F.concat(F.array(step), F.col("proof")))
        rows = rows.select(
            *keep, F.coalesce(proof, F.col("proof")).alias("proof"), "node",
            (F.col("rank") * FANOUT + F.col("pos")).alias("rank"))
    return rows


def _meet(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks and the paths above them, by ``g`` and ``block``. Each has one row
    per key, so a grouped union brings them together without a join."""
    path = F.struct(*[c for c in paths.columns if c not in ("g", "block")])
    both = blocks.select("g", "block", "node").unionByName(
        paths.select("g", "block", path.alias("path")), allowMissingColumns=True)
    met = both.groupBy("g", "block").agg(
        F.collect_list("node")[0].alias("node"), F.collect_list("path")[0].alias("path"))
    return met.select("g", "block", "node", "path.*")


def _build(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tables of nested blocks, from the nodes up to one block per group."""
    tables = []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        table = cut_lineage(nest(nodes, levels), "manifest")
        tables.append(table)
        largest = (largest + FANOUT ** levels - 1) // FANOUT ** levels
        if largest <= 1:
            return tables
        nodes = table.select(
            "g", F.col("block").alias("rank"), _above(F.col("n"), levels).alias("n"),
            F.col("node.hash").alias("hash"))


def _descend(tables: list[DataFrame], paths: DataFrame, keep: Sequence[str], levels: int) -> DataFrame:
    """From the path of each group's last block down to its nodes."""
    for table in reversed(tables[1:]):
        opened = open_blocks(_meet(table, paths), ["g", *keep], levels)
        paths = opened.select("g", F.col("rank").alias("block"), *keep, "proof")
    return open_blocks(_meet(tables[0], paths), ["g", *keep], levels)


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    carry: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row ``id`` (the order column), ``group``, ``leaf``, ``subroot`` of its
    group, ``root``, ``proof`` and the columns of ``carry``, which should be small.

    Leaves of a group ascend by the order column, null first, and rows that
    tie by their leaf; repeated rows are leaves of their own. Runs of eight
    become the hash of their hashes until one remains, the subroot; subroots in
    the order of their group, null first, become the root alike. A table of one
    row has its leaf as root; an empty one has no rows. ``proof`` has an entry
    per hashed level, from the leaf up: the hashes ``left`` and ``right`` of it.

    Only hashes are shuffled. A row of a nested table holds 512 hashes at
    most, however large a group is, and every further table is 512 times
    smaller. The path above a block meets it in a grouped union.
    """
    carry = carry or {}
    leaves = docs.select(
        _group_key(F.col(group)).alias("g"), F.col(order).alias("id"), F.col(group).alias("group"),
        leaf_hash([F.col(c) for c in columns]).alias("hash"),
        F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in carry.items()]).alias("carry"))
    # Texts are hashed once; ranging the rows would read them twice.
    ranked = rank_nodes(cut_lineage(leaves, "leaves"), ["id"])
    tables = _build(ranked, levels)
    none = F.array().cast("array<struct<left:array<string>,right:array<string>>>")

    subroots = tables[-1].select(F.lit("").alias("g"), F.col("g").alias("of"),
                                 F.col("node.hash").alias("hash"))
    top = _build(rank_nodes(subroots, ["of"]), levels)
    start = top[-1].select("g", "block", F.col("node.hash").alias("root"), none.alias("proof"))
    groups = _descend(top, start, ["root"], levels)
    paths = groups.select(
        F.col("node.of").alias("g"), F.lit(0).cast("long").alias("block"), "root",
        F.col("node.hash").alias("subroot"), "proof")
    opened = _descend(tables, paths, ["root", "subroot"], levels)
    return opened.select(
        "node.id", "node.group", F.col("node.hash").alias("leaf"), "subroot", "root", "proof",
        *[F.col("node.carry")[name].alias(name) for name in carry])


def siblings(proof: Column | str = "proof") -> Column:
    """All hashes of a proof, level by level, left to right."""
    return F.flatten(F.transform(proof, lambda p: F.concat(p["left"], p["right"])))


def fold(leaf: Column, proof: Column | str = "proof") -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, p: _hash(F.concat(
        F.array_join(p["left"], ""), h, F.array_join(p["right"], ""))))
