"""Line deduplication: lines that stand in several documents are left in one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.text import SPACES, ascii_lower, let, positions, whole
from platelake.session import cut_lineage

MIN_CHARS = 10
MIN_DOCUMENTS = 2


def _split(text: str) -> Column:
    return F.split(whole(text), "\n")


def keyed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """``id``, ``text_hash``, ``pos`` and the 128-bit hash of each line's key.

    The key is the line without white space at its ends, A-Z lower-cased.
    Lines with shorter keys are not listed.
    """
    key = ascii_lower(F.btrim(F.col("line"), F.lit(SPACES)))
    return (
        docs.where(F.col(doc_id).isNotNull())
        .select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"),
                F.posexplode(_split(text)).alias("pos", "line"))
        .select("id", "text_hash", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"),
                F.xxhash64(F.lit("second"), F.col("key")).alias("h2"))
    )


def repeated_keys(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Hashes found in at least that many documents, with the smallest id.

    Two documents are told by the smallest and largest id, which Spark
    combines before the shuffle: a line that stands everywhere costs one row
    per input task. Higher thresholds count distinct ids, in two steps that
    spread a hot hash over its ids first.
    """
    found = [F.min("id").alias("first_id"), F.max("id").alias("last_id")]
    if min_documents <= 2:
        many = F.col("last_id") > F.col("first_id") if min_documents == 2 else F.lit(True)
        return lines.groupBy("h1", "h2").agg(*found).where(many).drop("last_id")
    per_document = lines.groupBy("h1", "h2", "id").agg(F.lit(1).cast("long").alias("one"))
    return (
        per_document.groupBy("h1", "h2")
        .agg(F.min("id").alias("first_id"), F.sum("one").alias("n"))
        .where(F.col("n") >= min_documents).drop("n")
    )


def drop_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    row: str = "row",
) -> DataFrame:
    """The input row as a struct, ``n_lines``, ``n_dropped`` and ``kept``.

    A key found in ``min_documents`` documents loses its lines everywhere but
    in the document with the smallest id. A null text is one empty line.
    Documents without an id neither count nor lose lines. Rows that repeat an
    id are one document: they count once, and each is cut by its own lines.
    The lines of one document are gathered, never those of a key. A hot key is
    joined, not grouped, so adaptive execution can split it.
    """
    lines = keyed_lines(docs, doc_id, text, min_chars)
    # As a table of its own the keys are shuffled (or broadcast) on their own,
    # and adaptive execution can split the lines of a hot key.
    keys = cut_lineage(repeated_keys(lines, min_documents), "repeated-lines")
    drops = (
        lines.join(keys, ["h1", "h2"])
        .where(F.col("id") > F.col("first_id"))
        .groupBy("id", "text_hash").agg(F.collect_set("pos").alias("drops"))
    )
    packed = docs.select(
        F.struct("*").alias(row), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"))
    joined = packed.join(drops.hint("shuffle_hash"), ["id", "text_hash"], "left")
    body = whole(F.col(row)[text])
    left = let(F.split(body, "\n"), lambda parts: F.array_join(F.transform(
        F.array_except(positions(F.size(parts)), F.col("drops")),
        lambda i: F.get(parts, i)), "\n"))
    return joined.select(
        row,
        F.size(F.split(body, "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), body).otherwise(left).alias("kept"),
    )
