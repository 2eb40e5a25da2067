"""Benchmark decontamination: windows of benchmark words found in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.text import let, plain_words, positions, whole
from platelake.session import cut_lineage

WINDOW = 10
# Windows are broadcast up to this many bytes; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
# What a window takes in memory besides its words.
ROW_BYTES = 200

# Characters of words and between words, before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def benchmark_windows(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", n: int = WINDOW
) -> DataFrame:
    """Distinct windows: hash, words, number of words, items they stand in.

    An item of fewer words is one shorter window; one without words has none.
    """
    words = benchmark.select(
        F.col(item_id).alias("item"), plain_words(whole(text)).alias("words"))
    windows = words.where(F.size("words") > 0).select("item", F.explode(let(
        F.col("words"), lambda w: F.transform(
            positions(F.greatest(F.size(w) - (n - 1), F.lit(1))),
            lambda i: F.slice(w, i + 1, n)))).alias("window"))
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("window").alias("hash"), F.array_join("window", " ").alias("gram"),
        F.size("window").alias("gram_len"), "items")


def _fits(windows: DataFrame, limit: int) -> tuple[bool, list[int]]:
    """Whether the windows may be broadcast, and the lengths they have: at
    most as many as a window has words."""
    per_length = windows.groupBy("gram_len").agg(F.sum(
        F.octet_length("gram") + F.lit(ROW_BYTES) + 16 * F.size("items")).alias("bytes")).collect()
    return sum(r["bytes"] for r in per_length) <= limit, sorted(r["gram_len"] for r in per_length)


def _windows_of(listed: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``start`` and ``len`` of every window of each length, a row each.

    Only whole numbers are listed, so the windows themselves are cut and
    hashed in generated code rather than in a lambda over the words.
    """
    ahead = start = F.lit(0)
    length = F.lit(lengths[0])
    for n in lengths:
        start = F.when(F.col("k") >= ahead, F.col("k") - ahead).otherwise(start)
        length = F.when(F.col("k") >= ahead, F.lit(n)).otherwise(length)
        ahead = ahead + F.greatest(F.size("words") - (n - 1), F.lit(0))
    numbered = listed.select("*", F.explode(positions(ahead)).alias("k"))
    return numbered.select(*listed.columns, start.alias("start"), length.alias("len"))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", benchmark_text: str = "text", n: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Documents with benchmark windows: ``id``, ``text_hash``, ``spans``
    (distinct start and length, in words, sorted) and ``items`` (distinct).

    Every window of every document is looked up by its hash; the few that
    are found are compared by their words. Documents without a hit have no
    row. Null ids and repeated rows are told by the text as well.
    """
    windows = cut_lineage(benchmark_windows(benchmark, item_id, benchmark_text, n), "windows")
    small, lengths = _fits(windows, broadcast_bytes)
    lengths = lengths or [n]
    listed = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"),
        plain_words(whole(text)).alias("words"))
    window = F.slice("words", F.col("start") + 1, F.col("len"))
    scanned = _windows_of(listed, lengths).withColumn("hash", F.xxhash64(window))
    own = F.array_join(window, " ")
    if not small:
        # A shuffled row holds its window, not all words of the text.
        scanned = scanned.select("id", "text_hash", "start", "len", "hash", own.alias("own"))
        own = F.col("own")
    found = scanned.join(F.broadcast(windows) if small else windows.hint("merge"), "hash")
    same = (F.col("len") == F.col("gram_len")) & (own == F.col("gram"))
    return (
        found.where(same).select("id", "text_hash", "start", "len", "items")
        .groupBy("id", "text_hash").agg(
            F.sort_array(F.collect_set(F.struct("start", "len"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    )


def hit_words(spans: Column) -> Column:
    """Words covered by sorted spans; each word counts once."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(acc: Column, span: Column) -> Column:
        end = span["start"] + span["len"]
        fresh = F.greatest(end - F.greatest(span["start"], acc["end"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(spans, state, cover, lambda acc: acc["n"])


def _covered(spans: Column) -> Column:
    """Places of the covered words, each once."""
    return F.array_distinct(F.flatten(F.transform(
        spans, lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))


def annotate(docs: DataFrame, benchmark: DataFrame, row: str = "row", **options) -> DataFrame:
    """Every input row as a struct, with ``n_words``, ``n_hit``, ``items`` and
    ``spans`` (both empty if clean). A null text has no words. Windows of
    benchmark rows without an ``item_id`` hit words like others, but are no
    item: they count in ``n_hit`` and ``spans`` and not in ``items``."""
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    hits = overlaps(docs, benchmark, **options)
    rows = docs.select(
        F.struct("*").alias(row), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"),
        F.size(plain_words(whole(text))).cast("long").alias("n_words"))
    same = rows["id"].eqNullSafe(hits["id"]) & (rows["text_hash"] == hits["text_hash"])
    spans = F.coalesce("spans", F.array().cast(hits.schema["spans"].dataType))
    items = F.coalesce("items", F.array().cast(hits.schema["items"].dataType))
    return rows.join(hits, same, "left").select(
        row, "n_words", hit_words(spans).alias("n_hit"), items.alias("items"), spans.alias("spans"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    hits = overlaps(docs, benchmark, **options)
    same = docs[doc_id].eqNullSafe(hits["id"]) & (F.xxhash64(docs[text]) == hits["text_hash"])
    return docs.join(hits, same, "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents, the words of benchmark windows cut out of the text
    together with the separators ahead of them."""
    text = options.get("text", "text")
    marked = annotate(docs, benchmark, **options)
    body = F.col("row")[text]
    # The i-th chunk holds the i-th word and the separators ahead of it; what
    # follows the last word is a chunk of its own.
    chunks = F.regexp_extract_all(body, F.lit(f"{SEPARATORS}*{WORD}+|{SEPARATORS}+"), F.lit(0))
    kept = let(chunks, lambda p: F.array_join(F.transform(
        F.array_except(positions(F.size(p)), _covered(F.col("spans"))), lambda i: F.get(p, i)), ""))
    return marked.select(*[
        (F.when(F.size("spans") == 0, body).otherwise(kept) if c == text else F.col("row")[c]).alias(c)
        for c in docs.columns])
