"""The operators over whole tables, one query each, with the columns that
other programs compare."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.llm import (
    bpe, decontaminate, licences, lines, manifest, negatives, pii, pitman_yor, quality, shards,
    simhash, urls, warc,
)
from platelake.llm.text import ascii_lower, whole
from platelake.session import cut_lineage, scratch_path


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_pitman_yor(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return pitman_yor.score_documents(docs).withColumnRenamed("id", "doc_id")


def op2_quality_rules(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    # Written once: policies and ablations read the bits.
    entries = cut_lineage(
        quality.ledger(docs).select("row.doc_id", *quality.MEASURES, "fail_bits"), "ledger")
    judged = quality.with_ablations(
        quality.apply_policies(entries), quality.POLICIES[quality.POLICY])
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id", *base, (~F.col("kept_base")).alias("base_failed"),
        F.col(f"kept_{quality.POLICY}").alias("kept"), "fail_bits", "only_rule", "kept_without")


def op3_licences(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = licences.scan_licences(docs).drop("spans")
    return found.withColumnRenamed("id", "doc_id")


def op4_simhash(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op5_personal_data(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs).drop("found").withColumnRenamed("id", "doc_id")


def op6_warc(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    read = warc.resolve(warc.read_archives(spark, path))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_line_dedup(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    cut = lines.drop_repeated_lines(docs)
    return cut.select(
        "row.doc_id", "n_lines", "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_byte_bpe(spark, sf):
    return bpe.round_trip(_table(spark, sf, "documents").select("doc_id", "text"))


def op9_url_filter(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url", "html")
    judged = urls.filter_urls(pages)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op10_decontamination(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.annotate(docs, _table(spark, sf, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op11_hard_negatives(spark, sf):
    rows = _table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_sharding(spark, sf):
    placed = shards.shuffle_into_shards(_table(spark, sf, "documents"))
    text = whole(F.col("row.text"))
    return placed.select(
        "row.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_manifest(spark, sf):
    docs = _table(spark, sf, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in columns]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    listed = manifest.manifest(
        docs, columns, carry={"tampered": F.when(chosen, manifest.leaf_hash(lowered))})
    folded = listed.withColumn("folded_root", manifest.fold(F.coalesce("tampered", "leaf")))
    proof = F.array_join(manifest.siblings(), "")
    return folded.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (
    op1_pitman_yor, op2_quality_rules, op3_licences, op4_simhash, op5_personal_data, op6_warc,
    op7_line_dedup, op8_byte_bpe, op9_url_filter, op10_decontamination, op11_hard_negatives,
    op12_sharding, op13_manifest,
)}
