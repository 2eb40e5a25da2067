"""SimHash near-duplicates: fingerprints compared by bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.components import components
from platelake.llm.text import pieces, whole
from platelake.session import cut_lineage

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BITS = 64
# Hashes that are turned into bits at once.
HASHES = 1 << 16
# Members of a bucket that one task compares with each other. Larger buckets
# are cut into tiles of this many, and each pair of tiles is a bucket.
TILE = 16_384


def _counts(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """How many shingle hashes have each bit set, and how many there are."""
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, max(len(words) - size + 1, 0))
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), HASHES):
        part = hashes[start:start + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts, len(hashes)


def fingerprint(data: bytes, size: int = SHINGLE) -> int:
    """SimHash of a text in UTF-8. Long texts are read piece by piece; each
    piece starts with the last words of the one before."""
    counts, n, tail, total = np.zeros(BITS, np.int64), 0, [], 0
    for piece in pieces(data):
        words = piece.lower().split()  # of bytes: ASCII letters and white space only
        total += len(words)
        words = tail + words
        more, m = _counts(words, size)
        counts, n, tail = counts + more, n + m, words[max(len(words) - size + 1, 0):]
    if 0 < total < size:
        counts, n = _counts([b" ".join(tail)], 1)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprint_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), size) for x in batch.column("data")]
            signed = np.array(found, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(signed)], names=["id", "fingerprint"])

    return run


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE
) -> DataFrame:
    """``id`` and ``fingerprint`` (64 bits in a signed long), a row per row."""
    kind = docs.schema[doc_id].dataType.simpleString()
    listed = docs.select(F.col(doc_id).alias("id"), whole(text).cast("binary").alias("data"))
    return listed.mapInArrow(_fingerprint_batches(size), f"id {kind}, fingerprint long")


def _blocks(max_bits: int) -> list[int]:
    """Masks of the keys. The bits are cut into blocks; fingerprints that
    differ in few bits agree on all blocks but as many. With three blocks more
    than differing bits a key holds three fifths of all bits for two."""
    n = max_bits + 3
    edges = [BITS * i // n for i in range(n + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(m) for m in combinations(masks, n - max_bits)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _near(planes: list[int], query: int, bits: list[int], max_bits: int, everyone: int) -> int:
    """Members within the radius of a query, as a set of bits.

    ``planes[b]`` has a bit per member. Counters of all members are kept as
    planes too and take each differing plane by carry-save addition; whoever
    passes the radius is struck out, and an empty set ends the comparison.
    """
    width = (max_bits + 1).bit_length()
    counters = [0] * width
    alive = everyone
    limit = max_bits + 1
    for b in bits:
        carry = planes[b] ^ everyone if query >> b & 1 else planes[b]
        carry &= alive
        for i in range(width):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over = alive
        for i in range(width):
            over &= counters[i] if limit >> i & 1 else ~counters[i]
        alive &= ~over
        if not alive:
            break
    return alive


def link_bucket(members: np.ndarray, bits: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Edges that join all members (distinct, unsigned) linked inside a bucket.

    Only a spanning forest is returned: members met once are not asked again,
    and each is tied to the one that found it.
    """
    m = len(members)
    if m == 2:
        near = bin(int(members[0]) ^ int(members[1])).count("1") <= max_bits
        return [(int(members[0]), int(members[1]))] if near else []
    everyone = (1 << m) - 1
    planes = [0] * BITS
    for b in bits:
        column = ((members >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        planes[b] = int.from_bytes(np.packbits(column, bitorder="little").tobytes(), "little")
    waiting, edges = everyone, []
    values = members.tolist()
    while waiting:
        root = (waiting & -waiting).bit_length() - 1
        waiting &= waiting - 1
        queue = [root]
        while queue and waiting:
            q = queue.pop()
            # Only members that nobody has reached yet are compared.
            found = _near(planes, values[q], bits, max_bits, waiting)
            waiting &= ~found
            while found:
                i = (found & -found).bit_length() - 1
                found &= found - 1
                edges.append((values[q], values[i]))
                queue.append(i)
    return edges


def _link_batches(masks: list[int], max_bits: int):
    outside = [[b for b in range(BITS) if not mask >> b & 1] for mask in masks]

    def links(key: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(key)]
        out = []
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e - s > 1:
                out += link_bucket(np.unique(fps[s:e]), outside[int(key[s, 0])], max_bits)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty((0, 4), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            names = ("which", "block", "tile_a", "tile_b")
            got = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], 1)
            keys = np.concatenate([keys, got.astype(np.int64)])
            fps = np.concatenate([fps, batch.column("fingerprint").to_numpy().astype(np.uint64)])
            # The last bucket may go on in the next batch.
            last = int(np.flatnonzero(np.any(keys != keys[-1], axis=1))[-1]) + 1 if np.any(
                keys != keys[-1]) else 0
            if last:
                yield _edges(links(keys[:last], fps[:last]))
                keys, fps = keys[last:], fps[last:]
        if len(keys):
            yield _edges(links(keys, fps))

    return run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    found = np.array(pairs, np.uint64).reshape(-1, 2).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def links(prints: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints within ``max_bits``.

    They join whatever is linked, without listing every pair. Candidates meet
    in buckets of a key that linked fingerprints must share for some choice of
    blocks, so none is missed. A bucket with more members than a tile becomes
    one bucket per pair of tiles: exact, and no task holds more than two.
    """
    masks = _blocks(max_bits)
    keys = F.array(*[
        F.struct(F.lit(i).alias("which"),
                 F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("block"))
        for i, m in enumerate(masks)])
    keyed = prints.select("fingerprint", F.inline(keys))
    sizes = keyed.groupBy("which", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Buckets of one member are most of all and go no further.
    met = keyed.join(sizes, ["which", "block"])
    tiles = F.expr(f"cast((n + {tile} - 1) div {tile} as int)")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).cast("int")
    placed = met.withColumn("tiles", tiles).withColumn("own", own)
    pairs = placed.select(
        "which", "block", "fingerprint", "own",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"),
    ).select(
        "which", "block", "fingerprint",
        F.least("own", "other").alias("tile_a"), F.greatest("own", "other").alias("tile_b"))
    order = ["which", "block", "tile_a", "tile_b"]
    return (
        pairs.repartition(*order).sortWithinPartitions(*order)
        .select(*order, "fingerprint")
        .mapInArrow(_link_batches(masks, max_bits), "a long, b long")
    )


def hex_fingerprint(column: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``id``, ``fingerprint`` and ``component_id``, a row per row of ``docs``.

    The component is the smallest id that links lead to, its own included.
    Null and empty texts have fingerprint zero and link like any other; rows
    without an id take part in links and are never the smallest, so a
    component of such rows alone is null. Copies of a fingerprint are one node
    of the graph, so a group of copies costs one row.
    """
    prints = cut_lineage(fingerprints(docs, doc_id, text, size), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("id").alias("first_id"))
    nodes = cut_lineage(nodes, "nodes")
    found = components(links(nodes.select("fingerprint"), max_bits))
    rooted = nodes.join(
        found, nodes["fingerprint"] == found["node"], "left"
    ).select("fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    lookup = rooted.join(named, "root").select("fingerprint", "component_id")
    return prints.join(lookup, "fingerprint").select("id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group: the one with the smallest id. Rows without
    an id stay only if their group has no document with one. Rows that repeat
    the kept id are the same document and stay together."""
    groups = near_duplicates(docs, doc_id, text, **options)
    named = groups.where(F.col("component_id") == F.col("id")).select("id").distinct()
    kept = docs.join(named, docs[doc_id] == named["id"], "left_semi")
    nameless = docs.where(F.col(doc_id).isNull()).select(
        F.struct("*").alias("row"), F.col(text).alias("data"))
    if nameless.isEmpty():
        return kept
    lone = groups.where(F.col("component_id").isNull()).select("fingerprint").distinct()
    prints = fingerprints(nameless, "row", "data", options.get("size", SHINGLE))
    return kept.unionByName(prints.join(lone, "fingerprint", "left_semi").select("id.*"))
