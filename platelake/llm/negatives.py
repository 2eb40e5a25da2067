"""Hard negatives: rows of another label whose score with an anchor lies in a
band below that of a positive.

Vectors are rotated and kept as one-bit codes together with how well code and
vector align. The bits give an estimate of a score, what a code leaves over
bounds its error, and only pairs whose interval reaches a list are scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.session import cut_lineage

POSITIVES = 5
NEGATIVES = 10
# Least and largest hundredths of the positive's score, the positive's side
# and the negative's: LOW * positive <= UNIT * negative <= HIGH * positive.
LOW, UNIT, HIGH = 30, 100, 90

# Whole-number scale of a component.
SCALE = 256

# Codes per vector. Each further one codes what those before left over.
CODES = 4
# Bit planes of an anchor's rotated components.
PLANES = 6
SEED = 42

# Rows and anchors that meet at once.
BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 2048
BLOCK_ANCHORS = 256

# Anchors of one job: what is broadcast at once.
BROADCAST_BYTES = 32 << 20

# Sums of whole numbers up to here are exact in doubles, and in longs.
EXACT = 1 << 53
LONG = 1 << 62

# Pairs scored one by one; beyond this share of a block all of it is.
SLICE = 1 << 14
DENSE = 0.15
# Below this share of a block its pairs are followed one by one.
GATHER = 0.15

_NO_SCORE = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max


def taking_part(rows: DataFrame, vec_id: str, label: str, vector: str) -> DataFrame:
    """``id``, ``label`` and the whole-number ``vector`` of rows without nulls
    and with finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    return rows.where(
        F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~bad
    ).select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
             whole.alias("vector"))


# --- codes -------------------------------------------------------------------

def rotations(width: int, codes: int = CODES, seed: int = SEED) -> list[np.ndarray]:
    """Orthogonal matrices, the same in every task."""
    rng = np.random.default_rng(seed)
    return [np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(codes)]


@dataclass
class Codes:
    """Per vector and code: sign bits in words of 64, the length of the vector
    along its code (the alignment), and the length that is left over."""
    bits: np.ndarray      # (codes, rows, words) uint64
    along: np.ndarray     # (codes, rows)
    left: np.ndarray      # (codes, rows)


def _packed(signs: np.ndarray) -> np.ndarray:
    packed = np.packbits(signs, axis=-1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")


def encode(vectors: np.ndarray, turns: list[np.ndarray]) -> Codes:
    rest = vectors.astype(np.float64)
    width = rest.shape[1]
    bits, along, left = [], [], []
    for turn in turns:
        turned = rest @ turn
        signs = turned >= 0
        length = np.abs(turned).sum(axis=1) / np.sqrt(width)
        code = np.where(signs, 1.0, -1.0) / np.sqrt(width)
        rest = rest - (length[:, None] * code) @ turn.T
        bits.append(_packed(signs))
        along.append(length)
        left.append(np.sqrt((rest * rest).sum(axis=1)))
    return Codes(np.array(bits), np.array(along), np.array(left))


@dataclass
class Turned:
    """Anchors under each rotation: bit planes of their components on a grid,
    the grid, its greatest effect on a product with a code, and lengths."""
    planes: np.ndarray    # (codes, planes, anchors, words) uint64
    start: np.ndarray     # (codes, anchors)
    step: np.ndarray
    total: np.ndarray     # sum of the components as on the grid
    off: np.ndarray
    length: np.ndarray    # (anchors,)


def turn_anchors(vectors: np.ndarray, turns: list[np.ndarray], planes: int = PLANES) -> Turned:
    vectors = vectors.astype(np.float64)
    width = vectors.shape[1]
    out = [[] for _ in range(5)]
    for turn in turns:
        turned = vectors @ turn
        start = turned.min(axis=1)
        step = (turned.max(axis=1) - start) / ((1 << planes) - 1)
        step = np.where(step > 0, step, 1.0)
        grid = np.rint((turned - start[:, None]) / step[:, None])
        on_grid = start[:, None] + grid * step[:, None]
        levels = grid.astype(np.int64)
        for kept, value in zip(out, (
                np.stack([_packed((levels >> p & 1).astype(bool)) for p in range(planes)]),
                start, step, on_grid.sum(axis=1),
                np.abs(turned - on_grid).sum(axis=1) / np.sqrt(width)), strict=True):
            kept.append(value)
    return Turned(*map(np.array, out), np.sqrt((vectors * vectors).sum(axis=1)))


def _along_code(t: Turned, k: int, a, bits: np.ndarray, width: int) -> np.ndarray:
    """Products of gridded anchors with unit codes, from the counts of common
    bits: the sum over set bits counts twice, less the sum over all."""
    ones, counts = 0, 0
    for word in range(bits.shape[-1]):
        own = bits[..., word]
        ones = ones + np.bitwise_count(own).astype(np.int32)
        for p in range(t.planes.shape[1]):
            both = np.bitwise_count(own & t.planes[k, p][a][..., word]).astype(np.int32)
            both <<= p
            counts = counts + both
    on = counts * t.step[k][a]
    on += ones * t.start[k][a]
    on *= 2
    on -= t.total[k][a]
    on /= np.sqrt(width)
    return on


@dataclass
class Estimate:
    """Scores of anchors ``a`` with vectors ``x`` (indices that broadcast
    together) as far as some codes tell them."""
    a: np.ndarray
    x: np.ndarray
    middle: np.ndarray | float = 0.0
    slack: np.ndarray | float = 0.0
    upto: int = 0

    def add(self, codes: Codes, t: Turned, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Takes one more code and returns the bounds of the scores.

        A vector is its codes, each times its alignment, and a rest at right
        angles to the last code. By Cauchy and Schwarz the rest adds at most its
        length times that of the anchor's part at right angles to that code.
        """
        k, a, x = self.upto, self.a, self.x
        product = _along_code(t, k, a, codes.bits[k][x], width)
        off, length, along = t.off[k][a], t.length[a], codes.along[k][x]
        # Rounding of the doubles themselves is allowed for at each code.
        self.slack = self.slack + along * (off + 1e-9 * length) + 1e-6
        least = np.abs(product)
        least -= off
        np.maximum(least, 0.0, out=least)
        least *= least
        np.subtract(length * length, least, out=least)
        np.maximum(least, 0.0, out=least)
        rest = np.sqrt(least, out=least)
        rest *= codes.left[k][x]
        rest += self.slack + 1e-9 * length * codes.left[k][x]
        product *= along
        product += self.middle
        self.middle, self.upto = product, k + 1
        return product - rest, product + rest

    def only(self, near: np.ndarray) -> Estimate:
        """The pairs of a mask, as lists of indices."""
        a, x = np.broadcast_arrays(self.a, self.x)
        slack = np.broadcast_to(self.slack, near.shape)
        return Estimate(a[near], x[near], self.middle[near], slack[near], self.upto)


# --- lists -------------------------------------------------------------------

class Best:
    """The first ``size`` (score, id) of each list, higher scores first, then
    smaller ids."""

    def __init__(self, lists: int, size: int):
        self.score = np.full((lists, size), _NO_SCORE)
        self.id = np.full((lists, size), _NO_ID)

    def least(self) -> np.ndarray:
        """A score below this enters the list no more."""
        return self.score[:, -1]

    def add(self, which: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        size = self.score.shape[1]
        # A tie with the last place can still enter by its id.
        worth = score >= self.score[which, -1]
        which, score, ids = which[worth], score[worth], ids[worth]
        if not len(which):
            return
        order = np.lexsort((ids, -score, which))
        which, score, ids = which[order], score[order], ids[order]
        lists, first = np.unique(which, return_index=True)
        place = np.arange(len(which)) - np.repeat(first, np.diff(np.append(first, len(which))))
        near = place < size
        fresh = np.searchsorted(lists, which[near])
        both = [np.concatenate([old[lists], np.full((len(lists), size), none)], axis=1)
                for old, none in ((self.score, _NO_SCORE), (self.id, _NO_ID))]
        both[0][fresh, size + place[near]] = score[near]
        both[1][fresh, size + place[near]] = ids[near]
        # Lists without a score sort last: their id is the largest.
        keep = np.lexsort((both[1], -np.maximum(both[0], _NO_SCORE + 1)), axis=-1)[:, :size]
        self.score[lists] = np.take_along_axis(both[0], keep, axis=1)
        self.id[lists] = np.take_along_axis(both[1], keep, axis=1)


def _scores(anchors: np.ndarray, vectors: np.ndarray, a: np.ndarray, x: np.ndarray,
            exact_type) -> np.ndarray:
    """Whole-number scores of the pairs."""
    if len(a) > DENSE * len(anchors) * len(vectors):
        return (anchors.astype(exact_type) @ vectors.T.astype(exact_type))[a, x].astype(np.int64)
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), SLICE):
        cut = slice(i, i + SLICE)
        out[cut] = np.einsum(
            "ij,ij->i", anchors[a[cut]].astype(exact_type), vectors[x[cut]].astype(exact_type))
    return out


def _reaching(codes: Codes, t: Turned, width: int, wanted: np.ndarray, low: np.ndarray,
              high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs among ``wanted`` (anchors x rows) whose interval meets what their
    anchor still takes, from ``low`` to ``high``. One code after another."""
    # Without a limit on either side nothing can be left out.
    open_ = (low == -np.inf) & (high == np.inf)
    a_open, x_open = np.nonzero(wanted & open_[:, None])
    some = np.nonzero(~open_ & (low <= high))[0]
    if not len(some):
        return a_open, x_open
    found = Estimate(some[:, None], np.arange(wanted.shape[1])[None, :])
    near = wanted[some]
    while found.upto < len(codes.bits):
        lower, upper = found.add(codes, t, width)
        near &= (upper >= low[found.a]) & (lower <= high[found.a])
        # While many pairs are left, whole blocks are quicker than lists.
        if near.ndim == 1 or np.count_nonzero(near) < GATHER * near.size:
            found = found.only(near)
            near = np.ones(len(found.a), bool)
    if near.ndim > 1:
        found = found.only(near)
    return np.concatenate([a_open, found.a]), np.concatenate([x_open, found.x])


# --- blocks ------------------------------------------------------------------

_BLOCK = ("id binary, label binary, vector binary, bits binary, along binary, left_over binary, "
          "n int")


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, shorter ones filled with zeros."""
    out = np.zeros((len(values), width), np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(values.offsets.to_numpy()) if len(values) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(values)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = flat
    return out


def _encoder(width: int, store: str) -> Callable:
    rows = int(min(BLOCK_ROWS, max(64, BLOCK_BYTES // (8 * width))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = rotations(width)
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                cut = batch.slice(i, rows)
                vectors = _matrix(cut.column("vector"), width)
                c = encode(vectors, turns)
                columns = [np.asarray(cut.column("id")), np.asarray(cut.column("label")),
                           vectors.astype(store), c.bits, c.along, c.left]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in columns),
                     pa.array([cut.num_rows], pa.int32())],
                    names=[f.split()[0] for f in _BLOCK.split(", ")])

    return run


def _blocks(batches: Iterator[pa.RecordBatch], width: int, store: str):
    """(anchors of a block as an Arrow list, its number, ids, labels, vectors, codes)"""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            n = row["n"].as_py()

            def read(name, kind, *shape):
                return np.frombuffer(row[name].as_buffer(), kind).reshape(shape)

            codes = Codes(read("bits", "<u8", CODES, n, width // 64),
                          read("along", "<f8", CODES, n), read("left_over", "<f8", CODES, n))
            yield (row["anchors"].values, row["block"].as_py(), read("id", "<i8", n),
                   read("label", "<i8", n), read("vector", store, n, width), codes)


_FOUND = "anchor_id long, place int, score long, id long"


def _found(anchor_ids: np.ndarray, places: np.ndarray, best: Best) -> pa.RecordBatch:
    which, at = np.nonzero(best.score > _NO_SCORE)
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor_ids[which], pa.int64()), pa.array(places[which], pa.int32()),
         pa.array(best.score[which, at], pa.int64()), pa.array(best.id[which, at], pa.int64())],
        names=["anchor_id", "place", "score", "id"])


def _searcher(width: int, store: str, exact: str, size: int, banded: bool) -> Callable:
    """Per task and anchor the best rows of its label, or per positive the best
    ones of other labels in the band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, states = rotations(width), {}
        for packed, number, ids, labels, vectors, codes in _blocks(batches, width, store):
            if number not in states:
                own = _matrix(packed.field("vector"), width)
                anchor_ids = np.asarray(packed.field("id"))
                if banded:
                    lists = packed.field("positives")
                    counts = np.diff(lists.offsets.to_numpy())
                    score = np.asarray(lists.flatten())
                    of = np.repeat(np.arange(len(counts)), counts)
                    place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                    low, high = -(-LOW * score // UNIT), HIGH * score // UNIT
                else:
                    of = np.arange(len(anchor_ids))
                    place = np.zeros(len(of), np.int64)
                    low, high = None, None
                states[number] = (own, anchor_ids, np.asarray(packed.field("label")),
                                  turn_anchors(own, turns), of, place, low, high,
                                  Best(len(of), size))
            own, anchor_ids, own_labels, turned, of, place, low, high, best = states[number]
            same = own_labels[:, None] == labels[None, :]
            wanted = ~same if banded else same & (anchor_ids[:, None] != ids[None, :])
            least = best.least().astype(np.float64)
            least[best.least() == _NO_SCORE] = -np.inf
            if banded:
                # What any list of the anchor still takes.
                takes = np.maximum(low, least)
                takes[takes > high] = np.inf
                down = np.full(len(anchor_ids), np.inf)
                up = np.full(len(anchor_ids), -np.inf)
                np.minimum.at(down, of, takes)
                np.maximum.at(up, of, np.where(takes < np.inf, high, -np.inf))
            else:
                down, up = least, np.full(len(anchor_ids), np.inf)
            a, x = _reaching(codes, turned, width, wanted, down, up)
            if not len(a):
                continue
            score = _scores(own, vectors, a, x, exact)
            if not banded:
                best.add(a, score, ids[x])
                continue
            # The lists of one place at a time: an anchor has one at most.
            for p in np.unique(place):
                at = np.full(len(anchor_ids), -1)
                at[of[place == p]] = np.nonzero(place == p)[0]
                which = at[a]
                fits = which >= 0
                fits[fits] = (score[fits] >= low[which[fits]]) & (score[fits] <= high[which[fits]])
                best.add(which[fits], score[fits], ids[x[fits]])
        for own, anchor_ids, _, _, of, place, _, _, best in states.values():
            yield _found(anchor_ids[of], place, best)

    return run


def _search(rows: DataFrame, anchors: DataFrame, n_blocks: int, at_once: int, run: Callable,
            first: int) -> DataFrame:
    """Every block of anchors against every block of rows; a job takes as many
    anchors as may be broadcast. Lists of the tasks are merged per anchor."""
    found = []
    for start in range(0, n_blocks, at_once):
        stop = min(start + at_once, n_blocks) - 1
        chosen = anchors.where(F.col("block").between(start, stop))
        met = rows.withColumn("block", F.explode(F.sequence(F.lit(start), F.lit(stop)))).join(
            F.broadcast(chosen), "block")
        found.append(cut_lineage(met.mapInArrow(run, _FOUND), "found"))
    per_list = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    merged = reduce(DataFrame.unionByName, found)
    return merged.withColumn("rank", F.row_number().over(per_list)).where(F.col("rank") <= first)


def _pack(anchors: DataFrame, n_blocks: int, columns: list[str]) -> DataFrame:
    """Blocks of about BLOCK_ANCHORS anchors, dealt by a hash of their ids,
    which are distinct."""
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    return anchors.groupBy(block.alias("block")).agg(
        F.collect_list(F.struct(*columns)).alias("anchors"))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score``.

    A score is the inner product of whole numbers. Rows with a null id or label,
    a null vector, or a component that is null or not finite take no part. A
    shorter vector counts as filled with zeros. Of rows that repeat an anchor's
    id the largest (label, vector) is the anchor, and none of them is its own
    positive; other repeated rows are candidates each. Ties go to smaller ids.
    An anchor without a positive, or without a negative in the band, has no
    row. Other columns are not looked at. Scores beyond a long are an error.

    The coded rows are a written table. A task keeps its best ``positives`` or
    ``negatives`` of each list while it reads them, and leaves out pairs whose
    interval cannot enter: nothing is lost, whatever the data.
    """
    part = rows.where(F.col(vec_id).isNotNull())
    flagged = taking_part(part.withColumn("_a", is_anchor), vec_id, label, vector)
    size = flagged.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
        F.max(F.array_max(F.transform("vector", F.abs))).alias("most")).first()
    width = -(-max(size["width"] or 1, 1) // 64) * 64
    most = max(size["most"] or 0, 1)
    if width * most * most * UNIT >= LONG:
        raise ValueError("scores of these vectors do not fit into a long")
    exact = "<f8" if width * most * most < EXACT else "<i8"
    store = next(t for t in ("<i2", "<i4", "<i8") if most <= np.iinfo(t).max)

    table = cut_lineage(flagged.mapInArrow(_encoder(width, store), _BLOCK), "codes")
    own = taking_part(part.where(is_anchor), vec_id, label, vector)
    # Rows that repeat an id become one.
    own = own.groupBy("id").agg(F.max(F.struct("label", "vector")).alias("v")).select("id", "v.*")
    own = cut_lineage(own, "anchors")
    n_blocks = -(-own.count() // BLOCK_ANCHORS)
    if not n_blocks:
        n_blocks = 1
    # Hashed blocks differ in size: half as much again is allowed for.
    at_once = max(1, BROADCAST_BYTES * 2 // (3 * BLOCK_ANCHORS * (8 * width + 200)))

    packed = cut_lineage(_pack(own, n_blocks, ["id", "label", "vector"]), "anchor-blocks")
    near = _search(table, packed, n_blocks, at_once,
                   _searcher(width, store, exact, positives, False), positives)
    near = cut_lineage(near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(
        F.struct("rank", "id", "score"))).alias("found")), "positives")
    ready = own.join(near.withColumnRenamed("anchor_id", "id"), "id").withColumn(
        "positives", F.transform("found", lambda p: p["score"]))
    banded = cut_lineage(_pack(ready, n_blocks, ["id", "label", "vector", "positives"]), "anchor-blocks")
    far = _search(table, banded, n_blocks, at_once,
                  _searcher(width, store, exact, negatives, True), negatives)
    positive = F.get("found", F.col("place"))
    return far.join(near, "anchor_id").select(
        "anchor_id", positive["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"))
