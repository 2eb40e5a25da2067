"""Hierarchical Pitman-Yor language model over words.

Every word that stands ahead of a training token, and the end of a text, is a
context with a restaurant of its own; all of them share one parent, the
restaurant without context, whose base is uniform over the vocabulary and one
unknown word. Customers are seated by Gibbs sampling, and the seatings drawn
after burn-in are averaged.

The corpus is three written tables: blocks of texts, pairs (context, word) dealt
out by context, and words dealt out by hash. They talk in messages: packed
arrays of numbers, one row per sender and receiver. No vocabulary, context list
or group of one word or context comes to the driver or to a single task.
"""

from __future__ import annotations

import struct
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.llm.text import pieces, whole
from platelake.session import cut_lineage, drop_scratch, scratch_path

STRENGTH = 1.0
# Passes that settle the seating, and passes that are averaged.
BURN_IN = 2
SAMPLES = 2
# Tokens after which a block of documents is closed.
BLOCK_TOKENS = 1 << 21
# Tokens that a receiver of messages stands for, on average, and how many
# receivers there are at least.
PART_TOKENS = 1 << 22
PARTS = 48
# A context with this share of the training tokens is dealt out by its words
# too; there are 4,096 of them at most.
HOT_SHARE = 1 / 4096
# Stands for the end of a text, and for what is ahead of its first word.
END = b" "
SEED = 7

# Kinds of rows.
WORDS, COUNTS, PLACES, PAIRS, MEMBERS, LISTS, HOT, TABLES, SUMS, ROOT, SEEN, KEPT, KNOWN = range(13)

_COLUMNS = [("kind", pa.int32()), ("target", pa.int64()), ("source", pa.int64()), ("a", pa.binary()),
            ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary()), ("stats", pa.list_(pa.float64()))]
MESSAGE = ("kind int, target long, source long, a binary, b binary, c binary, d binary, "
           "stats array<double>")


# --- messages ------------------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, compressed: first the low bytes of all values,
    then the next ones, as many as the largest needs."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.view(np.uint8).reshape(len(values), 8)[:, :width].T
    return struct.pack("<QB", len(values), width) + pa.compress(
        planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", data)
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = pa.decompress(data[9:], n * width, codec="zstd")
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<u8").reshape(n)


def packed_steps(values: np.ndarray) -> bytes:
    """The same for numbers that do not decrease."""
    return packed(np.diff(np.ascontiguousarray(values, dtype="<u8"), prepend=np.uint64(0)))


def unpacked_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def packed_floats(values: np.ndarray) -> bytes:
    return packed(np.ascontiguousarray(values, dtype="<f4").view("<u4"))


def unpacked_floats(data: bytes) -> np.ndarray:
    return unpacked(data).astype("<u4").view("<f4").astype(np.float64)


class Messages:
    """Rows that a task sends."""

    def __init__(self):
        self.rows = []

    def add(self, kind: int, target: int, source: int, *data: bytes, stats=None) -> None:
        self.rows.append((kind, int(target), int(source), *data, *[None] * (4 - len(data)),
                          None if stats is None else [float(v) for v in stats]))

    def table(self) -> pa.Table:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in _COLUMNS]
        return pa.table({name: pa.array(c, t) for c, (name, t) in zip(columns, _COLUMNS, strict=True)})


def _rows(table: pa.Table, kind: int) -> list[dict]:
    """Rows of a kind by sender."""
    return sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["source"])


def _mixed(keys: np.ndarray) -> np.ndarray:
    """Evenly spread bits of whole numbers."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _segments(groups: np.ndarray) -> list[tuple[int, int, int]]:
    """(group, from, to) of an ordered array."""
    if not len(groups):
        return []
    starts = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1 if groups[0] else groups[0] + 1))
    starts[0] = 0
    ends = np.append(starts[1:], len(groups))
    return [(int(groups[i]), int(i), int(j)) for i, j in zip(starts, ends, strict=True)]


# --- blocks: texts as numbers ---------------------------------------------------

def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _block_batches(doc_type: pa.DataType):
    """Texts to blocks: the hashes of a block's words, and its tokens as places
    in that list. Place 0 is the end of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        places, ids, held, lengths, tokens, size = None, [], [], [], [], 0

        def start():
            nonlocal places, ids, held, lengths, tokens, size
            places = defaultdict()
            places.default_factory = places.__len__
            places[END]  # noqa: B018  takes place 0
            ids, held, lengths, tokens, size = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal made
            words = np.fromiter(map(_hash, places), np.uint64, len(places))
            all_tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            number = (task << 32) + made
            made += 1
            values = [[number], [packed(words)], [packed(all_tokens)], [size], [ids], [held], [lengths]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(doc_type),
                     pa.list_(pa.bool_()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=_BLOCK_NAMES)

        start()
        for batch in batches:
            columns = (batch.column("id"), batch.column("held"), batch.column("data"))
            for doc, out, data in zip(*columns, strict=True):
                n = 0
                for piece in pieces(data.as_py()):
                    words = piece.lower().split()  # of bytes: ASCII only
                    tokens.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
                    n += len(words)
                tokens.append(np.zeros(1, np.int32))
                ids.append(doc.as_py())
                held.append(out.as_py())
                lengths.append(n + 1)
                size += n + 1
                if size >= BLOCK_TOKENS:
                    yield block()
                    start()
        if ids:
            yield block()

    return run


_BLOCK_NAMES = ["block", "words", "tokens", "n_tokens", "ids", "held", "lengths"]


def held_out(doc_id: str) -> Column:
    """Whether a document is kept out of training. One without an id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _table(df: DataFrame, name: str, key: str) -> tuple[DataFrame, str]:
    """A written table whose rows later joins by ``key`` find where they are."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"platelake_{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(table)
    written = spark.table(table)
    # The files stay, and the frame knows them; the catalogue need not.
    spark.sql(f"DROP TABLE {table}")
    return written, path


def token_blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Table of blocks. Block numbers are taken from the written rows, so they
    stay as they are when a later task is repeated."""
    from pyspark.sql.pandas.types import to_arrow_type

    field = docs.schema[doc_id].dataType
    listed = docs.select(
        F.col(doc_id).alias("id"), held_out(doc_id).alias("held"),
        whole(text).cast("binary").alias("data"))
    schema = ("block long, words binary, tokens binary, n_tokens long, "
              f"ids array<{field.simpleString()}>, held array<boolean>, lengths array<long>")
    return _table(listed.mapInArrow(_block_batches(to_arrow_type(field)), schema), "blocks", "block")[0]


class Block:
    """The arrays of one row of the block table."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.words = unpacked(row["words"])
        self.tokens = unpacked(row["tokens"]).astype(np.int32)
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.array(row["held"], bool)
        self.ids = row["ids"]

    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.lengths)

    def word_order(self, parts: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Places of the words by receiver and hash, and what goes to each."""
        part = self.words % np.uint64(parts)
        order = np.lexsort((self.words, part))
        return order, _segments(part[order])

    def numbers(self, parts: int, rows: list[dict]) -> np.ndarray:
        """Word numbers of the block's words, from the answers of their parts."""
        order, segments = self.word_order(parts)
        out = np.zeros(len(self.words), np.uint64)
        answers = {r["source"]: r["a"] for r in rows}
        for part, a, b in segments:
            out[order[a:b]] = unpacked_steps(answers[part]) * np.uint64(parts) + np.uint64(part)
        return out

    def pairs(self, numbers: np.ndarray, deal: Deal):
        """Distinct pairs (context, word) by receiver, context and word; what
        goes to each receiver; and each token's place among them."""
        words = numbers[self.tokens]
        # Every text ends with token 0, so what stands before a text is an end.
        contexts = np.concatenate([numbers[:1], words[:-1]])
        keys, back = np.unique(contexts * np.uint64(deal.bound) + words, return_inverse=True)
        u, w = keys // np.uint64(deal.bound), keys % np.uint64(deal.bound)
        part = deal.part(u, w)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return u[order], w[order], _segments(part[order]), place[back]


class Deal(NamedTuple):
    """How pairs are dealt out: number of parts, a bound of the word numbers,
    and the contexts whose pairs are dealt out one by one."""
    parts: int
    bound: int
    hot: np.ndarray

    def is_hot(self, u: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(u), bool)
        at = np.minimum(np.searchsorted(self.hot, u), len(self.hot) - 1)
        return self.hot[at] == u

    def part(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        keys = np.where(self.is_hot(u), _mixed(u) ^ w, u)
        return _mixed(keys) % np.uint64(self.parts)


def _runs(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ordered array and how often each stands there."""
    starts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.zeros(0, int)
    return u[starts], np.diff(np.append(starts, len(u)))


def _pair_data(u: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[bytes, ...]:
    contexts, lengths = _runs(u)
    return packed_steps(contexts), packed(lengths), packed(w), packed(n)


def _pair_arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    u = np.repeat(unpacked_steps(row["a"]), unpacked(row["b"]).astype(np.int64))
    return u, unpacked(row["c"]), unpacked(row["d"]).astype(np.int64)


# --- counting ------------------------------------------------------------------

def _block_words(parts: int) -> Callable:
    """A block's words and their training counts, to the parts of the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, out = Block(batch.slice(i, 1).to_pylist()[0]), Messages()
                counts = np.bincount(block.tokens[block.training()], minlength=len(block.words))
                order, segments = block.word_order(parts)
                for part, a, b in segments:
                    own = order[a:b]
                    out.add(WORDS, part, block.number, packed_steps(block.words[own]), packed(counts[own]))
                yield from out.table().to_batches()

    return run


def _count_words(table: pa.Table) -> pa.Table:
    """Numbers the words of a part and adds up their counts; tells each block
    the numbers of its words."""
    out, rows = Messages(), _rows(table, WORDS)
    lists = [unpacked_steps(r["a"]) for r in rows]
    _, places = np.unique(np.concatenate(lists), return_inverse=True)
    counts = np.bincount(places, np.concatenate([unpacked(r["b"]) for r in rows])).astype(np.int64)
    part = rows[0]["target"]
    out.add(COUNTS, part, part, packed(counts), stats=[
        len(counts), (counts > 0).sum(), counts.sum()])
    ends = np.cumsum([len(x) for x in lists])
    for row, words, end in zip(rows, lists, ends, strict=True):
        out.add(PLACES, row["source"], part, packed_steps(places[end - len(words):end]))
    return out.table()


def _often(limit: float) -> Callable:
    """Numbers and counts of a part's words with at least so many tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = unpacked(row["a"])
                often = np.flatnonzero(counts >= limit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(often), row["target"], np.int64)), pa.array(often.astype(np.int64))],
                    names=["part", "place"])

    return run


def _block_pairs(parts: int, deal: Deal) -> Callable:
    """A block's pairs and their training counts, to the parts of the pairs."""
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = Messages()
        for row in blocks.to_pylist():
            block = Block(row)
            u, w, segments, place = block.pairs(block.numbers(parts, _rows(answers, PLACES)), deal)
            n = np.bincount(place, block.training(), len(u)).astype(np.int64)
            for part, a, b in segments:
                out.add(WORDS, part, block.number, *_pair_data(u[a:b], w[a:b], n[a:b]))
        return out.table()

    return run


def _word_lists(parts: int, bound: int, w: np.ndarray):
    """Distinct words by part and number, what belongs to each part, and the
    place of each of ``w`` among them."""
    each = np.uint64(bound // parts + 1)
    keys, back = np.unique((w % np.uint64(parts)) * each + w // np.uint64(parts), return_inverse=True)
    return keys % each, _segments(keys // each), back


def _hot_rows(out: Messages, deal: Deal, u: np.ndarray, *values: np.ndarray) -> None:
    """What this part knows of hot contexts: their customers, their tables, and
    the tables of all samples."""
    inside = deal.is_hot(u)
    contexts, back = np.unique(u[inside], return_inverse=True)
    sums = [np.bincount(back, x[inside], len(contexts)) for x in values]
    for context, *own in zip(contexts, *sums, strict=True):
        out.add(HOT, context, 0, stats=own)


def _count_pairs(parts: int, deal: Deal) -> Callable:
    """Adds up the pairs of a part; tells the parts of the words who asks for
    them, with one table per pair to begin with."""
    def run(table: pa.Table) -> pa.Table:
        out, rows = Messages(), _rows(table, WORDS)
        decoded = [_pair_arrays(r) for r in rows]
        bound = np.uint64(deal.bound)
        keys, places = np.unique(np.concatenate([u * bound + w for u, w, _ in decoded]), return_inverse=True)
        n = np.bincount(places, np.concatenate([x for *_, x in decoded])).astype(np.int64)
        u, w, part = keys // bound, keys % bound, rows[0]["target"]
        out.add(PAIRS, part, part, *_pair_data(u, w, n), stats=[
            n.sum(), (n > 0).sum(), (n == 1).sum(), (n == 2).sum()])
        end = 0
        for row, (own, *_) in zip(rows, decoded, strict=True):
            out.add(MEMBERS, part, row["source"], packed_steps(places[end:end + len(own)]))
            end += len(own)
        trained = n > 0
        lists, segments, back = _word_lists(parts, deal.bound, w[trained])
        sums = np.bincount(back, minlength=len(lists))
        for target, a, b in segments:
            out.add(LISTS, target, part, packed_steps(lists[a:b]), packed(sums[a:b]))
        _hot_rows(out, deal, u, n, trained, np.zeros(len(n)))
        return out.table()

    return run


# --- seating -------------------------------------------------------------------

def uniform(keys: np.ndarray, step: int) -> np.ndarray:
    """A number in (0, 1) for each key and step: the same in every task."""
    with np.errstate(over="ignore"):
        z = keys + np.uint64((step * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


# Up to so many customers the number of tables is drawn from its exact law;
# beyond, the part of the law that has no closed form is scaled from there.
LATTICE = 512
# Steps of the grid on which tables of larger dishes are looked for.
GRID_RATIO = 1.04
# Cells of the lattice that are worked on at once.
CELLS = 1 << 21


# Tables of Stirling numbers by discount. A plain dict: it travels to workers
# that cannot import the package.
_STIRLING: dict[float, np.ndarray] = {}


def log_stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: entry (c, t) sums the
    weights of all ways to seat c customers at t tables."""
    if discount not in _STIRLING:
        out = np.full((LATTICE + 1, LATTICE + 1), -np.inf)
        out[0, 0] = 0.0
        t = np.arange(1, LATTICE + 1)
        for c in range(LATTICE):
            joining = np.log(np.maximum(c - discount * t, 1e-300))
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], np.where(t <= c, out[c, 1:] + joining, -np.inf))
        _STIRLING[discount] = out
    return _STIRLING[discount]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function from 1 on."""
    shift = np.maximum(10.0 - np.floor(x), 0.0)
    z = x + shift
    series = (z - 0.5) * np.log(z) - z + 0.9189385332046727 + (1 / 12 - (1 / 360 - 1 / (1260 * z * z)) / (z * z)) / z
    for k in range(9):
        series = series - np.where(k < shift, np.log(np.maximum(x + k, 1e-300)), 0.0)
    return series


def _large_log_stirling(count: float, tables: np.ndarray, discount: float) -> np.ndarray:
    """The same, up to a constant, of more customers than the lattice holds.

    A Stirling number is a factor in closed form times the chance that
    independent table sizes add up to the customers. Their sums scale like
    ``tables ** (1 / discount)``, so that chance is read off at the last row of
    the lattice, at the number of tables that corresponds.
    """
    row = log_stirling(discount)[LATTICE, 1:]
    t = np.arange(1, LATTICE + 1)
    chance = row + t * np.log(discount) + _log_gamma(t + 1.0)
    place = tables * (LATTICE / count) ** discount
    # Few tables: the chance grows with their number.
    read = np.interp(np.log(np.maximum(place, 1.0)), np.log(t), chance) + np.log(np.minimum(place, 1.0))
    return read - tables * np.log(discount) - _log_gamma(tables + 1.0)


def _grid(top: int) -> np.ndarray:
    """1, 2, 3, ... with growing steps, up to ``top``."""
    out, at = [], 1.0
    while at < top:
        out.append(int(at))
        at = max(at + 1, at * GRID_RATIO)
    return np.array([*out, top], np.float64)


def _seat_large(count: float, mass: float, gain: float, later: float, slope: float,
                discount: float, u: float) -> float:
    """One draw for a large dish: a stretch of the grid, then a place in it."""
    t = _grid(int(count))
    opens = np.log(np.maximum(mass + gain * t, 1e-300)) + np.log(np.maximum(later + slope * t, 1e-300))
    # Weights of the second, third, ... table, added up along the grid.
    steps = np.diff(t)
    upto = np.concatenate([[0.0], np.cumsum(steps * (opens[1:] + opens[:-1]) / 2)])
    logs = upto - (opens - opens[0]) / 2 + _large_log_stirling(count, t, discount)
    # Each place of the grid stands for the numbers after the place before, their
    # weights going from one to the other by a constant ratio.
    rise = np.concatenate([[0.0], np.diff(logs) / steps])
    width = np.concatenate([[1.0], steps])
    shrink = np.abs(rise)
    top = np.maximum(logs, logs - rise * (width - 1)) - logs.max()
    sums = np.where(shrink > 1e-9, -np.expm1(-shrink * width) / np.maximum(-np.expm1(-shrink), 1e-12), width)
    heap = np.cumsum(np.exp(top) * sums)
    aim = u * heap[-1]
    k = min(int(np.searchsorted(heap, aim, side="right")), len(t) - 1)
    inside = np.cumsum(np.exp(logs[k] - logs.max() - rise[k] * np.arange(width[k] - 1, -1, -1)))
    at = int(np.searchsorted(inside, aim - (heap[k - 1] if k else 0.0), side="right"))
    return float(t[k] - width[k] + 1 + min(at, width[k] - 1))


def seat(counts: np.ndarray, mass: np.ndarray, gain: float, later: np.ndarray, slope: float,
         discount: float, keys: np.ndarray, step: int) -> np.ndarray:
    """Tables of each dish, drawn given all other seatings.

    The chance of t tables goes with the ways to seat the dish's customers at
    them and with the weights of opening the second to the t-th: table k + 1
    is opened with ``mass + gain * k`` (strength and discounted tables of the
    restaurant) times ``later + slope * k``, what the parent gives the dish
    once k customers of this restaurant are there. The first one is sure.
    """
    out = np.minimum(counts.astype(np.float64), 1.0)
    u = uniform(keys, step)
    # Of two customers the second sits down with the first or does not.
    two = np.flatnonzero(counts == 2)
    opens = (mass[two] + gain) * (later[two] + slope)
    out[two] += u[two] * (opens + 1 - discount) < opens
    small = np.flatnonzero((counts > 2) & (counts <= LATTICE))
    small = small[np.argsort(counts[small], kind="stable")]
    stirling = log_stirling(discount)
    at = 0
    while at < len(small):
        c = int(counts[small[at]])
        end = int(np.searchsorted(counts[small], c, side="right"))
        end = min(end, at + max(1, CELLS // c))
        rows = small[at:end]
        k = np.arange(1, c)
        logs = np.zeros((len(rows), c))
        opens = logs[:, 1:]
        np.multiply(mass[rows, None] + gain * k, later[rows, None] + slope * k, out=opens)
        np.maximum(opens, 1e-300, out=opens)
        np.log(opens, out=opens)
        np.cumsum(opens, axis=1, out=opens)
        logs += stirling[c, 1:c + 1]
        logs -= logs.max(axis=1, keepdims=True)
        heap = np.cumsum(np.exp(logs, out=logs), axis=1, out=logs)
        out[rows] = 1 + (heap < u[rows, None] * heap[:, -1:]).sum(axis=1)
        at = end
    for i in np.flatnonzero(counts > LATTICE):
        out[i] = _seat_large(
            float(counts[i]), float(mass[i]), gain, float(later[i]), slope, discount, float(u[i]))
    return out


class Totals(NamedTuple):
    """What the whole corpus adds to every draw: words and tokens of training,
    discounts, strength, customers and tables of the root, and customers and
    tables of the hot contexts, in the order of the deal."""
    vocabulary: int
    tokens: int
    root_discount: float
    discount: float
    strength: float
    customers: float
    tables: float
    hot_customers: np.ndarray
    hot_tables: np.ndarray

    @property
    def base(self) -> float:
        return 1.0 / (self.vocabulary + 1)


def _per_context(deal: Deal, u: np.ndarray, values: np.ndarray, hot_values: np.ndarray) -> np.ndarray:
    """Sum of the values of each pair's context. That of a hot one, most of
    whose pairs lie elsewhere, comes from the whole corpus."""
    contexts, lengths = _runs(u)
    starts = np.cumsum(lengths) - lengths
    sums = np.add.reduceat(values.astype(np.float64), starts) if len(u) else np.zeros(0)
    hot = deal.is_hot(contexts)
    sums[hot] = hot_values[np.searchsorted(deal.hot, contexts[hot])]
    return np.repeat(sums, lengths)


def _seat_pairs(parts: int, deal: Deal, totals: Totals, step: int, sample: bool) -> Callable:
    """One pass over the pairs: draws their tables, given what the root holds of
    each word, and tells the parts of the words what they send there. A
    ``sample`` adds the tables to those of the samples before."""
    def run(pairs: pa.Table, answers: pa.Table) -> pa.Table:
        out = Messages()
        for row in _rows(pairs, PAIRS):
            u, w, n = _pair_arrays(row)
            trained = n > 0
            before = _rows(answers, TABLES)
            tables = unpacked(before[0]["a"]).astype(np.float64) if before else trained.astype(np.float64)
            samples = unpacked(before[0]["b"]).astype(np.float64) if before else np.zeros(len(n))
            lists, segments, back = _word_lists(parts, deal.bound, w[trained])
            held = {r["source"]: r for r in _rows(answers, SEEN)}
            root = np.zeros((2, len(lists)))
            for part, a, b in segments:
                root[0, a:b], root[1, a:b] = unpacked(held[part]["a"]), unpacked(held[part]["b"])
            customers, root_tables = root[0][back], root[1][back]
            d0, d1, s = totals.root_discount, totals.discount, totals.strength
            whole = s + totals.customers
            all_tables = _per_context(deal, u, tables, totals.hot_tables)
            own = tables[trained]
            # What the root holds of the word without this pair's customers.
            others = np.maximum(customers - own, 0)
            stay = others - d0 * np.minimum(root_tables, others + 1) + (s + d0 * totals.tables) * totals.base
            mass = s + d1 * np.maximum(all_tables[trained] - own, 0)
            keys = _mixed(u[trained]) ^ w[trained]
            tables[trained] = seat(
                n[trained], mass, d1, stay / whole, 1.0 / whole, d1, keys, SEED + step * 2)
            if sample:
                samples += tables
            out.add(TABLES, row["target"], row["target"], packed(tables), packed(samples))
            sums = np.bincount(back, own, len(lists))
            for part, a, b in segments:
                out.add(SUMS, part, row["target"], packed(sums[a:b]))
            _hot_rows(out, deal, u, n, tables, samples)
        return out.table()

    return run


def _seat_words(totals: Totals | None, step: int, sample: bool) -> Callable:
    """One pass over the words: adds up the customers that contexts send, draws
    the root's tables and tells every part of pairs what it holds of its words.
    Without totals every word that is there has one table."""
    def run(table: pa.Table) -> pa.Table:
        out = Messages()
        (counted,) = _rows(table, COUNTS)
        part, n = counted["target"], len(unpacked(counted["a"]))
        lists = {r["source"]: unpacked_steps(r["a"]).astype(np.int64) for r in _rows(table, LISTS)}
        sums = {r["source"]: r["a"] for r in _rows(table, SUMS)} or {
            r["source"]: r["b"] for r in _rows(table, LISTS)}
        customers = np.zeros(n)
        for source, places in lists.items():
            customers[places] += unpacked(sums[source])
        before = _rows(table, ROOT)
        tables = unpacked(before[0]["b"]).astype(np.float64) if before else np.minimum(customers, 1)
        added = [unpacked(before[0][c]).astype(np.float64) if before else np.zeros(n) for c in "cd"]
        if totals is not None:
            d0, s = totals.root_discount, totals.strength
            mass = s + d0 * np.maximum(totals.tables - tables, 0)
            keys = np.arange(n, dtype=np.uint64) << np.uint64(20) ^ _mixed(np.full(n, part, np.uint64))
            tables = seat(customers, mass, d0, np.full(n, totals.base), 0.0, d0, keys, SEED + step * 2 + 1)
        if sample:
            added = [added[0] + customers, added[1] + tables]
        out.add(ROOT, part, part, packed(customers), packed(tables), *map(packed, added), stats=[
            customers.sum(), tables.sum(), (customers == 1).sum(), (customers == 2).sum(),
            added[0].sum(), added[1].sum()])
        for source, places in lists.items():
            out.add(SEEN, source, part, packed(customers[places]), packed(tables[places]))
        return out.table()

    return run


def _discount(ones: float | None, twos: float | None) -> float:
    """From the numbers of dishes with one and with two customers."""
    ones, twos = ones or 0, twos or 0
    return min(max(ones / (ones + 2 * twos), 0.1), 0.95) if ones else 0.5


def _sums(rows: DataFrame, kind: int, n: int) -> list[float]:
    """Statistics of all rows of a kind, added up."""
    found = rows.where(F.col("kind") == kind).agg(*[F.sum(F.col("stats")[i]) for i in range(n)]).first()
    return [v or 0.0 for v in found]


def _hot_totals(rows: DataFrame, deal: Deal) -> np.ndarray:
    """Customers, tables and tables of all samples of the hot contexts; 4,096
    rows at most."""
    found = rows.where(F.col("kind") == HOT).groupBy("target").agg(
        *[F.sum(F.col("stats")[i]) for i in range(3)]).collect()
    out = np.zeros((3, len(deal.hot)))
    for context, *sums in found:
        out[:, np.searchsorted(deal.hot, np.uint64(context))] = sums
    return out


class Model(NamedTuple):
    """``words``: rows COUNTS and ROOT by part; ``places``: numbers of the words
    of each block; ``pairs``: rows PAIRS and MEMBERS by part; ``tables``: their
    seating. Tables of ``samples`` draws are added up."""
    words: DataFrame
    places: DataFrame
    pairs: DataFrame
    tables: DataFrame
    parts: int
    deal: Deal
    totals: Totals
    samples: int
    root_sums: tuple[float, float]
    hot_samples: np.ndarray


def _pass(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Messages as a written table, a folder per kind."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns), path


def _of(rows: DataFrame, *kinds: int) -> DataFrame:
    return rows.where(F.col("kind").isin(list(kinds)))


def fit(blocks: DataFrame, strength: float = STRENGTH) -> Model:
    """Counts and seats all training tokens.

    Each pass is two exchanges of messages: what the contexts send to the root,
    and what the root holds of their words. The pairs themselves are shuffled
    once, when they are counted, and found by part from then on.
    """
    spark = blocks.sparkSession
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(PARTS, -(-tokens // PART_TOKENS))

    counted, _ = _pass(
        blocks.mapInArrow(_block_words(parts), MESSAGE).groupBy("target").applyInArrow(
            _count_words, MESSAGE), "words")
    counts, places = _of(counted, COUNTS), _of(counted, PLACES)
    vocabulary, trained = (int(v) for v in _sums(counted, COUNTS, 3)[1:])
    largest = counts.agg(F.max(F.col("stats")[0])).first()[0] or 0
    often = counts.mapInArrow(
        _often(max(HOT_SHARE * trained, 2)), "part long, place long").collect() if trained else []
    hot = np.sort(np.array([r["place"] * parts + r["part"] for r in often], np.uint64))
    deal = Deal(parts, int(largest + 1) * parts, hot)
    if deal.bound > 1 << 32:
        raise ValueError("more than four billion words")

    asked = blocks.groupBy("block").cogroup(places.groupBy("target")).applyInArrow(
        _block_pairs(parts, deal), MESSAGE)
    pairs, _ = _table(
        asked.groupBy("target").applyInArrow(_count_pairs(parts, deal), MESSAGE), "pairs", "target")
    lists = _of(pairs, LISTS)
    _, _, ones, twos = _sums(pairs, PAIRS, 4)
    hot_customers, hot_tables, hot_samples = _hot_totals(pairs, deal)

    def seat_words(rows: DataFrame, totals: Totals | None, step: int, sample: bool):
        return _pass(rows.groupBy("target").applyInArrow(
            _seat_words(totals, step, sample), MESSAGE), "root")

    root, root_path = seat_words(counts.unionByName(lists), None, 0, False)
    customers, tables, root_ones, root_twos, *_ = _sums(root, ROOT, 6)
    totals = Totals(vocabulary, trained, _discount(root_ones, root_twos), _discount(ones, twos),
                    strength, customers, tables, hot_customers, hot_tables)
    seated, seated_path = None, None
    own = _of(pairs, PAIRS)
    for step in range(1, BURN_IN + SAMPLES + 1):
        sample = step > BURN_IN
        answers = _of(root, SEEN)
        if seated is not None:
            answers = answers.unionByName(_of(seated, TABLES))
        new, new_path = _pass(own.groupBy("target").cogroup(answers.groupBy("target")).applyInArrow(
            _seat_pairs(parts, deal, totals, step, sample), MESSAGE), "seated")
        _, hot_tables, hot_samples = _hot_totals(new, deal)
        totals = totals._replace(hot_tables=hot_tables)
        told = counts.unionByName(lists).unionByName(_of(new, SUMS)).unionByName(_of(root, ROOT))
        new_root, new_root_path = seat_words(told, totals, step, sample)
        for path in (seated_path, root_path):
            if path:
                drop_scratch(spark, path)
        seated, seated_path, root, root_path = new, new_path, new_root, new_root_path
        customers, tables, _, _, *added = _sums(root, ROOT, 6)
        totals = totals._replace(customers=customers, tables=tables)
    return Model(counts.unionByName(_of(root, ROOT)), places, _of(pairs, PAIRS, MEMBERS),
                 _of(seated, TABLES), parts, deal, totals, SAMPLES, tuple(added), hot_samples)


# --- scoring -------------------------------------------------------------------

def _root_answers(model: tuple) -> Callable:
    """Probabilities without context and training counts of each block's words."""
    totals, samples, (all_customers, all_tables) = model

    def run(table: pa.Table) -> pa.Table:
        out = Messages()
        (counted,), (root,) = _rows(table, COUNTS), _rows(table, ROOT)
        n = unpacked(counted["a"])
        customers, tables = unpacked(root["c"]) / samples, unpacked(root["d"]) / samples
        whole = totals.strength + all_customers / samples
        back = (totals.strength + totals.root_discount * all_tables / samples) / whole
        p = (customers - totals.root_discount * tables) / whole + back * totals.base
        for row in _rows(table, PLACES):
            # Sent as asked: the block is the sender here.
            places = unpacked_steps(row["a"]).astype(np.int64)
            out.add(KNOWN, row["source"], counted["target"], packed_floats(p[places]), packed(n[places]))
        return out.table()

    return run


def _pair_answers(model: tuple) -> Callable:
    """What each block's pairs keep in their context, and what each context
    leaves to the root, averaged over the samples."""
    deal, totals, samples, hot_samples = model

    def run(pairs: pa.Table, seated: pa.Table) -> pa.Table:
        out = Messages()
        for row in _rows(pairs, PAIRS):
            u, _, n = _pair_arrays(row)
            (state,) = _rows(seated, TABLES)
            tables = unpacked(state["b"]) / samples
            whole = totals.strength + _per_context(deal, u, n, totals.hot_customers)
            kept = (n - totals.discount * tables) / whole
            back = (totals.strength + totals.discount * _per_context(
                deal, u, tables, hot_samples)) / whole
            for member in _rows(pairs, MEMBERS):
                places = unpacked_steps(member["a"]).astype(np.int64)
                first = np.concatenate([[True], np.diff(u[places].astype(np.int64)) != 0])
                out.add(KEPT, member["source"], row["target"], packed_floats(kept[places]),
                        packed_floats(back[places[first]]), packed(_runs(u[places])[1]))
        return out.table()

    return run


_SCORES = ("held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double")


def _score_blocks(parts: int, deal: Deal, totals: Totals, doc_type: pa.DataType) -> Callable:
    names = ["id", *[c.split()[0] for c in _SCORES.split(", ")]]

    def score(block: Block, answers: pa.Table) -> pa.Table:
        order, segments = block.word_order(parts)
        root, counts = np.zeros(len(block.words)), np.zeros(len(block.words))
        known = {r["source"]: r for r in _rows(answers, KNOWN)}
        for part, a, b in segments:
            root[order[a:b]] = unpacked_floats(known[part]["a"])
            counts[order[a:b]] = unpacked(known[part]["b"])
        u, _, segments, place = block.pairs(block.numbers(parts, _rows(answers, PLACES)), deal)
        kept, back = np.zeros(len(u)), np.zeros(len(u))
        told = {r["source"]: r for r in _rows(answers, KEPT)}
        for part, a, b in segments:
            row = told[part]
            kept[a:b] = unpacked_floats(row["a"])
            back[a:b] = np.repeat(unpacked_floats(row["b"]), unpacked(row["c"]).astype(np.int64))
        p = kept[place] + back[place] * root[block.tokens]
        base = np.log10((counts + 0.1) / (totals.tokens + 0.1 * (totals.vocabulary + 1)))
        starts = np.concatenate([[0], np.cumsum(block.lengths)[:-1]]).astype(np.int64)

        def total(values):
            return np.add.reduceat(values, starts)

        return pa.table([
            pa.array(block.ids, doc_type), pa.array(block.held), pa.array(block.lengths),
            pa.array(total((counts > 0)[block.tokens].astype(np.int64))),
            pa.array(np.full(len(starts), totals.tokens, np.int64)),
            pa.array(total(base[block.tokens])), pa.array(total(np.log10(p)))], names=names)

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.concat_tables([score(Block(row), answers) for row in blocks.to_pylist()])

    return run


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    strength: float = STRENGTH) -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` of every row.

    Perplexity is ``10 ** (-score / n_tokens)``. Null texts are empty and hold
    one token, their end. Rows without an id are trained on. Repeated rows are
    all counted and all scored. Without any training text every word is as
    likely as the base says.

    Each block asks once for each of its distinct words and pairs, so what is
    shuffled grows with the tokens, never faster.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    blocks = token_blocks(docs, doc_id, text)
    model = fit(blocks, strength)
    # Blocks asked by part; here their questions go to the parts once more.
    asked = model.places.select(
        "kind", F.col("source").alias("target"), F.col("target").alias("source"), "a", "b", "c", "d", "stats")
    known = model.words.unionByName(asked).groupBy("target").applyInArrow(
        _root_answers((model.totals, model.samples, model.root_sums)), MESSAGE)
    kept = model.pairs.groupBy("target").cogroup(model.tables.groupBy("target")).applyInArrow(
        _pair_answers((model.deal, model.totals, model.samples, model.hot_samples / model.samples)),
        MESSAGE)
    answers = model.places.unionByName(known).unionByName(kept)
    field = docs.schema[doc_id].dataType
    return blocks.groupBy("block").cogroup(answers.groupBy("target")).applyInArrow(
        _score_blocks(model.parts, model.deal, model.totals, to_arrow_type(field)),
        f"id {field.simpleString()}, {_SCORES}")
