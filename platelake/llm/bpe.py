"""Byte-level BPE: encoding with the tokenizers library and exact decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm.text import whole

# Distinct pieces a task remembers the ids of; then it starts over.
REMEMBERED = 300_000
# Longer pieces are encoded each time they occur.
LONG_PIECE = 64
# Characters of text split at once. Longer texts are cut where a piece is sure
# to end: after an ASCII letter and ahead of white space.
PART_CHARS = 1 << 20


def byte_table() -> list[str]:
    """The character that stands for each byte: printable ones for themselves,
    the others for the code points from 256 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, spare = [], 256
    for byte in range(256):
        if byte in shown:
            table.append(chr(byte))
        else:
            table.append(chr(spare))
            spare += 1
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts each token is made of, in the order of the ranks: what is
    left when only lower ranks are merged."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) < 2:
            continue
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(pairs)
            if best >= rank:
                raise ValueError(f"token {rank} cannot be made of lower ones")
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        merges.append((parts[0], parts[1]))
    return merges


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters that split as the whole
    does. A text without a safe place is one part."""
    start = 0
    while len(text) - start > size:
        safe = _SAFE_CUT.search(text, start + size)
        if not safe:
            break
        yield text[start:safe.end()]
        start = safe.end()
    yield text[start:]


_SAFE_CUT = regex.compile(r"[A-Za-z](?=\s)")


class ByteBpe:
    """Encoder and decoder of one rank file. Made once per task."""

    def __init__(self, ranks: dict[bytes, int], merges, pattern: str):
        from tokenizers.models import BPE

        table = byte_table()

        def chars(token: bytes) -> str:
            return "".join(table[b] for b in token)

        self.chars = chars
        self.model = BPE(
            {chars(t): i for t, i in ranks.items()}, [(chars(a), chars(b)) for a, b in merges],
            cache_capacity=0)
        self.pattern = regex.compile(pattern)
        # Decoding goes the other way: the characters of the model's tokens back
        # through the table. A token may hold a part of a character only.
        back = {ord(c): b for b, c in enumerate(table)}
        self.token_bytes = {
            i: self.model.id_to_token(i).translate(back).encode("latin-1") for i in ranks.values()}
        self.remembered: dict[str, bytes] = {}

    def tokens(self, piece: str) -> list[tuple[int, int, int]]:
        """Id, first and last byte (exclusive) of each token of a piece."""
        out, at = [], 0
        for token in self.model.tokenize(self.chars(piece.encode("utf-8"))):
            end = at + len(self.token_bytes[token.id])
            out.append((token.id, at, end))
            at = end
        return out

    def _piece_ids(self, piece: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        found = self.remembered.get(piece)
        if found is None:
            ids = [t.id for t in self.model.tokenize(self.chars(piece.encode("utf-8")))]
            found = b"".join(i.to_bytes(4, "little") for i in ids)
            if len(piece) <= LONG_PIECE:
                if len(self.remembered) >= REMEMBERED:
                    self.remembered.clear()
                self.remembered[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """All ids of a text, four bytes each."""
        out, known, fresh = [], self.remembered, self._piece_ids
        for part in parts(text):
            pieces = self.pattern.findall(part)
            out.append(b"".join([known.get(p) or fresh(p) for p in pieces]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens one after another. A character that was split
        over tokens is whole again once its last byte has come."""
        return b"".join(map(self.token_bytes.__getitem__, memoryview(ids).cast("I")))

    def offsets(self, text: str) -> list[tuple[int, int, int]]:
        """Id, first and last character (exclusive) of each token. A token
        that holds a part of a character spans that character."""
        out, at = [], 0
        for part in parts(text):
            for match in self.pattern.finditer(part):
                piece = match.group()
                char_of = [i for i, c in enumerate(piece) for _ in range(len(c.encode("utf-8")))]
                base = at + match.start()
                out += [(i, base + char_of[a], base + char_of[b - 1] + 1)
                        for i, a, b in self.tokens(piece)]
            at += len(part)
        return out


def _maker(path: str | None, pattern: str | None) -> Callable[[], ByteBpe]:
    """The files are read where the tasks run; by default those of the
    installed package of public tokenizers."""
    def make() -> ByteBpe:
        import public_tokenizers

        ranks = read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        return ByteBpe(ranks, merges_of(ranks), pattern or public_tokenizers.PATTERN)

    return make


def _each(make: Callable[[], ByteBpe], column: str, results, names: list[str]):
    """Arrow batches of (id, column) to (id, *names); one row at a time is in
    memory besides its batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or make()
            rows = [results(bpe, x.as_py()) for x in batch.column(column)]
            columns = [pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True) if rows else [[] for _ in names], results.types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *names])

    return run


def _ids(bpe: ByteBpe, text: str):
    return (list(memoryview(bpe.encode(text)).cast("I")),)


_ids.types = [pa.list_(pa.int32())]


def _spans(bpe: ByteBpe, text: str):
    return ([{"id": i, "start": a, "end": b} for i, a, b in bpe.offsets(text)],)


_spans.types = [pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))]


def _bytes(bpe: ByteBpe, ids: list[int] | None):
    return (b"".join(bpe.token_bytes[i] for i in ids or []),)


_bytes.types = [pa.binary()]


def _digests(bpe: ByteBpe, text: str):
    ids = bpe.encode(text)
    return (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(bpe.decode(ids)).hexdigest())


_digests.types = [pa.int64(), pa.string(), pa.string()]


def _run(docs: DataFrame, doc_id: str, value, make, results, names: list[str], schema: str):
    kind = docs.schema[doc_id].dataType.simpleString()
    listed = docs.select(F.col(doc_id).alias("id"), value.alias("value"))
    out = listed.mapInArrow(_each(make, "value", results, names), f"id {kind}, {schema}")
    return out.withColumnRenamed("id", doc_id)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``ids`` of each text. Null counts as empty, and an empty text has none.
    Rows are independent, so repeated rows give repeated results."""
    return _run(docs, doc_id, whole(text), _maker(path, pattern), _ids, ["ids"], "ids array<int>")


def encode_offsets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``tokens``: id, first and last character (exclusive, in code points)."""
    return _run(docs, doc_id, whole(text), _maker(path, pattern), _spans, ["tokens"],
                "tokens array<struct<id:int,start:int,end:int>>")


def decode(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids",
           path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``data``: the bytes of the ids; cast it to string for the text. An
    unknown id is an error."""
    return _run(encoded, doc_id, F.col(ids), _maker(path, pattern), _bytes, ["data"], "data binary")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encodes and decodes each text: number of tokens and SHA-256 of the ids
    (as little-endian unsigned 32-bit integers) and of the decoded bytes."""
    return _run(docs, doc_id, whole(text), _maker(path, pattern), _digests,
                ["n_tokens", "ids_sha256", "decoded_sha256"],
                "n_tokens long, ids_sha256 string, decoded_sha256 string")
