"""Text helpers shared by the operators: words, lower case, bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
# Everything that is neither an ASCII letter or digit nor beyond ASCII.
# Upper case counts as a separator: texts are lower-cased before.
OTHER_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Bytes of text that a Python task handles at once.
PIECE_BYTES = 1 << 20


def whole(text: Column | str) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Texts of ASCII alone take the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def space_words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def plain_words(text: Column) -> Column:
    """Lower-case runs of ASCII letters, digits and everything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(text), OTHER_RUN), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row. A column that is
    merely named inside a lambda is worked out again for every element."""
    return F.transform(F.array(value), use)[0]


def positions(n: Column) -> Column:
    """0, 1, ... n - 1; none if n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """``data`` in pieces that end where ASCII white space begins, so that no
    word is cut. A longer word makes a longer piece."""
    start, end = 0, len(data)
    while end - start > size:
        cut = min((i for i in (data.find(c, start + size) for c in _SPACE_BYTES) if i >= 0),
                  default=end)
        yield data[start:cut]
        start = cut
    yield data[start:end]


_SPACE_BYTES = [bytes([c]) for c in SPACES.encode()]
