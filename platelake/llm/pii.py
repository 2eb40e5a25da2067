"""Personal data: exact patterns, and spans that a trained tagger adds."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm.tagger import KINDS, Tagger, encode, spans_of, tags_of
from platelake.llm.text import whole

EMAIL, IP, CARD, PHONE = range(4)

# Windows of the tagger and how far the next one starts, in characters.
WINDOW = 64
STRIDE = 32
# Widths of the windows that spans are decoded in again where they touch an
# end, and how long a stretch of such spans may be to be one.
WIDER = (128, 256, 512, 1024, 2048)
STRETCH = 512
# Windows decoded at once.
DECODED = 512

# Bounds of the labelled sample the tagger is fitted on.
SAMPLE_DOCS = 600
SAMPLE_WINDOWS_OF_A_DOC = 6
MADE_WINDOWS = 6000
STEPS = 1200

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Repeats that cannot give anything back keep no way back, however long they are.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match cannot start within a run of digits whose start has failed.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# What stands for @, dots and digits. Brackets may be around a sign as well.
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s?", r"\s?[\])}>]\s{0,3}"
_DOT = rf"(?:{_OPEN}(?:dot|\.){_CLOSE}|\s{{1,3}}dot\s{{1,3}}|\.)"
_LABEL = r"[a-z0-9-]{1,63}"
_WORDED_EMAIL = re.compile(
    rf"(?i)[a-z0-9_%+-]+(?:{_DOT}[a-z0-9_%+-]+)*"
    rf"(?:{_OPEN}(?:at|@){_CLOSE}|(?P<at>\s{{1,3}}at\s{{1,3}})|\s{{0,3}}@\s{{0,3}})"
    rf"(?P<domain>{_LABEL}(?:{_DOT}{_LABEL})+)")
_NUMBER = {w: str(i) for i, w in enumerate(
    "zero one two three four five six seven eight nine".split())} | {"oh": "0", "plus": "+"}
_WORD = re.compile(r"[a-z]+")
# An email's "at" and what follows; what stands ahead of it, in a bounded slice.
_WORDED_AT = re.compile(rf"(?i)\bat\b\s?[\])}}>]?\s{{0,3}}{_LABEL}{_DOT}[a-z0-9]")
_AHEAD = re.compile(rf"(?i)[a-z0-9_%+-]+(?:{_DOT}[a-z0-9_%+-]+)*(?:{_OPEN}|\s{{1,3}})\Z")
AHEAD = 320
# What a window is laid around: digits and @ signs, what stands for a sign, and
# two digit words in a row. Other text cannot hold a plausible span.
_DIGIT_WORD = "(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
_ANCHORS = re.compile(
    r"[0-9@](?:[^\n]{0,16}[0-9@])*+"
    r"|(?i:\bdot\b|[\[({<]\s?(?:at|dot|\.)\s?[\])}>]"
    rf"|\b{_DIGIT_WORD}[ ,./-]{{1,3}}(?={_DIGIT_WORD}\b))")
# Digit words in a row, groups of digits among them.
_TOKEN = f"(?:{'|'.join(w for w in _NUMBER if w != 'plus')}|[0-9]{{1,4}}+)"
_WORDED_NUMBER = re.compile(rf"(?i)\b(?:plus\s|\+)?{_TOKEN}\b(?:[\s,./-]{{1,3}}+{_TOKEN}\b){{2,}}+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that do not overlap, found from their @: what stands
    ahead of it is the run of local characters, which a search from the left
    would start with."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        else:
            # The run ahead of a failed @ cannot serve the next one.
            done = at + 1
        at = text.find("@", done)


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the exact patterns, in code points."""
    out = [(EMAIL, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        # A long part cannot be 255 at most unless it is all zeros but for its end.
        out += [(IP, *m.span()) for m in _IP.finditer(text)
                if all(len(p := g.lstrip("0")) <= 3 and int(p or "0") <= 255 for g in m.groups())]
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((CARD, *m.span()))
        out += [(PHONE, *m.span()) for m in _PHONE.finditer(text)
                if 9 <= len(_digits(m.group())) <= 15]
    return out


class _Folds(dict):
    """What characters beyond ASCII are folded to, by code point, worked out
    when first met. A plain dict travels to workers by value; the wrapper of a
    cached function would be looked up in a package they may not have."""

    def __missing__(self, code: int) -> str:
        self[code] = out = _folded(chr(code))
        return out


def _folded(char: str) -> str:
    """The ASCII character that a wide or foreign one stands for, or itself."""
    if char < "\x80":
        return char
    if char.isdecimal():
        return str(unicodedata.decimal(char))
    plain = unicodedata.normalize("NFKC", char)
    return plain if len(plain) == 1 and plain.isascii() and not plain.isdigit() else char


_FOLDS = _Folds()


def folded(text: str) -> str:
    """The text with all decimal digits and full-width signs as ASCII ones, of
    the same length."""
    return text if text.isascii() else text.translate(_FOLDS)


def _numbered(text: str) -> str:
    """A text of digits and digit words with digits for the words; as it is if
    it holds another word."""
    lowered = text.lower()
    if any(w not in _NUMBER for w in _WORD.findall(lowered)):
        return text
    return _WORD.sub(lambda m: _NUMBER[m.group()], lowered)


def plausible(kind: int, text: str) -> bool:
    """What an added span must be at least."""
    text = folded(text)
    if kind == EMAIL:
        left, _, right = text.partition("@")
        if bool(left.strip()) and "." in right.strip(" .") and len(text.split()) <= 5:
            return True
        worded = _WORDED_EMAIL.fullmatch(text)
        # "look at example.org" is none: a bare "at" needs a worded dot.
        return bool(worded) and (not worded["at"] or re.search("(?i)dot", worded["domain"]) is not None)
    if kind in (CARD, PHONE):
        text = _numbered(text)
    digits = _digits(text)
    if kind == IP:
        parts = re.split(r"[^0-9]+", text)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == CARD:
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[A-Za-z]", text)
    return 9 <= len(digits) <= 15 and not re.search(r"[^0-9+() ./-]", text)


def kind_of(kind: int, text: str) -> int | None:
    """The kind of an added span, None if it is not plausible. Digit words of
    cards and phones look the same until they are counted, so of those the
    count decides: from 13 digits on that fit and no plus a card, else a phone."""
    if kind in (CARD, PHONE) and _WORD.search(folded(text).lower()):
        numbered = _numbered(folded(text))
        long = len(_digits(numbered)) >= 13 and "+" not in numbered
        order = (CARD, PHONE) if long else (PHONE, CARD)
        return next((k for k in order if plausible(k, text)), None)
    return kind if plausible(kind, text) else None


def worded_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of emails and numbers that are written in words.
    A row of digits that only counts up is none."""
    out = []
    for m in _WORDED_AT.finditer(text):
        low = max(m.start() - AHEAD, 0)
        ahead = _AHEAD.search(text[low:m.start()])
        # A name that begins ahead of the slice is too long for an address.
        if not ahead or (low and not ahead.start() and text[low - 1] in _LOCAL):
            continue
        found = _WORDED_EMAIL.match(text, low + ahead.start())
        if found and found.end() > m.start() and plausible(EMAIL, found.group()):
            out.append((EMAIL, *found.span()))
    for m in _WORDED_NUMBER.finditer(text):
        if _WORD.search(m.group().lower()) and _digits(_numbered(m.group())) not in "0123456789":
            kind = kind_of(PHONE, m.group())
            if kind is not None:
                out.append((kind, *m.span()))
    return out


def windows(text: str) -> list[int]:
    """Starts of the overlapping windows over every stretch that could belong to
    a span: a digit of any script, an @, a worded sign or digit words."""
    text = folded(text)
    starts, reach = [], -1
    for m in _ANCHORS.finditer(text):
        start = max(m.start() - STRIDE, 0, reach)
        end = min(m.end() + STRIDE, len(text))
        while start < end:
            starts.append(start)
            reach = start + STRIDE
            if start + WINDOW >= end:
                break
            start += STRIDE
    return starts


def codes_of(text: str, starts: list[int], width: int = WINDOW) -> np.ndarray:
    out = np.zeros((len(starts), width), np.int64)
    for row, s in zip(out, starts, strict=True):
        found = encode(folded(text[s:s + width]))
        row[:len(found)] = found
    return out


def _is_cut(a: int, b: int, start: int, length: int, text: str) -> bool:
    """Whether a span of a window touches an end with more text behind it."""
    return (a == 0 and start > 0) or (b == length and start + length < len(text))


def cut_stretches(text: str, starts: list[int], tags: np.ndarray,
                  base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Where spans are cut by the ends of all windows that hold them, pieces
    that touch put together. Pieces over a base span cannot be added."""
    whole_ones, pieces = [[] for _ in KINDS], []
    for start, row in zip(starts, tags, strict=True):
        length = min(WINDOW, len(text) - start)
        for kind, a, b in spans_of(row[:length]):
            if _is_cut(a, b, start, length, text):
                pieces.append((start + a, start + b, kind))
            else:
                whole_ones[kind].append((start + a, start + b))

    def ordered(spans):
        spans = sorted(spans)
        return [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

    holding = [ordered(w) for w in whole_ones]
    froms, tos = ordered((a, b) for _, a, b in base)
    out: list[tuple[int, int]] = []
    for a, b, kind in sorted(pieces):
        i = bisect_right(holding[kind][0], a)
        j = bisect_left(froms, b)
        if (i and holding[kind][1][i - 1] >= b) or (j and tos[j - 1] > a):
            continue
        if out and a <= out[-1][1] and b - out[-1][0] <= STRETCH:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def decoded(tagger: Tagger, places: list[tuple[str, int]], width: int = WINDOW) -> np.ndarray:
    """Tags of the windows at (text, start), slice by slice."""
    tags = np.zeros((len(places), width), np.int8)
    step = max(DECODED * WINDOW // width, 1)
    for i in range(0, len(places), step):
        codes = np.concatenate([codes_of(text, [s], width) for text, s in places[i:i + step]])
        tags[i:i + step] = tagger.decode(codes)
    return tags


def extend(tagger: Tagger, stretches: list[tuple[int, str, int, int]]) -> dict[int, dict]:
    """Spans over each stretch (owner, text, start, end) from windows that
    become wider until none of them touches an end; the widest has room for
    more than an address can hold. Per owner the spans with their room."""
    found: dict[int, dict] = {}
    for width in WIDER:
        now = [x for x in stretches if x[3] - x[2] + STRIDE <= width]
        later = [x for x in stretches if x[3] - x[2] + STRIDE > width]
        froms = [max((a + b - width) // 2, 0) for _, _, a, b in now]
        tags = decoded(tagger, [(x[1], s) for x, s in zip(now, froms, strict=True)], width)
        for x, start, row in zip(now, froms, tags, strict=True):
            owner, text, first, last = x
            length = min(width, len(text) - start)
            touches = False
            for kind, a, b in spans_of(row[:length]):
                if start + a >= last or start + b <= first:
                    continue
                if _is_cut(a, b, start, length, text):
                    touches = True
                else:
                    spans = found.setdefault(owner, {})
                    span = (kind, start + a, start + b)
                    spans[span] = max(spans.get(span, 0), min(a, length - b))
            if touches:
                later.append(x)
        stretches = later
    return found


def reconcile(text: str, starts: list[int], tags: np.ndarray,
              base: list[tuple[int, int, int]],
              more: dict[tuple[int, int, int], int] | None = None) -> list[tuple[int, int, int]]:
    """Base spans and what the windows add. A span that touches the end of its
    window is left to the windows that hold more around it. Of two that
    overlap the one further from the ends of its window stands, then the
    longer, then the one ahead; base spans always stand. ``more`` are further
    spans with what counts as their room."""
    found = dict(more or {})
    for start, row in zip(starts, tags, strict=True):
        length = min(WINDOW, len(text) - start)
        for kind, a, b in spans_of(row[:length]):
            span = (kind, start + a, start + b)
            if not _is_cut(a, b, start, length, text):
                margin = min(a, length - b)
                found[span] = max(found.get(span, -1), margin)
    taken = list(base)
    added = [(m, (kind, a, b)) for (tag, a, b), m in found.items()
             if (kind := kind_of(tag, text[a:b])) is not None]
    # Base spans of different kinds may overlap; added ones never do. What is
    # occupied is kept in order and apart, so only the neighbours are asked.
    froms, tos = [], []
    for _, a, b in sorted(base, key=lambda s: s[1:]):
        if tos and a < tos[-1]:
            tos[-1] = max(tos[-1], b)
        else:
            froms.append(a)
            tos.append(b)
    for _, (kind, a, b) in sorted(added, key=lambda x: (-x[0], x[1][1] - x[1][2], x[1][1], x[1][0])):
        i = bisect_left(froms, a)
        if (i == 0 or tos[i - 1] <= a) and (i == len(froms) or b <= froms[i]):
            taken.append((kind, a, b))
            froms.insert(i, a)
            tos.insert(i, b)
    return taken


def written(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end by start, then kind."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])))


# --- training ----------------------------------------------------------------

def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, tags = [], []
        for value in batch.column("text"):
            text = value.as_py()
            starts = windows(text)
            # Windows spread over the text, always from its whole length.
            step = max(len(starts) // SAMPLE_WINDOWS_OF_A_DOC, 1)
            chosen = starts[::step][:SAMPLE_WINDOWS_OF_A_DOC]
            spans = base_spans(text) if chosen else []
            for s, codes in zip(chosen, codes_of(text, chosen), strict=True):
                rows.append(codes.tolist())
                tags.append(tags_of(WINDOW, [(k, a - s, b - s) for k, a, b in spans]).tolist())
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(rows, kind), pa.array(tags, kind)], names=["codes", "tags"])


def labelled_windows(docs: DataFrame, text: str = "text",
                     sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a bounded sample of texts with the base spans as labels.

    The sample is the texts with a digit or @ whose hash is smallest: first
    the hashes alone are ranked, then those texts are read. It holds at most
    ``sample_docs`` times SAMPLE_WINDOWS_OF_A_DOC windows at any size.
    """
    marked = docs.where(F.col(text).rlike("[0-9@]")).select(
        F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    chosen = marked.select("h").distinct().orderBy("h").limit(sample_docs)
    sample = marked.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("text")
    got = sample.mapInArrow(_sample, "codes array<long>, tags array<long>").collect()
    # In an order of their own, whatever task they come from.
    rows = sorted((list(r["codes"]), list(r["tags"])) for r in got)
    return (np.array([r[0] for r in rows], np.int64).reshape(-1, WINDOW),
            np.array([r[1] for r in rows], np.int64).reshape(-1, WINDOW))


_TALK = ("the a of and to in is was for on it with as by be this that from or are at an we you will "
         "call mail write phone tel fax reach contact card number paid with ref host server address "
         "version page room order date see send ask more please now today new old net list").split()


def made_texts(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Short texts with their spans, made from formats: those of the exact
    patterns and others, and much that looks alike and is none."""
    rng = np.random.default_rng(seed)

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def letters(lo, hi):
        return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(lo, hi))))

    def number(k):
        return "".join(str(int(d)) for d in rng.integers(0, 10, k))

    def word():
        return pick(_TALK) if rng.random() < 0.6 else letters(2, 9)

    def name():
        made = letters(2, 9)
        return made.capitalize() if rng.random() < 0.2 else made

    def in_words(digits):
        spoken = {v: k for k, v in _NUMBER.items() if k not in ("oh", "plus")}
        return pick([" ", " ", "-", ", "]).join(spoken[d] for d in digits)

    def card_digits():
        body = number(pick([15, 15, 15, 14, 12]))
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))

    def email():
        worded = rng.random() < 0.3
        at = pick([" at ", " (at) ", "[at]", " [at] ", " AT "]) if worded else pick(
            ["@", "@", "@", " @ ", " @", "@ ", "(@)", " [@] "])
        dot = pick([" dot ", " dot ", "[dot]", " (dot) ", " DOT "]) if worded else pick(
            [".", ".", ".", ".", " . ", "[.]", "(.)", " dot "])
        inner = dot if "dot" in dot.lower() and rng.random() < 0.5 else "."
        local = name() + pick(["", "", inner + letters(2, 7), "_" + letters(2, 5), number(2), "-" + letters(2, 4)])
        host = letters(3, 9) + (dot + letters(3, 8) if rng.random() < 0.25 else "")
        return local + at + host + dot + pick(["com", "org", "net", "edu", "de", "co.uk" if dot == "." else "io"])

    def ip():
        dot = pick([".", ".", ".", "[.]", "[.]", " . ", "(.)", "[dot]"])
        return dot.join(str(int(x)) for x in rng.integers(0, 256, 4))

    def phone():
        a, b, c, sep = number(3), number(3), number(4), pick(["-", ".", " "])
        if rng.random() < 0.15:
            return in_words(pick([a + b + c, "0" + a + c + b]))
        return pick([
            f"+1 ({a}) {b}-{c}", f"+{number(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"+1-{a}-{b}-{c}",
            f"{a}{sep}{b}{sep}{c}", f"{a}{sep}{b}{sep}{c}", f"0{number(2)} {c} {number(4)}", f"0{a} {b} {c}",
            f"+44 {number(2)} {c} {number(4)}", f"1{sep}{pick(['800', '888'])}{sep}{b}{sep}{c}",
            f"00{number(2)} {a} {b}{c}", f"0{a}/{number(7)}"])

    def card():
        digits, sep = card_digits(), pick(["", " ", "-", ".", "."])
        if len(digits) == 15:
            return sep.join([digits[:4], digits[4:10], digits[10:]])
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))

    def clean():
        year, month, day = f"{pick([19, 20])}{number(2)}", f"{int(rng.integers(1, 13)):02d}", f"{int(rng.integers(1, 29)):02d}"
        return pick([
            number(int(rng.integers(1, 9))), f"{year}-{month}-{day}", f"{day}.{month}.{year}", f"{month}/{day}/{year}",
            f"{day}:{month}:{number(2)}", f"{year}-{month}-{day} {day}:{month}", f"v{number(1)}.{number(1)}.{number(2)}",
            f"version {number(1)}.{number(1)}", f"{number(1)},{number(3)}.{number(2)}", f"${number(2)}.{number(2)}",
            f"{year}-{year}", f"{number(2)}.{number(4)}, -{number(1)}.{number(4)}", f"{number(20)}", f"{number(3)}-{number(2)}",
            f"token = \"{number(6)}{letters(4, 9)}{number(9)}\"", f"{letters(3, 6)}{number(5)}{letters(2, 6)}{number(6)}",
            f"look at {letters(3, 8)}.org", f"meet at {number(1)}", "dot the i", f"at {number(2)} or {number(3)}",
            "one two three four five", f"one or two of {number(2)}", f"@{letters(3, 9)}", f"{letters(3, 7)} @ {number(2)} each",
            f"section {number(1)}.{number(1)}.{number(1)}", f"{number(3)} x {number(4)}", f"(see {number(2)}) {number(4)} {number(2)}",
            f"{number(2)}. {letters(3, 8)} {number(2)}. {letters(3, 8)}", f"{number(4)} {number(4)}"])

    makers = {EMAIL: email, IP: ip, CARD: card, PHONE: phone, None: clean}
    out = []
    for _ in range(n):
        kind = pick([EMAIL, EMAIL, IP, CARD, PHONE, PHONE, None, None, None])
        body = makers[kind]()
        ahead = " ".join(word() for _ in range(int(rng.integers(0, 7))))
        ahead += pick([" ", " ", "\n", ", ", ": ", " ("]) if ahead else ""
        behind = " ".join(word() for _ in range(int(rng.integers(0, 9))))
        text = ahead + body + (pick([" ", " ", ". ", ".\n", ", ", "\n", ") "]) if behind else pick(["", "."])) + behind
        out.append((text, [] if kind is None else [(kind, len(ahead), len(ahead) + len(body))]))
    return out


def made_windows(n: int = MADE_WINDOWS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows of made texts, laid as over any text."""
    codes, tags = [], []
    for text, spans in made_texts(n, seed):
        starts = windows(text)
        codes += list(codes_of(text, starts))
        tags += [tags_of(WINDOW, [(k, a - s, b - s) for k, a, b in spans]) for s in starts]
    return np.array(codes, np.int64).reshape(-1, WINDOW), np.array(tags, np.int64).reshape(-1, WINDOW)


def measured(tagger: Tagger, n: int = 2000, seed: int = 1234) -> dict[str, tuple[float, float, int]]:
    """Precision, recall and number of spans of each kind over made texts, for
    all spans and for those beyond the exact patterns, found whole or not at all."""
    given = made_texts(n, seed)
    counts = {k: [0, 0, 0] for k in (*KINDS, "all", "beyond")}
    for (text, spans), (base, found) in zip(
            given, spans_of_texts(tagger, [t for t, _ in given]), strict=True):
        for kind in range(len(KINDS)):
            asked = {s for s in spans if s[0] == kind}
            got = {s for s in found if s[0] == kind}
            hit = len(asked & got)
            for name in (KINDS[kind], "all"):
                for i, v in enumerate((hit, len(got), len(asked))):
                    counts[name][i] += v
            more, held = asked - set(base), got - set(base)
            for i, v in enumerate((len(more & held), len(held), len(more))):
                counts["beyond"][i] += v
    return {k: (hit / max(got, 1), hit / max(asked, 1), asked) for k, (hit, got, asked) in counts.items()}


def train(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS, steps: int = STEPS) -> Tagger:
    """A tagger fitted on a bounded sample of labelled windows of the texts and
    on made ones. Without any text the made ones alone serve."""
    codes, tags = labelled_windows(docs, text, sample_docs)
    more, more_tags = made_windows()
    return Tagger().fit(np.concatenate([codes, more]), np.concatenate([tags, more_tags]), steps)


# --- scanning ----------------------------------------------------------------

def spans_of_texts(tagger: Tagger, texts: list[str]) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of each text; windows of several texts are
    decoded together."""
    waiting: list[tuple[str, list[int], list]] = []
    held = 0

    def beyond(text: str, base: list) -> dict:
        """Added spans that need no tags: those of the exact patterns once wide
        and foreign signs are ASCII, and worded ones."""
        shown = folded(text)
        found = worded_spans(shown)
        if shown != text:
            found += set(base_spans(shown)) - set(base)
        return dict.fromkeys(found, len(text))

    def flush():
        tags = decoded(tagger, [(text, s) for text, starts, _ in waiting for s in starts])
        at, rows, stretches = 0, [], []
        for k, (text, starts, base) in enumerate(waiting):
            own = tags[at:at + len(starts)]
            at += len(starts)
            rows.append(own)
            stretches += [(k, text, a, b) for a, b in cut_stretches(text, starts, own, base)]
        wider = extend(tagger, stretches)
        for k, (text, starts, base) in enumerate(waiting):
            more = {**wider.get(k, {}), **beyond(text, base)}
            yield base, reconcile(text, starts, rows[k], base, more) if starts or more else base
        waiting.clear()

    for text in texts:
        starts = windows(text)
        waiting.append((text, starts, base_spans(text) if starts else []))
        held += len(starts) + 1
        if held >= DECODED * 4:
            yield from flush()
            held = 0
    yield from flush()


_SCHEMA = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
           "found array<struct<kind:string,start:int,end:int>>")


def _scan_batches(weights: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger()
        tagger.p = weights
        found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            counts, shas, joined, found = [[] for _ in KINDS], [], [], []
            texts = (v.as_py() for v in batch.column("text"))
            for base, spans in spans_of_texts(tagger, texts):
                for k in range(len(KINDS)):
                    counts[k].append(sum(s[0] == k for s in base))
                shas.append(hashlib.sha256(written(base).encode()).hexdigest())
                joined.append(written(spans))
                found.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(
                    spans, key=lambda s: (s[1], s[0], s[2]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(shas, pa.string()),
                 pa.array(joined, pa.string()), pa.array(found, found_type)],
                names=["id", *[c.split()[0] for c in _SCHEMA.split(", ")]])

    return run


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       tagger: Tagger | None = None, **training) -> DataFrame:
    """``id``, counts and digest of the exact patterns, and all spans.

    Windows cover every digit, @, worded sign and row of digit words of the whole
    text with room around, are decoded one by one and reconciled over the text; spans that no window holds
    whole are decoded again in wider ones, up to 700 characters long for sure. Null texts are empty and
    hold nothing. Full-width signs and digits of all scripts count as ASCII in
    added spans, and emails and numbers in words are added. Rows are independent; repeated rows give repeated results.
    The weights of the tagger, a few thousand numbers, travel with the tasks.
    """
    tagger = tagger or train(docs, text, **training)
    kind = docs.schema[doc_id].dataType.simpleString()
    listed = docs.select(F.col(doc_id).alias("id"), whole(text).alias("text"))
    return listed.mapInArrow(_scan_batches(tagger.p), f"id {kind}, {_SCHEMA}")

