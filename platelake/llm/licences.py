"""Licence scans: matching statistics of texts against a generalised suffix
automaton of licence templates, long matches chained into template spans."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm.notices import HEADS, TEMPLATES
from platelake.llm.text import pieces, whole

# Shortest match that takes part in a chain, in words.
MIN_MATCH = 3
# Words that may stand between two matches of a chain.
MAX_GAP = 12
# Share of a template's words that a chain must cover.
MIN_COVER = 0.8

# The phrases that always count, with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Words that make another licence of the same notice. None may stand in a gap,
# and like the version number a template's own must be matched.
MARKERS = frozenset(w.encode() for w in (
    "lesser", "library", "affero", "noncommercial", "sharealike", "noderivatives", "noderivs"))
# A number behind one of these words is that of a version.
NUMBERED = frozenset(w.encode() for w in (
    "version", "v", "attribution", "noncommercial", "sharealike", "noderivatives", "noderivs"))
# Behind this word every word counts.
IDENTIFIER = b"identifier"
# A notice right behind this word, or a few words on, is none.
DENIAL = b"not"
DENIED_WORDS = 3

# Every byte that is no part of a word becomes a space; A-Z are lower-cased before.
_TO_WORDS = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else 0x20 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.lower().translate(_TO_WORDS).split()


def key_places(words: Sequence[bytes]) -> list[int]:
    """Places of the words that tell a template from its neighbours: markers,
    the numbers of versions but for a zero, and whatever an identifier holds."""
    out, counting, named = [], False, False
    for place, word in enumerate(words):
        counting = word.isdigit() and (counting or (place > 0 and words[place - 1] in NUMBERED))
        if named or word in MARKERS or (counting and word != b"0"):
            out.append(place)
        named = named or word == IDENTIFIER
    return out


class State:
    __slots__ = ("length", "link", "next", "ends", "phrases")

    def __init__(self, length: int, link: int, moves: dict[int, int]):
        self.length, self.link, self.next = length, link, moves
        # (template, last place) of the occurrences of the state's words.
        self.ends: list[tuple[int, int]] = []
        # (phrase, words): phrases that are suffixes of what the state stands for.
        self.phrases: list[tuple[int, int]] = []


class Span(NamedTuple):
    label: str
    start: int
    end: int
    score: float


class Automaton:
    """Generalised suffix automaton of the templates and phrases. Its size
    follows from the templates, which are a parameter, not from any table."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES, heads=()):
        texts = [*phrases, *templates, *heads]
        self.labels = [label for label, _ in texts]
        self.phrase_count = len(phrases)
        self.first_head = len(phrases) + len(templates)
        self.vocabulary: dict[bytes, int] = {}
        self.sizes: list[int] = []
        self.tokens: list[list[int]] = []
        # Per text its places that must be matched, none for phrases.
        self.keys: list[list[int]] = []
        self.states = [State(0, -1, {})]
        for k, (_, text) in enumerate(texts):
            words = words_of(text.encode("utf-8"))
            tokens = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            self.sizes.append(len(tokens))
            self.tokens.append(tokens)
            self.keys.append(key_places(words) if k >= self.phrase_count else [])
            last = 0
            for place, token in enumerate(tokens):
                last = self._add(last, token)
                self.states[last].ends.append((k, place))
        # Markers are known words even where no template has them.
        self.markers = {self.vocabulary.setdefault(w, len(self.vocabulary)) for w in sorted(MARKERS)}
        self.denial = self.vocabulary.setdefault(DENIAL, len(self.vocabulary))
        self.reach = max(self.sizes, default=0)
        self._ending: dict[tuple[int, int | None], list[tuple[int, int, int]]] = {}
        self._close()

    def ending(self, state: int, token: int | None) -> list[tuple[int, int, int]]:
        """(template, last place, longest size) of the occurrences at a state
        and its suffix links that ``token`` does not go on."""
        out = self._ending.get((state, token))
        if out is None:
            out, seen, at = [], set(), state
            while at > 0:
                for k, place in self.states[at].ends:
                    if (k, place) not in seen:
                        seen.add((k, place))
                        words = self.tokens[k]
                        if place + 1 == len(words) or words[place + 1] != token:
                            out.append((k, place, self.states[at].length))
                at = self.states[at].link
            self._ending[state, token] = out
        return out

    def _add(self, last: int, token: int) -> int:
        states = self.states
        known = states[last].next.get(token)
        if known is not None:
            # Another template has these words already.
            if states[known].length == states[last].length + 1:
                return known
            return self._split(last, token, known)
        new = len(states)
        states.append(State(states[last].length + 1, 0, {}))
        p = last
        while p >= 0 and token not in states[p].next:
            states[p].next[token] = new
            p = states[p].link
        if p >= 0:
            q = states[p].next[token]
            fits = states[q].length == states[p].length + 1
            states[new].link = q if fits else self._split(p, token, q)
        return new

    def _split(self, p: int, token: int, q: int) -> int:
        """A copy of q for the shorter strings that end in ``token`` after p."""
        states = self.states
        copy = len(states)
        states.append(State(states[p].length + 1, states[q].link, dict(states[q].next)))
        states[q].link = copy
        while p >= 0 and states[p].next.get(token) == q:
            states[p].next[token] = copy
            p = states[p].link
        return copy

    def _close(self) -> None:
        """Hands ends up and phrases down the suffix links."""
        order = sorted(range(1, len(self.states)), key=lambda i: self.states[i].length)
        for i in reversed(order):
            state = self.states[i]
            if state.link > 0:
                self.states[state.link].ends.extend(state.ends)
        for i in order:
            state = self.states[i]
            state.ends = sorted(set(state.ends))
            shorter = self.states[state.link].length
            state.phrases = list(self.states[state.link].phrases) + [
                (k, self.sizes[k]) for k, place in state.ends
                if k < self.phrase_count and place == self.sizes[k] - 1
                and shorter < self.sizes[k] <= state.length]


class Scan:
    """Matching statistics of one text, fed word by word."""

    def __init__(self, automaton: Automaton, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP,
                 min_cover: float = MIN_COVER):
        self.a = automaton
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        self.n_words = self.n_phrases = 0
        self.first = self.last = None
        self.phrase_labels: set[str] = set()
        self.state = self.length = 0
        self.at = -1
        # Places of the last markers, as far back as a gap may lie.
        self.marked: deque = deque()
        # Places of the last denials, as far back as a match may begin.
        self.denied: deque = deque()
        # Per template the chains that a match could still go on.
        self.open: dict[int, deque] = {}
        self.found: list[tuple] = []

    def feed(self, words: Sequence[bytes]) -> None:
        get = self.a.vocabulary.get
        base = self.n_words
        for i, token in [(i, t) for i, t in enumerate(map(get, words)) if t is not None]:
            self._step(base + i, token)
        self.n_words += len(words)

    def _step(self, place: int, token: int) -> None:
        states = self.a.states
        if place != self.at + 1 and self.length:
            self._match_ends(None)
            self.state = self.length = 0
        if self.length:
            self._match_ends(token)
            while self.state and token not in states[self.state].next:
                self.state = states[self.state].link
                self.length = states[self.state].length
        following = states[self.state].next.get(token)
        self.at = place
        if token in self.a.markers:
            self.marked.append(place)
            while place - self.marked[0] > self.a.reach + self.max_gap + 1:
                self.marked.popleft()
        if token == self.a.denial:
            self.denied.append(place)
            while place - self.denied[0] > self.a.reach + DENIED_WORDS + 1:
                self.denied.popleft()
        if following is None:
            self.state = self.length = 0
            return
        self.state = following
        self.length += 1
        for k, size in states[following].phrases:
            if size <= self.length:
                start = place - size + 1
                self.n_phrases += 1
                self.first = start if self.first is None else min(self.first, start)
                self.last = start if self.last is None else max(self.last, start)
                self.phrase_labels.add(self.a.labels[k])

    def _match_ends(self, token: int | None) -> None:
        """Adds to the chains of each template what matches it up to the last
        word and does not go on with ``token``: the longest match, and shorter
        ones that only end here in another place or template."""
        if self.length < self.min_match:
            return
        for k, place, longest in self.a.ending(self.state, token):
            size = min(longest, self.length)
            if size >= self.min_match:
                self._chain(k, place, size)

    def _chain(self, k: int, place: int, size: int) -> None:
        """Lets the ``size`` words that end here and at ``place`` of template
        ``k`` go on the best of its chains, or begin one.

        A chain holds every key of the template up to where it has come, and
        its gaps hold no marker. Words in its gaps lower the score: it is what
        is covered, over the template and the gaps.
        """
        start, begin = self.at - size + 1, place - size + 1
        keys = self.a.keys[k]
        chains = self.open.setdefault(k, deque())
        while chains and self.at - self.a.sizes[k] - chains[0][0] > self.max_gap + 1:
            chains.popleft()
        # Value, first word, words covered, words in gaps.
        best = (size, -start, size, 0) if not keys or begin <= keys[0] else None
        if any(start - DENIED_WORDS <= place_ < start for place_ in self.denied):
            best = None
        for end, template_end, covered, gaps, first in chains:
            # Words shared by both matches count once.
            shared = max(end - start + 1, template_end - begin + 1, 0)
            if not (shared < size and end < self.at and template_end < place) or (
                    start - end > self.max_gap + 1):
                continue
            if any(template_end < key < begin + shared for key in keys) or any(
                    end < mark < start + shared for mark in self.marked):
                continue
            total, skipped = covered + size - shared, gaps + start + shared - end - 1
            value = (total - self.min_cover * skipped, -first, total, skipped)
            best = value if best is None else max(best, value)
        if best is None:
            return
        _, first, covered, gaps = best
        chains.append((self.at, place, covered, gaps, -first))
        score = covered / (self.a.sizes[k] + gaps)
        if score >= self.min_cover and (not keys or place >= keys[-1]):
            self.found.append((-first, self.at, k, min(score, 1.0)))

    def spans(self) -> list[Span]:
        """Template spans that do not overlap: whole texts and notices stand
        before heads, then the better covered of two, then the longer, then the
        one further ahead."""
        self._match_ends(None)
        self.state = self.length = 0
        out: list[Span] = []
        group: list[tuple] = []
        reach = -1
        for item in sorted(set(self.found)):
            if group and item[0] > reach:
                out += self._pick(group)
                group = []
            group.append(item)
            reach = max(reach, item[1]) if len(group) > 1 else item[1]
        return out + self._pick(group)

    def _pick(self, group: list[tuple]) -> list[Span]:
        taken: list[Span] = []
        head = self.a.first_head
        for first, end, k, score in sorted(
                group, key=lambda g: (g[2] >= head, -g[3], g[0] - g[1], g[0], g[2])):
            if all(end < s.start or first >= s.end for s in taken):
                taken.append(Span(self.a.labels[k], first, end + 1, score))
        return sorted(taken, key=lambda s: s.start)


_SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, spans array<struct<label:string,start:long,end:long,"
           "score:double>>")
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
          pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                              ("score", pa.float64())])))


def scan_text(automaton: Automaton, data: bytes, **options) -> tuple:
    """The columns of one text, read piece by piece."""
    scan = Scan(automaton, **options)
    for piece in pieces(data):
        scan.feed(words_of(piece))
    spans = scan.spans()
    labels = {s.label for s in spans} | scan.phrase_labels
    score = max((s.score for s in spans), default=0.0)
    if scan.phrase_labels:
        score = 1.0
    return (scan.n_words, scan.n_phrases, scan.first, scan.last,
            ",".join(sorted(scan.phrase_labels)), ",".join(sorted(labels)), score,
            [s._asdict() for s in spans])


def _scan_batches(phrases, templates, heads, options):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        for batch in batches:
            automaton = automaton or Automaton(phrases, templates, heads)
            rows = [scan_text(automaton, x.as_py(), **options) for x in batch.column("data")]
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]],
                names=["id", *names])

    return run


def scan_licences(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases=PHRASES,
    templates=TEMPLATES, heads=HEADS, **options,
) -> DataFrame:
    """``id`` and what was found in each text.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are about the
    phrases: places, smallest and largest start (words from 0, null if none)
    and labels. ``spans`` are the covered template spans, ``labels`` the
    labels of both, ``score`` the best cover. ``heads`` are openings and clauses
    that count where no whole template is. A notice within three words of a
    "not" ahead of it is none. Null texts are empty and have no
    words. Rows are independent; repeated rows give repeated results.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    listed = docs.select(F.col(doc_id).alias("id"), whole(text).cast("binary").alias("data"))
    return listed.mapInArrow(
        _scan_batches(tuple(phrases), tuple(templates), tuple(heads), options), f"id {kind}, {_SCHEMA}")
