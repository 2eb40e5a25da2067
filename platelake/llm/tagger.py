"""Character tagger in numpy: bidirectional LSTM with CRF transitions."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
# Tag 0 is outside; kind k begins with 1 + 2k and goes on with 2 + 2k.
TAGS = 1 + 2 * len(KINDS)
NEVER = -1e4

# Characters the tagger tells apart; A-Z count as a-z, other letters and the
# remaining characters as one symbol each. Symbol 0 is beyond the text.
_SHOWN = "abcdefghijklmnopqrstuvwxyz0123456789.@-+()_% \n\t\"'=:/,#*!?;[]{}<>&$|~^`\\"
SYMBOLS = len(_SHOWN) + 3
_CODES = {c: i + 1 for i, c in enumerate(_SHOWN)}
_LETTER, _OTHER = SYMBOLS - 2, SYMBOLS - 1


def encode(text: str) -> list[int]:
    get = _CODES.get
    return [get(c) or get(c.lower()) or (_LETTER if c.isalpha() else _OTHER) for c in text]


def allowed() -> np.ndarray:
    """(from, to) scores: a span goes on only in its own kind."""
    table = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        table[:, inside] = NEVER
        table[[inside - 1, inside], inside] = 0
    return table


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tags of a window; spans are (kind, start, end) and may reach over its ends."""
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        for i in range(max(start, 0), min(end, length)):
            tags[i] = (1 if i == start else 2) + 2 * kind
    return tags


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of a row of tags, cut at the ends of the window."""
    out, start, kind = [], None, None
    for i, t in enumerate([*tags.tolist(), 0]):
        goes_on = t > 0 and t % 2 == 0 and kind == (t - 2) // 2
        if start is not None and not goes_on:
            out.append((kind, start, i))
            start = kind = None
        if t > 0 and start is None:
            start, kind = i, (t - 1) // 2
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)  # of the type of x


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Windows of equal length are handled as one batch, time after time."""

    def __init__(self, embed: int = 12, hidden: int = 16, seed: int = 1, dtype=np.float32):
        rng = np.random.default_rng(seed)

        def table(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.hidden = hidden
        self.p = {"E": rng.normal(0, 0.3, (SYMBOLS, embed)), "O": table(2 * hidden, TAGS),
                  "o": np.zeros(TAGS), "T": np.zeros((TAGS, TAGS)), "S": np.zeros(TAGS)}
        for way in "fb":
            self.p["W" + way] = table(embed + hidden, 4 * hidden)
            bias = np.zeros(4 * hidden)
            bias[hidden:2 * hidden] = 1.0  # remember at first
            self.p["b" + way] = bias
        self.p = {k: v.astype(dtype) for k, v in self.p.items()}

    def _lstm(self, x: np.ndarray, way: str):
        """States of one direction, with what its gradient needs."""
        n, length, _ = x.shape
        size = self.hidden
        weights, bias = self.p["W" + way], self.p["b" + way]
        h, c = np.zeros((n, size), x.dtype), np.zeros((n, size), x.dtype)
        out, kept = np.empty((n, length, size), x.dtype), []
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            joined = np.concatenate([x[:, t], h], 1)
            z = joined @ weights + bias
            i, f, o = (_sigmoid(z[:, k * size:(k + 1) * size]) for k in range(3))
            g = np.tanh(z[:, 3 * size:])
            before, c = c, f * c + i * g
            tanh_c = np.tanh(c)
            h = o * tanh_c
            out[:, t] = h
            kept.append((t, joined, i, f, o, g, before, tanh_c))
        return out, kept

    def _lstm_back(self, grad: np.ndarray, kept, way: str, out: dict) -> np.ndarray:
        size, embed = self.hidden, self.p["E"].shape[1]
        weights = self.p["W" + way]
        n = grad.shape[0]
        dh, dc = np.zeros((n, size)), np.zeros((n, size))
        dx = np.empty((n, grad.shape[1], embed))
        out["W" + way], out["b" + way] = np.zeros_like(weights), np.zeros(4 * size)
        for t, joined, i, f, o, g, before, tanh_c in reversed(kept):
            dh = dh + grad[:, t]
            dc = dc + dh * o * (1 - tanh_c ** 2)
            dz = np.concatenate([
                dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o),
                dc * i * (1 - g ** 2)], 1)
            out["W" + way] += joined.T @ dz
            out["b" + way] += dz.sum(0)
            back = dz @ weights.T
            dx[:, t], dh, dc = back[:, :embed], back[:, embed:], dc * f
        return dx

    def emissions(self, codes: np.ndarray):
        x = self.p["E"][codes]
        (hf, kf), (hb, kb) = self._lstm(x, "f"), self._lstm(x, "b")
        states = np.concatenate([hf, hb], 2)
        return states @ self.p["O"] + self.p["o"], (states, kf, kb)

    def loss(self, codes: np.ndarray, tags: np.ndarray):
        """Mean negative log-likelihood of the tags, and its gradients."""
        n, length = codes.shape
        emitted, (states, kf, kb) = self.emissions(codes)
        moves, first = self.p["T"] + allowed(), self.p["S"]
        alpha = np.empty((n, length, TAGS))
        alpha[:, 0] = first + emitted[:, 0]
        for t in range(1, length):
            alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + moves, 1) + emitted[:, t]
        total = _logsum(alpha[:, -1], 1)
        beta = np.zeros((n, length, TAGS))
        moved = np.zeros((TAGS, TAGS))
        for t in range(length - 2, -1, -1):
            ahead = moves + (emitted[:, t + 1] + beta[:, t + 1])[:, None, :]
            beta[:, t] = _logsum(ahead, 2)
            moved += np.exp(alpha[:, t, :, None] + ahead - total[:, None, None]).sum(0)
        share = np.exp(alpha + beta - total[:, None, None])
        rows, places = np.arange(n)[:, None], np.arange(length)[None]
        gold = emitted[rows, places, tags].sum(1) + first[tags[:, 0]] + moves[
            tags[:, :-1], tags[:, 1:]].sum(1)
        grad = share.copy()
        grad[rows, places, tags] -= 1
        out = {"S": grad[:, 0].sum(0), "T": moved}
        np.subtract.at(out["T"], (tags[:, :-1], tags[:, 1:]), 1)
        flat = grad.reshape(-1, TAGS)
        out["O"], out["o"] = states.reshape(-1, 2 * self.hidden).T @ flat, flat.sum(0)
        into = grad @ self.p["O"].T
        dx = self._lstm_back(into[:, :, :self.hidden], kf, "f", out)
        dx += self._lstm_back(into[:, :, self.hidden:], kb, "b", out)
        out["E"] = np.zeros_like(self.p["E"])
        np.add.at(out["E"], codes, dx)
        return (total - gold).mean(), {k: v / n for k, v in out.items()}

    def fit(self, codes: np.ndarray, tags: np.ndarray, steps: int = 400, batch: int = 64,
            rate: float = 0.03, seed: int = 1) -> Tagger:
        """Adam over random batches; the same data and seed give the same weights."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        spread = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(codes), min(batch, len(codes)))
            _, grads = self.loss(codes[rows], tags[rows])
            now = rate * (1 - (step - 1) / steps)
            for k, g in grads.items():
                g = np.clip(g, -5, 5)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                spread[k] = 0.99 * spread[k] + 0.01 * g * g
                self.p[k] -= now * (mean[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(spread[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tags of each window (Viterbi). Places beyond the text are outside."""
        n, length = codes.shape
        emitted, _ = self.emissions(codes)
        emitted = np.where((codes == 0)[:, :, None] & (np.arange(TAGS) > 0), NEVER, emitted)
        moves = self.p["T"] + allowed()
        best = self.p["S"] + emitted[:, 0]
        came = np.zeros((n, length, TAGS), np.int8)
        for t in range(1, length):
            paths = best[:, :, None] + moves
            came[:, t] = paths.argmax(1)
            best = paths.max(1) + emitted[:, t]
        tags = np.empty((n, length), np.int64)
        tags[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = came[np.arange(n), t, tags[:, t]]
        return tags
