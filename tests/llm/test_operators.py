"""The operators against brute force on small tables."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from platelake.llm import (
    bpe, components, decontaminate, licences, lines, notices, pii, pitman_yor, quality, simhash, tagger, urls, warc,
)
from platelake.llm import text as texts

SOURCE = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SOURCE}/documents.parquet").select("doc_id", "text")


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- text --------------------------------------------------------------------

def test_pieces_keep_words():
    data = b"  one two\x0bthree " * 50 + b"x" * 300 + b"\ny"
    for size in (1, 7, 64, 10_000):
        cut = list(texts.pieces(data, size))
        assert b"".join(cut) == data
        assert [w for p in cut for w in p.split()] == data.split()


# --- 1 -----------------------------------------------------------------------

def test_scores_base_and_model(spark):
    docs = documents(spark)
    got = {r.id: r for r in pitman_yor.score_documents(docs).collect()}
    rows = docs.collect()
    out = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows}
    tokens = {r.doc_id: (r.text or "").encode().lower().split() + [b" "] for r in rows}
    counts = Counter(w for k, ws in tokens.items() if not out[k] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for k, ws in tokens.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[k], len(ws), n)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [k for k in tokens if out[k]]
    assert sum(got[k].score for k in held) > sum(got[k].base_score for k in held)
    # What a word follows tells more than half a digit a token here.
    gain = sum(got[k].score - got[k].base_score for k in held) / sum(got[k].n_tokens for k in held)
    assert gain > 0.5


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    docs = documents(spark).limit(80)
    one = {r.id: r.score for r in pitman_yor.score_documents(docs.coalesce(1)).collect()}
    monkeypatch.setattr(pitman_yor, "BLOCK_TOKENS", 700)
    many = {r.id: r.score for r in pitman_yor.score_documents(docs.repartition(5)).collect()}
    assert one.keys() == many.keys()
    assert all(math.isclose(one[k], many[k], rel_tol=1e-9) for k in one)


def exact_tables(count, mass, gain, later, slope, discount):
    """Chances of 1, 2, ... tables by adding up all ways to seat the customers."""
    ways = np.zeros(count + 1)
    ways[0] = 1.0
    for i in range(count):
        t = np.arange(1, count + 1)
        ways = np.concatenate([[0.0], ways[:-1] + ways[1:] * np.maximum(i - discount * t, 0)])
        ways /= ways.max()
    k = np.arange(1, count)
    weights = ways[1:] * np.concatenate([[1.0], np.cumprod((mass + gain * k) * (later + slope * k))])
    return weights / weights.sum()


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 12, 60])
def test_tables_follow_their_exact_law(count):
    rng = np.random.default_rng(count)
    for mass, gain, later, slope in ((0.1, 0.9, 1.0, 0.0), (0.5, 0.05, 0.7, 0.0), (2.0, 0.6, 0.1, 0.05)):
        for discount in (0.3, 0.9):
            exact = exact_tables(count, mass, gain, later, slope, discount)
            n = 20_000
            got = pitman_yor.seat(
                np.full(n, count), np.full(n, mass), gain, np.full(n, later), slope, discount,
                rng.integers(0, 2 ** 63, n).astype(np.uint64), 3)
            seen = np.bincount(got.astype(int), minlength=count + 1)[1:] / n
            assert np.abs(seen - exact).max() < 5 * math.sqrt(0.25 / n)


@pytest.mark.parametrize("count, mass, gain, later, slope, discount", [
    (700, 1.0, 0.8, 0.05, 0.001, 0.8), (2000, 30.0, 0.7, 0.02, 0.0001, 0.7),
    (1500, 400.0, 0.8, 0.05, 0.0001, 0.8), (900, 1.5, 0.5, 1e-5, 0.0, 0.5)])
def test_tables_beyond_the_lattice(count, mass, gain, later, slope, discount):
    t = np.arange(1, count + 1)
    logs = np.full(count + 1, -np.inf)
    logs[0] = 0.0
    for i in range(count):
        joined = logs[1:] + np.log(np.maximum(i - discount * t, 1e-300))
        logs = np.concatenate([[-np.inf], np.logaddexp(logs[:-1], joined)])
    k = np.arange(1, count)
    logs = logs[1:] + np.concatenate([[0.0], np.cumsum(np.log((mass + gain * k) * (later + slope * k)))])
    exact = np.exp(logs - logs.max())
    exact /= exact.sum()
    mean, n = (exact * t).sum(), 2000
    spread = math.sqrt((exact * t * t).sum() - mean * mean)
    rng = np.random.default_rng(count)
    got = pitman_yor.seat(
        np.full(n, count), np.full(n, mass), gain, np.full(n, later), slope, discount,
        rng.integers(0, 2 ** 63, n).astype(np.uint64), 3)
    assert abs(got.mean() - mean) < 0.02 * mean + 5 * spread / math.sqrt(n)
    assert abs(got.std() - spread) < 0.1 * spread + 0.05


def test_messages_hold_their_numbers():
    rng = np.random.default_rng(0)
    for top in (0, 1, 255, 256, 1 << 40, (1 << 64) - 1):
        for n in (0, 1, 1000):
            values = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
            assert np.array_equal(pitman_yor.unpacked(pitman_yor.packed(values)), values)
            values.sort()
            assert np.array_equal(pitman_yor.unpacked_steps(pitman_yor.packed_steps(values)), values)
    floats = rng.standard_normal(50).astype(np.float32)
    assert np.array_equal(pitman_yor.unpacked_floats(pitman_yor.packed_floats(floats)), floats)


class Passed:
    """The model's tasks with their messages carried by hand."""

    def __init__(self, texts, parts, hot=()):
        places = {pitman_yor.END: 0}
        tokens = [places.setdefault(w, len(places)) for text in texts for w in [*text, pitman_yor.END]]
        self.block = pitman_yor.Block({
            "block": 0, "words": pitman_yor.packed(np.array([xxhash.xxh64_intdigest(w) for w in places], np.uint64)),
            "tokens": pitman_yor.packed(np.array(tokens)), "ids": list(range(len(texts))),
            "held": [False] * len(texts), "lengths": [len(t) + 1 for t in texts]})
        self.row = pa.table({
            "block": [0], "words": pa.array([pitman_yor.packed(self.block.words)], pa.binary()),
            "tokens": pa.array([pitman_yor.packed(np.array(tokens))], pa.binary()),
            "ids": [self.block.ids], "held": [[False] * len(texts)], "lengths": [list(map(int, self.block.lengths))]})
        self.parts, self.places = parts, places
        first = pa.Table.from_batches(pitman_yor._block_words(parts)(iter(self.row.to_batches())))
        words = self.each(first, pitman_yor._count_words)
        self.counts, self.answers = (self.of(words, k) for k in (pitman_yor.COUNTS, pitman_yor.PLACES))
        self.numbers = self.block.numbers(parts, pitman_yor._rows(self.answers, pitman_yor.PLACES))
        bound = (int(self.numbers.max()) // parts + 1) * parts
        self.deal = pitman_yor.Deal(parts, bound, np.sort(self.numbers[[places[h] for h in hot]]))
        pairs = pitman_yor._block_pairs(parts, self.deal)(self.row, self.answers)
        self.pairs = self.each(pairs, pitman_yor._count_pairs(parts, self.deal))

    @staticmethod
    def of(table, *kinds):
        return table.filter(pa.compute.is_in(table["kind"], pa.array(kinds, pa.int32())))

    @staticmethod
    def each(table, function):
        groups = sorted(set(table["target"].to_pylist()))
        return pa.concat_tables([
            function(table.filter(pa.compute.equal(table["target"], g))) for g in groups])

    def hot(self, table):
        out = np.zeros((3, len(self.deal.hot)))
        for r in self.of(table, pitman_yor.HOT).to_pylist():
            out[:, np.searchsorted(self.deal.hot, np.uint64(r["target"]))] += r["stats"]
        return out

    def sums(self, table, kind):
        return np.sum([r["stats"] for r in self.of(table, kind).to_pylist()], axis=0)

    def seated(self, burn_in, samples, discounts, strength=1.0):
        """Averaged probabilities of every word in every context."""
        lists = self.of(self.pairs, pitman_yor.LISTS)
        root = self.each(pa.concat_tables([self.counts, lists]), pitman_yor._seat_words(None, 0, False))
        n = len(self.block.tokens)
        customers, tables = self.sums(root, pitman_yor.ROOT)[:2]
        hot = self.hot(self.pairs)
        totals = pitman_yor.Totals(len(self.places), n, *discounts, strength, customers, tables, hot[0], hot[1])
        seated = self.of(self.pairs, pitman_yor.TABLES)
        for step in range(1, burn_in + samples + 1):
            sample = step > burn_in
            answers = pa.concat_tables([self.of(root, pitman_yor.SEEN), self.of(seated, pitman_yor.TABLES)])
            run = pitman_yor._seat_pairs(self.parts, self.deal, totals, step, sample)
            seated = pa.concat_tables([
                run(self.at(self.of(self.pairs, pitman_yor.PAIRS), g), self.at(answers, g))
                for g in sorted(set(self.of(self.pairs, pitman_yor.PAIRS)["target"].to_pylist()))])
            totals = totals._replace(hot_tables=self.hot(seated)[1])
            told = pa.concat_tables([self.counts, lists, self.of(seated, pitman_yor.SUMS), self.of(root, pitman_yor.ROOT)])
            root = self.each(told, pitman_yor._seat_words(totals, step, sample))
            customers, tables, _, _, *added = self.sums(root, pitman_yor.ROOT)
            totals = totals._replace(customers=customers, tables=tables)
        asked = pa.table({**{c: self.answers[c] for c in self.answers.column_names},
                          "target": self.answers["source"], "source": self.answers["target"]}).select(
                              self.answers.column_names)
        known = self.each(pa.concat_tables([self.counts, self.of(root, pitman_yor.ROOT), asked]),
                          pitman_yor._root_answers((totals, samples, tuple(added))))
        kept = pa.concat_tables([
            pitman_yor._pair_answers((self.deal, totals, samples, self.hot(seated)[2] / samples))(
                self.at(self.of(self.pairs, pitman_yor.PAIRS, pitman_yor.MEMBERS), g), self.at(seated, g))
            for g in sorted(set(self.of(self.pairs, pitman_yor.PAIRS)["target"].to_pylist()))])
        words = {v: k for k, v in self.places.items()}
        number = {int(x): words[i] for i, x in enumerate(self.numbers)}
        order, segments = self.block.word_order(self.parts)
        root_p = {}
        for r in pitman_yor._rows(known, pitman_yor.KNOWN):
            a, b = next((a, b) for part, a, b in segments if part == r["source"])
            for i, p in zip(order[a:b], pitman_yor.unpacked_floats(r["a"])):
                root_p[words[int(i)]] = p
        u, w, segments, _ = self.block.pairs(self.numbers, self.deal)
        kept_p, back = {}, {}
        for r in pitman_yor._rows(kept, pitman_yor.KEPT):
            a, b = next((a, b) for part, a, b in segments if part == r["source"])
            each = np.repeat(pitman_yor.unpacked_floats(r["b"]), pitman_yor.unpacked(r["c"]).astype(int))
            for x, y, p, rest in zip(u[a:b], w[a:b], pitman_yor.unpacked_floats(r["a"]), each):
                kept_p[number[int(x)], number[int(y)]] = p
                back[number[int(x)]] = rest
        return root_p, kept_p, back

    @staticmethod
    def at(table, group):
        return table.filter(pa.compute.equal(table["target"], group))


def seated_one_by_one(texts, discounts, strength, sweeps, burn_in, seed):
    """The restaurants with every customer and table, each customer leaving and
    coming back in turn; averaged probabilities of all pairs of words."""
    rng = random.Random(seed)
    end = pitman_yor.END
    pairs = [(a, b) for t in texts for a, b in zip([end, *t], [*t, end])]
    words = sorted({w for p in pairs for w in p})
    base, (d0, d1) = 1 / (len(words) + 1), discounts
    rooms = {u: defaultdict(list) for u in words}
    root = defaultdict(list)

    def root_p(w):
        tables, customers = sum(map(len, root.values())), sum(map(sum, root.values()))
        return (sum(root[w]) - d0 * len(root[w]) + (strength + d0 * tables) * base) / (strength + customers)

    def sit(tables, discount, fresh):
        at = rng.choices(range(len(tables) + 1), [*(c - discount for c in tables), fresh])[0]
        if at == len(tables):
            tables.append(0)
        tables[at] += 1
        return tables[at] == 1

    def leave(tables):
        at = rng.choices(range(len(tables)), tables)[0]
        tables[at] -= 1
        if not tables[at]:
            tables.pop(at)
            return True
        return False

    def come(u, w):
        own = sum(map(len, rooms[u].values()))
        if sit(rooms[u][w], d1, (strength + d1 * own) * root_p(w)):
            sit(root[w], d0, (strength + d0 * sum(map(len, root.values()))) * base)

    for u, w in pairs:
        come(u, w)
    total = defaultdict(float)
    for k in range(burn_in + sweeps):
        for u, w in pairs:
            if leave(rooms[u][w]):
                leave(root[w])
            come(u, w)
        if k >= burn_in:
            ahead = {w: root_p(w) for w in words}
            for u in words:
                n = sum(map(sum, rooms[u].values()))
                t = sum(map(len, rooms[u].values()))
                for w in words:
                    c = rooms[u].get(w, [])
                    total[u, w] += (sum(c) - d1 * len(c) + (strength + d1 * t) * ahead[w]) / (strength + n) / sweeps
    return total


@pytest.mark.parametrize("parts, hot", [(1, ()), (3, (b"a", b"the")), (7, (pitman_yor.END,))])
def test_model_against_seating_one_by_one(parts, hot):
    rng = random.Random(4)
    words = [b"the", b"a", b"cat", b"dog", b"sat", b"ran", b"on", b"mat"]
    follow = {w: rng.choices(words, k=2) for w in words}
    texts = []
    for _ in range(16):
        text = [rng.choice(words)]
        while len(text) < 9:
            text.append(rng.choice(follow[text[-1]]) if rng.random() < 0.7 else rng.choice(words))
        texts.append(text)
    texts.append([b"rare", b"rare", b"the"])
    discounts = (0.4, 0.6)
    expected = seated_one_by_one(texts, discounts, 1.0, 400, 30, seed=1)
    root, kept, back = Passed(texts, parts, hot).seated(15, 120, discounts)
    got = {(u, w): kept.get((u, w), 0.0) + back[u] * root[w] for u, w in expected}
    # Words, contexts and one unknown word: each distribution sums to one.
    rest = 1 - sum(root.values())
    assert 0 < rest < 0.1
    for u in back:
        assert math.isclose(sum(got[u, w] for w in root) + back[u] * rest, 1, rel_tol=1e-5)
    error = [math.log10(got[k] / expected[k]) for k in expected]
    assert abs(np.mean(error)) < 0.02 and np.abs(error).max() < 0.25 and np.std(error) < 0.06


def test_hot_word_and_empty_training(spark):
    hot = frame(spark, [(i, "the " * 300 + f"word{i}") for i in range(40)])
    assert all(r.score < 0 and np.isfinite(r.score) for r in pitman_yor.score_documents(hot).collect())
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    (row,) = pitman_yor.score_documents(frame(spark, [(held, "a b")])).collect()
    assert (row.train_tokens, row.n_known, row.base_score, row.score) == (0, 0, 0.0, 0.0)


# --- 2 -----------------------------------------------------------------------

def repeated_words(words):
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    return len({q for places in windows.values() if len(places) > 1 for p in places for q in range(p, p + 5)})


def test_repeated_words(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    got = {r.row.doc_id: r.n_repeat_words for r in quality.measure(frame(spark, rows)).collect()}
    assert got == {i: repeated_words(t.split()) for i, t in rows}


def test_policies_and_ablations(spark):
    led = quality.ledger(documents(spark)).cache()
    bits = [r.fail_bits for r in led.select("fail_bits").collect()]
    for version, rules in quality.POLICIES.items():
        kept = quality.apply_policies(led).where(f"kept_{version}").count()
        assert kept == sum(b & quality.mask(rules) == 0 for b in bits)
    for rules in (quality.RULES, quality.BASE_RULES):
        whole = quality.mask(rules)
        for r in quality.ablations(led, rules).collect():
            bit = quality.mask([r.rule])
            failed = [b & whole for b in bits if b & bit]
            assert r.n_failed == len(failed) and r.n_only == sum(b == bit for b in failed)
            assert r.n_kept_without == sum(b & whole & ~bit == 0 for b in bits)
            if failed:
                assert r.bits_ever == int(np.bitwise_or.reduce(failed))
                assert r.bits_always == int(np.bitwise_and.reduce(failed))
    assert quality.ablations(quality.ledger(documents(spark).limit(0))).count() == len(quality.RULES)


def test_labelled_documents(spark):
    kept = quality.keep(spark.read.parquet(f"{SOURCE}/documents.parquet")).select("doc_id")
    labels = spark.read.parquet(f"{SOURCE}/labels.parquet")
    joined = labels.join(kept.withColumn("kept", F.lit(True)), "doc_id", "left").na.fill(False)
    shares = {r.quality: r.share for r in joined.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.95 and shares[0] < 0.05


def test_native_operators_run_no_python(spark):
    docs = documents(spark)
    benchmark = spark.read.parquet(f"{SOURCE}/benchmark.parquet")
    for df in (quality.keep(docs), decontaminate.annotate(docs, benchmark),
               decontaminate.cut_spans(docs, benchmark)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


# --- 3 -----------------------------------------------------------------------

def test_licences_against_brute_force():
    automaton = licences.Automaton()
    rng = random.Random(1)
    vocabulary = [w.decode() for w in automaton.vocabulary]

    def brute(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        hits = [(i, label) for label, phrase in licences.PHRASES for p in [phrase.split()]
                for i in range(len(words)) if words[i:i + len(p)] == p]
        starts = [i for i, _ in hits]
        return (len(words), len(hits), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({x for _, x in hits})))

    for _ in range(800):
        parts = []
        for _ in range(rng.randint(0, 12)):
            kind = rng.random()
            if kind < 0.3:
                parts.append(rng.choice(licences.PHRASES)[1])
            elif kind < 0.5:
                words = licences.words_of(rng.choice(licences.TEMPLATES)[1].encode())
                i = rng.randrange(len(words))
                parts.append(b" ".join(words[i:i + rng.randint(1, 9)]).decode())
            else:
                parts.append(rng.choice([rng.choice(vocabulary), "zz", "É", "MIT", "ünder"]))
        text = rng.choice([" ", ", ", "\n"]).join(parts)
        assert licences.scan_text(automaton, text.encode())[:5] == brute(text)


def test_matching_statistics():
    """The longest match that ends at each word, against all substrings."""
    automaton = licences.Automaton((), licences.TEMPLATES[:5])
    known = [licences.words_of(t.encode()) for _, t in licences.TEMPLATES[:5]]
    inside = {tuple(w[i:j]) for w in known for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    rng = random.Random(4)
    for _ in range(60):
        words = []
        while len(words) < 40:
            w = rng.choice(known)
            i = rng.randrange(len(w))
            words += w[i:i + rng.randint(1, 8)]
        scan = licences.Scan(automaton)
        for i, word in enumerate(words):
            scan._step(i, automaton.vocabulary[word])
            longest = max(n for n in range(i + 2) if n == 0 or tuple(words[i + 1 - n:i + 1]) in inside)
            assert scan.length == longest


@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("under the terms of the GNU General Public License as we published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version", "gpl-3"),
    ("the license of the software is here", ""),
])
def test_licence_labels(text, labels):
    assert licences.scan_text(licences.Automaton(), text.encode())[5] == labels


_GNU = "licensed under the GNU {}General Public License, version {}"
_LATER = ("under the terms of the GNU {}General Public License as published by the Free Software Foundation, "
          "either version {} of the License, or (at your option) any later version")
_CC = "licensed under a Creative Commons Attribution{} 4.0 International License"
_NEAR = [
    *[(form.format(name, version), label) for form in (_GNU, _LATER) for name, version, label in (
        ("", "2", "gpl-2"), ("", "3", "gpl-3"), ("Lesser ", "3", "lgpl-3"), ("Lesser ", "2.1", "lgpl-2.1"),
        ("Library ", "2", "lgpl-2"), ("Affero ", "3", "agpl-3"), ("", "1", ""), ("Affero ", "1", ""))],
    *[(_CC.format(name), label) for name, label in (
        ("", "cc-by"), ("-ShareAlike", "cc-by-sa"), ("-NoDerivatives", "cc-by-nd"), ("-NonCommercial", "cc-by-nc"),
        ("-NonCommercial-ShareAlike", "cc-by-nc-sa"), ("-NonCommercial-NoDerivatives", "cc-by-nc-nd"),
        ("-NoDerivs", ""))],
    ("Licensed under the Apache License, Version 1.1", ""),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1", ""),
]


@pytest.mark.parametrize("text, label", _NEAR)
def test_near_licences_are_told_apart(text, label):
    automaton = licences.Automaton()
    found = licences.scan_text(automaton, text.encode())
    assert (found[5], found[6]) == (label, 1.0 if label else 0.0)
    for other, other_label in _NEAR:
        both = licences.scan_text(automaton, f"{text}. {'word ' * 20} {other}.".encode())
        assert both[5] == ",".join(sorted({label, other_label} - {""}))


def whole_labels(text):
    automaton = licences.Automaton(licences.PHRASES, licences.TEMPLATES, licences.HEADS)
    return licences.scan_text(automaton, text.encode())[5]


@pytest.mark.parametrize("label, text", notices.WHOLE, ids=[label for label, _ in notices.WHOLE])
def test_whole_licences_are_told_apart(label, text):
    assert whole_labels(f"Copyright (c) 2020 Jane Doe. {text} And so on.") == label
    # As in the head of a source file, and without its last tenth.
    lines = [f" * {text[i:i + 70]}" for i in range(0, len(text), 70)]
    assert whole_labels("/*\n" + "\n".join(f" * {x}" for x in textwrap.wrap(text, 70)) + "\n */ int x;") == label
    assert len(lines) < 3 or label in whole_labels(text[:len(text) * 19 // 20])


@pytest.mark.parametrize("text, labels", [
    (notices.HEADS[2][1] + ".", "isc-or-0bsd"),
    (notices.HEADS[0][1] + " and nothing else", "mit"),
    ("Neither the name of the Foo Project nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission.", "bsd-3"),
    ("This is not licensed under the GNU General Public License, version 3", ""),
    ("It shall not be licensed under the Apache License, Version 2.0", "apache-2"),  # the phrase counts
    ("This was not known. It is licensed under the GNU General Public License, version 3", "gpl-3"),
    ("licensed under a Creative Commons Attribution 3.0 Unported License", "cc-by-3.0"),
    ("licensed under a Creative Commons Attribution-ShareAlike 2.0 License", "cc-by-sa-2.0"),
    ("released under GPL v3 or later, see COPYING", "gpl-3"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3"), ("SPDX-License-Identifier: MIT-0", "mit-0"),
    ("SPDX-License-Identifier: BSD-4-Clause", "bsd-4"), ("SPDX-License-Identifier: WTFPL", ""),
    ("SPDX-License-Identifier: GPL-1.0", ""), ("SPDX-License-Identifier: 0BSD", "0bsd"),
])
def test_notices_heads_and_denials(text, labels):
    assert whole_labels(text) == labels


def test_planted_notices_are_found():
    """Notices among other words, one word in forty of theirs changed."""
    rng = random.Random(11)
    automaton = licences.Automaton(licences.PHRASES, licences.TEMPLATES, licences.HEADS)
    found = wrong = total = 0
    for label, text in notices.TEMPLATES * 3:
        words = text.split()
        keys = set(licences.key_places(licences.words_of(text.encode())))
        if len(licences.words_of(text.encode())) == len(words):
            words = [w if i in keys or rng.random() > 0.025 else "other" for i, w in enumerate(words)]
        elif len(words) > 60:
            words = [w if rng.random() > 0.025 else "other" for w in words]
        around = [" ".join(rng.choice(["code", "of", "the", "file", "see", "this", "work"]) for _ in range(30))
                  for _ in range(2)]
        labels = set(licences.scan_text(automaton, f"{around[0]} {' '.join(words)} {around[1]}".encode())[5].split(","))
        total += 1
        found += label in labels
        wrong += bool(labels - {label, ""} - {"cc-by-nc", "apache-2"})
    assert found / total > 0.95 and wrong / total < 0.03


def test_words_in_gaps_lower_the_score():
    text = "licensed under a fine Creative Commons Attribution 4.0 International License"
    found = licences.scan_text(licences.Automaton(), text.encode())
    size = len(licences.words_of(_CC.format("").encode()))
    assert found[5] == "cc-by" and math.isclose(found[6], size / (size + 1))
    text = text.replace("fine", "very very very very very fine")
    assert licences.scan_text(licences.Automaton(), text.encode())[5] == ""


def test_templates_inside_longer_matches():
    automaton = licences.Automaton()
    text = 'Licensed under the Apache License, Version 2.0 (the "License") is what it says'
    assert licences.scan_text(automaton, text.encode())[7] == [
        {"label": "apache-2", "start": 0, "end": 8, "score": 1.0}]
    # A suffix of what matches the one template begins the other.
    nested = licences.Automaton((), (("long", "a b c d e f g h"), ("inner", "c d e f"), ("tail", "e f g x y z")))
    spans = licences.scan_text(nested, b"a b c d e f g x y z")[7]
    assert [(s["label"], s["start"], s["end"]) for s in spans] == [("tail", 4, 10)]
    assert [s["label"] for s in licences.scan_text(nested, b"b c d e f g")[7]] == ["inner"]


def test_matches_of_every_template():
    """What is chained, against every longest run of words shared with a template."""
    automaton = licences.Automaton()
    rng = random.Random(8)
    known = [licences.words_of(t.encode()) for _, t in licences.TEMPLATES]
    for _ in range(40):
        words = []
        while len(words) < 40:
            w = rng.choice(known)
            i = rng.randrange(len(w))
            words += w[i:i + rng.randint(1, 12)]
        expected = set()
        for k, w in enumerate(known):
            for i in range(len(words)):
                for j in range(len(w)):
                    n = 0
                    while n <= min(i, j) and words[i - n] == w[j - n]:
                        n += 1
                    goes_on = i + 1 < len(words) and j + 1 < len(w) and words[i + 1] == w[j + 1]
                    if n >= licences.MIN_MATCH and not goes_on:
                        expected.add((k + len(licences.PHRASES), i, j, n))
        got = set()
        scan = licences.Scan(automaton)
        scan._chain = lambda k, place, size: got.add((k, scan.at, place, size))
        scan.feed(words)
        scan.spans()
        assert {g for g in got if g[0] >= len(licences.PHRASES)} == expected


# --- 4 -----------------------------------------------------------------------

def simhash_of(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
    if words and not shingles:
        shingles = [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=2):
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = list(prints)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if bin(prints[i] ^ prints[j]).count("1") <= max_bits:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def test_fingerprints_of_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "pieces", lambda data: texts.pieces(data, 5))
    for text in ("", "a", "a b", "a b c", "One two\nthree four five  six seven", "É à ç " * 9):
        assert simhash.fingerprint(text.encode()) == simhash_of(text)


def test_simhash_groups(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    prints = {r.doc_id: simhash_of(r.text) for r in documents(spark).collect()}
    assert {r.id: r.fingerprint % 2 ** 64 for r in got} == prints
    assert {r.id: r.component_id for r in got} == brute_components(prints)


@pytest.mark.parametrize("tile", [4, 10_000])
def test_links_lose_none(spark, tile):
    rng = random.Random(8)
    values = set()
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            value ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            values.add(value)
    signed = {v: v - 2 ** 64 if v >> 63 else v for v in values}
    table = spark.createDataFrame([(s,) for s in signed.values()], "fingerprint long")
    edges = simhash.links(table, tile=tile).collect()
    back = {s: v for v, s in signed.items()}
    assert all(bin(back[e.a] ^ back[e.b]).count("1") <= 2 for e in edges)
    found = {r.node: r.component for r in components.components(simhash.links(table, tile=tile)).collect()}
    expected = defaultdict(set)
    for v, root in brute_components({v: v for v in values}).items():
        expected[root].add(v)
    grouped = defaultdict(set)
    for v, s in signed.items():
        grouped[found.get(s, s)].add(v)
    assert sorted(map(sorted, grouped.values())) == sorted(map(sorted, expected.values()))


def test_bit_planes():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 1, np.uint64)
    members = np.unique(base ^ (np.uint64(1) << rng.integers(0, 12, 200).astype(np.uint64))
                        ^ (np.uint64(1) << rng.integers(0, 12, 200).astype(np.uint64))
                        ^ (np.uint64(1) << rng.integers(0, 12, 200).astype(np.uint64)))
    values, everyone = members.tolist(), (1 << len(members)) - 1
    planes = [sum(1 << i for i, v in enumerate(values) if v >> b & 1) for b in range(64)]
    for radius in (0, 1, 2, 3, 5):
        for q in values[:20]:
            got = simhash._near(planes, q, list(range(64)), radius, everyone)
            assert got == sum(1 << i for i, v in enumerate(values) if bin(v ^ q).count("1") <= radius)


def test_one_of_each_group_stays(spark):
    text = "one two three four five six seven"
    rows = [(3, text), (1, text.upper()), (None, text), (2, "other words here"), (None, "nobody knows me"), (2, "other words here")]
    kept = simhash.keep_one(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted(
        [(1, text.upper()), (2, "other words here"), (2, "other words here"), (0, "nobody knows me")])


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(1, 200)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}


# --- 5 -----------------------------------------------------------------------

_PLAIN = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = [(0, *m.span()) for m in _PLAIN[0].finditer(text)]
    out += [(1, *m.span()) for m in _PLAIN[1].finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, low, high in ((2, 12, 19), (3, 9, 15)):
        for m in _PLAIN[kind].finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                out.append((kind, *m.span()))
    return sorted(out)


def test_base_patterns():
    rng = random.Random(3)
    for k in range(20_000):
        letters = "012345678901234 -.+" if k % 3 == 0 else "a1@@..--+ ( )09é%x"
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert sorted(pii.base_spans(text)) == plain_spans(text)
    assert pii.base_spans("7" * 200_000) == [] and pii.base_spans("a" * 200_000) == []


def test_tagger_gradients():
    model = tagger.Tagger(embed=4, hidden=3, dtype=np.float64)
    rng = np.random.default_rng(0)
    codes = rng.integers(0, tagger.SYMBOLS, (3, 7))
    tags = np.array([tagger.tags_of(7, s) for s in ([(0, 1, 4)], [(2, 0, 7)], [(3, -2, 3), (1, 4, 6)])])
    _, grads = model.loss(codes, tags)
    for name, table in model.p.items():
        at = tuple(rng.integers(0, s) for s in table.shape)
        ends = []
        for step in (1e-5, -1e-5):
            table[at] += step
            ends.append(model.loss(codes, tags)[0])
            table[at] -= step
        assert abs((ends[0] - ends[1]) / 2e-5 - grads[name][at]) < 1e-6


def test_tagger_and_spans(spark):
    docs = documents(spark)
    model = pii.train(docs)
    # On texts the tagger has not seen, made by the same formats.
    shares = pii.measured(model)
    for kind in (*pii.KINDS, "all", "beyond"):
        precision, recall, n = shares[kind]
        assert precision > 0.9 and recall > 0.9 and n > 150, (kind, shares)
    rows = {r.id: r for r in pii.find_personal_data(docs, tagger=model).collect()}
    for doc in docs.collect():
        text, r = doc.text or "", rows[doc.doc_id]
        base = plain_spans(text)
        counts = Counter(k for k, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in range(4))
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        listed = set(r.spans.split(",")) if r.spans else set()
        assert set(filter(None, pii.written(base).split(","))) <= listed
    added = dict(pii.find_personal_data(frame(spark, [
        (1, "please call (555) 123-4567 now for more of it"), (2, "plain words without any of it"),
        (3, "x" * 500 + " write to joe @ host.com or so " + "y" * 500)]), tagger=model).select("id", "spans").collect())
    assert added[1] == "phone:12:26" and added[2] == ""
    assert added[3].startswith("email:")


@pytest.fixture(scope="module")
def trained(spark):
    return pii.train(documents(spark))


@pytest.mark.parametrize("text, kind, span", [
    ("mail jane at example dot org for more of it", "email", "jane at example dot org"),
    ("write to name [at] host [dot] com now", "email", "name [at] host [dot] com"),
    ("name (at) mail.host.com is the address", "email", "name (at) mail.host.com"),
    ("call five five five one two three four five six seven now please", "phone",
     "five five five one two three four five six seven"),
    ("the card ４１１１ １１１１ １１１１ １１１１ is mine", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("call +４４ ２０ ７９４６ ０９５８ now", "phone", "+４４ ２０ ７９４６ ０９５８"),
    ("call （５５５） １２３-４５６７ now", "phone", "（５５５） １２３-４５６７"),
    ("joe＠host．com here", "email", "joe＠host．com"),
    ("John dot Smith AT mail dot example dot com and so on", "email", "John dot Smith AT mail dot example dot com"),
    ("pay four " + "one " * 15 + "today", "card", "four" + " one" * 15),
    ("dial plus four four 20 seven nine four six oh nine five eight now", "phone",
     "plus four four 20 seven nine four six oh nine five eight"),
    ("call 555.123.4567 now", "phone", "555.123.4567"),
    ("tel: 020 7946 0958", "phone", "020 7946 0958"),
    ("card 4111.1111.1111.1111", "card", "4111.1111.1111.1111"),
    ("joe @ host . com", "email", "joe @ host . com"),
    ("the host is 10[.]0[.]0[.]1 here", "ip", "10[.]0[.]0[.]1"),
    ("on 2024-05-17 we sold 1,250.75 of v1.2.34 and 12 x 4000", None, ""),
    ("look at example.org for one or two", None, ""),
    ("one two three four and the dot at the end", None, ""),
])
def test_worded_and_wide_spans(trained, text, kind, span):
    ((base, spans),) = pii.spans_of_texts(trained, [text])
    assert base == [] and [(pii.KINDS[k], text[a:b]) for k, a, b in spans] == ([(kind, span)] if kind else [])


def test_plausible_forms():
    assert pii.plausible(pii.EMAIL, "a at b dot org") and pii.plausible(pii.EMAIL, "a[at]b.org")
    assert not pii.plausible(pii.EMAIL, "look at example.org") and not pii.plausible(pii.EMAIL, "a at b")
    card = "four " + "one " * 15
    assert pii.kind_of(pii.PHONE, card.strip()) == pii.CARD and pii.kind_of(pii.CARD, card + "bread") is None
    assert pii.kind_of(pii.CARD, "plus " + "one " * 10 + "two") == pii.PHONE
    assert pii.folded("٣ ５＠．²①é") == "3 5@.²①é"
    assert max(pii.windows("x" * 90 + "٣")) + pii.WINDOW >= 91
    counted = "one two three four five six seven eight nine"
    assert pii.worded_spans(counted) == [] and pii.worded_spans("oh " + counted + " one") != []
    assert pii.worded_spans("a" * 100_000 + " at b dot org") == [] == pii.worded_spans("one " * 100_000)


class Lines:
    """Stands for a tagger: every line is an email."""

    def decode(self, codes):
        inside = ~np.isin(codes, [0, tagger.encode("\n")[0]])
        before = np.concatenate([np.zeros((len(codes), 1), bool), inside[:, :-1]], 1)
        return np.where(inside, np.where(before, 2, 1), 0)


@pytest.mark.parametrize("form", ["joe @ {}.example.org", "{}x @ example.org", "a @ {}.7-7.org"])
def test_long_spans_at_every_offset(form):
    texts, spans = [], []
    for size in (32, 33, 47, 63, 64, 65, 90, 128, 200, 400):
        span = form.format("a" * (size - len(form) + 2))
        for offset in range(66):
            texts.append("\n" * offset + span + "\n" * 700)
            spans.append((pii.EMAIL, offset, offset + size))
    got = [s for _, s in pii.spans_of_texts(Lines(), texts)]
    assert got == [[s] for s in spans]


def test_spans_are_reconciled_as_by_hand():
    """Against asking every span taken before."""
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("0123456789@. +") for _ in range(rng.randint(1, 300)))
        starts = pii.windows(text)
        base = pii.base_spans(text)
        tags = np.array([[rng.choice((0, 0, 7, 8, 8, 8, 8, 8, 8)) for _ in range(pii.WINDOW)] for _ in starts])
        found = {}
        for start, row in zip(starts, tags.reshape(-1, pii.WINDOW)):
            length = min(pii.WINDOW, len(text) - start)
            for kind, a, b in tagger.spans_of(row[:length]):
                if not (a == 0 and start > 0) and not (b == length and start + length < len(text)):
                    span = (kind, start + a, start + b)
                    found[span] = max(found.get(span, 0), min(a, length - b))
        taken = list(base)
        for kind, a, b in sorted(found, key=lambda s: (-found[s], s[1] - s[2], s[1], s[0])):
            if pii.plausible(kind, text[a:b]) and all(b <= x or a >= y for _, x, y in taken):
                taken.append((kind, a, b))
        assert sorted(pii.reconcile(text, starts, tags, base)) == sorted(taken)


def test_long_texts_of_spans():
    line = "call (212) 555-0147 or +1 212 555 0147 or joe@host.com, "
    model = tagger.Tagger()
    (base, spans), (nothing, none) = pii.spans_of_texts(model, [line * 5000, "7" * 1_000_000])
    assert len(base) == 10_000 and set(base) <= set(spans) and nothing == none == []


# --- 6 -----------------------------------------------------------------------

def test_archives_are_read_back(spark, tmp_path):
    body = "p" * 1200
    rows = [(1, "http://a/", body), (9, "http://b/", body), (3, None, "small"), (4, "http://c/", "small"),
            (5, "http://d/\r\nX: 1", "a\r\n\r\nWARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 40),
            (6, "u", "\r\n\r\n"), (7, "u", None), (8, "u", "\r\n"), (10, "u", "é" * 700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    read = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert {k: read[k].record_type for k in read} == {k: "revisit" if k == 1 else "response" for k, _, _ in rows}
    for k, _, html in rows:
        if k != 1:
            assert bytes(read[k].payload) == (html or "").encode()
    assert read[1].payload is None and read[1].refers_to_record == read[9].record_id
    resolved = {r.page_id: r for r in warc.resolve(warc.read_archives(spark, path)).collect()}
    assert resolved[1].refers_to == 9 and resolved[1].payload_bytes == 1200
    digest = hashlib.sha1(body.encode()).hexdigest()
    assert resolved[1].payload_digest == resolved[9].payload_digest == digest


# --- 7 -----------------------------------------------------------------------

def test_line_thresholds_and_nulls(spark):
    rows = [(1, "shared line one\nshort\nown line of one"), (2, " SHARED line one\t\nshort\nown line of two"),
            (3, "shared line one\nshared line one"), (3, "shared line one\nother line of three"), (None, "shared line one"),
            (4, None), (5, "")]
    def cut(**o):
        got = lines.drop_repeated_lines(frame(spark, rows), **o).collect()
        return Counter((r.row.doc_id, r.kept, r.n_dropped) for r in got)

    assert cut() == Counter([
        (1, "shared line one\nshort\nown line of one", 0), (2, "short\nown line of two", 1), (3, "", 2),
        (3, "other line of three", 1), (None, "shared line one", 0), (4, "", 0), (5, "", 0)])
    assert sum(n * k[2] for k, n in cut(min_documents=3).items()) == 4
    assert sum(n * k[2] for k, n in cut(min_documents=4).items()) == 0


# --- 8 -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def coder():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.ByteBpe(ranks, bpe.merges_of(ranks), public_tokenizers.PATTERN), tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_equal_the_rank_library(spark, coder):
    ours, theirs = coder
    rng = random.Random(6)
    cases = [r.text or "" for r in documents(spark).collect()]
    cases += ["".join(chr(rng.choice([rng.randrange(0x20, 0x3000), rng.randrange(0x1F300, 0x1FAFF), 32, 10, 39]))
                      for _ in range(60)) for _ in range(500)]
    for text in cases:
        ids = ours.encode(text)
        assert list(memoryview(ids).cast("I")) == theirs.encode_ordinary(text)
        assert ours.decode(ids) == text.encode()


def test_parts_split_like_the_whole(coder):
    text = "It's a test's end  \n\n of it 123 abc\t don't " * 40
    assert "".join(bpe.parts(text, 17)) == text and len(list(bpe.parts(text, 17))) > 20
    pieces = [p for part in bpe.parts(text, 17) for p in coder[0].pattern.findall(part)]
    assert pieces == coder[0].pattern.findall(text)


def test_offsets_and_round_trip(spark, coder):
    rows = [(1, "naïve 🙂 text"), (2, None), (3, "")]
    docs = frame(spark, rows)
    for r in bpe.encode_offsets(docs).collect():
        text = dict(rows)[r.doc_id] or ""
        covered = {i for t in r.tokens for i in range(t.start, t.end)}
        assert covered == set(range(len(text)))
        assert [t.id for t in r.tokens] == coder[1].encode_ordinary(text)
    back = bpe.decode(bpe.encode(docs)).select("doc_id", F.col("data").cast("string").alias("text"))
    assert {r.doc_id: r.text for r in back.collect()} == {1: "naïve 🙂 text", 2: "", 3: ""}


# --- 9 -----------------------------------------------------------------------

def test_rules_against_brute_force(spark):
    rng = random.Random(9)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "net", "x.net", "notnet", "badexample.com", "org"]
    made = [f"{rng.choice(['http', 'https', ''])}{rng.choice(['://', '://', ':/'])}{rng.choice(hosts)}"
            f"{rng.choice(['', '/', '/en/', '/en', '/es/x', '/fr/', '?q=://z.net/es/', '#/fr/'])}" for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(made)] + [(-1, None, None)],
                                  "page_id long, url string, html string")

    def brute(url):
        if not url or "://" not in url:
            return "", "", None
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = host.lower()
        fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return host, path, max((r.name for r in fits), key=len, default=None)

    for r in urls.judged(pages).collect():
        assert (r.host, r.path, r.rule) == brute(r.row.url)


def test_ranks_against_matrices(spark):
    rng = random.Random(2)
    names = [f"h{i}.org" for i in range(12)]
    links = [(*rng.sample(names, 2), rng.randint(1, 5)) for _ in range(40)]
    table = spark.createDataFrame(links, "src string, dst string, n long").groupBy("src", "dst").agg(F.sum("n").alias("n"))
    seeds = {"h1.org": (1.0, 0.0), "h2.org": (0.0, 0.5), "lone.net": (0.25, 0.75)}
    got = {r.host: (r.trust, r.distrust) for r in urls.propagate(table, spark.createDataFrame(
        [(h, *w) for h, w in seeds.items()], "host string, trusted double, blocked double")).collect()}
    hosts = sorted(got)
    assert set(hosts) == {h for a, b, _ in links for h in (a, b)} | set(seeds)
    matrix = np.zeros((len(hosts), len(hosts)))
    for a, b, n in links:
        matrix[hosts.index(a), hosts.index(b)] += n
    for k, table in ((0, matrix), (1, matrix.T)):
        flow = table / np.maximum(table.sum(1, keepdims=True), 1)
        seed = np.array([seeds.get(h, (0.0, 0.0))[k] for h in hosts])
        score = seed
        for _ in range(urls.ROUNDS):
            score = seed + urls.DAMPING * score @ flow
        assert np.allclose(score, [got[h][k] for h in hosts])


def test_links_and_verdicts(spark):
    pages = spark.createDataFrame([
        (1, "http://bad.net/es/1", ""), (2, "http://friend.org/x", '<a HREF="http://bad.net/es/1">'),
        (3, "http://clean.org/x", "<a href='/own'><img src=\"//friend.org/i\">"), (4, "http://good.com/", ""),
    ], "page_id long, url string, html string")
    found = {(r.src, r.dst): r.n for r in urls.host_links(pages).collect()}
    assert found == {("friend.org", "bad.net"): 1, ("clean.org", "friend.org"): 1}
    verdicts = {r.row.page_id: r.verdict for r in urls.filter_urls(pages).collect()}
    # clean.org links to a host that links to a blocked one: two steps.
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "allow"}


def _linked(spark, links, own=()):
    """Verdicts of hosts whose pages no rule judges. ``links``: (host, hosts it
    links to); ``own``: further (url, html)."""
    rows = [(f"http://{h}/x", "".join(f'<a href="http://{t}/es/">' for t in to)) for h, to in links]
    rows = [(i, *r) for i, r in enumerate([*rows, *own])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.host: r.verdict for r in urls.filter_urls(pages).where("rule is null").collect()}


def test_distrust_reaches_what_links_to_blocked_hosts(spark):
    bad = ("http://bad.net/es/1", "")
    # Both linkers of one blocked host, and ten of them.
    for n in (2, 10):
        found = _linked(spark, [(f"l{i}.org", ["bad.net"]) for i in range(n)] + [("clean.org", ["l.info"])], [bad])
        assert found == {**{f"l{i}.org": "block" for i in range(n)}, "clean.org": "allow"}
    # A chain of two steps and of three; who is linked to from there is clean.
    found = _linked(spark, [("a.org", ["b.org"]), ("b.org", ["c.org"]), ("c.org", ["bad.net", "read.org"]),
                            ("read.org", [])], [bad])
    assert found == {"a.org": "block", "b.org": "block", "c.org": "block", "read.org": "allow"}
    # One page in five is blocked: its own other pages and its neighbour.
    part = [("http://part.net/fr/1", "")] + [(f"http://part.net/en/{i}", "") for i in range(4)]
    assert _linked(spark, [("near.org", ["part.net"]), ("far.org", [])], part) == {
        "part.net": "block", "near.org": "block", "far.org": "allow"}


def test_trust_outweighs_distrust(spark):
    bad = ("http://bad.net/es/1", "")
    good = [(f"http://good{i}.com/", '<a href="http://mixed.org/">') for i in range(2)]
    # Ten linkers share the distrust; trusted hosts link to one of them.
    links = [(f"l{i}.org", ["bad.net"]) for i in range(9)] + [("mixed.org", ["bad.net"])]
    found = _linked(spark, links, [bad, *good])
    assert found.pop("mixed.org") == "allow" and set(found.values()) == {"block"}


def test_links_without_quotes_count(spark):
    html = ("<a href=http://one.net/x><img src='//two.net/a\"b'> <A HREF = \"http://three.net/it's\">"
            "<a href=http://four.net/ href=\"http://five.net>\"> <a hrefx=http://no.net/> <a href=>")
    pages = spark.createDataFrame([(1, "http://own.org/", html)], "page_id long, url string, html string")
    assert {r.dst for r in urls.host_links(pages).collect()} == {
        "one.net", "two.net", "three.net", "four.net"}


# --- 10 ----------------------------------------------------------------------

def test_cut_spans(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = frame(spark, [(1, f"Keep this. {item.upper()} and that."), (2, "clean Text, here!"), (3, None)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, benchmark).collect()}
    assert got == {1: "Keep this and that.", 2: "clean Text, here!", 3: None}
    assert sorted(r.doc_id for r in decontaminate.clean_documents(docs, benchmark).collect()) == [2, 3]


def test_joined_windows_equal_broadcast_ones(spark):
    docs, benchmark = documents(spark), spark.read.parquet(f"{SOURCE}/benchmark.parquet")
    def rows(limit):
        return sorted((r.row.doc_id, r.n_hit, sorted(r.items)) for r in decontaminate.annotate(
            docs, benchmark, broadcast_bytes=limit).collect())

    assert rows(1 << 30) == rows(0)
    assert any(n for _, n, _ in rows(0))
    plan = decontaminate.overlaps(docs, benchmark, broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    # What is shuffled by window is the window, without the words of its text.
    assert "SortMergeJoin" in plan
    ahead = [line.split("xxhash64(")[0] for line in plan.split("\n") if " Project [" in line and "xxhash64(slice(words" in line]
    assert ahead and not any("words#" in names for names in ahead)
