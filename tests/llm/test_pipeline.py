"""The pipeline against a plain version of every stage."""

import hashlib
import re
from collections import defaultdict

import pytest
import tiktoken

import corpus_pipeline
import public_tokenizers
from platelake.llm import bpe
from tests.llm.test_operators import brute_components, repeated_words, simhash_of

SOURCE = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\f\r"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def passes(text):
    words = text.encode().split()
    words = [w.decode() for w in words]
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return not (
        n < 10 or 100 * repeated_words(words) > 20 * n
        or 10 * len(re.findall(r"[#*$%&|<>]", text)) > n
        or 100 * (len(lines) - len(set(lines))) > 50 * len(lines)
        or chars < 2 * n or chars > 20 * n
        or 2 * len(re.findall("[A-Z]", text)) > chars or 2 * text.count("!") > n)


def drop_lines(texts):
    where = defaultdict(set)
    for i, text in texts.items():
        for line in text.split("\n"):
            key = ascii_lower(line.strip(SPACES))
            if len(key) >= 10:
                where[key].add(i)
    out = {}
    for i, text in texts.items():
        kept = [x for x in text.split("\n")
                if min(where.get(ascii_lower(x.strip(SPACES)), {i})) == i
                or len(where[ascii_lower(x.strip(SPACES))]) < 2]
        out[i] = "\n".join(kept)
    return out


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def clean(texts, items):
    windows = set()
    for item in items:
        words = plain_words(item or "")
        windows |= {tuple(words[i:i + 10]) for i in range(max(len(words) - 9, 1)) if words}
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in texts.items():
        words = plain_words(text)
        if not any(tuple(words[p:p + n]) in windows for n in sizes for p in range(len(words) - n + 1)):
            out[i] = text
    return out


def brute(spark, source):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{source}/documents.parquet").collect()}
    yield (texts := {i: t for i, t in texts.items() if passes(t)})
    yield (texts := drop_lines(texts))
    groups = brute_components({i: simhash_of(t) for i, t in texts.items()})
    yield (texts := {i: t for i, t in texts.items() if groups[i] == i})
    items = [r.text for r in spark.read.parquet(f"{source}/benchmark.parquet").collect()]
    yield clean(texts, items)


def test_stages_equal_the_plain_version(spark):
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    columns = docs.columns
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], brute(spark, SOURCE)):
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SOURCE), name)
        assert docs.columns == columns
        rows = docs.collect()
        assert len(rows) == len(expected) and {r.doc_id: r.text for r in rows} == expected
        assert all(r.n_chars == len(r.text) for r in rows)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SOURCE).collect()}
    assert got.keys() == expected.keys()
    for i, text in expected.items():
        ids = coder.encode_ordinary(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (1, ""), (None, "a b")]])
def test_stages_take_nulls_and_empty_tables(spark, rows):
    given = [(i, t, None, None, None, "clash") for i, t in rows]
    docs = spark.createDataFrame(
        given, "doc_id long, text string, lang string, source string, n_chars long, row string")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SOURCE)
        assert result.count() <= len(rows)
        if name != "byte_bpe":
            assert result.columns == docs.columns
