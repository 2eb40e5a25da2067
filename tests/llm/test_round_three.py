"""Hard negatives, sharding and the manifest against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from platelake.llm import manifest, negatives, queries, shards

SOURCE = "/root/testdata/sf0.001"


# --- 11 ----------------------------------------------------------------------

def mined(rows, every=100, positives=5, negatives_=10):
    """Plain version over (vec_id, label, vector) rows that all take part."""
    whole = [(i, lab, [math.floor(256 * float(x)) for x in v]) for i, lab, v in rows]
    anchors = {}
    for i, lab, v in whole:
        if i % every == 0 and (i not in anchors or (lab, v) > anchors[i]):
            anchors[i] = (lab, v)
    out = []
    for a, (lab, v) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in whole]
        same = sorted((s, i) for s, i, other in scored if other == lab and i != a)[:positives]
        for ps, p in same:
            band = sorted((s, i) for s, i, other in scored
                          if other != lab and -30 * ps <= -100 * s <= -90 * ps)[:negatives_]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(band)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def random_rows(n, width, seed, labels=3, copies=0):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((n, width)).astype(np.float32) / np.float32(width ** 0.5)
    data[n - copies:] = data[0]
    return [(i, int(rng.integers(labels)), [float(x) for x in data[i]]) for i in range(n)]


@pytest.mark.parametrize("n, width, copies, block", [
    (300, 64, 0, 2048), (300, 64, 100, 32), (260, 5, 120, 50), (200, 130, 0, 33)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, n, width, copies, block):
    """Also with one vector in a third of the rows, few and many components."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    rows = random_rows(n, width, n + width, copies=copies)
    got = negatives.mine(vectors(spark, rows).repartition(3), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == mined(rows, 20)


def test_hard_negatives_in_several_jobs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 2)
    monkeypatch.setattr(negatives, "BROADCAST_BYTES", 1)
    rows = random_rows(120, 8, 5)
    got = negatives.mine(vectors(spark, rows), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == mined(rows, 20)


def test_awkward_vectors(spark):
    good = random_rows(80, 4, 9)
    odd = [(None, 1, [1.0] * 4), (100, None, [1.0] * 4), (200, 1, None), (300, 1, [1.0, None]),
           (400, 1, [float("nan")]), (500, 1, [float("inf"), 1.0]), (600, 1, [-float("inf")])]
    short = [(81, 1, [0.5]), (82, 1, []), (83, 2, [0.25, -0.5])]
    again = [good[0], good[3], (20, 7, [0.1, 0.2, 0.3, 0.4])]
    rows = good + short + again
    df = vectors(spark, rows + odd).withColumns({c: F.lit(1) for c in ("id", "n", "block", "score")})
    got = negatives.mine(df, F.col("vec_id") % 20 == 0)
    filled = [(i, lab, v + [0.0] * (4 - len(v))) for i, lab, v in rows]
    assert sorted(map(tuple, got.collect())) == mined(filled, 20)
    assert got.count() > 0
    for none in (df.limit(0), df.where("label is null"), vectors(spark, [(20, 1, [1.0])])):
        assert negatives.mine(none, F.col("vec_id") % 20 == 0).collect() == []
    with pytest.raises(ValueError):
        negatives.mine(vectors(spark, [(20, 1, [1e12])]), F.lit(True))


def test_intervals_hold_the_score_and_leave_pairs_out():
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.standard_normal((400, 64)) / 8)
    q = np.vstack([np.floor(256 * rng.standard_normal((30, 64)) / 8), x[:2]])
    turns = negatives.rotations(64)
    codes, turned = negatives.encode(x, turns), negatives.turn_anchors(q, turns)
    scores = q @ x.T
    a, b = np.arange(len(q))[:, None], np.arange(len(x))[None, :]
    width, estimate = [], negatives.Estimate(a, b)
    for _ in range(negatives.CODES):
        low, high = estimate.add(codes, turned, 64)
        assert (low <= scores).all() and (scores <= high).all()
        width.append((high - low).mean())
    assert width[0] > width[1] > width[2]
    # A list that takes only the closest hundredth: random directions are the
    # worst case, and still most pairs are not scored.
    near = np.quantile(scores, 0.99, axis=1)
    kept, _ = negatives._reaching(
        codes, turned, 64, np.ones(scores.shape, bool), near, np.full(len(q), np.inf))
    assert len(kept) < 0.5 * scores.size
    # A vector that is its own code is left over by nothing.
    one = turns[0][:, :1].T * 0 + np.where(np.arange(64) % 3, 1.0, -1.0) @ turns[0].T
    assert negatives.encode(one, turns[:1]).left.max() < 1e-9


def test_lists_keep_ties_by_id():
    best = negatives.Best(2, 3)
    best.add(np.array([0, 0, 0, 0, 1]), np.array([5, 5, 5, 5, 1]), np.array([9, 3, 7, 8, 4]))
    best.add(np.array([0, 0, 1]), np.array([5, 4, 6]), np.array([1, 0, 2]))
    assert best.id[0].tolist() == [1, 3, 7] and best.score[0].tolist() == [5, 5, 5]
    assert best.id[1].tolist()[:2] == [2, 4] and best.score[1, 2] == negatives._NO_SCORE


# --- 12 ----------------------------------------------------------------------

def test_drawn_counts_follow_the_law():
    rng = np.random.default_rng(1)
    seen = Counter(shards.hypergeometric(rng, 7, 9, 5) for _ in range(20_000))
    for k in range(6):
        exact = math.comb(7, k) * math.comb(9, 5 - k) / math.comb(16, 5)
        assert abs(seen[k] / 20_000 - exact) < 4.5 * math.sqrt(exact * (1 - exact) / 20_000)
    for good, bad, draws in [(0, 5, 3), (5, 0, 3), (4, 4, 0), (4, 4, 8), (1, 1, 1)]:
        k = shards.hypergeometric(rng, good, bad, draws)
        assert max(0, draws - bad) <= k <= min(good, draws)
    large = [shards.hypergeometric(rng, 10 ** 10, 7 * 10 ** 10, 10 ** 6) for _ in range(300)]
    assert abs(np.mean(large) - 125_000) < 100 and 270 < np.std(large) < 395


def test_matrix_is_that_of_a_permutation():
    """Against dealing out a permutation of all rows, over many seeds."""
    counts, sizes = [3, 0, 4, 2], [4, 3, 2]
    labels = np.repeat(np.arange(3), sizes)
    ends = np.cumsum(counts)
    rng = np.random.default_rng(0)
    drawn, dealt = Counter(), Counter()
    for seed in range(4000):
        m = shards.communication_matrix(counts, sizes, seed)
        assert m.sum(1).tolist() == counts and m.sum(0).tolist() == sizes
        drawn[tuple(m[0])] += 1
        permuted = rng.permutation(labels)
        dealt[tuple(np.bincount(permuted[:ends[0]], minlength=3))] += 1
    assert set(drawn) == set(dealt)
    for key in dealt:
        assert abs(drawn[key] - dealt[key]) < 6 * math.sqrt(dealt[key] + 1)


def test_shards_are_exact_and_gapless(spark, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK_ROWS", 16)
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet").repartition(5)
    hot = docs.where("doc_id = 7").crossJoin(spark.range(103)).drop("id")
    odd = spark.createDataFrame(
        [(None, None, "x", "y"), (1, "", None, "z")], "doc_id long, text string, lang string, source string")
    table = docs.unionByName(hot).unionByName(odd, allowMissingColumns=True).withColumns({
        "row": F.lit("r"), "slot": F.lit(1), "part": F.lit(2), "a b": F.create_map(F.lit(1), F.lit(2))})
    placed = shards.shuffle_into_shards(table, 7)
    got = placed.select("row.*", F.col("shard").alias("to"), F.col("slot").alias("at")).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["to"]].append(r["at"])
    sizes = shards.shard_sizes(200 + 103 + 2, 7)
    assert [sorted(slots[j]) for j in range(7)] == [list(range(n)) for n in sizes]
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in table.select("doc_id").collect())
    again = shards.shuffle_into_shards(table, 7).select("row.doc_id", "shard", "slot").collect()
    assert Counter((r.doc_id, r["to"], r["at"]) for r in got) == Counter(map(tuple, again))
    other = shards.shuffle_into_shards(table, 7, seed=1).select("row.doc_id", "shard", "slot").collect()
    assert Counter(map(tuple, other)) != Counter(map(tuple, again))


def test_shards_of_little(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t") for i in range(3)], "doc_id long, text string")
    assert shards.shuffle_into_shards(docs.limit(0)).collect() == []
    placed = shards.shuffle_into_shards(docs, 8)
    assert sorted((r["shard"], r["slot"]) for r in placed.collect()) == [(0, 0), (1, 0), (2, 0)]
    shards.write_shards(placed, str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in read.collect()) == [0, 1, 2]
    assert {r["shard"] for r in read.collect()} == {0, 1, 2}


def test_shuffle_is_uniform(spark):
    """Neither neighbours nor small ids have a shard they prefer."""
    docs = spark.range(0, 4000, numPartitions=4).select(
        F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    got = shards.shuffle_into_shards(docs, 4).select("row.doc_id", "shard", "slot").collect()
    shard = {r.doc_id: r["shard"] for r in got}
    together = sum(shard[i] == shard[i + 1] for i in range(3999)) / 3999
    assert abs(together - 0.25) < 0.04
    for j in range(4):
        low = sum(1 for i in range(1000) if shard[i] == j)
        assert abs(low - 250) < 5 * math.sqrt(1000 * 0.25 * 0.75 * 0.75)
        first = np.mean([r.doc_id for r in got if r["shard"] == j and r["slot"] < 500])
        assert abs(first - 2000) < 5 * 1155 / math.sqrt(500)


def test_sharding_query(spark):
    got = queries.op12_sharding(spark, SOURCE).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SOURCE}/documents.parquet").collect()}
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (
            len(data) + 1, zlib.crc32(data), "rows", None)
    assert sorted((r["shard"], r["slot"]) for r in got) == [(j, k) for j in range(8) for k in range(25)]


# --- 13 ----------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        at = i // 8 * 8
        out.append((level[at:i], level[i + 1:at + 8]))
        i //= 8
    return out


def listed(rows, columns, group, order):
    """(order value, leaf, subroot, root, proof) of each row."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[group]].append((
            (r[order] is not None, r[order] or 0), digest("".join(encoded(r[c]) for c in columns)),
            r[order]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, leaf, _ in sorted(groups[g], key=lambda x: x[:2])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    return [
        (key, leaf, trees[g][-1][0], top[-1][0], path(trees[g], i) + path(top, k))
        for k, g in enumerate(names)
        for i, (_, leaf, key) in enumerate(sorted(groups[g], key=lambda x: x[:2]))]


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def check_manifest(df, **options):
    got = manifest.manifest(df, **options).collect()
    found = Counter(
        (r.id, r.leaf, r.subroot, r.root, tuple((tuple(p.left), tuple(p.right)) for p in r.proof))
        for r in got)
    rows = [r.asDict() for r in df.collect()]
    assert found == Counter(
        (k, leaf, sub, root, tuple((tuple(a), tuple(b)) for a, b in proof))
        for k, leaf, sub, root, proof in listed(rows, COLUMNS, "lang", "doc_id"))
    return got


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 8, None: 1}, {"a": 9, "b": 64, "": 65}, {"x": 700, "y": 1, "é": 2},
    {f"g{i}": 1 + i % 3 for i in range(80)}])
def test_manifest_equals_brute_force(spark, sizes):
    """Trees of one to four levels, one and many groups, blocks of 8 and 512."""
    rows = [(i * 7 % 1000 - 5, "s", g, i, f"Text É {i}") for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    check_manifest(df)
    check_manifest(df, levels=1)


def test_manifest_of_awkward_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "en", 0, ""), (3, "s", "en", 1, "a:b"),
            (3, "s", "en", 1, "a:b"), (3, "s", "en", 1, "zz"), (2, "s", "en", 1, "x" * 200_000)]
    df = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumns({c: F.lit("1") for c in ("id", "g", "rank", "n", "hash", "leaf", "node")})
    check_manifest(df)
    assert manifest.manifest(df.limit(0)).collect() == []


def test_hot_row_is_spread_and_proofs_detect_changes(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(100)] + [(50, "s", "en", 1, "t50")] * 600
    df = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(6)
    got = check_manifest(df, carry={"shouted": F.upper("text")})
    assert {r.shouted for r in got} == {f"T{i}" for i in range(100)}
    listed_ = manifest.manifest(df, carry={"wrong": F.sha2(F.col("text").cast("binary"), 256)})
    checked = listed_.select(
        (manifest.fold(F.col("leaf")) == F.col("root")).alias("right"),
        (manifest.fold(F.col("wrong")) == F.col("root")).alias("fooled"))
    assert checked.where("not right or fooled").count() == 0


def test_proofs_come_without_joins(spark):
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    plan = manifest.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate posexplode" in plan
