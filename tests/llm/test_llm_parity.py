"""Queries with SQL against DuckDB; all queries on empty and awkward tables."""

import datetime
import random
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry
from platelake.llm import pii
from platelake.llm.oracle import ORACLE
from platelake.llm.queries import QUERIES
from tests.llm.test_operators import repeated_words
from tests.parity import compare, connect, type_differences

SOURCE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = connect(SOURCE)
    df = QUERIES[name](spark, SOURCE)
    assert compare(df, connection, ORACLE[name]) == ""
    assert type_differences(df, connection, ORACLE[name]) == []


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """One text, one page and one line make up a third and more."""
    folder = str(tmp_path_factory.mktemp("hot"))
    connection = duckdb.connect()
    docs, pages = f"'{SOURCE}/documents.parquet'", f"'{SOURCE}/pages.parquet'"
    connection.execute(f"""COPY (
        SELECT * FROM {docs}
        UNION ALL SELECT 1000 + i, (SELECT text FROM {docs} WHERE doc_id = 7), 'en', 'hot', 1 FROM range(90) t(i)
        UNION ALL SELECT 2000 + i, 'the very same line here' || chr(10) || 'own words ' || i, 'en', 'hot', 1
        FROM range(90) t(i)
    ) TO '{folder}/documents.parquet' (FORMAT parquet)""")
    connection.execute(f"""COPY (
        SELECT * FROM {pages}
        UNION ALL SELECT 1000 + i, 'http://hot.example.net/en/' || i,
                         (SELECT html FROM {pages} WHERE page_id = 3) FROM range(60) t(i)
    ) TO '{folder}/pages.parquet' (FORMAT parquet)""")
    for name in ("benchmark", "labels"):
        connection.execute(f"COPY (SELECT * FROM '{SOURCE}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    vectors = f"'{SOURCE}/embeddings.parquet'"
    connection.execute(f"""COPY (
        SELECT * FROM {vectors}
        UNION ALL SELECT 100000 + i, (SELECT embedding FROM {vectors} WHERE vec_id = 11),
                         CAST(i % 3 AS INTEGER) FROM range(150) t(i)
    ) TO '{folder}/embeddings.parquet' (FORMAT parquet)""")
    return folder


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql_on_hot_rows(spark, skewed, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet'")
    assert compare(QUERIES[name](spark, skewed), connection, ORACLE[name]) == ""


def test_verdicts_over_links_equal_sql(spark, tmp_path):
    rng = random.Random(5)
    hosts = [f"h{i}.{rng.choice(['net', 'org', 'com'])}" for i in range(30)] + ["HUB.org", "example.com"]
    pages = []
    for i in range(400):
        own = rng.choice(hosts)
        refs = "".join(
            f'<a {rng.choice(["href", "SRC"])} = {quote}{rng.choice(["http://", "//", "x:", "/"])}{rng.choice(hosts)}/en/{quote}>'
            for quote in rng.choices(['"', "'", ""], k=rng.randint(0, 3)))
        pages.append((i, f"http://{own}/{rng.choice(['en/', 'es/', 'fr/', '', 'de/?://c.net/'])}", refs))
    folder = str(tmp_path)
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    df = QUERIES["op9_url_filter"](spark, folder)
    assert compare(df, connection, ORACLE["op9_url_filter"]) == ""
    # Verdicts of both kinds come from the links as well.
    assert {r.verdict for r in df.where("rule IS NULL").collect()} == {"allow", "block"}


DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that the operators use themselves.
    T.StructField("row", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("kept", T.DateType()), T.StructField("words", T.StringType()),
    T.StructField("text_hash", T.LongType()), T.StructField("component_id", T.LongType()),
])
PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
    T.StructField("digest", T.LongType()),
])
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def awkward_documents():
    same = "One two three four five six seven eight nine ten eleven twelve."
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, same), (5, same), (5, same), (6, same.upper()),
        (None, same), (None, None), (7, LONG), (8, LONG + " end"), (9, "\n".join([same] * 3)),
        (10, "a"), (11, "é É \x85 \u00a0 \u3000 ä"), (12, "a\x00b \x1f c\x0b d"), (13, "x" * 70_000),
        (14, "mail Joe.B@mail.example.com or +1 (555) 123-4567, under the MIT license"),
    ]
    return [(i, t, None, None, None, "r", 1, datetime.date(2024, 1, 1), "w", 3, 4) for i, t in rows]


def awkward_pages():
    page = "<a href='http://b.example.net/fr/x'>b</a>" + "x" * 1000
    rows = [
        (1, "http://a.example.net/en/", page), (2, "https://A.example.net?x", page), (2, None, page),
        (None, "ftp://c.org/a#b", page), (3, "no url", ""), (4, "http://", None), (5, "://x.net/es/", "é" * 600),
        (6, "http://a.com/line\r\nWARC/1.1", "a\r\n\r\nWARC/1.1\r\n\r\n" * 90), (7, "x://y.net/fr/", "\r\n"),
        (8, None, None), (9, "http://www.example.com/en/1", "tail\r\n\r\n"), (9, "http://www.example.com/en/1", "tail\r\n\r\n"),
    ]
    return [(i, u, h, "clash", 9) for i, u, h in rows]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("awkward"))
    spark.createDataFrame(awkward_documents(), DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(awkward_pages(), PAGES).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(
        [(1, "two THREE four five six seven eight nine ten eleven"), (2, "w1x1 w2x2"), (3, None),
         (None, "four five six seven"), (3, ""), (4, "four, five: six seven!"),
         (None, "under the MIT license")], "item_id long, text string",
    ).write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([
        (100, 1, [1.0, 0.5]), (100, 1, [1.0, 0.5]), (None, 1, [1.0, 1.0]), (200, None, [1.0]), (300, 2, None),
        (1, 1, [1.0, 0.25]), (2, 1, [0.5, None]), (3, 2, [0.5, 0.25]), (4, 2, [0.5, 0.25]),
        (5, 3, [float("nan"), 1.0]), (6, 3, [0.5, 0.125]), (14, 0, [0.75, 0.5]), (400, 9, [])],
        "vec_id long, label int, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], PAGES).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, label int, embedding array<float>").write.parquet(
        f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture
def quick_tagger(monkeypatch):
    """These tests are about rows; how well the tagger does is tested elsewhere."""
    monkeypatch.setattr(pii.train, "__defaults__", ("text", 20, 5))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, quick_tagger, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op11_hard_negatives"}))
def test_every_row_has_a_result(spark, awkward, quick_tagger, name):
    rows = QUERIES[name](spark, awkward).collect()
    column, given = ("page_id", awkward_pages()) if "page_id" in rows[0] else ("doc_id", awkward_documents())
    key = lambda x: (x is None, x or 0)
    assert sorted((r[column] for r in rows), key=key) == sorted((g[0] for g in given), key=key)


# The SQL takes minutes over the long texts; they are compared without it below.
LONG_IDS = "(7, 8)"


def test_long_texts(spark, awkward):
    found = {r.doc_id: r for r in QUERIES["op2_quality_rules"](spark, awkward).where(
        f"doc_id IN {LONG_IDS}").collect()}
    for i, text in ((7, LONG), (8, LONG + " end")):
        assert found[i].n_words == len(text.split())
        assert found[i].n_repeat_words == repeated_words(text.split())
    hits = {r.doc_id: r for r in QUERIES["op10_decontamination"](spark, awkward).where(
        f"doc_id IN {LONG_IDS}").collect()}
    pair = sum(a == "w1x1" and b == "w2x2" for a, b in zip(LONG.split(), LONG.split()[1:]))
    assert pair and all((r.n_hit, r.n_items) == (2 * pair, 1) for r in hits.values())


def test_awkward_vectors_have_their_negatives(spark, awkward):
    """Two rows are one anchor, and neither is its positive."""
    rows = QUERIES["op11_hard_negatives"](spark, awkward).collect()
    # Anchor 100 (label 1): 1 and 14 have its label; of others 3 and 4 tie.
    assert sorted(map(tuple, rows)) == [
        (100, 1, 1, 3, 73728, 40960), (100, 1, 2, 4, 73728, 40960), (100, 1, 3, 6, 73728, 36864),
        (100, 14, 1, 3, 65536, 40960), (100, 14, 2, 4, 65536, 40960), (100, 14, 3, 6, 65536, 36864)]


def test_awkward_manifest_equals_sql(spark, awkward):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{awkward}/documents.parquet/*.parquet'")
    assert compare(QUERIES["op13_manifest"](spark, awkward), connection, ORACLE["op13_manifest"]) == ""


# Nulls beside ids and repeated ids are defined by the operators, not by the SQL.
@pytest.mark.parametrize("name", ["op2_quality_rules", "op9_url_filter", "op10_decontamination"])
def test_awkward_rows_equal_sql(spark, awkward, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{awkward}/benchmark.parquet/*.parquet' WHERE item_id IS NOT NULL")
    if name == "op9_url_filter":
        connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{awkward}/pages.parquet/*.parquet'")
        assert compare(QUERIES[name](spark, awkward), connection, ORACLE[name]) == ""
        return
    connection.execute(f"""CREATE VIEW documents AS SELECT DISTINCT doc_id, text FROM
        '{awkward}/documents.parquet/*.parquet' WHERE doc_id IS NOT NULL AND doc_id NOT IN {LONG_IDS}""")
    df = QUERIES[name](spark, awkward).where(f"doc_id NOT IN {LONG_IDS}").dropDuplicates()
    if name == "op10_decontamination":
        # Windows of the item without an id hit words, but are no item.
        rows = {r.doc_id: r for r in df.collect()}
        named = {r[0]: r for r in connection.execute(ORACLE[name]).fetchall()}
        connection.execute(f"""CREATE OR REPLACE VIEW benchmark AS SELECT coalesce(item_id, -1) AS item_id, text
            FROM '{awkward}/benchmark.parquet/*.parquet'""")
        hits = {r[0]: r for r in connection.execute(ORACLE[name]).fetchall()}
        assert rows.keys() == named.keys() == hits.keys()
        for k, r in rows.items():
            assert (r.n_words, r.n_items, r.items_sha256) == (named[k][1], named[k][3], named[k][4])
            assert (r.n_hit, r.contaminated) == (hits[k][2], hits[k][5])
        assert any(r.n_hit and not r.n_items for r in rows.values())
    else:
        # The ablations count all documents, also those left out here.
        sql = f"SELECT * EXCLUDE (kept_without) FROM ({ORACLE[name]})"
        assert compare(df.drop("kept_without"), connection, sql) == ""


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_python_workers_need_no_package_on_their_path(tmp_path):
    """All operators from a foreign folder, as a driver that loads the entry
    file by path."""
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("given", {entry.__file__!r})
given = importlib.util.module_from_spec(spec)
spec.loader.exec_module(given)
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
for name in given.queries():
    if name == "pipeline" or name.startswith("op"):
        print("rows", name, given.queries()[name](spark, {SOURCE!r}).count())
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("rows op") == len(QUERIES) and "rows pipeline" in done.stdout
