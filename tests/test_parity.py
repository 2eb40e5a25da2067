"""Every registered query against its SQL, on the tables as they are and on
tables where one row makes up a third."""

import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from platelake.workload.oracle import ORACLE
from platelake.workload.queries import QUERIES
from tests.parity import TABLES, compare, connect, type_differences

SOURCE = "/root/testdata/sf0.001"
HOT = {"orders": "o_orderkey", "embeddings": "vec_id"}


@pytest.fixture(scope="session")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    connection = duckdb.connect()
    for name in TABLES:
        source = f"'{SOURCE}/{name}.parquet'"
        query = f"SELECT * FROM {source}"
        if name in HOT:
            key = HOT[name]
            query += (f" UNION ALL SELECT h.* FROM (SELECT * FROM {source} WHERE {key} ="
                      f" (SELECT min({key}) + 2 FROM {source})) h,"
                      f" range((SELECT count(*) // 2 FROM {source}))")
        connection.execute(f"COPY ({query}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    connection = connect(SOURCE)
    df = entry.queries()[name](spark, SOURCE)
    sql = entry.oracle_sql()[name]
    assert compare(df, connection, sql) == ""
    assert type_differences(df, connection, sql) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_on_skewed_tables(spark, skewed, name):
    df = entry.queries()[name](spark, skewed)
    assert compare(df, connect(skewed), entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_python_workers_need_no_package_on_their_path(tmp_path):
    """From a foreign folder, as a driver that loads the entry file by path."""
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("given", {entry.__file__!r})
given = importlib.util.module_from_spec(spec)
spec.loader.exec_module(given)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("chunk_sites", "score_sites", "load_png_sites", "scan_png_plates", "stream_planes"):
    print(name, len(given.queries()[name](spark, {SOURCE!r}).collect()))
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    for line in ("chunk_sites 332", "score_sites 83", "load_png_sites 31872", "scan_png_plates 332",
                 "stream_planes 500"):
        assert line in done.stdout
