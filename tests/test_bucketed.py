"""Which plans move pixels: bucketed planes, copies of planes, packing plans."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from platelake.operators import stack
from platelake.plans import jobs, packing, placing
from platelake.session import cut_lineage
from platelake.sources.bucketed import read_bucketed, write_bucketed
from platelake.sources.packed import read_packed
from tests.screens import site_frame, site_rows

DIRS = ("layout", "dataset", "file")
KEY = ("dataset", "experiment", "plate", "well", "site")


def nodes(df, kind):
    """(own line, input columns) of the plan's nodes of a kind."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    found = re.findall(r"\(\d+\) (\w+)[^\n]*\n((?:[^\n]+\n)*)", text)
    return [body for name, body in found if name == kind]


def moving_pixels(df, kind="Exchange"):
    return [n for n in nodes(df, kind) if re.search(r"Input[^\n]*\b(data|_plane\d)#", n)]


@pytest.fixture
def no_broadcast(spark):
    """What Spark does when no side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def planes_of(spark, rows, channels=(1, 2), size=4, value=0):
    rng = np.random.default_rng(value)
    data = [(r[1], r[2], r[4], r[5], r[8], c, size, size,
             bytearray(rng.integers(0, 256, size * size, dtype=np.uint8).tobytes()))
            for r in rows for c in channels]
    return spark.createDataFrame(data, "dataset string, experiment string, plate int, well string, "
                                 "site int, channel int, height int, width int, data binary")


def placed_rows(df):
    return sorted((r.layout, r.dataset, r.file, r.pos, r.id_code, bytes(r.image)) for r in df.collect())


@pytest.mark.parametrize("copies", [0, 40])
def test_bucketed_planes_move_once(spark, tmp_path, no_broadcast, copies):
    rows = site_rows(wells=12, plates=2)
    planes, dest = planes_of(spark, rows), str(tmp_path / "planes")
    assert write_bucketed(planes, dest, buckets=5) == 5
    plan = cut_lineage(packing.plan_random(site_frame(
        spark, rows + [(f"copy-{i}",) + rows[0][1:] for i in range(copies)]), 7))
    options = {"image_bytes": placing.HOT_ADDRESS_BYTES // 10, "broadcast_bytes": 0}
    placed = placing.place_images(
        plan, read_bucketed(spark, dest), DIRS, (1, 2), bucketed=True, **options)
    if not copies:
        # Looked at before the plan runs, when it is listed once.
        moved = moving_pixels(placed)
        assert len(moved) == 1 and "shufflepartitionidpassthrough" in moved[0]
        # The join neither shuffles nor sorts planes: their files are sorted.
        joins = nodes(placed, "SortMergeJoin")
        assert len([j for j in joins if "well" in j.split("Condition")[0]]) == 1
        assert all("task" in n for n in moving_pixels(placed, "Sort"))
        shuffled = placing.place_images(plan, planes, DIRS, (1, 2), **options)
        assert len(moving_pixels(shuffled)) == 2
    expected = placing.place_images(plan, planes, DIRS, (1, 2))
    assert placed_rows(placed) == placed_rows(expected) and placed.count() == len(rows) + copies


def test_bucketed_planes_are_replaced_and_read_by_others(spark, tmp_path):
    dest = str(tmp_path / "planes")
    rows = site_rows(wells=4)
    with pytest.raises(ValueError, match="no bucketed planes"):
        read_bucketed(spark, dest)
    write_bucketed(planes_of(spark, rows), dest, buckets=3)
    held = read_bucketed(spark, dest)
    assert write_bucketed(planes_of(spark, rows[:2], value=1), dest) == 1
    assert read_bucketed(spark, dest).count() == 4 and held.count() == 2 * len(rows)
    # A session that has never seen the table.
    other = read_bucketed(spark.newSession(), dest)
    assert sorted(map(str, other.collect())) == sorted(map(str, read_bucketed(spark, dest).collect()))
    # Rows of an address come together in a join with other rows.
    joined = held.join(held.groupBy(*KEY).agg(F.count("*").alias("n")), list(KEY))
    assert {r.n for r in joined.collect()} == {2}


def test_packing_bucketed_planes(spark, tmp_path):
    rows = site_rows(wells=9, plates=2)
    planes = planes_of(spark, rows)
    write_bucketed(planes, str(tmp_path / "planes"), buckets=4)
    for name, images, options in (
            ("a", planes, {}),
            ("b", read_bucketed(spark, str(tmp_path / "planes")), {"bucketed": True, "broadcast_bytes": 0})):
        jobs.pack_images(site_frame(spark, rows), images, str(tmp_path / name), channels=(1, 2),
                         per_file=5, unique=True, **options)
    one, two = (sorted(map(str, read_packed(spark, str(tmp_path / n)).collect())) for n in "ab")
    assert one == two and len(one) == 2 * len(rows)


# --- copies --------------------------------------------------------------------

def test_copies_do_not_move_the_other_planes(spark, no_broadcast):
    rows = site_rows(wells=200, plates=3, datasets=("train",))
    planes = planes_of(spark, rows, channels=(1,), size=1)
    repeated = planes.where("plate = 2")
    images = planes.unionByName(repeated).unionByName(repeated.where("well like 'B%'"))
    dropped = stack.drop_plane_copies(images)
    # The one exchange is that of the grouped copies, after they were combined
    # in their tasks; planes without a bit pass by, although no side counts as small.
    assert moving_pixels(dropped) == []
    (merged,) = [n for n in nodes(dropped, "Exchange")]
    assert "_mark" in merged and re.search(r"Input[^\n]*max#", merged)
    assert nodes(dropped, "SortMergeJoin") == [] and len(nodes(dropped, "BroadcastHashJoin")) == 2
    assert sorted(map(str, dropped.collect())) == sorted(map(str, planes.distinct().collect()))


def test_shared_bits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(stack, "COPY_WORD_BITS", 1)
    rows = site_rows(wells=100, plates=2, datasets=("train",))
    planes = planes_of(spark, rows, channels=(1, 2), size=2)
    images = planes.unionByName(planes.where("well < 'E'"))
    got = stack.drop_plane_copies(images)
    assert sorted(map(str, got.collect())) == sorted(map(str, planes.distinct().collect()))
    # Planes that differ both stay, to be refused later.
    other = planes.unionByName(planes_of(spark, rows[:1], channels=(1,), size=2, value=9))
    assert stack.drop_plane_copies(other).count() == planes.count() + 1
    assert stack.drop_plane_copies(planes) is planes


# --- packing plans ----------------------------------------------------------------

def test_strategies_and_seeds_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "sites")
    site_frame(spark, site_rows(wells=20, plates=2)).write.parquet(path)
    plan = packing.plan_all(spark.read.parquet(path), seeds=(42, 7), per_file=5)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_unknown_splits_are_found_ahead(spark):
    rows = site_rows(wells=2)
    for odd in ("holdout", None):
        sites = site_frame(spark, rows + [(rows[0][0], odd) + rows[0][2:]])
        with pytest.raises(ValueError, match=f"unknown split {odd}"):
            packing.plan_all(sites)
        assert packing.plan_all(sites, datasets=["train"]).count() > 0
