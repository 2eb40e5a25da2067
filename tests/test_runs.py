"""Commits of packed runs and arrays, and reading them back in parts."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from platelake.operators.chunks import assemble_arrays, read_window, to_chunks
from platelake.plans import jobs
from platelake.session import cut_lineage
from platelake.sources import runs
from platelake.sources.packed import read_chunks, read_packed

WELLS = [f"B{i:02d}" for i in range(6)]


def planes(spark, value, wells=WELLS, dataset="train", size=2, experiment="RPE-01"):
    rows = [(dataset, experiment, 1, w, 1, c, size, size,
             bytearray((value + c + i) % 256 for i in range(size * size)))
            for w in wells for c in (1, 2)]
    return spark.createDataFrame(rows, "dataset string, experiment string, plate int, well string, "
                                 "site int, channel int, height int, width int, data binary")


def sites(spark, wells=WELLS, dataset="train", experiment="RPE-01"):
    return spark.createDataFrame(
        [(w, dataset, experiment, "RPE", 1, w, "treatment", 1, 1) for w in wells],
        "id_code string, dataset string, experiment string, cell_type string, plate int, well string, "
        "well_type string, sirna long, site int")


def pack(spark, dest, value, per_file, **options):
    jobs.pack_images(sites(spark), planes(spark, value), dest, channels=(1, 2), per_file=per_file,
                     **options)


def content(spark, dest):
    return sorted((r.layout, r.file, r.pos, r.image[0]) for r in read_packed(spark, dest).collect())


def test_a_run_that_stops_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    dest = str(tmp_path / "packed")
    pack(spark, dest, 10, 3)
    before = content(spark, dest)
    assert len(before) == 12 and {r[3] for r in before} == {11}
    held = read_packed(spark, dest)

    def lost(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "commit", lost)
        with pytest.raises(KeyboardInterrupt):
            pack(spark, dest, 20, 5)
    # All files of the second run are there; no reader sees one of them.
    assert len(glob.glob(f"{dest}/run=*")) == 2
    assert content(spark, dest) == before
    pack(spark, dest, 30, 5)
    after = content(spark, dest)
    assert {r[3] for r in after} == {31} and len(after) == 12
    # Who opened the run before still reads it whole.
    assert {r.image[0] for r in held.collect()} == {11} and held.count() == 12
    assert len(runs.drop_abandoned(spark, dest, hours=0)) == 1
    assert runs.drop_abandoned(spark, dest, hours=0) == []
    pack(spark, dest, 40, 5)
    assert {r[3] for r in content(spark, dest)} == {41}
    assert len(glob.glob(f"{dest}/run=*")) == 2 and len(glob.glob(f"{dest}/_commits/[0-9]*")) == 2


def test_commits_of_two_writers_meet(spark, tmp_path, monkeypatch):
    dest = str(tmp_path / "packed")
    pack(spark, dest, 1, 3, strategies=["random"])
    create = runs._create
    others = []

    def slower(spark_, path, text):
        # Another job commits just before this one.
        if not others:
            others.append(1)
            pack(spark, dest, 5, 3, strategies=["by_exp_plate_site"])
        return create(spark_, path, text)

    monkeypatch.setattr(runs, "_create", slower)
    pack(spark, dest, 9, 3, strategies=["random"], seeds=(7,))
    found = {(r[0], r[3]) for r in content(spark, dest)}
    assert found == {("random-42", 2), ("by_exp_plate_site-42", 6), ("random-7", 10)}
    assert runs.numbers(spark, dest) == [2, 3]
    assert not runs._create(spark, f"{dest}/_commits/{3:012d}", "{}")


def test_units_without_rows_are_emptied(spark, tmp_path):
    dest = str(tmp_path / "packed")
    pack(spark, dest, 1, 3, strategies=["random"])
    run, _ = runs.new_run(dest)
    runs.commit(spark, dest, run, ["layout=random-42/dataset=train"])
    assert read_packed(spark, dest).collect() == [] and runs.units(spark, dest) == {}
    assert read_packed(spark, dest, layout="random-42").columns == read_packed(spark, dest).columns


def test_folders_without_commits_are_read_as_they_are(spark, tmp_path):
    dest, plain = str(tmp_path / "packed"), str(tmp_path / "plain")
    pack(spark, dest, 1, 3)
    read_packed(spark, dest).write.partitionBy("layout", "dataset", "file").parquet(plain)
    assert content(spark, plain) == content(spark, dest) and runs.units(spark, plain) is None


def test_experiments_choose_directories(spark, tmp_path):
    dest = str(tmp_path / "packed")
    names = ["RPE-01", "RPE-02", "U2OS_p1-03"]
    some, data = sites(spark, experiment=names[0]), planes(spark, 1, experiment=names[0])
    for name in names[1:]:
        some = some.unionByName(sites(spark, experiment=name))
        data = data.unionByName(planes(spark, 1, experiment=name))
    jobs.pack_images(some, data, dest, channels=(1, 2), per_file=7)
    chosen = read_packed(spark, dest, experiments=["RPE-02", "U2OS_p1-03"])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract(file" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert {r.experiment for r in chosen.collect()} == {"RPE-02", "U2OS_p1-03"}
    assert chosen.count() == 2 * 2 * 6
    grouped = chosen.where("layout like 'by%'")
    assert {f.split("file=")[1].split("/")[0] for f in _opened(grouped)} == {
        "RPE-02_p1_s1", "U2OS_p1-03_p1_s1"}
    assert read_packed(spark, dest, experiments=[]).count() == 0


def _opened(df):
    return {r[0] for r in df.select(F.input_file_name()).collect()}


# --- arrays --------------------------------------------------------------------

def image_rows(spark, shapes):
    rng = np.random.default_rng(0)
    images, rows = {}, []
    for i, (h, w, c) in enumerate(shapes):
        pixels = rng.integers(0, 256, (h, w, c)).astype(np.uint8)
        rows.append(("train", "RPE-01", 1, f"B{i:02d}", 1, h, w, c, bytearray(pixels.tobytes())))
        images[f"train/RPE-01/Plate1/B{i:02d}_s1"] = pixels
    return images, spark.createDataFrame(
        rows, "dataset string, experiment string, plate int, well string, site int, height int, "
              "width int, channels int, image binary")


SHAPES = [(8, 8, 2), (7, 5, 2), (3, 11, 1), (1, 1, 3), (16, 4, 2)]


@pytest.mark.parametrize("chunk", [1, 3, 4, 64])
@pytest.mark.parametrize("dtype", ["<u2", "uint8"])
def test_arrays_come_back_whole(spark, chunk, dtype):
    images, df = image_rows(spark, SHAPES)
    got = assemble_arrays(to_chunks(df, chunk, dtype)).collect()
    assert len(got) == len(images)
    for r in got:
        pixels = np.frombuffer(r.image, dtype).reshape(r.height, r.width, r.channels)
        assert np.array_equal(pixels, images[r.array_path])


@pytest.mark.parametrize("window", [(0, 0, 4, 4), (2, 3, 3, 9), (5, 1, 100, 1), (0, 0, 99, 99), (6, 6, 1, 1)])
def test_windows_equal_slices(spark, window):
    images, df = image_rows(spark, SHAPES)
    top, left, height, width = window
    got = {r.array_path: np.frombuffer(r.image, "<u2").reshape(r.height, r.width, r.channels)
           for r in read_window(to_chunks(df, 3), *window).collect()}
    expected = {k: v[top:top + height, left:left + width] for k, v in images.items()}
    assert set(got) == {k for k, v in expected.items() if v.size}
    for k, pixels in got.items():
        assert np.array_equal(pixels, expected[k])


def test_missing_and_repeated_pieces(spark):
    _, df = image_rows(spark, SHAPES)
    chunks = to_chunks(df, 4)
    lacking = chunks.where("not (well = 'B00' and cy = 1 and cx = 0)")
    for wrong in (lacking, chunks.unionByName(chunks.where("well = 'B00'"))):
        with pytest.raises(Exception, match="missing or there twice: train/RPE-01/Plate1/B00_s1"):
            assemble_arrays(wrong).select("array_path").collect()
        assert assemble_arrays(wrong, strict=False).count() == len(SHAPES) - 1
    # A window elsewhere does not mind.
    assert read_window(lacking, 0, 0, 2, 2).count() == len(SHAPES)
    for bad in ((-1, 0, 1, 1), (0, 0, 0, 1)):
        with pytest.raises(ValueError):
            read_window(chunks, *bad)


def test_windows_are_pushed_to_the_scan(spark, tmp_path):
    dest = str(tmp_path / "arrays")
    data = planes(spark, 3, size=16)
    jobs.convert_images(sites(spark), data, dest, (1, 2), chunk=4, by_window=True)
    # Row groups of six pieces, one per array: each holds one place.
    chunks = read_chunks(spark, dest, experiments=["RPE-01"])
    near = read_window(chunks, 4, 8, 4, 4)
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "2000")
    pushed = near._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(key, before)
    pushed = pushed.split("PushedFilters: [")[1].split("]")[0]
    for part in ("LessThan(y0,8)", "GreaterThan(y1,4)", "LessThan(x0,12)", "GreaterThan(x1,8)"):
        assert part in pushed
    # The pieces of the window are whole, so they pass the exchange by.
    assert near.count() == len(WELLS)
    one = read_chunks(spark, dest).where(F.col("array_path") == "train/RPE-01/Plate1/B02_s1")
    assert "EqualTo(array_path" in one._jdf.queryExecution().executedPlan().toString()
    assert assemble_arrays(one).count() == 1
    assert read_chunks(spark, dest, datasets=["test"]).count() == 0
    (path,) = glob.glob(f"{dest}/run=*/dataset=train/experiment=RPE-01/*.parquet")
    import pyarrow.parquet as pq
    table = pq.read_table(path, columns=["cy", "cx"], partitioning=None)
    places = list(zip(*(table.column(c).to_pylist() for c in ("cy", "cx"))))
    assert places == sorted(places)


def test_arrays_are_committed_by_experiment(spark, tmp_path, monkeypatch):
    dest = str(tmp_path / "arrays")

    def convert(experiment, value):
        plan = cut_lineage(jobs.plan_arrays(sites(spark, experiment=experiment)))
        jobs.write_chunks(plan, planes(spark, value, experiment=experiment), dest, (1, 2), chunk=2)

    convert("RPE-01", 1)
    convert("RPE-02", 2)
    convert("RPE-01", 7)
    first = {r.experiment: r.data[0] for r in read_chunks(spark, dest).collect()}
    assert first == {"RPE-01": 8, "RPE-02": 3}
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            convert("RPE-01", 9)
    assert {r.experiment: r.data[0] for r in read_chunks(spark, dest).collect()} == first
    assert os.path.isdir(f"{dest}/_commits")
