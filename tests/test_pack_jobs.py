import glob
import json
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from platelake.operators.stack import load_site, load_site_rgb, load_sites, load_sites_rgb
from platelake.plans import jobs, packing, placing
from platelake.plans.ingest import ingest_planes
from platelake.schemas import PIXEL_STATS
from platelake.session import cut_lineage
from platelake.sources.images import (
    list_experiments, list_images, list_splits, read_planes, scan_images, scan_keys,
)
from platelake.sources.packed import read_chunks, read_packed
from platelake.streaming.feed import feed_examples, stream_packed
from tests.screens import image_file, site_frame, site_rows, write_images, write_png

KEY = ("dataset", "experiment", "plate", "well", "site")


def _key(row):
    return tuple(row[k] for k in KEY)


def _image(row):
    return np.frombuffer(row.image, np.uint8).reshape(row.height, row.width, row.channels)


def _commit(dest):
    with open(max(glob.glob(f"{dest}/_commits/[0-9]*"))) as file:
        return json.load(file)


def _file_rows(dest):
    """{(layout, dataset, file): [part files]} of the latest run of each unit"""
    found = {}
    current = {f"run={run}/{unit}" for unit, run in _commit(dest).items()}
    for path in glob.glob(f"{dest}/run=*/layout=*/dataset=*/file=*/*.parquet"):
        run, *dirs = path[len(dest) + 1:].split("/")[:4]
        if "/".join([run, *dirs[:2]]) not in current:
            continue
        found.setdefault(tuple(d.split("=")[1] for d in dirs), []).append(path)
    return found


def test_random_packing_end_to_end(spark, tmp_path):
    rows = site_rows(wells=6)
    root, dest = str(tmp_path / "raw"), str(tmp_path / "packed")
    images = write_images(root, rows, (1, 2), size=512)
    manifest = jobs.pack(
        spark, site_frame(spark, rows), root, dest, ["random"], (1, 2), per_file=3)
    assert {m.dest_path: m.n_sites for m in manifest.collect()} == {
        f"random-42/{d}/{n}": 3 for d in ("train", "test") for n in ("001", "002")}
    files = _file_rows(dest)
    assert {k: len(v) for k, v in files.items()} == {
        ("random-42", d, n): 1 for d in ("train", "test") for n in ("001", "002")}
    for (path,) in files.values():
        table = pq.read_table(path, partitioning=None)
        assert table.column("pos").to_pylist() == [1, 2, 3]
        assert pq.ParquetFile(path).metadata.row_group(0).column(1).compression == "ZSTD"
    records = read_packed(spark, dest).collect()
    assert len(records) == 12
    for r in records:
        assert _image(r).shape == (512, 512, 2)
        assert np.array_equal(_image(r), images[_key(r)])
        assert (r.well_type, r.sirna) == ("treatment", 1 if r.dataset == "train" else None)


def test_grouped_packing_end_to_end(spark, tmp_path):
    rows = site_rows(wells=6, plates=2, sites=2)
    root, dest = str(tmp_path / "raw"), str(tmp_path / "packed")
    images = write_images(root, rows, (1, 2))
    for _ in range(2):  # the second run replaces the files of the first
        jobs.pack(spark, site_frame(spark, rows), root, dest, ["by_exp_plate_site"], (1, 2))
    assert read_packed(spark, dest).count() == len(rows)
    expected = {("by_exp_plate_site-42", r[1], f"{r[2]}_p{r[4]}_s{r[8]}") for r in rows}
    files = _file_rows(dest)
    assert set(files) == expected and {len(v) for v in files.values()} == {1}
    for r in read_packed(spark, dest).collect():
        assert np.array_equal(_image(r), images[_key(r)])


def test_channel_order_is_the_argument_order(spark, tmp_path):
    rows = site_rows(datasets=("train",), wells=2)
    root = str(tmp_path / "raw")
    images = write_images(root, rows, (1, 2, 3))
    keys = site_frame(spark, rows)
    for r in load_sites(spark, keys, root, (3, 1)).collect():
        assert np.array_equal(_image(r), images[_key(r)][:, :, [2, 0]])
    for r in load_sites(spark, keys, root, (2, 2)).collect():
        assert np.array_equal(_image(r), images[_key(r)][:, :, [1, 1]])


def test_only_wanted_files_are_read(spark, tmp_path):
    rows = site_rows(datasets=("train",), experiments=2, plates=2, wells=4, sites=2)
    root = str(tmp_path / "raw")
    images = write_images(root, rows, (1, 2, 3))
    some = [r for r in rows if (r[2], r[4], r[5], r[8]) == ("RPE-02", 1, "C03", 2)]
    keys = site_frame(spark, some + some)
    read = scan_keys(spark, root, keys, (3, 1)).inputFiles()
    assert sorted(f.split("/raw/")[1] for f in read) == [
        "train/RPE-02/Plate1/C03_s2_w1.png", "train/RPE-02/Plate1/C03_s2_w3.png"]
    (one,) = load_sites(spark, keys, root, (3, 1)).collect()
    assert np.array_equal(_image(one), images[_key(one)][:, :, [2, 0]])


def test_keys_without_directories(spark, tmp_path):
    rows = site_rows(datasets=("train",), wells=2)
    root = str(tmp_path / "raw")
    write_images(root, rows, (1, 2))
    keys = site_frame(spark, rows)
    assert load_sites(spark, keys.limit(0), root, (1, 2)).count() == 0
    for column, value in (("experiment", "RPE-77"), ("plate", 9), ("dataset", None)):
        other = keys.withColumn(column, F.lit(value).cast(keys.schema[column].dataType))
        assert load_sites(spark, keys.union(other), root, (1, 2), strict=False).count() == 2
        with pytest.raises(Exception, match="no image file"):
            load_sites(spark, keys.union(other), root, (1, 2)).collect()


def test_one_site_and_its_colours(spark, tmp_path):
    rows = site_rows(datasets=("train",), wells=3)
    root, channels = str(tmp_path / "raw"), (1, 2, 3, 4, 5, 6)
    images = write_images(root, rows, channels)
    _, dataset, experiment, _, plate, well, _, _, site = rows[1]
    (one,) = load_site(spark, dataset, experiment, plate, well, site, root).collect()
    pixels = images[dataset, experiment, plate, well, site]
    assert np.array_equal(_image(one), pixels)

    def expected(values):
        from platelake.schemas import COLOUR_MAP
        total = np.zeros(values.shape[:2] + (3,), int)
        for i, (_, r, g, b, low, high) in enumerate(COLOUR_MAP):
            share = np.minimum(1, values[:, :, i] / 255 / ((high - low) / 255) + low / 255)
            total += (share[:, :, None] * np.array([r, g, b])).astype(int)
        return np.minimum(total, 255)

    (rgb,) = load_site_rgb(spark, dataset, experiment, plate, well, site, root).collect()
    assert rgb.channels == 3 and np.array_equal(_image(rgb), expected(pixels))
    for r in load_sites_rgb(spark, site_frame(spark, rows), root).collect():
        assert np.array_equal(_image(r), expected(images[_key(r)]))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_site(spark, dataset, experiment, plate, "Z99", site, root).collect()


def test_missing_file_fails_or_drops_the_site(spark, tmp_path):
    rows = site_rows(datasets=("train",), wells=4)
    root = str(tmp_path / "raw")
    write_images(root, rows[:3], (1, 2))
    write_png(image_file(root, *rows[3][1:3], *rows[3][4:6], 1, 1), np.zeros((16, 16), np.uint8))
    sites = site_frame(spark, rows)
    with pytest.raises(jobs.MissingImages, match=rows[3][5]):
        jobs.pack(spark, sites, root, str(tmp_path / "a"), channels=(1, 2))
    jobs.pack(spark, sites, root, str(tmp_path / "b"), ["random"], (1, 2), strict=False)
    assert read_packed(spark, str(tmp_path / "b")).count() == 3
    # The same for direct loads, also when there is no file at all.
    absent = site_frame(spark, rows[:1]).withColumn("well", F.lit("O23"))
    with pytest.raises(Exception, match="missing, unreadable"):
        load_sites(spark, sites, root, (1, 2)).collect()
    with pytest.raises(Exception, match="no image file"):
        load_sites(spark, absent, root, (1, 2)).collect()
    assert load_sites(spark, sites, root, (1, 2), strict=False).count() == 3


@pytest.mark.parametrize("harm", ["junk", "size", "colour"])
def test_broken_planes_are_found(spark, tmp_path, harm):
    rows = site_rows(datasets=("train",), wells=3)
    root = str(tmp_path / "raw")
    write_images(root, rows, (1, 2))
    path = image_file(root, *rows[0][1:3], *rows[0][4:6], 1, 2)
    if harm == "junk":
        with open(path, "wb") as file:
            file.write(b"not an image")
    elif harm == "size":
        write_png(path, np.zeros((8, 8), np.uint8))
    else:
        write_png(path, np.zeros((16, 16, 3), np.uint8))
    sites = site_frame(spark, rows)
    with pytest.raises(Exception, match="missing, unreadable or odd-sized"):
        jobs.pack(spark, sites, root, str(tmp_path / "a"), ["random"], (1, 2))
    jobs.pack(spark, sites, root, str(tmp_path / "b"), ["random"], (1, 2), strict=False)
    assert read_packed(spark, str(tmp_path / "b")).count() == 2


def test_listing_and_split_discovery(spark, tmp_path):
    rows = site_rows(wells=2)
    root = str(tmp_path / "raw")
    write_images(root, rows, (1,))
    os.makedirs(f"{root}/other")
    with open(f"{root}/train/notes.txt", "w") as file:
        file.write("no image")
    assert list_splits(spark, root) == ["test", "train"]
    assert list_images(spark, root).count() == 4
    assert list_images(spark, root, ["train"]).count() == 2
    assert list_images(spark, root, experiments=["HUVEC-01"]).count() == 2
    assert "content" not in list_images(spark, root)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="two splits"):
        twin = [r for r in rows if r[1] == "train"]
        twin += [(r[0], "test") + r[2:] for r in twin]
        jobs.pack(spark, site_frame(spark, twin), root, str(tmp_path / "x"))


def _plan_and_images(spark, tmp_path, copies=1):
    rows = site_rows(datasets=("train",), wells=8)
    root = str(tmp_path / "raw")
    images = write_images(root, rows, (1, 2))
    rows = rows[1:] + [(f"{rows[0][0]}-{i}",) + rows[0][1:] for i in range(copies)]
    plan = cut_lineage(packing.plan_random(site_frame(spark, rows), 5))
    return rows, images, plan, scan_images(spark, root)


def test_planes_are_shuffled_once(spark, tmp_path):
    _, _, plan, planes = _plan_and_images(spark, tmp_path)
    placed = placing.place_images(plan, planes, ("layout", "dataset", "file"), (1, 2))
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    # What follows the broadcast holds keys only.
    planes_side, keys_side = text.split("BroadcastExchange", 1)
    assert "Scan image" in planes_side and "Scan image" not in keys_side
    assert planes_side.count("Exchange shufflepartitionidpassthrough") == 1
    assert planes_side.count("Exchange") == 1 and planes_side.count("Sort [") == 1


@pytest.mark.parametrize("hot_rows", [4096, 10])
def test_shuffled_plan_and_hot_addresses_give_the_same(spark, tmp_path, hot_rows):
    rows, images, plan, planes = _plan_and_images(spark, tmp_path, copies=40)
    placed = placing.place_images(
        plan, planes, ("layout", "dataset", "file"), (1, 2), broadcast_bytes=0,
        image_bytes=placing.HOT_ADDRESS_BYTES // hot_rows)
    got = placed.collect()
    assert sorted(r.id_code for r in got) == sorted(r[0] for r in rows)
    for r in got:
        assert np.array_equal(_image(r), images[_key(r)])


def test_large_file_is_split_into_ordered_parts(spark, tmp_path):
    rows, _, plan, planes = _plan_and_images(spark, tmp_path, copies=40)
    dest = str(tmp_path / "packed")
    jobs.write_packed(plan, planes, dest, (1, 2), part_rows=2)
    records = read_packed(spark, dest)
    assert records.count() == len(rows)
    for paths in _file_rows(dest).values():
        positions = []
        for path in paths:
            own = pq.read_table(path, partitioning=None).column("pos").to_pylist()
            assert own == sorted(own)
            positions += own
        assert sorted(positions) == list(range(1, len(positions) + 1))


def test_row_groups_are_small(spark, tmp_path, monkeypatch):
    _, _, plan, planes = _plan_and_images(spark, tmp_path, copies=40)
    monkeypatch.setattr("platelake.session.ROW_GROUP_BYTES", 2 * 512 * 512 * 6)
    dest = str(tmp_path / "packed")
    jobs.write_packed(plan, planes, dest, (1, 2))
    for paths in _file_rows(dest).values():
        for path in paths:
            meta = pq.ParquetFile(path).metadata
            groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
            assert max(g.num_rows for g in groups) <= 2
            image = groups[0].column(meta.schema.names.index("image"))
            assert "RLE_DICTIONARY" not in image.encodings


def test_ingested_planes_pack_the_same(spark, tmp_path):
    rows = site_rows(wells=4, experiments=2)
    root, table = str(tmp_path / "raw"), str(tmp_path / "planes")
    images = write_images(root, rows, (1, 2))
    done = [("test", "HUVEC-01"), ("test", "HUVEC-02"), ("train", "RPE-01"), ("train", "RPE-02")]
    assert list_experiments(spark, root) == done
    assert ingest_planes(spark, root, table, jobs_at_once=2) == done
    assert ingest_planes(spark, root, table) == []
    os.remove(f"{table}/dataset=train/experiment=RPE-02/_SUCCESS")
    assert ingest_planes(spark, root, table) == [("train", "RPE-02")]
    planes = read_planes(spark, table)
    assert planes.count() == 2 * len(rows)
    arrays = str(tmp_path / "arrays")
    jobs.convert_images(site_frame(spark, rows), planes, arrays, (1, 2), chunk=16)
    chunks = read_chunks(spark, arrays).collect()
    assert len(chunks) == len(rows)
    for c in chunks:
        pixels = np.frombuffer(c.data, "<u2").reshape(c.rows, c.cols, c.channels)
        assert np.array_equal(pixels, images[_key(c)])
    dest = str(tmp_path / "packed")
    jobs.pack_images(site_frame(spark, rows), planes, dest, channels=(1, 2), per_file=3,
                     unique=True)
    records = read_packed(spark, dest, "random-42").collect()
    assert len(records) == len(rows)
    for r in records:
        assert np.array_equal(_image(r), images[_key(r)])


def test_ingest_notices_new_and_changed_files(spark, tmp_path):
    rows = site_rows(datasets=("train",), wells=3, experiments=2)
    root, table = str(tmp_path / "raw"), str(tmp_path / "planes")
    write_images(root, rows, (1, 2))
    assert len(ingest_planes(spark, root, table)) == 2
    assert ingest_planes(spark, root, table) == []
    first = (root, *rows[0][1:3], *rows[0][4:6], 1)
    write_png(image_file(*first, 3), np.zeros((16, 16), np.uint8))
    os.utime(image_file(*first, 3), (1, 1))  # told by the number of files
    assert ingest_planes(spark, root, table) == [("train", "RPE-01")]
    later = os.path.getmtime(f"{table}/dataset=train/experiment=RPE-01/_SUCCESS") + 60
    os.utime(image_file(*first, 3), (later, later))
    assert ingest_planes(spark, root, table) == [("train", "RPE-01")]
    assert read_planes(spark, table).count() == 2 * len(rows) + 1


def test_function_over_files(spark, tmp_path):
    rows, _, plan, planes = _plan_and_images(spark, tmp_path, copies=4)
    placed = placing.place_images(plan, planes, ("layout", "dataset", "file"), (1, 2))

    def summarise(batches):
        import pandas as pd
        files, positions = [], []
        for batch in batches:
            files += list(batch["file"])
            positions += list(batch["pos"])
        yield pd.DataFrame({"file": files[:1], "files": [len(set(files))] if files else [],
                            "ordered": [positions == sorted(positions)] if files else []})

    got = placing.map_files(placed, summarise, "file string, files int, ordered boolean").collect()
    assert sorted(r.file for r in got) == ["001", "002", "003"]
    assert all(r.files == 1 and r.ordered for r in got)


def _csv(path, header, rows):
    with open(path, "w") as file:
        file.write(",".join(header) + "\n")
        file.writelines(",".join(str(v) for v in r) + "\n" for r in rows)


def test_convert_all_writes_chunked_arrays(spark, tmp_path):
    rows = site_rows(wells=2, sites=2)
    root, meta, dest = (str(tmp_path / d) for d in ("raw", "meta", "arrays"))
    images = write_images(root, rows, (1, 2, 3, 4, 5, 6), size=512)
    os.makedirs(meta)
    for dataset in ("train", "test"):
        wells = [r for r in rows if r[1] == dataset and r[8] == 1]
        _csv(f"{meta}/{dataset}.csv", ["id_code", "experiment", "plate", "well"],
             [(r[0], r[2], r[4], r[5]) for r in wells])
    for _ in range(2):  # a second run replaces the first
        jobs.convert_all(spark, meta, root, dest)
    chunks = read_chunks(spark, dest).collect()
    assert len(chunks) == len(rows)
    for c in chunks:
        assert c.array_path == f"{c.dataset}/{c.experiment}/Plate{c.plate}/{c.well}_s{c.site}"
        pixels = np.frombuffer(c.data, "<u2").reshape(c.rows, c.cols, c.channels)
        assert np.array_equal(pixels, images[_key(c)])


def test_stream_equals_batch(spark, tmp_path):
    rows = site_rows(wells=6)
    root, dest = str(tmp_path / "raw"), str(tmp_path / "packed")
    images = write_images(root, rows, (1, 2, 3, 4, 5, 6))
    jobs.pack(spark, site_frame(spark, rows), root, dest, ["random"], per_file=2)
    out = str(tmp_path / "out")
    query = feed_examples(
        stream_packed(spark, dest, "random-42", files_per_trigger=2), out,
        str(tmp_path / "state"), PIXEL_STATS, drain=True)
    query.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == 6 and {r.label for r in got} == {1}
    mean = np.array([s[1] for s in PIXEL_STATS], np.float32)
    std = np.array([s[2] for s in PIXEL_STATS], np.float32)
    for r in got:
        pixels = images["train", r.experiment, r.plate, r.well, r.site]
        assert np.array_equal(
            np.frombuffer(r.image, "<f4").reshape(pixels.shape),
            (pixels.astype(np.float32) - mean) / std)


def test_arrays_with_a_shuffled_plan_and_small_parts(spark, tmp_path):
    rows = site_rows(wells=5)
    root, dest = str(tmp_path / "raw"), str(tmp_path / "arrays")
    images = write_images(root, rows, (1, 2))
    plan = cut_lineage(jobs.plan_arrays(site_frame(spark, rows + rows)))
    jobs.write_chunks(plan, scan_images(spark, root), dest, (2, 1), chunk=9, dtype="uint8",
                      broadcast_bytes=0, part_rows=2)
    chunks = read_chunks(spark, dest).collect()
    assert len(chunks) == 4 * len(rows)
    for c in chunks:
        pixels = np.frombuffer(c.data, np.uint8).reshape(c.rows, c.cols, 2)
        expected = images[_key(c)][c.cy * 9:c.cy * 9 + 9, c.cx * 9:c.cx * 9 + 9, ::-1]
        assert np.array_equal(pixels, expected)
    assert len(glob.glob(f"{dest}/run=*/dataset=train/experiment=RPE-01/*.parquet")) == 3


def test_nothing_to_pack(spark, tmp_path):
    rows = site_rows(datasets=("train",), wells=2)
    root, dest = str(tmp_path / "raw"), str(tmp_path / "packed")
    write_images(root, rows, (1, 2))
    controls = site_frame(spark, rows).withColumn("well_type", F.lit("negative_control"))
    assert jobs.pack(spark, controls, root, dest, channels=(1, 2)).count() == 0
    with pytest.raises(ValueError, match="no split directory"):
        jobs.pack(spark, controls, str(tmp_path), dest)


def _site_planes(spark, wells, dataset="train", value=1):
    rows = [(dataset, "RPE-01", 1, w, 1, c, 2, 2, bytearray([value] * 4)) for w in wells for c in (1, 2)]
    return spark.createDataFrame(rows, "dataset string, experiment string, plate int, well string, "
                                 "site int, channel int, height int, width int, data binary")


def _sites(spark, wells, dataset="train"):
    return spark.createDataFrame(
        [(w, dataset, "RPE-01", "RPE", 1, w, "treatment", 1, 1) for w in wells],
        "id_code string, dataset string, experiment string, cell_type string, plate int, well string, "
        "well_type string, sirna long, site int")


def test_packing_again_leaves_no_stale_file(spark, tmp_path):
    wells, dest = [f"B{i:02d}" for i in range(12)], str(tmp_path / "packed")
    sites, planes = _sites(spark, wells), _site_planes(spark, wells)
    for per_file, files in ((3, 4), (6, 2)):
        jobs.pack_images(sites, planes, dest, ["random"], (1, 2), per_file=per_file)
        records = read_packed(spark, dest)
        assert records.count() == 12 and records.select("file").distinct().count() == files


def test_manifest_of_what_was_written(spark, tmp_path):
    wells = [f"B{i:02d}" for i in range(10)]
    planes = _site_planes(spark, wells).where("not (well = 'B03' and channel = 2)")
    got = jobs.pack_images(_sites(spark, wells), planes, str(tmp_path / "p"), ["random"], (1, 2),
                           per_file=5, strict=False).collect()
    assert sorted((r.n_sites, r.first_pos, r.last_pos) for r in got) == [(4, 1, 4), (5, 1, 5)]


def test_planes_that_differ_are_an_error(spark, tmp_path):
    wells = ["B01", "B02"]
    sites, planes = _sites(spark, wells), _site_planes(spark, wells)
    same = planes.union(planes)
    jobs.pack_images(sites, same, str(tmp_path / "a"), ["random"], (1, 2))
    assert read_packed(spark, str(tmp_path / "a")).count() == 2
    other = planes.union(_site_planes(spark, ["B02"], value=9))
    with pytest.raises(Exception, match="differ"):
        jobs.pack_images(sites, other, str(tmp_path / "b"), ["random"], (1, 2))


def test_unknown_splits_are_errors(spark):
    with pytest.raises(Exception, match="unknown split other"):
        packing.plan_random(_sites(spark, ["B01"], "other")).collect()


def test_arrays_of_other_experiments_stay(spark, tmp_path):
    dest = str(tmp_path / "arrays")
    for dataset in ("train", "test"):
        plan = cut_lineage(jobs.plan_arrays(_sites(spark, ["B01", "B02"], dataset)))
        jobs.write_chunks(plan, _site_planes(spark, ["B01", "B02"], dataset), dest, (1, 2), chunk=2)
    assert {r.dataset for r in read_chunks(spark, dest).collect()} == {"train", "test"}
