import pytest
from pyspark.sql import functions as F

from platelake.functions.labels import label_id
from platelake.functions.paths import (
    array_path, group_file, image_path, layout_name, padded_number,
)
from platelake.operators import metadata
from platelake.schemas import SITE_COLUMNS
from platelake.sources.images import parse_paths, splits_in
from platelake.sources.metadata_csv import read_wells, site_table


@pytest.fixture
def base(tmp_path):
    files = {
        "train.csv": "id_code,experiment,plate,well,sirna\n"
                     "RPE-05_3_D19,RPE-05,3,D19,7\nHEPG2-10_1_B02,HEPG2-10,1,B02,5.0\n",
        "train_controls.csv": "id_code,experiment,plate,well,sirna,well_type\n"
                              "RPE-05_3_B03,RPE-05,3,B03,1108,positive_control\n",
        "test.csv": "id_code,experiment,plate,well\nHUVEC-17_2_C05,HUVEC-17,2,C05\n",
        # Same columns in another order: they are found by name.
        "test_controls.csv": "well_type,id_code,well,experiment,plate,sirna\n"
                             "negative_control,HUVEC-17_2_B02,B02,HUVEC-17,2,1138\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_site_table_merges_four_files(spark, base):
    table = site_table(spark, base)
    assert table.columns == list(SITE_COLUMNS)
    assert dict(table.dtypes)["sirna"] == "bigint"
    got = {tuple(r) for r in table.collect()}
    wells = {
        ("RPE-05_3_D19", "train", "RPE-05", "RPE", 3, "D19", "treatment", 7),
        ("HEPG2-10_1_B02", "train", "HEPG2-10", "HEPG2", 1, "B02", "treatment", 5),
        ("RPE-05_3_B03", "train", "RPE-05", "RPE", 3, "B03", "positive_control", 1108),
        ("HUVEC-17_2_C05", "test", "HUVEC-17", "HUVEC", 2, "C05", "treatment", None),
        ("HUVEC-17_2_B02", "test", "HUVEC-17", "HUVEC", 2, "B02", "negative_control", 1138),
    }
    assert got == {w + (s,) for w in wells for s in (1, 2)} and table.count() == 10
    head = [(r.id_code, r.site) for r in metadata.head(table).collect()]
    assert head == [("HUVEC-17_2_B02", 1), ("HUVEC-17_2_B02", 2), ("HUVEC-17_2_C05", 1),
                    ("HUVEC-17_2_C05", 2), ("HEPG2-10_1_B02", 1)]


def test_controls_are_not_opened_when_unwanted(spark, base, tmp_path):
    (tmp_path / "train_controls.csv").unlink()
    (tmp_path / "test_controls.csv").unlink()
    table = site_table(spark, base, include_controls=False)
    assert table.count() == 6
    assert {r.well_type for r in table.collect()} == {"treatment"}


def test_csv_types_are_fixed(spark, base):
    assert dict(read_wells(spark, base, "train").dtypes) == {
        "id_code": "string", "experiment": "string", "plate": "int", "well": "string",
        "sirna": "string"}


def test_selections(spark, base):
    table = site_table(spark, base)
    assert metadata.select_sites(table, ["train"]).count() == 4
    assert metadata.select_sites(table, experiments=["HUVEC-17"]).count() == 2
    assert metadata.select_sites(table, well_type=None).count() == 10


def test_labels(spark):
    values = spark.createDataFrame([(float("nan"),), (5.0,), (None,)], "v double")
    assert [r[0] for r in values.select(label_id(F.col("v"))).collect()] == [None, 5, None]
    texts = spark.createDataFrame([("NaN",), ("5.0",), ("",), ("12",)], "v string")
    assert [r[0] for r in texts.select(label_id(F.col("v"))).collect()] == [None, 5, None, 12]


def test_paths(spark):
    row = spark.createDataFrame(
        [("train", "RPE-05", 3, "D19", 2, 1)],
        "dataset string, experiment string, plate int, well string, site int, channel int")
    got = row.select(
        image_path(), image_path("root/"), array_path(), group_file(),
        layout_name("random", F.lit(42))).first()
    assert list(got) == [
        "train/RPE-05/Plate3/D19_s2_w1.png", "root/train/RPE-05/Plate3/D19_s2_w1.png",
        "train/RPE-05/Plate3/D19_s2", "RPE-05_p3_s2", "random-42"]
    numbers = spark.createDataFrame([(1,), (999,), (1000,)], "n int")
    assert [r[0] for r in numbers.select(padded_number(F.col("n"))).collect()] == [
        "001", "999", "1000"]


def test_paths_that_do_not_parse_are_kept(spark):
    paths = spark.createDataFrame([
        ("file:/a/b/train/RPE-05/Plate3/D19_s2_w6.png",), ("a/train/notes.txt",),
        ("a/b/c/d/e/f",), ("train/RPE-05/Plate3/D19_s2_w6.png",),
        ("a/test/E/Plate1/d19_s2_w6.png",)], "path string")
    rows = {r.path: r for r in parse_paths(paths).collect()}
    good = rows["file:/a/b/train/RPE-05/Plate3/D19_s2_w6.png"]
    assert (good.dataset, good.experiment, good.plate, good.well, good.site, good.channel) == (
        "train", "RPE-05", 3, "D19", 2, 6)
    assert [rows[p].parsed for p in ("a/train/notes.txt", "a/b/c/d/e/f",
                                     "train/RPE-05/Plate3/D19_s2_w6.png",
                                     "a/test/E/Plate1/d19_s2_w6.png")] == [
        False, False, True, False]
    assert all(rows["a/b/c/d/e/f"][c] is None for c in ("dataset", "plate", "channel"))
    assert {r.dataset for r in splits_in(paths, "a").collect()} == {"train", "test"}


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.range(100).select(
        F.col("id").cast("string").alias("id_code"), F.lit("RPE-01").alias("experiment"),
        F.lit(1).alias("plate"), F.lit("B02").alias("well"), F.col("id").alias("sirna"),
    ).write.parquet(str(tmp_path / "wells"))
    wells = spark.read.parquet(str(tmp_path / "wells"))
    table = metadata.merge_wells({"train": (wells, None), "test": (wells, None)})
    wanted = metadata.select_sites(table, ["train"]).where(F.col("plate") == 1).select("id_code")
    text = wanted._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(plate,1)" in text and text.count("FileScan") == 1
    assert "sirna" not in text


def test_labels_keep_digits_and_refuse_text(spark):
    big = 9007199254740993
    longs = spark.createDataFrame([(big,), (None,)], "v long")
    assert [r[0] for r in longs.select(label_id(F.col("v"))).collect()] == [big, None]
    for bad in ("abc", "1.5", "inf"):
        with pytest.raises(Exception, match="not a label"):
            spark.createDataFrame([(bad,)], "v string").select(label_id(F.col("v"))).collect()
