import numpy as np
import pytest
from pyspark.sql import functions as F

from platelake.functions.tensors import (
    decode_bytes, decode_floats, false_colour, normalised, to_channel_first, unit_scaled,
)
from platelake.operators import pixels
from platelake.operators.chunks import to_chunks
from platelake.operators.stack import drop_plane_copies, load_from, stack_channels
from platelake.schemas import CHANNELS, PIXEL_STATS


def _pixel_rows(spark, rows):
    return spark.createDataFrame(rows, "site_id int, channel int, px int, val int")


GOLDEN = [
    ({1: 51}, (19, 0, 249)),
    ({4: 191}, (45, 255, 252)),
    ({2: 50}, (19, 119, 14)),
    ({c: 255 for c in CHANNELS}, (255, 255, 255)),
    ({c: 0 for c in CHANNELS}, (0, 0, 0)),
]


@pytest.mark.parametrize("values, colour", GOLDEN)
def test_false_colour_goldens(spark, values, colour):
    rows = _pixel_rows(spark, [(1, c, 0, v) for c, v in values.items()])
    assert tuple(pixels.to_rgb_rows(rows, ["site_id"]).select("r", "g", "b").first()) == colour
    raw = bytes(values.get(c, 0) for c in CHANNELS)
    image = spark.createDataFrame([(bytearray(raw),)], "image binary")
    assert tuple(image.select(false_colour(F.col("image"))).first()[0]) == colour


def test_colour_arguments(spark):
    own = ((9, 100, 50, 0, 0, 128),)
    rows = _pixel_rows(spark, [(1, 9, 0, 32), (1, 3, 0, 255)])
    got = pixels.to_rgb_rows(rows, ["site_id"], (9,), 127.5, own).select("r", "g", "b").first()
    image = spark.createDataFrame([(bytearray([32]),)], "image binary")
    raw = image.select(false_colour(F.col("image"), (9,), 127.5, own)).first()[0]
    assert tuple(got) == tuple(raw) == (50, 25, 0)


def test_row_form_equals_byte_form_for_every_value(spark):
    values = spark.range(256).select(
        F.col("id").cast("int").alias("v")).withColumn("one", F.lit(1))
    rows = values.select(
        F.col("v").alias("site_id"), F.explode(F.array(*[F.lit(c) for c in CHANNELS]))
        .alias("channel"), F.lit(0).alias("px"), F.col("v").alias("val"))
    for channel in CHANNELS:
        by_row = {r.site_id: (r.r, r.g, r.b) for r in pixels.to_rgb_rows(
            rows, ["site_id"], (channel,)).collect()}
        image = spark.createDataFrame([(bytearray(range(256)),)], "image binary")
        raw = image.select(false_colour(F.col("image"), (channel,))).first()[0]
        assert by_row == {i: tuple(raw[3 * i:3 * i + 3]) for i in range(256)}


def test_normalise(spark):
    row = pixels.normalise_rows(_pixel_rows(spark, [(1, 1, 0, 10)])).first()
    assert round(row.normalised, 6) == 0.408736
    raw = bytearray([10, 20, 30, 40, 50, 60, 0, 1, 2, 3, 4, 255])
    image = spark.createDataFrame([(raw,)], "image binary")
    mean = np.array([s[1] for s in PIXEL_STATS], np.float32)
    std = np.array([s[2] for s in PIXEL_STATS], np.float32)
    expected = (np.array(raw, np.float32).reshape(-1, 6) - mean) / std
    got = image.select(
        decode_floats(normalised(F.col("image"))).alias("a"),
        decode_floats(normalised(F.col("image"), layout="CHW")).alias("b"),
        decode_floats(unit_scaled(F.col("image"))).alias("c")).first()
    assert np.array_equal(np.float32(got.a), expected.ravel())
    assert np.array_equal(np.float32(got.b), expected.T.ravel())
    assert np.allclose(got.c, np.array(raw) / 255)
    with pytest.raises(ValueError):
        normalised(F.col("image"), layout="WHC")


def test_layouts(spark):
    # (H, W, C) = (2, 2, 3): y=1, x=0, c=2 is byte 8.
    rows = _pixel_rows(spark, [(1, 3, 2, 0)])
    index = pixels.index_rows(rows, 3, 4).first()
    assert (index.hwc_index, index.chw_index) == (8, 10)
    image = spark.createDataFrame([(bytearray(range(12)),)], "image binary")
    swapped = image.select(to_channel_first(F.col("image"), F.lit(3))).first()[0]
    assert list(swapped) == [0, 3, 6, 9, 1, 4, 7, 10, 2, 5, 8, 11]


def _planes(spark, rows):
    return spark.createDataFrame(
        [(w, c, 2, 3, bytearray(d)) for w, c, d in rows],
        "well string, channel int, height int, width int, data binary")


def test_stacking_planes(spark):
    planes = _planes(spark, [("a", 1, range(6)), ("a", 2, range(10, 16)), ("b", 1, range(6))])
    whole = stack_channels(planes, ["well"], (2, 1), strict=False).collect()
    assert [r.well for r in whole] == ["a"]
    assert list(whole[0].image) == [10, 0, 11, 1, 12, 2, 13, 3, 14, 4, 15, 5]
    flat = stack_channels(planes, ["well"], (2, 1), strict=False, layout="CHW").first()
    assert list(flat.image) == [*range(10, 16), *range(6)]
    with pytest.raises(Exception, match="missing, unreadable or odd-sized plane: b"):
        stack_channels(planes, ["well"], (1, 2)).collect()
    odd = _planes(spark, [("a", 1, range(6)), ("a", 2, range(5))])
    assert stack_channels(odd, ["well"], (1, 2), strict=False).count() == 0


def test_copies_of_a_plane_change_nothing(spark):
    planes = _planes(spark, [("a", 1, range(6)), ("a", 2, range(6))])
    first = planes.where("channel = 1")
    many = planes.unionByName(first.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500))))
                              .drop("n"))
    assert drop_plane_copies(many).count() == 2
    (one,) = stack_channels(many, ["well"], (1, 2)).collect()
    assert list(one.image) == [v for v in range(6) for _ in range(2)]
    # One that differs stays, so that stacking can refuse it.
    other = _planes(spark, [("a", 2, range(1, 7)), (None, 2, range(6)), (None, 2, range(6))])
    kept = drop_plane_copies(many.unionByName(other))
    assert sorted((str(r.well), r.channel) for r in kept.collect()) == [
        ("None", 2), ("None", 2), ("a", 1), ("a", 2), ("a", 2)]


def test_planes_without_copies_move_once(spark):
    rows = [("train", "RPE-01", 1, f"B{w:02}", 1, c, 2, 3, bytearray(range(6)))
            for w in range(2, 6) for c in (1, 2)]
    planes = spark.createDataFrame(
        rows, "dataset string, experiment string, plate int, well string, site int, channel int, "
              "height int, width int, data binary")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        loaded = load_from(planes, planes.where("well < 'B05'"), (1, 2), strict=False)
        text = loaded._jdf.queryExecution().executedPlan().toString()
        # One exchange of pixels, one of wanted keys; stacking reuses them.
        assert text.count("Exchange hashpartitioning") == text.count("Exchange") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r.well for r in loaded.collect()) == ["B02", "B03", "B04"]


def test_statistics(spark):
    rng = np.random.default_rng(3)
    data = {c: rng.integers(0, 256, 300, dtype=np.uint8) for c in (1, 2)}
    planes = spark.createDataFrame(
        [(c, bytearray(part)) for c, v in data.items() for part in np.split(v, 3)],
        "channel int, data binary")
    rows = _pixel_rows(spark, [(0, c, i, int(x)) for c, v in data.items()
                               for i, x in enumerate(v)])
    for stats in (pixels.pixel_stats(planes), pixels.pixel_stats_rows(rows)):
        for r in stats.collect():
            assert r.n == 300
            assert np.isclose(r["mean"], data[r.channel].mean())
            assert np.isclose(r["std"], data[r.channel].std())


def test_chunks_at_the_edge_are_ragged(spark):
    image = np.arange(5 * 7 * 2, dtype=np.uint8).reshape(5, 7, 2)
    stacked = spark.createDataFrame(
        [("train", "E-1", 1, "B02", 1, 5, 7, 2, bytearray(image.tobytes()))],
        "dataset string, experiment string, plate int, well string, site int, "
        "height int, width int, channels int, image binary")
    chunks = to_chunks(stacked, 3).collect()
    assert {(c.cy, c.cx): (c.rows, c.cols) for c in chunks} == {
        (0, 0): (3, 3), (0, 1): (3, 3), (0, 2): (3, 1),
        (1, 0): (2, 3), (1, 1): (2, 3), (1, 2): (2, 1)}
    for c in chunks:
        got = np.frombuffer(c.data, c.dtype).reshape(c.rows, c.cols, 2)
        assert np.array_equal(got, image[c.cy * 3:c.cy * 3 + 3, c.cx * 3:c.cx * 3 + 3])
    assert {len(c.data) for c in to_chunks(stacked, 9, "uint8").collect()} == {70}


def test_decode(spark):
    values = np.array([1, 300, 65535], "<u2")
    raw = spark.createDataFrame([(bytearray(values.tobytes()),), (None,)], "data binary")
    assert [r[0] for r in raw.select(decode_bytes(F.col("data"), "<u2")).collect()] == [
        [1, 300, 65535], None]


def test_unknown_channels_are_errors(spark):
    rows = spark.createDataFrame([("a", 1, 0, 9), ("a", 7, 0, 9)], "k string, channel int, px int, val int")
    for call in (lambda: pixels.to_rgb_rows(rows, ["k"]), lambda: pixels.normalise_rows(rows)):
        with pytest.raises(Exception, match="unknown channel 7"):
            call().collect()


def test_unusable_planes_are_left_out_and_listed(spark):
    planes = spark.createDataFrame(
        [(1, bytearray([1, 3]), True, 1, 2), (1, None, False, -1, -1), (1, bytearray(6), True, 1, 2)],
        "channel int, data binary, readable boolean, height int, width int")
    (row,) = pixels.pixel_stats(planes).collect()
    assert (row.n, row.mean) == (2, 2.0)
    assert pixels.unusable_planes(planes).count() == 2
