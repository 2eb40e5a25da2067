"""Column lists, schemas and the constants every other module shares."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of splits, plan strategies and defaults.
SPLITS = ("test", "train")
TREATMENT = "treatment"
STRATEGIES = ("random", "by_exp_plate_site")
CHANNELS = (1, 2, 3, 4, 5, 6)
SITES = (1, 2)
ROWS_PER_FILE = 308
SEED = 42
BATCH_SIZE = 512

# Display colour and intensity range of each channel,
# as (channel, red, green, blue, low, high).
COLOUR_MAP = (
    (1, 19, 0, 249, 0, 51),
    (2, 42, 255, 31, 0, 107),
    (3, 255, 0, 25, 0, 64),
    (4, 45, 255, 252, 0, 191),
    (5, 250, 0, 253, 0, 89),
    (6, 254, 255, 40, 0, 191),
)

# Published pixel mean and deviation of each channel,
# as (channel, mean, std).
PIXEL_STATS = (
    (1, 6.74696984, 7.95876312),
    (2, 14.74640167, 12.17305868),
    (3, 10.51260864, 5.86172946),
    (4, 10.45369445, 7.83451711),
    (5, 5.49959796, 4.701167),
    (6, 9.81545561, 5.43130431),
)

# Address of one imaged site, and of one channel file of it.
SITE_KEY = ("dataset", "experiment", "plate", "well", "site")
IMAGE_KEY = SITE_KEY + ("channel",)

# Wells may repeat an address, so a row is identified by address and id_code.
ROW_KEY = SITE_KEY + ("id_code",)

SITE_COLUMNS = (
    "id_code", "dataset", "experiment", "cell_type", "plate", "well",
    "well_type", "sirna", "site",
)

# The features a packed record carries besides its pixels.
RECORD_COLUMNS = (
    "well", "well_type", "experiment", "plate", "site", "cell_type", "sirna",
)

# Directory columns of a packed tree. All text, so "001" stays "001".
PACK_DIRS = ("layout", "dataset", "file")

# Directory columns of a tree of chunked arrays.
ARRAY_DIRS = ("dataset", "experiment")

# One decoded channel file.
PLANES = T.StructType([
    T.StructField("plate", T.IntegerType()),
    T.StructField("well", T.StringType()),
    T.StructField("site", T.IntegerType()),
    T.StructField("channel", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("readable", T.BooleanType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("experiment", T.StringType()),
])

PACKED = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("image", T.BinaryType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("well", T.StringType()),
    T.StructField("well_type", T.StringType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("plate", T.IntegerType()),
    T.StructField("site", T.IntegerType()),
    T.StructField("cell_type", T.StringType()),
    T.StructField("sirna", T.LongType()),
    T.StructField("layout", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("file", T.StringType()),
])

# One piece of a chunked array: rows [y0, y1) and columns [x0, x1) of an image.
CHUNK_TABLE = T.StructType([
    T.StructField("array_path", T.StringType()),
    T.StructField("plate", T.IntegerType()),
    T.StructField("well", T.StringType()),
    T.StructField("site", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("cy", T.IntegerType()),
    T.StructField("cx", T.IntegerType()),
    T.StructField("rows", T.IntegerType()),
    T.StructField("cols", T.IntegerType()),
    T.StructField("y0", T.IntegerType()),
    T.StructField("y1", T.IntegerType()),
    T.StructField("x0", T.IntegerType()),
    T.StructField("x1", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("experiment", T.StringType()),
])
