"""Column expressions that build and take apart file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: <dataset>/<experiment>/Plate<p>/<well>_s<site>_w<channel>.png
IMAGE_PATTERN = (
    r"([^/]+)/([^/]+)/Plate([0-9]+)/([A-Z][0-9]{2})_s([0-9]+)_w([0-9]+)[.]png$"
)

# Stands between the parts of a path while it is taken apart.
_MARK = "\u0001"


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def image_path(root: str | None = None) -> Column:
    """Path of the channel file a row (IMAGE_KEY columns) stands for."""
    tail = F.concat(
        _text("well"), F.lit("_s"), _text("site"),
        F.lit("_w"), _text("channel"), F.lit(".png"),
    )
    parts = [_text("dataset"), _text("experiment"),
             F.concat(F.lit("Plate"), _text("plate")), tail]
    if root:
        parts.insert(0, F.lit(root.rstrip("/")))
    return F.concat_ws("/", *parts)


def with_path_parts(df: DataFrame, path: Column, out: str) -> DataFrame:
    """Adds the parts of an image path as an array of six, or of one if the
    path does not parse.

    The array comes from a generator: filters on anything derived from it,
    also those Spark infers from joins, then stay above and do not repeat the
    regular expression.
    """
    fields = F.split(
        F.regexp_replace(
            path, "^(?:.*/)?" + IMAGE_PATTERN, _MARK.join(f"${i}" for i in range(1, 7))
        ),
        _MARK,
    )
    return df.select("*", F.explode(F.array(fields)).alias(out))


def key_columns(parts: Column) -> dict[str, Column]:
    """IMAGE_KEY columns from path parts; all null if the path did not parse."""

    def part(i: int) -> Column:
        return F.when(F.size(parts) == 6, F.get(parts, F.lit(i)))

    return {
        "dataset": part(0),
        "experiment": part(1),
        "plate": part(2).cast("int"),
        "well": part(3),
        "site": part(4).cast("int"),
        "channel": part(5).cast("int"),
    }


def padded_number(number: Column) -> Column:
    """At least three digits. lpad alone would cut 1000 down to 100."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0"))


def group_file() -> Column:
    """File name of the grouped layout."""
    return F.concat(
        _text("experiment"), F.lit("_p"), _text("plate"), F.lit("_s"), _text("site")
    )


# Fixed value: <experiment>_p<plate>_s<site>, as group_file writes it.
GROUP_PATTERN = r"^(.*)_p-?[0-9]+_s-?[0-9]+$"


def file_experiment(file: Column) -> Column:
    """The experiment a file of the grouped layout is of."""
    return F.regexp_extract(file, GROUP_PATTERN, 1)


def layout_name(strategy: str, seed: Column) -> Column:
    return F.concat(F.lit(strategy + "-"), seed.cast("string"))


def array_path() -> Column:
    """Path of the chunked array of a site."""
    return F.concat_ws(
        "/", _text("dataset"), _text("experiment"),
        F.concat(F.lit("Plate"), _text("plate")),
        F.concat(_text("well"), F.lit("_s"), _text("site")),
    )
