"""Column expressions on metadata values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_id(value: Column) -> Column:
    """A label as a nullable long; null, NaN and blank mean unknown. Anything
    else that is no whole number is an error. Long numbers keep all digits."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("decimal(38,6)")
    whole = F.coalesce(number == F.floor(number), F.lit(False))
    error = F.raise_error(F.concat(F.lit("not a label: "), text)).cast("long")
    return F.when((text != "") & (F.lower(text) != "nan"), F.when(
        whole, number.cast("long")).otherwise(error))


def cell_type(experiment: Column) -> Column:
    return F.split_part(experiment, F.lit("-"), F.lit(1))
