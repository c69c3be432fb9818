"""Functions under SQL names, so that queries in SQL text reach them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from . import names


def plain(values: pa.Array) -> pa.Array:
    """Decomposed, combining marks dropped, in any script."""
    return pc.replace_substring_regex(pc.utf8_normalize(values, "NFD"), r"\p{Mn}", "")


@F.arrow_udf(StringType())
def normalise_accents(values: pa.Array) -> pa.Array:
    return plain(values)


@F.arrow_udf(StringType())
def crop_class(values: pa.Array) -> pa.Array:
    """The prefix rules for SQL text, by column; names.crop_class is the native form."""
    name = plain(pc.utf8_lower(pc.utf8_trim_whitespace(values)))
    fits = [pc.fill_null(pc.starts_with(name, prefix), False) for prefix, _ in names.PREFIX_RULES]
    return pc.case_when(pc.make_struct(*fits, field_names=[str(i) for i in range(len(fits))]), *[kind for _, kind in names.PREFIX_RULES], names.OTHER)


@F.pandas_udf(DoubleType())
def robust_spread(values: pd.Series) -> float:
    """(p95 - p5) / |median| of a group."""
    known = values.dropna()
    middle = abs(known.median()) if len(known) else 0.0
    return float((known.quantile(0.95) - known.quantile(0.05)) / middle) if middle > 0 else float("nan")


@F.udtf(returnType=StructType([StructField("tile", IntegerType()), *[StructField(side, DoubleType()) for side in ("west", "south", "east", "north")]]))
class Tiles:
    """The boxes of at most `side` degrees that cover a box, row by row."""

    def eval(self, west: float, south: float, east: float, north: float, side: float) -> Iterator[tuple]:
        columns, rows = -int(-(east - west) // side), -int(-(north - south) // side)
        for r in range(rows):
            for c in range(columns):
                yield r * columns + c, west + c * side, south + r * side, min(west + (c + 1) * side, east), min(south + (r + 1) * side, north)


def register_all(spark: SparkSession) -> list[str]:
    spark.udf.register("strip_accents", normalise_accents)
    spark.udf.register("crop_class", crop_class)
    spark.udf.register("robust_spread", robust_spread)
    spark.udtf.register("tiles", Tiles)
    return ["strip_accents", "crop_class", "robust_spread", "tiles"]
