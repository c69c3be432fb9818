"""Pinned semantics: what counts as missing, how divisions are guarded, which of several maxima wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = -9999.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid(c: Column | str, nodata: Sequence[float] = (NODATA,)) -> Column:
    """NaN and the NoData values become NULL, so that aggregates skip them."""
    c = col(c)
    keep = ~F.isnan(c)
    for x in nodata:
        keep = keep & (c != F.lit(x))
    return F.when(keep, c)


def export(c: Column | str, nodata: float = NODATA) -> Column:
    """The way back: NULL and NaN become the NoData value."""
    return F.coalesce(valid(c), F.lit(nodata))


def in_range(c: Column | str, low: float, high: float) -> Column:
    """Values outside [low, high] are missing."""
    c = col(c)
    return F.when(c.between(low, high), c)


def nan_sum(c: Column | str) -> Column:
    """Sum that is 0 where nothing is valid."""
    return F.coalesce(F.sum(col(c).cast("double")), F.lit(0.0))


def mean(c: Column | str) -> Column:
    return F.avg(col(c).cast("double"))


def std_pop(c: Column | str) -> Column:
    return F.stddev_pop(col(c).cast("double"))


def std_samp(c: Column | str) -> Column:
    return F.stddev_samp(col(c).cast("double"))


def floored(c: Column | str, least: float) -> Column:
    """At least `least`; missing stays missing (greatest alone would fill it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(least)))


def clip(c: Column | str, low: Column | float, high: Column | float) -> Column:
    c = col(c)
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(c.isNotNull(), F.greatest(F.least(c, as_col(high)), as_col(low)))


def divide(a: Column | str, b: Column | str, otherwise: Column | float | None = None) -> Column:
    """a / b, `otherwise` where b is 0."""
    out = F.try_divide(col(a).cast("double"), col(b).cast("double"))
    return out if otherwise is None else F.when(col(b) == 0, otherwise).otherwise(out)


def zero_padded(c: Column | str, width: int = 5) -> Column:
    """Left-padded with zeros; longer strings stay whole."""
    c = col(c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def number(c: Column | str) -> Column:
    """A number, or missing where the text is none."""
    return F.expr(f"try_cast(trim({c}) as double)") if isinstance(c, str) else c.try_cast("double")


def first_argmax(values: Column | str) -> Column:
    """0-based position of the first maximum of an array."""
    values = col(values)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def coefficient_of_variation(std: Column, average: Column, epsilon: float = 1e-9) -> Column:
    return std / (F.abs(average) + F.lit(epsilon))


def half_year(c: Column | str) -> Column:
    """'2023A' for January to June, '2023B' for July to December."""
    c = col(c)
    return F.concat(F.year(c).cast("string"), F.when(F.month(c) <= 6, "A").otherwise("B"))


def severity(c: Column | str, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The first band whose bound the value exceeds."""
    out = None
    for bound, name in bands:
        out = F.when(col(c) > bound, name) if out is None else out.when(col(c) > bound, name)
    return out.otherwise(otherwise)
