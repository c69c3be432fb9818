"""Algebra on probability vectors and embeddings held as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import col


def doubles(v: Column | str) -> Column:
    return F.transform(col(v), lambda x: x.cast("double"))


def total(v: Column | str) -> Column:
    return F.aggregate(col(v), F.lit(0.0), lambda a, x: a + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def scaled(v: Column | str, by: Column) -> Column:
    return F.transform(col(v), lambda x: x / by)


def row_normalised(v: Column | str, least: float = 1e-8) -> Column:
    """Divided by its sum, which counts as at least `least`."""
    return scaled(v, F.greatest(total(v), F.lit(least)))


def unit(v: Column | str, least: float = 1e-12) -> Column:
    return scaled(v, F.greatest(norm(v), F.lit(least)))


def cosine(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def softmax(scores: Column | str, temperature: float = 1.0) -> Column:
    scores = col(scores)
    powers = F.transform(scores, lambda x: F.exp((x - F.array_max(scores)) / F.lit(temperature)))
    return scaled(powers, total(powers))


def entropy(p: Column | str, least: float = 1e-9) -> Column:
    """-sum p ln max(p, least)."""
    return -F.aggregate(col(p), F.lit(0.0), lambda s, x: s + x * F.ln(F.greatest(x, F.lit(least))))


def kl(w: Column | str, p: Column | str, least: float = 1e-12) -> Column:
    """sum of w (ln w - ln p) over the classes with w > 0, both at least `least`."""
    low = F.lit(least)
    terms = F.zip_with(col(w), col(p), lambda a, b: F.when(a > 0, a * (F.ln(F.greatest(a, low)) - F.ln(F.greatest(b, low)))).otherwise(0.0))
    return total(terms)


def top_k(p: Column | str, k: int) -> Column:
    """0-based class ids of the k largest, ties to the larger id."""
    pairs = F.transform(col(p), lambda x, i: F.struct(x.alias("p"), i.alias("i")))
    return F.transform(F.slice(F.reverse(F.array_sort(pairs)), 1, k), lambda s: s["i"])
