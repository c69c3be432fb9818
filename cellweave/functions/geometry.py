"""Polygons as rings of [x, y] arrays: even-odd containment, boxes, centroids, validity, Esri shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import col


def closed(ring: Column | str) -> Column:
    """The ring with its first point repeated at the end if it isn't there yet."""
    ring = col(ring)
    first, last = F.element_at(ring, 1), F.element_at(ring, -1)
    return F.when(first == last, ring).otherwise(F.concat(ring, F.array(first)))


def _inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a ray from the point crosses the ring's edges an odd number of times."""
    edges = F.sequence(F.lit(1), F.size(ring) - 1)

    def crossed(odd: Column, i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        x1, y1, x2, y2 = a[0], a[1], b[0], b[1]
        meets = (y1 > y) != (y2 > y)
        at = x1 + F.try_divide((y - y1) * (x2 - x1), y2 - y1)
        return odd != (meets & F.coalesce(x < at, F.lit(False)))

    return F.aggregate(edges, F.lit(False), crossed)


def on_edge(x: Column | str, y: Column | str, rings: Column | str) -> Column:
    """Whether the point lies on an edge of a ring."""
    x, y = col(x), col(y)

    def touched(ring: Column) -> Column:
        def on(i: Column) -> Column:
            a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
            straight = (b[0] - a[0]) * (y - a[1]) == (b[1] - a[1]) * (x - a[0])
            return straight & x.between(F.least(a[0], b[0]), F.greatest(a[0], b[0])) & y.between(F.least(a[1], b[1]), F.greatest(a[1], b[1]))

        return F.exists(F.sequence(F.lit(1), F.size(ring) - 1), on)

    return F.exists(col(rings), touched)


def inside(x: Column | str, y: Column | str, rings: Column | str) -> Column:
    """Even-odd rule over all rings, so holes are outside; so are points on an edge."""
    px, py = col(x), col(y)
    odd = F.aggregate(col(rings), F.lit(False), lambda state, ring: state != _inside_ring(px, py, ring))
    return odd & ~on_edge(x, y, rings)


def box(ring: Column | str) -> tuple[Column, Column, Column, Column]:
    """min x, min y, max x, max y."""
    ring = col(ring)
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def vertex_mean(ring: Column | str) -> tuple[Column, Column]:
    """Mean of the ring's points, the closing one left out."""
    ring = closed(ring)
    n = F.size(ring) - 1
    body = F.slice(ring, 1, n)
    mean = lambda k: F.aggregate(F.transform(body, lambda p: p[k]), F.lit(0.0), lambda s, v: s + v) / n
    return mean(0), mean(1)


def plausible(ring: Column | str) -> Column:
    """A ring that is closed and has at least four points."""
    ring = col(ring)
    return F.coalesce((F.size(ring) >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1)), F.lit(False))


def from_esri(rings: Column | str) -> Column:
    """GeoJSON geometry of Esri rings: one ring is a Polygon, several are a MultiPolygon of single rings, none is missing."""
    rings = col(rings)
    many = F.when(F.size(rings) == 1, F.array(rings)).otherwise(F.transform(rings, lambda r: F.array(r)))
    kind = F.when(F.size(rings) == 1, "Polygon").otherwise("MultiPolygon")
    return F.when(F.size(rings) > 0, F.struct(kind.alias("type"), many.alias("coordinates")))
