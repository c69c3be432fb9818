"""Flow over tiles against one process that sees the whole raster; stencils on tiles against whole arrays."""

import heapq
import math

import numpy as np
import pytest

from cellweave.operators import tiles


def plain_flow(z, size):
    """level, area and twi of a whole raster: flooding from its edge and its gaps, the shortest ways over levels, steepest falls."""
    rows, cols = z.shape
    inside = lambda r, c: 0 <= r < rows and 0 <= c < cols and not np.isnan(z[r, c])
    cells = [(r, c) for r in range(rows) for c in range(cols) if inside(r, c)]
    near = {p: [(p[0] + a, p[1] + b) for a, b in tiles.STEPS] for p in cells}
    open_ = {p for p in cells if any(not inside(*q) for q in near[p])}
    level, queue = {}, [(z[p], p) for p in open_]
    heapq.heapify(queue)
    while queue:
        v, p = heapq.heappop(queue)
        if p not in level:
            level[p] = v
            for q in near[p]:
                if inside(*q) and q not in level:
                    heapq.heappush(queue, (max(v, z[q]), q))
    way = {p: 0 for p in cells if p in open_ or any(inside(*q) and level[q] < level[p] for q in near[p])}
    edge = list(way)
    while edge:
        following = []
        for p in edge:
            for q in near[p]:
                if inside(*q) and level[q] == level[p] and q not in way:
                    way[q] = way[p] + 1
                    following.append(q)
        edge = following
    to, fall = {}, {}
    for p in cells:
        best = max(((level[p] - level[q]) / math.hypot(q[0] - p[0], q[1] - p[1]), -i, q) for i, q in enumerate(near[p]) if inside(*q)) if any(inside(*q) for q in near[p]) else (0, 0, None)
        fall[p] = max(best[0], 0)
        if best[0] > 0:
            to[p] = best[2]
        else:
            to[p] = next((q for q in near[p] if inside(*q) and level[q] == level[p] and way[q] < way[p]), None)
    area = dict.fromkeys(cells, 1)
    for p in sorted(cells, key=lambda p: (-level[p], -way[p])):
        if to[p]:
            area[to[p]] += area[p]
    return {(r, c, level[r, c], area[r, c], round(math.log(area[r, c] * size / max(fall[r, c] / size, 1e-3)), 9)) for r, c in cells}


def raster(kind):
    rng = np.random.default_rng(3)
    r, c = np.indices((23, 17))
    if kind == "noise":
        return rng.integers(1, 30, (23, 17)).astype(float)
    if kind == "flat":
        return np.full((23, 17), 5.0)
    if kind == "bowl":  # one hollow over all tiles, with a single low gap in its wall
        z = np.hypot(r - 11, c - 8)
        z[[0, -1]] = z[:, [0, -1]] = 30.0
        z[22, 9] = 3.0
        return z
    if kind == "snake":  # a channel that winds through the tiles
        z = np.full((23, 17), 50.0)
        for i in range(1, 22, 2):
            z[i, 1:16] = 40 - i
            z[i + 1, 15 if i % 4 == 1 else 1] = 39.5 - i
        return z
    z = np.round(rng.normal(size=(23, 17)).cumsum(0), 1)
    z[rng.random(z.shape) < 0.2] = np.nan
    z[8:16, 4:12] = np.nan  # a gap as large as a tile
    return z


@pytest.mark.parametrize("kind", ["noise", "flat", "bowl", "snake", "gaps"])
def test_flow_is_the_same_for_any_tile(spark, kind):
    z = raster(kind)
    rows = [(int(r) - 5, int(c) + 100, None if np.isnan(z[r, c]) and r % 2 else float(z[r, c])) for r in range(z.shape[0]) for c in range(z.shape[1]) if r % 5 or not np.isnan(z[r, c])]
    cells = spark.createDataFrame(rows, "row int, col int, value double")
    wanted = {(r - 5, c + 100, level, area, twi) for r, c, level, area, twi in plain_flow(z, 2.0)}
    for side in (4, 7, 64):
        found = tiles.flow(cells, 2.0, side).collect()
        assert {(x["row"], x["col"], x["level"], x["area"], round(x["twi"], 9)) for x in found} == wanted and len(found) == len(wanted)


def test_flow_of_no_cells_and_of_one(spark):
    cells = spark.createDataFrame([(3, 4, 7.0), (3, 4, 6.0), (9, 9, None), (None, 1, 2.0)], "row int, col int, value double")
    assert tiles.flow(cells.where("false")).count() == 0
    only = tiles.flow(cells, 1.0, 2).collect()
    assert [(x["row"], x["col"], x["level"], x["area"]) for x in only] == [(3, 4, 6.0, 1)]


def test_long_level_ways_end_where_the_sql_ends_them(spark, tmp_path):
    import compare
    import pandas as pd

    from cellweave.plans.catalog import QUERIES, SQL

    z = np.full((16, 40), 50)  # a level channel of 140 cells with one way out
    for i in range(2, 14, 4):
        z[i, 2:38] = z[i + 2, 2:38] = 5
        z[i + 1, 37] = 5
        z[i + 3, 2] = 5
    z[0:2, 2] = 4, 5
    rows = pd.DataFrame({"p_partkey": np.arange(z.size), "p_size": z.ravel().astype("int32"), "p_retailprice": 1.0})
    rows.to_parquet(tmp_path / "part.parquet")
    con, area = compare.connect(str(tmp_path)), {}
    for name in ("wetness_index", "wetness_index_whole"):
        found = QUERIES[name](spark, str(tmp_path))
        assert compare.mismatch(found, con, SQL[name]) is None
        area[name] = found.where("row = 0 and col = 2").first()["area"]
    assert area["wetness_index"] < 200 < area["wetness_index_whole"]
