"""Rasters as tiles with a rim of their neighbours' cells, and flow over rasters of any size.

Cells (row, col, value) are dealt to square tiles in one shuffle; a cell within
`reach` of a tile's edge goes to the neighbours too, about 1 + 4 * reach / side
times the cells. A tile is what one task holds.

`flow` gives for each cell the level up to which water stands, the number of
cells that drain through it and its wetness index, the same for every tile size:

1. Each tile's cells form a graph whose edges cost the higher of two heights.
   Merging along its cheapest edges (Kruskal) with one rim cell standing for each
   part leaves a tree between rim cells that keeps all spill heights.
2. Four tiles' trees and the edges between them are contracted in the same way
   to the rim of the four, and so on up to the whole raster.
3. On the way down the levels of a rim settle those of the four rims in it, until
   each tile floods its own cells from its rim's levels.
4. Where no neighbour is lower, water goes the shortest way to where it leaves
   the level: distances are passed over rims until none changes, as often as a
   level surface crosses tiles.
5. Each tile adds up its own flow and says where a path that enters at a rim cell
   leaves again; the sums over these links are found by doubling, and each tile
   adds up again with what flows in.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cuts import cut

STEPS = [(-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)]
OUT = -(1 << 62)  # what lies around the raster
HALF = 1 << 31


def deal(cells: DataFrame, side: int, reach: int = 1) -> DataFrame:
    """(ti, tj, row, col, value): each cell for its tile and for those it lies within reach of."""
    near = lambda c: F.array_distinct(F.transform(F.array(F.lit(-reach), F.lit(0), F.lit(reach)), lambda d: F.floor((F.col(c) + d) / side).cast("int")))
    rows = cells.select("row", "col", F.col("value").cast("double").alias("value"))
    return rows.select(F.explode(near("row")).alias("ti"), "row", "col", "value").select("ti", F.explode(near("col")).alias("tj"), "row", "col", "value")


def framed(part: pd.DataFrame, ti: int, tj: int, side: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """A tile with its rim as an array, NaN where there is no value, and which places have a cell."""
    z, has = np.full((side + 2 * reach,) * 2, np.nan), np.zeros((side + 2 * reach,) * 2, bool)
    r, c = part["row"].to_numpy() - ti * side + reach, part["col"].to_numpy() - tj * side + reach
    z[r, c], has[r, c] = part["value"].to_numpy(float), True
    return z, has


def windows(cells: DataFrame, rows: int, cols: int, f: Callable[[np.ndarray], dict[str, np.ndarray]], outputs: str, side: int = 256) -> DataFrame:
    """(row, col, outputs) by f, which is given the nine values around each of a tile's cells as arrays, in row order, NaN where there is none.

    Beyond the raster's edge its edge is repeated.
    """
    names = [o.split()[0] for o in outputs.split(",")]

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        z, has = framed(part, key[0], key[1], side, 1)
        r, c = np.nonzero(has[1:-1, 1:-1])
        if not len(r):
            return pd.DataFrame({n: [] for n in ["row", "col", *names]})
        row, col = r + key[0] * side, c + key[1] * side
        at = lambda v, d, most, start: np.clip(v + d, 0, most - 1) - start * side + 1
        found = f(np.stack([z[at(row, dr, rows, key[0]), at(col, dc, cols, key[1])] for dr in (-1, 0, 1) for dc in (-1, 0, 1)]))
        return pd.DataFrame({"row": row, "col": col} | {n: found[n] for n in names})

    return deal(cells, side).groupBy("ti", "tj").applyInPandas(run, f"row int, col int, {outputs}")


def shifted(z: np.ndarray, dr: int, dc: int, reach: int = 1) -> np.ndarray:
    """The neighbours in one direction of the cells inside the rim."""
    rows, cols = z.shape
    return z[reach + dr : rows - reach + dr, reach + dc : cols - reach + dc]


# spill heights


def node(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    return (np.asarray(row, np.int64) << 32) + np.asarray(col, np.int64) + HALF


def place(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return nodes >> 32, (nodes & 0xFFFFFFFF) - HALF


def merged(a: np.ndarray, b: np.ndarray, w: np.ndarray, kept: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """A tree between the kept nodes (and OUT) on which the cheapest way between any two has the same highest edge as in the graph (a, b, w)."""
    nodes, at = np.unique(np.concatenate([a, b, kept, [OUT]]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) : 2 * len(a)]
    stands = np.full(len(nodes), -1)
    for i in at[2 * len(a) :]:
        stands[i] = i
    stands, up, out = stands.tolist(), list(range(len(nodes))), ([], [], [])
    order = np.argsort(w, kind="stable")
    for i, j, h in zip(x[order].tolist(), y[order].tolist(), np.asarray(w)[order].tolist(), strict=True):
        while up[i] != i:
            up[i] = i = up[up[i]]
        while up[j] != j:
            up[j] = j = up[up[j]]
        if i != j:
            up[j] = i
            if stands[j] >= 0:
                if stands[i] >= 0:
                    out[0].append(int(nodes[stands[i]]))
                    out[1].append(int(nodes[stands[j]]))
                    out[2].append(h)
                else:
                    stands[i] = stands[j]
    return out


def levels_of(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> dict[int, float]:
    """For each node the least highest edge on a way to OUT."""
    ways: dict[int, list[tuple[int, float]]] = {}
    for i, j, h in zip(a.tolist(), b.tolist(), w.tolist(), strict=True):
        ways.setdefault(i, []).append((j, h))
        ways.setdefault(j, []).append((i, h))
    found, queue = {}, [(-math.inf, OUT)]
    while queue:
        level, i = heapq.heappop(queue)
        if i not in found:
            found[i] = level
            for j, h in ways.get(i, ()):
                if j not in found:
                    heapq.heappush(queue, (max(level, h), j))
    return found


def edges_of(z: np.ndarray, ti: int, tj: int, side: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(a, b, w) inside a tile, with OUT beside each cell that has a gap next to it, and (a, b, w) from its cells to its rim's."""
    own = z[1:-1, 1:-1]
    r, c = np.indices(own.shape)
    ids, inner, across = node(r + ti * side, c + tj * side), [], []
    gap = np.zeros(own.shape, bool)
    for dr, dc in STEPS:
        other = shifted(z, dr, dc)
        gap |= np.isnan(other)
        inside = (r + dr >= 0) & (r + dr < side) & (c + dc >= 0) & (c + dc < side)
        both = ~np.isnan(own) & ~np.isnan(other)
        for to, some in ((inner, both & inside & ((dr, dc) > (0, 0))), (across, both & ~inside)):
            to.append((ids[some], node(r[some] + ti * side + dr, c[some] + tj * side + dc), np.maximum(own, other)[some]))
    out = gap & ~np.isnan(own)
    inner.append((ids[out], np.full(out.sum(), OUT), own[out]))
    return [np.concatenate(p) for p in zip(*inner, strict=True)], [np.concatenate(p) for p in zip(*across, strict=True)]


GRAPH = "ti int, tj int, a array<long>, b array<long>, w array<double>, ca array<long>, cb array<long>, cw array<double>"


def _graph(key: tuple, inner, across) -> pd.DataFrame:
    tree = merged(*inner, np.unique(across[0]))
    return pd.DataFrame([[*key, *tree, *(p.tolist() for p in across)]], columns=["ti", "tj", "a", "b", "w", "ca", "cb", "cw"])


def _joined(part: pd.DataFrame, key: tuple, size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The graph of several tiles: their trees and the edges between them, and the edges that leave them; size: cells along the side of what they make."""
    one = lambda n, kind: np.concatenate([np.asarray(v, kind) for v in part[n]])
    inner, across = [one(n, k) for n, k in (("a", np.int64), ("b", np.int64), ("w", float))], [one(n, k) for n, k in (("ca", np.int64), ("cb", np.int64), ("cw", float))]
    r, c = place(across[1])
    within = (r // size == key[0]) & (c // size == key[1])
    return [np.concatenate([i, e[within]]) for i, e in zip(inner, across, strict=True)], [e[~within] for e in across]


def _contracted(size: int):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _graph(key, *_joined(part, key, size))

    return run


def _settled(size: int):
    def run(key: tuple, part: pd.DataFrame, rim: pd.DataFrame) -> pd.DataFrame:
        """The levels of the rims of up to four tiles, given those of the rim of what they make."""
        inner, _ = _joined(part, key, size)
        at = rim["node"].to_numpy(np.int64)
        found = levels_of(np.concatenate([inner[0], at]), np.concatenate([inner[1], np.full(len(at), OUT)]), np.concatenate([inner[2], rim["level"].to_numpy(float)]))
        rims = [np.unique(np.asarray(ca, np.int64)) for ca in part["ca"]]
        return pd.concat([pd.DataFrame({"ti": i, "tj": j, "node": n, "level": [found[v] for v in n.tolist()]}) for i, j, n in zip(part["ci"], part["cj"], rims, strict=True)])

    return run


def _half(c: str):
    return F.floor(F.col(c) / 2).cast("int").alias(c)


def rim_levels(tiles: DataFrame, side: int) -> DataFrame:
    """(ti, tj, node, level): how high water stands in each cell with a neighbour in another tile; (ti, tj), from 0 up, is its tile."""

    def base(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for ti, tj, z in zip(part["ti"], part["tj"], part["z"], strict=True):
                yield _graph((ti, tj), *edges_of(np.asarray(z).reshape(side + 2, side + 2), ti, tj, side))

    graphs, size = [cut(tiles.select("ti", "tj", "z").mapInPandas(base, GRAPH))], side
    while graphs[-1].where("ti > 0 or tj > 0").limit(1).count():
        size *= 2
        four = graphs[-1].select(_half("ti"), _half("tj"), "a", "b", "w", "ca", "cb", "cw")
        graphs.append(cut(four.groupBy("ti", "tj").applyInPandas(_contracted(size), GRAPH)))
    schema = "ti int, tj int, node long, level double"
    known = tiles.sparkSession.createDataFrame([], schema)
    for below in graphs[-2::-1]:
        children = below.select(_half("ti"), _half("tj"), F.col("ti").alias("ci"), F.col("tj").alias("cj"), "a", "b", "w", "ca", "cb", "cw")
        known = cut(children.groupBy("ti", "tj").cogroup(known.groupBy("ti", "tj")).applyInPandas(_settled(size), schema))
        size //= 2
    return known


# levels, directions, flow


def flooded(z: np.ndarray, rim: dict[tuple[int, int], float]) -> np.ndarray:
    """Levels of a tile inside its rim and on it; rim: the levels of its own cells next to other tiles and of those beyond, by place in the array."""
    level, queue = np.full(z.shape, np.nan), []
    last = z.shape[0] - 1
    for (r, c), v in rim.items():
        level[r, c] = v
        if 0 < r < last and 0 < c < last:
            heapq.heappush(queue, (v, r, c))
    gaps = np.isnan(z)
    beside = np.logical_or.reduce([shifted(gaps, dr, dc) for dr, dc in STEPS]) & ~gaps[1:-1, 1:-1]
    for r, c in zip(*np.nonzero(beside), strict=True):
        heapq.heappush(queue, (float(z[r + 1, c + 1]), int(r) + 1, int(c) + 1))
    done = np.zeros(z.shape, bool)
    done[[0, -1]] = done[:, [0, -1]] = True
    while queue:
        v, r, c = heapq.heappop(queue)
        if done[r, c]:
            continue
        done[r, c], level[r, c] = True, v
        for dr, dc in STEPS:
            y, x = r + dr, c + dc
            if not done[y, x] and not gaps[y, x]:
                heapq.heappush(queue, (max(v, float(z[y, x])), y, x))
    return level


FAR = 1 << 30


def falls(level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The steepest fall per cell width to a neighbour, 0 where none is lower, and its direction."""
    own = level[1:-1, 1:-1]
    each = np.stack([np.nan_to_num((own - shifted(level, dr, dc)) / math.hypot(dr, dc), nan=0.0) for dr, dc in STEPS])
    return np.maximum(each.max(0), 0), each.argmax(0)


def distances(level: np.ndarray, way: np.ndarray, steps: int = FAR) -> np.ndarray:
    """Steps on the same level to a cell where water leaves it, FAR where that takes more than `steps`; way: what is known so far, with the rim's."""
    way = way.copy()
    own, inner = level[1:-1, 1:-1], way[1:-1, 1:-1]
    same = [shifted(level, dr, dc) == own for dr, dc in STEPS]
    while True:
        least = np.minimum.reduce([np.where(s, shifted(way, dr, dc), FAR) for s, (dr, dc) in zip(same, STEPS, strict=True)]) + 1
        least[least > steps] = FAR
        if not (least < inner).any():
            return way
        np.minimum(inner, least, out=inner)


def receivers(level: np.ndarray, way: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each cell of the tile the place in the framed array that it drains to, itself if out of the raster or too far from where its level is left, and its fall."""
    fall, direction = falls(level)
    own, width = level[1:-1, 1:-1], level.shape[1]
    r, c = np.indices(own.shape) + 1
    to = r * width + c
    nearer = np.stack([(shifted(level, dr, dc) == own) & (shifted(way, dr, dc) < way[1:-1, 1:-1]) for dr, dc in STEPS])
    step = np.array([dr * width + dc for dr, dc in STEPS])
    flat = (fall <= 0) & (way[1:-1, 1:-1] < FAR) & nearer.any(0)
    return np.where(fall > 0, to + step[direction], np.where(flat, to + step[nearer.argmax(0)], to)), fall


def accumulated(level: np.ndarray, way: np.ndarray, to: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What flows through each place of the framed array, given what starts in it, and the last place in the tile on each cell's way."""
    width = level.shape[1]
    r, c = np.nonzero(~np.isnan(level[1:-1, 1:-1]))
    at, goes = (r + 1) * width + c + 1, to[r, c]
    order = np.lexsort((way[1:-1, 1:-1][r, c], level[1:-1, 1:-1][r, c]))
    at, goes, flow = at[order].tolist(), goes[order].tolist(), start.ravel().tolist()
    inside = np.zeros(level.shape, bool)
    inside[1:-1, 1:-1] = True
    inside, leaves = inside.ravel().tolist(), list(range(level.size))
    for i, t in zip(at, goes, strict=True):  # from the lowest up, so that what follows is known
        if t != i and inside[t]:
            leaves[i] = leaves[t]
    for i, t in zip(reversed(at), reversed(goes), strict=True):
        if t != i:
            flow[t] += flow[i]
    return np.array(flow).reshape(level.shape), np.array(leaves).reshape(level.shape)


def _near_tiles(side: int):
    """The tiles that see a node: its own and those it touches."""
    r, c = F.shiftright("node", 32), F.col("node").bitwiseAND(F.lit(0xFFFFFFFF)) - HALF
    near = lambda x: F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor((x + d) / side).cast("int")))
    return near(r), near(c)


def _for_tiles(rims: DataFrame, side: int, value: str) -> DataFrame:
    """(ti, tj, nodes, values): what each tile sees of the rims' cells."""
    rows, cols = _near_tiles(side)
    sent = rims.select("node", value, F.explode(rows).alias("ti"), cols.alias("_c")).select("ti", F.explode("_c").alias("tj"), "node", value)
    return sent.groupBy("ti", "tj").agg(F.collect_list("node").alias("nodes"), F.collect_list(value).alias("values"))


def _seen(nodes, values, ti: int, tj: int, side: int) -> dict[tuple[int, int], float]:
    if nodes is None or not len(nodes):
        return {}
    r, c = place(np.asarray(nodes, np.int64))
    return dict(zip(zip((r - ti * side + 1).tolist(), (c - tj * side + 1).tolist(), strict=True), np.asarray(values).tolist(), strict=True))


def flow(cells: DataFrame, size: float = 1.0, side: int = 256, steps: int = FAR) -> DataFrame:
    """(row, col, level, area, twi) of each cell (row, col, value) with a value.

    level: the cell's height, or that of the lowest way out of the hollow it lies
    in; area: the cells that drain through it, itself included; twi: ln(area *
    size / fall), the fall to the receiver per unit, 0.001 at least. Water goes to
    the steepest of eight neighbours, the first in row order of equal ones; the
    raster's edge and gaps take it out. On a level surface it goes up to `steps`
    cells, which is any way by default; what lies further from where water leaves
    the level keeps what drains to it. Null and NaN values are gaps; repeated
    cells keep the lowest value; an empty table gives an empty result.
    """
    known = cells.where("row is not null and col is not null and value is not null and not isnan(value)").groupBy("row", "col").agg(F.min("value").alias("value"))
    north, west = known.agg(F.min("row"), F.min("col")).first()
    if north is None:
        return cells.sparkSession.createDataFrame([], "row int, col int, level double, area long, twi double")
    moved = known.select((F.col("row") - north).alias("row"), (F.col("col") - west).alias("col"), "value")

    def frame(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        z, _ = framed(part, key[0], key[1], side, 1)
        own = not np.isnan(z[1:-1, 1:-1]).all()
        return pd.DataFrame([[*key, z.ravel().tolist()]] if own else [], columns=["ti", "tj", "z"])

    tiles = cut(deal(moved, side).groupBy("ti", "tj").applyInPandas(frame, "ti int, tj int, z array<double>"))
    rims = rim_levels(tiles, side)
    shape, empty = (side + 2, side + 2), np.zeros((side + 2, side + 2))

    def flood(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for ti, tj, z, nodes, values in zip(part["ti"], part["tj"], part["z"], part["nodes"], part["values"], strict=True):
                z = np.asarray(z).reshape(shape)
                level, way = flooded(z, _seen(nodes, values, ti, tj, side)), np.full(shape, FAR)
                gaps = np.isnan(level)
                leaves = (falls(level)[0] > 0) | np.logical_or.reduce([shifted(gaps, dr, dc) for dr, dc in STEPS])
                way[1:-1, 1:-1][leaves & ~gaps[1:-1, 1:-1]] = 0
                out.append([ti, tj, level.ravel().tolist(), distances(level, way, steps).ravel().tolist()])
            yield pd.DataFrame(out, columns=["ti", "tj", "level", "way"])

    state = cut(tiles.join(_for_tiles(rims, side, "level"), ["ti", "tj"], "left").mapInPandas(flood, "ti int, tj int, level array<double>, way array<int>"))

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The distances of rim cells that have a neighbour of the same level in another tile."""
        for part in batches:
            for ti, tj, level, way in zip(part["ti"], part["tj"], part["level"], part["way"], strict=True):
                level, way = np.asarray(level).reshape(shape), np.asarray(way).reshape(shape)
                own = level[1:-1, 1:-1]
                rim = np.ones(own.shape, bool)
                rim[1:-1, 1:-1] = False
                beyond = np.zeros(own.shape, bool)
                for dr, dc in STEPS:
                    r, c = np.indices(own.shape) + np.array([dr, dc])[:, None, None]
                    beyond |= ((r < 0) | (r >= side) | (c < 0) | (c >= side)) & (shifted(level, dr, dc) == own)
                r, c = np.nonzero(rim & beyond & (way[1:-1, 1:-1] < FAR))
                yield pd.DataFrame({"node": node(r + ti * side, c + tj * side), "way": way[1:-1, 1:-1][r, c]})

    def nearer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for ti, tj, level, way, nodes, values in zip(part["ti"], part["tj"], part["level"], part["way"], part["nodes"], part["values"], strict=True):
                level, before = np.asarray(level).reshape(shape), np.asarray(way).reshape(shape)
                way = before.copy()
                for (r, c), v in _seen(nodes, values, ti, tj, side).items():
                    way[r, c] = min(way[r, c], v)
                way = distances(level, way, steps)
                out.append([ti, tj, level.ravel().tolist(), way.ravel().tolist(), bool((way != before).any())])
            yield pd.DataFrame(out, columns=["ti", "tj", "level", "way", "moved"])

    while True:
        seen = _for_tiles(state.select("ti", "tj", "level", "way").mapInPandas(told, "node long, way int"), side, "way")
        state = cut(state.select("ti", "tj", "level", "way").join(seen, ["ti", "tj"], "left").mapInPandas(nearer, "ti int, tj int, level array<double>, way array<int>, moved boolean"))
        if not state.where("moved").limit(1).count():
            break

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each rim cell: what leaves the tile there and for which node, and the node that what enters there leaves for."""
        for part in batches:
            for ti, tj, level, way in zip(part["ti"], part["tj"], part["level"], part["way"], strict=True):
                level, way = np.asarray(level).reshape(shape), np.asarray(way).reshape(shape)
                to, _ = receivers(level, way)
                run, leaves = accumulated(level, way, to, np.where(np.isnan(level), 0, 1))
                rim = ~np.isnan(level[1:-1, 1:-1])
                rim[1:-1, 1:-1] = False
                r, c = np.nonzero(rim)
                name = lambda p, ti=ti, tj=tj: node(p // shape[1] - 1 + ti * side, p % shape[1] - 1 + tj * side)
                beyond = lambda p: (p // shape[1] < 1) | (p // shape[1] > side) | (p % shape[1] < 1) | (p % shape[1] > side)
                exits, last = to[r, c], leaves[1:-1, 1:-1][r, c]
                onward = to[last // shape[1] - 1, last % shape[1] - 1]
                yield pd.DataFrame({"node": node(r + ti * side, c + tj * side), "amount": run[1:-1, 1:-1][r, c], "goes": np.where(beyond(exits), name(exits), OUT), "next": np.where(beyond(onward), name(onward), OUT)})

    rim = cut(state.select("ti", "tj", "level", "way").mapInPandas(links, "node long, amount long, goes long, next long"))
    enters = rim.where(F.col("goes") != OUT).groupBy(F.col("goes").alias("node")).agg(F.sum("amount").alias("s"))
    sums = cut(enters.join(rim.select("node", "next"), "node"))
    while sums.where(F.col("next") != OUT).limit(1).count():
        more = sums.where(F.col("next") != OUT).groupBy(F.col("next").alias("node")).agg(F.sum("s").alias("_s"))
        after = sums.select(F.col("node").alias("next"), F.col("next").alias("_n"))
        sums = cut(sums.join(more, "node", "left").join(after, "next", "left").select("node", (F.col("s") + F.coalesce("_s", F.lit(0))).alias("s"), F.coalesce("_n", F.lit(OUT)).alias("next")))
    inflow = sums.select(F.floor(F.shiftright("node", 32) / side).cast("int").alias("ti"), F.floor((F.col("node").bitwiseAND(F.lit(0xFFFFFFFF)) - HALF) / side).cast("int").alias("tj"), "node", "s")
    entering = inflow.groupBy("ti", "tj").agg(F.collect_list("node").alias("nodes"), F.collect_list("s").alias("values"))

    def finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for ti, tj, level, way, nodes, values in zip(part["ti"], part["tj"], part["level"], part["way"], part["nodes"], part["values"], strict=True):
                level, way = np.asarray(level).reshape(shape), np.asarray(way).reshape(shape)
                to, fall = receivers(level, way)
                start = np.where(np.isnan(level), empty, 1).astype(np.int64)
                for (r, c), v in _seen(nodes, values, ti, tj, side).items():
                    start[r, c] += v
                area = accumulated(level, way, to, start)[0][1:-1, 1:-1]
                r, c = np.nonzero(~np.isnan(level[1:-1, 1:-1]))
                slope = np.maximum(fall[r, c] / size, 1e-3)
                yield pd.DataFrame({"row": r + ti * side + north, "col": c + tj * side + west, "level": level[1:-1, 1:-1][r, c], "area": area[r, c], "twi": np.log(area[r, c] * size / slope)})

    return state.select("ti", "tj", "level", "way").join(entering, ["ti", "tj"], "left").mapInPandas(finished, "row int, col int, level double, area long, twi double")
