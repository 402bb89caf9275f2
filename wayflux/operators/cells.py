"""A cell tree for spatial joins: rows meet in grid cells, and cells that are too full are cut into smaller ones.

An area is indexed by its cells. A cell inside it needs no test; a border cell carries the edges that meet it and one
bit, from which the parity of a ray east follows for every point of the cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.functions import geo
from wayflux.session import cut_lineage, salted_join

FAN = 4  # a cell is cut into FAN x FAN
LEVELS = 8
ROWS_PER_CELL = 200_000
EDGES_PER_CELL = 64
PAIRS_PER_CELL = 4_000_000
CELL = ["cx", "cy"]

Refine = Callable[[DataFrame, float], DataFrame]


def meet(left: DataFrame, right: DataFrame, size: float, refine_left: Refine, refine_right: Refine, heavy: Column, within_keys: list[str] | None = None, weights: tuple[Column, Column] | None = None) -> DataFrame:
    """Rows of both sides that share a cell (`cx`, `cy` of side `size`, on both) and the columns `within_keys`, joined.

    `heavy` says of (nl, nr, wl, wr), the rows of both sides and the largest of their `weights` in a cell, whether
    it is cut: its rows go on to the smaller cells that `refine_*` finds for them, LEVELS times at most. A pair that
    shares several cells comes once for each. The column `side` is that of the cell. What is too full in the end (equal places) is dealt by salt.
    """
    found, level, on = None, 0, [*(within_keys or []), *CELL]
    wl, wr = weights or (F.lit(0), F.lit(0))
    while True:
        nl = left.groupBy(*on).agg(F.count("*").alias("nl"), F.max(wl).alias("wl"))
        nr = right.groupBy(*on).agg(F.count("*").alias("nr"), F.max(wr).alias("wr"))
        full = nl.join(nr, on).filter(heavy).select(*on)
        if level == LEVELS or full.isEmpty():
            last = salted_join(left, right, on, rows_per_task=ROWS_PER_CELL) if level == LEVELS else left.join(right, on)
            last = last.withColumn("side", F.lit(size))
            return last if found is None else found.unionByName(last)
        full = cut_lineage(full)
        done = left.join(full, on, "left_anti").join(right, on).withColumn("side", F.lit(size))
        found = done if found is None else found.unionByName(done)
        size, level = size / FAN, level + 1
        left = cut_lineage(refine_left(left.join(full, on, "left_semi"), size))
        right = cut_lineage(refine_right(right.join(full, on, "left_semi"), size))


def many_pairs() -> Column:
    return F.col("nl") * F.col("nr") > PAIRS_PER_CELL


def in_cell(df: DataFrame, lon: str, lat: str, size: float) -> DataFrame:
    return df.withColumn("cx", geo.cell(F.col(lon), size)).withColumn("cy", geo.cell(F.col(lat), size))


def within(df: DataFrame, dealt: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of cells dealt to the smaller cells inside their own."""
    inner = dealt(df.withColumnsRenamed({"cx": "_px", "cy": "_py"}))
    return inner.filter((F.floor(F.col("cx") / FAN) == F.col("_px")) & (F.floor(F.col("cy") / FAN) == F.col("_py"))).drop("_px", "_py")


def _crossings(e: np.ndarray, y: float) -> np.ndarray:
    """Where the edges cross a height, in order; an end at that height counts as below it."""
    e = e[(e[:, 1] > y) != (e[:, 3] > y)]
    return np.sort(e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1]))


def _ends_beyond(e: np.ndarray, x: float, y: float) -> int:
    return int(((e[:, 0] > x) & (e[:, 1] > y)).sum() + ((e[:, 2] > x) & (e[:, 3] > y)).sum())


def parity(e: np.ndarray, bit: int, east: float, x: np.ndarray, y: float) -> np.ndarray:
    """Parity of rays east from (x, y), all in one cell that ends at `east`.

    Rays count the cell's own edges. The others east of it form chains, whose parity only changes with height
    where a chain ends, which is at an end east of the cell of an own edge; ends of two own edges cancel out.
    """
    at = _crossings(e, y)
    return (len(at) - np.searchsorted(at, x, "right") + _ends_beyond(e, east, y) + bit) & 1


def deal_edges(e: np.ndarray, x0: int, y0: int, nx: int, ny: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """(edge, cell number) of all cells of a grid that an edge meets, cells being a little wider than they are."""
    slack = size * 1e-9
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    first = np.clip(np.floor((low - slack) / size).astype(np.int64) - y0, 0, ny)
    last = np.clip(np.floor((high + slack) / size).astype(np.int64) - y0, -1, ny - 1)
    rows = np.maximum(last - first + 1, 0)
    of = np.repeat(np.arange(len(e)), rows)
    row = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
    # the part of the edge inside the row
    ex1, ey1, ex2, ey2 = e[of].T
    bottom, top = (row + y0) * size - slack, (row + y0 + 1) * size + slack
    rise = np.where(ey2 == ey1, 1.0, ey2 - ey1)
    a, b = np.clip((bottom - ey1) / rise, 0, 1), np.clip((top - ey1) / rise, 0, 1)
    flat = ey2 == ey1
    xa, xb = np.where(flat, ex1, ex1 + a * (ex2 - ex1)), np.where(flat, ex2, ex1 + b * (ex2 - ex1))
    left = np.clip(np.floor((np.minimum(xa, xb) - slack) / size).astype(np.int64) - x0, 0, nx)
    right = np.clip(np.floor((np.maximum(xa, xb) + slack) / size).astype(np.int64) - x0, -1, nx - 1)
    cols = np.maximum(right - left + 1, 0)
    again = np.repeat(np.arange(len(of)), cols)
    col = left[again] + np.arange(len(again)) - np.repeat(np.cumsum(cols) - cols, cols)
    return of[again], row[again] * nx + col


def cut(e: np.ndarray, bit: int, east: float, x0: int, y0: int, nx: int, ny: int, size: float) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """(cx, cy, bit, own edges) of the cells of a grid inside a cell that ends at `east`; inside cells have no edges."""
    of, number = deal_edges(e, x0, y0, nx, ny, size)
    order = np.argsort(number, kind="stable")
    of, number = of[order], number[order]
    own = np.searchsorted(number, np.arange(nx * ny + 1))
    corners = np.arange(x0, x0 + nx) * size
    for j in range(ny):
        y = (y0 + j) * size
        odd = parity(e, bit, east, corners, y)
        for i in range(nx):
            a, b = own[j * nx + i], own[j * nx + i + 1]
            if a == b:
                if odd[i]:
                    yield x0 + i, y0 + j, 0, None
                continue
            mine = e[of[a:b]]
            yield x0 + i, y0 + j, int(odd[i] ^ parity(mine, 0, (x0 + i + 1) * size, corners[i : i + 1], y)[0]), mine


EDGE = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")])


def _cut_rows(df: DataFrame, names: list[str], size: float, whole: bool) -> DataFrame:
    """Rows (names, cx, cy, bit, edges) of the cells of side `size`: of whole shapes, or inside their present cells."""
    schema = T.StructType([*(df.schema[n] for n in names), T.StructField("cx", T.LongType()), T.StructField("cy", T.LongType()), T.StructField("bit", T.IntegerType()), T.StructField("edges", T.ArrayType(EDGE))])

    def cells(b: pa.RecordBatch) -> Iterator[tuple]:
        lists = b.column("edges")
        flat = lists.flatten()
        e = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(4)], axis=1) if len(flat) else np.zeros((0, 4))
        ends = np.cumsum(np.nan_to_num(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64))
        for k in range(b.num_rows):
            own = e[(ends[k - 1] if k else 0) : ends[k]]
            if whole:
                if len(own):
                    lo, hi = np.floor((own.reshape(-1, 2).min(0)) / size).astype(np.int64), np.floor((own.reshape(-1, 2).max(0)) / size).astype(np.int64)
                    n = hi - lo + 1
                    yield from ((k, *c) for c in cut(own, 0, np.inf, int(lo[0]), int(lo[1]), int(n[0]), int(n[1]), size))
                continue
            x0, y0 = b.column("cx")[k].as_py() * FAN, b.column("cy")[k].as_py() * FAN
            if lists[k].is_valid:
                yield from ((k, *c) for c in cut(own, b.column("bit")[k].as_py(), (x0 + FAN) * size, x0, y0, FAN, FAN, size))
            else:
                yield from ((k, x0 + i, y0 + j, 0, None) for i in range(FAN) for j in range(FAN))

    def batch(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        k, cx, cy, bit, own = (list(c) for c in zip(*rows, strict=True))
        at = pa.array(k, pa.int64())
        counts = [0 if o is None else len(o) for o in own]
        every = np.concatenate([o for o in own if o is not None] or [np.zeros((0, 4))])
        values = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(every[:, c])) for c in range(4)], names=EDGE.names)
        edges = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values, mask=pa.array([o is None for o in own]))
        return pa.RecordBatch.from_arrays([*(b.column(n).take(at) for n in names), pa.array(cx, pa.int64()), pa.array(cy, pa.int64()), pa.array(bit, pa.int32()), edges], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for row in cells(b):
                rows.append(row)
                held += 1 if row[4] is None else 1 + len(row[4])
                if held > 1 << 16:
                    yield batch(b, rows)
                    rows, held = [], 0
            if rows:
                yield batch(b, rows)

    return df.mapInArrow(run, schema)


def area_cells(areas: DataFrame, keep: list[str], size: float) -> DataFrame:
    """(keep, cx, cy, bit, edges): the cells of each area (`rings`); `edges` is null in cells inside it."""
    return _cut_rows(areas.select(*keep, geo.edges_of(F.col("rings")).alias("edges")), keep, size, True)


def split_area_cells(cells: DataFrame, size: float) -> DataFrame:
    """The same area cells, cut to side `size`."""
    return _cut_rows(cells, [c for c in cells.columns if c not in ("cx", "cy", "bit", "edges")], size, False)


def edge_count() -> Column:
    return F.when(F.col("edges").isNull(), 0).otherwise(F.size("edges"))


def in_area(lon: Column, lat: Column) -> Column:
    """Whether a point lies within the area of its cell (columns cx, side, bit, edges), borders left out."""
    edges, east = F.col("edges"), (F.col("cx") + 1) * F.col("side")

    def odd(e):
        at = e["x1"] + (lat - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        ray = F.coalesce(((e["y1"] > lat) != (e["y2"] > lat)) & (lon < at), F.lit(False)).cast("int")
        return ray + ((e["x1"] > east) & (e["y1"] > lat)).cast("int") + ((e["x2"] > east) & (e["y2"] > lat)).cast("int")

    def on_edge(e):
        return (
            ((e["x2"] - e["x1"]) * (lat - e["y1"]) - (e["y2"] - e["y1"]) * (lon - e["x1"]) == 0.0)
            & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    inner = (F.aggregate(edges, F.col("bit"), lambda acc, e: acc + odd(e)) % 2 == 1) & ~F.exists(edges, on_edge)
    return edges.isNull() | inner


def places_in_areas(places: DataFrame, areas: DataFrame, keep: list[str], size: float) -> DataFrame:
    """(lon, lat, keep) of distinct places and the areas they lie within."""
    met = meet(
        in_cell(places, "lon", "lat", size), area_cells(areas, keep, size), size,
        lambda df, s: in_cell(df, "lon", "lat", s), split_area_cells,
        (F.col("nl") > ROWS_PER_CELL) | (F.col("wr") > EDGES_PER_CELL), weights=(F.lit(0), edge_count()),
    )
    return met.filter(in_area(F.col("lon"), F.col("lat"))).select("lon", "lat", *keep)


def _region(e: np.ndarray | None, bit: int, x0: float, y0: float, side: float) -> np.ndarray:
    """An area within its cell as signed pieces (x1, y1, x2, y2, sign) from left to right: the sum of what is above them."""
    x1, y1 = x0 + side, y0 + side
    if e is None:
        return np.array([[x0, y0, x1, y0, 1.0]])
    odd = parity(e, bit, x1, np.array([x0]), y0)[0]
    at = _crossings(e, y0)
    runs = np.r_[x0, at[(at > x0) & (at < x1)], x1]
    a, b = runs[:-1][1 - odd :: 2], runs[1:][1 - odd :: 2]
    floor = np.stack([a, np.full(len(a), y0), b, np.full(len(a), y0), np.ones(len(a))], axis=1)
    e = e[(e[:, 0] != e[:, 2]) & (np.maximum(e[:, 1], e[:, 3]) > y0)]
    sign = np.sign(e[:, 2] - e[:, 0])
    e = np.where((sign < 0)[:, None], e[:, [2, 3, 0, 1]], e)
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    level = dy == 0
    low, high = (y0 - e[:, 1]) / np.where(level, 1.0, dy), (y1 - e[:, 1]) / np.where(level, 1.0, dy)
    low, high = np.where(level, 0.0, np.minimum(low, high)), np.where(level, e[:, 1] <= y1, np.maximum(low, high))
    s = np.maximum.reduce([np.zeros(len(e)), (x0 - e[:, 0]) / dx, low])
    t = np.minimum.reduce([np.ones(len(e)), (x1 - e[:, 0]) / dx, high])
    e, sign, s, t, dx, dy = (v[t > s] for v in (e, sign, s, t, dx, dy))
    return np.vstack([floor, np.stack([e[:, 0] + s * dx, e[:, 1] + s * dy, e[:, 0] + t * dx, e[:, 1] + t * dy, sign], axis=1)])


def _above_both(a: np.ndarray, b: np.ndarray, top: float) -> float:
    """Signed sum, over pairs of pieces, of the region above both and below `top`, within their common span."""
    total = 0.0
    for k in range(0, len(a), 256):
        x1, y1, x2, y2, s = (c[:, None] for c in a[k : k + 256].T)
        u1, v1, u2, v2, r = (c[None, :] for c in b.T)
        lo, hi = np.maximum(x1, u1), np.minimum(x2, u2)
        i, j = np.nonzero(hi > lo)
        lo, hi = lo[i, j], hi[i, j]

        def height(x, p, q, x1, y1, x2, y2):
            return y1.ravel()[p] + (x - x1.ravel()[p]) * ((y2 - y1).ravel()[p] / (x2 - x1).ravel()[p])

        el, er = height(lo, i, j, x1, y1, x2, y2), height(hi, i, j, x1, y1, x2, y2)
        fl, fr = height(lo, j, i, u1, v1, u2, v2), height(hi, j, i, u1, v1, u2, v2)
        dl, dr = np.abs(el - fl), np.abs(er - fr)
        crossed = (el - fl) * (er - fr) < 0
        # the mean of the larger line is the mean of both plus half the mean gap
        gap = np.where(crossed, (dl * dl + dr * dr) / np.where(crossed, dl + dr, 1.0), dl + dr) / 2
        total += float((s.ravel()[i] * r.ravel()[j] * (hi - lo) * (top - (el + er + fl + fr) / 4 - gap / 2)).sum())
    return total


def shared_by_cell(met: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, shared): the area that two areas share in each cell, rows (keys, cx, cy, side, bit, edges, bit2, edges2)."""
    schema = T.StructType([*(met.schema[k] for k in keys), T.StructField("shared", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = []
            for name in ("edges", "edges2"):
                lists = b.column(name)
                flat = lists.flatten()
                e = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(4)], axis=1) if len(flat) else np.zeros((0, 4))
                ends = np.cumsum(np.nan_to_num(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64))
                sides.append([e[(ends[k - 1] if k else 0) : ends[k]] if lists[k].is_valid else None for k in range(b.num_rows)])
            cx, cy, side, bit, bit2 = (b.column(c).to_numpy() for c in ("cx", "cy", "side", "bit", "bit2"))
            out = []
            for k, (e, f) in enumerate(zip(*sides, strict=True)):
                x, y, s = cx[k] * side[k], cy[k] * side[k], side[k]
                out.append(s * s if e is None and f is None else _above_both(_region(e, bit[k], x, y, s), _region(f, bit2[k], x, y, s), y + s))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(out, pa.float64())], names=schema.names)

    return met.select(*keys, "cx", "cy", "side", "bit", "edges", "bit2", "edges2").mapInArrow(run, schema)


def shared_areas(left: DataFrame, right: DataFrame, key: str, other: str, size: float) -> DataFrame:
    """(key, other, shared) of all pairs of areas (`rings`) that have cells in common; `size` is in the unit of the rings.

    Every cell is reckoned for itself, and cells with many edges are cut, so no row holds two shapes
    and the work grows with the edges. Parts of a shape must not overlap.
    """
    here, there = area_cells(left, [key], size), area_cells(right, [other], size).withColumnsRenamed({"bit": "bit2", "edges": "edges2"})
    twin = {"bit": "bit2", "edges": "edges2"}
    back = {v: k for k, v in twin.items()}
    met = meet(
        here, there, size, split_area_cells, lambda df, s: split_area_cells(df.withColumnsRenamed(back), s).withColumnsRenamed(twin),
        (F.col("wl") > EDGES_PER_CELL) | (F.col("wr") > EDGES_PER_CELL), weights=(edge_count(), F.when(F.col("edges2").isNull(), 0).otherwise(F.size("edges2"))),
    )
    return shared_by_cell(met, [key, other]).groupBy(key, other).agg(F.sum("shared").alias("shared"))
