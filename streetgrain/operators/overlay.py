"""Exact areas of overlapping polygons: unions, and their share of other polygons.

Polygons are cut to one-degree boxes, and boxes with many edges to smaller
cells, so that a cell is one small task whatever overlaps in it. In a cell a
plane sweep finds the areas: between neighbouring corners and crossings the edges
keep their order, so each slab is a stack of trapezoids. A point belongs to a
polygon if an odd number of its rings enclose it, and to a union if it belongs
to any polygon.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from streetgrain.session import written

MOST_EDGES = 256  # a cell with more is cut into 16
STEP = 2  # halvings of the side at each cut
DEEPEST = 8  # halvings after which a cell stays as it is and is swept with all its edges: some hundred metres
SLAB_ROWS = 1 << 20  # edges of slabs that are worked on at a time
LAND, COVER = 0, 1


class Stack(NamedTuple):
    """Edges of some slabs from slab to slab, from the lowest up, and what lies between each and the next."""

    slab: np.ndarray
    edge: np.ndarray
    left: np.ndarray  # x of the slab's sides
    right: np.ndarray
    middle: np.ndarray  # y at half width
    land: np.ndarray
    cover: np.ndarray


def _at(e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """y of edges (x1, y1, x2, y2) at x."""
    return e[1] + (e[3] - e[1]) * ((x - e[0]) / (e[2] - e[0]))


def _near(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges in order of ``low``; of each in this order, how many of the next ones begin before its ``high``."""
    order = np.argsort(low, kind="stable")
    count = np.searchsorted(low[order], high[order], "left") - np.arange(len(low)) - 1
    return order, np.maximum(count, 0)


def crossings(e: np.ndarray) -> np.ndarray:
    """x of all places where two edges cross.

    Edges can cross where both their x and their y overlap; the pairs of the axis with fewer are tried.
    """
    low_y, high_y = np.minimum(e[1], e[3]), np.maximum(e[1], e[3])
    order, count = min(_near(e[0], e[2]), _near(low_y, high_y), key=lambda n: n[1].sum())
    total = np.concatenate([[0], np.cumsum(count)])
    out = [np.zeros(0)]
    at = 0
    while at < len(count):
        to = max(at + 1, int(np.searchsorted(total, total[at] + SLAB_ROWS, "right")) - 1)
        i, k = _repeat(count[at:to])
        i, j = order[i + at], order[i + at + 1 + k]
        at = to
        low, high = np.maximum(e[0, i], e[0, j]), np.minimum(e[2, i], e[2, j])
        meet = np.flatnonzero((low < high) & (low_y[i] < high_y[j]) & (low_y[j] < high_y[i]))
        i, j, low, high = i[meet], j[meet], low[meet], high[meet]
        a, b = _at(e[:, i], low) - _at(e[:, j], low), _at(e[:, i], high) - _at(e[:, j], high)
        cross = a * b < 0
        out.append((low + (high - low) * (a / np.where(cross, a - b, 1)))[cross])
    return np.concatenate(out)


def sweep(edges: np.ndarray, owner: np.ndarray, side: np.ndarray) -> Iterator[Stack]:
    """``edges``: x1, y1, x2, y2 with x1 < x2; ``owner``: the polygon of each; ``side`` of each: land or cover."""
    xs = np.unique(np.concatenate([edges[0], edges[2], crossings(edges)]))
    first, last = np.searchsorted(xs, edges[0]), np.searchsorted(xs, edges[2])
    active = np.zeros(len(xs) + 1, np.int64)
    np.add.at(active, first, 1)
    np.add.at(active, last, -1)
    active = np.cumsum(active)[: max(len(xs) - 1, 0)]
    total = np.concatenate([[0], np.cumsum(active)])
    at = 0
    while at < len(active):
        to = max(at + 1, int(np.searchsorted(total, total[at] + SLAB_ROWS, "right")) - 1)
        low, high = np.maximum(first, at), np.minimum(last, to)
        some = np.flatnonzero(low < high)
        count = (high - low)[some]
        edge = np.repeat(some, count)
        slab = np.arange(len(edge)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[some], count)
        left, right = xs[slab], xs[slab + 1]
        middle = _at(edges[:, edge], left / 2 + right / 2)
        # Each second edge of a polygon, from below, ends what the one before began.
        own = np.lexsort((middle, owner[edge], slab))
        new = np.ones(len(own), bool)
        new[1:] = (slab[own][1:] != slab[own][:-1]) | (owner[edge][own][1:] != owner[edge][own][:-1])
        place = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
        sign = np.empty(len(own), np.int64)
        sign[own] = 1 - 2 * (place % 2)
        up = np.lexsort((middle, slab))
        is_land = side[edge][up] == LAND
        land, cover = np.cumsum(np.where(is_land, sign[up], 0)), np.cumsum(np.where(is_land, 0, sign[up]))
        yield Stack(slab[up], edge[up], left[up], right[up], middle[up], land > 0, cover > 0)
        at = to


def _sizes(stack: Stack) -> np.ndarray:
    """Area between each edge of the stack and the next."""
    size = np.zeros(len(stack.slab))
    if len(size):
        same = stack.slab[1:] == stack.slab[:-1]
        size[:-1] = np.where(same, (stack.middle[1:] - stack.middle[:-1]) * (stack.right - stack.left)[:-1], 0)
    return size


def _edges(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Edges of pieces, and the row of each."""
    lists = [table.column(c) for c in ENDS]
    lists = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in lists]
    edges = np.stack([c.flatten().to_numpy(zero_copy_only=False) for c in lists])
    return edges, np.repeat(np.arange(table.num_rows), lists[0].value_lengths().to_numpy())


# --- cells ---------------------------------------------------------------------


def _ring_edges(rings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges that aren't vertical, left to right, and the row of each; none of a row with a corner that isn't finite."""
    per_row = pc.fill_null(pc.list_value_length(rings), 0).to_numpy()
    ring = rings.flatten()
    per_ring = pc.fill_null(pc.list_value_length(ring), 0).to_numpy()
    points = ring.flatten()
    x, y = (pc.struct_field(points, c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y"))
    of_ring = np.repeat(np.arange(len(per_ring)), per_ring)
    of_row = np.repeat(np.arange(len(per_row)), per_row)[of_ring]
    bad = np.bincount(of_row, ~(np.isfinite(x) & np.isfinite(y)), len(per_row)) > 0
    keep = (of_ring[1:] == of_ring[:-1]) & (x[1:] != x[:-1]) & ~bad[of_row[1:]]
    edges = np.stack([x[:-1], y[:-1], x[1:], y[1:]])[:, keep]
    back = edges[0] > edges[2]
    edges[:, back] = edges[[2, 3, 0, 1]][:, back]
    return edges, of_row[1:][keep]


def _repeat(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each repeated item, and the number of each repetition."""
    item = np.repeat(np.arange(len(count)), count)
    return item, np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)


def _odd_parts(piece: np.ndarray, line: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(piece, line, low, high) of the parts of a line that an odd number of ranges cover: ends that meet cancel out."""
    piece, line, x = np.concatenate([piece, piece]), np.concatenate([line, line]), np.concatenate([low, high])
    order = np.lexsort((x, line, piece))
    piece, line, x = piece[order], line[order], x[order]
    new = np.ones(len(x), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (line[1:] != line[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    odd = at[np.diff(np.append(at, len(x))) % 2 == 1]
    return piece[odd[::2]], line[odd[::2]], x[odd[::2]], x[odd[1::2]]


def cut(edges: np.ndarray, owner: np.ndarray, size: float) -> Iterator[tuple[np.ndarray, ...]]:
    """Polygons cut to cells: (owner, ix, iy) of each piece, the piece of each of its edges, and the edges.

    What lies below or above a cell stays as parts of its lower or upper side, so that
    the number of edges below a place keeps its parity. A piece that fills its cell is
    the two sides. The edges of a piece are sorted.
    """
    first, last = np.floor(edges[0] / size), np.ceil(edges[2] / size) - 1
    e, k = _repeat((last - first + 1).astype(np.int64))
    ix = first[e] + k
    left, right = np.maximum(edges[0][e], ix * size), np.minimum(edges[2][e], (ix + 1) * size)
    a = np.where(left == edges[0][e], edges[1][e], _at(edges[:, e], left))
    b = np.where(right == edges[2][e], edges[3][e], _at(edges[:, e], right))
    order = np.lexsort((ix, owner[e]))
    order = order[(left < right)[order]]
    e, ix, left, right, a, b = e[order], ix[order], left[order], right[order], a[order], b[order]
    if not len(e):
        return
    new = np.ones(len(e), bool)
    new[1:] = (owner[e][1:] != owner[e][:-1]) | (ix[1:] != ix[:-1])
    starts = np.flatnonzero(new)
    low = np.floor(np.minimum.reduceat(np.minimum(a, b), starts) / size)
    high = np.ceil(np.maximum.reduceat(np.maximum(a, b), starts) / size) - 1
    rows = np.maximum(high - low + 1, 0).astype(np.int64)
    many = np.diff(np.append(starts, len(e)))
    work = np.concatenate([[0], np.cumsum(rows * many)])
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(work, work[at] + SLAB_ROWS, "right")) - 1)
        piece, k = _repeat(rows[at:to])  # a piece per column part and row
        group, iy = piece + at, low[at:to][piece] + k
        g, k = _repeat(many[group])  # its edges
        yield _clamped(owner[e][starts[group]], ix[starts[group]], iy, g, starts[group][g] + k, left, right, a, b, size)
        at = to


def _clamped(owner, ix, iy, piece, e, left, right, a, b, size) -> tuple[np.ndarray, ...]:
    x, z, u, v = left[e], right[e], a[e], b[e]
    floor, roof = iy[piece] * size, (iy[piece] + 1) * size
    stops = []
    for line in (floor, roof):
        across = (u - line) * (v - line) < 0
        place = np.clip(x + (z - x) * ((line - u) / np.where(across, v - u, 1)), x, z)
        stops.append((np.where(across, place, x), np.where(across, line, u)))
    (x1, y1), (x2, y2) = stops
    swap = x1 > x2
    x1, x2, y1, y2 = np.where(swap, x2, x1), np.where(swap, x1, x2), np.where(swap, y2, y1), np.where(swap, y1, y2)
    p = np.tile(piece, 3)
    x, u = np.concatenate([x, x1, x2]), np.concatenate([u, y1, y2])
    z, v = np.concatenate([x1, x2, z]), np.concatenate([y1, y2, v])
    floor, roof = np.tile(floor, 3), np.tile(roof, 3)
    some = x < z
    p, x, z, u, v, floor, roof = (c[some] for c in (p, x, z, u, v, floor, roof))
    middle = (u + v) / 2
    out = (middle <= floor) | (middle >= roof)
    side = np.where(middle <= floor, floor, roof)
    fp, line, low, high = _odd_parts(p[out], side[out], x[out], z[out])
    inner = [np.clip(c[~out], floor[~out], roof[~out]) for c in (u, v)]
    p = np.concatenate([p[~out], fp])
    edges = np.stack([np.concatenate(c) for c in ((x[~out], low), (inner[0], line), (z[~out], high), (inner[1], line))])
    order = np.lexsort((edges[3], edges[2], edges[1], edges[0], p))
    return owner, ix, iy, p[order], edges[:, order]


CELL = ["code", "level", "ix", "iy"]
ENDS = ["x1", "y1", "x2", "y2"]


def _cut_to(rows: DataFrame, read: Callable, level: int) -> DataFrame:
    """Pieces of the rows (code, side and what ``read`` takes edges from) in cells of a level."""
    size = 0.5**level
    schema = f"code {rows.schema['code'].dataType.simpleString()}, side int, level int, ix long, iy long, whole boolean, " + ", ".join(f"{c} array<double>" for c in ENDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, ix, iy, piece, edges in cut(*read(batch), size):
                count = np.bincount(piece, minlength=len(owner))
                border = (edges[1] == iy[piece] * size) | (edges[1] == (iy[piece] + 1) * size)
                full = np.bincount(piece, border & (edges[1] == edges[3]) & (edges[2] - edges[0] == size), len(owner)) == 2
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
                row = pa.array(owner)
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column("code").take(row), batch.column("side").take(row), pa.array(np.full(len(owner), level, np.int32)),
                        pa.array(ix.astype(np.int64)), pa.array(iy.astype(np.int64)), pa.array(full & (count == 2)),
                        *[pa.ListArray.from_arrays(offsets, pa.array(c)) for c in edges],
                    ],
                    ["code", "side", "level", "ix", "iy", "whole", *ENDS],
                )
                yield out.filter(pa.array(count > 0))

    return rows.mapInArrow(run, schema)


def _pieces(polygons: DataFrame, code: str, rings: str, side: int) -> DataFrame:
    """Polygons cut to one-degree boxes."""
    shape = F.col(rings).cast("array<array<struct<x:double,y:double>>>")
    rows = polygons.select(F.col(code).alias("code"), F.lit(side).alias("side"), shape.alias("rings")).where("code IS NOT NULL")
    return _cut_to(rows, lambda batch: _ring_edges(batch.column("rings")), 0)


def _once(pieces: DataFrame) -> DataFrame:
    """Pieces, equal ones once, and none but the cell itself where one fills its cell: no other adds to the union there."""
    pieces = written(pieces.dropDuplicates([*CELL, "side", "whole", *ENDS]), "pieces")
    full = pieces.where("whole").select(*CELL, "side")
    return pieces.where("whole").unionByName(pieces.where("NOT whole").join(full, [*CELL, "side"], "left_anti").select(pieces.columns))


def _dealt(pieces: DataFrame) -> DataFrame:
    """Pieces in cells of at most ``MOST_EDGES`` edges, or of the least size."""
    done, open_ = [], pieces
    for level in range(0, DEEPEST + 1, STEP):
        open_ = written(_once(open_), "pieces")
        many = written(open_.groupBy(*CELL).agg(F.sum(F.size("x1")).alias("edges")).where(F.col("edges") > MOST_EDGES).select(*CELL), "cells")
        if level + STEP > DEEPEST or many.isEmpty():
            return reduce(DataFrame.unionByName, [*done, open_])
        done.append(open_.join(many, CELL, "left_anti").select(open_.columns))
        open_ = _cut_to(open_.join(many, CELL, "left_semi").select("code", "side", *ENDS), _edges, level + STEP)
    raise AssertionError


def _cells(table: pa.Table) -> np.ndarray:
    """First row of each cell of a sorted table."""
    new = np.zeros(max(table.num_rows - 1, 0), bool)
    for c in CELL:
        column = table.column(c)
        new |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy()
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def _swept(pieces: DataFrame, work: Callable, schema: str) -> DataFrame:
    """The rows that ``work`` gives for each cell, from its edges, their polygons and sides; before them code, lon and lat."""
    rows = _dealt(pieces).select(*CELL, "side", *ENDS)
    # The pieces of a cell lie together: many cells are one call, and only a cell is held.
    rows = rows.repartition(*CELL).sortWithinPartitions(*CELL)
    schema = f"code {pieces.schema['code'].dataType.simpleString()}, lon double, lat double, {schema}"
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    names = kinds.names

    def done(table: pa.Table, starts: np.ndarray) -> tuple[list[pa.Array], list[tuple]]:
        edges, owner = _edges(table)
        side = table.column("side").to_numpy()[owner]
        bounds = np.searchsorted(owner, np.append(starts, table.num_rows))
        found, cell = [], []
        for k, (low, high) in enumerate(itertools.pairwise(bounds)):
            own = work(edges[:, low:high], owner[low:high], side[low:high])
            found += own
            cell += [k] * len(own)
        first = table.take(pa.array(starts))
        size = 0.5 ** first.column("level").to_numpy()
        corner = [pa.array(np.floor(first.column(c).to_numpy() * size)) for c in ("ix", "iy")]
        cell = pa.array(cell, pa.int64())
        columns = [first.column("code").combine_chunks().take(cell), *[c.take(cell) for c in corner]]
        return columns, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            table = pa.Table.from_batches([*held, *([batch] if batch is not None else [])]) if held or batch is not None else None
            if table is None or not table.num_rows:
                continue
            starts = _cells(table)
            end = table.num_rows if batch is None else int(starts[-1])
            held = table.slice(end).combine_chunks().to_batches()
            if end:
                columns, found = done(table.slice(0, end), starts[starts < end])
                values = list(zip(*found, strict=True)) or [[] for _ in names[3:]]
                columns += [pa.array(v, kinds.field(n).type) for n, v in zip(names[3:], values, strict=True)]
                yield pa.RecordBatch.from_arrays([c.cast(kinds.field(n).type) for n, c in zip(names, columns, strict=True)], names)

    return rows.mapInArrow(run, schema)


# --- results -------------------------------------------------------------------


def shared_area(land: DataFrame, cover: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """Per one-degree box with land: ``code, lon, lat, land_area, covered_area``, in square degrees.

    ``land`` and ``cover`` hold polygons by code; of each code the polygons of a side count
    as their union. ``covered_area`` is the part of the land under some cover of its code,
    0 where there is none. Polygons without area, with no rings or without finite
    corners count for nothing, and so do rows of null code.
    """
    ground = _pieces(land, code, rings, LAND)
    boxes = ground.select("code", "ix", "iy").distinct()
    over = _pieces(cover, code, rings, COVER).join(boxes, ["code", "ix", "iy"], "left_semi")

    def work(edges: np.ndarray, owner: np.ndarray, side: np.ndarray) -> list[tuple[float, float]]:
        land = both = 0.0
        for stack in sweep(edges, owner, side):
            size = _sizes(stack)
            land += size[stack.land].sum()
            both += size[stack.land & stack.cover].sum()
        return [(land, both)]

    cells = _swept(ground.unionByName(over.select(*ground.columns)), work, "land double, both double")
    sums = cells.groupBy("code", "lon", "lat").agg(F.sum("land").alias("land_area"), F.sum("both").alias("covered_area"))
    return sums.where("land_area > 0").withColumnRenamed("code", code)


def union_area(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """``code, area``: what the polygons of each code cover together, in square degrees; see :func:`shared_area`."""

    def work(edges: np.ndarray, owner: np.ndarray, side: np.ndarray) -> list[tuple[float]]:
        return [(float(sum(_sizes(s)[s.cover].sum() for s in sweep(edges, owner, side))),)]

    cells = _swept(_pieces(polygons, code, rings, COVER), work, "area double")
    return cells.groupBy(F.col("code").alias(code)).agg(F.sum("area").alias("area"))


def union_parts(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """``code, rings``: the union of each code as trapezoids that don't overlap, one row each with one closed ring."""

    def work(edges: np.ndarray, owner: np.ndarray, side: np.ndarray) -> list[tuple[list]]:
        corners = [np.zeros((0, 5, 2))]
        for s in sweep(edges, owner, side):
            before = np.concatenate([[False], s.cover[:-1]])
            low, high = np.flatnonzero(s.cover & ~before), np.flatnonzero(~s.cover & before)
            left, right = s.left[low], s.right[low]
            y = [_at(edges[:, s.edge[k]], x) for k, x in ((low, left), (low, right), (high, right), (high, left))]
            ring = np.stack([np.stack([x, v], 1) for x, v in zip((left, right, right, left), y, strict=True)], 1)
            tall = np.maximum(ring[:, 3, 1] - ring[:, 0, 1], ring[:, 2, 1] - ring[:, 1, 1]) > 0
            corners.append(np.concatenate([ring, ring[:, :1]], 1)[tall])
        return [([[{"x": x, "y": y} for x, y in ring]],) for ring in np.concatenate(corners).tolist()]

    parts = _swept(_pieces(polygons, code, rings, COVER), work, "rings array<array<struct<x:double,y:double>>>")
    return parts.select(F.col("code").alias(code), "rings")
