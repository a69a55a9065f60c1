"""Coverage of countries and states by area and population."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions import geo
from streetgrain.functions.areas import coverage_band

CROSSINGS = 1 << 20  # of edges and rows of cells, worked on at a time


def assign_box_id(statistics: DataFrame, boxes: DataFrame) -> DataFrame:
    """Statistics rows with the id of the box at the same place and size."""
    return statistics.join(
        boxes.select(F.col("id").alias("box_id"), "lon", "lat", "size"), ["lon", "lat", "size"], "left"
    )


def box_dimension(areas: DataFrame, statistics: DataFrame, boxes: DataFrame, code: str, size: float = 1.0) -> DataFrame:
    """Every area with its statistics boxes of one size.

    ``areas``: code and geometry; ``statistics``: code, ``box_id``,
    ``population``, ``area``; ``boxes``: ``id, lon, lat, size``.
    """
    cells = boxes.filter(F.col("size") == size).select(F.col("id").alias("box_id"), "lon", "lat", "size")
    return statistics.join(cells, "box_id").join(areas, code)


def clip_to_boxes(areas_in_boxes: DataFrame, rings: str = "rings") -> DataFrame:
    """Adds the part of each geometry inside its box, and the size of the part."""
    lon, lat, size = F.col("lon"), F.col("lat"), F.col("size")
    clipped = areas_in_boxes.withColumn(
        "clipped", geo.clip_to_box(F.col(rings), lon, lat, lon + size, lat + size)
    )
    return clipped.withColumn("clipped_area", geo.polygon_area(F.col("clipped")))


def covered_vs_land(land: DataFrame, covered: DataFrame, code: str) -> DataFrame:
    """Land boxes with the covered part beside them; boxes without land drop out.

    ``land``: code, ``box_id, name, area, population, land_area``; ``covered``:
    code, ``box_id, covered_area``. A box without coverage has a null there.
    """
    return land.filter(F.col("land_area") > 0).join(covered, [code, "box_id"], "left")


def coverage_summary(boxes: DataFrame, code: str) -> DataFrame:
    """Covered area and population per code, as totals and as fractions.

    ``boxes``: code, ``name, area, population, fraction``; the fraction is the
    covered share of the land in the box, null where there is none.
    """
    share = lambda c: F.sum(F.col(c) * F.col("fraction"))
    return boxes.groupBy(code).agg(
        F.min("name").alias("name"),
        share("area").alias("area_total"),
        share("population").alias("pop_total"),
        F.try_divide(share("area"), F.sum("area")).alias("area_pct"),
        F.try_divide(share("population"), F.sum("population")).alias("pop_pct"),
    )


def with_band(summary: DataFrame) -> DataFrame:
    return summary.withColumn("band", coverage_band(F.col("pop_pct")))


def area_address_counts(features: DataFrame, code: str) -> DataFrame:
    """Addresses per country or state code."""
    return features.filter(F.col(code).isNotNull()).groupBy(code).agg(F.sum("count").alias("addr_count"))


# --- covered cells ------------------------------------------------------------


def cell_of(lon: Column, lat: Column, per_degree: int = 10) -> dict[str, Column]:
    """Whole-number index of a fine cell."""
    return {
        "cell_x": F.floor(lon * per_degree).cast("bigint"),
        "cell_y": F.floor(lat * per_degree).cast("bigint"),
    }


def grid_coverage(points: DataFrame, keys: list[str], per_degree: int = 10) -> DataFrame:
    """Share of the fine cells of each one-degree box that hold a point.

    Overlapping points count once, so the shares behave like the area of a
    union. Distinct cells are found by a combining aggregate, then counted.
    """
    cells = cell_of(F.col("lon"), F.col("lat"), per_degree)
    box = lambda c: F.floor(F.col(c) / per_degree).cast("bigint")
    distinct = points.groupBy(*keys, *[c.alias(n) for n, c in cells.items()]).agg(F.count("*").alias("_n"))
    return (
        distinct.groupBy(*keys, box("cell_x").alias("box_lon"), box("cell_y").alias("box_lat"))
        .agg(F.count("*").alias("cells"), F.sum("_n").alias("points"))
        .withColumn("fraction", F.col("cells") / float(per_degree**2))
    )


def cell_masks_of_rings(df: DataFrame, keys: list[str], rings: str = "rings", per_degree: int = 10) -> DataFrame:
    """Fine cells whose centre lies in a polygon (even-odd), as bit masks.

    ``keys, box_x, cell_y, mask``: bit i stands for cell ``box_x * per_degree +
    i`` of the row ``cell_y``; overlapping polygons set a bit once.

    A scan-line fill: every edge gives its crossing with each row of cell centres
    it spans; the sorted crossings of a shape in a row pair up to runs of cells.
    That takes the shape alone, so only masks are shuffled, as they come: shapes
    seldom share a row of a box, so a task's table of them would only fill memory.
    """
    if not 1 <= per_degree <= 32:
        raise ValueError("between 1 and 32 cells per degree fit a mask")
    shapes = df.select(*keys, F.col(rings).cast(geo.RINGS_TYPE).alias("_rings"))
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, box, cell_y, mask in _row_masks(batch.column("_rings"), per_degree):
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(at) for k in keys], pa.array(box), pa.array(cell_y), pa.array(mask)],
                    [*keys, "box_x", "cell_y", "mask"],
                )

    masks = shapes.mapInArrow(run, f"{kinds}box_x long, cell_y long, mask long")
    return masks.repartition(*keys, "box_x", "cell_y").groupBy(*keys, "box_x", "cell_y").agg(F.bit_or("mask").alias("mask"))


def _repeat(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each repeated item, and the number of each repetition."""
    item = np.repeat(np.arange(len(count)), count)
    return item, np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)


def _row_masks(rings: pa.Array, per_degree: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Shape, box, row and mask of the cells inside each shape, for some shapes at a time."""
    per_row = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
    ring = rings.flatten()
    of_row = np.repeat(np.arange(len(rings)), per_row)
    lost = np.bincount(of_row, pc.is_null(ring).to_numpy(zero_copy_only=False), len(rings)) > 0  # a ring is unknown, and with it the shape
    of_point = np.repeat(of_row, pc.fill_null(pc.list_value_length(ring), 0).to_numpy(zero_copy_only=False))
    of_ring = np.repeat(np.arange(len(ring)), pc.fill_null(pc.list_value_length(ring), 0).to_numpy(zero_copy_only=False))
    points = ring.flatten()
    x, y = (pc.cast(pc.struct_field(points, c), pa.float64()).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    edge = np.flatnonzero((of_ring[1:] == of_ring[:-1]) & ~lost[of_point[1:]] & np.isfinite(y[1:]) & np.isfinite(y[:-1]))
    low, high = np.minimum(y[edge], y[edge + 1]), np.maximum(y[edge], y[edge + 1])
    first = np.ceil(low * per_degree - 0.5).astype(np.int64)
    many = np.maximum(np.ceil(high * per_degree - 0.5).astype(np.int64) - first, 0)
    total = np.concatenate([[0], np.cumsum(np.bincount(of_point[edge], many, len(rings)).astype(np.int64))])
    start = np.searchsorted(of_point[edge], np.arange(len(rings) + 1))
    at = 0
    while at < len(rings):
        to = max(at + 1, int(np.searchsorted(total, total[at] + CROSSINGS, "right")) - 1)
        part = slice(start[at], start[to])
        i, k = _repeat(many[part])
        e, cell_y = edge[part][i], first[part][i] + k
        at = to
        middle = (cell_y + 0.5) / per_degree
        with np.errstate(invalid="ignore"):
            cross = (x[e + 1] - x[e]) * (middle - y[e]) / (y[e + 1] - y[e]) + x[e]
        cross = np.where(np.isfinite(x[e]) & np.isfinite(x[e + 1]), cross, -np.inf)
        row = of_point[e]
        order = np.lexsort((e, cross, cell_y, row))
        row, cell_y, cross = row[order], cell_y[order], cross[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (cell_y[1:] != cell_y[:-1])
        place = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
        left = np.flatnonzero(place[:-1] % 2 == 0)
        left = left[~new[left + 1]]
        left = left[np.isfinite(cross[left])]
        a = np.ceil(cross[left] * per_degree - 0.5).astype(np.int64)
        b = np.ceil(cross[left + 1] * per_degree - 0.5).astype(np.int64) - 1
        left, a, b = left[a <= b], a[a <= b], b[a <= b]
        s, k = _repeat(b // per_degree - a // per_degree + 1)
        box = a[s] // per_degree + k
        begin = np.maximum(a[s], box * per_degree) - box * per_degree
        width = np.minimum(b[s], box * per_degree + per_degree - 1) - box * per_degree - begin + 1
        mask = ((np.int64(1) << width) - 1) << begin
        if len(box):
            yield row[left][s], box, cell_y[left][s], mask


def cells_of_rings(df: DataFrame, keys: list[str], rings: str = "rings", per_degree: int = 10) -> DataFrame:
    """Fine cells whose centre lies in a polygon, each once per key."""
    masks = cell_masks_of_rings(df, keys, rings, per_degree)
    bits = F.sequence(F.lit(0), F.lit(per_degree - 1))
    inside = F.filter(bits, lambda b: F.call_function("getbit", F.col("mask"), b) == 1)
    cells = masks.withColumn("_bit", F.explode(inside))
    return cells.select(*keys, (F.col("box_x") * per_degree + F.col("_bit")).alias("cell_x"), "cell_y")


def covered_share(land: DataFrame, covered: DataFrame, code: str, per_degree: int = 10) -> DataFrame:
    """Covered share of the land in every one-degree box, from masks of both.

    ``code, name, lon, lat, fraction``; null where nothing is covered.
    """
    both = land.join(covered.withColumnRenamed("mask", "_covered"), [code, "box_x", "cell_y"], "left")
    common = F.bit_count(F.col("mask").bitwiseAND(F.col("_covered")))
    box_y = F.floor(F.col("cell_y") / per_degree).cast("double")
    hit = F.sum(F.when(common > 0, common))
    return both.groupBy(code, "name", F.col("box_x").cast("double").alias("lon"), box_y.alias("lat")).agg(
        (hit / F.sum(F.bit_count("mask"))).alias("fraction")
    )


# --- geographies and their sources -----------------------------------------------


def attach_coverage_status(geographies: DataFrame, sources: DataFrame) -> DataFrame:
    """Geographies with the sources that cover them; good sources win.

    ``geographies``: ``code, name``; ``sources``: ``code, path, good,
    address_count, date``. A geography with a good source is ``good`` and keeps
    good sources only; one with bad sources only is ``bad``; others drop out.
    """
    status = sources.groupBy("code").agg(F.bool_or("good").alias("good"))
    kept = sources.join(status, ["code", "good"])
    return geographies.join(kept, "code").withColumn(
        "status", F.when(F.col("good"), F.lit("good")).otherwise(F.lit("bad"))
    )


def good_and_bad_sources(sources: DataFrame, good: DataFrame) -> DataFrame:
    """All sources, marked by whether they are among the good ones."""
    marked = good.select("path").distinct().withColumn("_good", F.lit(True))
    return sources.join(marked, "path", "left").withColumn("good", F.col("_good").isNotNull()).drop("_good")


def coverage_features(attached: DataFrame) -> DataFrame:
    """One feature per geography: status, number of sources and address total."""
    return attached.groupBy("code", "name", "status").agg(
        F.count("*").alias("source_count"),
        F.sum(F.when(F.col("good"), F.coalesce("address_count", F.lit(0))).otherwise(0)).alias("address_count"),
    )


def coverage_paths(attached: DataFrame) -> DataFrame:
    """Sources of the features: ``code, path`` and, for good sources, ``date``.

    The list of a feature is its rows in order of ``path``.
    """
    return attached.select("code", "path", F.when(F.col("good"), F.col("date")).alias("date"))
