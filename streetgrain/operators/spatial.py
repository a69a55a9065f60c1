"""Spatial aggregation of address points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions import geo

GRID_SIZES = (0.1, 0.2, 0.5, 1.0)
PYRAMID_STEP = 3


def grid_summary(points: DataFrame, keys: list[str], size: float = 0.1, ordered: bool = True) -> DataFrame:
    """Points per grid cell: ``keys, count, lon, lat, area``, by lat and lon.

    Cells are grouped by whole-number index; counts are combined before the
    shuffle, so a crowded cell costs one row per task. Without ``ordered`` the
    final sort is left out.
    """
    if size not in GRID_SIZES:
        raise ValueError(f"cell size must be one of {GRID_SIZES}")
    index = lambda c: F.floor(F.col(c) / F.lit(size)).cast("bigint")
    cells = points.groupBy(*keys, index("lon").alias("_i"), index("lat").alias("_j")).agg(
        F.count("*").alias("count")
    )
    lon, lat = F.col("_i") * size, F.col("_j") * size
    if ordered:
        cells = cells.orderBy(*keys, "_j", "_i")
    return cells.select(
        *keys, "count",
        F.format_string("%.1f", lon).alias("lon"),
        F.format_string("%.1f", lat).alias("lat"),
        geo.box_text(lon, lat, size).alias("area"),
    )


def tile_key(lon: Column, lat: Column) -> dict[str, Column]:
    """South-west corner of the one-degree tile of a point."""
    return {"tile_lon": F.floor(lon).cast("bigint"), "tile_lat": F.floor(lat).cast("bigint")}


def tile_name(tile_lon: Column, tile_lat: Column) -> Column:
    return F.format_string("tiles/%.1f/%.1f", tile_lon.cast("double"), tile_lat.cast("double"))


def tile_source_counts(points: DataFrame) -> DataFrame:
    """Points per tile and source; share-alike sources are left out."""
    free = points.filter(~F.col("share_alike").eqNullSafe("true"))
    tiles = [c.alias(n) for n, c in tile_key(F.col("lon"), F.col("lat")).items()]
    return free.groupBy(*tiles, "source_base").agg(F.count("*").alias("points"))


def tile_index(points: DataFrame) -> DataFrame:
    """Points and sources per tile."""
    return (
        tile_source_counts(points)
        .groupBy("tile_lon", "tile_lat")
        .agg(F.sum("points").alias("points"), F.count("*").alias("sources"))
        .withColumn("key", tile_name(F.col("tile_lon"), F.col("tile_lat")))
    )


def tile_blocks(points: DataFrame) -> DataFrame:
    """Points laid out for tile files: clustered and sorted by tile.

    Range partitioning on the tile and a spread column keeps neighbours
    together and cuts a crowded tile into several tasks; AQE sizes them.
    """
    keyed = points.withColumns(tile_key(F.col("lon"), F.col("lat")))
    spread = F.xxhash64("lon", "lat")
    return (
        keyed.withColumn("_spread", spread)
        .repartitionByRange("tile_lon", "tile_lat", "_spread")
        .sortWithinPartitions("tile_lon", "tile_lat")
        .drop("_spread")
    )


def point_stats(points: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Count, means and sample deviations; fewer than two points give none."""
    return (
        points.groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            F.avg(x).alias("xmean"), F.stddev_samp(x).alias("xsdev"),
            F.avg(y).alias("ymean"), F.stddev_samp(y).alias("ysdev"),
        )
        .filter(F.col("n") >= 2)
    )


def robust_bounds(points: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Extent without far outliers, padded by two percent on every side.

    An axis takes the points within five (x) or three (y) deviations of its
    mean. Without keys the statistics return as scalar subqueries; with keys
    they are one small row per group, joined back to the points.
    """
    stats = point_stats(points, keys, x, y)
    names = ["xmean", "xsdev", "ymean", "ysdev"]
    if keys:
        with_stats = points.select(*keys, x, y).join(stats.select(*keys, *names), keys)
    else:
        one = stats.select(F.struct(*names).alias("s")).scalar()
        with_stats = points.select(x, y, one.alias("s")).select(x, y, "s.*")
    near_x = F.abs(F.col(x) - F.col("xmean")) <= F.col("xsdev") * 5
    near_y = F.abs(F.col(y) - F.col("ymean")) <= F.col("ysdev") * 3
    extent = with_stats.groupBy(*keys).agg(
        F.min(F.when(near_x, F.col(x))).alias("l"), F.max(F.when(near_x, F.col(x))).alias("r"),
        F.min(F.when(near_y, F.col(y))).alias("b"), F.max(F.when(near_y, F.col(y))).alias("t"),
    )
    width, height = (F.col("r") - F.col("l")) / 50, (F.col("t") - F.col("b")) / 50
    return extent.select(
        *keys,
        (F.col("l") - width).alias("xmin"), (F.col("b") - height).alias("ymin"),
        (F.col("r") + width).alias("xmax"), (F.col("t") + height).alias("ymax"),
    )


# --- web tiles -------------------------------------------------------------------


def tile_pyramid(points: DataFrame, keys: list[str] = [], zmin: int = 0, zmax: int = 15) -> DataFrame:
    """Points per web tile at every zoom: ``keys, zoom, col, row, points``.

    Only the finest level reads the points. A coarser tile holds whole finer
    tiles, so other levels are sums over those of the nearest base below, each
    ``PYRAMID_STEP`` levels: a task then holds the tiles of few levels at once.
    The lone tile at zoom 0 is combined before the shuffle like any other. Points
    at the poles lie in the border tiles.
    """
    z = F.lit(float(zmax))
    side = 2**zmax - 1
    clamp = lambda c: F.least(F.greatest(c, F.lit(0)), F.lit(side)).cast("bigint")
    x, y = geo.mercator_x(F.col("lon")), geo.tile_y(F.col("lat"))
    placed = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull() & ~F.isnan("lon") & ~F.isnan("lat"))
    base = placed.groupBy(
        *keys, clamp(geo.tile_column(x, z)).alias("col"), clamp(geo.tile_row(y, z)).alias("row")
    ).agg(F.count("*").alias("points"))
    coarser = lambda n: [F.call_function("shiftright", F.col(c), n).alias(c) for c in ("col", "row")]
    names = [*keys, "zoom", "col", "row", "points"]
    levels = []
    for zoom in range(zmax, zmin - 1, -PYRAMID_STEP):
        levels.append(base.withColumn("zoom", F.lit(zoom)).select(*names))
        low = max(zmin, zoom - PYRAMID_STEP + 1)
        if low < zoom:
            between = base.select("*", F.explode(F.sequence(F.lit(low), F.lit(zoom - 1))).alias("zoom"))
            levels.append(between.groupBy(*keys, "zoom", *coarser(F.lit(zoom) - F.col("zoom"))).agg(F.sum("points").alias("points")).select(*names))
        base = base.groupBy(*keys, *coarser(F.lit(PYRAMID_STEP))).agg(F.sum("points").alias("points"))
    return reduce(DataFrame.unionByName, levels)


def drop_rate_thinning(points: DataFrame, key: Column, rate: int = 2, base: int = 15, zmin: int = 0) -> DataFrame:
    """Points to draw at every zoom below ``base``: one in rate**(base - zoom).

    Whether a point stays depends on a hash of its key only: no shuffle, and a
    point drawn at one zoom is drawn at every closer one.
    """
    spread = F.conv(F.substring(F.md5(key.cast("string")), 1, 12), 16, 10).cast("bigint")
    zooms = F.filter(
        F.sequence(F.lit(zmin), F.lit(base)),
        lambda z: F.col("_h") % F.pow(F.lit(float(rate)), F.lit(base) - z).cast("bigint") == 0,
    )
    return points.withColumn("_h", spread).withColumn("zoom", F.explode(zooms)).drop("_h")


QUADRANTS = ("northwest", "northeast", "southeast", "southwest")


def quadrant_split(tiles: DataFrame) -> DataFrame:
    """Tiles with their world quadrant; rows are counted from the south.

    The tile at zoom 0 belongs to all four quadrants.
    """
    half = F.pow(F.lit(2.0), F.col("zoom") - 1)
    side = F.concat(
        F.when(F.col("row") >= half, F.lit("north")).otherwise(F.lit("south")),
        F.when(F.col("col") >= half, F.lit("east")).otherwise(F.lit("west")),
    )
    every = F.array(*[F.lit(q) for q in QUADRANTS])
    return tiles.withColumn("quadrant", F.explode(F.when(F.col("zoom") == 0, every).otherwise(F.array(side))))


def join_tilesets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two tile tables as one; tiles in both add up."""
    both = left.unionByName(right)
    keys = [c for c in left.columns if c != "points"]
    return both.groupBy(*keys).agg(F.sum("points").alias("points"))


def tile_cover(bounds: DataFrame, zoom: int) -> DataFrame:
    """All tiles that meet a Mercator rectangle ``xmin, ymin, xmax, ymax``."""
    z = F.lit(float(zoom))
    span = lambda low, high: F.explode(F.sequence(low, high))
    rows = bounds.withColumn(
        "row", span(geo.tile_row(F.col("ymax"), z), geo.tile_row(F.col("ymin"), z))
    )
    return rows.withColumn(
        "col", span(geo.tile_column(F.col("xmin"), z), geo.tile_column(F.col("xmax"), z))
    )


# --- shapes -------------------------------------------------------------------------


def polygon_filter(df: DataFrame, wkt: str = "wkt") -> DataFrame:
    """Rows with a single polygon; multi-polygons are dropped too."""
    return df.filter(geo.geometry_type(F.col(wkt)).isin("Polygon", "Polygon 2.5D"))


def shared_borders(boxes: DataFrame, cell: float = 1.0) -> DataFrame:
    """Unordered pairs of boxes that touch or overlap: ``left_id, right_id``.

    ``boxes``: ``id, xmin, ymin, xmax, ymax``. Boxes are spread over the grid
    cells they meet and joined on the cell. A pair is reported only by the cell
    with the south-west corner of its common part, so nothing is deduplicated
    afterwards. Choose ``cell`` near the usual box size: the join then sees
    little more than the pairs it returns, and AQE splits a crowded cell.
    """
    index = lambda c: F.floor(c / F.lit(cell)).cast("bigint")
    spread = boxes.withColumn(
        "ci", F.explode(F.sequence(index(F.col("xmin")), index(F.col("xmax"))))
    ).withColumn("cj", F.explode(F.sequence(index(F.col("ymin")), index(F.col("ymax")))))
    l, r = spread.alias("l"), spread.alias("r")
    meets = (
        (F.col("l.ci") == F.col("r.ci")) & (F.col("l.cj") == F.col("r.cj")) & (F.col("l.id") < F.col("r.id"))
        & (F.col("l.xmin") <= F.col("r.xmax")) & (F.col("r.xmin") <= F.col("l.xmax"))
        & (F.col("l.ymin") <= F.col("r.ymax")) & (F.col("r.ymin") <= F.col("l.ymax"))
        & (F.col("l.ci") == index(F.greatest("l.xmin", "r.xmin")))
        & (F.col("l.cj") == index(F.greatest("l.ymin", "r.ymin")))
    )
    return l.join(r, meets).select(F.col("l.id").alias("left_id"), F.col("r.id").alias("right_id"))
