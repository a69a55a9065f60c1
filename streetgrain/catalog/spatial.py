"""Check queries: point filters, grids, tiles, extents and shapes."""

from pyspark.sql import functions as F

from streetgrain.catalog.base import query
from streetgrain.catalog.views import table, view, view_sql
from streetgrain.functions import geo
from streetgrain.functions.projection import reproject
from streetgrain.operators import coverage, filters, places, spatial

NUMBER = r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"


def number_sql(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, '{NUMBER}') THEN TRY_CAST(trim({column}) AS DOUBLE) END"


PARSED = (
    f"raw AS ({view_sql('pts')}), parsed AS (SELECT * EXCLUDE (lon, lat), {number_sql('lon_text')} AS lon, "
    f"{number_sql('lat_text')} AS lat FROM raw)"
)
GOOD = f"WITH {PARSED}, good AS (SELECT * FROM parsed WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90)"
MERC = (
    "merc AS (SELECT *, radians(lon) * 6378137.0 AS x, ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0 AS y "
    "FROM good WHERE abs(lat) < 90)"
)
# For tiles: latitudes at and beyond the poles count as just before them.
POLED = "ln(tan(pi() / 4 + radians(least(greatest(lat, -89.9999999), 89.9999999)) / 2)) * 6378137.0"
DIAMETER = "(2 * pi() * 6378137.0)"


def points(spark, sf_dir):
    return filters.on_earth(view(spark, sf_dir, "pts"), "lon_text", "lat_text")


def projected(spark, sf_dir):
    good = points(spark, sf_dir)
    return good.select(
        "source_base", geo.mercator_x(F.col("lon")).alias("x"), geo.mercator_y(F.col("lat")).alias("y")
    ).filter(F.col("y").isNotNull())


@query("P01_on_earth", f"{GOOD} SELECT pt_id, source_base, lon, lat FROM good")
def _(spark, sf_dir):
    return points(spark, sf_dir).select("pt_id", "source_base", "lon", "lat")


@query(
    "P02_parseable_point",
    f"WITH {PARSED} SELECT pt_id, isnan(lon) AS odd, CASE WHEN isnan(lon) THEN 0 ELSE lon END AS lon, lat "
    "FROM parsed WHERE lon IS NOT NULL AND lat IS NOT NULL",
)
def _(spark, sf_dir):
    kept = filters.parseable_point(view(spark, sf_dir, "pts"), "lon_text", "lat_text")
    odd = F.isnan("lon")
    return kept.select("pt_id", odd.alias("odd"), F.when(odd, 0.0).otherwise(F.col("lon")).alias("lon"), "lat")


@query(
    "P03_license_class",
    f"WITH pts AS ({view_sql('pts')}) SELECT CASE WHEN share_alike = 'true' THEN 'sa' ELSE '' END AS license_attr, "
    "count(*) AS points, count(DISTINCT source_base) AS sources FROM pts GROUP BY 1",
)
def _(spark, sf_dir):
    from streetgrain.functions.licenses import license_class

    # Two aggregates instead of a distinct count over all points.
    per_source = (
        view(spark, sf_dir, "pts")
        .groupBy(license_class(F.col("share_alike")).alias("license_attr"), "source_base")
        .agg(F.count("*").alias("n"))
    )
    return per_source.groupBy("license_attr").agg(F.sum("n").alias("points"), F.count("*").alias("sources"))


AREA_SQL = """
 UNNEST(list_filter([
  'global',
  CASE WHEN regexp_matches(source_base, '^us/(ct|me|ma|nh|ri|vt|nj|ny|pa)($|[./])') OR regexp_matches(source_base, '^us-(ct|me|ma|nh|ri|vt|nj|ny|pa)($|[.-])') THEN 'us_northeast' END,
  CASE WHEN regexp_matches(source_base, '^us/(il|in|mi|oh|wi|ia|ks|mn|mo|ne|nd|sd)($|[./])') OR regexp_matches(source_base, '^us-(il|in|mi|oh|wi|ia|ks|mn|mo|ne|nd|sd)($|[.-])') THEN 'us_midwest' END,
  CASE WHEN regexp_matches(source_base, '^us/(de|fl|ga|md|nc|sc|va|dc|wv|al|ky|ms|ar|la|ok|tx|tn)($|[./])') OR regexp_matches(source_base, '^us-(de|fl|ga|md|nc|sc|va|dc|wv|al|ky|ms|ar|la|ok|tx|tn)($|[.-])') THEN 'us_south' END,
  CASE WHEN regexp_matches(source_base, '^us/(az|co|id|mt|nv|nm|ut|wy|ak|ca|hi|or|wa)($|[./])') OR regexp_matches(source_base, '^us-(az|co|id|mt|nv|nm|ut|wy|ak|ca|hi|or|wa)($|[.-])') THEN 'us_west' END,
  CASE WHEN regexp_matches(source_base, '^(de|fr|gb)($|[./-])') THEN 'europe' END,
  CASE WHEN regexp_matches(source_base, '^(jp|nz|au)($|[./-])') THEN 'asia' END,
  CASE WHEN regexp_matches(source_base, '^(br|ar|cl)($|[./-])') THEN 'south_america' END,
  CASE WHEN regexp_matches(source_base, '^(mx|ca|pa)($|[./-])') THEN 'north_america' END
 ], lambda x: x IS NOT NULL))"""


@query(
    "P04_in_area",
    f"WITH pts AS ({view_sql('pts')}), s AS (SELECT source_base, count(*) AS n FROM pts GROUP BY 1) "
    f"SELECT source_base, n, {AREA_SQL} AS area FROM s",
)
def _(spark, sf_dir):
    sources = view(spark, sf_dir, "pts").groupBy("source_base").agg(F.count("*").alias("n"))
    return filters.by_area(sources)


GRID_SQL = """
 SELECT {keys} c AS count, printf('%.1f', i * {s}) AS lon, printf('%.1f', j * {s}) AS lat,
  'POLYGON((' || printf('%.1f', i * {s}) || ' ' || printf('%.1f', j * {s}) || ','
   || printf('%.1f', i * {s}) || ' ' || printf('%.1f', j * {s} + {s}) || ','
   || printf('%.1f', i * {s} + {s}) || ' ' || printf('%.1f', j * {s} + {s}) || ','
   || printf('%.1f', i * {s} + {s}) || ' ' || printf('%.1f', j * {s}) || ','
   || printf('%.1f', i * {s}) || ' ' || printf('%.1f', j * {s}) || '))' AS area
 FROM (SELECT {keys} floor(lon / {s}) AS i, floor(lat / {s}) AS j, count(*) AS c FROM good GROUP BY {keys} i, j)"""


@query("A01_grid_summary", f"{GOOD} " + GRID_SQL.format(keys="source_base,", s="CAST(0.1 AS DOUBLE)"))
def _(spark, sf_dir):
    return spatial.grid_summary(points(spark, sf_dir), ["source_base"])


@query("A01_grid_summary_half_degree", f"{GOOD} " + GRID_SQL.format(keys="", s="CAST(0.5 AS DOUBLE)"))
def _(spark, sf_dir):
    return spatial.grid_summary(points(spark, sf_dir), [], 0.5)


TILES_SQL = (
    "tiles AS (SELECT CAST(floor(lon) AS BIGINT) AS tile_lon, CAST(floor(lat) AS BIGINT) AS tile_lat, source_base, "
    "count(*) AS points FROM good WHERE share_alike IS DISTINCT FROM 'true' GROUP BY ALL)"
)


@query("A02_tile_counts", f"{GOOD}, {TILES_SQL} SELECT * FROM tiles")
def _(spark, sf_dir):
    return spatial.tile_source_counts(points(spark, sf_dir))


@query(
    "A02_tile_index",
    f"{GOOD}, {TILES_SQL} SELECT tile_lon, tile_lat, CAST(sum(points) AS BIGINT) AS points, count(*) AS sources, "
    "printf('tiles/%.1f/%.1f', CAST(tile_lon AS DOUBLE), CAST(tile_lat AS DOUBLE)) AS key FROM tiles GROUP BY 1, 2",
)
def _(spark, sf_dir):
    return spatial.tile_index(points(spark, sf_dir))


@query(
    "L08_tile_blocks",
    f"{GOOD} SELECT pt_id, lon, lat, CAST(floor(lon) AS BIGINT) AS tile_lon, CAST(floor(lat) AS BIGINT) AS tile_lat FROM good",
)
def _(spark, sf_dir):
    return spatial.tile_blocks(points(spark, sf_dir)).select("pt_id", "lon", "lat", "tile_lon", "tile_lat")


@query(
    "L08_places",
    f"{GOOD}, p AS (SELECT tile_lon, tile_lat, row_number() OVER (ORDER BY tile_lon, tile_lat) AS place FROM "
    "(SELECT CAST(floor(lon) AS BIGINT) AS tile_lon, CAST(floor(lat) AS BIGINT) AS tile_lat FROM good)) "
    "SELECT tile_lon, tile_lat, min(place) AS first_place, max(place) AS last_place, count(*) AS n FROM p GROUP BY ALL",
)
def _(spark, sf_dir):
    return places.span_of_places(spatial.tile_blocks(points(spark, sf_dir)).select("tile_lon", "tile_lat"), ["tile_lon", "tile_lat"])


@query(
    "A11_grid_coverage",
    f"{GOOD}, cells AS (SELECT source_base, floor(lon * 10) AS cx, floor(lat * 10) AS cy, count(*) AS n FROM good GROUP BY ALL) "
    "SELECT source_base, CAST(floor(cx / 10) AS BIGINT) AS box_lon, CAST(floor(cy / 10) AS BIGINT) AS box_lat, "
    "count(*) AS cells, CAST(sum(n) AS BIGINT) AS points, count(*) / CAST(100 AS DOUBLE) AS fraction FROM cells GROUP BY 1, 2, 3",
)
def _(spark, sf_dir):
    return coverage.grid_coverage(points(spark, sf_dir), ["source_base"])


STATS_SQL = (
    f"{GOOD}, {MERC}, stats AS (SELECT source_base, count(*) AS n, avg(x) AS xmean, stddev_samp(x) AS xsdev, "
    "avg(y) AS ymean, stddev_samp(y) AS ysdev FROM merc GROUP BY 1 HAVING count(*) >= 2)"
)


@query(
    "A12_point_stats",
    f"{STATS_SQL} SELECT source_base, n, round(xmean, 1) AS xmean, round(xsdev, 1) AS xsdev, round(ymean, 1) AS ymean, "
    "round(ysdev, 1) AS ysdev FROM stats",
)
def _(spark, sf_dir):
    stats = spatial.point_stats(projected(spark, sf_dir), ["source_base"])
    return stats.select("source_base", "n", *[F.round(c, 1).alias(c) for c in ("xmean", "xsdev", "ymean", "ysdev")])


def bounds_sql(keys: str) -> str:
    return f"""SELECT {keys} round(l - (r - l) / 50, 2) AS xmin, round(b - (t - b) / 50, 2) AS ymin,
 round(r + (r - l) / 50, 2) AS xmax, round(t + (t - b) / 50, 2) AS ymax FROM (
 SELECT {keys} min(x) FILTER (abs(x - xmean) <= 5 * xsdev) AS l, max(x) FILTER (abs(x - xmean) <= 5 * xsdev) AS r,
  min(y) FILTER (abs(y - ymean) <= 3 * ysdev) AS b, max(y) FILTER (abs(y - ymean) <= 3 * ysdev) AS t
 FROM with_stats {'GROUP BY ' + keys.rstrip(', ') if keys else ''})"""


@query(
    "A15_robust_bounds",
    f"{STATS_SQL}, with_stats AS (SELECT * FROM merc JOIN stats USING (source_base)) " + bounds_sql("source_base, "),
)
def _(spark, sf_dir):
    bounds = spatial.robust_bounds(projected(spark, sf_dir), ["source_base"])
    return bounds.select("source_base", *[F.round(c, 2).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query(
    "A15_robust_bounds_of_all",
    f"{GOOD}, {MERC}, with_stats AS (SELECT * FROM merc, (SELECT avg(x) AS xmean, stddev_samp(x) AS xsdev, avg(y) AS ymean, "
    "stddev_samp(y) AS ysdev FROM merc)) " + bounds_sql(""),
)
def _(spark, sf_dir):
    bounds = spatial.robust_bounds(projected(spark, sf_dir), [])
    return bounds.select(*[F.round(c, 2).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def tile_sql(zoom: str) -> str:
    side = f"pow(2.0, {zoom})"
    clamp = lambda v: f"CAST(least(greatest(floor({v}), 0), {side} - 1) AS BIGINT)"
    return (
        clamp(f"(x + {DIAMETER} / 2) / {DIAMETER} * {side}") + " AS col, "
        + clamp(f"({DIAMETER} / 2 - y) / {DIAMETER} * {side}") + ' AS "row"'
    )


@query(
    "A17_tile_pyramid",
    f"{GOOD}, merc AS (SELECT radians(lon) * 6378137.0 AS x, {POLED} AS y FROM good), zooms AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS zoom) "
    f"SELECT zoom, {tile_sql('zoom')}, count(*) AS points FROM merc, zooms GROUP BY ALL",
)
def _(spark, sf_dir):
    return spatial.tile_pyramid(points(spark, sf_dir))


HASH12 = "('0x' || substr(md5(CAST(pt_id AS VARCHAR)), 1, 12))::BIGINT"


@query(
    "W06_drop_rate_thinning",
    f"{GOOD}, zooms AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS zoom) SELECT zoom, count(*) AS points, "
    f"CAST(sum(pt_id) AS BIGINT) AS ids FROM good, zooms WHERE {HASH12} % CAST(pow(2, 15 - zoom) AS BIGINT) = 0 GROUP BY 1",
)
def _(spark, sf_dir):
    drawn = spatial.drop_rate_thinning(points(spark, sf_dir), F.col("pt_id"))
    return drawn.groupBy("zoom").agg(F.count("*").alias("points"), F.sum("pt_id").alias("ids"))


@query(
    "W06_drop_rate_three",
    f"{GOOD}, zooms AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS zoom) SELECT pt_id, lon, zoom "
    f"FROM good, zooms WHERE zoom >= 12 AND {HASH12} % CAST(pow(3, 15 - zoom) AS BIGINT) = 0",
)
def _(spark, sf_dir):
    return spatial.drop_rate_thinning(points(spark, sf_dir), F.col("pt_id"), rate=3, zmin=12).select("pt_id", "lon", "zoom")


QUADRANT_SQL = f"""{GOOD}, {MERC}, zooms AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS zoom),
 tiles AS (SELECT zoom, {tile_sql('zoom')}, count(*) AS points FROM merc, zooms GROUP BY ALL),
 flipped AS (SELECT zoom, col, CAST(pow(2, zoom) AS BIGINT) - 1 - "row" AS "row", points FROM tiles),
 quadrants AS (SELECT unnest(['northwest', 'northeast', 'southeast', 'southwest']) AS quadrant)
 SELECT zoom, col, "row", points, quadrant FROM flipped, quadrants WHERE zoom = 0 OR (
  (CASE WHEN "row" >= pow(2, zoom - 1) THEN 'north' ELSE 'south' END) || (CASE WHEN col >= pow(2, zoom - 1) THEN 'east' ELSE 'west' END) = quadrant)"""


@query("U04_quadrant_split", QUADRANT_SQL)
def _(spark, sf_dir):
    tiles = spatial.tile_pyramid(points(spark, sf_dir))
    flipped = tiles.withColumn("row", geo.flip_tile_row(F.col("row"), F.col("zoom").cast("double")))
    return spatial.quadrant_split(flipped)


@query(
    "U05_join_tilesets",
    f"{GOOD}, {MERC}, zooms AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS zoom) "
    f"SELECT zoom, {tile_sql('zoom')}, count(*) AS points FROM merc, zooms GROUP BY ALL",
)
def _(spark, sf_dir):
    good = points(spark, sf_dir)
    north = spatial.tile_pyramid(good.filter("lat >= 0"), zmax=15)
    south = spatial.tile_pyramid(good.filter("lat < 0"), zmax=15)
    return spatial.join_tilesets(north, south)


# --- projection and tile arithmetic -------------------------------------------------


@query("G04_project_mercator", f"{GOOD}, {MERC} SELECT pt_id, source_base, round(x, 3) AS x, round(y, 3) AS y FROM merc")
def _(spark, sf_dir):
    good = points(spark, sf_dir).select(
        "pt_id", "source_base",
        F.round(geo.mercator_x(F.col("lon")), 3).alias("x"), F.round(geo.mercator_y(F.col("lat")), 3).alias("y"),
    )
    return good.filter(F.col("y").isNotNull())


@query(
    "G03_reproject_web_mercator",
    f"{GOOD} SELECT pt_id, source_base, round(lon, 6) AS lon, round(lat, 6) AS lat FROM good WHERE abs(lat) < 90",
)
def _(spark, sf_dir):
    good = points(spark, sf_dir).filter("abs(lat) < 90")
    x, y = geo.mercator_x(F.col("lon")), geo.mercator_y(F.col("lat"))
    lon, lat = reproject(x, y, "EPSG:3857")
    return good.select("pt_id", "source_base", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("G03_reproject_conic_and_transverse")
def _(spark, sf_dir):
    pts = view(spark, sf_dir, "pts")
    x, y = F.col("lon") * 1000 + 7655634, F.col("lat") * 1000 + 668868
    lon1, lat1 = reproject(x, y, "EPSG:2913")
    lon2, lat2 = reproject(F.col("lon") * 1000 + 565210, F.col("lat") * 10000 + 4184173, "EPSG:3740")
    return pts.select("pt_id", lon1.alias("lon_conic"), lat1.alias("lat_conic"), lon2.alias("lon_utm"), lat2.alias("lat_utm"))


@query(
    "G11_tile_of",
    f"{GOOD}, {MERC} SELECT pt_id, source_base, CAST(floor((x + {DIAMETER} / 2) / {DIAMETER} * 4096) AS BIGINT) AS col, "
    f'CAST(floor(({DIAMETER} / 2 - y) / {DIAMETER} * 4096) AS BIGINT) AS "row" FROM merc',
)
def _(spark, sf_dir):
    z = F.lit(12.0)
    good = points(spark, sf_dir).select("pt_id", "source_base", "lon", "lat")
    return good.filter(F.abs("lat") < 90).select(
        "pt_id", "source_base", geo.tile_column(geo.mercator_x(F.col("lon")), z).alias("col"),
        geo.tile_row(geo.mercator_y(F.col("lat")), z).alias("row"),
    )


@query(
    "G12_tile_bounds",
    f"{GOOD}, t AS (SELECT DISTINCT CAST(floor(lon + 180) AS BIGINT) AS col, CAST(floor(lat + 90) AS BIGINT) AS \"row\" FROM good) "
    f'SELECT col, "row", round({DIAMETER} * (col / CAST(512 AS DOUBLE) - 0.5), 3) AS ulx, round({DIAMETER} * (0.5 - "row" / CAST(512 AS DOUBLE)), 3) AS uly, '
    f'round({DIAMETER} * ((col + 1) / CAST(512 AS DOUBLE) - 0.5), 3) AS lrx, round({DIAMETER} * (0.5 - ("row" + 1) / CAST(512 AS DOUBLE)), 3) AS lry FROM t',
)
def _(spark, sf_dir):
    tiles = points(spark, sf_dir).select(
        F.floor(F.col("lon") + 180).cast("bigint").alias("col"), F.floor(F.col("lat") + 90).cast("bigint").alias("row")
    ).distinct()
    b = tiles.withColumn("b", geo.tile_bounds(F.col("row"), F.col("col"), F.lit(9.0)))
    return b.select("col", "row", *[F.round(f"b.{c}", 3).alias(c) for c in ("ulx", "uly", "lrx", "lry")])


@query(
    "G13_zoom_for_scale",
    f"{GOOD} SELECT pt_id, source_base, round(log2(((abs(lon) + 1) / 100000) / (2.0 * 256 / {DIAMETER})), 6) AS zoom FROM good",
)
def _(spark, sf_dir):
    scale = (F.abs("lon") + 1) / 100000
    return points(spark, sf_dir).select(
        "pt_id", "source_base", F.round(geo.zoom_for_scale(scale, 2.0), 6).alias("zoom")
    )


@query(
    "G14_tile_cover",
    f"{STATS_SQL}, with_stats AS (SELECT * FROM merc JOIN stats USING (source_base)), b AS ({bounds_sql('source_base, ')}), "
    f"t AS (SELECT source_base, CAST(floor((xmin + {DIAMETER} / 2) / {DIAMETER} * 64) AS BIGINT) AS c0, "
    f"CAST(floor((xmax + {DIAMETER} / 2) / {DIAMETER} * 64) AS BIGINT) AS c1, "
    f"CAST(floor(({DIAMETER} / 2 - ymax) / {DIAMETER} * 64) AS BIGINT) AS r0, "
    f"CAST(floor(({DIAMETER} / 2 - ymin) / {DIAMETER} * 64) AS BIGINT) AS r1 FROM b), "
    'rr AS (SELECT *, unnest(range(r0, r1 + 1)) AS "row" FROM t) SELECT source_base, "row", unnest(range(c0, c1 + 1)) AS col FROM rr',
)
def _(spark, sf_dir):
    bounds = spatial.robust_bounds(projected(spark, sf_dir), ["source_base"])
    rounded = bounds.select("source_base", *[F.round(c, 2).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    return spatial.tile_cover(rounded, 6).select("source_base", "row", "col")


@query(
    "F15_flip_tile_row",
    f"{GOOD} SELECT pt_id, source_base, 1023 - CAST(floor(lat + 90) AS BIGINT) AS flipped FROM good",
)
def _(spark, sf_dir):
    row = F.floor(F.col("lat") + 90).cast("bigint")
    return points(spark, sf_dir).select(
        "pt_id", "source_base", geo.flip_tile_row(row, F.lit(10.0)).alias("flipped")
    )


@query(
    "G07_box_wkt",
    f"{GOOD}, c AS (SELECT DISTINCT floor(lon) AS i, floor(lat) AS j FROM good) SELECT 'POLYGON((' || printf('%.1f', i) || ' ' || printf('%.1f', j) || ',' "
    "|| printf('%.1f', i) || ' ' || printf('%.1f', j + 1) || ',' || printf('%.1f', i + 1) || ' ' || printf('%.1f', j + 1) || ',' "
    "|| printf('%.1f', i + 1) || ' ' || printf('%.1f', j) || ',' || printf('%.1f', i) || ' ' || printf('%.1f', j) || '))' AS area FROM c",
)
def _(spark, sf_dir):
    corner = lambda c: F.floor(c).cast("double")
    cells = points(spark, sf_dir).select(corner("lon").alias("i"), corner("lat").alias("j")).distinct()
    return cells.select(geo.box_text(F.col("i"), F.col("j"), 1.0).alias("area"))


# --- shapes ------------------------------------------------------------------------

SHAPE = {
    "id": "o_orderkey",
    "x0": "CAST(o_orderkey * 7919 % 3000 AS DOUBLE) / 10 - 150",
    "y0": "CAST(o_custkey * 104729 % 1500 AS DOUBLE) / 10 - 75",
    "w": "CAST(5 + o_orderkey % 20 AS DOUBLE) / 10",
    "h": "CAST(5 + o_custkey % 15 AS DOUBLE) / 10",
}
SHAPES_SQL = "shapes AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in SHAPE.items()) + " FROM orders)"


def shapes(spark, sf_dir, dx: float = 0.0, dy: float = 0.0):
    """Rectangles with a rectangular hole, from the orders."""
    s = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in SHAPE.items()])
    if dx or dy:
        s = s.withColumns({"x0": F.col("x0") + dx, "y0": F.col("y0") + dy})
    x, y, w, h = (F.col(c) for c in ("x0", "y0", "w", "h"))
    outer = geo.box_ring(x, y, x + w, y + h)
    hole = geo.box_ring(x + w / 4, y + h / 4, x + w / 2, y + h / 2)
    return s.withColumn("rings", F.array(outer, hole))


# Areas of sources: a shape with its hole, each fifth with an island beside it, each fourth far smaller than a box.
BLOTS = {
    "id": "id", "code": "split_part('FR,DE,JP', ',', CAST(id % 3 + 1 AS INT))", "x0": "x0 + 0.02", "y0": "y0 + 0.02",
    "w": "w / CASE WHEN id % 4 = 0 THEN 50 ELSE 1 END", "h": "h / CASE WHEN id % 4 = 0 THEN 50 ELSE 1 END", "more": "id % 5 = 0",
}
BLOTS_SQL = f"{SHAPES_SQL}, blots AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in BLOTS.items()) + " FROM shapes)"


def blots(spark, sf_dir):
    b = shapes(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in BLOTS.items()])
    x, y, w, h = (F.col(c) for c in ("x0", "y0", "w", "h"))
    rings = [geo.box_ring(x, y, x + w, y + h), geo.box_ring(x + w / 4, y + h / 4, x + w / 2, y + h / 2)]
    island = geo.box_ring(x + w * 1.25, y, x + w * 1.5, y + h / 2)
    return b.withColumn("rings", F.when(F.col("more"), F.array(*rings, island)).otherwise(F.array(*rings)))


def union_sql(places: str) -> str:
    """Area per place (code, lx, rx, ly, ry, ...) and in blots: between neighbouring corners all is covered or nothing is."""
    corners = lambda low, high, a, s: (
        f"SELECT DISTINCT code, lx, rx, ly, ry, unnest([{low}, {high}] || list_transform([0.0, 0.25, 0.5, 1.0, 1.25, 1.5], lambda f: greatest({low}, least({high}, {a} + {s} * CAST(f AS DOUBLE))))) AS v FROM met"
    )
    return (
        f"places AS ({places}), met AS (SELECT p.*, x0, y0, w, h, more FROM places p JOIN blots b ON p.code = b.code AND x0 < rx AND x0 + w * 1.5 > lx AND y0 < ry AND y0 + h > ly), "
        f"xs AS (SELECT *, lead(v) OVER (PARTITION BY code, lx, rx, ly, ry ORDER BY v) AS u FROM ({corners('lx', 'rx', 'x0', 'w')})), "
        f"ys AS (SELECT *, lead(v) OVER (PARTITION BY code, lx, rx, ly, ry ORDER BY v) AS u FROM ({corners('ly', 'ry', 'y0', 'h')})), "
        "tiles AS (SELECT code, lx, rx, ly, ry, xs.v AS xa, xs.u AS xb, ys.v AS ya, ys.u AS yb, (xs.v + xs.u) / 2 AS x, (ys.v + ys.u) / 2 AS y FROM xs JOIN ys USING (code, lx, rx, ly, ry) WHERE xs.u IS NOT NULL AND ys.u IS NOT NULL), "
        "inked AS (SELECT DISTINCT t.code, t.lx, t.rx, t.ly, t.ry, xa, xb, ya, yb FROM tiles t JOIN met m ON t.code = m.code AND t.lx = m.lx AND t.rx = m.rx AND t.ly = m.ly AND t.ry = m.ry AND y > y0 AND y < y0 + h "
        "AND ((x > x0 AND x < x0 + w AND NOT (x > x0 + w / 4 AND x < x0 + w / 2 AND y > y0 + h / 4 AND y < y0 + h / 2)) OR (more AND x > x0 + w * 1.25 AND x < x0 + w * 1.5 AND y < y0 + h / 2))), "
        "inked_area AS (SELECT code, lx, rx, ly, ry, sum((xb - xa) * (yb - ya)) AS area FROM inked GROUP BY ALL)"
    )


@query(
    "G01_centroid",
    f"WITH {SHAPES_SQL} SELECT id, round((x0 + w / 2 - (x0 + 3 * w / 8) / 16) / (CAST(15 AS DOUBLE) / 16), 6) AS x, "
    "round((y0 + h / 2 - (y0 + 3 * h / 8) / 16) / (CAST(15 AS DOUBLE) / 16), 6) AS y, round(x0 + w / 2, 6) AS px, round(y0 + h / 2, 6) AS py FROM shapes",
)
def _(spark, sf_dir):
    s = shapes(spark, sf_dir)
    center = geo.polygon_centroid(F.col("rings"))
    path = geo.path_centroid(F.slice("rings", 1, 1))
    out = s.select("id", center.alias("c"), path.alias("p"))
    return out.select(
        "id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"),
        F.round("p.x", 6).alias("px"), F.round("p.y", 6).alias("py"),
    )


@query("G02_envelope", f"WITH {SHAPES_SQL} SELECT id, x0 AS xmin, x0 + w AS xmax, y0 AS ymin, y0 + h AS ymax FROM shapes")
def _(spark, sf_dir):
    return shapes(spark, sf_dir).select("id", geo.envelope(F.col("rings")).alias("e")).select("id", "e.*")


@query("G08_polygon_area", f"WITH {SHAPES_SQL} SELECT id, round(w * h * 15 / 16, 6) AS area FROM shapes")
def _(spark, sf_dir):
    return shapes(spark, sf_dir).select("id", F.round(geo.polygon_area(F.col("rings")), 6).alias("area"))


def overlap_sql(x: str, y: str, w: str, h: str) -> str:
    return (
        f"greatest(0, least({x} + {w}, bx + 1) - greatest({x}, bx)) * greatest(0, least({y} + {h}, b_y + 1) - greatest({y}, b_y))"
    )


@query(
    "G09_clip_to_box",
    f"WITH {SHAPES_SQL}, b AS (SELECT *, floor(x0 + w * 0.4) AS bx, floor(y0 + h * 0.4) AS b_y FROM shapes) "
    f"SELECT id, round({overlap_sql('x0', 'y0', 'w', 'h')} - {overlap_sql('(x0 + w / 4)', '(y0 + h / 4)', '(w / 4)', '(h / 4)')}, 6) AS area FROM b",
)
def _(spark, sf_dir):
    s = shapes(spark, sf_dir)
    bx, by = F.floor(F.col("x0") + F.col("w") * 0.4), F.floor(F.col("y0") + F.col("h") * 0.4)
    clipped = geo.clip_to_box(F.col("rings"), bx, by, bx + 1, by + 1)
    return s.select("id", clipped.alias("c")).select("id", F.round(geo.polygon_area(F.col("c")), 6).alias("area"))


@query(
    "G10_buffer_point",
    f"{GOOD} SELECT pt_id, source_base, 33 AS corners, round(lon + degrees(10000 / 6378137.0) / cos(radians(lat)), 6) AS east, "
    "round(lat + degrees(10000 / 6378137.0), 6) AS north, round(lon - degrees(10000 / 6378137.0) / cos(radians(lat)), 6) AS west FROM good WHERE abs(lat) < 90",
)
def _(spark, sf_dir):
    near = points(spark, sf_dir).filter("abs(lat) < 90")
    disc = near.select("pt_id", "source_base", geo.buffer_point(F.col("lon"), F.col("lat"), 10000.0).alias("r"))
    e = disc.select("pt_id", "source_base", F.size(F.col("r")[0]).alias("corners"), geo.envelope(F.col("r")).alias("e"))
    return e.select(
        "pt_id", "source_base", "corners", F.round("e.xmax", 6).alias("east"),
        F.round("e.ymax", 6).alias("north"), F.round("e.xmin", 6).alias("west"),
    )


WKT_KINDS = "Point,Polygon,MultiPolygon,LineString,MultiPoint,GeometryCollection"
WKT_SQL = (
    f"wkts AS (SELECT o_orderkey AS id, upper(split_part('{WKT_KINDS}', ',', CAST(o_custkey % 6 + 1 AS INT))) || "
    "CASE WHEN o_orderkey % 4 = 0 THEN ' Z' ELSE '' END || ' (' || CAST(o_custkey AS VARCHAR) || ' 1)' AS wkt FROM orders)"
)


def wkts(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        f"concat(upper(split_part('{WKT_KINDS}', ',', CAST(o_custkey % 6 + 1 AS INT))), "
        "CASE WHEN o_orderkey % 4 = 0 THEN ' Z' ELSE '' END, ' (', CAST(o_custkey AS STRING), ' 1)') AS wkt",
    )


@query(
    "G05_geometry_type",
    f"WITH {WKT_SQL} SELECT o_orderkey AS id, split_part('{WKT_KINDS}', ',', CAST(o_custkey % 6 + 1 AS INT)) || "
    "CASE WHEN o_orderkey % 4 = 0 THEN ' 2.5D' ELSE '' END AS geometry_type FROM orders",
)
def _(spark, sf_dir):
    return wkts(spark, sf_dir).select("id", geo.geometry_type(F.col("wkt")).alias("geometry_type"))


@query("G06_polygon_filter", f"WITH {WKT_SQL} SELECT id, wkt FROM wkts WHERE wkt LIKE 'POLYGON%'")
def _(spark, sf_dir):
    return spatial.polygon_filter(wkts(spark, sf_dir))


@query(
    "J08_shared_borders",
    f"WITH {SHAPES_SQL}, bb AS (SELECT id, x0 AS xmin, y0 AS ymin, x0 + w / 4 AS xmax, y0 + h / 4 AS ymax FROM shapes) "
    "SELECT a.id AS left_id, b.id AS right_id FROM bb a JOIN bb b ON a.id < b.id AND a.xmin <= b.xmax AND b.xmin <= a.xmax "
    "AND a.ymin <= b.ymax AND b.ymin <= a.ymax",
)
def _(spark, sf_dir):
    s = shapes(spark, sf_dir)
    bb = s.select(
        "id", F.col("x0").alias("xmin"), F.col("y0").alias("ymin"),
        (F.col("x0") + F.col("w") / 4).alias("xmax"), (F.col("y0") + F.col("h") / 4).alias("ymax"),
    )
    return spatial.shared_borders(bb, cell=1.0)
