"""Check queries: boxes, coverage sums and coverage features."""

from pyspark.sql import functions as F

from streetgrain.catalog.base import query
from streetgrain.catalog.spatial import BLOTS_SQL, GOOD, SHAPES_SQL, blots, points, shapes, union_sql
from streetgrain.catalog.views import table
from streetgrain.functions import geo
from streetgrain.operators import coverage as cov
from streetgrain.operators import overlay

# Boxes are the one-degree cells that hold points; their codes and figures
# follow from place and count.
BOXES = (
    "boxes AS (SELECT floor(lon) AS lon, floor(lat) AS lat, CAST(1 AS DOUBLE) AS size, count(*) AS n, "
    "CAST((floor(lon) + 180) * 1000 + floor(lat) + 90 AS BIGINT) AS id FROM good GROUP BY floor(lon), floor(lat))"
)
CODE = "split_part('FR,DE,JP,US,BR', ',', CAST((floor(lon) + 180) AS INT) // 80 + 1)"
STATISTICS = (
    f"st AS (SELECT {CODE} AS code, id AS box_id, lon, lat, size, CAST(n * 10 AS DOUBLE) AS population, CAST(100 + id % 7 AS DOUBLE) AS area, "
    "CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(id % 100 AS DOUBLE) / 100 END AS fraction FROM boxes)"
)
BASE = f"{GOOD}, {BOXES}, {STATISTICS}"


def boxes(spark, sf_dir):
    corner = lambda c: F.floor(c).cast("double")
    cells = points(spark, sf_dir).groupBy(corner("lon").alias("lon"), corner("lat").alias("lat")).agg(F.count("*").alias("n"))
    return cells.withColumns(
        {"size": F.lit(1.0), "id": ((F.col("lon") + 180) * 1000 + F.col("lat") + 90).cast("bigint")}
    )


def statistics(spark, sf_dir):
    code = F.split_part(F.lit("FR,DE,JP,US,BR"), F.lit(","), (F.floor((F.col("lon") + 180) / 80) + 1).cast("int"))
    return boxes(spark, sf_dir).select(
        code.alias("code"), F.col("id").alias("box_id"), "lon", "lat", "size",
        (F.col("n") * 10).cast("double").alias("population"), (100 + F.col("id") % 7).cast("double").alias("area"),
        F.when(F.col("id") % 3 != 0, (F.col("id") % 100).cast("double") / 100).alias("fraction"),
    )


def areas_of_codes(spark, sf_dir):
    return statistics(spark, sf_dir).select("code").distinct().withColumn("name", F.concat(F.lit("Land "), "code"))


@query(
    "J05_box_dimension",
    f"{BASE} SELECT code, 'Land ' || code AS name, box_id, lon, lat, population, area FROM st",
)
def _(spark, sf_dir):
    st = statistics(spark, sf_dir).select("code", "box_id", "population", "area")
    rows = cov.box_dimension(areas_of_codes(spark, sf_dir), st, boxes(spark, sf_dir), "code")
    return rows.select("code", "name", "box_id", "lon", "lat", "population", "area")


@query(
    "J06_covered_vs_land",
    f"{BASE} SELECT code, box_id, area, CASE WHEN fraction > 0.5 THEN fraction * 2 END AS covered_area FROM st WHERE box_id % 10 > 0",
)
def _(spark, sf_dir):
    st = statistics(spark, sf_dir)
    land = st.select("code", "box_id", "area", (F.col("box_id") % 10).cast("double").alias("land_area"))
    covered = st.filter("fraction > 0.5").select("code", "box_id", (F.col("fraction") * 2).alias("covered_area"))
    return cov.covered_vs_land(land, covered, "code").select("code", "box_id", "area", "covered_area")


@query(
    "J09_assign_box_id",
    f"{BASE} SELECT s.lon, s.lat, s.population, b.id AS box_id FROM st s LEFT JOIN (SELECT * FROM boxes WHERE n > 1) b USING (lon, lat, size)",
)
def _(spark, sf_dir):
    st = statistics(spark, sf_dir).select("lon", "lat", "size", "population")
    some = boxes(spark, sf_dir).filter("n > 1")
    return cov.assign_box_id(st, some).select("lon", "lat", "population", "box_id")


@query(
    "A10_coverage_summary",
    f"{BASE} SELECT code, 'Land ' || code AS name, round(sum(area * fraction), 4) AS area_total, round(sum(population * fraction), 4) AS pop_total, "
    "round(sum(area * fraction) / sum(area), 6) AS area_pct, round(sum(population * fraction) / sum(population), 6) AS pop_pct FROM st GROUP BY 1, 2",
)
def _(spark, sf_dir):
    rows = statistics(spark, sf_dir).withColumn("name", F.concat(F.lit("Land "), "code"))
    summary = cov.coverage_summary(rows, "code")
    return summary.withColumns(
        {"area_total": F.round("area_total", 4), "pop_total": F.round("pop_total", 4),
         "area_pct": F.round("area_pct", 6), "pop_pct": F.round("pop_pct", 6)}
    )


@query(
    "A09_area_address_counts",
    f"{BASE} SELECT code, CAST(sum(n) AS BIGINT) AS addr_count FROM st JOIN boxes ON id = box_id GROUP BY 1",
)
def _(spark, sf_dir):
    rows = statistics(spark, sf_dir).select("code", (F.col("population") / 10).cast("bigint").alias("count"))
    return cov.area_address_counts(rows, "code")


BLOT_BOXES = (
    "SELECT DISTINCT code, lx, lx + 1 AS rx, ly, ly + 1 AS ry FROM (SELECT *, CAST(unnest(range(CAST(floor(y0) AS BIGINT), CAST(ceil(y0 + h) AS BIGINT))) AS DOUBLE) AS ly FROM "
    "(SELECT *, CAST(unnest(range(CAST(floor(x0) AS BIGINT), CAST(ceil(x0 + w * 1.5) AS BIGINT))) AS DOUBLE) AS lx FROM blots))"
)


@query(
    "A09_union_area",
    f"WITH {BLOTS_SQL}, {union_sql(BLOT_BOXES)} SELECT code, round(sum(area), 5) AS area FROM inked_area GROUP BY 1",
)
def _(spark, sf_dir):
    # The sums are exact to some 1e-12: first to nine places, so that a tie in the sixth is one.
    return overlay.union_area(blots(spark, sf_dir), "code").withColumn("area", F.round(F.round("area", 9), 5))


@query(
    "A10_shared_area",
    f"WITH {BLOTS_SQL}, {union_sql('SELECT DISTINCT code, floor(x0) AS lx, floor(x0) + 0.75 AS rx, floor(y0) AS ly, floor(y0) + 1 AS ry FROM blots WHERE id % 2 = 0')} "
    "SELECT code, lx AS lon, ly AS lat, CAST(0.75 AS DOUBLE) AS land_area, round(coalesce(area, 0), 11) AS covered_area FROM places LEFT JOIN inked_area USING (code, lx, rx, ly, ry)",
)
def _(spark, sf_dir):
    """The land is three quarters of each box in which some source area begins."""
    cover = blots(spark, sf_dir)
    west, south = F.floor("x0").cast("double"), F.floor("y0").cast("double")
    land = cover.where("id % 2 = 0").select("code", F.array(geo.box_ring(west, south, west + 0.75, south + 1)).alias("rings"))
    out = overlay.shared_area(land, cover, "code")
    return out.withColumns({c: F.round(c, 11) for c in ("land_area", "covered_area")})


CELL_SQL = (
    f"WITH {SHAPES_SQL.replace('shapes AS', 'raw_shapes AS')}, shapes AS (SELECT id, x0 + 0.013 AS x0, y0 + 0.017 AS y0, w, h FROM raw_shapes), g AS (SELECT id, x0, y0, w, h, unnest(range(CAST(floor(x0 * 10) AS BIGINT), CAST(floor((x0 + w) * 10) AS BIGINT) + 1)) AS cell_x FROM shapes), "
    "c AS (SELECT *, unnest(range(CAST(floor(y0 * 10) AS BIGINT), CAST(floor((y0 + h) * 10) AS BIGINT) + 1)) AS cell_y FROM g), "
    "m AS (SELECT *, (cell_x + CAST(0.5 AS DOUBLE)) / 10 AS x, (cell_y + CAST(0.5 AS DOUBLE)) / 10 AS y FROM c) "
    "SELECT id, count(*) AS cells, CAST(sum(cell_x) AS BIGINT) AS xs, CAST(sum(cell_y) AS BIGINT) AS ys FROM m WHERE x > x0 AND x < x0 + w AND y > y0 AND y < y0 + h "
    "AND NOT (x > x0 + w / 4 AND x < x0 + w / 2 AND y > y0 + h / 4 AND y < y0 + h / 2) GROUP BY 1"
)


@query("A11_cells_of_polygons", CELL_SQL)
def _(spark, sf_dir):
    # Shifted a little so that no cell centre lies on an edge.
    s = shapes(spark, sf_dir, 0.013, 0.017)
    cells = cov.cells_of_rings(s, ["id"])
    return cells.groupBy("id").agg(
        F.count("*").alias("cells"), F.sum("cell_x").alias("xs"), F.sum("cell_y").alias("ys")
    )


SOURCES = {
    "code": "concat('g', CAST(o_custkey % 300 AS STRING))",
    "path": "concat('p', CAST(o_orderkey AS STRING))",
    "good": "o_orderstatus = 'F' AND o_custkey % 7 <> 0",
    "address_count": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END",
    "date": "concat('d', CAST(o_orderkey % 28 AS STRING))",
}
SOURCES_SQL = "src AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in SOURCES.items()) + " FROM orders)"
GEOGRAPHIES_SQL = "geos AS (SELECT DISTINCT concat('g', CAST(c_custkey % 250 AS STRING)) AS code, concat('Name ', CAST(c_custkey % 250 AS STRING)) AS name FROM customer)"
ATTACHED = (
    f"WITH {SOURCES_SQL}, {GEOGRAPHIES_SQL}, best AS (SELECT code, bool_or(good) AS good FROM src GROUP BY 1), "
    "att AS (SELECT geos.code, name, path, src.good, address_count, date, CASE WHEN src.good THEN 'good' ELSE 'bad' END AS status "
    "FROM geos JOIN src USING (code) JOIN best ON best.code = src.code AND best.good = src.good)"
)


def geographies(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('g', CAST(c_custkey % 250 AS STRING)) AS code", "concat('Name ', CAST(c_custkey % 250 AS STRING)) AS name"
    ).distinct()


def sources(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in SOURCES.items()])


@query("J07_attach_coverage_status", f"{ATTACHED} SELECT code, name, path, good, address_count, date, status FROM att")
def _(spark, sf_dir):
    rows = cov.attach_coverage_status(geographies(spark, sf_dir), sources(spark, sf_dir))
    return rows.select("code", "name", "path", "good", "address_count", "date", "status")


FEATURES = (
    f"{ATTACHED}, feat AS (SELECT code, name, status, count(*) AS source_count, "
    "CAST(sum(CASE WHEN good THEN coalesce(address_count, 0) ELSE 0 END) AS BIGINT) AS address_count FROM att GROUP BY 1, 2, 3)"
)


@query("A16_coverage_features", FEATURES + " SELECT * FROM feat")
def _(spark, sf_dir):
    return cov.coverage_features(cov.attach_coverage_status(geographies(spark, sf_dir), sources(spark, sf_dir)))


@query("A16_coverage_paths", f"{ATTACHED} SELECT code, path, CASE WHEN good THEN date END AS date FROM att")
def _(spark, sf_dir):
    return cov.coverage_paths(cov.attach_coverage_status(geographies(spark, sf_dir), sources(spark, sf_dir)))
