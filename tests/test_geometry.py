import math
import random

import pytest
from pyspark.sql import functions as F

from streetgrain.functions import geo
from streetgrain.functions.projection import projection_for, reproject
from streetgrain.operators import coverage, spatial


@pytest.mark.parametrize(
    "srs, x, y, lon, lat",
    [
        ("EPSG:2913", 7655634.924, 668868.414, -122.6308421866508, 45.481554393851063),
        ("EPSG:3740", 565210.3, 4184173.2, -122.2592497, 37.8026126),
        ("3857", 111319.49079327358, 0.0, 1.0, 0.0),
        ("EPSG:4326", 12.5, 41.9, 12.5, 41.9),
        ("EPSG:32633", 500000.0, 0.0, 15.0, 0.0),
        ("EPSG:32733", 500000.0, 10000000.0, 15.0, 0.0),
    ],
)
def test_reproject(spark, srs, x, y, lon, lat):
    df = spark.createDataFrame([(x, y)], "x double, y double")
    got = df.select(*reproject(F.col("x"), F.col("y"), srs)).first()
    assert got[0] == pytest.approx(lon, abs=1e-6) and got[1] == pytest.approx(lat, abs=1e-6)


def test_unknown_srs():
    for bad in ("EPSG:99999", "proj=longlat"):
        with pytest.raises(ValueError):
            projection_for(bad)


def star(seed):
    r = random.Random(seed)
    n = r.randint(3, 12)
    angles = sorted(r.uniform(0, 2 * math.pi) for _ in range(n))
    cx, cy = r.uniform(-3, 3), r.uniform(-3, 3)
    ring = [(cx + d * math.cos(a), cy + d * math.sin(a)) for a in angles for d in [r.uniform(0.3, 3)]]
    return [*ring, ring[0]]


def area_and_center(ring):
    a = x = y = 0.0
    for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
        c = x0 * y1 - x1 * y0
        a, x, y = a + c, x + (x0 + x1) * c, y + (y0 + y1) * c
    return abs(a / 2), x / (3 * a), y / (3 * a)


def test_area_and_centroid_of_stars(spark):
    rings = [star(i) for i in range(40)]
    df = spark.createDataFrame([(i, [r]) for i, r in enumerate(rings)], f"i int, rings {geo.RINGS_TYPE}")
    rows = df.select("i", geo.polygon_area(F.col("rings")).alias("a"), geo.polygon_centroid(F.col("rings")).alias("c")).collect()
    for r in rows:
        a, x, y = area_and_center(rings[r.i])
        assert (r.a, r.c.x, r.c.y) == (pytest.approx(a), pytest.approx(x), pytest.approx(y))


def clip_area(ring, box):
    """Area by plain clipping, one half-plane at a time."""
    for axis, limit, above in ((0, box[0], 1), (0, box[2], 0), (1, box[1], 1), (1, box[3], 0)):
        inside = lambda p: p[axis] >= limit if above else p[axis] <= limit
        out = []
        for p, q in zip(ring, ring[1:]):
            if inside(p):
                out.append(p)
            if inside(p) != inside(q):
                t = (limit - p[axis]) / (q[axis] - p[axis])
                out.append(tuple(limit if k == axis else p[k] + (q[k] - p[k]) * t for k in (0, 1)))
        if not out:
            return 0.0
        ring = [*out, out[0]]
    return area_and_center(ring)[0] if len(ring) > 3 else 0.0


def test_clip_stars(spark):
    rings = [star(i) for i in range(40)]
    df = spark.createDataFrame([(i, [r]) for i, r in enumerate(rings)], f"i int, rings {geo.RINGS_TYPE}")
    box = (-1.0, -1.5, 1.0, 0.5)
    clipped = geo.clip_to_box(F.col("rings"), *[F.lit(v) for v in box])
    for r in df.select("i", geo.polygon_area(clipped).alias("a")).collect():
        assert r.a == pytest.approx(clip_area(rings[r.i], box), abs=1e-9)


def test_centroid_fallbacks(spark):
    flat = [[(0.0, 0.0), (2.0, 0.0), (0.0, 0.0)]]
    df = spark.createDataFrame([(flat,)], f"rings {geo.RINGS_TYPE}")
    c = df.select(geo.polygon_centroid(F.col("rings"))).first()[0]
    assert (c.x, c.y) == (1.0, 0.0)
    square = lambda x, y, s, turn: [(x, y), (x, y + s), (x + s, y + s), (x + s, y), (x, y)][::turn]
    # Two outer rings turning one way, a hole the other way.
    shape = [square(0.0, 0.0, 2.0, 1), square(0.5, 0.5, 1.0, -1), square(10.0, 0.0, 1.0, 1)]
    df = spark.createDataFrame([(shape,)], f"rings {geo.RINGS_TYPE}")
    c = df.select(geo.polygon_centroid(F.col("rings"), by_orientation=True)).first()[0]
    assert c.x == pytest.approx((4 * 1 - 1 * 1 + 10.5) / 4) and c.y == pytest.approx((4 * 1 - 1 * 1 + 0.5) / 4)


def test_cells_of_copies_and_holes(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    hole = [(0.2, 0.2), (0.4, 0.2), (0.4, 0.4), (0.2, 0.4), (0.2, 0.2)]
    rows = [("a", [ring, hole])] * 5 + [("b", [ring])]
    df = spark.createDataFrame(rows, f"k string, rings {geo.RINGS_TYPE}")
    counts = {r.k: r["count"] for r in coverage.cells_of_rings(df, ["k"]).groupBy("k").count().collect()}
    assert counts == {"a": 96, "b": 100}


def test_cells_of_stars(spark):
    rings = [star(i) for i in range(20)]
    df = spark.createDataFrame([(i, [r]) for i, r in enumerate(rings)], f"i int, rings {geo.RINGS_TYPE}")
    got = {(r.i, r.cell_x, r.cell_y) for r in coverage.cells_of_rings(df, ["i"]).collect()}

    def inside(ring, x, y):
        hit = False
        for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
            if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                hit = not hit
        return hit

    wanted = {
        (i, cx, cy) for i, ring in enumerate(rings) for cx in range(-70, 70) for cy in range(-70, 70)
        if inside(ring, (cx + 0.5) / 10, (cy + 0.5) / 10)
    }
    assert got == wanted


def test_wkt(spark):
    texts = {
        "POINT (1 2)": "Point", "POINT (1 2 3)": "Point 2.5D", "POLYGON ((0 0, 1 0, 1 1, 0 0))": "Polygon",
        "MULTIPOLYGON (((0 0)))": "MultiPolygon", "LINESTRING Z (1 2 3)": "LineString 2.5D", "nonsense": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(geo.geometry_type(F.col("t"))).collect()] == list(texts.values())
    text = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    one = spark.createDataFrame([(text,)], "t string").select(geo.rings_from_text(F.col("t")).alias("r"))
    assert one.select(geo.polygon_area(F.col("r"))).first()[0] == 15.0
    back = one.select(geo.rings_to_text(F.col("r"))).first()[0]
    assert back.startswith("POLYGON ((0.0 0.0, 4.0 0.0")


def test_point_statistics_and_bounds(spark):
    line = spark.range(-1000, 1001).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    s = spatial.point_stats(line, []).first()
    assert (s.xmean, s.ymean) == (0, 0) and s.xsdev == pytest.approx(577.783263863) and s.ysdev == pytest.approx(577.783263863)
    points = [(-1.0, -1.0), (1.0, 1.0)] * 150 + [(-100.0, 0.0), (0.0, 100.0)]
    df = spark.createDataFrame(points, "x double, y double")
    b = spatial.robust_bounds(df, []).first()
    assert (b.xmin, b.ymin, b.xmax, b.ymax) == pytest.approx((-1.04, -1.04, 1.04, 1.04))
    assert spatial.point_stats(df.limit(1), []).count() == 0


def test_shared_borders_brute_force(spark):
    r = random.Random(5)
    boxes = [(i, x, y, x + r.uniform(0, 3), y + r.uniform(0, 3)) for i in range(120) for x, y in [(r.uniform(-9, 9), r.uniform(-9, 9))]]
    df = spark.createDataFrame(boxes, "id int, xmin double, ymin double, xmax double, ymax double")
    got = sorted((p.left_id, p.right_id) for p in spatial.shared_borders(df).collect())
    wanted = sorted(
        (a[0], b[0]) for a in boxes for b in boxes
        if a[0] < b[0] and a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]
    )
    assert got == wanted


def test_grid_and_pyramid(spark):
    df = spark.createDataFrame([(37.85, -122.27), (37.81, -122.25), (-0.01, 0.01)], "lat double, lon double")
    rows = [tuple(r) for r in spatial.grid_summary(df, []).collect()]
    assert rows == [
        (1, "0.0", "-0.1", "POLYGON((0.0 -0.1,0.0 0.0,0.1 0.0,0.1 -0.1,0.0 -0.1))"),
        (2, "-122.3", "37.8", "POLYGON((-122.3 37.8,-122.3 37.9,-122.2 37.9,-122.2 37.8,-122.3 37.8))"),
    ]
    with pytest.raises(ValueError):
        spatial.grid_summary(df, [], 0.3)
    pyramid = spatial.tile_pyramid(df)
    assert pyramid.filter("zoom = 0").first()["points"] == 3
    assert {r.zoom: r.n for r in pyramid.groupBy("zoom").agg(F.sum("points").alias("n")).collect()} == {z: 3 for z in range(16)}


def test_cell_masks_are_the_only_rows_shuffled(spark):
    box = "array(array({}))".format(", ".join(f"struct(double({x}) AS x, double({y}) AS y)" for x, y in [(0.2, 0.2), (2.6, 0.2), (2.6, 1.4), (0.2, 1.4), (0.2, 0.2)]))
    hole = box.replace("double(0.2)", "double(0.5)").replace("double(2.6)", "double(1.5)").replace("double(1.4)", "double(0.9)")
    rows = spark.range(1).selectExpr("'a' AS k", f"concat({box}, {hole}) AS rings").unionByName(spark.range(1).selectExpr("'a' AS k", f"{hole} AS rings"))
    rows = rows.unionByName(spark.range(1).selectExpr("'b' AS k", f"concat({box}, array(CAST(NULL AS array<struct<x:double,y:double>>))) AS rings"))
    masks = coverage.cell_masks_of_rings(rows, ["k"])
    assert masks._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {r.k: r["count"] for r in coverage.cells_of_rings(rows, ["k"]).groupBy("k").count().collect()}
    assert got == {"a": 24 * 12}  # the second shape fills the hole of the first; a shape with an unknown ring has no cells


def test_tile_pyramid_by_bases(spark):
    pick = random.Random(5)
    places = [(pick.uniform(-180, 180), pick.uniform(-85, 85)) for _ in range(300)] * 2
    df = spark.createDataFrame(places, "lon double, lat double")
    out = spatial.tile_pyramid(df, zmin=1, zmax=12)
    # Each base gives the levels up to the next one, so that no task holds the tiles of all of them.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 4
    finest = {(r.col, r.row): r.points for r in out.where("zoom = 12").collect()}
    want = {}
    for zoom in range(1, 13):
        for (c, r), n in finest.items():
            at = (zoom, c >> (12 - zoom), r >> (12 - zoom))
            want[at] = want.get(at, 0) + n
    assert {(r.zoom, r.col, r.row): r.points for r in out.collect()} == want
    assert sum(finest.values()) == len(places)
