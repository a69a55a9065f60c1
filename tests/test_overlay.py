"""Exact areas of unions and overlaps, against grids and points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetgrain.operators import overlay
from streetgrain.plans import products

ROWS = "code string, rings array<array<struct<x:double,y:double>>>"


def ring(*points):
    points = [tuple(map(float, p)) for p in points]
    return [*points, points[0]]


def box(x, y, w, h):
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def grid_area(shapes, inside=None):
    """Area covered by rectangles with holes, by the grid of all corners; ``inside`` clips it."""
    xs, ys = (np.unique([p[i] for rings in [*shapes, *([inside] if inside else [])] for r in rings for p in r]) for i in (0, 1))
    x, y = np.meshgrid((xs[1:] + xs[:-1]) / 2, (ys[1:] + ys[:-1]) / 2)

    def odd(rings):
        return sum(((min(p[0] for p in r) < x) & (x < max(p[0] for p in r)) & (min(p[1] for p in r) < y) & (y < max(p[1] for p in r))).astype(int) for r in rings) % 2 == 1

    hit = np.any([odd(r) for r in shapes], axis=0) & (odd(inside) if inside else True)
    return float((hit * np.outer(np.diff(ys), np.diff(xs))).sum())


@pytest.fixture
def rectangles():
    rng = np.random.default_rng(3)
    out = {}
    for code in ("a", "b"):
        shapes = []
        for k in range(60):
            x, y, w, h = rng.uniform(-3, 3), rng.uniform(-2, 2), *rng.uniform(0.001, 1.5, 2)
            shapes.append([box(x, y, w, h), box(x + w / 4, y + h / 4, w / 3, h / 3)][: 1 + k % 2])
        out[code] = shapes
    return out


@pytest.mark.parametrize("most, step", [(256, 2), (12, 1)])
def test_union_of_rectangles(spark, rectangles, monkeypatch, most, step):
    monkeypatch.setattr(overlay, "MOST_EDGES", most)
    monkeypatch.setattr(overlay, "STEP", step)
    monkeypatch.setattr(overlay, "DEEPEST", 3)
    rows = [(c, s) for c, shapes in rectangles.items() for s in [*shapes, shapes[0], shapes[0]]]
    rows += [("a", None), ("a", []), ("b", [[]]), ("b", [None]), (None, [box(0.0, 0.0, 1.0, 1.0)]), ("b", [[(0.5, float("nan")), (1.0, 1.0), (2.0, 0.0), (0.5, 0.5)]]), ("a", [ring((0.0, 0.0), (0.0, 9.0), (0.0, 3.0))])]
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit(1) for c in ("ix", "level", "side", "area", "e")})
    got = {r.code: r.area for r in overlay.union_area(df, "code").collect()}
    assert got == {c: pytest.approx(grid_area(s), rel=1e-12) for c, s in rectangles.items()}


def test_parts_of_a_union_do_not_overlap(spark, rectangles):
    df = spark.createDataFrame([("a", s) for s in rectangles["a"][:20]], ROWS)
    parts = overlay.union_parts(df, "code")
    rings = [[[(p.x, p.y) for p in r] for r in row.rings] for row in parts.collect()]
    assert all(r[0][0] == r[0][-1] for r in rings)
    sizes = sum(abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r[0], r[0][1:], strict=False))) / 2 for r in rings)
    assert sizes == pytest.approx(grid_area(rectangles["a"][:20]), rel=1e-12)
    assert overlay.union_area(parts, "code").first().area == pytest.approx(sizes, rel=1e-12)


def test_share_of_land(spark, rectangles):
    land = [("a", [box(-1.5, -1.25, 3.0, 2.0)]), ("a", [box(0.0, 0.0, 2.5, 0.5)]), ("b", [box(5.0, 5.0, 1.5, 1.0)]), (None, [box(0.0, 0.0, 1.0, 1.0)])]
    cover = [(c, s) for c, shapes in rectangles.items() for s in shapes] + [(None, [box(0.0, 0.0, 1.0, 1.0)]), ("c", [box(0.0, 0.0, 1.0, 1.0)])]
    out = overlay.shared_area(spark.createDataFrame(land, ROWS), spark.createDataFrame(cover, ROWS), "code").collect()
    got = {(r.code, r.lon, r.lat): (r.land_area, r.covered_area) for r in out}
    ground = [s for c, s in land if c == "a"]
    for x in range(-3, 4):
        for y in range(-3, 4):
            size = grid_area(ground, [box(float(x), float(y), 1.0, 1.0)])
            assert ("a", x, y) in got if size else ("a", x, y) not in got
    assert sum(v[0] for k, v in got.items() if k[0] == "a") == pytest.approx(grid_area(ground), rel=1e-12)
    wanted = grid_area(rectangles["a"], ground[0]) + grid_area(rectangles["a"], ground[1]) - grid_area(rectangles["a"], [box(0.0, 0.0, 1.5, 0.5)])
    assert sum(v[1] for k, v in got.items() if k[0] == "a") == pytest.approx(wanted, rel=1e-12)
    assert {k: v for k, v in got.items() if k[0] == "b"} == {("b", 5.0, 5.0): (1.0, 0.0), ("b", 6.0, 5.0): (0.5, 0.0)}
    assert not [k for k in got if k[0] not in ("a", "b")]


@pytest.mark.parametrize("seed", range(6))
def test_sweep_of_any_polygons(seed, monkeypatch):
    monkeypatch.setattr(overlay, "SLAB_ROWS", 60)
    rng = np.random.default_rng(seed)
    polygons = []
    for _ in range(6):
        points = rng.random((rng.integers(3, 9), 2))
        polygons.append(np.round(points * 4) / 4 if seed % 2 else points)
    sides = np.arange(6) % 2
    edges, owner = [], []
    for i, p in enumerate(polygons):
        for a, b in zip(p, np.roll(p, -1, 0), strict=True):
            if a[0] != b[0]:
                edges.append([*min(tuple(a), tuple(b)), *max(tuple(a), tuple(b))])
                owner.append(i)
    x, y = rng.random((2, 100_000))
    inside = []
    for p in polygons:
        above = np.zeros(len(x), int)
        for (a, b), (c, d) in zip(p, np.roll(p, -1, 0), strict=True):
            if a != c:
                above += ((a <= x) != (c <= x)) & (b + (d - b) * (x - a) / (c - a) < y)
        inside.append(above % 2 == 1)
    land, cover = (np.any([h for h, s in zip(inside, sides, strict=True) if s == k], axis=0) for k in (0, 1))
    got = np.zeros(3)
    owner = np.array(owner)
    for s in overlay.sweep(np.array(edges).T, owner, sides[owner]):
        size = overlay._sizes(s)
        got += [size[s.land].sum(), size[s.cover].sum(), size[s.land & s.cover].sum()]
    assert np.abs(got - [land.mean(), cover.mean(), (land & cover).mean()]).max() < 0.006


def test_many_overlapping_stars_in_one_box(spark):
    """Edges of one box beyond a cell's share, all crossing one another."""
    rng = np.random.default_rng(9)
    stars = []
    for _ in range(60):
        turn = rng.uniform(0, 6.28)
        angle = turn + np.arange(10) * np.pi / 5
        size = np.where(np.arange(10) % 2, 0.15, 0.4)
        stars.append([ring(*zip((0.5 + size * np.cos(angle)).tolist(), (0.5 + size * np.sin(angle)).tolist(), strict=True))])
    df = spark.createDataFrame([("s", s) for s in stars], ROWS)
    one = spark.createDataFrame([("s", stars[0])], ROWS)
    exact = 0.5 * 10 * 0.15 * 0.4 * np.sin(np.pi / 5)
    assert overlay.union_area(one, "code").first().area == pytest.approx(exact, rel=1e-12)
    assert exact < overlay.union_area(df, "code").first().area < np.pi * 0.16


def test_coverage_of_a_tiny_island_and_a_state(spark):
    """An island of a few hundred metres across four boxes, and a box within a state."""
    # Statistics of the boxes, addresses, and the figures they must give.
    figures = [("XX", 1, 2000.0, 800.0), ("XX", 2, 4000.0, 600.0), ("XX", 3, 6000.0, 400.0), ("XX", 4, 8000.0, 200.0), ("US", 5, 17907.0, 9540.0)]
    counts = {"XX": 9990, "US": 9}
    wanted = {"XX": (9990, 2000.0, 1.0, 20000.0, 1.0), "US": (9, 9540.0, 1.0, 17907.0, 1.0)}
    island = ring((-0.0005, 0.0), (-0.0002, -0.0004), (0.0003, -0.0001), (0.0004, 0.0002), (0.0, 0.0005))
    state = box(-104.0, 36.0, 9.0, 5.0)
    spread = [ring(*((x * 1.5, y * 1.5) for x, y in island[:-1]))]
    features = [("XX", counts["XX"], spread), ("US", counts["US"], [state]), ("ZZ", 4, [island])]
    land = [("XX", "Isle", [island]), ("US", "State", [state])]
    boxes = [(1, 0.0, 0.0), (2, 0.0, -1.0), (3, -1.0, -1.0), (4, -1.0, 0.0), (5, -99.0, 38.0)]
    rings = ROWS.split(", ", 1)[1]
    out = products.calculate_coverage(
        spark.createDataFrame(features, f"code string, count long, {rings}"), spark.createDataFrame(land, f"code string, name string, {rings}"),
        spark.createDataFrame(figures, "code string, box_id long, population double, area double"),
        spark.createDataFrame(boxes, "id long, lon double, lat double").withColumn("size", F.lit(1.0)), "code",
    )
    got = {r.code: (r.addr_count, r.area_total, r.area_pct, r.pop_total, r.pop_pct) for r in out.collect()}
    assert got.pop("ZZ") == (4, None, None, None, None)
    assert got == {k: pytest.approx(v, rel=1e-12) for k, v in wanted.items()}


@pytest.mark.parametrize("seed", range(6))
def test_crossings_try_few_pairs(seed, monkeypatch):
    """As by all pairs; of edges that are short or flat, few pairs are tried."""
    rng = np.random.default_rng(seed)
    n = 400
    x, y = rng.integers(0, 40, (2, n)) / 4
    dx, dy = rng.integers(1, 8, n) / 4, rng.integers(-8, 9, n) / 4 * (rng.random(n) < [0.0, 0.05, 0.5, 1.0, 1.0, 1.0][seed])
    e = np.stack([x, y, x + dx, y + dy])
    want = []
    for i in range(n):
        for j in range(i):
            low, high = max(e[0, i], e[0, j]), min(e[2, i], e[2, j])
            if low < high:
                a, b = (overlay._at(e[:, i], v) - overlay._at(e[:, j], v) for v in (low, high))
                if a * b < 0:
                    want.append(low + (high - low) * (a / (a - b)))
    repeat = overlay._repeat
    pairs = []
    monkeypatch.setattr(overlay, "_repeat", lambda c: (pairs.append(int(np.sum(c))), repeat(c))[1])
    monkeypatch.setattr(overlay, "SLAB_ROWS", 1 << (20 if seed % 2 else 8))
    np.testing.assert_allclose(np.sort(overlay.crossings(e)), np.sort(want), rtol=1e-12)
    assert 0 < sum(pairs) < n * (n - 1) / 2 / 4 or seed == 0 and not want
