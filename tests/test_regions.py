"""Tagging points by the tile covering, against an exact even-odd rule in fractions."""

import random
from fractions import Fraction

import pytest

from brinedeck.operators import geo


def exact_membership(rings, x, y):
    """Inside by the even-odd rule, or on an edge, with the coordinates as they are written."""
    x, y = Fraction(str(x)), Fraction(str(y))
    odd = False
    for ring in rings:
        at = [(Fraction(str(a)), Fraction(str(b))) for a, b in ring]
        for (x1, y1), (x2, y2) in zip(at, at[1:] + at[:1], strict=True):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def expected(shapes, points):
    return {k: min((name for name, rings in shapes.items() if exact_membership(rings, x, y)), default=None) for k, x, y in points}


def tagged(spark, shapes, points, **options):
    vertices = [(name, ring, k, float(x), float(y)) for name, rings in shapes.items() for ring, at in enumerate(rings) for k, (x, y) in enumerate(at)]
    edges = geo.polygon_edges(spark.createDataFrame(vertices, "region string, ring int, seq int, x double, y double"), ["region"])
    table = spark.createDataFrame([(k, float(x), float(y)) for k, x, y in points], "id int, x double, y double")
    return {r["id"]: r["region"] for r in geo.region_join(table, edges, x="x", y="y", region=["region"], **options).collect()}


def lattice_shapes(seed, step):
    """Rings with corners on a lattice that tile borders share, crossing themselves and each other, with holes."""
    rng = random.Random(seed)
    place = lambda: round(rng.randint(-20, 20) * step, 6)
    return {f"r{k}": [[(place(), place()) for _ in range(rng.randint(3, 9))] for _ in range(rng.randint(1, 3))] for k in range(4)}


@pytest.mark.parametrize(("seed", "step", "options"), [
    (1, 0.25, {"tile": 1.0, "leaf": 2, "depth": 3}),
    (2, 0.1, {"tile": 0.5, "leaf": 1, "depth": 2}),
    (3, 0.3, {"tile": 4.0, "leaf": 2, "depth": 5}),
    (4, 0.5, {"tile": 64.0}),
])
def test_same_as_exact_rule(spark, seed, step, options):
    shapes = lattice_shapes(seed, step)
    rng = random.Random(seed + 100)
    points = [(k, round(rng.randint(-44, 44) * step / 2, 6), round(rng.randint(-44, 44) * step / 2, 6)) for k in range(1500)]
    corners = [at for rings in shapes.values() for ring in rings for at in ring]
    points += [(2000 + k, x, y) for k, (x, y) in enumerate(corners)]
    assert tagged(spark, shapes, points, **options) == expected(shapes, points)


def test_a_thousand_edges_are_cut_into_small_cells(spark):
    rng = random.Random(9)
    coast = [(round(k * 0.01, 6), round(rng.random(), 6)) for k in range(1000)] + [(10.0, -3.0), (0.0, -3.0)]
    points = [(k, round(rng.uniform(-1, 11), 6), round(rng.uniform(-4, 2), 6)) for k in range(1000)]
    vertices = spark.createDataFrame([("coast", 0, k, x, y) for k, (x, y) in enumerate(coast)], "region string, ring int, seq int, x double, y double")
    tiles, cells = geo.region_tiles(geo.polygon_edges(vertices, ["region"]), ["region"], tile=16.0, leaf=1)
    assert tiles.selectExpr("max(_k)").first()[0] == 5
    sizes = [r[0] for r in cells.selectExpr("size(_cell)").collect()]
    assert max(sizes) < 60 and 20 < len(sizes) <= 1024
    assert tagged(spark, {"coast": [coast]}, points, tile=16.0, leaf=1) == expected({"coast": [coast]}, points)


def test_whole_tiles_inside_hold_no_edges(spark):
    box = spark.createDataFrame([("box", 0, k, x, y) for k, (x, y) in enumerate([(0.5, 0.5), (9.5, 0.5), (9.5, 9.5), (0.5, 9.5)])], "region string, ring int, seq int, x double, y double")
    tiles, _ = geo.region_tiles(geo.polygon_edges(box, ["region"]), ["region"])
    assert tiles.filter("size(_inside) = 1").count() == 64
    assert tiles.filter("size(_inside) = 0").count() == 36


def test_empty_tables_nulls_and_tile_size(spark):
    shapes = {"box": [[(0, 0), (1, 0), (1, 1), (0, 1)]]}
    no_edges = geo.polygon_edges(spark.createDataFrame([], "region string, ring int, seq int, x double, y double"), ["region"])
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, float("nan"), 0.5), (3, None, None)], "id int, x double, y double")
    assert [r["region"] for r in geo.region_join(points, no_edges, x="x", y="y", region=["region"]).collect()] == [None] * 3
    assert tagged(spark, shapes, [(1, 0.5, 0.5), (2, float("nan"), 0.5), (3, 1.0, 0.3)]) == {1: "box", 2: None, 3: "box"}
    with pytest.raises(ValueError, match="power of two"):
        geo.region_join(points, no_edges, x="x", y="y", region=["region"], tile=0.3)
