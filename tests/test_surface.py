"""The fitted surface against the same algorithm in NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinedeck.operators import surface


def weights(t):
    return np.array([(1 - t) ** 3, 3 * t**3 - 6 * t**2 + 4, -3 * t**3 + 3 * t**2 + 3 * t + 1, t**3]) / 6


def numpy_surface(x, y, z, nx, ny, cells, levels):
    """Sum of levels, each fitted to what the levels before leave."""
    spread = lambda c: np.ptp(c) or 1.0
    u, v, left = (x - x.min()) / spread(x), (y - y.min()) / spread(y), z.astype(float).copy()
    gu, gv = np.meshgrid(np.arange(nx) / (nx - 1), np.arange(ny) / (ny - 1), indexing="ij")
    out = np.zeros((nx, ny))

    def around(p, q, n, m):
        i, j = min(int(p * n), n - 1), min(int(q * m), m - 1)
        return i, j, np.outer(weights(p * n - i), weights(q * m - j))

    for level in range(levels):
        n, m = cells[0] << level, cells[1] << level
        up, down = np.zeros((n + 3, m + 3)), np.zeros((n + 3, m + 3))
        for p, q, r in zip(u, v, left):
            i, j, w = around(p, q, n, m)
            up[i : i + 4, j : j + 4] += w**3 * r / (w**2).sum()
            down[i : i + 4, j : j + 4] += w**2
        phi = np.divide(up, down, out=np.zeros_like(up), where=down > 0)
        read = lambda p, q: (lambda i, j, w: (w * phi[i : i + 4, j : j + 4]).sum())(*around(p, q, n, m))  # noqa: B023, E731
        left = left - np.array([read(p, q) for p, q in zip(u, v)])
        out += np.array([[read(p, q) for p, q in zip(a, b)] for a, b in zip(gu, gv)])
    return out


def found(df, **how):
    rows = surface.fitted_surface(df, x="x", y="y", value="z", **how).toPandas()
    return rows


@pytest.mark.parametrize(("cells", "levels"), [((1, 1), 1), ((1, 5), 5), ((2, 3), 4)])
def test_surface_of_each_site_equals_numpy(spark, cells, levels):
    rng = np.random.default_rng(4)
    sites = {}
    for site, n in (("a", 300), ("b", 40), (None, 7)):
        x, y = rng.uniform(2000, 2020, n), rng.uniform(0, 100, n)
        sites[site] = x, y, np.sin(x) * 5 + y / 10 + rng.normal(size=n)
    rows = [(s, float(a), float(b), float(c)) for s, p in sites.items() for a, b, c in zip(*p)]
    df = spark.createDataFrame(rows + [("a", None, 1.0, 1.0), ("a", 2001.0, 2.0, None), ("gone", None, None, None)], "site string, x double, y double, z double")
    out = found(df, by=["site"], nx=9, ny=12, cells=cells, levels=levels)
    assert len(out) == 3 * 9 * 12
    for site, (x, y, z) in sites.items():
        mine = out[out.site.isna() if site is None else out.site == site].sort_values(["x_idx", "y_idx"])
        np.testing.assert_allclose(mine.z.to_numpy().reshape(9, 12), numpy_surface(x, y, z, 9, 12, cells, levels), atol=1e-8)
        np.testing.assert_allclose(mine.x.to_numpy().reshape(9, 12)[:, 0], np.linspace(x.min(), x.max(), 9))
        np.testing.assert_allclose(mine.y.to_numpy().reshape(9, 12)[0], np.linspace(y.min(), y.max(), 12))


def test_more_levels_come_closer_to_the_points(spark):
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 9, 200) / 8, rng.integers(0, 9, 200) / 8
    df = spark.createDataFrame([(float(a), float(b), float(np.cos(5 * a) * b)) for a, b in zip(x, y)], "x double, y double, z double")
    misses = []
    for levels in (1, 3, 6):
        out = found(df, nx=9, ny=9, cells=(1, 1), levels=levels)
        at = {(round(r.x * 8), round(r.y * 8)): r.z for r in out.itertuples()}
        misses.append(max(abs(at[round(a * 8), round(b * 8)] - np.cos(5 * a) * b) for a, b in zip(x, y)))
    assert misses[0] > misses[1] > misses[2] and misses[2] < 1e-3


def test_one_place_and_no_points(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 2.0, 7.0)], "x double, y double, z double")
    out = found(df, nx=3, ny=2, cells=(1, 1), levels=4)
    assert len(out) == 6 and set(out.x) == {1.0} and abs(out.z[(out.x_idx == 0) & (out.y_idx == 0)].iloc[0] - 6.0) < 1e-6
    assert len(found(df.limit(0), nx=3, ny=2, levels=2)) == 0


def test_refined_lattice_is_the_same_surface(spark):
    rng = np.random.default_rng(8)
    nodes = spark.createDataFrame([(a, b, float(rng.normal())) for a in range(5) for b in range(6)], "a int, b int, phi double")
    points = spark.createDataFrame([(float(u), float(v)) for u, v in rng.uniform(size=(50, 2))] + [(1.0, 1.0), (0.0, 0.0)], "u double, v double")
    coarse = {(r["u"], r["v"]): r["f"] for r in surface._value(points, nodes, [], 2, 3).collect()}
    fine = {(r["u"], r["v"]): r["f"] for r in surface._value(points, surface.refine(nodes, [], 2, 3), [], 4, 6).collect()}
    assert coarse.keys() == fine.keys() and all(abs(coarse[k] - fine[k]) < 1e-12 for k in coarse)


def test_no_nested_loop(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 5.0)], "site string, x double, y double, z double").withColumn("z", F.col("z") + F.rand(1) * 0)
    plan = surface.fitted_surface(df, x="x", y="y", value="z", by=["site"], nx=3, ny=3, levels=2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_nodes_stay_with_their_group(spark):
    """Adding a level sends sums of cells and lattices once: no exchange of nodes."""
    points = spark.createDataFrame([("a", 0.1, 0.2, 5.0), (None, 0.5, 0.9, 1.0)], "site string, u double, v double, z double")
    lattices = points.groupBy("site").agg(F.array(*[F.sum("z")] * 20).alias("phi"))
    added = surface._added(lattices, surface.fit_cells(points, ["site"], 1, 2), ["site"], 2)
    plan = added._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 3
    assert {r["site"]: len(r["phi"]) for r in added.collect()} == {"a": 20, None: 20}
