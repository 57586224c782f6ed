"""Matching, profiles, regions, grids and summaries on small fixtures against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brinedeck.functions.axes import RegularAxis
from brinedeck.operators import community, geo, grid, gridmatch, indices, matching, mooring, profile, quality, summary
from brinedeck.operators.shuffle import left_join_nullsafe, ranked_in_buckets
from tests.conftest import rows

T0 = dt.datetime(2020, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_nearest_join_edges(spark):
    samples = [("MAI", at(10.0), "m1"), ("MAI", at(11.0), "m2"), ("NSI", at(10.0), "n1"), ("NSI", at(40.0), "n2"), ("KAI", at(10.0), "k1")]
    casts = [("MAI", at(12.9), 1), ("MAI", at(7.1), 2), ("MAI", at(7.1), 3), ("NSI", at(24.9), 4), ("NSI", at(55.1), 5), ("KAI", at(13.1), 6)]
    left = spark.createDataFrame(samples, "station string, t timestamp_ntz, trip string")
    right = spark.createDataFrame(casts, "station string, c timestamp_ntz, id int")
    out = matching.nearest_join(left, right, station="station", left_ts="t", right_ts="c")
    got = rows(out.select("trip", "id"))
    # m1: 2.9 h on either side, the earlier time wins and both of its files come; m2: 1.9 h; n1: 14.9 h, n2: 15.1 h; k1: 3.1 h
    assert got == [("m1", 2), ("m1", 3), ("m2", 1), ("n1", 4)]


def test_nearest_times_random(spark):
    rng = random.Random(3)
    left = [(rng.choice("ab"), at(rng.uniform(0, 200))) for _ in range(120)]
    right = [(rng.choice("ab"), at(rng.uniform(0, 200))) for _ in range(60)]
    out = matching.nearest_times(
        spark.createDataFrame(left, "s string, t timestamp_ntz"), spark.createDataFrame(right, "s string, c timestamp_ntz"),
        station="s", left_ts="t", right_ts="c", tolerance=1.5, tolerance_by_station={"b": 4.0},
    )
    want = []
    for s, t in set(left):
        near = min(((abs(c - t), c) for k, c in right if k == s), default=None)
        ok = near and near[0] <= dt.timedelta(hours=4.0 if s == "b" else 1.5)
        want.append((s, t, near[1] if ok else None))
    assert sorted([r[:3] for r in out.collect()], key=str) == sorted(want, key=str)


def test_match_casts_duplicates_shared_casts(spark):
    trips = spark.createDataFrame([("MAI1", at(10.0)), ("MAI2", at(10.5))], "TripCode string, t timestamp_ntz")
    casts = spark.createDataFrame([(1, "NRSMAI", at(10.2)), (2, "NRSMAI", at(30.0))], "file_id int, site string, c timestamp_ntz")
    out = matching.match_casts(
        trips, casts, trip="TripCode", sample_ts="t", cast_ts="c", cast_id="file_id",
        sample_station=F.substring("TripCode", 1, 3), cast_station=F.substring("site", 4, 3),
    )
    assert rows(out.select("file_id", "TripCode")) == [(1, "MAI1"), (1, "MAI2"), (2, None)]


PROFILES = {
    "one": [(10.0, 20.0, 35.0, 1.0)],
    "plain": [(2.0, 21.0, 35.0, 0.2), (10.0, 20.0, 35.0, 0.3), (20.0, 19.9, 34.98, 0.9), (30.0, 19.5, 34.9, 0.9), (40.0, 18.0, 34.0, 0.1)],
    "nochl": [(10.0, 20.0, 35.0, None), (20.0, 19.7, None, None), (30.0, None, 34.9, 0.5)],
    "zero": [(9.0, 20.0, 35.0, 0.0), (11.0, 20.0, 35.0, 0.0), (20.0, 20.0, 35.0, 0.0)],
    "unknown": [(10.0, None, None, 1.0), (20.0, 19.0, 35.0, 2.0), (30.0, 18.0, 35.0, 1.0)],
}


def test_mixed_layer(spark):
    data = [(k, *row) for k, v in PROFILES.items() for row in v]
    df = spark.createDataFrame(data, "trip string, d double, t double, s double, c double")
    args = {"trip": "trip", "depth": "d", "ref_depth": F.lit(10.0)}
    out = profile.mixed_layer(df, temperature="t", salinity="s", chlorophyll="c", **args)
    assert rows(out) == [
        ("nochl", 20.0, 30.0, None), ("one", None, None, None), ("plain", 30.0, 20.0, 20.0), ("unknown", 20.0, 20.0, 20.0), ("zero", 11.0, 11.0, None),
    ]
    maxima = profile.chlorophyll_maxima(df, chlorophyll="c", **args)
    assert rows(maxima) == [("nochl", None), ("one", None), ("plain", 20.0), ("plain", 30.0), ("unknown", 20.0), ("zero", None)]


def square(region, ring, x0, y0, size):
    return [(region, ring, i, x0 + dx * size, y0 + dy * size) for i, (dx, dy) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)])]


def test_region_join(spark):
    vertices = square("outer", 0, 0.0, 0.0, 10.0) + square("outer", 1, 4.0, 4.0, 2.0) + square("zone", 0, 8.0, 8.0, 10.0)
    edges = geo.polygon_edges(spark.createDataFrame(vertices, "region string, ring int, seq int, x double, y double"), ["region"])
    pts = [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 9.0, 9.0), (4, 15.0, 15.0), (5, 30.0, 1.0), (6, None, 1.0), (7, -1.0, 5.0)]
    points = spark.createDataFrame(pts, "id int, x double, y double")
    tagged = geo.region_join(points, edges, x="x", y="y", region=["region"])
    assert rows(tagged.select("id", "region")) == [(1, "outer"), (2, None), (3, "outer"), (4, "zone"), (5, None), (6, None), (7, None)]
    boxes = geo.region_boxes(edges, "region", ["zone", "outer"])
    assert boxes[0] == ("zone", (8.0, 18.0, 8.0, 18.0))
    filled = geo.region_bbox_fallback(tagged, x="x", y="y", region="region", boxes=boxes)
    assert rows(filled.filter("id = 2").select("region")) == [("outer",)]


AXIS = RegularAxis(0.0, 1.0, 4)
GRID = [(float(10 * x + y) if (x, y) != (1, 1) else math.nan, x, y) for x in range(4) for y in range(4)]


def lattice(spark):
    return spark.createDataFrame(GRID, "value double, lon_idx int, lat_idx int").withColumn("product", F.lit("p"))


def test_window_means(spark):
    points = spark.createDataFrame([(1, 0.2, 0.1), (2, 1.4, 1.4), (3, 9.0, 9.0)], "id int, x double, y double")
    table = {(x, y): v for v, x, y in GRID}
    for n in (1, 2, 3, 4):
        out = gridmatch.match_grid(points, lattice(spark), lon="x", lat="y", lon_axis=AXIS, lat_axis=AXIS, products={"m": "p"}, res_spat=n)
        for r in out.collect():
            cx, cy = (min(max(math.ceil(v - 0.5), 0), 3) for v in (r["x"], r["y"]))
            cells = [table.get((x, y), math.nan) for x in range(cx - n // 2, cx - n // 2 + n) for y in range(cy - n // 2, cy - n // 2 + n)]
            cells = [c for c in cells if not math.isnan(c)]
            assert r["m"] == (pytest.approx(np.mean(cells)) if cells else None)


@pytest.mark.parametrize("n", [2, 3, 10])
def test_a_window_is_four_rows(spark, n):
    """Windows equal the n x n rows written out, and a cell is sent as four rows at most."""
    axis = RegularAxis(0.0, 1.0, 25)
    layer = spark.range(625).select((F.col("id") % 25).cast("int").alias("lon_idx"), F.floor(F.col("id") / 25).cast("int").alias("lat_idx"), "id")
    cells = layer.select(F.col("lon_idx").alias("_x"), F.col("lat_idx").alias("_y"))
    got = gridmatch.join_windows(cells, layer, [], axis, axis, n)
    span = F.sequence(F.lit(-(n // 2)), F.lit(n - 1 - n // 2))
    written = cells.withColumn("dx", F.explode(span)).withColumn("dy", F.explode(span)).select("_x", "_y", (F.col("_x") + F.col("dx")).alias("lon_idx"), (F.col("_y") + F.col("dy")).alias("lat_idx"))
    want = written.join(layer, ["lon_idx", "lat_idx"])
    columns = ["_x", "_y", "lon_idx", "lat_idx", "id"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty() and want.select(columns).exceptAll(got.select(columns)).isEmpty()
    sent = got.select("_x", "_y", "_tx", "_ty").distinct().groupBy("_x", "_y").count().agg(F.max("count")).first()[0]
    assert sent <= 4


def test_missing_period_is_null(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, "a"), (2, 0.0, 0.0, "b"), (3, 0.0, 0.0, None)], "id int, x double, y double, period string")
    layers = lattice(spark).withColumn("period", F.lit("a"))
    out = gridmatch.match_grid(points, layers, lon="x", lat="y", lon_axis=AXIS, lat_axis=AXIS, products={"m": "p"}, period="period")
    assert rows(out.select("id", "m")) == [(1, 0.0), (2, None), (3, None)]


def test_bilinear(spark):
    plane = spark.createDataFrame([(2.0 * x + 3.0 * y, x, y) for x in range(4) for y in range(4)], "value double, lon_idx int, lat_idx int")
    pts = [(1, 0.25, 1.5), (2, 1.0, 1.0), (3, 1.0, 1.5), (4, 3.0, 3.0), (5, 3.1, 1.0)]
    points = spark.createDataFrame(pts, "id int, x double, y double")
    out = gridmatch.bilinear_match(points, plane, lon="x", lat="y", lon_axis=AXIS, lat_axis=AXIS, values={"v": "value"})
    got = {r["id"]: r["v"] for r in out.collect()}
    assert got == {i: (pytest.approx(2 * x + 3 * y) if x <= 3 else None) for i, x, y in pts}


def test_irregular_axis(spark):
    axis = spark.createDataFrame([(0, -1.0), (1, 0.5), (2, 0.75), (3, 6.0)], "idx int, c double")
    values = [-50.0, -1.0, -0.25, -0.2, 0.6, 0.63, 3.0, 3.5, 99.0, None]
    points = spark.createDataFrame([(v,) for v in values], "x double")
    out = gridmatch.nearest_on_axis(points, axis, coord="x", axis_coord="c", idx="idx", bin_width=0.5)
    nodes = [-1.0, 0.5, 0.75, 6.0]
    want = {v: None if v is None else min(range(4), key=lambda i: (abs(nodes[i] - v), i)) for v in values}
    assert {r["x"]: r["idx"] for r in out.collect()} == want


def test_weekly_slices(spark):
    slices = spark.createDataFrame([(14,), (21,), (40,)], "day int")
    out = {r["cycle"]: r["day"] for r in gridmatch.weekly_slices(slices, "day", 0).collect()}
    assert out == {c: min(d for d in (14, 21, 40) if d > c * 7) for c in range(1, 6)}


def test_trend_needs_the_first_layer(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0), (1, 2, 5.0), (2, 0, None), (2, 1, 3.0), (2, 2, 4.0), (3, 0, 1.0), (3, 1, None), (3, 2, 2.0)], "c int, t int, value double")
    assert rows(grid.cell_trend(df, cell=["c"], time="t")) == [(1, 2.0), (2, None), (3, 0.5)]
    later = df.filter((F.col("c") != 1) | (F.col("t") > df.agg(F.min("t")).first()[0]))  # a cell without a row in the first layer
    assert dict(rows(grid.cell_trend(later, cell=["c"], time="t")))[1] is None


def test_blocks_drop_empty(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0), (4, 0, None), (5, 1, math.nan)], "lon_idx int, lat_idx int, value double")
    assert rows(grid.block_mean(df, by=[], k=4)) == [(0, 0, 2.0)]


def test_mooring_series(spark):
    df = spark.createDataFrame([("A", T0, 10.0, 1.0), ("A", at(48), 10.0, 2.0), ("A", T0, 20.0, 3.0)], "site string, time timestamp_ntz, depth double, temp double")
    args = {"site": "site", "site_value": "A", "depth": "depth", "time": "time", "value": "temp"}
    out = mooring.mooring_series(df, depth_value=10.0, start="2020-01-02", **args)
    assert rows(out) == [(at(48), 2.0)]
    assert mooring.series_file_name(df, site="A", depth=10.0, time="time") == "A_TEMP_10m_20200101-20200103"
    with pytest.raises(Exception, match="not available at A; available: 10.0 to 20.0"):
        mooring.mooring_series(df, depth_value=14.0, **args).collect()
    wide = spark.createDataFrame([(T0, 1.0, None)], "time timestamp_ntz, `10.5` double, `20` double")
    assert rows(mooring.gridded_from_matrix(wide, "time", ["10.5", "20"])) == [(T0, 10.5, 1.0)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 101, 1000])
def test_exact_quartiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n) ** 3, 2)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    for accuracy in (100_000, 40):  # 40 leaves wide brackets
        got = summary.describe_measures(df, ["v"], accuracy=accuracy).first()
        want = np.quantile(values, [0.25, 0.5, 0.75])
        assert [got["p25"], got["p50"], got["p75"]] == pytest.approx(list(want))
        assert (got["n"], got["min"], got["max"]) == (n, values.min(), values.max())


def test_shannon_matches_the_definition(spark):
    data = [("a", "x", 1.0), ("a", "y", 3.0), ("a", "x", 2.0), ("a", "z", 0.0), ("b", "x", 4.0), ("c", "x", None), ("d", None, 1.0)]
    df = spark.createDataFrame(data, "k string, n string, v double")
    out = {r["k"]: r for r in indices.diversity(df, key="k", name=F.col("n"), value="v", groups={"g": F.col("n").isNotNull()}).collect()}
    assert out["a"]["g_shannon"] == pytest.approx(math.log(2))
    assert out["a"]["g_richness"] == 4 and out["a"]["g_evenness"] == pytest.approx(math.log(2) / math.log(4))
    assert (out["b"]["g_shannon"], out["b"]["g_evenness"]) == (0.0, None)
    assert (out["c"]["g_richness"], out["c"]["g_shannon"]) == (1, None)
    assert "d" not in out


def test_bray_curtis_tiles(spark):
    rng = np.random.default_rng(1)
    table = {(s, t): float(rng.integers(1, 9)) for s in range(23) for t in range(6) if rng.random() < 0.5}
    table |= {(98, 0): 0.0, (99, 0): 0.0}
    long = spark.createDataFrame([(s, str(t), v) for (s, t), v in table.items()] + [(0, "0", -999.0), (1, "1", None)], "s int, t string, v double")
    want = {}
    sites = sorted({s for s, _ in table})
    for i, a in enumerate(sites):
        for b in sites[i + 1:]:
            va, vb = ([table.get((s, t), 0.0) for t in range(6)] for s in (a, b))
            total = sum(va) + sum(vb)
            want[a, b] = None if total == 0 else pytest.approx(sum(abs(x - y) for x, y in zip(va, vb)) / total)
    for tile in (512, 5):
        got = {(r["a"], r["b"]): r["dissimilarity"] for r in community.bray_curtis(long, key="s", taxon="t", value="v", tile=tile).collect()}
        assert got == want


def test_permutation_test_separates_signal_from_noise(spark):
    rng = np.random.default_rng(2)
    u, v = rng.normal(size=(2, 80))
    df = spark.createDataFrame(pd.DataFrame({"id": range(80), "u": u, "v": v, "signal": 2 * u - v + 0.1 * rng.normal(size=80), "noise": rng.normal(size=80)}))
    got = {r["variable"]: r for r in community.env_fit_test(df, key="id", axes=("u", "v"), variables=["signal", "noise"], permutations=199).collect()}
    x = np.column_stack([np.ones(80), u, v])
    for name in ("signal", "noise"):
        z = df.toPandas()[name].to_numpy()
        resid = z - x @ np.linalg.lstsq(x, z, rcond=None)[0]
        assert got[name]["r2"] == pytest.approx(1 - resid.var() / z.var())
    assert got["signal"]["p_value"] == pytest.approx(1 / 200)
    assert got["noise"]["p_value"] > 0.05


def test_rank_in_buckets_is_a_rank(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    out = ranked_in_buckets(df.withColumn("b", F.substring("h", 1, 1)), ["g"], "b", ["h"]).toPandas()
    want = out.groupby("g")["h"].rank(method="first").astype(int)
    assert (out["rank"] == want).all()


def test_joins(spark):
    left = spark.createDataFrame([("a", None), ("b", 1)], "k string, d int")
    right = spark.createDataFrame([("a", None, 5), ("b", 2, 6)], "k string, d int, v int")
    assert rows(left_join_nullsafe(left, right, ["k", "d"])) == [("a", None, 5), ("b", 1, None)]


def test_contour_ranges_are_those_of_each_group(spark):
    data = [("A", 0.0, 0.0, 1.0), ("A", 1.0, 5.0, 2.0), ("B", 100.0, 0.0, 3.0), ("B", 101.0, 5.0, 4.0), (None, 7.0, 1.0, 5.0)]
    df = spark.createDataFrame(data, "site string, t double, d double, v double")
    out = grid.regrid_bins(df, x="t", y="d", value="v", nx=10, ny=5, by=["site"])
    assert rows(out) == [(None, 0, 0, 5.0), ("A", 0, 0, 1.0), ("A", 9, 4, 2.0), ("B", 0, 0, 3.0), ("B", 9, 4, 4.0)]
    common = grid.regrid_bins(df, x="t", y="d", value="v", nx=10, ny=5, by=["site"], x_range=(0.0, 101.0))
    assert {r["x_bin"] for r in common.filter("site = 'B'").collect()} == {9}


def test_empty_samples_stay_in_dissimilarities(spark):
    data = [("a", "x", 1.0), ("b", "x", None), ("b", "y", -999.0), ("c", None, None), ("d", "x", 3.0)]
    out = community.bray_curtis(spark.createDataFrame(data, "s string, t string, v double"), key="s", taxon="t", value="v")
    got = {(r["a"], r["b"]): r["dissimilarity"] for r in out.collect()}
    assert got == {("a", "b"): 1.0, ("a", "c"): 1.0, ("a", "d"): 0.5, ("b", "c"): None, ("b", "d"): 1.0, ("c", "d"): 1.0}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 30, 97, 1000, 1009])
def test_permuted_ranks_are_bijections(spark, n):
    """Every draw is a permutation, draws differ, and ranks go everywhere about equally often."""
    draws = 60
    df = spark.range(n).withColumnRenamed("id", "rank").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    got = community.permuted_rank(df, n).toPandas()
    for _, rows_of in got.groupby("k"):
        assert sorted(rows_of.slot) == list(range(n))
    if n >= 30:
        assert got.groupby("k").slot.apply(tuple).nunique() == draws
        assert abs(got[["rank", "slot"]].corr().iloc[0, 1]) < 0.05


def test_factor_with_an_effect_is_told_from_one_without(spark):
    rows_of = [(i, float(i % 2) * 3 + (i * 37 % 101) / 50, (i * 53 % 97) / 50, "ab"[i % 2], "xyz"[i * 31 % 89 % 3]) for i in range(300)]
    df = spark.createDataFrame(rows_of, "id int, u double, v double, f string, g string")
    strong = community.factor_fit_test(df, key="id", axes=("u", "v"), factor="f", permutations=199).first()
    weak = community.factor_fit_test(df, key="id", axes=("u", "v"), factor="g", permutations=199).first()
    assert strong["hits"] == 0 and strong["p_value"] == pytest.approx(1 / 200) and strong["r2"] > 0.7
    assert weak["p_value"] > 0.02 and weak["r2"] < 0.05
    assert strong["r2"] == pytest.approx(community.factor_fit(df, axes=("u", "v"), factor="f").first()["r2"])


def test_permutations_cost_the_driver_the_same_for_any_number_of_sites(spark):
    """10051 ranks leave six places of their rectangle over, 500 none: the plans are equally long."""
    few, many = (
        len(community.permuted_rank(spark.range(3).select(F.col("id").alias("rank"), F.lit(1).alias("k")), n)._jdf.queryExecution().optimizedPlan().toString())
        for n in (500, 10051)
    )
    assert community.rank_square(500)[2] == 0 and community.rank_square(10051)[2] == 6
    assert many <= few + 20


def test_permutation_tests_are_the_same_in_blocks(spark):
    """Sites cut into several blocks meet the same partners as in one, and as the permuted ranks name."""
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"id": range(97), "u": rng.normal(size=97) + 5, "v": rng.normal(size=97), "z": rng.normal(size=97), "f": [f"{i % 3}" for i in range(97)]})
    df = spark.createDataFrame(frame)
    ranks = community._ranked(df, "id").toPandas().sort_values("rank")
    x = np.column_stack([np.ones(97), ranks["u"], ranks["v"]])

    def fit(z):
        return 1 - (z - x @ np.linalg.lstsq(x, z, rcond=None)[0]).var() / z.var()

    z = ranks["z"].to_numpy()
    hits = sum(fit(z[community._sent(np.arange(97), k, 97)]) >= fit(z) - 1e-12 for k in range(1, 100))
    test = lambda block: community.env_fit_test(df, key="id", axes=("u", "v"), variables=["z"], permutations=99, block=block).select("variable", "hits").first()
    assert test(1 << 20) == test(40) == ("z", hits)
    factor = lambda block: community.factor_fit_test(df, key="id", axes=("u", "v"), factor="f", permutations=99, block=block).first()
    assert factor(1 << 20)["hits"] == factor(40)["hits"] and 0 < factor(40)["hits"] <= 99


def test_draws_repeat_and_follow_the_seed(spark):
    few = spark.range(7).withColumn("v", F.col("id") * 10)
    got = quality.draw_rows(few, 500, ["id"], digits=1)
    first = rows(got)
    assert [r[0] for r in first] == list(range(500)) and {r[1] for r in first} == set(range(7))
    assert all(v == 10 * k for _, k, v in first)
    assert first == rows(quality.draw_rows(few.repartition(5), 500, ["id"], digits=3))
    assert first != rows(quality.draw_rows(few, 500, ["id"], seed=1))
    assert quality.draw_rows(few.limit(0), 5, ["id"]).count() == 0
