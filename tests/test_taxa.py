"""Presence rule, totals and matrices against a plain-Python account of the rule."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brinedeck.operators import taxa
from tests.conftest import rows

DAY = [dt.datetime(2009, 1, d) for d in range(1, 11)]


def frames(spark, samples, obs, log):
    return (
        spark.createDataFrame(samples, "trip string, station string, date timestamp_ntz"),
        spark.createDataFrame(obs, "trip string, TaxonName string, name string, v double"),
        spark.createDataFrame(log, "TaxonName string, StartDate timestamp_ntz, ParentName string"),
    )


def expected(samples, obs, log, placeholder):
    """The rule step by step: sums, loop over logged names, larger of duplicates."""
    changed = {t for t, _, p in log if t != p}
    start = {t: s for t, s, _ in log}
    plain, hit = {}, {}
    for trip, taxon, name, v in obs:
        if not name:
            continue
        if taxon in changed:
            k = (trip, start[taxon], name)
            hit[k] = hit.get(k, 0.0) + (v or 0.0)
        else:
            plain[trip, name] = plain.get((trip, name), 0.0) + (v or 0.0)
    out = {}

    def put(trip, name, v):
        out.setdefault((trip, name), []).append(v)

    for trip, _, _ in samples:
        own = [(n, v) for (t, n), v in plain.items() if t == trip]
        for n, v in own or [(placeholder, 0.0)]:
            put(trip, n, v)
    default = {}
    for trip, s, name in sorted(hit):
        default.setdefault(name, s)
    for name, d0 in default.items():
        for trip, _, date in samples:
            found = [(s, v) for (t, s, n), v in hit.items() if t == trip and n == name] or [(d0, None)]
            parts = [-999.0 if s > date else 0.0 if v is None and s < date else v for s, v in found]
            put(trip, name, None if None in parts else sum(parts))
    return sorted(((t, n, None if None in v else max(v)) for (t, n), v in out.items()), key=str)


def check(spark, samples, obs, log, placeholder="none", **options):
    s, o, g = frames(spark, samples, obs, log)
    got = taxa.apply_change_log(s, o, g, level="name", key="trip", date="date", name="name", value="v", placeholder=placeholder, **options)
    assert got.columns == ["trip", "station", "date", "name", "v"]
    got = sorted([(r["trip"], r["name"], r["v"]) for r in got.collect()], key=str)
    assert got == expected(samples, obs, log, placeholder)


def test_presence_rule_cases(spark):
    samples = [("t1", "A", DAY[0]), ("t2", "A", DAY[4]), ("t3", "B", DAY[8]), ("t4", "B", DAY[5])]
    log = [("new", DAY[4], "old"), ("same", DAY[2], "same")]
    obs = [
        ("t1", "new", "N", 7.0),      # before its start: -999 overrides the record
        ("t3", "new", "N", 2.0),      # kept
        ("t1", "same", "S", 3.0),     # in the log but not changed
        ("t3", "other", "N", 5.0),    # same name, not logged: the larger wins
        ("t9", "new", "N", 1.0),      # no such sample
        ("t3", None, "X", 4.0), ("t1", "p", None, 1.0), ("t1", "p", "", 1.0),
    ]
    check(spark, samples, obs, log)   # t2 is on the start date without a record: unknown
    check(spark, samples, obs, log, placeholder="N")
    check(spark, samples, [], log)


def test_presence_rule_random(spark):
    rng = random.Random(5)
    samples = [(f"t{i}", "A", rng.choice(DAY)) for i in range(30)]
    log = [(f"x{i}", rng.choice(DAY), f"x{rng.randrange(6)}") for i in range(6)]
    obs = [
        (f"t{rng.randrange(34)}", f"x{rng.randrange(9)}", f"n{rng.randrange(4)}", rng.choice([None, 1.0, 2.0, 5.0])) for _ in range(90)
    ]
    check(spark, samples, obs, log)


def check_counts(spark, samples, obs, log, placeholder, by):
    """The counts against those of the long table."""
    s, o, g = frames(spark, samples, obs, log)
    options = dict(level="name", key="trip", date="date", name="name", value="v", placeholder=placeholder)
    got = rows(taxa.presence_counts(s, o, g, by=by, **options).select("name", *by, "n_not_looked_for", "n_absent", "n_unknown", "n_found", "total"))
    v = F.col("v")
    long = taxa.apply_change_log(s, o, g, **options).groupBy("name", *by).agg(
        F.count_if(v == -999), F.count_if(v == 0), F.count_if(v.isNull()), F.count_if(v > 0), F.coalesce(F.sum(F.when(v > 0, v)), F.lit(0.0)),
    )
    assert got == rows(long)


@pytest.mark.parametrize("seed", range(2))
def test_counts_equal_those_of_the_long_table(spark, seed):
    rng = random.Random(seed)
    times = [None, *DAY, *[d + dt.timedelta(hours=h) for d in DAY[3:6] for h in (1, 7, 12)]]
    samples = [(f"t{i}", rng.choice(["A", "B", None]), rng.choice(times)) for i in range(60)]
    log = [(f"x{i}", rng.choice(times), f"x{rng.randrange(6)}") for i in range(6)]
    obs = [(f"t{rng.randrange(64)}", f"x{rng.randrange(9)}", f"n{rng.randrange(5)}", rng.choice([None, 0.0, 1.0, 5.0])) for _ in range(90)]
    check_counts(spark, samples, obs, log, "n0" if seed else "none", ["station"])
    check_counts(spark, samples, obs, log, "none", ["station", "date"])


def test_counts_of_empty_tables(spark):
    log = [("new", DAY[4], "old")]
    check_counts(spark, [("t1", "A", DAY[0])], [], log, "none", ["station"])
    check_counts(spark, [], [("t1", "new", "N", 1.0)], log, "none", ["station"])


def test_counts_make_no_grid(spark):
    """No list of names, and no row of a sample but with a name found in it."""
    samples = [(f"t{i}", "A", DAY[i % 10]) for i in range(200)]
    log = [(f"x{i}", DAY[i % 10], "old") for i in range(40)]
    s, o, g = frames(spark, samples, [(f"t{i}", f"x{i}", f"n{i}", 1.0) for i in range(40)], log)
    out = taxa.presence_counts(s, o, g, level="name", key="trip", date="date", name="name", value="v", placeholder="none", by=["station"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "scalar-subquery" not in plan
    found = {r["name"]: (r["n_not_looked_for"], r["n_absent"], r["n_unknown"], r["n_found"]) for r in out.collect()}
    assert all(sum(n) == 200 for k, n in found.items() if k != "none") and found["none"] == (0, 200, 0, 0)


def test_rows_of_a_matrix(spark):
    long = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", None), ("b", "No taxa found", 0.0), ("c", "y", 4.0)], "k string, n string, v double"
    )
    out = taxa.to_matrix(long, ["k"], "n", "v", drop_names=["No taxa found"])
    assert out.columns == ["k", "x", "y"]
    assert rows(out) == [("a", 1.0, None), ("b", 0.0, 0.0), ("c", 0.0, 4.0)]


def test_names_of_a_long_table(spark):
    long = spark.createDataFrame([(str(i),) for i in range(5)] + [(None,)], "n string")
    assert taxa.taxon_names(long, "n") == ["0", "1", "2", "3", "4"]


def test_samples_without_records_stay(spark):
    samples = spark.createDataFrame([("a",), ("b",)], "trip string")
    obs = spark.createDataFrame([("a", "x", None, "s", "G1", 1.0), ("a", "y", "g", None, "Other", 2.0)], "trip string, t string, g string, s string, grp string, v double")
    assert rows(taxa.raw_long(samples, obs, key="trip", name="t", value="v", placeholder="none")) == [("a", "x", 1.0), ("a", "y", 2.0), ("b", "none", None)]
    assert rows(taxa.ids_long(samples, obs, key="trip", taxon="t", genus="g", species="s", value="v")) == [("a", "g NA", 2.0), ("a", "x", 1.0), ("b", None, 0.0)]
    out = taxa.group_totals(samples, obs, key="trip", group="grp", value="v", exclude=["Other"], placeholder="C")
    assert rows(out) == [("a", "G1", 1.0), ("b", "C", 0.0)]


def test_genus_level_of_the_log(spark):
    log = spark.createDataFrame([("A b", "A c"), ("A b", "D b"), ("A b", None)], "TaxonName string, ParentName string")
    assert taxa.changed_in_log(log, "genus").count() == 1
    assert taxa.changed_in_log(log, "name").count() == 2


def test_zero_taxa(spark):
    long = spark.createDataFrame([("a", 0.0), ("a", None), ("b", 1.0)], "t string, v double")
    assert rows(taxa.drop_zero_taxa(long, "t", "v").select("t")) == [("b",)]
    assert rows(taxa.taxon_totals(long, "t", "v")) == [("a", 0.0), ("b", 1.0)]


def test_dims_merge_samples(spark):
    samples, obs, log = frames(spark, [("t1", "A", DAY[0]), ("t2", "A", DAY[0])], [("t1", "p", "N", 1.0), ("t2", "p", "N", 3.0)], [("q", DAY[0], "r")])
    out = taxa.apply_change_log(
        samples, obs, log, level="name", key="trip", date="date", name="name", value="v", placeholder="none", dims=["station", "date"],
    )
    assert rows(out.select("station", "name", F.col("v"))) == [("A", "N", 4.0)]


def test_a_task_holds_a_bounded_number_of_samples(spark, monkeypatch):
    from brinedeck.operators import taxa as ops

    monkeypatch.setattr(ops, "SAMPLES_TOGETHER", 10)
    assert ops._parts(spark.range(95)) == 10


def test_matrix_needs_no_row_per_key_and_name(spark):
    from brinedeck.operators import taxa as ops

    long = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "b", None), (2, "c", 5.0), (3, None, 4.0)], "k int, name string, v double")
    wide = ops.to_matrix(long, ["k"], "name", "v", names=["a", "b"])
    assert "pivotfirst" not in wide._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in wide.select("k", "a").collect()) == [(1, 3.0), (2, 0.0), (3, 0.0)]
    assert [r["b"] for r in wide.orderBy("k").collect()] == [None, 0.0, 0.0]
