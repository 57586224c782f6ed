"""Contract of the column expressions, NULL and NaN included."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from brinedeck.functions import missing, ocean, text, timefn
from brinedeck.functions.axes import RegularAxis
from brinedeck.operators import quality
from brinedeck.operators.geo import lookup_tz
from tests.conftest import rows

NAN = float("nan")


def one(spark, column, value=None, kind="double"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


def test_sums_and_maxima(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", 3.0)], "k string, v double")
    v = F.col("v")
    out = df.groupBy("k").agg(missing.sum_or_zero(v), missing.sum_strict(v), missing.max_strict(v))
    assert rows(out) == [("a", 1.0, None, None), ("b", 0.0, None, None), ("c", 5.0, 5.0, 3.0)]


def test_nan_input_does_not_poison_a_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", NAN), ("b", NAN)], "k string, v double")
    assert rows(quality.mean_by_key(df, ["k"], {"m": "v"})) == [("a", 1.0), ("b", None)]


def test_membership_of_null(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "v string")
    assert rows(df.filter(missing.not_in(F.col("v"), ["x"]))) == [(None,), ("y",)]
    assert rows(df.filter(missing.not_matches(F.col("v"), "x"))) == [(None,), ("y",)]


def test_paste_prints_null(spark):
    assert one(spark, missing.paste(F.col("v"), " ", F.lit("x")), None, "string") == "NA x"


def test_ratio_by_zero(spark):
    assert one(spark, missing.ratio(F.col("v"), F.lit(0.0)), 1.0) is None


def test_pad_never_truncates(spark):
    for value, want in (("5", "005"), ("100", "100"), ("1000", "1000")):
        assert one(spark, text.pad_left(F.col("v"), 3), value, "string") == want
    assert one(spark, text.sample_code(F.lit("MAI20090101"), F.col("v")), "WC", "string") == "NRSMAI20090101_WC"
    assert one(spark, text.sample_code(F.lit("MAI20090101"), F.col("v")), "10", "string") == "NRSMAI20090101_010"


@pytest.mark.parametrize("species,ok", [
    ("finmarchicus", True), ("spp.", False), (None, False), ("cf. minor", False), ("grp a", False), ("a/b", True), ("two words", True), ("cfX", False),
])
def test_identified_species(spark, species, ok):
    assert one(spark, text.is_identified_species(F.col("v")), species, "string") is ok


def test_slash_and_grp_options(spark):
    assert one(spark, text.is_identified_species(F.col("v"), allow_slash=False), "a/b", "string") is False
    assert one(spark, text.is_identified_species(F.col("v"), allow_grp=True), "grp a", "string") is True


def test_codes(spark):
    df = spark.createDataFrame([("NRSDAR", dt.datetime(2011, 6, 27, 3, 4)), ("NRSMAI", dt.datetime(2011, 6, 27, 3, 4))], "s string, t timestamp_ntz")
    assert rows(df.select(text.cast_code(F.col("s"), F.col("t")))) == [("NRSDAR20110627_03:04",), ("NRSMAI20110627",)]
    assert one(spark, missing.map_code(F.col("v"), {"a": "A"}, None), "b", "string") is None


@pytest.mark.parametrize("local,zone,utc", [
    ("2019-10-06 02:30:00", "Australia/Sydney", "2019-10-05 16:00:00"),  # in the gap: rolls to its end
    ("2019-10-06 03:30:00", "Australia/Sydney", "2019-10-05 16:30:00"),
    ("2019-04-07 02:30:00", "Australia/Sydney", "2019-04-06 15:30:00"),  # in the overlap: the earlier one
    ("2019-01-01 12:00:00", "Australia/Darwin", "2019-01-01 02:30:00"),
])
def test_local_to_utc(spark, local, zone, utc):
    col = F.date_format(timefn.utc_from_local(F.col("v").cast("timestamp_ntz"), zone), "yyyy-MM-dd HH:mm:ss")
    assert one(spark, col, local, "string") == utc


def test_unknown_zone_is_null(spark):
    assert one(spark, lookup_tz(F.col("v")), "XXX", "string") is None
    assert one(spark, lookup_tz(F.col("v")), "YON", "string") == "Australia/Brisbane"


@pytest.mark.parametrize("day,calendar,written", [
    ("2015-01-01", "20150012015008", "20150012015008"),
    ("2015-01-10", "20150092015016", "20150012015008"),
    ("2016-12-31", "20163612016366", "20163662016360"),
    ("2015-12-31", "20153612015365", "20153532015360"),
    ("2016-02-29", "20160572016064", "20160572016064"),
])
def test_composite8(spark, day, calendar, written):
    at = F.col("v").cast("date")
    assert one(spark, timefn.composite8_key(at), day, "string") == calendar
    assert one(spark, timefn.composite8_key(at, "as_written"), day, "string") == written


def test_month_key_and_periods(spark):
    at = F.col("v").cast("date")
    assert one(spark, timefn.month_key(at), "2016-02-10", "string") == "20160322016060"
    assert one(spark, timefn.period_key(at, "1m"), "2016-02-10", "string") == "201602"
    assert one(spark, timefn.period_key(at, "12mNy"), "2016-02-10", "string") == "all"
    with pytest.raises(ValueError):
        timefn.period_key(at, "2d")


def test_time_axes(spark):
    assert one(spark, timefn.from_days_since(F.col("v"), "1950-01-01 00:00:00"), 1.5) == dt.datetime(1950, 1, 2, 12)
    at = F.col("v").cast("timestamp_ntz")
    assert one(spark, timefn.decimal_year(at), "2016-07-02 00:00:00", "string") == 2016.5
    assert one(spark, timefn.days_since(at, "1800-01-01"), "1800-01-02 12:00:00", "string") == 1.5


def test_depth_bins_are_open_below(spark):
    got = [one(spark, ocean.depth_bin(F.col("v")), d) for d in (0.0, 20.0, 20.01, 100.0, 100.01)]
    assert got == [None, "0 - 20m", "20 - 40m", "80 - 100m", None]


def test_cell_carbon(spark):
    def carbon(group, volume, cells):
        df = spark.createDataFrame([(group, volume, cells)], "g string, b double, c double")
        return df.select(ocean.cell_carbon(F.col("g"), F.col("b"), F.col("c"))).first()[0]

    assert carbon("Dinoflagellate", 200.0, 2.0) == pytest.approx(0.76 * 100 ** 0.819)
    assert carbon("Ciliate", 200.0, 2.0) == pytest.approx(0.22 * 100 ** 0.939)
    assert carbon("Other diatom", 200.0, 2.0) == pytest.approx(0.288 * 100 ** 0.811)
    assert carbon("Cyanobacteria", None, 2.0) == 0.2
    assert carbon(None, 200.0, 2.0) is None
    assert carbon("Ciliate", 200.0, 0.0) is None


def test_harmonic_and_log(spark):
    t = 2 * math.pi * 45 / 366
    want = 1 + 2 * math.cos(t) + 3 * math.sin(t) + 4 * math.cos(2 * t) + 5 * math.sin(2 * t)
    assert one(spark, ocean.harmonic(F.lit(45), *[F.lit(float(i)) for i in range(1, 6)])) == pytest.approx(want)
    assert [one(spark, ocean.log10_squished(F.col("v")), x) for x in (0.001, 1.0, 100.0, 0.0)] == [-1.5, 0.0, 1.0, None]


def test_axis_lookups(spark):
    up, down = RegularAxis(0.0, 0.5, 5), RegularAxis(2.0, -0.5, 5)
    x = F.col("v")
    assert [one(spark, up.nearest(x), v) for v in (-9.0, 0.25, 0.26, 9.0)] == [0, 0, 1, 4]
    assert [one(spark, down.nearest(x), v) for v in (9.0, 0.26, -9.0)] == [0, 3, 4]
    assert [(one(spark, a.at_or_below(x), 0.7), one(spark, a.at_or_above(x), 0.7)) for a in (up, down)] == [(1, 2), (3, 2)]
    assert (one(spark, up.at_or_below(x), 1.0), one(spark, up.at_or_above(x), 1.0)) == (2, 2)
    assert one(spark, up.at_or_below(x), -0.1) is None
    assert [one(spark, a.first_within(x, 0.45), 0.7) for a in (up, down)] == [1, 2]
    assert one(spark, up.first_within(x, 0.1), 0.7) is None


def test_require_date(spark):
    with pytest.raises(ValueError):
        quality.require_date(spark.createDataFrame([(1,)], "a int"))
    out = quality.require_date(spark.createDataFrame([(dt.date(2016, 2, 29),)], "Date date"))
    assert out.select("Year", "Month", "Day").first()[:] == (2016, 2, 29)


def test_qc_flags(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, None), (3.0, 1), (4.0, 9)], "v double, f int")
    assert rows(quality.qc_mask(df, {"v": "f"}).select("v")) == [(None,), (None,), (2.0,), (3.0,)]
    assert rows(quality.qc_keep(df, "f").select("v")) == [(3.0,)]


def test_replicates_can_be_summed(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 7.0), ("b", None, None)], "k string, m double, s double")
    assert rows(quality.replicate_mean(df, ["k"], ["m"], ["s"])) == [("a", 2.0, 12.0), ("b", None, 0.0)]
