"""Readers, sinks and whole products on text fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brinedeck.functions.axes import RegularAxis
from brinedeck.operators import gridmatch
from brinedeck.operators import indices as op
from brinedeck.operators.quality import duplicate_max
from brinedeck.plans import community, matchups, matrices, series
from brinedeck.plans.indices import station_indices, tow_indices
from brinedeck.plans.water_quality import combined_water_quality
from brinedeck.sources import readers, sinks
from tests.conftest import rows

TRIPS = """TRIP_CODE,PROJECTNAME,STATION,STATIONCODE,LATITUDE,LONGITUDE,SAMPLEDATELOCAL,BIOMASS_MGM3,SECCHI_M,SAMPLETYPE
MAI20150101,NRS,Maria Island,MAI,-42.6,148.2,2015-01-01 10:00:00,5.5,12,PZ
PHB20191006,NRS,Port Hacking,PHB,-34.1,151.2,2019-10-06 02:30:00,,7,P
YON20160101,NRS,Yongala,YON,-19.3,147.6,2016-01-01 10:00:00,1.0,,Z
XXX20150101,SOTS,Other,SOTS,,,2015-01-01 10:00:00,,,P
"""
ZOO = """TRIP_CODE,TAXON_NAME,TAXON_GROUP,TAXON_GRP01,GENUS,SPECIES,SPCODE,{value}
MAI20150101,Acartia tonsa,COPEPOD,Copepod,Acartia,tonsa,1,10
MAI20150101,Calanus cf. x,COPEPOD,Copepod,Calanus,cf. x,2,4
MAI20150101,Paracalanus parvus,COPEPOD,Copepod,Paracalanus,parvus big,3,6
MAI20150101,Evadne spinifera,NON-COPEPOD,Cladoceran,Evadne,spinifera,4,3
YON20160101,Acartia tonsa,COPEPOD,Copepod,Acartia,tonsa,1,
"""
PHYTO = """TRIP_CODE,TAXON_NAME,TAXON_GROUP,GENUS,SPECIES,SPCODE,CELL_L,BIOVOLUME_UM3L
MAI20150101,Chaetoceros a,Centric diatom,Chaetoceros,a,1,100,5000
MAI20150101,Navicula b/c,Pennate diatom,Navicula,b/c,2,50,2500
MAI20150101,Tripos furca,Dinoflagellate,Tripos,furca,3,50,10000
PHB20191006,Flagellate,Other,,,4,10,
PHB20191006,Chaetoceros spp.,Centric diatom,Chaetoceros,spp.,5,10,
"""
LOG = """TAXON_NAME,START_DATE,PARENT_NAME
Acartia tonsa,2015-06-01 00:00:00,Acartia spp.
Tripos furca,2014-06-01 00:00:00,Ceratium furca
"""
TRAITS = """TAXON_NAME,SIZE_MIN_MM,SIZE_MAX_MM,SIZE_AVE_MM,DIET
Acartia tonsa,,,1.0,CC
Paracalanus parvus,,,2.0,CH
"""
CHEMISTRY = """TRIP_CODE,SAMPLEDEPTH_M,SILICATE_UMOLL,SILICATE_FLAG,DIC_UMOLKG,CARBON_FLAG,NITRATE_UMOLL,NITRATE_FLAG
MAI20150101,10,1.0,1,2000,1,NaN,1
MAI20150101,10,3.0,2,2000,1,,1
MAI20150101,50,9.0,4,2000,,2.5,
"""
PIGMENTS = """TRIP_CODE,SAMPLEDEPTH_M,PIGMENTS_FLAG,PIGMENTS_COMMENTS,DV_CPHL_A_AND_CPHL_A
MAI20150101,10,1,ok,0.4
MAI20150101,10,4,bad,9.9
MAI20150101,WC,2,ok,0.8
"""
PICO = """TRIP_CODE,SAMPLEDEPTH_M,REPLICATE,SAMPLEDATE_LOCAL,PROCHLOROCOCCUS_CELLSML,PROCHLOROCOCCUS_FLAG,SYNECOCHOCCUS_CELLSML,SYNECOCHOCCUS_FLAG,PICOEUKARYOTES_CELLSML,PICOEUKARYOTES_FLAG
MAI20150101,20,1,,10,1,5,3,(null),1
MAI20150101,20,2,,20,1,7,1,(null),1
"""
TSS = """TRIP_CODE,SAMPLEDEPTH_M,TSS_MGL,INORGANICFRACTION_MGL,ORGANICFRACTION_MGL,SECCHIDEPTH_M,TSSFLAG
NRSMAI20150101,20,4.0,1.0,2.0,,1
NRSMAI20150101,20,8.0,1.0,2.0,,4
NRSMAI20150101,,8.0,1.0,2.0,,1
"""
CTD_HEAD = "".join(f"Metadata line {i}: see, documentation\n" for i in range(29))
CTD = CTD_HEAD + """file_id,site_code,cruise_id,time_coverage_start,LATITUDE,LONGITUDE,DEPTH,PRES_REL,PSAL,PSAL_quality_control,TEMP,TEMP_quality_control,CPHL,CHLF,TURB,CNDC,DENS
1,NRSMAI,c,2014-12-31 22:00:00,-42.6,148.2,2.0,2,35.0,1,16.0,1,,0.2,,,
1,NRSMAI,c,2014-12-31 22:00:00,-42.6,148.2,10.4,10,35.0,1,15.5,1,0.5,0.3,,,
1,NRSMAI,c,2014-12-31 22:00:00,-42.6,148.2,20.0,20,34.97,1,15.1,1,0.9,0.3,,,
1,NRSMAI,c,2014-12-31 22:00:00,-42.6,148.2,30.0,30,34.5,1,14.0,1,0.1,0.3,,,
2,NRSZZZ,c,2014-12-31 22:00:00,-42.6,148.2,2.0,2,35.0,1,16.0,1,,0.2,,,
3,OTHER,c,2014-12-31 22:00:00,-42.6,148.2,2.0,2,35.0,1,16.0,1,,0.2,,,
2117,NRSMAI,c,2014-12-31 22:00:00,-42.6,148.2,2.0,2,35.0,1,16.0,1,,0.2,,,
"""
TOW = """SAMPLE,TRIP_CODE,ROUTE,REGION,SAMPLETYPE,LATITUDE,LONGITUDE,PCI,BIOMASS_MGM3,SAMPLEDATEUTC
1,T1,R,Reg,PZ,-30.0,150.0,0.5,(null),2015-01-01 10:00:00
2,T1,R,Reg,P,-31.0,150.0,,1.0,2015-01-01 11:00:00
3,T1,R,Reg,(null),-32.0,150.0,,1.0,2015-01-01 12:00:00
"""


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    texts = {
        "trips": TRIPS, "zoo": ZOO.format(value="ZOOP_ABUNDANCE_M3"), "count": ZOO.format(value="COUNTS"), "phyto": PHYTO, "log": LOG, "traits": TRAITS,
        "chemistry": CHEMISTRY, "pigments": PIGMENTS, "pico": PICO, "tss": TSS, "ctd": CTD, "tow": TOW,
    }
    for name, text in texts.items():
        (root / f"{name}.csv").write_text(text)
    return lambda name: str(root / f"{name}.csv")


def test_trips(spark, files):
    trips = readers.load_trips(spark, files("trips"))
    got = rows(trips.select("TripCode", "Year", "Time_24hr", F.date_format("SampleDateUTC", "yyyy-MM-dd HH:mm"), "Secchi_m"))
    assert got == [
        ("MAI20150101", 2015, "10:00:00", "2014-12-31 23:00", 12.0), ("PHB20191006", 2019, "02:30:00", "2019-10-05 16:00", 7.0),
        ("YON20160101", 2016, "10:00:00", "2016-01-01 00:00", None),
    ]


def test_measurement_loaders(spark, files):
    chem = readers.load_chemistry(spark, files("chemistry"))
    assert rows(chem.select("SampleDepth_m", "Silicate_umolL", "DIC_umolkg", "Nitrate_umolL", "Oxygen_umolL")) == [("10", 2.0, 2000.0, None, None), ("50", None, 2000.0, 2.5, None)]
    assert rows(readers.load_chemistry(spark, files("chemistry"), sums=("DIC_umolkg",)).select("DIC_umolkg")) == [(2000.0,), (4000.0,)]
    assert rows(readers.load_pigments(spark, files("pigments")).select("SampleDepth_m", "Chla")) == [("10", 0.4), ("WC", 0.8)]
    assert rows(readers.load_pico(spark, files("pico")).drop("TripCode")) == [("20", 15.0, 7.0, None)]
    assert rows(readers.load_tss(spark, files("tss")).select("TripCode", "SampleDepth_m", "TSS_mgL")) == [("MAI20150101", "20", 4.0)]


def test_casts_skip_the_preamble(spark, files):
    ctd = readers.load_ctd(spark, files("ctd"))
    assert ctd.count() == 5
    first = ctd.filter("file_id = 1 and Depth_m = 2").first()
    assert (first["StationName"], first["TripCode"], first["Chla_mgm3"]) == ("Maria Island", "NRSMAI20141231", 0.2)
    assert ctd.filter("file_id = 2").first()["StationName"] is None
    assert first["castTime_Local"] == dt.datetime(2015, 1, 1, 6, 0)


def test_tow_samples(spark, files):
    assert readers.load_tow_samples(spark, files("tow")).count() == 2
    assert readers.load_tow_samples(spark, files("tow"), "Z").count() == 1
    assert readers.load_tow_samples(spark, files("tow"), "P").count() == 2


def load_all(spark, files):
    trips = readers.load_trips(spark, files("trips"))
    zoo, count = readers.load_zoo(spark, files("zoo")), readers.load_zoo_count(spark, files("count"))
    phyto, traits = readers.load_phyto(spark, files("phyto")), readers.load_taxon_info(spark, files("traits"))
    ctd = readers.load_ctd(spark, files("ctd")).withColumn("TripCode", F.when(F.col("file_id") == 1, "MAI20150101"))
    return trips, zoo, count, phyto, traits, ctd


def test_station_indices(spark, files):
    trips, zoo, count, phyto, traits, ctd = load_all(spark, files)
    out = station_indices(trips, zoo, count, phyto, traits, ctd, readers.load_chemistry(spark, files("chemistry")), readers.load_pigments(spark, files("pigments"), flagged=False))
    assert out.count() == trips.count() and duplicate_max(out, ["TripCode"]).first()[0] == 1
    got = {r["TripCode"]: r for r in out.collect()}
    mai, phb, yon = (got[k] for k in ("MAI20150101", "PHB20191006", "YON20160101"))
    assert (mai["ZoopAbundance_m3"], mai["CopeAbundance_m3"], mai["AvgTotalLengthCopepod_mm"]) == (23.0, 20.0, 22.0 / 16.0)
    assert mai["HerbivoreCarnivoreCopepodRatio"] == 6.0 / 16.0
    assert (phb["ZoopAbundance_m3"], phb["CopeAbundance_m3"], yon["CopeAbundance_m3"]) == (0.0, None, 0.0)
    assert mai["NoCopepodSpecies_Sample"] == 2 and mai["NoPhytoSpecies_Sample"] == 3 and mai["NoDiatomSpecies_Sample"] == 2
    assert (mai["AbundancePhyto_cells_L"], mai["DiatomDinoflagellateRatio"], mai["AvgCellVol_um3"]) == (200.0, 0.75, 17500.0 / 200.0)
    assert phb["PhytoBiomassCarbon_pg_L"] is None and phb["AbundancePhyto_cells_L"] == 10.0 and phb["AvgCellVol_um3"] is None
    assert (mai["CTD_SST_C"], mai["MLD_temp"], mai["MLD_sal"], mai["DCM"]) == (pytest.approx(15.75), 20.0, 20.0, 20.0)
    assert (mai["Silicate_umolL"], mai["Chla_mgm3"]) == (2.0, pytest.approx(5.15))


def test_fused_features_equal_the_single_operators(spark, files):
    _, zoo, _, phyto, traits, _ = load_all(spark, files)
    copepods = zoo.filter("Copepod = 'COPEPOD'")
    fused = op.zoo_indices(zoo, traits, key="TripCode", taxon="TaxonName", value="ZAbund_m3", copepod=F.col("Copepod") == "COPEPOD")
    single = op.weighted_mean_size(copepods, traits, key="TripCode", taxon="TaxonName", value="ZAbund_m3", size="SIZE_AVE_MM")
    assert rows(single.filter("AvgTotalLengthCopepod_mm is not null")) == rows(fused.select("TripCode", "AvgTotalLengthCopepod_mm").filter("AvgTotalLengthCopepod_mm is not null"))
    diet = op.diet_ratio(copepods, traits, key="TripCode", taxon="TaxonName", value="ZAbund_m3")
    assert rows(diet.filter("HerbivoreCarnivoreCopepodRatio is not null")) == rows(fused.select("TripCode", "HerbivoreCarnivoreCopepodRatio").filter("HerbivoreCarnivoreCopepodRatio is not null"))
    sums = op.phyto_sums(phyto, key="TripCode", group="TaxonGroup", cells="Cells_L", biovolume="Biovolume_um3L")
    carbon = op.phyto_carbon(phyto, key="TripCode", group="TaxonGroup", cells="Cells_L", biovolume="Biovolume_um3L")
    assert rows(carbon) == rows(sums.select("TripCode", "PhytoBiomassCarbon_pg_L"))


def test_water_quality(spark, files):
    trips, *_, ctd = load_all(spark, files)
    out = combined_water_quality(
        trips.drop("SampleType"), readers.load_chemistry(spark, files("chemistry")), readers.load_pico(spark, files("pico")),
        readers.load_pigments(spark, files("pigments")), readers.load_tss(spark, files("tss")), ctd,
    )
    got = {(r["TripCode"], r["SampleDepth_m"]): r for r in out.collect()}
    assert sorted(got) == [("MAI20150101", "10"), ("MAI20150101", "20"), ("MAI20150101", "50"), ("MAI20150101", "WC"), ("PHB20191006", "WC"), ("YON20160101", "WC")]
    assert out.count() == len(got)
    ten = got["MAI20150101", "10"]
    assert (ten["SampleCode"], ten["Chla"], ten["CTDTemperature"], ten["Station"]) == ("NRSMAI20150101_010", 0.4, 15.5, "Maria Island")
    assert got["MAI20150101", "WC"]["SampleCode"] == "NRSMAI20150101_WC"


def test_matrices(spark, files, tmp_path):
    trips, zoo, _, phyto, *_ = load_all(spark, files)
    log = readers.load_change_log(spark, files("log"))
    samples = trips.select("TripCode", "Station", "SampleDateLocal", "SampleType")
    p = matrices.phyto_tables(
        samples.filter(F.col("SampleType").contains("P")), phyto, log, key="TripCode", date="SampleDateLocal", cells="Cells_L", biovolume="Biovolume_um3L",
    )
    z = matrices.zoo_tables(samples.filter(F.col("SampleType").contains("Z")), zoo, log, key="TripCode", date="SampleDateLocal")
    assert len(p) == 7 and len(z) == 6
    assert rows(p["species"].select("TripCode", "Name", "Cells_L")) == [
        ("MAI20150101", "Chaetoceros a", 100.0), ("MAI20150101", "Tripos furca", 50.0), ("PHB20191006", "Paralia sulcata", 0.0), ("PHB20191006", "Tripos furca", 0.0),
    ]
    assert ("MAI20150101", "Navicula b/c", 2500.0) in rows(p["species_biovolume"].select("TripCode", "Name", "Biovolume_um3L"))
    assert rows(p["genus"].select("TripCode", "Genus", "Cells_L").filter("TripCode like 'PHB%'")) == [("PHB20191006", "Chaetoceros", 10.0), ("PHB20191006", "Tripos", 0.0)]
    assert rows(z["copepods"].select("TripCode", "Name", "ZAbund_m3")) == [
        ("MAI20150101", "Acartia tonsa", -999.0), ("MAI20150101", "Paracalanus parvus", 6.0), ("YON20160101", "Acartia tonsa", 0.0), ("YON20160101", "Calanus Australis", 0.0),
    ]
    assert ("YON20160101", "Calanus Australis", 0.0) in rows(z["noncopepods"].select("TripCode", "Name", "ZAbund_m3"))
    path = str(tmp_path / "m")
    matrices.export_matrix(p["groups"], path, keys=["TripCode", "SampleDateLocal"], name="TaxonGroup", value="Cells_L", date="SampleDateLocal")
    back = spark.read.option("header", True).csv(path)
    assert back.columns[2:] == ["Centric diatom", "Dinoflagellate", "Pennate diatom"]
    assert back.first()["SampleDateLocal"] == "2019-10-06 02:30:00"


def test_tow_indices_keep_every_sample(spark, files):
    samples = readers.load_tow_samples(spark, files("tow"))
    zoo = spark.createDataFrame([(1, "Acartia tonsa", "COPEPOD", "Copepod", "Acartia", "tonsa", 2.0, 2.0)],
                                "Sample int, TaxonName string, Copepod string, TaxonGroup string, Genus string, Species string, ZAbund_m3 double, TaxonCount double")
    phyto = zoo.select("Sample", "TaxonName", F.lit("Ciliate").alias("TaxonGroup"), "Genus", "Species", F.lit(3.0).alias("PAbun_m3"), F.lit(9.0).alias("BioVolume_um3m3"))
    props = spark.createDataFrame([(1, 0.3, 50.0)], "Sample int, ChlorophyllSatellite_mgm3 double, WaterDepth_m double")
    out = tow_indices(samples, zoo, zoo, phyto, readers.load_taxon_info(spark, files("traits")), props)
    assert rows(out.select("Sample", "ZoopAbundance_m3", "WaterDepth_m", "AvgCellVol_um3")) == [(1, 2.0, 50.0, 3.0), (2, None, None, None)]


def test_grid_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "grid")
    cells = spark.range(64).select(
        F.when(F.col("id") % 2 == 0, "sst").otherwise("chl").alias("product"), (F.col("id") % 4).cast("string").alias("period"),
        (F.col("id") % 8).cast("int").alias("lon_idx"), F.floor(F.col("id") / 8).cast("int").alias("lat_idx"), F.col("id").cast("double").alias("value"),
    )
    sinks.write_grid(cells, path)
    sst = readers.read_grid(spark, path, "sst")
    assert sst.count() == 32
    assert "PartitionFilters: [isnotnull(product" in sst._jdf.queryExecution().executedPlan().toString()


def test_match_chain_and_layers(spark):
    axis = RegularAxis(0.0, 1.0, 3)
    layer = spark.range(9).select(
        F.lit("sst").alias("product"), F.lit("20150101").alias("period"), (F.col("id") % 3).cast("int").alias("lon_idx"),
        F.floor(F.col("id") / 3).cast("int").alias("lat_idx"), (F.col("id") + 273.15).alias("value"),
    )
    points = spark.createDataFrame([(1.0, 1.0, dt.date(2015, 1, 1)), (1.0, 1.0, dt.date(2015, 1, 2))], "Longitude double, Latitude double, Date date")
    chain = matchups.satellite_chain(points, {"t": (layer, axis, axis, ["sst"])}, res_spat=3)
    assert [r[0] for r in rows(chain.select("sst_1d"))] == [None, pytest.approx(277.15)]
    sst = matchups.daily_sst(points, layer, lon="Longitude", lat="Latitude", date="Date", lon_axis=axis, lat_axis=axis)
    assert [r[0] for r in rows(sst.select("sst_C"))] == [None, pytest.approx(4.0)]
    clim = layer.select("lon_idx", "lat_idx", *[F.col("value").alias(t) for t in ("mean", "an_cos", "an_sin", "sa_cos", "sa_sin")])
    assert matchups.climatology_layer(clim, 366).filter("lon_idx = 0 and lat_idx = 0").first()["value"] == pytest.approx(273.15 * 3)
    lonlat = layer.select("*", axis.coord(F.col("lon_idx")).alias("lon"), axis.coord(F.col("lat_idx")).alias("lat"))
    target = spark.createDataFrame([(0.5, 0.5), (5.0, 5.0)], "lon double, lat double")
    cut = matchups.regional_layer(lonlat, (0.0, 2.0, 0.0, 2.0), target, lon_axis=axis, lat_axis=axis)
    assert rows(cut.select("value")) == [(pytest.approx(275.15),)]
    weekly = layer.select("lon_idx", "lat_idx", "value", F.lit(66424).alias("day"))
    early = spark.createDataFrame([(1.0, 1.0, dt.datetime(1981, 11, 5))], "Longitude double, Latitude double, Date timestamp_ntz")
    out = matchups.weekly_sst(early, weekly, weekly.select("day").distinct(), lon="Longitude", lat="Latitude", date="Date", day="day", origin=66410, lon_axis=axis, lat_axis=axis)
    assert rows(out.select("day", "value")) == [(66424, pytest.approx(277.15))]
    for span, key in (("8d", "20150012015008"), ("1m", "20150012015031")):
        keyed = layer.drop("period").withColumn("period", F.lit(key))
        got = matchups.composite_corner(points, keyed, lon="Longitude", lat="Latitude", date="Date", span=span, lon_axis=axis, lat_axis=axis)
        assert got.filter("value is not null").count() == 2
    near = matchups.monthly_window(points, layer.drop("period").withColumn("period", F.lit("20150012015031")), lon="Longitude", lat="Latitude", date="Date", half=0.05, lon_axis=axis, lat_axis=axis)
    assert near.filter("value is not null").count() == 2


def test_mooring_and_community_products(spark):
    data = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("site"), F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("time"),
        (F.col("id") % 120).cast("double").alias("depth"), F.col("id").cast("double").alias("temp"),
    )
    out = series.mooring_products(data, nx=10, ny=10)
    assert out["contour"].select("site").distinct().count() == 2
    assert out["series"].filter("DepthBin is null").count() == 0
    assert out["climatology"].agg(F.max("DOY")).first()[0] == 366 or out["climatology"].agg(F.max("DOY")).first()[0] == 365
    long = spark.createDataFrame([("s1", "a", 4.0), ("s2", "a", 1.0), ("s2", "b", 9.0), ("s3", "b", 1.0)], "s string, t string, v double")
    d = community.dissimilarities(long, key="s", taxon="t", value="v", where=F.col("s") != "s3", transform="sqrt")
    assert rows(d) == [("s1", "s2", pytest.approx(1 - 2 * 1 / (2 + 4)))]
    scores = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(40)], "id int, u double, v double")
    env = spark.createDataFrame([(i, float(i % 7) * 2, "x" if i % 2 else "y", 0.0) for i in range(40)], "id int, z double, f string, u double")
    vectors, factors, tests = community.environment_fit(scores, env, key="id", axes=("u", "v"), variables=["z"], factors=["f"], permutations=49)
    assert vectors.first()["r2"] == pytest.approx(1.0) and factors["f"].count() == 2
    assert 0 <= tests["f"].first()["r2"] < 1 and tests["f"].first()["p_value"] == pytest.approx((tests["f"].first()["hits"] + 1) / 50)


def test_row_operators_accept_a_stream(spark, tmp_path):
    from brinedeck.functions.ocean import depth_bin

    path = str(tmp_path / "in")
    spark.range(100).select(F.col("id").cast("double").alias("depth")).write.parquet(path)
    stream = spark.readStream.schema("depth double").parquet(path).withColumn("bin", depth_bin(F.col("depth")))
    query = stream.writeStream.format("memory").queryName("bins").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(60)
    assert spark.table("bins").filter("bin is null").count() == 1


def test_columns_follow_the_header_of_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y,z\n1,2,"p, ""q"""\n')
    (tmp_path / "b.csv").write_text("Y,X\n3,4\n\n(null),5\n")
    out = readers.read_obs_csv(spark, str(tmp_path), {"a": ("X", "int"), "b": ("y", "int"), "c": ("z", "string")})
    assert rows(out) == [(1, 2, 'p, "q"'), (4, 3, None), (5, None, None)]


def test_a_quote_inside_a_field_is_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('trip,x,gear,n\nT1,34.5,5" net,3\nT2,"1,5","a ""b"", c",4\nT3,,"",5\nT4,6\n')
    out = readers.read_obs_csv(spark, str(tmp_path), {"trip": ("trip", "string"), "x": ("X", "string"), "gear": ("gear", "string"), "n": ("N", "int")})
    assert rows(out) == [("T1", "34.5", '5" net', 3), ("T2", "1,5", 'a "b", c', 4), ("T3", None, None, 5), ("T4", "6", None, None)]


def test_too_wide_a_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3\n")
    assert rows(readers.read_obs_csv(spark, str(tmp_path), {"c": ("c", "int")}, width=3)) == [(3,)]
    with pytest.raises(Exception, match="more than 2 columns"):
        readers.read_obs_csv(spark, str(tmp_path), {"b": ("b", "int")}, width=2).collect()


def test_data_lines_equal_to_the_preamble_stay(spark, tmp_path):
    for name, order in (("a", "x,y"), ("b", "y,x")):
        (tmp_path / f"{name}.csv").write_text(f"1,2\nabout\n{order}\n1,2\n{order[::-1]}\n3,4\n")
    out = readers.read_obs_csv(spark, str(tmp_path), {"x": ("x", "string"), "y": ("y", "string")}, preamble=2)
    assert rows(out) == [("1", "2"), ("2", "1"), ("3", "4"), ("4", "3"), ("y", "x"), ("y", "x")]


def test_files_larger_than_a_block_keep_all_lines(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    (tmp_path / "a.csv").write_text("skip\nx,y\n" + "".join(f"{i},{i * 2}\n" for i in range(5000)))
    (tmp_path / "b.csv").write_text("skip\ny,x\n" + "".join(f"{i * 2},{i}\n" for i in range(5000, 9000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = readers.read_obs_csv(spark, str(tmp_path), {"x": ("x", "int"), "y": ("y", "int")}, preamble=1)
        assert out.count() == 9000 and out.filter("y <> 2 * x or x is null").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_all_pigments_are_read(spark, tmp_path):
    (tmp_path / "p.csv").write_text("TRIP_CODE,SAMPLEDEPTH_M,PIGMENTS_FLAG,ZEA,DV_CPHL_A_AND_CPHL_A\nT,10,1,0.25,0.5\n")
    got = readers.load_pigments(spark, str(tmp_path)).first()
    assert (got["ZEA"], got["Chla"], got["FUCO"]) == (0.25, 0.5, None)


def _files_read(df):
    """Files that the scans of a finished query opened."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        if node.getClass().getSimpleName() == "FileSourceScanExec" and node.metrics().contains("numFiles"):
            found.append(node.metrics().apply("numFiles").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(plan)
    return found


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_matching_opens_only_the_points_periods(spark, tmp_path, threshold):
    axis = RegularAxis(0.0, 1.0, 3)
    path, sea = str(tmp_path / "grid"), str(tmp_path / "sea")
    cells = spark.range(9 * 40).select(
        F.lit("sst").alias("product"), F.concat(F.lit("p"), F.floor(F.col("id") / 9).cast("string")).alias("period"), (F.col("id") % 3).cast("int").alias("lon_idx"),
        (F.floor(F.col("id") / 3) % 3).cast("int").alias("lat_idx"), F.col("id").cast("double").alias("value"),
    )
    cells.coalesce(1).write.partitionBy("period").parquet(path)
    measures = [F.col("value").alias(m) for m in ("GSLA", "GSL", "UCUR", "VCUR")]
    slices = cells.select((2000 + F.substr("period", F.lit(2)).cast("int") % 4).alias("year"), (F.substr("period", F.lit(2)).cast("int") * 9 + 1).alias("slice_doy"), "lon_idx", "lat_idx", *measures)
    slices.coalesce(1).write.partitionBy("year", "slice_doy").parquet(sea)
    layers, level = spark.read.parquet(path), spark.read.parquet(sea)
    points = spark.createDataFrame([(i, float(i % 3), float(i % 2), f"p{7 + i % 2}", 2001, 40 + i % 2) for i in range(20)], "id int, x double, y double, period string, year int, doy int")
    points = points.union(spark.createDataFrame([(99, 1.0, 1.0, "p99", 2999, 1)], points.schema))
    xy = {"lon": "x", "lat": "y", "lon_axis": axis, "lat_axis": axis}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = [
            gridmatch.match_grid(points, layers, **xy, products={"v": "sst"}, period="period"),
            gridmatch.bilinear_match(points, layers, **xy, values={"v": "value"}, period="period"),
            gridmatch.bracket_match(points, layers, **xy, period="period"),
            gridmatch.window_first_match(points, layers, **xy, half=0.3, period="period"),
        ]
        for out in found:
            assert _files_read(out) == [2] and out.filter("period = 'p7'").count() == 10
        calendar = level.select("year", "slice_doy").distinct()
        out = gridmatch.match_altimetry(points, level, **xy, year="year", doy="doy", slices=calendar)
        assert min(_files_read(out)) <= 2 and out.filter("GSLA is not null").count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_weekly_points_stay(spark):
    axis = RegularAxis(0.0, 1.0, 3)
    layer = spark.range(9).select((F.col("id") % 3).cast("int").alias("lon_idx"), F.floor(F.col("id") / 3).cast("int").alias("lat_idx"), F.col("id").cast("double").alias("value"), F.lit(66417).alias("day"))
    start = dt.datetime(1800, 1, 1)
    points = spark.createDataFrame([(1.0, 1.0, start + dt.timedelta(days=d)) for d in (66409, 66410, 66411, 66413, 66414)], "x double, y double, Date timestamp_ntz")
    out = matchups.weekly_sst(points, layer, layer.select("day").distinct(), lon="x", lat="y", date="Date", day="day", origin=66410, lon_axis=axis, lat_axis=axis)
    assert out.count() == 3
