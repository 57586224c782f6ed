"""Column types and output names of the source tables.

Each table is ``{output name: (source name, type)}``; source names are matched
without regard to case, and columns a file lacks come out as NULL.
"""

from __future__ import annotations

D, S, I, TS = "double", "string", "int", "timestamp_ntz"

STATION = {
    "ProjectName": ("PROJECTNAME", S), "StationCode": ("STATIONCODE", S), "Station": ("STATIONNAME", S),
    "Node": ("NODE", S), "StateCode": ("STATECODE", S), "Longitude": ("LONGITUDE", D), "Latitude": ("LATITUDE", D),
    "StationStartDate": ("STATIONSTARTDATE", TS), "StationDepth_m": ("STATIONDEPTH_M", D),
    "SamplingEffort": ("SAMPLINGEFFORT", S), "MesoRegion": ("IMCRA", S), "ProvincialRegion": ("IMCRA_PB", S),
    "ManagementRegion": ("MANAGEMENTREGION", S),
}
TRIP = {
    "TripCode": ("TRIP_CODE", S), "ProjectName": ("PROJECTNAME", S), "Station": ("STATION", S),
    "StationCode": ("STATIONCODE", S), "Latitude": ("LATITUDE", D), "Longitude": ("LONGITUDE", D),
    "SampleDateLocal": ("SAMPLEDATELOCAL", TS), "Biomass_mgm3": ("BIOMASS_MGM3", D), "Secchi_m": ("SECCHI_M", D),
    "SampleType": ("SAMPLETYPE", S),
}
PHYTO = {
    "TripCode": ("TRIP_CODE", S), "TaxonName": ("TAXON_NAME", S), "TaxonGroup": ("TAXON_GROUP", S),
    "Genus": ("GENUS", S), "Species": ("SPECIES", S), "SPCODE": ("SPCODE", S),
    "Cells_L": ("CELL_L", D), "Biovolume_um3L": ("BIOVOLUME_UM3L", D),
}
_ZOO_TAXON = {
    "TaxonName": ("TAXON_NAME", S), "Copepod": ("TAXON_GROUP", S), "TaxonGroup": ("TAXON_GRP01", S),
    "Genus": ("GENUS", S), "Species": ("SPECIES", S), "SPCODE": ("SPCODE", S),
}
ZOO = {"TripCode": ("TRIP_CODE", S), **_ZOO_TAXON, "ZAbund_m3": ("ZOOP_ABUNDANCE_M3", D)}
ZOO_COUNT = {"TripCode": ("TRIP_CODE", S), **_ZOO_TAXON, "TaxonCount": ("COUNTS", D), "SampVol_L": ("SAMPVOL_L", D)}
CHANGE_LOG = {"TaxonName": ("TAXON_NAME", S), "StartDate": ("START_DATE", TS), "ParentName": ("PARENT_NAME", S)}
TAXON_INFO = {
    "TaxonName": ("TAXON_NAME", S), "SIZE_MIN_MM": ("SIZE_MIN_MM", D), "SIZE_MAX_MM": ("SIZE_MAX_MM", D),
    "SIZE_AVE_MM": ("SIZE_AVE_MM", D), "DIET": ("DIET", S),
}
# measure -> its flag column
CHEMISTRY_FLAGS = {
    "Silicate_umolL": "SILICATE_FLAG", "Phosphate_umolL": "PHOSPHATE_FLAG", "Ammonium_umolL": "AMMONIUM_FLAG",
    "Nitrate_umolL": "NITRATE_FLAG", "Nitrite_umolL": "NITRITE_FLAG", "Oxygen_umolL": "OXYGEN_FLAG",
    "DIC_umolkg": "CARBON_FLAG", "TAlkalinity_umolkg": "ALKALINITY_FLAG", "Salinity_PSU": "SALINITY_FLAG",
}
CHEMISTRY = {
    "TripCode": ("TRIP_CODE", S), "SampleDepth_m": ("SAMPLEDEPTH_M", S),
    **{m: (m.upper(), D) for m in CHEMISTRY_FLAGS}, **{f: (f, I) for f in CHEMISTRY_FLAGS.values()},
}
# The pigment columns of the public data model; the chlorophyll of the products is one of them.
PIGMENT_NAMES = (
    "ALLO", "ALPHA_BETA_CAR", "ANTH", "ASTA", "BETA_BETA_CAR", "BETA_EPI_CAR", "BUT_FUCO", "CANTHA", "CPHL_A", "CPHL_B", "CPHL_C1", "CPHL_C2",
    "CPHL_C3", "CPHL_C1C2", "CPHLIDE_A", "DIADCHR", "DIADINO", "DIATO", "DINO", "DV_CPHL_A", "DV_CPHL_A_AND_CPHL_A", "DV_CPHL_B",
    "DV_CPHL_B_AND_CPHL_B", "ECHIN", "FUCO", "GYRO", "HEX_FUCO", "KETO_HEX_FUCO", "LUT", "LYCO", "MG_DVP", "NEO", "PERID", "PHIDE_A",
    "PHYTIN_A", "PHYTIN_B", "PRAS", "VIOLA", "ZEA",
)
CHLOROPHYLL = "DV_CPHL_A_AND_CPHL_A"
PIGMENTS = {
    "TripCode": ("TRIP_CODE", S), "SampleDepth_m": ("SAMPLEDEPTH_M", S), "PIGMENTS_FLAG": ("PIGMENTS_FLAG", I),
    **{p: (p, D) for p in PIGMENT_NAMES},
}
PICO_FLAGS = {
    "Prochlorococcus_cellsml": "PROCHLOROCOCCUS_FLAG", "Synecochoccus_cellsml": "SYNECOCHOCCUS_FLAG",
    "Picoeukaryotes_cellsml": "PICOEUKARYOTES_FLAG",
}
PICO = {
    "TripCode": ("TRIP_CODE", S), "SampleDepth_m": ("SAMPLEDEPTH_M", S), "Replicate": ("REPLICATE", I),
    "SampleDate_Local": ("SAMPLEDATE_LOCAL", TS),
    **{m: (m.upper(), D) for m in PICO_FLAGS}, **{f: (f, I) for f in PICO_FLAGS.values()},
}
TSS_MEASURES = ("TSS_mgL", "InorganicFraction_mgL", "OrganicFraction_mgL")
TSS = {
    "TripCode": ("TRIP_CODE", S), "SampleDepth_m": ("SAMPLEDEPTH_M", S), "TSS_mgL": ("TSS_MGL", D),
    "InorganicFraction_mgL": ("INORGANICFRACTION_MGL", D), "OrganicFraction_mgL": ("ORGANICFRACTION_MGL", D),
    "Secchi_m": ("SECCHIDEPTH_M", D), "TSSFLAG": ("TSSFLAG", I),
}
CTD = {
    "file_id": ("file_id", I), "site_code": ("site_code", S), "CastTime_UTC": ("time_coverage_start", TS),
    "Latitude": ("LATITUDE", D), "Longitude": ("LONGITUDE", D), "Depth_m": ("DEPTH", D), "Pressure_dbar": ("PRES_REL", D),
    "Salinity_psu": ("PSAL", D), "Salinity_flag": ("PSAL_quality_control", D),
    "Temperature_degC": ("TEMP", D), "Temperature_flag": ("TEMP_quality_control", D),
    "DissolvedOxygen_umolkg": ("DOX2", D), "DissolvedOxygen_flag": ("DOX2_quality_control", D),
    "Chla_mgm3": ("CPHL", D), "Chla_flag": ("CPHL_quality_control", D), "Fluorescence_mgm3": ("CHLF", D),
    "Turbidity_NTU": ("TURB", D), "Turbidity_flag": ("TURB_quality_control", D),
    "Conductivity_Sm": ("CNDC", D), "Conductivity_flag": ("CNDC_quality_control", D),
    "WaterDensity_kgm3": ("DENS", D), "WaterDensity_flag": ("DENS_quality_control", D),
}
TOW_SAMPLE = {
    "TripCode": ("TRIP_CODE", S), "Sample": ("SAMPLE", I), "Latitude": ("LATITUDE", D), "Longitude": ("LONGITUDE", D),
    "SampleDateUTC": ("SAMPLEDATEUTC", TS), "SampleType": ("SAMPLETYPE", S), "Region": ("REGION", S),
    "Route": ("ROUTE", S), "PCI": ("PCI", D), "Biomass_mgm3": ("BIOMASS_MGM3", D),
}
TOW_PHYTO = {
    "Sample": ("SAMPLE", I), "TaxonName": ("TAXON_NAME", S), "TaxonGroup": ("TAXON_GROUP", S), "Genus": ("GENUS", S),
    "Species": ("SPECIES", S), "PAbun_m3": ("PHYTO_ABUNDANCE_M3", D), "BioVolume_um3m3": ("BIOVOL_UM3M3", D),
}
TOW_ZOO = {"Sample": ("SAMPLE", I), **_ZOO_TAXON, "ZAbund_m3": ("ZOOP_ABUNDANCE_M3", D)}
TOW_ZOO_COUNT = {"Sample": ("SAMPLE", I), **_ZOO_TAXON, "TaxonCount": ("COUNTS", D), "SampVol_L": ("SAMPVOL_L", D)}
TOW_PROPS = {"Sample": ("SAMPLE", I), "ChlorophyllSatellite_mgm3": ("CHLA", D), "WaterDepth_m": ("DEPTH_M", D)}
