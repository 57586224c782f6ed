"""They must equal the published data conventions for right results."""

# quality-control flags
BAD_FLAGS = (3, 4, 9)
GOOD_FLAGS = (0, 1, 2, 5, 8)

# presence codes
NOT_LOOKED_FOR = -999.0

# project code, cast site prefix, casts with known wrong times
PROJECT = "NRS"
CAST_DENY_LIST = (2117, 2184, 2186, 2187)

# station code -> station name
STATION_NAMES = {
    "DAR": "Darwin",
    "YON": "Yongala",
    "NSI": "North Stradbroke Island",
    "PHB": "Port Hacking",
    "MAI": "Maria Island",
    "KAI": "Kangaroo Island",
    "ESP": "Esperance",
    "ROT": "Rottnest Island",
    "NIN": "Ningaloo",
}

# station code -> time zone
STATION_ZONES = {
    "MAI": "Australia/Hobart",
    "KAI": "Australia/Adelaide",
    "ESP": "Australia/Perth",
    "ROT": "Australia/Perth",
    "NIN": "Australia/Perth",
    "DAR": "Australia/Darwin",
    "YON": "Australia/Brisbane",
    "PH4": "Australia/Sydney",
    "NSI": "Australia/Brisbane",
    "PHB": "Australia/Sydney",
}

# cast matching tolerance, hours
CAST_TOLERANCE_H = 3.0
CAST_TOLERANCE_BY_STATION_H = {"NSI": 15.0}

# profile reference depth (m) and thresholds
SHALLOW_STATIONS = ("DAR", "YON")
SHALLOW_REF_DEPTH_M = 5.0
REF_DEPTH_M = 10.0
MLD_TEMPERATURE_DROP = 0.4
MLD_SALINITY_DROP = 0.03
SURFACE_CAST_DEPTH_M = 15.0
SURFACE_PIGMENT_DEPTH_M = 25.0

# cell carbon (pg) from biovolume (um3): factor, exponent
CARBON_ALLOMETRY = {"Dinoflagellate": (0.76, 0.819), "Ciliate": (0.22, 0.939)}
CARBON_OTHER = (0.288, 0.811)
CARBON_CYANOBACTERIA = 0.2

# taxon groups
COPEPOD = "COPEPOD"
NON_COPEPOD = "NON-COPEPOD"
DIATOM_GROUPS = ("Centric diatom", "Pennate diatom")
DINOFLAGELLATE = "Dinoflagellate"
CARNIVORE_DIET = "CC"
PHYTO_GROUPS_EXCLUDED = ("Other", "Coccolithophore", "Diatom", "Protozoa")
ZOO_GROUPS_EXCLUDED = ("Other",)

# label given to a sample in which nothing of a table was found
PLACEHOLDER = {
    "raw": "No taxa found",
    "phyto_group": "Ciliate",
    "zoo_group": "Copepod",
    "genus": "Acanthoica",
    "species": "Paralia sulcata",
    "copepod": "Calanus Australis",
    "noncopepod": "Calanus Australis",
    "towed_noncopepod": "Evadne spinifera",
}

# depth bins of moored temperature, (low, high] in metres -> label
DEPTH_BINS = (
    (0.0, 20.0, "0 - 20m"),
    (20.0, 40.0, "20 - 40m"),
    (40.0, 60.0, "40 - 60m"),
    (60.0, 80.0, "60 - 80m"),
    (80.0, 100.0, "80 - 100m"),
)

# origins of numeric time axes
MOORING_EPOCH = "1950-01-01 00:00:00"
ALTIMETRY_EPOCH = "1985-01-01"
WEEKLY_EPOCH = "1800-01-01"
WEEKLY_ORIGIN_DAY = 66410

# climatology year length in the harmonic argument
HARMONIC_YEAR = 366.0

# fallback boxes tried in this order for points outside every region polygon
FALLBACK_REGIONS = ("Coral Sea", "Temperate East", "South-west", "South-east")

# null markers in source text files
NULL_TOKENS = ("", "(null)", "NaN")
CAST_PREAMBLE_LINES = 29
