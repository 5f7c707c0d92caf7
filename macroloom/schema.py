"""Column contracts and fixed values shared by every layer."""

from pyspark.sql import types as T

# The ordered output contract of both release paths. New columns only ever append.
OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("UNIT_CODE", T.StringType()),
        T.StructField("CONCEPT_CODE", T.StringType()),
        T.StructField("REF_AREA_CODE", T.StringType()),
        T.StructField("REF_AREA_IMF_CODE", T.IntegerType()),
        T.StructField("FREQ_CODE", T.StringType()),
        T.StructField("LASTACTUALDATE", T.IntegerType()),
        T.StructField("SCALE_CODE", T.LongType()),
        T.StructField("NOTES", T.StringType()),
        T.StructField("TIME_PERIOD", T.IntegerType()),
        T.StructField("OBS_VALUE", T.DoubleType()),
        T.StructField("UNIT_LABEL", T.StringType()),
        T.StructField("CONCEPT_LABEL", T.StringType()),
        T.StructField("REF_AREA_LABEL", T.StringType()),
        T.StructField("FREQ_LABEL", T.StringType()),
        T.StructField("SCALE_LABEL", T.StringType()),
        T.StructField("COUNTRY_UPDATE_DATE", T.TimestampNTZType()),
    ]
)
CONTRACT_COLUMNS = OBSERVATION_SCHEMA.fieldNames()

# Columns that come from the series metadata rather than from the observations.
METADATA_FIELDS = {
    "LASTACTUALDATE": T.IntegerType(),
    "NOTES": T.StringType(),
    "COUNTRY_UPDATE_DATE": T.TimestampNTZType(),
}
ALIGNED_COLUMNS = [c for c in CONTRACT_COLUMNS if c not in METADATA_FIELDS]

# Row identity of an observation within one release, and of a series.
OBSERVATION_KEYS = ["REF_AREA_CODE", "CONCEPT_CODE", "FREQ_CODE", "TIME_PERIOD"]
SERIES_METADATA_JOIN_KEYS = ("REF_AREA_CODE", "CONCEPT_CODE", "FREQ_CODE")

# Feed column -> contract column.
FEED_RENAMES = {
    "COUNTRY": "REF_AREA_CODE",
    "INDICATOR": "CONCEPT_CODE",
    "UNIT": "UNIT_CODE",
    "FREQUENCY": "FREQ_CODE",
    "SCALE": "SCALE_CODE",
}
SIDECAR_KEYS = ["COUNTRY", "INDICATOR", "FREQUENCY"]
SIDECAR_VALUES = ["LATEST_ACTUAL_ANNUAL_DATA", "METHODOLOGY_NOTES", "COUNTRY_UPDATE_DATE"]

# Never part of the series metadata, and withheld from its public form.
ENVELOPE_COLUMNS = ["STRUCTURE", "STRUCTURE_ID", "ACTION", "TIME_PERIOD", "OBS_VALUE"]
PRIVATE_METADATA_COLUMNS = ["COUNTRY_UPDATE_DATE", "UNIT", "SCALE"]

# Scale exponent -> label, and scale exponent -> multiplier.
SCALE_NAME_BY_EXPONENT = {0: "Units", 6: "Millions", 9: "Billions"}
MULTIPLIER_BY_EXPONENT = {0: 1, 6: 1_000_000, 9: 1_000_000_000}

# Cell texts that mean "missing" in an observation file.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Bulk archive: attributes of a series and of an observation, and the code list of each coded one.
BULK_SERIES_ATTRIBUTES = [
    "UNIT", "CONCEPT", "REF_AREA", "FREQ", "LASTACTUALDATE", "SCALE", "NOTES",
]
BULK_OBS_ATTRIBUTES = ["TIME_PERIOD", "OBS_VALUE"]
BULK_CODELISTS = {
    "UNIT": "IMF.CL_WEO_UNIT.1.0",
    "CONCEPT": "IMF.CL_WEO_CONCEPT.1.0",
    "REF_AREA": "IMF.CL_WEO_REF_AREA.1.0",
    "FREQ": "IMF.CL_FREQ.1.0",
    "SCALE": "IMF.CL_WEO_SCALE.1.0",
}
BULK_REALS = ["OBS_VALUE"]
BULK_WHOLE_NUMBERS = {
    "REF_AREA_CODE": "int",
    "SCALE_CODE": "bigint",
    "LASTACTUALDATE": "int",
    "TIME_PERIOD": "int",
}

# Code lists the observation labels are read from: contract prefix -> (agency, code list).
LABEL_CODELISTS = {
    "REF_AREA": ("IMF.RES", "CL_WEO_COUNTRY"),
    "CONCEPT": ("IMF.RES", "CL_WEO_INDICATOR"),
    "UNIT": ("IMF", "CL_UNIT"),
    "FREQ": ("IMF", "CL_FREQ"),
}

CODELIST_SCHEMA = "agency string, codelist_id string, code string, label string"
AREA_MAP_SCHEMA = "legacy int, code string"
UNIT_MAP_SCHEMA = "concept string, letter string, unit string"
LABEL_SCHEMA = "code string, label string"
HOLDINGS_SCHEMA = "entity string, indicator string, value double, date date"

# Releases, and the two flavours they come in.
RELEASE_MONTHS = ("April", "October")
MAX_ROLL_BACK = 3

# Every bulk release published, and those whose published archive is corrupt.
BULK_RELEASES = [
    ("April", 2019), ("October", 2019), ("April", 2020), ("October", 2020), ("April", 2021),
    ("October", 2021), ("April", 2022), ("October", 2022), ("April", 2023), ("October", 2023),
    ("April", 2024), ("October", 2024), ("April", 2025),
]
CORRUPT_RELEASES = [("April", 2021), ("October", 2023)]
