"""Schemas, column lists and fixed values of the trace data model.

Everything here is declared explicitly: no reader in this package infers a
schema (hex ids such as ``7380e5`` would otherwise turn into floats).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the trace format's definitions.
# ---------------------------------------------------------------------------

# Top-level document keys copied onto every point, in output order.
TOP_LEVEL_KEYS = ["icao", "timestamp", "r", "t", "desc", "dbFlags", "year", "ownOp"]

# Trace entry positions 0..13, in array order.
TRACE_COLUMNS = [
    "seconds_after_timestamp",
    "latitude",
    "longitude",
    "altitude_ft",
    "ground_speed_kts",
    "track_deg",
    "flags_bitfield",
    "vertical_rate_fpm",
    "aircraft_metadata",
    "source_type",
    "geometric_altitude_ft",
    "geometric_vertical_rate_fpm",
    "indicated_airspeed_kts",
    "roll_angle_deg",
]

# The 23 point columns, in file order: top-level keys, datetime, trace columns.
POINT_COLUMNS = TOP_LEVEL_KEYS + ["datetime_utc"] + TRACE_COLUMNS

# Leading columns of a window table (the rest follow in existing order).
WINDOW_FRONT_COLUMNS = [
    "datetime_utc",
    "icao",
    "latitude",
    "longitude",
    "altitude_ft",
    "geometric_altitude_ft",
    "track_deg",
    "flags_bitfield",
]

# Columns a window run needs before it can start.
WINDOW_REQUIRED_COLUMNS = ["timestamp", "seconds_after_timestamp", "icao"]

# flags_bitfield bits (trace entry index 6).
FLAG_STALE = 1
FLAG_NEW_LEG = 2
FLAG_GEOM_RATE = 4
FLAG_GEOM_ALT = 8

# dbFlags bits (document level).
DBFLAG_MILITARY = 1
DBFLAG_INTERESTING = 2
DBFLAG_PIA = 4
DBFLAG_LADD = 8

# Near-region box (degrees, inclusive bounds): lat 01°30'N..02°30'N,
# lon 104°36'E..106°00'E.
NEAR_REGION = {"lat_min": 1.5, "lat_max": 2.5, "lon_min": 104.6, "lon_max": 106.0}

# Ours: bounds of the ground/air state machine (feet, knots, feet a minute).
NEAR_ZERO_FT, AIR_FT = 200, 500
SLOW_KTS, FAST_KTS = 40, 80
LEVEL_FPM, CLIMB_FPM = 300, 500

# Offset of the study's local time (GMT+8) from UTC, in hours.
LOCAL_UTC_OFFSET_HOURS = 8

# Release tag format and the years that have a release repository.
RELEASE_TAG_SUFFIX = "-planes-readsb-prod-0"
RELEASE_YEARS = [2024, 2025]

# Asset suffix rules: ".tar" or ".tar.<two letters>" accepted, these rejected first.
ASSET_IGNORED_SUFFIXES = [".tar.gz", ".zip"]
ASSET_ACCEPT_PATTERN = r"\.tar(\.[a-z]{2})?$"
ASSET_HOST = "https://github.com"

# Number of colours in the track palette (index = first-appearance rank mod 20).
PALETTE_SIZE = 20

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

# A trace document as parsed from JSON. ``trace`` stays ARRAY<STRING>: one
# malformed entry then nulls only itself, not the whole trace.
DOC_SCHEMA = T.StructType(
    [
        T.StructField("icao", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("r", T.StringType()),
        T.StructField("t", T.StringType()),
        T.StructField("desc", T.StringType()),
        T.StructField("dbFlags", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("ownOp", T.StringType()),
        T.StructField("trace", T.ArrayType(T.StringType())),
    ]
)

# Same document with the trace typed as arrays of element texts (fast path;
# null as a whole when any entry is not an array).
DOC_SCHEMA_NESTED = T.StructType(
    [f for f in DOC_SCHEMA.fields if f.name != "trace"]
    + [T.StructField("trace", T.ArrayType(T.ArrayType(T.StringType()))),
       T.StructField("_corrupt_record", T.StringType())]
)

# Raw-entry schema plus the corrupt-record column (document status only).
DOC_SCHEMA_STATUS = T.StructType(DOC_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])

# The 23 point columns as typed columns (CSV interchange schema).
POINT_SCHEMA = T.StructType(
    [
        T.StructField("icao", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("r", T.StringType()),
        T.StructField("t", T.StringType()),
        T.StructField("desc", T.StringType()),
        T.StructField("dbFlags", T.IntegerType()),
        T.StructField("year", T.StringType()),
        T.StructField("ownOp", T.StringType()),
        T.StructField("datetime_utc", T.StringType()),
        T.StructField("seconds_after_timestamp", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("altitude_ft", T.StringType()),
        T.StructField("ground_speed_kts", T.DoubleType()),
        T.StructField("track_deg", T.DoubleType()),
        T.StructField("flags_bitfield", T.IntegerType()),
        T.StructField("vertical_rate_fpm", T.IntegerType()),
        T.StructField("aircraft_metadata", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("geometric_altitude_ft", T.IntegerType()),
        T.StructField("geometric_vertical_rate_fpm", T.IntegerType()),
        T.StructField("indicated_airspeed_kts", T.DoubleType()),
        T.StructField("roll_angle_deg", T.DoubleType()),
    ]
)

# Optional fields of the aircraft metadata snapshot (entry index 8).
METADATA_SCHEMA = T.StructType(
    [
        T.StructField("hex", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("flight", T.StringType()),
        T.StructField("alt_baro", T.StringType()),
        T.StructField("alt_geom", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("gs", T.DoubleType()),
        T.StructField("ias", T.DoubleType()),
        T.StructField("tas", T.DoubleType()),
        T.StructField("mach", T.DoubleType()),
        T.StructField("track", T.DoubleType()),
        T.StructField("track_rate", T.DoubleType()),
        T.StructField("roll", T.DoubleType()),
        T.StructField("mag_heading", T.DoubleType()),
        T.StructField("true_heading", T.DoubleType()),
        T.StructField("baro_rate", T.DoubleType()),
        T.StructField("geom_rate", T.DoubleType()),
        T.StructField("squawk", T.StringType()),
        T.StructField("emergency", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("alert", T.IntegerType()),
        T.StructField("spi", T.IntegerType()),
        T.StructField("nav_qnh", T.DoubleType()),
        T.StructField("nav_altitude_mcp", T.DoubleType()),
        T.StructField("nav_altitude_fms", T.DoubleType()),
        T.StructField("nav_heading", T.DoubleType()),
        T.StructField("nav_modes", T.ArrayType(T.StringType())),
        T.StructField("nic", T.IntegerType()),
        T.StructField("nic_baro", T.IntegerType()),
        T.StructField("nac_p", T.IntegerType()),
        T.StructField("nac_v", T.IntegerType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("sil", T.IntegerType()),
        T.StructField("sil_type", T.StringType()),
        T.StructField("gva", T.IntegerType()),
        T.StructField("sda", T.IntegerType()),
        T.StructField("rc", T.IntegerType()),
        T.StructField("mlat", T.ArrayType(T.StringType())),
        T.StructField("tisb", T.ArrayType(T.StringType())),
        T.StructField("messages", T.LongType()),
        T.StructField("seen", T.DoubleType()),
        T.StructField("seen_pos", T.DoubleType()),
        T.StructField("rssi", T.DoubleType()),
        T.StructField("wd", T.DoubleType()),
        T.StructField("ws", T.DoubleType()),
        T.StructField("oat", T.DoubleType()),
        T.StructField("tat", T.DoubleType()),
    ]
)
