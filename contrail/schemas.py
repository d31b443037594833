"""Schemas of the message stream, the aircraft dimension and the result tables."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The flight message, one JSON object per aircraft per poll (all nullable),
# as the stream consumer reads it.
FLIGHT_SCHEMA = StructType([
    StructField("icao24", StringType(), True),
    StructField("callsign", StringType(), True),
    StructField("origin_country", StringType(), True),
    StructField("time_position", LongType(), True),
    StructField("last_contact", LongType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("baro_altitude", DoubleType(), True),
    StructField("on_ground", BooleanType(), True),
    StructField("velocity", DoubleType(), True),
    StructField("true_track", DoubleType(), True),
    StructField("vertical_rate", DoubleType(), True),
    StructField("geo_altitude", DoubleType(), True),
    StructField("squawk", StringType(), True),
    StructField("ingestion_ts", LongType(), True),
])

FLIGHT_FIELDS = [f.name for f in FLIGHT_SCHEMA.fields]

# The published message has three more fields, and this order.
EXTRA_SCHEMA = StructType([
    StructField("sensors", ArrayType(LongType()), True),
    StructField("spi", BooleanType(), True),
    StructField("position_source", LongType(), True),
])
MESSAGE_FIELDS = [
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude", "baro_altitude",
    "on_ground", "velocity", "true_track", "vertical_rate", "sensors", "geo_altitude", "squawk", "spi",
    "position_source", "ingestion_ts",
]

# Position of each field in a snapshot state vector.
STATE_SLOTS = {
    "icao24": 0, "callsign": 1, "origin_country": 2, "time_position": 3,
    "last_contact": 4, "longitude": 5, "latitude": 6, "baro_altitude": 7,
    "on_ground": 8, "velocity": 9, "true_track": 10, "vertical_rate": 11,
    "sensors": 12, "geo_altitude": 13, "squawk": 14, "spi": 15, "position_source": 16,
}
STATE_WIDTH = 17

# The aircraft dimension: header-named CSV, every column a string.
AIRCRAFT_COLUMNS = ["icao24", "registration", "manufacturername", "model", "typecode", "operator"]
AIRCRAFT_SCHEMA = StructType([StructField(c, StringType(), True) for c in AIRCRAFT_COLUMNS])
DIMENSION_COLUMNS = AIRCRAFT_COLUMNS[1:]

# Key columns of the result tables and the columns each keeps.
LIVE_COLUMNS = [
    "icao24", "callsign", "origin_country", "latitude", "longitude", "baro_altitude",
    "geo_altitude", "velocity", "true_track", "vertical_rate", "on_ground", "last_contact",
    "ingestion_ts", "operator", "model", "manufacturername", "typecode", "registration",
]
ENRICHED_COLUMNS = [
    "icao24", "callsign", "origin_country", "latitude", "longitude", "baro_altitude",
    "velocity", "vertical_rate", "on_ground", "last_contact",
    "operator", "model", "manufacturername", "typecode", "registration",
]
AGG_COLUMNS = ["country", "window_start", "window_end", "flight_count", "avg_alt", "max_alt", "avg_velocity"]
ALERT_COLUMNS = ["icao24", "ingestion_ts", "vrate", "alt", "callsign", "operator", "country", "ts"]

# Type of every result-table column: message and dimension fields keep theirs.
RESULT_TYPES = {f.name: f.dataType for f in FLIGHT_SCHEMA.fields + AIRCRAFT_SCHEMA.fields}
RESULT_TYPES.update({
    "country": StringType(), "window_start": LongType(), "window_end": LongType(), "flight_count": LongType(),
    "avg_alt": DoubleType(), "max_alt": DoubleType(), "avg_velocity": DoubleType(), "country_key": StringType(),
    "row_key": StringType(), "vrate": DoubleType(), "alt": DoubleType(), "ts": LongType(),
    "partition": IntegerType(), "offset": LongType(),
})


def table_schema(columns) -> StructType:
    """Schema of a result table with these columns (all nullable)."""
    return StructType([StructField(c, RESULT_TYPES[c], True) for c in columns])
