"""Small hand-made inputs for edge-case tests."""

from contrail.schemas import AIRCRAFT_SCHEMA, FLIGHT_FIELDS, FLIGHT_SCHEMA


def flight(**kw):
    base = dict.fromkeys(FLIGHT_FIELDS)
    base.update(kw)
    return tuple(base[f] for f in FLIGHT_FIELDS)


def flights_df(spark, rows):
    return spark.createDataFrame([flight(**r) for r in rows], FLIGHT_SCHEMA)


def aircraft_df(spark, rows):
    return spark.createDataFrame(rows, AIRCRAFT_SCHEMA)
