"""Scalar column functions: keys, cleaning, codecs, units, severity, labels.

All are built-in Spark expressions (JVM side, inside whole-stage codegen);
none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "REVERSE_EPOCH_BASE", "DESCENT_THRESHOLD", "CRITICAL_THRESHOLD", "KNOTS_PER_MS",
    "FPM_PER_MS", "FEET_PER_M", "clean_callsign", "aircraft_key", "country_key",
    "reverse_epoch", "row_key", "key_head", "event_time", "epoch_seconds", "in_units", "out_of_units", "unit_sums", "units_of", "half_up",
    "severity", "gauge_band", "encode_number", "encode_bool", "decode_number",
    "decode_int", "decode_bool", "rejected", "point_label", "to_knots", "to_fpm", "to_feet", "blank",
]

# Fixed values used by the result keys and the alert panels.
REVERSE_EPOCH_BASE = 9999999999
DESCENT_THRESHOLD = -15.0      # m/s, strict "<"
CRITICAL_THRESHOLD = -30.0     # m/s, strict "<"
KNOTS_PER_MS = 1.944
FPM_PER_MS = 196.85
FEET_PER_M = 3.281
GAUGE_STEPS = [(0, 20, "low"), (20, 35, "elevated"), (35, 60, "severe")]
GAUGE_MARKER = 30.0
UNITS = 100_000_000
UNITS_LIMIT = 9.0e10  # beyond, a value in units does not fit a bigint
UNIT_BITS = 24


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c) -> Column:
    """``x or ""`` for strings: null becomes the empty string."""
    return F.coalesce(_c(c), F.lit(""))


def clean_callsign(c) -> Column:
    """``(callsign or "").strip()``: strips spaces, tabs and newlines at both ends."""
    return F.regexp_replace(blank(c), r"^\s+|\s+$", "")


def aircraft_key(c="icao24") -> Column:
    """Row key of the per-aircraft tables: null or empty address -> ``unknown``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit("unknown"))


def country_key(c="origin_country") -> Column:
    """Country part of the aggregate key: null/empty -> ``UNKNOWN``, ``|`` -> ``_``."""
    return F.replace(F.coalesce(F.nullif(_c(c), F.lit("")), F.lit("UNKNOWN")), F.lit("|"), F.lit("_"))


def reverse_epoch(ts) -> Column:
    """``9999999999 - ts`` (missing ts counts as 0) so newer sorts first."""
    return F.lit(REVERSE_EPOCH_BASE) - F.coalesce(_c(ts), F.lit(0)).cast("long")


def row_key(head, ts) -> Column:
    return F.concat(_c(head), F.lit("|"), reverse_epoch(ts).cast("string"))


def key_head(key) -> Column:
    """First ``|``-separated part of a composite row key."""
    return F.split_part(_c(key), F.lit("|"), F.lit(1))


def event_time(c="last_contact") -> Column:
    """Epoch seconds -> TIMESTAMP (the watermark column)."""
    return F.timestamp_seconds(_c(c))


def epoch_seconds(ts) -> Column:
    return F.unix_timestamp(_c(ts))


def in_units(c) -> Column:
    """A double as a whole number (bigint) of 1e-8 units; null if there is no such number (NaN, or from 9e10 on)."""
    return F.when(F.abs(_c(c)) < UNITS_LIMIT, F.floor(_c(c) * float(UNITS) + 0.5))


def out_of_units(c) -> Column:
    """Whether a value is there but has no whole number of units, so that no sum counts it."""
    return _c(c).isNotNull() & in_units(c).isNull()


def unit_sums(c, name: str) -> list[Column]:
    """Sum of a double in two bigints (``name_hi`` of 2**24 units, ``name_lo``) and ``name_n``, the count of values summed.

    Exact whatever order rows come in, without an object a row; hi and lo add up over partial results. Together they
    hold the sum of 5e11 values of any size up to 18,000 (m or m/s), of fewer larger ones in proportion.
    """
    u = in_units(c)
    return [F.sum(F.shiftright(u, UNIT_BITS)).alias(f"{name}_hi"), F.sum(u.bitwiseAND(F.lit((1 << UNIT_BITS) - 1))).alias(f"{name}_lo"), F.count(u).alias(f"{name}_n")]


def units_of(name: str) -> Column:
    """The sum held by ``name_hi`` and ``name_lo``, as a decimal."""
    return (F.col(f"{name}_hi").cast("decimal(28,0)") * F.lit(1 << UNIT_BITS) + F.col(f"{name}_lo")).cast("decimal(38,0)")


def half_up(units: str, n: str) -> Column:
    """``units`` (decimal column of 1e-8 units) / ``n``, rounded half-up to 2 dp in whole numbers; 0 if n is 0 or null."""
    step = UNITS // 100
    return F.expr(f"CASE WHEN {n} > 0 THEN sign({units}) * CAST((2 * abs({units}) + {n} * {step}BD) div (2 * {n} * {step}BD) AS DOUBLE)"
                  f" / 100D + 0D ELSE 0D END")


def severity(vrate) -> Column:
    return F.when(_c(vrate) < CRITICAL_THRESHOLD, "CRITICAL").otherwise("WARNING")


def gauge_band(abs_rate) -> Column:
    e = None
    for lo, hi, name in GAUGE_STEPS:
        cond = _c(abs_rate) < hi
        e = F.when(cond, name) if e is None else e.when(cond, name)
    return e.otherwise("off_scale")


def to_knots(ms) -> Column:
    return F.bround(_c(ms) * KNOTS_PER_MS, 0)


def to_fpm(ms) -> Column:
    return F.bround(_c(ms) * FPM_PER_MS, 0)


def to_feet(m) -> Column:
    return F.bround(_c(m) * FEET_PER_M, 0)


# --- cell codec: the text form of the keyed store ---------------------------

def encode_number(c) -> Column:
    """``str(x or "")``: null and zero both become the empty cell."""
    x = _c(c)
    return F.when(x.isNull() | (x == 0), F.lit("")).otherwise(x.cast("string"))


def encode_bool(c) -> Column:
    """``str(flag)``: ``True`` / ``False`` / ``None``."""
    x = _c(c)
    return F.when(x.isNull(), "None").when(x, "True").otherwise("False")


def decode_number(c) -> Column:
    """Missing, empty or unparsable cell -> 0.0."""
    return F.coalesce(F.nullif(_c(c), F.lit("")).try_cast("double"), F.lit(0.0))


def decode_int(c) -> Column:
    """Missing, empty or unparsable cell -> 0; a fraction does not parse as a whole number."""
    return F.coalesce(_whole(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def decode_bool(c) -> Column:
    """A missing or empty flag cell reads as ``True``; otherwise only the text ``True`` does."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit("True")) == "True"


def rejected(c, kind: str = "double") -> Column:
    """Whether a cell holds text that does not decode as ``double`` or ``bigint``."""
    x = _whole(c) if kind == "bigint" else _c(c)
    return (F.coalesce(_c(c), F.lit("")) != "") & x.try_cast(kind).isNull()


def _whole(c) -> Column:
    return F.when(_c(c).rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(_c(c)))


def point_label(callsign, icao24, altitude, velocity, country) -> Column:
    """Map hover text (a fixed template): callsign (else address), altitude and speed (0 dp), country."""
    def whole(x):
        return F.bround(_c(x), 0).cast("long")
    return F.format_string(
        "%s<br>Alt: %d m<br>Speed: %d m/s<br>%s",
        F.coalesce(F.nullif(_c(callsign), F.lit("")), _c(icao24)),
        whole(altitude), whole(velocity), blank(country),
    )
