"""Event time, watermark, the stream-static enrichment join and row predicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType

from contrail.functions.scalars import DESCENT_THRESHOLD, event_time
from contrail.schemas import DIMENSION_COLUMNS

DEFAULT_WATERMARK = "2 minutes"
# Broadcast only a dimension proven to hold at most this many rows and bytes
# (every executor keeps one copy of the hashed build side).
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def with_event_time(df: DataFrame, watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    """Add ``event_time`` = TIMESTAMP of ``last_contact`` and (for streams) the watermark."""
    out = df.withColumn("event_time", event_time("last_contact"))
    if watermark and out.isStreaming:
        out = out.withWatermark("event_time", watermark)
    return out


def row_bytes(df: DataFrame) -> Column:
    """In-memory size of a row: 8-byte slot per field plus the bytes of variable-length values.

    Fixed-width values fit their slot; strings and binaries count their bytes,
    wide decimals 16, nested values the length of their JSON text.
    """
    size = F.lit(8 + 8 * len(df.schema.fields))
    for f in df.schema.fields:
        c, t = F.col(f.name), f.dataType
        if isinstance(t, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(t, DecimalType) and t.precision > 18:
            size = size + F.lit(16)
        elif isinstance(t, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return size


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's estimate of the size of ``df`` (for files: their bytes on disk), or None if it has none."""
    if getattr(df, "_jdf", None) is None:
        return None  # no JVM gateway (Spark Connect)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 62 else None  # Spark's stand-in for an unknown size is larger


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` by one two-phase aggregate: each task shuffles one row."""
    rows, nbytes = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return int(rows), int(nbytes)


def broadcast_bound_ok(dim: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, derived: bool = False) -> bool:
    """True when the dimension has at most ``max_rows`` rows and ``max_bytes`` bytes.

    A table whose files alone are several times larger than the bound is turned
    down without reading it, so what is measured, and what the check can cost,
    is bounded by ``max_bytes``. ``derived`` marks an aggregate of a large table,
    whose estimate is that of its input: it is always measured.
    """
    if not derived:
        estimate = estimated_bytes(dim)
        if estimate is not None and estimate > HOPELESS * max_bytes:
            return False
    rows, nbytes = measured_size(dim)
    return rows <= max_rows and nbytes <= max_bytes


# Files can be larger than the rows in memory (text formats); beyond this factor they are not measured.
HOPELESS = 4

# Salts for every key where hot keys cannot be counted first (a stream).
DEFAULT_SALTS = 16


def dimension_rows(aircraft: DataFrame, unique_dimension: bool = False) -> DataFrame:
    """The six dimension columns; one row per key (chosen deterministically) if ``unique_dimension``."""
    dim = aircraft.select("icao24", *DIMENSION_COLUMNS)
    if unique_dimension:
        # One row per key, chosen deterministically (largest metadata tuple).
        dim = dim.groupBy("icao24").agg(F.max(F.struct(*DIMENSION_COLUMNS)).alias("m")).select("icao24", "m.*")
    return dim


def join_strategy(aircraft: DataFrame, *, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                  unique_dimension: bool = False) -> str:
    """``broadcast`` if the dimension is within both bounds, else ``salted``.

    Decide once for a static dimension and pass the answer to ``enrich`` when
    the same plan is built repeatedly (e.g. a stream restarted per chunk).
    """
    dim = dimension_rows(aircraft, unique_dimension)
    return "broadcast" if broadcast_bound_ok(dim, max_broadcast_rows, max_broadcast_bytes) else "salted"


def enrich(df: DataFrame, aircraft: DataFrame, *, strategy: str = "auto",
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
           max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
           unique_dimension: bool = False) -> DataFrame:
    """Left outer equi-join on ``icao24``; unmatched reports keep null metadata.

    strategy: ``broadcast`` always hints the dimension (reference behaviour);
    ``auto`` broadcasts it behind the row and byte bounds and otherwise uses the
    salted join; ``salted`` splits hot keys and spreads null ones (see
    ``salted_left_join``); ``shuffle`` is a plain shuffle join (leaves skew to
    AQE's skew-join split), right where every key occurs once.
    A repeated dimension key fans reports out unless ``unique_dimension``.
    """
    dim = dimension_rows(aircraft, unique_dimension)
    if strategy == "auto":
        strategy = "broadcast" if broadcast_bound_ok(dim, max_broadcast_rows, max_broadcast_bytes) else "salted"
    if strategy == "broadcast":
        return df.join(F.broadcast(dim), on="icao24", how="left")
    if strategy == "salted":
        return salted_left_join(df, dim, "icao24")
    return df.join(dim, on="icao24", how="left")


def hot_keys(df: DataFrame, key: str, tasks: int, min_rows: int = 10_000) -> DataFrame:
    """(key, salts) of the keys with over twice a task's fair share of ``df``; at most ``tasks`` / 2 rows.

    One counting pass over the key column, combined map-side. A key gets as many
    salts as fair shares it holds, so its rows end up in parts of a fair share.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    share = max(min_rows, -(-total // max(1, tasks)))
    return (counts.where(F.col("_n") > 2 * share)
            .select(key, F.ceil(F.col("_n") / F.lit(float(share))).cast("int").alias("_salts")))


def salted_left_join(left: DataFrame, right: DataFrame, key: str, tasks: int | None = None,
                     min_rows: int = 10_000) -> DataFrame:
    """Left join on ``key`` in which neither a hot key nor null keys load one task.

    Only keys with over twice a task's share of ``left`` are salted (counted
    first; ``tasks`` defaults to the shuffle partitions): their rows are dealt
    over (key, salt) and their ``right`` rows repeated once a salt; all other
    right rows are there once. Rows with a null key match nothing and are dealt
    over made-up keys. The salt is a row's number within its input partition, so
    identical rows part too; files, Kafka offsets and written tables give the
    same numbers on a retry. In a stream, where keys cannot be counted first,
    every key gets ``DEFAULT_SALTS``.
    """
    spark = left.sparkSession
    number = F.monotonically_increasing_id()
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if left.isStreaming:
        salts = F.lit(DEFAULT_SALTS)
        lhs, rhs = left, right
    else:
        # at most tasks / 2 rows by construction
        hot = F.broadcast(hot_keys(left, key, tasks, min_rows))
        salts = F.coalesce(F.col("_salts"), F.lit(1))
        lhs, rhs = left.join(hot, key, "left"), right.join(hot, key, "left")
    lhs = lhs.withColumn("_number", number)
    joined_key = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\0null "), F.pmod(F.col("_number"), F.lit(16 * tasks))))
    lhs = lhs.select(*[F.col(c) for c in left.columns], joined_key.alias("_key"),
                     F.pmod(F.col("_number"), salts).cast("int").alias("_salt"))
    rhs = (rhs.where(F.col(key).isNotNull())
           .select(*[F.col(c) for c in right.columns if c != key], F.col(key).cast("string").alias("_key"),
                   F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")))
    return lhs.join(rhs, on=["_key", "_salt"], how="left").drop("_key", "_salt")


def descending_fast(threshold: float = DESCENT_THRESHOLD) -> Column:
    """Airborne (``on_ground`` is false, null excluded) and descending faster than the threshold."""
    return ((F.col("on_ground") == F.lit(False)) & F.col("vertical_rate").isNotNull()
            & (F.col("vertical_rate") < F.lit(threshold)))


def rapid_descent(df: DataFrame, threshold: float = DESCENT_THRESHOLD) -> DataFrame:
    """The reports that ``descending_fast`` holds for."""
    return df.where(descending_fast(threshold))


def fan_out_by_dimension(df: DataFrame, aircraft: DataFrame, *,
                         max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                         max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                         unique_dimension: bool = False) -> DataFrame:
    """The report rows exactly as the left join would multiply them, without metadata columns.

    For consumers that use no dimension column (the window aggregate) only a
    key's multiplicity matters. A broadcastable dimension is joined directly
    (its build side is pruned to ``icao24``). Otherwise only the keys that
    repeat are joined, and each matching report is repeated ``m`` times; the
    repeated-key set is tiny in practice and is itself broadcast behind the
    same bound, so the big side is never shuffled for the enrichment.
    """
    if unique_dimension:
        return df
    return fan_out_plan(aircraft, max_broadcast_rows=max_broadcast_rows, max_broadcast_bytes=max_broadcast_bytes)(df)


def fan_out_plan(aircraft: DataFrame, *, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> Callable[[DataFrame], DataFrame]:
    """``fan_out_by_dimension`` with the dimension measured now, once, for callers that use it for every micro-batch."""
    keys = aircraft.select("icao24")
    if broadcast_bound_ok(keys, max_broadcast_rows, max_broadcast_bytes):
        return lambda df: df.join(F.broadcast(keys), on="icao24", how="left")
    repeated = (keys.where(F.col("icao24").isNotNull()).groupBy("icao24")
                .agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > 1))
    small = broadcast_bound_ok(repeated, max_broadcast_rows, max_broadcast_bytes, derived=True)

    def repeat(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(repeated), on="icao24", how="left") if small else salted_left_join(df, repeated, "icao24")
        copies = F.explode(F.sequence(F.lit(1), F.coalesce(F.col("_m"), F.lit(1)).cast("int")))
        return joined.select("*", copies.alias("_copy")).drop("_m", "_copy")
    return repeat
