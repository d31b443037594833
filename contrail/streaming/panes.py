"""The sliding-window aggregate of a stream, kept as panes instead of windows.

Each micro-batch is reduced to partial sums by country and pane (a stretch of one slide) and appended to a
result table whose rows add up; the windows are put together from panes when they are read. So a report
is added to one sum instead of five (a batch of p minutes writes p rows a country instead of p + 4), there is no state
to repartition or restore, and the sink that writes the other tables writes the panes too, from one reading of the source.

Late reports follow the watermark rule of the stateful aggregate: a window that ended at or before the largest
event time of the batches before, less the delay, takes no more. A pane that some of its windows no longer take carries
that time in ``closed``; one that none of them takes is dropped and counted. The largest event time is read
back from the newest date's panes, and only from batches before the one at hand, so a replayed batch decides alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from contrail.operators.aggregate import (
    PANE_SUMS, WINDOW_LENGTH, WINDOW_SLIDE, country_panes, merge_sums, seconds_of, windows_of_panes,
)
from contrail.operators.enrich import DEFAULT_WATERMARK
from contrail.streaming.sinks import BATCH_COLUMN, NO_DATE, KeyedTable

_KEYS = ["country", "pane_start", "closed"]


def _merged() -> list[Column]:
    return [F.max("seen").alias("seen"), *merge_sums()]


def pane_table(path: str, compact_every: int | None = None) -> KeyedTable:
    """Panes by date: (country, pane_start, closed), the partial sums, and ``seen``, the largest event time in whole seconds."""
    names = [*_KEYS, "seen", *PANE_SUMS]
    schema = StructType([StructField(c, StringType() if c == "country" else LongType(), True) for c in names])
    return KeyedTable(path, _KEYS, (), names, compact_every, schema=schema, date_from="pane_start", merge=_merged)


def seen_before(spark: SparkSession, table: KeyedTable, batch_id: int) -> int | None:
    """The largest event time of the batches before ``batch_id``, from the panes of the newest dates only."""
    dates = sorted({e[2] for e in table.entries(spark) if e[1] < batch_id and e[2] not in (None, NO_DATE)})
    if not dates:
        return None
    newest = table.log(spark, since=dt.date.fromisoformat(dates[-1]))
    return newest.where(F.col(BATCH_COLUMN) < batch_id).agg(F.max("seen")).first()[0]


def write_panes(table: KeyedTable, batch: DataFrame, batch_id: int, delay: str = DEFAULT_WATERMARK,
                late_rows: Callable[[int, int, int], None] | None = None) -> None:
    """Append the panes of a micro-batch of reports with ``event_time`` (a sink for ``foreachBatch``).

    ``late_rows`` is told the batch id, the reports that no window took and those that some windows did not take.
    """
    size, step = seconds_of(WINDOW_LENGTH), seconds_of(WINDOW_SLIDE)
    # reports without a country are in no window, and as in the stateful stream their time does not count
    panes = country_panes(batch, extra=[F.max(F.unix_timestamp("event_time")).alias("seen")])
    seen = seen_before(batch.sparkSession, table, batch_id)
    closed = F.lit(None).cast("bigint")
    if seen is not None:
        late = seen - seconds_of(delay)
        gone = F.col("pane_start") + size <= late
        closed = F.when(F.col("pane_start") + step <= late, F.lit(late).cast("bigint"))
        if late_rows:
            lost = F.sum(F.when(gone, F.col("n")))
            counted = Observation()
            panes = panes.observe(counted, F.coalesce(lost, F.lit(0)).alias("late"),
                                  F.coalesce(F.sum(F.when(~gone & closed.isNotNull(), F.col("n"))), F.lit(0)).alias("partly"))
        panes = panes.where(F.col("pane_start") + size > late)
    table.write_batch(panes.withColumn("closed", closed), batch_id)
    if late_rows:
        told = counted.get if seen is not None else {"late": 0, "partly": 0}
        late_rows(batch_id, told["late"], told["partly"])


def windows_of_view(panes: DataFrame) -> DataFrame:
    """The window aggregate from a current view of the panes."""
    return windows_of_panes(panes, closed="closed")


def windows(spark: SparkSession, table: KeyedTable, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """The window aggregate from the panes, of the columns of ``country_window_agg``.

    ``since`` and ``until`` (inclusive) bound the dates on which windows start; a window reaches into the next date's panes.
    """
    day = dt.timedelta(days=1)
    found = windows_of_view(table.current(spark, since, until and until + day))
    start = F.to_date(F.timestamp_seconds("window_start"))
    if since is not None:
        found = found.where(start >= F.lit(since))
    return found if until is None else found.where(start <= F.lit(until))
