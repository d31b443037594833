"""Counts of every micro-batch while the streams run: rows, rejects, rows without a time, rows too late.

``observe_reports`` lets Spark count within the batch's own job (no further pass); a listener writes what each query
reports of each batch, one small file a batch and query, named after them, so a repeated batch replaces its counts.
Rows behind the watermark are counted by the pane sink report by report; a stateful query tells how many partial rows it dropped.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from contrail.functions.scalars import out_of_units
from contrail.schemas import FLIGHT_FIELDS
from contrail.streaming.sinks import file_system

NAME = "reports"
SCHEMA = ("query string, batch_id bigint, run string, time string, input_rows bigint, rows bigint, rejected bigint, untimed bigint, "
          "out_of_range bigint, state_dropped bigint, late bigint, partly_late bigint")
_COUNTS = ("rows", "rejected", "untimed", "out_of_range")


def rejected_message() -> Column:
    """A message of which nothing could be read: bad JSON, or none of the fields in it."""
    return F.coalesce(*[F.col(f).cast("string") for f in FLIGHT_FIELDS]).isNull()


def observe_reports(reports: DataFrame) -> DataFrame:
    """Decoded reports whose batches are counted: rows, rejected messages, reports without a time, values out of range."""
    strange = out_of_units("baro_altitude") | out_of_units("velocity")
    return reports.observe(NAME, F.count(F.lit(1)).alias("rows"), F.count_if(rejected_message()).alias("rejected"),
                           F.count_if(~rejected_message() & F.col("last_contact").isNull()).alias("untimed"), F.count_if(strange).alias("out_of_range"))


class BatchMetrics(StreamingQueryListener):
    """Writes the counts of each batch of each named query under ``path``; ``stop`` takes it off the session again."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")
        spark.streams.addListener(self)

    def stop(self) -> None:
        self.spark.streams.removeListener(self)

    def write(self, kind: str, query: str, batch_id: int, **counts) -> None:
        fs, target = file_system(self.spark, f"{self.path}/{kind}/{query}-{batch_id:012d}.json")
        out = fs.create(target, True)
        out.write(bytearray(json.dumps({"query": query, "batch_id": batch_id, **counts}).encode()))
        out.close()

    def late(self, query: str) -> Callable[[int, int, int], None]:
        """A callback for ``write_panes``: batch id, reports that no window took, reports that some windows did not take."""
        return lambda batch_id, late, partly: self.write("late", query, batch_id, late=late, partly_late=partly)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(NAME)
        if not p.name or seen is None or not p.numInputRows:
            return  # not one of ours, or a batch without data
        self.write("batches", query_name(p.name), p.batchId, run=str(p.runId), time=p.timestamp, input_rows=p.numInputRows,
                   state_dropped=sum(s.numRowsDroppedByWatermark for s in p.stateOperators), **{c: seen[c] for c in _COUNTS})


def query_name(name: str) -> str:
    """``contrail_live_1402`` -> ``live``: the name that a query keeps over restarts."""
    parts = name.split("_")
    return parts[1] if len(parts) == 3 and parts[0] == "contrail" and parts[2].isdigit() else name


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row for each query and batch (SCHEMA); ``late`` and ``partly_late`` are null but for the pane sink."""
    def part(kind: str) -> DataFrame:
        fs, at = file_system(spark, f"{path.rstrip('/')}/{kind}")
        return spark.read.schema(SCHEMA).json(f"{path.rstrip('/')}/{kind}") if fs.exists(at) else spark.createDataFrame([], SCHEMA)
    late = part("late").select("query", "batch_id", "late", "partly_late")
    return part("batches").drop("late", "partly_late").join(late, ["query", "batch_id"], "left")
