"""Session helpers: a local session for tests/bench and a shared scratch area.

On a cluster the scratch area is the folder named by ``spark.checkpoint.dir``
(shared storage). Only when that is unset (tests, local runs) do we create a
local temporary folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "contrail") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CONTRAIL_DRIVER_MEMORY", "8g"))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether everything runs in this process (``local-cluster`` does not)."""
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    In local mode an unset one becomes a temporary folder (scratch tables stay there until the
    system clears it). On a cluster that would be another disk for each executor, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="contrail-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/contrail-scratch/{name}-{uuid.uuid4().hex[:12]}"


def ensure_utc(spark: SparkSession) -> None:
    """Epoch-second columns are UTC; formatted times assume a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


class session_conf:
    """Temporarily set SQL confs on a session (restored on exit)."""

    def __init__(self, spark: SparkSession, **conf: str):
        self.spark = spark
        self.conf = {k.replace("__", "."): str(v) for k, v in conf.items()}
        self.saved: dict[str, str | None] = {}

    def __enter__(self):
        for k, v in self.conf.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self.spark

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def stream_partitions(spark: SparkSession) -> int:
    """Shuffle/state partitions for micro-batches, fixed in a stateful query's checkpoint at its first start.

    Micro-batches run without AQE, so the count is used as is. In local mode it is the number of
    task slots, known from the start. On a cluster executors may still be registering, so the
    session's ``spark.sql.shuffle.partitions`` decides, with the slots seen so far as the least.
    """
    slots = max(1, int(spark.sparkContext.defaultParallelism))
    return slots if is_local(spark) else max(slots, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """The rows in even ranges of ``by``, over as many tasks as a micro-batch has (a file of few row groups is read by few)."""
    return df.repartitionByRange(stream_partitions(df.sparkSession), *by)
