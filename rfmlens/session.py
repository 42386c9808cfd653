"""Spark session defaults and shared-folder resolution.

Library code never creates its own session: every function takes the
caller's ``SparkSession`` (or a DataFrame).  ``local_session`` exists for
tests, the bench and ad-hoc runs on one machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every run relies on; safe on a cluster as well.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

# Local runs only: remove checkpoint files once their frames are unreachable.
LOCAL_ONLY_CONF = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}

# Conf key (ours) for the folder of the day-partitioned tables.
TABLE_ROOT_KEY = "rfmlens.table.root"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cpus}]")
         .appName("rfmlens")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("RFMLENS_DRIVER_MEMORY", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**BASE_CONF, **LOCAL_ONLY_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the run settings on an existing session (idempotent)."""
    for k, v in BASE_CONF.items():
        if k == "spark.ui.enabled":
            continue  # static; only settable at start-up
        spark.conf.set(k, v)


# Fact rows that one shuffle task may get.  A call base entry takes about 700
# bytes in a task's hash table, so this is about 350 MB.
TASK_ROWS = 500_000
INITIAL_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_KEY = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let AQE choose among enough shuffle partitions for ``rows`` fact rows and
    not merge them into fewer tasks than the rows need, however many partitions
    the session has, so that a task's part does not grow with the table.  Small
    shuffles are still coalesced."""
    tasks = -(-rows // TASK_ROWS)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if tasks > min(partitions, spark.sparkContext.defaultParallelism):
        spark.conf.set(INITIAL_KEY, str(max(partitions, 2 * tasks)))
        spark.conf.set(LEAST_KEY, str(tasks))
    else:
        spark.conf.unset(INITIAL_KEY)
        spark.conf.unset(LEAST_KEY)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  A local session that names none gets a fresh scratch
    folder; on a cluster that is an error, as executors would not see it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        d = tempfile.mkdtemp(prefix="rfmlens-ckpt-")
    if not (sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None):
        sc.setCheckpointDir(d)
    return str(d).rstrip("/")


def cut_lineage(df):
    """Materialize ``df`` as a Parquet table in the shared folder.

    Used at stage boundaries: downstream plans start from a columnar file
    scan (reading only their columns, with filters pushed down), so every
    re-optimization works on a small plan, and a lost executor costs a
    re-read instead of a recomputation of the whole chain.
    """
    return write_once(df)


def table_root(spark: SparkSession) -> str:
    """The folder of the written tables, the same for every application.

    Named by ``rfmlens.table.root``; a session that leaves it out keeps them
    below its shared folder, for this application only.
    """
    root = spark.conf.get(TABLE_ROOT_KEY, None)
    return root.rstrip("/") if root else f"{shared_dir(spark)}/tables"


def write_once(df):
    """Write ``df`` as Parquet below the shared checkpoint folder and return a
    frame that reads it: columnar (consumers read the columns they need),
    pinned (row ids and ranges stay what they were), and re-read, not
    recomputed, when an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/once-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
