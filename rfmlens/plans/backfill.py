"""A8 for any chain of day tables: run a range of days, skip what is up to date.

The inputs of a day are fingerprinted - rows and an order-independent hash per
input day, one aggregation per input over the whole range - and a day's own
fingerprint covers every input day its windows read.  It is kept beside the
written days; a day is run only where it has changed, in date order, and a run
that dies has recorded exactly the days it finished.  So a correction of one
past day reruns that day and those whose windows hold it, and a second run
writes nothing.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windowed import window_days

FINGERPRINTS = "fingerprints"
SCHEMA = T.StructType([T.StructField("chain", T.StringType()), T.StructField("day", T.StringType()),
                       T.StructField("fingerprint", T.StringType()), T.StructField("version", T.LongType())])


def day_fingerprints(df: DataFrame, day: str | None, days: Sequence[str] | None = None) -> dict[str, str]:
    """Day -> rows and hash of the input's rows of that day ("" for an input
    without days).  A handful of numbers per day; rows stay where they are."""
    when = F.lit("") if day is None else F.col(day).cast("string")
    rows = df.select(when.alias("d"), F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h"))
    if days is not None and day is not None:
        rows = rows.where(F.col("d").between(min(days), max(days)))
    return {r["d"]: f"{r['n']}:{r['h']}" for r in
            rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).collect()}


def recorded(spark: SparkSession, root: str, chain: str) -> dict[str, str]:
    """Day -> fingerprint of its last finished run."""
    path = f"{root}/{FINGERPRINTS}"
    try:
        entries = spark.read.schema(SCHEMA).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}                                # nothing recorded yet
    newest = (entries.where(F.col("chain") == chain).groupBy("day")
              .agg(F.max(F.struct("version", "fingerprint")).alias("v")))
    return {r["day"]: r["v"]["fingerprint"] for r in newest.collect()}


def record(spark: SparkSession, root: str, chain: str, day: str, fingerprint: str) -> None:
    row = [(chain, day, fingerprint, time.time_ns())]
    spark.createDataFrame(row, SCHEMA).coalesce(1).write.parquet(f"{root}/{FINGERPRINTS}/entry={uuid.uuid4().hex}")


def range_run(spark: SparkSession, root: str, chain: str, days: Sequence[str], window: int,
              inputs: Mapping[str, tuple[DataFrame, str | None]], run: Callable[[list[str]], None],
              together: int = 1) -> list[str]:
    """Run ``run(days)`` for the days of ``chain`` whose inputs have changed,
    oldest first, up to ``together`` days in one call; returns the days run.

    ``inputs``: name -> (frame, day column or None); ``window``: how many days a
    day's run reads, itself included.
    """
    reach = sorted({d for day in days for d in window_days(day, window)})
    seen = {n: day_fingerprints(df, col, reach) for n, (df, col) in inputs.items()}
    dated = {n: col is not None for n, (_, col) in inputs.items()}
    done, todo = recorded(spark, root, chain), []
    for day in sorted(days):
        read = window_days(day, window)
        parts = {n: [fp.get(d) for d in read] if dated[n] else fp.get("") for n, fp in seen.items()}
        mark = hashlib.sha256(json.dumps([window, parts], sort_keys=True).encode()).hexdigest()
        if done.get(day) != mark:
            todo.append((day, mark))
    for i in range(0, len(todo), together):
        some = todo[i:i + together]
        run([d for d, _ in some])
        for d, mark in some:
            record(spark, root, chain, d, mark)
    return [d for d, _ in todo]
