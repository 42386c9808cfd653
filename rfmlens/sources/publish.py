"""Several tables of one day published as one commit.

A wide table and the narrow tables served from it are written from one
materialised frame into fresh folders, which no reader looks at.  Then one
manifest file that names all of them is added; it appears by a single rename,
as any Spark output file does.  Readers follow the manifest: they see the old
version of every table or the new version of every table, never a mixture,
also when a run dies between two of the writes.  A day may be published again
at any time; the newest complete version counts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_once
from .sinks import conform, reject_counts

MANIFEST = "manifest"
MANIFEST_SCHEMA = T.StructType([T.StructField("day", T.StringType()), T.StructField("version", T.LongType()),
                                T.StructField("tables", T.ArrayType(T.StringType())),
                                T.StructField("folder", T.StringType())])


def publish(root: str, day: str, wide: DataFrame, serve: Mapping[str, Sequence[str]],
            name: str, schemas: Mapping[str, T.StructType] | None = None) -> dict[str, int]:
    """Write ``wide`` as table ``name`` and, from the same rows, each table of
    ``serve`` (its columns, distinct) for ``day``; then commit all of them.

    Tables with a declared schema are conformed to it; returned is the number
    of values that the casts turned into NULL, by table and column.
    """
    spark = wide.sparkSession
    rows = write_once(wide)
    folder = f"{root}/data/{uuid.uuid4().hex}"
    bad: dict[str, int] = {}
    frames = {name: rows} | {n: rows.select(*cols).distinct() for n, cols in serve.items()}
    for n, df in frames.items():
        schema = (schemas or {}).get(n)
        if schema is not None:
            bad |= {f"{n}.{c}": k for c, k in reject_counts(df, schema).items() if k}
            df = conform(df, schema)
        df.hint("rebalance").write.parquet(f"{folder}/{n}")
    commit(spark, root, day, list(frames), folder)
    return bad


def commit(spark: SparkSession, root: str, day: str, tables: Sequence[str], folder: str) -> None:
    """Add the manifest entry that makes the written tables visible.  Every entry
    has a folder of its own, so that publishes may run at the same time."""
    row = [(day, time.time_ns(), list(tables), folder)]
    (spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1)
     .write.parquet(f"{root}/{MANIFEST}/entry={uuid.uuid4().hex}"))


def committed(spark: SparkSession, root: str) -> DataFrame:
    """day, table, version, folder: the newest version of each table and day."""
    entries = (spark.read.schema(MANIFEST_SCHEMA).option("basePath", f"{root}/{MANIFEST}")
               .parquet(f"{root}/{MANIFEST}"))
    return (entries.withColumn("table", F.explode("tables")).groupBy("day", "table")
            .agg(F.max(F.struct("version", "folder")).alias("v")).select("day", "table", "v.*"))


def read_published(spark: SparkSession, root: str, table: str, days: Sequence[str],
                   day_col: str = "dt") -> DataFrame:
    """The committed rows of ``table`` for the given days, with their day.

    The manifest entries of the asked days (a short list the caller holds) name
    the folders; nothing else is listed or read.
    """
    found = (committed(spark, root).where((F.col("table") == table) & F.col("day").isin(list(days)))
             .select("day", "folder").collect())
    if not found:
        raise LookupError(f"{table}: no published day among {list(days)}")
    out = None
    for r in sorted(found):
        part = spark.read.parquet(f"{r.folder}/{table}").withColumn(day_col, F.lit(r.day))
        out = part if out is None else out.unionByName(part)
    return out
