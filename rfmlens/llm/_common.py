"""Small shared helpers: table access, shared-folder writes, folds."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage so that a lost executor costs a re-read.  The folder lies
    below the one named by ``spark.checkpoint.dir``.  The shuffle files of the
    write go when it has ended: nothing reads them after that.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of two 64-bit columns that may be broadcast (about 40 MB in memory).
BROADCAST_ROWS = 1_000_000


def small_side(ids: DataFrame) -> DataFrame:
    """``ids`` (at most two 64-bit columns) written and counted: broadcast up
    to ``BROADCAST_ROWS`` rows, so that the texts it is joined with stay where
    they are; beyond that Spark joins by shuffle."""
    ids = written(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def fold(doc_id: str | Column, k: int) -> Column:
    """crc32(doc_id as text) mod k."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(k)


def hash_share(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of the whole table (all, if it has fewer), by key hash."""
    n = df.count()
    h = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    return df if n <= rows else df.where(h < F.lit((rows << 40) // n))


def hash_sample(df: DataFrame, key: str, strata: str, rows: int) -> DataFrame:
    """About ``rows`` rows of each stratum (all, if it has fewer), by key hash.

    One count per stratum gives its share; rows whose key hash falls under
    that share are taken, so the sample spreads over the whole table, is the
    same in every run and needs no sort.
    """
    counts = {r[0]: r[1] for r in df.groupBy(strata).count().collect()}
    h = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    share = F.lit(0)
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        if value is not None:
            share = F.when(F.col(strata) == F.lit(value),
                           F.lit(min(1 << 40, (rows << 40) // n))).otherwise(share)
    return df.where(h < share)
