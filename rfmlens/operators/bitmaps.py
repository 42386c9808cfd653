"""G5 / G6 by exact, mergeable bitmaps.

A distinct count cannot be added up over days; a set can.  The ids of a group
are kept as bitmaps of 32,768 bits (one per bucket of consecutive ids; Spark's
``bitmap_*`` functions), so that days, vip classes or levels are united by OR
and counted by their bits.  Every step is a hash aggregate with map-side
combine: a hot group is reduced to at most one bitmap per bucket in each task
before the shuffle, and its buckets spread over the tasks after it.

Ids must be integers.  Dense ids make small tables (a bitmap of few members
compresses to a few bytes each, but takes 4 KB in memory).  NULL ids count for
nothing, as in ``count(distinct)``; a group of NULL ids only has count 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], ident: str) -> DataFrame:
    """``keys``, bucket, members: the set of ``ident`` of every group."""
    if not isinstance(df.schema[ident].dataType, T.IntegralType):
        raise TypeError(f"{ident}: bitmaps need integer ids")
    c = F.col(ident).cast("long")
    return (df.groupBy(*keys, F.bitmap_bucket_number(c).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("members")))


def unite(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets over all columns but ``keys``."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def members(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """The size of each group's set; the bitmaps must be one per (keys, bucket)."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("members")).alias(out))


def distinct_members(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Exact distinct count per ``keys``, over all other columns of ``bitmaps``."""
    return members(unite(bitmaps, keys), keys, out)


def avg_daily(bitmaps: DataFrame, day: str, keys: Sequence[str], out: str) -> DataFrame:
    """Members per (day, keys), then the average over the days that have any row."""
    daily = distinct_members(bitmaps, [day, *keys], "__n")
    return daily.groupBy(*keys).agg(F.avg("__n").alias(out))
