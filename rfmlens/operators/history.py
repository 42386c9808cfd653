"""A3 on a versioned table: the rows up to a cut-off day, the latest version
of each key, and the version valid on a record's own day.

A version is valid from its day until the next version of the same key.
Versions dated after the cut-off have no effect.  Days compare as they are
(dates, or strings in ISO form).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def up_to(versions: DataFrame, day: str, day_col: str = "dt") -> DataFrame:
    return versions.where(F.col(day_col) <= F.lit(day).cast(versions.schema[day_col].dataType))


def snapshot_distinct(versions: DataFrame, day: str, cols: Sequence[str], key: str = "user_id",
                      sentinel=-1, day_col: str = "dt") -> DataFrame:
    """Every distinct row up to ``day``, without the sentinel id; a key with
    two different rows keeps both (Q10)."""
    return up_to(versions, day, day_col).where(F.col(key) != sentinel).select(key, *cols).distinct()


def snapshot_latest(versions: DataFrame, day: str, cols: Sequence[str], key: str = "user_id",
                    sentinel=-1, day_col: str = "dt") -> DataFrame:
    """One row a key: its latest version up to ``day``.  One aggregation with
    map-side combine (the largest struct that begins with the day); versions
    of one day compare by their columns, so the choice does not depend on order."""
    newest = F.max(F.struct(day_col, *cols))
    return (up_to(versions, day, day_col).where(F.col(key) != sentinel)
            .groupBy(key).agg(newest.alias("v")).select(key, "v.*"))


def as_of(records: DataFrame, versions: DataFrame, day: str, cols: Sequence[str], key: str = "user_id",
          day_col: str = "dt") -> DataFrame:
    """``records`` with the columns ``cols`` of the version of their key valid on
    their own day (NULL where none is yet).

    Only the distinct (key, day) of the records meet the versions: a key with a
    third of all records sends one row a day through the window, and the join
    back is a plain equi join, whose hot keys AQE splits.  Versions of one day
    compare by their columns, as in ``snapshot_latest``.
    """
    asked = records.select(F.col(key).alias("__k"), F.col(day).alias("__d")).distinct()
    at = versions.schema[day_col].dataType
    known = (versions.groupBy(F.col(key).alias("__k"), F.col(day_col).alias("__d"))
             .agg(F.max(F.struct(*cols)).alias("__v")))
    both = known.unionByName(asked.select("__k", F.col("__d").cast(at).alias("__d"), F.col("__d").alias("__of")),
                             allowMissingColumns=True)
    # a version of the same day comes first (its __of is NULL)
    w = (Window.partitionBy("__k").orderBy("__d", F.col("__of").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, 0))
    valid = (both.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where(F.col("__of").isNotNull())
             .select("__k", F.col("__of").alias("__d"), "__v"))
    out = records.join(valid, (F.col(key) == F.col("__k")) & (F.col(day) == F.col("__d")), "left")
    return out.select(*[records[c] for c in records.columns if c not in cols],
                      *[F.col(f"__v.{c}").alias(c) for c in cols])
