"""Running sums in a total order without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import written


def running(rows: DataFrame, group: Sequence[str], order: Sequence[str],
            sums: Mapping[str, Column]) -> DataFrame:
    """``rows`` with, for each name of ``sums``, the sum of its column over the
    rows of the same group that come before (0 for the first) and, as
    ``<name>_all``, over the whole group.

    Rows are range-partitioned by (group, order) and written with the number
    of their range, which pins it; a sum runs inside one range only, and a
    small table of range totals gives each range its offset.  A group with a
    third of all rows is spread over many ranges.  ``group`` and ``order`` must
    have no nulls in ``group``; ``order`` should be unique, so that no range
    is larger than the others.
    """
    rows = written(rows.withColumns({f"__{n}": c.cast("long") for n, c in sums.items()})
                   .repartitionByRange(*group, *order)
                   .withColumn("__range", F.spark_partition_id()))
    keys = [*group, "__range"]
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    inside = (Window.partitionBy(*keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    totals = rows.groupBy(*keys).agg(*[F.sum(f"__{n}").alias(f"__{n}_t") for n in sums])
    for n in sums:
        totals = totals.withColumns({
            f"__{n}_off": F.coalesce(F.sum(f"__{n}_t").over(
                whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            f"{n}_all": F.sum(f"__{n}_t").over(whole)})
    out = rows.withColumns({n: F.coalesce(F.sum(f"__{n}").over(inside), F.lit(0)) for n in sums})
    out = out.join(totals.drop(*[f"__{n}_t" for n in sums]), keys)
    return (out.withColumns({n: F.col(n) + F.col(f"__{n}_off") for n in sums})
            .drop("__range", *[f"__{n}" for n in sums], *[f"__{n}_off" for n in sums]))
