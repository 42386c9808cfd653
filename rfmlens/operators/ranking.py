"""Exact row-number ranks that do not funnel a group through one task.

``row_number() OVER (PARTITION BY g ORDER BY m DESC, id)`` is planned by
Spark as one sort per group; with no ``g`` (the reference's global RFM
ranks) or with a hot group holding a third of all rows, one task sorts it
all.  ``rank_columns`` computes the same numbers, for every input size and
for all terms of a frame at once:

1. the frame is written once with a row id; from that base every row gives
   one narrow row per term: group, term, sort value, tie columns;
2. these rows are range-partitioned by (group, term, value, ties) - ranges
   need an order only, so ids may be of any type and ties of any length -
   and written with the number of their range;
3. a range's count in each (group, term) gives the offsets of the later
   ranges (a running sum over a table of ranges, not rows);
4. the rank is the row number inside the range plus the offset; the terms
   of a row meet again by its row id.

Writing the ranged rows before they are numbered pins the range of every
row, so a lost executor re-reads the same ranges.

Ties are broken by the tie columns ascending; pass the full key of the
ranked entity, so that ranks are reproducible and the reverse score equals
``N + 1 - rank``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_once

# Rows of one group that one task may sort (frames declared ``bounded``).
BOUNDED_ROWS = 1_000_000


@dataclass(frozen=True)
class RankSpec:
    """One rank: ``out`` = row number by ``metric`` (desc or asc), then ties asc."""
    metric: str
    out: str
    descending: bool = True


def rank_columns(df: DataFrame, specs: Sequence[RankSpec], tie: Sequence[str] | str,
                 partition_by: Sequence[str] = (), count_col: str | None = None,
                 bounded: bool = False) -> DataFrame:
    """Add one exact row-number column per spec (see module doc).

    ``count_col`` also attaches the group size (= the largest rank); as in
    the reference's join back on the group keys, it is NULL when a group key
    is NULL.  NULL metrics sort as in Spark (first ascending, last
    descending).

    ``bounded=True`` is for frames bounded by dimension sizes (country
    pairs: at most |countries|^2 x 2 rows): plain windows, the same numbers in
    one sort per group.  The groups are counted first; should one have more
    than ``BOUNDED_ROWS`` rows, the ranges are used after all.
    """
    tie = [tie] if isinstance(tie, str) else list(tie)
    parts = list(partition_by)
    if bounded and _largest_group(df, parts) <= BOUNDED_ROWS:
        return _plain(df, specs, tie, parts, count_col)
    base = write_once(df.withColumn("__id", F.monotonically_increasing_id()))
    out = base
    for same in _by_type(base, specs):
        ranks = _ranged(base, same, tie, parts, count_col is not None and same[0] is specs[0])
        out = out.join(ranks, "__id")
    if count_col is not None:
        out = out.withColumn(count_col, _guarded(parts, F.col("__size")))
    return out.select(*df.columns, *([count_col] if count_col else []), *[s.out for s in specs])


def _largest_group(df: DataFrame, parts: list[str]) -> int:
    if not parts:
        return df.count()
    return df.groupBy(*parts).count().agg(F.max("count")).first()[0] or 0


def _plain(df: DataFrame, specs: Sequence[RankSpec], tie: list[str], parts: list[str],
           count_col: str | None) -> DataFrame:
    out = df
    for s in specs:
        m = F.col(s.metric).desc() if s.descending else F.col(s.metric).asc()
        w = Window.partitionBy(*parts).orderBy(m, *[F.col(t).asc() for t in tie])
        out = out.withColumn(s.out, F.row_number().over(w))
    size = []
    if count_col is not None:
        n = F.count(F.lit(1)).over(Window.partitionBy(*parts))
        size = [_guarded(parts, n).alias(count_col)]
    return out.select(*df.columns, *size, *[s.out for s in specs])


def _by_type(df: DataFrame, specs: Sequence[RankSpec]) -> list[list[RankSpec]]:
    """Specs whose metrics share a sort type (exact numbers; each other type)."""
    groups: dict[str, list[RankSpec]] = {}
    for s in specs:
        t = df.schema[s.metric].dataType
        exact = isinstance(t, (T.IntegralType, T.DecimalType))
        groups.setdefault("exact" if exact else t.simpleString(), []).append(s)
    return list(groups.values())


def _sort_value(df: DataFrame, s: RankSpec, exact: T.DataType | None) -> Column:
    c = F.col(s.metric).cast(exact) if exact is not None else F.col(s.metric)
    return -c if s.descending else c


def _ranged(base: DataFrame, specs: list[RankSpec], tie: list[str], parts: list[str],
            with_size: bool) -> DataFrame:
    """__id, the rank columns of specs of one sort type, and __size of the group."""
    types = [base.schema[s.metric].dataType for s in specs]
    exact = None
    if all(isinstance(t, T.IntegralType) for t in types):
        exact = T.LongType()
    elif all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        exact = T.DecimalType(38, max(t.scale for t in types if isinstance(t, T.DecimalType)))
    # a group is one string: NULL keys stay groups of their own, and joins are plain
    group = F.concat_ws("\u0001", F.lit(""), *[
        F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in parts])
    terms = F.explode(F.array(*[
        F.struct(F.lit(i).alias("term"), F.isnull(s.metric).alias("none") if s.descending
                 else F.isnotnull(s.metric).alias("none"), _sort_value(base, s, exact).alias("value"))
        for i, s in enumerate(specs)]))
    ties = [F.col(t).alias(f"__t{i}") for i, t in enumerate(tie)]
    order = ["term.none", "term.value", *[f"__t{i}" for i in range(len(tie))]]
    rows = (base.select("__id", group.alias("__g"), *ties, terms.alias("term"))
            .repartitionByRange("__g", "term.term", *order)
            .select("__id", "__g", F.col("term.term").alias("__term"), F.col("term.none").alias("__none"),
                    F.col("term.value").alias("__value"), *[f"__t{i}" for i in range(len(tie))],
                    F.spark_partition_id().alias("__range")))
    rows = write_once(rows)
    whole = Window.partitionBy("__g", "__term")
    offsets = (rows.groupBy("__range", "__g", "__term").agg(F.count(F.lit(1)).alias("__c"))
               .withColumn("__n", F.sum("__c").over(whole))
               .withColumn("__off", F.coalesce(F.sum("__c").over(
                   whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    w = (Window.partitionBy("__range", "__g", "__term")
         .orderBy("__none", "__value", *[f"__t{i}" for i in range(len(tie))]))
    numbered = (rows.withColumn("__rn", F.row_number().over(w))
                .join(offsets.drop("__c"), ["__range", "__g", "__term"])
                .withColumn("__rank", (F.col("__rn") + F.col("__off")).cast("bigint")))
    out = numbered.groupBy("__id").agg(
        *[F.max(F.when(F.col("__term") == i, F.col("__rank"))).alias(s.out) for i, s in enumerate(specs)],
        F.max("__n").alias("__size"))
    return out if with_size else out.drop("__size")


def _guarded(parts: list[str], c: Column) -> Column:
    cond = None
    for k in parts:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return c if cond is None else F.when(cond, c)


def top_k(df: DataFrame, partition_by: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str = "rnk") -> DataFrame:
    """The first ``k`` rows per group (Spark plans a WindowGroupLimit)."""
    w = Window.partitionBy(*partition_by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def score_from_rank(rank: str, count: str) -> Column:
    """Reverse rank (1 = worst): N + 1 - rank, the ascending row number."""
    return (F.col(count) + 1 - F.col(rank)).cast("bigint")
