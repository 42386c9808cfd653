"""Join operators: lookups, default-fill, semi filters,
group-total attach and the time-bounded request-to-call match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once


def dedup(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of the given columns (GROUP BY without aggregates)."""
    return (df.select(*cols) if cols else df).distinct()


def lookup(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
           take: Mapping[str, str]) -> DataFrame:
    """Left lookup of ``take`` (dim column -> output name) by one key.

    The dimension is de-duplicated on the key and the taken columns first
    (as the reference's ``group by``); Spark picks the join from real sizes.
    A name with two rows in the dimension fans out, as in the reference.
    """
    cols = [right_on] + [c for c in take if c != right_on]
    d = dedup(dim, cols)
    d = d.select(F.col(right_on).alias("__lk"),
                 *[F.col(src).alias(dst) for src, dst in take.items()])
    out = df.join(d, df[left_on] == d["__lk"], "left").drop("__lk")
    return out


def left_fill(left: DataFrame, right: DataFrame, on: Sequence[str],
              defaults: Mapping[str, object]) -> DataFrame:
    """Left join on ``on`` and replace NULLs of the right columns."""
    out = left.join(right, list(on), "left")
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def semi_filter(df: DataFrame, allow: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep rows of ``df`` whose keys appear in ``allow`` (no fan-out)."""
    return df.join(allow.select(*on), list(on), "left_semi")


def attach_group(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Group aggregate attached to every row of the group.

    Written as a window aggregate (one shuffle) instead of aggregate +
    join back.  The reference joins on the keys, so a row with a NULL key
    gets NULL totals; reproduced by the guard.
    """
    w = Window.partitionBy(*keys)
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else (not_null & c)
    for name, agg in aggs.items():
        df = df.withColumn(name, F.when(not_null, agg.over(w)))
    return df


def pair_grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every left key row with every right key row.

    Both sides are distinct lists of dimension values (user country or
    region x vip; streamer country), by contract bounded by the country
    dimension, so the right side is broadcast.
    """
    return left.crossJoin(F.broadcast(right))


# A key is heavy with more than this share of all rows (so there are at most
# 1 / HEAVY_SHARE of them) and more than HEAVY_ROWS rows.
HEAVY_SHARE = 0.001
HEAVY_ROWS = 1_000_000


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE, rows: int = HEAVY_ROWS) -> DataFrame:
    """``__heavy`` (a key of ``df`` too large for one task) and ``__salts``, into
    how many parts it is cut; written, at most 1 / share rows, whatever the data."""
    most = max(rows, int(df.count() * share))
    n = F.count(F.lit(1))
    return write_once(df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__heavy"))
                      .agg(n.alias("__n")).where(F.col("__n") > most)
                      .select("__heavy", F.ceil(F.col("__n") / most).cast("int").alias("__salts")))


def salted_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                heavy: DataFrame) -> DataFrame:
    """Inner join whose heavy left keys are spread over several tasks.

    The rows of a heavy key are dealt by a hash of the whole row (a retried task
    deals them alike) and the right rows of that key - and of no other - are
    repeated for each part.  Right keys may fan out: every left row meets each
    right row of its key exactly once.  ``heavy`` is bounded (see ``heavy_keys``),
    hence the broadcast.
    """
    salts = F.broadcast(heavy)
    lf = (left.join(salts, left[left_on] == F.col("__heavy"), "left")
          .withColumn("__part", F.when(F.col("__salts").isNotNull(), F.pmod(
              F.xxhash64(*[left[c] for c in left.columns]), F.col("__salts")).cast("int")).otherwise(0))
          .drop("__heavy", "__salts"))
    parts = F.when(F.col("__salts").isNotNull(), F.sequence(F.lit(0), F.col("__salts") - 1)).otherwise(F.array(F.lit(0)))
    rt = (right.join(salts, right[right_on] == F.col("__heavy"), "left")
          .withColumn("__right_part", F.explode(parts)).drop("__heavy", "__salts")
          .withColumnRenamed(right_on, "__right_key"))
    out = lf.join(rt, (lf[left_on] == rt["__right_key"]) & (F.col("__part") == F.col("__right_part")))
    return out.drop("__right_key", "__part", "__right_part")


def interval_match(req: DataFrame, calls: DataFrame, keys: Sequence[tuple[str, str]],
                   req_ts: str, call_ts: str, gap_s: int) -> DataFrame:
    """Request-to-call match: same keys, ``0 <= call - request < gap_s``.

    Every match is kept.  Besides the equality keys the join also uses a
    time bucket of width ``gap_s``: a call in bucket b can only match a
    request in bucket b or b-1, so requests are emitted twice (b, b+1) and
    calls once.  A busy (user, target) pair is thereby cut into time slices
    and the join never puts a pair's whole history into one task.
    """
    rq = (req.withColumn("__rt", F.unix_timestamp(F.col(req_ts)))
          .withColumn("__b", F.explode(F.array(
              F.floor(F.col("__rt") / gap_s), F.floor(F.col("__rt") / gap_s) + 1))))
    cl = (calls.withColumn("__ct", F.unix_timestamp(F.col(call_ts)))
          .withColumn("__b", F.floor(F.col("__ct") / gap_s)))
    cond = [rq[a] == cl[b] for a, b in keys] + [rq["__b"] == cl["__b"]]
    cond.append(cl["__ct"] >= rq["__rt"])
    cond.append(cl["__ct"] - rq["__rt"] < gap_s)
    out = rq.join(cl, cond, "inner")
    return out.drop(rq["__b"]).drop(cl["__b"]).drop("__rt", "__ct")
