"""Scoring operators F1-F20: blends, min-max scaling, rank percentages,
levels, shares, rates.  Plain column arithmetic and window aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import round_half_up, safe_div
from .joins import attach_group

# Fixed weights of the reference's blends.
RFM_WEIGHTS = {"frequency": 3, "monetary": 2, "monetary1": 2, "recency": 3}   # tenths
QUINTILE_WEIGHTS = {"frequency": 3, "recency": 3, "monetary": 4}              # tenths
BLEND_WEIGHTS = ((3, 7), (2, 8), (1, 9))                                        # rfm, behaviour (tenths)
# Guard divisors used when max = min (global scalers of the reference).
STREAMER_FLAT_DIVISOR = 10000
USER_FLAT_DIVISOR = 2000000


def tenths_blend(cols: Mapping[str, int]) -> Column:
    """sum(w_i/10 * c_i) for integer columns: exact, as integer tenths / 10."""
    num = None
    for c, w in cols.items():
        t = F.lit(w) * F.col(c)
        num = t if num is None else num + t
    return num.cast("double") / F.lit(10.0)


def minmax_scale(df: DataFrame, c: str, out: str, lo: float = 1, hi: float = 5,
                 group_by: Sequence[str] | None = None, flat_divisor: float | None = None,
                 digits: int = 2, keep_bounds: tuple[str, str] | None = None) -> DataFrame:
    """round(lo + (hi-lo) * (x - min) / (max - min), digits).

    Global (``group_by`` None, F3): the min/max row is one scalar attached by
    a broadcast nested-loop join; when max = min the reference divides by a
    constant instead (``flat_divisor``), giving ``lo``.
    Per group (F4): a window min/max; unguarded, so max = min gives NULL.
    """
    x = F.col(c)
    if group_by is None:
        mm = df.agg(F.max(c).alias("__mx"), F.min(c).alias("__mn"))
        d = df.crossJoin(F.broadcast(mm))
    else:
        d = attach_group(df, group_by, {"__mx": F.max(c), "__mn": F.min(c)})
    mx, mn = F.col("__mx"), F.col("__mn")
    span = (mx - mn).cast("double")
    scaled = F.lit(float(lo)) + F.lit(float(hi - lo)) * safe_div(x - mn, span)
    if flat_divisor is not None:
        flat = F.lit(float(lo)) + F.lit(float(hi - lo)) * (x - mn).cast("double") / F.lit(float(flat_divisor))
        scaled = F.when(span > 0, scaled).otherwise(flat)
    d = d.withColumn(out, round_half_up(scaled, digits))
    if keep_bounds:
        return d.withColumnRenamed("__mx", keep_bounds[0]).withColumnRenamed("__mn", keep_bounds[1])
    return d.drop("__mx", "__mn")


def rank_pct(rank: str, max_rank: str, digits: int) -> Column:
    """F8: round(rank / max rank, digits)."""
    return round_half_up(safe_div(rank, max_rank), digits)


def share(df: DataFrame, group_by: Sequence[str], num: str, out: str, digits: int,
          den: str | None = None) -> DataFrame:
    """Num / sum(den) over the group, rounded; NULL key -> NULL share."""
    den = den or num
    # Exact (order independent) total: the terms are rounded scores.
    d = attach_group(df, group_by, {"__tot": F.sum(F.col(den).cast("decimal(28,10)"))})
    return d.withColumn(out, round_half_up(safe_div(num, "__tot"), digits)).drop("__tot")


def rate(num: str, den: str, digits: int = 3) -> Column:
    """F16: successes / plays, NULL when plays = 0."""
    return round_half_up(safe_div(num, den), digits)


def blend(rfm: str, behaviour: str, w_rfm_tenths: int) -> Column:
    """round(w*rfm + (1-w)*behaviour, 2); NULL when either side is NULL."""
    v = (F.lit(w_rfm_tenths) * F.col(rfm) + F.lit(10 - w_rfm_tenths) * F.col(behaviour)) / F.lit(10.0)
    return round_half_up(v, 2)
