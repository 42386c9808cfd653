"""Column expressions shared by the jobs.  All JVM-side built-ins, no UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """round(x, n) half-up on the decimal value, returned as DOUBLE.

    Rounding a double directly is engine dependent at the .5 boundary
    (1.005 -> 1.0 or 1.01); going through DECIMAL(28,10) first makes it
    reproducible.  NULL stays NULL.
    """
    return F.round(col(c).cast(DecimalType(28, 10)), digits).cast(DoubleType())


def safe_div(num, den) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(col(num).cast(DoubleType()), col(den).cast(DoubleType()))


def recode(c, mapping: Mapping, default) -> Column:
    """CASE c WHEN k1 THEN v1 ... ELSE default END (NULL input -> default)."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None
               else out.when(c == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


# Fixed values of the vip encodings.
VIP_TO_FLAG = {"free": "0"}          # anything else (NULL too) -> '1'
FLAG_TO_IF_VIP = {"1": "vip"}        # anything else -> 'free'
IF_VIP_TO_FLAG = {"vip": "1"}        # anything else -> '0'


def vip_flag(c) -> Column:
    """'free' -> '0', anything else (NULL included) -> '1'."""
    return recode(c, VIP_TO_FLAG, "1")


def if_vip_from_flag(c) -> Column:
    """'1' -> 'vip', else 'free'."""
    return recode(c, FLAG_TO_IF_VIP, "free")


def flag_from_if_vip(c) -> Column:
    """'vip' -> '1', else '0'."""
    return recode(c, IF_VIP_TO_FLAG, "0")


def recency_days(run_date: str, ts) -> Column:
    """Whole days from the call day to the run date (datediff), BIGINT."""
    return F.datediff(F.to_date(F.lit(run_date)), F.to_date(col(ts))).cast("bigint")


def call_start(end_ts, duration_ms) -> Column:
    """Call start = end - duration, duration in ms truncated to whole seconds."""
    secs = F.unix_timestamp(col(end_ts)) - (col(duration_ms) / F.lit(1000)).cast("int")
    return F.timestamp_seconds(secs)


def weighted_sum(weights: Mapping[str, str]) -> Column:
    """sum(w * col) with the weights as exact decimal literals."""
    terms = [F.lit(w).cast(DecimalType(4, 2)) * col(c) for c, w in weights.items()]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def bucket(c, cuts: Sequence[float], labels: Sequence[int], default: int) -> Column:
    """First label whose cut is >= value (value <= cut_i -> labels[i]); else default.

    NULL falls through to the default, as in the reference's CASE chains.
    """
    c = col(c)
    out = None
    for cut, lab in zip(cuts, labels):
        cond = c <= F.lit(cut)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(default)).cast("bigint")


# Fixed cut points of the reference's CASE chains (fractions, inclusive).
LEVEL3_CUTS = (1 / 9, 4 / 9)                            # -> 1, 2, else 3
LEVEL5_CUTS = (1 / 15, 3 / 15, 6 / 15, 10 / 15)        # -> 1..4, else 5
QUINTILE_CUTS = (1 / 25, 4 / 25, 9 / 25, 16 / 25)       # -> 5, 4, 3, 2, else 1


def level3(c) -> Column:
    return bucket(c, LEVEL3_CUTS, (1, 2), 3)


def level5(c) -> Column:
    return bucket(c, LEVEL5_CUTS, (1, 2, 3, 4), 5)


def quintile(c) -> Column:
    return bucket(c, QUINTILE_CUTS, (5, 4, 3, 2), 1)


def decimals_to_double(df):
    """Cast DECIMAL columns to DOUBLE and small ints to BIGINT for output."""
    from pyspark.sql.types import IntegerType, ShortType, ByteType
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
