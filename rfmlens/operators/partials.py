"""A2 by mergeable day partials.

A window over call facts is not aggregated from the facts again every day.
Each day leaves one row per call-base key - count, sums, latest call - and a
window is the merge of its days' rows: counts and sums add up, the latest call
is the largest.  Days are partitions, so a window reads only its own days, a
corrected day is rewritten alone, and a rerun of a past day never sees a later
call.  Recency is counted from the latest call when the window is merged, so
one set of partials serves any reference day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import recency_days, vip_flag, weighted_sum
from .aggregates import COIN_BLEND, USER_KEYS

STREAMER_ATTRIBUTES = ["streamer_id", "streamer_country_id", "streamer_country_name",
                       "streamer_country_name_ab"]
PARTIAL_KEYS = [*USER_KEYS, *STREAMER_ATTRIBUTES]


def day_partials(calls: DataFrame, day: str = "day") -> DataFrame:
    """One row per day and call-base key of call facts."""
    rows = calls.select(
        day, "user_id", "user_country_id", "user_country_name", vip_flag("vip_level").alias("is_user_vip"),
        *STREAMER_ATTRIBUTES, "call_total_length", weighted_sum(COIN_BLEND).alias("gold_coin_amount"),
        "call_begin_time")
    return rows.groupBy(day, *PARTIAL_KEYS).agg(
        F.count(F.lit(1)).alias("frequency"),
        F.sum("call_total_length").alias("call_total_length"),
        F.sum("gold_coin_amount").alias("gold_coin_amount"),
        F.max("call_begin_time").alias("last_call"))


def merge_partials(partials: DataFrame, run_date: str, keys: Sequence[str]) -> DataFrame:
    """G1 over the days of ``partials``: the call base of ``keys``, as
    ``call_base`` gives it from the facts of the same days."""
    return partials.groupBy(*keys).agg(
        F.sum("frequency").alias("frequency"),
        F.sum("call_total_length").alias("call_total_length"),
        F.sum("gold_coin_amount").alias("gold_coin_amount"),
        recency_days(run_date, F.max("last_call")).alias("recency_call_interval"))
