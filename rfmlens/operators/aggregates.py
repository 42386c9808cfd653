"""Aggregation operators G1-G12: hash aggregates with partial (map-side)
combine, so a hot key is pre-aggregated in every task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import recency_days, vip_flag, weighted_sum

# Coin blend of call and gift coins, RFM NULL defaults.
COIN_BLEND = {"call_gold_coin_amount": "0.6", "gift_gold_coin_amount": "0.4"}
RECENCY_DEFAULT = 999

USER_KEYS = ["user_id", "user_country_id", "user_country_name", "is_user_vip"]


def call_base(calls: DataFrame, run_date: str, streamer_keys: Sequence[str]) -> DataFrame:
    """G1: per (user, user country, vip flag, streamer, streamer country):
    number of calls, total length, blended coins, days since the last call."""
    d = calls.select(
        "user_id", "user_country_id", "user_country_name",
        vip_flag("vip_level").alias("is_user_vip"),
        "streamer_id", *[c for c in streamer_keys if c != "streamer_id"],
        "call_total_length",
        weighted_sum(COIN_BLEND).alias("gold_coin_amount"),
        recency_days(run_date, "call_begin_time").alias("recency_call_interval"))
    return (d.groupBy(*USER_KEYS, "streamer_id", *[c for c in streamer_keys if c != "streamer_id"])
            .agg(F.count(F.lit(1)).alias("frequency"),
                 F.sum("call_total_length").alias("call_total_length"),
                 F.sum("gold_coin_amount").alias("gold_coin_amount"),
                 F.min("recency_call_interval").alias("recency_call_interval")))


def rfm_values(base: DataFrame, keys: Sequence[str], monetary: dict[str, str]) -> DataFrame:
    """Roll the call base up to ``keys`` with the NULL defaults 0 / 0 / 999.

    ``monetary`` maps output name -> base column (coins, call length).
    """
    zero = F.lit(0)
    aggs = [F.sum(F.coalesce(F.col("frequency"), zero)).alias("frequency")]
    for out, src in monetary.items():
        aggs.append(F.sum(F.coalesce(F.col(src), zero.cast(base.schema[src].dataType))).alias(out))
    aggs.append(F.min(F.coalesce(F.col("recency_call_interval"), F.lit(RECENCY_DEFAULT)))
                .cast("bigint").alias("recency"))
    return base.groupBy(*keys).agg(*aggs)


def coin_total(a: DataFrame, b: DataFrame) -> DataFrame:
    """Coins per (user, remote user, room) over two coin tables."""
    cols = ["user_id", "remote_user_id", "room_id", "gold_num"]
    return (a.select(*cols).unionByName(b.select(*cols))
            .groupBy("user_id", "remote_user_id", "room_id")
            .agg(F.sum("gold_num").alias("gold_num")))


def gift_total(gifts: DataFrame) -> DataFrame:
    """Gift coins per (sender, receiver), renamed to (user, streamer)."""
    return (gifts.groupBy("send_user_id", "user_id").agg(F.sum("gift_gold").alias("gift_gold"))
            .select(F.col("send_user_id").alias("user_id"),
                    F.col("user_id").alias("streamer_id"), "gift_gold"))


def count_distinct_by(df: DataFrame, keys: Sequence[str], c: str, out: str) -> DataFrame:
    """Exact distinct count per group (Spark expands it into two
    aggregations, the first one de-duplicating (keys, c) with partial combine)."""
    return df.groupBy(*keys).agg(F.count_distinct(c).alias(out))


def avg_daily_active(df: DataFrame, day: str, keys: Sequence[str], ident: str,
                     out: str) -> DataFrame:
    """Distinct actives per (day, keys), then the average over days."""
    daily = df.groupBy(day, *keys).agg(F.count_distinct(ident).alias("__n"))
    return daily.groupBy(*keys).agg(F.avg("__n").alias(out))
