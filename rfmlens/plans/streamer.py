"""Streamer side: call base, streamer RFM score, level per country, level
mix and the region roll-up of active counts (reference stage ``10``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import level3, round_half_up, vip_flag
from ..session import cut_lineage
from ..operators.aggregates import avg_daily_active, call_base, rfm_values
from ..operators.bitmaps import distinct_bitmaps, distinct_members, members
from ..operators.joins import left_fill, lookup
from ..operators.ranking import RankSpec, rank_columns, score_from_rank
from ..operators.scores import (RFM_WEIGHTS, STREAMER_FLAT_DIVISOR, minmax_scale, rank_pct,
                                tenths_blend)

STREAMER_KEYS = ["streamer_id", "streamer_country_id", "streamer_country_name"]
STREAMER_COUNTRY = ["streamer_country_id", "streamer_country_name"]
LEVEL_DIGITS = 2


def streamer_call_base(calls: DataFrame, country_region: DataFrame, run_date: str) -> DataFrame:
    """(user, streamer) call base with both parties' region attached."""
    base = call_base(calls, run_date, ["streamer_id", "streamer_country_id",
                                       "streamer_country_name_ab"])
    base = lookup(base, country_region, "user_country_name", "country_name_en",
                  {"region_name": "user_region_name"})
    base = lookup(base, country_region, "streamer_country_name_ab", "country_ab",
                  {"country_name_en": "streamer_country_name", "region_name": "streamer_region_name"})
    return base.select(
        "user_id", "user_country_id", "user_country_name", "user_region_name", "is_user_vip",
        "streamer_id", "streamer_country_id", "streamer_country_name_ab",
        "streamer_country_name", "streamer_region_name",
        "frequency", "call_total_length", "gold_coin_amount", "recency_call_interval")


def rfm_ranks(values: DataFrame, tie: str | list[str], partition_by=(),
              metrics=("frequency", "monetary", "monetary1"), bounded: bool = False) -> DataFrame:
    """Rank (1 = best) and score (N = best) for each RFM term.

    Frequency and monetary terms rank descending, recency ascending; the
    score is ``N + 1 - rank`` instead of a second sort.
    """
    specs = [RankSpec(m, f"{m}_rnk", True) for m in metrics]
    specs.append(RankSpec("recency", "recency_rnk", False))
    d = rank_columns(values, specs, tie, partition_by, count_col="__n", bounded=bounded)
    for s in specs:
        base = s.out[:-4]
        d = (d.withColumn(s.out, F.col(s.out).cast("bigint"))
             .withColumn(f"{base}_score", score_from_rank(s.out, "__n")))
    return d.drop("__n")


def streamer_values(base: DataFrame) -> DataFrame:
    """RFM values per streamer (coins, call length), NULL defaults."""
    return rfm_values(base, STREAMER_KEYS, {"monetary": "gold_coin_amount",
                                            "monetary1": "call_total_length"})


def combine_scores(ranked: DataFrame) -> DataFrame:
    """F1: 0.3 F + 0.2 M + 0.2 L + 0.3 R over the inverse ranks (scores)."""
    return ranked.withColumn("rfm_combination_score", tenths_blend(
        {f"{m}_score": w for m, w in RFM_WEIGHTS.items()}))


def scale_global(combined: DataFrame, flat_divisor: int = STREAMER_FLAT_DIVISOR) -> DataFrame:
    """global min-max to 1..5, guarded when max = min."""
    return minmax_scale(combined, "rfm_combination_score", "rfm_score", 1, 5,
                        flat_divisor=flat_divisor)


def apply_weight(scored: DataFrame, weights: DataFrame) -> DataFrame:
    """round(score * weight, 2); streamers without a weight keep 1.0."""
    w = weights.select("streamer_id", F.col("weight").cast("double").alias("weight"))
    d = left_fill(scored, w, ["streamer_id"], {"weight": 1.0})
    return (d.withColumn("rfm_score", round_half_up(F.col("rfm_score") * F.col("weight"), 2))
            .drop("weight"))


def streamer_scores(base: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Streamer RFM values, global ranks, blend, 1-5 scale, weight."""
    d = cut_lineage(combine_scores(rfm_ranks(streamer_values(base), STREAMER_KEYS)))
    d = scale_global(d)
    d = apply_weight(d, weights) if weights is not None else d
    return cut_lineage(d)


def country_level(scores: DataFrame, partition_by=STREAMER_COUNTRY, tie=tuple(STREAMER_KEYS),
                  digits: int = LEVEL_DIGITS) -> DataFrame:
    """Rank by score inside the country, rank percentage, level 1-3."""
    d = rank_columns(scores, [RankSpec("rfm_score", "rfm_rnk", True)], tie,
                     partition_by, count_col="rfm_rnk_max")
    d = d.withColumn("rfm_rnk", F.col("rfm_rnk").cast("bigint"))
    d = d.withColumn("rfm_rnk_percentage", rank_pct("rfm_rnk", "rfm_rnk_max", digits))
    return d.withColumn("level", level3("rfm_rnk_percentage")).drop("rfm_rnk_max")


LEVEL_DETAIL_COLS = [
    "streamer_id", "streamer_country_id", "streamer_country_name",
    "frequency", "monetary", "monetary1", "recency",
    "frequency_rnk", "monetary_rnk", "monetary1_rnk", "recency_rnk",
    "frequency_score", "monetary_score", "monetary1_score", "recency_score",
    "rfm_combination_score", "rfm_score", "rfm_rnk", "rfm_rnk_percentage", "level"]


def streamer_level(calls: DataFrame, country_region: DataFrame, weights: DataFrame | None,
                   run_date: str) -> DataFrame:
    """job_streamer_level: call base -> scores -> level per country."""
    base = streamer_call_base(calls, country_region, run_date)
    return country_level(streamer_scores(base, weights)).select(*LEVEL_DETAIL_COLS)


def serve_level(detail: DataFrame) -> DataFrame:
    """The narrow serving table from the same plan (same day only, Q4)."""
    return detail.select("streamer_id", "streamer_country_id", "streamer_country_name",
                         "level", "rfm_score")


def level_distribution(detail: DataFrame) -> DataFrame:
    """Share of distinct streamers per level inside the country.  One
    set of bitmaps gives both counts: a country's total is the union of its levels."""
    sets = distinct_bitmaps(detail, STREAMER_COUNTRY + ["level"], "streamer_id")
    per_level = members(sets, STREAMER_COUNTRY + ["level"], "streamer_amount")
    total = distinct_members(sets, STREAMER_COUNTRY, "streamer_amount_total")
    d = per_level.join(total, STREAMER_COUNTRY, "left")
    return d.select(*STREAMER_COUNTRY, "level", "streamer_amount", "streamer_amount_total",
                    rank_pct("streamer_amount", "streamer_amount_total", 2).alias("percentage"))


def active_users(calls: DataFrame, with_vip: bool) -> DataFrame:
    """Average daily distinct users per user country (and vip flag), over all days."""
    keys = ["user_country_id", "user_country_name"] + (["is_user_vip"] if with_vip else [])
    d = calls.select("day", "user_id", "user_country_id", "user_country_name",
                     vip_flag("vip_level").alias("is_user_vip"))
    return avg_daily_active(d, "day", keys, "user_id", "user_active_amount")


def active_streamers(calls: DataFrame, country_region: DataFrame) -> DataFrame:
    """S41 / G6 + J3: average daily distinct streamers per streamer country, over all days."""
    d = avg_daily_active(calls, "day", ["streamer_country_id", "streamer_country_name_ab"],
                         "streamer_id", "streamer_active_amount")
    d = lookup(d, country_region, "streamer_country_name_ab", "country_ab",
               {"country_name_en": "streamer_country_name", "region_name": "streamer_region_name"})
    return d.select("streamer_country_id", "streamer_country_name", "streamer_country_name_ab",
                    "streamer_region_name", "streamer_active_amount")


def active_streamers_region(per_country: DataFrame) -> DataFrame:
    """Sum of the country averages per streamer region."""
    return (per_country.groupBy(F.col("streamer_region_name").alias("region_name"))
            .agg(round_half_up(F.sum("streamer_active_amount"), 6).alias("streamer_amount")))
