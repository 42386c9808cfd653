"""Preference of a user group (country or region, x vip) for each streamer
country (reference stages ``20`` steps 01-35 and ``21`` steps 01-34).

One code path serves both grains; a ``Grain`` names the user-group keys
and the few places where the two jobs differ (band join, min-max group).
All tables here are at pair grain, bounded by |groups| x |countries|.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..operators.joins import left_fill, pair_grid, semi_filter
from ..operators.ranking import RankSpec, rank_columns
from ..operators.scores import minmax_scale, rank_pct, share
from ..session import cut_lineage
from .streamer import combine_scores, rfm_ranks

STREAMER_COUNTRY = ["streamer_country_id", "streamer_country_name"]
BAND = (0.1, 0.6)           # fixed: middle band of rank percentages
GRID_DEFAULT = 0.5          # fixed: preference of a pair without calls
SHARE_DIGITS = 5
PCT_DIGITS = 5


@dataclass(frozen=True)
class Grain:
    name: str
    group: list[str]                       # user-group keys incl. the vip flag
    minmax_by: list[str]                   # groups of the unguarded 1-5 scale
    tie: list[str] = field(default_factory=list)

    @property
    def pair(self) -> list[str]:
        return self.group + STREAMER_COUNTRY


COUNTRY = Grain("country", ["user_country_id", "user_country_name", "is_user_vip"],
                ["user_country_name"],
                ["user_country_id", "user_country_name", "streamer_country_id",
                 "streamer_country_name"])
REGION = Grain("region", ["user_region_name", "is_user_vip"], ["is_user_vip"],
               ["user_region_name", "streamer_country_id", "streamer_country_name"])

BASE_COLS = ["user_id", "user_country_id", "user_country_name", "user_region_name",
             "is_user_vip", "streamer_id", "streamer_country_id", "streamer_country_name",
             "frequency", "call_total_length", "gold_coin_amount", "recency_call_interval"]


def in_band(level_detail: DataFrame, pct: str = "rfm_rnk_percentage") -> DataFrame:
    """Rows whose rank percentage lies in the middle band (inclusive)."""
    return level_detail.filter(F.col(pct).between(*BAND))


def select_band(base: DataFrame, users: DataFrame, streamers: DataFrame) -> DataFrame:
    """J9 (country): keep calls whose user and streamer are both in the band.

    The level tables are unique on their keys, so the reference's inner joins
    equal semi joins (no fan-out, no columns taken).
    """
    u = in_band(users).select("user_id", "user_country_id", "user_country_name", "is_user_vip")
    s = in_band(streamers).select("streamer_id", *STREAMER_COUNTRY)
    d = semi_filter(base, u, ["user_id", "user_country_id", "user_country_name", "is_user_vip"])
    return semi_filter(d, s, ["streamer_id", *STREAMER_COUNTRY]).select(*BASE_COLS)


def label_band(base: DataFrame, users: DataFrame) -> DataFrame:
    """J10 (region): left join to the band; the region comes from the band
    side, so it is NULL for users outside the band (Q5: nothing is dropped;
    the streamer band join of the reference has no effect and is omitted)."""
    u = (in_band(users).select("user_id", F.col("user_region_name").alias("__r"), "is_user_vip")
         .distinct())
    d = base.join(u, (base.user_id == u.user_id) & (base.user_region_name == u.__r)
                  & (base.is_user_vip == u.is_user_vip), "left")
    return d.select(base.user_id, "user_country_id", "user_country_name",
                    F.col("__r").alias("user_region_name"), base.is_user_vip, "streamer_id",
                    *STREAMER_COUNTRY, "frequency", "call_total_length", "gold_coin_amount",
                    "recency_call_interval")


def pair_values(selected: DataFrame, g: Grain) -> DataFrame:
    """RFM values per pair, NULL defaults 0 / 0 / 0 / 999."""
    from ..operators.aggregates import rfm_values
    return rfm_values(selected, g.pair, {"monetary": "gold_coin_amount",
                                          "monetary1": "call_total_length"})


def pair_scores(values: DataFrame, g: Grain) -> DataFrame:
    """W2 + F1 + F4 + W4: ranks inside vip, blend, unguarded 1-5 scale per
    group (Q13), then the global pair rank by the blend."""
    d = rfm_ranks(values, g.tie, ["is_user_vip"], bounded=True)
    d = combine_scores(d)
    d = minmax_scale(d, "rfm_combination_score", "rfm_score", 1, 5, group_by=g.minmax_by)
    d = rank_columns(d, [RankSpec("rfm_combination_score", "rfm_rnk", True)],
                     ["is_user_vip", *g.tie], (), bounded=True)
    return d.withColumn("rfm_rnk", F.col("rfm_rnk").cast("bigint"))


def preference(scores: DataFrame) -> DataFrame:
    """Rank percentage against the largest pair rank of the vip class
    (Q11), 5 digits; the preference is the 1-5 score."""
    from ..operators.joins import attach_group
    d = attach_group(scores, ["is_user_vip"], {"rfm_rnk_max": F.max("rfm_rnk")})
    d = d.withColumn("rfm_rnk_percentage", rank_pct("rfm_rnk", "rfm_rnk_max", PCT_DIGITS))
    return d.drop("rfm_rnk_max").withColumn("preference", F.col("rfm_score"))


def grid(call_base: DataFrame, g: Grain) -> DataFrame:
    """Every user group seen in the call base x every streamer country."""
    left = call_base.select(*g.group).distinct()
    right = call_base.select(*STREAMER_COUNTRY).distinct()
    return pair_grid(left, right)


def grid_fill(grid_df: DataFrame, pref: DataFrame, g: Grain) -> DataFrame:
    """The preference of each grid pair, 0.5 when the pair has none."""
    p = pref.select(*g.pair, "preference")
    return left_fill(grid_df, p, g.pair, {"preference": GRID_DEFAULT})


def distribution(filled: DataFrame, g: Grain) -> DataFrame:
    """share of the group's preference total, 5 digits."""
    return share(filled, g.group, "preference", "percentage", SHARE_DIGITS)


def preference_chain(call_base: DataFrame, selected: DataFrame, g: Grain) -> dict[str, DataFrame]:
    """All intermediate tables of one grain, keyed by step name."""
    values = cut_lineage(pair_values(selected, g))
    scores = cut_lineage(pair_scores(values, g))
    pref = preference(scores)
    gr = grid(call_base, g)
    filled = grid_fill(gr, pref, g)
    return {"values": values, "scores": scores, "preference": pref, "grid": gr,
            "filled": filled, "distribution": distribution(filled, g)}


def recall_by_level(dist: DataFrame, level_mix: DataFrame) -> DataFrame:
    """One row per (pair, streamer level): pair share x level share."""
    m = level_mix.select(*STREAMER_COUNTRY, "level", F.col("percentage").alias("__lp"))
    d = dist.join(m, STREAMER_COUNTRY, "left")
    return d.select(*COUNTRY.pair, "level",
                    round_half_up(F.col("percentage") * F.col("__lp"), 2).alias("percentage"))
